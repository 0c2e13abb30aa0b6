"""Similarity of strings and sets."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinlink.functions import text as tx


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def jaccard(a, b) -> Column:
    """Of two arrays without repeats: 1 for two empty ones, 0 for one empty one."""
    a, b = _c(a), _c(b)
    both = F.size(F.array_intersect(a, b)).cast("double")
    either = (F.size(a) + F.size(b)).cast("double") - both
    return F.when(either == 0, F.lit(1.0)).otherwise(both / F.greatest(either, F.lit(1.0)))


def token_jaccard(a, b, mode: str = "full") -> Column:
    return jaccard(tx.tokens(tx.normalize_text(a, mode)), tx.tokens(tx.normalize_text(b, mode)))


def char_ngram_jaccard(a, b, mode: str = "full", n: int = 3) -> Column:
    return jaccard(tx.char_ngrams(tx.normalize_text(a, mode), n), tx.char_ngrams(tx.normalize_text(b, mode), n))


def lcs_length(a: str, b: str) -> int:
    """Longest common subsequence, bit-parallel: one big integer as the column of the matrix."""
    if not a or not b:
        return 0
    where: dict[str, int] = {}
    for i, ch in enumerate(a):
        where[ch] = where.get(ch, 0) | 1 << i
    full = (1 << len(a)) - 1
    s = full
    for ch in b:
        u = s & where.get(ch, 0)
        s = ((s + u) | (s - u)) & full
    return len(a) - s.bit_count()


def indel(a: str, b: str) -> float:
    """1 - (insertions and deletions) / (total length); two empty strings are equal."""
    total = len(a) + len(b)
    return 1.0 if not total else 2.0 * lcs_length(a, b) / total


def token_set(a: str, b: str) -> float:
    """Similarity of two texts as word sets: shared words count for both sides."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both = " ".join(sorted(x & y))
    only_a, only_b = " ".join(sorted(x - y)), " ".join(sorted(y - x))
    if both and (not only_a or not only_b):
        return 1.0
    gap = 1 if both else 0
    la, lb = len(both) + gap + len(only_a), len(both) + gap + len(only_b)
    total = la + lb
    distance = len(only_a) + len(only_b) - 2 * lcs_length(only_a, only_b)
    best = 1.0 - distance / total if total else 0.0
    if not both:
        return best
    n = len(both)
    return max(best, 1.0 - (gap + len(only_a)) / (n + la), 1.0 - (gap + len(only_b)) / (n + lb))


def _indel_series(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([1.0 if x == y else indel(x or "", y or "") for x, y in zip(a, b)], dtype="float64")


def _token_set_series(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([token_set(x or "", y or "") for x, y in zip(a, b)], dtype="float64")


def _four(n1: pd.Series, n2: pd.Series, c1: pd.Series, c2: pd.Series, a1: pd.Series, a2: pd.Series) -> pd.DataFrame:
    return pd.DataFrame(
        {
            "name_ratio": _indel_series(n1, n2),
            "name_core_ratio": _indel_series(c1, c2),
            "name_token_set_ratio": _token_set_series(n1, n2),
            "address_ratio": _indel_series(a1, a2),
        }
    )


def indel_ratio(a, b) -> Column:
    """indel() over two string columns in Arrow batches; null counts as empty."""
    return F.pandas_udf(_indel_series, T.DoubleType())(_c(a), _c(b))


def token_set_ratio(a, b) -> Column:
    """token_set() over two string columns in Arrow batches; null counts as empty."""
    return F.pandas_udf(_token_set_series, T.DoubleType())(_c(a), _c(b))


def fuzzy_four(*columns) -> Column:
    """The four text ratios of a pair in one Arrow pass: struct of name_ratio, name_core_ratio, name_token_set_ratio, address_ratio of
    (name, name, core, core, address, address)."""
    names = ("name_ratio", "name_core_ratio", "name_token_set_ratio", "address_ratio")
    return F.pandas_udf(_four, T.StructType([T.StructField(n, T.DoubleType()) for n in names]))(*[_c(c) for c in columns])


def len_diff(a, b) -> Column:
    return F.abs(F.length(_c(a)) - F.length(_c(b)))


def exact_eq(a, b) -> Column:
    """1 where both are equal, two empty ones included."""
    return (_c(a) == _c(b)).cast("int")


def country_equal_raw(a, b) -> Column:
    """Equality of the countries as written, but for case: not of their normalized form."""
    return (F.lower(_c(a)) == F.lower(_c(b))).cast("int")


def fbeta(precision, recall, beta: float = 0.5) -> Column:
    p, r = _c(precision), _c(recall)
    b2 = F.lit(float(beta * beta))
    below = b2 * p + r
    return F.when(below == 0, F.lit(0.0)).otherwise((b2 + 1.0) * p * r / F.when(below == 0, F.lit(1.0)).otherwise(below))
