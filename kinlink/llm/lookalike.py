"""One form for text that looks the same (problem 4).

canonical form: compatibility composed form, default-ignorable characters removed, every kind of blank mapped to the plain
one and stripped at the ends, letters of other scripts with the shape of a Latin letter and all hyphens mapped to one character.
With `fold` the form is also fully case-folded: that is the comparison key; without it the form keeps what the eye
can tell apart (case, accents, words). Each distinct value of a batch is normalised once.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Characters of the shape of another one (letters of other scripts, hyphens).
SHAPES = {
    # Cyrillic
    "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O", "Р": "P",
    "Ѕ": "S", "Т": "T", "У": "Y", "Ү": "Y", "Х": "X", "Ԛ": "Q", "Ԝ": "W", "Ԍ": "G",
    "а": "a", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "ӏ": "l", "о": "o", "р": "p", "ԛ": "q",
    "ѕ": "s", "у": "y", "х": "x", "ԝ": "w", "ѵ": "v", "ү": "y",
    # Greek
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P",
    "Τ": "T", "Υ": "Y", "Χ": "X", "ο": "o", "ν": "v", "ϳ": "j", "ρ": "p", "α": "a", "ι": "i", "υ": "u", "γ": "y",
    # Armenian and others
    "օ": "o", "ո": "n", "ս": "u", "ց": "g", "ɡ": "g", "ı": "i", "ɑ": "a",
    # hyphens and minus signs
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-", "﹣": "-", "－": "-", "⁃": "-", "˗": "-",
    # apostrophes
    "’": "'", "‘": "'", "ʼ": "'", "＇": "'", "′": "'",
}
# The code points with the property Default_Ignorable_Code_Point.
IGNORABLE = re.compile(
    "[\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180b-\u180f\u200b-\u200f\u202a-\u202e\u2060-\u206f\u3164\ufe00-\ufe0f\ufeff\uffa0\ufff0-\ufff8"
    "\U0001bca0-\U0001bca3\U0001d173-\U0001d17a\U000e0000-\U000e0fff]"
)
_SHAPE_TABLE = str.maketrans(SHAPES)
_BLANK = re.compile(r"[\s   -     　\x85\x1c-\x1f]")
_PLAIN = re.compile(r"^[!-~]+(?: [!-~]+)*$")


def look(text: str | None, fold: bool = False, shapes: bool = True) -> str | None:
    """The one form of text; None stays None. Linear in the length; the empty text stays empty."""
    if text is None:
        return None
    if not _PLAIN.match(text):
        text = unicodedata.normalize("NFKC", text)
        if not text.isascii():
            text = IGNORABLE.sub("", text)
        text = _BLANK.sub(" ", text).strip(" ")
        if shapes and not text.isascii():
            # decompose, map the bases, compose: an accented look-alike ends as the accented Latin letter
            text = unicodedata.normalize("NFC", unicodedata.normalize("NFD", text).translate(_SHAPE_TABLE))
    return unicodedata.normalize("NFC", unicodedata.normalize("NFKC", text.casefold())) if fold else text


def look_col(c: Column, fold: bool = False, shapes: bool = True) -> Column:
    """look() over a column."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for values in batches:
            codes, uniques = pd.factorize(values)
            done = [look(u, fold, shapes) for u in uniques]
            yield pd.Series([done[k] if k >= 0 else None for k in codes], dtype=object)

    return run(c)


def lookalike_classes(records: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, raw, look): one row for each distinct (id, text) with its form; texts are normalised once each.

    Nulls, in either column, are left out; repeated rows count once; an empty table gives no rows; other columns are dropped.
    """
    rows = records.select(F.col(id_col).alias("id"), F.col(text_col).alias("raw")).where("id is not null and raw is not null").distinct()
    texts = rows.select("raw").distinct().withColumn("look", look_col(F.col("raw")))
    return rows.join(texts, "raw").select("id", "raw", "look")


def lookalike_pairs(records: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id_a, id_b), id_a < id_b: different ids whose texts look the same and are different strings.

    Groups are joined on their folded form; only forms written in two or more ways are joined, first way with way,
    then each pair of ways with its ids, so the work follows the size of the result. Exact check: the case-keeping forms agree.
    """
    rows = records.select(F.col(id_col).alias("id"), F.col(text_col).alias("raw")).where("id is not null and raw is not null").distinct()
    ways = rows.select("raw").distinct().withColumn("folded", look_col(F.col("raw"), fold=True)).withColumn("look", look_col(F.col("raw")))
    several = ways.groupBy("folded").agg(F.count("*").alias("n")).where("n > 1").select("folded")
    ways = ways.join(several, "folded", "left_semi")
    a = ways.select("folded", F.col("look").alias("look_a"), F.col("raw").alias("raw_a"))
    b = ways.select("folded", F.col("look").alias("look_b"), F.col("raw").alias("raw_b"))
    pairs = a.join(b, "folded").where("look_a = look_b and raw_a < raw_b").select("raw_a", "raw_b")
    ids = rows.select("id", "raw")
    return (
        pairs.join(ids.select(F.col("raw").alias("raw_a"), F.col("id").alias("x")), "raw_a")
        .join(ids.select(F.col("raw").alias("raw_b"), F.col("id").alias("y")), "raw_b")
        .where("x <> y")
        .select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"))
        .distinct()
    )
