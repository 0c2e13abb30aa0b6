"""Variant spellings of one organisation's name (problem 5): a sharded trie join.

Names are parsed, and equal part lists become one form. A form goes to a few shards: the first and last consonants of each of its
words and of all of them together, with the trade; of all words at once, where the names without a trade are met; and each whole word. A typing
error, a dropped vowel, a joined, parted or moved word leaves at least one of these keys as it was; rarely two errors break them all. Each shard builds a trie of the joined words of its
forms in all orders of the words (and a second one of their consonants), and walks it with a Levenshtein automaton for every longer form. A shard
with more forms than a task should hold is cut into a grid of index parts and query parts, so no form is left out and no shard is bound to one
task. Nearly all shards have a handful of forms, for which tries cost more than they save: there, any two forms whose letters could be within the
automaton's bound are taken, in arrays. Pairs meet in some nine shards; each is compared once, first by parts, over all orders of the words
(names.same_org), then by the automaton's rule (meets), so the answer is the same for either way.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import permutations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinlink.functions.text import missing
from kinlink.llm.address import osa
from kinlink.llm.classes import link_classes
from kinlink.llm.names import LEXICON, Lexicon, OrgName, bones, few_vowels, fold, parse_name, same_org
from kinlink.llm.trie import Trie
from kinlink.session import cut, shuffle_partitions, stored

INDEX_PART = 4_000
QUERY_PART = 20_000
PAIRS_AT_ONCE = 1 << 17  # of a task, in arrays
PARTS = "words string, given string, trade int"


def shard_keys(name: OrgName) -> list[str]:
    """Shards of a form; a form without words has none."""
    words = name.words.split()
    if not words:
        return []
    keys: set[str] = set()
    units = {*words, "".join(words)}
    solid = [b for b in map(bones, units) if len(b) >= 3] or ["".join(words)]
    if name.trade:
        for b in solid:
            keys.add(f"{name.trade}<{b[:4]}")
            keys.add(f"{name.trade}>{b[-4:]}")
            if len(b) >= 4:
                keys.add(f"{name.trade}~{b[:2]}{b[-2:]}")
    if len(words) > 1:
        keys.update("@" + b for b in map(bones, words) if len(b) >= 4)  # one word as it is, whatever became of the others and of the trade
    if len(words) == 1:
        b = bones(words[0])
        keys.update(("=" + b[:6], "=" + b[:2] + b[-2:]))
        # a family name alone: shorter keys, together with the given name's initial
        for g in {fold(x)[:1] for x in name.given.split("|") if x}:
            keys.add(f"{name.trade}{g}<{b[:2]}")
            keys.add(f"{name.trade}{g}>{b[-2:]}")
    n = 4 if len(words) == 1 else 3
    keys.add("=" + "|".join(sorted(bones(w)[:n] for w in words)))
    keys.add("#" + "|".join(sorted(bones(w)[-n:] for w in words)))
    for joined in map(bones, _orders(words)):  # joined words, in whatever order they were joined
        keys.add("*" + joined[:4] + joined[-3:])
    return sorted(keys)


def with_names(df: DataFrame, text_col: str, keys: bool = False, lexicon: Lexicon = LEXICON) -> DataFrame:
    """df with words, given, trade (and shard keys) of its name column, one parse for each distinct name of a batch."""
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema), PARTS, *(["shards array<string>"] if keys else [])])
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            memo: dict = {}
            done = []
            for t in b.column(at).to_pylist():
                if t not in memo:
                    memo[t] = parse_name(t, lexicon)
                done.append(memo[t])
            cols = [pa.array([x.words for x in done], pa.string()), pa.array([x.given for x in done], pa.string()), pa.array([x.trade for x in done], pa.int32())]
            names = ["words", "given", "trade"]
            if keys:
                cols.append(pa.array([shard_keys(x) for x in done], pa.list_(pa.string())))
                names.append("shards")
            yield pa.RecordBatch.from_arrays([*b.columns, *cols], [*b.schema.names, *names])

    return df.mapInArrow(run, schema)


def _orders(words: list[str]) -> list[str]:
    """The words joined in every order; more than three in the written one."""
    return ["".join(p) for p in permutations(words)] if len(words) <= 3 else ["".join(words)]


class _Form(NamedTuple):
    words: list[str]
    joined: str
    bones: str
    orders: list[str]
    weak: bool


@lru_cache(1 << 15)
def _form(words: str) -> _Form:
    """A form comes to several shards of a task."""
    w = words.split()
    joined = "".join(w)
    return _Form(w, joined, bones(joined), _orders(w), few_vowels(w))


def _most(size: int) -> int:
    """Edits that a form of so many letters may be away from a shorter one."""
    return 1 if size < 7 else 2 if size < 14 else 3


def _word_most(word: str) -> int:
    return 0 if len(word) < 4 else _most(len(word))


class _Tries:
    """Index forms as tries of their joined words in all orders (single: of one word; long: of more than three words, in the written order) and of
    their consonants (weak: of forms short of vowels); forms of more than three words also by single words, for other orders."""

    __slots__ = ("whole", "single", "long", "weak", "words", "bones", "equal", "thin", "n_thin")

    def __init__(self) -> None:
        self.whole, self.single, self.long, self.weak, self.words, self.bones = (Trie() for _ in range(6))
        self.equal: dict[str, list[int]] = {}  # by consonants; they go into a trie when a form short of vowels asks
        self.thin, self.n_thin = Trie(), 0

    def add(self, form: _Form, k: int) -> None:
        words = form.words
        if len(words) == 1:
            self.single.add(form.joined, k)
        for j in form.orders:
            (self.whole if len(words) <= 3 else self.long).add(j, k)
            thin = bones(j) if len(words) > 1 else form.bones
            self.equal.setdefault(thin, []).append(k)
            if form.weak:
                self.weak.add(thin, k)
        if len(words) > 3:
            for w in set(words):
                self.words.add(w, k)
                self.bones.add(bones(w), k)

    def _by_word(self, words: set[str]) -> set[int]:
        """Forms that have a like word for all of words but one (a given name not known as such)."""
        found: Counter = Counter()
        for w in words:
            b = bones(w)
            found.update({*self.words.search(w, _word_most(w)), *self.bones.search(b, 1 if len(b) >= 6 else 0)})
        return {k for k, c in found.items() if c >= len(words) - 1}

    def search(self, form: _Form) -> set[int]:
        words, joined = form.words, form.joined
        most = _most(len(joined))
        hits: set[int] = set()
        for j in form.orders if len(words) == 3 else [joined]:  # two of three words may be one in the other form
            hits.update(self.whole.search(j, most))
        if len(words) == 2 and self.single.root:
            hits.update(self.single.search(words[1] + words[0], most))
        if self.long.root:
            for j in form.orders:
                hits.update(self.long.search(j, most))
            if len(words) > 3:
                hits |= self._by_word(set(words))
        if form.weak:  # by the asking form alone, so the answer does not depend on how a shard is cut
            if self.n_thin < len(self.equal):
                for thin in list(self.equal)[self.n_thin :]:
                    self.thin.add(thin, self.equal[thin])
                self.n_thin = len(self.equal)
            return hits.union(*self.thin.search(form.bones, 1))
        hits.update(self.equal.get(form.bones, ()))
        hits.update(self.weak.search(form.bones, 1))
        return hits


ANY = -1  # tries of the forms of all trades


class _Index:
    """The forms of a shard so far and their tries by trade. Forms go into the tries when another one asks, so a lone form never does."""

    __slots__ = ("names", "added", "tries")

    def __init__(self) -> None:
        self.names: list[tuple[int, OrgName]] = []
        self.added = 0
        self.tries: dict[int, _Tries] = {}

    def search(self, name: OrgName, all_trades: bool) -> set[int]:
        for k in range(self.added, len(self.names)):
            other = self.names[k][1]
            for t in (other.trade, ANY) if other.trade and all_trades else (other.trade,):
                self.tries.setdefault(t, _Tries()).add(_form(other.words), k)
        self.added = len(self.names)
        hits: set[int] = set()
        for t in (name.trade or ANY, 0):  # a name that states a trade fits those of its own and those without one
            if t in self.tries:
                hits |= self.tries[t].search(_form(name.words))
        return hits


def meets(name: _Form, other: _Form) -> bool:
    """Whether _Tries that hold the other form find it for this one, the longer of the two."""
    words, most = name.words, _most(len(name.joined))
    asked = name.orders if len(words) == 3 or len(other.words) > 3 else [name.joined]
    if any(osa(x, y, most) <= most for y in other.orders for x in asked):
        return True
    if len(words) == 2 and len(other.words) == 1 and osa(words[1] + words[0], other.joined, most) <= most:
        return True
    if len(words) > 3 and len(other.words) > 3:
        like = sum(any(osa(w, v, _word_most(w)) <= _word_most(w) or osa(bones(w), bones(v), 1) <= (len(bones(w)) >= 6) for v in other.words) for w in set(words))
        if like >= len(set(words)) - 1:
            return True
    few = 1 if name.weak or other.weak else 0
    return any(osa(name.bones, bones(y), few) <= few for y in other.orders)


_ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789"
_ONCE = {c: 1 << k for k, c in enumerate(_ALPHABET)}
_TWICE = {c: 1 << len(_ALPHABET) + k for k, c in enumerate(_ALPHABET[:26])}
_SOLID = np.int64(sum(b for c, b in _ONCE.items() if c not in "aeiouy"))
_WEAK, _LONG, _ANY_TRADE = 1, 2, 4


def _letters(joined: str) -> int:
    """Bits of the letters that are there once and twice, the same for any order of the words. An edit takes away one at most and adds one."""
    got = 0
    for c in joined:
        b = _ONCE.get(c, 0)
        got |= _TWICE.get(c, 0) if got & b else b
    return got


def _with_letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        forms = [_form(w) for w in b.column(b.schema.get_field_index("words")).to_pylist()]
        cols = [
            pa.array([len(x.joined) for x in forms], pa.int32()), pa.array([_letters(x.joined) for x in forms], pa.int64()),
            pa.array([_WEAK * x.weak + _LONG * (len(x.words) > 3) for x in forms], pa.int32()),
        ]
        yield pa.RecordBatch.from_arrays([*b.columns, *cols], [*b.schema.names, "size", "letters", "kind"])


_BESIDE = np.array([_most(k) for k in range(15)])


class _Met:
    """The columns of rows of shards that are compared in arrays, in order; a shard may go on in the next batch."""

    NAMES = ("shard", "salt", "role", "form", "size", "letters", "kind", "trade")

    def __init__(self) -> None:
        self.rest: list[np.ndarray] = []

    def add(self, batch: pa.RecordBatch | None) -> Iterator[pa.RecordBatch]:
        """Pairs (a, b) of the shards that are over; of all without a batch. b is the longer form."""
        cols = self.rest
        if batch is not None:
            new = [batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in self.NAMES]
            cols = [np.concatenate(x) for x in zip(cols, new)] if cols else new
        if not cols or not len(cols[0]):
            return
        begins = np.concatenate([[True], (cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1])])
        over = len(begins) if batch is None else int(np.flatnonzero(begins)[-1])
        self.rest = [x[over:] for x in cols]
        yield from self._pairs([x[:over] for x in cols[2:]], np.flatnonzero(begins[:over]))

    def _pairs(self, cols: list[np.ndarray], starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        role, form, size, letters, kind, trade = cols
        if not len(role):
            return
        begin = np.repeat(starts, np.diff(starts, append=len(role)))
        before = np.arange(len(role)) - begin  # the rows that a row is held against
        ends = np.cumsum(before)
        lo = 0
        while lo < len(role):
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + PAIRS_AT_ONCE, "right")))
            b = np.repeat(np.arange(lo, hi), before[lo:hi])
            a = begin[b] + np.arange(len(b)) - np.repeat(ends[lo:hi] - before[lo:hi] - (ends[lo - 1] if lo else 0), before[lo:hi])
            lo = hi
            fits = (role[a] != 1) & (role[b] != 0) & (form[a] != form[b]) & ((trade[a] == trade[b]) | (trade[a] == 0) | (trade[b] == 0))
            a, b = a[fits], b[fits]
            x, y, most = letters[a], letters[b], _BESIDE[np.minimum(size[b], 14)]
            near = (np.bitwise_count(x & ~y) <= most) & (np.bitwise_count(y & ~x) <= most) & (size[b] - size[a] <= most)
            few = (kind[a] | kind[b]) & _WEAK
            solid = (np.bitwise_count(x & ~y & _SOLID) <= few) & (np.bitwise_count(y & ~x & _SOLID) <= few)
            keep = near | solid | ((kind[a] & kind[b] & _LONG) > 0)
            if keep.any():
                yield pa.RecordBatch.from_arrays([pa.array(form[a[keep]]), pa.array(form[b[keep]])], ["a", "b"])


class _Walked:
    """Cells of the shards that are cut, by tries. Rows are sorted by (shard, salt, size, form). Each asks for the forms before it (role 1 and 2) and
    is then searched by those after it (role 0 and 2): two forms meet once, and the longer one asks, with the wider bound."""

    def __init__(self) -> None:
        self.here, self.index = None, _Index()

    def add(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        cols = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("shard", "salt", "role", "form", "kind", "words", "given", "trade")]
        out: tuple[list, list] = ([], [])
        for shard, salt, role, form, kind, words, given, trade in zip(*cols):
            if (shard, salt) != self.here:
                self.here, self.index = (shard, salt), _Index()
            name = OrgName(words, given, trade, "")
            if role and self.index.names:
                for k in self.index.search(name, bool(kind & _ANY_TRADE)):
                    other = self.index.names[k][0]
                    if other != form:
                        out[0].append(other)
                        out[1].append(form)
            if role != 1:
                self.index.names.append((form, name))
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], ["a", "b"])


def _join_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of forms to be compared; rows with words belong to shards that are cut."""
    met, walked = _Met(), _Walked()
    for batch in batches:
        words = batch.column(batch.schema.get_field_index("words"))
        if words.null_count < len(words):
            yield from walked.add(batch.filter(pc.is_valid(words)))
            batch = batch.filter(pc.is_null(words))
        yield from met.add(batch)
    yield from met.add(None)


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, score) of pairs that name the same organisation; b is the longer form, which asks."""
    for batch in batches:
        cols = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("a", "b", "words_a", "given_a", "trade_a", "words_b", "given_b", "trade_b")]
        out: tuple[list, list, list] = ([], [], [])
        for a, b, wa, ga, ta, wb, gb, tb in zip(*cols):
            score = same_org(OrgName(wa, ga, ta, ""), OrgName(wb, gb, tb, ""))
            if score and meets(_form(wb), _form(wa)):
                for o, x in zip(out, (min(a, b), max(a, b), score)):
                    o.append(x)
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int32())], ["a", "b", "score"])


def form_links(forms: DataFrame) -> DataFrame:
    """(a, b, score) between any two of forms(form, words, given, trade, shards)."""
    spark = forms.sparkSession
    n = shuffle_partitions(spark)
    parts = "form bigint, words string, given string, trade int"
    lettered = forms.select("form", "words", "given", "trade", "shards").mapInArrow(_with_letters, f"{parts}, shards array<string>, size int, letters bigint, kind int")
    # shards go by a hash: two that have the same only meet needlessly
    rows = lettered.withColumn("key", F.explode("shards")).drop("shards").withColumn("shard", F.xxhash64("key"))
    rows = rows.withColumn("kind", F.col("kind") + F.when(F.left("key", F.lit(1)).isin("=", "#", "*", "@"), F.lit(_ANY_TRADE)).otherwise(F.lit(0))).drop("key")
    sizes = forms.select(F.explode("shards").alias("key")).groupBy(F.xxhash64("key").alias("shard")).agg(F.count("*").alias("n"))
    big = cut(sizes.where(F.col("n") > min(INDEX_PART, QUERY_PART)))
    if big.limit(1).count():
        rows = rows.join(big, "shard", "left")
        # in a shard that is cut, a form is searched in the cells of its index part and asks in those of its query part
        rows = rows.withColumn("role", F.explode(F.when(F.col("n").isNull(), F.array(F.lit(2))).otherwise(F.array(F.lit(0), F.lit(1)))))
        pi = F.coalesce(F.ceil(F.col("n") / INDEX_PART), F.lit(1)).cast("int")
        pq = F.coalesce(F.ceil(F.col("n") / QUERY_PART), F.lit(1)).cast("int")
        mine = F.pmod(F.xxhash64("form"), F.when(F.col("role") == 0, pi).otherwise(pq)).cast("int")
        across = F.sequence(F.lit(0), F.when(F.col("role") == 0, pq).otherwise(pi) - 1)
        # index part i meets query part q in cell i * pq + q
        cell = F.transform(across, lambda x: F.when(F.col("role") == 0, mine * pq + x).otherwise(x * pq + mine))
        rows = rows.withColumn("salt", F.explode(cell)).withColumns({c: F.when(F.col("n").isNotNull(), F.col(c)) for c in ("words", "given")}).drop("n")
    else:
        rows = rows.withColumns({"role": F.lit(2), "salt": F.lit(0), "words": F.lit(None).cast("string"), "given": F.lit(None).cast("string")})
    placed = rows.select("shard", "salt", "size", "form", "role", "letters", "kind", "words", "given", "trade").repartition(n, "shard", "salt").sortWithinPartitions("shard", "salt", "size", "form")
    pairs = placed.mapInArrow(_join_shards, "a bigint, b bigint").distinct()
    for side in "ab":
        pairs = pairs.join(forms.select(F.col("form").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in ("words", "given", "trade")]), side)
    return pairs.mapInArrow(_compared, "a bigint, b bigint, score int")


def name_classes(left: DataFrame, right: DataFrame, lexicon: Lexicon = LEXICON) -> DataFrame:
    """(text, cls) for each distinct name of left(text) and right(text) with words in it.

    All names are compared with all, those of one table too. Nulls, blanks and placeholders, and names of nothing but legal forms and trades,
    are in no class.
    """
    texts = left.select("text").unionByName(right.select("text")).where(~missing("text")).distinct()
    parsed = stored(with_names(texts, "text", True, lexicon).where("words <> ''").withColumn("form", F.xxhash64("words", "given", "trade")))
    forms = parsed.groupBy("form").agg(F.first("words").alias("words"), F.first("given").alias("given"), F.first("trade").alias("trade"), F.first("shards").alias("shards"))
    links = cut(form_links(forms))
    classes = link_classes(forms.select(F.col("form").alias("node")), links)
    return parsed.select("text", "form").join(classes.select(F.col("node").alias("form"), "cls"), "form").select("text", "cls")


def variant_pairs(left: DataFrame, right: DataFrame, classes: DataFrame) -> DataFrame:
    """(left_id, right_id): records of left(id, text) and right(id, text) of one name class whose names are not the same string.

    Joined by way of the distinct names of a class, so exact copies are only expanded in the result itself.
    """
    a = left.where("id is not null").select("id", "text").distinct()
    b = right.where("id is not null").select("id", "text").distinct()
    ta = a.select("text").distinct().join(classes, "text").select(F.col("text").alias("text_a"), "cls")
    tb = b.select("text").distinct().join(classes, "text").select(F.col("text").alias("text_b"), "cls")
    ways = ta.join(tb, "cls").where("text_a <> text_b").select("text_a", "text_b")
    return (
        ways.join(a.select(F.col("id").alias("left_id"), F.col("text").alias("text_a")), "text_a")
        .join(b.select(F.col("id").alias("right_id"), F.col("text").alias("text_b")), "text_b")
        .select("left_id", "right_id")
        .distinct()
    )
