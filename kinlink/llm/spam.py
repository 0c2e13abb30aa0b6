"""Keyword-stuffed texts and lists of links or product tags (problem 10).

Texts are stitched from phrases: the shingles of two words inside each item (spam phrases are two or three words long). All
phrases of all texts are exploded, and the distinct hosts (shops) on which each stands in lists are counted, as well as the texts that
have it in lists and in sentences. A stock phrase stands in lists of several hosts and more often in lists than in sentences: honest
reviews share most of their phrases with others too, but in sentences. A segment is stitched if stock phrases cover most of its words. A text
is flagged if more than half of its characters are in stitched segments and more than half in segments that are no plain
sentences: replicated phrases joined with list density, neither of them alone.

So that phrases of different pages can be the same, links, tags, codes and the words a page repeats all over are written as one mark each.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinlink.session import stored

MIN_CHARS = 60  # a very short remark is no case
MIN_HOSTS_TEXTS = 2  # a phrase of a single text is replicated nowhere
SENTENCE, OPEN, LIST = 0, 1, 2
LINK, TAG, CODE, OWN = "\x02", "\x03", "\x04", "\x05"

_MAYBE_LINK = re.compile(r"://|www\.|[a-z0-9]\.[a-z]{2}|[ (\[]dot[ )\]]")
_LINK = re.compile(
    r"(?:h(?:tt|xx)ps?://|www\.)[^\s\"'<>|)\]]+"
    r"|(?<![\w.-])[a-z0-9-]{2,63}(?:\.[a-z0-9-]{1,63}){0,8}\.(?:com|net|org|example|test|invalid|info|shop|biz|ru|io|co)\b(?:/[^\s\"'<>|)\]]*)?"
    r"|(?<![\w-])[\w-]{2,63} (?:dot|\(dot\)|\[dot\]) [\w-]{2,63}(?:\.[a-z]+)?(?:/[^\s\"'<>|)\]]*)?"
)
_TAG = re.compile(r"(?<!\S)[#@＃＠][^\s#@＃＠,;|]+")
_MAYBE_CODE = re.compile(r"\d|[>:]\w")
_CODE = re.compile(r"(?<!\S)(?:[a-z]{2,5}-\d{3,}|[a-z]\d{2,4}|\d+(?:cm|mm|kg|ml|w|l|g|m|in))(?=[\s,;|/]|$)|(?<=[^\W\d_])[>:](?=[^\W\d_])")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_CJK_PAIR = re.compile("([぀-ヿ㐀-鿿가-힯]{1,2})")
_END = re.compile(r"(?<=[.!?।])[\"')\]]*\s+|(?<=[。！？])|\n+")
_ITEM = re.compile(r"[,;|•*、/~»«★☆<>=]+|!{2,}|\s[-–—+]\s")
_STRIP = ".,;:!?\"'()[]{}<>*|+-–—=~•/\\।。、！？「」…#@"
_ENDS = tuple(".!?।。！？…")


class Segment(NamedTuple):
    chars: int  # without blanks
    kind: int
    phrases: list[str]


def _marked(text: str) -> str:
    """Lower case, glued words parted, links, tags and codes as runs of their mark (as long as they were), scripts without blanks in pairs."""
    if _CAMEL.search(text):
        text = _CAMEL.sub(" ", text)
    s = text.lower().replace("_", " ")
    if _MAYBE_LINK.search(s):
        s = _LINK.sub(lambda m: f" {LINK * len(m[0])} ", s)
    if "#" in s or "@" in s or "＃" in s or "＠" in s:
        s = _TAG.sub(lambda m: TAG * len(m[0]), s)
    if _MAYBE_CODE.search(s):
        s = _CODE.sub(lambda m: f" {CODE * len(m[0])} ", s)
    return s if s.isascii() else _CJK_PAIR.sub(r"\1 ", s)


def _echo(items: list[list[str]]) -> dict[tuple[str, str], int]:
    """Pairs of words that stand twice or more in a segment, with their number, if they cover 35 % of its words."""
    words = items[0] if len(items) == 1 else [w for x in items for w in x]
    if len(words) < 6 or len(set(words)) > len(words) - 2:
        return {}
    again = {p: c for p, c in Counter(zip(words, words[1:])).items() if c > 1}
    inside = {w for p in again for w in p}
    return again if min(2 * sum(again.values()), sum(w in inside for w in words)) >= 0.35 * len(words) else {}


def segments(text: str) -> list[Segment]:
    """Lines and sentences of a text with their phrases and their kind by list density: LIST, SENTENCE, or OPEN (no end of a sentence).
    Linear in the length; a text of nothing but blanks and signs has none."""
    parts: list[tuple[list[list[str]], bool]] = []
    count: Counter = Counter()
    for seg in _END.split(_marked(text)):
        items = []
        for item in _ITEM.split(seg):
            words = [y for y in [x.strip(_STRIP) for x in item.split()] if y]
            if words:
                items.append(words)
                count.update(words)
        if items:
            parts.append((items, seg.rstrip(" \"')]\t").endswith(_ENDS)))
    total = count.total()
    # the words a page repeats all over; marks are among them
    own = {w for w, c in count.items() if w[0] < OWN or (c >= 4 and c > (0.05 if len(w) > 2 else 0.1) * total)}
    out: list[Segment] = []
    run = 0
    echoes = [_echo(items) for items, _ in parts]
    often = sum(map(bool, echoes)) >= max(3, len(parts) / 2)
    turns: Counter = Counter()
    for e in echoes:
        turns.update(e)
    for (items, ended), echo in zip(parts, echoes):
        # a phrase comes again in the segment: stuffing if the page repeats it on and on, open if the page goes on like that, else a turn of speech
        stuffed = bool(echo) and max(turns[p] for p in echo) >= 4
        own_here = own.union(*echo) if echo and (stuffed or often) else own
        echo = own_here is not own
        n_words = n = marked = longest = 0
        phrases: list[str] = []
        for words in items:
            m = len(words)
            n_words += m
            longest = max(longest, m)
            n += sum(map(len, words))
            if not own_here.isdisjoint(words):
                marked += sum(len(w) for w in words if w in own)
                words = [w if w not in own_here else w[0] if w[0] < OWN else OWN for w in words]
            phrases += [f"{a} {b}" for a, b in zip(words, words[1:])] if m > 1 else words
        if 2 * marked > n or (len(items) >= 5 and longest <= 5) or stuffed:
            kind = LIST
        else:
            kind = SENTENCE if ended and not echo else OPEN
        out.append(Segment(n, kind, phrases))
        # five or more short open lines in a row are a list
        run = run + 1 if kind == LIST or (kind == OPEN and n_words <= 6) else 0
        if run == 5:
            out[-5:] = [s._replace(kind=LIST) for s in out[-5:]]
        elif run > 5:
            out[-1] = out[-1]._replace(kind=LIST)
    return out


_SEGMENTS = pa.list_(pa.struct([("n", pa.int32()), ("phrases", pa.list_(pa.string()))]))
_KINDS = {"text_id": pa.string(), "lo": pa.int64(), "hi": pa.int64(), "chars": pa.int64(), "list_chars": pa.int64(), "listed": pa.list_(pa.string()), "said": pa.list_(pa.string()), "segs": _SEGMENTS}
_SCHEMA = "text_id string, lo bigint, hi bigint, chars bigint, list_chars bigint, listed array<string>, said array<string>, segs array<struct<n: int, phrases: array<string>>>"


def _evidence(share: float):
    """Task: list density and phrases of each text; the segments only of texts that list density would let be flagged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, lows, highs, texts = (b.column(b.schema.get_field_index(c)).to_pylist() for c in ("text_id", "lo", "hi", "text"))
            for at in range(0, len(ids), 500):  # small results: the arrays of long texts are long
                rows = []
                for i, lo, hi, t in zip(ids[at : at + 500], lows[at : at + 500], highs[at : at + 500], texts[at : at + 500]):
                    listed: set[str] = set()
                    said: set[str] = set()
                    found = segments(t)
                    for s in found:
                        if s.kind != OPEN:
                            (listed if s.kind == LIST else said).update(s.phrases)
                    chars, dense = sum(s.chars for s in found), sum(s.chars for s in found if s.kind != SENTENCE)
                    segs = [(s.chars, s.phrases) for s in found] if dense > share * chars else []
                    rows.append((i, lo, hi, chars, dense, list(listed), list(said), [{"n": n, "phrases": p} for n, p in segs]))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), _KINDS.values())], list(_KINDS))

    return run


def _tagged(c: str, in_list: int) -> Column:
    return F.transform(c, lambda p: F.struct(p.alias("phrase"), F.lit(in_list).alias("in_list")))


def spam_scores(docs: DataFrame, id_col: str, text_col: str, host_col: str, share: float = 0.5) -> DataFrame:
    """(doc_id, list_share, stock_share, n_chars, is_spam), one row for each distinct id with a text; null and blank texts are left out.

    list_share: characters in segments that are no plain sentences; stock_share: characters in segments stitched from stock phrases,
    null where list_share is too small for a flag. Equal texts are judged once. Phrases are counted over all texts; hosts are distinct values
    of host_col, null being one of them; with a single host nothing is replicated, so nothing is flagged. Repeated rows and other columns change nothing.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(F.coalesce(F.col(host_col).cast("string"), F.lit(""))).alias("host"))
    rows = rows.where("doc_id is not null and text is not null and trim(text) <> ''").withColumn("text_id", F.md5("text"))
    texts = rows.groupBy("text_id").agg(F.first("text").alias("text"), F.min("host").alias("lo"), F.max("host").alias("hi"))
    seen = stored(texts.mapInArrow(_evidence(share), _SCHEMA))
    # a phrase has several hosts if the least and the greatest of them differ: sums and extremes only, all combined before the shuffle
    told = seen.select("lo", "hi", F.explode(F.concat(_tagged("listed", 1), _tagged("said", 0))).alias("p")).select("lo", "hi", "p.phrase", "p.in_list")
    in_list = F.col("in_list") == 1
    stock = (
        told.groupBy("phrase")
        .agg(F.min(F.when(in_list, F.col("lo"))).alias("lo"), F.max(F.when(in_list, F.col("hi"))).alias("hi"), F.sum("in_list").alias("n_list"), F.count("*").alias("n"))
        .where((F.col("lo") != F.col("hi")) & (F.col("n_list") >= MIN_HOSTS_TEXTS) & (2 * F.col("n_list") > F.col("n")))
        .select("phrase", F.lit(1).alias("stock"))
    )
    asked = seen.where(F.size("segs") > 0).select("text_id", F.posexplode("segs").alias("seg", "s")).select("text_id", "seg", "s.n", F.explode("s.phrases").alias("phrase"))
    asked = asked.groupBy("text_id", "seg", "n", "phrase").agg(F.count("*").alias("c"))
    stitched = (
        asked.join(stock, "phrase", "left")
        .groupBy("text_id", "seg", "n")
        .agg(F.sum("c").alias("c"), F.sum(F.col("c") * F.coalesce("stock", F.lit(0))).alias("hit"))
        # a pair covers two words: more than a third of the pairs is most of the words
        .groupBy("text_id")
        .agg(F.sum(F.when(3 * F.col("hit") > F.col("c"), F.col("n")).otherwise(0)).alias("stock_chars"))
    )
    least = F.greatest("chars", F.lit(1))
    scored = seen.select("text_id", "chars", "list_chars").join(stitched, "text_id", "left")
    scored = scored.select("text_id", (F.col("list_chars") / least).alias("list_share"), (F.col("stock_chars") / least).alias("stock_share"), F.col("chars").alias("n_chars"))
    flag = F.coalesce((F.col("list_share") > share) & (F.col("stock_share") > share) & (F.col("n_chars") >= MIN_CHARS), F.lit(False))
    return rows.select("doc_id", "text_id").distinct().join(scored.withColumn("is_spam", flag), "text_id").drop("text_id")
