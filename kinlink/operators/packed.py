"""Several values packed in one field: a parsing expression grammar with ordered alternatives.

    field     <- blank* wrapper? list blank*
    wrapper   <- '[' list ']' / '{' list '}' / '(' list ')'
    list      <- (separator / item)*
    item      <- quoted / bare
    quoted    <- q (list of two or more values, or of one quoted value) q / q value q          q: ' or ", doubled quotes stand for one
    bare      <- any run up to the next separator, bracket or quote that opens an item
    separator <- , ; | / & tab, line break, their wide forms, runs of blanks, the word "and"

Alternatives are tried in this order. A quoted item whose content is itself a list of values (each of them matching
`value_pattern`) is a quoted list; otherwise the quotes hold one value, delimiters and all. A quote that is never
closed, or whose content fits neither, makes the parser go back to the quote, flag an error and read on
behind it as bare text. Each character is looked at a bounded number of times: the places of the closing quotes are found
once for each field.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

OK, UNCLOSED_QUOTE, UNBALANCED_BRACKET, NOT_A_VALUE = 0, 1, 2, 3
_PAIRS = {"[": "]", "{": "}", "(": ")"}
_QUOTES = "\"'"
_SEP = re.compile(r"(?:[\s,;|/&，；、 　]|\band\b)+", re.IGNORECASE)
_BARE = re.compile(r"[^\s,;|/&，；、 　\"'\[\]{}()]+")


class FieldParser:
    """value_pattern: what a single value looks like in full; without it every bare run is a value."""

    def __init__(self, value_pattern: str | None = None, suffix_pattern: str | None = None):
        self.value = re.compile(value_pattern) if value_pattern else None
        # a value that holds a delimiter stands in quotes only
        self.quoted_value = re.compile(f"(?:{value_pattern})(?:{suffix_pattern})?") if value_pattern and suffix_pattern else self.value

    def _fits(self, text: str, quoted: bool) -> bool:
        p = self.quoted_value if quoted else self.value
        return bool(text) and (p is None or p.fullmatch(text) is not None)

    def parse(self, text: str | None) -> list[tuple[str, int]]:
        """(value, error flag) in order; null, empty or blank text has none. Runs that are no value carry NOT_A_VALUE."""
        return [] if not text else self._list(text, 0)

    def _closing(self, s: str, i: int, known: dict) -> int:
        """Place of the quote that closes the one at i (a doubled quote inside doesn't), or -1."""
        q = s[i]
        if known.get(q, len(s)) <= i:  # there is no single quote of this kind behind that place
            return -1
        j = i + 1
        while True:
            j = s.find(q, j)
            if j < 0:
                known[q] = i
                return -1
            if s.startswith(q, j + 1):
                j += 2
                continue
            return j

    def _list(self, s: str, depth: int) -> list[tuple[str, int]]:
        out: list[tuple[str, int]] = []
        known: dict[str, int] = {}
        brackets: list[str] = []
        i, n, unclosed = 0, len(s), False
        while i < n:
            m = _SEP.match(s, i)
            if m:
                i = m.end()
                continue
            c = s[i]
            if c in _PAIRS:
                brackets.append(_PAIRS[c])
                i += 1
                continue
            if c in "]})":
                if brackets and brackets[-1] == c:
                    brackets.pop()
                elif out:
                    out[-1] = (out[-1][0], out[-1][1] or UNBALANCED_BRACKET)
                i += 1
                continue
            if c in _QUOTES:
                got = self._quoted(s, i, depth, known)
                if got is None:
                    unclosed = True  # go back: the quote is no quote
                    i += 1
                    continue
                items, i = got
                out += items
                continue
            m = _BARE.match(s, i)
            end = m.end() if m else i + 1
            word = s[i:end]
            out.append((word, UNCLOSED_QUOTE if unclosed and self._fits(word, False) else OK if self._fits(word, False) else NOT_A_VALUE))
            unclosed = False
            i = end
        if brackets and out:
            out[-1] = (out[-1][0], out[-1][1] or UNBALANCED_BRACKET)
        return out

    def _quoted(self, s: str, i: int, depth: int, known: dict) -> tuple[list[tuple[str, int]], int] | None:
        q = s[i]
        if s.startswith(q * 2, i) and not s.startswith(q * 3, i):
            return [], i + 2  # an empty value
        j = self._closing(s, i, known)
        if j < 0:
            return None
        body = s[i + 1 : j].replace(q * 2, q)
        # first alternative: a quoted list. One level is enough for what writers produce; it also bounds the work.
        if depth == 0 and (self.value is not None or "," in body):
            inner = self._list(body, 1)
            good = [x for x in inner if x[1] == OK]
            if self.value is not None and good and len(good) == len(inner) and (len(good) >= 2 or body.strip()[0] in _QUOTES):
                return inner, j + 1
        text = body.strip()
        if self._fits(text, True):
            return [(text, OK)], j + 1
        if not text:
            return [], j + 1
        if self.value is None:
            return [(text, OK)], j + 1
        return None


def unpack(df: DataFrame, column: str, keep: list[str], value_pattern: str | None = None, suffix_pattern: str | None = None, only_values: bool = True, value_name: str = "value") -> DataFrame:
    """One row for each value of df[column]: the columns `keep`, item_no (from 1), the value and error (0: none).

    only_values: runs that are no value by value_pattern give no row and don't count in item_no. Null and empty fields
    and empty tables give no row; repeated values and repeated rows stay. A narrow, linear pass: no shuffle, Arrow batches,
    output in slices, so a field of any length is no single large batch of rows.
    """
    fields = [df.schema[k] for k in keep]
    clash = {"item_no", value_name, "error"} & set(keep)
    if clash:
        raise ValueError(f"rename {sorted(clash)} first")
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), "item_no int", f"`{value_name}` string", "error int"])
    names = [*keep, "item_no", value_name, "error"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = FieldParser(value_pattern, suffix_pattern)
        for batch in batches:
            source: list[int] = []
            numbers: list[int] = []
            values: list[str] = []
            errors: list[int] = []

            def made():
                at = pa.array(source, pa.int64())
                cols = [batch.column(i + 1).take(at) for i in range(len(keep))]
                return pa.RecordBatch.from_arrays([*cols, pa.array(numbers, pa.int32()), pa.array(values, pa.string()), pa.array(errors, pa.int32())], names)

            for row, text in enumerate(batch.column(0).to_pylist()):
                k = 0
                for value, flag in parser.parse(text):
                    if only_values and flag == NOT_A_VALUE:
                        continue
                    k += 1
                    source.append(row)
                    numbers.append(k)
                    values.append(value)
                    errors.append(flag)
                    if len(source) >= 50_000:
                        yield made()
                        source, numbers, values, errors = [], [], [], []
            if source:
                yield made()

    return df.select(df[column].cast("string").alias("__packed"), *[df[k] for k in keep]).mapInArrow(run, schema)
