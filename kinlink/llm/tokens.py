"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the published pattern by which this vocabulary cuts a text into words.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(4)
def _encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("by_path", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_sizes(docs: DataFrame, id_col: str, text_col: str, keep: list[str] | None = None, tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc_id, *keep, n_tokens) for each distinct id with a text of at least one token; one row for each id.

    Whole texts are counted, equal ones of a batch once. Null and empty texts and null ids are left out. Where an id comes
    with several texts, the longest counts.
    """
    keep = keep or []
    rows = docs.select(F.col(id_col).alias("doc_id"), *keep, F.col(text_col).alias("text")).where("doc_id is not null and text is not null and text <> ''")
    schema = ", ".join(["doc_id " + rows.schema["doc_id"].dataType.simpleString(), *(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keep), "n_tokens bigint"])
    names = ["doc_id", *keep, "n_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoding(tokenizer)
        for b in batches:
            memo: dict[str, int] = {}
            sizes = []
            for t in b.column(b.num_columns - 1).to_pylist():
                n = memo.get(t)
                if n is None:
                    n = memo[t] = len(enc.encode_ordinary(t))
                sizes.append(n)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(sizes, pa.int64())], names)

    sized = rows.mapInArrow(run, schema)
    return sized.groupBy("doc_id").agg(*[F.max(k).alias(k) for k in keep], F.max("n_tokens").alias("n_tokens"))
