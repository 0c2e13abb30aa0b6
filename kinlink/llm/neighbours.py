"""Multi-pass sorted neighbourhoods.

All passes are sorted in one job: the rows of every pass carry the pass in front of their sort key, are range-partitioned on
(pass, key, id) with sampled quantiles and sorted. A window then slides over each partition, so no key, however heavy, is bound to one task. With
its pairs a partition hands on its first and last window - 1 rows; over these, at most 2 * partitions * window rows whatever the
input, the window slides once more for the pairs whose rows lie in different partitions, so no window is cut at a boundary. Pairs in a
window are first held against bit masks and equality gates in numpy, which lose nothing the comparison could accept; only the rest is compared in Python.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinlink.session import shuffle_partitions, stored


@dataclass(frozen=True)
class Gate:
    """Cheap conditions on integer columns. equal: both sides must agree. mask: (column, most differing bits); a zero on
    either side passes. sides: column whose values must differ (links between two tables), or None."""

    equal: tuple[str, ...] = ()
    masks: tuple[tuple[str, int], ...] = ()
    sides: str | None = None


def letter_mask(word: str) -> int:
    """Bit set of the letters of a word. One edit changes at most two bits."""
    m = 0
    for ch in word:
        m |= 1 << ((ord(ch) - 97) % 60)
    return m


def window_pairs(
    rows: DataFrame,
    keys: list[Column],
    id_col: str,
    fields: list[str],
    gate: Gate,
    compare: Callable[[tuple, tuple], int],
    window: int,
    partitions: int | None = None,
) -> DataFrame:
    """(a long, b long, score int): pairs of ids, a < b, that stand within `window` rows of each other in at least one pass
    and whose comparison is not 0; the best score of a pair found in several passes.

    rows[id_col]: bigint, one row for each id. keys: one sort key for each pass; a row whose key is null or empty takes no
    part in that pass. compare gets two tuples of `fields`. Ties in a key are ordered by id; equal records should be one row
    (the caller groups exact copies). Empty input gives no rows.
    """
    spark = rows.sparkSession
    n = partitions or shuffle_partitions(spark)
    used = [*dict.fromkeys([*fields, *gate.equal, *(m for m, _ in gate.masks), *([gate.sides] if gate.sides else [])])]
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    passes = F.filter(
        F.array(*[F.struct(F.lit(i).alias("pass"), k.alias("key")) for i, k in enumerate(keys)]),
        lambda x: x["key"].isNotNull() & (x["key"] != ""),
    )
    flat = rows.select(F.col(id_col).alias("__id"), *used, F.explode(passes).alias("p")).select("p.pass", "p.key", "__id", *used)
    in_order = flat.repartitionByRange(n, "pass", "key", "__id").sortWithinPartitions("pass", "key", "__id").drop("key")
    row_kinds = {"pass": "int", "__id": "bigint", **{c: kinds[c] for c in used}}
    row_schema = ", ".join(f"`{c}` {k}" for c, k in row_kinds.items())
    pair_names = ["a", "b", "score"]
    edge_names = ["part", "at", *row_kinds]
    schema = f"a bigint, b bigint, score int, part int, at int, {row_schema}"

    def compared(df: pd.DataFrame, ready: int, part: np.ndarray | None = None) -> tuple[list, list, list]:
        """Pairs of the first `ready` rows with the rows behind them; with part, only pairs of different ones."""
        m = len(df)
        ids, which = df["__id"].to_numpy(), df["pass"].to_numpy()
        equal = [df[c].to_numpy() for c in gate.equal]
        masks = [(df[c].to_numpy(), bits) for c, bits in gate.masks]
        differ = ([df[gate.sides].to_numpy()] if gate.sides else []) + ([part] if part is not None else [])
        left: list[np.ndarray] = []
        right: list[np.ndarray] = []
        for step in range(1, window):
            end = min(ready, m - step)
            if end <= 0:
                break
            ok = (which[:end] == which[step : end + step]) & (ids[:end] != ids[step : end + step])
            for e in equal:
                ok &= e[:end] == e[step : end + step]
            for e in differ:
                ok &= e[:end] != e[step : end + step]
            for x, bits in masks:
                p, q = x[:end], x[step : end + step]
                ok &= (np.bitwise_count(p ^ q) <= bits) | (p == 0) | (q == 0)
            at = np.flatnonzero(ok)
            left.append(at)
            right.append(at + step)
        a_out: list[int] = []
        b_out: list[int] = []
        s_out: list[int] = []
        if left:
            i, j = np.concatenate(left), np.concatenate(right)
            if len(i):
                rec = list(zip(*[df[c].tolist() for c in fields]))
                for x, y in zip(i.tolist(), j.tolist()):
                    score = compare(rec[x], rec[y])
                    if score:
                        u, v = int(ids[x]), int(ids[y])
                        a_out.append(min(u, v))
                        b_out.append(max(u, v))
                        s_out.append(score)
        return a_out, b_out, s_out

    def pair_arrays(found: tuple[list, list, list]) -> list[pa.Array]:
        return [pa.array(c, k) for c, k in zip(found, (pa.int64(), pa.int64(), pa.int32()))]

    def slide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        kind = None
        held: pd.DataFrame | None = None
        head: pd.DataFrame | None = None
        seen = 0
        for b in batches:
            if not b.num_rows:
                continue
            kind = b.schema
            now = b.to_pandas()
            seen += len(now)
            if head is None or len(head) < window - 1:
                head = now.head(window - 1) if head is None else pd.concat([head, now]).head(window - 1)
            held = now if held is None else pd.concat([held, now], ignore_index=True)
            ready = len(held) - (window - 1)
            if ready > 0:
                found = compared(held, ready)
                if found[0]:
                    nulls = [pa.nulls(len(found[0]), t) for t in (pa.int32(), pa.int32(), *kind.types)]
                    yield pa.RecordBatch.from_arrays([*pair_arrays(found), *nulls], [*pair_names, *edge_names])
                held = held.iloc[ready:].reset_index(drop=True)
        if held is None:
            return
        found = compared(held, len(held))
        tail = held.tail(min(len(held), seen - len(head)))  # rows that are not in the head
        edge = pd.concat([head, tail], ignore_index=True)
        m, k = len(edge), len(found[0])
        rows_out = pa.RecordBatch.from_pandas(edge, kind, preserve_index=False)
        here = [pa.array([TaskContext.get().partitionId()] * m, pa.int32()), pa.array(range(m), pa.int32())]
        yield pa.RecordBatch.from_arrays([*(pa.nulls(m, t) for t in (pa.int64(), pa.int64(), pa.int32())), *here, *rows_out.columns], [*pair_names, *edge_names])
        if k:
            yield pa.RecordBatch.from_arrays([*pair_arrays(found), *(pa.nulls(k, t) for t in (pa.int32(), pa.int32(), *kind.types))], [*pair_names, *edge_names])

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pd.DataFrame | None = None
        for b in batches:
            held = b.to_pandas() if held is None else pd.concat([held, b.to_pandas()], ignore_index=True)
            ready = len(held) - (window - 1)
            if ready > 0:
                yield pa.RecordBatch.from_arrays(pair_arrays(compared(held, ready, held["part"].to_numpy())), pair_names)
                held = held.iloc[ready:].reset_index(drop=True)
        if held is not None and len(held):
            yield pa.RecordBatch.from_arrays(pair_arrays(compared(held, len(held), held["part"].to_numpy())), pair_names)

    got = stored(in_order.mapInArrow(slide, schema))
    edges = got.where("part is not null").select(*edge_names).repartition(1).sortWithinPartitions("part", "at")
    found = got.where("a is not null").select(*pair_names).unionByName(edges.mapInArrow(across, "a bigint, b bigint, score int"))
    return found.groupBy("a", "b").agg(F.max("score").alias("score"))
