"""Per-key results where a few keys hold most rows.

The rows are range-partitioned on (key, secondary order, tie-breaker) with sampled quantiles, so a heavy key is spread
over as many tasks as its share asks for, and even one (key, member) pair that holds a third of the rows is split by the
tie-breaker. Each task reduces its sorted range to one partial state for each key it saw (rows, distinct members, first
and last member); the partial states, at most keys + tasks many, are then stitched: a member that crosses a
boundary was counted on both sides and is taken off once.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinlink.session import cut, shuffle_partitions

_STATE = "part int, k string, n_rows long, n_distinct long, first_member string, last_member string, nulls long"


def _partial_states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One state for each key of a range sorted by (k, m). Streams: only the open key's state is held."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    out: list[tuple] = []
    open_state: list | None = None  # k, rows, distinct, first, last, nulls

    def flush(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows))
        types = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        names = ["part", "k", "n_rows", "n_distinct", "first_member", "last_member", "nulls"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        k, m = batch.column(0), batch.column(1)
        if n > 1:
            new_k = pc.not_equal(k.slice(1), k.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            filled_a, filled_b = pc.fill_null(m.slice(1), "\x00"), pc.fill_null(m.slice(0, n - 1), "\x00")
            new_m = pc.not_equal(filled_a, filled_b).to_numpy(zero_copy_only=False)
            starts = [0, *(int(i) + 1 for i in new_k.nonzero()[0])]
        else:
            new_m, starts = None, [0]
        for a, b in zip(starts, [*starts[1:], n]):
            key = k[a].as_py()
            valid = m.slice(a, b - a)
            nulls = valid.null_count  # nulls sort first
            first = m[a + nulls].as_py() if nulls < b - a else None
            last = m[b - 1].as_py() if nulls < b - a else None
            distinct = 0
            if first is not None:
                distinct = 1 + (int(new_m[a + nulls : b - 1].sum()) if b - a - nulls > 1 else 0)
            if open_state and open_state[0] == key:
                again = open_state[4] is not None and open_state[4] == first
                open_state[1] += b - a
                open_state[2] += distinct - again
                open_state[3] = open_state[3] if open_state[3] is not None else first
                open_state[4] = last if last is not None else open_state[4]
                open_state[5] += nulls
            else:
                if open_state:
                    out.append((part, open_state[0], open_state[1], open_state[2], open_state[3], open_state[4], open_state[5]))
                open_state = [key, b - a, distinct, first, last, nulls]
        if len(out) >= 4096:
            yield flush(out)
            out = []
    if open_state:
        out.append((part, open_state[0], open_state[1], open_state[2], open_state[3], open_state[4], open_state[5]))
    if out:
        yield flush(out)


def count_by_heavy_key(df: DataFrame, key: Column, member: Column, tie: Column | None = None, partitions: int | None = None) -> DataFrame:
    """(k, n_rows, n_distinct): rows and distinct non-null members of each key, no task bound to a whole key.

    A null key counts as the empty key. A null member counts as a row, not as a member. Repeated rows count as rows.
    An empty table gives no row. Other columns of df are never read. `tie` splits a single hot (key, member) pair; without
    it the Spark task layout of the input is used (input partition and offset).
    """
    n = partitions or shuffle_partitions(df.sparkSession)
    rows = df.select(
        F.coalesce(key.cast("string"), F.lit("")).alias("k"),
        member.cast("string").alias("m"),
        (F.monotonically_increasing_id() if tie is None else tie).alias("t"),
    )
    ranged = rows.repartitionByRange(n, "k", "m", "t").sortWithinPartitions("k", "m", "t")
    # A task that is repeated must find the same ranges, and both windows below read the states.
    states = cut(ranged.select("k", "m").mapInArrow(_partial_states, _STATE))
    by_key = Window.partitionBy("k").orderBy("part")
    before = F.last("last_member", ignorenulls=True).over(by_key.rowsBetween(Window.unboundedPreceding, -1))
    seam = F.coalesce(before == F.col("first_member"), F.lit(False)).cast("long")
    return (
        states.withColumn("seam", seam)
        .groupBy("k")
        .agg(F.sum("n_rows").alias("n_rows"), (F.sum("n_distinct") - F.sum("seam")).alias("n_distinct"))
    )
