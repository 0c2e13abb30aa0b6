"""Filling containers of a fixed capacity (problem 8).

1. The global histogram of sizes, at most `capacity` rows, goes to the driver.
2. Dynamic programming over the histogram chooses the bucket boundaries of least padding.
3. Token-budget batches are planned on the histogram, bucket after bucket from the longest: a container takes items of its bucket as
   long as they fit; room that is left is topped up with the longest fitting items of shorter buckets (without that every item
   above half the capacity would waste the rest of its container). Equal plans are counted, not repeated.
4. The items, sorted by size on range partitions, take their places in the plan by their rank among items of the same size: no
   further shuffle, no group in one task, whatever the sizes.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinlink.session import cut, shuffle_partitions

BUCKETS = 12


def bucket_bounds(histogram: dict[int, int], k: int = BUCKETS) -> list[int]:
    """Upper bounds of at most k buckets of sizes with the least total padding when each item is padded to its bucket's bound."""
    sizes = np.array(sorted(histogram), dtype=np.int64)
    n = len(sizes)
    if n <= k:
        return sizes.tolist()
    counts = np.array([histogram[s] for s in sizes.tolist()], dtype=np.float64)
    cn = np.concatenate([[0], np.cumsum(counts)])
    cs = np.concatenate([[0], np.cumsum(counts * sizes)])
    best = np.where(np.arange(n + 1) == 0, 0.0, np.inf)
    choice = np.zeros((k + 1, n + 1), dtype=np.int64)
    for layer in range(1, k + 1):
        new = np.full(n + 1, np.inf)
        for j in range(1, n + 1):
            cost = best[:j] + sizes[j - 1] * (cn[j] - cn[:j]) - (cs[j] - cs[:j])
            i = int(np.argmin(cost))
            new[j], choice[layer, j] = cost[i], i
        best = new
    bounds, j = [], n
    for layer in range(k, 0, -1):
        if j == 0:
            break
        bounds.append(int(sizes[j - 1]))
        j = int(choice[layer, j])
    return sorted(bounds)


def plan(histogram: dict[int, int], capacity: int, bounds: list[int], top_up: bool = True) -> list[tuple[int, int, dict[int, int]]]:
    """(bucket, containers, {size: items in each}) for all items of the histogram; sizes must not exceed the capacity."""
    left = {s: c for s, c in histogram.items() if c > 0}
    if left and max(left) > capacity:
        raise ValueError("an item larger than the capacity must be split first")
    active = sorted(left)
    out: list[tuple[int, int, dict[int, int]]] = []
    while active:
        longest = active[-1]
        b = bisect_left(bounds, longest)
        floor = 0 if top_up or b == 0 else bounds[b - 1]
        room, take = capacity, {}
        at = len(active)
        while room > 0:
            at = bisect_right(active, room, 0, at) - 1
            if at < 0 or active[at] <= floor:
                break
            s = active[at]
            n = min(room // s, left[s])
            take[s] = n
            room -= n * s
        times = min(left[s] // n for s, n in take.items())
        out.append((bounds[b] if b < len(bounds) else longest, times, take))
        for s, n in take.items():
            left[s] -= n * times
            if not left[s]:
                active.pop(bisect_left(active, s))
    return out


def pack(sizes: DataFrame, containers: dict[str, int], buckets: int = BUCKETS, top_up: bool = True) -> DataFrame:
    """(container_kind, container_no, bucket, doc_id, piece, n_tokens, unused): where each item of sizes(doc_id, n_tokens) goes.

    An item larger than the capacity is split into full pieces and a rest, numbered from 1; others are piece 1. unused is the room left in that
    container. Items without tokens take no room and are left out; a capacity below 1 is an error; ties are ordered by doc_id, which must be unique.
    """
    spark = sizes.sparkSession
    if any(c < 1 for c in containers.values()):
        raise ValueError("a capacity must be at least 1")
    kinds = list(containers)
    rows = sizes.select("doc_id", "n_tokens").where("doc_id is not null and n_tokens > 0")
    shape = F.array(*[F.struct(F.lit(i).alias("k"), F.lit(int(containers[x])).cast("bigint").alias("capacity")) for i, x in enumerate(kinds)])
    each = rows.withColumn("c", F.explode(shape)).select("doc_id", "n_tokens", "c.k", "c.capacity")
    parts = F.ceil(F.col("n_tokens") / F.col("capacity"))
    pieces = each.withColumn("piece", F.explode(F.sequence(F.lit(1).cast("bigint"), parts))).select(
        "k", "doc_id", F.col("piece").cast("int").alias("piece"), F.least(F.col("capacity"), F.col("n_tokens") - (F.col("piece") - 1) * F.col("capacity")).alias("size")
    )
    histogram = pieces.groupBy("k", "size").count().collect()  # at most the sum of the capacities
    n = shuffle_partitions(spark)
    placed = cut(pieces.repartitionByRange(n, "k", "size", "doc_id", "piece").sortWithinPartitions("k", "size", "doc_id", "piece"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = sum(b.num_rows for b in batches)
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([total], pa.int64())], ["part", "n"])

    in_part = dict(placed.select("piece").mapInArrow(counted, "part int, n bigint").collect())  # one number for each partition
    starts, at = {}, 0
    for p in sorted(in_part):
        starts[p] = at
        at += in_part[p]
    first_of: dict[tuple[int, int], int] = {}
    seats: dict[tuple[int, int], tuple] = {}
    at = 0
    for k, kind in enumerate(kinds):
        counts = {int(r["size"]): int(r["count"]) for r in histogram if r["k"] == k}
        for s in sorted(counts):
            first_of[k, s] = at
            at += counts[s]
        bounds = bucket_bounds(counts, buckets)
        base, used = 0, dict.fromkeys(counts, 0)
        lists: dict[int, list[tuple]] = {s: [] for s in counts}
        for bucket, times, take in plan(counts, containers[kind], bounds, top_up):
            unused = containers[kind] - sum(s * m for s, m in take.items())
            for s, m in take.items():
                lists[s].append((used[s], m, base, bucket, unused))
                used[s] += m * times
            base += times
        for s, entries in lists.items():
            seats[k, s] = tuple(np.array(c, dtype=np.int64) for c in zip(*entries))
    sent = spark.sparkContext.broadcast((starts, first_of, seats))  # bounded by the capacities, not by the data
    id_kind = sizes.schema["doc_id"].dataType.simpleString()

    def seat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        starts, first_of, seats = sent.value
        at = starts.get(TaskContext.get().partitionId(), 0)
        for b in batches:
            m = b.num_rows
            if not m:
                continue
            k, size = b.column(0).to_numpy(zero_copy_only=False), b.column(3).to_numpy(zero_copy_only=False)
            rank = np.arange(at, at + m)
            at += m
            no, bucket, unused = np.empty(m, np.int64), np.empty(m, np.int64), np.empty(m, np.int64)
            cuts = np.flatnonzero((k[1:] != k[:-1]) | (size[1:] != size[:-1])) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), m]):
                key = (int(k[lo]), int(size[lo]))
                start, per, base, buckets_, unused_ = seats[key]
                r = rank[lo:hi] - first_of[key]
                e = np.searchsorted(start, r, side="right") - 1
                no[lo:hi] = base[e] + (r - start[e]) // per[e]
                bucket[lo:hi], unused[lo:hi] = buckets_[e], unused_[e]
            kind = pa.array(kinds, pa.string()).take(pa.array(k.astype(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [kind, pa.array(no), pa.array(bucket), b.column(1), b.column(2), b.column(3), pa.array(unused)],
                ["container_kind", "container_no", "bucket", "doc_id", "piece", "n_tokens", "unused"],
            )

    return placed.mapInArrow(seat, f"container_kind string, container_no bigint, bucket bigint, doc_id {id_kind}, piece int, n_tokens bigint, unused bigint")


def container_report(packed: DataFrame, containers: dict[str, int]) -> DataFrame:
    """(container_kind, capacity, n_containers, n_tokens, unused, fill) of each kind that holds anything."""
    table = F.create_map(*[F.lit(x) for kv in containers.items() for x in kv])
    by = packed.groupBy("container_kind", "container_no").agg(F.sum("n_tokens").alias("t"))
    got = by.groupBy("container_kind").agg(F.count("*").alias("n_containers"), F.sum("t").alias("n_tokens"))
    cap = F.element_at(table, F.col("container_kind")).cast("bigint")
    return got.select("container_kind", cap.alias("capacity"), "n_containers", "n_tokens", (cap * F.col("n_containers") - F.col("n_tokens")).alias("unused"), (F.col("n_tokens") / (cap * F.col("n_containers"))).alias("fill"))
