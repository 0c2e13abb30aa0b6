"""Splits that keep related records together (problem 2): grouped iterative stratification.

1. Components of the relation "shares an entity": each entity ties its records to the least of them, the rest is star contraction (operators.components).
2. One label vector for each component: how many of its records carry each label, and how many records it has.
3. Placement: components in the order of their rarest outstanding label, each into the split that lacks that label most.

Placement in parallel without giving up the rule: a component of more than 1/HEAVY of all records is heavy; there are fewer than
HEAVY of them whatever the input, and one task places them by the rule, over the global targets. What each split still lacks
of each label is then shared out among shards of light components in proportion to what the shard holds, and each
shard is placed by the same rule. A shard's result misses its target by at most about one light component for each label, so the
error of the whole is below shards / HEAVY and shrinks as the data grow.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinlink.operators.components import connected_components
from kinlink.session import cut

HEAVY = 1000
SHARD_COMPONENTS = 20_000
MAX_LABELS = 100_000


Vector = tuple[np.ndarray, np.ndarray]  # label numbers and how many records carry each


def place(vectors: list[Vector], sizes: np.ndarray, lacking: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """Split of each component. vectors: the labels of each component; sizes: its records; lacking: splits x (labels and, last, records),
    changed in place. Rarest outstanding label first, largest component first within it, into the split that
    lacks that label most, in proportion to its share; ties go to the split that lacks most records in proportion, then to the first split.
    A split without a share gets nothing."""
    n, labels = len(sizes), lacking.shape[1]
    split = np.full(n, -1, dtype=np.int32)
    outstanding = np.zeros(labels)
    outstanding[-1] = sizes.sum()
    holders: dict[int, list] = {labels - 1: [(-sizes[i], -sizes[i], i) for i in range(n)]}
    for i, (ks, vs) in enumerate(vectors):
        np.add.at(outstanding, ks, vs)
        for k, v in zip(ks.tolist(), vs.tolist()):
            holders.setdefault(k, []).append((-v, -sizes[i], i))
    weight = np.where(shares > 0, 1 / np.where(shares > 0, shares, 1), 0)
    barred = np.where(shares > 0, 0.0, -np.inf)
    heap = [(outstanding[k], k) for k in holders]
    heapq.heapify(heap)
    done: set[int] = set()
    while heap:
        left, k = heapq.heappop(heap)
        if k in done or left != outstanding[k]:
            continue  # an entry with the number as it is now follows
        for _, _, i in sorted(holders[k]):
            if split[i] >= 0:
                continue
            need = lacking[:, k] * weight + barred
            best = np.flatnonzero(need >= need.max() - 1e-9)
            s = int(best[np.argmax((lacking[:, -1] * weight + barred)[best])])
            split[i] = s
            ks, vs = vectors[i]
            lacking[s, ks] -= vs
            lacking[s, -1] -= sizes[i]
            outstanding[ks] -= vs
            outstanding[-1] -= sizes[i]
            for j in (*ks.tolist(), labels - 1):
                if j not in done and j != k:
                    heapq.heappush(heap, (outstanding[j], j))
        done.add(k)
    return split


def tied_components(links: DataFrame) -> DataFrame:
    """(record_id, component) of the records of links(record_id, entity) that share an entity with another record, directly or by way of others;
    component is the least of their ids. Each entity ties its records to the least of them; one that a single record has ties nothing."""
    known = links.where("record_id is not null and entity is not null").select("record_id", "entity")
    shared = known.groupBy("entity").agg(F.min("record_id").alias("least"), F.max("record_id").alias("most")).where("least <> most")
    edges = known.join(shared, "entity").where("record_id <> least").select(F.col("record_id").alias("a"), F.col("least").alias("b")).distinct()
    return connected_components(cut(edges)).select(F.col("node").alias("record_id"), F.col("component").cast("string").alias("component"))


def grouped_splits(records: DataFrame, links: DataFrame, labels: DataFrame, targets: dict[str, float], max_labels: int = MAX_LABELS) -> DataFrame:
    """(record_id, component, split_name), one row for each distinct record_id.

    records(record_id): repeated ids count once, nulls are left out. links(record_id, entity): records with a common entity
    belong together; a record without links is a component of its own. labels(record_id, label): any number each; a record
    without labels counts among the records only. targets: share of records for each split, scaled to a sum of 1. An empty table of records gives no rows. More different labels than max_labels are an error: one total of each is held by
    the driver and by the tasks.
    """
    names = list(targets)
    total_share = sum(targets.values())
    shares = np.array([targets[s] / total_share for s in names])
    ids = records.select("record_id").where("record_id is not null").distinct()
    members = cut(ids.join(tied_components(links), "record_id", "left").select("record_id", F.coalesce("component", F.col("record_id").cast("string")).alias("component")))
    kinds = labels.where("record_id is not null and label is not null").select("record_id", F.col("label").cast("string").alias("label")).distinct()
    totals = kinds.join(ids, "record_id", "left_semi").groupBy("label").agg(F.count("*").alias("n")).orderBy("label").limit(max_labels + 1).collect()
    if len(totals) > max_labels:
        raise ValueError(f"more than {max_labels} different labels")
    number = records.sparkSession.createDataFrame([(r["label"], k) for k, r in enumerate(totals)], "label string, k int")
    counted = members.join(kinds.join(number, "label"), "record_id").groupBy("component", "k").agg(F.count("*").alias("v"))
    held = counted.groupBy("component").agg(F.array_sort(F.collect_list(F.struct("k", "v"))).alias("kv"))
    vectors = cut(
        members.groupBy("component").agg(F.count("*").alias("size")).join(held, "component", "left")
        .select("component", "size", F.col("kv.k").alias("ks"), F.col("kv.v").alias("vs"))
    )
    sums = vectors.agg(F.count("*").alias("n"), F.sum("size").alias("size")).first()
    if not sums["n"]:
        return members.select("record_id", "component", F.lit(None).cast("string").alias("split_name"))
    total = np.array([*(float(r["n"]) for r in totals), float(sums["size"])])

    def sparse(pdf: pd.DataFrame) -> tuple[list[Vector], np.ndarray]:
        none = (np.zeros(0, np.int64), np.zeros(0))
        return [none if k is None else (np.asarray(k, np.int64), np.asarray(v, float)) for k, v in zip(pdf["ks"], pdf["vs"])], pdf["size"].to_numpy(float)

    def sum_of(vecs: list[Vector], sizes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(total))
        for ks, vs in vecs:
            out[ks] += vs
        out[-1] = sizes.sum()
        return out

    limit = max(1.0, total[-1] / HEAVY)
    heavy = vectors.where(F.col("size") > limit).toPandas().sort_values(["size", "component"], ascending=[False, True])  # fewer than HEAVY rows
    lacking = np.outer(shares, total)
    heavy_vectors, heavy_sizes = sparse(heavy)
    placed = place(heavy_vectors, heavy_sizes, lacking, shares)
    spark = records.sparkSession
    where_heavy = spark.createDataFrame(
        [(c, names[s]) for c, s in zip(heavy["component"], placed)], "component string, split_name string"
    )
    light_total = total - sum_of(heavy_vectors, heavy_sizes)
    shards = max(1, math.ceil(sums["n"] / SHARD_COMPONENTS))

    def one_shard(pdf: pd.DataFrame) -> pd.DataFrame:
        # ties in an order that has nothing to do with the names
        pdf = pdf.assign(h=pd.util.hash_array(pdf["component"].to_numpy(object))).sort_values(["h", "component"]).reset_index(drop=True)
        vecs, sizes = sparse(pdf)
        part = np.divide(sum_of(vecs, sizes), light_total, out=np.zeros_like(light_total), where=light_total > 0)
        split = place(vecs, sizes, lacking * part, shares)
        return pd.DataFrame({"component": pdf["component"], "split_name": [names[s] for s in split]})

    light = vectors.where(F.col("size") <= limit).withColumn("shard", F.pmod(F.xxhash64("component"), F.lit(shards)))
    where_light = light.groupBy("shard").applyInPandas(one_shard, "component string, split_name string")
    where = where_light.unionByName(where_heavy)
    return members.join(where, "component").select("record_id", "component", "split_name")


def tied_pairs(components: DataFrame) -> DataFrame:
    """(id_a, id_b): all pairs of records of one component(record_id, component), the smaller first."""
    a = components.select("component", F.col("record_id").alias("id_a"))
    b = components.select("component", F.col("record_id").alias("id_b"))
    return a.join(b, "component").where("id_a < id_b").select("id_a", "id_b")
