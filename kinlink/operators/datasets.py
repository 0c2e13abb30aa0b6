"""Samples and subsets that keep the truth together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinlink.functions.text import split_ids_list
from kinlink.operators.pairs import dedup_first


def sample_n(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """Exactly min(n, rows) rows without replacement: those of the smallest seeded hash of their key, so the same rows at every run and layout.
    A top-n by hash: each task keeps n rows, nothing else is shuffled."""
    return df.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(n)


def limit_head(df: DataFrame, order: str, n: int) -> DataFrame:
    """The first n rows by `order`."""
    return df.orderBy(order).limit(n)


def semi_in(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is among ids(key). Spark broadcasts ids if they are few."""
    return df.join(ids.select(key).distinct(), key, "left_semi")


def anti_in(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not among ids(key)."""
    return df.join(ids.select(key).distinct(), key, "left_anti")


def nonempty(c: str) -> Column:
    return F.length(F.coalesce(F.col(c), F.lit(""))) > 0


def from_source(c: str, prefix: str) -> Column:
    """Whether an id has the prefix of a source."""
    return F.col(c).startswith(prefix)


def explode_truth(gt: DataFrame) -> DataFrame:
    """(s1_id, target_id) of gt(source1_entity_id, matched_entity_ids), repeats kept, empty lists without rows."""
    return gt.select(F.col("source1_entity_id").alias("s1_id"), F.explode(split_ids_list("matched_entity_ids")).alias("target_id"))


def gt_available(gt: DataFrame, available: DataFrame, order: str = "pos") -> DataFrame:
    """gt with only those listed ids that are in available(entity_id), in their order; rows whose list ends up empty are dropped."""
    x = gt.where(nonempty("source1_entity_id")).select("source1_entity_id", order, F.posexplode(split_ids_list("matched_entity_ids")).alias("at", "entity_id"))
    x = x.join(available.select("entity_id").distinct(), "entity_id", "left_semi")
    listed = F.array_sort(F.collect_list(F.struct("at", "entity_id")))
    return x.groupBy("source1_entity_id", order).agg(F.concat_ws(",", F.transform(listed, lambda r: r["entity_id"])).alias("matched_entity_ids"))


def blocking_sample(gt: DataFrame, s1: DataFrame, s2: DataFrame, s3: DataFrame, n_s1: int = 10_000, n_negatives: int = 50_000, seeds: tuple[int, int, int] = (42, 42, 43)) -> dict[str, DataFrame]:
    """Source 1 records with truth, their matches and random other targets: tables sample_s1, sample_s2, sample_s3, sample_gt, sorted by id."""
    usable = gt.where(nonempty("source1_entity_id"))
    if usable.limit(n_s1).count() < n_s1:
        raise ValueError(f"fewer than {n_s1} truth rows")
    picked = sample_n(dedup_first(usable, "source1_entity_id"), "source1_entity_id", n_s1, seeds[0])
    ids = explode_truth(picked).select(F.col("target_id").alias("entity_id")).distinct()
    out = {"sample_s1": dedup_first(semi_in(s1, picked.select(F.col("source1_entity_id").alias("entity_id")), "entity_id"), "entity_id").orderBy("entity_id")}
    kept = []
    for name, table, seed in (("sample_s2", s2, seeds[1]), ("sample_s3", s3, seeds[2])):
        true = semi_in(table, ids, "entity_id")
        other = sample_n(dedup_first(anti_in(table, ids, "entity_id"), "entity_id"), "entity_id", n_negatives, seed)
        out[name] = dedup_first(true.unionByName(other), "entity_id").orderBy("entity_id")
        kept.append(out[name].select("entity_id"))
    out["sample_gt"] = gt_available(picked, kept[0].unionByName(kept[1])).orderBy("source1_entity_id")
    return out


def debug_dataset(gt: DataFrame, s1: DataFrame, s2: DataFrame, s3: DataFrame, n_gt: int = 10_000, existing: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """The records that the first n_gt truth rows speak of. With `existing` tables only what they lack: appending it twice changes nothing."""
    head = limit_head(gt, "pos", n_gt)
    ids = explode_truth(head).select(F.col("target_id").alias("entity_id")).distinct()
    out = {
        "source1": semi_in(s1, head.select(F.col("source1_entity_id").alias("entity_id")), "entity_id"),
        "source2": semi_in(s2, ids.where(from_source("entity_id", "S2-")), "entity_id"),
        "source3": semi_in(s3, ids.where(from_source("entity_id", "S3-")), "entity_id"),
        "ground_truth": head,
    }
    if existing:
        for k in ("source1", "source2", "source3"):
            out[k] = anti_in(out[k], existing[k], "entity_id")
        out["ground_truth"] = head.join(existing["ground_truth"].select("source1_entity_id", "matched_entity_ids").distinct(), ["source1_entity_id", "matched_entity_ids"], "left_anti")
    return out
