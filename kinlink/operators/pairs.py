"""Pair features and labels."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinlink.functions import at_once
from kinlink.functions import similarity as sim

# The features of a pair in their order.
FEATURES = (
    "country_equal name_exact name_core_exact name_ratio name_core_ratio name_token_set_ratio name_jaccard name_char_jaccard "
    "address_exact address_ratio address_jaccard address_char_jaccard numeric_overlap name_len_diff address_len_diff"
).split()


def dedup_first(df: DataFrame, key: str, order: str = "pos") -> DataFrame:
    """The first row of each key by `order`: an aggregate with map-side combine, no window."""
    cols = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.min_by(F.struct(*cols), order).alias("r")).select(key, "r.*").select(*df.columns)


def dedup_last(df: DataFrame, key: str, order: str = "pos") -> DataFrame:
    """The last row of each key by `order`."""
    cols = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*cols), order).alias("r")).select(key, "r.*").select(*df.columns)


def pair_inputs(features: DataFrame, n: int = 3) -> DataFrame:
    """What a comparison needs of each entity id: its first row."""
    from kinlink.functions import text as tx

    first = dedup_first(features.select("pos", "id", "country_raw", "name", "core", "address", "name_tokens", "grams", "numbers"), "id")
    return first.select("id", "country_raw", "name", "core", "address", "name_tokens", "grams", "numbers", tx.tokens("address").alias("addr_tokens"), tx.char_ngrams("address", n).alias("addr_grams"))


def lookup_join(pairs: DataFrame, s1: DataFrame, target: DataFrame) -> DataFrame:
    """pairs(s1_id, target_id, ...) with both entities as a_* and b_*; pairs with an unknown id are dropped."""
    a = s1.select(F.col("id").alias("s1_id"), *[F.col(c).alias(f"a_{c}") for c in s1.columns if c != "id"])
    b = target.select(F.col("id").alias("target_id"), *[F.col(c).alias(f"b_{c}") for c in target.columns if c != "id"])
    return pairs.join(a, "s1_id").join(b, "target_id")


def pair_features(pairs: DataFrame, s1: DataFrame, target: DataFrame, n: int = 3) -> DataFrame:
    """pairs with the features of FEATURES; s1 and target are entity features, n the length of their grams.

    Only the normalized strings go through the joins; words, grams and ratios are made of them behind, in arrays over a batch of pairs."""
    keep = pairs.columns
    strings = [dedup_first(e.select("pos", "id", "country_raw", "name", "core", "address"), "id").drop("pos") for e in (s1, target)]
    j = lookup_join(pairs, *strings)
    cols = {
        "country_equal": F.col("a_country_raw") == F.col("b_country_raw"),
        "name_exact": sim.exact_eq("a_name", "b_name"), "name_core_exact": sim.exact_eq("a_core", "b_core"), "address_exact": sim.exact_eq("a_address", "b_address"),
        "name_len_diff": sim.len_diff("a_name", "b_name"), "address_len_diff": sim.len_diff("a_address", "b_address"),
    }
    texts = [f"{side}_{c}" for c in ("name", "core", "address") for side in "ab"]
    j = j.select(*keep, *texts, *[c.cast("double").alias(f) for f, c in cols.items()])
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in pairs.schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = at_once.pair_measures(*[b.column(b.schema.get_field_index(c)) for c in texts], n)
            got = [made[f] if f in made else b.column(b.schema.get_field_index(f)) for f in FEATURES]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], *got], [*keep, *FEATURES])

    return j.mapInArrow(run, ", ".join([*kept, *(f"{f} double" for f in FEATURES)]))


def clean_features(df: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    """Infinite, missing and absent features become 0; columns in the order of `features`."""
    keep = [c for c in df.columns if c not in features]

    def clean(f: str):
        if f not in df.columns:
            return F.lit(0.0).alias(f)
        c = F.col(f).cast("double")
        return F.when(c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")), F.lit(0.0)).otherwise(c).alias(f)

    return df.select(*keep, *[clean(f) for f in features])


def truth_pairs(truth: DataFrame) -> DataFrame:
    """(s1_id, target_id), distinct, of truth(s1_id, ids array<string>)."""
    return truth.select("s1_id", F.explode("ids").alias("target_id")).distinct()


def label_join(pairs: DataFrame, positives: DataFrame) -> DataFrame:
    """pairs with label 1 where the pair is in positives(s1_id, target_id)."""
    hit = positives.select("s1_id", "target_id").distinct().withColumn("hit", F.lit(1))
    return pairs.join(hit, ["s1_id", "target_id"], "left").withColumn("label", F.coalesce("hit", F.lit(0))).drop("hit")


def collect_ids(pairs: DataFrame, key: str, id_col: str, order: str) -> DataFrame:
    """(key, ids): comma list of distinct ids in the order of `order`."""
    first = pairs.groupBy(key, id_col).agg(F.min(order).alias("o"))
    listed = F.array_sort(F.collect_list(F.struct("o", id_col)))
    return first.groupBy(key).agg(F.concat_ws(",", F.transform(listed, lambda x: x[id_col])).alias("ids"))
