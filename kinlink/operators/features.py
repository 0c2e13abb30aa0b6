"""Entity features: one row for each record, everything blocking and comparison need, computed once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinlink.functions import text as tx

SOURCE_STRIDE = 1 << 40  # positions of the second target table follow those of the first


def entities(df: DataFrame, source_ordinal: int = 0) -> DataFrame:
    """(pos, id, name, address, country) of a source table, missing columns and nulls as empty strings.

    df needs `pos` (row position) and entity_id; a second table of a union gets a higher ordinal, so positions stay ordered and unique.
    """

    def text(c: str):
        return F.coalesce(F.col(c).cast("string"), F.lit("")) if c in df.columns else F.lit("")

    return df.select(
        (F.col("pos") + F.lit(source_ordinal * SOURCE_STRIDE)).alias("pos"),
        text("entity_id").alias("id"), text("business_name").alias("name"), text("business_address").alias("address"), text("country").alias("country"),
    )


def target_union(s2: DataFrame, s3: DataFrame) -> DataFrame:
    """The target side: both tables, the first one's rows before the second one's."""
    return entities(s2, 0).unionByName(entities(s3, 1))


def normalized(ents: DataFrame, mode: str = "full") -> DataFrame:
    """The normalized strings of entities(pos, id, name, address, country)."""
    norm = ents.select(
        "pos", "id",
        tx.normalize_country("country", mode).alias("country"), tx.normalize_name("name", mode).alias("name"), tx.normalize_address("address", mode).alias("address"),
        F.lower(F.col("country")).alias("country_raw"),
    )
    return norm.withColumn("core", tx.normalize_name_core("name"))


def with_sets(norm: DataFrame, n: int = 3) -> DataFrame:
    """normalized() with the token sets, which cost less to make again than to write."""
    return norm.select(
        "pos", "id", "country", "country_raw", "name", "core", "address",
        tx.tokens("name").alias("name_tokens"), tx.address_tokens("address").alias("address_tokens"), tx.address_location_tokens("address").alias("location_tokens"),
        tx.numeric_tokens("address").alias("numbers"), tx.char_ngrams("name", n).alias("grams"),
    )


def entity_features(ents: DataFrame, mode: str = "full", n: int = 3) -> DataFrame:
    """Normalized strings and token sets of entities(pos, id, name, address, country). Two projections, no shuffle: the strings first,
    so the sets are built from finished columns and a Python transliteration runs once a column."""
    return with_sets(normalized(ents, mode), n)
