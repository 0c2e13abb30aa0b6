"""Tab-separated files: every column text, empty text for a missing value."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# What the default reading of the surveyed analyzer takes for missing.
NA_LITERALS = "#N/A,#N/A N/A,#NA,-1.#IND,-1.#QNAN,-NaN,-nan,1.#IND,1.#QNAN,<NA>,N/A,NA,NULL,NaN,None,n/a,nan,null".split(",")
READ = {"sep": "\t", "header": "true", "quote": '"', "escape": '"', "multiLine": "true", "inferSchema": "false", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
WRITE = {"sep": "\t", "header": "true", "quote": '"', "escape": '"', "emptyValue": "", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def scan_tsv(spark: SparkSession, path: str, columns: list[str] | None = None, na_mode: str = "keep", multiline: bool = True) -> DataFrame:
    """na_mode keep: literals such as NA stay; pandas_default: they become empty. columns: only these are read.
    multiline=False lets one large file be split among tasks where no field holds a line break."""
    df = spark.read.options(**READ | {"multiLine": str(multiline).lower()}).csv(path)
    df = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in (columns or df.columns)]).na.fill("")
    if na_mode == "pandas_default":
        return df.select(*[F.when(F.col(c).isin(*NA_LITERALS), "").otherwise(F.col(c)).alias(c) for c in df.columns])
    if na_mode != "keep":
        raise ValueError("na_mode must be keep or pandas_default")
    return df


def with_positions(df: DataFrame) -> DataFrame:
    """df with pos, the number of the row in reading order from 0: counts of the partitions go to the driver, rows don't move."""
    parts = df.withColumn("__p", F.spark_partition_id()).withColumn("__m", F.monotonically_increasing_id())
    counts = {r["__p"]: r["count"] for r in parts.groupBy("__p").count().collect()}
    start, offset = 0, {}
    for p in sorted(counts):
        offset[p] = start
        start += counts[p]
    if not offset:
        return df.withColumn("pos", F.lit(0).cast("bigint"))
    table = F.create_map(*[F.lit(x) for p, o in offset.items() for x in (p, o)])
    in_part = F.col("__m").bitwiseAND(F.lit((1 << 33) - 1))
    return parts.withColumn("pos", (F.element_at(table, F.col("__p")) + in_part).cast("bigint")).drop("__p", "__m")


def sink_tsv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header, no index; empty texts stay empty, blanks stay blanks."""
    df.write.mode(mode).options(**WRITE).csv(path)


def sink_append(df: DataFrame, path: str) -> None:
    """More rows to a folder table, created where it is absent."""
    df.write.mode("append").parquet(path)


def row_count_file(spark: SparkSession, path: str) -> int:
    """Physical lines less the header, not below 0."""
    return max(0, spark.read.text(path).count() - 1)


def results(s1: DataFrame, pairs: DataFrame, column: str) -> DataFrame:
    """(source1_entity_id, column): comma list of target ids for each row of s1(pos, id) in its order, empty where there are none."""
    from kinlink.operators.pairs import collect_ids

    listed = collect_ids(pairs, "s1_id", "target_id", "t_pos")
    j = s1.select("pos", F.col("id").alias("s1_id")).join(listed, "s1_id", "left")
    return j.orderBy("pos").select(F.col("s1_id").alias("source1_entity_id"), F.coalesce("ids", F.lit("")).alias(column))
