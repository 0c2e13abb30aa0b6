"""Queries of the general data operators, with DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinlink.functions.text import missing, normalize_country
from kinlink.operators.heavy_keys import count_by_heavy_key
from kinlink.operators.packed import unpack
from kinlink.session import table

ID_PATTERN = r"S[0-9]-[0-9]+"
ID_SUFFIX = r"[,;|][A-Za-z0-9]{1,4}"
HEAVY_SHARE = 0.04


def _country_counts(spark: SparkSession, d: str) -> DataFrame:
    s2 = table(spark, d, "train_source2").select("country", "entity_id", "pos")
    key = F.when(missing("country"), "").otherwise(normalize_country(F.col("country")))
    return count_by_heavy_key(s2, key, F.col("entity_id"), F.col("pos"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    counts = _country_counts(spark, d)
    total = counts.agg(F.sum("n_rows").alias("total"))  # one row
    return counts.crossJoin(F.broadcast(total)).where(F.col("n_rows") > F.lit(HEAVY_SHARE) * F.col("total")).select(F.col("k").alias("country_key"))


def p6_country_counts(spark: SparkSession, d: str) -> DataFrame:
    return _country_counts(spark, d).select(F.col("k").alias("country_key"), "n_rows", F.col("n_distinct").alias("n_entities"))


def _listed(spark: SparkSession, d: str) -> DataFrame:
    parts = []
    for name, column in (("train_matches", "matched_entity_ids"), ("candidate_pairs", "candidate_entity_ids")):
        got = unpack(table(spark, d, name), column, ["pos"], ID_PATTERN, ID_SUFFIX, value_name="entity_id")
        parts.append(got.select(F.lit(name).alias("src_table"), "pos", "item_no", "entity_id", "error"))
    return parts[0].unionByName(parts[1])


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return _listed(spark, d).select("src_table", "pos", "item_no", "entity_id")


def p7_field_report(spark: SparkSession, d: str) -> DataFrame:
    """Items and fields with at least one item, by table."""
    return (
        _listed(spark, d)
        .groupBy("src_table")
        .agg(F.count("*").alias("n_items"), F.sum((F.col("item_no") == 1).cast("long")).alias("n_fields"), F.max("item_no").alias("most_items"))
    )


def p7_fields(spark: SparkSession, d: str) -> DataFrame:
    """Every value of every packed field as it was read, with its place among all values of the field and its flag: what is no id and what is quoted
    wrongly too."""
    parts = []
    for name, column in (("train_matches", "matched_entity_ids"), ("candidate_pairs", "candidate_entity_ids")):
        got = unpack(table(spark, d, name), column, ["pos"], ID_PATTERN, ID_SUFFIX, only_values=False)
        parts.append(got.select(F.lit(name).alias("src_table"), "pos", "item_no", "value", "error"))
    return parts[0].unionByName(parts[1])


QUERIES = {"p7_fields": p7_fields, "p6_found": p6_found, "p6_country_counts": p6_country_counts, "p7_found": p7_found, "p7_field_report": p7_field_report}

_KEY = """CASE WHEN coalesce(lower(trim(country)), '') IN ('', 'na', 'n/a', 'null', 'none', 'nan', '-') THEN ''
 ELSE (SELECT CASE WHEN n IN ('us','usa','united states','united states of america') THEN 'us' WHEN n IN ('india','in') THEN 'india' ELSE n END
       FROM (SELECT trim(regexp_replace(replace(translate(lower(country), '''’`', ''), '&', ' and '), '[^a-z0-9]+', ' ', 'g')) AS n)) END"""
_COUNTS = f"SELECT country_key, count(*) AS n_rows, count(DISTINCT entity_id) AS n_entities FROM (SELECT {_KEY} AS country_key, entity_id FROM train_source2) GROUP BY 1"
_ITEMS = """SELECT src_table, pos, CAST(i AS INTEGER) AS item_no, trim(ids[i], '"''') AS entity_id FROM (
  SELECT src_table, pos, ids, unnest(range(1, len(ids) + 1)) AS i FROM (
    SELECT src_table, pos, regexp_extract_all(v, '["''](S[0-9]-[0-9]{8})[,;|][A-Z0-9]{1,2}["'']|S[0-9]-[0-9]{8}') AS ids FROM (
      SELECT 'train_matches' AS src_table, pos, matched_entity_ids AS v FROM train_matches
      UNION ALL SELECT 'candidate_pairs', pos, candidate_entity_ids FROM candidate_pairs)))"""
SQL = {
    "p6_found": f"SELECT country_key FROM ({_COUNTS}) WHERE n_rows > 0.04 * (SELECT count(*) FROM train_source2)",
    "p6_country_counts": _COUNTS,
    "p7_found": _ITEMS,
    "p7_field_report": f"SELECT src_table, count(*) AS n_items, sum(CASE WHEN item_no = 1 THEN 1 ELSE 0 END)::BIGINT AS n_fields, max(item_no) AS most_items FROM ({_ITEMS}) GROUP BY 1",
}
