"""Why true pairs were missed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinlink.functions import text as tx

# Tags and reasons of a missed pair, in their order, and the columns of the report.
TAGS = ("exact_name", "name_core", "exact_address", "shared_name_token", "shared_name_token_pair", "shared_ngrams", "shared_address_token")
REASONS = ("COUNTRY_MISMATCH", "HAS_SHARED_KEY_CHECK_INDEX", "MULTILINGUAL_NAME", "NO_NAME_OVERLAP", "ADDRESS_MISSING", "OTHER")
REPORT = (
    "s1_entity_id target_entity_id country s1_name target_name s1_name_normalized target_name_normalized s1_name_core target_name_core s1_address target_address "
    "s1_address_normalized target_address_normalized s1_tokens target_tokens shared_keys reason"
).split()


def described(ents: DataFrame, mode: str = "full") -> DataFrame:
    """entities(pos, id, name, address, country) with their normalized forms; of each id the last row counts."""
    from kinlink.operators.pairs import dedup_last

    d = dedup_last(ents, "id")
    d = d.withColumn("country_n", tx.normalize_country("country", mode)).withColumn("name_n", tx.normalize_name("name", mode)).withColumn("address_n", tx.normalize_address("address", mode))
    return d.withColumn("core", tx.normalize_name_core("name_n"))


def _common(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b))


def shared_keys(a: str = "s1_", b: str = "t_") -> Column:
    """Tags of what two described records share, '|' between; empty if their countries differ."""
    x, y = (lambda c: F.col(a + c)), (lambda c: F.col(b + c))

    def equal(c: str) -> Column:
        return (x(c) != "") & (x(c) == y(c))

    name_common = _common(tx.tokens(x("name_n")), tx.tokens(y("name_n")))
    tests = [
        equal("name_n"), equal("core"), equal("address_n"), name_common >= 1, name_common >= 2,
        _common(tx.char_ngrams(x("name_n")), tx.char_ngrams(y("name_n"))) >= 2,
        _common(tx.tokens(x("address_n")), tx.tokens(y("address_n"))) >= 1,
    ]
    tags = F.concat_ws("|", *[F.when(t, F.lit(tag)) for t, tag in zip(tests, TAGS)])
    return F.when(x("country_n") != y("country_n"), F.lit("")).otherwise(tags)


def classify_reason(tags: Column, a: str = "s1_", b: str = "t_") -> Column:
    """The first reason that holds; tags as given by shared_keys."""
    x, y = (lambda c: F.col(a + c)), (lambda c: F.col(b + c))
    overlap = _common(tx.tokens(x("name_n")), tx.tokens(y("name_n"))) > 0
    tests = [
        x("country_n") != y("country_n"), tags != "", tx.is_ascii_name(x("name")) != tx.is_ascii_name(y("name")),
        (x("name_n") != "") & (y("name_n") != "") & ~overlap, (x("address") == "") | (y("address") == ""),
    ]
    out = F.lit(REASONS[-1])
    for t, r in reversed(list(zip(tests, REASONS))):
        out = F.when(t, F.lit(r)).otherwise(out)
    return out


def missed_pairs(truth: DataFrame, candidates: DataFrame, s1: DataFrame, target: DataFrame) -> DataFrame:
    """Described truth pairs (s1_id, target_id) that are no candidates; both records must exist."""
    a = s1.select(*[F.col(c).alias(f"s1_{c}") for c in s1.columns])
    b = target.select(*[F.col(c).alias(f"t_{c}") for c in target.columns])
    t = truth.select(F.col("s1_id"), F.col("target_id").alias("t_id")).join(a, "s1_id").join(b, "t_id")
    return t.join(candidates.select("s1_id", F.col("target_id").alias("t_id")).distinct(), ["s1_id", "t_id"], "left_anti")


def missed_pairs_report(truth: DataFrame, candidates: DataFrame, s1: DataFrame, target: DataFrame) -> DataFrame:
    """One row of the columns REPORT for each missed truth pair; s1 and target as given by described()."""
    m = missed_pairs(truth, candidates, s1, target).withColumn("shared_keys", shared_keys())
    m = m.withColumn("reason", classify_reason(F.col("shared_keys")))

    def words(c: str) -> Column:
        return F.array_join(F.array_sort(tx.tokens(c)), " ")

    values = [
        "s1_id", "t_id", "s1_country", "s1_name", "t_name", "s1_name_n", "t_name_n", "s1_core", "t_core", "s1_address", "t_address", "s1_address_n", "t_address_n",
    ]
    return m.select(*[F.col(v).alias(c) for v, c in zip(values, REPORT)], words("s1_name_n").alias("s1_tokens"), words("t_name_n").alias("target_tokens"), "shared_keys", "reason")


def reason_counts(report: DataFrame) -> DataFrame:
    """(reason, n), most frequent first."""
    return report.groupBy("reason").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "reason")
