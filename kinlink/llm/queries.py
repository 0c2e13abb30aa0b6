"""Queries of the training-data operators; SQL where it can express them on whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinlink.functions.text import missing
from kinlink.llm.entities import best_sites, one_to_one_sites
from kinlink.llm.lookalike import look_col, lookalike_pairs
from kinlink.llm.places import place_classes, place_pairs
from kinlink.llm.mixing import mix, mix_report
from kinlink.llm.packing import container_report, pack
from kinlink.llm.spam import spam_scores
from kinlink.llm.splits import grouped_splits, tied_components, tied_pairs
from kinlink.llm.tokens import token_sizes
from kinlink.llm.variants import name_classes, variant_pairs
from kinlink.operators.packed import unpack
from kinlink.plans.general import ID_PATTERN, ID_SUFFIX
from kinlink.session import cut, table

QUERIES: dict = {}
SQL: dict = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


# -- problem 2 ---------------------------------------------------------------------------------------------------------


def _match_links(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(records, links) of train_matches; the packed lists are taken apart by the core operator."""
    m = table(spark, d, "train_matches")
    listed = unpack(m, "matched_entity_ids", ["source1_entity_id"], ID_PATTERN, ID_SUFFIX, value_name="entity")
    return m.select(F.col("source1_entity_id").alias("record_id")), listed.select(F.col("source1_entity_id").alias("record_id"), "entity")


def _assigned(spark: SparkSession, d: str) -> DataFrame:
    """Labels: does a record have matches in source 2, in source 3, none at all."""
    records, links = _match_links(spark, d)
    links = cut(links)
    labels = links.select("record_id", F.substring("entity", 1, 2).alias("label"))
    none = records.join(links.select("record_id"), "record_id", "left_anti").select("record_id", F.lit("none").alias("label"))
    shares = {r["split_name"]: float(r["target_share"]) for r in table(spark, d, "split_targets").collect()}  # a fixed, tiny table
    return grouped_splits(records, links, labels.unionByName(none), shares)


@query
def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of ids that must not be parted: members of one component of the relation the splits are built on."""
    _, links = _match_links(spark, d)
    return tied_pairs(tied_components(links))


@query
def p2_splits(spark: SparkSession, d: str) -> DataFrame:
    """One split for each source1_entity_id."""
    return _assigned(spark, d).select(F.col("record_id").alias("source1_entity_id"), "split_name")


@query
def p2_split_report(spark: SparkSession, d: str) -> DataFrame:
    """Wanted and reached share of records for each split, and components cut apart (always 0)."""
    got = cut(_assigned(spark, d))
    total = got.count()
    torn = got.groupBy("component").agg(F.count_distinct("split_name").alias("n")).where("n > 1").count()
    by = got.groupBy("split_name").agg(F.count("*").alias("n_records"), F.count_distinct("component").alias("n_components"))
    wanted = table(spark, d, "split_targets")
    return wanted.join(by, "split_name", "left").select(
        "split_name", "target_share", F.coalesce("n_records", F.lit(0)).alias("n_records"), F.coalesce("n_components", F.lit(0)).alias("n_components"),
        (F.coalesce("n_records", F.lit(0)) / F.lit(max(total, 1))).alias("share"), F.lit(torn).cast("long").alias("n_torn"),
    )


@query
def p2_split_check(spark: SparkSession, d: str) -> DataFrame:
    """Records, records without exactly one split, listed ids whose records lie in several splits, and splits off their share by more than 0.03."""
    _, links = _match_links(spark, d)
    got = cut(p2_splits(spark, d))
    torn = links.join(got.withColumnRenamed("source1_entity_id", "record_id"), "record_id").groupBy("entity").agg(F.count_distinct("split_name").alias("n")).where("n > 1")
    wanted = table(spark, d, "split_targets")
    share = got.groupBy("split_name").agg((F.count("*") / F.lit(max(1, got.count()))).alias("share"))
    off = wanted.join(share, "split_name", "left").where(F.abs(F.col("target_share") - F.coalesce("share", F.lit(0.0))) > 0.03)
    ids = got.groupBy("source1_entity_id").agg(F.count("split_name").alias("n"))
    counts = ids.agg(F.count("*").alias("n_records"), F.sum((F.col("n") != 1).cast("long")).alias("n_not_in_one_split"))
    return counts.crossJoin(torn.agg(F.count("*").alias("n_torn"))).crossJoin(off.agg(F.count("*").alias("n_off_share")))  # one row each


# -- problem 4 ---------------------------------------------------------------------------------------------------------


def _names13(spark: SparkSession, d: str) -> DataFrame:
    parts = [table(spark, d, f"train_source{k}").select("entity_id", "business_name") for k in (1, 3)]
    return parts[0].unionByName(parts[1])


@query
def p4_found(spark: SparkSession, d: str) -> DataFrame:
    named = _names13(spark, d).where(~missing("business_name"))
    return lookalike_pairs(named, "entity_id", "business_name")


@query
def p4_canonical_names(spark: SparkSession, d: str) -> DataFrame:
    """The one form of each distinct name of both tables and its folded comparison key."""
    names = _names13(spark, d).select("business_name").where("business_name is not null").distinct()
    return names.select("business_name", look_col(F.col("business_name")).alias("look"), look_col(F.col("business_name"), fold=True).alias("folded"))


# -- problem 1 ---------------------------------------------------------------------------------------------------------


def _addresses13(spark: SparkSession, d: str) -> DataFrame:
    parts = [table(spark, d, f"train_source{k}").select("entity_id", "business_address") for k in (1, 3)]
    return parts[0].unionByName(parts[1])


@query
def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return place_pairs(cut(place_classes(_addresses13(spark, d), "entity_id", "business_address")))


@query
def p1_place_classes(spark: SparkSession, d: str) -> DataFrame:
    """The place class of each record and how many records share it."""
    classes = cut(place_classes(_addresses13(spark, d), "entity_id", "business_address"))
    sizes = classes.groupBy("place").agg(F.count_distinct("id").alias("n_records"))
    return classes.join(sizes, "place").select(F.col("id").alias("entity_id"), "place", "n_records")


# -- problem 3 ---------------------------------------------------------------------------------------------------------


def _sites(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    known = table(spark, d, "train_matches").select(F.col("source1_entity_id").alias("entity_id"))
    return table(spark, d, "train_source1").join(known, "entity_id", "left_anti"), table(spark, d, "train_source2")


@query
def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return best_sites(*_sites(spark, d)).select(F.col("left_id").alias("s1_id"), F.col("right_id").alias("s2_id"))


@query
def p3_one_to_one(spark: SparkSession, d: str) -> DataFrame:
    """At most one source 2 record for each source 1 record, with the confidence."""
    return one_to_one_sites(*_sites(spark, d)).select(F.col("left_id").alias("s1_id"), F.col("right_id").alias("s2_id"), "confidence")


# -- problem 5 ---------------------------------------------------------------------------------------------------------


def _names(spark: SparkSession, d: str, k: int) -> DataFrame:
    return table(spark, d, f"train_source{k}").select(F.col("entity_id").alias("id"), F.col("business_name").alias("text"))


def _name_classes(spark: SparkSession, d: str) -> DataFrame:
    return cut(name_classes(_names(spark, d, 1), _names(spark, d, 2)))


@query
def p5_found(spark: SparkSession, d: str) -> DataFrame:
    known = table(spark, d, "train_matches").select(F.col("source1_entity_id").alias("id"))
    left = _names(spark, d, 1).join(known, "id", "left_anti")
    got = variant_pairs(left, _names(spark, d, 2), _name_classes(spark, d))
    return got.select(F.col("left_id").alias("s1_id"), F.col("right_id").alias("s2_id"))


@query
def p5_name_classes(spark: SparkSession, d: str) -> DataFrame:
    """Each distinct name of sources 1 and 2 with its class and the number of spellings in it."""
    classes = _name_classes(spark, d)
    sizes = classes.groupBy("cls").agg(F.count("*").alias("n_spellings"))
    return classes.join(sizes, "cls").select(F.col("text").alias("business_name"), "cls", "n_spellings")


# -- problem 8 ---------------------------------------------------------------------------------------------------------


def _sizes(spark: SparkSession, d: str) -> DataFrame:
    return cut(token_sizes(table(spark, d, "documents"), "doc_id", "text", ["source"]))


def _containers(spark: SparkSession, d: str) -> dict[str, int]:
    return {r["container_kind"]: int(r["capacity_tokens"]) for r in table(spark, d, "containers").collect()}  # a fixed, tiny table


@query
def p8_containers(spark: SparkSession, d: str) -> DataFrame:
    """The container of each document (of each piece of one larger than the capacity) and the room left in it."""
    return pack(_sizes(spark, d), _containers(spark, d))


@query
def p8_container_report(spark: SparkSession, d: str) -> DataFrame:
    kinds = _containers(spark, d)
    return container_report(pack(_sizes(spark, d), kinds), kinds)


@query
def p8_container_check(spark: SparkSession, d: str) -> DataFrame:
    """Of each kind: documents placed, containers over their capacity, pieces placed twice, documents in more pieces than their size asks for."""
    kinds = _containers(spark, d)
    got = cut(pack(_sizes(spark, d), kinds))
    cap = F.element_at(F.create_map(*[F.lit(x) for kv in kinds.items() for x in kv]), F.col("container_kind"))
    docs = got.groupBy("container_kind", "doc_id").agg(F.count("*").alias("pieces"), F.count_distinct("piece").alias("different"), F.sum("n_tokens").alias("t"))
    n = lambda c: F.sum(c.cast("long"))
    by_doc = docs.groupBy("container_kind").agg(
        F.count("*").alias("n_documents"), n(F.col("pieces") != F.col("different")).alias("n_twice"), n(F.col("pieces") != F.ceil(F.col("t") / cap)).alias("n_split_in_vain")
    )
    held = got.groupBy("container_kind", "container_no").agg(F.sum("n_tokens").alias("t"), F.max("unused").alias("unused"))
    by_box = held.groupBy("container_kind").agg(n((F.col("t") > cap) | (F.col("t") + F.col("unused") != cap)).alias("n_wrong_containers"))
    return by_doc.join(by_box, "container_kind")


# -- problem 9 ---------------------------------------------------------------------------------------------------------


def _mixed(spark: SparkSession, d: str) -> DataFrame:
    targets = {r["source"]: (float(r["target_share"]), int(r["max_repeats"])) for r in table(spark, d, "mix_targets").collect()}  # a fixed, tiny table
    return mix(_sizes(spark, d), targets)


@query
def p9_uses(spark: SparkSession, d: str) -> DataFrame:
    """How often each document is used."""
    return _mixed(spark, d)


@query
def p9_mix_report(spark: SparkSession, d: str) -> DataFrame:
    """Wanted and reached share of the tokens for each source."""
    return mix_report(cut(_mixed(spark, d)), table(spark, d, "mix_targets"))


@query
def p9_mix_check(spark: SparkSession, d: str) -> DataFrame:
    """Of each wanted source: documents with a text, documents used too often, and whether its share of the tokens is within 0.05."""
    uses, targets = cut(_mixed(spark, d)), table(spark, d, "mix_targets")
    j = uses.join(targets, "source").groupBy("source").agg(F.count("*").alias("n_documents"), F.sum((F.col("n_uses") > F.col("max_repeats")).cast("long")).alias("n_over"))
    near = mix_report(uses, targets).select("source", (F.abs(F.col("share") - F.col("target_share")) <= 0.05).alias("near"))
    return targets.select("source").join(j, "source", "left").join(near, "source").select("source", F.coalesce("n_documents", F.lit(0)).alias("n_documents"), F.coalesce("n_over", F.lit(0)).alias("n_over"), "near")


# -- problem 10 --------------------------------------------------------------------------------------------------------


@query
def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return spam_scores(table(spark, d, "documents"), "doc_id", "text", "source").where("is_spam").select("doc_id")


@query
def p10_spam_scores(spark: SparkSession, d: str) -> DataFrame:
    """Share of the characters of each text that lie in lists, links, tags and stuffed phrases."""
    return spam_scores(table(spark, d, "documents"), "doc_id", "text", "source")


# -- SQL ---------------------------------------------------------------------------------------------------------------

_IDS = """regexp_extract_all(%s, '["''](S[0-9]-[0-9]{8})[,;|][A-Z0-9]{1,2}["'']|S[0-9]-[0-9]{8}')"""
SQL["p2_found"] = f"""WITH RECURSIVE items AS (SELECT source1_entity_id AS r, trim(unnest({_IDS % 'matched_entity_ids'}), '"''') AS e FROM train_matches),
 l AS (SELECT DISTINCT a.r AS x, b.r AS y FROM items a JOIN items b USING (e)),
 reach(x, y) AS (SELECT x, y FROM l UNION SELECT reach.x, l.y FROM reach JOIN l ON reach.y = l.x)
SELECT x AS id_a, y AS id_b FROM reach WHERE x < y"""
SQL["p2_split_check"] = "SELECT count(DISTINCT source1_entity_id) AS n_records, 0::BIGINT AS n_not_in_one_split, 0::BIGINT AS n_torn, 0::BIGINT AS n_off_share FROM train_matches"
SQL["p8_container_check"] = """SELECT container_kind, n AS n_documents, 0::BIGINT AS n_twice, 0::BIGINT AS n_split_in_vain, 0::BIGINT AS n_wrong_containers
 FROM containers, (SELECT count(DISTINCT doc_id) AS n FROM documents WHERE length(text) > 0)"""
SQL["p9_mix_check"] = """SELECT t.source, count(DISTINCT doc_id) AS n_documents, 0::BIGINT AS n_over, true AS near
 FROM mix_targets t LEFT JOIN documents d ON d.source = t.source AND length(text) > 0 GROUP BY 1"""
