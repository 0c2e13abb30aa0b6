"""Queries of the linkage operators over train_source1 (the reference side) and train_source2, train_source3 (the targets).

Where a query has SQL it uses the `latin` transliteration, which both engines can express; those over the full romanization have none and
are tested against brute force. Pair queries take the pairs listed in candidate_pairs; truth is train_matches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinlink.functions import similarity as sim
from kinlink.functions import text as tx
from kinlink.functions.translit import romanize_col, unicode_normalize_col
from kinlink.operators import blocking as bl
from kinlink.operators import datasets as ds
from kinlink.operators import diagnose as dg
from kinlink.operators import evaluate as ev
from kinlink.operators import pairs as pr
from kinlink.operators.features import entities, entity_features, normalized, target_union, with_sets
from kinlink.operators.packed import unpack
from kinlink.operators.probing import key_index, met, probed
from kinlink.plans import linkage_sql as q
from kinlink.plans import model as md
from kinlink.plans.general import ID_PATTERN, ID_SUFFIX
from kinlink.session import cut, ensure_checkpoint_dir, remove, stored, table
from kinlink.sources import paths, tsv

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
MODE = "latin"
LOW_CAP = 50


def query(name: str, sql: str | None = None):
    def wrap(f):
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return wrap


# -- inputs ------------------------------------------------------------------------------------------------------------


def s1_entities(spark: SparkSession, d: str) -> DataFrame:
    return entities(table(spark, d, "train_source1"))


def target_entities(spark: SparkSession, d: str) -> DataFrame:
    return target_union(table(spark, d, "train_source2"), table(spark, d, "train_source3"))


def both_features(spark: SparkSession, d: str, mode: str = MODE) -> tuple[DataFrame, DataFrame]:
    return with_sets(stored(normalized(s1_entities(spark, d), mode))), with_sets(stored(normalized(target_entities(spark, d), mode)))


def _listed(spark: SparkSession, d: str, name: str, column: str) -> DataFrame:
    got = unpack(table(spark, d, name), column, ["source1_entity_id"], ID_PATTERN, ID_SUFFIX, value_name="target_id")
    return got.select(F.col("source1_entity_id").alias("s1_id"), "target_id").distinct()


def truth(spark: SparkSession, d: str) -> DataFrame:
    return _listed(spark, d, "train_matches", "matched_entity_ids")


def listed_pairs(spark: SparkSession, d: str) -> DataFrame:
    return _listed(spark, d, "candidate_pairs", "candidate_entity_ids")


# -- scalar functions --------------------------------------------------------------------------------------------------


def _scalar(name: str, column: str, make: Callable[[Column], Column], sql: str | None) -> None:
    """One row for each row of train_source1: its position and the value."""

    def run(spark: SparkSession, d: str) -> DataFrame:
        return table(spark, d, "train_source1").select("pos", make(F.col(column)).alias("value"))

    query(name, None if sql is None else f"SELECT pos, {sql} AS value FROM train_source1")(run)


def _sets(c: Column) -> Column:
    return F.array_join(F.array_sort(c), " ")


_N, _A = q.norm("business_name"), q.norm("business_address")
_name, _address = (lambda c: tx.normalize_name(c, MODE)), (lambda c: tx.normalize_address(c, MODE))
_scalar("unicode_normalize", "business_name", unicode_normalize_col, None)
_scalar("transliterate", "business_name", romanize_col, None)
_scalar("normalize_text_full", "business_name", lambda c: tx.normalize_text(c, "full"), None)
_scalar("normalize_text", "business_name", lambda c: tx.normalize_text(c, MODE), _N)
_scalar("normalize_name", "business_name", _name, _N)
_scalar("normalize_address", "business_address", _address, _A)
_scalar("normalize_country", "country", lambda c: tx.normalize_country(c, MODE), q.country("country"))
_scalar("normalize_name_core", "business_name", lambda c: tx.normalize_name_core(_name(c)), q.core(_N))
_scalar("tokens", "business_name", lambda c: _sets(tx.tokens(_name(c))), q.show(q.toks(_N)))
_scalar("address_tokens", "business_address", lambda c: _sets(tx.address_tokens(_address(c))), q.show(q.addr_toks(_A)))
_scalar("address_location_tokens", "business_address", lambda c: _sets(tx.address_location_tokens(_address(c))), q.show(q.loc_toks(_A)))
_scalar("numeric_tokens", "business_address", lambda c: _sets(tx.numeric_tokens(_address(c))), q.show(q.nums(_A)))
_scalar("char_ngrams", "business_name", lambda c: _sets(tx.char_ngrams(_name(c))), q.show(q.grams(_N)))
_scalar("token_pairs", "business_name", lambda c: _sets(tx.token_pairs(tx.tokens(_name(c)))), q.show(q.pairs_of(q.toks(_N))))
@query("is_ascii_name", "SELECT pos, CASE WHEN regexp_matches(regexp_replace(coalesce(business_name, ''), '[ \\t\\n\\x0B\\f\\r]+', '', 'g'), '[^\\x00-\\x7F]') THEN 0 ELSE 1 END AS value FROM train_source1")
def is_ascii_name(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "train_source1").select("pos", tx.is_ascii_name("business_name").cast("int").alias("value"))


def _list_query(name: str, make: Callable[[str], Column], sql: str) -> None:
    def run(spark: SparkSession, d: str) -> DataFrame:
        return table(spark, d, "train_matches").select("pos", F.array_join(make("matched_entity_ids"), "#").alias("value"))

    query(name, f"SELECT pos, array_to_string({sql}, '#') AS value FROM train_matches")(run)


_STRIPPED = "list_filter(list_transform(string_split(coalesce(matched_entity_ids, ''), ','), lambda x: regexp_replace(regexp_replace(x, '^[ \\t\\n\\x0B\\f\\r]+', ''), '[ \\t\\n\\x0B\\f\\r]+$', '')), lambda x: x <> '')"
_list_query("split_ids", lambda c: F.array_sort(tx.split_ids(c)), f"list_sort(list_distinct({_STRIPPED}))")
_list_query("split_ids_list", tx.split_ids_list, _STRIPPED)
_list_query("parse_truth", tx.parse_truth_ids, "list_filter(string_split(coalesce(matched_entity_ids, ''), ','), lambda x: x <> '')")


@query("parse_truth_last", "SELECT source1_entity_id AS s1_id, array_to_string(list_filter(string_split(coalesce(m, ''), ','), lambda x: x <> ''), '#') AS ids FROM (SELECT DISTINCT ON (source1_entity_id) source1_entity_id, matched_entity_ids AS m FROM train_matches ORDER BY source1_entity_id, pos DESC)")
def parse_truth_last(spark: SparkSession, d: str) -> DataFrame:
    """Ids stated in several rows: the last row counts."""
    m = pr.dedup_last(table(spark, d, "train_matches"), "source1_entity_id")
    return m.select(F.col("source1_entity_id").alias("s1_id"), F.array_join(tx.parse_truth_ids("matched_entity_ids"), "#").alias("ids"))


@query("show_normalization")
def show_normalization(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "train_source1").select("pos", F.coalesce("business_name", F.lit("")).alias("original"))
    s = s.withColumn("transliterated", romanize_col(F.col("original")))
    s = s.withColumn("normalized", tx.normalize_text("transliterated", "identity"))
    return s.withColumn("core", tx.normalize_name_core("normalized"))


# -- pair similarity ---------------------------------------------------------------------------------------------------

_PAIR_CTE = f"WITH {q.FEATS}, p AS ({q.LISTED}), j AS (SELECT p.s1_id, p.target_id, a.name AS an, b.name AS bn, a.core AS ac, b.core AS bc, a.address AS aa, b.address AS ba, a.country_raw AS acr, b.country_raw AS bcr, a.numbers AS anu, b.numbers AS bnu, a.grams AS ag, b.grams AS bg FROM p JOIN {q.first('s')} a ON a.id = p.s1_id JOIN {q.first('t')} b ON b.id = p.target_id)"


def _pairs_with(spark: SparkSession, d: str, **values) -> DataFrame:
    a, b = both_features(spark, d)
    j = pr.lookup_join(listed_pairs(spark, d), pr.pair_inputs(a), pr.pair_inputs(b))
    return j.select("s1_id", "target_id", *[v.alias(k) for k, v in values.items()])


def _pair_query(name: str, make: Callable[[], dict[str, Column]], sql: str) -> None:
    query(name, f"{_PAIR_CTE} SELECT s1_id, target_id, {sql} FROM j")(lambda spark, d: _pairs_with(spark, d, **make()))


def _r(c: Column) -> Column:
    return F.round(c, 6)


_pair_query("jaccard", lambda: {"value": _r(sim.jaccard("a_numbers", "b_numbers"))}, f"round({q.jaccard('anu', 'bnu')}, 6) AS value")
_pair_query("token_jaccard", lambda: {"value": _r(sim.jaccard("a_name_tokens", "b_name_tokens"))}, f"round({q.jaccard(q.toks('an'), q.toks('bn'))}, 6) AS value")
_pair_query("char_ngram_jaccard", lambda: {"value": _r(sim.jaccard("a_grams", "b_grams"))}, f"round({q.jaccard('ag', 'bg')}, 6) AS value")
_pair_query("indel_ratio", lambda: {"value": _r(sim.indel_ratio("a_name", "b_name"))}, f"round({q.indel('an', 'bn')}, 6) AS value")
_pair_query("len_diff", lambda: {"value": sim.len_diff("a_name", "b_name").cast("int")}, "abs(length(an) - length(bn))::INT AS value")
_pair_query("exact_eq", lambda: {"name_eq": sim.exact_eq("a_name", "b_name"), "address_eq": sim.exact_eq("a_address", "b_address")}, "(an = bn)::INT AS name_eq, (aa = ba)::INT AS address_eq")
_pair_query("country_equal_raw", lambda: {"value": sim.country_equal_raw("a_country_raw", "b_country_raw")}, "(acr = bcr)::INT AS value")


_SETS_SQL = f"""{_PAIR_CTE}, x AS (SELECT s1_id, target_id, {q.toks('an')} AS x, {q.toks('bn')} AS y FROM j),
 y AS (SELECT s1_id, target_id, len(x) AS nx, len(y) AS ny, {q.show('list_intersect(x, y)')} AS c, {q.show('list_filter(x, lambda t: NOT list_contains(y, t))')} AS oa, {q.show('list_filter(y, lambda t: NOT list_contains(x, t))')} AS ob FROM x),
 z AS (SELECT *, length(c)::DOUBLE AS n, (c <> '')::INT::DOUBLE AS gap, length(oa)::DOUBLE AS p, length(ob)::DOUBLE AS r, CASE WHEN oa = '' OR ob = '' THEN 0 ELSE {q.lcs('oa', 'ob')} END::DOUBLE AS l FROM y),
 w AS (SELECT *, n + gap + p AS la, n + gap + r AS lb FROM z)
SELECT s1_id, target_id, round(CASE WHEN nx = 0 OR ny = 0 THEN 0.0::DOUBLE WHEN c <> '' AND (oa = '' OR ob = '') THEN 1.0::DOUBLE WHEN c = '' THEN 1.0::DOUBLE - (p + r - 2.0::DOUBLE * l) / (la + lb)
 ELSE greatest(1.0::DOUBLE - (p + r - 2.0::DOUBLE * l) / (la + lb), 1.0::DOUBLE - (gap + p) / (n + la), 1.0::DOUBLE - (gap + r) / (n + lb)) END, 6) AS value FROM w"""


@query("token_set_ratio", _SETS_SQL)
def token_set_ratio(spark: SparkSession, d: str) -> DataFrame:
    return _pairs_with(spark, d, value=_r(sim.token_set_ratio("a_name", "b_name")))


_FEATURE_SQL = {
    "country_equal": "(acr = bcr)::INT::DOUBLE", "name_exact": "(an = bn)::INT::DOUBLE", "name_core_exact": "(ac = bc)::INT::DOUBLE",
    "name_ratio": q.indel("an", "bn"), "name_core_ratio": q.indel("ac", "bc"), "name_jaccard": q.jaccard(q.toks("an"), q.toks("bn")), "name_char_jaccard": q.jaccard("ag", "bg"),
    "address_exact": "(aa = ba)::INT::DOUBLE", "address_ratio": q.indel("aa", "ba"), "address_jaccard": q.jaccard(q.toks("aa"), q.toks("ba")),
    "address_char_jaccard": q.jaccard(f"({q.grams('aa')})", f"({q.grams('ba')})"), "numeric_overlap": q.jaccard("anu", "bnu"),
    "name_len_diff": "abs(length(an) - length(bn))::DOUBLE", "address_len_diff": "abs(length(aa) - length(ba))::DOUBLE",
}


@query("pair_features", f"{_PAIR_CTE} SELECT s1_id, target_id, " + ", ".join(f"round({v}, 6) AS {k}" for k, v in _FEATURE_SQL.items()) + " FROM j")
def pair_features(spark: SparkSession, d: str) -> DataFrame:
    """All features but the word-set ratio, which has a query of its own."""
    a, b = both_features(spark, d)
    f = pr.pair_features(listed_pairs(spark, d), a, b)
    return f.select("s1_id", "target_id", *[F.round(k, 6).alias(k) for k in _FEATURE_SQL])


@query("clean_features", f"{_PAIR_CTE} SELECT s1_id, target_id, round(CASE WHEN length(bn) = 0 THEN 0.0::DOUBLE ELSE length(an)::DOUBLE / length(bn)::DOUBLE END, 6) AS ratio, 0.0::DOUBLE AS absent FROM j")
def clean_features(spark: SparkSession, d: str) -> DataFrame:
    """A ratio that is infinite or undefined for empty names, and a column that is not there."""
    n, m = F.length("a_name").cast("double"), F.length("b_name").cast("double")
    ratio = F.when(m > 0, n / F.greatest(m, F.lit(1.0))).when(n > 0, F.lit(float("inf"))).otherwise(F.lit(float("nan")))
    return pr.clean_features(_pairs_with(spark, d, ratio=ratio), ["ratio", "absent"]).select("s1_id", "target_id", F.round("ratio", 6).alias("ratio"), "absent")


@query("label_join", f"SELECT p.s1_id, p.target_id, (t.s1_id IS NOT NULL)::INT AS label FROM ({q.LISTED}) p LEFT JOIN ({q.TRUTH}) t USING (s1_id, target_id)")
def label_join(spark: SparkSession, d: str) -> DataFrame:
    return pr.label_join(listed_pairs(spark, d), truth(spark, d))


@query("lookup_join", f"WITH s AS ({q.S1_ENTS}), t AS ({q.T_ENTS}), p AS ({q.LISTED}) SELECT p.s1_id, p.target_id, a.name AS s1_name, b.name AS target_name FROM p JOIN {q.first('s')} a ON a.id = p.s1_id JOIN {q.first('t')} b ON b.id = p.target_id")
def lookup_join(spark: SparkSession, d: str) -> DataFrame:
    a, b = pr.dedup_first(s1_entities(spark, d), "id"), pr.dedup_first(target_entities(spark, d), "id")
    return pr.lookup_join(listed_pairs(spark, d), a, b).select("s1_id", "target_id", F.col("a_name").alias("s1_name"), F.col("b_name").alias("target_name"))


# -- blocking ----------------------------------------------------------------------------------------------------------


def _config(families=None, cap: int | None = None, version: int = 1) -> bl.BlockingConfig:
    c = bl.BlockingConfig(version=version, families=families, mode=MODE)
    return c.with_cap(cap) if cap else c


def _per_record(pairs: DataFrame) -> DataFrame:
    """Candidates of each record in brief: how many, and the sum of their positions."""
    return pairs.groupBy("s1_pos").agg(F.count("*").alias("n"), F.sum("t_pos").alias("t_pos_sum"))


_BRIEF = "SELECT s1_pos, count(*) AS n, sum(t_pos)::BIGINT AS t_pos_sum FROM {} GROUP BY 1"


def _block_query(family: int, cap: int | None) -> None:
    def run(spark: SparkSession, d: str) -> DataFrame:
        a, b = both_features(spark, d)
        return _per_record(bl.hits_by_family(a, b, _config((family,), cap)))

    query(f"block_{bl.FAMILIES[family]}" + (f"_cap{cap}" if cap else ""), f"{q.hits((family,), cap)} {_BRIEF.format('hits')}")(run)


for _f in range(9):
    _block_query(_f, None)
    if _f >= bl.NAME_TOKEN:
        _block_query(_f, LOW_CAP)

V1, V2 = bl.BlockingConfig(version=1).active(), bl.BlockingConfig(version=2).active()


def _union_query(name: str, version: int, cap: int | None) -> None:
    def run(spark: SparkSession, d: str) -> DataFrame:
        config = _config(None, cap, version)
        return probed(key_index(*both_features(spark, d), config), config, "brief")

    query(name, f"{q.hits(V1 if version == 1 else V2, cap)}, {q.CANDIDATES} {_BRIEF.format('cand')}")(run)


_union_query("block_union", 1, None)
_union_query("block_union_v2", 2, None)
_union_query(f"block_union_cap{LOW_CAP}", 1, LOW_CAP)


_NAMED = "SELECT s.id AS s1_id, target_id, min(s1_pos) AS s1_pos, min(t_pos) AS t_pos FROM cand JOIN s ON s.pos = s1_pos GROUP BY 1, 2"


def _candidates_query(name: str, cap: int | None) -> None:
    def run(spark: SparkSession, d: str) -> DataFrame:
        a, b = both_features(spark, d)
        return bl.generate_candidates(a, b, _config(None, cap))

    query(name, f"{q.hits(V1, cap)}, {q.CANDIDATES} {_NAMED}")(run)


_candidates_query("generate_candidates", None)
_candidates_query(f"generate_candidates_cap{LOW_CAP}", LOW_CAP)


@query("generate_candidates_full")
def generate_candidates_full(spark: SparkSession, d: str) -> DataFrame:
    """Default caps and the full romanization."""
    a, b = both_features(spark, d, "full")
    return bl.generate_candidates(a, b, bl.BlockingConfig(version=2))


def _debug_query(name: str, cap: int | None) -> None:
    def run(spark: SparkSession, d: str) -> DataFrame:
        a, b = both_features(spark, d)
        return bl.debug_info(a, b, _config(None, cap))

    each = ", ".join(f"count(DISTINCT CASE WHEN family = {f} THEN t_pos END) AS {bl.FAMILIES[f]}" for f in V1)
    query(name, f"{q.hits(V1, cap)} SELECT s.pos AS s1_pos, {each}, count(DISTINCT t_pos) AS total FROM s LEFT JOIN hits ON hits.s1_pos = s.pos GROUP BY 1")(run)


_debug_query("agg_debug_info", None)
_debug_query(f"agg_debug_info_cap{LOW_CAP}", LOW_CAP)


_TP = f"WITH t AS MATERIALIZED ({q.feats(q.T_ENTS)}), tp AS ({q.postings('t', range(9))}), df AS (SELECT family, country, key, count(*) AS n FROM tp GROUP BY ALL)"


def _frequency(spark: SparkSession, d: str) -> DataFrame:
    return bl.key_frequency(bl.postings(cut(entity_features(target_entities(spark, d), MODE)), tuple(range(9))))


@query("agg_key_frequency", f"{_TP} SELECT family, country, count(*) AS n_keys, sum(n)::BIGINT AS n_postings, max(n) AS max_df FROM df GROUP BY 1, 2")
def agg_key_frequency(spark: SparkSession, d: str) -> DataFrame:
    return _frequency(spark, d).groupBy("family", "country").agg(F.count("*").alias("n_keys"), F.sum("df").alias("n_postings"), F.max("df").alias("max_df"))


@query("filter_df_cap", f"{_TP} SELECT family, count(*) AS n_keys, sum(n)::BIGINT AS n_postings FROM df WHERE n <= CASE family " + " ".join(f"WHEN {f} THEN {LOW_CAP}" for f in bl.DEFAULT_CAPS) + " ELSE 1000000000 END GROUP BY 1")
def filter_df_cap(spark: SparkSession, d: str) -> DataFrame:
    return bl.capped(_frequency(spark, d), _config(None, LOW_CAP)).groupBy("family").agg(F.count("*").alias("n_keys"), F.sum("df").alias("n_postings"))


@query("agg_shared_count", f"{q.hits((8,))}, n AS (SELECT s1_pos, t_pos, count(*) AS n FROM shared GROUP BY 1, 2) SELECT hits.s1_pos, hits.t_pos, n::INT AS shared FROM hits JOIN n ON n.s1_pos = hits.s1_pos AND n.t_pos = hits.t_pos")
def agg_shared_count(spark: SparkSession, d: str) -> DataFrame:
    """Shared rare grams of the pairs that have enough of them."""
    a, b = both_features(spark, d)
    return bl.ngram_hits(a, b, _config((bl.NGRAM,)))


@query("filter_min_shared", f"SELECT pos, CASE WHEN g <= 4 THEN 1 ELSE greatest(2, ceil(g::DOUBLE * 0.3::DOUBLE)::INT) END AS required FROM (SELECT pos, len({q.grams(_N)}) AS g FROM train_source1)")
def filter_min_shared(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "train_source1").select("pos", F.size(tx.char_ngrams(tx.normalize_name("business_name", MODE))).alias("g"))
    return s.select("pos", bl.required_grams(F.col("g")).alias("required"))


@query("filter_min_len", f"SELECT pos, {q.show('list_filter(' + q.toks(_N) + ', lambda t: length(t) >= 3)')} AS value FROM train_source1")
def filter_min_len(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "train_source1").select("pos", _sets(tx.name_block_tokens(tx.normalize_name("business_name", MODE))).alias("value"))


# -- evaluation --------------------------------------------------------------------------------------------------------

def _metrics_sql(candidates: str, before: str = "WITH") -> str:
    return f"""{before} c AS ({candidates}), g AS ({q.TRUTH}), ids AS (SELECT entity_id AS s1_id FROM train_source1),
 n AS (SELECT s1_id, count(*) AS n FROM c GROUP BY 1), gt AS (SELECT s1_id, count(*) AS gt FROM g GROUP BY 1), h AS (SELECT s1_id, count(*) AS hit FROM c JOIN g USING (s1_id, target_id) GROUP BY 1),
 j AS (SELECT coalesce(n, 0) AS n, coalesce(gt, 0) AS gt, coalesce(hit, 0) AS hit FROM ids LEFT JOIN n USING (s1_id) LEFT JOIN gt USING (s1_id) LEFT JOIN h USING (s1_id)),
 a AS (SELECT count(*) AS n_s1, sum(n)::BIGINT AS candidate_pairs, avg(n) AS mean_candidates, median(n)::DOUBLE AS median_candidates, max(n) AS max_candidates, count(*) FILTER (n = 0) AS zero_candidates,
   sum(gt)::BIGINT AS gt_pairs, sum(hit)::BIGINT AS gt_found, count(*) FILTER (hit > 0) AS any_match, count(*) FILTER (gt > 0 AND hit = gt) AS all_match FROM j),
 nt AS (SELECT (SELECT count(*) FROM train_source2) + (SELECT count(*) FROM train_source3) AS nt)
SELECT n_s1, candidate_pairs, round(mean_candidates, 6) AS mean_candidates, median_candidates, max_candidates, zero_candidates, gt_pairs, gt_found, any_match, all_match,
 round(CASE WHEN gt_pairs > 0 THEN gt_found::DOUBLE / gt_pairs::DOUBLE ELSE 0.0 END, 6) AS match_recall, round(any_match::DOUBLE / n_s1::DOUBLE, 6) AS any_recall, round(all_match::DOUBLE / n_s1::DOUBLE, 6) AS all_recall,
 round(1.0::DOUBLE - candidate_pairs::DOUBLE / (n_s1::DOUBLE * nt::DOUBLE), 9) AS reduction FROM a, nt"""


_ENGINE = f"{q.hits(V1)}, {q.CANDIDATES},"
_ENGINE_PAIRS = "SELECT DISTINCT s.id AS s1_id, target_id FROM cand JOIN s ON s.pos = s1_pos"


def _rounded(m: DataFrame) -> DataFrame:
    return m.select(*[F.round(c, 9 if c == "reduction" else 6).alias(c) if t == "double" and c != "median_candidates" else F.col(c) for c, t in m.dtypes])


def _engine(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Key numbers for the engine's own candidates: version 1, default caps."""
    return key_index(*both_features(spark, d), _config())


@query("agg_blocking_metrics", _metrics_sql(q.LISTED))
def agg_blocking_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Of the delivered candidate lists."""
    return _rounded(ev.blocking_metrics(s1_entities(spark, d).select("id"), target_entities(spark, d).select("pos"), listed_pairs(spark, d), truth(spark, d)))


@query("pipeline_blocking_metrics", _metrics_sql(_ENGINE_PAIRS, _ENGINE))
def pipeline_blocking_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Recall, reduction and candidates per record of the engine's own blocking at the default caps."""
    index, true = _engine(spark, d), truth(spark, d)
    return _rounded(ev.metrics_of_counts(s1_entities(spark, d).select("id"), target_entities(spark, d).select("pos"), probed(index, _config(), "ids"), true, met(true, index)))


def _lists(pairs: DataFrame, records: DataFrame) -> DataFrame:
    got = pairs.groupBy("s1_id").agg(F.collect_set("target_id").alias("ids"))
    return records.select("s1_id").distinct().join(got, "s1_id", "left").select("s1_id", F.coalesce("ids", F.array().cast("array<string>")).alias("ids"))


def _truth_and_predicted(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    t = table(spark, d, "train_matches").select(F.col("source1_entity_id").alias("s1_id"))
    return _lists(truth(spark, d), t), listed_pairs(spark, d).groupBy("s1_id").agg(F.collect_set("target_id").alias("ids"))


def _fb_sql(candidates: str, before: str = "WITH") -> str:
    return f"""{before} g AS ({q.TRUTH}), c AS ({candidates}), i AS (SELECT DISTINCT source1_entity_id AS s1_id FROM train_matches),
 x AS (SELECT s1_id, coalesce(nt, 0)::DOUBLE AS t, coalesce(np, 0)::DOUBLE AS p, coalesce(nb, 0)::DOUBLE AS b FROM i LEFT JOIN (SELECT s1_id, count(*) AS nt FROM g GROUP BY 1) USING (s1_id)
   LEFT JOIN (SELECT s1_id, count(*) AS np FROM c GROUP BY 1) USING (s1_id) LEFT JOIN (SELECT s1_id, count(*) AS nb FROM c JOIN g USING (s1_id, target_id) GROUP BY 1) USING (s1_id)),
 f AS (SELECT s1_id, CASE WHEN t = 0 AND p = 0 THEN 1.0::DOUBLE WHEN t = 0 OR p = 0 OR b = 0 THEN 0.0::DOUBLE ELSE 1.25::DOUBLE * (b / p) * (b / t) / (0.25::DOUBLE * (b / p) + b / t) END AS f FROM x)"""


_FB = _fb_sql(q.LISTED)


@query("agg_entity_fbeta", f"{_FB} SELECT s1_id, round(f, 6) AS f FROM f")
def agg_entity_fbeta(spark: SparkSession, d: str) -> DataFrame:
    return ev.entity_fbeta(*_truth_and_predicted(spark, d)).select("s1_id", F.round("f", 6).alias("f"))


@query("agg_macro_fbeta", f"{_FB} SELECT round(avg(f), 6) AS macro_f, count(*) AS n FROM f")
def agg_macro_fbeta(spark: SparkSession, d: str) -> DataFrame:
    return ev.macro_fbeta(*_truth_and_predicted(spark, d)).select(F.round("macro_f", 6).alias("macro_f"), "n")


@query("pipeline_blocking_macro_fbeta", f"{_fb_sql(_ENGINE_PAIRS, _ENGINE)} SELECT round(avg(f), 6) AS macro_f, count(*) AS n FROM f")
def pipeline_blocking_macro_fbeta(spark: SparkSession, d: str) -> DataFrame:
    """Macro F0.5 if every candidate of the engine's blocking were taken for a match."""
    index, true = _engine(spark, d), truth(spark, d)
    ids = table(spark, d, "train_matches").select(F.col("source1_entity_id").alias("s1_id")).distinct()
    f = ev.fbeta_of_counts(ids, true, probed(index, _config(), "ids"), met(true, index))
    return f.agg(F.avg("f").alias("macro_f"), F.count("*").alias("n")).select(F.round("macro_f", 6).alias("macro_f"), "n")


@query("fbeta", f"WITH x AS (SELECT s1_id, count(*)::DOUBLE AS n FROM ({q.LISTED}) GROUP BY 1) SELECT s1_id, round(CASE WHEN n > 8 THEN 0.0::DOUBLE ELSE 1.25::DOUBLE * (1.0::DOUBLE / n) * 0.5::DOUBLE / (0.25::DOUBLE * (1.0::DOUBLE / n) + 0.5::DOUBLE) END, 6) AS f FROM x")
def fbeta(spark: SparkSession, d: str) -> DataFrame:
    """The column function on a precision of 1 / candidates and a recall of 0.5, both 0 beyond eight candidates."""
    x = listed_pairs(spark, d).groupBy("s1_id").agg(F.count("*").cast("double").alias("n"))
    zero = F.col("n") > 8
    f = sim.fbeta(F.when(zero, F.lit(0.0)).otherwise(1.0 / F.col("n")), F.when(zero, F.lit(0.0)).otherwise(F.lit(0.5)))
    return x.select("s1_id", F.round(f, 6).alias("f"))


@query("agg_class_balance", f"WITH l AS (SELECT (t.s1_id IS NOT NULL)::INT AS label FROM ({q.LISTED}) p LEFT JOIN ({q.TRUTH}) t USING (s1_id, target_id)) SELECT sum(label)::BIGINT AS positives, sum(1 - label)::BIGINT AS negatives, round(CASE WHEN sum(label) > 0 THEN sum(1 - label)::DOUBLE / sum(label)::DOUBLE ELSE 1.0 END, 6) AS weight FROM l")
def agg_class_balance(spark: SparkSession, d: str) -> DataFrame:
    return ev.class_balance(label_join(spark, d)).withColumn("weight", F.round("weight", 6))


@query("agg_collect_ids", f"WITH t AS ({q.T_ENTS}), o AS (SELECT id, min(pos) AS pos FROM t GROUP BY 1) SELECT s1_id, string_agg(target_id, ',' ORDER BY o.pos, target_id) AS ids FROM ({q.LISTED}) p JOIN o ON o.id = target_id GROUP BY 1")
def agg_collect_ids(spark: SparkSession, d: str) -> DataFrame:
    at = target_entities(spark, d).groupBy(F.col("id").alias("target_id")).agg(F.min("pos").alias("t_pos"))
    return pr.collect_ids(listed_pairs(spark, d).join(at, "target_id"), "s1_id", "target_id", "t_pos")


@query("agg_distinct", f"SELECT s1_id, target_id FROM ({q.LISTED})")
def agg_distinct(spark: SparkSession, d: str) -> DataFrame:
    return listed_pairs(spark, d)


@query("agg_counts_report", " UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS n FROM {t}" for t in ("train_source1", "train_source2", "train_source3", "train_matches", "candidate_pairs")))
def agg_counts_report(spark: SparkSession, d: str) -> DataFrame:
    parts = [table(spark, d, t).agg(F.count("*").alias("n")).select(F.lit(t).alias("name"), "n") for t in ("train_source1", "train_source2", "train_source3", "train_matches", "candidate_pairs")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# -- filters, joins and set operations ---------------------------------------------------------------------------------


@query("filter_nonempty_id", "SELECT pos, source1_entity_id FROM train_matches WHERE length(coalesce(source1_entity_id, '')) > 0 AND length(coalesce(matched_entity_ids, '')) > 0")
def filter_nonempty_id(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "train_matches").where(ds.nonempty("source1_entity_id") & ds.nonempty("matched_entity_ids")).select("pos", "source1_entity_id")


@query("filter_prefix", f"SELECT s1_id, target_id FROM ({q.LISTED}) WHERE starts_with(target_id, 'S3-')")
def filter_prefix(spark: SparkSession, d: str) -> DataFrame:
    return listed_pairs(spark, d).where(ds.from_source("target_id", "S3-"))


@query("semi_in", f"SELECT pos, entity_id FROM train_source2 WHERE entity_id IN (SELECT target_id FROM ({q.TRUTH}))")
def semi_in(spark: SparkSession, d: str) -> DataFrame:
    return ds.semi_in(table(spark, d, "train_source2"), truth(spark, d).select(F.col("target_id").alias("entity_id")), "entity_id").select("pos", "entity_id")


@query("anti_in", f"SELECT pos, entity_id FROM train_source2 WHERE entity_id NOT IN (SELECT target_id FROM ({q.TRUTH}))")
def anti_in(spark: SparkSession, d: str) -> DataFrame:
    return ds.anti_in(table(spark, d, "train_source2"), truth(spark, d).select(F.col("target_id").alias("entity_id")), "entity_id").select("pos", "entity_id")


@query("anti_append", f"SELECT DISTINCT target_id FROM ({q.TRUTH}) WHERE target_id NOT IN (SELECT entity_id FROM train_source2)")
def anti_append(spark: SparkSession, d: str) -> DataFrame:
    """Ids that are wanted and not yet there."""
    have = table(spark, d, "train_source2").select(F.col("entity_id").alias("target_id"))
    return ds.anti_in(truth(spark, d).select("target_id").distinct(), have, "target_id")


@query("pair_anti_candidates", f"SELECT g.s1_id, g.target_id FROM ({q.TRUTH}) g ANTI JOIN ({q.LISTED}) c ON c.s1_id = g.s1_id AND c.target_id = g.target_id WHERE g.s1_id IN (SELECT entity_id FROM train_source1) AND g.target_id IN (SELECT entity_id FROM train_source2 UNION ALL SELECT entity_id FROM train_source3)")
def pair_anti_candidates(spark: SparkSession, d: str) -> DataFrame:
    t = ds.semi_in(truth(spark, d), s1_entities(spark, d).select(F.col("id").alias("s1_id")), "s1_id")
    t = ds.semi_in(t, target_entities(spark, d).select(F.col("id").alias("target_id")), "target_id")
    return t.join(listed_pairs(spark, d), ["s1_id", "target_id"], "left_anti").select("s1_id", "target_id")


@query("left_lookup", f"SELECT s.pos, s.entity_id, coalesce(n, 0) AS n_true FROM train_source1 s LEFT JOIN (SELECT s1_id, count(*) AS n FROM ({q.TRUTH}) GROUP BY 1) t ON t.s1_id = s.entity_id")
def left_lookup(spark: SparkSession, d: str) -> DataFrame:
    n = truth(spark, d).groupBy(F.col("s1_id").alias("entity_id")).agg(F.count("*").alias("n"))
    return table(spark, d, "train_source1").select("pos", "entity_id").join(n, "entity_id", "left").select("pos", "entity_id", F.coalesce("n", F.lit(0)).alias("n_true"))


@query("scan_chunked_lookup", f"SELECT pos, entity_id, business_name FROM train_source3 WHERE entity_id IN (SELECT target_id FROM ({q.TRUTH}))")
def scan_chunked_lookup(spark: SparkSession, d: str) -> DataFrame:
    return ds.semi_in(table(spark, d, "train_source3"), truth(spark, d).select(F.col("target_id").alias("entity_id")), "entity_id").select("pos", "entity_id", "business_name")


@query("filter_gt_available", f"WITH x AS (SELECT source1_entity_id, pos, string_split(coalesce(matched_entity_ids, ''), ',') AS l FROM train_matches), y AS (SELECT source1_entity_id, pos, unnest(range(1, len(l) + 1)) AS k, l FROM x), z AS (SELECT source1_entity_id, pos, k, trim(l[k], E' \\t\\n\\r') AS id FROM y) SELECT source1_entity_id, pos, string_agg(id, ',' ORDER BY k) AS matched_entity_ids FROM z WHERE id IN (SELECT entity_id FROM train_source2) GROUP BY 1, 2")
def filter_gt_available(spark: SparkSession, d: str) -> DataFrame:
    return ds.gt_available(table(spark, d, "train_matches"), table(spark, d, "train_source2"))


@query("sort_by_id", "SELECT entity_id, pos FROM train_source1 ORDER BY entity_id, pos")
def sort_by_id(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "train_source1").select("entity_id", "pos").orderBy("entity_id", "pos")


@query("sort_positions", f"{q.hits((0,))}, {q.CANDIDATES} SELECT s1_pos, t_pos FROM cand ORDER BY s1_pos, t_pos")
def sort_positions(spark: SparkSession, d: str) -> DataFrame:
    a, b = both_features(spark, d)
    return bl.candidate_positions(a, b, _config((bl.EXACT_NAME,))).select("s1_pos", "t_pos").orderBy("s1_pos", "t_pos")


@query("limit_head", "SELECT pos, source1_entity_id FROM train_matches ORDER BY pos LIMIT 500")
def limit_head(spark: SparkSession, d: str) -> DataFrame:
    return ds.limit_head(table(spark, d, "train_matches").select("pos", "source1_entity_id"), "pos", 500)


@query("sample_n")
def sample_n(spark: SparkSession, d: str) -> DataFrame:
    return ds.sample_n(table(spark, d, "train_source2").select("pos", "entity_id"), "pos", 1000)


@query("union_all", f"SELECT pos, id FROM ({q.T_ENTS})")
def union_all(spark: SparkSession, d: str) -> DataFrame:
    return target_entities(spark, d).select("pos", "id")


def _dedup_sql(order: str) -> str:
    return f"SELECT DISTINCT ON (id) pos, id, name, country FROM ({q.T_ENTS}) ORDER BY id, pos {order}"


@query("dedup_first", _dedup_sql("ASC"))
def dedup_first(spark: SparkSession, d: str) -> DataFrame:
    return pr.dedup_first(target_entities(spark, d).select("pos", "id", "name", "country"), "id")


@query("dedup_last", _dedup_sql("DESC"))
def dedup_last(spark: SparkSession, d: str) -> DataFrame:
    return pr.dedup_last(target_entities(spark, d).select("pos", "id", "name", "country"), "id")


@query("set_difference", f"{_PAIR_CTE} SELECT s1_id, target_id, {q.show('list_intersect(' + q.toks('an') + ', ' + q.toks('bn') + ')')} AS common FROM j")
def set_difference(spark: SparkSession, d: str) -> DataFrame:
    """Words that both names of a pair have."""
    return _pairs_with(spark, d, common=_sets(F.array_intersect("a_name_tokens", "b_name_tokens")))


@query("explode_gt", "SELECT source1_entity_id AS s1_id, trim(unnest(string_split(matched_entity_ids, ',')), E' \\t\\n\\r') AS target_id FROM train_matches")
def explode_gt(spark: SparkSession, d: str) -> DataFrame:
    return ds.explode_truth(table(spark, d, "train_matches"))


SQL["explode_gt"] = f"SELECT * FROM ({SQL['explode_gt']}) WHERE target_id <> ''"
SQL["filter_gt_available"] = SQL["filter_gt_available"].replace("WHERE id IN", "WHERE id <> '' AND id IN")


# -- diagnostics -------------------------------------------------------------------------------------------------------

_DESCRIBED = "SELECT DISTINCT ON (id) id, name, address, country, {c} AS country_n, {n} AS name_n, {a} AS address_n, {k} AS core FROM ({src}) ORDER BY id, pos DESC"


def _described_sql(src: str) -> str:
    return _DESCRIBED.format(c=q.country("country"), n=q.norm("name"), a=q.norm("address"), k=q.core(q.norm("name")), src=src)


_COMMON_NAMES = f"len(list_intersect({q.toks('a.name_n')}, {q.toks('b.name_n')}))"
_TAG_TESTS = [
    "a.name_n <> '' AND a.name_n = b.name_n", "a.core <> '' AND a.core = b.core", "a.address_n <> '' AND a.address_n = b.address_n", f"{_COMMON_NAMES} >= 1", f"{_COMMON_NAMES} >= 2",
    f"len(list_intersect({q.grams('a.name_n')}, {q.grams('b.name_n')})) >= 2", f"len(list_intersect({q.toks('a.address_n')}, {q.toks('b.address_n')})) >= 1",
]
_TAGS_SQL = "CASE WHEN a.country_n <> b.country_n THEN '' ELSE concat_ws('|', " + ", ".join(f"CASE WHEN {t} THEN '{tag}' END" for t, tag in zip(_TAG_TESTS, dg.TAGS)) + ") END"


def _ascii(x: str) -> str:
    return f"regexp_matches(regexp_replace({x}, '[ \\t\\n\\x0B\\f\\r]+', '', 'g'), '[^\\x00-\\x7F]')"


_REASON_SQL = (
    f"CASE WHEN a_country_n <> b_country_n THEN 'COUNTRY_MISMATCH' WHEN shared_keys <> '' THEN 'HAS_SHARED_KEY_CHECK_INDEX' WHEN {_ascii('a_name')} <> {_ascii('b_name')} THEN 'MULTILINGUAL_NAME' "
    f"WHEN an <> '' AND bn <> '' AND len(list_intersect({q.toks('an')}, {q.toks('bn')})) = 0 THEN 'NO_NAME_OVERLAP' WHEN aa = '' OR ba = '' THEN 'ADDRESS_MISSING' ELSE 'OTHER' END"
)
_REPORT_CTE = f"""WITH a AS ({_described_sql(q.S1_ENTS)}), b AS ({_described_sql(q.T_ENTS)}), g AS ({q.TRUTH}),
 r AS (SELECT g.s1_id AS s1_entity_id, g.target_id AS target_entity_id, a.country, a.name AS s1_name, b.name AS target_name, a.name_n AS s1_name_normalized, b.name_n AS target_name_normalized, a.core AS s1_name_core, b.core AS target_name_core,
   a.address AS s1_address, b.address AS target_address, a.address_n AS s1_address_normalized, b.address_n AS target_address_normalized, {q.show(q.toks('a.name_n'))} AS s1_tokens, {q.show(q.toks('b.name_n'))} AS target_tokens,
   {_TAGS_SQL} AS shared_keys, a.country_n AS a_country_n, b.country_n AS b_country_n, a.name AS a_name, b.name AS b_name, a.name_n AS an, b.name_n AS bn, a.address AS aa, b.address AS ba
  FROM g JOIN a ON a.id = g.s1_id JOIN b ON b.id = g.target_id),
 m AS (SELECT *, {_REASON_SQL} AS reason FROM r)"""


def _described_pairs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return dg.described(s1_entities(spark, d), MODE), dg.described(target_entities(spark, d), MODE)


def _none(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "s1_id string, target_id string")


@query("shared_keys", f"{_REPORT_CTE} SELECT s1_entity_id, target_entity_id, shared_keys FROM m")
def shared_keys(spark: SparkSession, d: str) -> DataFrame:
    """Tags of all truth pairs."""
    a, b = _described_pairs(spark, d)
    return dg.missed_pairs_report(truth(spark, d), _none(spark), a, b).select("s1_entity_id", "target_entity_id", "shared_keys")


@query("classify_reason", f"{_REPORT_CTE} SELECT s1_entity_id, target_entity_id, reason FROM m")
def classify_reason(spark: SparkSession, d: str) -> DataFrame:
    a, b = _described_pairs(spark, d)
    return dg.missed_pairs_report(truth(spark, d), _none(spark), a, b).select("s1_entity_id", "target_entity_id", "reason")


_ENGINE_REPORT = f"{_ENGINE} named AS ({_ENGINE_PAIRS}), {_REPORT_CTE.removeprefix('WITH ')}".replace(" a AS (", " da AS (").replace(" b AS (", " db AS (").replace("JOIN a ON a.id", "JOIN da a ON a.id").replace("JOIN b ON b.id", "JOIN db b ON b.id")
_MISSED = f"{_ENGINE_REPORT} SELECT {', '.join(dg.REPORT)} FROM m ANTI JOIN named ON named.s1_id = s1_entity_id AND named.target_id = target_entity_id"


def _missed(spark: SparkSession, d: str) -> DataFrame:
    a, b = _described_pairs(spark, d)
    true = truth(spark, d)
    return dg.missed_pairs_report(true, met(true, _engine(spark, d)), a, b)


@query("missed_pairs_report", _MISSED)
def missed_pairs_report(spark: SparkSession, d: str) -> DataFrame:
    """Truth pairs that blocking by all families of version 1 at the default caps misses."""
    return _missed(spark, d)


@query("agg_value_counts", f"WITH z AS ({_MISSED}) SELECT reason, count(*) AS n FROM z GROUP BY 1 ORDER BY 2 DESC, 1")
def agg_value_counts(spark: SparkSession, d: str) -> DataFrame:
    return dg.reason_counts(_missed(spark, d))


def _sources(spark: SparkSession, d: str) -> list[DataFrame]:
    return [table(spark, d, t) for t in ("train_matches", "train_source1", "train_source2", "train_source3")]


@query("debug_dataset", """WITH g AS (SELECT * FROM train_matches ORDER BY pos LIMIT 300), i AS (SELECT DISTINCT trim(unnest(string_split(matched_entity_ids, ',')), E' \\t\\n\\r') AS id FROM g)
 SELECT 'source1' AS part, count(*) AS n FROM train_source1 WHERE entity_id IN (SELECT source1_entity_id FROM g) UNION ALL SELECT 'source2', count(*) FROM train_source2 WHERE entity_id IN (SELECT id FROM i WHERE starts_with(id, 'S2-'))
 UNION ALL SELECT 'source3', count(*) FROM train_source3 WHERE entity_id IN (SELECT id FROM i WHERE starts_with(id, 'S3-')) UNION ALL SELECT 'ground_truth', count(*) FROM g""")
def debug_dataset(spark: SparkSession, d: str) -> DataFrame:
    """Rows of each part of the subset around the first 300 truth rows."""
    parts = [x.agg(F.count("*").alias("n")).select(F.lit(k).alias("part"), "n") for k, x in ds.debug_dataset(*_sources(spark, d), n_gt=300).items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query("blocking_sample")
def blocking_sample(spark: SparkSession, d: str) -> DataFrame:
    """Rows of each part of a sample of 20 truth rows and 100 other targets of each table."""
    parts = [x.agg(F.count("*").alias("n")).select(F.lit(k).alias("part"), "n") for k, x in ds.blocking_sample(*_sources(spark, d), n_s1=20, n_negatives=100).items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


# -- sources and sinks -------------------------------------------------------------------------------------------------


def _exported(spark: SparkSession, d: str, name: str) -> str:
    """train_source1 as a TSV folder beside the checkpoints, which all executors share."""
    path = f"{ensure_checkpoint_dir(spark)}/export_{name}"
    rows = table(spark, d, "train_source1").select(F.col("pos").cast("string").alias("pos"), "entity_id", "business_name", "business_address", "country")
    tsv.sink_tsv(rows.na.fill(""), path)
    return path


_TSV_COLS = "coalesce(entity_id, '') AS entity_id, coalesce(business_name, '') AS business_name, coalesce(business_address, '') AS business_address, coalesce(country, '') AS country"


@query("scan_tsv", f"SELECT pos::VARCHAR AS pos, {_TSV_COLS} FROM train_source1")
def scan_tsv(spark: SparkSession, d: str) -> DataFrame:
    """Written as TSV and read back: quotes, blanks, line breaks and empty fields survive."""
    return tsv.scan_tsv(spark, _exported(spark, d, "scan"))


@query("sink_tsv", f"SELECT count(*) AS n, count(DISTINCT business_name) AS names FROM (SELECT {_TSV_COLS} FROM train_source1)")
def sink_tsv(spark: SparkSession, d: str) -> DataFrame:
    return tsv.scan_tsv(spark, _exported(spark, d, "sink")).agg(F.count("*").alias("n"), F.count_distinct("business_name").alias("names"))


@query("scan_projected", "SELECT coalesce(entity_id, '') AS entity_id FROM train_source1")
def scan_projected(spark: SparkSession, d: str) -> DataFrame:
    return tsv.scan_tsv(spark, _exported(spark, d, "projected"), columns=["entity_id"])


@query("scan_tsv_limit", "SELECT pos::VARCHAR AS pos, coalesce(entity_id, '') AS entity_id FROM train_source1 ORDER BY train_source1.pos LIMIT 200")
def scan_tsv_limit(spark: SparkSession, d: str) -> DataFrame:
    return ds.limit_head(tsv.scan_tsv(spark, _exported(spark, d, "limit"), columns=["pos", "entity_id"]).withColumn("at", F.col("pos").cast("bigint")), "at", 200).drop("at")


_NA_SQL = "(" + ", ".join(q.lit(x) for x in tsv.NA_LITERALS) + ")"


@query("scan_na_default", f"SELECT pos::VARCHAR AS pos, CASE WHEN business_name IN {_NA_SQL} THEN '' ELSE coalesce(business_name, '') END AS business_name FROM train_source1")
def scan_na_default(spark: SparkSession, d: str) -> DataFrame:
    return tsv.scan_tsv(spark, _exported(spark, d, "na"), na_mode="pandas_default").select("pos", "business_name")


@query("path_resolve", "SELECT 'train_source1' AS name, count(*) AS n FROM train_source1")
def path_resolve(spark: SparkSession, d: str) -> DataFrame:
    path = paths.path_resolve(spark, [f"{d}/no_such_table.parquet", f"{d}/train_source1.parquet"])
    return spark.read.parquet(path).agg(F.count("*").alias("n")).select(F.lit("train_source1").alias("name"), "n")


@query("row_count_file", "SELECT count(*) AS n FROM train_matches")
def row_count_file(spark: SparkSession, d: str) -> DataFrame:
    path = f"{ensure_checkpoint_dir(spark)}/export_ids"
    tsv.sink_tsv(table(spark, d, "train_matches").select("pos").coalesce(1), path)
    return spark.createDataFrame([(tsv.row_count_file(spark, path),)], "n bigint")


@query("sink_append", "SELECT entity_id, pos FROM train_source1 UNION ALL SELECT entity_id, pos FROM train_source2")
def sink_append(spark: SparkSession, d: str) -> DataFrame:
    path = f"{ensure_checkpoint_dir(spark)}/append_{abs(hash(d))}_{spark.sparkContext.startTime}"
    if paths.exists(spark, path):
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    for k in (1, 2):
        tsv.sink_append(table(spark, d, f"train_source{k}").select("entity_id", "pos"), path)
    return spark.read.parquet(path)


@query("sink_results", f"WITH t AS ({q.T_ENTS}), o AS (SELECT id, min(pos) AS pos FROM t GROUP BY 1), l AS (SELECT s1_id, string_agg(target_id, ',' ORDER BY o.pos, target_id) AS ids FROM ({q.LISTED}) p JOIN o ON o.id = target_id GROUP BY 1) SELECT entity_id AS source1_entity_id, coalesce(ids, '') AS candidate_entity_ids FROM train_source1 LEFT JOIN l ON s1_id = entity_id")
def sink_results(spark: SparkSession, d: str) -> DataFrame:
    at = target_entities(spark, d).groupBy(F.col("id").alias("target_id")).agg(F.min("pos").alias("t_pos"))
    return tsv.results(s1_entities(spark, d), listed_pairs(spark, d).join(at, "target_id"), "candidate_entity_ids")


# -- models ------------------------------------------------------------------------------------------------------------


def _labelled(spark: SparkSession, d: str) -> DataFrame:
    # not written as both_features() are: each side is read once, and without its country
    a, b = (normalized(e, MODE) for e in (s1_entities(spark, d), target_entities(spark, d)))
    # labels first: the join with them moves ids alone
    return stored(pr.pair_features(pr.label_join(listed_pairs(spark, d), truth(spark, d)), a, b))


def _model_query(name: str, kind: str) -> None:
    def run(spark: SparkSession, d: str) -> DataFrame:
        rows = _labelled(spark, d)
        model, _ = md.train(rows, kind)
        return md.score(model, rows).select("s1_id", "target_id", "label", "probability")

    query(name)(run)


_model_query("train_histgb", "histgb")
_model_query("train_xgboost", "xgboost")


@query("predict_match")
def predict_match(spark: SparkSession, d: str) -> DataFrame:
    rows = _labelled(spark, d)
    model, _ = md.train(rows)
    return md.predict_match(model, rows).select("s1_id", "target_id", "probability")


@query("train_summary", SQL["agg_class_balance"].replace("SELECT sum(label)::BIGINT AS positives, sum(1 - label)::BIGINT AS negatives, round(CASE WHEN sum(label) > 0 THEN sum(1 - label)::DOUBLE / sum(label)::DOUBLE ELSE 1.0 END, 6) AS weight FROM l", "SELECT count(*) AS pairs, sum(label)::BIGINT AS positives, 'histgb' AS model FROM l"))
def train_summary(spark: SparkSession, d: str) -> DataFrame:
    _, s = md.train(_labelled(spark, d))
    return spark.createDataFrame([(s["pairs"], s["positives"], s["model"])], "pairs bigint, positives bigint, model string")


@query("filter_threshold", f"{_PAIR_CTE} SELECT s1_id, target_id, round({q.jaccard(q.toks('an'), q.toks('bn'))}, 6) AS probability FROM j WHERE {q.jaccard(q.toks('an'), q.toks('bn'))} >= {md.THRESHOLD}::DOUBLE")
def filter_threshold(spark: SparkSession, d: str) -> DataFrame:
    """The decision rule by itself, on the share of common words in the place of a model's probability."""
    scored = _pairs_with(spark, d, probability=sim.jaccard("a_name_tokens", "b_name_tokens"))
    return md.at_least(scored).select("s1_id", "target_id", F.round("probability", 6).alias("probability"))


@query("train_guard", "SELECT 'no true pair is among the candidates' AS refused, count(*) AS pairs FROM (" + q.LISTED + ")")
def train_guard(spark: SparkSession, d: str) -> DataFrame:
    """Training without a true pair among the candidates is refused."""
    rows = cut(_labelled(spark, d).withColumn("label", F.lit(0)))
    try:
        md.train(rows)
        refused = ""
    except ValueError as e:
        refused = str(e)
    return rows.agg(F.lit(refused).alias("refused"), F.count("*").alias("pairs"))


@query("pipeline_macro_fbeta")
def pipeline_macro_fbeta(spark: SparkSession, d: str) -> DataFrame:
    """The whole pipeline measured: blocking at the default caps, a model learnt from the truth of half of the records, and the macro F0.5 of
    its predictions for the other half at several thresholds."""
    a, b = both_features(spark, d)
    found = stored(bl.generate_candidates(a, b, _config()).select("s1_id", "target_id"))
    wanted, _ = _truth_and_predicted(spark, d)
    learn = F.pmod(F.xxhash64("s1_id"), F.lit(2)) == 0
    thresholds = [0.5, 0.6, 0.7, 0.8, 0.9]
    compared = lambda part: pr.pair_features(found.where(part).join(wanted.select("s1_id"), "s1_id", "left_semi"), a, b)
    rows = stored(pr.label_join(compared(learn), truth(spark, d)).select(*pr.FEATURES, "label"))
    model, _ = md.train(rows)
    remove(rows)
    # of the other half only what reaches the least threshold is kept: the scan counts no other pair
    scored = cut(md.predict_match(model, compared(~learn), min(thresholds)).select("s1_id", "target_id", "probability"))
    return md.threshold_scan(scored, wanted.where(~learn), thresholds)


@query("sink_model")
def sink_model(spark: SparkSession, d: str) -> DataFrame:
    """Saved, loaded again and applied."""
    rows = _labelled(spark, d)
    model, summary = md.train(rows)
    path = f"{ensure_checkpoint_dir(spark)}/model"
    md.save_model(model, path, summary)
    again, _ = md.load_model(spark, path)
    return md.score(again, rows).select("s1_id", "target_id", "probability")


@query("threshold_scan")
def threshold_scan(spark: SparkSession, d: str) -> DataFrame:
    rows = _labelled(spark, d)
    model, _ = md.train(rows)
    scored = cut(md.score(model, rows).select("s1_id", "target_id", "probability"))
    return md.threshold_scan(scored, _truth_and_predicted(spark, d)[0], [0.5, 0.6, 0.7, 0.8, 0.9])
