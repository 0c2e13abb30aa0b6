"""The pipeline end to end, the queries against SQL on the smallest tables, and streaming."""

import os

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def test_entry_and_names():
    import __spark_entry__ as e

    q, s = e.queries(), e.oracle_sql()
    assert set(s) <= set(q) and "block_union" in q


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", ["block_union", "pair_features", "p6_country_counts", "p7_found", "agg_blocking_metrics", "pipeline_blocking_metrics", "token_set_ratio", "missed_pairs_report", "filter_gt_available"])
def test_against_sql(spark, name):
    import duckdb

    import __spark_entry__ as e

    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for f in os.listdir(SF):
        con.execute(f"create view {f[:-8]} as select * from '{SF}/{f}'")
    a, b = e.queries()[name](spark, SF).toPandas(), con.execute(e.oracle_sql()[name]).fetch_df()
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)
    norm = lambda d: sorted(tuple(f"{v:.6f}" if isinstance(v, float) else str(v) for v in r) for r in d[cols].itertuples(index=False))
    assert norm(a) == norm(b)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_missed_pairs_of_all_families(spark):
    """Pairs that any family finds are not reported."""
    from kinlink.operators import blocking as bl
    from kinlink.operators import diagnose as dg
    from kinlink.plans import linkage as ln

    ids = ["s1_entity_id", "target_entity_id"]
    x, y = ln.both_features(spark, SF)
    by_name = bl.generate_candidates(x, y, ln._config((bl.EXACT_NAME, bl.EXACT_CORE)))
    exact = dg.missed_pairs_report(ln.truth(spark, SF), by_name, *ln._described_pairs(spark, SF))
    exact, full = ({tuple(r) for r in df.select(*ids).collect()} for df in (exact, ln.QUERIES["missed_pairs_report"](spark, SF)))
    assert full < exact


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", ["train_histgb", "train_xgboost", "predict_match", "train_summary", "sink_model", "threshold_scan"])
def test_model_queries_train_with_the_default_rounds(spark, monkeypatch, name):
    from kinlink.plans import linkage

    class Seen(Exception):
        pass

    def train(rows, kind="histgb", **overrides):
        raise Seen(overrides)

    monkeypatch.setattr(linkage.md, "train", train)
    monkeypatch.setattr(linkage, "_labelled", lambda *_: None)
    with pytest.raises(Seen) as got:
        linkage.QUERIES[name](spark, SF)
    assert got.value.args == ({},)


def _tables(spark):
    names = [("Acme Foods Ltd", "12 Main Road Springfield"), ("Zenith Steel", "7 Lake View Rivertown"), ("Blue Bird Cafe", "99 Hill Crest Oldham"), ("Orbit Motors Inc", "5 Station Yard Derby")]
    schema = "pos long, entity_id string, business_name string, business_address string, country string"
    s1 = [(i, f"S1-{i}", *names[i % 4], "US") for i in range(8)]
    s2 = [(i, f"S2-{i}", names[i % 4][0].upper(), names[i % 4][1], "USA") for i in range(8)]
    s3 = [(i, f"S3-{i}", "Acme " + names[(i + 1) % 4][0], "1 Nowhere", "US") for i in range(8)]
    truth = [(f"S1-{i}", f"S2-{j}") for i in range(8) for j in range(8) if i % 4 == j % 4]
    return [spark.createDataFrame(x, schema) for x in (s1, s2, s3)] + [spark.createDataFrame(truth, "s1_id string, target_id string")]


def test_resolver(spark, tmp_path):
    from kinlink.plans import model as md
    from kinlink.plans.resolver import EntityResolver

    s1, s2, s3, truth = _tables(spark)
    r = EntityResolver().fit(s1, s2, s3, truth, maxIter=3, minInstancesPerNode=1)
    assert r.summary["positives"] == 16
    out = r.transform(s1, s2, s3)
    matched = out["matching_results"].collect()
    assert [x.source1_entity_id for x in matched] == [f"S1-{i}" for i in range(8)]
    assert matched[1].matched_entity_ids == "S2-1,S2-5"
    md.save_model(r.model, str(tmp_path / "m"), r.summary)
    again, about = md.load_model(spark, str(tmp_path / "m"))
    assert about["model"] == "histgb" and len(about["features"]) == 15
    same = EntityResolver(model=again).transform(s1, s2, s3)["matching_results"].collect()
    assert same == matched


def test_command_line(spark, tmp_path):
    """TSV files in, a model and both result files out."""
    from kinlink.__main__ import main
    from kinlink.sources.tsv import scan_tsv, sink_tsv

    *sources, truth = _tables(spark)
    named = ["entity_id", "business_name", "business_address", "country"]
    args = []
    for k, df in enumerate(sources, 1):
        sink_tsv(df.select(*named).coalesce(1).sortWithinPartitions("entity_id"), str(tmp_path / f"s{k}"))
        args += [f"--source{k}", str(tmp_path / f"s{k}")]
    lists = truth.groupBy(F.col("s1_id").alias("source1_entity_id")).agg(F.concat_ws(",", F.collect_list("target_id")).alias("matched_entity_ids"))
    sink_tsv(lists, str(tmp_path / "truth"))
    model = ["--model", str(tmp_path / "model")]
    assert main(["train", *args, *model, "--truth", str(tmp_path / "truth"), "--rounds", "2"], spark)["positives"] == 16
    done = main(["predict", *args, *model, "--output", str(tmp_path / "out"), "--threshold", "0.5"], spark)
    assert done["matching_results"] == done["candidate_pairs"] == 8
    assert set(scan_tsv(spark, str(tmp_path / "out" / "candidate_pairs")).columns) == {"source1_entity_id", "candidate_entity_ids"}
    with pytest.raises(FileNotFoundError):
        main(["predict", "--source1", str(tmp_path / "none"), *args[2:], *model, "--output", str(tmp_path / "x")], spark)


def test_threshold_scan_is_one_measure_for_each_threshold(spark):
    from kinlink.operators.evaluate import macro_fbeta
    from kinlink.plans import model as md

    scored = spark.createDataFrame([("a", "x", 0.9), ("a", "y", 0.6), ("b", "x", 0.7), ("c", "z", None)], "s1_id string, target_id string, probability double")
    truth = spark.createDataFrame([("a", ["x"]), ("b", ["y"]), ("c", []), ("d", ["w"])], "s1_id string, ids array<string>")
    got = {r.threshold: (r.macro_f, r.n) for r in md.threshold_scan(scored, truth, [0.5, 0.8, 0.95]).collect()}
    for t, (f, n) in got.items():
        predicted = md.at_least(scored, t).groupBy("s1_id").agg(F.collect_set("target_id").alias("ids"))
        one = macro_fbeta(truth, predicted).first()
        assert abs(one.macro_f - f) < 1e-12 and one.n == n == 4
    assert len(got) == 3


def test_checkpoints_need_a_shared_folder_on_a_cluster():
    from kinlink import session

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Session())


def test_train_guards(spark):
    from kinlink.operators.pairs import FEATURES
    from kinlink.plans import model as md

    rows = spark.createDataFrame([(0, 1.0), (0, 2.0)], "label int, name_ratio double")
    with pytest.raises(ValueError):
        md.train(rows)
    with pytest.raises(ValueError):
        md.train(rows, "nonsense")
    assert len(FEATURES) == 15


def test_stream(spark, tmp_path):
    from kinlink.operators.blocking import BlockingConfig, EXACT_NAME
    from kinlink.operators.features import entity_features, target_union
    from kinlink.streaming.incoming import link_stream

    s1, s2, s3, _ = _tables(spark)
    s1.write.parquet(str(tmp_path / "in"))
    target = entity_features(target_union(s2, s3), "latin").cache()
    out = str(tmp_path / "out")
    stream = spark.readStream.schema(s1.schema).parquet(str(tmp_path / "in"))
    q = link_stream(stream, target, lambda df, epoch: df.withColumn("epoch", F.lit(epoch)).write.mode("append").parquet(out), BlockingConfig(families=(EXACT_NAME,), mode="latin"), str(tmp_path / "cp"))
    q.awaitTermination(120)
    assert spark.read.parquet(out).count() == 16


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_pipeline_learns_from_features_alone(spark, monkeypatch):
    """The table that is written for training holds neither ids nor the other half's pairs."""
    from kinlink.operators.pairs import FEATURES
    from kinlink.plans import linkage

    class Seen(Exception):
        pass

    def train(rows, kind="histgb", **overrides):
        raise Seen(rows.columns)

    monkeypatch.setattr(linkage.md, "train", train)
    with pytest.raises(Seen) as got:
        linkage.QUERIES["pipeline_macro_fbeta"](spark, SF)
    assert got.value.args[0] == [*FEATURES, "label"]
