import pytest
from conftest import rows

from kinlink.operators import datasets as ds
from kinlink.operators import diagnose as dg
from kinlink.sources import paths, tsv

TRICKY = [("a", 'say "hi"'), ("b", ""), ("c", "  padded  "), ("d", "NA"), ("e", "null"), ("f", "back\\slash"), ("g", "line\nbreak"), ("h", "tab\there")]


def test_tsv_round_trip(spark, tmp_path):
    df = spark.createDataFrame(TRICKY, "id string, v string")
    tsv.sink_tsv(df.coalesce(1), str(tmp_path / "t"))
    assert rows(tsv.scan_tsv(spark, str(tmp_path / "t"))) == sorted(TRICKY)
    assert rows(tsv.scan_tsv(spark, str(tmp_path / "t"), ["id"])) == [(a,) for a, _ in sorted(TRICKY)]
    na = dict(rows(tsv.scan_tsv(spark, str(tmp_path / "t"), na_mode="pandas_default")))
    assert na["d"] == na["e"] == "" and na["a"] == 'say "hi"'
    with pytest.raises(ValueError):
        tsv.scan_tsv(spark, str(tmp_path / "t"), na_mode="x")
    tsv.sink_tsv(df.limit(0), str(tmp_path / "e"))
    assert tsv.row_count_file(spark, str(tmp_path / "e")) == 0


def test_append_positions_paths(spark, tmp_path):
    p = str(tmp_path / "a")
    for _ in range(2):
        tsv.sink_append(spark.createDataFrame([(1,)], "x int"), p)
    assert spark.read.parquet(p).count() == 2
    df = tsv.with_positions(spark.range(100).repartition(4))
    assert sorted(r.pos for r in df.collect()) == list(range(100))
    assert tsv.with_positions(spark.range(0)).count() == 0
    assert paths.path_resolve(spark, [str(tmp_path / "no"), p]) == p
    with pytest.raises(FileNotFoundError):
        paths.path_resolve(spark, [str(tmp_path / "no")])


def test_results_keep_every_record(spark):
    s1 = spark.createDataFrame([(1, "B"), (0, "A")], "pos long, id string")
    p = spark.createDataFrame([("A", "y", 5), ("A", "x", 2)], "s1_id string, target_id string, t_pos long")
    assert [tuple(r) for r in tsv.results(s1, p, "ids").collect()] == [("A", "x,y"), ("B", "")]


def test_samples(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a, b = ds.sample_n(df, "k", 50), ds.sample_n(df.repartition(7), "k", 50)
    assert rows(a) == rows(b) and a.count() == 50 and ds.sample_n(df, "k", 5000).count() == 1000
    gt = spark.createDataFrame([(0, "S1-1", "S2-1, S3-9,S2-2"), (1, "S1-2", "S3-7"), (2, "", "S2-1"), (3, "S1-3", None)], "pos long, source1_entity_id string, matched_entity_ids string")
    s1 = spark.createDataFrame([(0, "S1-1"), (1, "S1-2"), (2, "S1-1")], "pos long, entity_id string")
    s2 = spark.createDataFrame([(i, f"S2-{i}") for i in range(20)], "pos long, entity_id string")
    s3 = spark.createDataFrame([(i, f"S3-{i}") for i in range(8)], "pos long, entity_id string")
    assert rows(ds.gt_available(gt, s2)) == [("S1-1", 0, "S2-1,S2-2")]
    parts = ds.debug_dataset(gt, s1, s2, s3, n_gt=2)
    assert {k: v.count() for k, v in parts.items()} == {"source1": 3, "source2": 2, "source3": 1, "ground_truth": 2}
    again = ds.debug_dataset(gt, s1, s2, s3, n_gt=2, existing=parts)
    assert all(v.count() == 0 for v in again.values())
    sample = ds.blocking_sample(gt, s1, s2, s3, n_s1=2, n_negatives=3)
    assert {"S2-1", "S2-2"} <= {r.entity_id for r in sample["sample_s2"].collect()} or sample["sample_gt"].count() <= 2
    with pytest.raises(ValueError):
        ds.blocking_sample(gt, s1, s2, s3, n_s1=50)


def test_reasons(spark):
    schema = "pos long, id string, name string, address string, country string"
    s = [(0, "1", "Acme Foods", "1 Main", "US"), (1, "2", "Acme Foods", "1 Main", "US"), (2, "3", "कखग", "", "US"), (3, "4", "alpha", "q", "US"), (4, "5", "", "", "US"), (5, "6", "", "zz", "US")]
    t = [(0, "1", "Acme Foods", "1 Main", "India"), (1, "2", "acme foods ltd", "", "USA"), (2, "3", "beta", "", "US"), (3, "4", "omega", "w", "US"), (4, "5", "x", "", "US"), (5, "6", "", "yy", "US")]
    a, b = (dg.described(spark.createDataFrame(x, schema), "full") for x in (s, t))
    truth = spark.createDataFrame([(i, i) for i in "123456"] + [("9", "1")], "s1_id string, target_id string")
    report = dg.missed_pairs_report(truth, spark.createDataFrame([], "s1_id string, target_id string"), a, b)
    assert report.columns == list(dg.REPORT)
    got = {r.s1_entity_id: (r.shared_keys, r.reason) for r in report.collect()}
    assert got["1"] == ("", "COUNTRY_MISMATCH") and got["2"][1] == "HAS_SHARED_KEY_CHECK_INDEX" and got["2"][0].startswith("name_core|shared_name_token")
    assert got["3"][1] == "MULTILINGUAL_NAME" and got["4"][1] == "NO_NAME_OVERLAP" and got["5"][1] == "ADDRESS_MISSING" and got["6"][1] == "OTHER"
    assert dg.reason_counts(report).count() == 6
