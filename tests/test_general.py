"""Heavy keys, packed fields and components against plain Python, with nulls, ties, empty tables and clashing names."""

import random
from collections import defaultdict

import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kinlink.operators.components import connected_components
from kinlink.operators.heavy_keys import count_by_heavy_key
from kinlink.operators.packed import OK, UNBALANCED_BRACKET, UNCLOSED_QUOTE, FieldParser, unpack

ID, SUFFIX = r"S[0-9]-[0-9]+", r"[,;|][A-Za-z0-9]{1,4}"


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_heavy_keys(spark, parts):
    r = random.Random(parts)
    data = [(r.choice(["a", "a", "a", "b", None, ""]), r.choice([None, "x", "x", "x", *map(str, range(30))]), i, "clash") for i in range(3000)]
    df = spark.createDataFrame(data, "k string, m string, t long, n_rows string")
    got = {x[0]: (x[1], x[2]) for x in rows(count_by_heavy_key(df, F.col("k"), F.col("m"), F.col("t"), parts))}
    n, d = defaultdict(int), defaultdict(set)
    for k, m, *_ in data:
        n[k or ""] += 1
        if m is not None:
            d[k or ""].add(m)
    assert got == {k: (n[k], len(d[k])) for k in n}
    assert count_by_heavy_key(df.limit(0), F.col("k"), F.col("m")).count() == 0


def test_one_hot_member(spark):
    """One pair of key and member holds all rows: it is split, and counted once."""
    df = spark.range(5000).select(F.lit("k").alias("k"), F.lit("m").alias("m"), "id")
    assert rows(count_by_heavy_key(df, F.col("k"), F.col("m"), F.col("id"), 8)) == [("k", 5000, 1)]


PACKED = [
    ("S2-1,S3-2", ["S2-1", "S3-2"]), ('"S3-1,B",S2-2', ["S3-1,B", "S2-2"]), ('"S3-1,S2-2,S3-3"', ["S3-1", "S2-2", "S3-3"]), ('"S3-1|K"', ["S3-1|K"]),
    ('["S2-1", "S3-2;2"]', ["S2-1", "S3-2;2"]), ("{S2-1,S3-2}", ["S2-1", "S3-2"]), ("'S2-1';'S3-2'", ["S2-1", "S3-2"]), ("S2-1 and S2-2 & S2-3", ["S2-1", "S2-2", "S2-3"]),
    (" S2-1,,S2-1, ", ["S2-1", "S2-1"]), ('"""S3-1,B"",S2-2"', ["S3-1,B", "S2-2"]), ("none", []), ("NA", []), ("-", []), ("[]", []), ("", []), (" ", []), (None, []),
    ('"""S3-1,A1"""', ["S3-1,A1"]), ('"S2-1,""S3-1,A1"",S2-2"', ["S2-1", "S3-1,A1", "S2-2"]),
    ("S2-1；S2-2、S2-3\tS2-4\r\nS2-5||S2-6 / S2-7", [f"S2-{i}" for i in range(1, 8)]),
]


@pytest.mark.parametrize("text,want", PACKED)
def test_packed_fields(text, want):
    assert [v for v, e in FieldParser(ID, SUFFIX).parse(text) if e != 3] == want


def test_malformed():
    p = FieldParser(ID, SUFFIX)
    assert p.parse('"S2-1,S2-2') == [("S2-1", UNCLOSED_QUOTE), ("S2-2", OK)]
    assert p.parse("{S2-1,S2-2") == [("S2-1", OK), ("S2-2", UNBALANCED_BRACKET)]
    assert [v for v, e in p.parse('"S2-1" x "S2-2"') if e == OK] == ["S2-1", "S2-2"]
    assert FieldParser().parse("a; 'b, c' d") == [("a", OK), ("b, c", OK), ("d", OK)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 10**8), min_size=1, max_size=8), st.sampled_from([",", ", ", ";", " | ", "||", "/", "\t", "\n", "  "]), st.sampled_from(["", '"', "'"]), st.sampled_from([("", ""), ("[", "]"), ("{", "}")]))
def test_packed_round_trip(ids, sep, quote, wrap):
    values = [f"S2-{i}" for i in ids]
    text = wrap[0] + sep.join(quote + v + quote for v in values) + wrap[1]
    assert [v for v, e in FieldParser(ID, SUFFIX).parse(text) if e == OK] == values


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="S2-1,;|\"'[]{} and", max_size=60))
def test_packed_never_fails(text):
    FieldParser(ID, SUFFIX).parse(text)


def test_unpack(spark):
    df = spark.createDataFrame([(1, t, "x") for t, _ in PACKED] + [(2, '"' * 20001, None)], "pos long, v string, value string")
    got = unpack(df, "v", ["pos"], ID, SUFFIX)
    assert got.count() == sum(len(w) for _, w in PACKED) and got.columns == ["pos", "item_no", "value", "error"]
    assert unpack(df.limit(0), "v", ["pos"], ID, SUFFIX).count() == 0
    with pytest.raises(ValueError):
        unpack(df, "v", ["value"], ID, SUFFIX)
    long = spark.createDataFrame([(1, ",".join(f"S2-{i}" for i in range(120_000)))], "pos long, v string")
    assert unpack(long, "v", ["pos"], ID, SUFFIX).agg(F.max("item_no")).first()[0] == 120_000


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components(spark, seed):
    r = random.Random(seed)
    edges = [(r.randint(0, 60), r.randint(0, 60)) for _ in range(40)] + [(100 + i, 101 + i) for i in range(40)] + [(5, 5), (None, 3)]
    edges += [(200, i) for i in range(201, 260)]  # a hub
    got = dict(rows(connected_components(spark.createDataFrame(edges, "a long, b long"))))
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            parent[max(find(a), find(b))] = min(find(a), find(b))
    assert got == {x: find(x) for x in list(parent)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_fields_query_shows_the_flags(spark, tmp_path):
    """What is no id and what is quoted wrongly has a row with its flag; the query of the ids leaves it out."""
    from kinlink.plans.general import QUERIES

    rows = [(1, "S2-00000001, \"S2-00000002"), (2, "nonsense; S3-00000003"), (3, None), (4, "")]
    for name, column in (("train_matches", "matched_entity_ids"), ("candidate_pairs", "candidate_entity_ids")):
        spark.createDataFrame(rows, f"pos long, {column} string").write.parquet(str(tmp_path / f"{name}.parquet"))
    flags = {(r.pos, r.value): r.error for r in QUERIES["p7_fields"](spark, str(tmp_path)).collect()}
    assert flags[1, "S2-00000001"] == 0 and flags[2, "nonsense"] == 3 and flags[2, "S3-00000003"] == 0
    assert {p for p, _ in flags} == {1, 2} and any(e == 1 for e in flags.values())
    assert {r.entity_id for r in QUERIES["p7_found"](spark, str(tmp_path)).collect()} >= {"S2-00000001", "S3-00000003"}
