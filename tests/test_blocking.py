"""The Spark plan against an independent model with plain sets and loops."""

import pickle
import random
import re
from collections import Counter, defaultdict
from itertools import combinations
from math import ceil

import pytest
from conftest import rows
from pyspark.sql import functions as F

from kinlink.functions.text import ADDRESS_STOPWORDS, LEGAL_SUFFIXES
from kinlink.operators import blocking as bl
from kinlink.operators import evaluate as ev
from kinlink.operators import pairs as pr
from kinlink.operators.features import entities, entity_features, target_union

WORDS = "acme apex zenith ltd foods steel city north road lane 12 12b 7 new town alpha beta gamma co".split()


def model_keys(name, address, n=3):
    nt = list(dict.fromkeys(name.split()))
    at = [t for t in dict.fromkeys(address.split()) if len(t) >= 3 and t not in ADDRESS_STOPWORDS]
    lt = [t for t in dict.fromkeys(address.split()) if len(t) >= 4 and t not in ADDRESS_STOPWORDS and not t.isdigit()]
    nums = set(re.findall("[0-9]+", address))
    core = " ".join(t for t in name.split() if t not in LEGAL_SUFFIXES)
    x = name.replace(" ", "")
    grams = {x[i : i + n] for i in range(len(x) - n + 1)} if len(x) > n else ({x} if x else set())
    return {
        0: {name} - {""}, 1: {core} - {""}, 2: {address} - {""}, 3: {t for t in nt if len(t) >= 3}, 4: set(combinations(sorted(nt), 2)), 5: set(at),
        6: {(a, b) for a in nums for b in lt}, 7: set(combinations(sorted(at), 2)), 8: grams,
    }


def model(s1, target, config):
    df = Counter()
    index = defaultdict(set)
    for pos, _, name, address, country in target:
        for f, keys in model_keys(name, address).items():
            for k in keys:
                df[f, country, k] += 1
                index[f, country, k].add(pos)
    ok = lambda f, c, k: df[f, c, k] <= config.caps.get(f, 10**9)
    id_of = {p: i for p, i, *_ in target}
    out, fam = set(), set()
    for pos, _, name, address, country in s1:
        hit = set()
        for f, keys in model_keys(name, address).items():
            if f not in config.active():
                continue
            if f == 8:
                n = Counter(p for k in keys if ok(f, country, k) for p in index[f, country, k])
                need = 1 if len(keys) <= 4 else max(2, ceil(0.3 * len(keys)))
                got = {p for p, c in n.items() if c >= need}
            else:
                got = {p for k in keys if ok(f, country, k) for p in index[f, country, k]}
            fam |= {(pos, p, f) for p in got}
            hit |= got
        first = {}
        for p in sorted(hit):
            first.setdefault(id_of[p], p)
        out |= {(pos, p) for p in first.values()}
    return out, fam


def make(seed, n1, n2):
    r = random.Random(seed)

    def rec(pos, k):
        return (pos, f"{k}{r.randint(0, n2)}", " ".join(r.choices(WORDS, k=r.randint(0, 4))), " ".join(r.choices(WORDS, k=r.randint(0, 5))), r.choice(["us", "india", ""]))

    return [rec(i, "A") for i in range(n1)], [rec(i, "B") for i in range(n2)]


SCHEMA = "pos long, id string, name string, address string, country string"


@pytest.mark.parametrize("seed,cap,version", [(1, None, 1), (2, 3, 1), (3, 1, 2), (4, 6, 2)])
def test_union_equals_model(spark, seed, cap, version):
    s1, target = make(seed, 25, 60)
    config = bl.BlockingConfig(version=version, mode="latin")
    config = config.with_cap(cap) if cap else config
    a, b = (entity_features(spark.createDataFrame(x, SCHEMA), "latin").cache() for x in (s1, target))
    want, fam = model(s1, target, config)
    assert {tuple(r) for r in bl.hits_by_family(a, b, config).collect()} == fam
    assert {(r.s1_pos, r.t_pos) for r in bl.candidate_positions(a, b, config).collect()} == want
    info = {r.s1_pos: r.total for r in bl.debug_info(a, b, config).collect()}
    assert info == {p: len({t for q, t, _ in fam if q == p}) for p, *_ in s1}


def test_invariants(spark):
    s1, target = make(9, 20, 50)
    a, b = (entity_features(spark.createDataFrame(x, SCHEMA), "latin").cache() for x in (s1, target))
    pairs = lambda c: {(r.s1_pos, r.t_pos) for r in bl.hits_by_family(a, b, c).select("s1_pos", "t_pos").collect()}
    one, two = bl.BlockingConfig(version=1, mode="latin"), bl.BlockingConfig(version=2, mode="latin")
    assert pairs(one) <= pairs(two)
    assert pairs(one.with_cap(2)) <= pairs(one.with_cap(5)) <= pairs(one)
    assert bl.generate_candidates(a.limit(0), b, one).count() == 0
    assert bl.generate_candidates(a, b.limit(0), one).count() == 0


def test_entities_and_union(spark):
    df = spark.createDataFrame([(0, None, None, "x")], "pos long, entity_id string, business_name string, business_address string")
    e = target_union(df, df)
    assert rows(e)[0] == (0, "", "", "x", "") and e.count() == 2 and e.select("pos").distinct().count() == 2
    assert entity_features(entities(df)).first()["name"] == ""


def test_pairs_and_measures(spark):
    s = entity_features(spark.createDataFrame([(0, "A", "Acme Ltd", "1 Main", "US"), (1, "A", "Other", "", "US"), (2, "C", "", "", "")], SCHEMA), "latin")
    t = entity_features(spark.createDataFrame([(0, "B", "acme ltd", "1 main", "us"), (1, "D", "", "", "")], SCHEMA), "latin")
    p = spark.createDataFrame([("A", "B"), ("C", "D"), ("A", "nowhere")], "s1_id string, target_id string")
    got = {r.s1_id: r for r in pr.pair_features(p, s, t).collect()}
    assert set(got) == {"A", "C"} and got["A"].name_exact == 1 and got["A"].country_equal == 1 and got["C"].name_jaccard == 1 and got["C"].name_exact == 1
    labelled = pr.label_join(p, spark.createDataFrame([("A", "B"), ("A", "B")], "s1_id string, target_id string"))
    assert rows(labelled.select("s1_id", "target_id", "label")) == [("A", "B", 1), ("A", "nowhere", 0), ("C", "D", 0)]
    bad = spark.createDataFrame([(float("inf"), None), (float("nan"), 2.0)], "x double, y double")
    assert rows(pr.clean_features(bad, ["x", "y", "z"])) == [(0.0, 0.0, 0.0), (0.0, 2.0, 0.0)]
    truth = spark.createDataFrame([("A", ["x", "y"]), ("B", []), ("C", ["x"]), ("D", [])], "s1_id string, ids array<string>")
    pred = spark.createDataFrame([("A", ["x", "x"]), ("D", ["q"])], "s1_id string, ids array<string>")
    f = {r.s1_id: round(r.f, 6) for r in ev.entity_fbeta(truth, pred).collect()}
    assert f == {"A": round(1.25 * 0.5 / (0.25 + 0.5), 6), "B": 1.0, "C": 0.0, "D": 0.0}
    ids = spark.createDataFrame([("A",), ("B",), ("B",)], "id string")
    cand = spark.createDataFrame([("A", "x"), ("A", "z"), ("B", "x")], "s1_id string, target_id string")
    tr = spark.createDataFrame([("A", "x"), ("B", "y")], "s1_id string, target_id string")
    m = ev.blocking_metrics(ids, spark.range(10), cand, tr).first()
    assert (m.n_s1, m.candidate_pairs, m.gt_pairs, m.gt_found, m.any_match, m.median_candidates) == (3, 4, 3, 1, 1, 1.0)
    empty = ev.blocking_metrics(ids.limit(0), spark.range(0), cand, tr).first()
    assert empty.n_s1 == 0 and empty.reduction == 0 and empty.match_recall == 0
    assert ev.class_balance(labelled.where("label = 0")).first().weight == 1.0
    first = pr.dedup_first(spark.createDataFrame([(2, "a", "late"), (1, "a", None)], "pos long, id string, v string"), "id")
    assert rows(first) == [(1, "a", None)]
    assert pr.collect_ids(spark.createDataFrame([("A", "y", 2), ("A", "x", 3), ("A", "y", 1)], "k string, i string, o int"), "k", "i", "o").first().ids == "y,x"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_pair_is_shuffled_and_counts_are_those_of_the_pairs(spark):
    from kinlink.operators.probing import key_index, met, probed

    s1, target = make(5, 40, 80)
    a, b = (entity_features(spark.createDataFrame(x, SCHEMA), "latin") for x in (s1, target))
    config = bl.BlockingConfig(version=2, mode="latin")
    named = bl.generate_candidates(a, b, config)
    assert "Exchange" not in _plan(named) and "Exchange" not in _plan(bl.candidate_positions(a, b, config))
    want, _ = model(s1, target, config)
    sid, tid = {p: i for p, i, *_ in s1}, {p: i for p, i, *_ in target}
    pairs = {}
    for p, t in want:
        x, y = pairs.get((sid[p], tid[t]), (p, t))
        pairs[sid[p], tid[t]] = min(p, x), min(t, y)
    assert {(r.s1_id, r.target_id): (r.s1_pos, r.t_pos) for r in named.collect()} == pairs
    index = key_index(a, b, config)
    assert {r.s1_id: r.n for r in probed(index, config, "ids").collect()} == Counter(i for i, _ in pairs)
    brief = {r.s1_pos: (r.n, r.t_pos_sum) for r in probed(index, config, "brief").collect()}
    assert brief == {p: (len(ts), sum(ts)) for p in {p for p, _ in want} for ts in [[t for q, t in want if q == p]]}
    every = spark.createDataFrame(sorted({(i, j) for i in sid.values() for j in tid.values()}), "s1_id string, target_id string")
    assert {tuple(r) for r in met(every, index).collect()} == set(pairs)


def test_cells_and_steps_of_any_size_give_the_same(spark, monkeypatch):
    from kinlink.operators import probing

    s1, target = make(6, 40, 80)
    a, b = (entity_features(spark.createDataFrame(x, SCHEMA), "latin") for x in (s1, target))
    config = bl.BlockingConfig(version=1, mode="latin")
    want, _ = model(s1, target, config)
    index = probing.key_index(a, b, config)
    for keys in (200, 10_000):
        monkeypatch.setattr(probing, "SHARD_KEYS", keys)
        monkeypatch.setattr(probing, "CHUNK_KEYS", keys)
        assert {tuple(r) for r in probing.probed(index, config, "pairs").collect()} == want
    parts = [pickle.loads(next(make_blob(iter(df.toArrow().to_batches()))).column(0)[0].as_py()) for make_blob, df in ((probing._shard, index[1]), (probing._chunk, index[0]))]
    got = []
    for n in (1, 7, 1000):
        monkeypatch.setattr(probing, "BATCH_PAIRS", n)
        steps = list(probing._cells(*parts, False))
        got.append((len(steps), [(int(x), int(y)) for r, c, _ in steps for x, y in zip(r, c)]))
    assert got[0][1] == got[1][1] == got[2][1] and got[0][0] > got[1][0] > got[2][0] == 1
