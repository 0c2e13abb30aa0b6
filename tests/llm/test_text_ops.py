"""One form of look-alike text, containers, mixing and spam: units, edge cases and brute force."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kinlink.llm.lookalike import look, lookalike_pairs
from kinlink.llm.mixing import flight, land, mix, mix_report
from kinlink.llm.packing import bucket_bounds, container_report, pack, plan
from kinlink.llm.spam import SENTENCE, segments, spam_scores
from kinlink.llm.tokens import TOKENIZER, token_sizes


def test_look():
    same = ["Acme Café", "Acme Café", "Ａｃｍｅ Ｃａｆé", "Ac​me Café ", "Асmе Саfé", "﻿Acme　Café­"]
    assert {look(s) for s in same} == {"Acme Café"}
    assert look("co‑op") == look("co-op") == look("co−op") and look("ﬁne ﬆ") == "fine st"
    assert look("ACME") != look("acme") and look("ACME", fold=True) == look("acme", fold=True) and look("cafe") != look("café")
    assert look(None) is None and look("") == "" and look(" ​ ") == "" and look("Straße", fold=True) == "strasse"
    assert look("a\u0600b") == "a\u0600b" and look("a\u06ddb\u070f") == "a\u06ddb\u070f"  # format characters that are seen
    assert look("a\u2065b\ufff0\u180e\U000e0100") == "ab"  # ignorable, assigned or not
    assert look("x" * 200_000 + "​") == "x" * 200_000


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=30))
def test_look_is_stable(s):
    assert look(look(s)) == look(s)


def test_lookalike_pairs(spark):
    data = [("1", "Acme"), ("2", "Асme"), ("3", "acme"), ("4", "Acme"), ("2", "Асme"), ("5", None), (None, "Acme"), ("6", "Ａcme")]
    df = spark.createDataFrame([(*r, 1) for r in data], "id string, name string, raw int")
    got = sorted(tuple(r) for r in lookalike_pairs(df, "id", "name").collect())
    forms = {}
    for i, n in data:
        if i and n:
            forms.setdefault(i, n)
    want = sorted((a, b) for a in forms for b in forms if a < b and look(forms[a]) == look(forms[b]) and forms[a] != forms[b])
    assert got == want and got
    assert lookalike_pairs(df.limit(0), "id", "name").count() == 0


# -- containers --------------------------------------------------------------------------------------------------------


def test_bucket_bounds_are_optimal():
    from itertools import combinations

    r = random.Random(1)
    for _ in range(20):
        h = {r.randint(1, 30): r.randint(1, 9) for _ in range(8)}
        sizes = sorted(h)
        pad = lambda bounds: sum((min(b for b in bounds if b >= s) - s) * c for s, c in h.items())
        best = min(pad((*c, sizes[-1])) for c in combinations(sizes[:-1], min(2, len(sizes) - 1)))
        assert pad(bucket_bounds(h, 3)) == best
    assert bucket_bounds({}) == [] and bucket_bounds({5: 2}) == [5]


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 50), max_size=20), st.booleans())
def test_plan_places_everything_once(h, top_up):
    left = dict(h)
    for _, times, take in plan(h, 40, bucket_bounds(h, 4), top_up):
        assert sum(s * n for s, n in take.items()) <= 40
        for s, n in take.items():
            left[s] -= n * times
    assert not any(left.values())
    with pytest.raises(ValueError):
        plan({41: 1}, 40, [41])


@pytest.mark.parametrize("seed", [1, 2])
def test_pack(spark, seed):
    r = random.Random(seed)
    data = [(i, r.choice([3, 3, 3, 7, 50, 99, 100, 101, 1000, r.randint(1, 120)])) for i in range(400)] + [(1000, 0), (1001, None)]
    df = spark.createDataFrame([(a, b, "x") for a, b in data], "doc_id long, n_tokens long, piece string")
    kinds = {"a": 100, "b": 37}
    got = pack(df, kinds).collect()
    for kind, cap in kinds.items():
        mine = [x for x in got if x.container_kind == kind]
        total, room = {}, {}
        for x in mine:
            total[x.container_no] = total.get(x.container_no, 0) + x.n_tokens
            room.setdefault(x.container_no, x.unused)
            assert room[x.container_no] == x.unused
        assert all(t + room[c] == cap for c, t in total.items())
        per = {}
        for x in mine:
            per.setdefault(x.doc_id, []).append((x.piece, x.n_tokens))
        assert {d: sum(n for _, n in p) for d, p in per.items()} == {d: n for d, n in data if n}
        assert all(len(p) == max(1, -(-dict(data)[d] // cap)) for d, p in per.items())
        assert sum(total.values()) / (cap * len(total)) > 0.9
    rep = {x.container_kind: x for x in container_report(pack(df, kinds), kinds).collect()}
    assert rep["a"].unused == rep["a"].capacity * rep["a"].n_containers - rep["a"].n_tokens
    assert pack(df.limit(0), kinds).count() == 0
    with pytest.raises(ValueError):
        pack(df, {"z": 0})


def test_token_sizes(spark):
    import os

    if not os.path.exists(TOKENIZER):
        pytest.skip("no tokenizer")
    df = spark.createDataFrame([(1, "hello world", "s"), (1, "hello world", "s"), (2, "", "s"), (3, None, "s"), (None, "x", "s"), (4, "a " * 50_000, None)], "doc_id long, text string, source string")
    got = {r.doc_id: r.n_tokens for r in token_sizes(df, "doc_id", "text", ["source"]).collect()}
    assert got[1] == 2 and set(got) == {1, 4} and got[4] >= 50_000


# -- mixing ------------------------------------------------------------------------------------------------------------


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.floats(0.05, 0.95), st.integers(1, 500)), max_size=60), st.integers(0, 5))
def test_flight_keeps_the_sums(units, seed):
    pi, tk = [u[0] for u in units], [float(u[1]) for u in units]
    got = flight(pi, tk, random.Random(seed))
    assert sum(1 for p in got if 0 < p < 1) <= 2
    assert abs(sum(got) - sum(pi)) < 1e-5 and abs(np.dot(got, tk) - np.dot(pi, tk)) < 1e-3
    assert all(p in (0.0, 1.0) for p in land(got, tk))


def test_flight_keeps_probabilities():
    pi, tk = [0.3, 0.5, 0.2, 0.7, 0.4, 0.6], [10.0, 20.0, 5.0, 8.0, 30.0, 12.0]
    mean = np.mean([flight(pi, tk, random.Random(s)) for s in range(3000)], axis=0)
    assert np.abs(mean - pi).max() < 0.04


def test_mix(spark):
    r = random.Random(4)
    data = [(i, r.choice(["a", "a", "a", "b", "c", None, "unwanted"]), r.randint(1, 300)) for i in range(4000)] + [(10**6, "a", 30_000)]
    df = spark.createDataFrame([(*x, 9) for x in data], "doc_id long, source string, n_tokens long, pi int")
    targets = {"a": (0.3, 1), "b": (0.4, 3), "c": (0.2, 4), "nobody": (0.1, 2)}
    got = mix(df, targets, block=200)
    rows = got.collect()
    assert len(rows) == len(data) and len({x.doc_id for x in rows}) == len(data)
    assert all(x.n_uses == 0 for x in rows if x.source in (None, "unwanted")) and all(x.n_uses <= targets[x.source][1] for x in rows if x.source in targets)
    t = spark.createDataFrame([(s, v[0], v[1]) for s, v in targets.items()], "source string, target_share double, max_repeats int")
    rep = {x.source: x for x in mix_report(got, t).collect()}
    for s in "abc":
        assert abs(rep[s].share - targets[s][0] / 0.9) < 0.01
    assert rep["nobody"].share == 0
    assert sorted(map(tuple, rows)) == sorted(map(tuple, mix(df.repartition(3), targets, block=200).collect()))  # the same at any layout
    assert mix(df.limit(0), targets).count() == 0


# -- spam --------------------------------------------------------------------------------------------------------------

HONEST = "I have used this kettle for two weeks and the switch still looks new. My sister warned me about it, and she was right. Delivery was early. Setup took 20 minutes."
SPAM = [
    "kettle cheap, kettle sale, best kettle, kettle online, kettle cheap, kettle sale, best kettle, kettle online, kettle cheap, best kettle",
    "http://a.example/x http://b.example/y www.c.test/z https://d.invalid/p/1 http://e.example/q http://f.example/r",
    "#kettle #bestkettle #cheap_kettle #kettlesale #kettleonline #newkettle #topkettle #kettle2 #kettle3",
    "Every red kettle buyer trusts our red kettle. Buy red kettle here because red kettle is what red kettle fans want. No red kettle beats this red kettle, so get red kettle today.",
    "KET-1234\nkettle 30cm\nkettle>toaster\nred kettle\nKET-9999\nkettle 5L\nblue kettle\nkettle>drill\nKET-7777",
]


def _share(t):
    s = segments(t)
    return sum(x.chars for x in s if x.kind != SENTENCE) / max(1, sum(x.chars for x in s))


def test_segments():
    assert _share(HONEST) == 0
    for t in SPAM:
        assert _share(t) > 0.5, t
        assert _share(HONEST * 4 + " " + t) < 0.5, t
    assert _share(HONEST + " #kettle #nice https://x.example/y") < 0.5
    assert segments("") == [] and segments(" .!, \n - ") == []
    # pages about different things share phrases: links, tags, codes and a page's own words are marks
    a, b = (segments(SPAM[3].replace("red kettle", x))[0].phrases for x in ("red kettle", "blue tent"))
    assert set(a) & set(b) and len(segments("x" * 100_000 + " " + "y " * 100_000)) == 1


def _flags(df):
    return {r.doc_id: r.is_spam for r in spam_scores(df, "doc_id", "text", "source").collect()}


def test_spam_scores(spark):
    """Spam is flagged where its phrases stand in lists of several hosts, however it words them; honest texts and remarks are not."""
    other = [t.replace("kettle", "tent").replace("KET", "TEN").replace("red", "big").replace("x http", "x/y http") for t in SPAM]
    data = [(i, t, f"shop{i % 3}") for i, t in enumerate([HONEST, *SPAM])] + [(10 + i, t, f"shop{(i + 1) % 3}") for i, t in enumerate([HONEST, *other])]
    data += [(20 + i, t, f"shop{(i + 2) % 3}") for i, t in enumerate([HONEST, *SPAM]) if i in (1, 5)]
    data += [(31, SPAM[0] + ", best kettle sale", "shop0"), (35, SPAM[4] + "\nred tent", "shop1")]
    data += [(50, None, "a"), (51, " ", "a"), (52, "ok", None), (1, SPAM[0], "shop1"), (53, "word " * 40_000, "x"), (None, HONEST, "x")]
    df = spark.createDataFrame([(*x, 0) for x in data], "doc_id long, text string, source string, host int")
    got = _flags(df)
    assert all(got[i] for i in (1, 2, 3, 4, 5, 31, 35)) and not any(got[i] for i in (0, 10, 52)) and 50 not in got and 51 not in got and None not in got
    assert spam_scores(df.limit(0), "doc_id", "text", "source").count() == 0


def test_one_host_replicates_nothing(spark):
    """List density alone flags nothing: with a single host no phrase is replicated."""
    data = [(i, t + f" no {i % 7}x", "one") for i, t in enumerate(SPAM * 5)]
    assert not any(_flags(spark.createDataFrame(data, "doc_id long, text string, source string")).values())


def test_open_texts_by_phrases(spark):
    """A list that its own form does not give away is known by phrases that stand in lists of several shops."""
    salad = "blue tent sale red lamp offer green chair deal big sofa bargain blue tent sale"
    lists = [(i, f"blue tent sale, red lamp offer, green chair deal, big sofa bargain, blue lamp sale, lamp offer {i}, tent sale red, offer green chair", f"s{i}") for i in range(3)]
    df = spark.createDataFrame([*lists, (9, salad, "s9"), (10, HONEST, "s9")], "doc_id long, text string, source string")
    got = _flags(df)
    assert got[9] and not got[10]
    assert not _flags(df.where(F.col("doc_id") >= 9))[9]


def test_many_stuffed_phrases(spark):
    """Sentences built round ten phrases in turn are as well known by the phrases between them as those built round one."""
    words = ["oak table", "pine chair", "desk lamp", "wool rug", "steel pan", "tea pot", "bath mat", "bed frame", "wall clock", "sofa bed"]
    page = [f"Buy {w} here because {w} is what {w} fans want. Every {w} buyer trusts our {w}." for w in words]
    data = [(i, " ".join([page[i]] * 3), f"s{i}") for i in range(3)] + [(10, " ".join(page), "s9"), (11, HONEST, "s9")]
    got = _flags(spark.createDataFrame(data, "doc_id long, text string, source string"))
    assert all(got[i] for i in (0, 1, 2, 10)) and not got[11]
