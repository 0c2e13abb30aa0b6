import pytest
from conftest import rows
from pyspark.sql import functions as F

from kinlink.functions import similarity as sim
from kinlink.functions import text as tx
from kinlink.functions.translit import romanize, unicode_normalize

CASES = [("ABC Pvt. Ltd.", "abc pvt ltd"), ("  Tata   Motors, Inc. ", "tata motors inc"), ("McDonald's Barbershop", "mcdonalds barbershop"), ("Café Élite", "cafe elite"), (None, ""), ("A&B", "a and b"), ("", "")]


@pytest.mark.parametrize("mode", ["full", "latin"])
def test_normalize_text(spark, mode):
    df = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(CASES)], "i int, a string")
    got = [r.v for r in df.orderBy("i").select(tx.normalize_text("a", mode).alias("v")).collect()]
    assert got == [b for _, b in CASES]
    again = spark.createDataFrame([(v,) for v in got], "a string").select(tx.normalize_text("a", mode).alias("v"))
    assert [r.v for r in again.collect()] == got  # idempotent


def test_romanize():
    assert romanize("नेक्किएबेलान") == "nekkiebelan"
    assert romanize("Бонпагепу") == "Bonpagepu"
    assert romanize("Ａｂﬆ ß") == "Abst ss"
    assert romanize(None) == "" and unicode_normalize(None) == ""
    for text in ("हिन्दी नाम", "ಕನ್ನಡ ಹೆಸರು", "漢字", "x‍y"):
        assert romanize(text).isascii()
    assert romanize("हिन्दी").strip() and not any("ऀ" <= c <= "ॿ" for c in romanize("हिन्दी"))


def test_country_and_core(spark):
    df = spark.createDataFrame([("USA",), ("United States",), ("India",), ("IN",), ("U.S.A.",), ("Deutschland",), (None,)], "c string")
    assert [r.v for r in df.select(tx.normalize_country("c").alias("v")).collect()] == ["us", "us", "india", "india", "u s a", "deutschland", ""]
    df = spark.createDataFrame([("abc technologies pvt ltd",), ("ltd",), ("co a co b",), ("",)], "n string")
    assert [r.v for r in df.select(tx.normalize_name_core("n").alias("v")).collect()] == ["abc technologies", "", "a b", ""]


def test_token_sets(spark):
    df = spark.createDataFrame([("12b main main street ab apt 007",), ("",), ("ab",), ("abcd",)], "n string")
    got = df.select(
        tx.tokens("n"), tx.address_tokens("n"), tx.address_location_tokens("n"), tx.numeric_tokens("n"), tx.char_ngrams("n"), tx.token_pairs(tx.tokens("n"))
    ).collect()
    assert list(got[0])[:4] == [["12b", "main", "street", "ab", "apt", "007"], ["12b", "main", "007"], ["main"], ["12", "007"]]
    assert list(got[1]) == [[], [], [], [], [], []]
    assert got[2][4] == ["ab"] and got[3][4] == ["abc", "bcd"]
    assert len(got[0][5]) == 15 and all(a < b for a, b in (p.split(tx.SEP) for p in got[0][5]))


def test_lists_and_ascii(spark):
    df = spark.createDataFrame([(" a ,b,, a",), (None,), ("",)], "v string")
    got = df.select(tx.split_ids("v"), tx.split_ids_list("v"), tx.parse_truth_ids("v")).collect()
    assert list(got[0]) == [["a", "b"], ["a", "b", "a"], [" a ", "b", " a"]]
    assert list(got[1]) == [[], [], []] == list(got[2])
    df = spark.createDataFrame([("abc ",), ("é",), (None,)], "v string")
    assert [r[0] for r in df.select(tx.is_ascii_name("v")).collect()] == [False, False, True]
    df = spark.createDataFrame([(None,), (" ",), ("NA",), ("n/a",), ("-",), ("Nab",)], "v string")
    assert [r[0] for r in df.select(tx.missing("v")).collect()] == [True] * 5 + [False]


def _levels(a, b):
    m = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            m[i + 1][j + 1] = m[i][j] + 1 if x == y else max(m[i][j + 1], m[i + 1][j])
    return m[-1][-1]


def test_similarity(spark):
    import random

    r = random.Random(3)
    for _ in range(500):
        a, b = ("".join(r.choice("abc ") for _ in range(r.randint(0, 80))) for _ in "12")
        assert sim.lcs_length(a, b) == _levels(a, b)
    assert sim.indel("", "") == 1.0 and sim.indel("a", "") == 0.0
    assert abs(sim.indel("kitten", "sitting") - 8 / 13) < 1e-12
    assert sim.token_set("a b", "b a c") == 1.0 and sim.token_set("", "a") == 0.0
    df = spark.createDataFrame([(["a", "b"], ["b", "c"]), ([], []), (["a"], [])], "a array<string>, b array<string>")
    assert [round(x[0], 6) for x in df.select(sim.jaccard("a", "b")).collect()] == [0.333333, 1.0, 0.0]
    df = spark.createDataFrame([("ab", None), (None, None)], "a string, b string")
    assert [tuple(x) for x in df.select(sim.indel_ratio("a", "b"), sim.token_set_ratio("a", "b")).collect()] == [(0.0, 0.0), (1.0, 0.0)]
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 1.0), (0.5, 1.0)], "p double, r double")
    assert [round(x[0], 6) for x in df.select(sim.fbeta("p", "r")).collect()] == [0.0, 1.0, round(1.25 * 0.5 / (0.125 + 1), 6)]
    df = spark.createDataFrame([("US", "us"), ("US", "USA")], "a string, b string")
    assert rows(df.select(sim.country_equal_raw("a", "b"))) == [(0,), (1,)]
    assert rows(df.select(F.col("a"), sim.token_jaccard("a", "b"))) == [("US", 0.0), ("US", 1.0)]


def test_scripts_without_decomposition():
    from kinlink.functions.translit import romanize

    want = {"서울": "seoul", "さくら": "sakura", "ラーメン": "ramen", "שלום": "shlvm", "محمد": "mhmd", "თბილისი": "tbilisi", "Երևան": "Erewan", "東京 Café": "   Cafe"}
    assert {k: romanize(k) for k in want} == want


def test_measures_at_once_are_those_of_each_pair():
    """F16: ratios, words, grams and numbers of a batch in arrays, beside the same one pair at a time."""
    import random
    import re

    import pyarrow as pa

    from kinlink.functions import at_once, similarity

    r = random.Random(2)
    words = ["abc", "zulu", "12", "007", "x", "kästner", "名", "trading", "ltd", "a1b22", "q" * 30]
    text = lambda: " ".join(r.choice(words) for _ in range(r.randint(0, 6)))
    a = [text() for _ in range(600)] + ["", "x", "a", ""]
    b = [x if r.random() < 0.1 else text() for x in a[:600]] + ["", "", "aaaa", "b c"]
    got = at_once.pair_measures(*[pa.array(x) for x in (a, b, a, b, a, b)], 3)
    share = lambda x, y: len(x & y) / len(x | y) if x | y else 1.0
    grams = lambda s: ({s} if len(s) <= 3 else {s[i : i + 3] for i in range(len(s) - 2)}) if s else set()
    bare = lambda s: s.replace(" ", "")
    for name, one in {
        "name_ratio": similarity.indel, "address_ratio": similarity.indel, "name_token_set_ratio": similarity.token_set, "name_jaccard": lambda x, y: share(set(x.split()), set(y.split())),
        "address_char_jaccard": lambda x, y: share(grams(bare(x)), grams(bare(y))), "numeric_overlap": lambda x, y: share(set(re.findall("[0-9]+", x)), set(re.findall("[0-9]+", y))),
    }.items():
        assert got[name].to_pylist() == [one(x, y) for x, y in zip(a, b)], name
    none = at_once.pair_measures(*[pa.array([None], pa.string())] * 6)
    assert none["name_ratio"].to_pylist() == [1.0] and none["name_jaccard"].to_pylist() == [None]
