"""Splits, places, name variants and sites: units, edge cases and brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinlink.llm.address import EMPTY, osa, parse, same_place
from kinlink.llm.classes import link_classes
from kinlink.llm.entities import best_left, best_sites, one_to_one, one_to_one_sites, ranked, site_candidates, solve
from kinlink.llm.names import NO_NAME, Lexicon, OrgName, parse_name, same_org
from kinlink.llm.neighbours import Gate, letter_mask, window_pairs
from kinlink.llm.places import place_classes, place_pairs
from kinlink.llm.splits import grouped_splits, place, tied_pairs
from kinlink.llm.trie import Trie
from kinlink.llm.variants import form_links, name_classes, shard_keys, variant_pairs


def full_osa(a, b):
    d = [[max(i, j) if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def test_distances_and_trie():
    r = random.Random(2)
    words = ["".join(r.choice("abc") for _ in range(r.randint(0, 8))) for _ in range(120)]
    for k in (0, 1, 2, 3):
        t = Trie()
        for i, w in enumerate(words):
            t.add(w, i)
        for q in words[:40]:
            assert set(t.search(q, k)) == {i for i, w in enumerate(words) if full_osa(q, w) <= k}
            assert all(osa(q, w, k) == min(full_osa(q, w), k + 1) for w in words[:60])


# -- splits ------------------------------------------------------------------------------------------------------------


def test_grouped_splits(spark):
    r = random.Random(5)
    ids = [f"r{i}" for i in range(1500)]
    links = [(x, f"e{r.randint(0, 2500)}") for x in ids for _ in range(r.randint(0, 2))] + [(f"r{i}", "hub") for i in range(300)] + [(None, "e1"), ("r1", None)]
    labels = [(x, r.choice(["common", "common", "common", "rare"])) for x in ids if r.random() < 0.9] + [("r1", None)]
    rec = spark.createDataFrame([(x, 1) for x in ids + ids[:50]] + [(None, 1)], "record_id string, component int")
    got = grouped_splits(rec, spark.createDataFrame(links, "record_id string, entity string"), spark.createDataFrame(labels, "record_id string, label string"), {"train": 0.7, "valid": 0.2, "test": 0.1}).collect()
    split = {x.record_id: x.split_name for x in got}
    assert len(got) == len(ids) == len(split)
    by = {}
    for a, e in links:
        if a and e:
            by.setdefault(e, set()).add(split[a])
    assert all(len(s) == 1 for s in by.values())
    for s, share in (("train", 0.7), ("valid", 0.2), ("test", 0.1)):
        assert abs(sum(v == s for v in split.values()) / len(ids) - share) < 0.03
    none = spark.createDataFrame([], "record_id string, entity string")
    assert grouped_splits(rec.limit(0), none, none.select("record_id", F.col("entity").alias("label")), {"a": 1.0}).count() == 0
    comps = spark.createDataFrame([("a", 1), ("b", 1), ("c", 2), ("d", 1)], "record_id string, component int")
    assert sorted(tuple(x) for x in tied_pairs(comps).collect()) == [("a", "b"), ("a", "d"), ("b", "d")]


def test_rarest_label_first():
    vectors = [(np.array([0]), np.array([1.0]))] * 10 + [(np.array([1]), np.array([1.0]))] * 90
    sizes, total, shares = np.ones(100), np.array([10.0, 90.0, 100.0]), np.array([0.8, 0.2])
    got = place(vectors, sizes, np.outer(shares, total), shares)
    assert (got[:10] == 1).sum() == 2 and (got[10:] == 1).sum() == 18
    assert set(place(vectors, sizes, np.outer([1.0, 0.0], total), np.array([1.0, 0.0]))) == {0}


def test_more_labels_than_a_row_has_columns(spark):
    """1,500 labels, two records each: every label ends in both of two equal splits; more labels than allowed are an error."""
    rec = spark.range(3000).select(F.col("id").cast("string").alias("record_id"))
    labels = rec.select("record_id", (F.col("record_id").cast("int") % 1500).cast("string").alias("label"))
    none = spark.createDataFrame([], "record_id string, entity string")
    got = grouped_splits(rec, none, labels, {"a": 0.5, "b": 0.5})
    by = got.join(labels, "record_id").groupBy("label").agg(F.count_distinct("split_name").alias("n")).where("n = 2").count()
    assert by == 1500
    with pytest.raises(ValueError):
        grouped_splits(rec, none, labels, {"a": 1.0}, max_labels=1000)


# -- addresses ---------------------------------------------------------------------------------------------------------

SAME = [
    ("Suite 5, 194 West Ornubuni Square, Gerzincombe, Drulmi 13681", "194 W Ornubuni Sq.\nbehind Post Office\nGerzinconbe\n136 81"),
    ("Plaza Salsilo, 170A, Trorvarvale, Rilgo 75291", "75291 Trorvarvale Pza. Salsilo, 170-A"),
    ("Genivideviweg 375, Vegonpura, Risus 49818", "Genivideviwg. 375 - Vegonpura"),
    ("Vovelilusstraße 85, Zumgungarh 46884", "8. OG, Vovelilusstr. 85, Zumgungarh"),
    ("59 boulevard Sibakozu; 87670 Bimkithorpe", "87670 Bimkithorpe - 59, Bld Sibakozu"),
    ("17 Garzisare Avenue, Vegongarh, Hurfo HR20 1XQ", "Garzisare House, 17 Garzisare Ave, Vegongarh, HR201XQ, UK"),
    ("#Three Ilkizobul Str; Nopitown. 672 46", "3 Ilkizobul Street, Nopitown 67246"),
    ("79 R Ilkizos, Broszibrook", "Rua Ilkizos, 79, Broszibrook, Flisus 60850-710"),
    ("10250 Santa Monica Blvd, Los Angeles, CA 90067", "10250 Santa Monica Boulevard, Los Angeles 90067"),
    ("12345 Kestrel Road, Springfield", "12345 Kestrel Rd. Springfield"), ("100 Fifth Avenue, New York, NY 10011", "100 5th Ave New York NY 10011"),
    ("Rua Dom Pedro, 37, Sao Paulo", "37 rua dom pedro sao paulo"), ("12-14 Elm Street, Leeds", "12-14 Elm St Leeds"), ("12 Kestrel Road, South Bend", "12 Kestrel Rd; South Bend"),
    ("12 Martin Luther King Road, Leeds", "Martin Luther Kign Rd. 12, Leeds"), ("44417 Bimkioaks Ulbobinin Allee 192", "Ulbobininallee 192, Bimkioaks"),
    ("8 North Street, Leeds", "8 North St, Leeds"), ("20340 dalvorrigg nine unpypufar la.", "9 Unpupufar Lane, Dalvorrigg, Borfe 20340"),
]
OTHER = [
    ("207A Gesvezir Road, Bimkithorpe 87622", "207 Gesvezir Road, Bimkithorpe 87622"), ("207 Gesvezir Road, Bimkithorpe 87622", "209 Gesvezir Road, Bimkithorpe 87622"),
    ("207 Gesvezir Road, Bimkithorpe 87622", "207 Gesvezir Lane, Bimkithorpe 87622"), ("207 North Gesvezir Road, Bimkithorpe", "207 South Gesvezir Road, Bimkithorpe"),
    ("313 Indavezir Road, Stosmeborough, Tenfu 29422", "313 Indavezir Road, Grorgopura, Tenfu 29522"), ("12 Alphastreet Road, Bimkithorpe", "12 Omegaplace Road, Bimkithorpe"),
    ("5 Old Mill Road, Springfield", "5 New Mill Road, Springfield"), ("12 Martin Luther King Road", "12 Stephen King Road"),
    ("12345 Kestrel Road, Springfield", "12346 Kestrel Road, Springfield"), ("12345 Kestrel Road, Springfield", "Kestrel Road, Springfield 12345"),
    ("12 Elm Street, New Leeds", "12 Elm Street, New York"), ("10 10th Street, Boston", "10 20th Street, Boston"), ("12-14 Elm Street, Leeds", "12 Elm Street, Leeds"),
    ("12 Elm Street, York", "12 Elm Street, Bath"), ("12 Kestrel Road, South Bend", "12 South Kestrel Road, Bend"), ("37 rua dom pedro sao paulo", "37 rua dom afonso sao paulo"),
    ("37 rua dom pedro sao paulo", "Rua Dom Pedro, 37, Lisboa"),
]


@pytest.mark.parametrize("a,b", SAME)
def test_same_place(a, b):
    assert same_place(parse(a), parse(b)) == same_place(parse(b), parse(a)) == 2, (parse(a), parse(b))


@pytest.mark.parametrize("a,b", OTHER)
def test_other_place(a, b):
    assert same_place(parse(a), parse(b)) == 0


def test_address_parts():
    a = parse("10250 Santa Monica Blvd, Los Angeles, CA 90067")
    assert (a.number, a.street, a.region, a.postcode) == ("10250", "santa monica", "ca", "90067") and "angeles" in a.town
    assert parse("12345 Kestrel Road, Springfield").number == "12345" and parse("12-14 Elm Street").number == "12-14"
    assert parse("10 10th Street, Boston").ok and parse("8 North Street, Leeds").street == "north" and parse("12 Elm Street, Leeds").town == "leeds"


def test_regions_by_evidence(spark):
    """A single name that others state behind a town is a region: the address then misses its town and is no contradiction."""
    data = [("a", "12 Kestrel Road, Nortonia, Wessa"), ("b", "12 Kestrel Rd, Wessa"), ("c", "9 Oak Lane, Suttonia, Wessa"), ("d", "14 Pine Road, Nortonia, Wessa")]
    got = {r.id: r.place for r in place_classes(spark.createDataFrame(data, "id string, t string"), "id", "t").collect()}
    assert got["a"] == got["b"] and len(set(got.values())) == 3
    apart = {r.id: r.place for r in place_classes(spark.createDataFrame(data[:2], "id string, t string"), "id", "t").collect()}
    assert apart["a"] == apart["b"]  # stated behind the town of the other address itself


def test_address_edges():
    assert parse(None) == parse("") == EMPTY and not parse("NA").ok and not parse("-").ok
    for t in ("word " * 20_000, "12 " * 20_000, "near " * 10_000, "a" * 100_000, "𝔘 ʼ, ,;;", "\x00\x01"):
        parse(t)
    assert same_place(EMPTY, EMPTY) == 0


def test_place_classes(spark):
    data = [(f"a{i}", a) for i, (a, _) in enumerate(SAME)] + [(f"b{i}", b) for i, (_, b) in enumerate(SAME)] + [("n1", None), ("n2", "NA"), (None, SAME[0][0]), ("a0", SAME[0][0]), ("c0", SAME[0][0])]
    df = spark.createDataFrame([(*x, "z") for x in data], "entity_id string, business_address string, place string")
    got = place_classes(df, "entity_id", "business_address").cache()
    pairs = {tuple(r) for r in place_pairs(got).collect()}
    assert {(f"a{i}", f"b{i}") for i in range(len(SAME))} <= pairs and ("a0", "c0") in pairs
    assert len(pairs) == len(SAME) + 2 and not {"n1", "n2"} & {r.id for r in got.collect()}
    assert place_classes(df.limit(0), "entity_id", "business_address").count() == 0


def test_windows_cross_partitions(spark):
    """All neighbours within the window are met whatever the number of partitions, ties included."""
    data = [(i, f"{i // 3:04d}", i, 0) for i in range(200)]
    df = spark.createDataFrame(data, "id long, k string, v long, m long")
    order = sorted(data, key=lambda x: (x[1], x[0]))
    want = {(min(a[0], b[0]), max(a[0], b[0])) for i, a in enumerate(order) for b in order[i + 1 : i + 5]}
    for parts in (1, 3, 50, 190):
        got = window_pairs(df, [F.col("k"), F.lit(None).cast("string")], "id", ["v"], Gate(masks=(("m", 0),)), lambda a, b: 1, 5, parts)
        assert {(r.a, r.b) for r in got.collect()} == want
    assert window_pairs(df.limit(0), [F.col("k")], "id", ["v"], Gate(), lambda a, b: 1, 5).count() == 0
    assert letter_mask("") == 0 and bin(letter_mask("abca")).count("1") == 3


def test_link_classes(spark):
    nodes = spark.createDataFrame([(i,) for i in range(1, 10)], "node long")
    links = spark.createDataFrame([(1, 2, 2), (3, 4, 2), (2, 5, 1), (6, 1, 1), (6, 3, 1), (7, 8, 1)], "a long, b long, score int")
    got = dict(map(tuple, link_classes(nodes, links).collect()))
    assert got[1] == got[2] and got[3] == got[4] and got[7] == got[8] and got[9] == 9
    assert len({got[1], got[3], got[5], got[6]}) == 4  # two unsure links each: nobody joins
    assert link_classes(nodes.limit(0), links.limit(0)).count() == 0


# -- names -------------------------------------------------------------------------------------------------------------

VARIANTS = [
    ("William Tulukizular Foods", "W. Tlkzlr Food Products Corp"), ("Irsatifar Notiomfe Engineering", "IRSATIFARNOTIOMFE ENGG LTD"), ("Flolvuker Setuwenfu Jewellers", "Setuwenfu Flolvyker Jwlrs"),
    ("Emnopozem Sefegrupi Packaging SA", "Emno pozem Safegrupi Packg. Co"), ("Josefina Honbasase & Co-Owners Manufacturing", "Honbaesase, Josefina & Co-Owners Mfg"),
    ("Бонпагепу Рувеирса Цхемицалс", "Bonpagepu Ruveirsa Chemicals Limited"), ("टास्राटिवाटेन जुलार्लोन्सा एलेच्ट्रोनिच्स", "Tasrativaten Zularlonsa Electronics"),
    ("Robert Fedopopukin & Sons Packaging", "Bob Fed0popukin & Sons Packaging (Town) - Head Office"), ("Ricһard Gurbupavuѕ Paсkaging", "Richard Gurbupavus Packaging Inc"),
]
DIFFERENT = [
    ("Habimenapi Kifolguta Dairy", "Habimenapi Kifolguta Seeds"), ("Binomaris Nemiselfa Textiles", "Binomaris Nemispifa Textiles"), ("Petuzasobo Fipopifa Construction", "Petuzasobo Fipoelfa Construction"),
    ("Richard Elfarisos Motors", "William Elfarisos Motors"), ("Acme Foods", None),
]


@pytest.mark.parametrize("a,b", VARIANTS)
def test_same_org(a, b):
    assert same_org(parse_name(a), parse_name(b)) == same_org(parse_name(b), parse_name(a)) == 2, (parse_name(a), parse_name(b))


@pytest.mark.parametrize("a,b", DIFFERENT)
def test_different_org(a, b):
    assert same_org(parse_name(a), parse_name(b)) == 0


def test_name_edges():
    assert parse_name(None) == parse_name("") == parse_name("N/A") == NO_NAME and not parse_name("Ltd").ok
    long = parse_name("wordum " * 20_000)
    assert same_org(long, parse_name("wordom " * 20_000)) in (0, 1)
    assert same_org(parse_name("Binomaris Nemiselfa"), parse_name("Binomaris Nemiselfa Textiles")) == 1


def test_variant_pairs(spark):
    left = [(f"a{i}", a) for i, (a, _) in enumerate(VARIANTS)] + [("x", None), ("y", "NA"), ("e", "Zebu Quorra Motors")]
    right = [(f"b{i}", b) for i, (_, b) in enumerate(VARIANTS)] + [("e2", "Zebu Quorra Motors"), ("e2", "Zebu Quorra Motors"), ("e3", "Zebu Quorra Motors Ltd"), (None, "Zebu Quorra Motors Co")]
    a, b = (spark.createDataFrame([(*r, 0) for r in x], "id string, text string, cls int") for x in (left, right))
    classes = name_classes(a, b).cache()
    got = {tuple(r) for r in variant_pairs(a, b, classes).collect()}
    assert got == {(f"a{i}", f"b{i}") for i in range(len(VARIANTS))} | {("e", "e3")}
    assert name_classes(a.limit(0), b.limit(0)).count() == 0


def test_variants_of_the_right_table_alone(spark):
    """Spellings that only the right table has are one class, and tie a left name to spellings too far from it."""
    a = spark.createDataFrame([("a", "Nekiravaro Nirarginpo Laboratories")], "id string, text string")
    names = ["Nekiravato Nirarginpo Laboratories", "Nekiravato Nirargonp Laboratories", "Wolmerata Kestunipo Seeds", "Wolmerata Kestunibo Seeds", "Wolmerata Kestunipu Seeds"]
    b = spark.createDataFrame([(f"b{i}", n) for i, n in enumerate(names)], "id string, text string")
    cls = {r.text: r.cls for r in name_classes(a, b).collect()}
    assert len({cls[n] for n in names[2:]}) == 1
    assert cls[names[0]] == cls[names[1]] == cls["Nekiravaro Nirarginpo Laboratories"] != cls[names[2]]


def test_names_of_a_trade_meet_in_the_shards_of_all_words(spark):
    """Short reordered words, and words with an error in the fourth of four consonants each, share no shard of the trade."""
    left, right = ["Reno Lima Foods", "Kanbota Gedbova Motors"], ["Lima Reno Foods", "Kanbosa Gedboga Motors"]
    a, b = (spark.createDataFrame([(str(i), n) for i, n in enumerate(x)], "id string, text string") for x in (left, right))
    got = {tuple(r) for r in variant_pairs(a, b, name_classes(a, b)).collect()}
    assert got == {("0", "0"), ("1", "1")}


def test_longer_names_in_another_order(spark):
    left = ["Zebuquor Lastinum Wolmerat Kestunip Motors", "Gorvim Nadsul Tepruk Foods"]
    right = ["Kestunip Wolmerot Zebuquor Lastinum Motors", "Tepruknadsul Gorvim Foods"]
    a, b = (spark.createDataFrame([(str(i), n) for i, n in enumerate(x)], "id string, text string") for x in (left, right))
    got = {tuple(r) for r in variant_pairs(a, b, name_classes(a, b)).collect()}
    assert got == {("0", "0"), ("1", "1")}
    assert same_org(parse_name(left[0]), parse_name("Kestunip Wolmerot Zebuquor Zebuquor Motors")) == 0


def test_hot_shards_lose_nothing(spark, monkeypatch):
    """Shards cut into a grid of small parts give the same links as whole ones."""
    from kinlink.llm import variants

    r = random.Random(8)
    names = [f"Kanto{''.join(r.choice('aeiou') for _ in range(3))} Lasti{''.join(r.choice('aeiou') for _ in range(3))} Motors" for _ in range(60)]
    a = spark.createDataFrame([(str(i), n) for i, n in enumerate(names[:30])], "id string, text string")
    b = spark.createDataFrame([(str(i), n) for i, n in enumerate(names[30:])], "id string, text string")
    whole = {tuple(x) for x in variant_pairs(a, b, name_classes(a, b)).collect()}
    monkeypatch.setattr(variants, "INDEX_PART", 4)
    monkeypatch.setattr(variants, "QUERY_PART", 7)
    assert whole == {tuple(x) for x in variant_pairs(a, b, name_classes(a, b)).collect()}


# -- sites -------------------------------------------------------------------------------------------------------------


def test_sites(spark):
    schema = "pos long, entity_id string, business_name string, business_address string, country string"
    a1, a2 = "207 Gesvezir Road, Bimkithorpe, Stungo 87622", "12 Ornubuni Square, Gerzincombe, Drulmi 13681"
    left = [(0, "A1", "Habimenapi Kifolguta Dairy", a1, "US"), (1, "A2", "Habimenapi Kifolguta Dairy", a2, "US"), (2, "A3", "Zebuquor Lastinum Motors", a1, None), (3, "A4", None, None, None), (4, "A5", "Wolmerata Kestunipo Seeds", "9 Harbour Lane, Tardonquay 55512", "IN")]
    right = [
        (0, "B1", "HABIMENAPI KIFLOGUTA DAIRIES", "207 Gesvezir Rd - Bimkithorpe", "usa"), (1, "B2", "Habimenapi Kifolguta", a2, "US"), (2, "B3", "Lastinum Zebuquor Motors Ltd", "Suite 2, 207 Gesvezir Rd., 87622", "US"),
        (3, "B4", "Wolmerata Kestunipo Seeds", "NA", "IN"), (4, "B5", "Habimenapi Kifolguta Dairy", None, "US"), (5, "B6", None, "9 Harbour Ln, Tardonquay", None), (6, "B7", "Other Thing Foods", a1, "US"), (7, "B1", "HABIMENAPI KIFLOGUTA DAIRIES", "207 Gesvezir Rd - Bimkithorpe", None),
    ]
    l, r = spark.createDataFrame(left, schema).withColumn("id", F.lit(1)), spark.createDataFrame(right, schema).withColumn("side", F.lit("s"))
    cand = site_candidates(l, r).cache()
    got = {(x.left_id, x.right_id) for x in best_left(cand).collect()}
    assert got == {("A1", "B1"), ("A2", "B2"), ("A3", "B3"), ("A5", "B4"), ("A5", "B6")}
    one = [(x.left_id, x.right_id) for x in one_to_one_sites(l, r).collect()]
    assert len(one) == one_to_one(cand).count()
    assert len({a for a, _ in one}) == len(one) == len({b for _, b in one})
    assert site_candidates(l.limit(0), r).count() == 0


def _best_total(edges, left, right):
    """Greatest total of an assignment with capacities, by trying all."""
    edges = [e for e in edges if e[2] > 0]

    def go(i, cl, cr):
        if i == len(edges):
            return 0
        a, b, w = edges[i]
        best = go(i + 1, cl, cr)
        for u in range(1, min(cl[a], cr[b]) + 1):
            best = max(best, u * w + go(i + 1, cl | {a: cl[a] - u}, cr | {b: cr[b] - u}))
        return best

    return go(0, left, right)


def test_assignment_has_the_greatest_total():
    r = random.Random(7)
    for _ in range(150):
        cl, cr = {i: r.randint(1, 2) for i in range(4)}, {i: r.randint(1, 2) for i in range(4)}
        pairs = r.sample([(a, b) for a in cl for b in cr], r.randint(1, 8))
        edges = [(a, b, r.randint(1, 9)) for a, b in pairs]
        units = solve([e[0] for e in edges], [e[1] for e in edges], [e[2] for e in edges], cl, cr)
        assert min(units) >= 0 and sum(u * e[2] for u, e in zip(units, edges)) == _best_total(edges, cl, cr)
        for k, cap in cl.items():
            assert sum(u for u, e in zip(units, edges) if e[0] == k) <= cap
        for k, cap in cr.items():
            assert sum(u for u, e in zip(units, edges) if e[1] == k) <= cap


def test_one_to_one(spark):
    schema = "left_id string, right_id string, confidence double"
    edges = [("a", "x", 0.95), ("a", "y", 0.9), ("b", "x", 0.9), (None, "x", 1.0), ("b", "x", 0.9), ("c", None, 1.0)]
    got = {(r.left_id, r.right_id) for r in one_to_one(spark.createDataFrame(edges, schema)).collect()}
    assert got == {("a", "y"), ("b", "x")}
    # a chain of 200 pairs of falling confidence: no pair is left that could still be taken, exactly or by dominant pairs
    chain = [(f"l{i // 2:03d}", f"r{(i + 1) // 2:03d}", 1 - i / 1000) for i in range(200)]
    df = spark.createDataFrame(chain, schema)
    for limit, n in ((1000, 200), (6, 8)):
        got = [(r.left_id, r.right_id) for r in one_to_one(df.limit(n), limit).collect()]
        a, b = {x for x, _ in got}, {y for _, y in got}
        assert len(a) == len(got) == len(b) and all(x in a or y in b for x, y, _ in chain[:n])
    assert one_to_one(df.limit(0)).count() == 0


def test_one_to_one_is_the_same_for_components_of_any_size(spark):
    """Chains in which taking the best pair first loses: tasks of their own give the same greatest total as shared ones."""
    schema = "left_id string, right_id string, confidence double"
    chains = [e for k in range(9) for e in ((f"{k}a", f"{k}x", 0.6), (f"{k}a", f"{k}y", 0.7), (f"{k}b", f"{k}y", 0.6))]
    want = {(f"{k}{a}", f"{k}{b}") for k in range(9) for a, b in ("ax", "by")}
    for n in (1000, 2):
        assert {(r.left_id, r.right_id) for r in one_to_one(spark.createDataFrame(chains, schema), n).collect()} == want


def test_copies_of_a_site_take_one_place(spark):
    """More copies on both sides than any window holds: all of them are paired."""
    schema = "entity_id string, business_name string, business_address string, country string"
    site = ("Habimenapi Kifolguta Dairy", "207 Gesvezir Road, Bimkithorpe, Stungo 87622", "US")
    near = ("Habimenapi Kifolgata Dairies", "207 Gesvezir Rd, Bimkithorpe, Stungo 87622", "US")
    left = spark.createDataFrame([(f"A{i:03d}", *site) for i in range(60)], schema)
    right = spark.createDataFrame([(f"B{i:03d}", *(site if i % 2 else near)) for i in range(200)] + [("C", *site[:1], None, "US")], schema)
    cand = site_candidates(left, right).cache()
    assert cand.where("right_id <> 'C'").count() == 60 * 200
    one = one_to_one_sites(left, right).collect()
    assert len(one) == len({x.left_id for x in one}) == len({x.right_id for x in one}) == 60
    assert sorted(x["rank"] for x in ranked(right.select("country", "entity_id"), "country", "entity_id").collect()) == list(range(201))
    want = {("A000", f"B{i:03d}") for i in range(200)}
    assert {(r.left_id, r.right_id) for r in best_sites(left, right).collect()} == want == {(r.left_id, r.right_id) for r in best_left(cand).collect()}


def test_one_to_one_leaves_nobody_of_a_large_group_of_equals(spark):
    pairs = spark.range(70).select(F.col("id").alias("left_id")).crossJoin(spark.range(70).select(F.col("id").alias("right_id"))).withColumn("confidence", F.lit(0.9))
    got = one_to_one(pairs).collect()
    assert len(got) == len({r.left_id for r in got}) == len({r.right_id for r in got}) == 70


def test_links_against_brute_force_and_grid(spark, monkeypatch):
    """Nearly all pairs that the comparison accepts meet in a shard, and how large shards are cut changes nothing."""
    r = random.Random(11)
    syllables = ["ka", "mol", "ren", "vi", "tuz", "ber", "sol", "dan", "po", "lin", "gar", "fen"]
    forms = set()
    for _ in range(40):
        words = ["".join(r.sample(syllables, r.randint(2, 4))) for _ in range(r.randint(1, 3))]
        trade = r.choice([0, 3, 3, 7])
        for _ in range(6):
            w = list(words)
            i = r.randrange(len(w))
            j = r.randrange(len(w[i]) - 1)
            w[i] = r.choice([w[i], w[i][:j] + w[i][j + 1 :], w[i][:j] + w[i][j + 1] + w[i][j] + w[i][j + 2 :], w[i][0] + "".join(c for c in w[i][1:] if c not in "aeiou")])
            r.shuffle(w)
            forms.add((" ".join(w) if r.random() < 0.8 else "".join(w), "", r.choice([trade, trade, 0])))
    forms = [(k, *f, shard_keys(OrgName(*f, ""))) for k, f in enumerate(sorted(forms))]
    want = {(a[0], b[0]) for a in forms for b in forms if a[0] < b[0] and same_org(OrgName(*a[1:4], ""), OrgName(*b[1:4], ""))}
    df = spark.createDataFrame(forms, "form long, words string, given string, trade int, shards array<string>")
    got = {(x.a, x.b) for x in form_links(df).collect()}
    assert got <= want and len(got) >= 0.93 * len(want), sorted(want - got)[:5]
    monkeypatch.setattr("kinlink.llm.variants.INDEX_PART", 3)
    monkeypatch.setattr("kinlink.llm.variants.QUERY_PART", 5)
    assert {(x.a, x.b) for x in form_links(df).collect()} == got


def test_two_edits_in_two_words(spark):
    names = spark.createDataFrame([("Kestrel Delmar Bakery",), ("Kestnel Delman Bakery",), ("Alpha Bravo Kestrel Delmar",), ("Delmar Alpha Bravo Kestrel",), ("Reno Lima Foods",), ("Lima Reno Foods",)], "text string")
    cls = {x.text: x.cls for x in name_classes(names, names.limit(0)).collect()}
    assert cls["Kestrel Delmar Bakery"] == cls["Kestnel Delman Bakery"] and cls["Alpha Bravo Kestrel Delmar"] == cls["Delmar Alpha Bravo Kestrel"] and cls["Reno Lima Foods"] == cls["Lima Reno Foods"]


def test_other_lexicon(spark):
    """Trades and given names are a parameter of the operators."""
    lexicon = Lexicon(trades={"plant": "kraftwerk kw"}, given={"jochen": "jo"})
    assert parse_name("Alphona Kraftwerk GmbH", lexicon).trade == 1 and parse_name("Alphona Kraftwerk GmbH").trade == 0
    names = spark.createDataFrame([("Alphona Kraftwerk GmbH",), ("KW Alphona",), ("Alphona Bakery",)], "text string")
    cls = {x.text: x.cls for x in name_classes(names, names.limit(0), lexicon).collect()}
    assert cls["Alphona Kraftwerk GmbH"] == cls["KW Alphona"] != cls["Alphona Bakery"]


def test_small_shards_take_what_tries_find(monkeypatch):
    """pairs of a small shard are taken in arrays without a walk, none that a trie finds is missing, and meets() is the trie's rule."""
    import pyarrow as pa

    from kinlink.llm import variants as v

    r = random.Random(5)
    words = ["kestrel", "kestrl", "ketsrel", "delmar", "dellmar", "dlmr", "an", "quorvane", "quorvn", "bimki", "bimkithorpe", "thorpe", "kstrl", "delmarbimki"]
    texts = sorted({" ".join(r.sample(words, r.choice((1, 2, 2, 3, 3, 4, 5)))) for _ in range(160)}, key=lambda x: (len(x.replace(" ", "")), x))
    forms, size = [v._form(t) for t in texts], [len(t.replace(" ", "")) for t in texts]
    found = set()
    for b in range(len(forms)):
        for a in range(b):
            tries = v._Tries()
            tries.add(forms[a], a)
            hit = bool(tries.search(forms[b]))
            assert hit == v.meets(forms[b], forms[a]), (texts[a], texts[b])
            if hit:
                found.add((a, b))
    monkeypatch.setattr(v.Trie, "search", None)
    monkeypatch.setattr(v, "PAIRS_AT_ONCE", 300)
    (lettered,) = v._with_letters(iter([pa.RecordBatch.from_arrays([pa.array(texts)], ["words"])]))
    n = len(texts)
    none = pa.nulls(n, pa.string())
    rows = pa.RecordBatch.from_arrays(
        [pa.array([7] * n), pa.array([0] * n), lettered.column(1), pa.array(range(n)), pa.array([2] * n), lettered.column(2), lettered.column(3), none, none, pa.array([0] * n)],
        ["shard", "salt", "size", "form", "role", "letters", "kind", "words", "given", "trade"],
    )
    got = {(a, b) for x in v._join_shards(iter([rows.slice(k, 37) for k in range(0, n, 37)])) for a, b in zip(x.column(0).to_pylist(), x.column(1).to_pylist())}
    assert found <= got and len(found) > 200 and len(got) < n * (n - 1) // 2
