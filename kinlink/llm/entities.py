"""Records of two tables that describe the same site, without a common key (problem 3).

Both tables are sorted together by several composite keys of name and address; in a sliding window the records of one table
are compared with those of the other. The similarities of the fields are weighed into a confidence; a field that is missing
neither speaks for nor against. Two assignments of greatest total confidence: best_sites() gives each right record to one left record (a left record
may have several), one_to_one_sites() is strictly one to one.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinlink.functions.text import missing, normalize_country
from kinlink.llm.address import Address, osa, same_place
from kinlink.llm.names import LEXICON, Lexicon, OrgName, near_org, same_org
from kinlink.llm.neighbours import Gate, letter_mask, window_pairs
from kinlink.llm.places import PART_NAMES, settle_regions, skeleton, with_parts
from kinlink.llm.variants import with_names
from kinlink.operators.components import connected_components
from kinlink.session import cut, shuffle_partitions, stored

WINDOW = 24
# weights of the fields, and what a missing one counts
NAME, PLACE, COUNTRY, MISSING = 0.5, 0.4, 0.1, 0.4
# Other written forms of a country, after normalize_country.
SAME_COUNTRY = {"gb": "uk", "united kingdom": "uk", "deutschland": "de", "germany": "de", "brasil": "br", "brazil": "br", "u s a": "us"}
FIELDS = ["words", "given", "trade", *PART_NAMES, "nation"]


def _similar(a: str, b: str) -> float:
    """1 less the share of the letters that are edited, to a tenth of them or more (names and places that are told apart get here no more)."""
    if a == b:
        return 1.0
    n = max(len(a), len(b))
    return max(0.0, 1 - osa(a, b, 6) / n)


def name_similarity(a: OrgName, b: OrgName) -> float:
    """Of the coined words in the written or the sorted order; a trade that is stated on one side only leaves a doubt."""
    wa, wb = a.words.split(), b.words.split()
    s = max(_similar("".join(wa), "".join(wb)), _similar("".join(sorted(wa)), "".join(sorted(wb))))
    return s if a.trade and b.trade else 0.9 * s


def place_similarity(a: Address, b: Address) -> float:
    """Of street, town and postcode."""
    town = _similar(a.town, b.town) if a.town and b.town and not a.loose and not b.loose else MISSING
    postcode = (1.0 if a.postcode == b.postcode else 0.0) if a.postcode and b.postcode else MISSING
    return 0.6 * (1.0 if a.loose or b.loose else _similar(a.street, b.street)) + 0.2 * town + 0.2 * postcode


def compare_sites(a: tuple, b: tuple) -> int:
    """0: not the same site. Else twice the confidence in thousandths, and 1 more if it rests on name and place. Fields as in FIELDS."""
    na, nb = OrgName(a[0], a[1], a[2], ""), OrgName(b[0], b[1], b[2], "")
    pa, pb = Address(*a[3:-1]), Address(*b[3:-1])
    place = bool(pa.number and pa.street and pb.number and pb.street)
    name = bool(na.words and nb.words)
    if not place and not name:
        return 0
    sure = same_place(pa, pb) if place else 0
    if place and not sure:
        return 0
    if name and not same_org(na, nb) and (sure != 2 or not near_org(na, nb)):
        return 0
    country = MISSING if not a[-1] or not b[-1] else float(a[-1] == b[-1])
    total = NAME * (name_similarity(na, nb) if name else MISSING) + PLACE * (place_similarity(pa, pb) if place else MISSING) + COUNTRY * country
    return 2 * max(1, round(1000 * total)) + int(place and name)


def _one_per_id(df: DataFrame, id_col: str) -> DataFrame:
    """The record of each id; a country filled in by a later delivery counts."""
    country = F.when(missing("country"), None).otherwise(F.col("country"))
    return (
        df.where(F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("id"))
        .agg(F.max("business_name").alias("name"), F.max("business_address").alias("address"), F.max(country).alias("country"))
    )


def site_forms(left: DataFrame, right: DataFrame, id_col: str = "entity_id", window: int = WINDOW, lexicon: Lexicon = LEXICON) -> tuple[DataFrame, DataFrame]:
    """(members, pairs): members(form, side, id) gives the form of each record, pairs(left_form, right_form, confidence, sure) the forms that may be
    the same site; sure: both name and place say so.

    Records of one table with equal fields are one form, so copies take one place in the windows however many they are.
    """
    both = _one_per_id(left, id_col).withColumn("side", F.lit(0)).unionByName(_one_per_id(right, id_col).withColumn("side", F.lit(1)))
    parsed = with_names(with_parts(both, "address"), "name", lexicon=lexicon)
    nation = normalize_country(F.col("country"))
    table = F.create_map(*[F.lit(v) for kv in SAME_COUNTRY.items() for v in kv])
    parsed = parsed.withColumn("nation", F.coalesce(F.try_element_at(table, nation), nation)).drop("name", "address", "country")
    usable = (F.col("number") != "") & (F.col("street") != "")
    letters = F.udf(lambda w: letter_mask("".join(c for c in w if c not in "aeiou ")), "bigint", useArrow=True)
    found = stored(parsed.where(usable | (F.col("words") != "")).select("id", "side", *FIELDS, "second"))
    records = stored(settle_regions(found).withColumn("form", F.xxhash64("side", *FIELDS)).select("id", "side", "form", *FIELDS))
    rows = stored(
        records.drop("id")
        .dropDuplicates(["form"])
        .withColumn("house_gate", F.when(usable, F.xxhash64("number", "letter", "direction")).otherwise(F.lit(0).cast("bigint")))
        .withColumn("name_mask", letters("words"))
        .withColumn("joined", F.replace("words", F.lit(" "), F.lit("")))
    )
    bones = F.array_sort(
        F.filter(F.transform(F.split("words", " "), lambda w: F.regexp_replace(F.regexp_replace(w, "[aeiou]", ""), r"(.)\1+", "$1")), lambda w: w != "")
    )
    house = F.when(usable, F.concat_ws("|", "number", "letter", "direction"))
    named = F.col("words") != ""
    keys = [
        F.when(usable, F.concat_ws("|", house, skeleton("street"), skeleton("town"))),
        F.when(usable & (F.col("postcode") != ""), F.concat_ws("|", "postcode", house, skeleton("street"))),
        F.when(named, F.concat_ws("|", F.array_join(bones, "|"), F.col("trade").cast("string"), skeleton("town"), house)),
        F.when(named, F.concat_ws("|", F.reverse(F.array_join(bones, "")), F.col("trade").cast("string"), skeleton("town"), house)),
        F.when(named, F.concat_ws("|", skeleton("joined"), F.col("trade").cast("string"), skeleton("town"), house)),
    ]
    gate = Gate(masks=(("house_gate", 0), ("name_mask", 8)), sides="side")
    pairs = window_pairs(rows, keys, "form", FIELDS, gate, compare_sites, window)
    sides = rows.select(F.col("form").alias("a"), "side")
    first = F.col("side") == 0
    placed = pairs.join(sides, "a").select(
        F.when(first, F.col("a")).otherwise(F.col("b")).alias("left_form"), F.when(first, F.col("b")).otherwise(F.col("a")).alias("right_form"), (F.floor(F.col("score") / 2) / 1000.0).alias("confidence"), (F.col("score") % 2 == 1).alias("sure")
    )
    return records.select("form", "side", "id"), cut(placed)


def _ids(members: DataFrame, side: int) -> DataFrame:
    name = ("left", "right")[side]
    return members.where(F.col("side") == side).select(F.col("form").alias(f"{name}_form"), F.col("id").alias(f"{name}_id"))


def site_candidates(left: DataFrame, right: DataFrame, id_col: str = "entity_id", window: int = WINDOW) -> DataFrame:
    """(left_id, right_id, confidence, sure): pairs of left and right records that may be the same site.

    Both tables have id_col, business_name, business_address, country; others are ignored. Null ids are left out, ids delivered
    several times are one record. A record with neither a usable name nor a usable address is in no pair.
    """
    members, pairs = site_forms(left, right, id_col, window)
    return pairs.join(_ids(members, 0), "left_form").join(_ids(members, 1), "right_form").select("left_id", "right_id", "confidence", "sure")


def best_sites(left: DataFrame, right: DataFrame, id_col: str = "entity_id", window: int = WINDOW) -> DataFrame:
    """best_left(site_candidates(...)), chosen among forms: copies are only expanded in the result."""
    members, pairs = site_forms(left, right, id_col, window)
    first = _ids(members, 0).groupBy("left_form").agg(F.min("left_id").alias("left_id"), F.count("*").alias("copies"))
    best = best_left(pairs.join(first, "left_form").select("left_id", F.col("right_form").alias("right_id"), "confidence", "sure", "copies"))
    return best.withColumnRenamed("right_id", "right_form").join(_ids(members, 1), "right_form").select("left_id", "right_id", "confidence")


def best_left(pairs: DataFrame) -> DataFrame:
    """Each right record with the left record of the greatest confidence: the assignment of greatest total confidence where a left
    record may have several right ones. Where several left records are equally good, a sure pair goes to the smallest left id, and a pair that
    lacks name or place is not assigned: nothing tells which it is. A column copies, if there is one, tells how many left records a row stands for."""
    copies = F.sum("copies") if "copies" in pairs.columns else F.count("*")
    best = pairs.groupBy("right_id").agg(F.max("confidence").alias("confidence"))
    top = pairs.join(best, ["right_id", "confidence"]).groupBy("right_id", "confidence").agg(copies.alias("n"), F.max("sure").alias("sure"), F.min("left_id").alias("left_id"))
    return top.where((F.col("n") == 1) | F.col("sure")).select("left_id", "right_id", "confidence")


# -- one to one --------------------------------------------------------------------------------------------------------

LARGE_PAIRS = 20_000  # candidate pairs of a component that gets a task of its own


def solve(left: list, right: list, weight: list[int], cap_left: dict, cap_right: dict) -> list[int]:
    """Units of each pair in the assignment of greatest total weight, no end above its capacity: the left ends are added one at a time, each by
    shortest paths under prices. A search ends at the nearest right end with room or at a left end that is worth nothing more, so it
    sees the surroundings of its start and not the whole component. Weights are positive; the pairs are taken in their order where several
    assignments are equally good."""
    out: dict = {}
    back: dict = {}
    for e, (x, y) in enumerate(zip(left, right)):
        out.setdefault(x, []).append(e)
        back.setdefault(y, []).append(e)
    flow = [0] * len(left)
    used: dict = {y: {} for y in back}  # the pairs of a right end that have units, in the order they got them
    free_r = dict(cap_right)
    # prices: p + q >= weight for the left ends that were added, equal where there are units; above 0 only for ends without room
    p: dict = {}
    q = dict.fromkeys(back, 0)
    for start, own in out.items():
        p[start] = max(0, max(weight[e] - q[right[e]] for e in own))
        units = cap_left[start]
        while units:
            dist: dict = {(0, start): 0}
            via: dict = {}
            heap: list = [(0, 0, -1, start)]
            best, end = p[start], (0, start)
            settled = []
            while heap and heap[0][0] < best:
                d, side, _, v = heapq.heappop(heap)
                if d > dist[side, v]:
                    continue
                settled.append((side, v, d))
                if side == 0:
                    for e in out[v]:
                        y = right[e]
                        nd = d + p[v] + q[y] - weight[e]
                        if nd < best and nd < dist.get((1, y), best):
                            dist[1, y], via[1, y] = nd, e
                            if free_r[y]:
                                best, end = nd, (1, y)
                            else:
                                heapq.heappush(heap, (nd, 1, e, y))
                else:
                    for e in used[v]:
                        x = left[e]
                        if d < dist.get((0, x), d + 1):
                            dist[0, x], via[0, x] = d, e
                            heapq.heappush(heap, (d, 0, e, x))
                            if d + p[x] < best:
                                best, end = d + p[x], (0, x)
            for side, v, d in settled:
                if d < best:
                    if side:
                        q[v] += best - d
                    else:
                        p[v] -= best - d
            path, at = [], end
            while at in via:
                e = via[at]
                path.append((e, at[0]))
                at = (0, left[e]) if at[0] else (1, right[e])
            moved = min([units, *([free_r[end[1]]] if end[0] else []), *(flow[e] for e, forward in path if not forward)])
            for e, forward in path:
                flow[e] += moved if forward else -moved
                if flow[e]:
                    used[right[e]][e] = None
                else:
                    used[right[e]].pop(e, None)
            if end[0]:
                free_r[end[1]] -= moved
            units -= moved
    return flow


def _solve_components(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by component; one component at a time is held."""

    def one(g: pd.DataFrame) -> pd.DataFrame:
        if len(g) == 1:
            units = [min(g["left_cap"].iloc[0], g["right_cap"].iloc[0])]
        else:
            left, right = g["left_id"].tolist(), g["right_id"].tolist()
            weight = [round(c * 1_000_000) for c in g["confidence"].tolist()]
            units = solve(left, right, weight, dict(zip(left, g["left_cap"].tolist())), dict(zip(right, g["right_cap"].tolist())))
        return g[["left_id", "right_id", "confidence"]].assign(units=units)

    held: list[pd.DataFrame] = []
    for df in parts:
        if not len(df):
            continue
        last = df["component"] == df["component"].iloc[-1]
        if not held or held[0]["component"].iloc[0] != df["component"].iloc[-1]:
            ready = pd.concat([*held, df[~last]], ignore_index=True)
            if len(ready):
                got = pd.concat([one(g) for _, g in ready.groupby("component", sort=False)])
                yield got[got["units"] > 0]
            held = []
        held.append(df[last])
    if held:
        got = one(pd.concat(held, ignore_index=True))
        yield got[got["units"] > 0]


def assignment(pairs: DataFrame, large_pairs: int = LARGE_PAIRS) -> DataFrame:
    """(left_id, right_id, confidence, units): the assignment of greatest total confidence in which no end has more units than its capacity.

    pairs(left_id, right_id, confidence, left_cap, right_cap); null ids and repeated pairs are dropped. Each connected component of the candidates
    is solved exactly, whatever its size, by augmenting paths in one task, which holds its pairs; components of more than large_pairs pairs get
    a task each, the others share tasks. The result does not depend on that.
    """
    caps = [F.max(c).cast("bigint").alias(c) for c in ("left_cap", "right_cap")]
    clean = pairs.where("left_id is not null and right_id is not null and confidence > 0").groupBy("left_id", "right_id").agg(F.max("confidence").alias("confidence"), *caps)
    clean = cut(clean)
    node = F.concat(F.lit("l\x01"), F.col("left_id").cast("string"))
    edges = clean.select(node.alias("a"), F.concat(F.lit("r\x01"), F.col("right_id").cast("string")).alias("b"))
    comps = connected_components(edges).where(F.col("node").startswith("l\x01"))
    placed = cut(clean.withColumn("node", node).join(comps, "node").drop("node"))
    sizes = placed.groupBy("component").agg(F.count("*").alias("n"))
    large = cut(sizes.where(F.col("n") > large_pairs).select("component", (F.row_number().over(Window.orderBy(F.desc("n"), "component")) - 1).alias("task")))
    tasks = large.count()
    small = placed.join(large, "component", "left_anti") if tasks else placed
    kinds = {f.name: f.dataType.simpleString() for f in placed.schema}
    schema = f"left_id {kinds['left_id']}, right_id {kinds['right_id']}, confidence double, units bigint"

    def solved(rows: DataFrame) -> DataFrame:
        return rows.sortWithinPartitions("component", F.desc("confidence"), "left_id", "right_id").mapInPandas(_solve_components, schema)

    got = solved(small.repartition(shuffle_partitions(pairs.sparkSession), "component"))
    return got.unionByName(solved(placed.join(large, "component").repartitionById(tasks, "task").drop("task"))) if tasks else got


def one_to_one(pairs: DataFrame, large_pairs: int = LARGE_PAIRS) -> DataFrame:
    """(left_id, right_id, confidence): assignment() with each id used once."""
    one = F.lit(1)
    return assignment(pairs.withColumn("left_cap", one).withColumn("right_cap", one), large_pairs).select("left_id", "right_id", "confidence")


def ranked(df: DataFrame, group: str, order: str) -> DataFrame:
    """df with `rank`: 0, 1, ... of each row in its group, no task bound to a whole group: ranges of (group, order), numbered each and stitched."""
    n = shuffle_partitions(df.sparkSession)
    names = [*df.columns, "local", "part"]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema), "local bigint", "part int"])
    at = df.columns.index(group)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, here, k = TaskContext.get().partitionId(), None, 0
        for b in batches:
            local = []
            for g in b.column(at).to_pylist():
                k = k + 1 if g == here else 0
                here = g
                local.append(k)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(local, pa.int64()), pa.array([part] * b.num_rows, pa.int32())], names)

    rows = cut(df.repartitionByRange(n, group, order).sortWithinPartitions(group, order).mapInArrow(number, schema))
    counts = rows.groupBy(group, "part").agg((F.max("local") + 1).alias("n"))
    before = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(group, "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return rows.join(offsets, [group, "part"]).select(*df.columns, (F.col("local") + F.col("before")).alias("rank"))


def one_to_one_sites(left: DataFrame, right: DataFrame, id_col: str = "entity_id", window: int = WINDOW) -> DataFrame:
    """(left_id, right_id, confidence): assignment() among forms, as many units as a form has records, then dealt to the records in the order of
    their ids: the pairs of a group of copies are never expanded."""
    members, pairs = site_forms(left, right, id_col, window)
    sizes = [_ids(members, k).groupBy(f"{s}_form").agg(F.count("*").alias(f"{s}_cap")) for k, s in enumerate(("left", "right"))]
    asked = pairs.join(sizes[0], "left_form").join(sizes[1], "right_form")
    dealt = cut(assignment(asked.withColumnsRenamed({"left_form": "left_id", "right_form": "right_id"})).withColumnsRenamed({"left_id": "left_form", "right_id": "right_form"}))
    for s, other in (("left", "right"), ("right", "left")):  # the records of a form from lo on, `units` of them
        before = Window.partitionBy(f"{s}_form").orderBy(f"{other}_form").rowsBetween(Window.unboundedPreceding, -1)
        dealt = dealt.withColumn(f"{s}_lo", F.coalesce(F.sum("units").over(before), F.lit(0)))
    a, b = ranked(_ids(members, 0), "left_form", "left_id"), ranked(_ids(members, 1), "right_form", "right_id").withColumnRenamed("rank", "right_rank")
    a = a.join(dealt, "left_form").where("rank >= left_lo and rank < left_lo + units").withColumn("right_rank", F.col("rank") - F.col("left_lo") + F.col("right_lo"))
    return a.select("left_id", "right_form", "right_rank", "confidence").join(b, ["right_form", "right_rank"]).select("left_id", "right_id", "confidence")
