"""Which address records denote the same place (problem 1)."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinlink.functions.text import missing
from kinlink.llm.address import Address, parse, same_place
from kinlink.llm.classes import link_classes
from kinlink.llm.neighbours import Gate, letter_mask, window_pairs
from kinlink.session import cut, stored

WINDOW = 20
PARTS = "number string, letter string, direction string, types int, street string, town string, region string, postcode string, loose int"
PART_NAMES = [p.split()[0] for p in PARTS.split(", ")]
MASKS = "street_mask bigint, town_mask bigint"
EXTRA = ["second", *(m.split()[0] for m in MASKS.split(", "))]


def _masks(x: Address) -> tuple[int, int]:
    """Letters of the street and of the first word of the town, 0 where same_place() may compare other words than these."""
    if x.loose:
        return 0, 0
    return letter_mask(x.street.replace(" ", "")), letter_mask(x.town.split()[0]) if x.town and (x.region or " " in x.town) else 0


def with_parts(df: DataFrame, text_col: str) -> DataFrame:
    """df with the parts of its address and `second`, one parse for each distinct text of a batch; null or placeholder: all parts empty."""
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema), PARTS, "second string", MASKS])
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int32() if n in ("types", "loose") else pa.string() for n in PART_NAMES]
        for b in batches:
            memo: dict = {}
            done = []
            for t in b.column(at).to_pylist():
                if t not in memo:
                    memo[t] = parse(t)
                done.append(memo[t])
            cols = [pa.array([getattr(x, n) for x in done], k) for n, k in zip(PART_NAMES, kinds)] + [pa.array([x.second for x in done], pa.string())]
            masks = [_masks(x) for x in done]
            cols += [pa.array([m[i] for m in masks], pa.int64()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*b.columns, *cols], [*b.schema.names, *PART_NAMES, *EXTRA])

    return df.mapInArrow(run, schema)


def settle_regions(parsed: DataFrame) -> DataFrame:
    """with_parts() rows without `second`: a single name that the addresses of the table mostly state behind a town is a region, not a town.

    The names are counted over all addresses that state both; the counts are joined, whatever their number."""
    both = parsed.where("second <> '' and town <> ''").select(F.explode(F.array(F.struct(F.col("town").alias("name"), F.lit(0).alias("r")), F.struct(F.col("second").alias("name"), F.lit(1).alias("r")))).alias("x"))
    regions = both.select("x.name", "x.r").groupBy("name").agg(F.sum("r").alias("r"), F.count("*").alias("n")).where("n > 1 and 2 * r > n").select(F.col("name").alias("town"), F.lit(True).alias("known"))
    alone = F.coalesce("known", F.lit(False)) & (F.col("second") == "") & (F.col("region") == "")
    got = parsed.join(regions, "town", "left")
    town = F.when(alone, F.lit("")).otherwise(F.col("town"))
    region = F.when(alone, F.substring("town", 1, 3)).otherwise(F.col("region"))
    return got.select(*[{"town": town, "region": region}.get(c, F.col(c)).alias(c) for c in parsed.columns if c != "second"])


def skeleton(c: str):
    """Consonants of a word with doublings removed: stable under most typing errors in vowels."""
    return F.regexp_replace(F.regexp_replace(F.col(c), "[aeiou]", ""), r"(.)\1+", "$1")


def place_classes(records: DataFrame, id_col: str, address_col: str, window: int = WINDOW) -> DataFrame:
    """(id, place): the place class of every record whose address has a house number and a street.

    Distinct address texts are parsed once each and collapsed to distinct part lists; these are sorted in four orders of the
    components, compared in windows, and joined into classes. An address whose town and postcode give no common ground
    with the other is joined only if it fits the records of exactly one class, else it stays alone.
    Nulls, blanks and placeholders are in no class; a record delivered again counts once; extra columns are ignored.
    """
    rows = records.select(F.col(id_col).alias("id"), F.col(address_col).alias("text")).where("id is not null").where(~missing("text")).distinct()
    texts = stored(with_parts(rows.select("text").distinct(), "text").where("number <> '' and street <> ''"))
    texts = stored(settle_regions(texts).withColumn("form", F.xxhash64(*PART_NAMES)))
    forms = texts.drop("text").dropDuplicates(["form"]).withColumn("gate", F.xxhash64("number", "letter", "direction"))
    house = F.concat_ws("|", "number", "letter", "direction")
    keys = [
        F.concat_ws("|", house, skeleton("street"), skeleton("town")),
        F.when(F.col("postcode") != "", F.concat_ws("|", "postcode", house, skeleton("street"))),
        F.when(F.col("town") != "", F.concat_ws("|", skeleton("town"), house, skeleton("street"))),
        F.concat_ws("|", house, F.reverse(F.col("street")), skeleton("town")),
    ]
    gate = Gate(equal=("gate",), masks=(("street_mask", 6), ("town_mask", 8)))
    links = cut(window_pairs(forms, keys, "form", PART_NAMES, gate, lambda a, b: same_place(Address(*a), Address(*b)), window))
    final = link_classes(forms.select(F.col("form").alias("node")), links).select(F.col("node").alias("form"), F.col("cls").alias("place"))
    return rows.join(texts.select("text", "form").join(final, "form"), "text").select("id", "place").distinct()


def place_pairs(classes: DataFrame) -> DataFrame:
    """(id_a, id_b), id_a < id_b: records of one place."""
    a = classes.select("place", F.col("id").alias("id_a"))
    b = classes.select("place", F.col("id").alias("id_b"))
    return a.join(b, "place").where("id_a < id_b").select("id_a", "id_b").distinct()
