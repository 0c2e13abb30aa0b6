"""Candidate generation: one inverted-index join over all key families.

Every family of keys of a record goes into one array of (family, key) and is exploded once. Target keys that are too frequent in their country are
dropped (a rule of the blocking, not an optimisation); the frequencies come from the same postings with a map-side
combined count. The n-gram family asks for a number of shared rare grams: records that have too few rare ones are left out, the postings of
frequent grams are dropped before they are shuffled (where the rare keys are few enough for AQE to broadcast them), and the pairs are counted.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinlink.functions import text as tx

EXACT_NAME, EXACT_CORE, EXACT_ADDRESS, NAME_TOKEN, NAME_PAIR, ADDRESS_TOKEN, NUM_LOCATION, ADDRESS_PAIR, NGRAM = range(9)
FAMILIES = ("exact_name", "exact_core", "exact_address", "rare_name_token", "rare_name_pair", "rare_address_token", "address_num_location", "rare_address_pair", "rare_ngram")
# Greatest number of target rows of a country that a key may have.
DEFAULT_CAPS = {NAME_TOKEN: 500, NAME_PAIR: 1000, ADDRESS_TOKEN: 500, NUM_LOCATION: 500, ADDRESS_PAIR: 1000, NGRAM: 500}
MIN_SHARED_GRAMS = 2
GRAM_SHARE = 0.30


@dataclass(frozen=True)
class BlockingConfig:
    """version 1 has all families but address pairs, version 2 has them too. caps: family -> greatest frequency, exact families have none.
    fallback: records without any candidate get all targets that share their country and first name letter (off by default)."""

    version: int = 1
    caps: dict[int, int] = field(default_factory=lambda: dict(DEFAULT_CAPS))
    families: tuple[int, ...] | None = None
    mode: str = "full"
    n: int = 3
    fallback: bool = False

    def active(self) -> tuple[int, ...]:
        if self.families is not None:
            return self.families
        return tuple(f for f in range(9) if f != ADDRESS_PAIR or self.version >= 2)

    def with_cap(self, cap: int) -> "BlockingConfig":
        return replace(self, caps={f: min(cap, c) for f, c in self.caps.items()})


def family_keys(family: int) -> Column:
    """Array of the keys of one family, without repeats in a record."""
    one = {EXACT_NAME: "name", EXACT_CORE: "core", EXACT_ADDRESS: "address"}
    if family in one:
        c = F.col(one[family])
        return F.when(c != "", F.array(c)).otherwise(F.array().cast("array<string>"))
    if family == NAME_TOKEN:
        return F.filter("name_tokens", lambda t: F.length(t) >= 3)
    if family == NAME_PAIR:
        return tx.token_pairs("name_tokens")
    if family == ADDRESS_TOKEN:
        return F.col("address_tokens")
    if family == NUM_LOCATION:
        return tx.cross_pairs("numbers", "location_tokens")
    if family == ADDRESS_PAIR:
        return tx.token_pairs("address_tokens")
    return F.col("grams")


def postings(features: DataFrame, families: tuple[int, ...]) -> DataFrame:
    """(pos, country, family, key): one Generate over the keys of all families."""

    def tag(f: int) -> Column:
        return F.transform(family_keys(f), lambda k: F.struct(F.lit(f).alias("family"), k.alias("key")))

    return features.select("pos", "country", F.explode(F.concat(*map(tag, families))).alias("p")).select("pos", "country", "p.family", "p.key")


def key_frequency(target_postings: DataFrame) -> DataFrame:
    """(family, country, key, df): number of target rows with a key."""
    return target_postings.groupBy("family", "country", "key").agg(F.count("*").alias("df"))


def _cap(config: BlockingConfig) -> Column:
    c = F.lit(None).cast("bigint")
    for f, cap in config.caps.items():
        c = F.when(F.col("family") == f, F.lit(cap).cast("bigint")).otherwise(c)
    return c


def capped(frequency: DataFrame, config: BlockingConfig) -> DataFrame:
    """The keys that are not too frequent."""
    return frequency.where(F.coalesce(F.col("df") <= _cap(config), F.lit(True)))


def required_grams(n_grams: Column) -> Column:
    """Shared grams asked of a record with so many distinct grams, frequent ones included."""
    share = F.ceil(n_grams.cast("double") * F.lit(GRAM_SHARE)).cast("int")
    return F.when(n_grams <= 4, F.lit(1)).otherwise(F.greatest(F.lit(MIN_SHARED_GRAMS), share))


def key_hits(s1: DataFrame, target: DataFrame, config: BlockingConfig) -> DataFrame:
    """(s1_pos, t_pos, family) for all families but n-grams, one row for each shared key."""
    fams = tuple(f for f in config.active() if f != NGRAM)
    tp = postings(target, fams)
    rare = capped(key_frequency(tp), config).drop("df")
    build = tp.join(rare, ["family", "country", "key"], "left_semi").withColumnRenamed("pos", "t_pos")
    probe = postings(s1, fams).withColumnRenamed("pos", "s1_pos")
    return probe.join(build, ["family", "country", "key"]).select("s1_pos", "t_pos", "family")


def ngram_hits(s1: DataFrame, target: DataFrame, config: BlockingConfig) -> DataFrame:
    """(s1_pos, t_pos, shared): pairs with enough shared rare grams.

    A record with fewer rare grams than it must share is left out before the join; of the others every rare gram is probed and the pairs
    are counted, two positions and a counter a row."""
    tp = postings(target, (NGRAM,)).select("pos", "country", "key")
    df = tp.groupBy("country", "key").agg(F.count("*").alias("df"))
    rare = df.where(F.col("df") <= config.caps[NGRAM]).select("country", "key") if NGRAM in config.caps else df.select("country", "key")
    need = s1.select("pos", "country", "grams", required_grams(F.size("grams")).alias("required"))
    sg = need.select("pos", "country", "required", F.explode("grams").alias("key")).join(rare, ["country", "key"])
    able = sg.groupBy("pos").agg(F.count("*").alias("r"), F.first("required").alias("required")).where("r >= required")
    probe = sg.select("pos", "country", "key").join(able.select("pos", "required"), "pos").withColumnRenamed("pos", "s1_pos")
    build = tp.join(rare, ["country", "key"], "left_semi").withColumnRenamed("pos", "t_pos")
    counted = probe.join(build, ["country", "key"]).groupBy("s1_pos", "t_pos").agg(F.count("*").cast("int").alias("shared"), F.first("required").alias("required"))
    return counted.where("shared >= required").select("s1_pos", "t_pos", "shared")


def hits_by_family(s1: DataFrame, target: DataFrame, config: BlockingConfig) -> DataFrame:
    """(s1_pos, t_pos, family), distinct, over all active families."""
    fams = config.active()
    parts = []
    if any(f != NGRAM for f in fams):
        parts.append(key_hits(s1, target, config).distinct())
    if NGRAM in fams:
        parts.append(ngram_hits(s1, target, config).select("s1_pos", "t_pos", F.lit(NGRAM).alias("family")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def candidate_positions(s1: DataFrame, target: DataFrame, config: BlockingConfig) -> DataFrame:
    """(s1_pos, t_pos): union of all families; for each record a target id counts once, at its lowest position."""
    from kinlink.operators.probing import key_index, probed

    index = key_index(s1, target, config)
    pairs = probed(index, config, "pairs")
    return pairs.unionByName(_fallback(s1, target, index, config)) if config.fallback else pairs


def _fallback(s1: DataFrame, target: DataFrame, index: tuple[DataFrame, DataFrame], config: BlockingConfig) -> DataFrame:
    """(s1_pos, t_pos) of the records without any candidate: all targets of their country and first name letter, each id at its lowest position."""
    from kinlink.operators.probing import probed

    found = probed(index, config, "brief").select(F.col("s1_pos").alias("pos"))
    none = s1.select("pos", "country", F.substring("name", 1, 1).alias("initial")).where("initial <> ''").join(found, "pos", "left_anti")
    same = target.select("country", F.substring("name", 1, 1).alias("initial"), "id", F.col("pos").alias("t_pos"))
    return none.join(same, ["country", "initial"]).groupBy(F.col("pos").alias("s1_pos"), "id").agg(F.min("t_pos").alias("t_pos")).select("s1_pos", "t_pos")


def generate_candidates(s1: DataFrame, target: DataFrame, config: BlockingConfig = BlockingConfig()) -> DataFrame:
    """(s1_id, target_id, s1_pos, t_pos): distinct pairs of ids with the lowest positions they were met at."""
    from kinlink.operators.probing import key_index, probed

    index = key_index(s1, target, config)
    if not config.fallback:
        return probed(index, config, "named")
    pos = probed(index, config, "pairs").unionByName(_fallback(s1, target, index, config))
    named = pos.join(s1.select(F.col("pos").alias("s1_pos"), F.col("id").alias("s1_id")), "s1_pos").join(target.select(F.col("pos").alias("t_pos"), F.col("id").alias("target_id")), "t_pos")
    return named.groupBy("s1_id", "target_id").agg(F.min("s1_pos").alias("s1_pos"), F.min("t_pos").alias("t_pos"))


def debug_info(s1: DataFrame, target: DataFrame, config: BlockingConfig = BlockingConfig()) -> DataFrame:
    """Targets by family and in all for each record of s1, zeros included."""
    from kinlink.operators.probing import key_index, probed

    got = probed(key_index(s1, target, config), config, "families")
    cols = [FAMILIES[f] for f in config.active()] + ["total"]
    return s1.select(F.col("pos").alias("s1_pos")).join(got, "s1_pos", "left").select("s1_pos", *[F.coalesce(c, F.lit(0)).alias(c) for c in cols])
