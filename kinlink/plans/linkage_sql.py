"""DuckDB SQL for the linkage queries: the same definitions, written a second time and independently of Spark."""

from __future__ import annotations

from kinlink.functions.text import ACCENTED, ADDRESS_STOPWORDS, LEGAL_SUFFIXES, NARROW, PLAIN, WIDE
from kinlink.operators.blocking import DEFAULT_CAPS


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def words(ws) -> str:
    return "(" + ", ".join(map(lit, ws)) + ")"


STRIDE = 1 << 40


def norm(x: str) -> str:
    latin = f"replace(translate(coalesce({x}, ''), {lit(ACCENTED + WIDE)}, {lit(PLAIN + NARROW)}), 'ß', 'ss')"
    return f"trim(regexp_replace(replace(translate(lower({latin}), '''’`', ''), '&', ' and '), '[^a-z0-9]+', ' ', 'g'))"


def country(x: str) -> str:
    n = norm(x)
    return f"CASE WHEN {n} IN ('us','usa','united states','united states of america') THEN 'us' WHEN {n} IN ('india','in') THEN 'india' ELSE {n} END"


def toks(x: str) -> str:
    return f"list_distinct(list_filter(string_split({x}, ' '), lambda t: t <> ''))"


def core(x: str) -> str:
    return f"array_to_string(list_filter(string_split({x}, ' '), lambda t: t <> '' AND t NOT IN {words(LEGAL_SUFFIXES)}), ' ')"


def addr_toks(x: str) -> str:
    return f"list_filter({toks(x)}, lambda t: length(t) >= 3 AND t NOT IN {words(ADDRESS_STOPWORDS)})"


def loc_toks(x: str) -> str:
    return f"list_filter({toks(x)}, lambda t: length(t) >= 4 AND t NOT IN {words(ADDRESS_STOPWORDS)} AND NOT regexp_full_match(t, '[0-9]+'))"


def nums(x: str) -> str:
    return f"list_distinct(regexp_extract_all({x}, '[0-9]+'))"


def grams(x: str, n: int = 3) -> str:
    y = f"replace({x}, ' ', '')"
    return f"CASE WHEN length({y}) = 0 THEN []::VARCHAR[] WHEN length({y}) <= {n} THEN [{y}] ELSE list_distinct(list_transform(range(1, length({y}) - {n - 2}), lambda i: substring({y}, i, {n}))) END"


def pairs_of(x: str) -> str:
    ts = f"list_sort({x})"
    return f"flatten(list_transform(range(1, len({x})), lambda i: list_transform(({ts})[i+1:], lambda b: ({ts})[i] || chr(1) || b)))"


def cross_of(a: str, b: str) -> str:
    return f"flatten(list_transform({a}, lambda p: list_transform({b}, lambda q: p || chr(1) || q)))"


def jaccard(a: str, b: str) -> str:
    both = f"len(list_intersect({a}, {b}))"
    return f"(CASE WHEN len({a}) + len({b}) = 0 THEN 1.0::DOUBLE ELSE {both}::DOUBLE / (len({a}) + len({b}) - {both})::DOUBLE END)"


def show(x: str, sep: str = " ") -> str:
    return f"array_to_string(list_sort({x}), {lit(sep)})"


def lcs(a: str, b: str) -> str:
    """Longest common subsequence of two strings of fewer than 126 characters."""
    full = f"((1::HUGEINT << length({a})) - 1)"
    mask = f"list_sum(list_prepend(0::HUGEINT, list_transform(range(1, length({a}) + 1), lambda i: CASE WHEN substring({a}, i, 1) = ch THEN 1::HUGEINT << (i - 1)::INT ELSE 0::HUGEINT END)))::HUGEINT"
    masks = f"list_transform(string_split({b}, ''), lambda ch: {mask})"
    return f"(length({a}) - bit_count(list_reduce(list_prepend({full}, {masks}), lambda s, m: ((s + (s & m)) | (s - (s & m))) & {full}))::BIGINT)"


def indel(a: str, b: str) -> str:
    return f"(CASE WHEN {a} = {b} THEN 1.0::DOUBLE WHEN length({a}) = 0 OR length({b}) = 0 THEN 0.0::DOUBLE ELSE 2.0::DOUBLE * {lcs(a, b)}::DOUBLE / (length({a}) + length({b}))::DOUBLE END)"


def ents(table: str, ordinal: int = 0) -> str:
    cols = ", ".join(f"coalesce({c}, '') AS {n}" for c, n in (("entity_id", "id"), ("business_name", "name"), ("business_address", "address"), ("country", "country")))
    return f"SELECT pos + {ordinal * STRIDE} AS pos, {cols} FROM {table}"


S1_ENTS = ents("train_source1")
T_ENTS = f"{ents('train_source2')} UNION ALL {ents('train_source3', 1)}"


def feats(source: str) -> str:
    return (
        f"SELECT *, {core('name')} AS core, {toks('name')} AS name_tokens, {addr_toks('address')} AS address_tokens, {loc_toks('address')} AS location_tokens, {nums('address')} AS numbers, {grams('name')} AS grams "
        f"FROM (SELECT pos, id, {country('country')} AS country, lower(country) AS country_raw, {norm('name')} AS name, {norm('address')} AS address FROM ({source}))"
    )


FEATS = f"s AS MATERIALIZED ({feats(S1_ENTS)}), t AS MATERIALIZED ({feats(T_ENTS)})"
FAMILY_KEYS = [
    "CASE WHEN name <> '' THEN [name] ELSE []::VARCHAR[] END",
    "CASE WHEN core <> '' THEN [core] ELSE []::VARCHAR[] END",
    "CASE WHEN address <> '' THEN [address] ELSE []::VARCHAR[] END",
    "list_filter(name_tokens, lambda t: length(t) >= 3)",
    pairs_of("name_tokens"),
    "address_tokens",
    cross_of("numbers", "location_tokens"),
    pairs_of("address_tokens"),
    "grams",
]


def postings(x: str, families) -> str:
    return " UNION ALL ".join(f"SELECT pos, country, {f} AS family, unnest({FAMILY_KEYS[f]}) AS key FROM {x}" for f in families)


def hits(families, cap: int | None = None) -> str:
    """CTEs up to hits(s1_pos, t_pos, family), distinct; families without n-grams need no count."""
    caps = {f: min(c, cap) if cap else c for f, c in DEFAULT_CAPS.items()}
    case = "CASE family " + " ".join(f"WHEN {f} THEN {c}" for f, c in caps.items()) + " ELSE 1000000000 END"
    parts = [f"SELECT DISTINCT s1_pos, t_pos, family FROM shared WHERE family <> 8"]
    if 8 in families:
        need = "CASE WHEN len(s.grams) <= 4 THEN 1 ELSE greatest(2, ceil(len(s.grams)::DOUBLE * 0.3::DOUBLE)::INT) END"
        parts.append(f"SELECT s1_pos, t_pos, 8 FROM (SELECT s1_pos, t_pos, count(*) AS n FROM shared WHERE family = 8 GROUP BY ALL) JOIN s ON s.pos = s1_pos WHERE n >= {need}")
    return (
        f"WITH {FEATS}, tp AS MATERIALIZED ({postings('t', families)}), df AS (SELECT family, country, key, count(*) AS n FROM tp GROUP BY ALL), "
        f"rare AS (SELECT family, country, key FROM df WHERE n <= {case}), sp AS ({postings('s', families)}), "
        f"shared AS MATERIALIZED (SELECT sp.pos AS s1_pos, tp.pos AS t_pos, family FROM sp JOIN rare USING (family, country, key) JOIN tp USING (family, country, key)), "
        f"hits AS ({' UNION ALL '.join(parts)})"
    )


CANDIDATES = "cand AS (SELECT s1_pos, t.id AS target_id, min(t_pos) AS t_pos FROM (SELECT DISTINCT s1_pos, t_pos FROM hits) JOIN t ON t.pos = t_pos GROUP BY ALL)"
IDS = """regexp_extract_all(%s, '["''](S[0-9]-[0-9]{8})[,;|][A-Z0-9]{1,2}["'']|S[0-9]-[0-9]{8}')"""


def listed(table: str, column: str) -> str:
    return f"SELECT DISTINCT source1_entity_id AS s1_id, trim(unnest({IDS % column}), '\"''') AS target_id FROM {table}"


TRUTH = listed("train_matches", "matched_entity_ids")
LISTED = listed("candidate_pairs", "candidate_entity_ids")


def first(x: str) -> str:
    return f"(SELECT DISTINCT ON (id) * FROM {x} ORDER BY id, pos)"
