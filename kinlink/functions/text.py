"""Text normalization and token sets as column expressions (all JVM-side but for the `full` transliteration).

Every function takes a Column (or a column name) and treats null as the empty string. The normalized alphabet is
`[a-z0-9 ]`. Token sets are arrays without repeats.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kinlink.functions.translit import romanize_col

# Legal forms, address stop words and country aliases.
LEGAL_SUFFIXES = "co company corp corporation inc incorporated limited llc llp lp ltd plc private pvt".split()
ADDRESS_STOPWORDS = (
    "road rd street st avenue ave boulevard blvd drive dr lane ln way highway hwy place pl park "
    "building bldg floor fl unit suite ste apt apartment block "
    "district city town township county state "
    "india usa us united states "
    "north south east west new"
).split()
COUNTRY_ALIASES = {
    "us": "us", "usa": "us", "united states": "us", "united states of america": "us", "india": "india", "in": "india",
}
# Accented Latin letters and their plain ones; full-width forms follow from their code points.
ACCENTED = "áàâäãåéèêëíìîïóòôöõúùûüçñýÿÁÀÂÄÃÅÉÈÊËÍÌÎÏÓÒÔÖÕÚÙÛÜÇÑÝ"
PLAIN = "aaaaaaeeeeiiiiooooouuuucnyyAAAAAAEEEEIIIIOOOOOUUUUCNY"
WIDE = "".join(chr(0xFF01 + i) for i in range(94))
NARROW = "".join(chr(0x21 + i) for i in range(94))
MODES = ("full", "latin", "identity")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_ascii(c, mode: str = "full") -> Column:
    """full: romanization of every script in one Arrow pass. latin: accents and width only, inside the JVM.
    identity: the text as it is (what the surveyed pipeline does where its library is missing)."""
    c = F.coalesce(_c(c), F.lit(""))
    if mode == "full":
        return romanize_col(c)
    if mode == "latin":
        # most texts are ASCII, and translate() looks up each letter
        plain = F.replace(F.translate(c, ACCENTED + WIDE, PLAIN + NARROW), F.lit("ß"), F.lit("ss"))
        return F.when(F.octet_length(c) == F.char_length(c), c).otherwise(plain)
    if mode == "identity":
        return c
    raise ValueError(f"mode must be one of {MODES}")


def normalize_text(c, mode: str = "full") -> Column:
    """ASCII, lower case, apostrophes out, & spelled out, every other run of characters one space. Idempotent."""
    x = F.lower(to_ascii(c, mode))
    for mark in "'’`":
        x = F.replace(x, F.lit(mark), F.lit(""))
    x = F.regexp_replace(F.replace(x, F.lit("&"), F.lit(" and ")), "[^a-z0-9]+", " ")
    return F.trim(x)


normalize_name = normalize_text
normalize_address = normalize_text


def normalize_country(c, mode: str = "full") -> Column:
    """normalize_text, then the two alias sets; every other country stays as written."""
    x = normalize_text(c, mode)
    table = F.create_map(*[F.lit(v) for kv in COUNTRY_ALIASES.items() for v in kv])
    return F.coalesce(F.try_element_at(table, x), x)


def _split(c) -> Column:
    return F.filter(F.split(_c(c), " "), lambda t: t != "")


def _lits(words) -> Column:
    return F.array(*[F.lit(w) for w in words])


def normalize_name_core(normalized) -> Column:
    """The normalized name without its legal-form tokens, wherever they stand; may be empty."""
    return F.array_join(F.filter(_split(normalized), lambda t: ~t.isin(LEGAL_SUFFIXES)), " ")


def tokens(normalized) -> Column:
    return F.array_distinct(_split(normalized))


def name_block_tokens(normalized, min_len: int = 3) -> Column:
    return F.filter(tokens(normalized), lambda t: F.length(t) >= min_len)


def address_tokens(normalized) -> Column:
    """Distinct tokens of three letters or more that are no stop word."""
    return F.filter(tokens(normalized), lambda t: (F.length(t) >= 3) & ~t.isin(ADDRESS_STOPWORDS))


def address_location_tokens(normalized) -> Column:
    """Distinct tokens of four letters or more that are neither a stop word nor a number."""
    return F.filter(tokens(normalized), lambda t: (F.length(t) >= 4) & ~t.isin(ADDRESS_STOPWORDS) & ~t.rlike("^[0-9]+$"))


def numeric_tokens(normalized) -> Column:
    """Distinct runs of digits, also those inside a token; leading zeros stay."""
    return F.array_distinct(F.regexp_extract_all(_c(normalized), F.lit("[0-9]+"), 0))


def _once(c: Column, make) -> Column:
    """make(c) with c evaluated once: what a lambda refers to outside of itself is evaluated for each element."""
    return F.element_at(F.transform(F.array(c), make), 1)


def char_ngrams(normalized, n: int = 3) -> Column:
    """Distinct n-grams of the text without its spaces; a text of at most n characters is its own gram."""
    empty = F.array().cast("array<string>")

    def grams(x: Column) -> Column:
        all_of_them = F.transform(F.sequence(F.lit(1), F.greatest(F.length(x) - n + 1, F.lit(1))), lambda i: F.substring(x, i, F.lit(n)))
        return F.when(F.length(x) == 0, empty).when(F.length(x) <= n, F.array(x)).otherwise(F.array_distinct(all_of_them))

    return _once(F.replace(_c(normalized), F.lit(" "), F.lit("")), grams)


SEP = "\x01"


def token_pairs(token_set) -> Column:
    """All unordered pairs of different tokens, the smaller first, joined by a separator that no token holds.
    Quadratic in the number of tokens: meant for names and addresses, not for long texts."""

    def pairs(ts: Column) -> Column:
        return F.flatten(F.transform(ts, lambda a, i: F.transform(F.slice(ts, i + 2, F.greatest(F.size(ts), F.lit(1))), lambda b: F.concat(a, F.lit(SEP), b))))

    return _once(F.array_sort(_c(token_set)), pairs)


def cross_pairs(left, right) -> Column:
    """Every element of one array with every element of the other."""
    return _once(_c(right), lambda r: F.flatten(F.transform(_c(left), lambda a: F.transform(r, lambda b: F.concat(a, F.lit(SEP), b)))))


def strip_ws(c) -> Column:
    """Python's strip: every kind of blank at both ends."""
    return F.regexp_replace(F.regexp_replace(_c(c), r"^\s+", ""), r"\s+$", "")


def split_ids(c) -> Column:
    """Comma list to distinct ids, blanks around them and empties removed."""
    parts = F.transform(F.split(F.coalesce(_c(c), F.lit("")), ","), strip_ws)
    return F.array_distinct(F.filter(parts, lambda x: x != ""))


def split_ids_list(c) -> Column:
    """Comma list to ids in order, repeats kept."""
    parts = F.transform(F.split(F.coalesce(_c(c), F.lit("")), ","), strip_ws)
    return F.filter(parts, lambda x: x != "")


def parse_truth_ids(c) -> Column:
    """Comma list to ids in order without stripping."""
    return F.filter(F.split(F.coalesce(_c(c), F.lit("")), ","), lambda x: x != "")


def is_ascii_name(c) -> Column:
    """Whether every character but blanks is ASCII."""
    return ~F.regexp_replace(F.coalesce(_c(c), F.lit("")), r"\s+", "").rlike(r"[^\x00-\x7F]")


# What stands for a missing value in the delivered tables.
PLACEHOLDERS = ("", "na", "n/a", "null", "none", "nan", "-")


def missing(c) -> Column:
    """Null, blank or one of the placeholders, whatever its case."""
    return F.coalesce(F.lower(strip_ws(c)).isin(*PLACEHOLDERS), F.lit(True))
