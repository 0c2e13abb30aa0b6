"""Unicode compatibility form and romanization to ASCII.

Romanization is by rule: the letters of Indic scripts are read off their Unicode character names
(consonant with inherent vowel, vowel signs, virama), as are Hangul syllables and Kana; Latin letters lose their marks, and alphabets go
through short tables. What has no rule (ideographs, whose reading no rule gives) becomes a space. `unidecode` is used instead where it is installed
and asked for.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Romanization of alphabets and of Latin letters without decomposition.
CYRILLIC = dict(
    zip(
        "абвгдежзийклмнопрстуфхцчшщъыьэюяіїєґјѕһўљњћђџ",
        "a b v g d e zh z i y k l m n o p r s t u f h c ch sh sch _ y _ e yu ya i yi ye g j s h u lj nj c dj dz".split(),
    )
)
GREEK = dict(zip("αβγδεζηθικλμνξοπρσςτυφχψω", "a b g d e z i th i k l m n x o p r s s t y f ch ps o".split()))
LATIN = {"ß": "ss", "æ": "ae", "œ": "oe", "ø": "o", "đ": "d", "ł": "l", "þ": "th", "ð": "d", "ı": "i", "ħ": "h", "ŋ": "n"}
HEBREW = dict(zip("אבגדהוזחטיךכלםמןנסעףפץצקרשת", "a b g d h v z h t y k k l m m n n s a p p ts ts q r sh t".split()))
ARABIC = dict(zip("ابتثجحخدذرزسشصضطظعغفقكلمنهويىةپچژگکی", "a b t th j h kh d dh r z s sh s d t z a gh f q k l m n h w y a h p ch zh g k y".split())) | {"ء": "", "ئ": "y", "ؤ": "w", "ـ": ""}
THAI = dict(
    zip(
        "กขฃคฅฆงจฉชซฌญฎฏฐฑฒณดตถทธนบปผฝพฟภมยรลวศษสหฬอฮะาำิีึืุูเแโใไ",
        "k kh kh kh kh kh ng ch ch ch s ch y d t th th th n d t th th th n b p ph f ph f ph m y r l w s s s h l o h a a am i i ue ue u u e ae o ai ai".split(),
    )
)
ARMENIAN = dict(zip("աբգդեզէըթժիլխծկհձղճմյնշոչպջռսվտրցւփքօֆ", "a b g d e z e e t zh i l kh ts k h dz gh ch m y n sh o ch p j r s v t r ts w p k o f".split()))
GEORGIAN = dict(zip("აბგდევზთიკლმნოპჟრსტუფქღყშჩცძწჭხჯჰ", "a b g d e v z t i k l m n o p zh r s t u p k gh q sh ch ts dz ts ch kh j h".split()))
TABLES = (CYRILLIC, GREEK, LATIN, HEBREW, ARABIC, THAI, ARMENIAN, GEORGIAN)
MARKS = {"’": "'", "‘": "'", "“": '"', "”": '"', "–": "-", "—": "-", "‐": "-", "‑": "-", "−": "-", "…": "...", "·": ".", "№": "No", "ʼ": "'", "ー": "", "・": " "}

_LETTER = re.compile(r"^(DEVANAGARI|KANNADA|BENGALI|GUJARATI|GURMUKHI|TAMIL|TELUGU|MALAYALAM|ORIYA) (LETTER|VOWEL SIGN|SIGN|DIGIT) (.+)$")
_NAMED = re.compile(r"^(?:HANGUL SYLLABLE|(?:HIRAGANA|KATAKANA) LETTER(?: SMALL)?) ([A-Z]+)$")
_ASCII = re.compile(r"^[\x00-\x7f]*$")
_memo: dict[str, tuple[str, str]] = {}


def _indic(ch: str) -> tuple[str, str] | None:
    """(kind, text) of an Indic character: consonant, vowel, sign (dependent vowel), virama, mark or digit."""
    m = _LETTER.match(unicodedata.name(ch, ""))
    if not m:
        return None
    kind, what = m[2], m[3].split(" WITH ")[0].lower()
    if kind == "DIGIT":
        return "digit", str(unicodedata.digit(ch))
    if kind == "SIGN":
        if what == "virama":
            return "virama", ""
        return "mark", {"anusvara": "n", "candrabindu": "n", "visarga": "h"}.get(what, "")
    what = re.sub(r"^(candra|short|vocalic) ", "", what)
    if kind == "VOWEL SIGN":
        return "sign", re.sub(r"(.)\1", r"\1", what)
    if what[0] in "aeiou" or len(what) == 1:
        return "vowel", re.sub(r"(.)\1", r"\1", what)
    body = what[:-1] if what.endswith("a") else what
    body = re.sub(r"^(tt|dd|nn|ss|ll|rr)", lambda g: g[0][0], body)
    return "consonant", body


def _one(ch: str) -> tuple[str, str]:
    got = _memo.get(ch)
    if got is None:
        got = _indic(ch)
        if got is None:
            low = ch.lower()
            known = next((t[low] for t in TABLES if low in t), None)
            named = _NAMED.match(unicodedata.name(ch, ""))
            if ch in MARKS:
                text = MARKS[ch]
            elif named:
                text = named[1].lower()
            elif known is not None:
                text = known.replace("_", "")
                text = text.upper() if ch != low and len(text) == 1 else text.capitalize() if ch != low else text
            else:
                base = "".join(c for c in unicodedata.normalize("NFD", ch) if not unicodedata.combining(c))
                if base and _ASCII.match(base):
                    text = base
                elif base and base != ch and len(base) == 1:
                    text = _one(base)[1]
                elif unicodedata.category(ch) in ("Mn", "Me", "Cf"):
                    text = ""
                else:
                    text = " "
            got = ("other", text)
        _memo[ch] = got
    return got


def unicode_normalize(text: str | None) -> str:
    """None becomes empty; otherwise the stripped text in compatibility composed form."""
    return "" if text is None else unicodedata.normalize("NFKC", str(text).strip())


def romanize(text: str | None) -> str:
    """ASCII rendering of the compatibility form of text."""
    text = unicode_normalize(text)
    if _ASCII.match(text):
        return text
    out: list[str] = []
    pending = False  # a consonant whose inherent vowel is still open
    for ch in text:
        if ch < "\x80":
            pending = False  # at the end of a word the inherent vowel is silent
            out.append(ch)
            continue
        kind, piece = _one(ch)
        if kind in ("consonant", "vowel", "digit", "other") and pending:
            if kind == "consonant" or kind == "vowel":
                out.append("a")
            pending = False
        if kind in ("sign", "virama"):
            pending = False
        elif kind == "mark" and pending and piece:
            out.append("a")
            pending = False
        out.append(piece)
        if kind == "consonant":
            pending = True
    return "".join(out)


def _per_distinct(values: pd.Series, f) -> pd.Series:
    codes, uniques = pd.factorize(values, use_na_sentinel=True)
    done = [f(u) for u in uniques]
    empty = f(None)
    return pd.Series([done[c] if c >= 0 else empty for c in codes], dtype=object)


def _udf(f):
    @F.pandas_udf("string")
    def run(values: pd.Series) -> pd.Series:
        return _per_distinct(values, f)

    return run


def unicode_normalize_col(c: Column) -> Column:
    """unicode_normalize over a column: one Arrow pass, one evaluation for each distinct value of a batch."""
    return _udf(unicode_normalize)(c)


def romanize_col(c: Column, library: bool = False) -> Column:
    """romanize over a column. library: use `unidecode` where it is installed."""
    f = romanize
    if library:
        try:
            from unidecode import unidecode

            def f(text):
                return unidecode(unicode_normalize(text))

        except ImportError:
            pass
    return _udf(f)(c)
