"""Postal addresses taken apart and compared (problem 1).

parse() reads house number (with its letter or range), the words of the street, street type, direction, town, region and postcode out of one
free-form line whatever the order of its parts; unit, floor, landmark, building name and country are dropped. Number, town and region are told by
their position, not by their length. Where nothing marks the end of the street ("calle a b c") or its start ("a b c road 5"), the address is
`loose`: its words may belong to the street or to the town, and all of them are compared in order. same_place() is strict on numbers, letters, directions,
types and ordinals, and tolerant of typing errors (edit distance with transpositions) in the words of street and town.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from kinlink.functions.translit import romanize

# Written forms of street types by class, directions, unit words, landmarks' prepositions, number words, countries.
TYPES = {
    "avenue": "avenue ave av aven avenida avda avd", "drive": "drive dr drv", "lane": "lane ln la", "road": "road rd",
    "street": "street st str strasse", "square": "square sq sqr", "boulevard": "boulevard blvd boul bd bvd blv bld bulevar",
    "court": "court ct crt", "place": "place pl plaza pza plza platz pza", "paseo": "paseo pso po", "calle": "calle cl c",
    "rua": "rua r rue", "alameda": "alameda alam al allee all", "travessa": "travessa trav tv", "weg": "weg wg", "highway": "highway hwy", "way": "way wy", "terrace": "terrace ter terr", "gasse": "gasse",
    "close": "close clo", "crescent": "crescent cres", "via": "via", "piazza": "piazza pzza", "praca": "praca",
}
BEFORE_NAME = {"paseo", "calle", "rua", "travessa", "via", "piazza", "praca"}
AFTER_NAME = {"drive", "lane", "road", "street", "square", "court", "weg", "highway", "way", "terrace", "gasse", "close", "crescent"}
GLUED = ("strasse", "str", "weg", "wg", "platz", "pl", "allee", "all", "gasse")
# written forms that stand before the name; avenue, av, boulevard, boul, pl and place stand on either side
LEADING = set("avenida avda avd plaza pza plza alameda alam al bd bld place".split())
TRAILING = set("ave blvd bvd blv allee all platz".split())
DIRECTIONS = {"north": "n", "nth": "n", "n": "n", "south": "s", "sth": "s", "s": "s", "east": "e", "e": "e", "west": "w", "wst": "w", "w": "w", "est": "e"}
UNIT_WORDS = "unit flat suite ste floor fl apt apartment room rm level lvl shop office"
NUMBER_WORDS = "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty".split()
ORDINAL_WORDS = "zeroth first second third fourth fifth sixth seventh eighth ninth tenth eleventh twelfth".split()
ARTICLES = set("da das de del der des do dos du el la las le les los of the und".split())
COUNTRY_WORDS = ("usa", "u s a", "united states of america", "united states", "india", "united kingdom", "brazil", "brasil", "germany", "deutschland", "england")
COUNTRY_CODES = set(
    "us in de gb br fr es it nl be pl at cz se ch uk gr fi no pt ie ro dk mn ua ma rs eg bg ke kz za gh hu ae il sa mx ng tz tr ar sg pe np nz uy co kr ph lk jp kh th bd my tw mm hk vn au cl pk ca id la".split()
)

TYPE_NAMES = list(TYPES)
TYPE_OF: dict[str, int] = {}
for _i, _n in enumerate(TYPE_NAMES):
    for _w in TYPES[_n].split():
        TYPE_OF[_w] = TYPE_OF.get(_w, 0) | 1 << _i
_BEFORE = sum(1 << TYPE_NAMES.index(n) for n in BEFORE_NAME)
_AFTER = sum(1 << TYPE_NAMES.index(n) for n in AFTER_NAME)


class Address(NamedTuple):
    """ok: it has a house number and a street; types: bit set of the classes the written type may stand for; street, town: words with
    blanks between; loose: 1 if the end of the street is not marked, 2 if its start is not; second: the name
    after the town as written, for places.settle_regions()."""

    number: str
    letter: str
    direction: str
    types: int
    street: str
    town: str
    region: str
    postcode: str
    loose: int = 0
    second: str = ""

    @property
    def ok(self) -> bool:
        return bool(self.number and self.street)


EMPTY = Address("", "", "", 0, "", "", "", "")
_SPLIT = re.compile(r"[,;\n\r\t|()]+|\s[-–—]+\s|\s[-–—]+$|^[-–—]+\s")
_UNIT = re.compile(rf"\b(?:{'|'.join(UNIT_WORDS.split())})\b\.?\s*(?:no\b\.?\s*|#\s*|-\s*)?(?:\d+[a-z]?\b|[a-z]\b|(?:{'|'.join(NUMBER_WORDS)})\b)")
_STOREY = re.compile(r"\b\d+\.?\s*(?:og|stock|etage|piso|andar)\b\.?")
_MARK = re.compile(r"\b(?:near|next to|behind|opposite|opp|beside|in front of|adjacent to|c/o|attn)\b\.?\s*[a-z]+(?:\s+[a-z]+)?")
_HOUSE = re.compile(r"\b([a-z]{3,})\s+(?:house|building|bldg|tower|haus|edificio)\b")
_UK = re.compile(r"\b([a-z]{1,2}\d[a-z\d]?)\s*(\d[a-z]{2})\b")
_BR = re.compile(r"\b(\d{5})\s*-\s*(\d{3})\b")
_PC3 = re.compile(r"\b(?=(\d{3})[ ]{1,3}(\d{2,3})\b(?!\s*-))")
_LONG = re.compile(r"\b\d{5,8}\b")
_ORDINAL = re.compile(r"\b(\d{1,6})(?:st|nd|rd|th)\b|\b(" + "|".join(ORDINAL_WORDS[1:]) + r")\b")
_LETTER = r"(?:(?:\s?[-/]\s?|\s{1,2})([a-df-mo-qt-vx-z])(?=\s|$)(?!\.)|([a-z])\b)?"
_RANGE = r"(?!\d)(?:[-/](\d{1,4})(?!\d))?"
_MARKED = re.compile(r"(?:\b(?:no|nr|num|nro)\b\.?\s*|#\s*)(\d{1,6})" + _RANGE + _LETTER)
_PLAINNUM = re.compile(r"(?<![\w-])(\d{1,4})" + _RANGE + _LETTER)
_LEADNUM = re.compile(r"(\d{5,6})" + _RANGE + _LETTER + r"(?=\s)")
_SHORTNUM = re.compile(r"(?<![\w-])\d{1,4}(?!\d)")
_SPELLED = re.compile(r"(?:\b(?:no|nr|num|nro)\b\.?\s*|#\s*)(" + "|".join(NUMBER_WORDS) + r")\b")
_NUMBER_WORD = re.compile(r"\b(" + "|".join(NUMBER_WORDS) + r")\b")
_COUNTRY = re.compile(r"\b(?:" + "|".join(w.replace(" ", r"[ .]*") for w in COUNTRY_WORDS) + r")\b\.?")
_TOKENS = re.compile(r",|\x00|\d+|[a-z]+(?:'[a-z]+)*\.?")
_CALLE, _PASEO = re.compile(r"\bc/(?=[a-z]{3})"), re.compile(r"\bpo\b\.?(?= ?[a-z])")
_DIGITS = "abcdefghij"


def _ordinal(m: re.Match) -> str:
    """An ordinal as a word without digits; equal ones only are the same."""
    n = int(m[1]) if m[1] else ORDINAL_WORDS.index(m[2])
    return " xth" + "".join(_DIGITS[int(d)] for d in str(n)) + " "


def _bare(word: str) -> str:
    return word.rstrip(".")


def _has_type(text: str) -> bool:
    return any(_bare(w) in TYPE_OF or any(_bare(w).endswith(g) and len(_bare(w)) >= len(g) + 4 for g in GLUED) for w in re.findall(r"[a-z]+\.?", text))


def _leading_number(segments: list[str]) -> re.Match | None:
    """A house number of five or six digits: it opens a segment that names a street, and no shorter number is there to be the house number."""
    for x in segments:
        m = _LEADNUM.match(x)
        if m and _has_type(x[m.end() :]) and not _SHORTNUM.search(" , ".join(segments)) and not _NUMBER_WORD.search(x):
            return m
    return None


def _cut_postcode(s: str) -> tuple[str, str]:
    """(text without the postcode, postcode)"""
    for pattern in (_UK, _BR, _LONG):
        m = pattern.search(s)
        if m:
            return s[: m.start()] + " , " + s[m.end() :], "".join(g for g in m.groups() if g) or m[0]
    # three and two or three digits side by side, the last such pair; a house number must be left over
    pairs = list(_PC3.finditer(s))
    if pairs and ("\x00" in s or len(re.findall(r"\d+", s)) > 2 or _NUMBER_WORD.search(s)):
        m = pairs[-1]
        return s[: m.start()] + " , " + s[m.end(2) :], m[1] + m[2]
    return s, ""


def _cut_number(s: str) -> tuple[str, str, str]:
    """(text with a mark in the place of the house number, number or range, letter)"""
    m = _MARKED.search(s) or _PLAINNUM.search(s)
    if not m:
        m = _NUMBER_WORD.search(s)
        return (s[: m.start()] + " \x00 " + s[m.end() :], str(NUMBER_WORDS.index(m[1])), "") if m else (s, "", "")
    number, letter, end = m[1].lstrip("0") or "0", m[3] or m[4] or "", m.end()
    if m[2]:
        number += "-" + (m[2].lstrip("0") or "0")
    if m[3] == "c" and s[m.start(3) - 1] == " " and not any(_bare(w) in TYPE_OF for w in (s[: m.start()] + s[m.end() :]).replace("-", " ").split()):
        letter, end = "", m.start(3) - 1  # "79 c ilkizos": the street type
    return s[: m.start()] + " \x00 " + s[end:], number, letter


class _Line:
    """The words of an address with the segments they stand in."""

    __slots__ = ("text", "seg", "kind")

    def __init__(self, s: str) -> None:
        self.text: list[str] = []
        self.seg: list[int] = []
        self.kind: list[str] = []
        seg = 0
        for tok in _TOKENS.findall(s.replace("-", " ")):
            if tok == ",":
                seg += 1
                continue
            self.text.append(tok)
            self.seg.append(seg)
            self.kind.append("num" if tok == "\x00" else "digits" if tok[0].isdigit() else "word")

    def span(self, k: int) -> tuple[int, int]:
        lo = hi = k
        while lo and self.seg[lo - 1] == self.seg[k]:
            lo -= 1
        while hi + 1 < len(self.seg) and self.seg[hi + 1] == self.seg[k]:
            hi += 1
        return lo, hi

    def names(self, at) -> list[int]:
        """Positions of words that may name something: no single letters, no articles."""
        return [i for i in at if self.kind[i] == "word" and len(_bare(self.text[i])) > 1 and _bare(self.text[i]) not in ARTICLES]

    def is_num(self, i: int) -> bool:
        return 0 <= i < len(self.kind) and self.kind[i] == "num"


def _pick_type(line: _Line) -> int | None:
    """Position of the word that is the street type: beside a name, the longest written form; others of the kind are put aside."""
    cands = [i for i, t in enumerate(line.text) if line.kind[i] == "word" and _bare(t) in TYPE_OF]
    if len(cands) > 1 and line.text[cands[-1]] in COUNTRY_CODES and cands[-1] == len(line.text) - 1:
        line.kind[cands.pop()] = "drop"
    if not cands:
        return None
    named = [i for i in line.names(range(len(line.text))) if i not in cands and len(_bare(line.text[i])) >= 3 and _bare(line.text[i]) not in DIRECTIONS]

    def rank(i: int) -> tuple:
        form = _bare(line.text[i])
        return (not any(line.seg[j] == line.seg[i] and abs(j - i) <= 2 for j in named), len(form) < 2, -len(form) if len(form) < 4 else -4, -i)

    k = min(cands, key=rank)
    for i in cands:
        # a short form elsewhere ("st", "c") is noise, a word like "place" or "park" inside a name is part of it
        if i != k and (len(_bare(line.text[i])) < 3 or line.seg[i] != line.seg[k]):
            line.kind[i] = "drop"
    line.kind[k] = "type"
    return k


def _street(line: _Line, k: int | None) -> tuple[list[int], int, int]:
    """(positions of the words of the street, loose, types). The words of its segment that are not taken stay names."""
    if k is None:
        for i, t in enumerate(line.text):
            t = _bare(t)
            if line.kind[i] == "word":
                for g in GLUED:
                    if t.endswith(g) and len(t) - len(g) >= 4:
                        line.text[i] = t[: -len(g)]
                        return [i], 0, TYPE_OF[g]
        # no type at all: the words beside the number
        n = next((i for i, x in enumerate(line.kind) if x == "num"), None)
        if n is None:
            named = line.names(range(len(line.text)))
            return (named[:1], 1, 0) if named else ([], 0, 0)
        lo, hi = line.span(n)
        after, before = line.names(range(n + 1, hi + 1)), line.names(range(lo, n))
        if not after and not before:  # the number stands alone: the segment before it, else the one after it
            near = [i for i in line.names(range(n)) if n and line.seg[i] == line.seg[n - 1]] or [i for i in line.names(range(n + 1, len(line.text))) if line.seg[i] == line.seg[min(n + 1, len(line.text) - 1)]]
            return near, 0, 0
        if after and (not before or len(after) <= len(before)) and not (before and hi == n + len(after) and lo == 0 and not any(line.seg[i] != line.seg[n] for i in range(len(line.text)))):
            return (after, 0, 0) if len(after) == 1 or any(line.seg[i] != line.seg[n] and line.kind[i] == "word" for i in range(len(line.text))) else (after[:1], 1, 0)
        return (before or after), 0, 0
    lo, hi = line.span(k)
    n = next((i for i in range(lo, hi + 1) if line.kind[i] == "num"), None)
    types = TYPE_OF[_bare(line.text[k])]
    before = line.names(range(n + 1 if n is not None and n < k else lo, k))
    after = line.names(range(k + 1, n if n is not None and n > k else hi + 1))
    solid_before = [i for i in before if _bare(line.text[i]) not in DIRECTIONS]
    solid_after = [i for i in after if _bare(line.text[i]) not in DIRECTIONS]
    if n is not None and n < k and not solid_before:
        before_far = [i for i in line.names(range(lo, n)) if _bare(line.text[i]) not in DIRECTIONS]
        if before_far and not solid_after:
            return before_far, 0, types
    if solid_before and solid_after:
        form = _bare(line.text[k])
        if types & ~_BEFORE == 0:
            leads = True
        elif types & ~_AFTER == 0:
            leads = False
        else:
            first = k == lo or line.is_num(k - 1)
            leads = form in LEADING or (form not in TRAILING and not line.is_num(solid_before[0] - 1) and (first or line.is_num(solid_after[0] + 1)))
    else:
        leads = not solid_before and bool(solid_after)
    if not leads:
        if len(solid_before) > 1 and not (n is not None and n < k) and not any(line.seg[i] != line.seg[k] and len(_bare(line.text[i])) > 3 for i in line.names(range(len(line.text)))):
            return solid_before[-1:], 2, types
        return solid_before or before, 0, types
    closed = n is not None and n > k or (hi + 1 < len(line.kind) and line.is_num(hi + 1) and (hi + 2 >= len(line.seg) or line.seg[hi + 2] != line.seg[hi + 1]))
    if len(solid_after) == 1 or closed:
        return solid_after, 0, types
    return solid_after[:1], 1, types


def parse(text: str | None) -> Address:
    """Null, blank and placeholder texts give EMPTY. Linear in the length of the text."""
    if not text:
        return EMPTY
    s = romanize(text).lower().replace("_", " ").replace("p.o ", "paseo ").replace("c/ ", "calle ").replace("u.s.a", "usa")
    s = _PASEO.sub("paseo", _CALLE.sub("calle ", s))
    s = _ORDINAL.sub(_ordinal, s)
    s = _SPELLED.sub(lambda m: f"# {NUMBER_WORDS.index(m[1])}", s)
    segments = [x for x in (x.strip() for x in _SPLIT.split(s)) if x]
    if len(segments) > 1 and _bare(segments[-1]) in COUNTRY_CODES:
        segments.pop()
    s = " , ".join(segments)
    s = _COUNTRY.sub(" , ", _STOREY.sub(" , ", _UNIT.sub(" , ", _MARK.sub(" , ", s))))
    s = _HOUSE.sub(lambda m: " , " if m[1] not in TYPE_OF else m[0], s)
    number = letter = ""
    m = _leading_number([x.strip() for x in s.split(",")])
    if m:
        number, letter = m[1] + ("-" + m[2] if m[2] else ""), m[3] or m[4] or ""
        s = s.replace(m[0], " \x00 ", 1)
    whole = s
    s, postcode = _cut_postcode(s)
    ends_in_postcode = bool(postcode) and not re.search("[a-z]", whole.replace(" ", "").rpartition(postcode[-3:])[2])
    if not number:
        s, number, letter = _cut_number(s)
    line = _Line(s)
    if not line.text:
        return EMPTY._replace(postcode=postcode, number=number, letter=letter)
    k = _pick_type(line)
    street, loose, types = _street(line, k)
    direction = _direction(line, k, street)
    words = [_bare(line.text[i]) for i in street]
    for i in street:
        line.kind[i] = "street"
    if not words and direction:
        words, direction = [direction], ""  # "north street"
    here = line.seg[street[0]] if street else line.seg[k] if k is not None else -1
    groups: dict[int, list[str]] = {}
    for i in line.names(range(len(line.text))):
        groups.setdefault(line.seg[i], []).append(line.text[i])
    order = sorted(groups, key=lambda g: (g != here, g < here, g))
    names: list[list[str]] = []
    code = ""  # what is abbreviated at the end of a part is a region
    for g in order:
        at = groups[g]
        while at and (at[-1].endswith(".") or len(at[-1]) < 4):
            last = _bare(at.pop())
            # a country's code stands last, a region's before the postcode
            code = last if last not in COUNTRY_CODES or ends_in_postcode else code
        if at:
            names.append([_bare(w) for w in at])
    town = " ".join(names[0]) if names else ""
    region = code[:3] or (names[1][0][:3] if len(names) > 1 else "")
    second = " ".join(names[1]) if len(names) > 1 else ""
    return Address(number, letter, direction, types, " ".join(words), town, region, postcode, loose, second)


def _direction(line: _Line, k: int | None, street: list[int]) -> str:
    """The direction that belongs to the street: beside its words, its type or the number, or alone in a segment."""
    anchors = {*street, *([k] if k is not None else []), *(i for i, x in enumerate(line.kind) if x == "num")}
    found = ""
    for i, t in enumerate(line.text):
        t = _bare(t)
        if line.kind[i] != "word" or t not in DIRECTIONS or i in street:
            continue
        near = any(abs(i - a) == 1 and line.seg[a] == line.seg[i] for a in anchors)
        if near or line.span(i) == (i, i):
            found = found or DIRECTIONS[t]
            line.kind[i] = "dir"
    return found


def osa(a: str, b: str, most: int) -> int:
    """Edit distance with transpositions of neighbours, or most + 1 where it is larger than most. Only the band of the matrix within `most` of
    the diagonal is computed: linear in the length for a fixed `most`."""
    if a == b:
        return 0
    la, lb, over = len(a), len(b), most + 1
    if abs(la - lb) > most or not most:
        return over
    # what both begin and end with costs nothing
    n = min(la, lb)
    i = 0
    while i < n and a[i] == b[i]:
        i += 1
    j = 0
    while j < n - i and a[la - 1 - j] == b[lb - 1 - j]:
        j += 1
    if i or j:
        a, b = a[i : la - j], b[i : lb - j]
        la, lb = len(a), len(b)
        if not la or not lb:
            return la or lb
    two: list[int] = []
    one = [j if j <= most else over for j in range(min(lb, most) + 1)]  # columns lo..hi of the row before
    lo1 = lo2 = 0
    for i in range(1, la + 1):
        ca = a[i - 1]
        lo, hi = max(0, i - most), min(lb, i + most)
        cur = []
        n1, n2 = len(one), len(two)
        low = left = over
        for j in range(lo, hi + 1):
            if j == 0:
                v = i
            else:
                k = j - lo1
                v = (one[k - 1] if 0 < k <= n1 else over) + (ca != b[j - 1])
                if k < n1 and one[k] + 1 < v:
                    v = one[k] + 1
                if left + 1 < v:
                    v = left + 1
                if i > 1 and j > 1 and ca == b[j - 2] and a[i - 2] == b[j - 1]:
                    k = j - 2 - lo2
                    if 0 <= k < n2 and two[k] + 1 < v:
                        v = two[k] + 1
            if v > over:
                v = over
            if v < low:
                low = v
            cur.append(v)
            left = v
        if low >= over and min(one) >= over:
            return over
        two, one, lo2, lo1 = one, cur, lo1, lo
    return min(one[lb - lo1], over)


def tolerance(a: str, b: str) -> int:
    n = min(len(a), len(b))
    return 0 if n < 4 else 1 if n < 6 else 2 if n < 11 else 3


def _like(a: str, b: str, more: int = 0) -> bool:
    """The same word up to typing errors; ordinals must be equal."""
    if a == b:
        return True
    if a.startswith("xth") or b.startswith("xth"):
        return False
    t = tolerance(a, b) + more
    return osa(a, b, t) <= t


def _same_words(a: str, b: str) -> bool:
    """Word by word; a word may be joined or parted."""
    if a == b:
        return True
    if " " not in a and " " not in b:
        return _like(a, b)
    wa, wb = a.split(), b.split()
    if len(wa) == len(wb):
        return all(map(_like, wa, wb)) and sum(osa(x, y, 3) for x, y in zip(wa, wb)) <= 3
    ja, jb = "".join(wa), "".join(wb)
    return "xth" not in ja + jb and abs(len(wa) - len(wb)) == 1 and osa(ja, jb, 1) <= 1


def _run(a: list[str], b: list[str], more: int = 0) -> bool:
    """The words of the shorter list open the longer one."""
    return bool(a and b) and all(_like(x, y, more) for x, y in zip(a, b))


def same_place(a: Address, b: Address) -> int:
    """0: not the same. 2: the same, confirmed by town or postcode. 1: the same as far as the parts that both have go,
    with the town known on one side only and no postcode to compare."""
    if a.number != b.number or a.letter != b.letter or not a.number or not a.street or not b.street:
        return 0
    if a.direction != b.direction or (a.types and b.types and not a.types & b.types):
        return 0
    ta, tb = a.town.split(), b.town.split()
    if a.loose or b.loose:
        wa, wb = a.street.split(), b.street.split()
        if not (a.loose and b.loose):
            if a.loose:
                wa, ta = _borrow(a.loose, wa, ta, len(wb))
            else:
                wb, tb = _borrow(b.loose, wb, tb, len(wa))
        if len(wa) != len(wb) or not all(map(_like, wa, wb)):
            return 0
    elif not _same_words(a.street, b.street):
        return 0
    p = None
    if a.postcode and b.postcode:
        p = a.postcode == b.postcode
        if not p and (a.postcode[:5] == b.postcode or b.postcode[:5] == a.postcode):
            p = True
    if ta and tb:
        if _run(ta, tb):
            exact = all(x == y for x, y in zip(ta, tb))
            return 2 if p is not False or (exact and osa(a.postcode, b.postcode, 1) <= 1 and a.postcode[:3] != b.postcode[:3]) else 0
        if p and (_run(ta, tb, 1) or (len(ta) == 1 and not a.region) or (len(tb) == 1 and not b.region)):
            return 2  # the one name given may be that of the region
        if not _only_region(ta, a.region, tb, b.region) and not _only_region(tb, b.region, ta, a.region):
            return 0
        return 1 if p is None else 2 if p else 0
    if p is not None:
        return 2 if p else 0
    if a.region and b.region and a.region != b.region:
        return 0
    return 1


def _borrow(loose: int, street: list[str], town: list[str], n: int) -> tuple[list[str], list[str]]:
    """Street and town of a loose address if its street has n words."""
    run = street + town if loose == 1 else town + street
    return (run[:n], run[n:]) if loose == 1 else (run[-n:], run[:-n])


def _only_region(town: list[str], region: str, other: list[str], other_region: str) -> bool:
    """What stands in the place of the town is the region of the other address."""
    return not region and len(town) == 1 and (town[0][:3] == other_region or (len(other) > 1 and not other_region and _like(town[0], other[-1])))
