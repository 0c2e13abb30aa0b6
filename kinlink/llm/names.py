"""Organisation names taken apart and compared (problems 3 and 5).

parse_name() separates the coined or family words from given name, trade, legal form, partners' suffix and additions such as a
place in brackets, whatever the script. same_org() compares two names: the trade must agree where both state one, the
coined words must agree up to typing errors, dropped vowels, joined or parted words and any order of the words.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache
from itertools import permutations
from typing import NamedTuple

from kinlink.functions.text import LEGAL_SUFFIXES, PLACEHOLDERS
from kinlink.functions.translit import romanize
from kinlink.llm.address import osa
from kinlink.llm.lookalike import SHAPES, look

# Written forms of trades, legal forms, partners, openings, and given names with their short forms.
TRADES = {
    "apparel": "apparel apparels appl clothing garments", "bakery": "bakery bakers bkry bakeries", "bookstore": "bookstore book books bookshop bk store str stores",
    "ceramics": "ceramics ceramic ceram cer crmcs", "chemicals": "chemicals chemical chem chems", "cleaning": "cleaning cleaners clng cleaner clean",
    "construction": "construction const constr construct constructions", "consulting": "consulting consult consltg consultants consultancy consultg",
    "dairy": "dairy dairies dry", "dental": "dental dent dntl clinic clnc clinics cln", "electronics": "electronics electr elec electronic elecs eltrncs",
    "engineering": "engineering engg engrg eng engineers engr", "fisheries": "fisheries fishery fish fshrs", "foods": "foods food fds products",
    "furniture": "furniture furn furnitures", "garage": "garage garages grge", "hardware": "hardware hdwe hardwares hrdwr hdw",
    "insurance": "insurance insur ins insurances", "international": "international intl internatl int'l", "jewellers": "jewellers jewelers jwlrs jewellery jewelry jewel",
    "laboratories": "laboratories labs lab laboratory", "logistics": "logistics logist lgstcs logistic", "manufacturing": "manufacturing mfg manufg manuf mfrs manufacturers",
    "motors": "motors motor mtrs", "nursery": "nursery nurseries nurs nrsry", "optical": "optical opticals opt opticians optics",
    "packaging": "packaging packg pkg packagings pckg", "paper": "paper mills ppr mill papers mls", "pharmacy": "pharmacy pharm phcy pharmacies pharma",
    "plumbing": "plumbing plumb plbg plumbers plumber", "printing": "printing ptg printers print prntg press", "property": "property prop mgmt mgt management properties",
    "restaurant": "restaurant restaurants rest restr", "security": "security sec systems sys system securities", "seeds": "seeds seed sds",
    "services": "services serv svc svcs service", "technologies": "technologies tech techs technology technols", "textiles": "textiles textile txtls text textls",
    "travel": "travel travels trvl agency agcy agencies trav", "tyres": "tyre tire tyres tires centre center ctr",
    "brewery": "brewery breweries brewers brew brwy", "foundation": "foundation foundations fdn fndn", "hotel": "hotel hotels htl", "school": "school schools sch",
    "bank": "bank banks bnk", "transport": "transport transports transp trnsp", "hospital": "hospital hospitals hosp", "theatre": "theatre theater theatres theaters",
}
LEGAL = {*LEGAL_SUFFIXES, *"lp plc sa sarl kg gmbh ag ltda spa srl bv nv oy ab as aps kft sl pte pty ohg ug cia".split()}
PARTNERS = set("sons son daughters daughter dtrs brothers brother bros coowners owners ovners coowner partners associates".split())
OPENINGS = set("the m/s ms messrs shri sri shree mr mrs dr".split())
JOINERS = set("and n & et und y e u".split())
GIVEN = {
    "alexander": "alex sandy sasha xander alec", "antonio": "tony toni tonio", "benjamin": "ben benny benji", "charles": "charlie chuck chas",
    "andrew": "andy drew", "anthony": "tony ant", "christopher": "chris kit topher", "daniel": "dan danny", "david": "dave davy", "james": "jim jimmy jamie",
    "john": "jack johnny jon", "joseph": "joe joey", "matthew": "matt", "peter": "pete", "rebecca": "becky becca", "stephen": "steve steven",
    "dorothy": "dot dolly dottie dora", "edward": "ed eddie ned ted teddy", "elizabeth": "liz betty beth eliza lizzie bess", "francisco": "paco pancho frank fran cisco",
    "frederick": "fred fritz freddie freddy", "gabriela": "gabi gaby", "giuseppe": "beppe peppe pino", "johannes": "hans hannes johann jo",
    "josefina": "fina pepa josie", "katherine": "kate katie kathy kat kitty", "krishnan": "krish kittu kishan", "lakshmi": "laxmi lachmi lak",
    "leonard": "len lenny leo", "margaret": "maggie meg peggy marge", "michael": "mike mick mickey", "nicholas": "nick nicky klaus nico", "patricia": "pat trish patty tricia",
    "rajendra": "raju rajen raj", "richard": "rich rick dick ricky", "robert": "bob bobby rob bert", "samuel": "sam sammy", "susanna": "sue susie susan suzy",
    "theodore": "theo ted teddy", "thomas": "tom tommy", "venkatesh": "venkat venky", "william": "bill will billy willy liam",
}

_FOLDS = (("ph", "f"), ("w", "v"), ("z", "j"), ("q", "k"), ("x", "ks"))


def fold(word: str) -> str:
    """Letters that scripts without them write alike made one."""
    for a, b in _FOLDS:
        if a in word:
            word = word.replace(a, b)
    return word


def _by_ends(words: list[str]) -> dict[tuple[str, bool], list[tuple[int, str]]]:
    """(position, word) by a word's first and by its last two letters."""
    ends: dict = {}
    for k, w in enumerate(words):
        ends.setdefault((w[:2], False), []).append((k, w))
        ends.setdefault((w[-2:], True), []).append((k, w))
    return ends


def _first_like(t: str, ends: dict) -> int:
    """The first word within an edit of t that begins or ends like it, or -1."""
    near = [(k, w) for x in ((t[:2], False), (t[-2:], True)) for k, w in ends.get(x, ()) if abs(len(w) - len(t)) <= 1]
    return next((k for k, w in sorted(near) if osa(w, t, 1) <= 1), -1)


class Lexicon:
    """What names are made of beside their own words: trades and given names (name -> written forms), legal forms, partners, openings, joiners.
    The default one is that of the languages of the delivered tables; for others give the operators another one."""

    def __init__(self, trades: dict[str, str] = TRADES, given: dict[str, str] = GIVEN, legal=LEGAL, partners=PARTNERS, openings=OPENINGS, joiners=JOINERS) -> None:
        self.legal, self.partners, self.openings, self.joiners = frozenset(legal), frozenset(partners), frozenset(openings), frozenset(joiners)
        plain = {w: k for k, forms in enumerate(trades.values(), 1) for w in forms.split()}
        self.trade_of = {fold(w): k for w, k in plain.items()} | plain
        self.trade_bare = {fold(w).replace("a", ""): k for w, k in plain.items() if len(w) >= 7}  # scripts whose inherent vowel is not always spoken
        self.trade_long = [(w, k) for w, k in plain.items() if len(w) >= 6]
        self.given = list(given)
        self.given_of: dict[str, frozenset] = {}
        for n, forms in given.items():
            for w in (n, *forms.split()):
                self.given_of[w] = self.given_of.get(w, frozenset()) | {n}
        self._long_ends, self._given_ends = _by_ends([w for w, _ in self.trade_long]), _by_ends(self.given)
        self._memo: dict[str, tuple[int, str]] = {}

    def like(self, t: str) -> tuple[int, str]:
        """(trade, given name) that a word mistypes: 0 and the empty text where there is none."""
        got = self._memo.get(t)
        if got is None:
            if len(self._memo) > 1 << 15:
                self._memo.clear()
            got = self._memo[t] = (self._trade_like(t), self._given_like(t))
        return got

    def _trade_like(self, t: str) -> int:
        if len(t) < 6:
            return 0
        bare = self.trade_bare.get(fold(t).replace("a", ""), 0)
        if bare:
            return bare
        at = _first_like(t, self._long_ends)
        return self.trade_long[at][1] if at >= 0 else 0

    def _given_like(self, t: str) -> str:
        at = _first_like(t, self._given_ends)
        return self.given[at] if at >= 0 else ""


LEXICON = Lexicon()
_OCR = str.maketrans("0158", "olsb")
_VOWELS = re.compile("[aeiouy]")
_NO_VOWELS = str.maketrans("", "", "aeiouy")
_DOUBLED = re.compile(r"(.)\1+", re.DOTALL)
_TOKEN = re.compile(r"[a-z0-9]+(?:['/][a-z0-9]+)*|&")
_TAIL = re.compile(r"\(.*?\)|\s[-–]\s*(?:head office|branch|main office|hq)\b.*$")
_NATIVE = re.compile("[Ѐ-ӿͰ-Ͽ]")
_BY_SOUND = str.maketrans({"щ": "w", "Щ": "W", "й": "j", "Й": "J"})  # letters that stand for w and j in names carried over from Latin


class OrgName(NamedTuple):
    """words: coined or family words, space between; given: possible given names or an initial, '|' between; trade: class or 0."""

    words: str
    given: str
    trade: int
    partner: str

    @property
    def ok(self) -> bool:
        return bool(self.words)


NO_NAME = OrgName("", "", 0, "")


@lru_cache(1 << 16)
def bones(word: str) -> str:
    """Consonants, doublings removed."""
    return _DOUBLED.sub(r"\1", word.translate(_NO_VOWELS))


def _latin(text: str) -> str:
    """Look-alike letters to Latin ones; a text truly written in another script is romanized instead."""
    text = look(text, shapes=False) or ""
    if text.isascii():
        return text
    native = [c for c in text if _NATIVE.match(c)]
    if native and any(c not in SHAPES for c in native):
        return romanize(text.translate(_BY_SOUND))
    return romanize(look(text) or "")


def parse_name(text: str | None, lexicon: Lexicon = LEXICON) -> OrgName:
    """Null, blank and placeholder names give NO_NAME."""
    if text is None or text.strip().lower() in PLACEHOLDERS:
        return NO_NAME
    s = _TAIL.sub(" ", _latin(text).lower()).replace("co-owner", "coowner").replace("m/s.", "m/s")
    tokens = [t.rstrip(".") for t in _TOKEN.findall(s)]
    words: list[str] = []
    given: set[str] = set()
    initial = partner = ""
    trade = 0
    for i, t in enumerate(tokens):
        if t in lexicon.joiners and (t != "e" or len(tokens) > 3):
            if t in ("e", "y", "u", "n") and i == 0:
                initial = t
            continue
        if (i == 0 and t in lexicon.openings) or t in lexicon.legal:
            continue
        if t.startswith("coowner") or t in lexicon.partners:
            partner = t[:3]
            continue
        k = lexicon.trade_of.get(t, 0) or lexicon.trade_of.get(fold(t), 0)
        if k:
            trade = trade or k
            continue
        if len(t) > 1 and any(c.isdigit() for c in t) and any(c.isalpha() for c in t):
            t = t.translate(_OCR)
        if t in lexicon.given_of and not given:
            given |= lexicon.given_of[t]
            continue
        if len(t) == 1 and t.isalpha():
            initial = initial or t
            continue
        words.append(t.replace("'", "").replace("/", ""))
    if len(words) > 1 or (words and not trade):
        # a mistyped trade or given name among what is left; a word must remain
        for t in list(words):
            if len(words) > 1 and not trade and (k := lexicon.like(t)[0]):
                trade = k
                words.remove(t)
        if partner or len(words) > 1:
            for t in list(words):
                if len(words) > 1 and not given and len(t) >= 5:
                    hit = lexicon.like(t)[1]
                    if hit:
                        given.add(hit)
                        words.remove(t)
    return OrgName(" ".join(fold(w) for w in words), "|".join(sorted(given)) or fold(initial), trade, partner)


@lru_cache(1 << 16)
def _close(a: str, b: str) -> bool:
    """The same word up to typing errors: one edit, or two or three that do not sit in one spot (a replaced syllable is
    another name)."""
    if a == b:
        return True
    n = min(len(a), len(b))
    most = 0 if n < 4 else 1 if n < 7 else 2 if n < 14 else 3
    d = osa(a, b, most)
    if d > most:
        return False
    if d <= 1:
        return True
    i = 0
    while i < n and a[i] == b[i]:
        i += 1
    j = 0
    while j < n - i and a[-1 - j] == b[-1 - j]:
        j += 1
    spot = max(len(a), len(b)) - i - j
    if spot > (3 if d == 2 else 5) or (d == 2 and abs(len(a) - len(b)) == 2):
        return True
    # in one spot: letters in another order are an error of typing, other letters are another name
    x, y = list(a[i : len(a) - j]), b[i : len(b) - j]
    other = 0
    for ch in y:
        if ch in x:
            x.remove(ch)
        else:
            other += 1
    return other + len(x) <= 2


def vowelless(word: str) -> bool:
    return len(word) >= 3 and len(_VOWELS.findall(word[1:])) * 8 < len(word)


def few_vowels(words: list[str]) -> bool:
    """Has a word without vowels, or few vowels in all."""
    joined = "".join(words)
    return any(map(vowelless, words)) or len(joined) - len(bones(joined)) < len(joined) // 3


def _same_bones(x: str, y: str, worn: bool = True) -> bool:
    """Equal consonants; of names short of vowels also with one lost, doubled or moved in six or more; another consonant is another name."""
    if x == y:
        return True
    if not worn or min(len(x), len(y)) < 6 or osa(x, y, 1) > 1:
        return False
    return len(x) != len(y) or sorted(x) == sorted(y)


def _word(a: str, b: str) -> bool:
    va, vb = vowelless(a), vowelless(b)
    if va != vb:
        return _same_bones(bones(a), bones(b))
    return _close(a, b) or (min(len(a), len(b)) >= 6 and a.replace("a", "") == b.replace("a", ""))


def _assigned(a: list[str], b: list[str]) -> bool:
    """Each word of a stands for another one of b, in any order: a flow between the distinct words."""
    left, free = Counter(a), Counter(b)
    fit = {x: sorted((y for y in free if _word(x, y)), key=lambda y: y != x) for x in left}
    if not all(fit.values()):
        return False
    flow: Counter = Counter()
    for x, need in left.items():
        while need:
            via, back, queue, end = {}, {x: None}, [x], None
            for u in queue:
                for y in fit[u]:
                    if y not in via:
                        via[y] = u
                        if free[y]:
                            end = y
                            break
                        for v in left:
                            if v not in back and flow[v, y]:
                                back[v] = y
                                queue.append(v)
                if end is not None:
                    break
            if end is None:
                return False
            path, y, most = [], end, min(need, free[end])
            while y is not None:
                u = via[y]
                path.append((u, y, 1))
                y = back[u]
                if y is not None:
                    path.append((u, y, -1))
                    most = min(most, flow[u, y])
            for u, y, sign in path:
                flow[u, y] += sign * most
            free[end] -= most
            need -= most
    return True


def _words_match(a: list[str], b: list[str]) -> bool:
    if len(a) > len(b):
        a, b = b, a  # the name of more words is the one whose orders are tried
    if len(a) == len(b):
        if len(a) > 3:
            return _word("".join(a), "".join(b)) or _assigned(a, b)
        if any(all(_word(x, y) for x, y in zip(a, p)) for p in permutations(b)):
            return True
    ja = "".join(a)
    orders = permutations(b) if len(b) <= 3 else [tuple(b)]
    bare = any(map(vowelless, a)) != any(map(vowelless, b))
    worn = few_vowels(a) or few_vowels(b)
    for p in orders:
        jb = "".join(p)
        if _close(ja, jb):
            return True
        if bare or abs(len(ja) - len(jb)) >= 3:
            if _same_bones(bones(ja), bones(jb), worn):
                return True
    if len(a) <= 3 and len(b) > 3:
        return any(_close("".join(p), "".join(b)) for p in permutations(a))
    return False


def near_org(a: OrgName, b: OrgName) -> bool:
    """Names that differ by at most three edits in all, trades not contradicting: enough where the place says the rest."""
    if not a.words or not b.words or (a.trade and b.trade and a.trade != b.trade):
        return False
    ja, wb = a.words.replace(" ", ""), b.words.split()
    orders = permutations(wb) if len(wb) <= 3 else [tuple(wb)]
    return len(ja) >= 10 and any(osa(ja, "".join(p), 3) <= 3 for p in orders)


def same_org(a: OrgName, b: OrgName) -> int:
    """0: different or not known. 2: the same, trade confirmed. 1: the same coined words, the trade not stated on one side."""
    if not a.words or not b.words or (a.trade and b.trade and a.trade != b.trade):
        return 0
    wa, wb = a.words.split(), b.words.split()
    if a.given and b.given:
        ga, gb = a.given.split("|"), b.given.split("|")
        if not any(x == y or (1 in (len(x), len(y)) and fold(x[0]) == fold(y[0])) for x in ga for y in gb):
            return 0
    if not _words_match(wa, wb):
        # a given name that was not recognised on one side stays among its words
        if bool(a.given) == bool(b.given) or len(wa) == len(wb):
            return 0
        full, bare, g = (wa, wb, b.given) if len(wa) > len(wb) else (wb, wa, a.given)
        names = g.split("|")
        if not any(
            (vowelless(w) and any(bones(w) == bones(fold(x)) for x in names if len(x) > 1)) or any(osa(w, fold(x), 2) <= 2 for x in names if len(x) > 4)
            for w in full
            if _words_match([v for v in full if v is not w], bare)
        ):
            return 0
    return 2 if a.trade and b.trade else 1
