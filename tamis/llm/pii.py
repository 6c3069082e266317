"""Problem 10: personal information, found through an offset-preserving deobfuscation.

Transducers rewrite a text step by step (look-alike characters and digits, spelled digits, at and dot
disguises) and carry along, for every character they leave, the span it came from. Detectors run on
the rewritten text; what they find is mapped back and reported as it stands in the source.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left, insort
from functools import lru_cache, reduce
from itertools import repeat
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamis.llm.forms import FARSI_YEH, JOINER, LOOKALIKE
from tamis.operators.joins import lookup_join
from tamis.session import cut, spread

KINDS = ("email", "phone", "id_number", "address", "name")
#: Least distinct partners and least share of uses beside a partner for a word to count as a name.
NAME_PARTNERS, NAME_SHARE = 2, 0.5
#: Names up to which a lexicon is broadcast; of a larger one each document gets by a join those that stand in it.
MAX_NAMES = 300_000

# Cues, street words and towns.
ID_CUES = ["cin", "c.i.n", "cin mte3i", "carte ta3rif", "bita9et ta3rif", "passeport", "passport", "carte d'identité", "carte d identité", "identity card", "id card", "national id", "id number", "sécurité sociale", "securite sociale", "social security", "cnss", "ب.ت.و", "بطاقة التعريف", "بطاقة تعريف", "جواز السفر", "جواز سفر", "الضمان الاجتماعي"]
OTHER_NUMBER_CUES = ["facture", "invoice", "order", "commande", "commande n°", "réf", "ref", "reference", "référence", "isbn", "code", "version", "colis n°", "الفاتورة", "فاتورة", "الطلبية", "طلبية", "المرجع", "fatoura", "el facture", "dated", "ticket"]
PHONE_CUES = ["tel", "tél", "téléphone", "telephone", "phone", "mobile", "gsm", "whatsapp", "call", "appelez", "numéro", "number", "noumrou", "nemrou", "kallemni", "التلفون", "نومرو", "هاتف", "الهاتف", "واتساب", "كلّمني", "كلمني", "اتصل"]
STREETS_FIRST = ["rue", "avenue", "av", "boulevard", "bd", "impasse", "place", "allée", "chemin", "route", "ruelle", "quai", "passage", "nahj", "zan9et", "zanket", "zan9a", "chera3", "cherа3", "charaa", "شارع", "نهج", "زنقة", "ساحة", "طريق"]
STREETS_LAST = ["street", "road", "lane", "avenue", "drive", "square", "way", "alley", "court", "place", "close", "terrace"]
TOWNS = [
    "tunis", "ariana", "l'ariana", "ben arous", "manouba", "la manouba", "nabeul", "zaghouan", "bizerte", "béja", "beja", "jendouba", "le kef", "el kef", "siliana", "sousse", "monastir", "mahdia", "sfax", "kairouan", "kasserine", "sidi bouzid", "gabès", "gabes", "médenine", "medenine", "tataouine", "gafsa", "tozeur", "kébili", "kebili", "la marsa", "hammamet", "djerba", "carthage", "9ayrouen", "9abes", "benzart", "nabel", "soussa", "sfa9es", "gafsa", "beja", "touzeur",
    "تونس", "أريانة", "بن عروس", "منوبة", "نابل", "زغوان", "بنزرت", "باجة", "جندوبة", "الكاف", "سليانة", "سوسة", "المنستير", "المهدية", "صفاقس", "القيروان", "القصرين", "سيدي بوزيد", "قابس", "مدنين", "تطاوين", "قفصة", "توزر", "قبلي", "المرسى", "الحمامات", "جربة", "قرطاج",
]
FAMILY_PARTICLES = {"ben", "bin", "bel", "بن", "بل"}
DIGIT_WORDS = {
    "zero": "0", "zéro": "0", "one": "1", "un": "1", "two": "2", "deux": "2", "three": "3", "trois": "3", "four": "4", "quatre": "4", "five": "5", "cinq": "5", "six": "6", "seven": "7", "sept": "7", "eight": "8", "huit": "8", "nine": "9", "neuf": "9",
    "صفر": "0", "واحد": "1", "زوز": "2", "اثنين": "2", "ثلاثة": "3", "أربعة": "4", "اربعة": "4", "خمسة": "5", "ستة": "6", "ستّة": "6", "سبعة": "7", "ثمانية": "8", "ثمنية": "8", "تسعة": "9", "sfir": "0", "wa7ed": "1", "zouz": "2", "thletha": "3", "arb3a": "4", "khamsa": "5", "setta": "6", "sab3a": "7", "thmenya": "8", "tes3a": "9",
}


class Traced:
    """A rewritten text and, for each of its characters, the span of the source it stands for."""

    __slots__ = ("source", "text", "start", "end")

    def __init__(self, source: str):
        self.source, self.text, self.start, self.end = source, source, None, None

    def _own(self):
        if self.start is None:
            n = len(self.text)
            self.start, self.end = list(range(n)), list(range(1, n + 1))

    def span(self, a: int, b: int) -> tuple[int, int]:
        """The source span of the characters a to b of the rewritten text."""
        return (a, b) if self.start is None else (self.start[a], self.end[b - 1])

    def characters(self) -> None:
        """Transducer of look-alikes, forms, digits, invisible characters and decomposed letters; what lies between them is copied."""
        text, at = self.text, 0
        out, start, end = [], [], []
        for m in _ODD.finditer(text):
            b = m.end()
            a = max(at, m.start() - 1)  # a mark may compose with the character before it
            out.append(text[at:a])
            start.extend(range(at, a))
            end.extend(range(at + 1, a + 1))
            at = b
            for i in range(a, b):
                c = text[i]
                if i > a and unicodedata.combining(c) and len(end) and len(x := unicodedata.normalize("NFC", out[-1] + c)) == 1:
                    out[-1], end[-1] = x, i + 1
                    continue
                to = _CHARS.get(ord(c), c)
                if to is None:
                    continue
                if to is c and _WIDE.match(c):
                    to = unicodedata.normalize("NFKC", c)
                out.extend(to)
                start.extend([i] * len(to))
                end.extend([i + 1] * len(to))
        if at:
            out.append(text[at:])
            start.extend(range(at, len(text)))
            end.extend(range(at + 1, len(text) + 1))
            self.text, self.start, self.end = "".join(out), start, end

    def rewrite(self, pattern: re.Pattern, to) -> None:
        """Transducer of one pattern; ``to`` gives the replacement of a match, all of whose characters stand for the whole match."""
        ms = list(pattern.finditer(self.text))
        if not ms:
            return
        self._own()
        out, start, end, at = [], [], [], 0
        for m in ms:
            new = to(m)
            out.append(self.text[at : m.start()])
            start += self.start[at : m.start()] + [self.start[m.start()]] * len(new)
            end += self.end[at : m.start()] + [self.end[m.end() - 1]] * len(new)
            out.append(new)
            at = m.end()
        out.append(self.text[at:])
        self.text, self.start, self.end = "".join(out), start + self.start[at:], end + self.end[at:]


_WIDE = re.compile("[ﭐ-﷿ﹰ-ﻼ！-～]")
_CHARS = LOOKALIKE | {ord(FARSI_YEH): "ي", ord(JOINER): None, ord("ـ"): None}
_ODD_CHARS = re.escape("".join(map(chr, _CHARS))) + "ﭐ-﷿ﹰ-ﻼ！-～\u0300-\u036f\u0653-\u0655"
_ODD = re.compile(f"[{_ODD_CHARS}]+")
_alt = lambda xs: "|".join(re.escape(x) for x in sorted(set(xs), key=lambda x: (-len(x), x)))
_AT = re.compile(r"[ ]*[\[({<][ ]*(?:at|arobase|arrobase|chez|آت|ات)[ ]*[\])}>][ ]*|(?<=\w)[ ]+@[ ]+(?=\w)|(?<=\w)@[ ]+(?=[\w-]+\.\w)|(?<=\w)[ ]+(?:at|arobase)[ ]+(?=[\w-]+(?:[ ]+(?:dot|point)[ ]+[\w-]+)+)", re.I)
_DOT = re.compile(r"[ ]*[\[({<][ ]*(?:dot|point|نقطة)[ ]*[\])}>][ ]*", re.I)
_DOT_WORD = re.compile(r"(?<=@)([\w-]+)((?:[ ]+(?:dot|point)[ ]+[\w-]+)+)", re.I)
_SPELLED = re.compile(rf"(?<!\w)(?:{_alt(DIGIT_WORDS)})(?:[ ,.-]+(?:{_alt(DIGIT_WORDS)})){{5,}}(?!\w)", re.I)
_DIGIT_WORD = re.compile(_alt(DIGIT_WORDS), re.I)
_EMAIL = re.compile(r"(?<![\w.+%-])[A-Za-z0-9][\w.+%-]*@[A-Za-z0-9][\w-]*(?:\.[A-Za-z0-9][\w-]*)+", re.A)
_NUMBER = re.compile(r"(?<![\w.,/-])(?:(?P<cc>\(\s?\+216\s?\)|\+216|00216)[ .-]?)?(?P<n>\d{2}(?:[ .-]?\d{3}[ .-]?\d{3}|(?:[ .-]?\d{2}){3})|\d{4}[ .-]?\d{4})(?!\w|[.,/-]\d)")
_FOREIGN = re.compile(r"(?<![\w.,/-])(?:\(\s?\+\d{1,3}\s?\)|\+\d{1,3}|00\d{2,3})[ .-]?\d{1,4}(?:[ .-]?\d{2,4}){2,4}(?!\w|[.,/-]\d)")
#: National notations that need a cue: a trunk zero, or an area code in brackets.
_TRUNK = re.compile(r"(?<![\w.,/-])(?:0\d(?:[ .-]?\d{2}){4}|0\d{2,4}[ .-]?\d{3}[ .-]?\d{3,4}|\(\d{3}\)[ ]?\d{3}[ .-]\d{4}|\d{3}[ .-]\d{3}[ .-]\d{4})(?!\w|[.,/-]\d)")
_DATE = re.compile(r"(?:19|20)\d\d[-. ](?:0\d|1[0-2])[-. ](?:[0-2]\d|3[01])$|(?:[0-2]\d|3[01])[-. ](?:0\d|1[0-2])[-. ](?:19|20)\d\d$")
#: The rest of a clause; digits stand inside words only.
_NO_NUMBER = r"(?:[^\n\d.!?؟;|]|(?<=[^\W\d_])\d|\d(?=[^\W\d_]))*"
#: Identity numbers; small letters stand before the digits only without a gap, as words do otherwise.
_ID = re.compile(r"(?<![A-Za-z0-9])(?:[A-Z]{1,2}[ -]?\d{5,8}|[a-z]{1,2}\d{5,8}|\d{8}-\d{2}|\d{2}[ .-]\d{3}[ .-]\d{3}|\d{7,12})(?![\w]|[-.]\d)")
#: A cue stands close before a number, or anywhere before it in the same clause, without another number between.
_ID_CUE = re.compile(rf"(?<![^\W\d_])(?:{_alt(ID_CUES)})(?![^\W\d_])(?:[^\n\d]{{0,24}}|{_NO_NUMBER})$", re.I)
_TOWN = rf"(?:{_alt(TOWNS)})(?!\w)"
_POSTAL, _ENDS = r"(?:\d{4,5}[ ]+)", r"(?=[ ]*(?:$|[\n.,،;:!?؟|/<>()\[\]«»\"*_`]))"
#: A town that no table has: capitalised or Arabic words behind a comma or a postal code, and then the end of the clause.
_SOME_TOWN = rf"(?:[,،][ ]+{_POSTAL}?|[ ]{_POSTAL})(?-i:[A-ZÀ-ÖØ-Þ][\w'’-]*(?:[ -](?-i:[A-ZÀ-ÖØ-Þ])[\w'’-]*)*|[ء-ي]+(?:[ ][ء-ي]+)?){_ENDS}"
#: The name of a street: within a clause, and of 300 characters at most, as a text may be one clause of street words.
_STREET_NAME = r"(?:(?!\d{1,3}\b)[^\n,،|/<>.;:!?؟]){1,300}?"
_TO_TOWN = rf"(?:[,،]?[ ]+{_POSTAL}?{_TOWN}|{_SOME_TOWN})"
_INITIALS = "".join(sorted({x[0] for x in STREETS_FIRST}))
_ADDRESS = re.compile(
    rf"(?=[\d{_INITIALS}])(?<![\w-])(?:\d{{1,4}}(?:[ ]?(?:bis|ter|مكرر))?,?[ ]+(?:{_alt(STREETS_FIRST)})[ ]+{_STREET_NAME}{_TO_TOWN}"
    rf"|(?:{_alt(STREETS_FIRST)})[ ]+[^\n,،|/<>.;:!?؟]{{1,300}}?[ ,،]+(?:عدد|رقم|n°|no|num|numéro|3dad|number|3add)[ ]*\d{{1,4}}[ ]*{_TO_TOWN}"
    rf"|\d{{1,4}}[ab]?,?[ ]+(?:[A-Z][\w'’-]*[ ]+)+?(?:{_alt(STREETS_LAST)}){_TO_TOWN})",
    re.I,
)
#: Whole words; a hyphen or an apostrophe stands inside only.
_TOKEN = re.compile(r"[^\W_]+(?:[ً-ْٰ]|['’-]+(?=[^\W_])|[^\W_])*")
_HAS_DIGIT = re.compile(r"\d")
_NOT_PHONE = re.compile(rf"(?:{_alt(OTHER_NUMBER_CUES)})[^\w\n]{{0,4}}(?:(?:n°|no|num|number|numéro|عدد|رقم)[^\w\n]{{0,3}})?$", re.I)
_PHONE = re.compile(rf"(?<![^\W\d_])(?:{_alt(PHONE_CUES)})(?![^\W\d_])(?:[^\d\n]{{0,12}}|{_NO_NUMBER})$", re.I)
_FIELD_START, _FIELD_END = re.compile(r"(?:^|[\n|/\[\]<>:])[ ]*$"), re.compile(r"[ ]*(?:$|[\n|/\[\]<])")
_PARTED = re.compile(r"[ ]+[|/][ ]")


#: What must be there for a disguise in brackets, and the stretches that hold every number; looked for before the dearer patterns.
_BRACKET_AT = re.compile(r"[\[({<][ ]*(?:at|aro|arro|chez|آت|ات)", re.I)
_STRETCH = re.compile(r"[\d.()+-][\d\s.()+-]{3,}\d")
_RUN, _ALPHA = re.compile(r"\w+"), re.compile(r"[^\W\d_]+")
#: Spelled digits in a number that stand between two others.
INNER_DIGITS = 4
#: What a piece of text may hold.
DIGIT, STREET, GIVEN = 1, 2, 4


def _low(text: str) -> str:
    """Lower case in which a letter is what patterns that ignore case take it for."""
    return text.casefold().replace("i̇", "i")


class Looks(dict):
    """What a piece between white space may hold (``DIGIT``, ``STREET``, ``GIVEN``), by its runs of letters and digits and of letters; remembered up to a bound.

    A street word, a spelled digit between two others and the first letters of a name are such a run wherever
    the patterns find one, whatever mark-up stands around; a mark inside a word parts it, here as there.
    """

    def __init__(self, names_: frozenset = frozenset()):
        self.first = first_letters(names_)

    def __missing__(self, piece: str) -> int:
        if len(self) >= 400_000:
            self.clear()
        found = _RUN.findall(piece)
        if not all(map(str.isalpha, found)):
            found += _ALPHA.findall(piece)
        v = self[piece] = sum(bit for bit, known in ((DIGIT, _DIGIT_RUNS), (STREET, _STREET_RUNS), (GIVEN, self.first)) if not known.isdisjoint(found))
        return v

    def of(self, pieces) -> int:
        """All that pieces in lower case may hold."""
        return reduce(or_, map(self.__getitem__, pieces), 0)


@lru_cache(8)
def looks_for(names_: frozenset) -> Looks:
    return Looks(names_)


def first_letters(keys: frozenset) -> frozenset:
    """The first run of letters of every name, which is in the runs of each text with the name."""
    return frozenset(m.group() for k in keys if (m := _ALPHA.search(_low(k))))


_DIGIT_RUNS = frozenset(_RUN.match(_low(x)).group() for x in DIGIT_WORDS)
_STREET_RUNS = frozenset(_RUN.match(_low(x).translate(LOOKALIKE)).group() for x in STREETS_FIRST + STREETS_LAST)


def traced(text: str, looks: Looks | None = None) -> tuple[Traced, int]:
    """The text after all transducers, and what it may hold; without ``looks`` every pattern is tried."""
    t = Traced(text)
    t.characters()
    low = _low(t.text)
    if looks is None or "@" in low or " dot " in low or " point " in low or _BRACKET_AT.search(t.text):
        before = t.text
        t.rewrite(_AT, lambda m: "@")
        if "@" in t.text:
            t.rewrite(_DOT, lambda m: ".")
            t.rewrite(_DOT_WORD, lambda m: m.group(1) + re.sub(r"[ ]+(?:dot|point)[ ]+", ".", m.group(2), flags=re.I))
        low = low if t.text is before else _low(t.text)
    held = DIGIT | STREET | GIVEN if looks is None else looks.of(set(low.split()))
    if held & DIGIT and (looks is None or sum(map(_DIGIT_RUNS.__contains__, _RUN.findall(low))) >= INNER_DIGITS):
        t.rewrite(_SPELLED, lambda m: "".join(DIGIT_WORDS[_low(w)] for w in _DIGIT_WORD.findall(m.group())))
    return t, held


def name_tokens(text: str):
    """Words of letters with their places, each with whether a single space parts it from the one before; a word with a digit is none and parts others."""
    out, before = [], None
    for m in _TOKEN.finditer(text):
        if _HAS_DIGIT.search(m.group()):
            continue
        out.append((m.group().casefold(), m.start(), m.end(), before is not None and text[before : m.start()] == " "))
        before = m.end()
    return out


def _unit_right(toks, i):
    """The word at i, or a particle and the word after it: key, index after it."""
    if toks[i][0] in FAMILY_PARTICLES and i + 1 < len(toks) and toks[i + 1][3]:
        return f"{toks[i][0]} {toks[i + 1][0]}", i + 2
    return toks[i][0], i + 1


def names(text: str, given: frozenset, family: frozenset):
    """Spans of a given and a family name side by side, in either order."""
    toks = name_tokens(text)
    i, n = 0, len(toks)
    while i < n:
        key, j = _unit_right(toks, i)
        if j < n and toks[j][3]:
            if key in given and j == i + 1:
                fam, k = _unit_right(toks, j)
                if fam in family:
                    yield toks[i][1], toks[k - 1][2]
                    i = k
                    continue
            elif key in family and toks[j][0] in given and text[toks[i][1]].isupper() | ("؀" <= text[toks[i][1]]):
                yield toks[i][1], toks[j][2]
                i = j + 1
                continue
        i += 1


class _Taken:
    """Spans that don't overlap, looked up by their starts."""

    def __init__(self, found):
        self.starts, self.spans = [], {}
        for x in found:
            self.add(*x)

    def add(self, a: int, b: int, kind: str) -> None:
        insort(self.starts, a)
        self.spans[a] = (b, kind)

    def free(self, a: int, b: int) -> bool:
        i = bisect_left(self.starts, b)
        return not i or self.spans[self.starts[i - 1]][0] <= a


def detect(text: str | None, given: frozenset = frozenset(), family: frozenset = frozenset(), quick: bool = True):
    """Spans in ``text`` as (start, end, kind), in order and without overlap; none for null and empty texts.

    ``quick`` looks for what must be there before a pattern is tried; without it the spans are the same.
    """
    if not text:
        return []
    t, held = traced(text, looks_for(given) if quick else None)
    s = t.text
    found: list[tuple[int, int, str]] = []
    if "@" in s:
        found += [(m.start(), m.end(), "email") for m in _EMAIL.finditer(s)]
    taken = _Taken(found)
    if held & STREET:
        for m in _ADDRESS.finditer(s):
            if taken.free(*m.span()):
                taken.add(*m.span(), "address")
    # a number lies in one stretch of digits and what parts them; letters may stand before, and two characters behind decide
    stretches = [m.span() for m in _STRETCH.finditer(s)]
    places = [(max(0, a - 3), min(len(s), b + 2)) for a, b in stretches] if quick else [(0, len(s))]

    def numbers(p):
        return (m for a, b in places for m in p.finditer(s, a, b))

    def left(a: int) -> str:
        """What stands before a number: its clause back to the number before it, and 40 characters at least."""
        i = a - 1
        while i >= 0 and s[i] not in "\n.!?؟;|" and not (s[i].isdigit() and not s[i + 1].isalpha() and not (i and s[i - 1].isalpha())):
            i -= 1
        return s[min(max(0, a - 40), i + 1) : a]

    for m in numbers(_ID):
        if taken.free(*m.span()) and _ID_CUE.search(before := left(m.start())) and not _NOT_PHONE.search(before):
            taken.add(*m.span(), "id_number")
    for p, coded in ((_NUMBER, True), (_FOREIGN, True), (_TRUNK, False), (_NUMBER, False)):
        for m in numbers(p):
            a, b = m.span()
            if not taken.free(a, b):
                continue
            code = p is _FOREIGN or (p is _NUMBER and m.group("cc"))
            if coded and not code:
                continue
            if not code:
                before = left(a)
                if _DATE.match(m.group()) or _NOT_PHONE.search(before):
                    continue
                field = _FIELD_START.search(before) and _FIELD_END.match(s, b) or _PARTED.match(s, b)
                grouped = p is _NUMBER and any(c in m.group() for c in " .-")
                if not (_PHONE.search(before) or field or grouped):
                    continue
            taken.add(a, b, "phone")
    if given and family and held & GIVEN:
        for a, b in names(s, given, family):
            if taken.free(a, b):
                taken.add(a, b, "name")
    return [(*t.span(a, taken.spans[a][0]), taken.spans[a][1]) for a in taken.starts]


def placeholders(text: str, spans) -> str:
    """The text with ``[KIND]`` in the place of every span."""
    out, at = [], 0
    for a, b, k in spans:
        if a >= at:
            out += [text[at:a], f"[{k.upper()}]"]
            at = b
    return "".join([*out, text[at:]])


def _chunks(text: str) -> list[str]:
    """Pieces between white space and mark-up: the uses of words that stand alone, those in addresses of mail apart."""
    return text.replace(">", "> ").replace("<", " <").casefold().split()


def _fold(name: str) -> str:
    return unicodedata.normalize("NFC", name).casefold()


def keys_of(text: str) -> set[str]:
    """Every key under which a name in the text may stand in a lexicon: its words, and a particle with the word behind it."""
    toks = name_tokens(text)
    return {x[0] for x in toks} | {f"{a[0]} {b[0]}" for a, b in zip(toks, toks[1:]) if b[3] and a[0] in FAMILY_PARTICLES}


def with_lexicons(docs: DataFrame, text_col: str, lexicons: list[DataFrame]):
    """The documents and how to get the lexicons (one column ``word``, distinct) of a batch's rows: (table, function of batch and row).

    Lexicons of up to ``MAX_NAMES`` names in all are broadcast. Beyond, the keys of each text meet the lexicons in a join,
    and each document carries those names that stand in it; equal texts are looked up once.
    """
    many = range(len(lexicons))
    every = lexicons[0].select("word", F.lit(0).alias("n"))
    for n, x in enumerate(lexicons[1:], 1):
        every = every.unionByName(x.select("word", F.lit(n).alias("n")))
    rows = every.limit(MAX_NAMES + 1).collect()
    if len(rows) <= MAX_NAMES:
        shared = docs.sparkSession.sparkContext.broadcast(tuple(frozenset(r["word"] for r in rows if r["n"] == n) for n in many))
        return docs, lambda batch: repeat(shared.value)

    def run(batches):
        import pyarrow as pa

        for b in batches:
            at, words_ = [], []
            for i, text in enumerate(b.column(2).to_pylist()):
                t = Traced(text)
                t.characters()
                k = keys_of(t.text)
                at += [i] * len(k)
                words_ += k
            yield pa.RecordBatch.from_arrays([*(b.column(c).take(pa.array(at, pa.int32())) for c in (0, 1)), pa.array(words_, pa.string())], names=["h1", "h2", "word"])

    hashed = docs.withColumns({"h1": F.xxhash64(text_col), "h2": F.xxhash64(F.lit("text"), text_col)})
    texts = hashed.where(F.coalesce(F.col(text_col), F.lit("")) != "").groupBy("h1", "h2").agg(F.first(text_col).alias("t"))
    held = texts.select("h1", "h2", "t").mapInArrow(run, "h1 long, h2 long, word string").join(every, "word")
    mine = held.groupBy("h1", "h2").agg(*[F.collect_set(F.when(F.col("n") == n, F.col("word"))).alias(f"__w{n}") for n in many])
    joined = lookup_join(hashed, cut(mine), ["h1", "h2"], "left", salt_by=docs.columns[0]).select(*docs.columns, *[f"__w{n}" for n in many])
    return joined, lambda batch: zip(*([frozenset(x or ()) for x in batch.column(batch.schema.get_field_index(f"__w{n}")).to_pylist()] for n in many))


def beside(docs: DataFrame, seeds: DataFrame, forward: bool, count_words: bool, text_col: str = "text") -> DataFrame:
    """word, seed, uses, beside over all documents: uses of words (with ``count_words`` of all that stand alone), uses beside a seed (both without seed), and those with a seed on the given side.

    A family name with a particle is one word, counted here as it stands beside a seed only.
    """
    docs, lexicon_of = with_lexicons(docs.select(text_col), text_col, [seeds])

    def run(batches):
        from collections import Counter

        import pyarrow as pa

        uses, near, with_seed = Counter(), Counter(), Counter()

        def flush():
            rows = [(w, None, uses[w], near[w]) for w in uses.keys() | near.keys()] + [(w, x, 0, n) for (w, x), n in with_seed.items()]
            for c in (uses, near, with_seed):
                c.clear()
            cols = list(zip(*rows)) if rows else [[], [], [], []]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.string(), pa.int64(), pa.int64()))], names=["word", "seed", "uses", "beside"])

        known = looks = None
        for b in batches:
            for text, (names_,) in zip(b.column(0).to_pylist(), lexicon_of(b)):
                if names_ is not known:
                    known, looks = names_, Looks(frozenset(y for x in names_ for y in (x.split()[0], x.split()[-1])))
                pieces = _chunks(text)
                if count_words:
                    uses.update(pieces)
                t = Traced(text)
                t.characters()
                if not looks.of(pieces if t.text is text else set(_low(t.text).split())) & GIVEN:
                    continue
                toks = name_tokens(t.text)
                i = 0
                while i < len(toks):
                    key, j = _unit_right(toks, i)
                    if key in names_:
                        if j < len(toks) and toks[j][3]:
                            after, k = _unit_right(toks, j)
                            near[after] += 1
                            if forward:
                                with_seed[after, key] += 1
                            if k > j + 1:
                                uses[after] += 1
                        if i and toks[i][3]:
                            p = i - 1
                            before = toks[p][0]
                            if p and toks[p][3] and toks[p - 1][0] in FAMILY_PARTICLES:
                                before = f"{toks[p - 1][0]} {before}"
                                uses[before] += 1
                            near[before] += 1
                            if not forward:
                                with_seed[before, key] += 1
                    i = j
            if len(uses) + len(with_seed) > 400_000:
                yield flush()
        yield flush()

    some = docs.where(F.coalesce(F.col(text_col), F.lit("")) != "")
    pairs = some.mapInArrow(run, "word string, seed string, uses long, beside long")
    return cut(pairs.groupBy("word", "seed").agg(F.sum("uses").alias("uses"), F.sum("beside").alias("beside")))


def learned(pairs: DataFrame, uses: DataFrame) -> DataFrame:
    """word: those with ``NAME_PARTNERS`` seeds and ``NAME_SHARE`` of their uses (also those in the table ``uses``) beside one."""
    per = pairs.groupBy("word").agg(F.count("seed").alias("partners"), F.sum(F.when(F.col("seed").isNull(), F.col("uses"))).alias("own"), F.sum(F.when(F.col("seed").isNull(), F.col("beside"))).alias("beside"))
    some = per.where(F.col("partners") >= NAME_PARTNERS).join(uses, "word", "left")
    return some.where(F.col("beside") >= F.lit(NAME_SHARE) * (F.coalesce("own", F.lit(0)) + F.coalesce("uses", F.lit(0)))).select("word")


def lexicon(docs: DataFrame, given_names: DataFrame, text_col: str = "text") -> list[DataFrame]:
    """Given and family names (word): families stand behind listed given names, further given names before families.

    The uses of all words are counted in the first look at the documents; the second counts only what stands beside a family.
    """

    def run(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([_fold(x) for x in b.column(0).to_pylist()], pa.string())], names=["word"])

    listed = cut(given_names.where("name is not null and name <> ''").select("name").mapInArrow(run, "word string").distinct())
    if listed.isEmpty():
        return [listed, listed]
    first = beside(docs, listed, True, True, text_col)
    uses = first.where("seed is null").select("word", "uses")
    family = cut(learned(first, uses.limit(0)).join(listed, "word", "left_anti"))
    if family.isEmpty():
        return [listed, family]
    further = learned(beside(docs, family, False, False, text_col), uses.where(~F.col("word").contains(" ")))
    return [listed.unionByName(further.join(family, "word", "left_anti")).distinct(), family]


def find_pii(docs: DataFrame, given_names: DataFrame, id_col: str = "doc_id", text_col: str = "text", redact: bool = False) -> DataFrame:
    """One row for each find (``id_col``, kind, found), or with ``redact`` one for each document (``id_col``, redacted).

    Null and empty texts have no finds and are redacted to themselves; texts of any length are read
    whole; repeated rows and finds come out as often as they stand; other columns are left out.
    """
    docs = spread(docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")))
    docs, lexicons_of = with_lexicons(docs, "__text", lexicon(docs, given_names, "__text"))
    kind = dict(docs.dtypes)["__id"]

    def run(batches):
        import pyarrow as pa

        for b in batches:
            at, kinds, texts = [], [], []
            for i, (text, (g, f)) in enumerate(zip(b.column(1).to_pylist(), lexicons_of(b))):
                spans = detect(text, g, f)
                if redact:
                    texts.append(placeholders(text, spans) if text else text)
                for s, e, k in spans:
                    at.append(i)
                    kinds.append(k)
                    if not redact:
                        texts.append(text[s:e])
            if redact:
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=[id_col, "redacted"])
            else:
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int32())), pa.array(kinds, pa.string()), pa.array(texts, pa.string())], names=[id_col, "kind", "found"])

    return docs.mapInArrow(run, f"`{id_col}` {kind}, " + ("redacted string" if redact else "kind string, found string"))
