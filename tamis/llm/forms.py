"""One consistent form of text that looks the same, and words freed of everything but letters and digits.

Only unstable segments are touched: characters whose look-alike, presentation form or kind of space
has another standard character, invisible characters, and combining marks that the normalization
quick check can't vouch for. A segment takes along the character before it and the marks around it,
as composition depends on them; its canonical form is spliced into the unchanged rest.
"""

from __future__ import annotations

import re
import unicodedata
from itertools import chain

# Look-alike letters and the letters they stand for, in pairs.
CYRILLIC_GREEK = "аa еe оo рp сc уy хx ѕs іi јj һh ԁd ԛq ԝw ҽe АA ВB ЕE ЗЗ КK МM НH ОO РP СC ТT УY ХX ЅS ІI ЈJ ԌG ԚQ ԜW οo ϲc ϳj ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX"
OTHER_LETTERS = "ıi ɡg ɑa ℓl ꜱs"
ARABIC = "کك ڪك ەه ہه"
FARSI_YEH = "ی"
# Characters without a shape of their own (zero-width joiner apart), and kinds of one space.
INVISIBLE = "­͏؜ᅟᅠ឴឵᠋᠌᠍᠎​‌‎‏‪‫‬‭‮⁠⁡⁢⁣⁤⁦⁧⁨⁩⁪⁫⁬⁭⁮⁯︀︁︂︃︄︅︆︇︈︉︊︋︌︍︎️﻿ﾠ￹￺￻ㅤ"
JOINER = "‍"
SPACES = "               　"

LOOKALIKE = {ord(p[0]): p[1] for p in (CYRILLIC_GREEK + " " + OTHER_LETTERS + " " + ARABIC).split() if p[0] != p[1]}
LOOKALIKE |= {ord(z) + i: str(i) for z in "٠۰" for i in range(10)}
LOOKALIKE |= dict.fromkeys(map(ord, SPACES), " ") | dict.fromkeys(map(ord, INVISIBLE))

_PRESENTATION = "ﬀ-ﬆﭐ-﷿ﹰ-ﻼ！-￯"
#: Planes with characters that decompose or combine; what lies beyond has neither.
_ASSIGNED = (range(0x2FA20), range(0xE0000, 0xE01F0))


def _ranges(points) -> str:
    """Code points as the inside of a character class."""
    out: list[list[int]] = []
    for c in sorted(points):
        if out and out[-1][1] == c - 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "".join(re.escape(chr(a)) if a == b else f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in out)


def _quick_check() -> tuple[set[int], set[int], set[int]]:
    """The properties of all code points: combining (a class above 0), quick-check value Maybe (composes with what stands before it), and No (or made of a look-alike)."""
    combining, maybe, no = set(), set(range(0x1161, 0x1176)) | set(range(0x11A8, 0x11C3)), set()
    for c in chain(*_ASSIGNED):
        if 0xAC00 <= c < 0xD7A4 or 0xD800 <= c < 0xE000:  # syllables are composed by rule and stable; surrogates are nothing
            continue
        x = chr(c)
        if unicodedata.combining(x):
            combining.add(c)
        if (d := unicodedata.decomposition(x)) and d[0] != "<":
            if not unicodedata.is_normalized("NFC", x):
                no.add(c)
            else:
                maybe.add(int(d.split()[-1], 16))
            if any(ord(y) in LOOKALIKE for y in unicodedata.normalize("NFD", x)):
                no.add(c)
    return combining, maybe, no


_COMBINING, _MAYBE, _NO = _quick_check()
_ODD = _MAYBE | _NO | set(LOOKALIKE) | {ord(FARSI_YEH), ord(JOINER)}


class _Patterns:
    """Segments and the quick check over code points below ``end``: classes that reach beyond the first plane are slow."""

    def __init__(self, end: int):
        marks, odd = (_ranges(c for c in x if c < end) for x in (_COMBINING, _ODD))
        odd += _PRESENTATION
        self.segment = re.compile(f"[^{marks}{odd}]?[{marks}{odd}]*[{odd}][{marks}{odd}]*|[{marks}]{{2,}}")
        self.odd, self.marks = re.compile(f"[{odd}]"), re.compile(f"[{marks}][{marks}]")


_PLANE, _ALL = _Patterns(0x10000), _Patterns(0x110000)
_MARKS = _ranges(_COMBINING)
#: What a text must have to be anything but canonical; most have nothing of it.
_QUICK = re.compile(f"[{_ranges(c for c in _ODD | _COMBINING if c < 0x10000)}{_PRESENTATION}\U00010000-\U0010ffff]")
_BEYOND = re.compile("[\U00010000-\U0010ffff]")
_FORMS = re.compile(f"[{_PRESENTATION}]")
_YEH = re.compile(f"{FARSI_YEH}(?=[{_MARKS}]*[\\u0620-\\u064a\\u066e-\\u06d3])")


def _pictograph(c: str) -> bool:
    return unicodedata.category(c) in ("So", "Sk") or c in "︎️"


def _segment(m: re.Match) -> str:
    s, after = m.group(), m.string[m.end() : m.end() + 1]
    if JOINER in s:
        t = s + after
        s = "".join(c for i, c in enumerate(s) if c != JOINER or (i and _pictograph(s[i - 1]) and i + 1 < len(t) and _pictograph(t[i + 1])))
    keep = any(_pictograph(c) and c not in "︎️" for c in s)  # a style mark after a pictograph is visible
    s = unicodedata.normalize("NFD", _FORMS.sub(lambda f: unicodedata.normalize("NFKC", f.group()), s))
    s = "".join(c if keep and c in "︎️" and i and _pictograph(s[i - 1]) else LOOKALIKE.get(ord(c), c) or "" for i, c in enumerate(s))
    if FARSI_YEH in s:  # joined to a following letter it has the two dots of yeh, else none; marks and odd letters behind it are in the segment
        s = _YEH.sub("ي", s + after)[: len(s)].replace(FARSI_YEH, "ى")
    return unicodedata.normalize("NFC", s)


def canonical(text: str | None) -> str | None:
    """The form under which texts that look the same are equal and others are not; null stays null.

    Accents, hamza, case, punctuation, the number of spaces and line breaks are visible and stay.
    """
    if not text or not _QUICK.search(text):
        return text
    p = _ALL if _BEYOND.search(text) else _PLANE
    return p.segment.sub(_segment, text) if p.odd.search(text) or p.marks.search(text) else text


_WORD = re.compile(r"[^\W_]+")
_DROP = {ord("ـ"): None} | LOOKALIKE | {ord(FARSI_YEH): "ي", ord("ى"): "ي", ord(JOINER): None}


def fold(text: str) -> str:
    """Without case, accents and other marks, tatweel, invisible and look-alike characters."""
    s = unicodedata.normalize("NFKD", text.translate(_DROP))
    s = "".join(c for c in s if not unicodedata.combining(c)).casefold()
    return s.translate(_DROP)


class _Pieces(dict):
    """Folded words of a piece of text between white space, remembered up to a bound."""

    def __missing__(self, piece: str) -> tuple[str, ...]:
        if len(self) >= 400_000:
            self.clear()
        w = self[piece] = tuple(_WORD.findall(fold(piece)))
        return w


_pieces = _Pieces()


def words(text: str | None) -> list[str]:
    """Folded words: longest runs of letters and digits."""
    if not text:
        return []
    return [w for p in map(_pieces.__getitem__, text.split()) for w in p]


def word_set(texts) -> set[str]:
    """Distinct folded words of several texts."""
    out: set[str] = set()
    for t in texts:
        if t:
            out.update(*map(_pieces.__getitem__, t.split()))
    return out
