"""Language dictionaries: words and the languages they are used in."""

from __future__ import annotations

import re
from collections import Counter

from tamis.llm.langid import main_script, sentences

ARABIC = re.compile("[ء-يٱ-ۓ]")
_WORD = re.compile(r"[^\W_]+(?:['’-][^\W_]+)*")


class Dictionaries:
    """For each word of a sample of texts, the share of each language in its uses; every word in Arabic script is Arabic.

    Fitted like the profiles: on labelled sentences, and again on what the first fit assigns.
    """

    def __init__(self, labelled: list[tuple[str, str]]):
        flat = [(k, s) for k, text in labelled for s in sentences(text)]
        self.shares: dict[str, dict[str, float]] = {}
        self._fit([(k, s) for k, s in flat if k != "ar"])
        for _ in range(2):
            told = [(*self.classify(s), s) for _, s in flat]
            self._fit([(lang, s) for lang, sure, s in told if lang and lang != "ar" and sure > 0.1])

    def _fit(self, assigned: list[tuple[str, str]]) -> None:
        uses: dict[str, Counter] = {}
        for k, s in assigned:
            uses.setdefault(k, Counter()).update(_WORD.findall(s))
        total = {k: sum(c.values()) for k, c in uses.items()}
        self.shares = {}
        for w in set().union(*uses.values()):
            rate = {k: c[w] / total[k] for k, c in uses.items() if c[w]}
            self.shares[w] = {k: r / sum(rate.values()) for k, r in rate.items()}

    def classify(self, sentence: str) -> tuple[str | None, float]:
        """Language of one sentence (in lower case) and its confidence, the lead in shares a known word; none without a known word."""
        ws = _WORD.findall(main_script(sentence))
        if ws and ARABIC.search(ws[0] if len(ws) == 1 else " ".join(ws)):
            return "ar", 1.0
        votes: dict[str, float] = {}
        known = 0
        for w in ws:
            if shares := self.shares.get(w):
                known += 1
                for k, x in shares.items():
                    votes[k] = votes.get(k, 0.0) + x
        if not known:
            return None, 0.0
        (best, x), *rest = sorted(votes.items(), key=lambda v: (-v[1], v[0]))
        return best, (x - (rest[0][1] if rest else 0.0)) / known
