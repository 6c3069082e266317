"""Byte-level BPE on a contiguous rank array, and encoders that remember what they have seen.

The merge loop keeps, for one word, the part boundaries and the rank of every adjacent pair in
two flat lists; it scans for the smallest rank, deletes the boundary between the two parts and
refreshes the ranks of the two neighbours. Words beyond ``SHORT_WORD`` bytes take the same merges
from a heap, as the scan is quadratic.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import os
import re
from functools import lru_cache
from itertools import chain

import regex

TOKENIZERS = "/opt/tokenizers"
#: Fixed value: the published split pattern of the rank files.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SHORT_WORD = 96
#: Entries kept by one worker; at the bound the memory is emptied, results stay the same.
MEMORY = 400_000
_NONE = 1 << 60


def load_ranks(name: str, folder: str = TOKENIZERS) -> dict[bytes, int]:
    with open(os.path.join(folder, name), "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def file_hash(name: str, folder: str = TOKENIZERS) -> str:
    """Names a tokenizer by its content: file and split pattern."""
    with open(os.path.join(folder, name), "rb") as f:
        return hashlib.sha256(f.read() + SPLIT.encode()).hexdigest()[:16]


def _merge_short(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    n = len(word)
    bounds = list(range(n + 1))
    get = ranks.get
    adjacent = [get(word[i : i + 2], _NONE) for i in range(n - 1)]
    while adjacent:
        low = min(adjacent)
        if low == _NONE:
            break
        i = adjacent.index(low)
        del bounds[i + 1]
        del adjacent[i]
        if i < len(adjacent):
            adjacent[i] = get(word[bounds[i] : bounds[i + 2]], _NONE)
        if i:
            adjacent[i - 1] = get(word[bounds[i - 1] : bounds[i + 1]], _NONE)
    return [ranks[word[a:b]] for a, b in zip(bounds, bounds[1:])]


def _merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    n = len(word)
    end, prev = list(range(1, n + 1)), list(range(-1, n - 1))
    alive = bytearray(b"\1" * n)
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not alive[i] or end[i] >= n or end[end[i]] != stop:
            continue
        j = end[i]
        alive[j] = 0
        end[i] = stop
        if stop < n:
            prev[stop] = i
            if (r := ranks.get(word[i : end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        p = prev[i]
        if p >= 0 and (r := ranks.get(word[p:stop])) is not None:
            heapq.heappush(heap, (r, p, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : end[i]]])
        i = end[i]
    return out


def encode_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one word of the split pattern."""
    if (whole := ranks.get(word)) is not None:
        return [whole]
    return _merge_short(word, ranks) if len(word) <= SHORT_WORD else _merge_long(word, ranks)


class _Words(dict):
    def __init__(self, ranks):
        self.ranks = ranks

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= MEMORY:
            self.clear()
        ids = self[word] = tuple(encode_word(word.encode("utf-8", "surrogatepass"), self.ranks))
        return ids


class _Spaced(dict):
    """Ids of a space followed by what stands before the next space."""

    def __init__(self, encoder):
        self.encoder = encoder

    def __missing__(self, piece: str) -> tuple[int, ...]:
        if len(self) >= MEMORY:
            self.clear()
        ids = self[piece] = tuple(self.encoder.by_pattern(" " + piece))
        return ids


class Encoder:
    """Encodes texts without special tokens; strings that look like them are ordinary text.

    A single space between anything and a non-space always opens a new word of the split pattern,
    so a text may be cut there and each piece looked up. Where a space stands inside or at the end
    of a run of white space that doesn't hold, and the pattern is applied to the whole text.
    """

    _hard = re.compile(r"\s (?!\S)")

    def __init__(self, name: str, folder: str = TOKENIZERS):
        self.ranks = load_ranks(name, folder)
        self.words = _Words(self.ranks)
        self.spaced = _Spaced(self)
        self.split = regex.compile(SPLIT).findall

    def by_pattern(self, text: str):
        return chain.from_iterable(map(self.words.__getitem__, self.split(text)))

    def parts(self, text: str):
        """Tuples of ids whose concatenation is the encoding."""
        if self._hard.search(text):
            return map(self.words.__getitem__, self.split(text))
        first, *rest = text.split(" ")
        head = (tuple(self.by_pattern(first)),) if first else ()
        return chain(head, map(self.spaced.__getitem__, rest))

    def encode(self, text: str | None) -> list[int]:
        return list(chain.from_iterable(self.parts(text))) if text else []

    def count(self, text: str | None) -> int:
        return sum(map(len, self.parts(text))) if text else 0


@lru_cache(maxsize=4)
def encoder(name: str, folder: str = TOKENIZERS) -> Encoder:
    """One encoder a worker process."""
    return Encoder(name, folder)
