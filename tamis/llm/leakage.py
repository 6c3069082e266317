"""Problem 9: passages of evaluation items inside documents, by pigeonhole edit matching.

Every window of ``PASSAGE`` words of an item is to be found with at most ``ERRORS`` word edits. The
item is cut into pieces short enough that each window holds ``ERRORS`` + 1 whole ones; an occurrence
with that many edits leaves one of them untouched. Documents are searched for exact pieces, and around
each hit Myers' bit-parallel distance decides, a word being a symbol.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamis.session import cut, spread

PASSAGE, ERRORS = 15, 1
#: Item texts that are broadcast at once (words in all); a larger set is searched in blocks.
BLOCK_WORDS = 2_000_000


def piece_length(passage: int, errors: int) -> int:
    """Longest p such that any window of ``passage`` words holds ``errors`` + 1 whole pieces of p words."""
    return max(1, (passage + 1) // (errors + 2))


def myers_ends(pattern: list[int], text: list[int], budget: int) -> list[int]:
    """Smallest distance of the pattern to a stretch of the text that ends at each place, by bit vectors.

    One number for each symbol of ``text``; numbers above ``budget`` say only that it is exceeded.
    """
    m = len(pattern)
    full, top = (1 << m) - 1, 1 << (m - 1)
    peq: dict[int, int] = {}
    for i, c in enumerate(pattern):
        peq[c] = peq.get(c, 0) | 1 << i
    pv, mv, score, out = full, 0, m, []
    for c in text:
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (~(xh | pv) & full)
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph, mh = (ph << 1) & full, (mh << 1) & full
        pv = mh | (~(xv | ph) & full)
        mv = ph & xv
        out.append(min(score, budget + 1))
    return out


#: Rows of a block that are matched at once, and the longest pattern of one machine word.
ROWS, WORD_BITS = 20_000, 63


def myers_least(patterns, texts, budget: int):
    """Least distance of each pattern (a row of symbols) to any stretch of its text, by bit vectors: all rows step together.

    Rows of both arrays have one length each; a symbol below 0 fills a text up and matches nothing, so it never lowers
    a distance. Patterns beyond a machine word go through ``myers_ends``. Numbers above ``budget`` say only that it is exceeded.
    """
    import numpy as np

    n, m = patterns.shape
    if m > WORD_BITS:
        return np.array([min(myers_ends(p, [c for c in t if c >= 0], budget), default=budget + 1) for p, t in zip(patterns.tolist(), texts.tolist())], np.int64)
    least = np.full(n, budget + 1, np.int64)
    one, top, full = np.uint64(1), np.uint64(m - 1), np.uint64((1 << m) - 1)
    bits = one << np.arange(m, dtype=np.uint64)
    for a in range(0, n, ROWS):
        p, t = patterns[a : a + ROWS], texts[a : a + ROWS]
        pv, mv, score = np.full(len(p), full), np.zeros(len(p), np.uint64), np.full(len(p), m, np.int64)
        best = least[a : a + ROWS]
        for c in t.T:
            eq = (p == c[:, None]) @ bits
            xv = eq | mv
            xh = (((eq & pv) + pv) ^ pv) | eq
            ph, mh = mv | (~(xh | pv) & full), pv & xh
            score += ((ph >> top) & one).astype(np.int64) - ((mh >> top) & one).astype(np.int64)
            ph, mh = (ph << one) & full, (mh << one) & full
            pv, mv = mh | (~(xv | ph) & full), ph & xv
            np.minimum(best, score, out=best)
    return least


class _Symbols(dict):
    """Symbols of a piece of text between white space, remembered up to a bound."""

    def __init__(self, symbol: dict[str, int]):
        self.symbol = symbol

    def __missing__(self, piece: str) -> tuple[int, ...]:
        from tamis.llm.forms import words

        if len(self) >= 400_000:
            self.clear()
        w = self[piece] = tuple(self.symbol.get(x, 0) for x in words(piece))
        return w


class Index:
    """Pieces of item texts: (item, text as words) each; words outside of it have the symbol 0."""

    def __init__(self, texts: list[tuple[object, list[str]]], passage: int = PASSAGE, errors: int = ERRORS):
        import numpy as np

        self.passage, self.errors, self.piece = passage, errors, piece_length(passage, errors)
        self.symbol: dict[str, int] = {}
        self.items, self.texts = [], []
        at: dict[int, list[tuple[int, int]]] = {}
        rng = np.random.default_rng(7)
        self.mul = rng.integers(1, 1 << 62, self.piece, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        for item, ws in texts:
            if len(ws) < passage:
                continue
            ids = np.array([self.symbol.setdefault(w, len(self.symbol) + 1) for w in ws], np.uint64)
            n = len(self.texts)
            self.items.append(item)
            self.texts.append(ids.astype(np.int64).tolist())
            for o in range(0, len(ws) - self.piece + 1, self.piece):
                at.setdefault(int(self.hashes(ids[o : o + self.piece])[0]), []).append((n, o))
        self.at = at
        self.keys = np.array(sorted(at), np.uint64)
        self.filter = np.zeros(1 << max(16, (8 * len(at)).bit_length()), bool)
        self.filter[(self.keys & np.uint64(len(self.filter) - 1)).astype(np.int64)] = True
        self._pieces = None

    def hashes(self, ids):
        """Hash of every stretch of a piece's length."""
        import numpy as np

        n = len(ids) - self.piece + 1
        out = np.zeros(max(n, 0), np.uint64)
        with np.errstate(over="ignore"):
            for k in range(self.piece):
                out[:] += (ids[k : k + n] + np.uint64(0x9E3779B9)) * self.mul[k]
                out ^= out >> np.uint64(32)
        return out

    def symbols(self, text: str | None) -> list[int]:
        """Symbols of the folded words of a text; pieces between white space are remembered."""
        return list(chain.from_iterable(map(self.pieces().__getitem__, text.split()))) if text else []

    def pieces(self):
        if self._pieces is None:
            self._pieces = _Symbols(self.symbol)
        return self._pieces

    def search(self, docs: list[list[int]]) -> list[tuple[int, object, int]]:
        """(document, item, least edits) for documents given as symbols; a batch is hashed as one array."""
        import numpy as np

        if not len(self.keys) or not docs:
            return []
        gap = [0] * self.piece
        size = np.fromiter((len(d) + self.piece for d in docs), np.int64, len(docs))
        starts = np.cumsum(size) - size
        ids = np.fromiter(chain.from_iterable(x for d in docs for x in (d, gap)), np.uint64, int(size.sum()))
        h = self.hashes(ids)
        low = np.uint64(len(self.filter) - 1)
        maybe = np.flatnonzero(self.filter[(h & low).astype(np.int64)])
        owner = np.searchsorted(starts, maybe, "right") - 1
        stretches: set[tuple[int, int, int, int, int]] = set()
        for p, key, d in zip((maybe - starts[owner]).tolist(), h[maybe].tolist(), owner.tolist()):
            for n, o in self.at.get(key, ()):
                if docs[d][p : p + self.piece] == self.texts[n][o : o + self.piece]:
                    stretches.add((d, n, p - o, *self.stretch(docs[d], self.texts[n], p - o, o)))
        found: dict[tuple[int, object], int] = {}
        w = self.passage
        whole = [(d, n, shift, a) for d, n, shift, a, b in stretches if b - a >= w]
        self.match(docs, whole, found)
        if self.errors:
            # the hit may lie in the shorter of the untouched stretches, so its length rules nothing out
            near = [(d, n, shift, start) for d, n, shift, a, b in stretches if b - a < w and found.get((d, self.items[n])) != 0 for start in range(max(0, b - w), min(a, len(self.texts[n]) - w) + 1)]
            self.match(docs, near, found)
        return [(d, i, e) for (d, i), e in sorted(found.items(), key=lambda x: x[0][0])]

    def stretch(self, doc: list[int], text: list[int], shift: int, o: int) -> tuple[int, int]:
        """The exact stretch of the text through the piece at ``o``. Windows that hold only a part of it are no nearer than one that holds all, or is in it."""
        a, b = o, o + self.piece
        while a and a + shift > 0 and doc[a + shift - 1] == text[a - 1]:
            a -= 1
        while b < len(text) and b + shift < len(doc) and doc[b + shift] == text[b]:
            b += 1
        return a, b

    def match(self, docs: list[list[int]], windows: list[tuple[int, int, int, int]], found: dict) -> None:
        """Least edits of windows (document, text, shift, start) by Myers' distance, into ``found`` by document and item."""
        import numpy as np

        w, k = self.passage, self.errors
        for at in range(0, len(windows), ROWS):
            part = windows[at : at + ROWS]
            patterns = np.array([self.texts[n][start : start + w] for _, n, _, start in part], np.int64)
            texts = np.full((len(part), w + 2 * k), -1, np.int64)
            for row, (d, _, shift, start) in zip(texts, part):
                piece = docs[d][max(0, start + shift - k) : start + shift + w + k]
                row[: len(piece)] = piece
            for (d, n, _, _), e in zip(part, myers_least(patterns, texts, k).tolist()):
                if e <= k:
                    x = d, self.items[n]
                    found[x] = min(e, found.get(x, e))


def item_texts(items: DataFrame, item_col: str = "item_id", text_cols: tuple[str, ...] = ("prompt", "expected_behavior")) -> DataFrame:
    """One row for each item and text: (item, text); null and blank texts are left out."""
    parts = [items.select(F.col(item_col).alias("item"), F.col(c).alias("text")) for c in text_cols]
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    return both.where("item is not null and text is not null and trim(text) <> ''").distinct()


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", passage: int = PASSAGE, errors: int = ERRORS, block_words: int = BLOCK_WORDS, **how) -> DataFrame:
    """``id_col``, item and edits of each document and item of which it holds a passage.

    Both sides are compared as folded words, without case, punctuation, spacing, marks, tatweel and
    invisible characters. Items with less than ``passage`` words cannot leak; items that share a text
    are all reported; null, empty and short documents have no row; a repeated document has its rows as
    often as it stands. The items are numbered and go through in blocks of ``block_words`` words, so a
    broadcast has a bound whatever their number.
    """
    from tamis.llm.forms import words

    kind, item_kind = dict(docs.dtypes)[id_col], None
    texts = item_texts(items, **how)
    item_kind = dict(texts.dtypes)["item"]
    sized = cut(texts.withColumn("n", F.size(F.split(F.trim("text"), r"\s+")) + 1))
    total = sized.agg(F.sum("n")).first()[0] or 0
    blocks = max(1, -(-total // block_words))
    out = None
    docs = spread(docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).where(f"length(`{text_col}`) >= {2 * (passage - errors) - 1}"))
    for b in range(blocks):
        mine = sized if blocks == 1 else sized.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b)
        index = Index([(r["item"], words(r["text"])) for r in mine.select("item", "text").toLocalIterator()], passage, errors)
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches, shared=shared):
            import pyarrow as pa

            ix = shared.value
            for batch in batches:
                hits = ix.search(list(map(ix.symbols, batch.column(1).to_pylist())))
                at, item, edits = map(list, zip(*hits)) if hits else ([], [], [])
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int32())), pa.array(item), pa.array(edits, pa.int32())] if at else [batch.column(0).slice(0, 0), pa.array([], _arrow(item_kind)), pa.array([], pa.int32())], names=[id_col, "item", "edits"])

        part = docs.mapInArrow(run, f"`{id_col}` {kind}, item {item_kind}, edits int")
        out = part if out is None else out.unionByName(part)
    return out


def _arrow(kind: str):
    import pyarrow as pa

    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]
