"""Problem 6: languages of documents and of their sentences by rank-order profiles.

A profile ranks the most frequent n-grams of a language. A sentence's own ranking is compared with
each profile by the out-of-place distance: the sum, over its n-grams, of how far their ranks lie
apart, and a fixed penalty for those the profile lacks. Profiles are fitted on a bounded sample of
labelled records and refitted once on the sentences that the first fit assigns, as labels are wrong here
and there. Single words in the other script are left out of a sentence; the rest is held against all profiles.
"""

from __future__ import annotations

import re
import zlib
from itertools import chain

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamis.llm.arrow import turns
from tamis.llm.forms import canonical
from tamis.llm.labels import language_label
from tamis.session import spread

LANGUAGES = ("ar", "arabizi", "fr", "en")
#: Labelled records for each language in the sample that profiles are fitted on, each read whole.
SAMPLE = 400
#: Share of rows that a language needs for a full sample.
LEAST_SHARE = 0.02
#: N-gram lengths, ranks of a profile, and ranks of a sentence.
GRAMS, TOP, TOP_SENTENCE = (1, 2, 3), 400, 200
#: Words that a stretch in another language or script needs to be a sentence of its own.
LEAST_WORDS = 4
#: Confidence that a further language of a text must reach in one sentence at least.
LEAST_SURE = 0.05
#: Confidence of a sentence of two words beside longer ones.
CLEAR = 0.2

_STOP = re.compile(r"[.!?؟\n\r…؛;]+|(?<=\w)[:](?=\s)|```.*?(?:```|$)", re.S)
_ARABIC, _LATIN = re.compile("[ء-يٱ-ۓ]"), re.compile("[a-zà-öø-ÿœ]")
_CLEAN = re.compile(r"[^a-zà-öø-ÿœء-يٱ-ۓ0-9'’]+")


#: N-grams are named by so many bits of a hash, which also breaks ties of frequency.
BITS = 20


class _Grams(dict):
    """N-grams of a word padded by one space, as hashes; remembered up to a bound."""

    def __missing__(self, word: str):
        import numpy as np

        if len(self) >= 200_000:
            self.clear()
        t = f" {word} "
        names = [t[i : i + n] for n in GRAMS for i in range(len(t) - n + 1) if t[i : i + n] != " "]
        ids = self[word] = np.array([zlib.crc32(g.encode()) & ((1 << BITS) - 1) for g in names], np.int32)
        return ids


_grams = _Grams()


def gram_ids(text: str):
    """All n-grams of a text, repeated as often as they stand."""
    import numpy as np

    parts = list(map(_grams.__getitem__, _CLEAN.sub(" ", text).split()))
    return np.concatenate(parts) if parts else np.zeros(0, np.int32)


def ranking(ids, top: int):
    """The most frequent n-grams in order; ties by the hash, so that there is one outcome."""
    import numpy as np

    u, c = np.unique(ids, return_counts=True)
    return u[np.lexsort((u, -c))[:top]]


class Profiles:
    """Rank-order profiles by language."""

    def __init__(self, texts: dict[str, list[str]]):
        self.ranked = {k: ranking(gram_ids(" ".join(v)), TOP) for k, v in texts.items() if v}
        self._table = None

    def __getstate__(self):
        return {"ranked": self.ranked, "_table": None}

    def table(self):
        """Rank of every n-gram in each profile; those it lacks have one beyond all."""
        import numpy as np

        if self._table is None:
            self._table = np.full((len(self.ranked), 1 << BITS), -1, np.int16)
            for row, ids in zip(self._table, self.ranked.values()):
                row[ids] = np.arange(len(ids))
        return self._table

    def distances(self, sentence: str) -> dict[str, float]:
        """Mean out-of-place distance to each profile, 0 to 1."""
        import numpy as np

        own = ranking(gram_ids(sentence), TOP_SENTENCE)
        r = self.table()[:, own]
        d = np.where(r < 0, TOP, np.abs(r - np.arange(len(own), dtype=np.int16)))
        return dict(zip(self.ranked, (d.sum(axis=1) / (TOP * max(1, len(own)))).tolist()))

    def classify(self, sentence: str) -> tuple[str | None, float]:
        """Language of one sentence (in lower case) and its confidence, how much nearer it is than the next; none without letters, or where no profile has an n-gram of it."""
        sentence = main_script(sentence)
        if not sentence:
            return None, 0.0
        d = sorted((v, k) for k, v in self.distances(sentence).items())
        if not d or d[0][0] >= 1.0:
            return None, 0.0
        return d[0][1], 1.0 - d[0][0] / (d[1][0] if len(d) > 1 else 1.0)


def main_script(sentence: str) -> str:
    """The words in the script of most, others left out; nothing without letters."""
    arabic, latin = _ARABIC.search(sentence), _LATIN.search(sentence)
    if not (arabic and latin):
        return sentence if arabic or latin else ""
    ws = sentence.split()
    a = [w for w in ws if _ARABIC.search(w)]
    return " ".join(a if 2 * len(a) >= len(ws) else [w for w in ws if not _ARABIC.search(w)])


def script_runs(sentence: str) -> list[str]:
    """A sentence cut where the script changes for a whole stretch of words; shorter stretches stay inside."""
    if not (_ARABIC.search(sentence) and _LATIN.search(sentence)):
        return [sentence]
    runs: list[tuple[str, list[str]]] = []
    for w in sentence.split():
        s = "a" if _ARABIC.search(w) else "l" if _LATIN.search(w) else runs[-1][0] if runs else "a"
        if not runs or runs[-1][0] != s:
            runs.append((s, []))
        runs[-1][1].append(w)
    if sum(len(ws) >= LEAST_WORDS for _, ws in runs) < 2 or len({s for s, ws in runs if len(ws) >= LEAST_WORDS}) < 2:
        return [sentence]
    out: list[list[str]] = []
    for _, ws in runs:
        if len(ws) >= LEAST_WORDS or not out:
            out.append(list(ws))
        else:
            out[-1] += ws
    return [" ".join(x) for x in out]


def sentences(text: str | None) -> list[str]:
    """Sentences with a letter, in lower case, look-alike characters resolved."""
    if not text:
        return []
    pieces = [s for s in map(str.strip, _STOP.split(canonical(text).lower())) if s]
    return [s for s in chain.from_iterable(map(script_runs, pieces)) if _ARABIC.search(s) or _LATIN.search(s)]


def text_languages(texts, model) -> dict[str, tuple[int, float]]:
    """Language to (sentences, mean confidence) over several texts; ``model`` classifies a sentence.

    A word that stands alone is no sentence beside others, and two words are one with a confidence of ``CLEAR``.
    """
    out: dict[str, list[float]] = {}
    short: list[tuple[int, str, float]] = []
    for s in chain.from_iterable(map(sentences, texts)):
        lang, sure = model.classify(s)
        if lang:
            if (n := s.count(" ")) >= LEAST_WORDS - 2:
                out.setdefault(lang, []).append(sure)
            else:
                short.append((n, lang, sure))
    alone = not out
    for n, lang, sure in short:
        if alone or (n and sure >= CLEAR):
            out.setdefault(lang, []).append(sure)
    if len(out) > 1:  # a language that no sentence shows with any confidence is none beside others
        out = {k: v for k, v in out.items() if max(v) >= LEAST_SURE} or out
    return {k: (len(v), sum(v) / len(v)) for k, v in out.items()}


def hash_share(df: DataFrame, key: str, seed: int, rows: float) -> DataFrame:
    """About ``rows`` rows of a table, those with the least hashes, with the hash as ``__h``; all of a small one.

    The share is set by the count of rows (from footers), so what a fit gathers is the same at every size.
    """
    total = df.count()
    h = F.pmod(F.xxhash64(F.lit(seed), F.col(key).cast("string")), F.lit(1 << 40))
    out = df.withColumn("__h", h)
    return out if total <= rows else out.where(F.col("__h") < int(rows / total * (1 << 40)))


def labelled_texts(records: DataFrame, key: str = "line_no", sample: int = SAMPLE) -> list[tuple[str, str]]:
    """(label, text) of ``sample`` labelled records of each language, in a hash order, read whole.

    Looked for among ``sample / LEAST_SHARE`` rows in all: a language that fewer rows are labelled with
    than that share is fitted on those there are.
    """
    label = language_label(F.col("language"))
    turns_ = F.filter("messages", lambda m: m["role"].isin("user", "assistant"))
    text = F.array_join(F.transform(turns_, lambda m: F.coalesce(m["content"], F.lit(""))), "\n")
    part = hash_share(records.select(key, "language", "messages"), key, 17, sample / LEAST_SHARE)
    some = part.select(label.alias("label"), "__h", text.alias("text")).where(F.col("label").isin(*LANGUAGES) & (F.length("text") > 20))
    ranked = some.withColumn("r", F.row_number().over(Window.partitionBy("label").orderBy("__h", "text"))).where(F.col("r") <= sample)
    return [(r["label"], r["text"]) for r in ranked.collect()]


def fit(records: DataFrame, key: str = "line_no", sample: int = SAMPLE) -> Profiles:
    """Profiles from ``labelled_texts``."""
    return fit_texts(labelled_texts(records, key, sample))


def fit_texts(labelled: list[tuple[str, str]]) -> Profiles:
    """Profiles from labelled texts, refitted on what they assign to each language."""
    cut: dict[str, list[str]] = {k: [] for k in LANGUAGES}
    for label, text in labelled:
        cut[label] += sentences(text)
    # the script of a sentence is certain, whatever its label
    flat = [(k, s) for k, v in cut.items() for s in v]
    first = Profiles({k: [s for l, s in flat if l == k and bool(_ARABIC.search(s)) == (k == "ar")] for k in LANGUAGES})
    again: dict[str, list[str]] = {k: [] for k in LANGUAGES}
    for _, s in flat:
        lang, sure = first.classify(s)
        if lang and sure > 0.1:
            again[lang].append(s)
    return Profiles({k: v or cut[k] for k, v in again.items()})


def record_languages(records: DataFrame, profiles: Profiles, key: str = "line_no", keep: list[str] = (), roles: tuple[str, ...] = ("user",)) -> DataFrame:
    """``key``, ``keep`` and the languages of each record: array of (lang, sentences, confidence) in order of the name.

    Only turns of ``roles`` count. Records without messages, or without a letter in these turns, have an
    empty array; null contents are skipped, repeated rows stay as they are.
    """
    kinds = dict(records.dtypes)
    shared = records.sparkSession.sparkContext.broadcast(profiles)

    def run(batches):
        import pyarrow as pa

        p = shared.value
        kind = pa.list_(pa.struct([("lang", pa.string()), ("sentences", pa.int32()), ("confidence", pa.float64())]))
        for b in batches:
            start, end, role, content = turns(b.column(b.num_columns - 1))
            rows = []
            for s, e in zip(start, end):
                found = text_languages([c for r, c in zip(role[s:e], content[s:e]) if r in roles], p)
                rows.append([{"lang": k, "sentences": n, "confidence": c} for k, (n, c) in sorted(found.items())])
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(rows, kind)], names=[key, *keep, "languages"])

    schema = ", ".join(f"`{c}` {kinds[c]}" for c in [key, *keep]) + ", languages array<struct<lang:string,sentences:int,confidence:double>>"
    return spread(records.select(key, *keep, "messages")).mapInArrow(run, schema)


def segments(records: DataFrame, profiles: Profiles, key: str = "line_no") -> DataFrame:
    """One row for each sentence of the user turns, short ones too: ``key``, turn, segment (both from 0), lang, confidence, text."""
    kinds = dict(records.dtypes)
    shared = records.sparkSession.sparkContext.broadcast(profiles)

    def run(batches):
        import pyarrow as pa

        p = shared.value
        for b in batches:
            start, end, role, content = turns(b.column(1))
            at, cols = [], [[], [], [], [], []]
            for i, (s, e) in enumerate(zip(start, end)):
                for t in range(s, e):
                    if role[t] == "user":
                        for k, text in enumerate(sentences(content[t])):
                            at.append(i)
                            for c, v in zip(cols, (t - s, k, *p.classify(text), text)):
                                c.append(v)
            kinds_ = (pa.int32(), pa.int32(), pa.string(), pa.float64(), pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int32())), *(pa.array(c, k) for c, k in zip(cols, kinds_))], names=[key, "turn", "segment", "lang", "confidence", "text"])

    return spread(records.where("size(messages) > 0").select(key, "messages")).mapInArrow(run, f"`{key}` {kinds[key]}, turn int, segment int, lang string, confidence double, text string")


def right_label(languages: Column) -> Column:
    """The label the languages call for: the only one, ``mixed``, or null without any."""
    return F.when(F.size(languages) == 1, F.try_element_at(languages, F.lit(1))["lang"]).when(F.size(languages) > 1, F.lit("mixed"))


def relabelled(records: DataFrame, profiles: Profiles | None = None, key: str = "line_no") -> DataFrame:
    """``key``, label (canonical, as given), right (as found) and languages of every record with messages."""
    p = profiles or fit(records, key)
    found = record_languages(records.where("size(messages) > 0"), p, key, ["language"])
    return found.select(key, language_label(F.col("language")).alias("label"), right_label(F.col("languages")).alias("right"), "languages")
