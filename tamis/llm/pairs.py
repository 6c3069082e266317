"""Problem 2: answers that are no proper answer to the question before them, with the kind of defect.

Copies are told by compression: the response, compressed with its prompt as a zstandard dictionary,
leaves next to nothing. Refusals, requests for another language and the languages of both come from
dictionaries, truncation from unclosed structure and a model of the contexts in which sentences of the
corpus end.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamis.llm import langid
from tamis.llm.arrow import turns
from tamis.llm.dictionaries import Dictionaries
from tamis.llm.forms import canonical, words
from tamis.llm.labels import STAND_INS
from tamis.operators.joins import lookup_join
from tamis.session import cut, spread

DEFECTS = ("empty_answer", "truncated_answer", "refusal", "copied_question", "other_language")
#: Uses in the whole corpus from which a word is judged by its own share of ends (a word with fewer by those of all such
#: words), and from which a context or an ending of such words is trusted.
KNOWN, TRUSTED = 6, 4
#: Least share of ends of a known word at which a sentence may stop without a full stop; for a word that isn't known the
#: same of the word before it and any unknown word.
LEAST_END, LEAST_END_UNKNOWN = 0.01, 0.12
#: Least confidence that an answer is in another language, and its least words: a yes or no is the same in several.
LEAST_SURE, LEAST_ANSWER = 0.3, 3
#: Words of sentences that a task counts at once.
COUNT_WORDS = 1_000_000
#: Words beside excuses that a refusal may have before it, behind it in its sentence before a contrast, and in further sentences.
LEAD_WORDS, OWN_WORDS, OTHER_WORDS = 6, 16, 14
#: Greatest residue of a copy: bytes that stay of the response over its own, when the prompt is the dictionary.
RESIDUE = 0.45

# Ways to decline, what follows it, and how an answer is announced all the same.
REFUSALS = [
    r"ما نقدرش", r"ما نجمش", r"ما نجّمش", r"ماهوش مسموحلي", r"موش مسموحلي", r"ممنوع عليّ", r"نفضّل ما نتدخّلش", r"نفضّل ما نجاوبش", r"خارج على نطاقي", r"خارج عن نطاقي", r"ليس بإمكاني", r"لا أستطيع", r"لا يمكنني", r"لا أقدر", r"لست قادرا", r"غير قادر على", r"غير مسموح لي", r"لا يسمح لي", r"أفضّل ألّا", r"أفضل عدم", r"يتعذّر عليّ", r"أعتذر عن",
    r"ma na9derch", r"ma najjamch", r"ma nejjemch", r"ma nnajjamch", r"mouch masmou7li", r"mahouch masmou7li", r"nfadhel ma", r"khare?j 3la? ?nta9i", r"kharej 3la", r"mamnou3 3liya",
    r"je ne peux pas", r"je ne puis", r"je ne suis pas en mesure", r"je ne suis pas autorisée?", r"il m['’]est impossible", r"je préfère ne pas", r"je refuse", r"impossible pour moi", r"hors de mon (?:champ|domaine)", r"je ne saurais", r"dépasse (?:mon|mes)",
    r"i can(?:'|’|no)t", r"i can ?not", r"i am unable", r"i['’]m unable", r"i am not able", r"i['’]m not able", r"i['’]m not allowed", r"i am not allowed", r"i would rather not", r"i['’]d rather not", r"i won['’]t", r"i will not", r"out(?:side)? (?:of )?my scope", r"beyond my scope", r"i must decline", r"i have to decline", r"not permitted to",
]
LANGUAGE_NAMES = [
    r"fran[cç]ais\w*", r"anglais\w*", r"arabe\w*", r"arabic", r"arabizi", r"english", r"french", r"franco", r"dialect\w*", r"derja", r"ingl[ie][sz]\w*", r"souri", r"3arb\w*", r"soury?a",
    r"\w*فرنس\w*", r"\w*سوري", r"\w*نقليز\w*", r"\w*نجليز\w*", r"\w*عربي\w*", r"\w*عربيز\w*", r"\w*دارج\w*",
]
# What is said beside a refusal and answers nothing, and words with which an answer follows all the same.
EXCUSES = [
    "désolé", "desole", "navré", "pardon", "excus", "merci", "politique", "règles", "programme", "assistant", "modèle", "autre question", "autre chose", "consult", "spécialiste", "professionnel",
    "sorry", "apolog", "thank", "policy", "policies", "rules", "guidelines", "program", "language model", "as an ai", "something else", "another question", "please ask", "professional", "specialist",
    "سامحني", "نعتذر", "آسف", "عذرا", "شكرا", "القواعد", "قوانين", "برنامج", "نموذج", "سؤال آخر", "حاجة أخرى", "مختصّ", "مختص",
    "sama7ni", "sam7ni", "nsama7", "samahni", "na3tadhir", "na3tather", "merci", "barnamej", "9awa3ed", "9anoun", "7aja okhra", "so2el ekher",
]
CONTRASTS = ["but", "however", "instead", "still", "mais", "cependant", "toutefois", "pourtant", "لكن", "أما", "امّا", "ama", "emma", "lakin", "lekin", "walakin"]
#: For text in lower case: a pattern that ignores case tries every alternative at every place.
_REFUSAL = re.compile(rf"(?=[{''.join(sorted({x[0] for x in REFUSALS}))}])(?<!\w)(?:{'|'.join(REFUSALS)})")
_EXCUSE = re.compile("|".join(rf"(?<!\w){re.escape(x)}" for x in EXCUSES), re.I)
_CONTRAST = re.compile(rf"(?<!\w)(?:{'|'.join(CONTRASTS)})(?!\w)", re.I)
_CLAUSE, _SENTENCE = re.compile(r"[.!?؟\n,،;؛]"), re.compile(r"[.!?؟\n]")
_QUOTED = re.compile(r"«[^»]*»|“[^”]*”|\"[^\"\n]*\"")
_ASKED = re.compile("|".join(rf"(?<!\w){x}(?!\w)" for x in LANGUAGE_NAMES), re.I)
#: Any Latin letter, full-width and look-alike ones too: whoever has none is in Arabic script or has no letter.
_ROMAN = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿŒœΑ-Ωα-ωА-яёѐ-ӿＡ-Ｚａ-ｚ]")
_ANY = re.compile(r"[^\W_]")
#: Pictographs at the end of an answer, taken off as white space is.
_PICTOGRAPH = re.compile("[\U0001F000-\U0001FAFF☀-➿️‍]")
_SENTENCE_END = re.compile(r"(?<![.!?؟])[.!?؟]++(?=[\s»”\")\]]|$)")
_MARKER = re.compile(r"(?:\d{1,3}[.)]|[-*•])$")
_DIGITS = r"^\p{Nd}+$"
_CLOSED = tuple(".!?؟»”)]}\"'`;؛")


def complete_sentences(answer: str) -> list[list[str]]:
    """Words of the sentences of an answer that are closed by a mark; what stands behind the last mark is none."""
    return [ws for x in _SENTENCE_END.split(answer)[:-1] if (ws := words(x))]


def symbol(word: str, known: bool) -> str:
    return word if known else Endings.NUMBER if word.isdecimal() else Endings.RARE


class Endings:
    """How often a word ends a sentence, and a rare word behind a given one; rare words share a symbol."""

    RARE, NUMBER = "\0", "#"

    def __init__(self, texts: list[str]):
        sentences = [s for t in texts for s in complete_sentences(t)]
        uses = Counter(w for s in sentences for w in s)
        self.known = frozenset(w for w, n in uses.items() if n >= KNOWN)
        #: by word or symbol, and by the symbol before a rare word: uses and ends
        self.word, self.before_rare, suffix = {}, {}, Counter()
        for s in sentences:
            k = [symbol(w, w in self.known) for w in s]
            for i, x in enumerate(k):
                last = i == len(k) - 1
                for table, c in ((self.word, x), (self.before_rare, k[i - 1] if i and x == self.RARE else None)):
                    if c is not None:
                        n = table.setdefault(c, [0, 0])
                        n[0] += 1
                        n[1] += last
                if s[i] not in self.known and len(s[i]) > 3:
                    suffix[s[i][-2:]] += 1
        self.suffix = frozenset(x for x, n in suffix.items() if n >= TRUSTED)

    def may_end(self, ws: list[str]) -> bool:
        """Whether a sentence of these words may be complete."""
        if not ws:
            return True
        k = [symbol(w, w in self.known) for w in ws[-2:]]
        if k[-1] == self.RARE:
            # an unknown last word: only a place where unknown words stand, with the ending of one
            n, ends = self.before_rare.get(k[0], (0, 0)) if len(k) > 1 else (0, 0)
            return n >= TRUSTED and ends >= LEAST_END_UNKNOWN * n and ws[-1][-2:] in self.suffix
        n, ends = self.word.get(k[-1], (0, 0))
        return n < KNOWN or ends >= LEAST_END * n


def is_empty(answer: str | None) -> bool:
    """Null, without a word, or only a stand-in for a missing value."""
    return not answer or not _ANY.search(answer) or answer.strip().strip("[]<>()\"'").strip().lower() in STAND_INS


def is_refusal(answer: str) -> bool:
    """Declines, outside of quotations, at the start or behind excuses, and says next to nothing else but excuses."""
    low = answer.lower()
    if not _REFUSAL.search(low):
        return False
    text = _QUOTED.sub(" ", low)
    m = _REFUSAL.search(text)
    if not m:
        return False
    *before, own = _CLAUSE.split(text[: m.start()])
    if len(words(own)) + sum(len(words(x)) for x in before if not _EXCUSE.search(x)) > LEAD_WORDS:
        return False
    rest, *others = _SENTENCE.split(text[m.end() :])
    if re.search(r"[:：]\s*\S", rest):
        return False
    if len(words(rest)) > OWN_WORDS and _CONTRAST.search(rest):
        return False
    return sum(len(words(x)) for x in others if not (_EXCUSE.search(x) or _REFUSAL.search(x))) <= OTHER_WORDS


def residue(question: str, answer: str) -> float:
    """Bytes left of the answer when the question is its dictionary, over its own bytes."""
    import zstandard

    q, a = question.encode(), answer.encode()
    while len(q) < 16:
        q += b" " + (q or b"?")
    d = zstandard.ZstdCompressionDict(q, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    n = len(zstandard.ZstdCompressor(level=3, dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False).compress(a))
    return max(0, n - 11) / max(1, len(a))


def is_copy(question: str | None, answer: str) -> bool:
    """Repeats the question, perhaps slightly changed or announced, and adds no answer."""
    if not question:
        return False
    q, a = words(question), words(answer)
    asked = set(q)
    if len(a) < 2 or not asked:
        return False
    # what is said beyond the question's words, however often these are repeated, and how many of them are said
    if len(asked.intersection(a)) < 0.75 * len(asked) or sum(x not in asked for x in a) > max(2, 0.2 * len(q)) + 3:
        return False
    return residue(" ".join(q), " ".join(a)) <= RESIDUE


def tail_off(text: str) -> str:
    """Without white space and pictographs at the end; one look at each of these characters."""
    n = len(text)
    while n and (text[n - 1].isspace() or _PICTOGRAPH.match(text[n - 1])):
        n -= 1
    return text[:n]


def ends_in_marker(text: str) -> bool:
    """A list marker with nothing behind it, at the start of a line or behind a sentence."""
    m = _MARKER.search(text, max(0, len(text) - 4))
    if not m:
        return False
    before = text[: m.start()]
    said = before.rstrip()
    return not said or "\n" in before[len(said) :] or (len(said) < len(before) and said[-1] in ".!?؟")


def open_end(answer: str) -> list[str] | bool:
    """Whether an answer stops inside a list, bracket, quotation or code block; else the words of a last sentence without mark."""
    if answer.count("```") % 2:
        return True
    text = tail_off(answer)
    if not text:
        return False
    for o, c in ("()", "[]", "«»", "“”", "{}"):
        if text.count(o) > text.count(c) and text.rfind(o) > text.rfind(c):
            return True
    if text.count('"') % 2 and not re.search(r'\d"', text):
        return True
    if text.endswith(":") or ends_in_marker(text):
        return True
    if text.endswith(_CLOSED) and not text.endswith(("...", ";", "؛")):
        return False
    # the last stretch after a sentence end or a line break, or all of it
    last = re.split(r"[.!?؟;؛](?=\s)|\n", text.rstrip(".…,،;؛ "))[-1]
    ws = words(re.sub(r"^\s*(?:[-*•]|\d+[.)!])\s*", "", last))
    return ws[-2:]


def is_other_language(question: str | None, answer: str, dictionaries: Dictionaries) -> bool:
    """The answer is in another language than the question, which is in one, and it asked for none."""
    if not question or not (_ROMAN.search(question) or _ROMAN.search(answer)):  # both in Arabic script
        return False
    q = langid.text_languages([question], dictionaries)
    if len(q) != 1:
        return False
    a = langid.text_languages([answer], dictionaries)
    own = next(iter(q))
    if not a or own in a or _ASKED.search(question):
        return False
    n = sum(x for x, _ in a.values())
    return max(x for x, _ in a.values()) >= 0.6 * n and max(c for _, c in a.values()) >= LEAST_SURE and len(words(answer)) >= LEAST_ANSWER


def judge(question: str | None, answer: str | None, dictionaries: Dictionaries) -> tuple[str | None, list[str]]:
    """The defect of one answer, or none, and the last words of one that is truncated if no sentence ends in them.

    The rules look at both texts in their canonical form.
    """
    answer = canonical(answer)
    if is_empty(answer):
        return "empty_answer", []
    if is_refusal(answer):
        return "refusal", []
    question = canonical(question)
    if is_copy(question, answer):
        return "copied_question", []
    end = open_end(answer)
    if end is True:
        return "truncated_answer", []
    return "other_language" if is_other_language(question, answer, dictionaries) else None, end or []


def defect(question: str | None, answer: str | None, dictionaries: Dictionaries, endings: Endings) -> str | None:
    """The defect of one answer, or none."""
    found, end = judge(question, answer, dictionaries)
    return found if endings.may_end(end) else "truncated_answer"


def count_words(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Over the complete sentences of all assistant answers: (word, uses, ends), and (before, word, uses, ends) of rare words.

    ``before`` is empty at the start of a sentence. A task counts the words before a rare one only where it met the word
    less than ``KNOWN`` times at once; of a word that is rare in the corpus that is every place.
    """

    def run(batches):
        import pyarrow as pa

        held, size = [], 0

        def flush():
            uses, ends = Counter(), Counter(s[-1] for s in held)
            for s in held:
                uses.update(s)
            rare = {w for w, n in uses.items() if n < KNOWN}
            pairs, pair_ends = Counter(), Counter()
            for s in held:
                if not rare.isdisjoint(s):
                    pairs.update(x for x in zip(s, s[1:]) if x[1] in rare)
                    if len(s) > 1 and s[-1] in rare:
                        pair_ends[s[-2], s[-1]] += 1
            rows = [(None, w, n, ends[w]) for w, n in uses.items()] + [(*x, n, pair_ends[x]) for x, n in pairs.items()]
            held.clear()
            cols = list(zip(*rows)) or [(), (), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.string(), pa.int64(), pa.int64()))], names=["before", "word", "uses", "ends"])

        for b in batches:
            _, _, role, content = turns(b.column(0))
            for r, c in zip(role, content):
                if r == "assistant" and c:
                    for s in complete_sentences(canonical(c)):
                        held.append(s)
                        size += len(s)
            if size >= COUNT_WORDS:
                yield flush()
                size = 0
        yield flush()

    part = spread(records.where("size(messages) > 0").select("messages")).mapInArrow(run, "before string, word string, uses long, ends long")
    both = cut(part.groupBy("before", "word").agg(F.sum("uses").alias("uses"), F.sum("ends").alias("ends")))
    return both.where("before is null").drop("before"), both.where("before is not null")


def sound_ends(records: DataFrame, ends: DataFrame) -> DataFrame:
    """The rows (before, word) of ``ends`` with which a sentence may be complete, as ``Endings.may_end`` of all answers says.

    The counts stay in tables that are joined, so no vocabulary is too large; ``before`` is empty for a single word.
    """
    words_, pairs_ = count_words(records)
    number, rare = F.lit(Endings.NUMBER), F.lit(Endings.RARE)
    unknown = cut(words_.where(F.col("uses") < KNOWN).withColumn("digit", F.col("word").rlike(_DIGITS)))
    known = words_.where(F.col("uses") >= KNOWN)

    def symbols(df: DataFrame, word: str, to: str) -> DataFrame:
        """Adds the symbol of a word, and the uses and ends of a known one."""
        named = df.join(known.select(F.col("word").alias(word), F.col("uses").alias(f"{to}_uses"), F.col("ends").alias(f"{to}_ends")), word, "left")
        return named.withColumn(to, F.when(F.col(f"{to}_uses").isNotNull(), F.col(word)).when(F.col(word).rlike(_DIGITS), number).otherwise(rare))

    digit_uses, digit_ends = unknown.where("digit").agg(F.coalesce(F.sum("uses"), F.lit(0)), F.coalesce(F.sum("ends"), F.lit(0))).first()
    suffix = unknown.where(F.length("word") > 3).groupBy(F.substring("word", -2, 2).alias("suffix")).agg(F.sum("uses").alias("n")).where(F.col("n") >= TRUSTED).select("suffix")
    before = symbols(pairs_.join(unknown.where("not digit").select("word"), "word", "left_semi").select("before", "uses", "ends"), "before", "b")
    before = before.groupBy("b").agg(F.sum("uses").alias("uses"), F.sum("ends").alias("ends")).where((F.col("uses") >= TRUSTED) & (F.col("ends") >= F.lit(LEAST_END_UNKNOWN) * F.col("uses"))).select("b")
    at = cut(symbols(symbols(ends.distinct(), "word", "w"), "before", "b").withColumn("suffix", F.substring("word", -2, 2)))
    uses, done = F.when(F.col("w") == number, F.lit(digit_uses)).otherwise(F.col("w_uses")), F.when(F.col("w") == number, F.lit(digit_ends)).otherwise(F.col("w_ends"))
    plain = at.where((F.col("w") != rare) & ((uses < KNOWN) | (done >= F.lit(LEAST_END) * uses))).select("before", "word")
    odd = at.where((F.col("w") == rare) & (F.col("before") != "")).join(before, "b", "left_semi").join(suffix, "suffix", "left_semi").select("before", "word")
    return plain.union(odd)


def defective_pairs(records: DataFrame, key: str = "line_no", dictionaries: Dictionaries | None = None, endings: Endings | None = None) -> DataFrame:
    """``key``, turn (0-based, of the answer) and defect; one row for each defective answer.

    A pair is an assistant turn and the turn before it, which must be of the user; other turns make no
    pair. Null messages have none. Repeated rows give repeated results. Without ``endings`` the ends of
    sentences are counted over all assistant answers.
    """
    kinds = dict(records.dtypes)
    models = records.sparkSession.sparkContext.broadcast((dictionaries or Dictionaries(langid.labelled_texts(records, key)), endings))

    def run(batches):
        import pyarrow as pa

        p, e_ = models.value
        for b in batches:
            start, end, role, content = turns(b.column(1))
            at, cols = [], [[], [], [], []]
            for i, (s, e) in enumerate(zip(start, end)):
                for t in range(s + 1, e):
                    if role[t] == "assistant" and role[t - 1] == "user":
                        kind, last = judge(content[t - 1], content[t], p)
                        if e_ is not None:
                            kind, last = kind if e_.may_end(last) else "truncated_answer", []
                        if kind or last:
                            at.append(i)
                            for c, v in zip(cols, (t - s, kind, last[-2] if len(last) > 1 else "" if last else None, last[-1] if last else None)):
                                c.append(v)
            kinds_ = (pa.int32(), pa.string(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int32())), *(pa.array(c, k) for c, k in zip(cols, kinds_))], names=[key, "turn", "defect", "before", "word"])

    found = spread(records.where("size(messages) > 1").select(key, "messages")).mapInArrow(run, f"`{key}` {kinds[key]}, turn int, defect string, before string, word string")
    if endings is not None:
        return found.select(key, "turn", "defect")
    found = cut(found)
    open_ = found.where("word is not null")
    sound = cut(sound_ends(records, open_.select("before", "word")).withColumn("sound", F.lit(True)))
    told = lookup_join(open_, sound, ["before", "word"], "left", salt_by=key).select(key, "turn", F.when(F.col("sound"), F.col("defect")).otherwise(F.lit("truncated_answer")).alias("defect"))
    return found.where("word is null").select(key, "turn", "defect").union(told.where("defect is not null"))
