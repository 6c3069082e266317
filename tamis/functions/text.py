"""Text expressions. All are built-in columns, so they stay in whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns and word lists of the corpus rules.
ARABIC_CHAR = r"[؀-ۿ]"
LATIN_CHAR = r"[A-Za-z]"
ARABIZI_DIGIT = r"[379]"
URL = r"https?://\S+|www\.\S+"
EMOJI = r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F1E0}-\x{1F1FF}\x{2702}-\x{27B0}\x{24C2}-\x{1F251}]"
FRENCH_WORDS = [
    "le", "la", "les", "un", "une", "des", "et", "ou", "a", "de", "du", "en", "je", "tu", "il", "elle", "nous", "vous", "ils", "elles", "ce", "cette",
    "ces", "mon", "ton", "son", "ma", "ta", "sa", "mes", "tes", "ses", "est", "sont", "etre", "avoir", "faire", "aller", "dire", "voir", "savoir",
    "pouvoir", "vouloir", "devoir", "falloir", "qui", "que", "quoi", "dont", "plus", "moins", "tres", "bien", "mal", "ici", "maintenant",
    "aujourdhui", "demain", "hier", "soir", "matin", "jour", "nuit", "an", "ans", "fois", "pour", "sur", "avec", "sans", "sous", "dans", "chez",
    "par", "pour", "quoi", "comment", "quand", "si", "car", "mais", "donc", "or", "ni", "que", "l", "d", "j", "qu", "n", "m", "t", "s", "c", "jusqu",
    "presque", "depuis", "pendant", "avant", "apres", "entre", "vers", "contre", "selon", "malgre", "via",
]


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once; a lambda would compute a captured expression for every element."""
    return F.try_element_at(F.transform(F.array(value), body), F.lit(1))


def strip(x: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(x, r"(?U)^\s+|\s+$", "")


def blank(x: Column) -> Column:
    """Whether there is nothing but white space; null for null. The first other character ends the look, unlike a strip of the whole text."""
    return ~x.rlike(r"(?U)\S")


def collapse(x: Column) -> Column:
    """Runs of white space to one space, none at the ends."""
    return strip(F.regexp_replace(x, r"(?U)\s+", " "))


def clean_web(x: Column) -> Column:
    """Without addresses of pages and pictographs, white space collapsed."""
    return collapse(F.regexp_replace(F.regexp_replace(x, "(?U)" + URL, ""), EMOJI, ""))


def clean_bom(x: Column) -> Column:
    return collapse(F.replace(x, F.lit("﻿"), F.lit("")))


def norm_key(x: Column) -> Column:
    """Lower case without punctuation."""
    return strip(F.regexp_replace(F.lower(x), r"(?U)[^\p{L}\p{N}_\s]", ""))


def as_text(x: Column) -> Column:
    return F.coalesce(x.cast("string"), F.lit(""))


def count_chars(x: Column, pattern: str) -> Column:
    return F.coalesce(F.regexp_count(x, F.lit(pattern)), F.lit(0))


def count_words(x: Column, words: list[str], flags: str = "(?U)") -> Column:
    """Hits of whole words."""
    return F.coalesce(F.regexp_count(x, F.lit(flags + r"\b(" + "|".join(words) + r")\b")), F.lit(0))


def count_markers(x: Column, markers: list[str]) -> Column:
    """How many of the markers occur in the text, anywhere."""
    out = F.lit(0)
    for m in dict.fromkeys(markers):
        out = out + F.when(F.contains(x, F.lit(m)), 1).otherwise(0)
    return F.coalesce(out, F.lit(0))


def any_marker(x: Column, markers: list[str]) -> Column:
    """Whether one of the markers occurs in the text, anywhere: one pattern, as a test for each would outgrow generated code."""
    pattern = "|".join("".join("\\" + c if c in r"\.[]{}()*+-?^$|" else c for c in m) for m in dict.fromkeys(markers))
    return F.coalesce(x.rlike(pattern), F.lit(False))


def has_arabic(x: Column) -> Column:
    return F.coalesce(x.rlike(ARABIC_CHAR), F.lit(False))


def has_french(x: Column) -> Column:
    return F.coalesce(x.rlike(r"(?iU)\b(" + "|".join(dict.fromkeys(FRENCH_WORDS)) + r")\b"), F.lit(False))


def is_short(x: Column, least: int = 10) -> Column:
    return F.length(strip(F.coalesce(x, F.lit("")))) < least


def is_valid_text(x: Column) -> Column:
    return F.coalesce(F.length(strip(x)) >= 2, F.lit(False))


def has_digit_orthography(x: Column) -> Column:
    return F.coalesce(x.rlike(r"(?U)\b\w*[379]\w*\b"), F.lit(False))


def token_estimate(x: Column) -> Column:
    """A quarter of the characters, at least 1; 0 for nothing."""
    return F.when(F.coalesce(F.length(x), F.lit(0)) == 0, F.lit(0)).otherwise(F.greatest(F.lit(1), F.floor(F.length(x) / 4))).cast("long")


def sha256(x: Column) -> Column:
    return F.sha2(x, 256)


def sanitise_id(x: Column) -> Column:
    return F.regexp_replace(x, r"[^A-Za-z0-9._:-]", "_")


def model_size(name: Column) -> Column:
    """Billions of parameters named in a model's name; 7 where none is."""
    n = F.regexp_extract(F.lower(name), r"(?:^|[^0-9a-z.])(\d+(?:\.\d+)?)b(?:$|[^a-z0-9])", 1)
    return F.coalesce(F.when(n != "", n).cast("double"), F.lit(7.0))


def embedded_blob(text: Column, pattern: str) -> Column:
    """Base64 pieces captured by a pattern, joined and decoded."""
    return F.decode(F.unbase64(F.array_join(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), "")), "UTF-8")
