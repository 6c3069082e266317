"""Adapters from raw source shapes to canonical records, as one select each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamis.functions.classify import code_switching
from tamis.functions.messages import canonical_messages, from_sharegpt, from_text, messages_valid
from tamis.functions.text import as_text, clean_web, collapse, has_arabic, has_digit_orthography, has_french, is_short, sanitise_id, strip

# Label and dialect maps.
SENTIMENTS = {"1": "positive", "0": "neutral", "-1": "negative"}
DIALECT_LANGUAGE = {"tunisian": "ar", "tunisian_arabic": "ar", "arabic": "ar", "tunisian_arabizi": "arabizi", "arabizi": "arabizi", "french": "fr", "english": "en", "mixed": "mixed"}


#: Topics of questions and the categories they belong to.
TOPIC_CATEGORY = {
    "student_life": "general_instruction", "education": "general_instruction", "work": "general_instruction", "health": "knowledge_qa", "technology": "general_instruction", "culture": "general_instruction",
    "religion": "knowledge_qa", "politics": "knowledge_qa", "sports": "general_instruction", "food": "general_instruction", "travel": "general_instruction", "family": "general_instruction",
}


def lookup(c: Column, pairs: dict[str, str], default: str | None = None) -> Column:
    m = F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])
    return F.coalesce(F.try_element_at(m, c), F.lit(default).cast("string"))


def first_filled(*cols: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c.cast("string"), F.lit("")) for c in cols], F.lit(""))


def record(df: DataFrame, ident: Column, user: Column, assistant: Column, category, source, language, system: Column | None = None, keep: list[str] = (), **optional) -> DataFrame:
    """Canonical records; literals or columns, optional fields as named."""
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    return df.select(ident.alias("id"), canonical_messages(user, assistant, system).alias("messages"), lit(category).alias("category"), lit(source).alias("source"), lit(language).alias("language"), *[lit(v).alias(k) for k, v in optional.items()], *keep)


def sentiment(df: DataFrame, prompt: str, source: str) -> DataFrame:
    """ID, text, label rows: the label's name answers the prompt; unknown labels are neutral."""
    return record(df, F.concat(F.lit(source + "-"), F.col("ID").cast("string")), F.concat(F.lit(prompt + "\n"), collapse(F.col("text"))), lookup(F.trim(F.col("label").cast("string")), SENTIMENTS, "neutral"), "knowledge_qa", source, "arabizi", script="latin")


def transliteration(df: DataFrame, ident: Column, prompt: str, source: str) -> DataFrame:
    """arabish, CODA rows; the target falls back to the source text where it is blank."""
    return record(df, ident, F.concat(F.lit(prompt + "\n"), collapse(F.col("arabish"))), F.coalesce(F.nullif(collapse(F.col("CODA")), F.lit("")), collapse(F.col("arabish"))), "general_instruction", source, "arabizi", script="latin")


def joined(a: Column, b: Column, sep: str = "\n") -> Column:
    """Both where both are there, else the one that is."""
    x, y = F.nullif(a, F.lit("")), F.nullif(b, F.lit(""))
    return F.coalesce(F.concat(x, F.lit(sep), y), x, y, F.lit(""))


def dialect_qa(df: DataFrame, source: str, dialects: list[str] | None = None, only_digit_orthography: bool = False, keep: list[str] = ()) -> DataFrame:
    """id, instruction, input, output, dialect rows; blank parts fall back to what is there, rows without any text are left out."""
    i, n, o = (collapse(as_text(F.col(c))) for c in ("instruction", "input", "output"))
    rows = df.select("*", i.alias("__i"), n.alias("__n"), o.alias("__o"), F.lower(F.trim(F.col("dialect"))).alias("__d")).where("__i <> '' or __n <> '' or __o <> ''")
    if dialects is not None:
        rows = rows.where(F.col("__d").isin(dialects))
    if only_digit_orthography:
        rows = rows.where(has_digit_orthography(F.concat_ws(" ", "__i", "__n", "__o")))
    user = first_filled(joined(F.col("__i"), F.col("__n")), F.col("__o"))
    ident = F.coalesce(F.nullif(sanitise_id(F.col("id").cast("string")), F.lit("")), F.substring(F.sha2(F.concat_ws("|", "__i", "__n", "__o"), 256), 1, 16))
    return record(rows, F.concat(F.lit(source + "-"), ident), user, first_filled(F.col("__o"), user), "knowledge_qa", source, lookup(F.col("__d"), DIALECT_LANGUAGE, "ar"), keep=list(keep))


def qa_or_reason(df: DataFrame) -> DataFrame:
    """Adds ``skip_reason``, and the prompt and answer of rows that have both."""
    i, n, o = (strip(as_text(F.col(c))) for c in ("instruction", "input", "output"))
    prompt = joined(i, n, "\n\n")
    return df.withColumns({"skip_reason": F.when(prompt == "", "empty_prompt").when(o == "", "empty_output"), "prompt": prompt, "answer": o})


def corpus_lines(df: DataFrame, text: Column, ident: Column, instruction: str, source: str, language="ar", least: int = 10) -> DataFrame:
    """Texts of a corpus as answers to one instruction; short ones are left out."""
    t = df.withColumn("__t", clean_web(text)).where(~is_short(F.col("__t"), least))
    return record(t, ident, F.lit(instruction), F.col("__t"), "general_instruction", source, language)


def arabic_corpus(df: DataFrame, text: str) -> tuple[DataFrame, DataFrame]:
    """Clean texts with an Arabic letter, and how many were skipped for each reason."""
    t = df.withColumn("clean", clean_web(F.col(text)))
    reason = F.when(is_short(F.col("clean")), "short").when(~has_arabic(F.col("clean")), "no_arabic")
    judged = t.withColumn("reason", reason)
    return judged.where("reason is null").drop("reason"), judged.groupBy(F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def french_qa(df: DataFrame, source: str) -> DataFrame:
    """instruction, response, category rows that hold a French word, language from the script."""
    i, r = clean_web(as_text(F.col("instruction"))), clean_web(as_text(F.col("response")))
    rows = df.select("*", i.alias("__i"), r.alias("__r")).where(~is_short(F.col("__i")) & ~is_short(F.col("__r")) & has_french(F.concat_ws(" ", "__i", "__r")))
    mixed = has_arabic(F.concat_ws(" ", "__i", "__r"))
    ident = F.concat(F.lit(source + "-"), F.substring(F.sha2(F.concat_ws("|", "__i", "__r"), 256), 1, 16))
    return record(rows, ident, F.col("__i"), F.col("__r"), "knowledge_qa", source, F.when(mixed, "mixed").otherwise("fr"), script=F.when(mixed, "mixed").otherwise("latin"), code_switching=mixed)


def math_rows(df: DataFrame, source: str) -> tuple[DataFrame, DataFrame]:
    """query, response, type rows, and counts of rejected ones."""
    q, r = strip(as_text(F.col("query"))), strip(as_text(F.col("response")))
    judged = df.withColumns({"__q": q, "__r": r}).withColumn("reason", F.when(F.col("__q") == "", "empty_query").when(F.col("__r") == "", "empty_response"))
    ident = F.concat(F.lit(source + "-"), F.substring(F.sha2(F.concat_ws("|", "__q", "__r"), 256), 1, 16))
    good = record(judged.where("reason is null"), ident, F.col("__q"), F.col("__r"), "mathematics", source, "en", script="latin")
    return good, judged.where("reason is not null").groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def chat_rows(df: DataFrame, source: str, category="coding", conversations: str | None = None, tag=None) -> tuple[DataFrame, DataFrame]:
    """ChatML (``messages``) or ShareGPT rows with a sound structure, and the count of the others; ``tag`` gives the category of the last user turn."""
    m = from_sharegpt(F.col(conversations)) if conversations else F.col("messages")
    rows = df.withColumn("__m", m).withColumn("__ok", messages_valid(F.col("__m")))
    last = F.try_element_at(F.filter("__m", lambda x: x["role"] == "user"), F.lit(-1))["content"]
    cat = tag(last) if tag else F.lit(category)
    ident = F.concat(F.lit(source + "-"), F.substring(F.sha2(F.to_json(F.col("__m")), 256), 1, 16))
    good = rows.where("__ok").select(ident.alias("id"), F.col("__m").alias("messages"), cat.alias("category"), F.lit(source).alias("source"), F.lit("en").alias("language"))
    return good, rows.where("not __ok").agg(F.count(F.lit(1)).alias("rejected"))


def text_dialogues(df: DataFrame, ident: Column, text: Column, source: str) -> DataFrame:
    """Running texts as alternating turns; blank ones are left out."""
    rows = df.withColumn("__m", from_text(text)).where("__m is not null")
    return rows.select(ident.alias("id"), F.col("__m").alias("messages"), F.lit("general_instruction").alias("category"), F.lit(source).alias("source"), F.lit("mixed").alias("language"))


def multilingual_pairs(df: DataFrame, code: str = "arb") -> DataFrame:
    """inputs, targets rows of one language with both sides filled."""
    return df.where((F.col("language_code") == code) & (strip(as_text(F.col("inputs"))) != "") & (strip(as_text(F.col("targets"))) != ""))


def retag(df: DataFrame, category: Column) -> DataFrame:
    return df.withColumn("category", category)


def alias_targets(category: Column, aliases: dict[str, str]) -> Column:
    return F.coalesce(lookup(category, aliases), category)


# --- pools: rows of one shape as canonical records, code-switching told where the shape calls for it ----------
def _numbered(source: str, ident: str | None, *parts: Column) -> Column:
    """An identifier from the source and a column, or from the hash of the parts: the same wherever a row stands."""
    own = F.col(ident).cast("string") if ident else F.lit(None).cast("string")
    return F.concat(F.lit(source + "-"), F.coalesce(own, F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 16)))


def _pool(df: DataFrame, source: str, ident: str | None, user: Column, assistant: Column, category: Column | str, language: Column | str, switching: Column | None = None, **optional) -> DataFrame:
    rows = df.withColumns({"__u": user, "__a": assistant})
    more = {} if switching is None else {"code_switching": switching}
    return record(rows, _numbered(source, ident, F.col("__u"), F.col("__a")), F.col("__u"), F.col("__a"), category, source, language, **optional, **more)


def instruction_pool(df: DataFrame, source: str, ident: str | None = None, language: str = "ar", category: str = "general_instruction") -> DataFrame:
    """instruction, output and perhaps input; a filled input follows the instruction on a line of its own."""
    extra = as_text(F.col("input")) if "input" in df.columns else F.lit("")
    user = F.concat(as_text(F.col("instruction")), F.when(strip(extra) != "", F.concat(F.lit("\n"), extra)).otherwise(""))
    return _pool(df, source, ident, user, as_text(F.col("output")), category, language)


def conversation_pool(df: DataFrame, source: str, ident: str | None = None, language: str = "ar", category: str = "general_instruction", conversations: str = "conversations") -> DataFrame:
    """Turns of speakers, as an array or as its JSON text; conversations of less than two known turns are left out."""
    c = F.col(conversations)
    turns = F.from_json(c, "array<struct<from:string,value:string>>") if dict(df.dtypes)[conversations] == "string" else c
    rows = df.withColumn("__m", from_sharegpt(turns)).where("size(__m) >= 2")
    return rows.select(_numbered(source, ident, F.to_json("__m")).alias("id"), F.col("__m").alias("messages"), F.lit(category).alias("category"), F.lit(source).alias("source"), F.lit(language).alias("language"))


def language_pool(df: DataFrame, source: str, ident: str | None = None, code: str = "arb", language: str = "ar", category: str = "general_instruction") -> DataFrame:
    """inputs, targets of one language code, both filled."""
    return _pool(multilingual_pairs(df, code), source, ident, as_text(F.col("inputs")), as_text(F.col("targets")), category, language)


def dialect_pool(df: DataFrame, source: str, ident: str | None = None, category: str = "general_instruction") -> DataFrame:
    """instruction, input, output, dialect: language and code-switching from the dialect, mixed where it is unknown."""
    user = F.concat(as_text(F.col("instruction")), F.when(strip(as_text(F.col("input"))) != "", F.concat(F.lit("\n"), as_text(F.col("input")))).otherwise(""))
    d = F.lower(F.col("dialect"))
    switching = code_switching(F.concat_ws(" ", user, as_text(F.col("output"))), F.col("dialect"))
    return _pool(df, source, ident, user, as_text(F.col("output")), category, lookup(d, DIALECT_LANGUAGE, "mixed"), switching, script="mixed")


def topic_pool(df: DataFrame, source: str, ident: str | None = None, language: str = "mixed") -> DataFrame:
    """instruction, response, category: the topic gives the category."""
    user, answer = as_text(F.col("instruction")), as_text(F.col("response"))
    return _pool(df, source, ident, user, answer, lookup(F.lower(F.col("category")), TOPIC_CATEGORY, "general_instruction"), language, code_switching(F.concat_ws(" ", user, answer)), script="mixed")


def text_pool(df: DataFrame, source: str, ident: str | None = None, text: str = "text", switching: bool | None = None, language: str = "mixed") -> DataFrame:
    """Running texts as alternating turns; ``switching`` where the whole pool is known to switch."""
    rows = df.withColumn("__m", from_text(F.col(text))).where("__m is not null")
    told = code_switching(F.array_join(F.transform("__m", lambda m: m["content"]), " ")) if switching is None else F.lit(switching)
    return rows.select(_numbered(source, ident, F.to_json("__m")).alias("id"), F.col("__m").alias("messages"), F.lit("general_instruction").alias("category"), F.lit(source).alias("source"), F.lit(language).alias("language"), F.lit("mixed").alias("script"), told.alias("code_switching"))


#: Shapes of pools by name: function (table, source, options) to canonical records.
POOLS = {"instruction": instruction_pool, "conversation": conversation_pool, "language": language_pool, "dialect": dialect_pool, "topic": topic_pool, "text": text_pool}


def load_pool(df: DataFrame, shape: str, source: str, **options) -> DataFrame:
    """Canonical records of a pool of a registered shape."""
    if shape not in POOLS:
        raise ValueError(f"unknown shape {shape}; one of {sorted(POOLS)}")
    return POOLS[shape](df, source, **options)
