"""Audits of pools, selections and records: roll-ups that a report is made of."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamis.functions import classify as C
from tamis.functions.text import blank, strip
from tamis.operators.joins import lookup_join
from tamis.operators.profile import order_statistics
from tamis.operators.sampling import stable_key


def long_counts(df: DataFrame, **facets: Column) -> DataFrame:
    """facet, value, n of several expressions in one pass; null as ``None``. Aggregated in each task before it is shuffled."""
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("facet"), F.coalesce(c.cast("string"), F.lit("None")).alias("value")) for k, c in facets.items()])).alias("p")
    return df.select(pairs).groupBy("p.facet", "p.value").agg(F.count(F.lit(1)).alias("n"))


def capped_histogram(df: DataFrame, value: Column, most: int) -> DataFrame:
    """value, n; all values from ``most`` on are one."""
    return df.groupBy(F.least(value, F.lit(most)).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def pool_audit(df: DataFrame, instruction: str, output: str, source: str | None = None, most: int = 5) -> DataFrame:
    """facet, value, n over a pool of instruction and output: register and capped penalty of both, task of the instruction, malformed rows, sources, and pairs that are repeated."""
    i, o = (F.coalesce(F.col(c), F.lit("")) for c in (instruction, output))
    text = F.concat_ws(" ", i, o)
    rows = df.select(*[c.alias(k) for k, c in C.register_signals(text).items()], C.formal_quality(text)["penalty"].alias("penalty"), C.classify_task(i).alias("task"), (blank(i) | blank(o)).alias("empty"), (F.col(source) if source else F.lit(None).cast("string")).alias("source"))
    told = rows.withColumn("register", C.classify_register({k: F.col(k) for k in ("msa_score", "dialect_score", "arabic_chars", "latin_chars")}))
    out = long_counts(told, register=F.col("register"), penalty=F.least("penalty", F.lit(most)), task=F.col("task"), malformed=F.when(F.col("empty"), "empty_instruction_or_output").otherwise("none"), source=F.col("source"))
    twice = df.groupBy(strip(i).alias("i"), strip(o).alias("o")).agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n"))
    return out.unionByName(twice.select(F.lit("duplicates").alias("facet"), F.lit("exact_pair").alias("value"), "n"))


def class_samples(df: DataFrame, source: str, label: Column, text: str, ident: str, few: int = 5) -> DataFrame:
    """source, label, n, and the first few texts in stable order of every class of every source: of each task only its few go on."""
    rows = df.select(F.col(source).alias("source"), label.alias("label"), F.col(text).alias("text"), stable_key(ident).alias("__k"), F.col(ident).alias("__id"))
    n = rows.groupBy("source", "label").agg(F.count(F.lit(1)).alias("n"))
    first = rows.withColumn("__r", F.row_number().over(Window.partitionBy("source", "label").orderBy("__k", "__id"))).where(F.col("__r") <= few)
    some = first.groupBy("source", "label").agg(F.transform(F.array_sort(F.collect_list(F.struct("__r", "text"))), lambda x: x["text"]).alias("samples"))
    return n.join(some, n["source"].eqNullSafe(some["source"]) & n["label"].eqNullSafe(some["label"])).select(n["source"], n["label"], "n", "samples")


def contributions(df: DataFrame, by: str, tokens: Column) -> DataFrame:
    """``by``, examples, tokens and per cent of all tokens with two digits."""
    g = df.groupBy(by).agg(F.count(F.lit(1)).alias("examples"), F.coalesce(F.sum(tokens), F.lit(0)).alias("tokens"))
    total = g.agg(F.sum("tokens").alias("__all"))
    return g.crossJoin(F.broadcast(total)).withColumn("pct", F.coalesce(F.round(F.try_divide(F.col("tokens") * 100.0, F.col("__all")), 2), F.lit(0.0))).drop("__all")


def selection_check(train: DataFrame, holdout: DataFrame, ident: str = "id", source: str = "source", flag: Column | None = None) -> DataFrame:
    """facet, value, n: rows by part and source, keys on both sides, and rows for which ``flag`` doesn't hold."""
    flag = F.lit(True) if flag is None else F.coalesce(flag, F.lit(False))
    both = train.select(F.lit("train").alias("part"), F.col(source).alias("source"), flag.alias("ok")).unionByName(holdout.select(F.lit("holdout").alias("part"), F.col(source).alias("source"), flag.alias("ok")))
    rows = both.groupBy("part", "source").agg(F.count(F.lit(1)).alias("n")).select(F.col("part").alias("facet"), F.coalesce("source", F.lit("None")).alias("value"), "n")
    shared = train.select(ident).where(F.col(ident).isNotNull()).distinct().join(holdout.select(ident).distinct(), ident, "left_semi").agg(F.count(F.lit(1)).alias("n"))
    unflagged = both.agg(F.count_if(~F.col("ok")).alias("n"))
    return rows.unionByName(shared.select(F.lit("check").alias("facet"), F.lit("overlap").alias("value"), "n")).unionByName(unflagged.select(F.lit("check").alias("facet"), F.lit("unflagged").alias("value"), "n"))


def key_scan(lines: DataFrame) -> DataFrame:
    """path, kind, n over parsed lines (``_raw``, ``v``): every key of the records and of their turns and the kinds of value it has."""
    top = lines.select(F.explode(F.json_object_keys("_raw")).alias("k"), "v").select("k", F.schema_of_variant(F.expr("try_variant_get(v, concat('$[\"', k, '\"]'), 'variant')")).alias("kind"))
    kind = lambda c: F.regexp_extract(c, r"^\w+", 0)
    turns = lines.select(F.explode_outer(F.expr("cast(try_variant_get(v, '$.messages', 'array<variant>') as array<variant>)")).alias("m")).where("m is not null")
    inner = turns.select(F.explode(F.array(*[F.struct(F.lit(f"messages.{f}").alias("k"), F.coalesce(F.schema_of_variant(F.try_variant_get("m", f"$.{f}", "variant")), F.lit("MISSING")).alias("kind")) for f in ("role", "content")])).alias("x")).select("x.k", "x.kind")
    both = top.unionByName(inner)
    return both.groupBy(F.col("k").alias("path"), kind(F.col("kind")).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


def field_presence(df: DataFrame, fields: list[str]) -> DataFrame:
    """field, filled, missing of the columns of a typed table, in one pass."""
    marks = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).isNotNull().alias("there")) for c in fields])).alias("m")
    return df.select(marks).groupBy("m.field").agg(F.count_if("m.there").alias("filled"), F.count_if(~F.col("m.there")).alias("missing"))


def inspect(df: DataFrame, ident: str, columns: list[str], few: int = 5, width: int = 80, seed: int = 42) -> DataFrame:
    """The first few rows in stable order, each value as text of at most ``width`` characters: a preview."""
    some = df.withColumn("__k", stable_key(ident, seed)).orderBy("__k", ident).limit(few)
    return some.select(ident, *[F.left(F.col(c).cast("string"), F.lit(width)).alias(c) for c in columns if c != ident])


def doctor(df: DataFrame, tokens: Column, limit: int, messages: str = "messages") -> DataFrame:
    """finding, n: records that a trainer would cut or stumble over."""
    m, roles = F.col(messages), F.transform(messages, lambda x: x["role"])
    last = F.try_element_at(m, F.lit(-1))
    some = F.coalesce(F.size(m), F.lit(0)) > 0
    tests = {
        "no_messages": ~some,
        "over_limit": tokens > limit,
        "no_answer": some & ~F.coalesce(F.array_contains(roles, "assistant"), F.lit(False)),
        "ends_without_answer": some & ~F.coalesce(last["role"] == "assistant", F.lit(False)),
        "blank_turn": some & F.exists(m, lambda x: blank(F.coalesce(x["content"], F.lit("")))),
        "same_role_twice": some & (F.size(F.filter(F.zip_with(F.slice(roles, F.lit(1), F.greatest(F.size(roles) - 1, F.lit(0))), F.slice(roles, F.lit(2), F.greatest(F.size(roles) - 1, F.lit(0))), lambda a, b: a == b), lambda x: F.coalesce(x, F.lit(False)))) > 0),
        "marker_in_text": some & F.exists(m, lambda x: F.coalesce(x["content"].rlike(r"<\|[a-z_]+\|>|</?s>|\[/?INST\]"), F.lit(False))),
    }
    agg = df.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(k) for k, c in tests.items()])
    return agg.select(F.explode(F.array(*[F.struct(F.lit(k).alias("finding"), F.col(k).alias("n")) for k in tests])).alias("f")).select("f.*")


def language_guess(text: Column) -> Column:
    """A guess from markers alone: ar, arabizi, fr, en, or unknown."""
    low = F.lower(text)
    arabic, latin = F.regexp_count(text, F.lit(r"[؀-ۿ]")), F.regexp_count(text, F.lit(r"[A-Za-z]"))
    spoken = lambda words: F.coalesce(F.regexp_count(low, F.lit(r"(?U)\b(" + "|".join(words) + r")\b")), F.lit(0))
    fr, en, az = spoken(C.FRENCH_COMMON), spoken(ENGLISH_COMMON), spoken(C.TUNISIAN_MARKERS) + F.coalesce(F.regexp_count(low, F.lit(r"(?U)\b[a-z]*[379][a-z]+\b")), F.lit(0))
    return F.when(F.coalesce(arabic, F.lit(0)) > F.coalesce(latin, F.lit(0)), "ar").when((az > fr) & (az > en), "arabizi").when((fr > en) & (fr > 0), "fr").when(en > 0, "en").otherwise("unknown")


# Frequent English words.
ENGLISH_COMMON = ["the", "and", "of", "to", "is", "are", "was", "with", "for", "that", "this", "you", "i", "it", "in", "on", "my", "we", "what", "how"]


def cap_counts(df: DataFrame, key: Column, cap: int, preview: Column) -> DataFrame:
    """template, kept, dropped, preview: what a cap of records a key does to each key."""
    g = df.groupBy(key.alias("template")).agg(F.count(F.lit(1)).alias("n"), F.min(F.left(preview, F.lit(80))).alias("preview"))
    return g.select("template", F.least("n", F.lit(cap)).alias("kept"), F.greatest(F.col("n") - cap, F.lit(0)).alias("dropped"), "preview")


def within_shares(df: DataFrame, group: str, tokens: str, shares: dict[str, float], ident: str = "id", seed: int = 42) -> DataFrame:
    """Rows, in stable order, of which each named group holds at most its share of the tokens of the whole table; groups without a share are left out."""
    from tamis.operators.ranks import prefix_sums

    total = df.agg(F.coalesce(F.sum(tokens), F.lit(0)).alias("__total"))
    limits = df.sparkSession.createDataFrame(list(shares.items()), f"`{group}` string, __share double").crossJoin(total).select(group, F.floor(F.col("__share") * F.col("__total")).alias("__room"))
    named = lookup_join(df.withColumn("__key", stable_key(ident, seed)), limits, [group], salt_by=ident)
    return prefix_sums(named, group, "__key", tokens, ident).where(F.col("before") + F.col(tokens) <= F.col("__room")).drop("__key", "__room", "before")


def length_bands(tokens: Column, edges: list[int]) -> Column:
    """The number of the band between ascending edges, from 0."""
    return sum((F.when(tokens >= e, 1).otherwise(0) for e in edges), F.lit(0))


def token_percentiles(df: DataFrame, value: Column) -> DataFrame:
    """One row: n, p10 to p90, p95, p99, least and most."""
    return order_statistics(df, value, {f"p{q}": q / 100 for q in (10, 25, 50, 75, 90, 95, 99)})
