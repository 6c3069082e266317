"""Profiles: distributions, order statistics, shares and cross tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamis.functions.messages import record_chars, tokens_assistant, tokens_total


def counts(df: DataFrame, value: Column, top: int | None = None) -> DataFrame:
    """value, n; null as ``None``; ordered by count, then value, where ``top`` limits it."""
    out = df.groupBy(F.coalesce(value.cast("string"), F.lit("None")).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return out if top is None else out.orderBy(F.desc("n"), "value").limit(top)


def distributions(df: DataFrame, columns: list[str]) -> DataFrame:
    """field, value, n of several columns in one pass: one row a field is aggregated before it is shuffled."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.coalesce(F.col(c).cast("string"), F.lit("None")).alias("value")) for c in columns])).alias("p")
    return df.select(pairs).groupBy("p.field", "p.value").agg(F.count(F.lit(1)).alias("n"))


def dataset_profile(df: DataFrame, ident: str = "id") -> DataFrame:
    """One row: examples, average turns, characters (average, least, most), estimated tokens, code-switched rows, rows of repeated ids."""
    chars = record_chars(F.col("messages"))
    base = df.select(F.col(ident).alias("id"), F.greatest(F.coalesce(F.size("messages"), F.lit(0)), F.lit(0)).alias("turns"), chars.alias("chars"), F.coalesce("code_switching", F.lit(False)).alias("cs"))
    agg = base.agg(
        F.count(F.lit(1)).alias("examples"), F.avg("turns").alias("avg_messages"), F.avg("chars").alias("avg_chars"), F.min("chars").alias("min_chars"), F.max("chars").alias("max_chars"),
        F.floor(F.coalesce(F.sum("chars"), F.lit(0)) / 4).cast("long").alias("approx_tokens"), F.count_if("cs").alias("code_switching"),
    )
    dup = base.where("id is not null and id <> ''").groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_ids"))
    return agg.crossJoin(F.broadcast(dup))


def audit(df: DataFrame, by: list[str], tokens: Column) -> DataFrame:
    """Count, tokens and share of tokens of each group."""
    g = df.select(*by, tokens.alias("t")).groupBy(*by).agg(F.count(F.lit(1)).alias("examples"), F.sum("t").alias("tokens"))
    total = g.agg(F.sum("tokens").alias("__all"))
    return g.crossJoin(F.broadcast(total)).withColumn("token_share", F.coalesce(F.try_divide(F.col("tokens"), F.col("__all")), F.lit(0.0))).drop("__all")


def order_statistics(df: DataFrame, value: Column, quantiles: dict[str, float], by: list[str] = ()) -> DataFrame:
    """``sorted[int(n * q)]`` of each group for several q, from the counts of distinct values.

    Only distinct values are ordered, never the rows: a window over them gives for each the places it
    takes. Values such as lengths have few; for others the group is a parameter to think about.
    """
    keys = list(by)
    c = df.select(*keys, value.alias("v")).where("v is not null").groupBy(*keys, "v").agg(F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("v")
    placed = c.withColumn("hi", F.sum("c").over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("n", F.sum("c").over(Window.partitionBy(*(keys or [F.lit(0)]))))
    picks = [F.max(F.when((F.floor(F.col("n") * F.lit(q)) < F.col("hi")) & (F.floor(F.col("n") * F.lit(q)) >= F.col("hi") - F.col("c")), F.col("v"))).alias(name) for name, q in quantiles.items()]
    return placed.groupBy(*keys).agg(F.max("n").alias("n"), *picks, F.min("v").alias("least"), F.max("v").alias("most"))


def exceedance(df: DataFrame, value: Column, thresholds: list[int]) -> DataFrame:
    return df.select(value.alias("v")).agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col("v") > t).alias(f"over_{t}") for t in thresholds])


def crosstab(df: DataFrame, row: str, column: str, values: list[str]) -> DataFrame:
    """Counts of ``row`` by the given values of ``column`` and the share of each in its row."""
    g = df.groupBy(row).agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(column) == v).alias(f"n_{v}") for v in values])
    return g.select("*", *[(F.col(f"n_{v}") / F.col("rows")).alias(f"share_{v}") for v in values])


def group_sizes(df: DataFrame, key: Column) -> DataFrame:
    """One row: distinct groups, rows, the largest group, rows in groups of more than one."""
    g = df.select(key.alias("k")).groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    return g.agg(F.count(F.lit(1)).alias("groups"), F.sum("n").alias("rows"), F.max("n").alias("largest"), F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("rows_in_groups"))


def duplicate_groups(df: DataFrame, keys: list[Column]) -> DataFrame:
    """One row: groups of equal keys with several rows, and their rows."""
    g = df.select(*[k.alias(f"k{i}") for i, k in enumerate(keys)]).groupBy(*[f"k{i}" for i in range(len(keys))]).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return g.agg(F.count(F.lit(1)).alias("groups"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))


def template_inventory(df: DataFrame, key: Column, text: Column) -> DataFrame:
    """Rows and an 80-character preview of each template."""
    g = df.select(key.alias("template"), F.left(text, F.lit(80)).alias("p")).groupBy("template").agg(F.count(F.lit(1)).alias("n"), F.min("p").alias("preview"))
    return g


def shares(df: DataFrame, by: str, target: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Actual against intended share (``by``, share): OVER, UNDER or OK."""
    n = df.groupBy(by).agg(F.count(F.lit(1)).alias("n"))
    both = target.join(n, by, "left").withColumn("n", F.coalesce("n", F.lit(0)))
    total = both.agg(F.sum("n").alias("__t"))
    a = both.crossJoin(F.broadcast(total)).withColumn("actual", F.coalesce(F.try_divide(F.col("n"), F.col("__t")), F.lit(0.0))).drop("__t")
    gap = F.col("actual") - F.col("share")
    return a.withColumn("status", F.when(gap > tolerance, "OVER").when(gap < -tolerance, "UNDER").otherwise("OK"))


def token_columns(df: DataFrame, messages: str = "messages") -> DataFrame:
    return df.withColumns({"tokens_total": tokens_total(F.col(messages)), "tokens_assistant": tokens_assistant(F.col(messages))})


def reduction(source: DataFrame, derived: DataFrame, tokens: Column) -> DataFrame:
    """One row: rows and tokens of both, and by how much they fell, in percent."""
    a = source.agg(F.count(F.lit(1)).alias("source_rows"), F.coalesce(F.sum(tokens), F.lit(0)).alias("source_tokens"))
    b = derived.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(tokens), F.lit(0)).alias("tokens"))
    both = a.crossJoin(F.broadcast(b))
    pct = lambda x, y: F.coalesce(F.try_divide((F.col(x) - F.col(y)) * 100.0, F.col(x)), F.lit(0.0))
    return both.withColumns({"rows_pct": pct("source_rows", "rows"), "tokens_pct": pct("source_tokens", "tokens")})
