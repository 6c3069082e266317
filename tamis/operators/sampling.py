"""Deterministic samples, splits and caps.

Every order comes from a hash of seed and key, so a result depends neither on the order of the input nor
on its partitions. Quotas of strata are small aggregates; the first rows of a stratum are found by a histogram
of its keys (``ranks.mark_first``), so no stratum is sorted in one task however many rows it has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamis.operators.joins import lookup_join
from tamis.operators.ranks import mark_first, prefix_sums


def stable_key(ident: Column | str, seed: int = 42) -> Column:
    """Hex hash of ``seed:id``."""
    c = F.col(ident) if isinstance(ident, str) else ident
    return F.sha2(F.concat(F.lit(f"{seed}:"), c.cast("string")), 256)


def scale_targets(targets: dict[str, int], scale: float) -> dict[str, int]:
    if scale <= 0:
        raise ValueError("the scale must be positive")
    return dict(targets) if scale == 1.0 else {k: max(1, round(v * scale)) for k, v in targets.items()}


def largest_remainder(weights: DataFrame, stratum: str, weight: str, total: int | Column) -> DataFrame:
    """``stratum``, quota: whole shares of ``total`` in proportion to the weights; what is left goes to the largest fractions, ties to the greater name."""
    t = F.lit(total) if isinstance(total, int) else total
    everything = Window.partitionBy(F.lit(0))
    exact = weights.select(stratum, (t * F.col(weight).cast("double") / F.sum(F.col(weight).cast("double")).over(everything)).alias("x"))
    floor = exact.select(stratum, F.floor("x").alias("base"), (F.col("x") - F.floor("x")).alias("frac"))
    ranked = floor.withColumn("left", t - F.sum("base").over(everything)).withColumn("r", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("frac"), F.desc(stratum))))
    return ranked.select(stratum, (F.col("base") + F.when(F.col("r") <= F.col("left"), 1).otherwise(0)).cast("long").alias("quota"))


def top_k(df: DataFrame, k: int, seed: int = 42, ident: str = "id") -> DataFrame:
    """The k rows that come first in the stable order; a top-k, not a sort."""
    return df.withColumn("__k", stable_key(ident, seed)).orderBy("__k", ident).limit(k).drop("__k")


def _all(df: DataFrame, quota: int) -> DataFrame:
    """A quota for one stratum of all rows."""
    return df.sparkSession.createDataFrame([(0, quota)], "__all int, quota long")


def split_exact(df: DataFrame, holdout: int, seed: int = 42, ident: str = "id") -> DataFrame:
    """Adds ``part``: holdout for the first that many rows in stable order, train for the rest."""
    if holdout < 0:
        raise ValueError("the holdout is negative")
    if df.count() < holdout:
        raise ValueError(f"{holdout} rows asked for, fewer are there")
    marked = mark_first(df.withColumn("__all", F.lit(0)), _all(df, holdout), "__all", stable_key(ident, seed), ident, "__in")
    return marked.withColumn("part", F.when(F.col("__in"), "holdout").otherwise("train")).drop("__all", "__in")


def take_by_quota(df: DataFrame, quotas: DataFrame, stratum: str, seed: int = 42, ident: str = "id") -> DataFrame:
    """Rows that are among the first of their stratum within its ``quota``, in stable order."""
    return mark_first(df, quotas, stratum, stable_key(ident, seed), ident, "__in").where("__in").drop("__in")


def _strata(df: DataFrame, stratum: str, missing: str = "__unknown__") -> tuple[DataFrame, DataFrame]:
    """The table with its stratum as ``__s``, and the rows of each as n."""
    named = df.withColumn("__s", F.coalesce(F.col(stratum).cast("string"), F.lit(missing)))
    return named, named.groupBy("__s").agg(F.count(F.lit(1)).alias("n"))


def stratified_split(df: DataFrame, holdout: int, stratum: str, seed: int = 42, ident: str = "id", missing: str = "__unknown__") -> DataFrame:
    """Adds ``part``: the holdout is apportioned to the strata by largest remainder and taken in stable order."""
    named, sizes = _strata(df, stratum, missing)
    marked = mark_first(named, largest_remainder(sizes, "__s", "n", holdout), "__s", stable_key(ident, seed), ident, "__in")
    return marked.withColumn("part", F.when(F.col("__in"), "holdout").otherwise("train")).drop("__s", "__in")


def group_stratified_split(df: DataFrame, holdout: int, group: str, seed: int = 42, ident: str = "id") -> DataFrame:
    """The same inside groups: records of one group may fall on both sides."""
    return stratified_split(df, holdout, group, seed, ident, "__no_group__")


def group_holdout(df: DataFrame, holdout: int, group: str, seed: int = 42) -> DataFrame:
    """Adds ``part``, keeping groups whole: groups in stable order as long as their rows fit into the holdout."""
    named = df.withColumn("__g", F.coalesce(F.col(group).cast("string"), F.lit("__no_group__")))
    sizes = named.groupBy("__g").agg(F.count(F.lit(1)).alias("n")).withColumns({"__k": stable_key("__g", seed), "__all": F.lit(0)})
    run = prefix_sums(sizes, "__all", "__k", "n", "__g").select("__g", (F.col("before") + F.col("n") <= holdout).alias("__h"))
    return lookup_join(named, run, ["__g"]).withColumn("part", F.when(F.col("__h"), "holdout").otherwise("train")).drop("__g", "__h")


def ratio_split(df: DataFrame, ratio: float, stratum: str, seed: int = 42, ident: str = "id") -> DataFrame:
    """Adds ``part``: a share of every stratum, one row at least, is held out."""
    named, sizes = _strata(df, stratum)
    quotas = sizes.select("__s", F.greatest(F.lit(1), F.floor(F.col("n") * F.lit(ratio))).cast("long").alias("quota"))
    marked = mark_first(named, quotas, "__s", stable_key(ident, seed), ident, "__in")
    return marked.withColumn("part", F.when(F.col("__in"), "holdout").otherwise("train")).drop("__s", "__in")


def three_way_split(df: DataFrame, stratum: str, val: float = 0.05, test: float = 0.05, seed: int = 42, ident: str = "id") -> DataFrame:
    """Adds ``part``: train, val and test in each stratum, sizes by half-even rounding."""
    named, sizes = _strata(df, stratum)
    nv, nt = F.bround(F.col("n") * F.lit(val)).cast("long"), F.bround(F.col("n") * F.lit(test)).cast("long")
    key = stable_key(ident, seed)
    marked = mark_first(mark_first(named, sizes.select("__s", nv.alias("quota")), "__s", key, ident, "__v"), sizes.select("__s", (nv + nt).alias("quota")), "__s", key, ident, "__t")
    return marked.withColumn("part", F.when(F.col("__v"), "val").when(F.col("__t"), "test").otherwise("train")).drop("__s", "__v", "__t")


def source_diverse_by(df: DataFrame, needs: dict[str, int], group: str, max_share: float, source: str = "source", seed: int = 42, ident: str = "id") -> DataFrame:
    """Of each named group so many rows in stable order, at most a share of them from each source, filled up from what is left."""
    plan = [(g, n, max(1, int(n * max_share)) if 0 < max_share < 1 else n) for g, n in needs.items()]
    wanted = df.sparkSession.createDataFrame(plan, "__g string, quota long, __cap long")
    named = df.withColumns({"__g": F.col(group).cast("string"), "__s": F.concat_ws("\1", F.col(group).cast("string"), F.coalesce(F.col(source).cast("string"), F.lit("")))}).where(F.col("__g").isin(*needs))
    caps = named.select("__g", "__s").distinct().join(F.broadcast(wanted), "__g").select("__s", F.col("__cap").alias("quota"))  # a row for each group named
    key = stable_key(ident, seed)
    under = mark_first(named, caps, "__s", key, ident, "__in")
    # those within the cap come first
    first = F.concat(F.when(F.col("__in"), "0").otherwise("1"), key)
    return mark_first(under, wanted.select("__g", "quota"), "__g", first, ident, "__first", skip=1).where("__first").drop("__g", "__s", "__in", "__first")


def source_diverse(df: DataFrame, need: int, max_share: float, source: str = "source", seed: int = 42, ident: str = "id") -> DataFrame:
    """The same for all rows as one group."""
    return source_diverse_by(df.withColumn("__all", F.lit("")), {"": need}, "__all", max_share, source, seed, ident).drop("__all")


def cap_per(df: DataFrame, key: Column, cap: int, order: list[Column | str], only: Column | None = None) -> DataFrame:
    """At most ``cap`` rows of each key, first in order; with ``only``, other rows stay as they are."""
    placed = df.withColumn("__key", key).withColumn("__r", F.row_number().over(Window.partitionBy("__key").orderBy(*order)))
    keep = F.col("__r") <= cap
    return placed.where(keep if only is None else ~F.coalesce(only, F.lit(False)) | keep).drop("__key", "__r")


def cap_passages(df: DataFrame, text: Column, cap: int, order: list[Column | str], ident: str = "id") -> DataFrame:
    """At most ``cap`` rows of each passage; a blank passage is a group of its own."""
    key = F.when(F.coalesce(text, F.lit("")) == "", F.concat(F.lit("row:"), F.col(ident).cast("string"))).otherwise(F.sha2(text, 256))
    return cap_per(df, key, cap, order)


def proportional_last(weights: DataFrame, stratum: str, weight: str, total: int) -> DataFrame:
    """Whole shares rounded down; the last stratum by name takes the rest."""
    everything = Window.partitionBy(F.lit(0))
    base = weights.select(stratum, F.floor(F.lit(total) * F.col(weight) / F.sum(weight).over(everything)).cast("long").alias("b"))
    last = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc(stratum))) == 1
    return base.select(stratum, F.when(last, F.lit(total) - F.sum("b").over(everything) + F.col("b")).otherwise(F.col("b")).alias("quota"))


def downsample_class(df: DataFrame, column: str, value: str, fraction: float, stratum: str = "category", seed: int = 42, ident: str = "id") -> DataFrame:
    """All rows of other classes, and a fraction of one, apportioned over ``stratum``."""
    chosen = df.where(F.col(column) == value)
    n = chosen.count()
    part = stratified_split(chosen, int(fraction * n + 0.5), stratum, seed, ident).where("part = 'holdout'").drop("part")
    return df.where((F.col(column) != value) | F.col(column).isNull()).unionByName(part)


def audit_sample(df: DataFrame, category: str, tag: Column, per: int = 200, seed: int = 42, ident: str = "id") -> DataFrame:
    """Up to ``per`` rows of each category, tagged again: category, sampled, agreeing, accuracy."""
    some = cap_per(df, F.col(category), per, [stable_key(ident, seed), F.col(ident)])
    g = some.groupBy(category).agg(F.count(F.lit(1)).alias("sampled"), F.count_if(tag == F.col(category)).alias("agreeing"))
    return g.withColumn("accuracy", F.col("agreeing") / F.col("sampled"))
