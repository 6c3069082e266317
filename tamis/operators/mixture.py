"""Checks of a mixture of slices, and of leakage between tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamis.operators.dedup import word_shingles
from tamis.operators.joins import lookup_join
from tamis.session import cut, spread
from tamis.spec import MixtureSpec


def slice_report(df: DataFrame, spec: MixtureSpec, column: str = "slice") -> DataFrame:
    """slice, share, purpose, examples, actual_share of declared and found slices; share is null for undeclared ones."""
    spark = df.sparkSession
    declared = spark.createDataFrame([(k, float(v), spec.purposes.get(k, "")) for k, v in spec.shares.items()], "slice string, share double, purpose string")
    n = df.groupBy(F.col(column).alias("slice")).agg(F.count(F.lit(1)).alias("examples"))
    both = declared.join(n, "slice", "full").withColumn("examples", F.coalesce("examples", F.lit(0)))
    total = both.agg(F.sum("examples").alias("__t"))
    return both.crossJoin(F.broadcast(total)).withColumn("actual_share", F.coalesce(F.try_divide(F.col("examples"), F.col("__t")), F.lit(0.0))).drop("__t")


def mixture_violations(df: DataFrame, spec: MixtureSpec, column: str = "slice", retention: str = "retention", holdout: DataFrame | None = None, requested: dict[str, int] | None = None, ident: str = "id") -> DataFrame:
    """slice, violation, detail: everything that keeps the data from being the declared mixture."""
    spark = df.sparkSession
    rep = slice_report(df, spec, column)
    rows = [("", "spec", p) for p in spec.problems()]
    out = spark.createDataFrame(rows, "slice string, violation string, detail string")
    out = out.unionByName(rep.where("share is null").select("slice", F.lit("undeclared_slice").alias("violation"), F.col("examples").cast("string").alias("detail")))
    out = out.unionByName(rep.where("share is not null and examples = 0").select("slice", F.lit("empty_slice").alias("violation"), F.lit("no examples").alias("detail")))
    if requested:
        want = spark.createDataFrame(list(requested.items()), "slice string, wanted long")
        out = out.unionByName(rep.join(F.broadcast(want), "slice").where("wanted > examples").select("slice", F.lit("infeasible_count").alias("violation"), F.concat_ws(" of ", F.col("examples").cast("string"), F.col("wanted").cast("string")).alias("detail")))
    foreign = df.where((F.col(column) == retention) & ~F.coalesce(F.col("language") == "en", F.lit(False))).groupBy(F.col(column).alias("slice")).agg(F.count(F.lit(1)).alias("n"))
    out = out.unionByName(foreign.select("slice", F.lit("retention_not_english").alias("violation"), F.col("n").cast("string").alias("detail")))
    if holdout is not None:
        leaked = df.join(holdout.select(ident).distinct(), ident, "left_semi").groupBy(F.col(column).alias("slice")).agg(F.count(F.lit(1)).alias("n"))
        out = out.unionByName(leaked.select("slice", F.lit("holdout_leak").alias("violation"), F.col("n").cast("string").alias("detail")))
    return out


def leaked(a: DataFrame, b: DataFrame, on: str = "id") -> DataFrame:
    """Distinct keys that stand in both tables. Keys are made distinct before they meet, so a hot one is one row a side."""
    return a.select(on).where(F.col(on).isNotNull()).distinct().join(b.select(on).distinct(), on, "left_semi")


def leak_summary(a: DataFrame, b: DataFrame, on: str = "id", examples: int = 5) -> DataFrame:
    """One row: how many keys leak, and the first few in order."""
    keys = leaked(a, b, on)
    few = keys.orderBy(on).limit(examples).agg(F.array_sort(F.collect_list(F.col(on).cast("string"))).alias("examples"))
    return keys.agg(F.count(F.lit(1)).alias("leaked")).crossJoin(F.broadcast(few)).withColumn("examples", F.array_join("examples", ","))


def without(df: DataFrame, ids: DataFrame, on: str = "id") -> DataFrame:
    """Rows whose key is not in ``ids``."""
    return df.join(ids.select(on).distinct(), on, "left_anti")


def pairwise_overlap(df: DataFrame, split: str, key: Column) -> DataFrame:
    """split_a, split_b, shared: distinct keys that two splits share. Splits of a key are gathered as a small set first."""
    sets = df.select(key.alias("k"), F.col(split).alias("s")).where("s is not null").distinct().groupBy("k").agg(F.array_sort(F.collect_set("s")).alias("ss")).where("size(ss) > 1")
    pairs = sets.select(F.explode("ss").alias("split_a"), "ss").select("split_a", F.explode("ss").alias("split_b")).where("split_a < split_b")
    return pairs.groupBy("split_a", "split_b").agg(F.count(F.lit(1)).alias("shared"))


def line_overlap(df: DataFrame, split: str, line: Column) -> DataFrame:
    """split_a, split_b, shared: distinct whole lines (or records as text) that stand in two splits, by their hash."""
    return pairwise_overlap(df, split, F.sha2(line, 256))


def key_relation(a: DataFrame, b: DataFrame, on: str = "id") -> DataFrame:
    """One row on the distinct keys of two tables: only_a, only_b, shared, subset (all of a in b), equal."""
    side = lambda df, n: df.select(F.col(on).alias("k")).where("k is not null").distinct().withColumn(n, F.lit(1))
    n = side(a, "a").join(side(b, "b"), "k", "full").agg(F.count_if(F.col("b").isNull()).alias("only_a"), F.count_if(F.col("a").isNull()).alias("only_b"), F.count_if(F.col("a").isNotNull() & F.col("b").isNotNull()).alias("shared"))
    return n.withColumns({"subset": F.col("only_a") == 0, "equal": (F.col("only_a") == 0) & (F.col("only_b") == 0)})


def union_keys(*tables: DataFrame, on: str = "id") -> DataFrame:
    """The distinct keys of all tables."""
    out = None
    for t in tables:
        k = t.select(on).where(F.col(on).isNotNull())
        out = k if out is None else out.unionByName(k)
    return out.distinct()


def sub_corpora(df: DataFrame, column: str, include: list[str] | None = None, exclude: list[str] = ()) -> DataFrame:
    """Rows of the listed sub-corpora, or of all but the excluded ones; rows without a name are of none that is listed or excluded."""
    out = df if include is None else df.where(F.coalesce(F.col(column).isin(*include), F.lit(False)))
    return out.where(~F.coalesce(F.col(column).isin(*exclude), F.lit(False))) if exclude else out


def code_switched(df: DataFrame) -> DataFrame:
    """Rows that say they switch languages."""
    return df.where(F.coalesce("code_switching", F.lit(False)))


def zip_rows(a: DataFrame, b: DataFrame, row: str) -> DataFrame:
    """Two tables row by row over their row number; raises where one has rows that the other lacks."""
    lost = a.select(row).join(b.select(F.col(row).alias("__b")), F.col(row) == F.col("__b"), "full").where(F.col(row).isNull() | F.col("__b").isNull()).limit(1).count()
    if lost:
        raise ValueError("the tables don't have the same rows")
    return a.join(b, row)


def is_subset(a: DataFrame, b: DataFrame, on: str = "id") -> bool:
    return bool(key_relation(a, b, on).first()["subset"])


def same_keys(a: DataFrame, b: DataFrame, on: str = "id") -> bool:
    return bool(key_relation(a, b, on).first()["equal"])


def shared_shingles(docs: DataFrame, items: DataFrame, doc: str, text: str, item: str, item_text: str, n: int = 8) -> DataFrame:
    """``doc``, ``item``, shared: distinct runs of n words of an item that a document holds.

    The items' runs are counted and broadcast; more of them are salted, as a run may stand in a third of the documents.
    """
    # the outer form: a filter inferred from the inner one would work the runs out twice
    d = spread(docs.select(doc, text)).select(F.col(doc), F.explode_outer(word_shingles(F.col(text), n)).alias("s")).where("s is not null")
    i = cut(items.select(F.col(item), F.explode(word_shingles(F.col(item_text), n)).alias("s")))
    return lookup_join(d, i, ["s"], salt_by=doc).groupBy(doc, item).agg(F.count(F.lit(1)).alias("shared"))
