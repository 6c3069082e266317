"""Order statistics of groups of any size: running sums and first rows without a sort of a whole group.

Keys are hex hashes, so their first digits part the rows of a group evenly. A histogram over these digits says in
which part a place lies, and only that part is looked at row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamis.operators.joins import lookup_join
from tamis.session import cut

#: First hex digits of a key that part a group: up to 65,536 parts.
DIGITS = 4


def _before(value: str, by: list[str], order: list[str]) -> Column:
    return F.coalesce(F.sum(value).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def prefix_sums(df: DataFrame, group: str, key: str, value: str, ident: str) -> DataFrame:
    """Adds ``before``: the sum of the values of the group's rows that come earlier."""
    b = df.withColumn("__b", F.substring(key, 1, DIGITS))
    sums = b.groupBy(group, "__b").agg(F.sum(value).alias("__s"))
    base = sums.withColumn("__base", _before("__s", [group], ["__b"])).drop("__s")
    inside = b.withColumn("__in", _before(value, [group, "__b"], [key, ident]))
    return inside.join(base, [group, "__b"]).withColumn("before", F.col("__base") + F.col("__in")).drop("__b", "__in", "__base")


def kth_keys(keyed: DataFrame, quotas: DataFrame, group: str, key: str, skip: int = 0) -> DataFrame:
    """``group``, t, spare, over: the rows with a key below ``t`` and ``spare`` of those at ``t`` are the group's first ``quota`` rows, ``over`` more are at ``t``.

    ``t`` is ``~``, beyond all keys, for groups that have no more rows than their quota. ``skip`` digits at the start of the keys don't part them evenly and count beside ``DIGITS``.
    """
    slim = keyed.select(group, F.col(key).alias("__k"), F.substring(key, 1, DIGITS + skip).alias("__b"))
    hist = cut(slim.groupBy(group, "__b").agg(F.count(F.lit(1)).alias("n")))
    placed = hist.withColumn("before", _before("n", [group], ["__b"])).join(quotas.select(group, F.col("quota").cast("long").alias("quota")), group)
    whole = placed.groupBy(group).agg(F.sum("n").alias("all"), F.max("quota").alias("quota")).where("all <= quota").select(group, F.lit("~").alias("t"), F.lit(0).cast("long").alias("spare"), F.lit(0).cast("long").alias("over"))
    none = placed.where("quota <= 0").select(group, F.lit("").alias("t"), F.lit(0).cast("long").alias("spare"), F.lit(0).cast("long").alias("over")).distinct()
    edge = cut(placed.where("before < quota and quota < before + n or quota = before + n").join(whole.select(group), group, "left_anti").select(group, "__b", (F.col("quota") - F.col("before")).alias("need")))
    near = lookup_join(slim, edge, [group, "__b"], salt_by="__k").groupBy(group, "need", "__k").agg(F.count(F.lit(1)).alias("n")).withColumn("before", _before("n", [group], ["__k"]))
    at = near.where("before < need and need <= before + n").select(group, F.col("__k").alias("t"), (F.col("need") - F.col("before")).alias("spare"), (F.col("n") + F.col("before") - F.col("need")).alias("over"))
    return cut(whole.unionByName(none.join(whole.select(group), group, "left_anti")).unionByName(at))


def mark_first(df: DataFrame, quotas: DataFrame, group: str, key: Column, ident: str, to: str, skip: int = 0) -> DataFrame:
    """Adds ``to``: whether a row is among the first ``quota`` of its group (``quotas``: group, quota; none without) by the hex digits of ``key``.

    Rows with the same key are repeated; as many of them are taken as there is room for, by ``ident``.
    """
    keyed = df.withColumn("__key", key)
    cuts = kth_keys(keyed, quotas, group, "__key", skip)
    judged = lookup_join(keyed, cuts, [group], "left", salt_by="__key")
    split = F.coalesce((F.col("__key") == F.col("t")) & (F.col("over") > 0), F.lit(False))
    out = [*df.columns, to]
    plain = judged.withColumn(to, F.coalesce((F.col("__key") < F.col("t")) | (F.col("__key") == F.col("t")), F.lit(False)))
    if cuts.where("over > 0").isEmpty():
        return plain.select(*out)
    few = judged.where(split).withColumn("__r", F.row_number().over(Window.partitionBy(group).orderBy(ident)))
    return plain.where(~split).select(*out).unionByName(few.withColumn(to, F.col("__r") <= F.col("spare")).select(*out))
