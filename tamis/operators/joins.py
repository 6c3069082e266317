"""Joins that look at the size of the small side before they choose a way."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamis.session import cut

#: Rows up to which a slim lookup table (a key and a few numbers) is broadcast: tens of MB at most.
BROADCAST_ROWS = 200_000
SALTS = 32
#: A key is hot with more than this share of the rows, so there are at most as many hot keys as its inverse.
HOT_SHARE = 1e-4


def lookup_join(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner", bound: int = BROADCAST_ROWS, salt_by: str | None = None) -> DataFrame:
    """Join a large table to slim unique keys, any of which may hold a third of the large table.

    The small side is counted (no further than the bound). Up to it, it is broadcast and the large
    side stays where it is; beyond it, the keys are repeated ``SALTS`` times and the rows spread
    over the copies by the hash of ``salt_by``, so that no key ends up in one task.
    """
    if small.limit(bound + 1).count() <= bound:
        return big.join(F.broadcast(small), on, how)
    salted = small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return big.withColumn("__salt", F.pmod(F.xxhash64(salt_by or big.columns[0]), F.lit(SALTS)).cast("int")).join(salted, [*on, "__salt"], how).drop("__salt")


def hot_split_join(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join a large table to a large one of unique keys, any of which may hold a third of the first.

    Keys are counted by a partial aggregate. The entries of hot ones, at most 1 / ``HOT_SHARE``, are broadcast, so their
    rows stay where they are; the others are shuffled as usual. ``how`` is inner or left; null keys match nothing.
    """
    counts = big.where(" and ".join(f"`{c}` is not null" for c in on)).groupBy(*on).agg(F.count(F.lit(1)).alias("__n"))
    total = counts.agg(F.sum("__n").alias("__all"))
    hot = cut(counts.crossJoin(F.broadcast(total)).where(F.col("__n") > F.lit(HOT_SHARE) * F.col("__all")).select(*on, F.lit(True).alias("__hot")))
    if hot.isEmpty():
        return big.join(small, on, how)
    tagged = big.join(F.broadcast(hot), on, "left")
    entries = cut(small.join(F.broadcast(hot.select(*on)), on, "left_semi"))
    warm = tagged.where("__hot").drop("__hot").join(F.broadcast(entries), on, how)
    return warm.unionByName(tagged.where("__hot is null").drop("__hot").join(small, on, how))
