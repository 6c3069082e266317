"""Problem 3: dominant contributors and a cap on their records by radix selection.

Score and identifier are encoded as bytes whose order is the order of preference. For every
contributor above its limit the rows are counted by the first undecided byte among those that share
the digits fixed so far; the byte in which the limit falls becomes the next digit of the cutoff.
When all digits are fixed, or the bytes still open are taken whole, each row is kept or not by one
comparison with the cutoff. No group is sorted or gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamis.llm.labels import with_contributor
from tamis.operators.joins import lookup_join
from tamis.session import cut


def quality_score(quality: Column) -> Column:
    """0 (worst) to 53 (best): unflagged before flagged, authored before synthetic, then reviewed, then native; null is in the middle."""

    def three(field: str, good: bool) -> Column:
        v = quality[field]
        return F.when(v.isNull(), 1).when(v == F.lit(good), 2).otherwise(0)

    flagged = F.when(quality["flagged"] == F.lit(True), 0).otherwise(1)
    return (flagged * 27 + three("synthetic", False) * 9 + three("reviewed", True) * 3 + three("native_authored", True)).cast("int")


def _order_hex(col: Column, kind: str, best_first: bool) -> Column:
    """Hex digits whose order is that of ``col``, or its reverse; null comes last in preference."""
    if kind in ("tinyint", "smallint", "int", "bigint"):
        v = col.cast("bigint").bitwiseXOR(F.lit(-(1 << 63)))
        digits = F.lpad(F.hex(v if best_first else F.bitwise_not(v)), 16, "0")
    else:
        digits = F.hex(F.encode(col.cast("string"), "UTF-8"))
        digits = digits if best_first else F.concat(F.translate(digits, "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("FF"))
    return F.coalesce(digits, F.lit(""))


def preference_key(score: Column, ident: Column, ident_kind: str) -> Column:
    """Hex digits of the score (any whole number, null below all) and of the identifier, in the order of preference."""
    scored = F.concat(F.lit("01"), _order_hex(score.cast("bigint"), "bigint", True))
    return F.concat(F.when(score.isNull(), F.lit("00" * 9)).otherwise(scored), _order_hex(ident, ident_kind, False))


def contributor_totals(records: DataFrame, catalog: DataFrame, source: str = "source") -> DataFrame:
    """Rows of each spelling with its contributor; spellings are counted before anything is joined."""
    return with_contributor(records.groupBy(source).agg(F.count(F.lit(1)).alias("rows")), catalog, source)


def every_limit(records: DataFrame, catalog: DataFrame, share: float, source: str = "source") -> DataFrame:
    """contributor, keep: the same share of all rows for every contributor."""
    spelled = contributor_totals(records, catalog, source)
    by = spelled.groupBy("contributor").agg(F.sum("rows").alias("held"))
    total = by.agg(F.coalesce(F.sum("held"), F.lit(0)).alias("total"))
    return by.where("contributor is not null").crossJoin(F.broadcast(total)).select("contributor", F.floor(F.lit(share) * F.col("total")).alias("keep"))


def _shared(a: Column, b: Column) -> Column:
    """The whole bytes (pairs of digits) with which both begin."""
    differs = F.array_position(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: F.coalesce(x != y, F.lit(True))), True)
    n = F.when(differs == 0, F.least(F.length(a), F.length(b))).otherwise(differs - 1)
    return F.substring(a, F.lit(1), (F.floor(n / 2) * 2).cast("int"))


def cutoffs(slim: DataFrame, limits: DataFrame) -> DataFrame:
    """Radix selection over ``slim`` (__c, __key): for each contributor above its limit (__c, left) the digits of its cutoff.

    __c, __cut (where its rows begin to be worse), and __left: how many of the rows that begin with __cut stay, null for all.
    Each round fixes one byte, and those behind it that all rows left share, and the next reads only what agrees with them.
    """
    held = slim.groupBy("__c").agg(F.count(F.lit(1)).alias("held"), F.min("__key").alias("low"), F.max("__key").alias("high"))
    over = held.join(limits, "__c").where("held > left")
    state = cut(over.select("__c", _shared(F.col("low"), F.col("high")).alias("prefix"), "left", ((F.col("left") == 0) | (F.col("low") == F.col("high"))).alias("done")))
    here, first = slim, True
    while not (open_ := state.where("not done").select("__c", "prefix", "left")).isEmpty():
        here = lookup_join(here.select("__c", "__key"), open_, ["__c"], salt_by="__key").where(F.col("__key").startswith(F.col("prefix")))
        here, first = here if first else cut(here), False
        counted = here.groupBy("__c", "prefix", "left", F.substring(F.col("__key"), F.length("prefix") + 1, F.lit(2)).alias("digit")).agg(F.count(F.lit(1)).alias("n"), F.min("__key").alias("low"), F.max("__key").alias("high"))
        better = F.sum("n").over(Window.partitionBy("__c").orderBy(F.desc("digit")).rowsBetween(Window.unboundedPreceding, -1))
        fixed = counted.withColumn("before", F.coalesce(better, F.lit(0))).where("before < left and left <= before + n")
        whole = F.col("left") == F.col("before") + F.col("n")
        step = fixed.select("__c", F.when(whole, F.concat("prefix", "digit")).otherwise(_shared(F.col("low"), F.col("high"))).alias("prefix"), F.when(~whole, F.col("left") - F.col("before")).alias("left"), (whole | (F.col("low") == F.col("high"))).alias("done"))
        state = cut(state.where("done").unionByName(step))
    return state.select("__c", F.col("prefix").alias("__cut"), F.col("left").alias("__left"))


def judge_contributors(records: DataFrame, limits: DataFrame, score: Column, ident: str, contributor: str = "contributor") -> DataFrame:
    """All rows of ``records`` as ``__row`` with ``__c`` and ``__kept``: whether a row stays when each contributor in ``limits`` keeps at most its ``keep`` best.

    ``limits``: contributor, keep. Better is the higher ``score`` (whole numbers, null below all), then the smaller
    ``ident`` (null last). Contributors that aren't in ``limits``, and rows without one, stay whole. Rows equal in
    score and identifier are interchangeable; exactly as many stay as the limit leaves room for. A limit of 0 or
    less keeps nothing, null is no limit.
    """
    kind = dict(records.dtypes)[ident]
    rows = records.select(F.struct(*[F.col(f"`{n}`") for n in records.columns]).alias("__row"), F.col(contributor).alias("__c"), preference_key(score, F.col(ident), kind).alias("__key"))
    slim = cut(rows.select("__c", "__key").where("__c is not null"))
    most = limits.where("keep is not null").select(F.col(contributor).alias("__c"), F.greatest("keep", F.lit(0)).cast("long").alias("left"))
    judged = lookup_join(rows, cutoffs(slim, most), ["__c"], how="left", salt_by="__key").withColumn("__head", F.substring(F.col("__key"), F.lit(1), F.length("__cut")))
    level = (F.col("__head") == F.col("__cut")) & (F.col("__left") > 0)
    kept = F.col("__cut").isNull() | (F.col("__head") > F.col("__cut")) | ((F.col("__head") == F.col("__cut")) & F.col("__left").isNull())
    sure = judged.where(~F.coalesce(level, F.lit(False))).select("__row", "__c", kept.alias("__kept"))
    # equal ones are counted, not sorted: copies in a partial aggregate, different rows by sums over two levels
    same = judged.where(level).groupBy("__c", "__left", "__row").agg(F.count(F.lit(1)).alias("n")).withColumns({"h": F.xxhash64("__row"), "bucket": F.pmod(F.xxhash64("__row"), F.lit(1024))})
    up_to = lambda *by: F.coalesce(F.sum("n").over(Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    base = same.groupBy("__c", "bucket").agg(F.sum("n").alias("n")).withColumn("base", up_to("__c", "bucket")).select("__c", "bucket", "base")
    placed = same.withColumn("inside", up_to("__c", "bucket", "h")).join(base, ["__c", "bucket"])
    room = F.col("__left") - F.col("base") - F.col("inside")
    equal = placed.withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))).select("__row", "__c", (F.col("i") <= room).alias("__kept"))
    return sure.unionByName(equal)


def cap_contributors(records: DataFrame, limits: DataFrame, score: Column, ident: str, contributor: str = "contributor") -> DataFrame:
    """The rows that stay by ``judge_contributors``, with all their columns."""
    return judge_contributors(records, limits, score, ident, contributor).where("__kept").select("__row.*")
