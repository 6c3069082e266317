"""Selections that fill token budgets with whole records.

The greedy fill takes records in stable order while the total stays below the upper bound and stops in
the band around the target. Where no record is larger than the band, none is ever skipped, and the fill is
a prefix sum: ``before < lower``. The prefix sum has two levels, so that no group is ordered in one task.
Where larger records exist, the slim rows up to the place where the small ones alone reach the band are
taken in rounds of such sums; a fold in one task sees only the few that are left.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamis.functions.messages import last_of, template_key, tokens_assistant, tokens_total
from tamis.operators.joins import lookup_join
from tamis.operators.ranks import prefix_sums
from tamis.operators.sampling import cap_per, scale_targets, source_diverse, source_diverse_by, stable_key, stratified_split
from tamis.session import cut
from tamis.spec import RetentionSpec


class SelectionError(ValueError):
    """Too few candidates for what the plan asks."""


#: Slim rows (group, id, key, value) up to which what is left of a fold goes through one task a group.
FOLD_ROWS = 500_000


def take_fitting(slim: DataFrame, state: DataFrame, group: str, fold_rows: int = FOLD_ROWS) -> DataFrame:
    """``group`` and ``__id`` of the rows that are taken when each group's rows are visited in order of ``__key``.

    ``slim``: group, __id, __key (hex hash), __v. ``state``: group, acc (taken so far), room, stop. A row is
    taken while ``acc < stop`` where ``acc + v <= room``; others are passed over. In a round, all rows that
    still fit on their own are summed up in order; those before the first that overflows are taken at
    once, and the next round goes on behind it with less room. Sums run over two levels, so no group is
    ordered in one task; only when few candidates are left do they go through a streaming fold.
    """
    kinds = dict(slim.dtypes)
    spark = slim.sparkSession
    state = cut(state.select(group, F.col("acc").cast("double").alias("acc"), F.col("room").cast("double").alias("room"), F.col("stop").cast("double").alias("stop"), F.lit("").alias("pos")))
    chosen = spark.createDataFrame([], f"`{group}` {kinds[group]}, __id {kinds['__id']}")

    def fold(batches: Iterator) -> Iterator:
        import pandas as pd

        now, acc = None, 0.0
        for b in batches:
            keep = []
            for g, v, a, room, stop in zip(b[group], b["__v"], b["acc"], b["room"], b["stop"]):
                if g != now:
                    now, acc = g, a
                take = acc < stop and acc + v <= room
                acc += v if take else 0.0
                keep.append(take)
            yield b.loc[pd.Series(keep, index=b.index, dtype=bool), [group, "__id"]]

    left = slim
    while True:
        left = lookup_join(left, state, [group], salt_by="__id").where("acc < stop and __key > pos and __v <= room - acc")
        if left.limit(fold_rows + 1).count() <= fold_rows:
            ordered = left.repartition(group).sortWithinPartitions(group, "__key", "__id")
            return chosen.unionByName(ordered.mapInPandas(fold, f"`{group}` {kinds[group]}, __id {kinds['__id']}"))
        placed = cut(prefix_sums(left, group, "__key", "__v", "__id"))
        bad = (F.col("acc") + F.col("before") + F.col("__v") > F.col("room")) | (F.col("acc") + F.col("before") >= F.col("stop"))
        first = placed.where(bad).groupBy(group).agg(F.min("__key").alias("__bad"))
        taken = cut(lookup_join(placed, first, [group], "left", salt_by="__id").where("__bad is null or __key < __bad").select(group, "__id", "__v"))
        chosen = chosen.unionByName(taken.select(group, "__id"))
        sums = taken.groupBy(group).agg(F.sum("__v").alias("__s"))
        # keys are distinct, so what is at the key of the first that overflows is that row
        state = cut(state.join(sums, group, "left").join(first, group, "inner").select(group, (F.col("acc") + F.coalesce("__s", F.lit(0.0))).alias("acc"), "room", "stop", F.col("__bad").alias("pos")))
        left = slim


def greedy_fill(pool: DataFrame, targets: DataFrame, group: str, value: str, tolerance: float, seed: int = 42, ident: str = "id", fold_rows: int = FOLD_ROWS) -> DataFrame:
    """The rows of ``pool`` that fill the target of their group (``group``, target); all columns come back.

    Rows of no value are passed over; groups without or with a non-positive target get nothing. Rows with one
    identifier are visited one by one, the smaller value first.
    """
    twice = cut(pool.groupBy(group, ident).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select(group, F.col(ident).alias("__twice")))
    if twice.isEmpty():
        return _fill(pool.withColumn("__copy", F.lit("")), targets, group, value, tolerance, seed, ident, fold_rows).drop("__copy")
    tagged = pool.join(twice, pool[group].eqNullSafe(twice[group]) & pool[ident].eqNullSafe(F.col("__twice")), "left").select(pool["*"], F.col("__twice").isNotNull().alias("__again"))
    copies = F.row_number().over(Window.partitionBy(group, ident).orderBy(value, *[F.xxhash64(*[F.col(f"`{c}`") for c in pool.columns])]))
    many = tagged.where("__again").withColumn("__copy", F.format_string("%012d", copies)).drop("__again")
    numbered = tagged.where("not __again").withColumn("__copy", F.lit("")).drop("__again").unionByName(many)
    return _fill(cut(numbered), targets, group, value, tolerance, seed, ident, fold_rows).drop("__copy")


def _fill(pool: DataFrame, targets: DataFrame, group: str, value: str, tolerance: float, seed: int, ident: str, fold_rows: int) -> DataFrame:
    """The greedy fill of rows that (group, ident, __copy) tells apart."""
    t = targets.where("target > 0").select(group, (F.col("target") * (1 - tolerance)).alias("lower"), (F.col("target") * (1 + tolerance)).alias("upper"))
    slim = pool.select(group, F.struct(F.col(ident).alias("id"), F.col("__copy").alias("copy")).alias("__id"), F.col(value).cast("double").alias("__v")).where("__v > 0").withColumn("__key", F.concat(stable_key(F.col("__id.id"), seed), F.col("__id.copy")))
    slim = lookup_join(slim, cut(t), [group], salt_by="__id")
    slim = slim.withColumn("__small", F.when(F.col("__v") <= F.col("upper") - F.col("lower"), F.col("__v")).otherwise(0.0))
    slim = cut(slim)  # the value may be dear, and the sums read it twice
    near = prefix_sums(slim, group, "__key", "__small", "__id").where(F.col("before") < F.col("lower"))
    near = cut(near.select(group, "__id", "__key", "__v", "__small", "before", "lower", "upper"))
    kinds = cut(near.groupBy(group).agg(F.bool_or(F.col("__small") == 0).alias("__slow")))
    told = lookup_join(near, kinds, [group], salt_by="__id")
    fast = told.where("not __slow").select(group, "__id")
    slow = told.where("__slow").select(group, "__id", "__key", "__v")
    large = kinds.where("__slow").select(group)
    folded = take_fitting(slow, t.join(large, group).select(group, F.lit(0).alias("acc"), F.col("upper").alias("room"), F.col("lower").alias("stop")), group, fold_rows)
    chosen = fast.unionByName(folded)
    return pool.join(chosen.select(F.col(group), F.col("__id.id").alias(ident), F.col("__id.copy").alias("__copy")), [group, ident, "__copy"], "left_semi")


def nested_variants(df: DataFrame, fractions: dict[str, float], preserve: list[str], fill: list[str], language: str = "language", tokens: str = "tokens", seed: int = 42, ident: str = "id", fold_rows: int = FOLD_ROWS) -> DataFrame:
    """``ident`` and ``variant`` (the smallest variant the row is in; each larger one holds it too).

    Classes in ``preserve`` are in all. The others are visited in stable order and taken where they fit,
    level by level; what did not fit comes up again at the next level. The first row of a level needs to
    fit into the whole budget only.
    """
    levels = sorted(fractions.items(), key=lambda x: x[1])
    total = df.agg(F.coalesce(F.sum(tokens), F.lit(0))).first()[0]
    whole = df.where(F.col(language).isin(preserve))
    out = whole.select(ident, F.lit(levels[0][0]).alias("variant"))
    spent = whole.agg(F.coalesce(F.sum(tokens), F.lit(0))).first()[0]
    left = cut(df.where(F.col(language).isin(fill)).select(F.lit(0).alias("__g"), F.col(ident).alias("__id"), stable_key(ident, seed).alias("__key"), F.coalesce(F.col(tokens), F.lit(0)).cast("double").alias("__v")))
    for name, fraction in levels:
        budget = int(total * fraction)
        room = max(budget - spent, 0)
        head = left.where(F.col("__v") <= budget).orderBy("__key", "__id").limit(1).collect()
        if not head:
            continue
        rest = left.where((F.col("__key") > head[0]["__key"]) & (F.col("__id") != head[0]["__id"]))
        state = df.sparkSession.createDataFrame([(0, float(head[0]["__v"]), float(room), float("inf"))], "__g int, acc double, room double, stop double")
        first = left.where(F.col("__id") == head[0]["__id"]).select("__g", "__id")
        taken = cut(take_fitting(rest, state, "__g", fold_rows).unionByName(first).join(left, ["__g", "__id"]))
        spent += int(taken.agg(F.coalesce(F.sum("__v"), F.lit(0.0))).first()[0])
        out = out.unionByName(taken.select(F.col("__id").alias(ident), F.lit(name).alias("variant")))
        left = cut(left.join(taken.select("__id"), "__id", "left_anti"))
    return out


def prefix_sample(df: DataFrame, stratum: str, tokens: str, quotas: DataFrame, seed: int = 42, ident: str = "id") -> DataFrame:
    """Rows of each stratum in stable order up to the first that would exceed its quota; one row at least."""
    slim = df.withColumn("__key", stable_key(ident, seed))
    placed = prefix_sums(slim, stratum, "__key", tokens, ident)
    placed = lookup_join(placed, quotas, [stratum], salt_by=ident)
    return placed.where((F.col("before") + F.col(tokens) <= F.col("quota")) | (F.col("before") == 0)).drop("__key", "before", "quota")


#: Rows of a group that are packed in one task.
SHARD_ROWS = 200_000


def pack_first_fit(df: DataFrame, group: str, tokens: str, capacity: int, ident: str = "id", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """First-fit-decreasing bins of each group: group, shard, ident, bin (in its shard), tokens. Records beyond the capacity have bin -1.

    A group of more than ``shard_rows`` rows is packed in as many shards as it takes, by a hash of the identifier, so no
    group is one task. The first bin with room is found in a tree over the room of all bins.
    """
    kinds = dict(df.dtypes)
    slim = df.select(group, ident, tokens)
    sizes = slim.groupBy(group).agg(F.ceil(F.count(F.lit(1)) / shard_rows).cast("int").alias("__shards")).withColumn("__g", F.coalesce(F.col(group).cast("string"), F.lit("\0"))).drop(group)
    keyed = lookup_join(slim.withColumn("__g", F.coalesce(F.col(group).cast("string"), F.lit("\0"))), sizes, ["__g"], salt_by=ident)
    keyed = keyed.select(group, F.pmod(F.xxhash64(ident), F.col("__shards")).cast("int").alias("shard"), ident, tokens)

    def pack(pdf):
        pdf = pdf.sort_values([tokens, ident], ascending=[False, True])
        size = 1
        while size < len(pdf):
            size *= 2
        room = [capacity] * (2 * size)  # of bins that aren't open yet too: the first that fits is opened
        bins = []
        for v in pdf[tokens].tolist():
            if v > capacity:
                bins.append(-1)
                continue
            at = 1
            while at < size:
                at = 2 * at if room[2 * at] >= v else 2 * at + 1
            bins.append(at - size)
            room[at] -= v
            while at > 1:
                at //= 2
                room[at] = max(room[2 * at], room[2 * at + 1])
        return pdf.assign(bin=bins)[[group, "shard", ident, "bin", tokens]]

    return keyed.groupBy(group, "shard").applyInPandas(pack, f"`{group}` {kinds[group]}, shard int, `{ident}` {kinds[ident]}, bin long, `{tokens}` {kinds[tokens]}")


@dataclass
class Selection:
    """Train and holdout, what was rejected and why, and a receipt."""

    train: DataFrame
    holdout: DataFrame
    rejected: DataFrame
    receipt: dict

    def overlap(self, ident: str = "id") -> int:
        return self.train.join(self.holdout.select(ident), ident, "left_semi").count()


def eligible(df: DataFrame, spec: RetentionSpec, categories: list[str], valid: Column | None = None) -> DataFrame:
    """Adds ``reject_reason`` by the rules in order; null where a record may be selected."""
    rules = [("schema_invalid", ~valid)] if valid is not None else []
    if spec.exclude_flagged:
        rules.append(("quality_flagged", F.col("quality")["flagged"]))
    rules.append(("language_not_allowed", ~F.coalesce(F.col("language").isin(*spec.languages), F.lit(False))))
    rules.append(("category_not_requested", ~F.coalesce(F.col("category").isin(*categories), F.lit(False))))
    out = F.lit(None).cast("string")
    for name, cond in reversed(rules):
        out = F.when(F.coalesce(cond, F.lit(False)), name).otherwise(out)
    return df.withColumn("reject_reason", out)


def _first_by_id(df: DataFrame, ident: str, order: str) -> DataFrame:
    first = df.groupBy(ident).agg(F.min(order).alias(order))
    return df.join(first, [ident, order], "left_semi")


def select_by_count(df: DataFrame, spec: RetentionSpec, scale: float = 1.0, order: str = "line_no", ident: str = "id", valid: Column | None = None) -> Selection:
    """Counts by category with a stratified holdout reserved first."""
    targets = scale_targets(spec.canonical_targets(), scale)
    judged = eligible(df, spec, list(targets), valid)
    unique = cut(_first_by_id(judged.where("reject_reason is null"), ident, order))
    counts = {r["category"]: r["count"] for r in unique.groupBy("category").count().collect()}
    holdout_size = max(1, round(spec.holdout_size * scale)) if spec.holdout_size else 0
    if spec.on_insufficient == "error" and (short := [c for c, n in targets.items() if counts.get(c, 0) < n]):
        raise SelectionError(f"too few candidates for {short}: {counts}")
    parted = cut(stratified_split(unique, holdout_size, spec.stratify_by, spec.seed, ident))
    holdout, rest = parted.where("part = 'holdout'").drop("part", "reject_reason"), parted.where("part = 'train'").drop("part", "reject_reason")
    train = source_diverse_by(rest, targets, "category", spec.max_share_per_source, seed=spec.seed, ident=ident)
    rejected = judged.where("reject_reason is not null").groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"))
    return Selection(train, holdout, rejected, {"targets": targets, "holdout": holdout_size, "seed": spec.seed, "scale": scale})


def select_by_tokens(df: DataFrame, spec: RetentionSpec, scale: float = 1.0, order: str = "line_no", ident: str = "id", valid: Column | None = None) -> Selection:
    """Token budgets by category around an anchor: the anchor is drawn first, its tokens are the unit, then the holdout, then the rest."""
    metric = f"tokens_{spec.metric}"
    judged = eligible(df, spec, list(spec.multipliers), valid)
    unique = _first_by_id(judged.where("reject_reason is null"), ident, order)
    sized = cut(unique.withColumns({"tokens_total": tokens_total(F.col("messages")), "tokens_assistant": tokens_assistant(F.col("messages"))}).drop("reject_reason"))
    fit = sized.where(F.col("tokens_total") <= spec.max_tokens)
    need = max(1, round(spec.anchor_examples * scale))
    pool = fit.where(F.col("category") == spec.anchor)
    anchor = cut(source_diverse(pool, need, spec.max_share_per_source, seed=spec.seed, ident=ident))
    if spec.on_insufficient == "error" and anchor.count() < need:
        raise SelectionError(f"the anchor {spec.anchor} has fewer than {need} candidates")
    unit = anchor.agg(F.coalesce(F.sum(metric), F.lit(0))).first()[0]
    rest = fit.join(anchor.select(ident), ident, "left_anti")
    if spec.template_cap is not None:
        rest = cap_per(rest, template_key(F.col("messages")), spec.template_cap, [ident], F.col("source") == spec.template_source if spec.template_source else None)
    spark = df.sparkSession
    held = float(spec.holdout_tokens if spec.holdout_tokens is not None else spec.holdout_ratio * unit)

    def fill(pool: DataFrame, targets: dict[str, float], what: str) -> DataFrame:
        t = spark.createDataFrame([(c, float(x)) for c, x in targets.items()], "category string, target double")
        out = cut(greedy_fill(pool, t, "category", metric, spec.tolerance, spec.seed, ident))
        got = {r["category"]: r["n"] for r in out.groupBy("category").agg(F.sum(metric).alias("n")).collect()}
        short = [c for c, x in targets.items() if x > 0 and got.get(c, 0) < x * (1 - spec.tolerance)]
        if short and spec.on_insufficient == "error":
            raise SelectionError(f"{what}: too few tokens in {short}: {got}")
        return out

    holdout = fill(rest, {c: held * s for c, s in spec.holdout_shares.items()}, "holdout") if spec.holdout_shares else fit.limit(0)
    rest = rest.join(holdout.select(ident), ident, "left_anti")
    train = anchor.unionByName(fill(rest, {c: m * unit for c, m in spec.multipliers.items() if c != spec.anchor}, "train"))
    over = sized.where(F.col("tokens_total") > spec.max_tokens).agg(F.count(F.lit(1)).alias("n")).select(F.lit("over_length").alias("reject_reason"), "n").where("n > 0")
    rejected = judged.where("reject_reason is not null").groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n")).unionByName(over)
    return Selection(train, holdout, rejected, {"unit_tokens": unit, "holdout_tokens": held, "seed": spec.seed, "scale": scale})


def cross_contamination(df: DataFrame, a: str, b: str, category: str = "category") -> DataFrame:
    """Distinct last user turns that two categories share."""
    text = last_of(F.col("messages"), "user")
    side = lambda c: df.where(F.col(category) == c).select(text.alias("text")).where("text <> ''")
    return side(a).intersect(side(b))


def select_slice(df: DataFrame, multipliers: dict[str, float], anchor: str, languages: list[str], scripts: list[str] | None = None, unit: int | None = None, metric: str = "assistant", holdout_ratio: float = 0.05, tolerance: float = 0.02, max_tokens: int = 15_500, seed: int = 42, order: str = "line_no", ident: str = "id") -> Selection:
    """Budgets of one slice around its whole anchor category, or around a unit given from elsewhere; filling less than asked is allowed.

    A holdout of ``holdout_ratio`` of the unit is reserved in proportion to the multipliers, then every category is filled.
    """
    spec = RetentionSpec(languages=tuple(languages), multipliers=multipliers, anchor=anchor, metric=metric)
    judged = eligible(df, spec, list(multipliers))
    if scripts is not None:
        judged = judged.withColumn("reject_reason", F.coalesce("reject_reason", F.when(~F.coalesce(F.col("script").isin(scripts), F.lit(False)), "script_not_allowed")))
    name = f"tokens_{metric}"
    sized = _first_by_id(judged.where("reject_reason is null"), ident, order).withColumns({"tokens_total": tokens_total(F.col("messages")), "tokens_assistant": tokens_assistant(F.col("messages"))}).drop("reject_reason")
    pool = cut(sized.where(F.col("tokens_total") <= max_tokens))
    if unit is None:
        unit = pool.where(F.col("category") == anchor).agg(F.coalesce(F.sum(name), F.lit(0))).first()[0]
    share = sum(multipliers.values())
    spark = df.sparkSession
    held = spark.createDataFrame([(c, holdout_ratio * unit * m / share) for c, m in multipliers.items()], "category string, target double")
    holdout = cut(greedy_fill(pool, held, "category", name, tolerance, seed, ident))
    rest = pool.join(holdout.select(ident), ident, "left_anti")
    wanted = spark.createDataFrame([(c, float(m * unit)) for c, m in multipliers.items()], "category string, target double")
    train = cut(greedy_fill(rest, wanted, "category", name, tolerance, seed, ident))
    rejected = judged.where("reject_reason is not null").groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"))
    return Selection(train, holdout, rejected, {"unit_tokens": unit, "multipliers": multipliers, "seed": seed})
