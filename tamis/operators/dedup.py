"""Exact, normalised and near duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamis.functions.text import let, norm_key
from tamis.operators.joins import hot_split_join
from tamis.session import cut, spread

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 20, 6
#: Members of a bucket up to which each is paired with each other, and the times that larger ones are parted by other hashes.
PAIRED, LEVELS = 256, 3


def by_id(df: DataFrame, ident: str = "id", order: str = "line_no") -> DataFrame:
    """The first row of each id; rows without one stay. First rows come from a partial aggregate, so a hot id is no hot task."""
    usable = F.coalesce(F.col(ident), F.lit("")) != ""
    first = df.where(usable).groupBy(ident).agg(F.min(order).alias(order))
    return df.where(usable).join(first, [ident, order], "left_semi").unionByName(df.where(~usable).select(*[ident, order, *[c for c in df.columns if c not in (ident, order)]])).select(*df.columns)


def exact_then_normalised(df: DataFrame, text: str, order: str) -> tuple[DataFrame, DataFrame]:
    """Survivors of exact and then of normalised equality, and a one-row count of both kinds removed."""
    first = df.groupBy(F.xxhash64(text).alias("__h"), F.col(text).alias("__t")).agg(F.min(order).alias(order)).drop("__h", "__t")
    exact = df.join(first, order, "left_semi")
    second = exact.groupBy(norm_key(F.col(text)).alias("__n")).agg(F.min(order).alias(order)).drop("__n")
    out = exact.join(second, order, "left_semi")
    n = df.agg(F.count(F.lit(1)).alias("a")).crossJoin(exact.agg(F.count(F.lit(1)).alias("b"))).crossJoin(out.agg(F.count(F.lit(1)).alias("c")))
    return out, n.select((F.col("a") - F.col("b")).alias("exact_removed"), (F.col("b") - F.col("c")).alias("normalised_removed"), F.col("c").alias("kept"))


def char_grams(text: Column, n: int = 3) -> Column:
    """Distinct character n-grams, lower case, white space collapsed."""
    none = F.array().cast("array<int>")

    def grams(t: Column) -> Column:
        places = F.when(F.length(t) >= n, F.sequence(F.lit(1), F.length(t) - (n - 1))).otherwise(none)
        return F.array_distinct(F.transform(places, lambda i: F.substring(t, i, F.lit(n))))

    return let(F.lower(F.regexp_replace(text, r"(?U)\s+", " ")), grams)


def word_shingles(text: Column, n: int = SHINGLE) -> Column:
    """Distinct hashes of runs of n words; a shorter text is one shingle."""
    none = F.array().cast("array<bigint>")

    def shingles(w: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)), lambda i: F.xxhash64(F.array_join(F.slice(w, i, n), " ")))
        return F.array_distinct(F.when(F.size(w) >= n, runs).when(F.size(w) > 0, F.array(F.xxhash64(F.array_join(w, " ")))).otherwise(none))

    return let(F.filter(F.split(F.lower(text), r"(?U)[^\p{L}\p{N}]+"), lambda x: x != ""), shingles)


def jaccard(a: Column, b: Column) -> Column:
    shared = F.size(F.array_intersect(a, b))
    return F.coalesce(F.try_divide(shared, F.size(a) + F.size(b) - shared), F.lit(0.0))


def band_hashes(df: DataFrame, ident: str, shingles: str, bands: int = BANDS, rows: int = ROWS, seed: int = 11) -> DataFrame:
    """``ident`` and buckets: one hash for each band of the min-hash signature of an array of shingles."""
    kind = dict(df.dtypes)[ident]

    def run(batches):
        import numpy as np
        import pyarrow as pa

        rng = np.random.default_rng(seed)
        mul, add, mix = (rng.integers(1, 1 << 63, n, dtype=np.uint64) | np.uint64(1) for n in (bands * rows, bands * rows, rows))
        for b in batches:
            col = b.column(1)
            flat, at = col.flatten().to_numpy(zero_copy_only=False).astype(np.uint64), 0
            out = np.empty((b.num_rows, bands), np.int64)
            for i, n in enumerate(col.value_lengths().to_numpy(zero_copy_only=False)):
                x = flat[at : at + n]
                at += n
                low = ((x[:, None] * mul + add) >> np.uint64(32)).min(axis=0).reshape(bands, rows)
                g = (low + np.uint64(1)) * mix
                out[i] = np.bitwise_xor.reduce(g ^ (g >> np.uint64(31)), axis=1).astype(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.FixedSizeListArray.from_arrays(pa.array(out.ravel()), bands).cast(pa.list_(pa.int64()))], names=[ident, "buckets"])

    return spread(df.select(ident, shingles).where(F.size(shingles) > 0)).mapInArrow(run, f"`{ident}` {kind}, buckets array<long>")


def bucket_links(buckets: DataFrame, confirm, part, paired: int = PAIRED, levels: int = LEVELS) -> DataFrame:
    """Links (a, b) that join all members of a bucket that are linked to each other, directly or not.

    ``buckets``: g, rep. ``confirm`` keeps the pairs (a, b) that are links; ``part(members, level)`` gives the buckets
    (sub, rep) of members by other hashes. In a bucket of up to ``paired`` members each meets each. In a larger one all
    meet the least; those linked to it need no other link, and the rest is parted by other hashes, in ``levels`` rounds
    whatever the size. What is left then meets the members of its bucket in blocks. So the rounds are fixed, no task
    holds the pairs of a bucket, and copies of one text cost one pair each.
    """
    kind = dict(buckets.dtypes)["rep"]
    links = buckets.sparkSession.createDataFrame([], f"a {kind}, b {kind}")
    groups = cut(buckets.select("g", "rep", F.lit(True).alias("open")))
    for level in range(levels + 1):
        sizes = groups.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.min(F.when(F.col("open"), F.col("rep"))).alias("head")).where("n > 1 and head is not null")
        sized = cut(groups.join(sizes, "g"))
        few = sized.where(F.col("n") <= paired)
        met = few.select("g", F.col("rep").alias("a"), F.col("open").alias("x")).join(few.select("g", F.col("rep").alias("b"), F.col("open").alias("y")), "g").where("a < b and (x or y)")
        links = links.unionByName(cut(confirm(met.select("a", "b"))))
        many = sized.where(F.col("n") > paired)
        if many.isEmpty():
            break
        if level == levels:
            # in blocks: each open member meets every other, one block a task
            blocks = many.withColumns({"of": F.ceil(F.col("n") / paired).cast("int"), "h": F.xxhash64("rep")})
            left = blocks.where("open").select("g", F.col("rep").alias("x"), F.explode(F.sequence(F.lit(0), F.col("of") - 1)).alias("block"))
            right = blocks.select("g", F.col("rep").alias("y"), F.pmod("h", F.col("of")).cast("int").alias("block"))
            pairs = left.join(right, ["g", "block"]).where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
            links = links.unionByName(cut(confirm(pairs)))
            break
        star = many.where("rep <> head").select(F.least("head", "rep").alias("a"), F.greatest("head", "rep").alias("b"))
        linked = cut(confirm(star))
        links = links.unionByName(linked)
        ends = linked.select(F.col("a").alias("head"), F.col("b").alias("rep")).unionByName(linked.select(F.col("b").alias("head"), F.col("a").alias("rep"))).withColumn("met", F.lit(True))
        now = many.join(ends, ["head", "rep"], "left").select("g", "rep", (F.col("open") & F.col("met").isNull() & (F.col("rep") != F.col("head"))).alias("open"))
        now = cut(now)
        # a bucket without an open member is done
        now = now.join(now.where("open").select("g").distinct(), "g", "left_semi")
        subs = part(now.select("rep").distinct(), level + 1)
        groups = cut(now.join(subs, "rep").select(F.xxhash64("g", "sub").alias("g"), "rep", "open"))
    return links.distinct()


def near_duplicates(df: DataFrame, ident: str, text: str, similarity: float = SIMILARITY, shingle: int = SHINGLE, paired: int = PAIRED) -> DataFrame:
    """``ident`` and ``class_id`` (least id of all that are linked, directly or not).

    Equal texts collapse first; only one of each goes on, and copies share its class. Candidates come from banded
    min-hash buckets of different texts; links are exact Jaccard similarities of word shingles. Null and empty
    texts are classes of their own.
    """
    rows = df.where(F.coalesce(F.col(text), F.lit("")) != "").select(F.col(ident).alias("id"), F.xxhash64(text).alias("h1"), F.xxhash64(F.lit("s"), text).alias("h2"), F.col(text).alias("t"))
    reps = cut(rows.groupBy("h1", "h2").agg(F.min("id").alias("rep"), F.min("t").alias("t")).withColumn("sh", word_shingles(F.col("t"), shingle)).drop("t"))
    sh = reps.select("rep", "sh")

    def part(members: DataFrame, level: int) -> DataFrame:
        mine = sh if level == 0 else sh.join(members, "rep", "left_semi")
        return band_hashes(mine, "rep", "sh", seed=11 + level).select("rep", F.posexplode("buckets").alias("band", "bucket")).select("rep", F.xxhash64("band", "bucket").alias("sub"))

    def confirm(candidates: DataFrame) -> DataFrame:
        x, y = sh.select(F.col("rep").alias("a"), F.col("sh").alias("x")), sh.select(F.col("rep").alias("b"), F.col("sh").alias("y"))
        return candidates.distinct().join(x, "a").join(y, "b").where(jaccard(F.col("x"), F.col("y")) >= similarity).select("a", "b")

    links = cut(bucket_links(part(sh, 0).withColumnRenamed("sub", "g"), confirm, part, paired))
    classes = components(links, reps.select(F.col("rep").alias("id")))
    named = reps.select("h1", "h2", "rep").join(classes.select(F.col("id").alias("rep"), "class_id"), "rep").drop("rep")
    found = hot_split_join(rows.select("id", "h1", "h2"), named, ["h1", "h2"])
    blank = df.where(F.coalesce(F.col(text), F.lit("")) == "").select(F.col(ident), F.col(ident).alias("class_id"))
    return found.select(F.col("id").alias(ident), "class_id").unionByName(blank)


def components(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """``id``, ``class_id``: the least id reachable over links, by alternating large-star and small-star rounds."""
    edges = cut(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    mark = lambda e: e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", F.lit(1), "u"))).first()
    before = mark(edges)  # two sets of edges are the same if their sizes and hashes are
    while True:
        # every neighbour that is larger points to the least neighbour
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # every node and its smaller neighbours point to the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        new = cut(small)
        edges, now = new, mark(new)
        if now == before:
            break
        before = now
    return nodes.join(edges.groupBy("u").agg(F.min("v").alias("class_id")).withColumnRenamed("u", "id"), "id", "left").withColumn("class_id", F.coalesce("class_id", "id"))


def decision(input_rows: int, output_rows: int, field: str, threshold: float, semantic: bool = False, **paths: str) -> dict:
    """A row for the log of deduplications; the field set is part of it, as metadata columns suppress matches."""
    return {"field": field, "threshold": float(threshold), "semantic": semantic, "input_records": input_rows, "output_records": output_rows, "removed": input_rows - output_rows} | paths


def append_decision(spark, table_path: str, row: dict) -> None:
    spark.createDataFrame([row]).write.mode("append").json(table_path)


def keep_first(df: DataFrame, keys: list[Column], order: str) -> DataFrame:
    """The first row of each key by an order that is total."""
    named = df.withColumns({f"__k{i}": k for i, k in enumerate(keys)})
    w = Window.partitionBy(*[f"__k{i}" for i in range(len(keys))]).orderBy(order)
    return named.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r", *[f"__k{i}" for i in range(len(keys))])


def semantic_duplicates(df: DataFrame, ident: str, vector: str, similarity: float = 0.85, tables: int = 40, bits: int = 10, seed: int = 7, paired: int = PAIRED) -> DataFrame:
    """``ident`` and ``class_id`` of rows whose vectors have a cosine of ``similarity`` or more, over random hyperplanes.

    Candidates share all signs of one table of hyperplanes; links are exact cosines. Equal vectors collapse
    first; null, empty and zero vectors are classes of their own.
    """
    norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    rows = df.select(F.col(ident).alias("id"), F.transform(vector, lambda x: x.cast("double")).alias("v"), norm.alias("n"))
    live = rows.where("n > 0")
    same = cut(live.groupBy(F.xxhash64("v").alias("h"), "v").agg(F.min("id").alias("rep"), F.first("n").alias("n")))
    unit = same.select("rep", F.transform("v", lambda x: x / F.col("n")).alias("u"))
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    kind = dict(same.dtypes)["rep"]

    def part(members: DataFrame, level: int) -> DataFrame:
        def run(batches):
            import numpy as np
            import pyarrow as pa

            weights = 1 << np.arange(bits, dtype=np.int64)
            planes: dict[int, np.ndarray] = {}
            for b in batches:
                col = b.column(1)
                sizes, flat, at = col.value_lengths().to_numpy(zero_copy_only=False), col.flatten().to_numpy(zero_copy_only=False), 0
                subs = np.empty((b.num_rows, tables), np.int64)
                for i, n in enumerate(sizes):
                    if n not in planes:  # vectors of one length are compared with each other
                        planes[n] = np.random.default_rng([seed, level, int(n)]).standard_normal((tables * bits, n))
                    signs = (planes[n] @ flat[at : at + n] > 0).reshape(tables, bits)
                    at += n
                    subs[i] = (int(n) << 24 | np.arange(tables)) << bits | signs @ weights
                yield pa.RecordBatch.from_arrays([b.column(0), pa.FixedSizeListArray.from_arrays(pa.array(subs.ravel()), tables).cast(pa.list_(pa.int64()))], names=["rep", "subs"])

        mine = unit if level == 0 else unit.join(members, "rep", "left_semi")
        return spread(mine).mapInArrow(run, f"rep {kind}, subs array<long>").select("rep", F.explode("subs").alias("sub"))

    def confirm(pairs: DataFrame) -> DataFrame:
        x, y = unit.select(F.col("rep").alias("a"), F.col("u").alias("x")), unit.select(F.col("rep").alias("b"), F.col("u").alias("y"))
        return pairs.distinct().join(x, "a").join(y, "b").where((F.size("x") == F.size("y")) & (dot(F.col("x"), F.col("y")) >= similarity)).select("a", "b")

    links = cut(bucket_links(part(unit, 0).withColumnRenamed("sub", "g"), confirm, part, paired))
    classes = components(links, same.select(F.col("rep").alias("id"))).withColumnRenamed("id", "rep")
    named = same.select("h", "v", "rep").join(classes, "rep").select("h", "v", "class_id")
    found = hot_split_join(live.select("id", "v", F.xxhash64("v").alias("h")), named, ["h", "v"]).select(F.col("id").alias(ident), "class_id")
    return found.unionByName(rows.where("n is null or n <= 0").select(F.col("id").alias(ident), F.col("id").alias("class_id")))
