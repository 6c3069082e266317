"""Problem 5: records of the evaluation splits that stand again in the train split.

The shingles are the distinct folded words of the user and assistant turns, as the problem states
the similarity on them. Records with equal word sets form a class; classes of opposite splits meet in
banded min-hash buckets, a sketch drops pairs that are far apart, and the rest is decided by the exact
Jaccard similarity of the words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamis.llm.arrow import turns
from tamis.llm.labels import with_contributor
from tamis.operators.joins import hot_split_join, lookup_join
from tamis.session import cut, spread

#: Bands, rows of each, and the bands that a candidate pair must share at least.
#: At a similarity of 0.8 a pair shares fewer with a chance of 0.14 %, at 0.85 of 0.0002 %; one at 0.45 shares two by 0.1 %.
BANDS, ROWS, SHARED = 62, 9, 2
#: Pairs whose 128-bit sketches agree in fewer bits are dropped; at 0.8 the mean is 115 and the deviation 3.4.
SKETCH_BITS = 128
LEAST_AGREEING = 96
SIMILARITY = 0.8
EVALUATION = ("val", "test")


def signatures(records: DataFrame, key: str = "line_no", bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``key``, train (or evaluation), h1 and h2 (hash of the word set), n (words), s1 and s2 (sketch), bands.

    Rows of other splits, and rows without a word in their user and assistant turns, are left out.
    ``bands`` is null where the task has met the same word set in the same split before.
    """
    kinds = dict(records.dtypes)

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import xxhash

        from tamis.llm.forms import word_set

        hashes = bands * rows + SKETCH_BITS
        rng = np.random.default_rng(20240501)
        mul, add = rng.integers(1, 1 << 63, hashes, dtype=np.uint64) | np.uint64(1), rng.integers(0, 1 << 63, hashes, dtype=np.uint64)
        fold_mul = rng.integers(1, 1 << 63, rows, dtype=np.uint64) | np.uint64(1)
        at: dict[str, int] = {}
        table = np.empty((1 << 12, hashes), np.uint32)
        seen: set = set()
        word64 = xxhash.xxh3_64_intdigest
        for b in batches:
            start, end, roles, contents = turns(b.column(2))
            train = b.column(1).to_pylist()
            out = []
            for i, (s, e) in enumerate(zip(start, end)):
                ws = word_set([c for r, c in zip(roles[s:e], contents[s:e]) if r in ("user", "assistant")])
                if not ws:
                    continue
                if len(at) + len(ws) > 200_000:
                    at.clear()
                for w in ws:
                    if w not in at:
                        if len(at) == len(table):
                            table = np.concatenate([table, np.empty_like(table)])
                        at[w] = k = len(at)
                        x = np.uint64(word64(w))
                        with np.errstate(over="ignore"):
                            v = (x * mul + add) ^ (x >> np.uint64(29))
                            v *= np.uint64(0xFF51AFD7ED558CCD)
                        table[k] = v >> np.uint64(32)
                low = table[[at[w] for w in ws]].min(axis=0)
                joined = "\n".join(sorted(ws))
                h = xxhash.xxh3_128_intdigest(joined)
                h1, h2 = (h >> 64) - (1 << 63), (h & ((1 << 64) - 1)) - (1 << 63)
                bits = np.packbits((low[bands * rows :] & 1).astype(np.uint8)).view(">i8")
                mine = None
                if (train[i], h) not in seen:
                    if len(seen) > 500_000:
                        seen.clear()
                    seen.add((train[i], h))
                    with np.errstate(over="ignore"):
                        g = (low[: bands * rows].astype(np.uint64).reshape(bands, rows) + np.uint64(1)) * fold_mul
                        g = (np.bitwise_xor.reduce(g ^ (g >> np.uint64(31)), axis=1) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
                    mine = g.astype(np.uint32).view(np.int32)
                out.append((i, train[i], h1, h2, len(ws), int(bits[0]), int(bits[1]), mine))
            if not out:
                continue
            cols = list(zip(*out))
            ids = b.column(0).take(pa.array(cols[0]))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(cols[1], pa.bool_()), *(pa.array(c, pa.int64()) for c in cols[2:4]), pa.array(cols[4], pa.int32()), *(pa.array(c, pa.int64()) for c in cols[5:7]), pa.array(cols[7], pa.list_(pa.int32()))],
                names=[key, "train", "h1", "h2", "n", "s1", "s2", "bands"],
            )

    sides = records.where(F.col("split").isin("train", *EVALUATION) & (F.size("messages") > 0)).select(key, (F.col("split") == "train").alias("train"), "messages")
    return spread(sides).mapInArrow(run, f"`{key}` {kinds[key]}, train boolean, h1 long, h2 long, n int, s1 long, s2 long, bands array<int>")


def word_rows(records: DataFrame, key: str) -> DataFrame:
    """``key`` and the sorted distinct words of a record."""
    kinds = dict(records.dtypes)

    def run(batches):
        import pyarrow as pa

        from tamis.llm.forms import word_set

        for b in batches:
            start, end, roles, contents = turns(b.column(1))
            ws = [sorted(word_set([c for r, c in zip(roles[s:e], contents[s:e]) if r in ("user", "assistant")])) for s, e in zip(start, end)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ws, pa.list_(pa.string()))], names=[key, "words"])

    return records.select(key, "messages").mapInArrow(run, f"`{key}` {kinds[key]}, words array<string>")


def cross_split_classes(records: DataFrame, key: str = "line_no", similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """Confirmed pairs of classes (e1, e2 against t1, t2, similarity), and the class of each row (key, train, h1, h2)."""
    rows = cut(signatures(records, key))
    short = F.shiftrightunsigned("h1", 24)  # 40 bits name a class until its pairs are few
    keyed = rows.where("bands is not null").select("train", short.alias("id"), F.posexplode("bands").alias("i", "band"))
    keyed = keyed.select("train", "id", (F.shiftleft(F.col("i").cast("long"), 32) + F.col("band").cast("long") + F.lit(1 << 31)).alias("bucket"))
    # both sides go straight from their exchange to the join, so that adaptive execution can split a bucket that many share
    ev = keyed.where("not train").select("bucket", F.col("id").alias("e"))
    tr = keyed.where("train").select("bucket", F.col("id").alias("t"))
    bands_met = F.expr("bit_or(shiftleft(1L, cast(shiftright(bucket, 32) as int)))")
    met = ev.join(tr, "bucket").groupBy("e", "t").agg(bands_met.alias("bands")).where(F.bit_count("bands") >= SHARED).select("e", "t")
    classes = cut(rows.groupBy("train", "h1", "h2").agg(F.first("n").alias("n"), F.first("s1").alias("s1"), F.first("s2").alias("s2"), F.min(key).alias("rep")))

    def side(train: bool, p: str) -> DataFrame:
        return classes.where(F.col("train") == train).select(*(F.col(c).alias(f"{p}_{c}" if c not in ("h1", "h2") else p + c[1]) for c in ("h1", "h2", "n", "s1", "s2", "rep")))

    one = met.join(side(False, "e").withColumn("e", F.shiftrightunsigned("e1", 24)), "e")
    pairs = one.join(side(True, "t").withColumn("t", F.shiftrightunsigned("t1", 24)), "t")
    agree = F.lit(SKETCH_BITS) - F.bit_count(F.col("e_s1").bitwiseXOR(F.col("t_s1"))) - F.bit_count(F.col("e_s2").bitwiseXOR(F.col("t_s2")))
    near = pairs.where((F.least("e_n", "t_n") >= F.lit(similarity) * F.greatest("e_n", "t_n")) & (agree >= LEAST_AGREEING))
    near = cut(near.select("e1", "e2", "t1", "t2", "e_rep", "t_rep"))
    lines = near.select(F.col("e_rep").alias(key)).union(near.select(F.col("t_rep").alias(key))).distinct()
    texts = cut(word_rows(lookup_join(records.select(key, "messages"), lines, [key], "left_semi", salt_by=key), key).groupBy(key).agg(F.first("words").alias("words")))
    both = near.join(texts.select(F.col(key).alias("e_rep"), F.col("words").alias("a")), "e_rep").join(texts.select(F.col(key).alias("t_rep"), F.col("words").alias("b")), "t_rep")
    shared = F.size(F.array_intersect("a", "b"))
    scored = both.withColumn("similarity", shared / (F.size("a") + F.size("b") - shared))
    return scored.where(F.col("similarity") >= similarity).select("e1", "e2", "t1", "t2", "similarity"), rows.select(key, "train", "h1", "h2")


def _members(rows: DataFrame, train: bool, p: str, key: str, to: str) -> DataFrame:
    """The rows of a side as (p1, p2, to)."""
    return rows.where(F.col("train") == train).select(F.col("h1").alias(f"{p}1"), F.col("h2").alias(f"{p}2"), F.col(key).alias(to))


def cross_split_pairs(records: DataFrame, key: str = "line_no", similarity: float = SIMILARITY) -> DataFrame:
    """Every pair of rows of opposite splits that are the same or nearly so: evaluation row, train row, similarity."""
    classes, rows = cross_split_classes(records, key, similarity)
    one = lookup_join(_members(rows, False, "e", key, "evaluation"), cut(classes), ["e1", "e2"], salt_by="evaluation")
    return one.join(_members(rows, True, "t", key, "train"), ["t1", "t2"]).select("evaluation", "train", "similarity").distinct()


def overlap_classes(records: DataFrame, key: str = "line_no", similarity: float = SIMILARITY) -> DataFrame:
    """The same without pairs of rows: one row for each record that overlaps (``key``, train, class_id, links, most).

    Records of a side with equal word sets form a class, named by its least ``key``; links are the classes of the
    other side that it is near to, most is the greatest similarity.
    """
    classes, rows = cross_split_classes(records, key, similarity)
    pairs = cut(classes)
    linked = None
    for train, p in ((False, "e"), (True, "t")):
        side = pairs.groupBy(F.col(f"{p}1").alias("h1"), F.col(f"{p}2").alias("h2")).agg(F.count(F.lit(1)).alias("links"), F.max("similarity").alias("most")).withColumn("train", F.lit(train))
        linked = side if linked is None else linked.unionByName(side)
    mine = cut(lookup_join(rows, cut(linked), ["train", "h1", "h2"], salt_by=key))
    named = mine.groupBy("train", "h1", "h2").agg(F.min(key).alias("class_id"))
    return hot_split_join(mine, named, ["train", "h1", "h2"]).select(key, "train", "class_id", "links", "most")


def overlap_report(records: DataFrame, catalog: DataFrame, key: str = "line_no") -> DataFrame:
    """Evaluation records by split and contributor: records, those that stand again in train, their share."""
    classes, rows = cross_split_classes(records, key)
    found = lookup_join(_members(rows, False, "e", key, key), cut(classes.select("e1", "e2").distinct()), ["e1", "e2"], salt_by=key).select(key, F.lit(1).alias("hit")).distinct()
    ev = with_contributor(records.where(F.col("split").isin(*EVALUATION)).select(key, "split", "source"), catalog)
    agg = ev.join(found, key, "left").groupBy("split", F.coalesce("contributor", F.lit("unknown")).alias("contributor")).agg(F.count(F.lit(1)).alias("records"), F.count("hit").alias("overlapping"))
    return agg.withColumn("share", F.col("overlapping") / F.col("records"))
