"""Problem 1: token budgets that are kept up to date.

The count table holds, for each distinct content and tokenizer, the number of tokens. Each content that it
lacks is encoded once. A state holds the fingerprint, facets and tokens of every record; a new snapshot is
held against it by fingerprints, so that only records that are new, changed or gone are looked at again, and
cubes change by their signed counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.llm import bpe
from tamis.llm.labels import language_label, with_contributor
from tamis.operators.joins import BROADCAST_ROWS, hot_split_join
from tamis.session import cut, spread

TOKENIZER = "byte_bpe_multi_50k.tiktoken"
FACETS = ["contributor", "language", "category"]


def content_hash(content: Column) -> Column:
    """128 bits of a content; two seeds of a 64-bit hash, as one would collide on 10^10 contents."""
    return F.struct(F.xxhash64(content).alias("h1"), F.xxhash64(F.lit("tamis"), content).alias("h2"))


def contents(records: DataFrame, messages: str = "messages") -> DataFrame:
    """One row for each content that has anything to encode."""
    return records.select(F.explode(F.col(messages)["content"]).alias("content")).where("content is not null and content <> ''")


def count_contents(df: DataFrame, tokenizer: str = TOKENIZER, folder: str = bpe.TOKENIZERS, known: DataFrame | None = None) -> DataFrame:
    """Rows of a count table for the contents of ``df`` that ``known`` lacks: tokenizer, h1, h2, tokens.

    Contents meet the hashes of the same tokenizer in ``known`` first; of equal ones, however many, one is encoded.
    """
    name = bpe.file_hash(tokenizer, folder)
    df = df.select(content_hash(F.col("content")).alias("h"), "content").groupBy("h").agg(F.first("content").alias("content")).select("h.h1", "h.h2", "content")
    if known is not None:
        df = df.join(known.where(F.col("tokenizer") == name).select("h1", "h2"), ["h1", "h2"], "left_anti")

    def run(batches):
        import pyarrow as pa

        enc = bpe.encoder(tokenizer, folder)
        for b in batches:
            n = pa.array([enc.count(x) for x in b.column(2).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), n], names=["h1", "h2", "tokens"])

    return df.mapInArrow(run, "h1 long, h2 long, tokens long").select(F.lit(name).alias("tokenizer"), "h1", "h2", "tokens")


def store_counts(counts: DataFrame, path: str, batch: int) -> None:
    """Adds rows to the stored count table; a batch that is written again replaces what it left."""
    counts.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch}")


def load_counts(spark: SparkSession, path: str) -> DataFrame:
    """The stored count table; a content that several batches brought has one row."""
    return spark.read.parquet(path).groupBy("tokenizer", "h1", "h2").agg(F.max("tokens").alias("tokens"))


def update_counts(records: DataFrame, known: DataFrame | None = None, **how) -> DataFrame:
    """The count table after ``records`` were seen: ``known`` and what had to be encoded."""
    new = cut(count_contents(contents(spread(records.select("messages"))), known=known, **how))
    return new if known is None else known.unionByName(new)


def record_tokens(records: DataFrame, counts: DataFrame, key: str = "line_no", keep: list[str] = (), tokenizer: str = TOKENIZER, folder: str = bpe.TOKENIZERS) -> DataFrame:
    """``keep`` columns, turns and tokens of each record; null, blank-free and missing contents count 0.

    Rows are told apart by ``key``. A content that a third of all rows share doesn't travel: the entries of hot contents are broadcast.
    """
    name = bpe.file_hash(tokenizer, folder)
    base = records.select(key, *keep, "messages")
    each = base.select(key, F.explode("messages.content").alias("content")).where("content is not null and content <> ''").select(key, content_hash(F.col("content")).alias("h")).select(key, "h.*")
    known = counts.where(F.col("tokenizer") == name).select("h1", "h2", "tokens")
    sums = hot_split_join(each, known, ["h1", "h2"]).groupBy(key).agg(F.sum("tokens").alias("tokens"))
    sized = base.select(key, *keep, F.coalesce(F.greatest(F.size("messages"), F.lit(0)), F.lit(0)).cast("long").alias("turns"))
    return sized.join(sums, key, "left").withColumn("tokens", F.coalesce("tokens", F.lit(0)))


def facets(records: DataFrame, catalog: DataFrame) -> DataFrame:
    """Canonical contributor, language and category; ``unknown`` where there is none."""
    known = with_contributor(records, catalog).withColumn("language", language_label(F.col("language")))
    return known.withColumns({c: F.coalesce(c, F.lit("unknown")) for c in FACETS})


def _fingerprint() -> list[Column]:
    """d1 and d2: 128 bits of all contents of a record, on which alone its tokens depend."""
    text = F.col("messages.content")
    return [F.xxhash64(text, F.size(text)).alias("d1"), F.xxhash64(F.lit("record"), text).alias("d2")]


def snapshot(records: DataFrame, catalog: DataFrame, key: str = "line_no") -> DataFrame:
    """``key``, facets, d1 and d2 (fingerprint of all contents) and copies (rows equal in all of them)."""
    rows = records.select(key, "source", "language", "category", *_fingerprint())
    return facets(rows, catalog).groupBy(key, *FACETS, "d1", "d2").agg(F.count(F.lit(1)).alias("copies"))


def changes(state: DataFrame | None, now: DataFrame, key: str = "line_no") -> DataFrame:
    """Records whose copies differ between a state and a snapshot: ``key``, facets, d1, d2, delta (copies more or less), tokens (of those in the state).

    What is equal in fingerprint and facets cancels here, before anything is counted or summed up.
    """
    by = [key, *FACETS, "d1", "d2"]
    new = now.select(*by, F.col("copies").alias("__new"))
    if state is None:
        return new.select(*by, F.col("__new").alias("delta"), F.lit(None).cast("long").alias("tokens"))
    both = new.unionByName(state.select(*by, F.col("copies").alias("__old"), "tokens"), allowMissingColumns=True)
    met = both.groupBy(*by).agg((F.coalesce(F.sum("__new"), F.lit(0)) - F.coalesce(F.sum("__old"), F.lit(0))).alias("delta"), F.max("tokens").alias("tokens"))
    return met.where("delta <> 0")


def _only(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """The rows of ``df`` whose keys are in a table of distinct ones: a small one is broadcast, else the entries of hot keys are."""
    if keys.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return df.join(F.broadcast(keys), on, "left_semi")
    return hot_split_join(df, keys, on)


def update_budget(records: DataFrame, catalog: DataFrame, state: DataFrame | None = None, counts: DataFrame | None = None, key: str = "line_no", tokenizer: str = TOKENIZER, folder: str = bpe.TOKENIZERS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """From one snapshot to the next: signed cells, the new state, the new count table.

    Only hashes are compared and shuffled: fingerprints of records with the state, hashes of the contents of new or
    changed records with the count table. The texts of those that it lacks are fetched and encoded once each; removed
    records leave by the tokens that the state holds of them. Without a state all records are new.
    """
    name = bpe.file_hash(tokenizer, folder)
    moved = cut(changes(state, snapshot(records, catalog, key), key))
    fresh = moved.where("delta > 0 and tokens is null").select("d1", "d2").distinct()
    filled = F.filter("messages.content", lambda c: c.isNotNull() & (c != ""))
    hashed = records.select(*_fingerprint(), F.transform(filled, content_hash).alias("hashes")).where("size(hashes) > 0")
    parts = cut(_only(hashed, cut(fresh), ["d1", "d2"]).groupBy("d1", "d2").agg(F.first("hashes").alias("hashes")).select("d1", "d2", F.explode("hashes").alias("h")).select("d1", "d2", "h.*"))
    lacking = parts.select("h1", "h2").distinct()
    if counts is not None:
        lacking = lacking.join(counts.where(F.col("tokenizer") == name).select("h1", "h2"), ["h1", "h2"], "left_anti")
    texts = contents(spread(records.select("messages"))).select(content_hash(F.col("content")).alias("h"), "content").select("h.*", "content")
    if state is not None or counts is not None:  # at first all of them lack
        texts = _only(texts, cut(lacking), ["h1", "h2"])
    new = cut(count_contents(texts, tokenizer, folder))
    counts = new if counts is None else counts.unionByName(new)
    per = hot_split_join(parts, counts.where(F.col("tokenizer") == name).select("h1", "h2", "tokens"), ["h1", "h2"]).groupBy("d1", "d2").agg(F.sum("tokens").alias("__tokens"))
    cells = cut(moved.join(per, ["d1", "d2"], "left").withColumn("tokens", F.coalesce("tokens", "__tokens", F.lit(0))).drop("__tokens"))
    left = cells.select(key, *FACETS, "d1", "d2", F.col("delta").alias("copies"), "tokens")
    if state is not None:
        left = state.select(*left.columns).unionByName(left).groupBy(key, *FACETS, "d1", "d2").agg(F.sum("copies").alias("copies"), F.max("tokens").alias("tokens")).where("copies > 0")
    return signed_cells(cells), left, counts


def signed_cells(moved: DataFrame) -> DataFrame:
    """Base cells of a change: facets, documents, tokens (both signed)."""
    return moved.groupBy(*FACETS).agg(F.sum("delta").alias("documents"), F.sum(F.col("delta") * F.col("tokens")).alias("tokens")).where("documents <> 0 or tokens <> 0")


def apply_cells(cells: DataFrame | None, delta: DataFrame) -> DataFrame:
    """Base cells after a delta; cells that hold no document any more are gone."""
    both = delta if cells is None else cells.unionByName(delta)
    return both.groupBy(*FACETS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens")).where("documents <> 0 or tokens <> 0")


def cube(cells: DataFrame) -> DataFrame:
    """Totals by every combination of facets (null: all of it), from base cells only."""
    sums = cells.cube(*FACETS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"), F.grouping_id().cast("int").alias("grouping"))
    return sums.select(*FACETS, "grouping", "documents", "tokens")


def token_budget(records: DataFrame, catalog: DataFrame, counts: DataFrame | None = None, **how) -> tuple[DataFrame, DataFrame]:
    """Tokens of each record with its facets, and the count table after them (cut, so encoded once)."""
    counts = cut(update_counts(records, counts, **how))
    per = record_tokens(records, counts, keep=["source", "language", "category"], **how)
    return facets(per, catalog), counts
