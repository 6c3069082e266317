"""Readers. Each returns a DataFrame with ``_file`` and ``_line`` where order matters, as Spark has none of its own."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tamis.functions.text import strip
from tamis.operators.joins import lookup_join
from tamis.session import cut

#: Names under which a corpus may keep its text.
TEXT_COLUMNS = ("text", "content", "body", "sentence", "utterance")
#: Hash of nothing.
EMPTY_SHA256 = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def _path(spark: SparkSession, path: str):
    """A path and its file system, whichever it is."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or a glob names anything."""
    p, fs = _path(spark, path)
    return bool(fs.globStatus(p))


def decoded(value: Column, errors: str = "replace") -> Column:
    """Text whose bytes are no UTF-8 in places: with the replacement character there (replace), or without them (ignore)."""
    if errors == "replace":
        return F.make_valid_utf8(value)
    return F.when(F.is_valid_utf8(value), value).otherwise(F.replace(F.make_valid_utf8(value), F.lit("\ufffd"), F.lit("")))


def lines(spark: SparkSession, path: str | list[str], errors: str = "replace") -> DataFrame:
    """Every non-blank line with its 1-based number in its own file: _file, _line, _raw. Blank lines keep their number.

    A task reads a stretch of a file in order, so a line's place in its stretch is known at once; the lines of the
    stretches before it, one small row each, are added. No file is gathered into one task, no line leaves the JVM.
    """
    paths = [path] if isinstance(path, str) else path
    for p in paths:
        if not exists(spark, p):
            raise FileNotFoundError(p)
    at = spark.read.text(paths).select(F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("__start"), F.monotonically_increasing_id().alias("__n"), decoded(F.col("value"), errors).alias("_raw"))
    blocks = at.groupBy("_file", "__start").agg(F.min("__n").alias("__low"), F.count(F.lit(1)).alias("__rows"))
    before = F.coalesce(F.sum("__rows").over(Window.partitionBy("_file").orderBy("__start").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    first = cut(blocks.select("_file", "__start", (before - F.col("__low") + 1).alias("__add")))
    return lookup_join(at, first, ["_file", "__start"], salt_by="__n").where(strip(F.col("_raw")) != "").select("_file", (F.col("__n") + F.col("__add")).alias("_line"), "_raw")


def jsonl(spark: SparkSession, path: str | list[str], errors: str = "replace") -> DataFrame:
    """Lines with their parsed value: _file, _line, _raw, v (null where it is no JSON), and defect (invalid_json, invalid_type or null)."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    df = lines(spark, path, errors).withColumn("v", F.try_parse_json("_raw"))
    return df.withColumn("defect", F.when(F.col("v").isNull(), "invalid_json").when(~F.schema_of_variant("v").startswith("OBJECT"), "invalid_type"))


def jsonl_lenient(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """Good rows under a schema, and a one-row count of bad lines."""
    text = spark.read.text(path).where(strip(F.col("value")) != "")
    df = text.select(F.from_json("value", schema + ", _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("r")).select("r.*")
    return df.where("_bad is null").drop("_bad"), df.agg(F.count("_bad").alias("bad"))


def jsonl_strict(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path, mode="FAILFAST")


def json_array(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path, multiLine=True)


def sniff_json(spark: SparkSession, path: str) -> str:
    """``array`` where the first character is a bracket, ``sharegpt`` where the first rows have conversations, else ``jsonl``."""
    head = [r[0] for r in spark.read.text(path).where(F.trim("value") != "").limit(5).collect()]
    if not head:
        return "jsonl"
    if head[0].lstrip().startswith("["):
        return "array"
    try:
        rows = [json.loads(x) for x in head]
    except ValueError:
        return "jsonl"
    return "sharegpt" if rows and all(isinstance(r, dict) and "conversations" in r for r in rows) else "jsonl"


def parquet(spark: SparkSession, path: str | list[str], recursive: bool = False) -> DataFrame:
    """A file, a folder or a glob of shards, with the shard's name and the place in it for order: _file, _row."""
    reader = spark.read.option("recursiveFileLookup", str(recursive).lower())
    df = reader.parquet(*([path] if isinstance(path, str) else path))
    return df.withColumns({"_file": F.col("_metadata.file_path"), "_row": F.col("_metadata.row_index")})


def text_corpus(spark: SparkSession, path: str, aliases: tuple[str, ...] = TEXT_COLUMNS) -> DataFrame:
    """The text column of a corpus under any of its usual names; only that column is read."""
    df = parquet(spark, path, recursive=True)
    for a in aliases:
        if a in df.columns:
            return df.select("_file", "_row", F.col(a).cast("string").alias("text"))
    raise ValueError(f"none of {aliases} among {df.columns}")


def row_count(spark: SparkSession, path: str) -> int:
    """From footers alone: a count with no column."""
    return spark.read.parquet(path).count()


def csv(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """With a header; tab-separated files have no quotes, and bytes that are no UTF-8 are replaced."""
    if sep == "\t":
        df = spark.read.csv(path, header=True, sep=sep, quote="")
        return df.select(*[decoded(F.col(f"`{c}`")).alias(c) for c in df.columns])
    return spark.read.csv(path, header=True, sep=sep, quote='"', escape='"', multiLine=True)


def label_first(spark: SparkSession, path: str) -> DataFrame:
    """``label;text`` lines, parted at the first semicolon, leading percent signs dropped."""
    pattern = r"^%*([^;]*);(.*)$"
    return lines(spark, path).where(F.col("_raw").contains(";")).select("_file", "_line", strip(F.regexp_extract("_raw", pattern, 1)).alias("label"), strip(F.regexp_extract("_raw", pattern, 2)).alias("text"))


def label_last(spark: SparkSession, path: str) -> DataFrame:
    """``text;label`` lines, parted at the last semicolon; lines without one have no label."""
    pattern = r"^(.*);([^;]*)$"
    some = F.col("_raw").contains(";")
    text = F.when(some, F.regexp_extract("_raw", pattern, 1)).otherwise(F.col("_raw"))
    return lines(spark, path).select("_file", "_line", F.when(some, strip(F.regexp_extract("_raw", pattern, 2))).alias("label"), strip(text).alias("text"))


def message_lines(spark: SparkSession, path: str) -> DataFrame:
    """One message a line from many files, byte-order marks dropped, the file's name beside it."""
    df = spark.read.text(path).select(F.col("_metadata.file_name").alias("page"), strip(F.replace("value", F.lit("﻿"), F.lit(""))).alias("text"))
    return df.where("text <> ''")


def decoded_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of files that are UTF-8 or, each as a whole, Latin-1."""
    df = spark.read.format("binaryFile").load(path)
    text = F.when(F.is_valid_utf8(F.col("content").cast("string")), F.decode("content", "UTF-8")).otherwise(F.decode("content", "ISO-8859-1"))
    rows = df.select(F.element_at(F.split("path", "/"), -1).alias("page"), F.posexplode(F.split(text, r"\r\n|\n|\r")).alias("pos", "text"))
    return rows.select("page", (F.col("pos") + 1).cast("long").alias("_line"), strip(F.replace("text", F.lit("﻿"), F.lit(""))).alias("text")).where("text <> ''")


def files(spark: SparkSession, path: str, hashes: bool = False) -> DataFrame:
    """A folder as a table: path, bytes, modified, and sha256 where asked for (files up to 2 GB). Empty files have a row too."""
    p, fs = _path(spark, path)
    rows, found = [], fs.listFiles(p, True)
    while found.hasNext():
        f = found.next()
        rows.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    listing = spark.createDataFrame(rows, "path string, bytes long, ms long").select("path", "bytes", F.timestamp_millis("ms").alias("modified"))
    if not hashes:
        return listing
    content = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", F.sha2("content", 256).alias("sha256"))
    return listing.join(content, "path", "left").withColumn("sha256", F.when(F.col("bytes") == 0, EMPTY_SHA256).otherwise(F.col("sha256")))


def data_files(listing: DataFrame) -> DataFrame:
    """Finished data files only: no caches, locks and part files."""
    return listing.where(~F.col("path").rlike(r"(/\.cache/|/\.git/|\.incomplete$|\.lock$|\.tmp$|\.part$|/\.[^/]*$)"))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """A JSON manifest as one row."""
    return spark.read.json(path, multiLine=True)


def prompts(spark: SparkSession, path: str) -> DataFrame:
    """A checked list of prompts; raises on missing or repeated ids and on blank language or prompt."""
    raw = spark.read.schema("id string, language string, prompt string, category string, description string, expected_behavior string").json(path, multiLine=True)
    bad = raw.where(F.coalesce(strip(F.col("id")), F.lit("")).isin("") | F.coalesce(strip(F.col("language")), F.lit("")).isin("") | F.coalesce(strip(F.col("prompt")), F.lit("")).isin("")).count()
    twice = raw.groupBy("id").count().where("count > 1").count()
    if bad or twice:
        raise ValueError(f"{bad} prompts lack id, language or prompt; {twice} ids are repeated")
    return raw.fillna({"category": "uncategorized", "description": "", "expected_behavior": ""})


def pool(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """``train`` and ``holdout`` of a slice, as far as they are there, in this order."""
    out = None
    for i, part in enumerate(("train", "holdout")):
        p = f"{folder.rstrip('/')}/{part}.jsonl"
        if exists(spark, p):
            df = spark.read.schema(schema).json(p).withColumn("_src_ord", F.lit(i))
            out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is None:
        raise FileNotFoundError(folder)
    return out


def union_all(*parts: DataFrame) -> DataFrame:
    """All parts in a fixed order, kept as ``_src_ord``."""
    out = None
    for i, df in enumerate(parts):
        df = df.withColumn("_src_ord", F.lit(i))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def numbered(df: DataFrame, order: list[str | Column], prefix: str, to: str = "id") -> DataFrame:
    """Running ids in an order, at least six digits. The rows are parted by ranges; the count of the parts before goes before each."""
    at = cut(df.orderBy(*order).withColumn("__n", F.monotonically_increasing_id()))
    part = F.shiftright("__n", 33)
    counts = at.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__rows"))
    before = F.coalesce(F.sum("__rows").over(Window.partitionBy(F.lit(0)).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # one row a part
    placed = at.withColumn("__part", part).join(F.broadcast(counts.select("__part", before.alias("__before"))), "__part")
    return placed.withColumn(to, F.format_string(prefix + "%06d", F.col("__before") + F.col("__n").bitwiseAND(F.lit((1 << 33) - 1)))).drop("__part", "__n", "__before")
