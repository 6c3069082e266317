"""Incremental ingestion: only new files are read, validated, and merged by id. An extension of batch ingestion."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.operators.validate import record_errors, intermediate_raw
from tamis.session import shared_path
from tamis.sources.readers import exists
from tamis.spec import CANONICAL, Schema


def stream_lines(spark: SparkSession, folder: str, max_files: int = 1000) -> DataFrame:
    return spark.readStream.option("maxFilesPerTrigger", max_files).text(folder).select(F.col("value").alias("_raw"), F.col("_metadata.file_path").alias("_file"))


def ingest(spark: SparkSession, folder: str, target: str, checkpoint: str, schema: Schema = Schema()) -> None:
    """Reads what is new in ``folder``; sound records whose id the target lacks are appended there, defects beside it.

    Of several records of an id in a batch the first by file and line is kept. Each batch is idempotent: it writes to a folder named by its number, so a batch that is run again
    after a failure replaces what it left.
    """

    def batch(df: DataFrame, n: int) -> None:
        parsed = df.withColumn("_at", F.monotonically_increasing_id()).where(F.trim("_raw") != "").withColumn("v", F.try_parse_json("_raw"))
        judged = intermediate_raw(parsed, schema).withColumn("errors", F.when(~F.coalesce(F.col("is_object"), F.lit(False)), F.array(F.struct(F.lit("invalid_json").alias("code"), F.lit("no object").alias("message"), F.lit(None).cast("string").alias("field")))).otherwise(record_errors(schema)))
        sound = judged.where("size(errors) = 0").select(F.from_json("_raw", CANONICAL).alias("r"), "_file", "_at", "_raw").select("r.*", F.struct("_file", "_at", "_raw").alias("_first"))
        first = sound.groupBy("id").agg(F.min("_first").alias("_first"))
        good = sound.join(first, ["id", "_first"], "left_semi").drop("_first")
        if exists(spark, f"{target}/batch=*"):
            done = spark.read.schema(CANONICAL + ", batch long").parquet(target).where(F.col("batch") != n)
            good = good.join(done.select("id"), "id", "left_anti")
        good.write.mode("overwrite").parquet(f"{target}/batch={n}")
        judged.where("size(errors) > 0").select("_file", "_raw", F.to_json("errors").alias("errors")).write.mode("overwrite").json(f"{target}_errors/batch={n}")

    q = stream_lines(spark, folder).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def first_seen(stream: DataFrame, ident: str, time: str, delay: str = "1 hour") -> DataFrame:
    """Keeps the first row of each id whose repetitions come within the delay."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([ident])


def windowed_counts(stream: DataFrame, time: str, by: list[str], width: str = "1 hour", slide: str | None = None, delay: str = "1 hour") -> DataFrame:
    """Rows in tumbling or sliding windows, late ones up to the delay."""
    w = F.window(time, width, slide) if slide else F.window(time, width)
    return stream.withWatermark(time, delay).groupBy(w, *by).agg(F.count(F.lit(1)).alias("n"))


def run_to_table(result: DataFrame, name: str) -> DataFrame:
    """Runs a stream over what is there and gives its last complete result, kept in the shared folder."""
    spark = result.sparkSession
    top = shared_path(spark, f"{name}-{uuid.uuid4().hex}")
    out = f"{top}/result"

    def keep(df: DataFrame, n: int) -> None:
        df.write.mode("overwrite").parquet(out)

    q = result.writeStream.foreachBatch(keep).outputMode("complete").option("checkpointLocation", f"{top}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(out) if exists(spark, out) else spark.createDataFrame([], result.schema)
