"""Made-up records for tests and trials, by rule from their number alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.functions.messages import canonical_messages
from tamis.spec import Schema

#: Kinds of malformed lines, one after the other.
DEFECTS = ("no_json", "no_object", "no_id", "no_messages", "empty_messages", "unknown_role", "assistant_first", "blank_content", "unknown_category", "unknown_language", "more_fields", "number_as_content")


def _turn(values: tuple[str, ...], n: Column, every: int = 1) -> Column:
    """The values in turn, each ``every`` numbers long."""
    return F.element_at(F.array(*map(F.lit, values)), (F.pmod(F.floor(n / every), F.lit(len(values))) + 1).cast("int"))


def records(spark: SparkSession, n: int, language: str = "en", sources: tuple[str, ...] = ("synthetic_a", "synthetic_b"), prefix: str = "syn", schema: Schema = Schema()) -> DataFrame:
    """``n`` valid canonical records; categories, difficulties and sources take turns."""
    i = F.col("id")
    asked = F.format_string("Question %d: what follows from the number %d?", i, i * 7)
    told = F.format_string("Answer %d: the number that follows is %d.", i, i * 7 + 1)
    return spark.range(n).select(
        F.format_string(prefix + "-%06d", i).alias("id"), canonical_messages(asked, told).alias("messages"), _turn(schema.categories, i).alias("category"), _turn(sources, i).alias("source"), F.lit(language).alias("language"),
        _turn(schema.difficulties, i, len(schema.categories)).alias("difficulty"), F.struct(F.lit(True).alias("synthetic")).alias("quality"),
    )


def malformed_lines(spark: SparkSession, n: int) -> DataFrame:
    """``n`` raw lines (n, defect, line), each with one defect of ``DEFECTS`` in turn."""
    i = F.col("n")
    ident, tail = F.format_string('"id": "bad-%06d"', i), F.lit('"category": "coding", "source": "s", "language": "en"')
    turns = lambda *x: F.lit('"messages": [' + ", ".join(f'{{"role": "{r}", "content": {c}}}' for r, c in x) + "]")
    good = (("user", '"q"'), ("assistant", '"a"'))

    def obj(*parts: Column) -> Column:
        return F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))

    line = {
        "no_json": F.lit("{not json"), "no_object": F.lit("[1, 2]"), "no_id": obj(turns(*good), tail), "no_messages": obj(ident, tail), "empty_messages": obj(ident, turns(), tail),
        "unknown_role": obj(ident, turns(("robot", '"q"'), good[1]), tail), "assistant_first": obj(ident, turns(*reversed(good)), tail), "blank_content": obj(ident, turns(("user", '"  "'), good[1]), tail),
        "unknown_category": obj(ident, turns(*good), F.lit('"category": "?", "source": "s", "language": "en"')), "unknown_language": obj(ident, turns(*good), F.lit('"category": "coding", "source": "s", "language": "xx"')),
        "more_fields": obj(ident, turns(*good), tail, F.lit('"extra": 1')), "number_as_content": obj(ident, turns(("user", "3"), good[1]), tail),
    }
    rows = spark.range(n).select(F.col("id").alias("n")).withColumn("defect", _turn(DEFECTS, i))
    out = F.lit(None).cast("string")
    for k, c in line.items():
        out = F.when(F.col("defect") == k, c).otherwise(out)
    return rows.withColumn("line", out)


def duplicates(df: DataFrame, every: int, copies: int = 1, number: str = "id") -> DataFrame:
    """The rows, and ``copies`` more of about one in ``every``, by the hash of a column."""
    again = df.where(F.pmod(F.xxhash64(number), F.lit(every)) == 0)
    out = df
    for _ in range(copies):
        out = out.unionByName(again)
    return out
