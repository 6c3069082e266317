"""Problem 7: a consistent form of texts that look the same, and the records that differ only in it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamis.llm.arrow import turns
from tamis.operators.joins import hot_split_join, lookup_join
from tamis.session import cut, spread


def canonical_messages(records: DataFrame, key: str = "line_no") -> DataFrame:
    """``key`` and the messages with every content in its canonical form.

    Null messages and contents stay null, empty ones empty; repeated rows stay as they are.
    """
    kinds = dict(records.dtypes)

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        from tamis.llm.forms import canonical

        for b in batches:
            col = b.column(1)
            flat = col.flatten()
            new = pa.array([canonical(x) for x in pc.struct_field(flat, "content").to_pylist()], pa.string())
            role = pc.struct_field(flat, "role")
            values = pa.StructArray.from_arrays([role, new], names=["role", "content"], mask=pc.is_null(flat))
            n = pc.fill_null(pc.list_value_length(col), 0).to_numpy(zero_copy_only=False)
            offsets = pa.array([0, *n.cumsum().tolist()], pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(offsets, values, mask=pc.is_null(col))], names=[key, "messages"])

    return spread(records.select(key, "messages")).mapInArrow(run, f"`{key}` {kinds[key]}, messages array<struct<role:string,content:string>>")


def fingerprints(records: DataFrame, key: str = "line_no") -> DataFrame:
    """``key``, the fingerprint of how a record looks, and that of its characters (128 bits each).

    Roles and null contents are part of both; records without messages have none and are left out.
    """
    kinds = dict(records.dtypes)

    def run(batches):
        import pyarrow as pa
        import xxhash

        from tamis.llm.forms import canonical

        digest = xxhash.xxh3_128_digest
        for b in batches:
            start, end, roles, contents = turns(b.column(1))
            forms = list(map(canonical, contents))
            looks, raws = [], []
            for s, e in zip(start, end):
                # lengths in front keep ('ab', 'c') and ('a', 'bc') apart
                for into, part in ((looks, forms), (raws, contents)):
                    t = "".join([f"{r}\x1f{-1 if c is None else len(c)}\x1f{c}" for r, c in zip(roles[s:e], part[s:e])])
                    into.append(digest(t.encode("utf-8", "surrogatepass")))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(looks, pa.binary()), pa.array(raws, pa.binary())], names=[key, "look", "raw"])

    some = spread(records.where("size(messages) > 0").select(key, "messages"))
    return some.mapInArrow(run, f"`{key}` {kinds[key]}, look binary, raw binary")


def lookalike_rows(records: DataFrame, key: str = "line_no") -> DataFrame:
    """The fingerprints of the rows whose look is shared by rows of other characters."""
    prints = cut(fingerprints(records, key))
    several = cut(prints.groupBy("look").agg(F.min("raw").alias("lo"), F.max("raw").alias("hi")).where("lo <> hi").select("look"))
    return cut(lookup_join(prints, several, ["look"], salt_by=key))


def lookalike_classes(records: DataFrame, key: str = "line_no") -> DataFrame:
    """The rows that look like others and differ in their characters: ``key``, class_id (least ``key`` of the look), variant (least ``key`` with the same characters), variants (of the look)."""
    rows = lookalike_rows(records, key)
    variants = rows.groupBy("look", "raw").agg(F.min(key).alias("variant"))
    named = cut(variants.groupBy("look").agg(F.min("variant").alias("class_id"), F.count(F.lit(1)).alias("variants")))
    both = cut(lookup_join(variants, named, ["look"], salt_by="raw"))
    return hot_split_join(rows, both, ["look", "raw"]).select(key, "class_id", "variant", "variants")


def lookalike_pairs(records: DataFrame, key: str = "line_no") -> DataFrame:
    """Pairs of different rows (``line_a`` < ``line_b``) that look the same and differ in their characters.

    Rows equal character by character form one class; only looks with several classes go on, and
    members meet by pairs of classes, so copies of one text are never compared with each other.
    """
    rows = lookalike_rows(records, key)
    classes = rows.select("look", "raw").distinct()
    a, b = classes.select("look", F.col("raw").alias("raw_a")), classes.select("look", F.col("raw").alias("raw_b"))
    met = cut(a.join(b, "look").where("raw_a < raw_b"))
    one = lookup_join(rows.select("look", F.col("raw").alias("raw_a"), F.col(key).alias("x")), met, ["look", "raw_a"], salt_by="x")
    two = one.join(rows.select("look", F.col("raw").alias("raw_b"), F.col(key).alias("y")), ["look", "raw_b"])
    return two.select(F.least("x", "y").alias("line_a"), F.greatest("x", "y").alias("line_b")).where("line_a < line_b").distinct()
