"""Validation rules that report every defect of a record as data.

Raw lines (a VARIANT, where missing, null and wrongly typed differ) and typed rows are first brought to
one intermediate form; the rules are built on it as one array of defects, so a table is read once and
nothing is shuffled but for repeated ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamis.functions.text import blank
from tamis.session import spread
from tamis.spec import Schema

ERROR = "struct<code:string,message:string,field:string>"


def _err(code: str, field: str | Column | None, message: str | Column) -> Column:
    f = F.lit(field).cast("string") if not isinstance(field, Column) else field
    return F.struct(F.lit(code).alias("code"), (message if isinstance(message, Column) else F.lit(message)).alias("message"), f.alias("field"))


def _when(cond: Column, code: str, field, message) -> Column:
    return F.when(F.coalesce(cond, F.lit(False)), _err(code, field, message))


def intermediate_raw(df: DataFrame, schema: Schema) -> DataFrame:
    """From parsed lines (``_raw`` and ``v``): keys, type and value of each field, and the turns."""

    def kind(f: str) -> Column:
        return F.schema_of_variant(F.try_variant_get("v", f"$.{f}", "variant"))

    def text(f: str) -> Column:
        return F.when(kind(f) == "STRING", F.try_variant_get("v", f"$.{f}", "string"))

    def turn(m: Column) -> Column:
        role, content = F.try_variant_get(m, "$.role", "variant"), F.try_variant_get(m, "$.content", "variant")
        return F.struct(
            F.coalesce(F.schema_of_variant(m).startswith("OBJECT"), F.lit(False)).alias("obj"),
            role.isNotNull().alias("has_role"),
            content.isNotNull().alias("has_content"),
            F.when(F.schema_of_variant(role) == "STRING", F.try_variant_get(m, "$.role", "string")).alias("role"),
            F.when(F.schema_of_variant(content) == "STRING", F.try_variant_get(m, "$.content", "string")).alias("content"),
        )

    is_obj = F.coalesce(F.schema_of_variant("v").startswith("OBJECT"), F.lit(False))
    kinds = {f: kind(f) for f in schema.known}
    df = df.withColumn("is_object", is_obj).withColumn("keys", F.when(F.col("is_object"), F.json_object_keys("_raw")))
    df = df.withColumns({f"k_{f}": k for f, k in kinds.items()} | {f"t_{f}": text(f) for f in schema.known if f not in ("messages", "code_switching", "quality")})
    df = df.withColumn("turns", F.when(F.col("k_messages").startswith("ARRAY"), F.transform(F.expr("cast(try_variant_get(v, '$.messages', 'array<variant>') as array<variant>)"), turn)))
    flags = F.when(F.col("k_quality").startswith("OBJECT"), F.json_object_keys(F.get_json_object("_raw", "$.quality")))
    bad = F.array_compact(F.array(*[F.when((t := F.schema_of_variant(F.try_variant_get("v", f"$.quality.{q}", "variant"))).isNotNull() & (t != "BOOLEAN"), F.lit(q)) for q in schema.quality_flags]))
    return with_order(df).withColumns({"q_unknown": F.array_except(flags, F.array(*map(F.lit, schema.quality_flags))), "q_bad": bad})


def intermediate_typed(df: DataFrame, schema: Schema) -> DataFrame:
    """From a typed table: required fields are there (perhaps null), optional ones where they are not null."""
    have = {f: F.col(f) if f in df.columns else F.lit(None).cast("string") for f in schema.known}
    keys = F.array_compact(F.array(*[F.lit(f) if f in schema.required else F.when(have[f].isNotNull(), F.lit(f)) for f in schema.known]))
    kinds = {f: F.when(have[f].isNull(), "VOID" if f in schema.required else None).otherwise({"messages": "ARRAY", "code_switching": "BOOLEAN", "quality": "OBJECT"}.get(f, "STRING")) for f in schema.known}
    turn = lambda m: F.struct(m.isNotNull().alias("obj"), F.lit(True).alias("has_role"), F.lit(True).alias("has_content"), m["role"].alias("role"), m["content"].alias("content"))
    none = F.array().cast("array<string>")
    df = df.withColumns(
        {"is_object": F.lit(True), "keys": keys, "turns": F.transform(have["messages"], turn), "q_unknown": none, "q_bad": none}
        | {f"k_{f}": k for f, k in kinds.items()}
        | {f"t_{f}": have[f] for f in schema.known if f not in ("messages", "code_switching", "quality")}
    )
    return with_order(df)


def with_order(df: DataFrame) -> DataFrame:
    """Adds what the rules on the turns share, each computed once a record: the first broken turn, the turns before it, and the roles."""
    indexed = F.transform("turns", lambda m, i: F.struct(m.alias("m"), i.alias("i")))
    any_of = lambda p: F.exists("turns", lambda m: F.coalesce(m["content"].rlike(p), F.lit(False)))
    df = df.withColumns({"__indexed": indexed, "__roles": F.transform("turns", lambda m: m["role"]), "__arabic": any_of("[؀-ۿ]"), "__latin": any_of("[A-Za-z]")})
    broken = lambda x: ~x["m"]["obj"] | ~x["m"]["has_role"] | ~x["m"]["has_content"]
    df = df.withColumns({"__stop": F.try_element_at(F.filter("__indexed", broken), F.lit(1)), "__body": F.filter("__roles", lambda r: r.isNull() | (r != "system"))})
    return df.withColumns({"__before": F.when(F.col("__stop").isNull(), F.col("__indexed")).otherwise(F.slice("__indexed", F.lit(1), F.coalesce(F.col("__stop.i"), F.lit(0)))), "__twice": F.exists(F.zip_with(F.slice("__body", F.lit(1), F.greatest(F.size("__body") - 1, F.lit(0))), F.slice("__body", F.lit(2), F.greatest(F.size("__body") - 1, F.lit(0))), lambda a, b: F.coalesce(a == b, F.lit(False))), lambda x: x)})


def message_errors(schema: Schema) -> Column:
    """Defects of the turns; a malformed turn ends the look at the order of turns."""
    t, stop, before = F.col("turns"), F.col("__stop"), F.col("__before")
    place = lambda x: F.concat(F.lit("messages["), x["i"].cast("string"), F.lit("]"))
    first = F.array(
        F.when(stop.isNotNull() & ~stop["m"]["obj"], _err("invalid_type", place(stop), "a turn is not an object"))
        .when(stop.isNotNull() & ~stop["m"]["has_role"], _err("missing_field", F.concat(place(stop), F.lit(".role")), "a turn has no role"))
        .when(stop.isNotNull(), _err("missing_field", F.concat(place(stop), F.lit(".content")), "a turn has no content"))
    )
    roles_bad = F.transform(F.filter(before, lambda x: ~F.coalesce(x["m"]["role"].isin(*schema.roles), F.lit(False))), lambda x: _err("invalid_role", F.concat(place(x), F.lit(".role")), "unknown role"))
    content_bad = F.transform(
        F.filter(before, lambda x: x["m"]["content"].isNull() | blank(x["m"]["content"])),
        lambda x: F.when(x["m"]["content"].isNull(), _err("invalid_type", F.concat(place(x), F.lit(".content")), "content is not a string")).otherwise(_err("empty_content", F.concat(place(x), F.lit(".content")), "content is blank")),
    )
    roles, body = F.col("__roles"), F.col("__body")
    system = F.filter(roles, lambda r: r == "system")
    ordered = stop.isNull()
    has_body = ordered & (F.size(body) > 0)
    wrong = F.col("__twice")
    order = F.array(
        _when(ordered & (F.size(system) > 1), "invalid_ordering", "messages", "more than one system turn"),
        _when(ordered & (F.array_position(roles, "system") > 1), "invalid_ordering", "messages", "the system turn is not the first"),
        _when(ordered & (F.size(body) == 0), "empty_messages", "messages", "nothing after the system turn"),
        _when(has_body & ~F.coalesce(F.try_element_at(body, F.lit(1)) == "user", F.lit(False)), "invalid_ordering", "messages", "the first turn is not the user's"),
        _when(has_body & wrong, "invalid_ordering", "messages", "turns do not alternate"),
        _when(has_body & ~F.coalesce(F.try_element_at(body, F.lit(-1)) == "assistant", F.lit(False)), "invalid_ordering", "messages", "the last turn is not the assistant's"),
    )
    whole = F.array(_when(F.size(t) < schema.min_turns, "too_few_turns", "messages", "too few turns"))
    empty = F.array(_err("empty_messages", "messages", "no turns"))
    none = F.array().cast(f"array<{ERROR}>")
    return F.when(t.isNull(), none).when(F.size(t) == 0, empty).otherwise(F.concat(whole, first, roles_bad, content_bad, order))


def record_errors(schema: Schema) -> Column:
    """All defects of a record over the intermediate columns."""
    has = lambda f: F.coalesce(F.array_contains("keys", f), F.lit(False))
    k, t = (lambda f: F.col(f"k_{f}")), (lambda f: F.col(f"t_{f}"))
    not_str = lambda f: has(f) & ~F.coalesce(k(f) == "STRING", F.lit(False))
    out = [_when(~has(f), "missing_field", f, f"{f} is missing") for f in schema.required]
    out.append(
        F.when(not_str("id"), _err("invalid_type", "id", "id is not a string"))
        .when(has("id") & blank(t("id")), _err("empty_id", "id", "id is blank"))
        .when(has("id") & ~t("id").rlike(schema.id_pattern), _err("invalid_id", "id", "id has other characters"))
    )
    out.append(_when(has("messages") & ~F.coalesce(k("messages").startswith("ARRAY"), F.lit(False)), "invalid_type", "messages", "messages is not a list"))
    for f, allowed in (("category", schema.categories), ("language", schema.languages), ("script", schema.scripts), ("difficulty", schema.difficulties)):
        if f in schema.required:
            out.append(F.when(not_str(f), _err("invalid_type", f, f"{f} is not a string")).when(has(f) & ~t(f).isin(*allowed), _err(f"invalid_{f}", f, f"{f} is unknown")))
        else:
            out.append(_when(has(f) & ~F.coalesce(t(f).isin(*allowed), F.lit(False)), f"invalid_{f}", f, f"{f} is unknown"))
    out.append(F.when(not_str("source"), _err("invalid_type", "source", "source is not a string")).when(has("source") & blank(t("source")), _err("empty_source", "source", "source is blank")))
    out.append(_when(has("code_switching") & ~F.coalesce(k("code_switching") == "BOOLEAN", F.lit(False)), "invalid_type", "code_switching", "code_switching is not a boolean"))
    out += [_when(not_str(f), "invalid_type", f, f"{f} is not a string") for f in ("subcategory", "variation_group")]
    out.append(_when(has("quality") & ~F.coalesce(k("quality").startswith("OBJECT"), F.lit(False)), "invalid_type", "quality", "quality is not an object"))
    arabic, latin = F.col("__arabic"), F.col("__latin")
    both = has("language") & has("script") & t("language").isNotNull() & t("script").isNotNull() & F.col("turns").isNotNull()
    scripted = has("script") & F.col("turns").isNotNull()
    out += [
        _when(both & (t("language") == "ar") & (t("script") != "arabic"), "language_script_mismatch", "script", "Arabic is not in Arabic script"),
        _when(both & (t("language") == "arabizi") & (t("script") != "latin"), "language_script_mismatch", "script", "Arabizi is not in Latin script"),
        _when(scripted & (t("script") == "arabic") & ~arabic, "script_content_mismatch", "script", "no Arabic letter"),
        _when(scripted & (t("script") == "latin") & arabic & ~latin, "script_content_mismatch", "script", "only Arabic letters"),
    ]
    flags = F.concat(
        F.transform(F.coalesce("q_unknown", F.array().cast("array<string>")), lambda q: _err("invalid_quality_flag", F.concat(F.lit("quality."), q), "unknown flag")),
        F.transform(F.coalesce("q_bad", F.array().cast("array<string>")), lambda q: _err("invalid_quality_flag", F.concat(F.lit("quality."), q), "a flag is not a boolean")),
    )
    unknown = F.transform(F.array_except(F.coalesce("keys", F.array().cast("array<string>")), F.array(*map(F.lit, schema.known))), lambda x: _err("unknown_field", x, "unknown field"))
    return F.array_compact(F.concat(F.array(*out), message_errors(schema), flags, unknown))


def validate_lines(parsed: DataFrame, schema: Schema = Schema()) -> DataFrame:
    """Every line of a file with its defects: _file, _line, record_id, errors (empty for a sound record)."""
    m = intermediate_raw(parsed, schema)
    errors = F.when(F.col("defect") == "invalid_json", F.array(_err("invalid_json", None, "the line is no JSON"))).when(~F.col("is_object"), F.array(_err("invalid_type", None, "the line is no object"))).otherwise(record_errors(schema))
    return m.select("_file", "_line", F.col("t_id").alias("record_id"), errors.alias("errors"))


def validate_table(df: DataFrame, line: str, schema: Schema = Schema(), keep: list[str] = ()) -> DataFrame:
    """Every row of a typed table with its defects: line, record_id, errors. Columns beside the schema's are ignored."""
    m = intermediate_typed(spread(df.select(line, *[c for c in schema.known if c in df.columns], *[c for c in keep if c not in schema.known])), schema)
    return m.select(F.col(line).alias("line"), F.col("t_id").alias("record_id"), *keep, record_errors(schema).alias("errors"))


def duplicate_ids(df: DataFrame, ident: str = "id", line: str = "line_no") -> DataFrame:
    """Each later row of an id: line, record_id, code, message, field; the message names the first row.

    First rows are found by a partial aggregate, so an id that a third of all rows share is no hot partition.
    """
    ids = df.where(~F.coalesce(blank(F.col(ident)), F.lit(True))).select(F.col(line).alias("line"), F.col(ident).alias("record_id"))
    first = ids.groupBy("record_id").agg(F.min("line").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    later = ids.join(first, "record_id").where("line > first")
    place = F.col("first._line") if dict(ids.dtypes)["line"].startswith("struct") else F.col("first")
    return later.select("line", "record_id", F.lit("duplicate_id").alias("code"), F.concat(F.lit("first on line "), place.cast("string")).alias("message"), F.lit("id").alias("field"))


def error_rows(validated: DataFrame, line: str = "line") -> DataFrame:
    """Long form: line, record_id, seq, code, message, field."""
    # the outer form, as a filter inferred from the inner one would work the rules out again below each projection
    rows = validated.select(F.col(line).alias("line"), "record_id", F.posexplode_outer("errors").alias("seq", "e")).where("seq is not null")
    return rows.select("line", "record_id", "seq", "e.code", "e.message", "e.field")


def code_counts(errors: DataFrame) -> DataFrame:
    return errors.groupBy("code").agg(F.count(F.lit(1)).alias("n"))


def valid_rows(df: DataFrame, validated: DataFrame, line: str, ident: str = "id") -> DataFrame:
    """Rows without a defect whose id stands once only: all rows of a repeated id go, the first too."""
    sound = validated.where("size(errors) = 0").select(F.col("line").alias(line))
    twice = df.where(F.col(ident).isNotNull()).groupBy(ident).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select(ident)
    return df.join(sound, line, "left_semi").join(twice, ident, "left_anti")


def report(validated: DataFrame, duplicates: DataFrame | None = None) -> DataFrame:
    """One row: total, valid, invalid records, errors, and ok."""
    bad = validated.select("line", "errors")
    if duplicates is not None:
        bad = bad.join(duplicates.select("line", F.lit(1).alias("dup")), "line", "left")
    else:
        bad = bad.withColumn("dup", F.lit(None).cast("int"))
    wrong = (F.size("errors") > 0) | F.col("dup").isNotNull()
    agg = bad.agg(F.count(F.lit(1)).alias("total_records"), F.count_if(~wrong).alias("valid_records"), F.count_if(wrong).alias("invalid_records"), F.coalesce(F.sum(F.size("errors") + F.when(F.col("dup").isNotNull(), 1).otherwise(0)), F.lit(0)).alias("error_count"))
    return agg.withColumn("ok", F.col("error_count") == 0)


def gate(df: DataFrame, reasons: list[tuple[str, Column]]) -> DataFrame:
    """Adds ``reject_reason``: the name of the first condition that holds, null for rows that pass."""
    out = F.lit(None).cast("string")
    for name, cond in reversed(reasons):
        out = F.when(F.coalesce(cond, F.lit(False)), name).otherwise(out)
    return df.withColumn("reject_reason", out)


def first_occurrence(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of each key, by an order that is total."""
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")
