"""Integrity, lineage and run-log operators."""

from __future__ import annotations

import datetime as dt
import json
import subprocess
import time

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def changed_files(before: DataFrame, after: DataFrame) -> DataFrame:
    """path, change (added, removed, changed) between two listings with hashes."""
    a, b = before.select("path", F.col("sha256").alias("old")), after.select("path", F.col("sha256").alias("new"))
    c = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").when(F.col("old") != F.col("new"), "changed")
    return a.join(b, "path", "full").select("path", c.alias("change")).where("change is not null")


def verify_manifest(manifest: DataFrame, listing: DataFrame, critical: list[str] = ()) -> DataFrame:
    """name, status (ok, missing, size, sha256, unlisted) and critical of every file of either side, by name."""
    have = listing.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("bytes").alias("has_bytes"), F.col("sha256").alias("has_sha"))
    both = manifest.select("name", F.col("bytes").alias("want_bytes"), F.col("sha256").alias("want_sha")).join(have, "name", "full")
    status = F.when(F.col("has_sha").isNull(), "missing").when(F.col("want_sha").isNull(), "unlisted").when(F.col("want_bytes") != F.col("has_bytes"), "size").when(F.col("want_sha") != F.col("has_sha"), "sha256").otherwise("ok")
    return both.select("name", status.alias("status"), F.col("name").isin(*critical).alias("critical"))


def build_manifest(listing: DataFrame) -> DataFrame:
    """name, bytes, sha256 of a listing with hashes, to verify a copy by."""
    return listing.select(F.element_at(F.split("path", "/"), -1).alias("name"), "bytes", "sha256")


def missing_files(listing: DataFrame, required: list[str]) -> DataFrame:
    """name, result (PASS, empty, missing) of the files that a finished folder needs."""
    want = listing.sparkSession.createDataFrame([(x,) for x in required], "name string")
    have = listing.groupBy(F.element_at(F.split("path", "/"), -1).alias("name")).agg(F.max("bytes").alias("bytes"))
    return want.join(have, "name", "left").select("name", F.when(F.col("bytes").isNull(), "missing").when(F.col("bytes") == 0, "empty").otherwise("PASS").alias("result"))


def settings(found: dict, wanted: dict, prefix: str = "") -> list[tuple[str, str]]:
    """(name, what is wrong) of every setting of ``wanted``, nested as it is, that isn't so in ``found``."""
    out = []
    for k, v in wanted.items():
        name = f"{prefix}{k}"
        if k not in found:
            out.append((name, "missing"))
        elif isinstance(v, dict) and isinstance(found[k], dict):
            out += settings(found[k], v, name + ".")
        elif found[k] != v:
            out.append((name, f"{found[k]!r}, not {v!r}"))
    return out


def verify_provenance(listing: DataFrame, records: DataFrame) -> DataFrame:
    """name, result of every data file: whether a provenance record (file, bytes, sha256) is there and holds."""
    have = listing.where(~F.col("path").endswith(".provenance.json")).select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("bytes").alias("b"), F.col("sha256").alias("s"))
    said = records.select(F.col("file").alias("name"), F.col("bytes").alias("sb"), F.col("sha256").alias("ss"))
    result = F.when(F.col("ss").isNull(), "no record").when(F.col("s").isNull(), "no file").when((F.col("b") != F.col("sb")) | (F.col("s") != F.col("ss")), "changed").otherwise("PASS")
    return have.join(said, "name", "full").select("name", result.alias("result"))


def checked_fingerprint(listing: DataFrame, sidecar: str) -> bool:
    """Whether the fingerprint of the files is the stored one; where none is stored it is computed and kept."""
    import os

    from tamis.sources.writers import json_atomic

    now = fingerprint(listing)
    if not os.path.exists(sidecar):
        json_atomic(sidecar, {"fingerprint": now})
        return True
    with open(sidecar, encoding="utf-8") as f:
        return json.load(f)["fingerprint"] == now


def run_step(name: str, command: list[str], output: str | None = None, timeout: float | None = None) -> dict:
    """Runs an external command and tells: name, exit code, seconds, last line it said, and the lines of its output file."""
    began = time.time()
    try:
        done = subprocess.run(command, capture_output=True, text=True, timeout=timeout)
        code, said = done.returncode, (done.stdout + done.stderr).strip()
    except (OSError, subprocess.TimeoutExpired) as e:
        code, said = -1, str(e)
    rows = None
    if output:
        try:
            with open(output, "rb") as f:
                rows = sum(1 for line in f if line.strip())
        except OSError:
            pass
    return {"name": name, "exit_code": code, "seconds": round(time.time() - began, 3), "said": said.splitlines()[-1] if said else "", "rows": rows}


def complete_checkpoints(listing: DataFrame, required: list[str]) -> DataFrame:
    """folder, step, complete of every checkpoint folder: complete where each required file is there and not empty."""
    f = listing.select(F.regexp_extract("path", r"^(.*checkpoint-(\d+))/", 1).alias("folder"), F.regexp_extract("path", r"checkpoint-(\d+)/", 1).alias("step"), F.element_at(F.split("path", "/"), -1).alias("name"), "bytes").where("step <> ''")
    return f.groupBy("folder", F.col("step").cast("long").alias("step")).agg((F.count_distinct(F.when(F.col("name").isin(*required) & (F.col("bytes") > 0), F.col("name"))) == len(required)).alias("complete"))


def latest_checkpoint(checkpoints: DataFrame) -> DataFrame:
    return checkpoints.where("complete").agg(F.max_by("folder", "step").alias("folder"), F.max("step").alias("step"))


def preflight(listing: DataFrame, expected: DataFrame) -> DataFrame:
    """name, result (PASS, FAIL) of expected files: there, of the size and the hash."""
    v = verify_manifest(expected, listing)
    return v.where("status <> 'unlisted'").select("name", F.when(F.col("status") == "ok", "PASS").otherwise("FAIL").alias("result"))


def gate(results: DataFrame) -> bool:
    """Whether everything passed; nothing to pass is a failure."""
    r = results.agg(F.bool_and(F.col("result") == "PASS")).first()[0]
    return bool(r)


def integrity_report(derived: DataFrame, source: DataFrame, preserved: list[str], sampled: str, fraction: float, holdout: DataFrame | None = None, ident: str = "line_no", language: str = "language", content: Column | None = None, expected: DataFrame | None = None) -> DataFrame:
    """check, ok, detail of a table derived from another: subset, no repeated key, classes kept whole, the sampled class near its fraction, no leak, contents unchanged, rows as expected (a table of one ``rows``)."""

    def none(n: DataFrame, name: str) -> DataFrame:
        return n.select(F.lit(name).alias("check"), (F.col("n") == 0).alias("ok"), F.col("n").cast("string").alias("detail"))

    count = F.count(F.lit(1)).alias("n")
    out = none(derived.select(ident).join(source.select(ident), ident, "left_anti").agg(count), "subset_of_source")
    out = out.unionByName(none(derived.groupBy(ident).agg(F.count(F.lit(1)).alias("c")).agg(F.count_if(F.col("c") > 1).alias("n")), "no_repeated_key"))
    a = derived.groupBy(language).agg(F.count(F.lit(1)).alias("d"))
    b = source.groupBy(language).agg(F.count(F.lit(1)).alias("s"))
    both = b.join(a, language, "left").withColumn("d", F.coalesce("d", F.lit(0)))
    out = out.unionByName(both.where(F.col(language).isin(preserved)).agg(F.coalesce(F.bool_and(F.col("d") == F.col("s")), F.lit(True)).alias("ok")).select(F.lit("classes_preserved").alias("check"), "ok", F.lit(",".join(preserved)).alias("detail")))
    ratio = both.where(F.col(language) == sampled).agg(F.coalesce(F.try_divide(F.sum("d"), F.sum("s")), F.lit(0.0)).alias("r"))
    out = out.unionByName(ratio.select(F.lit("sampled_fraction").alias("check"), (F.abs(F.col("r") - fraction) <= 0.005).alias("ok"), F.format_string("%.4f", "r").alias("detail")))
    if holdout is not None:
        out = out.unionByName(none(derived.join(holdout.select(ident), ident, "left_semi").agg(count), "no_leak"))
    if content is not None:
        # a row is the same where key and checksum meet
        mark = lambda df: df.select(ident, F.xxhash64(content).alias("c1"), F.xxhash64(F.lit("c"), content).alias("c2"))
        out = out.unionByName(none(mark(derived).join(mark(source), [ident, "c1", "c2"], "left_anti").agg(count), "content_unchanged"))
    if expected is not None:
        rows = derived.agg(count).crossJoin(F.broadcast(expected.select("rows")))
        out = out.unionByName(rows.select(F.lit("rows_expected").alias("check"), (F.col("n") == F.col("rows")).alias("ok"), F.col("n").cast("string").alias("detail")))
    return out


def secrets(df: DataFrame, text: str, pattern: str = r"hf_[A-Za-z0-9]{20,}") -> DataFrame:
    """Rows that hold something like a credential, and how many."""
    return df.withColumn("hits", F.regexp_count(text, F.lit(pattern))).where("hits > 0")


def runs(flags: DataFrame, group: str, pos: str, flag: Column) -> DataFrame:
    """``group``, start, stop, length of each run of places where ``flag`` holds (gaps and islands)."""
    w = Window.partitionBy(group).orderBy(pos)
    f = flags.where(flag).withColumn("island", F.col(pos) - F.row_number().over(w))
    return f.groupBy(group, "island").agg(F.min(pos).alias("start"), F.max(pos).alias("stop"), F.count(F.lit(1)).alias("length")).drop("island")


def trained_spans(df: DataFrame, ident: str, messages: str = "messages") -> DataFrame:
    """Runs of assistant turns in each record, from the turns alone."""
    flags = df.select(ident, F.posexplode(messages).alias("pos", "m"))
    return runs(flags, ident, "pos", F.col("m.role") == "assistant")


def trainer_log(spark: SparkSession, path: str) -> DataFrame:
    """The steps of a trainer's state file."""
    return spark.read.json(path, multiLine=True).select(F.explode("log_history").alias("h")).select("h.*")


def parse_log(df: DataFrame, text: str, fields: dict[str, str]) -> DataFrame:
    """Numbers found in log text by a pattern each, and whether any was."""
    cols = {k: F.regexp_extract(text, p, 1) for k, p in fields.items()}
    out = df.withColumns({k: F.when(c != "", c).cast("double") for k, c in cols.items()})
    return out.withColumn("parsed", F.coalesce(*[F.col(k) for k in fields]).isNotNull())


def accrued_cost(df: DataFrame, seconds: str, rate: float, budget: float, threshold: float = 1.0) -> DataFrame:
    """Adds cost so far and whether the share of the budget is reached."""
    return df.withColumn("cost", F.col(seconds) * F.lit(rate)).withColumn("over_budget", F.col("cost") >= F.lit(budget * threshold))


def rollup(df: DataFrame, text: str, seconds: str, tokens: str) -> DataFrame:
    """One row over inference results: items, non-empty, seconds, tokens, tokens a second, all_pass."""
    full = F.coalesce(F.length(F.trim(text)), F.lit(0)) > 0
    return df.agg(F.count(F.lit(1)).alias("items"), F.count_if(full).alias("non_empty"), F.sum(seconds).alias("seconds"), F.sum(tokens).alias("tokens"), F.try_divide(F.sum(tokens), F.sum(seconds)).alias("tokens_per_second"), F.coalesce(F.bool_and(full), F.lit(False)).alias("all_pass"))


def receipt(df: DataFrame, by: list[str], tokens: Column | None = None, **extra) -> dict:
    """A manifest of a table: counts by each column, hash over ordered keys left to the caller, time in UTC."""
    out: dict = {"generated_at": dt.datetime.now(dt.timezone.utc).isoformat(), **extra}
    for c in by:
        rows = df.groupBy(c).agg(F.count(F.lit(1)).alias("n"), *([F.sum(tokens).alias("t")] if tokens is not None else [])).orderBy(c).collect()
        out[c] = {str(r[c]): ({"n": r["n"], "tokens": r["t"]} if tokens is not None else r["n"]) for r in rows}
    return out


def selection_receipt(train: DataFrame, holdout: DataFrame, rejected: DataFrame, by: list[str], tokens: Column, **said) -> dict:
    """A manifest of a selection: train and holdout by column with tokens, rejections by reason, sources, and what else is said of it."""
    out = receipt(train, [], **said)
    for name, df in (("train", train), ("holdout", holdout)):
        part = receipt(df, by, tokens)
        part.pop("generated_at")
        out[name] = part | {"total": df.count()}
    out["rejected"] = {r["reject_reason"]: r["n"] for r in rejected.collect()}
    out["sources"] = sorted(r[0] for r in train.select("source").unionByName(holdout.select("source")).where("source is not null").distinct().collect())
    return out


def fingerprint(listing: DataFrame) -> str:
    """One hash over all files: names and hashes in order of the name."""
    return listing.agg(F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", F.element_at(F.split("path", "/"), -1), "sha256"))), "\n"), 256)).first()[0]
