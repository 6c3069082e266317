"""Writers, exports and receipts."""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import os
import tempfile

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamis.functions.messages import messages_valid, to_sharegpt


def sorted_struct(df: DataFrame):
    """All columns in the order of their names, so that equal rows give equal text."""
    return F.struct(*[F.col(f"`{c}`") for c in sorted(df.columns) if not c.startswith("_")])


def jsonl(df: DataFrame, path: str, order: str = "id", mode: str = "overwrite") -> None:
    """One object a line, keys sorted, non-ASCII as it is, rows in order; internal columns are dropped. Files follow the order."""
    body = df.select(F.col(order).alias("_o"), F.to_json(sorted_struct(df), {"ignoreNullFields": "true"}).alias("value"))
    body.orderBy("_o").select("value").write.mode(mode).text(path)


def append_jsonl(df: DataFrame, path: str) -> None:
    df.select(F.to_json(sorted_struct(df), {"ignoreNullFields": "true"}).alias("value")).write.mode("append").text(path)


def json_atomic(path: str, value) -> None:
    """Small receipts on the driver: written beside, then moved."""
    fd, tmp = tempfile.mkstemp(dir=os.path.dirname(os.path.abspath(path)))
    with os.fdopen(fd, "w", encoding="utf-8") as f:
        json.dump(value, f, ensure_ascii=False, sort_keys=True, indent=2)
    os.replace(tmp, path)


def pointer(path: str, target: str) -> None:
    """A file that names another, for example the latest; moved into place as a whole."""
    fd, tmp = tempfile.mkstemp(dir=os.path.dirname(os.path.abspath(path)))
    with os.fdopen(fd, "w", encoding="utf-8") as f:
        f.write(target + "\n")
    os.replace(tmp, path)


def provenance(path: str, about: dict) -> str:
    """A sidecar beside a finished file: what is said of it, its size, hash and time; both are made read-only. Returns the sidecar's path."""
    with open(path, "rb") as f:
        digest = hashlib.file_digest(f, "sha256").hexdigest()
    side = path + ".provenance.json"
    if os.path.exists(side):
        os.chmod(side, 0o644)
    json_atomic(side, about | {"file": os.path.basename(path), "bytes": os.path.getsize(path), "sha256": digest, "recorded_at": dt.datetime.now(dt.timezone.utc).isoformat()})
    for p in (path, side):
        os.chmod(p, 0o444)
    return side


def sharegpt(df: DataFrame, keep_metadata: bool = False) -> DataFrame:
    """Conversations for training; with metadata also id, category, source and language."""
    keep = ["id", "category", "source", "language"] if keep_metadata else []
    return df.select(to_sharegpt(F.col("messages")).alias("conversations"), *keep)


def export_sharegpt(df: DataFrame, path: str, keep_metadata: bool = False, validate: bool = True) -> int:
    """Writes the export; refuses a table with an invalid record. Returns the rows written."""
    if validate:
        bad = df.where(~messages_valid(F.col("messages"))).limit(1).count()
        if bad:
            raise ValueError("some records are invalid; nothing was written")
    sharegpt(df, keep_metadata).write.mode("overwrite").json(path)
    return df.count()


def alpaca(df: DataFrame, columns: dict[str, str | None]) -> DataFrame:
    """Instruction, input and output from the columns named; missing ones are empty."""
    return df.select(*[F.coalesce(F.col(columns[k]).cast("string"), F.lit("")).alias(k) if columns.get(k) else F.lit("").alias(k) for k in ("instruction", "input", "output")])


def alpaca_with_ids(df: DataFrame, columns: dict[str, str | None], row: str) -> tuple[DataFrame, DataFrame]:
    """Strict rows with their row number, and a sidecar by it with all other columns and the hash of the passage."""
    used = {v for v in columns.values() if v}
    rest = [c for c in df.columns if c not in used and c != row]
    passage = F.coalesce(F.col(columns["input"]).cast("string"), F.lit("")) if columns.get("input") else F.lit("")
    side = df.select(F.col(row).alias("row"), *rest, F.when(passage != "", F.sha2(passage, 256)).alias("passage_sha256"))
    strict = df.select(F.col(row).alias("row"), *[F.coalesce(F.col(columns[k]).cast("string"), F.lit("")).alias(k) if columns.get(k) else F.lit("").alias(k) for k in ("instruction", "input", "output")])
    return strict, side


def export_alpaca(df: DataFrame, columns: dict[str, str | None], row: str, path: str) -> None:
    """Strict rows under ``data`` and the sidecar under ``ids``, both in the order of the row number, which the strict rows don't show."""
    strict, side = alpaca_with_ids(df, columns, row)
    strict.orderBy("row").drop("row").write.mode("overwrite").json(f"{path}/data", ignoreNullFields=False)
    side.orderBy("row").write.mode("overwrite").json(f"{path}/ids")


def csv_report(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").csv(path, header=True)


def markdown(df: DataFrame, title: str, limit: int = 1000) -> str:
    """A small aggregate as a Markdown table."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError("only aggregates are rendered")
    head = "| " + " | ".join(df.columns) + " |\n|" + "---|" * len(df.columns)
    body = "\n".join("| " + " | ".join("" if v is None else f"{v:,}" if isinstance(v, int) and not isinstance(v, bool) else f"{v:.4g}" if isinstance(v, float) else str(v) for v in r) + " |" for r in rows)
    return f"## {title}\n\n{head}\n{body}\n"


def splits(df: DataFrame, path: str, raw: str = "_raw", split: str = "split") -> dict[str, int]:
    """Writes raw lines by split, unchanged, and reads them again: every line must be there as often as before."""
    df.select(raw, split).write.mode("overwrite").partitionBy(split).text(path)
    back = df.sparkSession.read.text(path)
    lost = df.select(F.col(raw).alias("value"), F.col(split).cast("string").alias(split)).exceptAll(back.select("value", F.col(split).cast("string").alias(split))).limit(1).count()
    if lost:
        raise OSError("lines were changed by writing")
    return {r[split]: r["count"] for r in df.groupBy(split).count().collect()}
