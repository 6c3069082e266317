"""Command line: validate, stats, dedupe (id, content), export, retention, mixture, inspect, doctor. Exit code 0: sound, 1: defects, 2: wrong use or missing file."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.functions.messages import contents, tokens_assistant, tokens_total
from tamis.operators import audit, budget, dedup, integrity, mixture, profile, validate
from tamis.session import cut, get_spark
from tamis.sources import readers, writers
from tamis.spec import CANONICAL, MixtureSpec, RetentionSpec


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tamis")
    sub = p.add_subparsers(dest="verb", required=True)

    def verb(name: str, *flags: tuple, path: bool = True) -> None:
        s = sub.add_parser(name)
        if path:
            s.add_argument("path")
        for names, how in flags:
            s.add_argument(*names, **how)

    out = (("--out",), {})
    verb("validate", (("--max-errors",), {"type": int, "default": 20}), (("--strict",), {"action": "store_true"}), out)
    verb("stats", out)
    verb("dedupe", (("--mode",), {"choices": ["id", "content"], "default": "id"}), (("--threshold",), {"type": float, "default": 0.8}), (("--field",), {}), (("--log",), {}), (("--dry-run",), {"action": "store_true"}), (("--out",), {"required": True}))
    verb("export", (("--keep-metadata",), {"action": "store_true"}), (("--out",), {"required": True}))
    verb("retention", (("--config",), {"required": True}), (("--mode",), {"choices": ["count", "tokens"], "default": "count"}), (("--scale",), {"type": float, "default": 1.0}), (("--seed",), {"type": int}), (("--template-cap",), {"type": int}), (("--template-source",), {}), (("--train-out",), {"required": True}), (("--holdout-out",), {"required": True}), (("--manifest-out",), {}))
    verb("mixture", (("--slice",), {"action": "append", "required": True, "metavar": "NAME=PATH"}), (("--holdout",), {"action": "append", "default": []}), (("--config",), {"required": True}), (("--json",), {"action": "store_true"}), path=False)
    verb("inspect", (("--rows",), {"type": int, "default": 5}))
    verb("doctor", (("--max-tokens",), {"type": int, "default": 4096}))
    return p


def _records(spark: SparkSession, path: str) -> DataFrame:
    """Records of a file with their place in it."""
    return readers.lines(spark, path).select("_file", "_line", F.from_json("_raw", CANONICAL).alias("r")).select("_file", "_line", "r.*").withColumn("line_no", F.struct("_file", "_line"))


def _validate(spark: SparkSession, a) -> int:
    v = cut(validate.validate_lines(readers.jsonl(spark, a.path)).withColumn("line", F.struct("_file", "_line")))
    twice = cut(validate.duplicate_ids(v, "record_id", "line"))
    rep = validate.report(v, twice).first().asDict()
    rows = validate.error_rows(v).unionByName(twice.select("line", "record_id", F.lit(0).alias("seq"), "code", "message", "field"))
    shown = rows.orderBy("line", "code", "seq")
    for e in (shown if a.max_errors == 0 else shown.limit(a.max_errors)).toLocalIterator():
        print(f"{e['line']['_line']}: {e['code']} {e['field'] or ''} {e['message']}")
    print(json.dumps(rep))
    if a.out:
        writers.json_atomic(a.out, rep)
    return int(not rep["ok"] or (a.strict and rep["total_records"] == 0))


def _dedupe(spark: SparkSession, a) -> int:
    rows = _records(spark, a.path)
    before = rows.count()
    if a.mode == "id":
        kept = dedup.by_id(rows, "id", "line_no")
    else:
        text = F.col(a.field) if a.field else contents(F.col("messages"), "\n")
        classes = cut(dedup.near_duplicates(rows.select("line_no", text.alias("t")), "line_no", "t", a.threshold))
        kept = rows.join(classes.where("line_no = class_id").select("line_no"), "line_no", "left_semi")
    kept = cut(kept)
    row = dedup.decision(before, kept.count(), a.field or ("id" if a.mode == "id" else "messages.content"), a.threshold, input=a.path, output=a.out)
    print(json.dumps(row))
    if a.log:
        dedup.append_decision(spark, a.log, row)
    if not a.dry_run:
        writers.jsonl(kept.drop("line_no"), a.out)
    return 0


def _retention(spark: SparkSession, a) -> int:
    spec = RetentionSpec.load(a.config)
    over = {k: v for k, v in (("seed", a.seed), ("template_cap", a.template_cap), ("template_source", a.template_source)) if v is not None}
    spec = type(spec)(**(spec.__dict__ | over))
    rows = _records(spark, a.path)
    pick = budget.select_by_count if a.mode == "count" else budget.select_by_tokens
    s = pick(rows, spec, a.scale)
    train, holdout = cut(s.train), cut(s.holdout)
    if train.join(holdout.select("id"), "id", "left_semi").limit(1).count():
        raise ValueError("train and holdout share records")
    writers.jsonl(train.drop("line_no", "tokens_total", "tokens_assistant"), a.train_out)
    writers.jsonl(holdout.drop("line_no", "tokens_total", "tokens_assistant"), a.holdout_out)
    tokens = tokens_assistant(F.col("messages"))
    said = integrity.selection_receipt(train, holdout, s.rejected, ["category", "source"], tokens, candidates=rows.count(), mode=a.mode, plan=s.receipt)
    print(json.dumps({"train": said["train"]["total"], "holdout": said["holdout"]["total"], "rejected": said["rejected"]}))
    if a.manifest_out:
        writers.json_atomic(a.manifest_out, said)
    return 0


def _mixture(spark: SparkSession, a) -> int:
    spec, rows, kept = MixtureSpec.load(a.config), None, None
    for name, path in (x.split("=", 1) for x in a.slice):
        part = _records(spark, path).withColumn("slice", F.lit(name))
        rows = part if rows is None else rows.unionByName(part)
    for path in a.holdout:
        part = _records(spark, path).select("id")
        kept = part if kept is None else kept.unionByName(part)
    report = [r.asDict() for r in mixture.slice_report(rows, spec).orderBy("slice").collect()]
    wrong = [r.asDict() for r in mixture.mixture_violations(rows, spec, holdout=kept).orderBy("slice", "violation").collect()]
    if a.json:
        print(json.dumps({"slices": report, "violations": wrong}, ensure_ascii=False))
    else:
        for r in report:
            print(f"{r['slice']}: {r['examples']} examples, {r['actual_share']:.4f} of {r['share']}")
        for v in wrong:
            print(f"{v['violation']}: {v['slice']} {v['detail']}")
    return int(bool(wrong))


def main(argv: list[str] | None = None) -> int:
    a = _parser().parse_args(argv)
    spark = get_spark()
    try:
        if a.verb == "validate":
            return _validate(spark, a)
        if a.verb == "dedupe":
            return _dedupe(spark, a)
        if a.verb == "retention":
            return _retention(spark, a)
        if a.verb == "mixture":
            return _mixture(spark, a)
        df = _records(spark, a.path)
        if a.verb == "stats":
            said = profile.dataset_profile(df).first().asDict()
            print(json.dumps(said, ensure_ascii=False))
            if a.out:
                writers.json_atomic(a.out, said)
        elif a.verb == "inspect":
            for r in audit.inspect(df, "id", ["category", "source", "language", "messages"], a.rows).collect():
                print(json.dumps(r.asDict(), ensure_ascii=False))
        elif a.verb == "doctor":
            found = audit.doctor(df, tokens_total(F.col("messages")), a.max_tokens).collect()
            for r in found:
                print(f"{r['finding']}: {r['n']}")
            return int(any(r["n"] for r in found))
        else:
            writers.export_sharegpt(df, a.out, a.keep_metadata)
        return 0
    except (FileNotFoundError, ValueError) as e:
        print(e, file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(main())
