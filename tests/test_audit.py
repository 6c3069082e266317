import json

import pytest
from helpers import RECORD, good, record, write_lines
from pyspark.sql import functions as F

from tamis.cli import main
from tamis.functions import adapters as A
from tamis.functions.messages import tokens_total
from tamis.operators import audit, dedup, integrity, mixture
from tamis.operators import validate as V
from tamis.sources import readers, synthetic, writers
from tamis.spec import CANONICAL, SliceSpec, SpecError


def counts(df):
    return {(r[0], r[1]): r[2] for r in df.collect()}


def test_pool_audit(spark):
    rows = [("احسب المعادلة", "هذا هو الحل الذي يمكن أن يكون في هذه المسألة التي تم حلها", "a"), ("", "x", "a"), ("احسب المعادلة ", " هذا هو الحل الذي يمكن أن يكون في هذه المسألة التي تم حلها", None)]
    got = counts(audit.pool_audit(spark.createDataFrame(rows, "i string, o string, s string"), "i", "o", "s"))
    assert got["register", "msa"] == 2 and got["malformed", "empty_instruction_or_output"] == 1 and got["task", "mathematics"] == 2 and got["duplicates", "exact_pair"] == 1 and got["source", "None"] == 1
    hist = {r["value"]: r["n"] for r in audit.capped_histogram(spark.createDataFrame([(x,) for x in (0, 1, 5, 9, 70)], "v int"), F.col("v"), 5).collect()}
    assert hist == {0: 1, 1: 1, 5: 3}


def test_samples_and_shares(spark):
    df = spark.createDataFrame([(i, "s" if i % 3 else None, f"t{i}", i) for i in range(30)], "id long, source string, text string, n long")
    got = {r["source"]: r for r in audit.class_samples(df, "source", F.lit("all"), "text", "id", 5).collect()}
    assert got["s"]["n"] == 20 and len(got["s"]["samples"]) == 5 and got[None]["n"] == 10
    pct = {r["source"]: r["pct"] for r in audit.contributions(df, "source", F.col("n")).collect()}
    assert pct == {"s": 68.97, None: 31.03}
    check = counts(audit.selection_check(df.where("id < 20"), df.where("id >= 18"), "id", flag=F.col("n") > 0))
    assert check["check", "overlap"] == 2 and check["check", "unflagged"] == 1 and check["train", "s"] + check["train", "None"] == 20
    part = audit.within_shares(df.na.fill("x"), "source", "n", {"s": 0.1, "x": 0.05})
    assert {r["source"]: r["t"] <= 435 * (0.1 if r["source"] == "s" else 0.05) for r in part.groupBy("source").agg(F.sum("n").alias("t")).collect()} == {"s": True, "x": True}
    bands = spark.range(1).select(*[audit.length_bands(F.lit(x), [1000, 3000]).alias(str(x)) for x in (10, 1000, 5000)]).first()
    assert tuple(bands) == (0, 1, 2)
    assert len(audit.inspect(df, "id", ["id", "text"], 3).collect()) == 3
    capped = {r["template"]: (r["kept"], r["dropped"]) for r in audit.cap_counts(df, F.coalesce("source", F.lit("-")), 12, F.col("text")).collect()}
    assert capped == {"s": (12, 8), "-": (10, 0)}


def test_schema_and_doctor(spark, tmp_path):
    p = write_lines(tmp_path / "x.jsonl", [good(), good(extra=1), good(messages=[{"role": "user"}]), good(messages=3)])
    got = counts(audit.key_scan(readers.jsonl(spark, p)))
    assert got["id", "STRING"] == 4 and got["extra", "BIGINT"] == 1 and got["messages", "ARRAY"] == 3 and got["messages.content", "MISSING"] == 1 and got["messages.role", "STRING"] == 5
    df = spark.createDataFrame([record(1), record(2, messages=None), record(3, messages=[("user", "x"), ("user", " ")]), record(4, assistant="y" * 900), record(5, assistant="a<|end|>")], RECORD)
    found = {r["finding"]: r["n"] for r in audit.doctor(df, tokens_total(F.col("messages")), 100).collect()}
    assert found == {"no_messages": 1, "over_limit": 1, "no_answer": 1, "ends_without_answer": 1, "blank_turn": 1, "same_role_twice": 1, "marker_in_text": 1}
    there = {r["field"]: (r["filled"], r["missing"]) for r in audit.field_presence(df, ["messages", "script"]).collect()}
    assert there == {"messages": (4, 1), "script": (0, 5)}
    texts = spark.createDataFrame([("هذا نص",), ("le chat est dans la maison",), ("the cat is in the house",), ("chnowa 3andek lyoum barcha",), ("zzz",), (None,)], "t string")
    assert [r[0] for r in texts.select(audit.language_guess(F.col("t"))).collect()] == ["ar", "fr", "en", "arabizi", "unknown", "unknown"]


def test_pools(spark):
    both = lambda df: [(tuple(m["content"] for m in r["messages"]), r["category"], r["language"], r["id"]) for r in df.collect()]
    i = spark.createDataFrame([("7", "do", "this", "done"), ("8", "do", " ", None)], "index string, instruction string, input string, output string")
    assert both(A.load_pool(i, "instruction", "s", ident="index")) == [(("do\nthis", "done"), "general_instruction", "ar", "s-7"), (("do", ""), "general_instruction", "ar", "s-8")]
    c = spark.createDataFrame([(json.dumps([{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]),), ("[]",), ("bad",)], "conversations string")
    assert both(A.load_pool(c, "conversation", "s"))[0][:3] == (("q", "a"), "general_instruction", "ar") and A.load_pool(c, "conversation", "s").count() == 1
    m = spark.createDataFrame([("arb", "q", "a"), ("fra", "q", "a"), ("arb", " ", "a")], "language_code string, inputs string, targets string")
    assert A.load_pool(m, "language", "s").count() == 1
    d = spark.createDataFrame([("x", None, "y", "French"), ("x", None, "y", "odd"), ("x", None, "y", None)], "instruction string, input string, output string, dialect string")
    assert [(r["language"], r["code_switching"]) for r in A.load_pool(d, "dialect", "s").collect()] == [("fr", True), ("mixed", False), ("mixed", False)]
    t = spark.createDataFrame([("x", "y", "Health"), ("x", "y", None)], "instruction string, response string, category string")
    assert [r["category"] for r in A.load_pool(t, "topic", "s").collect()] == ["knowledge_qa", "general_instruction"]
    x = spark.createDataFrame([("one. two. three",), (" ",), (None,)], "text string")
    rows = A.load_pool(x, "text", "s", switching=True).collect()
    assert len(rows) == 1 and [m["role"] for m in rows[0]["messages"]] == ["user", "assistant", "user", "assistant"] and rows[0]["code_switching"]
    with pytest.raises(ValueError):
        A.load_pool(x, "odd", "s")


def test_other_adapters(spark):
    s = spark.createDataFrame([(1, "a  b", "1"), (2, "c", "9")], "ID long, text string, label string")
    assert [r["messages"][1]["content"] for r in A.sentiment(s, "Tell", "s").collect()] == ["positive", "neutral"]
    t = spark.createDataFrame([("x", "y"), ("z", " ")], "arabish string, CODA string")
    assert [r["messages"][1]["content"] for r in A.transliteration(t, F.lit("1"), "P", "s").collect()] == ["y", "z"]
    c = spark.createDataFrame([(1, "كتاب جميل في المكتبة"), (2, "short"), (3, "long enough but latin")], "n long, t string")
    assert A.corpus_lines(c, F.col("t"), F.col("n").cast("string"), "Read", "s").count() == 2
    kept, why = A.arabic_corpus(c, "t")
    assert kept.count() == 1 and {r["reason"]: r["n"] for r in why.collect()} == {"kept": 1, "short": 1, "no_arabic": 1}
    f = spark.createDataFrame([("Pourquoi le chat dort", "parce que la nuit est longue"), ("xxxxxxxxxxxx", "yyyyyyyyyyyy")], "instruction string, response string")
    assert [r["language"] for r in A.french_qa(f, "s").collect()] == ["fr"]
    m = spark.createDataFrame([("1+1", "2", "t"), ("", "2", "t"), ("q", None, "t")], "query string, response string, type string")
    rows, bad = A.math_rows(m, "s")
    assert rows.count() == 1 and {r["reason"]: r["n"] for r in bad.collect()} == {"empty_query": 1, "empty_response": 1}
    assert A.text_dialogues(c, F.col("n").cast("string"), F.col("t"), "s").count() == 3
    assert [r[0] for r in A.retag(m, F.lit("x")).select("category").distinct().collect()] == ["x"]
    assert spark.range(1).select(A.alias_targets(F.lit("instruction_following"), {"instruction_following": "general_instruction"})).first()[0] == "general_instruction"


def test_keys_and_lines(spark):
    a, b = (spark.createDataFrame([(x,) for x in xs], "id string") for xs in (["a", "b", "b", None], ["b", "c", "a"]))
    assert tuple(mixture.key_relation(a, b).first()) == (0, 1, 2, True, False) and mixture.is_subset(a, b) and not mixture.same_keys(a, b)
    assert sorted(r["id"] for r in mixture.union_keys(a, b).collect()) == ["a", "b", "c"]
    df = spark.createDataFrame([("train", "x", "s1", True), ("val", "x", "s2", None), ("val", "y", None, False), ("train", "y", "s1", True), ("train", "x", "s1", True)], "split string, line string, sub string, code_switching boolean")
    assert [tuple(r) for r in mixture.line_overlap(df, "split", F.col("line")).collect()] == [("train", "val", 2)]
    assert mixture.sub_corpora(df, "sub", include=["s1"]).count() == 3 and mixture.sub_corpora(df, "sub", exclude=["s1"]).count() == 2 and mixture.code_switched(df).count() == 3
    n = spark.createDataFrame([(0, "a"), (1, "b")], "row long, x string")
    assert mixture.zip_rows(n, n.select("row", F.upper("x").alias("y")), "row").orderBy("row").collect()[1]["y"] == "B"
    with pytest.raises(ValueError):
        mixture.zip_rows(n, n.limit(1).withColumnRenamed("x", "y"), "row")
    g = spark.createDataFrame([("abc  DEF", "abc def"), ("ab", "ab"), (None, "x")], "a string, b string")
    assert [r[0] for r in g.select(dedup.jaccard(dedup.char_grams(F.col("a")), dedup.char_grams(F.col("b")))).collect()] == [1.0, 0.0, 0.0]


def test_synthetic_records(spark, tmp_path):
    df = synthetic.records(spark, 60)
    writers.jsonl(df, str(tmp_path / "ok"))
    v = V.validate_lines(readers.jsonl(spark, str(tmp_path / "ok")))
    assert v.count() == 60 and v.where("size(errors) > 0").count() == 0
    bad = synthetic.malformed_lines(spark, 2 * len(synthetic.DEFECTS))
    bad.select("line").coalesce(1).write.text(str(tmp_path / "bad"))
    v = V.validate_lines(readers.jsonl(spark, str(tmp_path / "bad")))
    assert v.count() == 24 and v.where("size(errors) = 0").count() == 0
    assert synthetic.duplicates(df, 3, 2).count() > 60


def test_integrity_of_folders(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"x")
    (tmp_path / "b.bin").write_bytes(b"")
    listing = lambda: readers.files(spark, str(tmp_path), hashes=True)
    assert {r["name"]: r["result"] for r in integrity.missing_files(listing(), ["a.bin", "b.bin", "c.bin"]).collect()} == {"a.bin": "PASS", "b.bin": "empty", "c.bin": "missing"}
    made = integrity.build_manifest(listing())
    assert {r["status"] for r in integrity.verify_manifest(made, listing()).collect()} == {"ok"}
    assert integrity.settings({"a": 1, "b": {"c": 2}}, {"a": 1, "b": {"c": 3, "d": 4}, "e": 5}) == [("b.c", "2, not 3"), ("b.d", "missing"), ("e", "missing")]
    side = str(tmp_path.parent / "print.json")
    assert integrity.checked_fingerprint(listing(), side) and integrity.checked_fingerprint(listing(), side)
    writers.provenance(str(tmp_path / "a.bin"), {"source": "s"})
    (tmp_path / "c.bin").write_bytes(b"y")
    said = spark.read.json(str(tmp_path / "a.bin.provenance.json"), multiLine=True)
    assert {r["name"]: r["result"] for r in integrity.verify_provenance(listing(), said).collect()} == {"a.bin": "PASS", "b.bin": "no record", "c.bin": "no record"}
    assert not integrity.checked_fingerprint(listing(), side)
    step = integrity.run_step("count", ["python3", "-c", "print('12 rows')"], str(tmp_path / "c.bin"))
    assert (step["exit_code"], step["said"], step["rows"]) == (0, "12 rows", 1) and integrity.run_step("none", ["/no/such"])["exit_code"] == -1
    cost = integrity.accrued_cost(spark.createDataFrame([(10.0,), (20.0,)], "s double"), "s", 0.5, 10.0)
    assert [(r["cost"], r["over_budget"]) for r in cost.collect()] == [(5.0, False), (10.0, True)]


def test_slice_spec(tmp_path):
    p = tmp_path / "s.yaml"
    p.write_text("name: d\nlanguages: [ar]\nscripts: [arabic]\nanchor: coding\nmultipliers: {coding: 1.0}\n")
    assert SliceSpec.load(p).multipliers == {"coding": 1.0}
    p.write_text("name: d\nlanguages: [xx]\nmultipliers: {odd: 1.0}\n")
    with pytest.raises(SpecError):
        SliceSpec.load(p)


def test_command_line(spark, tmp_path, capsys):
    pool = str(tmp_path / "pool")
    writers.jsonl(synthetic.records(spark, 200), pool)
    (tmp_path / "r.yaml").write_text("targets: {coding: 10, mathematics: 10}\nholdout_size: 5\nlanguages: [en]\n")
    args = ["retention", pool, "--config", str(tmp_path / "r.yaml"), "--train-out", str(tmp_path / "train"), "--holdout-out", str(tmp_path / "hold"), "--manifest-out", str(tmp_path / "m.json")]
    assert main(args) == 0
    said = json.loads((tmp_path / "m.json").read_text())
    assert said["train"]["total"] == 20 and said["holdout"]["total"] == 5 and said["candidates"] == 200
    assert spark.read.schema(CANONICAL).json(str(tmp_path / "train")).count() == 20
    (tmp_path / "x.yaml").write_text("slices:\n  a: {share: 0.5, purpose: p}\n  b: {share: 0.5, purpose: q}\n")
    mix = ["mixture", "--slice", f"a={tmp_path / 'train'}", "--slice", f"b={tmp_path / 'hold'}", "--config", str(tmp_path / "x.yaml"), "--json"]
    capsys.readouterr()
    assert main(mix) == 0 and json.loads(capsys.readouterr().out)["violations"] == []
    assert main([*mix, "--holdout", str(tmp_path / "hold")]) == 1
    twice = write_lines(tmp_path / "twice.jsonl", [good(id="a"), good(id="a"), good(id="b")])
    for mode, left in (("id", 2), ("content", 1)):
        assert main(["dedupe", twice, "--mode", mode, "--out", str(tmp_path / mode), "--log", str(tmp_path / "log")]) == 0
        assert spark.read.json(str(tmp_path / mode)).count() == left
    assert spark.read.json(str(tmp_path / "log")).count() == 2
    assert main(["inspect", twice]) == 0 and main(["doctor", twice]) == 0 and main(["stats", twice, "--out", str(tmp_path / "st.json")]) == 0
    assert main(["export", twice, "--out", str(tmp_path / "e")]) == 0 and main(["mixture", "--slice", "a=/none", "--config", str(tmp_path / "x.yaml")]) == 2
    capsys.readouterr()
    assert main(["validate", twice, "--max-errors", "0", "--out", str(tmp_path / "v.json")]) == 1 and json.loads((tmp_path / "v.json").read_text())["error_count"] == 1
    assert "2: duplicate_id id first on line 1" in capsys.readouterr().out
