from pyspark.sql import functions as F

from tamis.functions import adapters as A
from tamis.functions import formats
from tamis.functions import messages as M
from tamis.operators import dedup, integrity
from tamis.sources import readers


def test_files_and_manifest(spark, tmp_path):
    d = tmp_path / "checkpoint-20"
    d.mkdir()
    (d / "a.bin").write_bytes(b"abc")
    (d / "b.bin").write_bytes(b"")
    (tmp_path / "checkpoint-10").mkdir()
    for n in ("a.bin", "b.bin"):
        (tmp_path / "checkpoint-10" / n).write_bytes(b"x")
    listing = readers.files(spark, str(tmp_path), hashes=True)
    c = integrity.complete_checkpoints(listing, ["a.bin", "b.bin"])
    assert {r["step"]: r["complete"] for r in c.collect()} == {10: True, 20: False}
    assert integrity.latest_checkpoint(c).first()["step"] == 10
    before = listing
    before = spark.createDataFrame(before.collect(), before.schema)
    (d / "a.bin").write_bytes(b"abd")
    after = readers.files(spark, str(tmp_path), hashes=True)
    assert [r["change"] for r in integrity.changed_files(before, after).collect()] == ["changed"]
    (d / "b.bin").write_bytes(b"y")
    want = spark.createDataFrame([("a.bin", 3, "0"), ("c.bin", 1, "0")], "name string, bytes long, sha256 string")
    got = {r["name"]: r["status"] for r in integrity.verify_manifest(want, readers.files(spark, str(d), hashes=True), ["c.bin"]).collect()}
    assert got == {"a.bin": "sha256", "b.bin": "unlisted", "c.bin": "missing"}
    assert not integrity.gate(integrity.preflight(readers.files(spark, str(d), hashes=True), want))


def test_logs(spark):
    df = spark.createDataFrame([("step 5 loss=2.5",), ("nothing",)], "t string")
    assert [(r["loss"], r["parsed"]) for r in integrity.parse_log(df, "t", {"loss": r"loss=([0-9.]+)"}).collect()] == [(2.5, True), (None, False)]
    r = integrity.rollup(spark.createDataFrame([("a", 2.0, 10), (" ", 1.0, 5)], "t string, s double, k long"), "t", "s", "k").first()
    assert (r["items"], r["non_empty"], r["tokens_per_second"], r["all_pass"]) == (2, 1, 5.0, False)


def test_adapters(spark):
    rows = [("1 a", "do", "this", "done", "mixed"), (None, "", None, "only", "French"), ("3", " ", "", None, "tunisian")]
    df = spark.createDataFrame(rows, "id string, instruction string, input string, output string, dialect string")
    got = {r["id"]: ([m["content"] for m in r["messages"]], r["language"]) for r in A.dialect_qa(df, "s").collect()}
    assert got["s-1_a"] == (["do\nthis", "done"], "mixed") and sorted(x[1] for x in got.values()) == ["fr", "mixed"]
    assert [r["skip_reason"] for r in A.qa_or_reason(df).collect()] == [None, "empty_prompt", "empty_prompt"]
    conv = spark.createDataFrame([([("human", "q"), ("gpt", "a")],), ([("human", " ")],)], "conversations array<struct<from:string,value:string>>")
    good, bad = A.chat_rows(conv, "x", conversations="conversations")
    assert good.count() == 1 and bad.first()["rejected"] == 1
    a = conv.select(M.sharegpt_to_alpaca(F.col("conversations")).alias("a")).first()["a"]
    assert (a["instruction"], a["input"], a["output"]) == ("q", "", "a")
    assert [r["ok"] for r in conv.select(formats.is_valid(conv, "sharegpt").alias("ok")).collect()] == [True, False]


def test_semantic_classes(spark):
    rows = [(1, [1.0, 0.0, 0.0]), (2, [0.99, 0.05, 0.0]), (3, [0.0, 1.0, 0.0]), (4, [1.0, 0.0, 0.0]), (5, None), (6, [0.0, 0.0, 0.0])]
    got = {r["id"]: r["class_id"] for r in dedup.semantic_duplicates(spark.createDataFrame(rows, "id long, v array<float>"), "id", "v").collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 1, 5: 5, 6: 6}
