import hashlib
import json
import os

import pytest
from helpers import good, write_lines
from pyspark.sql import functions as F

from tamis.cli import main
from tamis.functions import messages as M
from tamis.functions import text as T
from tamis.session import ensure_checkpoint_dir
from tamis.sources import readers, writers
from tamis.spec import CANONICAL
from tamis.streaming import ingest


def test_label_lines(spark, tmp_path):
    p = write_lines(tmp_path / "a.txt", ["%pos;good; text", "no label", "", "neg;bad"])
    assert [(r["_line"], r["label"], r["text"]) for r in readers.label_first(spark, p).collect()] == [(1, "pos", "good; text"), (4, "neg", "bad")]
    assert [(r["label"], r["text"]) for r in readers.label_last(spark, p).collect()] == [("text", "%pos;good"), (None, "no label"), ("bad", "neg")]


def test_encodings(spark, tmp_path):
    (tmp_path / "u.txt").write_bytes("é\nب".encode())
    (tmp_path / "l.txt").write_bytes("é\r\nx".encode("latin-1"))
    assert sorted((r["page"], r["_line"], r["text"]) for r in readers.decoded_lines(spark, str(tmp_path)).collect()) == [("l.txt", 1, "é"), ("l.txt", 2, "x"), ("u.txt", 1, "é"), ("u.txt", 2, "ب")]


def test_export_round_trip(spark, tmp_path):
    p = write_lines(tmp_path / "r.jsonl", [good(id="b"), good(id="a")])
    df = spark.read.schema(CANONICAL).json(p)
    assert writers.export_sharegpt(df, str(tmp_path / "out")) == 2
    back = spark.read.json(str(tmp_path / "out")).select(M.from_sharegpt(F.col("conversations")).alias("m")).first()["m"]
    assert [(t["role"], t["content"]) for t in back] == [("user", "hi"), ("assistant", "yo")]
    writers.jsonl(df, str(tmp_path / "one"))
    rows = [json.loads(r[0]) for r in spark.read.text(str(tmp_path / "one")).collect()]
    assert [r["id"] for r in rows] == ["a", "b"] and list(rows[0]) == sorted(rows[0])


def test_text_expressions(spark):
    df = spark.createDataFrame([(" a 　b ",), (None,), ("",), ("x😀 https://a.b c",)], "t string")
    assert [r[0] for r in df.select(T.clean_web(F.col("t"))).collect()] == ["a b", None, "", "x c"]
    assert [r[0] for r in df.select(T.token_estimate(F.col("t"))).collect()] == [1, 0, 0, 4]
    names = spark.createDataFrame([("model-7b-chat",), ("x-1.5B",), ("llama",), ("web3b2",)], "n string")
    assert [r[0] for r in names.select(T.model_size(F.col("n"))).collect()] == [7.0, 1.5, 7.0, 7.0]


def test_cli(spark, tmp_path, capsys):
    ok, bad = write_lines(tmp_path / "ok.jsonl", [good()]), write_lines(tmp_path / "bad.jsonl", [good(category="?")])
    assert main(["validate", ok]) == 0 and main(["validate", bad]) == 1 and main(["validate", str(tmp_path / "none")]) == 2
    assert "invalid_category" in capsys.readouterr().out


def test_incremental_ingest(spark, tmp_path):
    src, out, cp = tmp_path / "in", tmp_path / "out", tmp_path / "cp"
    src.mkdir()
    write_lines(src / "1.jsonl", [good(id="a"), good(id="b"), "{bad"])
    ingest.ingest(spark, str(src), str(out), str(cp))
    write_lines(src / "2.jsonl", [good(id="b"), good(id="c")])
    ingest.ingest(spark, str(src), str(out), str(cp))
    assert sorted(r["id"] for r in spark.read.schema(CANONICAL).parquet(*[str(x) for x in out.iterdir() if x.name.startswith("batch=")]).collect()) == ["a", "b", "c"]


def test_line_numbers_of_each_file(spark, tmp_path):
    rows = {f"f{k}.jsonl": [json.dumps({"n": i}) if i % 4 else "" for i in range(1, 60 + k)] for k in range(3)}
    for name, xs in rows.items():
        (tmp_path / name).write_text("\n".join(xs) + "\n", encoding="utf-8")
    for size in ("134217728", "64b"):  # in one piece, and each file in many
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        got = [(r["_file"].rsplit("/", 1)[1], r["_line"], json.loads(r["_raw"])["n"]) for r in readers.lines(spark, str(tmp_path / "*.jsonl")).collect()]
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
        assert sorted(got) == sorted((name, i, i) for name, xs in rows.items() for i in range(1, len(xs) + 1) if i % 4)
    (tmp_path / "none.jsonl").write_text("")
    assert readers.lines(spark, str(tmp_path / "none.jsonl")).count() == 0


def test_bytes_that_are_no_text(spark, tmp_path):
    (tmp_path / "a.jsonl").write_bytes(b'{"t": "a\xffb"}\n{"t": "\xc3\xa9"}\n')
    assert [json.loads(r["_raw"])["t"] for r in readers.lines(spark, str(tmp_path / "a.jsonl")).orderBy("_line").collect()] == ["a�b", "é"]
    assert [json.loads(r["_raw"])["t"] for r in readers.lines(spark, str(tmp_path / "a.jsonl"), "ignore").orderBy("_line").collect()] == ["ab", "é"]
    (tmp_path / "a.tsv").write_bytes(b'x\ty\na\xff\t"q\n')
    assert [tuple(r) for r in readers.csv(spark, str(tmp_path / "a.tsv"), "\t").collect()] == [("a�", '"q')]
    (tmp_path / "a.csv").write_text('x,y\n"a\nb","say ""hi"""\n')
    assert [tuple(r) for r in readers.csv(spark, str(tmp_path / "a.csv")).collect()] == [("a\nb", 'say "hi"')]


def test_json_shapes(spark, tmp_path):
    (tmp_path / "array.json").write_text('[{"a": 1}, {"a": 2}]')
    share = write_lines(tmp_path / "share.jsonl", [{"conversations": []}, {"conversations": [{"from": "human", "value": "x"}]}])
    plain = write_lines(tmp_path / "plain.jsonl", [{"a": 1}, "{bad", {"a": 3}])
    assert [readers.sniff_json(spark, p) for p in (str(tmp_path / "array.json"), share, plain)] == ["array", "sharegpt", "jsonl"]
    assert sorted(r["a"] for r in readers.json_array(spark, str(tmp_path / "array.json"), "a long").collect()) == [1, 2]
    good, bad = readers.jsonl_lenient(spark, plain, "a long")
    assert sorted(r["a"] for r in good.collect()) == [1, 3] and bad.first()["bad"] == 1
    with pytest.raises(Exception):
        readers.jsonl_strict(spark, plain, "a long").collect()
    assert readers.manifest(spark, str(tmp_path / "array.json")).count() == 2


def test_parquet_folders(spark, tmp_path):
    for k in range(2):
        spark.createDataFrame([(f"t{k}{i}",) for i in range(3)], "body string").coalesce(1).write.parquet(str(tmp_path / f"d/part{k}"))
    df = readers.text_corpus(spark, str(tmp_path / "d"))
    assert sorted(r["text"] for r in df.collect()) == [f"t{k}{i}" for k in range(2) for i in range(3)]
    assert [r["text"] for r in df.orderBy("_file", "_row").collect()] == sorted(r["text"] for r in df.collect())
    assert readers.row_count(spark, str(tmp_path / "d/part0")) == 3
    spark.createDataFrame([(1,)], "odd int").write.parquet(str(tmp_path / "e"))
    with pytest.raises(ValueError):
        readers.text_corpus(spark, str(tmp_path / "e"))


def test_folders_and_pools(spark, tmp_path):
    (tmp_path / "s").mkdir()
    write_lines(tmp_path / "s/train.jsonl", [{"id": "a"}])
    write_lines(tmp_path / "s/holdout.jsonl", [{"id": "b"}])
    assert [(r["id"], r["_src_ord"]) for r in readers.pool(spark, str(tmp_path / "s"), "id string").orderBy("_src_ord").collect()] == [("a", 0), ("b", 1)]
    (tmp_path / "s/empty.bin").write_bytes(b"")
    (tmp_path / "s/x.lock").write_bytes(b"l")
    listing = readers.files(spark, str(tmp_path / "s"), hashes=True)
    got = {r["path"].rsplit("/", 1)[1]: (r["bytes"], r["sha256"]) for r in listing.collect()}
    assert got["empty.bin"] == (0, hashlib.sha256(b"").hexdigest()) and got["x.lock"] == (1, hashlib.sha256(b"l").hexdigest()) and len(got) == 4
    assert readers.data_files(listing).count() == 3
    with pytest.raises(FileNotFoundError):
        readers.pool(spark, str(tmp_path / "none"), "id string")
    ok = [{"id": "1", "language": "en", "prompt": "p"}, {"id": "2", "language": "ar", "prompt": "q", "category": "c"}]
    (tmp_path / "p.json").write_text(json.dumps(ok))
    assert {(r["id"], r["category"]) for r in readers.prompts(spark, str(tmp_path / "p.json")).collect()} == {("1", "uncategorized"), ("2", "c")}
    (tmp_path / "q.json").write_text(json.dumps([*ok, ok[0]]))
    with pytest.raises(ValueError):
        readers.prompts(spark, str(tmp_path / "q.json"))
    (tmp_path / "m").mkdir()
    (tmp_path / "m/a.txt").write_text("﻿one\n\n two \n", encoding="utf-8")
    assert sorted((r["page"], r["text"]) for r in readers.message_lines(spark, str(tmp_path / "m")).collect()) == [("a.txt", "one"), ("a.txt", "two")]


def test_running_ids_and_unions(spark):
    df = spark.createDataFrame([(i * 7 % 100, "x") for i in range(100)], "k long, _n string").repartition(5)
    got = {r["k"]: r["id"] for r in readers.numbered(df, ["k"], "rec-").collect()}
    assert got == {k: f"rec-{k:06d}" for k in range(100)}
    both = readers.union_all(df.select("k"), df.select("_n"))
    assert both.groupBy("_src_ord").count().count() == 2 and both.columns == ["k", "_src_ord", "_n"]


def test_alpaca_with_ids(spark, tmp_path):
    df = spark.createDataFrame([(2, "q2", None, "a2", "m"), (1, "q1", "p", None, "n")], "row_no long, q string, p string, a string, tag string")
    columns = {"instruction": "q", "input": "p", "output": "a"}
    strict, side = writers.alpaca_with_ids(df, columns, "row_no")
    both = {r["row"]: r for r in strict.join(side, "row").collect()}
    assert (both[1]["instruction"], both[1]["input"], both[1]["output"], both[1]["tag"]) == ("q1", "p", "", "n") and both[2]["passage_sha256"] is None
    writers.export_alpaca(df, columns, "row_no", str(tmp_path / "x"))
    assert [json.loads(r[0]) for r in spark.read.text(str(tmp_path / "x/data")).collect()] == [{"instruction": "q1", "input": "p", "output": ""}, {"instruction": "q2", "input": "", "output": "a2"}]


def test_splits_reports_and_receipts(spark, tmp_path):
    df = spark.createDataFrame([('{"a": 1}', "train"), ('{"a": 1}', "train"), ('{"b": "é"}', "val")], "_raw string, split string")
    assert writers.splits(df, str(tmp_path / "s")) == {"train": 2, "val": 1}
    writers.csv_report(df, str(tmp_path / "c"))
    assert spark.read.csv(str(tmp_path / "c"), header=True).count() == 3
    text = writers.markdown(df.groupBy("split").count().orderBy("split"), "Rows")
    assert text == "## Rows\n\n| split | count |\n|---|---|\n| train | 2 |\n| val | 1 |\n"
    with pytest.raises(ValueError):
        writers.markdown(df, "x", limit=2)
    writers.append_jsonl(df, str(tmp_path / "log"))
    writers.append_jsonl(df, str(tmp_path / "log"))
    assert spark.read.text(str(tmp_path / "log")).count() == 6
    (tmp_path / "f.bin").write_bytes(b"x")
    side = writers.provenance(str(tmp_path / "f.bin"), {"source": "here"})
    assert json.loads(open(side).read())["sha256"] == hashlib.sha256(b"x").hexdigest() and not os.stat(side).st_mode & 0o222
    writers.provenance(str(tmp_path / "f.bin"), {"source": "there"})
    writers.pointer(str(tmp_path / "LATEST"), "run-2")
    assert (tmp_path / "LATEST").read_text() == "run-2\n"


def test_streams(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    write_lines(src / "1.json", [{"id": "a", "ts": "2024-01-01 00:10:00", "k": "x"}, {"id": "a", "ts": "2024-01-01 00:20:00", "k": "x"}, {"id": "b", "ts": "2024-01-01 01:10:00", "k": "y"}])
    stream = lambda: spark.readStream.schema("id string, ts timestamp, k string").json(str(src))

    def run(df, name, mode):
        q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        q.awaitTermination()
        return spark.table(name).collect()

    assert sorted(r["id"] for r in run(ingest.first_seen(stream(), "id", "ts"), "seen", "append")) == ["a", "b"]
    assert sorted((r["k"], r["n"]) for r in run(ingest.windowed_counts(stream(), "ts", ["k"]), "counts", "complete")) == [("x", 2), ("y", 1)]


def test_checkpoints_need_a_shared_folder_on_a_cluster():
    class Conf:
        get = staticmethod(lambda name, default: default)

    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(lambda: Conf)

    class Session:
        sparkContext = Context

    with pytest.raises(ValueError):
        ensure_checkpoint_dir(Session)
