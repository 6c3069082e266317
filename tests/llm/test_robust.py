"""Every query on tables with nulls everywhere, empty and long texts, repeated rows, clashing extra columns, and without rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tamis.llm import queries as Q

MSG = "array<struct<role:string,content:string>>"
RECORDS = f"line_no long, id string, messages {MSG}, category string, source string, language string, subcategory string, script string, code_switching boolean, difficulty string, quality struct<reviewed:boolean,native_authored:boolean,synthetic:boolean,flagged:boolean>, variation_group string, split string, ingested_at timestamp"
FR = "Le chat de ma voisine mange une souris dans le jardin de la maison"
EN = "The neighbour bought a bicycle near the station and left for the market"
ITEM = " ".join(f"mot{i} de la page" for i in range(12))
CLASHES = ["h1", "h2", "train", "contributor", "languages", "look", "raw", "ids", "size", "bucket", "membership", "word", "seed", "kind", "found", "item", "edits", "tokens", "score", "keep", "n", "label", "turn", "defect", "rows", "__id", "__text", "__c", "__key", "__s"]


def record(n, messages, split="train", source="souk_talk", language="fr", quality=(True, None, False, None)):
    return (n, f"r{n}", messages, "qa", source, language, None, None, None, None, quality, None, split, dt.datetime(2024, 1, 1))


def tables():
    say = lambda q, a: [("user", q), ("assistant", a)]
    rows = [record(n, say(f"{FR} {n}. {EN}.", f"{FR}. Le mot {n} est ici."), ("train", "val", "test")[n % 3], ("souk_talk", "HF:Souk-Talk", None, "odd")[n % 4], ("fr", None, "?", "en")[n % 4]) for n in range(24)]
    rows += [record(100, None), record(101, []), record(102, [("user", None), ("assistant", None)]), record(103, say("", " ")), record(104, [(None, "x"), ("assistant", "y")]), record(105, say(FR + ".", FR + "."), "val"), record(106, say(FR + ".", FR + "."), None), record(107, say("x " * 40_000, "é" * 60_000)), record(108, [None, ("user", "café")]), record(109, [None, ("user", "café")])]
    rows += [tuple([None] * 14), rows[3], rows[3], (None, *rows[4][1:])]
    docs = [(1, f"avant {ITEM} après", "fr", "s", 1, "c", None), (2, None, None, None, None, None, None), (3, "", "fr", "s", 0, "c", None), (3, "", "fr", "s", 0, "c", None), (4, "a@b.cd " + "x" * 200_000, "fr", "s", 0, "c", None), (None, "Slim Borganine, Rim Borganine", "fr", "s", 0, "c", None), (6, " \t\n", None, None, None, None, None)]
    items = [(1, "t", "fr", ITEM, None, "c"), (2, None, None, None, None, None), (3, "t", "fr", ITEM, "", "c"), (None, "t", "fr", ITEM, ITEM, "c"), (1, "t", "fr", ITEM, None, "c")]
    return {
        "arabic_derja": (rows, RECORDS), "documents": (docs, "doc_id long, text string, lang string, source string, n_chars long, category string, collected_at timestamp"),
        "eval_prompts": (items, "item_id long, track string, language string, prompt string, expected_behavior string, category string"),
        "source_catalog": ([("souk_talk", None), ("odd", "x"), (None, None), ("", None), ("souk_talk", "twice")], "source string, license string"),
        "mixture_targets": ([("souk_talk", 0.6, 2), ("none", 0.4, 3), ("odd", None, 1), ("x", 0.1, None), (None, 0.1, 1)], "source string, target_share double, max_repeat int"),
        "given_names": ([("Slim", "latin"), ("Rim", None), (None, "latin"), ("", None)], "name string, script string"),
    }


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    top = tmp_path_factory.mktemp("robust")
    for name, (rows, schema) in tables().items():
        df = spark.createDataFrame(rows, schema)
        df.write.parquet(f"{top}/plain/{name}.parquet")
        df.withColumns({c: F.lit("clash") for c in CLASHES if c not in df.columns}).write.parquet(f"{top}/clash/{name}.parquet")
        df.limit(0).write.parquet(f"{top}/empty/{name}.parquet")
    return top


@pytest.mark.parametrize("name", sorted(Q.queries()))
def test_odd_tables(spark, folders, name):
    run = lambda kind: sorted(map(repr, Q.queries()[name](spark, f"{folders}/{kind}").collect()))
    plain = run("plain")
    assert run("clash") == plain
    run("empty")
    if name in ("p8_ids", "p10_redacted"):
        assert len(plain) == 7
    if name == "p9_found":
        assert len(plain) == 2
    if name == "p1_record_tokens":
        assert len(plain) >= 34
