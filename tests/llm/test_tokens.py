import random

import pytest
import tiktoken
from pyspark.sql import functions as F

from tamis.llm import bpe, encode, tokens
from tamis.operators import joins

MSG = "array<struct<role:string,content:string>>"
EDGE = ["", " ", "  ", "\n \n", "a  b", "ab \n cd ", "<|endoftext|>", "l'eau d'été, it's", "برشّة ٣٤", "x" * 5000, "é" * 900 + "ab" * 900, "\x1c a", "😀 👍🏽"]


@pytest.fixture(scope="module")
def reference():
    ranks = bpe.load_ranks("byte_bpe_50k.tiktoken")
    return tiktoken.Encoding("own", pat_str=bpe.SPLIT, mergeable_ranks=ranks, special_tokens={})


def test_encoder_equals_library(reference):
    rng = random.Random(0)
    alphabet = " \n\t  's'abéçم٣9!.—\x1c😊x"
    texts = EDGE + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(20))) for _ in range(4000)]
    enc = bpe.encoder("byte_bpe_50k.tiktoken")
    for t in texts:
        assert enc.encode(t) == reference.encode_ordinary(t)
        assert enc.count(t) == len(reference.encode_ordinary(t))


def test_corpus_ids(spark, reference):
    rows = list(enumerate([None, *EDGE, "same", "same"]))
    df = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, ids string")
    got = {r["doc_id"]: list(r["ids"]) for r in encode.corpus_ids(df).collect()}
    assert got == {i: reference.encode_ordinary(t) if t else [] for i, t in rows}
    assert encode.corpus_ids(df.limit(0)).count() == 0


def snapshot(spark, rows):
    return spark.createDataFrame(rows, f"line_no long, messages {MSG}, source string, language string, category string, tokens string")


def test_budget_by_deltas(spark, tmp_path, monkeypatch):
    catalog = spark.createDataFrame([("souk_talk",), ("souk_talks",)], "source string")
    same = [("user", "over and over"), ("assistant", "over and over")]
    a = [(1, [("user", "one two"), ("assistant", None)], "hf:souk_talk", "AR", "qa", "x"), (2, [("user", "three")], "SOUK TALKS", None, None, "x"), (3, None, None, "en", "qa", "x"), (4, [("user", "gone")], "souk_talk", "ar", "qa", "x"), (5, same, "souk_talk", "ar", "qa", "x"), (5, same, "souk_talk", "ar", "qa", "x"), (6, [("user", "moves")], None, "fr", "qa", "x"), (None, [], None, None, None, None)]
    b = [*a[:1], (2, [("user", "three four five")], "SOUK TALKS", None, None, "x"), a[2], a[4], (6, [("user", "moves")], None, "ar", "qa", "x"), (7, same, "souk_talk", "ar", "qa", "x"), a[7], a[7]]
    sa, sb = snapshot(spark, a).drop("tokens"), snapshot(spark, b).drop("tokens")
    encoded = []
    real = tokens.count_contents
    monkeypatch.setattr(tokens, "count_contents", lambda df, *how: encoded.append(sorted({r["content"] for r in df.collect()})) or real(df, *how))
    first, state, counts = tokens.update_budget(sa, catalog)
    moved, state2, counts2 = tokens.update_budget(sb, catalog, state, counts)
    # only contents of changed records that the table lacks are fetched
    assert encoded[1] == ["three four five"] and counts2.count() == counts.count() + 1 == 6
    key = lambda df: sorted(map(tuple, df.select("contributor", "language", "category", "documents", "tokens").collect()))
    fresh = tokens.apply_cells(None, tokens.update_budget(sb, catalog)[0])
    assert key(tokens.apply_cells(tokens.apply_cells(None, first), moved)) == key(fresh)
    assert tokens.update_budget(sb, catalog, state2, counts2)[0].count() == 0
    gone, empty, _ = tokens.update_budget(sb.limit(0), catalog, state2, counts2)
    assert empty.count() == 0 and key(gone) == [(*k[:3], -k[3], -k[4]) for k in key(fresh)]
    tokens.store_counts(counts, str(tmp_path / "c"), 0)
    tokens.store_counts(counts2, str(tmp_path / "c"), 1)
    tokens.store_counts(counts2, str(tmp_path / "c"), 1)
    assert sorted(map(tuple, tokens.load_counts(spark, str(tmp_path / "c")).select("h1", "h2", "tokens").collect())) == sorted(map(tuple, counts2.select("h1", "h2", "tokens").collect()))
    monkeypatch.setattr(tokens, "count_contents", real)
    monkeypatch.setattr(tokens, "BROADCAST_ROWS", 0)  # and where no side is small
    assert key(tokens.apply_cells(tokens.apply_cells(None, first), tokens.update_budget(sb, catalog, state, counts)[0])) == key(fresh)
    pb, _ = tokens.token_budget(sb, catalog, counts2)
    by = {r["line_no"]: (r["contributor"], r["language"], r["category"], r["tokens"]) for r in pb.collect()}
    enc = bpe.encoder(tokens.TOKENIZER)
    assert by[1] == ("souk_talk", "ar", "qa", enc.count("one two")) and by[3] == ("unknown", "en", "qa", 0)
    assert by[2] == ("souk_talks", "unknown", "unknown", enc.count("three four five"))
    total = tokens.cube(fresh).where("grouping = 7").first()
    assert total["tokens"] == fresh.agg(F.sum("tokens")).first()[0] and total["documents"] == 8
    assert tokens.token_budget(sa.limit(0), catalog)[0].count() == 0


@pytest.mark.parametrize("share", [1e-4, 0.3, 0.9])
def test_hot_split_join(spark, monkeypatch, share):
    monkeypatch.setattr(joins, "HOT_SHARE", share)
    big = spark.createDataFrame([(i, None if i % 7 == 0 else 1 if i % 2 else i) for i in range(60)], "i long, k long")
    small = spark.createDataFrame([(k, f"v{k}") for k in range(0, 40)], "k long, v string")
    for how in ("inner", "left"):
        assert sorted(map(repr, joins.hot_split_join(big, small, ["k"], how).collect())) == sorted(map(repr, big.join(small, "k", how).collect()))
