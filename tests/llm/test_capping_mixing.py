import random

from pyspark.sql import functions as F

from tamis.llm import capping, labels, mixing


def test_radix_cap_against_sort(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice(["big", "big", "big", "mid", None, "one"]), rng.randrange(5), "x") for i in range(600)]
    rows += [(1000, "big", 4, "twice")] * 3 + [(1001 + i, "wide", s, "y") for i, s in enumerate((-3, 300, None, 10**15, 7, -(10**15), None))]
    df = spark.createDataFrame(rows, "line_no long, contributor string, score long, keep string")
    limits = spark.createDataFrame([("big", 57), ("mid", 0), ("one", None), ("wide", 6)], "contributor string, keep long")
    got = capping.cap_contributors(df, limits, F.col("score"), "line_no")
    assert got.columns == df.columns
    shown = lambda c, s, n: (c or "", -(1 << 63) if s is None else s, n)
    kept = sorted(shown(r["contributor"], r["score"], r["line_no"]) for r in got.collect())
    want = []
    for c in {r[1] for r in rows}:
        own = sorted((r for r in rows if r[1] == c), key=lambda r: (r[2] is None, -(r[2] or 0), r[0]))
        want += own[: {"big": 57, "mid": 0, "wide": 6}.get(c, len(own))]
    assert kept == sorted(shown(r[1], r[2], r[0]) for r in want)
    assert capping.cap_contributors(df.limit(0), limits, F.col("score"), "line_no").count() == 0


def test_string_identifiers(spark):
    df = spark.createDataFrame([(x, "c", 1) for x in ("b", "a", "ab", "é", "", None)], "line_no string, contributor string, score int")
    limits = spark.createDataFrame([("c", 3)], "contributor string, keep long")
    assert sorted(r["line_no"] for r in capping.cap_contributors(df, limits, F.col("score"), "line_no").collect()) == ["", "a", "ab"]


def test_equal_rows_fill_the_limit(spark):
    rows = [(1, "c", 5, f"v{i % 3}") for i in range(30)] + [(2, "c", 4, "w"), (0, "c", 5, "best")]
    df = spark.createDataFrame(rows, "line_no long, contributor string, score int, more string")
    for keep in (1, 2, 17, 31):
        got = capping.cap_contributors(df, spark.createDataFrame([("c", keep)], "contributor string, keep long"), F.col("score"), "line_no").collect()
        assert len(got) == keep and sum(r["more"] == "best" for r in got) == 1 and sum(r["more"] == "w" for r in got) == 0


def test_spellings(spark):
    catalog = spark.createDataFrame([("derja_majlis",), ("derja_majlis_kids",), ("a-b",), ("ab",), (None,), ("",)], "source string")
    spellings = ["derja_majlis", "HF:derja_majlis", "gh:Derja-Majlis", "derja majlis@v2", "derja_majlis_v1.1", "derja-majlis/train-00001-of-00004"]
    df = spark.createDataFrame([(s,) for s in spellings] * 2 + [("derja_majlis_kids",), (None,), ("",), ("a-b",), ("ab",), ("A B",)] + [(f"other{i}",) for i in range(30)], "source string")
    got = {(r["source"], r["contributor"]) for r in labels.with_contributor(df, catalog).collect()}
    assert {(s, "derja_majlis") for s in spellings} <= got and {("a-b", "a-b"), ("ab", "ab"), ("A B", None), (None, None), ("", None), ("other1", None)} <= got
    assert labels.with_contributor(df, catalog).count() == df.count()
    limits = capping.every_limit(df, catalog, 0.05)
    assert {(r["contributor"], r["keep"]) for r in limits.collect()} == {(c, 2) for c in ("derja_majlis", "derja_majlis_kids", "a-b", "ab")}
    assert capping.every_limit(df.limit(0), catalog, 0.05).count() == 0


def test_flow_is_cheapest_and_full():
    quota, flow = mixing.solve({("a",): 100, ("b",): 10, ("a", "b"): 40}, {"a": (0.5, 1), "b": (0.5, 3)}, 150)
    assert quota == {"a": 75, "b": 75} and flow[("a",), "a"] + flow[("a", "b"), "a"] == 75
    assert flow[("b",), "b"] + flow[("a", "b"), "b"] == 75 and flow[("b",), "b"] <= 30
    _, flow = mixing.solve({("a",): 10}, {"a": (1.0, 2), "b": (0.5, 2)}, 100)
    assert flow[("a",), "a"] == 20


def test_flow_against_every_split():
    import itertools

    # two sources that share a pattern: the cheapest way to fill both quotas, by trying all
    for sizes, repeats in (((7, 5, 4), (3, 2)), ((2, 9, 3), (4, 1)), ((0, 3, 6), (2, 3)), ((5, 0, 0), (1_000_000, 2))):
        a, b, ab = sizes
        total = sum(sizes)
        quota, flow = mixing.solve({k: v for k, v in ((("a",), a), (("b",), b), (("a", "b"), ab)) if v}, {"a": (0.5, repeats[0]), "b": (0.5, repeats[1])}, total)
        price = lambda n, size: sum(i // size for i in range(n)) if size else (0 if not n else None)
        best = None
        for x, y in itertools.product(range(quota["a"] + 1), range(quota["b"] + 1)):  # from the shared pattern to each
            if not ab and (x or y) or x > ab * repeats[0] or y > ab * repeats[1]:
                continue
            p, q = min(quota["a"] - x, a * repeats[0]), min(quota["b"] - y, b * repeats[1])
            if x + y > ab * max(repeats):
                continue
            cost = price(p, a) + price(q, b) + price(x + y, ab)
            if best is None or (-(p + q + x + y), cost) < best:
                best = -(p + q + x + y), cost
        into = lambda k: sum(n for (p, s), n in flow.items() if p == k)
        got = -sum(flow.values()), price(into(("a",)), a) + price(into(("b",)), b) + price(into(("a", "b")), ab)
        assert got == best, (sizes, repeats)


def test_mixture(spark):
    rows = [(i, 10, ["a"]) for i in range(50)] + [(100 + i, 5, ["b"]) for i in range(8)] + [(200, None, ["a"]), (201, 3, ["none"]), (202, 7, [])]
    docs = spark.createDataFrame(rows, "line_no long, size long, membership array<string>")
    targets = spark.createDataFrame([("a", 0.6, 1), ("b", 0.3, 3), ("c", 0.1, 2)], "source string, target_share double, max_repeat int")
    m = mixing.Mixture(docs, targets)
    assert m.total == 540 and [r["source"] for r in m.short().collect()] == ["b", "c"]
    pick = m.selection().collect()
    assert max(r["repeats"] for r in pick if r["source"] == "b") == 3 and all(r["repeats"] == 1 for r in pick if r["source"] == "a")
    taken = sum(r["repeats"] * r["size"] for r in pick if r["source"] == "a")
    assert abs(taken - m.quota["a"]) < 10
    again = mixing.Mixture(docs.repartition(3), targets)
    assert sorted(map(tuple, again.selection().collect())) == sorted(map(tuple, pick))
    empty = mixing.Mixture(docs.limit(0), targets)
    assert empty.selection().count() == 0 and {r["source"]: r["short"] for r in empty.report().collect()} == {"a": False, "b": False, "c": False}
