import random

import pytest
from helpers import RECORD, record
from pyspark.sql import functions as F

from tamis.operators import budget, dedup, mixture, ranks, sampling
from tamis.spec import MixtureSpec, RetentionSpec, SpecError


def key(x, seed=42):
    import hashlib

    return hashlib.sha256(f"{seed}:{x}".encode()).hexdigest()


def naive_fill(rows, target, tol):
    lower, upper, total, out = target * (1 - tol), target * (1 + tol), 0, []
    for i, v in sorted(rows, key=lambda r: key(r[0])):
        if total >= lower:
            break
        if v > 0 and total + v <= upper:
            out.append(i)
            total += v
    return set(out)


@pytest.mark.parametrize(("big", "fold"), [(0, 1000), (40, 1000), (40, 0)])
def test_greedy_fill_against_naive(spark, big, fold):
    rng = random.Random(big)
    rows = [(i, g, rng.choice([0, 1, 2, 3, 5]) + (rng.random() < 0.3) * big) for g in "abc" for i in range(ord(g) * 1000, ord(g) * 1000 + 120)]
    df = spark.createDataFrame(rows, "id long, g string, v long")
    targets = {"a": 150.0, "b": 60.0, "c": 0.0}
    got = budget.greedy_fill(df, spark.createDataFrame(list(targets.items()), "g string, target double"), "g", "v", 0.05, fold_rows=fold)
    want = set().union(*(naive_fill([(i, v) for i, gg, v in rows if gg == g], t, 0.05) if t else set() for g, t in targets.items()))
    assert {r["id"] for r in got.collect()} == want


@pytest.mark.parametrize("fold", [1000, 0])
def test_greedy_fill_of_repeated_rows(spark, fold):
    rng = random.Random(11)
    rows = [(i % 40, "g", rng.choice([1, 2, 3, 9])) for i in range(120)]
    df = spark.createDataFrame(rows, "id long, g string, v long")
    got = budget.greedy_fill(df, spark.createDataFrame([("g", 60.0)], "g string, target double"), "g", "v", 0.05, fold_rows=fold).collect()
    total, want = 0, []
    for i, _, v in sorted(rows, key=lambda r: (key(r[0]), r[2])):
        if total >= 57:
            break
        if total + v <= 63:
            want.append((i, v))
            total += v
    assert sorted((r["id"], r["v"]) for r in got) == sorted(want) and set(got[0].asDict()) == {"id", "g", "v"}


@pytest.mark.parametrize("fold", [1000, 10])
def test_nested_variants_against_naive(spark, fold):
    rng = random.Random(3)
    rows = [(i, rng.choice(["ar", "en", "arabizi", "fr"]), rng.randrange(1, 60)) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, language string, tokens long")
    got = {r["id"]: r["variant"] for r in budget.nested_variants(df, {"v25": 0.25, "v50": 0.5, "v75": 0.75}, ["arabizi"], ["ar", "en"], fold_rows=fold).collect()}
    total, spent = sum(v for _, _, v in rows), sum(v for _, lang, v in rows if lang == "arabizi")
    want = {i: "v25" for i, lang, _ in rows if lang == "arabizi"}
    pool = sorted(((i, v) for i, lang, v in rows if lang in ("ar", "en")), key=lambda r: key(r[0]))
    for name, f in (("v25", 0.25), ("v50", 0.5), ("v75", 0.75)):
        room, added, left = max(int(total * f) - spent, 0), 0, []
        first = True
        for i, v in pool:
            if added + v <= room or (first and v <= int(total * f)):
                want[i], added, first = name, added + v, False
            else:
                left.append((i, v))
        pool, spent = left, spent + added
    assert got == want


def test_splits_are_disjoint_and_deterministic(spark):
    df = spark.createDataFrame([(i, f"c{i % 5}") for i in range(300)], "id long, category string")
    a = sampling.split_exact(df, 30)
    assert a.where("part = 'holdout'").count() == 30 and a.count() == 300
    s = sampling.stratified_split(df, 25, "category")
    assert {r["count"] for r in s.where("part = 'holdout'").groupBy("category").count().collect()} == {5}
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    again = sampling.stratified_split(df.repartition(5), 25, "category")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert s.exceptAll(again).isEmpty()
    with pytest.raises(ValueError):
        sampling.split_exact(df, 301)
    assert sampling.scale_targets({"a": 100}, 0.01) == {"a": 1}


def test_token_budget_selection(spark):
    cats = ["coding", "mathematics", "reasoning", "general_instruction", "knowledge_qa"]
    rows = [record(n * 1000 + i, category=c, id=f"tok-{c}-{i:05d}") for n, c in enumerate(cats) for i in range(120)]
    rows.append(record(99999, assistant="x" * 70_000, category="coding", id="long"))
    df = spark.createDataFrame(rows, RECORD)
    spec = RetentionSpec(anchor_examples=50, multipliers=dict(zip(cats, (1.0, 1.0, 0.8, 0.6, 0.6))), holdout_tokens=40, holdout_shares={"coding": 0.5, "mathematics": 0.5})
    s = budget.select_by_tokens(df, spec)
    n = {r["category"]: r["count"] for r in s.train.groupBy("category").count().collect()}
    assert n["coding"] == 50 and n["mathematics"] in (49, 50, 51) and n["knowledge_qa"] in (30, 29, 31)
    assert s.overlap() == 0 and {r["reject_reason"]: r["n"] for r in s.rejected.collect()} == {"over_length": 1}
    with pytest.raises(budget.SelectionError):
        budget.select_by_tokens(df, RetentionSpec(anchor_examples=500, multipliers=spec.multipliers))


def test_packing_fits(spark):
    rng = random.Random(1)
    df = spark.createDataFrame([(i, "g", rng.randrange(1, 120)) for i in range(150)], "id long, g string, t long")
    rows = budget.pack_first_fit(df, "g", "t", 100).collect()
    used = {}
    for r in rows:
        if r["bin"] >= 0:
            used[r["bin"]] = used.get(r["bin"], 0) + r["t"]
    assert len(rows) == 150 and max(used.values()) <= 100 and all((r["bin"] == -1) == (r["t"] > 100) for r in rows)


def test_dedup_keeps_first_and_blank_ids(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, "a", "y"), (3, None, "z"), (4, "", "z"), (5, "b", "x")], "line_no long, id string, t string")
    assert sorted(r["line_no"] for r in dedup.by_id(df).collect()) == [1, 3, 4, 5]


@pytest.mark.parametrize("paired", [dedup.PAIRED, 2])
def test_near_duplicates_against_brute_force(spark, paired):
    rng = random.Random(5)
    base = [[f"w{rng.randrange(400)}" for _ in range(60)] for _ in range(40)]
    texts = []
    for b in base:
        texts.append(" ".join(b))
        if rng.random() < 0.6:
            c = list(b)
            c[0] = "changed"
            texts.append(" ".join(c))
        if rng.random() < 0.4:
            texts.append(" ".join(b))
    for n in range(12):  # one bucket of many different texts, in a chain
        texts.append(" ".join([f"x{i}" for i in range(n, 50 + n)]))
    rows = [(i, t) for i, t in enumerate(texts)] + [(900, None), (901, ""), (902, "two words"), (903, "two words")]
    got = {r["id"]: r["class_id"] for r in dedup.near_duplicates(spark.createDataFrame(rows, "id long, t string"), "id", "t", paired=paired).collect()}

    def shingles(t):
        w = t.split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)}

    parent = {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    live = [(i, shingles(t)) for i, t in rows if t]
    for x, (i, a) in enumerate(live):
        for j, b in live[:x]:
            if len(a & b) >= 0.8 * len(a | b):
                p, q = root(i), root(j)
                parent[max(p, q)] = min(p, q)
    assert got == {i: root(i) for i, _ in rows}


def test_mixture(spark):
    df = spark.createDataFrame([(f"i{i}", "retention", "fr" if i == 0 else "en") for i in range(10)] + [("x", "other", "en")], "id string, slice string, language string")
    spec = MixtureSpec({"retention": 0.5, "arabizi": 0.5})
    v = {(r["slice"], r["violation"]) for r in mixture.mixture_violations(df, spec, holdout=df.where("id = 'i3'"), requested={"retention": 1_000_000}).collect()}
    assert v == {("other", "undeclared_slice"), ("arabizi", "empty_slice"), ("retention", "infeasible_count"), ("retention", "retention_not_english"), ("retention", "holdout_leak")}
    with pytest.raises(SpecError):
        MixtureSpec({"a": 0.6, "b": 0.6}).validate()


def test_large_buckets_take_fixed_rounds(spark):
    # 400 members of one bucket in three groups, linked within a group only
    members = [(0, i) for i in range(400)]
    buckets = spark.createDataFrame(members, "g long, rep long")
    calls = []

    def confirm(pairs):
        calls.append(1)
        return pairs.distinct().where("a % 3 = b % 3 and abs(a - b) <= 30")

    def part(some, level):
        return some.withColumn("sub", F.explode(F.array(*[(F.floor((F.col("rep") + 10 * k) / (60 // level)) + 1000 * k).cast("long") for k in range(3)])))

    links = dedup.bucket_links(buckets, confirm, part, paired=16)
    classes = dedup.components(links, buckets.select(F.col("rep").alias("id"))).collect()
    assert {r["id"]: r["class_id"] for r in classes} == {i: i % 3 for i in range(400)} and len(calls) <= 2 * (dedup.LEVELS + 1)


def test_first_rows_against_sort(spark, monkeypatch):
    rng = random.Random(6)
    rows = [(i, rng.choice("aaab") if i % 50 else "c", i) for i in range(400)] + [(7, "a", 1000 + i) for i in range(5)]
    df = spark.createDataFrame(rows, "id long, g string, n long")
    for digits in (1, 4):
        monkeypatch.setattr(ranks, "DIGITS", digits)
        for quotas in ({"a": 17, "b": 0, "c": 500}, {"a": 150, "b": 1}, {"a": 303}):
            got = ranks.mark_first(df, spark.createDataFrame(list(quotas.items()), "g string, quota int"), "g", sampling.stable_key("id"), "id", "first").collect()
            assert len(got) == len(rows)
            for g in "abc":
                own = sorted(key(i) for i, x, _ in rows if x == g)[: quotas.get(g, 0)]
                assert sorted(key(r["id"]) for r in got if r["g"] == g and r["first"]) == own
    for k in range(len(rows)):  # every cut through the repeated rows
        if k % 40 == 0 or rows and sorted(key(i) for i, _, _ in rows)[k] == key(7):
            assert sampling.split_exact(df, k).where("part = 'holdout'").count() == k


def test_source_diverse_against_sort(spark):
    rows = [(i, None if i % 9 == 0 else f"s{i % 3 if i % 2 else 0}") for i in range(200)]
    df = spark.createDataFrame(rows, "id long, source string")
    for need, share in ((40, 0.1), (120, 0.2), (500, 0.3), (30, 1.0)):
        cap = max(1, int(need * share)) if share < 1 else need
        seen, order = {}, []
        for i, s in sorted(rows, key=lambda r: key(r[0])):
            seen[s] = seen.get(s, 0) + 1
            order.append((seen[s] > cap, key(i), i))
        assert {r["id"] for r in sampling.source_diverse(df, need, share).collect()} == {x[2] for x in sorted(order)[:need]}


def test_packing_is_first_fit(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice(["g", None]), rng.randrange(0, 120)) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, g string, t long")
    got = {r["id"]: r["bin"] for r in budget.pack_first_fit(df, "g", "t", 100).collect()}
    for g in ("g", None):
        room, want = [], {}
        for i, _, v in sorted((r for r in rows if r[1] == g), key=lambda r: (-r[2], r[0])):
            if v > 100:
                want[i] = -1
                continue
            b = next((b for b, x in enumerate(room) if x >= v), len(room))
            if b == len(room):
                room.append(100)
            room[b] -= v
            want[i] = b
        assert want == {i: got[i] for i in want}
    assert budget.pack_first_fit(df, "g", "t", 100, shard_rows=40).select("shard").distinct().count() > 2
