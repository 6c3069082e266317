"""Problem 4: a mixture of sources near its target shares, by min-cost flow.

Documents are aggregated by membership pattern, the set of targets they may serve. The flow goes from
each pattern, copy by copy at rising cost, to the quotas of the sources; only these sums reach the
driver. The flow gives each source an interval on the line of a pattern's copies, and a document is
used for a source as often as one of its copies starts in that interval.
"""

from __future__ import annotations

import heapq
from decimal import ROUND_CEILING, Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamis.llm.labels import with_contributor
from tamis.operators.joins import lookup_join
from tamis.session import cut

#: Patterns and targets that the flow on the driver may have; more is an error, never a silent cut.
MAX_PATTERNS, MAX_TARGETS = 5_000, 1_000
BUCKETS = 1 << 14


class Flow:
    """Min-cost flow by successive cheapest paths; capacities are whole numbers."""

    def __init__(self, n: int):
        self.out: list[list[int]] = [[] for _ in range(n)]
        self.to: list[int] = []
        self.room: list[int] = []
        self.cost: list[int] = []
        self.copies: dict[int, list[int]] = {}

    def rising(self, a: int, b: int, room: int, copies: int) -> None:
        """An arc out of the source that is filled ``copies`` times, each time at a cost of one more: only the copy in use is there, however many may follow."""
        if copies > 0:
            self.copies[self.arc(a, b, room)] = [room, copies - 1]

    def arc(self, a: int, b: int, room: int, cost: int = 0) -> int:
        for x, y, r, c in ((a, b, room, cost), (b, a, 0, -cost)):
            self.out[x].append(len(self.to))
            self.to.append(y)
            self.room.append(r)
            self.cost.append(c)
        return len(self.to) - 2

    def run(self, s: int, t: int) -> None:
        height = [0] * len(self.out)
        while True:
            far = [None] * len(self.out)
            via = [-1] * len(self.out)
            far[s], heap = 0, [(0, s)]
            while heap:
                d, x = heapq.heappop(heap)
                if d > far[x]:
                    continue
                for e in self.out[x]:
                    if self.room[e] > 0:
                        y, nd = self.to[e], d + self.cost[e] + height[x] - height[self.to[e]]
                        if far[y] is None or nd < far[y]:
                            far[y], via[y] = nd, e
                            heapq.heappush(heap, (nd, y))
            if far[t] is None:
                return
            for x, d in enumerate(far):
                if d is not None:
                    height[x] += d
            path, x = [], t
            while x != s:
                path.append(via[x])
                x = self.to[via[x] ^ 1]
            most = min(self.room[e] for e in path)
            for e in path:
                self.room[e] -= most
                self.room[e ^ 1] += most
                if not self.room[e] and (copy := self.copies.get(e)) and copy[1]:
                    self.room[e], self.cost[e] = copy[0], self.cost[e] + 1
                    copy[1] -= 1


def solve(sizes: dict[tuple[str, ...], int], targets: dict[str, tuple[float, int]], total: int) -> tuple[dict[str, int], dict[tuple[tuple[str, ...], str], int]]:
    """Quota of each source and the flow from each pattern to each source."""
    quota = {s: int((Decimal(str(share)) * total).to_integral_value(ROUND_CEILING)) for s, (share, _) in targets.items()}
    patterns, sources = sorted(sizes), sorted(targets)
    at = {s: 2 + len(patterns) + i for i, s in enumerate(sources)}
    g = Flow(2 + len(patterns) + len(sources))
    used = {}
    for i, p in enumerate(patterns):
        g.rising(0, 2 + i, sizes[p], max(targets[s][1] for s in p))
        for s in p:
            used[p, s] = g.arc(2 + i, at[s], sizes[p] * targets[s][1])
    for s in sources:
        g.arc(at[s], 1, quota[s])
    g.run(0, 1)
    return quota, {k: g.room[e ^ 1] for k, e in used.items()}


def content_size(messages: Column) -> Column:
    """Code points of all contents, null counting 0."""
    return F.coalesce(F.aggregate(messages, F.lit(0).cast("long"), lambda a, m: a + F.coalesce(F.length(m["content"]), F.lit(0))), F.lit(0).cast("long"))


def members(records: DataFrame, catalog: DataFrame, targets: DataFrame, key: str = "line_no") -> DataFrame:
    """``key``, size and membership (the target of its contributor) of the train records of the targets."""
    train = records.where("split = 'train'").select(key, "source", content_size(F.col("messages")).alias("size"))
    named = with_contributor(train, catalog)
    return lookup_join(named, targets.select(F.col("source").alias("contributor")).where("contributor is not null").distinct(), ["contributor"], "left_semi", salt_by=key).select(key, "size", F.array("contributor").alias("membership"))


class Mixture:
    """``docs``: a key, size (0 or more) and membership (non-empty array of targets); ``targets``: source, target_share, max_repeat.

    Repeated keys are separate documents. Targets with a null or non-positive share or repetition
    get nothing; memberships in unknown targets are ignored. Empty tables give an empty mixture
    in which every target with a share and no document falls short.
    """

    def __init__(self, docs: DataFrame, targets: DataFrame, key: str = "line_no", seed: int = 42):
        self.key, self.seed = key, seed
        self.spark = docs.sparkSession
        rows = targets.where("source is not null").limit(MAX_TARGETS + 1).collect()
        if len(rows) > MAX_TARGETS:
            raise ValueError(f"more than {MAX_TARGETS} targets")
        self.targets = {r["source"]: (max(r["target_share"] or 0.0, 0.0), max(r["max_repeat"] or 0, 0)) for r in rows}
        known = F.array_sort(F.array_distinct(F.filter("membership", lambda m: m.isin(*self.targets)))) if self.targets else F.array().cast("array<string>")
        docs = docs.select(F.col(key), F.greatest(F.coalesce("size", F.lit(0)), F.lit(0)).cast("long").alias("size"), known.alias("pattern")).where("size(pattern) > 0")
        salt = F.xxhash64(F.lit(seed), F.col(key).cast("string"))
        self.docs = cut(docs.withColumn("order", salt).withColumn("bucket", F.pmod(F.shiftright("order", 20), F.lit(BUCKETS)).cast("int")))
        self.histogram = cut(self.docs.groupBy("pattern", "bucket").agg(F.sum("size").alias("size")))
        sums = self.histogram.groupBy("pattern").agg(F.sum("size").alias("size")).limit(MAX_PATTERNS + 1).collect()
        if len(sums) > MAX_PATTERNS:
            raise ValueError(f"more than {MAX_PATTERNS} membership patterns; join sources that always go together")
        self.sizes = {tuple(r["pattern"]): r["size"] for r in sums}
        self.total = sum(self.sizes.values())
        self.quota, self.flow = solve(self.sizes, self.targets, self.total)

    def got(self) -> dict[str, int]:
        """Characters that the flow carries to each source."""
        out = dict.fromkeys(self.targets, 0)
        for (_, s), n in self.flow.items():
            out[s] += n
        return out

    def short(self) -> DataFrame:
        """Sources whose quota the flow cannot fill: source."""
        got = self.got()
        return self.spark.createDataFrame([(s,) for s in sorted(self.targets) if got[s] < self.quota[s]], "source string")

    def selection(self) -> DataFrame:
        """``key``, source and repeats of the chosen documents, size included."""
        rows = []
        for p, size in self.sizes.items():
            start = 0
            for s in p:
                n = self.flow.get((p, s), 0)
                if n:
                    rows.append((list(p), s, start, start + n, size))
                start += n
        spans = self.spark.createDataFrame(rows, "pattern array<string>, source string, a long, b long, whole long")
        before = F.sum("size").over(Window.partitionBy("pattern").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
        starts = self.histogram.withColumn("base", F.coalesce(before, F.lit(0))).select("pattern", "bucket", "base")
        inside = F.sum("size").over(Window.partitionBy("pattern", "bucket").orderBy("order", self.key).rowsBetween(Window.unboundedPreceding, -1))
        placed = self.docs.withColumn("inside", F.coalesce(inside, F.lit(0))).join(starts, ["pattern", "bucket"]).withColumn("x", F.col("base") + F.col("inside"))
        hit = placed.join(F.broadcast(spans), "pattern")  # a row for each pattern and target at most
        # copies r with a <= x + r * whole < b
        first = F.greatest(F.ceil((F.col("a") - F.col("x")) / F.col("whole")), F.lit(0)).cast("long")
        last = F.ceil((F.col("b") - F.col("x")) / F.col("whole")).cast("long")
        return hit.where("size > 0").select(self.key, "source", F.greatest(last - first, F.lit(0)).cast("int").alias("repeats"), "size").where("repeats > 0")

    def report(self) -> DataFrame:
        """One row a target: its share and quota, what it holds, what was taken, the actual share, and whether it falls short."""
        got = self.got()
        own = {s: sum(n for p, n in self.sizes.items() if s in p) for s in self.targets}
        fixed = self.spark.createDataFrame([(s, float(t[0]), int(t[1]), own[s], self.quota[s], got[s] < self.quota[s]) for s, t in sorted(self.targets.items())], "source string, target_share double, max_repeat int, size long, quota long, short boolean")
        taken = self.selection().groupBy("source").agg(F.sum(F.col("repeats") * F.col("size")).alias("taken"), F.max("repeats").alias("most_repeats"))
        both = fixed.join(taken, "source", "left").withColumns({"taken": F.coalesce("taken", F.lit(0)), "most_repeats": F.coalesce("most_repeats", F.lit(0))})
        return both.withColumn("actual_share", F.coalesce(F.try_divide(F.col("taken"), F.sum("taken").over(Window.partitionBy(F.lit(0)))), F.lit(0.0)))
