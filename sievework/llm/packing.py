"""Filling containers of a fixed capacity with documents, hierarchically over several context sizes.

1. An item longer than the capacity is cut into full containers and a rest; nothing else is ever cut.
2. The sizes are counted. Sizes are whole numbers up to the capacity, so the counts have at most ``capacity`` rows
   whatever the number of documents, and they alone go to the driver.
3. The plan is made from the counts, for all items of a size at once. Each item is routed to the tier of the shortest context
   (``contexts``: the capacity, its half, its quarter) that holds it. From the longest tier to the shortest, the items of a tier open
   windows of its context, and what is left free in them is filled from the shorter tiers, longest item first, into the
   fullest window that holds it. Windows of a shorter tier that stay emptier than ``LEAST_FILL`` are given up, and their items packed
   into windows of the next longer one. Windows of a tier share containers: two of half the capacity, four of a quarter.
4. Each item gets its rank among the items of its size: size and bucket (a hash of the key, as many buckets as keep
   a bucket small) are ranked apart, and the counts of the buckets before it are added, all of it in Spark. So a size that a third
   of all documents have is never in one task. The rank is looked up in the plan.
5. Containers are dealt to step groups in turn, there and back, in the order of their cost (the sum of the squares of
   their lengths, as attention pays), so that the steps are balanced.

Defined results: an item of size 0 (null or empty text) needs no place and gets no row; ties are broken by the hash of
the key and the key; rows that repeat a key count once if the caller makes them unique (the queries do), rows without one not at all; extra columns are left out. An empty table gives no rows.
"""

from __future__ import annotations

import bisect
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F, types as T

#: Items of one size in one bucket, at the most in the mean.
BUCKET_ROWS = 200_000
#: Share of a shorter window that must be in use for it to stay.
LEAST_FILL = 0.985


@dataclass
class Group:
    """``n`` windows of one context filled alike: size -> items."""

    context: int
    n: int
    holds: dict[int, int]

    @property
    def used(self) -> int:
        return sum(s * k for s, k in self.holds.items())

    @property
    def cost(self) -> int:
        return sum(s * s * k for s, k in self.holds.items())


@dataclass
class Plan:
    """Groups of windows, longest context first; and where their items go: by size, runs of (first rank, first window, items of this
    size in a window)."""

    capacity: int
    groups: list[Group] = field(default_factory=list)
    runs: dict[int, list[tuple[int, int, int]]] = field(default_factory=lambda: defaultdict(list))
    #: (first window, context, first container) of each tier
    tiers: list[tuple[int, int, int]] = field(default_factory=list)
    #: (first container, containers, cost) of containers filled alike
    costs: list[tuple[int, int, int]] = field(default_factory=list)
    windows: int = 0
    containers: int = 0


def contexts(capacity: int) -> list[int]:
    """The context of each tier, longest first. Each divides the capacity."""
    return [capacity // k for k in (1, 2, 4) if capacity % k == 0 and capacity // k > 0]


class _Filler:
    """Best fit, for all items of a size at once."""

    def __init__(self, left: dict[int, int], context: int):
        self.left, self.context = left, context
        self.open: dict[int, list[Group]] = defaultdict(list)
        self.frees: list[int] = []
        self.full: list[Group] = []

    def put(self, g: Group, free: int) -> None:
        if not free:
            self.full.append(g)
            return
        if not self.open[free]:
            bisect.insort(self.frees, free)
        self.open[free].append(g)

    def fill(self, size: int, opens: bool) -> None:
        """Items of ``size`` into the fullest windows that hold them; ``opens``: the others open windows of their own."""
        while self.left[size] and (at := bisect.bisect_left(self.frees, size)) < len(self.frees):
            free = self.frees.pop(at)
            groups = self.open.pop(free)
            while groups and self.left[size]:
                self._into(groups.pop(), free, size)
            for g in groups:
                self.put(g, free)
        if opens and self.left[size]:
            k = self.context // size
            many, rest = divmod(self.left[size], k)
            self.left[size] = 0
            for n, items in ((many, k), (int(rest > 0), rest)):
                if n:
                    self.put(Group(self.context, n, {size: items}), self.context - items * size)

    def _into(self, g: Group, free: int, size: int) -> None:
        k = min(free // size, self.left[size])
        n = min(g.n, self.left[size] // k)
        self.left[size] -= n * k
        self.put(Group(g.context, n, {**g.holds, size: g.holds.get(size, 0) + k}), free - k * size)
        if g.n > n:
            self.put(Group(g.context, g.n - n, g.holds), free)

    def groups(self) -> list[Group]:
        return self.full + [g for free in self.frees for g in self.open[free]]


def plan_packing(counts: dict[int, int], capacity: int, tiers: Sequence[int] | None = None) -> Plan:
    """The plan for ``counts`` (size -> items). Work and result are bounded by the number of sizes, not of items."""
    plan, left = Plan(capacity), dict(counts)
    tiers = list(tiers or contexts(capacity))
    if tiers[0] != capacity or any(capacity % t for t in tiers):
        raise ValueError("the longest context is the capacity, and each divides it")
    route = {s: min(t for t in tiers if s <= t) for s in counts}
    order = sorted(counts, reverse=True)
    fillers: dict[int, _Filler] = {}
    for context in tiers:
        f = fillers[context] = _Filler(left, context)
        for opens in (True, False):  # the items of the tier, then the gaps from the shorter ones
            for size in order:
                if left[size] and (route[size] == context if opens else route[size] < context):
                    f.fill(size, opens)
    kept: dict[int, list[Group]] = {}
    for i, context in reversed(list(enumerate(tiers))):  # from the shortest: what isn't full enough moves up
        kept[context] = fillers[context].groups()
        if i:
            stay = [g for g in kept[context] if g.used >= LEAST_FILL * context]
            for g in kept[context]:
                if g.used < LEAST_FILL * context:
                    for s, k in g.holds.items():
                        left[s] += k * g.n
            kept[context] = stay
            for size in order:
                if left[size]:
                    fillers[tiers[i - 1]].fill(size, True)
    rank: dict[int, int] = dict.fromkeys(counts, 0)
    for context in tiers:
        per = capacity // context
        groups = sorted(kept[context], key=lambda g: (-g.cost, sorted(g.holds.items())))
        if not groups:
            continue
        plan.tiers.append((plan.windows, context, plan.containers))
        at = 0
        for g in groups:
            for size, k in g.holds.items():
                plan.runs[size].append((rank[size], plan.windows + at, k))
                rank[size] += g.n * k
            first, last = -(-at // per), -(-(at + g.n) // per)  # a container counts with its first window
            if last > first:
                plan.costs.append((plan.containers + first, last - first, g.cost * per))
            at += g.n
        plan.groups += groups
        plan.windows += at
        plan.containers += -(-at // per)
    for size in plan.runs:
        plan.runs[size].sort()
    return plan


def _steps_of(plan: Plan, group: int) -> tuple[np.ndarray, np.ndarray, int]:
    """First container of each run of containers filled alike, its place in the order of cost, and the number of steps."""
    order = sorted(plan.costs, key=lambda g: (-g[2], g[0]))
    firsts = np.array([g[0] for g in order], dtype=np.int64)
    places = np.cumsum([0, *[g[1] for g in order]])[:-1].astype(np.int64)
    by_first = np.argsort(firsts, kind="stable")
    return firsts[by_first], places[by_first], max(1, -(-plan.containers // group))


def pack(sizes: DataFrame, capacity: int, key: str = "doc_id", size: str = "n_tokens", step_group: int = 8, tiers: Sequence[int] | None = None) -> DataFrame:
    """Places of all items: ``key``, ``piece``, ``from_token``, ``to_token``, ``context``, ``window_id``, ``container_id``, ``step_id``.

    ``sizes`` is read three times (counts by size, counts by bucket, places); write it to the shared folder first if it is costly."""
    spark = sizes.sparkSession
    key_type = sizes.schema[key].dataType
    items = (
        sizes.where((F.col(size) > 0) & F.col(key).isNotNull())
        .select(F.col(key).alias("k"), F.col(size).cast("long").alias("n"))
        .select("k", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / capacity))).alias("piece"))
        .select("k", "piece", F.least(F.lit(capacity).cast("long"), F.col("n") - F.col("piece") * capacity).alias("length"))
    )
    counts = {r["length"]: r["count"] for r in items.groupBy("length").count().collect()}  # one row a size: at most the capacity
    plan = plan_packing(counts, capacity, tiers)
    buckets = max(1, -(-max(counts.values(), default=0) // BUCKET_ROWS))
    bucketed = items.withColumn("bucket", F.pmod(F.xxhash64("k", "piece"), F.lit(buckets)).cast("int"))
    by_bucket = bucketed.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_bucket.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    firsts, places, steps = _steps_of(plan, step_group)
    shared = spark.sparkContext.broadcast((dict(plan.runs), plan.tiers, firsts, places, steps))  # some entries for each size

    in_bucket = F.row_number().over(Window.partitionBy("length", "bucket").orderBy(F.xxhash64("k", "piece"), "k", "piece")) - 1
    ranked = bucketed.join(offsets, ["length", "bucket"]).select("k", "piece", "length", (F.col("before") + in_bucket).alias("rank"))
    schema = T.StructType([T.StructField(key, key_type), T.StructField("piece", T.IntegerType()), *[T.StructField(c, T.LongType()) for c in ("from_token", "to_token", "context", "window_id", "container_id", "step_id")]])

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        runs, of_tiers, starts, order, n_steps = shared.value
        arrays = {s: tuple(np.array(c, dtype=np.int64) for c in zip(*r)) for s, r in runs.items()}
        first_window, context, first_container = (np.array(c, dtype=np.int64) for c in zip(*(of_tiers or [(0, capacity, 0)])))
        for batch in batches:
            at, lengths = batch["rank"].to_numpy(), batch["length"].to_numpy()
            window = np.empty(len(batch), dtype=np.int64)
            for s in np.unique(lengths):
                mine = lengths == s
                first_rank, first, k = arrays[s]
                run = np.searchsorted(first_rank, at[mine], side="right") - 1
                window[mine] = first[run] + (at[mine] - first_rank[run]) // k[run]
            tier = np.searchsorted(first_window, window, side="right") - 1
            container = first_container[tier] + (window - first_window[tier]) // (capacity // context[tier])
            group = np.searchsorted(starts, container, side="right") - 1
            turn, slot = np.divmod(order[group] + container - starts[group], n_steps)
            start = batch["piece"].to_numpy() * capacity
            yield pd.DataFrame(
                {key: batch["k"], "piece": batch["piece"].astype("int32"), "from_token": start, "to_token": start + lengths, "context": context[tier], "window_id": window, "container_id": container, "step_id": np.where(turn % 2 == 0, slot, n_steps - 1 - slot)}
            )

    return ranked.mapInPandas(place, schema)


def packing_report(placed: DataFrame, capacity: int) -> DataFrame:
    """One row for each tier, and one with a null ``context`` for all: windows, containers, items, tokens, the most used of a window,
    ``fill``, the share of the space in use, and ``balance``, the mean cost of a step (the sum of the squares of the lengths) over the largest."""
    n = F.col("to_token") - F.col("from_token")
    # by window first, so no tier is in one task
    per = placed.groupBy("context", "window_id", "container_id", "step_id").agg(F.sum(n).alias("used"), F.count("*").alias("items"), F.sum(n * n).alias("cost"))
    by_step = per.rollup("step_id", "context").agg(F.sum("cost").alias("cost"), F.grouping("context").alias("all")).where("step_id is not null")
    balance = by_step.groupBy("context", "all").agg((F.avg("cost") / F.max("cost")).alias("balance"))
    whole = per.cube("context").agg(
        F.grouping("context").alias("all"), F.count("*").alias("windows"), F.count_distinct("container_id").alias("containers"), F.sum("items").alias("items"), F.sum("used").alias("tokens"), F.max("used").alias("most_used")
    )
    space = F.when(F.col("all") == 1, F.col("containers") * capacity).otherwise(F.col("windows") * F.col("context"))
    both = whole.withColumn("fill", F.col("tokens") / space).join(balance.withColumnRenamed("context", "c").withColumnRenamed("all", "a"), (F.col("all") == F.col("a")) & F.col("context").eqNullSafe(F.col("c")))
    return both.select("context", "windows", "containers", "items", "tokens", "most_used", "fill", "balance")


def split_items(placed: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key`` of the items that had to be cut."""
    return placed.groupBy(key).agg(F.max("piece").alias("last")).where("last > 0").select(key)
