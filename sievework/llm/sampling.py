"""Drawing a sample whose share of each category matches given target proportions.

1. The rows are counted by cell, the combination of their categories over all fields. A label that no target names
   counts as "other", so the number of cells is bounded by the targets, not by the rows; only these counts go to the
   driver.
2. Rake: iterative proportional fitting scales the cells to one field's targets after the other until all margins
   fit. A cell never gets more than its rows; what that leaves over is spread by the next rounds.
3. Round: the fitted cells become whole quotas whose margins stay as close as the fit allows (largest fractions first,
   within what each value still lacks), and add up to the sample size as far as there are rows.
4. Repair: a value below its minimum takes rows from cells without it whose values can spare them, the largest surplus
   first.
5. Draw: each row has a weighted exponential key, -ln(u) / w, with u from the hash of its key and the seed and w the
   weight of its cell; the rows with the smallest keys fill the quota of the cell. The keys are counted in buckets, so
   rows are ranked only in the one bucket of a cell that the quota cuts; no task holds a whole cell.
6. Report: for each target the rows it asks for, those that exist and those drawn, and the gap that stays.

Defined results: rows that repeat a key count once, rows without one not at all; a null label is the value "none" where targets name it and "other"
elsewhere; ties of keys are broken by the row's key; no targets, no rows or a size of 0 give an empty sample.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

OTHER = "~other"
NONE = "none"
#: Rows of one cell in one bucket of keys, at the most in the mean; and the bound on buckets.
BUCKET_ROWS = 100_000
MOST_BUCKETS = 4096
ROUNDS = 200


def label(column: Column | str) -> Column:
    """Trimmed, lower case, each run of blanks, hyphens and underscores as one underscore."""
    c = F.col(column) if isinstance(column, str) else column
    c = F.lower(F.regexp_replace(c.cast("string"), r"(?U)^\s+|\s+$", ""))
    return F.regexp_replace(c, r"(?U)[\s\-_]+", "_")


def number_label(column: Column | str) -> Column:
    """A number as a label, null as "none"."""
    c = F.col(column) if isinstance(column, str) else column
    return F.coalesce(c.cast("bigint").cast("string"), F.lit(NONE))


@dataclass
class Target:
    field: str
    value: str
    permille: int
    least: int

    def rows(self, n: int) -> int:
        return max(self.least, -(-self.permille * n // 1000))


def rake(counts: np.ndarray, cells: list[tuple], fields: list[str], targets: list[Target], n: int) -> np.ndarray:
    """Rows to draw from each cell, as real numbers. A cell with an "other" label has none."""
    known = np.array([OTHER not in c for c in cells])
    fitted = np.where(known, counts, 0).astype(float)
    if not fitted.sum() or not n:
        return np.zeros(len(cells))
    fitted *= n / fitted.sum()
    members = {(f, t.value): np.array([c[k] == t.value for c in cells]) for k, f in enumerate(fields) for t in targets if t.field == f}
    for _ in range(ROUNDS):
        before = fitted.copy()
        for t in targets:
            m = members[t.field, t.value]
            if (s := fitted[m].sum()) > 0:
                fitted[m] *= t.permille * n / 1000 / s
        fitted = np.minimum(fitted, counts)
        if np.abs(fitted - before).max() < 1e-9 * n:
            break
    if 0 < (s := fitted.sum()) < n:  # what full cells left over
        for _ in range(ROUNDS):
            free = np.where(known, counts - fitted, 0.0)
            lacking = n - fitted.sum()
            if lacking < 1e-9 or free.sum() <= 0:
                break
            open_ = np.where(free > 0, np.maximum(fitted, 1e-6), 0.0)
            fitted = np.minimum(fitted + open_ * lacking / open_.sum(), counts * known)
    return fitted


def quotas(fitted: np.ndarray, counts: np.ndarray, cells: list[tuple], fields: list[str], targets: list[Target], n: int) -> np.ndarray:
    """Whole numbers near ``fitted`` that keep the margins, reach n where there are rows, and the minimums where they can be met."""
    q = np.floor(fitted + 1e-9).astype(int)
    at = {(k, c[k]): [] for c in cells for k in range(len(fields))}
    for i, c in enumerate(cells):
        for k in range(len(fields)):
            at[k, c[k]].append(i)
    wanted = {(fields.index(t.field), t.value): t.permille * n / 1000 for t in targets}
    drawn = {kv: int(q[i].sum()) for kv, i in at.items()}
    supply = int(sum(m for m, c in zip(counts, cells) if OTHER not in c))
    for _ in range(max(0, min(n, supply) - int(q.sum()))):
        free = [i for i in range(len(cells)) if q[i] < counts[i] and OTHER not in cells[i]]
        i = max(free, key=lambda i: (sum(np.tanh(wanted.get((k, v), 0) - drawn[k, v]) for k, v in enumerate(cells[i])), fitted[i] - q[i], -i))
        q[i] += 1
        for kv in enumerate(cells[i]):
            drawn[kv] += 1
    least = {(fields.index(t.field), t.value): t.least for t in targets}
    for kv in sorted(least):
        while kv in at and drawn[kv] < least[kv]:
            gives = [i for i in range(len(cells)) if q[i] and cells[i][kv[0]] != kv[1] and all(drawn[x] > least.get(x, 0) for x in enumerate(cells[i]))]
            takes = [i for i in at[kv] if q[i] < counts[i]]
            if not takes:
                break
            i = max(takes, key=lambda i: (OTHER not in cells[i], counts[i] - q[i], -i))
            q[i] += 1
            for x in enumerate(cells[i]):
                drawn[x] += 1
            if int(q.sum()) > n:
                if not gives:
                    q[i] -= 1
                    for x in enumerate(cells[i]):
                        drawn[x] -= 1
                    break
                j = max(gives, key=lambda j: (min(drawn[x] - wanted.get(x, 0) for x in enumerate(cells[j])), q[j], -j))
                q[j] -= 1
                for x in enumerate(cells[j]):
                    drawn[x] -= 1
    return q


@dataclass
class Sample:
    rows: DataFrame
    report: DataFrame
    size: int


def draw(df: DataFrame, key: str, fields: Mapping[str, Column], targets: DataFrame, share: float = 0.5, seed: int = 42) -> Sample:
    """A sample of floor(share x rows). ``fields``: name -> label of a row; ``targets``: field, value, share_permille, min_rows.

    ``rows``: key, a column for each field, ``weight`` (rows that one drawn row stands for). ``report``: see step 6.
    ``df`` is read twice; only its key and labels are shuffled."""
    spark = df.sparkSession
    wanted = [Target(r["field"], r["value"], int(r["share_permille"]), int(r["min_rows"])) for r in targets.select(F.col("field"), label("value").alias("value"), "share_permille", "min_rows").collect()]
    names = [f for f in fields if any(t.field == f for t in wanted)]
    keep = [F.when(fields[f].isin([t.value for t in wanted if t.field == f]), fields[f]).otherwise(F.lit(OTHER)).alias(f"f{k}") for k, f in enumerate(names)]
    labelled = df.where(F.col(key).isNotNull()).select(F.col(key).alias("k"), *keep).dropDuplicates(["k"])
    if not names:
        empty = spark.createDataFrame([], "field string, value string, wanted long, available long, drawn long, residual double, short boolean")
        return Sample(labelled.where("false").select(F.col("k").alias(key), F.lit(1.0).alias("weight")), empty, 0)
    columns = [f"f{k}" for k in range(len(names))]
    counted = labelled.groupBy(*columns).count().collect()  # bounded by the targets
    counted.sort(key=lambda r: tuple(r)[:-1])
    cells = [tuple(r)[:-1] for r in counted]
    counts = np.array([r["count"] for r in counted], dtype=np.int64)
    total = int(counts.sum())
    n = int(np.floor(total * share + 1e-9))
    fitted = rake(counts, cells, names, wanted, n)
    q = quotas(fitted, counts, cells, names, wanted, n)

    report = []
    for t in wanted:
        m = np.array([t.field in names and c[names.index(t.field)] == t.value for c in cells], dtype=bool)
        there, drawn = int(counts[m].sum()) if len(m) else 0, int(q[m].sum()) if len(m) else 0
        report.append((t.field, t.value, t.rows(n), there, drawn, round(t.permille * n / 1000 - drawn, 3), there < t.rows(n)))
    report_df = spark.createDataFrame(report, "field string, value string, wanted long, available long, drawn long, residual double, short boolean")

    buckets = int(min(MOST_BUCKETS, max(1, -(-int(counts.max(initial=0)) // BUCKET_ROWS) * 2)))
    cell_rows = [(*c, int(a), float(w / a) if a else 0.0, i) for i, (c, a, w) in enumerate(zip(cells, counts, fitted)) if q[i] > 0]
    cell_schema = ", ".join([*(f"{c} string" for c in columns), "cell_rows long", "p double", "cell int"])
    cell_df = F.broadcast(spark.createDataFrame(cell_rows, cell_schema))  # one row a cell: bounded by the targets
    u = (F.pmod(F.xxhash64("k", F.lit(seed)), F.lit(1 << 53)).cast("double") + 1) / float((1 << 53) + 1)
    keyed = labelled.join(cell_df, columns).withColumn("u", u)
    # w is the same for all rows of a cell, so the keys of a cell are ordered as -ln(u)
    keyed = keyed.withColumn("bucket", F.least(F.floor((1 - F.col("u")) * buckets), F.lit(buckets - 1)).cast("int"))
    per: dict[int, dict[int, int]] = {}
    for r in keyed.groupBy("cell", "bucket").count().collect():  # cells x buckets: both bounded
        per.setdefault(r["cell"], {})[r["bucket"]] = r["count"]
    cuts = []
    for cell, have in per.items():
        left = int(q[cell])
        for b in sorted(have):
            cuts.append((cell, b, min(left, have[b]), have[b] <= left))
            left -= min(left, have[b])
            if not left:
                break
    cut_df = F.broadcast(spark.createDataFrame(cuts, "cell int, bucket int, take long, whole boolean"))
    taken = keyed.join(cut_df, ["cell", "bucket"]).withColumn("key", -F.log("u") / F.greatest(F.col("p"), F.lit(1e-12)))
    rank = F.row_number().over(Window.partitionBy("cell", "bucket").orderBy("key", "k"))
    part = taken.where("not whole").withColumn("rank", rank).where("rank <= take").drop("rank")
    weight = F.col("cell_rows") / F.col("quota")
    quota_df = F.broadcast(spark.createDataFrame([(i, int(x)) for i, x in enumerate(q) if x > 0] or [(-1, 1)], "cell int, quota long"))
    rows = taken.where("whole").unionByName(part).join(quota_df, "cell")
    rows = rows.select(F.col("k").alias(key), *[F.col(c).alias(f) for c, f in zip(columns, names)], weight.alias("weight"))
    return Sample(rows, report_df, n)


def unmet(sample: Sample) -> DataFrame:
    """``field``, ``value`` of the targets that fewer rows match than they ask for."""
    return sample.report.where("short").select("field", "value")
