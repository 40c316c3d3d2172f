"""Near-duplicate records with small edits, over a collection too large for pairwise comparison.

Deletion-variant signatures:

1. A record's words become a set of hashed word sequences (shingles). The signature has one digit for each of ``functions``
   hash functions, 16 bits of the least hash of the set (min-wise), so two records agree in a digit with the probability of
   their similarity. Digits stand where a plain bit signature has bits: at a similarity of 0.5, a quarter of all bits
   differ, and segments short enough to survive that would select nothing.
2. Records of equal sets are one record from here on, the one with the least key; the others are its copies. So a hot group
   of copies has the variants of one record.
3. The first digits of the signature are cut into fewer segments than digits may differ, so that one of them differs in at
   most one digit. Of each segment every variant with one digit as a wildcard is indexed. At a similarity s, a segment of d
   digits shares a variant with the probability s^d + d s^(d-1) (1-s); 12 segments of 4 find 98.9 % of the pairs at 0.5,
   99.8 % at 0.55 and all but one in ten thousand from 0.62.
4. A variant is a row of fixed width (``ROW_BYTES``): variant, key, and two bits of each of 128 digits. The rows are joined by
   equal variants, a few segments at a time (``PASSES``); the shuffle files of a pass are removed when it ends. How many
   bytes a record has in a shuffle depends on nothing but the parameters. The rows come sorted and are read as a
   stream, one run of equal variants after the other. A pair is a candidate if the two-bit digits agree as often as the
   threshold needs; this drops pairs that share a variant by chance.
5. A run of more than ``HOT`` rows isn't joined there. Its rows are written out, dealt into blocks of that size, and each
   pair of blocks is joined in a task of its own, so no task holds a hot variant and no pair is lost.
6. The sets of the candidates alone are made again from the texts and compared exactly.

No bucket is capped. Nothing about all records goes to the driver.

Defined results: records without a sequence (null or empty texts, fewer than k words) have no pair; words are maximal runs of
letters or digits in lower case; rows that repeat an exact (key, position) with the same content count once; ties don't occur,
pairs are ordered by key. The key must be a whole number; rows without one and extra columns are left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from sievework.runtime import Table, parallelism, written

WORD = re.compile(r"[^\W_]+")
#: Passes over the segments; rows of variants in a partition, in the mean; rows of a run that one task joins.
PASSES, PARTITION_ROWS, HOT = 3, 4_000_000, 20_000
#: Rows read at a time from the sorted stream; pairs in a block.
CHUNK, BLOCK = 200_000, 1 << 20
#: Bytes of the columns of a variant's row.
ROW_BYTES = 48
#: Keys of candidates that are broadcast to find their texts, at the most; more are joined.
BROADCAST_KEYS = 1_000_000
_U = np.uint64
_ONE = _U(1)


@dataclass(frozen=True)
class Params:
    k: int = 5  # words in a sequence
    threshold: float = 0.8
    least: int = 1  # sequences a record must have
    segments: int = 12
    digits: int = 4
    functions: int = 128  # digits of a signature; two bits of each tell chance from likeness
    seed: int = 1

    @property
    def width(self) -> int:
        """Digits that the segments have."""
        return self.segments * self.digits

    def hashes(self) -> tuple[np.ndarray, np.ndarray]:
        rng = np.random.default_rng(self.seed)
        return rng.integers(1, 1 << 32, self.functions, dtype=np.uint32) | np.uint32(1), rng.integers(0, 1 << 32, self.functions, dtype=np.uint32)

    def agreeing(self) -> int:
        """Two-bit digits that must agree: 3.5 standard deviations below what the threshold leads one to expect."""
        p = self.threshold + (1 - self.threshold) / 4
        return int(self.functions * p - 3.5 * (self.functions * p * (1 - p)) ** 0.5)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


_WORDS: dict[str, int] = {}


def shingles(text: str, k: int) -> np.ndarray:
    """Sorted hashes of the distinct sequences of k words."""
    words = WORD.findall(text.lower())
    hashes = list(map(_WORDS.get, words))
    if None in hashes:
        if len(_WORDS) > 500_000:
            _WORDS.clear()
        for w in words:
            if w not in _WORDS:
                _WORDS[w] = xxhash.xxh3_64_intdigest(w)
        hashes = list(map(_WORDS.get, words))
    n = len(hashes) - k + 1
    if n < 1:
        return np.empty(0, dtype=np.uint64)
    a = np.array(hashes, dtype=np.uint64)
    x = a[:n].copy()
    for i in range(1, k):
        x = x * _U(0x9E3779B97F4A7C15) + (a[i : i + n] ^ (a[i : i + n] >> _U(29)))
    return np.unique(_mixed(x))


def _signature(s: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = np.multiply.outer(a, (s >> _U(32)).astype(np.uint32))  # the hashes of a set are mixed already: a multiplication and an addition permute them enough
    h += b[:, None]
    return h.min(axis=1)


PLANES = ("b0", "b1", "b2", "b3")


def _planes(digits: np.ndarray) -> list[np.ndarray]:
    """Two bits of each of 128 digits, as four words of 64 bits: the first and second bits of the first 64 digits, then of the others."""
    place = np.arange(64, dtype=np.uint64)
    plane = lambda x, bit: (((x.astype(np.uint64) >> _U(bit)) & _ONE) << place[: x.shape[1]]).sum(axis=1, dtype=np.uint64).view(np.int64)
    return [plane(x, bit) for x in (digits[:, :64], digits[:, 64:128]) for bit in (0, 1)]


def _variants(digits: np.ndarray, p: Params, segments: range) -> np.ndarray:
    """Keys of the segments with one digit as a wildcard: n x (segments * digits)."""
    n, salt = len(digits), np.arange(segments.start * p.digits, segments.stop * p.digits, dtype=np.uint64)
    d = _mixed((salt + _ONE) * _U(0x9E3779B97F4A7C15) + digits[:, segments.start * p.digits : segments.stop * p.digits]).reshape(n, len(segments), p.digits)
    whole = np.bitwise_xor.reduce(d, axis=2)  # without one digit: the xor of the others
    return _mixed((whole[:, :, None] ^ d).reshape(n, -1) + salt * _U(0x9E3779B97F4A7C15)).view(np.int64)


def records(df: DataFrame, key: str, position: str, content: str) -> DataFrame:
    """``key``, ``text``: the contents of a key joined by position with a blank; a null content is empty."""
    part = F.struct(F.col(position), F.coalesce(F.col(content), F.lit("")).alias("c"))
    return df.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("bigint").alias("key")).agg(F.array_join(F.transform(F.array_sort(F.collect_set(part)), lambda x: x["c"]), " ").alias("text"))


def signatures(texts: DataFrame, p: Params) -> DataFrame:
    """key, set (hash of the set), digits (16 bits each), of the records with enough sequences among ``texts`` (key, text)."""
    a, b = p.hashes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sets, out = [], [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                s = shingles(text or "", p.k)
                if len(s) >= max(1, p.least):
                    keys.append(key)
                    sets.append(xxhash.xxh3_64_intdigest(s.tobytes()))
                    out.append(_signature(s, a, b))
            digits = _mixed(np.array(out, dtype=np.uint64).reshape(-1, p.functions)).astype(np.uint16)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(np.array(sets, dtype=np.uint64).view(np.int64)), pa.array([d.tobytes() for d in digits], pa.binary())], names=["key", "set", "digits"])

    return texts.mapInArrow(run, "key long, set long, digits binary")


def variants(leads: DataFrame, p: Params, segments: range) -> DataFrame:
    """v, key, ``PLANES``: ``len(segments) * digits`` rows for each record, of ``ROW_BYTES`` each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digits = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.uint16).reshape(-1, p.functions)
            if len(digits):
                v = _variants(digits, p, segments)
                spread = lambda x: pa.array(np.repeat(x, v.shape[1]))
                yield pa.RecordBatch.from_arrays([pa.array(v.ravel()), spread(batch.column(0).to_numpy()), *map(spread, _planes(digits))], names=["v", "key", *PLANES])

    return leads.select("key", "digits").mapInArrow(run, "v long, key long" + "".join(f", {c} long" for c in PLANES))


Rows = tuple[np.ndarray, ...]  # v, key, PLANES, sorted by v


def _near(rows: Rows, p: Params) -> Iterator[np.ndarray]:
    """Pairs of keys with one variant whose two-bit digits agree often enough, the smaller key first."""
    v, *side = rows
    step, live = 1, np.flatnonzero(v[1:] == v[:-1])
    while len(live):  # neighbours at distance 1, 2, ... in each run of one variant
        for at in range(0, len(live), BLOCK):
            x = live[at : at + BLOCK]
            yield _alike(side, side, x, x + step, p)
        step += 1
        live = live[live + step < len(v)]
        live = live[v[live] == v[live + step]]


def _alike(left: list[np.ndarray], right: list[np.ndarray], x: np.ndarray, y: np.ndarray, p: Params) -> np.ndarray:
    """Of the pairs at x and y (key, PLANES) those whose digits agree often enough."""
    (ka, *pa_), (kb, *pb) = left, right
    differ = sum(np.bitwise_count(((pa_[i][x] ^ pb[i][y]) | (pa_[i + 1][x] ^ pb[i + 1][y])).view(np.uint64)).astype(np.int64) for i in (0, 2))
    good = (p.functions - differ >= p.agreeing()) & (ka[x] != kb[y])
    a, b = ka[x[good]], kb[y[good]]
    return np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)


def _sorted_chunks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[Rows, bool]]:
    """The rows of a stream sorted by v, cut between runs; and whether they belong to a run of more than ``most`` rows."""
    held: list[Rows] = []
    size, hot = 0, None

    def parts(rows: Rows, last: bool) -> Iterator[tuple[Rows, bool]]:
        nonlocal held, size, hot
        v = rows[0]
        if hot is not None:  # the rest of a long run that has begun
            end = int(np.searchsorted(v, hot, side="right"))
            if end:
                yield tuple(c[:end] for c in rows), True
                rows = tuple(c[end:] for c in rows)
                v = rows[0]
            if len(v):
                hot = None
        held, size = [], 0
        if not len(v):
            return
        end = len(v) if last else int(np.searchsorted(v, v[-1], side="left"))
        if not last and len(v) - end > most:
            hot = v[-1]
            yield tuple(c[end:] for c in rows), True
        elif end < len(v):
            held, size = [tuple(c[end:] for c in rows)], len(v) - end
        starts = np.flatnonzero(np.r_[True, v[1:end] != v[: end - 1]]) if end else np.zeros(0, dtype=np.int64)
        counts = np.diff(np.r_[starts, end])
        long = np.repeat(counts > most, counts)
        for which in (True, False):
            if (mask := long == which).any():
                yield tuple(c[:end][mask] for c in rows), which

    for batch in batches:
        held.append(tuple(c.to_numpy() for c in batch.columns))
        size += batch.num_rows
        if size >= CHUNK:
            yield from parts(tuple(np.concatenate(c) for c in zip(*held)), False)
    if held:
        yield from parts(tuple(np.concatenate(c) for c in zip(*held)), True)


def _joined(rows: DataFrame, p: Params) -> DataFrame:
    """a, b: candidates; or, with b null, the row (v, a, PLANES) of a hot run, which is joined later."""
    most = HOT

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["a", "b", "v", *PLANES]
        for part, hot in _sorted_chunks(batches, most):
            if hot:
                v, key, *planes = map(pa.array, part)
                yield pa.RecordBatch.from_arrays([key, pa.nulls(len(key), pa.int64()), v, *planes], names=names)
                continue
            for pairs in _near(part, p):
                if len(pairs):
                    none = pa.nulls(len(pairs), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy()), *[none] * 5], names=names)

    return rows.mapInArrow(run, "a long, b long, v long" + "".join(f", {c} long" for c in PLANES))


def _hot_pairs(hot: DataFrame, p: Params) -> DataFrame:
    """a, b: candidates among the rows (v, a, PLANES) of hot runs. A run of n rows is n / HOT blocks, and each pair of blocks one
    group of at most some 2 HOT rows."""
    sizes = hot.groupBy("v").agg(F.ceil(F.count("*") / HOT).cast("int").alias("blocks"))
    dealt = hot.join(sizes, "v").withColumn("i", F.pmod(F.xxhash64("a"), "blocks").cast("int"))
    met = dealt.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("v", F.col("a").alias("key"), *PLANES, F.least("i", "j").alias("x"), F.greatest("i", "j").alias("y"), (F.col("i") > F.col("j")).alias("second"))

    def join(rows: pd.DataFrame) -> pd.DataFrame:
        one = rows["x"].iloc[0] == rows["y"].iloc[0]
        side = lambda which: tuple(rows.loc[which, c].to_numpy() for c in ("key", *PLANES))
        left, right = (side(rows["second"] == rows["second"]),) * 2 if one else (side(~rows["second"]), side(rows["second"]))
        out, wide = [np.zeros((0, 2), dtype=np.int64)], max(1, BLOCK // max(1, len(right[0])))
        for at in range(0, len(left[0]), wide):
            x = np.repeat(np.arange(at, min(len(left[0]), at + wide)), len(right[0]))
            out.append(_alike(left, right, x, np.tile(np.arange(len(right[0])), len(x) // max(1, len(right[0]))), p))
        return pd.DataFrame(np.concatenate(out), columns=["a", "b"])

    return met.groupBy("v", "x", "y").applyInPandas(join, "a long, b long")


def candidates(leads: DataFrame, p: Params, rows: int) -> list[Table]:
    """Tables a, b of candidates among ``leads`` (key, digits), one row for each time they meet; ``rows``: how many records there are."""
    out, spark = [], leads.sparkSession
    edges = np.linspace(0, p.segments, min(PASSES, p.segments) + 1).astype(int).tolist()
    for begin, end in zip(edges, edges[1:]):
        parts = parallelism(leads, -(-rows * (end - begin) * p.digits // PARTITION_ROWS))
        met = written(_joined(variants(leads, p, range(begin, end)).repartition(parts, "v").sortWithinPartitions("v"), p), "met")
        out.append(met)
        if (hot := met.df.where("b is null")).limit(1).count():
            out.append(written(_hot_pairs(hot, p), "hot"))
    return out


def _sets(texts: DataFrame, p: Params) -> DataFrame:
    """key, shingles: six bytes of each hash, sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [np.sort(shingles(t or "", p.k) >> _U(16)).view(np.uint8).reshape(-1, 8)[:, :6].tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, type=pa.binary())], names=["key", "shingles"])

    return texts.mapInArrow(run, "key long, shingles binary")


def _verified(pairs: DataFrame, sets: DataFrame, p: Params) -> DataFrame:
    """a, b, similarity of the pairs at or over the threshold."""
    threshold = p.threshold

    @F.pandas_udf("double")
    def similarity(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        def whole(x: bytes) -> np.ndarray:
            out = np.zeros((len(x) // 6, 8), dtype=np.uint8)
            out[:, :6] = np.frombuffer(x, dtype=np.uint8).reshape(-1, 6)
            return out.view(np.uint64).ravel()

        for xs, ys in batches:
            out = []
            for x, y in zip(xs, ys):
                x, y = whole(x), whole(y)
                both = np.sort(np.concatenate([x, y]))
                shared = int((both[1:] == both[:-1]).sum())
                out.append(shared / max(1, len(x) + len(y) - shared))
            yield pd.Series(out)

    side = lambda n: sets.select(F.col("key").alias(n), F.col("shingles").alias(f"s{n}"))
    compared = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", similarity("sa", "sb").alias("similarity"))
    return compared.where(F.col("similarity") >= threshold)


@dataclass
class Links:
    """``pairs``: a, b, similarity of records whose sets differ, one record for each set; ``copies``: a, b, where b has the set of a."""

    pairs: DataFrame
    copies: DataFrame


def links(df: DataFrame, key: str, position: str, content: str, p: Params) -> Links:
    """All links between records of ``df``; see the module. ``df`` is read twice, the second time for the candidates only."""
    signed = written(signatures(records(df, key, position, content), p), "signatures")
    several = signed.df.groupBy("set").agg(F.min("key").alias("a"), F.count("*").alias("n")).where("n > 1").select("set", "a")
    copies = written(signed.df.select("set", F.col("key").alias("b")).join(several, "set").where("a <> b").select("a", "b"), "copies")
    leads = written(signed.df.join(copies.df.select(F.col("b").alias("key")), "key", "left_anti").select("key", "digits"), "leads")
    signed.drop()
    met = candidates(leads.df, p, leads.df.count())
    leads.drop()
    every = met[0].df.select("a", "b")
    for t in met[1:]:
        every = every.unionByName(t.df.select("a", "b"))
    pairs = written(every.where("b is not null").distinct(), "candidates")
    for t in met:
        t.drop()
    keys = written(pairs.df.select(F.explode(F.array("a", "b")).alias("key")).distinct(), "keys")
    some = F.broadcast(keys.df) if keys.df.count() <= BROADCAST_KEYS else keys.df  # beyond, a join on the key that the records are grouped by anyway
    texts = records(df.where(F.col(key).isNotNull()).withColumn(key, F.col(key).cast("bigint")).join(some.withColumnRenamed("key", key), key, "left_semi"), key, position, content)
    sets = written(_sets(texts, p), "sets")
    similar = written(_verified(pairs.df, sets.df, p), "links")
    for t in (pairs, keys, sets):
        t.drop()
    return Links(similar.df, copies.df)


#: Rows of a group of copies that meet in one task.
COPIES = 1000


def all_pairs(found: Links, key: str) -> DataFrame:
    """``key``_a, ``key``_b: the links with the copies written out, the copies of one set included.

    That is n^2 / 2 rows for n copies; ``groups`` has one row for each record instead. The rows of a large group are dealt
    to as many tasks as it has ``COPIES``."""
    copies = found.copies
    own = copies.select(F.col("a").alias("lead"), F.col("b").alias("member")).unionByName(copies.select(F.col("a").alias("lead"), F.col("a").alias("member")).distinct())
    sizes = copies.groupBy(F.col("a").alias("lead")).agg(F.ceil((F.count("*") + 1) / COPIES).cast("int").alias("salts"))
    own = own.join(sizes, "lead")
    a, b = own.select(F.col("lead").alias("a"), F.col("member").alias("ma")), own.select(F.col("lead").alias("b"), F.col("member").alias("mb"))
    near = found.pairs.join(a, "a", "left").join(b, "b", "left").select(F.coalesce("ma", "a").alias("x"), F.coalesce("mb", "b").alias("y"))
    dealt = own.select("lead", F.col("member").alias("x"), F.pmod(F.xxhash64("member"), "salts").cast("int").alias("salt"))
    spread = own.select("lead", F.col("member").alias("y"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    same = dealt.join(spread, ["lead", "salt"]).where("x < y").select("x", "y")
    return near.unionByName(same).select(F.least("x", "y").alias(f"{key}_a"), F.greatest("x", "y").alias(f"{key}_b"))


def groups(found: Links, key: str) -> DataFrame:
    """``key``, ``group_id`` (the least key of the group), ``links``: one row for each record with a link.

    Each round the first record of every set takes the least group among itself and its neighbours, and then that group's own
    group, until nothing changes; each round is a table in the shared folder, and the one before is removed. ``links`` is the number
    of rows of ``all_pairs`` that have the record: a neighbour counts with all of its copies, and so do the record's own copies. A
    copy has the group and the links of the first record of its set."""
    pairs = found.pairs.select("a", "b")
    both = written(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))), "both")
    copies = found.copies.groupBy("a").agg(F.count("*").alias("copies"))
    near = both.df.join(copies.withColumnRenamed("a", "b"), "b", "left").groupBy("a").agg(F.sum(1 + F.coalesce("copies", F.lit(0))).alias("near"), F.min("b").alias("b"))
    nodes = near.join(copies, "a", "full").select(F.col("a").alias("node"), (F.coalesce("near", F.lit(0)) + F.coalesce("copies", F.lit(0))).alias("links"), F.lit(None).cast("long").alias("old"), F.least("a", "b").alias("g"))
    now = written(nodes, "round")
    while True:
        one = now.df.select("node", "links", "g")
        least = both.df.join(one.select(F.col("node").alias("b"), F.col("g").alias("gb")), "b").groupBy("a").agg(F.min("gb").alias("m"))
        step = one.join(least, one["node"] == least["a"], "left").select("node", "links", F.col("g").alias("old"), F.least("g", "m").alias("g1"))
        jump = one.select(F.col("node").alias("g1"), F.col("g").alias("g2"))
        after = written(step.join(jump, "g1", "left").select("node", "links", "old", F.least(F.col("g1"), F.coalesce("g2", "g1")).alias("g")), "round")
        now.drop()
        now = after
        if not now.df.where("g <> old").limit(1).count():
            break
    both.drop()
    first = now.df.select("node", F.col("g").alias("group_id"), "links")
    others = found.copies.join(first, found.copies["a"] == first["node"]).select(F.col("b").alias("node"), "group_id", "links")
    return first.unionByName(others).withColumnRenamed("node", key)
