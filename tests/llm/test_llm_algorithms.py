"""Near duplicates, sampling, splitting, packing: brute force, exact round trips, odd input."""

import math
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from sievework.llm import neardup, packing, sampling, splitting

# --- near duplicates


def shingle_set(text, k):
    w = re.findall(r"[^\W_]+", text.lower())
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def brute(records, p):
    sets = {i: s for i, t in records.items() if len(s := shingle_set(t, p.k)) >= max(1, p.least)}
    return {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= p.threshold}


def edited(words, rng, share):
    out = []
    for w in words:
        r = rng.random()
        if r < share / 3:
            continue
        out += [f"n{rng.randrange(10**6)}"] if r < 2 * share / 3 else [w, f"x{rng.randrange(10**6)}"] if r < share else [w]
    return out


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(3000)]
    records, n = {}, 0
    for _ in range(60):
        base = [rng.choice(vocabulary) for _ in range(rng.randrange(60, 200))]
        records[n] = " ".join(base)
        n += 1
        for share in (0.0, 0.02, 0.06, 0.10):
            records[n] = " ".join(edited(base, rng, share)).title() + "!"
            n += 1
    half = records[0].split()
    records[n] = " ".join(half[len(half) // 2 :] + half[: len(half) // 2])  # reordered
    records[n + 1] = ""
    records[n + 2] = "too short"
    return records


@pytest.mark.parametrize("p", [neardup.Params(k=3, threshold=0.5, least=30), neardup.Params()])
def test_links_equal_brute_force(spark, corpus, p):
    rows = [(i, pos, part) for i, t in corpus.items() for pos, part in enumerate([t[: len(t) // 3].rsplit(" ", 1)[0], t[len(t[: len(t) // 3].rsplit(" ", 1)[0]) :]])]
    rows += rows[:40] + [(10**6, 0, None)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "ex_id long, pos int, content string").withColumn("key", F.lit(1)).withColumn("text", F.lit(2))
    found = neardup.links(df, "ex_id", "pos", "content", p)
    got = set(map(tuple, neardup.all_pairs(found, "ex_id").collect()))
    want = brute(corpus, p)
    assert got <= want and len(got) >= 0.995 * len(want) and len(want) > 100
    groups = {r["ex_id"]: r["group_id"] for r in neardup.groups(found, "ex_id").collect()}
    lead = {}

    def root(x):
        while lead.setdefault(x, x) != x:
            x = lead[x]
        return x

    for a, b in got:
        lead[max(root(a), root(b))] = min(root(a), root(b))
    assert groups == {x: root(x) for x in list(lead)}


def test_hot_copies_and_no_rows(spark, monkeypatch):
    text = " ".join(f"w{i}" for i in range(120))
    df = spark.createDataFrame([(i, 0, text) for i in range(300)] + [(1000, 0, text + " end")], "ex_id long, pos int, content string")
    found = neardup.links(df, "ex_id", "pos", "content", neardup.Params(k=3, threshold=0.5))
    assert [tuple(r)[:2] for r in found.pairs.collect()] == [(0, 1000)] and found.copies.count() == 299
    assert neardup.all_pairs(found, "ex_id").count() == 301 * 300 // 2
    monkeypatch.setattr(neardup, "HOT", 1)  # every run that has a pair is a hot one
    again = neardup.links(df, "ex_id", "pos", "content", neardup.Params(k=3, threshold=0.5))
    assert [tuple(r)[:2] for r in again.pairs.collect()] == [(0, 1000)]
    none = neardup.links(df.limit(0), "ex_id", "pos", "content", neardup.Params())
    assert neardup.all_pairs(none, "ex_id").count() == 0 and neardup.groups(none, "ex_id").count() == 0


def test_links_of_copies(spark):
    """Every copy has the number of its pairs, whichever key of the set is the least."""
    text = " ".join(f"w{i}" for i in range(120))
    other = " ".join(f"v{i}" for i in range(120))
    rows = [(i, 0, text) for i in (1, 5, 9)] + [(i, 0, text + " end") for i in (3, 7)] + [(4, 0, "start " + text)] + [(i, 0, other) for i in (2, 6)] + [(8, 0, "alone " * 5)]
    found = neardup.links(spark.createDataFrame(rows, "ex_id long, pos int, content string"), "ex_id", "pos", "content", neardup.Params(k=3, threshold=0.5))
    degree = {}
    for a, b in neardup.all_pairs(found, "ex_id").collect():
        degree[a], degree[b] = degree.get(a, 0) + 1, degree.get(b, 0) + 1
    got = neardup.groups(found, "ex_id").collect()
    assert {r["ex_id"]: r["links"] for r in got} == degree == {1: 5, 3: 5, 4: 5, 5: 5, 7: 5, 9: 5, 2: 1, 6: 1}
    assert {r["ex_id"]: r["group_id"] for r in got} == {1: 1, 3: 1, 4: 1, 5: 1, 7: 1, 9: 1, 2: 2, 6: 2} and len(got) == 8


@pytest.mark.parametrize("p", [neardup.Params(k=3, threshold=0.5), neardup.Params()])
def test_two_bit_digits_drop_few_pairs_at_the_threshold(p):
    agree = p.threshold + (1 - p.threshold) / 4
    assert sum(math.comb(p.functions, i) * agree**i * (1 - agree) ** (p.functions - i) for i in range(p.agreeing())) < 5e-4


def test_bytes_of_a_record_do_not_depend_on_the_partitions(spark, corpus):
    p = neardup.Params(k=3, threshold=0.5, least=30)
    texts = spark.createDataFrame(list(corpus.items()), "key long, text string")
    leads = neardup.signatures(texts, p).select("key", "digits").crossJoin(spark.range(30)).select((F.col("key") + 1000 * F.col("id")).alias("key"), "digits").cache()
    n, moved = leads.count(), []
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for parts in (6, 600):
            query = neardup.variants(leads, p, range(p.segments)).repartition(parts, "v")._jdf.queryExecution()
            assert query.toRdd().count() == n * p.width
            moved.append(query.executedPlan().metrics().apply("shuffleBytesWritten").value())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert moved[1] < 1.2 * moved[0] and moved[0] < (neardup.ROW_BYTES + 8) * n * p.width
    leads.unpersist()


def test_hot_runs_are_joined_in_blocks(spark, monkeypatch):
    """Long runs are told from the others wherever the batches end, and their blocks give all of their pairs."""
    p = neardup.Params(k=3, threshold=0.5, least=30)
    rng = np.random.default_rng(3)
    v = np.sort(rng.integers(0, 40, 5000))
    rows = (v, np.arange(5000), rng.integers(0, 1 << 60, 5000), rng.integers(0, 1 << 60, 5000))
    batches = [neardup.pa.RecordBatch.from_arrays([neardup.pa.array(c[i : i + 700]) for c in rows], names=list("vklh")) for i in range(0, 5000, 700)]
    for chunk, hot in ((100, 3), (1000, 60), (1000, 10**6), (10**6, 130)):
        monkeypatch.setattr(neardup, "CHUNK", chunk)
        parts = list(neardup._sorted_chunks(iter(batches), hot))
        assert sorted(np.concatenate([x[1] for x, _ in parts]).tolist()) == list(range(5000))
        long = {int(k) for k, n in zip(*np.unique(v, return_counts=True)) if n > hot}
        assert {int(k) for x, is_hot in parts if is_hot for k in x[0]} == long
        assert all(len(set(x[0]) & set(y[0])) == 0 for (x, xh), (y, yh) in zip(parts, parts[1:]) if not xh or not yh)
    hot = spark.createDataFrame([(7, i, 0, 0, 0, 0) for i in range(9)] + [(8, i, 0, 0, 0, -1 if i % 2 else 0) for i in range(5)], "v long, a long, b0 long, b1 long, b2 long, b3 long")
    monkeypatch.setattr(neardup, "HOT", 2)
    got = {tuple(r) for r in neardup._hot_pairs(hot, p).collect()}
    assert got == {(a, b) for a in range(9) for b in range(a + 1, 9)}


# --- sampling


def draw(spark, rows, targets, share=0.5):
    df = spark.createDataFrame(rows, "ex_id long, a string, g int").withColumn("cell", F.lit(1)).withColumn("weight", F.lit(2))
    t = spark.createDataFrame(targets, "field string, value string, share_permille int, min_rows int")
    return sampling.draw(df, "ex_id", {"a": sampling.label("a"), "g": sampling.number_label("g")}, t, share)


def test_sample_meets_margins(spark, monkeypatch):
    monkeypatch.setattr(sampling, "BUCKET_ROWS", 200)
    rng = random.Random(2)
    rows = [(i, rng.choice(["Big one", " big-one ", "BIG_ONE", "small", "other"]), rng.choice([4, 5, None])) for i in range(4000)]
    targets = [("a", "big one", 600, 5), ("a", "small", 400, 5), ("g", "4", 500, 5), ("g", "5", 300, 5), ("g", "none", 200, 5)]
    s = draw(spark, rows + rows[:100], targets, 0.1)
    got = s.rows.toPandas()
    assert len(got) == 400 == s.size and got["ex_id"].is_unique
    report = {(r["field"], r["value"]): r for r in s.report.collect()}
    assert all(abs(r["residual"]) <= 2 and not r["short"] for r in report.values())
    assert (got["a"] == "big_one").sum() == report["a", "big_one"]["drawn"]
    assert abs(got["weight"].sum() - sum(1 for r in rows if sampling_label(r[1]) in ("big_one", "small"))) < 1e-6
    again = draw(spark, rows, targets, 0.1).rows.toPandas()
    assert set(again["ex_id"]) == set(got["ex_id"])


def sampling_label(x):
    return re.sub(r"[\s\-_]+", "_", x.strip().lower())


def test_minimum_and_shortage(spark):
    rows = [(i, "big", 4) for i in range(200)] + [(1000 + i, "rare", 5) for i in range(6)] + [(2000, None, 99)]
    s = draw(spark, rows, [("a", "big", 990, 5), ("a", "rare", 10, 4), ("a", "absent", 0, 3), ("g", "4", 995, 1), ("g", "5", 5, 1)], 0.25)
    got = s.rows.toPandas()
    assert (got["a"] == "rare").sum() >= 4 and len(got) == 51
    assert sorted(map(tuple, sampling.unmet(s).collect())) == [("a", "absent")]


@pytest.mark.parametrize("rows,targets", [([], [("a", "x", 1000, 1)]), ([(1, "x", 4)], []), ([(1, "x", 4)], [("a", "x", 1000, 0)])])
def test_samples_of_nothing(spark, rows, targets):
    assert draw(spark, rows, targets).rows.count() == 0


# --- splitting


@given(st.text(alphabet=st.sampled_from("ab1 \n.é中#-|`́,"), max_size=300), st.integers(2, 40), st.data())
@settings(max_examples=400, deadline=None)
def test_pieces_give_the_text_back(text, size, data):
    overlap = data.draw(st.integers(0, size - 1))
    pieces = splitting.split_text(text, size, overlap)
    assert "".join(text[a + o : b] for a, b, o, _ in pieces) == text
    assert all(0 < b - a <= size and 0 <= o <= overlap for a, b, o, _ in pieces)
    forced = any(c == splitting.FORCED for *_, c in pieces)
    assert forced == bool(re.search(r"[A-Za-z0-9]{%d,}" % (size + 1), text))


def test_cuts_are_the_highest_boundaries():
    text = "# One\n\n" + "Alpha beta. " * 8 + "\n\n# Two\n\n" + "Gamma delta. " * 8
    parts = [text[a + o : b] for a, b, o, _ in splitting.split_text(text, 130, 10)]
    assert parts[0].startswith("# One") and any(p.startswith("# Two") for p in parts)
    items = "intro\n" + "".join(f"- item number {i} of the list\n" for i in range(20))
    assert all(items[a + o : b].startswith(("- ", "intro")) for a, b, o, _ in splitting.split_text(items, 120, 0))


def own_parts(text, size, overlap=0):
    return [text[a + o : b] for a, b, o, _ in splitting.split_text(text, size, overlap)]


def test_pieces_are_nodes_or_runs_of_siblings():
    """A section that is cut is never joined with the ones beside it."""
    a, b, c = "# A\n\n" + "Alpha beta gamma. " * 40 + "\n\n", "# B\n\nShort text of B.\n\n", "# C\n\nShort text of C."
    parts = own_parts(a + b + c, 400)
    assert parts[-1] == b + c and "".join(parts[:-1]) == a
    parts = own_parts(b + a + c, 400, 20)
    assert parts[0] == b and parts[-1] == c


def test_lists_and_elements_nest():
    inner = "".join(f"  - inner item {i} with words\n" for i in range(6))
    text = "- first\n" + inner + "- second\n" + inner
    assert own_parts(text, len(text) // 2 + 5) == ["- first\n" + inner, "- second\n" + inner]
    parts = own_parts(text, 90)
    assert all(p.startswith(("- ", "  - ")) for p in parts) and sum("- second" in p for p in parts) == 1 and next(p for p in parts if "- second" in p).startswith("- second")
    rows = "".join(f"<li>item {i} of the list</li>" for i in range(8))
    page = f"<div><p>one paragraph</p><ul>{rows}</ul></div><div><p>another one</p></div>"
    parts = own_parts(page, 120)
    assert parts[-1] == "<div><p>another one</p></div>" and all(p.startswith("<") and p.endswith(">") for p in parts)
    sections = "".join(f"<h1>Title {i}</h1><p>{'some words ' * 9}</p>" for i in range(4))
    assert [p[:4] for p in own_parts(sections, 150)] == ["<h1>"] * 4


def test_deep_nesting_and_a_heading_stays_with_its_text():
    deep = "<div>" * 3000 + "word " * 50 + "</div>" * 3000
    assert "".join(own_parts(deep, 100)) == deep
    text = "# One\n\n" + "Alpha beta. " * 30 + "\n\n" + "Gamma delta. " * 5
    assert own_parts(text, 100)[0].startswith("# One\n\nAlpha")


@pytest.mark.parametrize("text,n", [("", 0), ("x", 1), (" " * 5, 1), ("y" * 100_000, 224), ("word " * 20_000, 224)])
def test_long_and_empty_texts(text, n):
    assert abs(len(splitting.split_text(text, 512, 64)) - n) <= 0.02 * n


def test_split_items(spark):
    df = spark.createDataFrame([("a", None), ("b", ""), ("c", "z" * 30), ("d", "aa bb cc dd ee"), ("e", "short")], "k string, text string").withColumn("piece", F.lit(7)).withColumn("cut", F.lit(1))
    pieces = splitting.split_items(df, "chunk", 10, 2, "k")
    assert sorted(map(tuple, splitting.oversized_items(pieces).collect())) == [("chunk", "c", "forced"), ("chunk", "d", "natural")]
    assert splitting.split_items(df.limit(0), "chunk", 10, 2, "k").count() == 0


def test_split_arguments():
    with pytest.raises(ValueError):
        splitting.split_text("abc", 2, 2)


# --- packing


def filled(plan, counts):
    """Tokens in each window, by the runs."""
    used = [0] * plan.windows
    for size, n in counts.items():
        runs = plan.runs[size]
        for i in range(n):
            first, window, k = next(r for r in reversed(runs) if r[0] <= i)
            used[window + (i - first) // k] += size
    return used


@given(st.lists(st.integers(1, 64), max_size=200), st.sampled_from([16, 64, 100]))
@settings(max_examples=150, deadline=None)
def test_plan_holds_everything_once(sizes, capacity):
    sizes = [min(s, capacity) for s in sizes]
    counts = {s: sizes.count(s) for s in sizes}
    plan = packing.plan_packing(counts, capacity)
    used = filled(plan, counts)
    contexts = [c for i, (first, c, _) in enumerate(plan.tiers) for _ in range((plan.tiers[i + 1][0] if i + 1 < len(plan.tiers) else plan.windows) - first)]
    assert all(0 < u <= c for u, c in zip(used, contexts)) and len(contexts) == plan.windows and sum(used) == sum(sizes) == sum(g.n * g.used for g in plan.groups)
    assert all(u >= packing.LEAST_FILL * c for u, c in zip(used, contexts) if c < capacity)
    assert sum(n for _, n, _ in plan.costs) == plan.containers and sum(g.n for g in plan.groups) == plan.windows
    if sizes:  # no worse than first fit, decreasing, by more than a tenth and a container for each tier
        bins: list[int] = []
        for s in sorted(sizes, reverse=True):
            for j, b in enumerate(bins):
                if b + s <= capacity:
                    bins[j] += s
                    break
            else:
                bins.append(s)
        assert plan.containers <= len(bins) * 1.1 + 3


def test_tiers_make_a_difference():
    """Short items get windows of their own context, gaps of long windows are filled from shorter tiers, and each tier changes the plan."""
    rng = np.random.default_rng(8)
    counts = {int(s): int(n) for s, n in zip(*np.unique(np.minimum(2048, rng.lognormal(5.5, 1.1, 20_000).astype(int) + 1), return_counts=True))}
    plans = [packing.plan_packing(counts, 2048, t) for t in ((2048,), (2048, 1024), (2048, 512), (2048, 1024, 512))]
    contexts = [{c for _, c, _ in p.tiers} for p in plans]
    assert contexts == [{2048}, {2048, 1024}, {2048, 512}, {2048, 1024, 512}]
    assert len({tuple((g.context, g.n, tuple(sorted(g.holds.items()))) for g in p.groups) for p in plans}) == 4
    fills = [sum(s * n for s, n in counts.items()) / (2048 * p.containers) for p in plans]
    assert min(fills) > 0.985, fills
    assert any(g.context == 2048 and max(g.holds) > 1024 and min(g.holds) <= 512 for g in plans[3].groups)
    costs = [sum(g.n * g.used**2 for g in p.groups) for p in plans]  # what attention over whole windows costs
    assert costs[3] < costs[0]
    with pytest.raises(ValueError):
        packing.plan_packing(counts, 2048, (1024, 512))


def test_pack(spark, monkeypatch):
    monkeypatch.setattr(packing, "BUCKET_ROWS", 50)
    rng = np.random.default_rng(1)
    rows = [(i, int(x)) for i, x in enumerate([*rng.integers(1, 40, 400), *[7] * 300, 0, 0, 64, 65, 200])] + [(10**6, None)]
    df = spark.createDataFrame(rows, "doc_id long, n_tokens int").withColumn("bucket", F.lit(1)).withColumn("k", F.lit(1))
    got = packing.pack(df, 64).toPandas()
    assert (got.groupby("container_id").apply(lambda g: (g["to_token"] - g["from_token"]).sum(), include_groups=False) <= 64).all()
    length = (got["to_token"] - got["from_token"]).groupby(got["doc_id"]).sum()
    assert dict(length) == {i: n for i, n in rows if n}
    assert not got.duplicated(["doc_id", "piece"]).any()
    assert sorted(packing.split_items(packing.pack(df, 64)).toPandas()["doc_id"]) == [703, 704]
    assert got.assign(n=got["to_token"] - got["from_token"]).groupby("window_id").agg(n=("n", "sum"), c=("context", "first")).eval("n <= c").all()
    report = {r["context"]: r for r in packing.packing_report(packing.pack(df, 64), 64).collect()}
    assert report[None]["fill"] > 0.97 and report[None]["items"] == len(got) and sum(r["tokens"] for c, r in report.items() if c) == report[None]["tokens"]
    assert set(report) == {None, *got["context"]} and all(0 < r["balance"] <= 1 for r in report.values())
    steps = got.groupby("step_id")["container_id"].nunique()
    assert steps.max() <= 8
    assert packing.pack(df.limit(0), 64).count() == 0
