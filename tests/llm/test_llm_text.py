"""Encoding, confusables, scans, broken pairs: exact round trips, brute force, held-out accuracy, odd input."""

import os

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from sievework.llm import bpe, confusables, pairs, scans

DATA = "/root/testdata/sf0.01"
needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
needs_vocabulary = pytest.mark.skipif(not os.path.isdir(bpe.TOKENIZER_DIR), reason="no vocabularies")

# --- encoding


@pytest.fixture(scope="module")
def reference():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=bpe.SPLIT_PATTERN, mergeable_ranks=bpe.read_vocabulary(), special_tokens={})


@needs_vocabulary
@given(st.text(max_size=200))
@settings(max_examples=150, deadline=None)
def test_ids_of_any_text(text):
    e = bpe.encoder()
    text = text.encode("utf-8", "replace").decode("utf-8")
    ids = e.encode(text)
    assert e.decode(ids) == text
    assert ids == [i for p in e.split.findall(text) for i in e.machine.merged(p.encode("utf-8"))]  # the merges as defined


@needs_vocabulary
@pytest.mark.parametrize("text", ["", "a" * 100_000, "<|endoftext|> x", "  \n\t é́ ​", "日本語のテキスト。" * 500, "don't we'll I'D", "0" * 999 + " " * 999])
def test_ids_equal_the_library(reference, text):
    assert bpe.encoder().encode(text) == reference.encode_ordinary(text)


@needs_vocabulary
def test_small_tables_change_nothing(reference, monkeypatch):
    monkeypatch.setattr(bpe, "MOST_STEPS", 50)
    monkeypatch.setattr(bpe, "MOST_PIECES", 5)
    e = bpe.Encoder()
    for text in ("The quick brown fox jumps over the lazy dog, twice.", "Überraschung déjà vu " * 20):
        assert e.encode(text) == reference.encode_ordinary(text)


@needs_vocabulary
def test_lone_surrogates():
    assert bpe.encoder().decode(bpe.encoder().encode("a\ud800b")) == "a�b"


@given(st.binary(max_size=40), st.lists(st.integers(0, 40), max_size=6))
@settings(max_examples=200, deadline=None)
def test_utf8_machine(data, cuts):
    m, at, out = bpe.Utf8Machine(), 0, []
    for c in [*sorted(min(c, len(data)) for c in cuts), len(data)]:
        out.append(m.feed(data[at:c]))
        at = c
    assert "".join(out) + m.close() == data.decode("utf-8", "replace")


@needs_vocabulary
def test_encode_documents(spark):
    df = spark.createDataFrame([(1, None, 9), (2, "", 9), (3, "Hello world", 9), (3, "Hello world", 9)], "doc_id long, text string, ids int")
    got = sorted((r["doc_id"], r["ids"]) for r in bpe.encode_documents(df).collect())
    assert got == [(1, []), (2, []), (3, [15496, 995]), (3, [15496, 995])]
    assert bpe.encode_documents(df.limit(0)).count() == 0
    assert sorted(r["n_tokens"] for r in bpe.token_counts(df).collect()) == [0, 0, 2, 2]
    back = bpe.decode_documents(bpe.encode_documents(df))
    assert sorted(r["text"] for r in back.collect()) == ["", "", "Hello world", "Hello world"]


# --- confusables


@pytest.mark.parametrize(
    "a,b",
    [
        ("ｐａｓｓ　１２", "pass 12"), ("été", "été"), ("a b c", "a b c"), ("so​ft­", "soft"), ("раypаl accоunt", "paypal account"),
        ("ﬁnal oﬀer", "final offer"), ("Ångström", "Ångström"), ("x‑y", "x-y"), ("νery gοοd", "very good"), ("привет cвет", "привет свет"), ("a\r\nb", "a\nb"), ("ɡood", "good"),
    ],
)
def test_same_look(a, b):
    assert confusables.normal_form(a) == confusables.normal_form(b)


@pytest.mark.parametrize("a,b", [("x²", "x2"), ("③", "3"), ("é", "e"), ("A", "a"), ("a b", "a  b"), ("a\nb", "a b"), ("👩‍🏫", "👩🏫"), ("ß", "ss"), ("a\tb", "a b"), ("“a”", '"a"')])
def test_other_look(a, b):
    assert confusables.normal_form(a) != confusables.normal_form(b)


def test_forms_of_nothing_visible():
    assert confusables.normal_form(None) is None
    assert {confusables.normal_form(x) for x in ("", " \n", "​‍", "﻿ ")} == {""}


@given(st.text(alphabet="abcеорсху ABΑΒ́​ ｆ１é", max_size=30))
@settings(max_examples=200, deadline=None)
def test_form_is_stable(text):
    form = confusables.normal_form(text)
    assert confusables.normal_form(form) == form


def test_script_sets():
    assert confusables.resolved_scripts("сор") == {"Latin", "Cyrillic"} and confusables.kind_of_run("сор") == "whole"
    assert confusables.kind_of_run("рaypal") == "mixed" and confusables.kind_of_run("день") == "single"
    assert confusables.resolved_scripts("漢字かなカナ") == {"Japanese"} and confusables.kind_of_run("漢字かなカナ") == "single"
    assert confusables.resolved_scripts("漢字한글") == {"Korean"} and confusables.kind_of_run("漢字x") == "mixed"
    assert [confusables.script_of(c) for c in "Ａªʰーꓮᐁ한漢ｶⅣ"] == ["Latin", "Latin", "Latin", None, "Lisu", "Canadian_Aboriginal", "Hangul", "Han", "Katakana", None]


def test_shapes_of_unicode(spark):
    shapes = confusables.unicode_shapes(spark)
    like = {"\ua4ee": "A", "\u13df": "C", "\u2c9f": "o", "\u101d": "o", "\u0578": "n", "\u217c": "l", "\u2160": "I", "\u0406": "I", "\u04cf": "l", "\u03bf": "o"}
    for other, plain in like.items():
        assert confusables.normal_form(f"a w{other}rd with it", shapes) == f"a w{plain}rd with it", other
    for gone in ("\ufe00", "\u206a", "\ufff9", "\U000e0041", "\u00ad", "\u180b", "\u115f"):
        assert confusables.normal_form(f"a wo{gone}rd", shapes) == "a word", gone
    assert confusables.normal_form("Гамма и Пи", shapes) == confusables.normal_form("\u0393амма и \u03a0и", shapes)
    for text in ("\U0001f3f4\U000e0067\U000e0062\U000e0065\U000e006e\U000e0067\U000e007f", "α a ρ p", "день з 3", "שלום", "日本語のテキスト", "ဝဏ္ဏ မြန်မာ"):
        assert confusables.normal_form(text, shapes) == text, text
    assert len(shapes.shape) > 300 and len({x for v in shapes.spelled.values() for x in v}) > 20
    for a, b in (("x²", "x2"), ("α", "a"), ("\U0001d400", "A"), ("ı", "i"), ("rn", "m"), ("0", "O"), ("1", "l")):
        assert confusables.normal_form(a, shapes) != confusables.normal_form(b, shapes)


@given(st.text(alphabet="abcеорсху ABΑΒ\u13df\u2c9f\u101d\u0578ГΓПкκвé", max_size=30))
@settings(max_examples=200, deadline=None)
def test_form_with_all_shapes_is_stable(spark, text):
    shapes = confusables.unicode_shapes(spark)
    form = confusables.normal_form(text, shapes)
    assert confusables.normal_form(form, shapes) == form


def test_many_copies_and_one_variant(spark):
    """The work follows the result, not the square of the copies."""
    import time

    text = "the same words over and over"
    df = spark.range(40_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") == 7, text.replace("o", "о")).otherwise(text).alias("text"))
    confusables.same_look_pairs(df.limit(10)).count()
    began = time.time()
    assert confusables.same_look_pairs(df).where("doc_id_a = 7 or doc_id_b = 7").count() == 39_999
    assert time.time() - began < 30


def test_same_look_pairs(spark):
    rows = [(1, "good day"), (2, "gооd day"), (3, "good day"), (4, None), (5, "​"), (6, ""), (7, "good  day"), (2, "gооd day"), (8, "x" * 200_000 + " y"), (9, "x" * 200_000 + " y")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("look", F.lit(1)).withColumn("stored", F.lit(2))
    assert sorted(map(tuple, confusables.same_look_pairs(df).collect())) == [(1, 2), (2, 3), (8, 9)]
    assert confusables.same_look_pairs(df.limit(0)).count() == 0
    forms = confusables.with_normal_form(df.withColumn("form", F.lit("old")))
    assert forms.where("doc_id = 2").first()["form"] == "good day" and forms.columns.count("form") == 1


# --- scans


def page(spark, rows):
    return spark.createDataFrame(rows, "page_id long, source_file string, page_number int, text string").withColumn("noise", F.lit("old")).withColumn("line", F.lit(0))


PROSE = "The harbour clerk reads the weather report and writes the tide table for the morning boats near the lantern\n"


def test_noise_of_a_small_file(spark):
    body = PROSE * 12
    rows = [
        (1, "a", 1, "Chapter 1: Quiet Harbours\n" + body + "the weather re-"),
        (2, "a", 2, "Notes on Tides\nport is well-\nknown to the well-known clerk. The cl€rk writes thc report\n" + body + "- 12 -"),
        (3, "a", 3, "Notes on Tides\n" + body + "the well-known clerk\nMarks available:\n40\n- 13 -"),
        (4, "a", 4, "NOTES ON TIDES   14\r\n" + body.replace("\n", "\r\n")),
        (5, "b", 1, None),
        (6, "b", 2, " \n "),
        (3, "a", 3, "Notes on Tides\n" + body + "the well-known clerk\nMarks available:\n40\n- 13 -"),
    ]
    noise = scans.find_noise(page(spark, rows))
    got = sorted(map(tuple, scans.noise_lines(noise).collect()))
    assert got == [(1, 14, "hyphenation"), (2, 1, "header"), (2, 3, "misread"), (2, 16, "page_number"), (3, 1, "header"), (3, 17, "page_number"), (4, 1, "header")]
    clean = {r["page_id"]: r["text"] for r in scans.repaired_pages(noise).collect()}
    assert clean[1].endswith("the weather report") and clean[5] is None and clean[6] == ""
    assert "well-known to the well-known clerk. The clerk writes the report" in clean[2] and "Notes on Tides" not in clean[2]


def test_no_pages(spark):
    assert scans.noise_lines(scans.find_noise(page(spark, []))).count() == 0


def test_few_words_and_one_long_page(spark):
    rows = [(1, "a", 1, " ".join(f"word{chr(97 + i)}" for i in range(20)) + " one-\nhalf"), (2, "b", 1, "x" * 50_000 + "\n" + "7\n" * 3), (3, None, None, "Some Title\nbody text"), (4, "b", 2, PROSE * 3000)]
    got = {(r["page_id"], r["noise"]) for r in scans.noise_lines(scans.find_noise(page(spark, rows[:3]))).collect()}
    assert got <= {(1, "hyphenation")}
    scans.repaired_pages(scans.find_noise(page(spark, rows))).collect()


def test_vectors_are_sums_whatever_the_size(spark):
    """The table twice has twice the sums, in any number of tasks; no bound on words leaves any out."""
    rows = [(i, "a", i, PROSE * 2 + f"the clerk of quay number {i} writes\n" + "one" * (i % 2)) for i in range(40)]
    pages = page(spark, rows).withColumn("skip", F.lit(None).cast("array<int>"))
    again = pages.unionByName(pages.withColumn("page_id", F.col("page_id") + 1000))
    asked = spark.createDataFrame([("clerk",), ("writes",), ("never",), ("one",)], "word string")
    get = lambda df: {r["word"]: np.array(r["v"]) for r in scans.vectors(df, asked, {"the": 2}).collect()}
    once, twice = get(pages.repartition(1)), get(again.repartition(7))
    assert set(once) == set(twice) == {"clerk", "writes", "one"} and all((2 * once[w] == twice[w]).all() for w in once)
    signs, want = scans.Signs({"the": 2}), {w: 0 for w in once}
    for *_, text in rows:
        words = [w.text for w in scans.body(text, set()).words]
        for i, w in enumerate(words):
            if w in want:
                around = signs(words[max(0, i - scans.CONTEXT) : i] + words[i + 1 : i + 1 + scans.CONTEXT])
                want[w] = want[w] + signs.table[around].sum(axis=0, dtype=int)
    known = signs(["the", "clerk"])
    assert all((once[w] == want[w]).all() for w in want) and np.abs(signs.table[known]).max(axis=1).tolist() == [2, scans.WEIGHT]


def test_context_decides_at_every_size(spark, monkeypatch):
    """A rare word in contexts of its own stays, one in those of the word it looks like doesn't, both with vectors; a bound on the words with vectors would tell
    a large table from a small one."""
    monkeypatch.setattr(scans, "MOST_VECTORS", 1, raising=False)
    often = "they eat warm bread with butter before the long walk home"
    pages = ["\n".join([often] * 25 + ["some grey old cat slept behind our kitchen stove", often.replace("bread", "brcad")]) for _ in range(8)]
    rows = [(1000 * k + i, f"f{k}", i, text) for k in range(2) for i, text in enumerate(pages)]
    found = {(r["page_id"] % 1000, r["line"], r["word"], r["to"]) for r in scans.find_noise(page(spark, rows)).misread.collect()}
    assert found == {(i, 27, "brcad", "bread") for i in range(8)}


def test_roman():
    assert [scans.roman(x) for x in ("iv", "ix", "xii", "iiii", "vx")] == [4, 9, 12, 0, 0]


@needs_data
def test_repair_of_the_samples(spark):
    """Held-out: the words of the given clean texts come back; heads of single pages, which have no file around, stay."""
    samples = spark.read.parquet(f"{DATA}/page_samples.parquet")
    pages = spark.read.parquet(f"{DATA}/extracted_pages.parquet").select("page_id", "source_file", "page_number", "text")
    own = samples.select((F.col("sample_id") + 10**9).cast("long").alias("page_id"), F.concat(F.lit("s"), "sample_id").alias("source_file"), F.lit(1).alias("page_number"), F.col("raw_text").alias("text"))
    got = {r["page_id"] - 10**9: r["text"] for r in scans.repaired_pages(scans.find_noise(pages.unionByName(own))).where("page_id >= 1000000000").collect()}
    right = total = 0
    for r in samples.collect():
        want, have = r["clean_text"].split(), got[r["sample_id"]].split()
        from difflib import SequenceMatcher

        right += sum(b.size for b in SequenceMatcher(None, want, have, autojunk=False).get_matching_blocks())
        total += len(want)
    assert right / total > 0.995


# --- broken pairs

NAMES = "Ada Ben Cleo Dan Eve Finn Gus Hana Ivo June".split()
THINGS = "lantern harbour letter mirror garden engine ladder window river clock".split()
VERBS = "shows hides explains carries follows answers repeats holds breaks keeps".split()


def made(n, seed):
    rng = np.random.default_rng(seed)
    pick = lambda x: x[int(rng.integers(len(x)))]
    out = []
    for _ in range(n):
        q = f"Why does {pick(NAMES)} think that the {pick(THINGS)} {pick(VERBS)} the {pick(THINGS)} in scene {int(rng.integers(1, 40))}? I read the part about the {pick(THINGS)} and I am not sure what it means."
        a = " ".join(f"In line {int(rng.integers(1, 99))} the {pick(THINGS)} {pick(VERBS)} what {pick(NAMES)} fears, so look at the {pick(THINGS)} again." for _ in range(int(rng.integers(2, 5)))) + f" How would {pick(NAMES)} see the {pick(THINGS)}?"
        out.append((q, a))
    return out


GERMAN = "Lies die Strophe noch einmal und überlege, wie der Autor über die Angst spricht. Was ist für dich dabei wichtig, und warum?"


def test_held_out_accuracy():
    sound = made(400, 1)
    german = [(GERMAN.replace("Strophe", x), f"In der {x} sieht man, wie der Autor die {y} zeigt. Das ist für den Leser nicht neu, aber es wird hier noch einmal gesagt.") for x in ("Szene", "Zeile", "Stelle", "Seite") for y in ("Angst", "Schuld", "Liebe", "Macht")]
    model = pairs.train(sound + german)
    rng = np.random.default_rng(5)
    fresh = made(120, 2)
    cases = {
        None: fresh,
        "truncated": [(q, t) for q, a in fresh if (t := pairs.truncated(a, rng))],
        "refusal": [(q, pairs.refusal(rng)) for q, _ in fresh],
        "copies_question": [(q, pairs.copied(q, rng)) for q, _ in fresh],
        "other_language": [(q, a.replace("Autor", "Dichter")) for (q, _), (_, a) in zip(fresh, german)],
        "empty": [(q, x) for q, _ in fresh[:3] for x in ("", "...", "- -")],
    }
    for label, items in cases.items():
        found = model.defects([q for q, _ in items], [a for _, a in items])
        assert np.mean([x == label for x in found]) > 0.9, (label, found[:10])


#: Defects made by other means than those of the fit: refusals in words that its grammar doesn't put together, answers cut at a fixed place,
#: questions given back in a frame that the fit doesn't use, answers in languages that no list has.
OTHER_REFUSALS = [
    "Answering would break the terms I operate under.", "I am going to pass.", "Let me stop you there, I cannot do that.", "You will have to find this elsewhere, I can't take it on.", "I won't.",
    "Helping here is not something I am able to do.", "Sorry, no.", "I'm not comfortable answering.", "That is not a conversation I can have.", "It is my policy not to respond to requests like this one.", "I have to refuse.",
    "There are things I cannot write, and this is one of them.", "Unfortunately this falls outside of what I may help with.", "Being an AI, I can't form a view on this.", "I do not answer such questions.", "I am unable to comply with your request.",
]
OTHER_LANGUAGES = [
    "Dans ce chapitre, la lanterne cache ce que Ada ne veut pas dire, et le lecteur le comprend avant elle. Relis la page pour voir comment.",
    "En esta parte el espejo oculta lo que Ben no quiere decir, y el lector lo entiende antes que él. Lee otra vez la página para ver cómo.",
    "W tej scenie bohater jeszcze nie wie, że list został zgubiony, dlatego warto przeczytać ten fragment ponownie i poszukać powodu.",
]


def test_defects_made_by_other_means():
    sound = made(600, 1)
    german = [(GERMAN.replace("Strophe", x), f"In der {x} sieht man, wie der Autor die {y} zeigt. Das ist für den Leser nicht neu, aber es wird hier noch einmal gesagt.") for x in ("Szene", "Zeile", "Stelle", "Seite") for y in ("Angst", "Schuld", "Liebe", "Macht")]
    real = [(q, OTHER_REFUSALS[i % 4]) for i, (q, _) in enumerate(made(24, 3))]  # the table has refusals of its own, of four of the forms
    model = pairs.train(sound + german + real)
    fresh = made(160, 2)
    cases = {
        "truncated": [(q, a[: int(len(a) * x)].rstrip(" .,?")) for x in (0.4, 0.55, 0.7) for q, a in fresh],
        "refusal": [(q, OTHER_REFUSALS[4 + i % 12]) for i, (q, _) in enumerate(fresh)],
        "copies_question": [(q, f"So what you would like to find out is this: {q}") for q, _ in fresh],
        "other_language": [(q, OTHER_LANGUAGES[i % 3]) for i, (q, _) in enumerate(fresh)],
    }
    recall = {}
    for label, items in cases.items():
        found = model.defects([q for q, _ in items], [a for _, a in items])
        recall[label] = float(np.mean([x == label for x in found]))
    print(recall)
    assert np.mean([x is None for x in model.defects(*map(list, zip(*fresh)))]) > 0.97
    assert recall["truncated"] > 0.9 and recall["copies_question"] > 0.9 and recall["other_language"] > 0.6 and recall["refusal"] > 0.5, recall


def test_counts_leave_out_the_own_answer():
    counts = pairs.Counts.of(["alpha beta gamma.", "alpha delta."])
    rest = pairs._Others(counts, pairs._tokens(["alpha beta gamma.", "alpha delta."]))
    slot = pairs._slot(np.array([pairs.zlib.crc32(w.encode()) for w in ("alpha", "beta")], dtype=np.uint64), 11)
    assert rest.words(np.array([0, 0]), slot).tolist() == [1, 0] and rest.words(np.array([1, 1]), slot).tolist() == [1, 1] and counts.answers == 2


def test_counts_of_grams_and_endings_are_of_all_pairs(spark):
    """Not of the sample: n-grams of questions and answers and the endings, whatever the number of tasks, and each with its own meaning of often."""
    every = made(300, 1) + [("Why?", f"{x} he went on to the end of the road") for x in THINGS[:4]] + [("Wozu?", "..."), ("Wozu?", "Weil der Weg")]
    df = spark.createDataFrame([(i, 0, *p) for i, p in enumerate(every)], "ex_id long, pos int, question string, answer string").repartition(5)
    sample = [every[300], every[-1]]
    got, want = pairs.corpus_counts(df, sample), pairs.Counts.of([a for _, a in every if a != "..."], [q for q, a in every if a != "..."])
    assert got.gram_counts.sum() > 0 and np.array_equal(got.gram_counts, want.gram_counts) and np.array_equal(got.words, want.words) and got.answers == want.answers == 305
    assert got.endings == {("of", "the", "road"): 4, ("weil", "der", "weg"): 1} and want.endings == got.endings
    assert got.shared(sample[0][1]) and not got.shared(sample[1][1]) and not got.shared("It ends here.")
    got.answers = 1e6
    assert not got.shared(sample[0][1])
    assert np.array_equal(got.weigh_grams().grams, want.weigh_grams().grams)


def test_answers_without_reasoning():
    assert pairs.answer_of("<THINK>a</think> b <think>c") == "b" and pairs.answer_of(None) == ""
    assert pairs.is_empty("​ … -") and not pairs.is_empty("é")


def test_broken_pairs_of_odd_rows(spark):
    rows = [(1, 0, "system", "x"), (1, 1, "Human ", "q"), (1, 2, "GPT", "..."), (2, 0, "user", "q"), (3, 0, "user", None), (3, 1, "bot", "fine"), (4, 5, "user", "q"), (4, 7, "assistant", "late"), (1, 1, "Human ", "q"), (5, 0, "tool", "x"), (6, 0, "user", "q" * 100_000), (6, 1, "assistant", None)]
    df = spark.createDataFrame(rows, "ex_id long, pos int, role string, content string").withColumn("side", F.lit(9)).withColumn("defect", F.lit("old"))
    assert sorted(map(tuple, pairs.broken_pairs(df).collect())) == [(1, 1, "empty"), (2, 0, "empty"), (4, 5, "empty"), (6, 0, "empty")]
    assert pairs.broken_pairs(df.limit(0)).count() == 0


@needs_data
def test_broken_pairs_of_the_tables(spark):
    """Every defect is found, and about as often as each other, as the table was made; sound pairs are the large majority."""
    got = pairs.broken_pairs(spark.read.parquet(f"{DATA}/messages.parquet")).toPandas()
    counts = got["defect"].value_counts()
    assert set(counts.index) == {"empty", *pairs.LABELS} and counts.min() > 10 and len(got) < 300
    assert not got.duplicated(["ex_id", "pos"]).any()


