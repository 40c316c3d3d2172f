"""Broken prompt and response pairs.

A multi-label linear classifier on hashed n-grams and pair features. It is trained here, on responses made from the corpus'
own: cut off, copied from the question, swapped with responses in another language, and replaced by refusals of a small
grammar; the stored pairs serve as sound ones. Two rounds: each half of the sample is cleaned by the model of the other, and what
it finds broken leaves the sound ones for the last fit. The threshold of each label is calibrated on pairs held out, weighted to
``PRIOR``.

* ``empty`` is what it is defined as: no answer message, or no letter or digit in the answer.
* Hashed n-grams, for all labels: words and word pairs of the whole answer; the last one to three words with the kind of its end. An
  answer that is swapped in stands as often beside its own question, so that its words alone tell nothing.
* Pair features: lengths, overlap of words and word pairs with the question in both directions, what the answer has that the
  question hasn't, how rare the words are that both have, the end of the answer, open quotations, brackets and lists, words, word pairs and
  endings that other answers don't have. For the language: votes of function words and scripts, and how well either
  side fits a model of character n-grams, which needs no list of languages.
* How often words, word pairs and endings occur is counted over all answers of the table, into tables of a fixed size; an answer's own
  occurrences are taken off before it is scored. Character n-grams are counted over all questions and answers, and the endings that the
  sample's answers have over all answers. Rare and shared mean a share of the answers, so they mean the same at every size.

Reasoning (``<think>`` to ``</think>``, any case, or to the end) is no part of an answer. Only the fit, weights and thresholds, is made on a
sample: ``SAMPLE_PAIRS`` pairs, drawn by the hash of the example; every pair of the table is scored, on its whole text.

Defined results: a question that is null counts as empty text; a null answer is ``empty``; a user message that no assistant
message follows at the next position is ``empty``; rows delivered again count once; roles in any spelling; other roles, rows without
a key and extra columns are left out; an empty table gives no rows; with too few pairs to learn from, only ``empty`` is reported.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sievework.llm.common import role_of
from sievework.runtime import Table, written

LABELS = ("truncated", "refusal", "copies_question", "other_language")
EMPTY = "empty"
#: Pairs to fit on, at the most (the bound of the labelled sample); fewest pairs to fit on.
SAMPLE_PAIRS, LEAST_PAIRS = 3000, 40
#: Share of pairs that each label is calibrated for.
PRIOR = 0.02
#: Prior of the first round, whose threshold only cleans the stored pairs.
CLEANING_PRIOR = 0.3
#: Share of the stored pairs that may be broken in the calibration.
DOUBTFUL = 0.0015
#: Responses that share their last three words, for the ending to be taken as complete: at least so many, and so large a share of all.
SHARED_ENDINGS, SHARED_RATE = 2, 2.5e-4
#: Rounds of cleaning, all but the first for refusals alone; logits over the threshold from which a pair counts as found; what the refusals found weigh together, against those
#: made, and each at the most.
CLEANINGS, SURE, REAL_SHARE, MOST_BOOST = 5, 0.25, 1.0, 60.0
HASH_BITS = 18
COUNT_BITS = 20
DIM = 1 << HASH_BITS
#: Rounds of the last fit and of the two that clean; step; rows of the sample that a hashed feature must occur in.
EPOCHS, CLEANING_EPOCHS, RATE, LEAST_ROWS = 60, 20, 0.08, 2
#: Decay of the weights of n-grams. The last two labels compare the two sides; words alone would teach them which languages are rare.
DECAY = {"truncated": 2e-4, "refusal": 5e-5, "copies_question": 0.3, "other_language": 1.0}
#: Occurrences for each answer of the table below which a word, or a word pair, is rare; once at least.
RARE_WORD, RARE_PAIR = 2e-5, 1e-4
#: Where the threshold is between the highest sound pair and the lowest broken one.
NEAR = 0.3
#: Rows of the fit whose languages are not voted on.
UNLISTED = 0.3
#: Slots of the character n-grams.
GRAMS = 1 << 13

THINK = re.compile(r"<think>.*?(?:</think>|\Z)", re.I | re.S)
_WORD = re.compile(r"[぀-ヿ㐀-鿿가-힣]|[^\W_぀-ヿ㐀-鿿가-힣]+(?:['’][^\W_]+)?")
_ALNUM = re.compile(r"[^\W_]")

#: Frequent short words by language; a word that several languages have counts for each in part. Fixed values.
FUNCTION_WORDS = {
    "en": "the of and to a in is that it for on with as by at how what which this be are was an or from not but have you your can should would if when why does do my they i so than then",
    "fr": "le la les de des du et un une est que qui dans pour sur au aux ce cette il elle avec pas plus par se son sa ses nous vous je mon ne comment pourquoi quand chez derrière vers selon",
    "de": "der die das und ist ein eine einen einem einer zu den dem des im mit auf für von nicht es er sie ich wie was warum wenn auch sich bei nach über als aus dass hinter noch wird oder wir man",
    "es": "el la los las de del y un una es que en por para con se su sus lo al como más pero no qué cómo cuando hacia este esta esto vuelve donde detrás ante muy otra vez queda desde sobre",
    "it": "il lo la i gli le di del della dello dei delle e un una è che in per con si suo sua come più ma non perché quando verso questo questa dietro al alla nel nella da sul sulla devi cui",
    "pt": "o os as de do da dos das e um uma é que em no na nos nas por para com se seu sua como mais mas não quando este esta ao à pelo pela você",
    "nl": "de het een en van is in dat op te voor met niet zijn aan er die door als maar ook bij naar uit hoe wat waarom wanneer deze dit wordt",
}
_SCRIPTS = (("GREEK", "el"), ("CYRILLIC", "ru"), ("HIRAGANA", "ja"), ("KATAKANA", "ja"), ("CJK", "zh"), ("HANGUL", "ko"), ("ARABIC", "ar"), ("HEBREW", "he"), ("DEVANAGARI", "hi"))
LANGUAGES = (*FUNCTION_WORDS, "el", "ru", "ja", "zh", "ko", "ar", "he", "hi")


def _votes() -> dict[str, np.ndarray]:
    by: dict[str, list[int]] = {}
    for n, words in enumerate(FUNCTION_WORDS.values()):
        for w in words.split():
            by.setdefault(w, []).append(n)
    out = {}
    for w, langs in by.items():
        v = np.zeros(len(LANGUAGES), dtype=np.float32)
        v[langs] = 1 / len(langs) ** 2
        out[w] = v
    return out


VOTES = _votes()
_NO_VOTE = np.zeros(len(LANGUAGES), dtype=np.float32)


def _vote(word: str) -> np.ndarray:
    if (v := VOTES.get(word)) is not None:
        return v
    if word[0] < "Ͱ":
        return _NO_VOTE
    import unicodedata

    name = unicodedata.name(word[0], "")
    for script, lang in _SCRIPTS:
        if name.startswith(script):
            v = np.zeros(len(LANGUAGES), dtype=np.float32)
            v[LANGUAGES.index(lang)] = 0.34
            if lang == "zh":  # Japanese has kana between them
                v[LANGUAGES.index("zh")], v[LANGUAGES.index("ja")] = 0.2, 0.14
            return v
    return _NO_VOTE


class Words:
    """Number, hash and language votes of each word met; emptied at a fixed size."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[str, int] = {}
        self._hashes: list[int] = []
        self._votes: list[np.ndarray] = []
        self._grams: list[np.ndarray] = []

    def __call__(self, words: list[str]) -> list[int]:
        out = list(map(self.numbers.get, words))
        if None in out:
            for w in words:
                if w not in self.numbers:
                    self.numbers[w] = len(self._hashes)
                    self._hashes.append(zlib.crc32(w.encode("utf-8", "surrogatepass")))
                    self._votes.append(_vote(w))
                    self._grams.append(_grams(w))
            out = list(map(self.numbers.get, words))
        return out

    def hashes(self) -> np.ndarray:
        return np.array(self._hashes, dtype=np.uint64)

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        return np.array(self._hashes, dtype=np.uint64), np.array(self._votes, dtype=np.float32).reshape(-1, len(LANGUAGES))


def _grams(word: str) -> np.ndarray:
    """Slots of the character n-grams of a word, its edges included."""
    w = f"\x02{word}\x03"
    return np.array([zlib.crc32(w[i : i + n].encode("utf-8", "surrogatepass")) & (GRAMS - 1) for n in (2, 3) for i in range(len(w) - n + 1)], dtype=np.int64)


_WORDS = Words()


def answer_of(content: str | None) -> str:
    """The answer without reasoning and outer white space."""
    if content is None:
        return ""
    return (THINK.sub("", content) if "<" in content else content).strip()


def is_empty(answer: str) -> bool:
    return _ALNUM.search(answer) is None


_END_KINDS = ("stop", "closed", "ellipsis", "comma", "colon", "dash", "word", "open", "other")


def _end_kind(answer: str) -> int:
    last = answer[-1]
    if last in ".!?。！？":
        return 2 if answer.endswith("..") else 0
    if last in "\"'”’»」』)]}）*`":
        return 1
    if last == "…":
        return 2
    if last in ",;，、；":
        return 3
    if last in ":：":
        return 4
    if last in "-–—/":
        return 5
    if last.isalnum():
        return 6
    return 7 if last in "([{“‘«„「『（<" else 8


_ITEM = re.compile(r"\s*(?:[-*•·+]|\(?\d{1,2}[.)]|\(?[a-z][.)])(?:\s+|$)")
DENSE = 61


def _shape(answer: str, out: np.ndarray) -> int:
    """The features of the form of an answer, into ``out``; the kind of its end."""
    end = _end_kind(answer)
    out[end] = 1
    cut = answer.rfind("\n") + 1
    last = answer[cut:]
    item = _ITEM.match(last) is not None
    out[9] = item
    out[10] = item and len(last.split()) <= 1
    out[11] = item and end == 6
    out[12] = not item and end == 6
    straight = answer.count('"')
    out[13] = straight % 2
    out[14] = answer.count("“") != answer.count("”") or answer.count("«") != answer.count("»") or answer.count("「") != answer.count("」")
    out[15] = answer.count("(") != answer.count(")")
    out[16] = answer.count("**") % 2 or answer.count("`") % 2
    out[17] = answer.endswith(("Answer:", "answer:"))
    return end


@dataclass
class Features:
    """Hashed features of each pair (flat, with the first of each pair) and its dense ones."""

    index: np.ndarray
    starts: np.ndarray
    scale: np.ndarray
    dense: np.ndarray


def _mix(a: np.ndarray, salt: int) -> np.ndarray:
    x = (a + np.uint64(salt * 0x9E3779B9)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def featurize(questions: list[str], answers: list[str], counts_of: Counts, owns: list[str] | None = None) -> Features:
    """Features of pairs whose answers aren't empty, all pairs of a batch at once. ``owns``: the stored answer of each pair, which the
    counts have; by default the answer itself."""
    n = len(answers)
    dense = np.zeros((n, DENSE), dtype=np.float32)
    if len(_WORDS.numbers) > 400_000:
        _WORDS.clear()
    q_words, ends = [], np.zeros(n, dtype=np.uint64)
    for i in range(n):
        ends[i] = _shape(answers[i], dense[i])
        q_words.append(_WORDS(_WORD.findall(questions[i].lower())) or _WORDS(["~~"]))
    tokens = _tokens(answers)
    a_flat, al = tokens[:2]
    ql, q_flat = np.array([len(x) for x in q_words]), np.concatenate(q_words)
    hashes, votes = _WORDS.tables()
    a_starts, q_starts = np.r_[0, np.cumsum(al)[:-1]], np.r_[0, np.cumsum(ql)[:-1]]
    a_row, q_row = np.repeat(np.arange(n), al), np.repeat(np.arange(n), ql)
    size = np.int64(len(hashes))
    # words and word pairs of one side in the other
    a_key, q_key = a_row * size + a_flat, q_row * size + q_flat
    in_q = _isin(a_key, q_key)
    in_a = _isin(q_key, a_key)
    a_h, q_h = hashes[a_flat], hashes[q_flat]
    a2, q2 = _mix(a_h[:-1] * np.uint64(31) + a_h[1:], 7), _mix(q_h[:-1] * np.uint64(31) + q_h[1:], 7)
    a2_ok, q2_ok = a_row[:-1] == a_row[1:], q_row[:-1] == q_row[1:]
    low = np.uint64((1 << 40) - 1)
    a2_key = (a2[a2_ok] & low) ^ (a_row[:-1][a2_ok].astype(np.uint64) << np.uint64(40))
    q2_key = (q2[q2_ok] & low) ^ (q_row[:-1][q2_ok].astype(np.uint64) << np.uint64(40))
    pair_in_q = np.bincount(a_row[:-1][a2_ok], weights=_isin(a2_key, q2_key), minlength=n)
    pairs = np.maximum(1, np.bincount(a_row[:-1][a2_ok], minlength=n))
    in_question = np.add.reduceat(in_q.astype(np.float32), a_starts)
    novel = al - in_question
    dense[:, 18] = pair_in_q / pairs
    dense[:, 19] = in_question / al
    dense[:, 20] = np.add.reduceat(in_a.astype(np.float32), q_starts) / ql
    dense[:, 21] = np.log1p(novel)
    dense[:, 22] = np.log1p(al)
    dense[:, 23] = np.log1p(ql)
    dense[:, 24] = dense[:, 18] > 0.6
    dense[:, 25] = (dense[:, 19] > 0.75) & (novel <= 8) & (dense[:, 20] > 0.4)
    dense[:, 26] = (novel <= 3) & (dense[:, 20] > 0.5)
    for k, most in enumerate((2, 5, 12, 25, 45)):
        dense[:, 27 + k] = al <= most
    # languages
    av, qv = np.add.reduceat(votes[a_flat], a_starts, axis=0), np.add.reduceat(votes[q_flat], q_starts, axis=0)
    at, qt = av.sum(1), qv.sum(1)
    main = qv.argmax(1)
    own = av[np.arange(n), main]
    best = av.max(1)
    sure = (at > 0.9) & (qt > 0.9)
    cosine = (av * qv).sum(1) / np.maximum(1e-6, np.sqrt((av**2).sum(1) * (qv**2).sum(1)))
    dense[:, 32] = sure * (1 - own / np.maximum(at, 1e-6))
    dense[:, 33] = sure * (av.argmax(1) != main)
    dense[:, 34] = sure * (1 - cosine)
    dense[:, 35] = sure * (av.argmax(1) != main) * (best > 1.5 * own)
    dense[:, 36] = sure * (av.argmax(1) != main) * (best > 4 * own + 0.5)
    dense[:, 37] = ~sure
    # what other answers don't have, and whether they end like this
    last = a_starts + al - 1
    h1 = a_h[last]
    h2 = np.where(al > 1, a_h[np.maximum(last - 1, 0)], np.uint64(0))
    h3 = np.where(al > 2, a_h[np.maximum(last - 2, 0)], np.uint64(0))
    last2 = _mix(h2 * np.uint64(31) + h1, 7)
    rest = _Others(counts_of, tokens if owns is None else _tokens(owns))
    word_n, pair_n = rest.words(a_row, _slot(a_h, 11)), rest.pairs(a_row[:-1][a2_ok], _slot(a2[a2_ok], 12))
    one = np.arange(n)
    ends1, ends2 = rest.ends(one, _slot(h1, 13)), rest.ends(one, _slot(last2, 14))
    least_word, least_pair = max(0.5, RARE_WORD * counts_of.answers), max(0.5, RARE_PAIR * counts_of.answers)
    unseen_word, unseen_pair = word_n < least_word, pair_n < least_pair
    end1 = ends1 / (word_n[last] + 1.0)
    end2 = (ends2 + 0.1) / (rest.pairs(one, _slot(last2, 12)) + 1.0)
    open_end = dense[:, 12] + dense[:, 11]
    dense[:, 38] = np.bincount(a_row[:-1][a2_ok], weights=unseen_pair, minlength=n) / pairs
    dense[:, 39] = np.add.reduceat(unseen_word.astype(np.float32), a_starts) / al
    dense[:, 40] = unseen_word[last] * dense[:, 12]
    dense[:, 41] = unseen_word[last] * dense[:, 11]
    dense[:, 42] = (dense[:, 38] > 0.6) & (al <= 60) & (al > 3)
    dense[:, 43] = dense[:, 12] * (1 - unseen_word[last])
    dense[:, 44] = (al > 60) & (novel > 40)
    dense[:, 45] = 1
    dense[:, 46] = open_end * np.minimum(end1, 1)
    dense[:, 47] = open_end * np.minimum(end2, 1)
    dense[:, 48] = open_end * (ends2 >= least_pair)
    dense[:, 49] = open_end * (end1 < 0.02)
    dense[:, 50] = open_end * (ends1 >= least_word)
    dense[:, 51] = (dense[:, 38] > 0.3) & (al <= 60) & (dense[:, 19] < 0.5) & (al > 3)
    # how rare the words are that both sides have
    weigh = lambda h: np.minimum(-np.log((counts_of.words[_slot(h, 11)] + 1.0) / (counts_of.answers + 1.0)), 9.0).clip(0.05)
    a_weight, q_weight = weigh(a_h), weigh(q_h)
    dense[:, 52] = np.add.reduceat(in_a * q_weight, q_starts) / np.add.reduceat(q_weight, q_starts)
    dense[:, 53] = np.add.reduceat(in_q * a_weight, a_starts) / np.add.reduceat(a_weight, a_starts)
    # how well the sides fit the language that most texts are in
    used, at = np.unique(np.concatenate([a_flat, q_flat]), return_inverse=True)
    grams = [_WORDS._grams[i] for i in used]
    sizes = np.array([len(g) for g in grams])
    fit = np.add.reduceat(counts_of.grams[np.concatenate(grams)], np.r_[0, np.cumsum(sizes)[:-1]])
    af = np.add.reduceat(fit[at[: len(a_flat)]], a_starts) / np.add.reduceat(sizes[at[: len(a_flat)]], a_starts)
    qf = np.add.reduceat(fit[at[len(a_flat) :]], q_starts) / np.add.reduceat(sizes[at[len(a_flat) :]], q_starts)
    enough = (al >= 5) & (ql >= 4)
    dense[:, 54] = np.clip(af, -6, 6) / 3
    dense[:, 55] = np.clip(qf, -6, 6) / 3
    for k, least in enumerate((0.4, 0.7, 1.0)):
        dense[:, 56 + k] = enough * (np.abs(af - qf) > least)
    dense[:, 59] = enough * np.clip(np.abs(af - qf), 0, 3)
    dense[:, 60] = ~enough
    # hashed: words, word pairs, and the last one to three words with the kind of the end
    top = np.uint64(DIM - 1)
    w1 = _mix(a_h, 1) & top
    w2 = _mix(a2, 2) & top
    kind = ends * np.uint64(2) + dense[:, 9].astype(np.uint64)
    t1 = _mix(h1 * np.uint64(64) + kind, 3) & top
    t2 = _mix(_mix(h2 * np.uint64(31) + h1, 5) * np.uint64(64) + kind, 4) & top
    t3 = _mix(_mix((h3 * np.uint64(31) + h2) * np.uint64(31) + h1, 6) * np.uint64(64) + kind, 5) & top
    index = np.concatenate([w1, w2[a2_ok], t1, t2, t3]).astype(np.int64)
    row = np.concatenate([a_row, a_row[:-1][a2_ok], np.arange(n), np.arange(n), np.arange(n)])
    weight = np.concatenate([(1 / np.sqrt(al)).astype(np.float32)[a_row], (1 / np.sqrt(al)).astype(np.float32)[a_row[:-1][a2_ok]], np.ones(3 * n, dtype=np.float32)])
    order = np.argsort(row, kind="stable")
    counts = np.bincount(row, minlength=n)
    return Features(index[order].astype(np.int32), np.r_[0, np.cumsum(counts)[:-1]], weight[order], dense)


def _slot(h: np.ndarray, salt: int) -> np.ndarray:
    return (_mix(h, salt) & np.uint64((1 << COUNT_BITS) - 1)).astype(np.int64)


@dataclass
class Counts:
    """Hashed counts over all answers: words, word pairs, and the words and pairs that end a sentence or an item; the number of
    answers; the character n-grams of all questions and answers; and how often each ending of the sample's answers occurs."""

    words: np.ndarray
    pairs: np.ndarray
    ends: np.ndarray
    answers: float
    gram_counts: np.ndarray
    grams: np.ndarray
    endings: Counter = field(default_factory=Counter)

    @classmethod
    def of(cls, answers: list[str], questions: list[str] | None = None) -> Counts:
        """Of pairs at hand."""
        out = cls(*(np.zeros(1 << COUNT_BITS, dtype=np.float32) for _ in range(3)), 0.0, np.zeros(GRAMS), np.zeros(GRAMS, dtype=np.float32))
        return out.add(answers, questions or [], None)

    def add(self, answers: list[str], questions: list[str], among: frozenset | None) -> Counts:
        """``among``: the endings to count; all if None."""
        if len(_WORDS.numbers) > 400_000:
            _WORDS.clear()
        tokens = _tokens(answers)
        for table, slots in zip((self.words, self.pairs, self.ends), (x[1] for x in _occurrences(tokens))):
            table += np.bincount(slots, minlength=len(table)).astype(table.dtype)
        asked = _WORDS([w for t in questions for w in _WORD.findall(t.lower())])
        times = np.bincount(np.r_[tokens[0], np.array(asked, dtype=np.int64)], minlength=1)
        if len(used := np.flatnonzero(times)):
            grams = [_WORDS._grams[i] for i in used]
            self.gram_counts += np.bincount(np.concatenate(grams), weights=np.repeat(times[used], [len(g) for g in grams]), minlength=GRAMS)
        self.endings.update(e for a in answers if (e := _ending(a)) is not None and (among is None or e in among))
        self.answers += len(answers)
        return self

    def shared(self, answer: str) -> bool:
        """Whether an answer ends in words that so many answers end in that the ending is a complete one."""
        return (e := _ending(answer)) is not None and self.endings[e] >= max(SHARED_ENDINGS, SHARED_RATE * self.answers)

    def weigh_grams(self) -> Counts:
        """How much likelier n-grams are than in an even mixture of all slots, as logarithms, centred on what a text has in the mean."""
        z = self.gram_counts
        p = np.log((z + 0.5) / (z.sum() + 0.5 * GRAMS) * GRAMS)
        self.grams = (p - (p * z).sum() / max(1.0, z.sum())).astype(np.float32)
        return self


Tokens = tuple[np.ndarray, np.ndarray, np.ndarray]


def _tokens(answers: list[str]) -> Tokens:
    """Numbers of the words of all answers, how many each has (one at least), and the places of those that end a sentence or an item."""
    numbers, sizes, ends = [], [], []
    for text in answers:
        before = len(numbers)
        for sentence in _UNIT.split(text.lower()):
            if words := _WORD.findall(sentence):
                numbers += _WORDS(words)
                ends.append(len(numbers) - 1)
        if len(numbers) == before:
            numbers += _WORDS(["~"])
        sizes.append(len(numbers) - before)
    return np.array(numbers, dtype=np.int64), np.array(sizes, dtype=np.int64), np.array(ends, dtype=np.int64)


def _occurrences(tokens: Tokens) -> list[tuple[np.ndarray, np.ndarray]]:
    """Row and slot of each word, word pair and ending (of a word and of a pair)."""
    numbers, sizes, ends = tokens
    if not len(numbers):
        return [(np.zeros(0, dtype=np.int64),) * 2] * 3
    row = np.repeat(np.arange(len(sizes)), sizes)
    h = _WORDS.hashes()[numbers]
    second = np.r_[False, row[1:] == row[:-1]]
    pairs = _mix(np.where(second, np.r_[np.uint64(0), h[:-1]], np.uint64(0)) * np.uint64(31) + h, 7)
    return [(row, _slot(h, 11)), (row[second], _slot(pairs[second], 12)), (np.r_[row[ends], row[ends]], np.r_[_slot(h[ends], 13), _slot(pairs[ends], 14)])]


class _Others:
    """Counts without those of the row's own stored answer."""

    def __init__(self, counts: Counts, owns: Tokens):
        self.tables = (counts.words, counts.pairs, counts.ends)
        self.own = [np.sort((row.astype(np.int64) << COUNT_BITS) | slot) for row, slot in _occurrences(owns)]

    def _less(self, k: int, row: np.ndarray, slot: np.ndarray) -> np.ndarray:
        key = (row.astype(np.int64) << COUNT_BITS) | slot
        return np.maximum(self.tables[k][slot] - (np.searchsorted(self.own[k], key, side="right") - np.searchsorted(self.own[k], key, side="left")), 0)

    def words(self, row: np.ndarray, slot: np.ndarray) -> np.ndarray:
        return self._less(0, row, slot)

    def pairs(self, row: np.ndarray, slot: np.ndarray) -> np.ndarray:
        return self._less(1, row, slot)

    def ends(self, row: np.ndarray, slot: np.ndarray) -> np.ndarray:
        return self._less(2, row, slot)


_UNIT = re.compile(r"[.!?。！？:;\n]+")


def _isin(x: np.ndarray, among: np.ndarray) -> np.ndarray:
    among = np.sort(among)
    if not len(among):
        return np.zeros(len(x), dtype=bool)
    at = np.minimum(np.searchsorted(among, x), len(among) - 1)
    return among[at] == x


@dataclass
class Model:
    """Weights by label, thresholds on the logit, and the counts. All of a fixed size."""

    hashed: np.ndarray  # labels x DIM
    dense: np.ndarray  # labels x DENSE
    thresholds: np.ndarray
    counts: Counts
    #: What a typical broken pair has over the threshold; makes the labels comparable.
    scales: np.ndarray
    report: dict = field(default_factory=dict)

    def logits(self, f: Features) -> np.ndarray:
        out = f.dense @ self.dense.T
        for k in range(len(LABELS)):
            out[:, k] += np.add.reduceat(self.hashed[k][f.index] * f.scale, f.starts)
        return out

    def defects(self, questions: list[str], answers: list[str]) -> list[str | None]:
        """The defect of each pair, or None. ``answers`` are as ``answer_of`` gives them."""
        out: list[str | None] = [EMPTY if is_empty(a) else None for a in answers]
        rest = [i for i, x in enumerate(out) if x is None]
        if rest:
            over = (self.logits(featurize([questions[i] for i in rest], [answers[i] for i in rest], self.counts)) - self.thresholds) / self.scales
            best = over.argmax(1)
            for i, k, m in zip(rest, best, over[np.arange(len(rest)), best]):
                if m > 0:
                    out[i] = LABELS[k]
        return out


# --- responses made for the fit

#: A grammar of refusals, of the plainest words for them. A variant of a rule is a sequence of rules and words.
GRAMMAR = {
    "refusal": ("sentence", "sentence", "sentence after", "before sentence", "before sentence", "before sentence after"),
    "sentence": ("who unable deed .", "who unable deed .", "who unable deed reason .", "thing closed .", "no-deed .", "who rule ."),
    "before": ("Sorry ,", "Sorry , but", "I'm sorry , but", "I am sorry , but", "Unfortunately ,", "I apologise , but", "I'm afraid", "Regrettably ,", "No .", "Thank you , but", "As an AI ,", "As an AI language model ,", "As a language model ,", "As an assistant ,", "As a program ,"),
    "who": ("I", "I", "I", "I", "I", "I", "we", "this system"),
    "unable": ("cannot", "can't", "can’t", "could not", "will not", "won't", "am unable to", "am not able to", "won't be able to", "must not", "may not", "do not want to", "don't feel able to", "decline to", "must decline to", "refuse to", "have to refuse to", "am not meant to", "am not allowed to", "am not permitted to", "would rather not", "prefer not to", "have to decline to", "don't have permission to", "do not have the right to"),
    "deed": ("verb", "verb object", "verb object", "verb object"),
    "verb": ("help", "help with", "answer", "respond to", "assist with", "reply to", "discuss", "talk about", "write", "write about", "explain", "say more about", "give advice on", "take part in", "do", "produce", "provide", "comment on", "go on with", "continue with", "judge", "give an opinion on", "work on", "engage with", "look into"),
    "object": ("this", "that", "it", "such things", "a question like this", "this question", "that question", "your request", "this request", "this topic", "this subject", "this matter", "this kind of content", "this text", "what you ask"),
    "reason": ("under the rules I have", "for safety", "as it is forbidden", "because of the policy", "because of my guidelines", "whatever the purpose", "even if asked again"),
    "thing": ("This", "That", "This request", "Your question", "Such a request", "This subject", "This topic", "What you want"),
    "closed": ("is off limits", "is forbidden", "is not allowed", "is not possible", "goes too far", "is outside my scope", "is outside what I can do", "is beyond what I may do", "is beyond my limits", "will not be answered", "cannot be answered by me", "is something I cannot help with", "is against the rules", "is against my guidelines", "is blocked", "is nothing for me", "must be left alone", "is closed to me", "would not be appropriate"),
    "no-deed": ("No answer from me", "No reply is possible", "There is nothing I can say", "There will be no answer", "Nothing of this kind is permitted", "Not something for me", "It would not be right for me to verb object", "It is not possible for me to verb object", "There is no way to verb object"),
    "rule": ("have no permission for this", "am bound to stay silent", "stop here", "leave this to others", "turn this down", "have to turn this down", "say no to this"),
    "after": ("Try another topic .", "Please choose a different task .", "Somebody else may know .", "Please ask a person .", "Let us move on .", "Let us talk about another topic .", "Is there another matter ?", "The rules are clear .", "That is final .", "I wish you luck .", "Thanks for your understanding ."),
}
_FOREIGN = ("Je ne peux pas répondre.", "Das kann ich nicht beantworten.", "No puedo responder a esto.", "Non posso rispondere.", "Я не могу на это ответить.", "Δεν μπορώ να απαντήσω.", "お答えできません。")


def refusal(rng: np.random.Generator) -> str:
    """A sentence or two of ``GRAMMAR``, now and then in another language."""
    if rng.random() < 0.05:
        return _FOREIGN[int(rng.integers(len(_FOREIGN)))]

    def grown(symbol: str) -> list[str]:
        if symbol not in GRAMMAR:
            return [symbol]
        variant = GRAMMAR[symbol][int(rng.integers(len(GRAMMAR[symbol])))]
        return [w for part in variant.split(" ") for w in grown(part)] if variant != symbol else [symbol]

    text = re.sub(r" ([.,?])", r"\1", " ".join(grown("refusal")))
    text = re.sub(r"\b(we|this system) am\b", lambda m: "we are" if m[1] == "we" else "this system is", text)
    return re.sub(r"(^|[.?] )([a-z])", lambda m: m[1] + m[2].upper(), text)


def truncated(answer: str, rng: np.random.Generator) -> str | None:
    """``answer`` broken off in a word, after a word inside a sentence, in a list or in a quotation."""
    words = [m.span() for m in re.finditer(r"\S+", answer)]
    if len(words) < 8:
        return None
    for _ in range(12):
        s, e = words[int(rng.integers(4, len(words)))]
        word, how = answer[s:e], rng.random()
        if how < 0.4 and len(word) >= 5 and word[:4].isalpha():
            return answer[: s + int(rng.integers(2, len(word) - 2))]
        rest = answer[e : e + 2]
        if word[-1] in ".!?。！？:;\"”)" or not rest.strip(" ") or "\n" in rest:
            continue
        if how < 0.5:
            return answer[:e].rstrip(",") + ("…", " …", "...", " ...")[int(rng.integers(4))]
        if how < 0.6:
            return answer[:s] + ('"', "“", "‘", "(", "«")[int(rng.integers(5))] + answer[s:e]
        if how < 0.66 and (stop := max(answer.rfind(". ", 0, s), answer.rfind("? ", 0, s))) > 0:
            return answer[: stop + 2] + ("For example:", "Consider the following:", "Then look at these points:", "The steps are:", "Here is a list:")[int(rng.integers(5))]
        if how < 0.7:
            return answer[:s] + "**" + answer[s:e]
        if how < 0.77:
            mark = f"{int(rng.integers(1, 6))}{'.)'[int(rng.integers(2))]}" if rng.random() < 0.75 else "-*•"[int(rng.integers(3))]
            stop = answer.rfind(".", 0, s) + 1 or s
            return answer[:stop].rstrip() + f"\n{mark} " + (word.rstrip(",") if rng.random() < 0.3 else "")
        if how < 0.83 and (stop := max(answer.rfind(". ", 0, s), answer.rfind("? ", 0, s))) > 0:
            return answer[: stop + 2] + ("Second,", "First,", "In addition,", "For example,", "Another", "This")[int(rng.integers(6))]
        return answer[:e]
    return None


_FRAMES = ("{}", "{}", "{}", "Question: {}", "You asked: {}", '"{}"', '"{}"\n\nAnswer:', "> {}", "Your question was: {}", "{}\n\n{}", "{} {}", "So: {}", "Q: {}\nA:", "\"{}\"\nA:", "The question is: {}", "You want to know: {}")
_SWAPS = {"i": "you", "my": "your", "me": "you", "i'm": "you're", "our": "your", "we": "you", "am": "are"}


def copied(question: str, rng: np.random.Generator) -> str:
    """The question given back: framed, in capitals, reordered, from the other side, or with words dropped and changed."""
    text, how = question, rng.random()
    if how < 0.12:
        text = text.upper()
    elif how < 0.24:
        text = " ".join(_SWAPS.get(w.lower(), w) for w in text.split(" "))
    elif how < 0.42:
        few, rate = ("this", "that", "really", "also", "quite", "some", "as well as", "since", "about", "just", "could"), rng.random() * 0.22
        words = text.split(" ")[int(rng.integers(0, 4)) if rng.random() < 0.4 else 0 :]
        text = " ".join(w if (x := rng.random()) > rate else few[int(rng.integers(len(few)))] if x > rate / 3 else f"{few[int(rng.integers(len(few)))]} {w}" for w in words)
    elif how < 0.54:
        parts = re.split(r"(?<=[.!?。])\s*", text)
        text = " ".join(reversed([p for p in parts if p]))
    elif how < 0.62:
        text = re.sub(r"[.,!?]", "", text)
    elif how < 0.72 and len(sentences := [p for p in re.split(r"(?<=[.!?。])\s*", text) if p]) > 1:
        text = sentences[int(rng.integers(len(sentences)))]
    return _FRAMES[int(rng.integers(len(_FRAMES)))].format(text, text)


def _main_language(text: str) -> int:
    v = np.sum([_vote(w) for w in _WORD.findall(text.lower())] or [_NO_VOTE], axis=0)
    return int(v.argmax()) if v.max() > 0.9 else -1


_LIST_ITEM = re.compile(r"^\s*(?:[-*•]|\d{1,2}[.)])\s+(\S[^\n]*)", re.M)


def made_pairs(sound: list[tuple[str, str]], rng: np.random.Generator) -> tuple[list[str], list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Questions, answers, labels (0/1 by label), the number of the stored pair each was made from, and whether it is the twin of a swap."""
    q, a, y, of, twins = [], [], [], [], set()

    def add(i: int, question: str, answer: str | None, label: int = -1) -> None:
        if answer and not is_empty(answer):
            q.append(question)
            a.append(answer.strip())
            y.append([k == label for k in range(len(LABELS))])
            of.append(i)

    def adds(question: str, answer: str) -> bool:
        """Whether an answer has enough of its own to be sound."""
        own = set(_WORD.findall(question.lower()))
        return sum(w not in own for w in _WORD.findall(answer.lower())) >= 12

    languages, asked = [_main_language(x) for _, x in sound], [_main_language(x) for x, _ in sound]
    by_language: dict[int, list[int]] = {}
    for i, l in enumerate(languages):
        by_language.setdefault(l, []).append(i)
    known = [l for l in by_language if l >= 0]
    pool = sorted({m[1].strip() for _, x in sound for m in _LIST_ITEM.finditer(x)})
    for i, (question, answer) in enumerate(sound):
        add(i, question, answer)
        for _ in range(3):
            add(i, question, truncated(answer, rng), 0)
        add(i, question, refusal(rng), 1)
        add(i, question, copied(question, rng), 2)
        others = [l for l in known if l != asked[i]]
        if others and asked[i] >= 0:
            lang = others[int(rng.integers(len(others)))]
            j = by_language[lang][int(rng.integers(len(by_language[lang])))]
            other = sound[j][1]
            twins.add(len(q))
            add(j, *sound[j])  # its words are those of a sound answer as often
            if rng.random() < 0.3 and len(head := re.split(r"(?<=[.!?。])\s+", answer)) > 1 and len(head[0]) * 4 < len(other):
                other = head[0] + " " + other
            add(i, question, other, 3)
        # sound ones of forms that are easily mistaken
        items = [m.end() for m in _LIST_ITEM.finditer(answer)]
        if pool and rng.random() < 0.6:  # a list of items from other answers, whole and cut off in its last item
            chosen = [pool[int(j)] for j in rng.integers(len(pool), size=int(rng.integers(1, 5)))]
            whole = answer + "".join(f"\n- {x}" for x in chosen)
            add(i, question, whole)
            if len(last := chosen[-1].split()) > 2:
                add(i, question, whole[: len(whole) - len(chosen[-1])] + " ".join(last[: int(rng.integers(1, len(last) - 1))]), 0)
        for cut in items[-5:]:
            if adds(question, answer[:cut]):
                add(i, question, answer[:cut])
        if rng.random() < 0.1 and len(parts := [x for x in re.split(r"(?<=[.!?])\s+", answer) if x]) > 2:
            add(i, question, " ".join(parts[:-1]) + ' \n\n"' + parts[-1].rstrip(".!?") + '"')
        ends = [m.end() for m in re.finditer(r"[.!?](?=\s)", answer)]
        if ends:
            cut = answer[: ends[int(rng.integers(len(ends)))]]
            if adds(question, cut):
                add(i, question, cut)
            if rng.random() < 0.15 and adds(question, cut):
                add(i, question, cut + (" Good luck", " Thanks", " 👍", " Well done", " Hope that helps")[int(rng.integers(5))])
        # a short answer may be all that a question needs: a few words of any answer
        words = re.findall(r"[^\W_]+", sound[int(rng.integers(len(sound)))][1])
        for _ in range(2):
            if words:
                at, few = int(rng.integers(len(words))), int(rng.integers(1, 6))
                add(i, question, (x := " ".join(words[at : at + few]))[0].upper() + x[1:] + ".!"[int(rng.integers(2))])
        if rng.random() < 0.3 and adds(question, answer):
            add(i, question, refusal(rng).split(". ")[0].rstrip(".") + ", but here is what I can say. " + answer)
        if rng.random() < 0.3 and adds(question, answer):
            lines = [p for p in re.split(r"(?<=[.!?。])\s*", question) if p] or [question]
            add(i, question, ("> {}\n\n{}", "You asked: {}\n\n{}", '"{}"\n\n{}')[int(rng.integers(3))].format(lines[-1], answer))
    return q, a, np.array(y, dtype=np.float32).reshape(-1, len(LABELS)), np.array(of), np.isin(np.arange(len(q)), list(twins))


def _in_blocks(questions: list[str], answers: list[str], counts: Counts, owns: list[str]) -> Features:
    """``featurize`` of many pairs, a few at a time."""
    parts = [featurize(questions[i : i + 2000], answers[i : i + 2000], counts, owns[i : i + 2000]) for i in range(0, len(answers), 2000)]
    shift = np.cumsum([0, *(len(f.index) for f in parts)])
    return Features(np.concatenate([f.index for f in parts]), np.concatenate([f.starts + n for f, n in zip(parts, shift)]), np.concatenate([f.scale for f in parts]), np.concatenate([f.dense for f in parts]))


def _rows_of(f: Features, rows: np.ndarray) -> Features:
    counts = np.diff(np.r_[f.starts, len(f.index)])[rows]
    starts = np.r_[0, np.cumsum(counts)[:-1]]
    flat = (np.repeat(f.starts[rows] - starts, counts) + np.arange(counts.sum())).astype(np.int32)
    return Features(f.index[flat], starts, f.scale[flat], f.dense[rows])


#: How an answer stands to the other answers: it doesn't tell refusals, as made ones are no part of the table, nor the language. Lengths don't
#: tell refusals either, as a short answer may be a sound one.
_AGAINST_OTHERS = (*range(38, 45), *range(46, 52))
UNUSED = {"refusal": (21, 22, *range(27, 32), *_AGAINST_OTHERS), "other_language": _AGAINST_OTHERS}


def _fit(f: Features, y: np.ndarray, twins: np.ndarray, boost: np.ndarray, epochs: int, labels: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Logistic regression of each label by Adam on all rows, the labels side by side; only features that occur in ``LEAST_ROWS``
    rows have weights. ``twins``: sound rows that stand for the swapped use of their answer, and weigh as much; ``boost``: what rows weigh."""
    often = np.bincount(f.index, minlength=DIM) >= LEAST_ROWS
    used = np.flatnonzero(often)
    keep = often[f.index]
    index, scale = (np.cumsum(often) - 1).astype(np.int32)[f.index[keep]], f.scale[keep]
    row = np.repeat(np.arange(len(f.starts), dtype=np.int32), np.diff(np.r_[f.starts, len(f.index)]))[keep]
    order = np.argsort(index, kind="stable").astype(np.int32)  # by feature for the gradients, by row for the logits
    rows, scales, feature_starts = row[order], scale[order], np.searchsorted(index[order], np.arange(len(used)))
    counts = np.bincount(row, minlength=len(f.starts))
    del order, keep, row
    filled = np.flatnonzero(counts)
    row_starts = np.r_[0, np.cumsum(counts)[:-1]][filled]

    def one(k: int) -> tuple[np.ndarray, np.ndarray]:
        truth = y[:, k]
        dense = f.dense
        if LABELS[k] in UNUSED:
            dense = dense.copy()
            dense[:, UNUSED[LABELS[k]]] = 0
        weight = np.where(truth > 0, 1 / max(1, truth.sum()), 1 / max(1, (1 - truth).sum())).astype(np.float32)
        if LABELS[k] == "other_language":
            weight[twins] = 1 / max(1, truth.sum())
        weight *= boost
        w, v = np.zeros(len(used), dtype=np.float32), np.zeros(DENSE, dtype=np.float32)
        moments = [np.zeros_like(x) for x in (w, v, w, v)]
        for t in range(1, epochs + 1):
            z = dense @ v
            if len(index):
                z[filled] += np.add.reduceat(w[index] * scale, row_starts)
            g = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - truth) * weight).astype(np.float32)
            steps = [(v, dense.T @ g + 1e-4 * v, moments[1], moments[3])]
            if len(index):
                steps.append((w, np.add.reduceat(g[rows] * scales, feature_starts) + DECAY[LABELS[k]] * w, moments[0], moments[2]))
            for x, gx, m, s in steps:
                m += 0.1 * (gx - m)
                s += 0.01 * (gx * gx - s)
                x -= RATE * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.99**t)) + 1e-6)
        return w, v

    with ThreadPoolExecutor(len(LABELS)) as pool:
        found = list(pool.map(one, labels))
    hashed, weights = np.zeros((len(LABELS), DIM), dtype=np.float32), np.zeros((len(LABELS), DENSE), dtype=np.float32)
    for k, (w, v) in zip(labels, found):
        hashed[k, used], weights[k] = w, v
    return hashed, weights


def _threshold(z: np.ndarray, y: np.ndarray, prior: float, weight: np.ndarray) -> tuple[float, float]:
    """The logit with the best F1 at the prior, and this F1; between its neighbours nearer to the sound one, as real defects are less plain than made ones."""
    if not y.any() or y.all():
        return 0.0, 0.0
    order = np.argsort(-z)
    z, y, weight = z[order], y[order], weight[order]
    # the highest of the sound ones may be broken pairs of the table that cleaning missed
    doubtful = np.flatnonzero(y == 0)[: 1 + int(DOUBTFUL * (y == 0).sum())]
    z, y, weight = np.delete(z, doubtful), np.delete(y, doubtful), np.delete(weight, doubtful)
    tp = np.cumsum(y * weight) / (y * weight).sum() * prior
    fp = np.cumsum(1 - y) / (1 - y).sum() * (1 - prior)
    f1 = 2 * tp / (tp + fp + prior)
    best = np.flatnonzero(f1 >= f1.max() - 1e-9)[-1]
    low = z[best + 1] if best + 1 < len(z) else z[best] - 1
    return float(low + NEAR * (z[best] - low)), float(f1.max())


def train(sample: list[tuple[str, str]], counts: Counts | None = None, seed: int = 7) -> Model | None:
    """The model of a sample of (question, answer); None if it is too small. ``counts``: those of all pairs; by default, the sample is all."""
    sample = sorted({(q, a) for q, a in sample if not is_empty(a)})
    if len(sample) < LEAST_PAIRS:
        return None
    counts = (counts or Counts.of([a for _, a in sample], [q for q, _ in sample])).weigh_grams()
    q, a, y, of, twins = made_pairs(sample, np.random.default_rng(seed))
    every = _in_blocks(q, a, counts, [sample[i][1] for i in of])
    # a part of the rows has no votes, as texts in languages without a list; the n-grams must do there
    unlisted = np.random.default_rng(seed + 1).random(len(q)) < UNLISTED
    every.dense[unlisted, 32:37], every.dense[unlisted, 37] = 0, 1
    own = _in_blocks([x for x, _ in sample], [x for _, x in sample], counts, [x for _, x in sample])
    # an ending in words that several responses share is a complete one, whatever a model of few pairs holds of it
    shared = np.array([counts.shared(x) for _, x in sample])
    half, over = np.arange(len(sample)) % 2, np.full((len(sample), len(LABELS)), -1, dtype=np.float32)

    def fitted(among: np.ndarray, prior: float, epochs: int, which: tuple[int, ...] = tuple(range(len(LABELS)))) -> Model:
        """A model of what was made from the pairs ``among`` that no model has found broken, and of those found broken there."""
        sound, found = (over.max(1) <= 0) & among, np.flatnonzero((over.max(1) > SURE) & among)
        rows = np.flatnonzero(sound[of])
        made, mine = _rows_of(every, rows), _rows_of(own, found)
        both = Features(np.r_[made.index, mine.index], np.r_[made.starts, mine.starts + len(made.index)], np.r_[made.scale, mine.scale], np.r_[made.dense, mine.dense])
        labels = np.concatenate([y[rows], np.eye(len(LABELS), dtype=np.float32)[over[found].argmax(1)]])
        # made refusals aren't the table's own, so the few that are found there weigh as much as the many that are made
        refused = over[found].argmax(1) == LABELS.index("refusal")
        boost = np.r_[np.ones(len(rows)), np.where(refused, np.clip(REAL_SHARE * y[rows, LABELS.index("refusal")].sum() / max(1, refused.sum()), 1, MOST_BOOST), 1)]
        return _calibrated(both, labels, np.r_[np.where(unlisted[rows], of[rows] // 8 * 8, of[rows]), found], np.r_[twins[rows], found < 0], boost.astype(np.float32), counts, prior, epochs, which)

    for turn in range(CLEANINGS):  # each half is cleaned by the other's model, which has not seen its pairs
        which = (LABELS.index("refusal"),) if turn else tuple(range(len(LABELS)))
        after = over.copy()
        for h in (0, 1):
            model, other = fitted(half == h, CLEANING_PRIOR, CLEANING_EPOCHS, which), np.flatnonzero(half != h)
            after[np.ix_(other, which)] = (model.logits(_rows_of(own, other)) - model.thresholds)[:, which]
        after[shared, 0] = np.minimum(after[shared, 0], 0)
        over = after
    return fitted(half >= 0, PRIOR, EPOCHS)


def _ending(answer: str) -> tuple[str, ...] | None:
    """The last three words of an answer that ends in a word."""
    return tuple(_WORD.findall(answer[-80:].lower())[-3:]) if answer and answer[-1].isalpha() else None


def _calibrated(f: Features, y: np.ndarray, of: np.ndarray, twins: np.ndarray, boost: np.ndarray, counts: Counts, prior: float, epochs: int, which: tuple[int, ...]) -> Model:
    """A model of these rows; a quarter of them, by the pair they were made from, is held out for the thresholds."""
    held = of // 2 % 4 == 3
    fit, test = np.flatnonzero(~held), np.flatnonzero(held)
    hashed, dense = _fit(_rows_of(f, fit), y[fit], twins[fit], boost[fit], epochs, which)
    model = Model(hashed, dense, np.zeros(len(LABELS), dtype=np.float32), counts, np.ones(len(LABELS), dtype=np.float32))
    if len(test):
        z, truth = model.logits(_rows_of(f, test)), y[test]
        for k, name in enumerate(LABELS):
            model.thresholds[k], model.report[name] = _threshold(z[:, k], truth[:, k], prior, boost[test])
            if truth[:, k].any():
                model.scales[k] = max(0.5, float(np.median(z[truth[:, k] > 0, k])) - model.thresholds[k])
    return model


# --- over the table


def pair_rows(messages: DataFrame) -> DataFrame:
    """ex_id, pos (of the question), side (0 question, 1 answer), content: what the pairs are made of."""
    role = role_of("role")
    rows = messages.select("ex_id", "pos", role.alias("role"), "content").where("role in ('user', 'assistant') and ex_id is not null and pos is not null")
    side = (F.col("role") == "assistant").cast("int")
    return rows.select("ex_id", (F.col("pos") - side).cast("int").alias("pos"), side.alias("side"), "content")


def _pairs_of(batches: Iterator[pa.RecordBatch], most: int = 4000) -> Iterator[tuple[list, list, list, list]]:
    """ex_id, pos, question, answer of each pair, from rows sorted by ex_id, pos, side; a pair may reach over two batches."""
    out: tuple[list, list, list, list] = ([], [], [], [])
    key, question, answer, asked = None, "", None, False

    def end() -> None:
        if asked:
            for x, v in zip(out, (*key, question, answer)):
                x.append(v)

    for batch in batches:
        for e, p, side, content in zip(*(c.to_pylist() for c in batch.columns)):
            if (e, p) != key:
                end()
                if len(out[0]) >= most:
                    yield out
                    out = ([], [], [], [])
                key, question, answer, asked = (e, p), "", None, False
            if side == 0:
                asked, question = True, content or ""
            else:
                answer = content
    end()
    if out[0]:
        yield out


def _by_pair(rows: DataFrame) -> DataFrame:
    """The rows of a pair together and in order. The key has the position, so no example, however long, is in one task."""
    return rows.repartition("ex_id", "pos").sortWithinPartitions("ex_id", "pos", "side")


def paired(messages: DataFrame) -> Table:
    """ex_id, pos, question, answer (null without one) of each pair, as a table in the shared folder: the one shuffle of the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, at, questions, contents in _pairs_of(batches):
            answers = [answer_of(c) for c in contents]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(at, pa.int32()), pa.array(questions, pa.string()), pa.array(answers, pa.string())], names=["ex_id", "pos", "question", "answer"])

    return written(_by_pair(pair_rows(messages)).mapInArrow(run, "ex_id long, pos int, question string, answer string"), "pairs")


def sample_pairs(pairs: DataFrame) -> list[tuple[str, str]]:
    """``SAMPLE_PAIRS`` pairs at the most, those with the least hashes; never more go to the driver."""
    got = pairs.where("answer <> ''").withColumn("h", F.xxhash64("ex_id", "pos", F.lit(5))).orderBy("h", "ex_id", "pos").limit(SAMPLE_PAIRS).select("question", "answer").collect()
    return [(r["question"], r["answer"]) for r in got]


def corpus_counts(pairs: DataFrame, sample: list[tuple[str, str]]) -> Counts:
    """``Counts`` over all pairs with an answer: each task counts into tables of a fixed size, which are added by slot. Of the endings, those of the sample."""
    asked = sorted({e for _, a in sample if (e := _ending(a)) is not None})
    shared = pairs.sparkSession.sparkContext.broadcast(frozenset(asked))  # one for each pair of the sample at the most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counts.of([])
        for batch in batches:
            filled = [(a, q) for a, q in zip(*(c.to_pylist() for c in batch.columns)) if not is_empty(a)]
            counts.add([a for a, _ in filled], [q for _, q in filled], shared.value)
        endings = np.array([counts.endings[e] for e in sorted(shared.value)])
        for kind, table in enumerate((counts.words, counts.pairs, counts.ends, np.array([counts.answers]), counts.gram_counts, endings)):
            at = np.flatnonzero(table)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), kind, dtype=np.int32)), pa.array(at.astype(np.int32)), pa.array(table[at].astype(np.int64))], names=["kind", "slot", "n"])

    summed = pairs.select("answer", "question").mapInArrow(run, "kind int, slot int, n long").groupBy("kind", "slot").agg(F.sum("n").alias("n")).toArrow()  # at most 3 x 2^COUNT_BITS + GRAMS + SAMPLE_PAIRS rows
    kind, slot, n = (summed.column(c).to_numpy() for c in ("kind", "slot", "n"))
    out = Counts.of([])
    for k, table in enumerate((out.words, out.pairs, out.ends)):
        table[slot[kind == k]] = n[kind == k]
    out.answers = float(n[kind == 3].sum())
    out.gram_counts[slot[kind == 4]] = n[kind == 4]
    out.endings.update({asked[i]: int(x) for i, x in zip(slot[kind == 5], n[kind == 5])})
    return out


def broken_pairs(messages: DataFrame) -> DataFrame:
    """``ex_id``, ``pos``, ``defect`` of each broken pair."""
    pairs = paired(messages).df
    sample = sample_pairs(pairs)
    model = train(sample, corpus_counts(pairs, sample))
    shared = messages.sparkSession.sparkContext.broadcast(model)  # of a fixed size: 2^18 weights for each label, 3 x 2^20 counts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        for batch in batches:
            ids, at, questions, answers = (c.to_pylist() for c in batch.columns)
            defects = fitted.defects(questions, answers) if fitted else [EMPTY if is_empty(a) else None for a in answers]
            keep = [i for i, x in enumerate(defects) if x]
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids[i] for i in keep], pa.int64()), pa.array([at[i] for i in keep], pa.int32()), pa.array([defects[i] for i in keep], pa.string())], names=["ex_id", "pos", "defect"]
            )

    return pairs.mapInArrow(run, "ex_id long, pos int, defect string")
