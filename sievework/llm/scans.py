"""Noise in text from scanned pages: words hyphenated over lines, misread characters, running heads and page numbers.

1. Furniture. The first and last lines of each page are read as a title with or without a number, or as a number alone.
   Counted by file: on how many pages a title stands, and the shift between printed and real page numbers that most pages
   of the file agree on. A title is a running head if the file has it on several pages, if it shares a part with such a
   title or with a chapter's heading, or if it carries the page's number; a number is the page's if it fits the shift.
2. Vocabulary. Words of the running text are counted over all pages.
3. Links. A rare word is linked to the words at least ``RATIO`` times as frequent that one plausible glyph edit (``GLYPHS``) turns
   it into: its variants are made and joined with the vocabulary.
4. In context. A linked word and those it is linked to have skip-gram vectors: the sum, over all pages, of the index vectors (signs from
   a hash) of the words up to ``CONTEXT`` places away. The sums are of whole numbers, made by word in Spark; no size of the corpus or of
   the vocabulary and no number of tasks changes which words have one or what it is. Of each occurrence of a linked word, the neighbour
   that fits the words around it best is taken, by the vectors; without a link that fits, the word stays.
5. Hyphens. A line that ends in a hyphen or the like is joined with the next line of running text, over the page end too,
   by an equi-join with the next page. The counts of the joined word, of the hyphenated word and of the two parts tell whether
   the hyphen is the word's own.
6. Repair. Furniture goes, words are joined and corrected, lines flow into paragraphs.

No file, however many pages it has, is in one task: furniture is counted by (file, title), pages meet the next page by key.

Defined results: null and blank pages have no noise and a repaired text of null and ""; both kinds of line ends are read; line numbers
are those of ``text`` split at "\\n"; rows that repeat a page count once; very long pages are handled whole. Rows without a key and
extra columns are left out; a page without a file or number has no furniture and no next page.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from sievework.llm.common import once
from sievework.runtime import cut_lineage

#: Lines looked at from either end of a page; pages a running head stands on at least.
EDGE, LEAST_PAGES = 3, 2
#: How much more frequent than a misread word its neighbour is at least, and how often it occurs at least.
RATIO, LEAST_COUNT = 12.0, 6
#: The same for a word that mixes letters with digits or signs.
STRANGE_RATIO = 4.0
#: Size of the vectors; words on either side that are the context.
VECTOR_SIZE, CONTEXT = 64, 3
#: Weight of a word in the contexts of others, and the share of all words from which on it weighs less, by the root of its count.
WEIGHT, FREQUENT = 16, 1e-3
#: Letters of the longest word that is looked at; longer runs are no words.
MOST_LETTERS = 60
#: Bits of the filter on words for each word in it, and at the most; it only spares the exact join rows.
FILTER_BITS, MOST_BITS = 16, 1 << 26

HYPHENATION, MISREAD, HEADER, PAGE_NUMBER = "hyphenation", "misread", "header", "page_number"

#: What a scanner reads -> what stands there. Fixed values.
GLYPHS = {
    "€": ("e",), "†": ("t",), "@": ("a",), "(": ("c",), "|": ("l", "i"), "!": ("l", "i"), "$": ("s",), "¢": ("c",), "ſ": ("f",), "ß": ("b",),
    "0": ("o",), "1": ("l", "i"), "2": ("z",), "3": ("e",), "4": ("a",), "5": ("s",), "6": ("b", "g"), "7": ("t",), "8": ("b",), "9": ("g", "q"),
    "c": ("e", "o"), "e": ("c",), "o": ("0", "a", "e"), "i": ("t", "l", "1"), "l": ("i", "t", "1"), "t": ("f",), "f": ("t",), "v": ("y",), "y": ("v",),
    "b": ("h",), "h": ("b", "li"), "m": ("in", "rn", "ni"), "n": ("ri", "rr", "u"), "d": ("cl",), "u": ("ll", "ii", "n"), "w": ("vv",), "s": ("5",), "g": ("9", "q"), "q": ("g",), "a": ("o",),
    "rn": ("m",), "ri": ("n",), "cl": ("d",), "ii": ("u",), "vv": ("w",), "nn": ("m",), "iii": ("m",), "ni": ("m",), "in": ("m",), "li": ("h", "u"), "lc": ("k",), "fi": ("h",), "tl": ("d",),
}
HYPHENS = "-¬\xad‐‑"

_NUMBER = re.compile(r"^[\W_]*(?:page|p|pp|seite|s)?[\s.]*(\d{1,6}|(?=[OIlS]*\d)[\dOIlS]{2,5}|[ivxlc]{1,8})(?:\s*(?:of|/)\s*[\dOIlS]{1,6})?[\W_]*$", re.I)
_GLYPH_NUMBER = re.compile(r"^[^\w]*(?:page|p\.?)?\s*([OIlS]{1,4})(?:\s*(?:of|/)\s*[\dOIlS]{1,6})?[^\w]*$")
_BARE = re.compile(r"^\s*(?:\d{1,6}|[ivxlc]{1,8})\s*$", re.I)
_EDGE_NUMBER = re.compile(r"^(?:[\[(]?(\d{1,6})[\])]?(?:\s{2,}|\s*[|·–—-]\s*)(\S.*)|(\S.*?)(?:\s{2,}|\s*[|·–—-]\s*)[\[(]?(\d{1,6})[\])]?)$")
_CHAPTER = re.compile(r"^(?:chapter|part|section|unit|appendix)\s+(?:\d+|[ivxlc]+|[a-z])\b[\s:.–—-]*(.*)$", re.I)
_SMALL = frozenset("a an the of and or to in on for with from by at as de la le und der die das".split())
#: Signs that are read for a digit.
_DIGITS = str.maketrans("OoIlSs", "001155")
_ROMAN = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100}


def roman(text: str) -> int:
    """The value of a roman number in lower case; 0 if it is none."""
    total, last = 0, 0
    for ch in reversed(text):
        value = _ROMAN[ch]
        total += value if value >= last else -value
        last = max(last, value)
    return total if total and _as_roman(total) == text else 0


def _as_roman(n: int) -> str:
    out = []
    for value, sign in ((100, "c"), (90, "xc"), (50, "l"), (40, "xl"), (10, "x"), (9, "ix"), (5, "v"), (4, "iv"), (1, "i")):
        while n >= value:
            out.append(sign)
            n -= value
    return "".join(out)


def _title_like(text: str) -> bool:
    """Few words, all of them capitalised but the small ones, and no end of a sentence; after a dash a short remark may follow."""
    head, *rest = re.split(r"\s+[–—|]\s+", text)
    if rest and all(len(r.split()) <= 4 and r.rstrip()[-1:] not in ".,;:?!" for r in rest):
        return _title_like(head)
    words = re.findall(r"[^\W\d_][\w'’€†@()-]*", text)
    if not 1 <= len(words) <= 14 or text.rstrip()[-1:] in ".,;:?!-":
        return False
    big = [w for w in words if w.lower() not in _SMALL]
    return bool(big) and words[0][0].isupper() and all(w[0].isupper() for w in big)


@dataclass
class Edge:
    """What a line at the edge of a page may be: a number alone, or a title (``stem``) with or without one; kind 0 number, 1 title, 2 chapter heading."""

    line: int
    kind: int
    stem: str
    number: int
    style: str  # of the number: d digits, r roman
    bare: bool
    top: bool  # a title of two words or more on the first line


def edges(text: str) -> list[Edge]:
    lines = text.split("\n")
    filled = [i for i, x in enumerate(lines) if x.strip()]
    out = []
    for rank, i in [*enumerate(filled[:EDGE]), *enumerate(reversed(filled[EDGE:][-EDGE:]))]:
        x = lines[i].strip()
        labelled = i != filled[0] and lines[filled[filled.index(i) - 1]].rstrip().endswith(":")
        if (m := _GLYPH_NUMBER.match(x)) and not labelled:  # no digit is left in it, so it must fit the page
            out.append(Edge(i + 1, 0, "", int(m[1].translate(_DIGITS)), "d", True, False))
        m = _NUMBER.match(x)
        if m:
            digits = m[1].translate(_DIGITS) if re.search(r"\d", m[1]) else m[1]
            value = int(digits) if digits.isdigit() else roman(m[1].lower())
            if value and not labelled:
                out.append(Edge(i + 1, 0, "", value, "d" if digits.isdigit() else "r", bool(_BARE.match(x)), False))
            if value:
                continue
        if m := _CHAPTER.match(x):
            if _title_like(x.rstrip(".")):
                out.append(Edge(i + 1, 2, _stem(m[1]), -1, "", False, False))
            continue
        number, title = -1, x
        if m := _EDGE_NUMBER.match(x):
            number, title = int(m[1] or m[4]), m[2] or m[3]
        if rank < 2 + (number >= 0) and _title_like(title):
            out.append(Edge(i + 1, 1, _stem(title), number, "d" if number >= 0 else "", False, i == filled[0] and " " in title and "," not in title))
    return out


def _stem(title: str) -> str:
    return re.sub(r"\W+", " ", title.lower()).strip()


EDGE_SCHEMA = "page_id long, source_file string, page_number int, line int, kind int, stem string, part string, number int, style string, bare boolean, top boolean"


def _edge_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for page, file, n, text in zip(batch["page_id"], batch["source_file"], batch["page_number"], batch["text"]):
            if not text:
                continue
            lines = text.split("\n")
            for e in edges(text):
                part = re.split(r"\s+[–—|]\s+", re.sub(r"\s*[|]\s*\d+$", "", lines[e.line - 1].strip()))[0] if e.kind == 1 else ""
                out.append((page, file, n, e.line, e.kind, e.stem, _stem(part), e.number, e.style, e.bare, e.top))
        yield pd.DataFrame(out, columns=[x.split()[0] for x in EDGE_SCHEMA.split(", ")])


def furniture(pages: DataFrame) -> DataFrame:
    """``page_id``, ``line``, ``noise`` of running heads and page numbers."""
    e = cut_lineage(pages.select("page_id", "source_file", "page_number", "text").mapInPandas(_edge_rows, EDGE_SCHEMA))
    shift = F.col("number") - F.col("page_number")
    numbered = e.where("number >= 0").select("source_file", "style", shift.alias("shift"), "page_id")
    counted = numbered.groupBy("source_file", "style", "shift").agg(F.count_distinct("page_id").alias("pages"))
    shifts = counted.groupBy("source_file", "style").agg(F.max_by("shift", F.struct("pages", -F.col("shift"))).alias("shift"), F.max("pages").alias("agree")).where(f"agree >= {LEAST_PAGES}")
    titles = e.where("kind = 1")
    stems = titles.select("source_file", F.explode(F.array_distinct(F.array("stem", "part"))).alias("stem"), "page_id").where("stem <> ''")
    chapters = e.where("kind = 2 and stem <> ''").select("source_file", "stem", "page_id")
    repeated = stems.groupBy("source_file", "stem").agg(F.count_distinct("page_id").alias("n")).unionByName(chapters.groupBy("source_file", "stem").agg(F.lit(LEAST_PAGES).cast("long").alias("n")))
    known = repeated.groupBy("source_file", "stem").agg(F.max("n").alias("n")).where(f"n >= {LEAST_PAGES}").select("source_file", "stem")

    t = titles.select("page_id", "source_file", "line", "stem", "part", shift.alias("shift"), "number")
    by_stem = t.join(known, ["source_file", "stem"], "left_semi").select("page_id", "line")
    by_part = t.where("part <> stem").join(known.withColumnRenamed("stem", "part"), ["source_file", "part"], "left_semi").select("page_id", "line")
    by_number = t.where("number >= 0").join(shifts.where("style = 'd'").select("source_file", "shift"), ["source_file", "shift"], "left_semi").select("page_id", "line")
    # a title on the first line of a page, in a file that has running heads, is one of them misread
    by_place = titles.where("top").join(known.select("source_file").distinct(), "source_file", "left_semi").select("page_id", "line")
    heads = by_stem.unionByName(by_part).unionByName(by_number).unionByName(by_place).distinct().withColumn("noise", F.lit(HEADER))
    n = e.where("kind = 0").select("page_id", "source_file", "line", "style", shift.alias("shift"), "bare")
    fits = n.join(shifts.select("source_file", "style", "shift"), ["source_file", "style", "shift"], "left_semi").unionByName(n.where("style = 'r' and shift = 0"))
    dressed = n.where("not bare").join(shifts.select("source_file", "style"), ["source_file", "style"], "left_anti")
    numbers = fits.unionByName(dressed).select("page_id", "line", F.lit(PAGE_NUMBER).alias("noise")).distinct()
    return heads.unionByName(numbers)


# --- words of the running text

_OUTER_LEFT, _OUTER_RIGHT = "\"'“”‘’[{<«*_…", ".,;:!?\"'“”‘’)]}>»*_…"
_CORE = re.compile(r"[\w€†@($¢|!ſ'’]+")
_TOKEN, _PART = re.compile(r"\S+"), re.compile(r"[^-‐‑/–—=+]+")
_HAS_LETTER = re.compile(r"[^\W\d_]")


class Word(NamedTuple):
    line: int  # index of the line
    start: int
    end: int
    text: str  # lower case
    next: int = -1  # index of the line that a broken word goes on in


def _words_of(line: str, index: int, ahead: str) -> list[Word]:
    out = []
    for m in _TOKEN.finditer(line):
        a, b = m.span()
        token = m[0]
        if token.isalnum():
            out.append(Word(index, a, b, token.lower()))
            continue
        if (bare := token.rstrip(".,;:!?")).isalnum():
            out.append(Word(index, a, a + len(bare), bare.lower()))
            continue
        while a < b and (line[a] in _OUTER_LEFT or line[a] == "(" and ")" in (line[a:] + " " + ahead)[:80]):
            a += 1
        while b > a and (line[b - 1] in _OUTER_RIGHT):
            b -= 1
        for w in _PART.finditer(line[a:b]):
            text = w[0].strip(".,;:?\"")
            if text and _CORE.fullmatch(text):
                s = a + w.start() + w[0].index(text)
                out.append(Word(index, s, s + len(text), text.lower()))
    return out


@dataclass
class Body:
    """The running text of a page: lines without furniture, the words, and the lines that end in a hyphen."""

    lines: list[str]
    running: list[int]
    words: list[Word]
    breaks: list[tuple[int, str, int, str, bool]]  # line index, left part, index of the next line or -1, right part, plain hyphen
    first: str  # first part of a word on the page
    compounds: list[str]


_LEFT = re.compile(r"([\w€†@($¢|!ſ'’]+(?:[-‐‑][\w€†@($¢|!ſ'’]+)*)([" + HYPHENS + r"])[ \t\r]*$")
_RIGHT = re.compile(r"[ \t\"“‘(]*([\w€†@($¢|!ſ'’]+)")
_FIGURE = re.compile(r"\s*(?=[OIlSo]*\d|[OIl]{1,3}\s*$)[\dOIlSo.,]{1,8}\s*$")
_ENDS = frozenset(HYPHENS)
_COMPOUND = re.compile(r"(?<![\w-])[^\W\d_]+(?:[-‐‑][^\W\d_]+)+(?![\w-])")


def _opening(lines: list[str], running: list[int]) -> int:
    """The line on which a word of the page before goes on: the first one below a chapter's heading."""
    if len(running) > 1 and _CHAPTER.match(lines[running[0]].strip()):
        return running[1]
    return running[0] if running else -1


def body(text: str, skip: set[int]) -> Body:
    """``skip``: line numbers (from 1) of furniture."""
    lines = text.split("\n")
    running = [i for i, x in enumerate(lines) if i + 1 not in skip and x.strip()]
    words: list[Word] = []
    breaks: list[tuple[int, str, int, str, bool]] = []
    compounds: list[str] = []
    after: dict[int, int] = {}
    for at, i in enumerate(running):
        line = lines[i].replace("\r", " ")
        cut = after.pop(i, 0)
        if _FIGURE.match(line) or _CHAPTER.match(line.strip()) and _title_like(line.strip()):
            continue  # a figure or a heading is no running text
        m = _LEFT.search(line) if line.rstrip()[-1:] in _ENDS else None
        follows = running[at + 1] if at + 1 < len(running) else -1
        if m and _HAS_LETTER.search(m[1]) and m.start(1) >= cut:
            right = _RIGHT.match(lines[follows]) if follows >= 0 else None
            left = re.split(r"[-‐‑]", m[1])[-1]
            if follows < 0 or right and (right[1][0].islower() or not right[1][0].isalnum() or right[1][0].isdigit()):
                breaks.append((i, left.lower(), follows, right[1].lower() if right else "", m[2] in "-‐‑"))
                keep = line[: m.end(1) - len(left)]
                words += _words_of(" " * cut + keep[cut:], i, "")
                compounds += [c.lower().replace("‐", "-").replace("‑", "-") for c in _COMPOUND.findall(keep)]
                if right:
                    words.append(Word(i, m.end(1) - len(left), m.end(2), (left + right[1]).lower(), follows))
                    after[follows] = right.end(1)
                continue
        ahead = lines[follows][:80] if follows >= 0 else ""
        words += _words_of(" " * cut + line[cut:], i, ahead)
        if "-" in line or "‐" in line or "‑" in line:
            compounds += [c.lower().replace("‐", "-").replace("‑", "-") for c in _COMPOUND.findall(line)]
    opening = _opening(lines, running)
    right = _RIGHT.match(lines[opening]) if opening >= 0 else None
    return Body(lines, running, words, breaks, right[1].lower() if right and not right[1][0].isupper() else "", compounds)


def variants(word: str) -> list[str]:
    """Words that ``word`` may stand for, one glyph edit away."""
    found = {word[:a] + to + word[a + size :] for a in range(len(word)) for size in (1, 2, 3) for to in GLYPHS.get(word[a : a + size], ())}
    return sorted(found - {word})


def _bodies(batch: pd.DataFrame) -> Iterator[tuple]:
    for page, file, n, text, skip in zip(batch["page_id"], batch["source_file"], batch["page_number"], batch["text"], batch["skip"]):
        if text:
            yield page, file, n, body(text, set() if skip is None else set(int(x) for x in skip))


def vocabulary(pages: DataFrame) -> DataFrame:
    """``word``, ``n``: words of the running text and hyphenated words, counted over all pages."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter = Counter()
        for batch in batches:
            for *_, b in _bodies(batch):
                counts.update(w.text for w in b.words)
                counts.update(b.compounds)
                counts.update(c[: c.index("-") + 1] for c in b.compounds)
            if len(counts) > 300_000:
                yield pd.DataFrame({"word": list(counts), "n": list(counts.values())})
                counts.clear()
        yield pd.DataFrame({"word": pd.Series(list(counts), dtype=object), "n": pd.Series(list(counts.values()), dtype="int64")})

    return pages.mapInPandas(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Signs:
    """Index vectors of the words met: signs from a hash of the word, times its weight. Emptied at a fixed size."""

    def __init__(self, weights: dict[str, int]) -> None:
        self.weights = weights
        self._clear()

    def _clear(self) -> None:
        self.numbers: dict[str, int] = {}
        self.table = np.zeros((0, VECTOR_SIZE), dtype=np.int8)

    def __call__(self, words: list[str]) -> np.ndarray:
        """The numbers of these words, good until the next call."""
        if len(self.numbers) > 200_000:
            self._clear()
        if new := list(dict.fromkeys(w for w in words if w not in self.numbers)):
            self.numbers.update(zip(new, range(len(self.numbers), len(self.numbers) + len(new))))
            digests = b"".join(blake2b(w.encode("utf-8", "surrogatepass"), digest_size=VECTOR_SIZE // 8).digest() for w in new)
            signs = np.unpackbits(np.frombuffer(digests, dtype=np.uint8)).reshape(-1, VECTOR_SIZE).astype(np.int8) * 2 - 1
            self.table = np.concatenate([self.table, signs * np.array([self.weights.get(w, WEIGHT) for w in new], dtype=np.int8)[:, None]])
        return np.fromiter(map(self.numbers.__getitem__, words), dtype=np.int64, count=len(words))


def weights(vocab: DataFrame) -> dict[str, int]:
    """What frequent words weigh in a context; all others weigh ``WEIGHT``."""
    total = vocab.where("not contains(word, '-')").agg(F.sum("n")).first()[0] or 0
    rows = vocab.where(~F.col("word").contains("-") & (F.col("n") > FREQUENT * total)).collect()  # at most 1 / FREQUENT words have such a share
    return {r["word"]: max(1, round(WEIGHT * (FREQUENT * total / r["n"]) ** 0.5)) for r in rows}


def vectors(pages: DataFrame, asked: DataFrame, weighed: dict[str, int]) -> DataFrame:
    """``word``, ``v``: skip-gram vectors of the words in ``asked``, over all pages."""
    spark, names = pages.sparkSession, [f"c{i}" for i in range(VECTOR_SIZE)]
    size, bits = _filter(asked)
    shared = spark.sparkContext.broadcast((bits, weighed))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits, signs = shared.value[0].view(np.uint64), Signs(shared.value[1])
        for batch in batches:
            texts: list[str] = []
            within: list[int] = []  # number of the page of each word
            for at, (*_, b) in enumerate(_bodies(batch)):
                texts += [w.text for w in b.words]
                within += [at] * len(b.words)
            if not texts:
                continue
            ids, page = signs(texts), np.array(within)
            used = np.unique(ids)
            words = dict(zip(ids.tolist(), texts))
            hit = np.array([_in_filter(words[i], bits, size) for i in used.tolist()])
            kept = used[hit]
            sums = np.zeros((len(kept), VECTOR_SIZE), dtype=np.int64)
            row = np.full(int(used[-1]) + 1, -1, dtype=np.int64)
            row[kept] = np.arange(len(kept))
            found = np.flatnonzero(row[ids] >= 0)
            for start in range(0, len(found), 1 << 15):
                at = found[start : start + (1 << 15)]
                around = np.zeros((len(at), VECTOR_SIZE), dtype=np.int64)
                for k in (*range(-CONTEXT, 0), *range(1, CONTEXT + 1)):
                    there = np.clip(at + k, 0, len(ids) - 1)
                    same = (there == at + k) & (page[there] == page[at])
                    around[same] += signs.table[ids[there[same]]]
                order = np.argsort(row[ids[at]], kind="stable")
                of = row[ids[at]][order]
                firsts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
                sums[of[firsts]] += np.add.reduceat(around[order], firsts, axis=0)
            yield pd.DataFrame(sums, columns=names).assign(word=[words[i] for i in kept.tolist()])

    made = pages.mapInPandas(run, ", ".join(f"{c} long" for c in names) + ", word string").groupBy("word").agg(*[F.sum(c).alias(c) for c in names])
    return made.join(asked, "word", "left_semi").select("word", F.array(*names).alias("v"))


def _filter(words: DataFrame) -> tuple[int, np.ndarray]:
    """Bits of the filter on these words, and the filter."""
    size = min(MOST_BITS, max(1 << 12, 1 << (FILTER_BITS * words.select("word").distinct().count()).bit_length()))
    slots = words.select(F.pmod(F.crc32(F.encode("word", "UTF-8")), F.lit(size)).alias("s"))
    filled = slots.select(F.shiftright("s", 6).cast("int").alias("w"), F.expr("shiftleft(1L, cast(s & 63 as int))").alias("bit")).groupBy("w").agg(F.bit_or("bit").alias("bits")).toArrow()  # at most MOST_BITS / 64 rows
    bits = np.zeros(size // 64, dtype=np.int64)
    bits[filled.column("w").to_numpy()] = filled.column("bits").to_numpy()
    return size, bits


def _in_filter(word: str, bits: np.ndarray, size: int) -> bool:
    x = crc32(word.encode("utf-8", "surrogatepass")) % size
    return bool(int(bits[x >> 6]) >> (x & 63) & 1)


def links(vocab: DataFrame) -> DataFrame:
    """``word``, ``n``, ``to``, ``to_n``: frequent words that a rare word may be a misreading of."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 500):  # a word has some twenty variants
                rows = [(w, n, v) for w, n in zip(batch["word"][at : at + 500], batch["n"][at : at + 500]) if 1 < len(w) <= MOST_LETTERS for v in variants(w)]
                yield pd.DataFrame(rows, columns=["word", "n", "to"])

    # a word as frequent as RATIO times the least count of nothing can't be rare: the most frequent word bounds it
    top = vocab.agg(F.max("n")).first()[0] or 0
    rare = vocab.where(F.col("n") * STRANGE_RATIO <= top).where(~F.col("word").contains("-") & F.col("word").rlike(r"\p{L}"))
    made = rare.mapInPandas(run, "word string, n long, to string")
    frequent = vocab.where(F.col("n") >= LEAST_COUNT).select(F.col("word").alias("to"), F.col("n").alias("to_n"))
    strange = F.col("word").rlike(r"[€†@($¢|!ſ]") | F.col("word").rlike(r"\d") & F.col("word").rlike(r"\p{L}")
    return made.join(frequent, "to").where(F.col("to_n") >= F.col("n") * F.when(strange, STRANGE_RATIO).otherwise(RATIO)).select("word", "n", "to", "to_n")


def _strange(word: str) -> bool:
    """Whether a word mixes letters with other signs, as no word of the language does."""
    return bool(re.search(r"[€†@($¢|!ſ]", word)) or bool(re.search(r"[^\W\d_]", word) and re.search(r"\d", word))


FOUND_SCHEMA = "page_id long, line int, start int, end int, word string, to string, shown int"


def misread(pages: DataFrame, linked: DataFrame, table: DataFrame, weighed: dict[str, int]) -> DataFrame:
    """Occurrences of linked words that a neighbour fits in context: ``FOUND_SCHEMA``; lines count from 1. ``shown`` is the line with
    the misread characters, which of a word broken over two lines may be the second. ``table``: the vectors, see ``vectors``."""
    spark = pages.sparkSession
    size, bits = _filter(linked)
    shared_bits, shared_weights = spark.sparkContext.broadcast(bits), spark.sparkContext.broadcast(weighed)

    def occurrences(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = shared_bits.value.view(np.uint64)
        known: dict[str, bool] = {}
        for batch in batches:
            out = []
            for page, _, _, b in _bodies(batch):
                texts = [w.text for w in b.words]
                for i, w in enumerate(b.words):
                    hit = known.get(w.text)
                    if hit is None:
                        if len(known) > 500_000:
                            known.clear()
                        hit = known[w.text] = _in_filter(w.text, words, size)
                    if hit:
                        out.append((page, w.line + 1, w.start, w.end, w.text, texts[max(0, i - CONTEXT) : i] + texts[i + 1 : i + 1 + CONTEXT], w.next + 1))
            yield pd.DataFrame(out, columns=["page_id", "line", "start", "end", "word", "context", "next"])

    seen = pages.mapInPandas(occurrences, "page_id long, line int, start int, end int, word string, context array<string>, next int")
    fitted = linked.join(table.select(F.col("word").alias("to"), "v"), "to", "left")
    options = fitted.groupBy("word").agg(F.collect_list(F.struct("to", "to_n", "n", "v")).alias("options"))  # at most the variants of one word
    options = options.join(table.select("word", F.col("v").alias("own")), "word", "left")

    def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        signs = Signs(shared_weights.value)
        for batch in batches:
            out = []
            ids = signs([w for context in batch["context"] for w in context])
            ends = np.cumsum([len(context) for context in batch["context"]])
            for (page, line, start, end, word, context, after, options, own_sum), until in zip(batch.itertuples(index=False), ends):
                around = signs.table[ids[until - len(context) : until]].sum(axis=0, dtype=np.int64)
                # the own vector is that of the other occurrences
                own = _cosine(around, np.asarray(own_sum) - around) if own_sum is not None and options[0]["n"] >= LEAST_COUNT else None
                best, best_score = None, -9.0
                for o in options:
                    fit = _cosine(around, np.asarray(o["v"])) if o["v"] is not None else 0.0
                    score = fit + 0.03 * np.log(o["to_n"])
                    if score > best_score:
                        best, best_score, best_fit, ratio, best_sum = o["to"], score, fit, o["to_n"] / o["n"], o["v"]
                if best is None:
                    continue
                # a word with a vector of its own must fit worse than the neighbour, or be found in the same contexts; a strange word needs no context
                alike = own is not None and best_sum is not None and _cosine(np.asarray(own_sum), np.asarray(best_sum)) > ALIKE
                if _strange(word) or own is None and (best_fit > LEAST_FIT or ratio > 200) or own is not None and (alike or best_fit > own - 0.05):
                    same = next((i for i, (a, b) in enumerate(zip(word, best)) if a != b), min(len(word), len(best)))
                    out.append((page, line, start, end, word, best, after if after and same >= end - start - 1 else line))
            yield pd.DataFrame(out, columns=[x.split()[0] for x in FOUND_SCHEMA.split(", ")])

    return seen.join(options, "word").select("page_id", "line", "start", "end", "word", "context", "next", "options", "own").mapInPandas(choose, FOUND_SCHEMA)


def _cosine(a: np.ndarray, b: np.ndarray) -> float:
    a, b = a.astype(np.float64), b.astype(np.float64)
    return float(a @ b / max(1e-6, np.sqrt((a @ a) * (b @ b))))


#: Cosine between a neighbour and the words around that it needs at least.
LEAST_FIT = -0.2
#: Cosine between the vectors of a word and a neighbour from which on they are found in the same contexts.
ALIKE = 0.4


def breaks(pages: DataFrame, vocab: DataFrame) -> DataFrame:
    """``page_id``, ``line``, ``left``, ``right``, ``at_end``: lines that end inside a word without a hyphen of its own."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for page, file, n, b in _bodies(batch):
                if b.first:
                    out.append((page, file, n, 0, "", b.first, False, False))
                for i, left, follows, right, plain in b.breaks:
                    out.append((page, file, n, i + 1, left, right, follows < 0, plain))
            yield pd.DataFrame(out, columns=["page_id", "source_file", "page_number", "line", "left", "right", "at_end", "plain"])

    found = cut_lineage(pages.mapInPandas(run, "page_id long, source_file string, page_number int, line int, left string, right string, at_end boolean, plain boolean"))
    inside = found.where("line > 0 and not at_end").select("page_id", "line", "left", "right", "plain", "at_end")
    starts = found.where("line = 0").select("source_file", (F.col("page_number") - 1).alias("page_number"), "right").dropDuplicates(["source_file", "page_number"])
    over = found.where("line > 0 and at_end").drop("right").join(starts, ["source_file", "page_number"]).select("page_id", "line", "left", "right", "plain", "at_end")
    # without a next page to be seen, a soft hyphen, or a part that is no word, still tells that the word goes on
    alone = found.where("line > 0 and at_end").drop("right").join(starts, ["source_file", "page_number"], "left_anti").select("page_id", "line", "left", F.lit("").alias("right"), "plain", "at_end")
    cases = inside.unionByName(over).unionByName(alone)
    asked = cases.select(
        "page_id", "line", "left", "right", "plain", "at_end",
        F.explode(F.array(*[F.struct(F.lit(k).alias("k"), w.alias("word")) for k, w in enumerate((F.concat("left", "right"), F.concat_ws("-", "left", "right"), F.col("left"), F.col("right"), F.concat("left", F.lit("-"))))])).alias("a"),
    ).select("page_id", "line", "left", "right", "plain", "at_end", "a.k", "a.word")
    counted = asked.join(vocab, "word", "left").groupBy("page_id", "line", "left", "right", "plain", "at_end").agg(
        *[F.max(F.when(F.col("k") == k, F.coalesce("n", F.lit(0)))).alias(c) for k, c in enumerate(("joined", "hyphened", "l", "r", "before"))]
    )
    # the joined word has been counted once for this very break
    joined = F.col("joined") > 1
    compound = (F.col("hyphened") > 0) & (F.col("hyphened") >= F.col("joined") - 1)
    alike = (F.col("hyphened") == 0) & ~joined & ((F.col("l") >= LEAST_COUNT) & (F.col("r") >= LEAST_COUNT) & F.col("plain") | (F.col("before") >= LEAST_COUNT))
    own = F.when(F.col("right") == "", F.col("plain") & (F.col("l") >= LEAST_COUNT)).otherwise(compound | alike)
    return counted.where(~own).select("page_id", "line", "left", "right", "at_end")


@dataclass
class Noise:
    """``pages`` with ``skip``, the lines of furniture; ``furniture``, ``misread`` and ``breaks`` as the functions of these names give them."""

    pages: DataFrame
    furniture: DataFrame
    misread: DataFrame
    breaks: DataFrame


def find_noise(extracted_pages: DataFrame) -> Noise:
    """All noise of all pages."""
    pages = once(extracted_pages.select(F.col("page_id").cast("bigint").alias("page_id"), "source_file", F.col("page_number").cast("int").alias("page_number"), "text").where("page_id is not null"), "page_id")
    around = cut_lineage(furniture(pages))
    skip = around.groupBy("page_id").agg(F.collect_set("line").alias("skip"))  # at most 2 EDGE lines
    clean = cut_lineage(pages.join(skip, "page_id", "left"))
    vocab = cut_lineage(vocabulary(clean))
    linked = cut_lineage(links(vocab))
    broken = cut_lineage(breaks(clean, vocab))
    # the rest of a word that the page before broke off is no word of its own
    over = broken.where("at_end and right <> ''").join(clean.select("page_id", "source_file", "page_number"), "page_id")
    rests = over.select("source_file", (F.col("page_number") + 1).alias("page_number"), F.col("right").alias("word")).join(clean.select("page_id", "source_file", "page_number"), ["source_file", "page_number"])
    weighed = weights(vocab)
    asked = linked.select("word").union(linked.select("to")).distinct()
    wrong = misread(clean, linked, cut_lineage(vectors(clean, asked, weighed)), weighed)
    wrong = wrong.join(rests.select("page_id", "word", F.lit(0).alias("start")).distinct(), ["page_id", "word", "start"], "left_anti").select(*wrong.columns)
    return Noise(clean, around, wrong, broken)


def noise_lines(noise: Noise) -> DataFrame:
    """``page_id``, ``line_no``, ``noise``: one row for each line and kind."""
    parts = (
        noise.furniture.select("page_id", "line", "noise"),
        noise.misread.select("page_id", F.col("shown").alias("line"), F.lit(MISREAD).alias("noise")),
        noise.breaks.select("page_id", "line", F.lit(HYPHENATION).alias("noise")),
    )
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).distinct().withColumnRenamed("line", "line_no")


def _case(to: str, original: str) -> str:
    letters = [c for c in original if c.isalpha()]
    if len(letters) > 1 and all(c.isupper() for c in letters):
        return to.upper()
    return to[0].upper() + to[1:] if original[:1].isupper() else to


_LIST_LINE = re.compile(r"^\s*(?:[-*•]|\d{1,2}[.)])\s")


def repair(text: str, skip: set[int], joins: dict[int, str], fixes: list[tuple[int, int, int, str]], goes_on: bool = False) -> str:
    """The running text as paragraphs, one to a line, parted by an empty line.

    ``joins``: line -> the part of the word on the next line or page; ``fixes``: line, start, end, word; ``goes_on``: the page opens with
    the rest of a word that the page before has."""
    lines = [x.replace("\r", "") for x in text.split("\n")]
    b = body(text, skip)
    glued = {i: (follows, right) for i, _, follows, right, _ in b.breaks}
    by_line: dict[int, list[tuple[int, int, str]]] = {}
    taken: dict[int, int] = {}
    for line, start, end, to in fixes:
        by_line.setdefault(line - 1, []).append((start, end, to))
    opening = _opening(lines, b.running)
    if goes_on and opening >= 0 and (r := _RIGHT.match(lines[opening])):
        taken[opening] = r.end(1)
    paragraphs: list[str] = []
    open_, last = "", -2
    for i in b.running:
        x, cut = lines[i], taken.pop(i, 0)
        end_part, whole = "", None
        m = _LEFT.search(x)
        if i in glued and m:
            left = re.split(r"[-‐‑]", m[1])[-1]
            at = m.end(1) - len(left)
            follows, _ = glued[i]
            r = _RIGHT.match(lines[follows]) if follows >= 0 else None
            if i + 1 in joins:
                source = left + (r[1] if r else joins[i + 1])
                fix = next((f for f in by_line.get(i, []) if f[0] == at and f[1] == m.end(2)), None)
                end_part, whole = _case(fix[2], source) if fix else source, at
            elif r:
                end_part, whole = x[at : m.end(1)] + "-" + r[1], at
            if r and whole is not None:
                taken[follows] = r.end(1)
        for start, end, to in sorted(by_line.get(i, []), reverse=True):
            if start >= cut and (whole is None or end <= whole):
                x = x[:start] + _case(to, x[start:end]) + x[end:]
                if whole is not None:
                    whole += len(to) - (end - start)
        if whole is not None:
            x = x[:whole] + end_part
        x = x[cut:].rstrip() if cut and open_ else x[cut:].strip()
        heading = _CHAPTER.match(x) is not None and _title_like(x)
        fresh = last >= 0 and any(not lines[j].strip() for j in range(last + 1, i)) or heading
        if open_ and (fresh or _LIST_LINE.match(x)) and not cut:
            paragraphs.append(open_)
            open_ = x
        else:
            open_ = x if not open_ else open_ + ("" if cut else " ") + x
        if heading:
            paragraphs.append(open_)
            open_ = ""
        last = i
    if open_:
        paragraphs.append(open_)
    return "\n\n".join(p.strip() for p in paragraphs)


def repaired_pages(noise: Noise) -> DataFrame:
    """``page_id``, ``text``: each page as continuous paragraphs. A word over the page end is whole on the page where it begins."""
    joins = noise.breaks.groupBy("page_id").agg(F.map_from_entries(F.collect_set(F.struct("line", "right"))).alias("joins"))
    fixes = noise.misread.groupBy("page_id").agg(F.collect_list(F.struct("line", "start", "end", "to")).alias("fixes"))
    over = noise.breaks.where("at_end and right <> ''").join(noise.pages.select("page_id", "source_file", "page_number"), "page_id")
    goes_on = over.select("source_file", (F.col("page_number") + 1).alias("page_number"), F.lit(True).alias("goes_on")).distinct()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for page, text, skip, joined, fixed, on in zip(batch["page_id"], batch["text"], batch["skip"], batch["joins"], batch["fixes"], batch["goes_on"]):
                fixed = [] if fixed is None else [(int(f["line"]), int(f["start"]), int(f["end"]), f["to"]) for f in fixed]
                lines = set() if skip is None else {int(v) for v in skip}
                out.append((page, None if text is None else repair(text, lines, {int(k): v for k, v in (joined or [])} if not isinstance(joined, dict) else {int(k): v for k, v in joined.items()}, fixed, bool(on))))
            yield pd.DataFrame(out, columns=["page_id", "text"])

    pages = noise.pages.join(joins, "page_id", "left").join(fixes, "page_id", "left").join(goes_on, ["source_file", "page_number"], "left")
    return pages.select("page_id", "text", "skip", "joins", "fixes", F.coalesce("goes_on", F.lit(False)).alias("goes_on")).mapInPandas(run, "page_id long, text string")
