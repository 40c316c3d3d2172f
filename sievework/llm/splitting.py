"""Splitting oversized items at natural boundaries, by packing a tree of the text's structure.

The text is read as a tree: sections under headings (by depth, Markdown and HTML), HTML elements (by nesting), blocks parted by
empty lines (a fenced block is one, a heading belongs to the block below it), list items (by indentation), table rows and lines of
code, sentences, clauses, words. Every node is a span of the text, and the children of a node cover it without gaps.

Packing goes bottom-up. Children that fit are merged with their siblings as long as the piece stays within the limit; only a
node that is larger than a piece is entered, and what it is cut into is never joined with what stands beside it. So a
piece is a node or a run of siblings, and the boundary of a node that was entered is always a cut. Words are entered only
where one is longer than a whole piece: at a change from ASCII letters and digits to something else if there is one
(a "natural" cut still), else in the run itself (a "forced" cut).

Each piece after the first begins ``overlap`` characters before the end of the one before, so its own part has at most
``max_size - overlap`` characters. Where a word is longer than that but not longer than ``max_size``, it is kept whole and
the overlap before it shrinks to what fits. Sizes are code points. Cutting off the overlaps and joining the pieces gives
the text back, character by character.

Defined results: null and empty texts have no pieces; a text within the limit is one piece; blank text is text; trailing
white space belongs to the piece before it; rows that repeat a key count once if the caller asks (the queries do), rows without one not at all;
other columns are left out. Texts of any length are handled whole, in time proportional to their length.
"""

from __future__ import annotations

import bisect
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

PIECES_SCHEMA = "item_kind string, item_key string, piece int, from_char int, to_char int, overlap int, cut string, text string"
NATURAL, FORCED = "natural", "forced"

_HEADING = re.compile(r"^(#{1,6})[ \t]+\S[^\n]*|^(?:chapter|part|section)[ \t]+[\divxlc]+\b[^.\n]{0,80}$", re.I | re.M)
_FENCE = re.compile(r"^(`{3,}|~{3,})[^\n]*\n.*?(?:^\1[`~]*[ \t]*(?:\n|\Z)|\Z)", re.M | re.S)
_EMPTY_LINE = re.compile(r"\n[ \t\r]*\n\s*")
_ITEM = re.compile(r"^([ \t]*)(?:[-*+•·‣▪–][ \t]+|\(?(?:\d{1,3}|[a-z])[.)][ \t]+)", re.M | re.I)
_ROW = re.compile(r"^[ \t]*\|", re.M)
_TAG = re.compile(r"<(/?)(h[1-6]|p|div|li|tr|td|th|dl|dt|dd|ul|ol|table|thead|tbody|section|article|main|aside|nav|header|footer|figure|pre|blockquote)\b[^<>]*>", re.I)
#: Elements that end where the next of their kind begins.
_CLOSED_BY_THE_NEXT = frozenset(("p", "li", "tr", "td", "th", "dt", "dd"))
#: Levels of nested elements and of indentation that are told apart; deeper ones count as the last.
NESTED = 40
_LINE = re.compile(r"\n")
_SENTENCE = re.compile(r"[.!?…](?:[\"'”’)\]»]*)\s+(?=[^\sa-zß-öø-ÿ])|[。！？](?:[」』”）]*)\s*")
_CLAUSE = re.compile(r"[,;:](?=\s)\s+|[、，；：]\s*|\s[–—]\s|[}\]],\s*")
_BLANK = re.compile(r"\s+")
_RUN = re.compile(r"[A-Za-z0-9]+")


class Tree:
    """The structure of one text. A node is a span on a level; its children are made when it is entered."""

    def __init__(self, text: str):
        self.text = text
        fences = [m.span() for m in _FENCE.finditer(text)]
        starts = [s for s, _ in fences]
        fenced = lambda p: (i := bisect.bisect_right(starts, p) - 1) >= 0 and fences[i][0] < p < fences[i][1]
        headings: dict[int, list[int]] = {}
        heading_ends: set[int] = set()
        for m in _HEADING.finditer(text):
            if not fenced(m.start()):
                headings.setdefault(len(m[1]) if m[1] else 1, []).append(m.start())
                heading_ends.add(len(text[: m.end()].rstrip()) if m[0][-1].isspace() else m.end())
        elements = self._elements(fenced, headings)
        blocks = {m.end() for m in _EMPTY_LINE.finditer(text) if m.start() not in heading_ends and not fenced(m.start())} | {p for span in fences for p in span}
        items: dict[int, list[int]] = {}
        for m in _ITEM.finditer(text):
            if not fenced(m.start()):
                items.setdefault(len(m[1].expandtabs(4)), []).append(m.start())
        by_indent = self._leveled(items)
        rows = [m.start() for m in _ROW.finditer(text)] + [m.end() for s, e in fences for m in _LINE.finditer(text, s, e)]
        self.levels = [*self._leveled(headings), *self._leveled(elements), sorted(blocks), *by_indent, sorted(rows)]
        self.depth = len(self.levels) + 3

    @staticmethod
    def _leveled(by: dict[int, list[int]]) -> list[list[int]]:
        """Boundaries by level. A boundary parts the nodes of its own level only: on a deeper one it is the node's edge already."""
        order = sorted(by)
        merged = [by[k] for k in order[: NESTED - 1]]
        if rest := [p for k in order[NESTED - 1 :] for p in by[k]]:
            merged.append(rest)
        return [sorted(x) for x in merged]

    def _elements(self, fenced, headings: dict[int, list[int]]) -> dict[int, list[int]]:
        """Where elements begin and end, by nesting; headings outside all of them begin sections instead."""
        out: dict[int, list[int]] = {}
        stack: list[str] = []
        for m in _TAG.finditer(self.text):
            name = m[2].lower()
            if fenced(m.start()):
                continue
            if not m[1]:
                if stack and stack[-1] == name and name in _CLOSED_BY_THE_NEXT:
                    stack.pop()
                if name[0] == "h" and name[1:].isdigit() and not stack:
                    headings.setdefault(int(name[1:]), []).append(m.start())
                else:
                    out.setdefault(len(stack), []).append(m.start())
                stack.append(name)
            elif name in stack:
                while stack.pop() != name:
                    pass
                if not (name[0] == "h" and name[1:].isdigit()):  # what follows a heading belongs to it
                    out.setdefault(len(stack), []).append(m.end())
        return out

    def children(self, a: int, b: int, level: int) -> list[int]:
        """Ends of the children of the span a to b."""
        if level < len(self.levels):
            at = self.levels[level]
            inside = at[bisect.bisect_right(at, a) : bisect.bisect_left(at, b)]
        else:
            pattern = (_SENTENCE, _CLAUSE, _BLANK)[level - len(self.levels)]
            inside = [p for m in pattern.finditer(self.text, a, b) if a < (p := m.end()) < b]
        return [*inside, b]


def _glued(text: str, p: int) -> bool:
    """Whether a cut at p would part one character from its accents or joiners."""
    return p < len(text) and (unicodedata.combining(text[p]) != 0 or text[p] in "‍️" or text[p - 1] == "‍")


def split_text(text: str, max_size: int, overlap: int) -> list[tuple[int, int, int, str]]:
    """(start, end, overlap with the piece before, kind of the cut at the end) of each piece; start counts the overlap."""
    if not 0 <= overlap < max_size:
        raise ValueError("overlap must be at least 0 and less than the limit")
    n = len(text)
    if n <= max_size:
        return [(0, n, 0, NATURAL)] if n else []
    tree, room = Tree(text), max_size - overlap
    most = lambda a: room if a else max_size  # only the first piece has no overlap before it
    own: list[tuple[int, int, str]] = []  # begin, end and cut of each piece's own part

    def word(a: int, b: int) -> None:
        """A word that is longer than a piece's own part."""
        if b - a <= max_size:
            own.append((a, b, NATURAL))
            return
        at = a
        while b - at > most(at):
            stop = end = at + most(at)
            while end > at and (_glued(text, end) or _alnum(text, end)):
                end -= 1
            kind = NATURAL
            if end == at:
                run = _RUN.match(text, at)
                if run and at < run.end() <= at + max_size:
                    end = run.end()  # the run fits into a piece of its own
                else:
                    end, kind = stop, FORCED if _alnum(text, stop) else NATURAL
            own.append((at, end, kind))
            at = end
        if at < b:
            own.append((at, b, NATURAL))

    def pack(a: int, b: int, level: int) -> None:
        """Pieces of a node that is larger than one."""
        while len(ends := tree.children(a, b, level)) == 1:
            level += 1
            if level == tree.depth:
                return word(a, b)
        begin = a  # of the run of siblings that is open
        for end in ends:
            if end - a > most(a):
                if a > begin:
                    own.append((begin, a, NATURAL))
                pack(a, end, level + 1) if level + 1 < tree.depth else word(a, end)
                begin = end
            elif end - begin > most(begin):
                own.append((begin, a, NATURAL))
                begin = a
            a = end
        if b > begin:
            own.append((begin, b, NATURAL))

    pack(0, n, 0)
    return [(a - before, b, before, kind) for i, (a, b, kind) in enumerate(own) for before in [min(overlap, max_size - (b - a)) if i else 0]]


def _alnum(text: str, p: int) -> bool:
    """Whether the characters on both sides of p are ASCII letters or digits."""
    return 0 < p < len(text) and text[p - 1].isascii() and text[p - 1].isalnum() and text[p].isascii() and text[p].isalnum()


def split_items(df: DataFrame, item_kind: str, max_size: int, overlap: int, key: str, text: str = "text") -> DataFrame:
    """All pieces of all items. One narrow stage; ``cut`` is the kind of the cut at the end of the piece."""
    items = df.select(F.col(key).cast("string").alias("k"), F.col(text).alias("t")).where("k is not null and t is not null and t <> ''")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for k, t in zip(batch["k"], batch["t"]):
                for i, (a, b, before, kind) in enumerate(split_text(t, max_size, overlap)):
                    out.append((item_kind, k, i, a, b, before, kind, t[a:b]))
            yield pd.DataFrame(out, columns=["item_kind", "item_key", "piece", "from_char", "to_char", "overlap", "cut", "text"])

    return items.mapInPandas(run, PIECES_SCHEMA)


def oversized_items(pieces: DataFrame) -> DataFrame:
    """``item_kind``, ``item_key``, ``cut`` of the items that were cut: forced if one of their cuts is."""
    return (
        pieces.groupBy("item_kind", "item_key")
        .agg(F.max("piece").alias("last"), F.max((F.col("cut") == FORCED).cast("int")).alias("forced"))
        .where("last > 0")
        .select("item_kind", "item_key", F.when(F.col("forced") == 1, FORCED).otherwise(NATURAL).alias("cut"))
    )
