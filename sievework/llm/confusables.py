"""Visually identical text with different characters.

Each text is brought to one form in which texts that look the same are equal:

1. Characters without a visible shape go (those that Unicode calls default ignorable, and annotation marks; joiners and emoji
   selectors stay where they shape a glyph: between pictographs, and beside letters of scripts with joining forms; tags stay
   behind a flag), line ends become "\\n".
2. Blanks of every width become a plain blank; full-width and half-width forms, ligatures, Roman numerals and hyphens of one look
   become their plain form. Raised, circled, or styled figures stay, for a reader sees them.
3. In each run of letters every letter has a set of scripts in which its shape exists. The sets of a run are
   intersected (the resolved script set). A run whose letters come from several scripts, or whose whole run could
   be spelled in another script, is confusable; it is respelled in the one script that fits: the resolved set if it
   has one member, else the script that leads among the letters of the text that exist in one script only.
   Only shapes enter this choice, so two texts of one look are always respelled alike.
4. Letters and accents are composed (NFC).

Shapes. ``unicode_shapes`` reads them from the Unicode Consortium's data on confusable characters, in the ICU library that Spark ships:
letters of all scripts up to U+1FFFF whose prototype is one letter that letters of two scripts share (with the data of Spark 4.1, 298
letters of 26 scripts that look like an ASCII letter, 513 of 39 scripts in all). Left out, as a reader tells them apart or lays them out otherwise: scripts
written from right to left, Chinese, Japanese and Korean, styled letters, Latin letters with other shapes than the plain ones, and
the small Greek letters but four. ``BASE`` has the Cyrillic, Greek and Armenian letters that look like Latin ones; it takes precedence, and
serves where there is no session.

Defined results: a null text gives null; an empty text stays empty; a text without a visible character gives "".
Very long texts are handled whole, in one pass. Forms keep repeated rows; pairs count a key once and leave rows without one out.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
import regex as re
from pyspark.sql import DataFrame, SparkSession, functions as F

from sievework.runtime import cut_lineage

#: Letters that look like a Latin letter, by script. Fixed values.
CYRILLIC_LIKE_LATIN = {
    "а": "a", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s",
    "ԝ": "w", "х": "x", "у": "y", "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K",
    "М": "M", "О": "O", "Р": "P", "Ԛ": "Q", "Ѕ": "S", "Т": "T", "Ԝ": "W", "Х": "X", "Ү": "Y", "ӏ": "l", "Ӏ": "I", "ѵ": "v",
    "Ѵ": "V", "Ԍ": "G", "ү": "y",
}
GREEK_LIKE_LATIN = {
    "ο": "o", "ν": "v", "ϲ": "c", "ϳ": "j", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K",
    "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "Ϲ": "C", "Ϳ": "J",
}
ARMENIAN_LIKE_LATIN = {"օ": "o", "ս": "u", "հ": "h", "ց": "g", "Օ": "O", "Ս": "U", "Լ": "L"}
#: Latin letters and other signs that look like a plain Latin letter.
LATIN_LIKE_LATIN = {"ɡ": "g", "ɑ": "a", "ꞌ": "'"}
#: Small Greek letters that look like a Latin one. Fixed values.
GREEK_SMALL = "ονϲϳ"
#: Hyphens of one look and width.
HYPHENS = "‐‑﹣－"

LATIN, CYRILLIC, GREEK, ARMENIAN = "Latin", "Cyrillic", "Greek", "Armenian"
#: A tie between scripts goes to the first; others follow by name.
SCRIPT_ORDER = (LATIN, CYRILLIC, GREEK, ARMENIAN)
#: Writing systems that use several scripts together, as Unicode's augmented script sets have them.
AUGMENTED = {"Han": ("Japanese", "Korean", "Chinese with Bopomofo"), "Hiragana": ("Japanese",), "Katakana": ("Japanese",), "Hangul": ("Korean",), "Bopomofo": ("Chinese with Bopomofo",)}
_EAST = frozenset(AUGMENTED)


def _place(script: str) -> tuple[int, str]:
    return (SCRIPT_ORDER.index(script) if script in SCRIPT_ORDER else len(SCRIPT_ORDER), script)


@lru_cache(maxsize=1 << 10)
def _property(script: str) -> re.Pattern | None:
    try:
        return re.compile(r"\p{Script=%s}" % script)
    except re.error:
        return None


@lru_cache(maxsize=1 << 16)
def script_of(ch: str) -> str | None:
    """The script of a letter, as Unicode's property has it; None for what belongs to every script.

    The name of a letter has its script among the first words; the property then decides."""
    if not ch.isalpha():
        return None
    words = re.findall(r"[A-Z]+", unicodedata.name(ch, ""))[:4]
    names = [w.title() for w in words] + ["_".join((a.title(), b.title())) for a, b in zip(words, words[1:])]
    for name in (*names, LATIN, GREEK, CYRILLIC, "Han", "Canadian_Aboriginal", "Katakana", "Hangul", "Arabic"):
        if (p := _property(name)) and p.match(ch):
            return name
    return None if re.match(r"\p{Script=Common}|\p{Script=Inherited}", ch) else "Unknown"


@dataclass(frozen=True)
class Shapes:
    """Letter -> its shape, and shape -> script -> the letter of this script."""

    shape: dict[str, str]
    spelled: dict[str, dict[str, str]]

    def scripts(self, ch: str) -> frozenset[str] | None:
        """The scripts in which the shape of a letter exists; None for what belongs to every script."""
        if (own := script_of(ch)) is None:
            return None
        shape = self.shape.get(ch, ch)
        found = frozenset(self.spelled[shape]) if shape in self.spelled else frozenset((own,))
        return found.union(*(AUGMENTED.get(x, ()) for x in found)) if found & _EAST else found


def _base() -> Shapes:
    shape: dict[str, str] = {}
    spelled: dict[str, dict[str, str]] = {}
    for script, table in ((CYRILLIC, CYRILLIC_LIKE_LATIN), (GREEK, GREEK_LIKE_LATIN), (ARMENIAN, ARMENIAN_LIKE_LATIN)):
        for letter, latin in table.items():
            shape[letter] = latin
            spelled.setdefault(latin, {LATIN: latin}).setdefault(script, letter)
    return Shapes(shape, spelled)


BASE = _base()
_READ: dict[str, Shapes] = {}


def _may_stand(ch: str, prototype: str) -> bool:
    """Whether a letter is compared by shape at all; see the module."""
    script = script_of(ch)
    if script in (None, "Unknown") or script in _EAST or unicodedata.bidirectional(ch) in ("R", "AL") or unicodedata.decomposition(ch):
        return False
    if script == LATIN:
        return ch == prototype
    return script != GREEK or ch.isupper() or ch in GREEK_SMALL


def unicode_shapes(spark: SparkSession) -> Shapes:
    """``BASE`` and the letters that Unicode's data call confusable, read once for each application: one call, a table of a fixed size."""
    application = spark.sparkContext.applicationId
    if application not in _READ:
        letters = [c for c in map(chr, range(0x41, 0x20000)) if unicodedata.category(c)[0] == "L"]
        checker = spark._jvm.com.ibm.icu.text.SpoofChecker.Builder().build()
        prototypes = checker.getSkeleton("\n".join(letters)).split("\n")
        shape, spelled = dict(BASE.shape), {k: dict(v) for k, v in BASE.spelled.items()}
        classes: dict[str, list[str]] = {}
        for ch, to in zip(letters, prototypes):
            if to == "l":  # the data don't part the capital I from the small l
                to = "I" if ch.isupper() or script_of(ch) == "Lisu" else "l"
            if ch not in shape and len(to) == 1 and (ch != to or to.isascii()) and _may_stand(ch, to):
                classes.setdefault(to, []).append(ch)
        for to, members in classes.items():
            if to not in spelled and _may_stand(to, to):
                members = [to, *(c for c in members if c != to)]
            scripts = {script_of(c) for c in members} | set(spelled.get(to, ()))
            if len(scripts) > 1:
                for c in members:
                    if c != to:
                        shape[c] = to
                    spelled.setdefault(to, {}).setdefault(script_of(c), c)
        _READ[application] = Shapes(shape, spelled)
    return _READ[application]


@lru_cache(maxsize=1 << 16)
def _plain(ch: str) -> str:
    """Step 1 and 2 for one character."""
    if _INVISIBLE.match(ch):
        return ""
    if ch in HYPHENS:
        return "-"
    if unicodedata.category(ch) == "Zs":
        return " "
    if ch in LATIN_LIKE_LATIN:
        return LATIN_LIKE_LATIN[ch]
    if ch in BASE.shape:  # the lunate sigma stands for itself here, not for the common one
        return ch
    kind, _, rest = unicodedata.decomposition(ch).partition(" ")
    if kind in ("<wide>", "<narrow>", "<noBreak>") or kind == "<compat>" and unicodedata.category(ch) in ("Ll", "Lu", "Lt", "Nl", "Po"):
        return "".join(_plain(chr(int(x, 16))) for x in rest.split())
    return ch


#: Default ignorable characters but the joiners and emoji selectors, which are handled apart; and the marks of annotations.
_INVISIBLE = re.compile(r"(?![‌‍︎️])[\p{Default_Ignorable_Code_Point}\ufff9-\ufffb]")
_JOINER = re.compile("[‌‍︎️]")
_FLAG = re.compile("(\U0001f3f4[\U000e0020-\U000e007e]+\U000e007f)")
_ODD = re.compile(r"[^\x09\x0a\x20-\x7e]")
_BLANK_END = re.compile(r"[ \t]+(?=\n|\Z)")


def _joiner_stays(text: str, i: int) -> bool:
    before, after = text[i - 1 : i], text[i + 1 : i + 2]
    if text[i] in "︎️":
        return bool(before) and unicodedata.category(before) in ("So", "Sm", "Po", "Nd") and before not in ".,;:!?"
    pictograph = lambda c: bool(c) and (unicodedata.category(c) in ("So", "Sk") or c == "️")
    if text[i] == "‍" and pictograph(before) and pictograph(after):
        return True
    joining = lambda c: bool(c) and c.isalpha() and 0x0600 <= ord(c) <= 0x1CFF and not 0x10A0 <= ord(c) <= 0x11FF
    return joining(before) and joining(after)


_RUN = re.compile(r"[^\W\d_](?:[^\W\d_]|[̀-ͯ])*")


def resolved_scripts(run: str, shapes: Shapes = BASE) -> frozenset[str] | None:
    """The scripts in which the whole run can be spelled without a change of look; None if no letter decides."""
    left: frozenset[str] | None = None
    for scripts in map(shapes.scripts, run):
        if scripts is not None:
            left = scripts if left is None else left & scripts
    return left


def kind_of_run(run: str, shapes: Shapes = BASE) -> str:
    """mixed: its letters come from several scripts; whole: one script, but it can be spelled in another; single: neither.

    Scripts that one writing system uses together, as Japanese does, are no mix."""
    left: frozenset[str] | None = None
    for own in filter(None, map(script_of, run)):
        scripts = frozenset((own, *AUGMENTED.get(own, ())))
        left = scripts if left is None else left & scripts
    if left is not None and not left:
        return "mixed"
    resolved = resolved_scripts(run, shapes)
    return "whole" if resolved is not None and len(resolved - set().union(*AUGMENTED.values())) > 1 else "single"


def _leading(counts: Counter, among: frozenset[str] | None = None) -> str:
    """The script with the most letters; ties by ``SCRIPT_ORDER``."""
    return min(among or {*counts, *SCRIPT_ORDER}, key=lambda s: (-counts[s], _place(s)))


def _respell(run: str, leading: str, shapes: Shapes) -> str:
    ambiguous = [shapes.shape.get(c, c) for c in run]
    if not any(s in shapes.spelled for s in ambiguous):
        return run
    scripts = resolved_scripts(run, shapes)
    if scripts is None:
        return run
    if len(scripts) == 1:
        to = next(iter(scripts))
    elif scripts:
        to = leading if leading in scripts else _leading(Counter(), scripts)
    else:  # letters of several scripts that exist in one script each: the run keeps them, its ambiguous letters go with the most
        to = _leading(Counter(script_of(c) for c, s in zip(run, ambiguous) if script_of(c) and s not in shapes.spelled))
    return "".join(shapes.spelled[s].get(to, s) if s in shapes.spelled else c for c, s in zip(run, ambiguous))


def normal_form(text: str | None, shapes: Shapes = BASE) -> str | None:
    """The one form of all texts that look like this one."""
    if text is None:
        return None
    text = text.replace("\r\n", "\n").replace("\r", "\n")
    if not text.isascii():
        text = unicodedata.normalize("NFC", text)
        if _JOINER.search(text):
            text = "".join(c for i, c in enumerate(text) if c not in "‌‍︎️" or _joiner_stays(text, i))
        plain = lambda x: _ODD.sub(lambda m: _plain(m[0]), x)
        text = "".join(x if i % 2 else plain(x) for i, x in enumerate(_FLAG.split(text))) if "\U000e007f" in text else plain(text)
        if not text.isascii():
            text = unicodedata.normalize("NFD", text)
            sure: Counter = Counter()
            for ch, n in Counter(text).items():
                if shapes.shape.get(ch, ch) not in shapes.spelled and (own := script_of(ch)):
                    sure[own] += n
            leading = _leading(sure)
            seen: dict[str, str] = {}

            def one(m: re.Match) -> str:
                run = m[0]
                if run not in seen:
                    seen[run] = _respell(run, leading, shapes)
                return seen[run]

            text = unicodedata.normalize("NFC", _RUN.sub(one, text))
    text = _BLANK_END.sub("", text).strip("\n")
    return text if any(not c.isspace() and unicodedata.category(c)[0] not in "CZ" for c in text) else ""


def with_normal_form(df: DataFrame, text: str = "text", out: str = "form") -> DataFrame:
    """``df`` with a column ``out``: the one form of ``text``. A column ``out`` of ``df`` is replaced.

    Null gives null, a text without a visible character gives ""."""
    shapes = unicode_shapes(df.sparkSession)  # a table of a fixed size

    @F.pandas_udf("string")
    def form(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda t: normal_form(t, shapes), na_action="ignore")

    return df.withColumn(out, form(F.col(text)))


def same_look_keys(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``look`` (digest of the form), ``stored`` (digest of the text as stored), for texts with a visible character.

    Only digests leave the Python worker, so nothing but 40 bytes a row is shuffled later."""
    from hashlib import blake2b

    shapes = unicode_shapes(df.sparkSession)  # a table of a fixed size

    @F.pandas_udf("look binary, stored binary")
    def digests(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        digest = lambda t: blake2b(t.encode("utf-8", "surrogatepass"), digest_size=16).digest()
        for batch in batches:
            looks, stored = [], []
            for t in batch:
                form = normal_form(t, shapes)
                looks.append(digest(form) if form else None)
                stored.append(digest(t) if form else None)
            yield pd.DataFrame({"look": looks, "stored": stored})

    d = digests(F.col("_text"))
    return (
        df.select(F.col(key).alias("_key"), F.col(text).alias("_text")).select(F.col("_key").alias(key), d.alias("_d")).select(key, "_d.look", "_d.stored").where(F.col("look").isNotNull() & F.col(key).isNotNull())
    )


def same_look_classes(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document that looks like a document stored otherwise: ``key``, ``look``, ``stored``.

    Exact copies alone are no case, so a hot group of copies is gone before any join: the classes are found by an
    aggregate with a partial step, and only classes with at least two stored spellings stay."""
    keys = cut_lineage(same_look_keys(df, key, text).dropDuplicates([key]))  # read twice below; the forms are made once
    several = keys.groupBy("look").agg(F.min("stored").alias("_a"), F.max("stored").alias("_b")).where("_a <> _b").select("look")
    return keys.join(several, "look", "left_semi")


#: Documents of one spelling that meet in one task.
COPIES = 1000


def same_look_pairs(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``_a, ``key``_b (smaller first): documents that differ as stored and look the same.

    The spellings of a look are paired first, one row for each, and their documents joined afterwards, dealt to as many tasks as a
    spelling has ``COPIES``; so the work is in proportion to the result, and copies of one spelling never meet."""
    members = cut_lineage(same_look_classes(df, key, text).select("look", "stored", F.col(key).alias("k")))
    spellings = members.groupBy("look", "stored").agg(F.ceil(F.count("*") / COPIES).cast("int").alias("salts"))
    a = spellings.select("look", F.col("stored").alias("stored_a"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt_a"))
    b = spellings.select("look", F.col("stored").alias("stored_b"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt_b"))
    met = a.join(b, "look").where("stored_a < stored_b")
    dealt = members.join(spellings, ["look", "stored"]).select("look", "stored", F.pmod(F.xxhash64("k"), "salts").cast("int").alias("salt"), "k")
    side = lambda x: dealt.select("look", F.col("stored").alias(f"stored_{x}"), F.col("salt").alias(f"salt_{x}"), F.col("k").alias(f"k{x}"))
    pairs = met.join(side("a"), ["look", "stored_a", "salt_a"]).join(side("b"), ["look", "stored_b", "salt_b"])
    return pairs.select(F.least("ka", "kb").alias(f"{key}_a"), F.greatest("ka", "kb").alias(f"{key}_b"))
