"""One form for texts that look alike, and the rows whose texts look alike without being equal.

Each letter has a script set: the scripts in which a letter of its look exists. The sets of a token's letters are
intersected. One script left: the token is spelt in it, whatever its letters were. Several left (a whole-script
confusable): the token is spelt in the script that most of the text's other letters tell, Latin if they tell none.
None left (a mixed-script token): the letters that have a choice follow the script that fits most letters. All this
depends on looks only, never on how a text was coded, so texts that look alike get one form. What remains (full-width and
half-width forms, mathematical letters, ligatures, number signs, composed and decomposed accents, blanks of all widths,
invisible characters) is normalised by rule without touching anything that can be told apart by eye: raised and lowered
figures, Greek alpha, case and accents stay.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellumine.sources.tables import settled

# Letters drawn like a Latin letter, by script, each above its Latin look-alike (of the public Unicode
# confusables data those that the eye cannot tell apart in upright type).
LETTERS = {
    "CYRILLIC": ("аеорсухѕіјһԁԛԝӏѵ" "АВЕЅІЈКМНОРСТХԌԚԜҮѴ",
                 "aeopcyxsijhdqwlv" "ABESIJKMHOPCTXGQWYV"),
    "GREEK": ("ονϳϲ" "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹϜͿ",
              "ovjc" "ABEZHIKMNOPTYXCFJ"),
    "ARMENIAN": ("օոսհցզյ" "ՕՏՍԼ",
                 "onuhgqj" "OSUL"),
    "CHEROKEE": ("ᎠᎡᎢᎪᎫᎬᎳᎷᎻᎽᏀᏃᏢᏙᏚᏞᏟᏦᏴᎵ",
                 "DRTAJEWMHYGZPVSLCKBd"),
    "COPTIC": ("ⲟⲥⲣ" "ⲎⲔⲚⲞⲢⲤⲦⲬ",
               "ocp" "HKNOPCTX"),
}
# Characters drawn like one of another name, that decomposition leaves apart.
ALIKE = {"µ": "μ", "‐": "-", "‑": "-", "ʹ": "'", "․": ".", "ɡ": "g", "ɑ": "a", "∕": "/", "⁄": "/", "∶": ":", "∣": "|", "ǀ": "|", "ꞌ": "'", "ߺ": "_"}
# Scripts by their names in Unicode; a letter of another script has the first word of its own name.
SCRIPTS = "Latin Greek Cyrillic Armenian Hebrew Arabic Devanagari Bengali Thai Georgian Hangul Cherokee Hiragana Katakana Han Coptic Ethiopic Tamil".split()
_INVISIBLE = {0x00AD, 0x034F, 0x061C, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x180E, 0x200B, 0x200C, 0x200D, 0x200E, 0x200F, 0x2060, 0x2061, 0x2062, 0x2063, 0x2064, 0xFEFF}
#: The compatibility mappings of Unicode that keep a character's look; raised, lowered, circled and squared forms don't.
_SAME_LOOK = ("<font>", "<wide>", "<narrow>", "<noBreak>", "<compat>", "<initial>", "<medial>", "<final>", "<isolated>")
#: Of these, characters whose look is their own: long s, dotted and symbol forms of Greek letters, letters with an apostrophe.
_OWN_LOOK = frozenset("ſŉĿŀẚև") | frozenset(map(chr, (*range(0x3D0, 0x3D7), *range(0x3F0, 0x3F2), *range(0x3F4, 0x3FA))))

_IS = {name.upper(): regex.compile(rf"\p{{scx={name}}}") for name in SCRIPTS}
TO_LATIN = {c: latin for letters, latins in LETTERS.values() for c, latin in zip(letters, latins)}
_FROM_LATIN = {script: dict(zip(latins, letters)) for script, (letters, latins) in LETTERS.items()}


class _Plain(dict):
    """Code point -> its plain form, filled as characters are met: a table made from rules."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        self[code] = out = self.plain(c, code)
        return out

    def plain(self, c: str, code: int) -> str:
        if code in _INVISIBLE or 0xFE00 <= code <= 0xFE0F or 0xE0100 <= code <= 0xE01EF:
            return ""
        if c in ALIKE:
            return ALIKE[c]
        if unicodedata.category(c) == "Zs":
            return " "
        if c in TO_LATIN or c in _OWN_LOOK:
            return c
        kind, *codes = unicodedata.decomposition(c).split(" ")
        if kind in _SAME_LOOK and "0020" not in codes:
            return "".join(self[int(x, 16)] for x in codes)
        return c


_PLAIN = _Plain()


@lru_cache(maxsize=65536)
def scripts(char: str) -> frozenset[str]:
    """The scripts of a letter, extensions included; none for what is no letter, which goes with every script."""
    if not char.isalpha():
        return frozenset()
    found = frozenset(name for name, pattern in _IS.items() if pattern.match(char))
    return found or frozenset({unicodedata.name(char, "UNNAMED").split(" ")[0]})


@lru_cache(maxsize=65536)
def script_set(char: str) -> frozenset[str]:
    """The resolved script set: the scripts in which a letter of this look exists; empty for what is no letter."""
    latin = TO_LATIN.get(char, char)
    if latin == char and scripts(char) != {"LATIN"}:
        return scripts(char)
    return frozenset({"LATIN", *(script for script, back in _FROM_LATIN.items() if latin in back)}) if scripts(char) else frozenset()


def _spelt(token: str, script: str) -> str:
    """The token's letters in *script* where they have a look-alike there; all others as they are drawn in Latin, if they are."""
    back = _FROM_LATIN.get(script, {})
    out = []
    for c in token:
        latin = TO_LATIN.get(c, c)
        out.append(back.get(latin, latin) if script in script_set(c) else latin)
    return "".join(out)


def _is_unit(token: str) -> bool:
    """Micro or ohm signs with the letters of a unit (μA, MΩ), which are written so in any script."""
    return (token[:1] == "μ" and 1 < len(token) <= 4) or (token[-1:] == "Ω" and len(token) == 2)


@lru_cache(maxsize=65536)
def resolved(token: str) -> frozenset[str] | None:
    """The intersection of the script sets of a token's letters: the scripts that fit the whole token; null without letters."""
    sets = [s for c in token if (s := script_set(c))]
    return frozenset.intersection(*sets) if sets else None


def is_mixed(token: str) -> bool:
    """Whether no single script can spell the token."""
    return resolved(token) == frozenset()


@lru_cache(maxsize=65536)
def consistent(token: str, dominant: str = "LATIN") -> str:
    """The token in the script that fits all its letters; of several the *dominant* script of the text, else Latin.

    Where none fits all, in the one that fits most letters; of equals the dominant one, Latin, the first by name.
    """
    fits = resolved(token)
    if fits is None:
        return token
    bare = "".join(TO_LATIN.get(c, c) for c in token)
    if _is_unit(bare) and all("LATIN" in script_set(c) or c in "μΩ" for c in token):
        return bare
    if not fits:
        votes: dict[str, int] = {}
        for c in token:
            for script in script_set(c):
                votes[script] = votes.get(script, 0) + 1
        fits = {script for script, n in votes.items() if n == max(votes.values())}
    best = dominant if dominant in fits else "LATIN" if "LATIN" in fits else min(fits)
    return _spelt(token, best)


def _runs(word: str) -> Iterator[tuple[bool, str]]:
    """(whether letters, piece): runs of letters with their accents, and what stands between them."""
    start = 0
    for i, c in enumerate(word):
        if not c.isalpha() and not unicodedata.combining(c):
            if start < i:
                yield True, word[start:i]
            yield False, c
            start = i + 1
    if start < len(word):
        yield True, word[start:]


@lru_cache(maxsize=1 << 17)
def _letters(word: str) -> str:
    """The word normalised but for its scripts, decomposed: a foreign letter with an accent is respelled as letter and accent."""
    word = word.translate(_PLAIN)
    return word if word.isascii() else unicodedata.normalize("NFD", word).translate(_PLAIN)


@lru_cache(maxsize=1 << 17)
def _tells(word: str) -> tuple[tuple[str, int], ...]:
    """(script, letters) of the runs of two letters or more that only one script fits."""
    out: dict[str, int] = {}
    for is_letters, run in _runs(_letters(word)):
        fits = resolved(run) if is_letters and len(run) > 1 else None
        if fits and len(fits) == 1 and not _is_unit(run):
            script = next(iter(fits))
            out[script] = out.get(script, 0) + sum(map(str.isalpha, run))
    return tuple(out.items())


@lru_cache(maxsize=1 << 17)
def _word(word: str, dominant: str = "LATIN") -> str:
    """The one form of a stretch without plain blanks; letters are judged in runs."""
    word = _letters(word)
    if word.isascii() and dominant == "LATIN":
        return word
    return unicodedata.normalize("NFC", "".join(consistent(run, dominant) if is_letters else run for is_letters, run in _runs(word)))


def dominant_script(words: list[str]) -> str:
    """The script of most letters in words that fit one script only; Latin where none tells or of equals."""
    votes: dict[str, int] = {}
    for word in words:
        if not word.isascii():
            for script, n in _tells(word):
                votes[script] = votes.get(script, 0) + n
    if not votes.keys() - {"LATIN"}:
        return "LATIN"
    for word in words:
        if word.isascii():
            for script, n in _tells(word):
                votes[script] = votes.get(script, 0) + n
    return max(sorted(votes), key=lambda script: (votes[script], script == "LATIN"))


def look(text: str) -> str:
    """The one form of all texts that look like *text*. Plain ASCII is its own form.

    Neither accents nor runs of letters reach over a blank, so words are taken one by one.
    """
    if text.isascii():
        return text
    words = text.split(" ")
    dominant = dominant_script(words)
    if dominant != "LATIN":
        return " ".join([_word(w, dominant) for w in words])
    return " ".join([w if w.isascii() else _word(w) for w in words])


def _strings(column: pa.Array) -> list:
    return column.to_pylist()


def one_form(rows: DataFrame, column: str, out: str = "look") -> DataFrame:
    """*rows* with the column *out*: the one form of *column*; null stays null, an empty text empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            forms = [None if t is None else look(t) for t in _strings(b.column(column))]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(forms, pa.string())], names=[*b.schema.names, out])

    from pyspark.sql import types as T

    schema = T.StructType([*rows.schema.fields, T.StructField(out, T.StringType())])
    return rows.mapInArrow(run, schema)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hash128, hash64 = xxhash.xxh3_128_digest, xxhash.xxh3_64_intdigest
    for b in batches:
        keys, looks, texts = [], [], []
        for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            form = look(text)
            if not form.strip():
                continue
            raw = text.encode("utf-8", "surrogatepass")
            keys.append(key)
            looks.append(hash128(raw if form is text else form.encode("utf-8", "surrogatepass")))
            texts.append(hash64(raw) - (1 << 63))
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(looks, pa.binary()), pa.array(texts, pa.int64())], names=["key", "look", "text"])


def look_keys(rows: DataFrame, key: str, column: str) -> DataFrame:
    """``key, look, text``: of each row with a visible text the hash of its one form and the hash of its text.

    Both are made of the whole text, in one pass, without moving a text. Null texts and texts without any visible
    character have no look and are left out.
    """
    return rows.filter(F.col(key).isNotNull() & F.col(column).isNotNull()).select(F.col(key).cast("long").alias("key"), F.col(column).alias("t")).mapInArrow(_hashed, "key long, look binary, text long")


def _members(rows: DataFrame, key: str, column: str) -> DataFrame:
    """``key, look, text`` of the rows whose look occurs in two codings at least, each once.

    Two hashes that are combined before the shuffle tell which looks these are; only their rows go on.
    """
    keys = settled(look_keys(rows, key, column))  # each text is read once
    mixed = keys.groupBy("look").agg(F.min("text").alias("least"), F.max("text").alias("most")).filter("least < most").select("look")
    return settled(keys.join(mixed, "look", "left_semi").distinct())


def look_groups(tables: dict[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """``tbl, key, group_id, codings``: the rows whose texts look like a text of other code points, one row for each.

    *group_id* is the least key of the rows that look the same, *codings* the number of different texts among them; rows
    of one group are of one look, so this holds all links of ``lookalikes`` without expanding the pairs, whatever
    their number. Nulls, blank texts and empty tables give no rows.
    """
    out = None
    for name, (rows, key, column) in tables.items():
        some = _members(rows, key, column)
        groups = some.groupBy("look").agg(F.min("key").alias("group_id"), F.countDistinct("text").alias("codings"))
        members = some.select("look", "key").distinct().join(groups, "look").select(F.lit(name).alias("tbl"), "key", "group_id", "codings")
        out = members if out is None else out.unionByName(members)
    return out


def lookalikes(tables: dict[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """``tbl, key_lo, key_hi``: rows of one table whose whole texts look the same but differ in code points.

    *tables*: name -> (rows, key column, text column). Rows of equal text are no pair, whatever their number; a
    repeated row counts once. Where a look is so frequent that its pairs are too many, ``look_groups`` tells the same
    by membership. Only forms that occur in two different codings go on. Codings are paired before rows, so the rows of a text that a third of all rows share are
    never held against one another, only against those that code it otherwise. Nulls, blank texts and empty tables give
    no pair.
    """
    out = None
    for name, (rows, key, column) in tables.items():
        some = _members(rows, key, column)
        codings = some.select("look", "text").distinct()
        pair = codings.withColumnRenamed("text", "text_a").join(codings.withColumnRenamed("text", "text_b"), "look").filter("text_a < text_b")
        one, other = some.select("look", F.col("text").alias("text_a"), F.col("key").alias("a")), some.select("look", F.col("text").alias("text_b"), F.col("key").alias("b"))
        both = pair.join(one, ["look", "text_a"]).join(other, ["look", "text_b"]).filter("a <> b")
        pairs = both.select(F.lit(name).alias("tbl"), F.least("a", "b").alias("key_lo"), F.greatest("a", "b").alias("key_hi"))
        out = pairs if out is None else out.unionByName(pairs)
    return out.distinct()
