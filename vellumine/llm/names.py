"""Linking the spellings of one person or one venue by a noisy channel.

Frequent forms are candidate canonical forms. The prior of a form is its frequency; the channel that turns it
into a typed spelling abbreviates given names or words, reorders parts, uses nicknames, drops accents or middle
initials, and makes at most one typing error (insertion, deletion, substitution, transposition) in a word. Every
form is attached to the form of maximum posterior, which may be itself; the channel's probabilities are fitted by
expectation maximisation on the forms attached.

All mentions are first reduced to distinct spellings and these to distinct forms (surname, given name, middle initials;
words of a venue) with their counts, so a name that holds a third of all rows is one row from there on. Forms meet
their candidates by joins on keys that only related forms share (deletions of a letter, full names of a nickname,
prefixes, an acronym with the beginning of a word), and what has no given name meets the best entity of its initials by
an aggregate. Nothing gathers the forms of one surname or acronym, however many there are. All joins are merge joins: a side
read from compressed files may be many times larger in the driver's memory than the size a broadcast is chosen by.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellumine.sources.tables import settled

# English nicknames and short forms of given names (public knowledge).
NICKNAMES = {
    "alexander": "al alec alex sandy sasha xander", "andrew": "andy drew", "anthony": "tony", "benjamin": "ben benny benji",
    "catherine": "cathy kate kathy katie kitty", "charles": "charlie chuck", "christopher": "chris kit topher",
    "daniel": "dan danny", "david": "dave davy", "edward": "ed eddie ned ted teddy", "elizabeth": "bess beth betsy betty eliza libby lisa liz lizzie",
    "francis": "frank", "frederick": "fred freddie", "gregory": "greg", "henry": "hal hank harry", "james": "jamie jim jimmy",
    "jeffrey": "jeff", "john": "jack johnny", "jonathan": "jon nathan", "joseph": "joe joey", "katherine": "cathy kate kathy katie kay kitty",
    "kenneth": "ken kenny", "lawrence": "larry", "margaret": "daisy greta maggie margie marge meg megan peg peggy", "matthew": "mat matt",
    "michael": "mick mickey mike", "nicholas": "nick nicky", "patricia": "pat patty tricia", "patrick": "pat paddy", "peter": "pete",
    "philip": "phil", "rebecca": "becca becky", "richard": "dick rich richie rick ricky", "robert": "bob bobby rob robbie", "ronald": "ron",
    "samuel": "sam sammy", "stephen": "steve", "susanna": "sue susan susie suzie", "theodore": "ted teddy theo", "thomas": "tom tommy",
    "timothy": "tim", "victoria": "tori vic vicky", "walter": "walt", "william": "bill billy liam will willy",
}
_NICK = {short: {full for full, names in NICKNAMES.items() if short in names.split()} for names in NICKNAMES.values() for short in names.split()}
_SMALL_WORDS = {"of", "on", "in", "the", "and", "for", "to", "a", "an"}
_LETTERS = str.maketrans({"ø": "o", "Ø": "O", "ł": "l", "Ł": "L", "đ": "d", "Đ": "D", "ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "ı": "i"})

#: Channel probabilities before the fit: how often a typed form differs from the canonical one in this way; they weigh
#: as much as PRIOR mentions. COLLISION: how often a second entity has a name that differs from the first in just such a way.
CHANNEL = {"same": 0.5, "initial": 0.2, "nickname": 0.06, "prefix": 0.04, "accent": 0.05, "typo": 0.05, "no_middle": 0.08, "new_middle": 0.02, "acronym": 0.05, "abbreviated": 0.3}
PRIOR, COLLISION = 1000.0, 2e-5
Channel = dict[str, float]


def fold(text: str) -> str:
    """Lower case without accents; letters that have no decomposition become their plain forms."""
    text = unicodedata.normalize("NFKD", text.translate(_LETTERS))
    return "".join(c for c in text if not unicodedata.combining(c)).lower()


def _spelt(name: str) -> str:
    """A folded name without the digraphs that stand for accented letters."""
    return name.replace("oe", "o").replace("aa", "a").replace("ue", "u").replace("ae", "a")


def within_one(a: str, b: str) -> bool:
    """Whether one insertion, deletion, substitution or transposition of neighbours at most makes *a* to *b*."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1:
        return False
    i, most = 0, min(len(a), len(b))
    while i < most and a[i] == b[i]:
        i += 1
    if len(a) == len(b):
        return a[i + 1 :] == b[i + 1 :] or (a[i : i + 2] == b[i : i + 2][::-1] and a[i + 2 :] == b[i + 2 :])
    return a[i + 1 :] == b[i:] if len(a) > len(b) else a[i:] == b[i + 1 :]


def parse_person(name: str) -> tuple[str, str, str, str, bool]:
    """(first part, last part, given, middle, known): the surname's and the given name's place, if the form tells it.

    For a form that doesn't (two full words), first and last part are the two words and known is False.
    """
    text = unicodedata.normalize("NFC", name).strip()
    shout = text.upper() == text

    def initials(t: str) -> bool:
        """A run of initials as one token; in capitals throughout, only single letters are taken as such."""
        return len(t) == 1 or (len(t) <= 3 and t.isupper() and not shout)

    if "," in text:
        surname, _, rest = text.partition(",")
        given = [t for t in re.split(r"[\s.]+", rest) if t]
        flat = [x for t in given for x in (t if initials(t) and len(t) > 1 else [t])]
        return fold(surname).strip(), "", fold(flat[0]) if flat else "", fold("".join(x[0] for x in flat[1:])), True
    tokens = [t for t in re.split(r"[\s.]+", text) if t]
    if len(tokens) < 2:
        return fold("".join(tokens)), "", "", "", True
    if initials(tokens[-1]) and not initials(tokens[0]):
        rest = [x for t in tokens[1:] for x in (t if initials(t) else [t])]
        return fold(tokens[0]), "", fold(rest[0]), fold("".join(x[0] for x in rest[1:])), True
    if len(tokens) > 2 or initials(tokens[0]):
        rest = [x for t in tokens[:-1] for x in (t if initials(t) else [t])]
        return fold(tokens[-1]), "", fold(rest[0]), fold("".join(x[0] for x in rest[1:])), True
    return fold(tokens[0]), fold(tokens[1]), "", "", False


def parse_venue(name: str) -> list[str]:
    """The folded content words in natural order: a leading part put behind a comma is put back, small words fall."""
    text = fold(name).replace("&", " and ").strip()
    head, comma, tail = text.rpartition(",")
    if comma and re.search(r"\b(of|on|in|the)\s*$", tail):
        text = f"{tail} {head}"
    return [w for w in re.split(r"[^\w]+", text) if w and w not in _SMALL_WORDS]


def given_change(typed: str, form: str) -> tuple[str, float] | None:
    """How *typed* comes from the given name *form* (folded): the channel's step and the log of its share that goes to
    just this form, apart from the step's probability. None if it can't."""
    if typed == form:
        return "same", 0.0
    if len(typed) == 1:
        return ("initial", 0.0) if form[:1] == typed else None
    if _spelt(typed) == _spelt(form):
        return "accent", 0.0
    if form in _NICK.get(typed, ()):
        return "nickname", 0.0
    if len(typed) >= 2 and len(form) > len(typed) + 1 and form.startswith(typed):
        return "prefix", 0.0
    if 3 <= len(typed) <= 4 and len(form) > len(typed) + 1 and typed[0] == form[0] and within_one(typed, form[: len(typed)]):
        return "prefix", math.log(CHANNEL["typo"])  # cut short, where the form itself is a misspelling
    if within_one(typed, form) and min(len(typed), len(form)) >= 3:
        return "typo", -math.log(len(form) * 4)
    return None


def _given_loglik(typed: str, form: str) -> float:
    """log P(typed given name | canonical given name) under the channel before the fit."""
    change = given_change(typed, form)
    return math.log(CHANNEL[change[0]]) + change[1] if change else -math.inf


def _given_either(a: str, b: str) -> float:
    """As _given_loglik, where either name may be the one that tells less."""
    return max(_given_loglik(a, b), _given_loglik(b, a))


def _middle_loglik(typed: str, form: str) -> float:
    if typed == form:
        return math.log(CHANNEL["same"])
    if not typed:
        return math.log(CHANNEL["no_middle"])
    return math.log(CHANNEL["new_middle"]) if not form else -math.inf


def words_change(typed: list[str], form: list[str]) -> tuple[str, float] | None:
    """As given_change, of a venue's words: abbreviated words, one typing error in all, or the acronym for the words."""
    if len(typed) == 1 and len(form) > 1:
        return ("acronym", 0.0) if len(typed[0]) > 1 and typed[0] == "".join(w[0] for w in form) else None
    if len(typed) != len(form):
        return None
    typos, short = 0, False
    for a, b in zip(typed, form):
        if a == b:
            continue
        if len(b) > len(a) + 1 and b.startswith(a):
            short = True
        elif within_one(a, b) and min(len(a), len(b)) > 3:
            typos += 1
        else:
            return None
    if typos > 1 or not (typos or short):
        return None
    error = math.log(CHANNEL["typo"] / 40)
    return ("abbreviated", error * typos) if short else ("typo", -math.log(40))


def spellings(refs: DataFrame) -> DataFrame:
    """``kind, name, n``: distinct spellings of ``authors`` and of ``source`` with their numbers of mentions.

    Nulls and names without any letter are left out; repeated rows weigh as often as they stand.
    """
    names = refs.select(F.explode(F.concat(F.transform(F.coalesce("authors", F.array().cast("array<string>")), lambda a: F.struct(F.lit("author").alias("kind"), a.alias("name"))), F.array(F.struct(F.lit("source").alias("kind"), F.col("source").alias("name"))))).alias("x")).select("x.*")
    return names.filter(F.col("name").rlike(r"\p{L}")).groupBy("kind", "name").agg(F.count("*").alias("n"))


def _parsed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for kind, name, n in zip(pdf["kind"], pdf["name"], pdf["n"]):
            if kind == "author":
                rows.append((kind, name, n, *parse_person(name), None))
            else:
                words = parse_venue(name)
                rows.append((kind, name, n, words[0] if len(words) == 1 else "".join(w[0] for w in words), "", "", "", True, words))
        yield pd.DataFrame(rows, columns=["kind", "name", "n", "a", "b", "given", "middle", "known", "words"])


_PARSED = "kind string, name string, n long, a string, b string, given string, middle string, known boolean, words array<string>"


def _oriented(parsed: DataFrame) -> DataFrame:
    """The two-word person names turned so that a is the surname, and each given name's number of spellings, gfreq.

    Each word's log odds of being a given name are summed over all spellings: a place that the form tells counts
    more than the place in a pair of words, whose order is natural four times out of five.
    """
    persons = parsed.filter("kind = 'author'")
    told, seen = 3.0, math.log(0.8 / 0.2)
    said = F.array(
        F.struct(F.when(F.col("known"), F.col("a")).otherwise(F.col("b")).alias("word"), F.when(F.col("known"), -told).otherwise(-seen).alias("odds"), F.lit(0).alias("given")),
        F.struct(F.when(F.col("known"), F.col("given")).otherwise(F.col("a")).alias("word"), F.when(F.col("known"), told).otherwise(seen).alias("odds"), F.lit(1).alias("given")),
    )
    words = persons.select(F.explode(said).alias("s")).select("s.*").filter(F.length("word") > 1).groupBy("word").agg(F.sum("odds").alias("odds"), F.sum("given").alias("gfreq"))
    pair = persons.filter("not known")
    first, last = words.select(F.col("word").alias("a"), F.col("odds").alias("odds_a")), words.select(F.col("word").alias("b"), F.col("odds").alias("odds_b"))
    natural = F.coalesce("odds_a", F.lit(0.0)) - F.coalesce("odds_b", F.lit(0.0)) + F.lit(seen) >= 0
    turned = pair.hint("merge").join(first, "a", "left").hint("merge").join(last, "b", "left").select("kind", "name", "n", F.when(natural, F.col("b")).otherwise(F.col("a")).alias("a"), F.when(natural, F.col("a")).otherwise(F.col("b")).alias("given"), "middle", "words")
    both = parsed.filter("known").select("kind", "name", "n", "a", "given", "middle", "words").unionByName(turned)
    return both.hint("merge").join(words.select(F.col("word").alias("given"), "gfreq"), "given", "left").withColumn("gfreq", F.coalesce("gfreq", F.lit(0)))


def deletions(word: str, short: int = 64) -> list[str]:
    """Keys of which two words share one if a single error makes one to the other: the word and all words that lack one
    of its letters. Of a long word, instead, the first and last letters, since one error cannot touch both ends."""
    keys = {word, *(word[:i] + word[i + 1 :] for i in range(len(word)))} if len(word) <= short + 1 else set()
    if len(word) >= short:
        keys |= {"<" + word[:24], ">" + word[-24:]}
    return sorted(keys)


def _key(*parts: str) -> int:
    """A 64-bit key; forms that meet by chance are told apart when they are scored."""
    return xxhash.xxh3_64_intdigest("\x1f".join(parts).encode("utf-8", "surrogatepass")) - (1 << 63)


def _starts(word: str, most: int = 64) -> list[str]:
    """The beginnings of a word that a form cut short may have; beyond *most* letters the beginning of *most* stands for all."""
    return [word[:i] for i in range(2, min(len(word) - 1, most + 1))]


def given_keys(node: tuple, typed: bool) -> set[int]:
    """The keys of a given name with its surname, as the typed form or as the canonical one."""
    a, g = node
    keys = {("k", _spelt(g))} | ({("d", d) for d in deletions(g)} if len(g) >= 3 else set())
    if typed:
        keys |= {("n", full) for full in _NICK.get(g, ())} | {("p", g[:64])}
        if 3 <= len(g) <= 4:
            keys |= {("q", str(len(g)), d) for d in deletions(g)}
    else:
        keys |= {("n", g)} | {("p", start) for start in _starts(g)}
        keys |= {("q", str(n), d) for n in (3, 4) if len(g) > n + 1 for d in deletions(g[:n])}
    return {_key("g", a, *k) for k in keys}


def given_relation(typed: tuple, form: tuple) -> tuple[str, float, bool] | None:
    """The change, its share, and whether the typed name tells less than the form."""
    change = given_change(typed[1], form[1]) if typed[0] == form[0] and typed[1] != form[1] else None
    return (*change, change[0] == "nickname" or (change[0] == "prefix" and form[1].startswith(typed[1]))) if change else None


def venue_keys(node: tuple, typed: bool) -> set[int]:
    """The keys of a venue's words. One error: the words with a letter less in one of them. Abbreviations: the acronym with
    the beginning of one of its words, since an error leaves one of two beginnings whole."""
    words = list(node[0])
    keys = {("t", *words[:i], d, *words[i + 1 :]) for i, w in enumerate(words) if len(w) > 3 for d in deletions(w)}
    letters = "".join(w[0] for w in words)
    if len(words) > 1:
        anchors = {("b", letters, str(i), w[:3]) for i, w in enumerate(words) if len(w) >= 3}
        keys |= anchors
        if not typed or len(anchors) < 2:
            keys.add(("b", letters))
        if not typed:
            keys.add(("a", letters))
    elif words and typed:
        keys.add(("a", words[0]))
    return {_key("v", *k) for k in keys}


def venue_relation(typed: tuple, form: tuple) -> tuple[str, float, bool] | None:
    change = words_change(list(typed[0]), list(form[0]))
    return (*change, change[0] != "typo") if change else None


def entity_keys(node: tuple, typed: bool) -> set[int]:
    """The keys of a person (surname, given name, middle initials) for one error in the surname, or in the given name, or a
    nickname of another initial. Forms of one surname share none of them only because they share it."""
    a, g, _ = node
    if not g:
        return set()
    if len(g) == 1:
        names = {"~" + g}
    else:  # an error in a given name too leaves either its beginning or its end whole
        full = (_spelt(g), *(_NICK.get(g, ()) if typed else ()))
        names = {x for f in full for x in ("=" + f[:2], "$" + f[-2:])} | (set() if typed else {"~" + g[0]})
    # one lacks a letter of the other (whole against deletion), or both lack one letter of a common word
    whole, less = ("x", ("l", "y")) if typed else ("y", ("l", "x"))
    near = [(whole, a), *((tag, d) for d in deletions(a) if d != a for tag in less)] if len(a) > 3 else []
    keys = {("s", *d, x) for d in near for x in names}
    if len(g) > 3:
        keys |= {("g", a, d) for d in deletions(g)}
    if typed:
        keys |= {("n", a, x) for full in _NICK.get(g, ()) for x in ("~" + full[0], *deletions(full), *_starts(full))}
    else:
        keys |= {("n", a, d) for d in deletions(g)} if len(g) > 1 else {("n", a, "~" + g)}
    return {_key("e", *k) & ~1 if k[0] == "s" else _key("e", *k) | 1 for k in keys}  # odd keys are for equal surnames


def entity_relation(typed: tuple, form: tuple) -> tuple[str, float, bool] | None:
    (a, g, m), (b, h, k) = typed, form
    middle = max(_middle_loglik(m, k), _middle_loglik(k, m))
    if middle == -math.inf or not g or not h:
        return None
    if a == b:
        for x, y in ((g, h), (h, g)):
            if any(_given_either(full, y) > -math.inf for full in _NICK.get(x, ())):
                return "nickname", middle, False
        return ("typo", middle - math.log(40), False) if g != h and len(g) > 2 and len(h) > 2 and within_one(g, h) else None
    if min(len(a), len(b)) < 4 or not within_one(a, b):
        return None
    given = _given_either(g, h)
    return ("typo", max(given, math.log(CHANNEL["accent"])) + middle - math.log(40), False) if given > -math.inf else None


def _met(nodes: DataFrame, fields: list[str], keys, relation, useful: str = "true") -> DataFrame:
    """``v, c, v_n, c_n, v_spelt, v_rank, c_rank, change, share, short``: the forms that are related, in both directions.

    *nodes* has ``id, n, spelt, rank`` and the *fields* that *keys* and *relation* read. *useful* is a condition on ``key, t_node,
    f_node`` without which forms that share a key aren't scored.
    """
    node = F.struct(*fields)

    def keyed(side: str, typed: bool) -> DataFrame:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                found = [list(keys(x, typed)) for x in pdf[fields].itertuples(index=False, name=None)]
                at = np.repeat(np.arange(len(pdf)), [len(k) for k in found])
                out = pdf.iloc[at].copy()
                out.insert(0, "key", np.array([k for some in found for k in some], dtype=np.int64))
                yield out

        kinds = {f.name: f.dataType.simpleString() for f in nodes.schema.fields}
        names = ["id", "n", "spelt", "rank", *fields]
        rows = nodes.select(*names).mapInPandas(run, "key long, " + ", ".join(f"`{x}` {kinds[x]}" for x in names))
        return rows.select("key", *(F.col(x).alias(f"{side}_{x}") for x in names[:4]), node.alias(f"{side}_node"))

    pairs = keyed("t", True).hint("merge").join(keyed("f", False), "key").filter(f"t_id <> f_id and ({useful})").drop("key")

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for t, f, *rest in zip(pdf["t_node"], pdf["f_node"], *(pdf[x] for x in ("t_id", "f_id", "t_n", "f_n", "t_spelt", "f_spelt", "t_rank", "f_rank"))):
                told = relation(tuple(t[x] for x in fields), tuple(f[x] for x in fields))
                if told:
                    rows.append((*rest, *told))
            yield pd.DataFrame(rows, columns=["t", "f", "t_n", "f_n", "t_spelt", "f_spelt", "t_rank", "f_rank", "change", "share", "short"])

    some = pairs.mapInPandas(score, "t string, f string, t_n long, f_n long, t_spelt long, f_spelt long, t_rank long, f_rank long, change string, share double, short boolean")
    one = settled(some.distinct())
    ahead = one.select(F.col("t").alias("v"), F.col("f").alias("c"), F.col("t_n").alias("v_n"), F.col("f_n").alias("c_n"), F.col("t_spelt").alias("v_spelt"), F.col("t_rank").alias("v_rank"), F.col("f_rank").alias("c_rank"), "change", "share", "short")
    back = one.select(F.col("f").alias("v"), F.col("t").alias("c"), F.col("f_n").alias("v_n"), F.col("t_n").alias("c_n"), F.col("f_spelt").alias("v_spelt"), F.col("f_rank").alias("v_rank"), F.col("t_rank").alias("c_rank"), "change", "share", F.lit(False).alias("short"))
    return ahead.unionByName(back)


def _ordered(edges: DataFrame, oneway: bool) -> DataFrame:
    """The edges to forms that come first: those that are short for no other, then the usual and the frequent, then the
    lesser by code points. Every edge goes down this order, so there is no circle. *oneway*: what is short for a form is
    attached to it and never the other way."""
    short = edges.filter("short").select("v").distinct()
    mine, its = short.withColumn("v_short", F.lit(1)), short.select(F.col("v").alias("c"), F.lit(1).alias("c_short"))
    both = edges.hint("merge").join(mine, "v", "left").hint("merge").join(its, "c", "left").fillna(0, ["v_short", "c_short"])
    if oneway:
        both = both.filter(F.col("short") | (F.col("change") == "typo"))
    place = lambda side: F.struct(f"{side}_short", -F.col(f"{side}_rank"), -F.col(f"{side}_n"), side)
    return both.filter(place("c") < place("v"))


def _best(edges: DataFrame, channel: Channel, penalty: float) -> DataFrame:
    """``v, target, change, v_n``: each form with the form of maximum posterior, where that is above its own; ties go to the
    more frequent form, then to the lesser by code points. A form spelt in k ways is a misspelling only where each of them is one."""
    step = F.element_at(F.create_map(*(F.lit(x) for name, p in channel.items() for x in (name, math.log(p)))), F.col("change"))
    score = F.log("c_n") + step + F.col("share")
    own = F.log("v_n") + math.log(COLLISION) + penalty * F.when(F.col("change") == "typo", F.col("v_spelt") - 1).otherwise(0)
    some = edges.withColumn("score", score).filter(F.col("score") > own)
    first = F.min(F.struct((-F.col("score")).alias("s"), (-F.col("c_n")).alias("m"), "c", "change")).alias("x")
    return some.groupBy("v").agg(first, F.first("v_n").alias("v_n")).select("v", F.col("x.c").alias("target"), F.col("x.change").alias("change"), "v_n")


def fit(edges: DataFrame, mentions: float, channel: Channel, penalty: float, rounds: int = 2) -> Channel:
    """The channel after *rounds* of expectation maximisation: each form goes to its maximum posterior, and a change is as
    probable as the share of all *mentions* that it made. What comes to the driver are the sums by change."""
    for _ in range(rounds):
        made = {r["change"]: r["n"] for r in _best(edges, channel, penalty).groupBy("change").agg(F.sum("v_n").alias("n")).collect()}
        channel = channel | {name: (made.get(name, 0) + PRIOR * CHANNEL[name]) / (mentions + PRIOR) for name in made}
    return channel


def _roots(links: DataFrame) -> DataFrame:
    """``v, root``: the last target of each form, by doubling the steps until none changes; edges go down an order, so it ends."""
    links = settled(links.select("v", "target"))
    while True:
        further = links.select(F.col("v").alias("target"), F.col("target").alias("last"))
        if not links.hint("merge").join(further, "target", "left_semi").head(1):
            return links.withColumnRenamed("target", "root")
        links = settled(links.hint("merge").join(further, "target", "left").select("v", F.coalesce("last", "target").alias("target")))


def _lead() -> Column:
    """The most frequent spelling; of equals the lesser by code points."""
    return F.min(F.struct((-F.col("n")).alias("m"), "name"))


def _mentions(nodes: DataFrame) -> float:
    return float(nodes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])


def _top(entities: DataFrame, by: list[str], score: Column, name: str) -> DataFrame:
    """The best entity of each group of *by*: the greatest score, then the lesser by code points."""
    x = F.min(F.struct((-score).alias("s"), "told", "mid"))
    return entities.groupBy(*by).agg(x.alias(name))


def _persons(turned: DataFrame) -> DataFrame:
    """``name, entity``: the author spellings with the id of their person."""
    apart = "\x1f"
    some = turned.filter("kind = 'author'").select("name", "n", "a", F.coalesce("given", F.lit("")).alias("given"), F.coalesce("middle", F.lit("")).alias("middle"), "gfreq")
    forms = settled(some.groupBy("a", "given", "middle").agg(F.sum("n").alias("n"), F.count("*").alias("spelt"), F.max("gfreq").alias("gfreq")))
    # the given names of a surname, each with its canonical one
    given = forms.filter(F.length("given") > 1).groupBy("a", "given").agg(F.sum("n").alias("n"), F.sum("spelt").alias("spelt"), F.max("gfreq").cast("long").alias("rank"))
    given = settled(given.withColumn("id", F.concat_ws(apart, "a", "given")))
    edges = settled(_ordered(_met(given, ["a", "given"], given_keys, given_relation), oneway=False))
    seen = forms.agg(F.sum("n").alias("all"), F.sum(F.when(F.length("given") == 1, F.col("n"))).alias("initial")).first()
    mentions = float(seen["all"] or 0)
    channel = fit(edges, mentions, CHANNEL, 0.0) | {"initial": ((seen["initial"] or 0) + PRIOR * CHANNEL["initial"]) / (mentions + PRIOR)}
    log = {x: math.log(p) for x, p in channel.items()}
    root = _roots(_best(edges, channel, 0.0)).select(F.split_part("v", F.lit(apart), F.lit(1)).alias("a"), F.split_part("v", F.lit(apart), F.lit(2)).alias("given"), F.split_part("root", F.lit(apart), F.lit(2)).alias("told"))
    forms = forms.hint("merge").join(root, ["a", "given"], "left").withColumn("told", F.coalesce("told", "given"))
    # full names: one without middle initials goes to the best with some
    by_name = forms.groupBy("a", "told", "middle").agg(F.sum("n").alias("n")).withColumn("init", F.substring("told", 1, 1))
    full = by_name.filter(F.length("told") > 1).withColumn("mid", F.col("middle"))
    best = _top(full.filter("middle <> ''"), ["a", "told"], F.log("n"), "best")
    joins = (F.col("middle") == "") & (-F.col("best.s") + log["same"] + log["no_middle"] > F.log("n") + math.log(COLLISION))
    full = settled(full.hint("merge").join(best, ["a", "told"], "left").withColumn("mid", F.when(F.coalesce(joins, F.lit(False)), F.col("best.mid")).otherwise(F.col("middle"))).select("a", "init", "told", "middle", "mid", "n"))
    entities = full.groupBy("a", "init", "told", "mid").agg(F.sum("n").alias("n"))
    # initials with middle initials, then those without any: each goes to the best entity that they fit
    bare = by_name.filter(F.length("told") <= 1).select("a", "init", "told", "middle", "n")
    tops = _top(entities, ["a", "init", "mid"], F.log("n"), "top")
    two = bare.filter("middle <> ''").hint("merge").join(tops.select("a", "init", F.col("mid").alias("middle"), F.col("top").alias("equal")), ["a", "init", "middle"], "left")
    two = two.hint("merge").join(tops.filter("mid = ''").select("a", "init", F.col("top").alias("open")), ["a", "init"], "left")
    s1, s2 = -F.col("equal.s") + log["initial"] + log["same"], -F.col("open.s") + log["initial"] + log["new_middle"]
    own = F.log("n") + math.log(COLLISION)
    low = F.lit(-1e9)
    s1, s2 = F.coalesce(s1, low), F.coalesce(s2, low)
    to = F.when(F.greatest(s1, s2) <= own, F.struct("told", F.col("middle").alias("mid"))).when(s1 >= s2, F.struct("equal.told", "equal.mid")).otherwise(F.struct("open.told", F.col("middle").alias("mid")))
    # an entity without middle initials takes those of the form that joins it, so its id changes: kept apart as *was*
    two = settled(two.withColumn("to", to).withColumn("opened", (s2 > s1) & (s2 > own)).select("a", "init", "told", "middle", "n", F.col("to.told").alias("etold"), F.when(F.col("opened"), "").otherwise(F.col("to.mid")).alias("emid")))
    entities = entities.select("a", "init", "told", "mid", "n").unionByName(two.select("a", "init", F.col("etold").alias("told"), F.col("emid").alias("mid"), "n")).groupBy("a", "init", "told", "mid").agg(F.sum("n").alias("n"))
    score = F.log("n") + F.when(F.length("told") > 1, log["initial"]).otherwise(log["same"]) + F.when(F.col("mid") == "", log["same"]).otherwise(log["no_middle"])
    one = bare.filter("middle = ''").hint("merge").join(_top(entities, ["a", "init"], score, "top"), ["a", "init"], "left")
    fits = F.coalesce(-F.col("top.s") > own, F.lit(False))
    one = one.select("a", "told", "middle", F.when(fits, F.col("top.told")).otherwise(F.col("told")).alias("etold"), F.when(fits, F.col("top.mid")).otherwise(F.lit("")).alias("emid"))
    whole = full.select("a", "told", "middle", F.col("told").alias("etold"), F.col("mid").alias("emid")).unionByName(two.select("a", "told", "middle", "etold", "emid")).unionByName(one)
    placed = settled(forms.hint("merge").join(whole, ["a", "told", "middle"]).withColumn("entity", F.concat_ws(apart, "a", "etold", "emid")).select("a", "given", "middle", "n", "spelt", "etold", "emid", "entity"))
    # persons of other surnames or initials, by one error or a nickname
    nodes = placed.groupBy("entity", "a", "etold").agg(F.sum("n").alias("n"), F.sum("spelt").alias("spelt"), F.max(F.when(F.col("emid") != "", F.col("emid")).otherwise(F.col("middle"))).alias("mid"))
    nodes = settled(nodes.select(F.col("entity").alias("id"), F.lit(0).cast("long").alias("rank"), "n", "spelt", "a", F.col("etold").alias("given"), "mid"))
    edges = settled(_ordered(_met(nodes, ["a", "given", "mid"], entity_keys, entity_relation, "key & 1 = 1 or t_node.a <> f_node.a"), oneway=False))
    roots = _roots(_best(edges, fit(edges, mentions, CHANNEL, 4.0), 4.0))
    last = placed.hint("merge").join(roots, placed["entity"] == roots["v"], "left").select("a", "given", "middle", F.coalesce("root", "entity").alias("entity"))
    return some.hint("merge").join(last, ["a", "given", "middle"]).select("name", "entity")


def _venues(turned: DataFrame) -> DataFrame:
    """``name, entity``: the venue spellings with the id of their venue."""
    some = turned.filter("kind = 'source'").select("name", "n", "words", F.concat_ws(" ", "words").alias("id"))
    nodes = some.filter("size(words) > 0").groupBy("id", "words").agg(F.sum("n").alias("n"), F.count("*").alias("spelt")).withColumn("rank", F.lit(0).cast("long"))
    nodes = settled(nodes)
    edges = settled(_ordered(_met(nodes, ["words"], venue_keys, venue_relation), oneway=True))
    channel = fit(edges, _mentions(nodes), CHANNEL, 4.0)
    roots = _roots(_best(edges, channel, 4.0))
    named = some.withColumn("id", F.when(F.size("words") > 0, F.col("id")).otherwise(F.concat(F.lit("\x1f"), "name")))
    return named.hint("merge").join(roots, named["id"] == roots["v"], "left").select("name", F.coalesce("root", "id").alias("entity"))


def linked(refs: DataFrame) -> DataFrame:
    """``kind, name, n, entity``: each distinct spelling with the canonical spelling of its entity.

    Names are compared as typed words: nulls and names without letters are left out, empty tables give no rows, ties go to the
    more frequent form and then to the lesser one by code points, and the same input always gives the same
    entities. The canonical spelling is the most frequent one of the entity. Columns other than ``authors`` and ``source``
    are ignored. Chains of misspelt forms are followed to their end.
    """
    parsed = settled(spellings(refs).mapInPandas(_parsed, _PARSED), refs.sparkSession)
    turned = settled(_oriented(parsed), refs.sparkSession)
    with ThreadPoolExecutor(2) as both:  # the two kinds have nothing in common, so their stages run side by side
        persons, venues = both.submit(_persons, turned), both.submit(_venues, turned)
    of = persons.result().withColumn("kind", F.lit("author")).unionByName(venues.result().withColumn("kind", F.lit("source")))
    found = settled(turned.select("kind", "name", "n").hint("merge").join(of, ["kind", "name"]), refs.sparkSession)
    leads = found.groupBy("kind", "entity").agg(_lead().alias("lead"))
    return found.hint("merge").join(leads, ["kind", "entity"]).select("kind", "name", "n", F.col("lead.name").alias("entity"))


def variant_pairs(links: DataFrame) -> DataFrame:
    """``kind, name_lo, name_hi``: the pairs of distinct spellings of one entity, name_lo < name_hi by code points.

    The pairs are those of *links*, which holds the same by membership and stays as small as the spellings are.
    """
    lo = links.select("kind", "entity", F.col("name").alias("name_lo"))
    hi = links.select("kind", "entity", F.col("name").alias("name_hi"))
    return lo.hint("merge").join(hi, ["kind", "entity"]).filter("name_lo < name_hi").select("kind", "name_lo", "name_hi")
