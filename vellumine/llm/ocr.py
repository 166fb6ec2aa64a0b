"""Damage in the text of scanned pages, and its repair into continuous paragraphs.

Lines are labelled by a hidden Markov model as body, break (a body line that opens a paragraph), running head or page
number, from layout features alone: numbers set off by a gap, capitals, a name before a colon, line ends and starts,
length and place. The model is fitted by expectation maximisation on all rows of running text, from stated priors: rows
are counted by the features of their lines, and each round sums expected counts over these in the tasks.

Words are judged by counts over the whole corpus: a rare form is a misread word if undoing confusions of shapes gives
a much more frequent one; a word cut at a line end is rejoined without its hyphen unless the hyphenated compound is
what the corpus knows. Texts are read where they lie; only rare forms and damage found leave the tasks. Tasks get the
most frequent words (*lexicon_words*) to settle what is common on the spot; all other forms are settled by joins with
the full counts, so the bound changes the cost and not the result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellumine.llm.confusables import look
from vellumine.sources.tables import settled

# Shapes that recognition confuses, as read -> as printed.
SYMBOLS = {"0": "o", "1": "l", "5": "s", "6": "b", "9": "g", "8": "b", "@": "a", "!": "i", "|": "l", "$": "s"}
SHAPES = {"c": "e", "f": "t", "b": "h", "v": "y", "h": "ti li", "m": "in rn nn", "mi": "nn", "cl": "d", "ii": "u", "rn": "m", "vv": "w", "li": "h", "nn": "m"}
STATES = ("body", "break", "header", "pageno")
FEATURES = ("cue", "capitals", "end", "start", "words", "place")
_HYPHENS = "-¬‐‑­"
_EDGE = ".,;:()[]{}\"'“”‘’—–?/…-=+*"
_PAGE = re.compile(r"^\s*(?:[-—–]\s*\d{1,5}\s*[-—–]|\[\s+\d{1,5}\s+\]|(?:page|p\.|pg\.|seite|página)\s*\d{1,5}|\d{1,5}\s*\||\|\s*\d{1,5}|\d{1,5}(?:\s+(?:of|/)\s+\d{1,5})?)\s*$", re.I)
_GAP = re.compile(r"^\s*\d{1,5}\s{2,}\S|\S\s{3,}\d{1,5}\s*$")
_NAMED = re.compile(r"^\s*[^\W\d_][\w'’.-]*(?:\s+(?:et al\.|and others|[^\W\d_][\w'’.-]*))?:\s+[^\W\d_]")
_OPENING = re.compile(r"[.?!:—]\s*(?=[^\W\d_a-z])[^\W\d_]{4,}")
_LETTERS = re.compile(r"[^\W\d_]+")
_BLANKS = {i: " " for i in range(128) if not chr(i).isalpha()}
_ENDS_HYPHEN = re.compile(rf"[^\W\d_][{_HYPHENS}][ \t]*$")
_CUT_WORD = re.compile(rf"[^\W\d_]+[{_HYPHENS}][ \t]*\n[ \t]*\S+")


def features(lines: list[str]) -> list[tuple[int, ...]]:
    """Of each line: cue, capitals, end, start, words, place; each a small number."""
    out, last = [], len(lines) - 1
    for i, line in enumerate(lines):
        plain_ = line.isascii()
        words = line.translate(_BLANKS).split() if plain_ else _LETTERS.findall(line)
        long = [w for w in words if len(w) > 3]
        if len(line) < 40 and _PAGE.match(line):
            cue = 1
        else:  # neither pattern can match without two blanks or a colon
            cue = 2 * ("  " in line and bool(_GAP.search(line))) + 3 * (":" in line and bool(_NAMED.match(line)))
            cue = 4 if cue == 5 else cue
        upper = len([w for w in long if w < "["]) if plain_ else sum(w[0].isupper() for w in long)
        if upper:
            upper -= len(_OPENING.findall(line))
        if not cue and long and words[0] == long[0] and words[0][0].isupper() and (i == 0 or out[-1][2] == 0):
            upper -= 1  # the word that opens a sentence is no sign
        caps = 0 if upper < 1 or upper < 0.5 * len(long) else 2 if all(w.isupper() for w in long) else 1
        bare = line.rstrip()
        end = 3 if not bare else 1 if bare[-1] in _HYPHENS and _ENDS_HYPHEN.search(line) else 0 if bare[-1] in ".!?:;…\"" else 2
        first = line.lstrip()[:1]
        start = 0 if first.islower() else 1 if first.isupper() else 2
        n = len(words)
        out.append((cue, caps, end, start, 0 if n < 2 else 1 if n < 5 else 2 if n < 9 else 3, 0 if last == 0 else 1 if i == 0 else 3 if i == last else 2))
    return out


_SIZES = (5, 3, 4, 3, 4, 4)
_STEPS = np.cumprod((1, *_SIZES[:-1]))
_UNIT = 2.0**28  # of expected numbers
_FIRST = 0x4000  # characters from here on stand for the features of one line


def coded(seen: list[tuple[int, ...]]) -> str:
    """The features of a row's lines as a text of one character for each line."""
    return "".join([chr(_FIRST + a + 5 * b + 15 * c + 60 * d + 180 * e + 720 * f) for a, b, c, d, e, f in seen])


# Priors of the emissions, by state and feature, and of the transitions; they are pseudo-counts for the fit.
_PRIOR = {
    "body": ([0.993, 0.001, 0.004, 0.002, 1e-4], [0.96, 0.03, 0.01], [0.25, 0.2, 0.5, 0.05], [0.6, 0.3, 0.1], [0.05, 0.1, 0.35, 0.5], [0.05, 0.2, 0.5, 0.25]),
    "break": ([0.99, 0.001, 0.004, 0.005, 1e-4], [0.93, 0.05, 0.02], [0.4, 0.15, 0.4, 0.05], [0.02, 0.9, 0.08], [0.05, 0.1, 0.35, 0.5], [0.3, 0.5, 0.15, 0.05]),
    "header": ([0.002, 0.002, 0.5, 0.4, 0.096], [0.05, 0.6, 0.35], [0.06, 0.02, 0.9, 0.02], [0.02, 0.7, 0.28], [0.05, 0.35, 0.45, 0.15], [0.3, 0.05, 0.6, 0.05]),
    "pageno": ([0.004, 0.99, 0.004, 0.001, 0.001], [0.98, 0.01, 0.01], [0.1, 0.01, 0.85, 0.04], [0.05, 0.25, 0.7], [0.97, 0.02, 0.005, 0.005], [0.4, 0.05, 0.5, 0.05]),
}
_START = [0.05, 0.85, 0.06, 0.04]
_MOVE = [[0.9, 0.02, 0.05, 0.03], [0.9, 0.02, 0.05, 0.03], [0.95, 0.03, 0.01, 0.01], [0.95, 0.03, 0.01, 0.01]]


class Model:
    """The hidden Markov model of lines, in logarithms."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: list[np.ndarray]):
        self.start, self.move, self.emit = np.log(start), np.log(move), [np.log(e) for e in emit]
        self._seen: dict[tuple[int, ...], list[float]] = {}
        self._move = self.move.tolist()
        self._start = self.start.tolist()
        self._quiet: dict[tuple[int, ...], bool] = {}
        # what it costs at most to put state y for x between any neighbours, at the start or at the end of a row
        into = np.vstack([self.move, self.start])
        out = np.hstack([self.move, np.zeros((len(STATES), 1))])
        self._cost = {(x, y): float(np.max(into[:, x] - into[:, y]) + np.max(out[x] - out[y])) for x in (2, 3) for y in (0, 1)}

    @classmethod
    def prior(cls) -> Model:
        emit = [np.array([_PRIOR[s][f] for s in STATES]) for f in range(len(_SIZES))]
        return cls(np.array(_START), np.array(_MOVE), [e / e.sum(axis=1, keepdims=True) for e in emit])

    def at(self, line: tuple[int, ...]) -> list[float]:
        if line not in self._seen:
            self._seen[line] = sum(e[:, v] for e, v in zip(self.emit, line)).tolist()
        return self._seen[line]

    def quiet(self, line: tuple[int, ...]) -> bool:
        """Whether a line is body or break on every best path: no change of its transitions makes up for what its features say."""
        if line not in self._quiet:
            at = self.at(line)
            self._quiet[line] = all(any(at[y] - at[x] > self._cost[x, y] for y in (0, 1)) for x in (2, 3))
        return self._quiet[line]

    def decode(self, lines: list[tuple[int, ...]]) -> list[int]:
        """The most probable states of a row's lines (Viterbi)."""
        states = range(len(STATES))
        score = [a + b for a, b in zip(self._start, self.at(lines[0]))]
        back: list[list[int]] = []
        for line in lines[1:]:
            here, step, scores = self.at(line), [], []
            for s in states:
                best = max(states, key=lambda r: score[r] + self._move[r][s])
                step.append(best)
                scores.append(score[best] + self._move[best][s] + here[s])
            back.append(step)
            score = scores
        path = [max(states, key=score.__getitem__)]
        for step in reversed(back):
            path.append(step[path[-1]])
        return path[::-1]

    def expected(self, codes: list[str], times: list[int], most: int = 500_000) -> np.ndarray:
        """The expected numbers of starts, moves and emissions (as by ``updated``) over rows of coded lines that occur so many times,
        in units of 1 / _UNIT: whole numbers, so that their sum is the same in whatever order and tasks. Each row weighs as one,
        shared out among its lines, so that one endless row doesn't outweigh all others."""
        start, move, n = np.exp(self.start), np.exp(self.move), len(STATES)
        digits = np.arange(int(np.prod(_SIZES)))[:, None] // _STEPS % _SIZES
        table = np.exp(sum(e[:, digits[:, f]].T for f, e in enumerate(self.emit)))
        starts, moves, seen = np.zeros(n, np.int64), np.zeros((n, n), np.int64), np.zeros((len(digits), n), np.int64)
        order = sorted(range(len(codes)), key=lambda i: -len(codes[i]))
        while order:
            # rows of falling length: those that have a line t are the first ones, at each t
            lines, k = 0, 0
            while k < len(order) and (k == 0 or lines + len(codes[order[k]]) <= most):
                lines, k = lines + len(codes[order[k]]), k + 1
            some, order = order[:k], order[k:]
            sizes = np.array([len(codes[i]) for i in some])
            flat = np.frombuffer("".join(codes[i] for i in some).encode("utf-16-le"), np.uint16).astype(np.int64) - _FIRST
            first, weight = np.cumsum(sizes) - sizes, (np.array([times[i] for i in some]) / sizes * _UNIT)[:, None]
            there = np.searchsorted(-sizes, -np.arange(sizes[0]), "left")  # at t, the number of rows of more than t lines
            alpha, scale = [], []
            for t, m in enumerate(there):
                b = table[flat[first[:m] + t]]
                a = (start if t == 0 else sum(alpha[-1][:m, i, None] * move[i] for i in range(n))) * b
                scale.append(a.sum(axis=1, keepdims=True))
                alpha.append(a / scale[-1])
            beta = np.ones((there[-1], n))
            for t in range(len(there) - 1, -1, -1):
                m, at = there[t], flat[first[: there[t]] + t]
                gamma = np.rint(alpha[t] * beta * weight[:m]).astype(np.int64)
                np.add.at(seen, at, gamma)
                if t == 0:
                    starts += gamma.sum(axis=0)
                    break
                ahead = table[at] * beta / scale[t]
                moves += np.rint(alpha[t - 1][:m, :, None] * move * ahead[:, None, :] * weight[:m, :, None]).astype(np.int64).sum(axis=0)
                beta = np.ones((there[t - 1], n))
                beta[:m] = sum(ahead[:, j, None] * move[:, j] for j in range(n))
        emits = [np.array([seen[digits[:, f] == v].sum(axis=0) for v in range(size)]).T for f, size in enumerate(_SIZES)]
        return np.concatenate([starts, moves.ravel(), *(e.ravel() for e in emits)])

    @staticmethod
    def updated(sums: np.ndarray, weight: float = 50.0) -> Model:
        """The model of expected numbers; the priors count as *weight* rows for each state."""
        prior = Model.prior()
        parts = [np.exp(p) * weight for p in (prior.start, prior.move, *prior.emit)]
        at = np.cumsum([0, *(p.size for p in parts)])
        start, move, *emit = (p + sums[i : i + p.size].reshape(p.shape) / _UNIT for p, i in zip(parts, at))
        return Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), [e / e.sum(axis=1, keepdims=True) for e in emit])

    def fitted(self, rows: list[list[tuple[int, ...]]], rounds: int = 4, weight: float = 50.0) -> Model:
        """The model after *rounds* of expectation maximisation on *rows*; the priors count as *weight* rows for each state."""
        model, counted = self, Counter(map(coded, rows))
        for _ in range(rounds):
            model = self.updated(model.expected(list(counted), list(counted.values())), weight)
        return model


@lru_cache(maxsize=200_000)
def corrections(form: str) -> frozenset[str]:
    """What a form may have been in print: symbols undone, and up to two confused shapes of letters."""
    base = "".join(SYMBOLS.get(c, c) for c in form)
    out, stage = ({base} if base != form else set()), {base}
    for _ in range(2):
        stage = {w[:i] + good + w[i + len(bad) :] for w in stage for bad, goods in SHAPES.items() for good in goods.split() for i in _places(w, bad)}
        out |= stage
    return frozenset(out - {form})


def _places(word: str, part: str) -> Iterator[int]:
    at = word.find(part)
    while at >= 0:
        yield at
        at = word.find(part, at + 1)


def is_symbolic(form: str) -> bool:
    return any(c in SYMBOLS for c in form)


def worth_judging(form: str) -> bool:
    """Whether a token can be a misread word: at least three characters, mostly letters, nothing but shapes of letters."""
    letters = sum(c.isalpha() for c in form)
    return len(form) >= 3 and letters >= 2 and letters * 2 > len(form) and all(c.isalpha() or c in SYMBOLS or c == "-" for c in form)


def plain(text: str) -> str:
    """The look of a text, where a soft hyphen at a line end stays as a hyphen."""
    if text.isascii():
        return text
    return look(re.sub(r"­(?=[ \t]*(?:\n|$))", "-", text))


def _count(batches: Iterator[pa.RecordBatch], most: int = 500_000) -> Iterator[pa.RecordBatch]:
    """Sums of this task, given out whenever they hold more than *most* tokens; the shuffle adds them up."""
    raw: Counter = Counter()
    rows: Counter = Counter()
    held = 0
    for b in batches:
        for text, running in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            text = plain(text)
            if running and text.strip():
                code = coded(features(text.split("\n")))
                held += len(code) if code not in rows else 0
                rows[code] += 1
            if "\n" in text:
                text = _CUT_WORD.sub(" ", text)
            raw.update(text.split())
        if len(raw) > most or held > 4 * most:
            yield from _tallies(raw, rows)
            raw.clear()
            rows.clear()
            held = 0
    yield from _tallies(raw, rows)


def _tallies(raw: Counter, rows: Counter) -> Iterator[pa.RecordBatch]:
    words: Counter = Counter()
    for token, n in raw.items():
        form = token.strip(_EDGE).lower()
        if worth_judging(form):
            words[form] += n
    for lines, tally in ((False, words), (True, rows)):
        yield pa.RecordBatch.from_arrays([pa.array([lines] * len(tally), pa.bool_()), pa.array(list(tally), pa.string()), pa.array(list(tally.values()), pa.int64())], names=["lines", "form", "n"])


def tallied(texts: DataFrame) -> DataFrame:
    """``lines, form, n``: the words of all texts (column ``text``), lower case, with their counts, and where *lines*, the rows of
    running text (column ``running``) by the features of their lines; summed up in each task before the shuffle."""
    return texts.select("text", "running").mapInArrow(_count, "lines boolean, form string, n long").groupBy("lines", "form").agg(F.sum("n").alias("n"))


def _candidates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = [(f, c) for f in pdf["form"] for c in corrections(f)]
        yield pd.DataFrame(rows, columns=["form", "printed"])


def _is_misread(symbolic: Column) -> Column:
    """A correction must be much more frequent than the form; for a form with symbols among its letters, more frequent."""
    return F.when(symbolic, F.col("printed_n") > F.col("form_n")).otherwise((F.col("printed_n") >= 20 * F.col("form_n")) & (F.col("printed_n") >= 5))


def judged(forms: DataFrame, counts: DataFrame) -> DataFrame:
    """``form, form_n, printed, printed_n, misread``: each distinct form with its count and its most frequent correction."""
    own = forms.select("form").distinct()
    known = counts.select(F.col("form").alias("printed"), F.col("n").alias("printed_n"))
    best = own.mapInPandas(_candidates, "form string, printed string").hint("merge").join(known, "printed").groupBy("form").agg(F.max(F.struct("printed_n", "printed")).alias("best"))
    full = own.hint("merge").join(counts, "form", "left").hint("merge").join(best, "form", "left")
    full = full.select("form", F.coalesce("n", F.lit(0)).alias("form_n"), F.col("best.printed").alias("printed"), F.coalesce("best.printed_n", F.lit(0)).alias("printed_n"))
    return full.withColumn("misread", _is_misread(F.col("form").rlike(r"[0-9@!|$]")))


def lexicon(counts: DataFrame, most: int = 20_000) -> frozenset[str]:
    """The *most* most frequent words that are not misread themselves, for the tasks' quick path."""
    sound = counts.hint("merge").join(judged(counts, counts).filter("misread").select("form"), "form", "left_anti")
    rows = sound.orderBy(F.desc("n"), "form").limit(most).select("form").collect()
    return frozenset(r[0] for r in rows)


class Reader:
    """Reads one row after another with a model and a lexicon."""

    def __init__(self, model: Model, known: frozenset[str]):
        self.model, self.known = model, known
        self._fine: set[str] = set()

    def labels(self, lines: list[str], breaks: bool = True) -> list[int]:
        """The states of a row's lines; without *breaks*, all 0 where every line is surely body or break."""
        seen = features(lines)
        if not breaks and all(map(self.model.quiet, seen)):
            return [0] * len(seen)
        return self.model.decode(seen)

    def unknown(self, tokens: set[str]) -> set[str]:
        """The forms of *tokens* that are to be judged by counts. Tokens seen to be fine are kept, so that each is looked at once."""
        forms, known = set(), self.known
        if len(self._fine) > 200_000:
            self._fine.clear()
        for t in tokens - self._fine:
            form = t.strip(_EDGE).lower()
            if form in known or not worth_judging(form):
                self._fine.add(t)
            else:
                forms.add(form)
        return forms

    def damage(self, text: str, running: bool = True) -> tuple[set[str], list[tuple[str, str, str, str, str]]]:
        """The damage settled at once, and the forms to be settled by counts: ('misread', form, '', '', '') or
        ('hyphen', joined, compound, first half, second half).
        In what is no *running* text only words are judged."""
        text = plain(text)
        open_: list[tuple[str, str, str, str, str]] = []
        if not running:  # neither lines to label nor words cut at line ends
            whole = _CUT_WORD.sub(" ", text) if "\n" in text else text
            return set(), [("misread", f, "", "", "") for f in self.unknown(set(whole.split()))]
        lines = text.split("\n")
        states = self.labels(lines, breaks=False)
        found = {STATES[s] for s in states if s >= 2}
        body = [line for line, s in zip(lines, states) if s < 2]
        words_, cut = set(), ""
        for i, line in enumerate(body):
            tokens = line.split()
            if not tokens:
                continue
            if cut:
                rest = tokens[0]
                joined, compound = cut + rest, f"{cut}-{rest}"
                joined, compound = joined.strip(_EDGE).lower(), compound.strip(_EDGE).lower()
                if rest[:1].isalpha() or rest[:1] in SYMBOLS:
                    open_.append(("hyphen", joined, compound, cut.strip(_EDGE).lower(), rest.strip(_EDGE).lower()))
                tokens = tokens[1:]
            cut = ""
            if i + 1 < len(body) and tokens and _ENDS_HYPHEN.search(line):
                cut = tokens.pop().rstrip(_HYPHENS)
            words_.update(tokens)
        open_.extend(("misread", f, "", "", "") for f in self.unknown(words_))
        return found, open_

    def paragraphs(self, text: str, fixes: dict[str, str], kept: set[str], running: bool = True) -> str:
        """The row as continuous paragraphs: heads and numbers dropped, words rejoined (*kept*: compounds), forms replaced.
        In what is no *running* text only forms are replaced."""
        if not running:
            return re.sub(r"\S+", lambda m: self._fixed(m[0], fixes), plain(text)) if fixes else text
        text = plain(text)
        lines = text.split("\n")
        states = self.labels(lines)
        out: list[str] = []
        for line, s in zip(lines, states):
            if s >= 2:
                continue
            tokens = line.split()
            if not tokens:
                continue
            if out and out[-1] and (m := _ENDS_HYPHEN.search(out[-1])) and s != 1:
                head, _, last = out[-1].rstrip().rpartition(" ")
                last = last.rstrip(_HYPHENS)
                compound = f"{last}-{tokens[0]}"
                bare = compound.strip(_EDGE).lower()
                joined = compound if bare in kept else last + tokens[0]
                out[-1] = " ".join(x for x in (head, joined, *tokens[1:]) if x)
            elif out and s == 0:
                out[-1] += " " + " ".join(tokens)
            else:
                out.append(" ".join(tokens))
        if not fixes:
            return "\n".join(out)
        return "\n".join(" ".join(self._fixed(t, fixes) for t in p.split(" ")) for p in out)

    @staticmethod
    def _fixed(token: str, fixes: dict[str, str]) -> str:
        core = token.strip(_EDGE)
        good = fixes.get(core.lower())
        if not good:
            return token
        at = token.find(core)
        return token[:at] + (good.capitalize() if core[:1].isupper() else good) + token[at + len(core) :]


class Scans:
    """The scanned rows of several tables: name -> (rows, key column). The text is in ``text``.

    Null keys and texts take no part; rows repeated exactly count once in the results; blank texts have no damage;
    empty tables give no rows; other columns are ignored but for ``type`` and ``text_level``: where a table has
    them, rows of type text, in any case, without a level are running text. Words are judged in every row, lines and
    cuts in running text.
    """

    def __init__(self, tables: dict[str, tuple[DataFrame, str]], lexicon_words: int = 20_000):
        self.spark = next(iter(tables.values()))[0].sparkSession
        some = None
        for name, (rows, key) in tables.items():
            has = F.col("text").isNotNull() & F.col(key).isNotNull()
            running = F.lit(True)
            if "type" in rows.columns:
                running &= F.coalesce(F.lower("type") == "text", F.lit(False))
            if "text_level" in rows.columns:
                running &= F.col("text_level").isNull()
            one = rows.filter(has).select(F.lit(name).alias("tbl"), F.col(key).cast("long").alias("row_key"), "text", running.alias("running"))
            some = one if some is None else some.unionByName(one)
        self.texts = self.whole = some
        tally = settled(tallied(self.texts), self.spark)
        self.counts = tally.filter("not lines").select("form", "n")
        self.model = self._fit(tally.filter("lines").select("form", "n"))
        self.known = lexicon(self.counts, lexicon_words)

    @staticmethod
    def _fit(rows: DataFrame, rounds: int = 4) -> Model:
        """The model fitted on *rows* (``form``: coded lines, ``n``), all of them; what comes to the driver in each round are its sums."""
        model = Model.prior()
        for _ in range(rounds):

            def run(batches: Iterator[pa.RecordBatch], model: Model = model) -> Iterator[pa.RecordBatch]:
                total = 0
                for b in batches:
                    total = total + model.expected(b.column(0).to_pylist(), b.column(1).to_pylist())
                if not isinstance(total, int):
                    yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total, pa.int64())], names=["at", "n"])

            sums = {r["at"]: r["n"] for r in rows.mapInArrow(run, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()}
            if not sums:
                return model
            model = Model.updated(np.array([float(sums[i]) for i in range(len(sums))]))
        return model

    def _read(self) -> DataFrame:
        """``tbl, row_key, damage, form, compound, head, tail``: damage settled at once has an empty form."""
        model, known = self.model, self.spark.sparkContext.broadcast(self.known)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            reader = Reader(model, known.value)
            for b in batches:
                cols: list[list] = [[], [], [], [], [], [], []]
                for tbl, key, text, running in zip(*(b.column(i).to_pylist() for i in range(4))):
                    if not text.strip():
                        continue
                    found, open_ = reader.damage(text, running)
                    for one in [*((d, "", "", "", "") for d in sorted(found)), *open_]:
                        for col, v in zip(cols, (tbl, key, *one)):
                            col.append(v)
                types = [pa.string(), pa.int64(), *[pa.string()] * 5]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["tbl", "row_key", "damage", "form", "compound", "head", "tail"])

        return self.whole.mapInArrow(run, "tbl string, row_key long, damage string, form string, compound string, head string, tail string")

    def settled_damage(self) -> DataFrame:
        """``tbl, row_key, damage, form, compound, printed``: all damage, that settled by counts included.

        For a cut word *form* is the rejoined word. *damage* 'compound' marks a compound cut at its own hyphen.
        """
        read = settled(self._read(), self.spark)
        open_ = read.filter("form <> ''")
        cut = open_.filter("damage = 'hyphen'").select("form", "compound", "head", "tail").distinct()
        forms = open_.filter("damage = 'misread'").select("form").unionByName(cut.select(F.explode(F.array("form", "compound", "head", "tail")).alias("form")))
        verdict = settled(judged(forms, self.counts), self.spark)
        words = open_.filter("damage = 'misread'").hint("merge").join(verdict.filter("misread").select("form", "printed"), "form")
        joined = verdict.select("form", "printed", "misread", F.greatest("form_n", F.when(F.col("misread"), F.col("printed_n")).otherwise(0)).alias("joined_n"))
        whole = verdict.select(F.col("form").alias("compound"), F.greatest("form_n", F.when(F.col("misread"), F.col("printed_n")).otherwise(0)).alias("compound_n"), F.col("misread").alias("compound_misread"), F.col("printed").alias("compound_printed"))
        head, tail = (verdict.select(F.col("form").alias(half), ((F.col("form_n") > 0) & ~F.col("misread")).alias(f"{half}_word")) for half in ("head", "tail"))
        for half, half_name in ((joined, "form"), (whole, "compound"), (head, "head"), (tail, "tail")):  # no side's size is bounded
            cut = cut.hint("merge").join(half, half_name)
        cuts = cut
        apart = (F.col("compound_n") > F.col("joined_n")) | (F.col("head_word") & F.col("tail_word") & (F.col("joined_n") == 0))
        pick = F.when(apart, F.array(F.struct(F.lit("compound").alias("damage"), F.lit(False).alias("bad")), F.struct(F.lit("misread").alias("damage"), (~F.col("compound_misread")).alias("bad")))).otherwise(
            F.array(F.struct(F.lit("hyphen").alias("damage"), F.lit(False).alias("bad")), F.struct(F.lit("misread").alias("damage"), (~F.col("misread")).alias("bad")))
        )
        cuts = cuts.select("form", "compound", "head", "tail", F.when(apart, F.col("compound_printed")).otherwise(F.col("printed")).alias("printed"), F.explode(pick).alias("p")).filter("not p.bad")
        cuts = open_.select("tbl", "row_key", "form", "compound", "head", "tail").hint("merge").join(cuts, ["form", "compound", "head", "tail"])
        none = F.lit(None).cast("string")
        return (
            read.filter("form = ''").select("tbl", "row_key", "damage", "form", "compound", none.alias("printed"))
            .unionByName(words.select("tbl", "row_key", "damage", "form", "compound", "printed"))
            .unionByName(cuts.select("tbl", "row_key", F.col("p.damage").alias("damage"), "form", "compound", F.when(F.col("p.damage") == "misread", F.col("printed")).alias("printed")))
        )

    def emissions(self) -> DataFrame:
        """``state, feature, value, prior, fitted``: what the fit made of the prior of each value of each feature in a state."""
        prior = Model.prior()
        rows = [
            (state, name, v, float(np.exp(prior.emit[f][i, v])), float(np.exp(self.model.emit[f][i, v])))
            for i, state in enumerate(STATES) for f, name in enumerate(FEATURES) for v in range(_SIZES[f])
        ]
        return self.spark.createDataFrame(rows, "state string, feature string, value int, prior double, fitted double")

    def damaged(self) -> DataFrame:
        """``tbl, row_key, damage``: 'hyphen', 'misread', 'header' or 'pageno', each once for a row."""
        return self.settled_damage().filter("damage <> 'compound'").select("tbl", "row_key", "damage").distinct()

    def repaired(self) -> DataFrame:
        """``tbl, row_key, repaired``: each distinct row of running text, whole, as continuous paragraphs separated by newlines,
        and each other row with a misread word, that word corrected."""
        found = self.settled_damage()
        fixes = found.filter("damage in ('misread', 'compound')").groupBy("tbl", "row_key").agg(
            F.collect_set(F.when(F.col("damage") == "misread", F.struct(F.when(F.col("compound") == "", F.col("form")).otherwise(F.col("form")).alias("form"), F.col("printed")))).alias("fixes"),
            F.collect_set(F.when(F.col("damage") == "compound", F.col("compound"))).alias("kept"),
        )
        model, known = self.model, self.spark.sparkContext.broadcast(self.known)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            reader = Reader(model, known.value)
            for pdf in batches:
                texts = []
                for text, running, fix, kept in zip(pdf["text"], pdf["running"], pdf["fixes"], pdf["kept"]):
                    table = {f["form"]: f["printed"] for f in fix if f["printed"]} if fix is not None else {}
                    texts.append(reader.paragraphs(text, table, set(kept) if kept is not None else set(), running))
                yield pd.DataFrame({"tbl": pdf["tbl"], "row_key": pdf["row_key"], "repaired": texts})

        # by key first, so that dropping repeated rows and the join need no other shuffle of the texts
        rows = self.whole.repartition("tbl", "row_key").distinct().hint("merge").join(fixes, ["tbl", "row_key"], "left").filter("running or size(fixes) > 0")
        return rows.mapInPandas(run, "tbl string, row_key long, repaired string")
