"""Per-document text statistics, and the documents that are not prose.

Each document is reduced to a row of statistics. Ratios are taken of passages of some two hundred characters, and the
document's value is the median over its passages by characters: what more than half of its characters are decides it,
whatever the rest is. For each language the mean and covariance of prose are estimated robustly over all documents: from
medians and quartiles, the estimate is concentrated in a few rounds on the documents near it. The Mahalanobis distance
of a document from its language's prose is the sum of its statistics' contributions, which are reported, and it alone
decides: a document is no prose if it is further than a text with half the common words of that prose is in the mean.

Texts are read once; the rounds pass over the statistics alone and return moments whose size is fixed by the number
of statistics and of languages.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellumine.llm.confusables import look
from vellumine.sources.tables import settled

STATS = ["log_words", "word_length", "symbol_ratio", "digit_ratio", "odd_case_share", "line_end_share", "common_share", "single_share"]
COMMON = STATS.index("common_share")
#: The characters of a passage, and the finest step of a ratio in it: no deviation below that step counts.
PASSAGE = 200
STEP = 1 / PASSAGE
_END = ".!?:;…\"”"
_BLANKS, _DIGITS = b" \t\n\r\x0b\x0c", b"0123456789"
_CASES = bytes(97 if 97 <= i <= 122 else 65 if 65 <= i <= 90 else 32 for i in range(256))


class _Letters(dict):
    """Code point -> the letter in lower case, a blank for all else; filled as characters are met."""

    def __missing__(self, code: int) -> str:
        self[code] = out = chr(code).lower() if chr(code).isalpha() else " "
        return out


_LETTERS = _Letters()


def passages(lines: list[str]) -> list[str]:
    """The lines put together to passages of at least PASSAGE characters; lines of more than two passages are cut, at
    a blank if there is one near. The last passage takes what is left."""
    out, some, size = [], [], 0
    for line in lines:
        if len(line) > 2 * PASSAGE:
            if some:
                out.append("\n".join(some))
                some, size = [], 0
            at = 0
            while len(line) - at > 2 * PASSAGE:
                cut = line.rfind(" ", at + PASSAGE // 2, at + PASSAGE * 3 // 2)
                cut = cut if cut > at else at + PASSAGE
                out.append(line[at:cut])
                at = cut
            line = line[at:]
        some.append(line)
        size += len(line)
        if size >= PASSAGE:
            out.append("\n".join(some))
            some, size = [], 0
    if some:
        out.append("\n".join(some))
    return out


class Reader:
    """Statistics of texts, given the common words of each language."""

    def __init__(self, common: dict[str, frozenset[str]]):
        self.langs = sorted(common)
        # a word's languages as one number, so that one sum counts the hits of all languages
        self._of: dict[str, int] = {}
        for k, lang in enumerate(self.langs):
            for word in common[lang]:
                self._of[word] = self._of.get(word, 0) | 1 << 16 * k

    def hits(self, packed: int) -> list[int]:
        return [packed >> 16 * k & 0xFFFF for k in range(len(self.langs))]

    def statistics(self, texts: list[str], langs: list[str | None]) -> pd.DataFrame:
        """``lang_used, chars`` and STATS of each text; a text without words has zero shares. Look-alike letters count as
        plain ones. A passage's common words are those of the language that has most of them in it; a word's case is odd
        if a capital follows a small letter."""
        rows, first, told, ends, counts, find = [], [], [], [], [], self._of.get
        for text, lang in zip(texts, langs):
            lines = [x for x in map(str.rstrip, look(text).split("\n")) if x]
            first.append(len(rows))
            ends.append(sum([x[-1] in _END for x in lines]) / (len(lines) or 1))
            total, in_all = [0] * len(self.langs), 0
            for part in passages(lines):
                words, raw = part.translate(_LETTERS).split(), part.encode("utf-8", "replace")
                hits = self.hits(sum(map(find, words, repeat(0))))
                total = [a + b for a, b in zip(total, hits)]
                in_all += len(words)
                blanks, digits = (len(raw) - len(raw.translate(None, of)) for of in (_BLANKS, _DIGITS))
                odd = raw.translate(_CASES).count(b"aA")
                rows.append((len(words), len("".join(words)), len(part), len(part) - blanks, digits, odd, list(map(len, words)).count(1), max(hits, default=0)))
            counts.append(in_all)
            told.append(lang if lang in self.langs else self.langs[total.index(max(total))] if any(total) else None)
        x = np.array(rows, dtype=float).reshape(-1, 8)
        words, letters, chars, solid, digits, odd, single, hits = x.T
        n, all_ = np.maximum(words, 1), np.maximum(solid, 1)
        ratios = {"word_length": letters / n, "symbol_ratio": np.maximum(solid - letters - digits, 0) / all_, "digit_ratio": digits / all_, "odd_case_share": odd / n, "common_share": hits / n, "single_share": single / n}
        bounds = np.append(first, len(rows)).astype(int)
        doc = np.repeat(np.arange(len(texts)), np.diff(bounds))
        out = {"lang_used": told, "chars": np.bincount(doc, solid, len(texts)).astype(int), "log_words": np.log1p(counts), "line_end_share": ends}
        out |= {name: _medians(value, chars, doc, bounds) for name, value in ratios.items()}
        return pd.DataFrame(out)[["lang_used", "chars", *STATS]]


def _medians(value: np.ndarray, weight: np.ndarray, doc: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Each document's lower weighted median of its passages' values; 0 for a document without any."""
    out = np.zeros(len(bounds) - 1)
    if not len(value):
        return out
    order = np.lexsort((value, doc))
    run = np.cumsum(weight[order])
    before = np.append(0, run)[bounds]  # the documents' passages stay together, so sums are those at their bounds
    has = np.diff(bounds) > 0
    half = (before[:-1] + before[1:]) / 2
    out[has] = value[order][np.searchsorted(run, half[has])]
    return out


def common_word_sets(common_words: DataFrame, most: int = 100_000) -> dict[str, frozenset[str]]:
    """The common words by language; the table is a fixed list whose size is checked."""
    rows = common_words.filter(F.col("lang").isNotNull() & F.col("word").isNotNull()).select("lang", "word").distinct().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"common_words has more than {most} rows; it is meant to be a fixed list of frequent words")
    sets: dict[str, set[str]] = {}
    for lang, word in rows:
        sets.setdefault(lang, set()).add(word.lower())
    return {lang: frozenset(words) for lang, words in sets.items()}


def document_statistics(documents: DataFrame, common_words: DataFrame) -> DataFrame:
    """``doc_id, lang_used, chars`` and the columns of STATS for each document with text.

    *lang_used* is the document's language or, where that is null or has no common words, the one whose common words
    are most frequent in it; null if there are none. *chars* are the visible characters. Null texts give no row; an empty text has zero statistics.
    """
    common = common_word_sets(common_words)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader(common)
        for pdf in batches:
            stats = reader.statistics(pdf["text"].tolist(), pdf["lang"].tolist())
            stats.insert(0, "doc_id", pdf["doc_id"].to_numpy())
            yield stats

    docs = documents.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    return docs.mapInPandas(run, "doc_id long, lang_used string, chars long, " + ", ".join(f"{s} double" for s in STATS))


def chi2_quantile(d: int, z: float = 3.09) -> float:
    """The quantile of a chi-square distribution of d degrees at the normal quantile z (3.09: 0.999), Wilson and Hilferty."""
    return d * (1 - 2 / (9 * d) + z * math.sqrt(2 / (9 * d))) ** 3


#: Language -> mean and inverse covariance of prose, and the squared distance beyond which a text is none.
Model = dict[str, tuple[np.ndarray, np.ndarray, float]]


def _squared(x: np.ndarray, model: tuple) -> tuple[np.ndarray, np.ndarray]:
    """The squared distances and each statistic's contributions, which sum up to them."""
    off = x - model[0]
    parts = off * (off @ model[1])
    return parts.sum(axis=1), parts


def fitted(mean: np.ndarray, cov: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """The model of one language. A text with half the mean share of common words is, by that alone, ``(mean / 2) ** 2 / variance``
    away, and if its other statistics scatter as those of prose do, further by their number in the mean: that is the
    limit, if it is above the 0.999 quantile of the distance."""
    cov = cov + np.eye(len(mean)) * STEP**2
    half = (mean[COMMON] / 2) ** 2 / cov[COMMON, COMMON] + len(mean) - 1
    return mean, np.linalg.inv(cov), float(max(half, chi2_quantile(len(mean))))


def prose_model(stats: DataFrame, rounds: int = 4) -> Model:
    """Language -> robust mean, inverse covariance and limit of prose; the empty name holds all languages together.

    It starts from medians and quartiles (or, of a statistic that is all but constant between these, the 0.05 and 0.95 quantiles), then *rounds* times takes the moments of the documents within the 0.999 quantile
    of the last estimate. All documents take part at every round. Languages of fewer than 40 documents use the model of all.
    """
    d = len(STATS)
    some = stats.select(F.coalesce("lang_used", F.lit("")).alias("lang_used"), *STATS)
    quantiles = [F.percentile_approx(s, [0.05, 0.25, 0.5, 0.75, 0.95], 1000).alias(s) for s in STATS]
    rows = [*some.filter("lang_used <> ''").groupBy("lang_used").agg(F.count("*").alias("n"), *quantiles).filter("n >= 40").collect()]
    rows += some.agg(F.lit("").alias("lang_used"), F.count("*").alias("n"), *quantiles).filter("n > 0").collect()
    model: Model = {}
    for r in rows:
        least, low, middle, high, most = np.array([r[s] for s in STATS]).T
        spread = (high - low) / 1.349
        model[r["lang_used"]] = fitted(middle, np.diag(np.where(spread > STEP, spread, (most - least) / 3.29) ** 2))
    if not model:
        return {}
    within = chi2_quantile(d)
    for _ in range(rounds):

        def moments(batches: Iterator[pd.DataFrame], model=model) -> Iterator[pd.DataFrame]:
            sums: dict[str, list] = {}
            for pdf in batches:
                x, langs = pdf[STATS].to_numpy(), pdf["lang_used"].to_numpy()
                for lang in model:
                    own = x[langs == lang] if lang else x
                    own = own[_squared(own, model[lang])[0] <= within]
                    n, s, ss = sums.get(lang, (0, 0.0, 0.0))
                    sums[lang] = [n + len(own), s + own.sum(axis=0), ss + own.T @ own]
            yield pd.DataFrame([(lang, n, s.tolist(), ss.ravel().tolist()) for lang, (n, s, ss) in sums.items()], columns=["lang_used", "n", "s", "ss"])

        parts = some.mapInPandas(moments, "lang_used string, n long, s array<double>, ss array<double>")
        total = parts.groupBy("lang_used").agg(F.sum("n").alias("n"), *(F.sum(F.get("s", F.lit(i))).alias(f"s{i}") for i in range(d)), *(F.sum(F.get("ss", F.lit(i))).alias(f"q{i}") for i in range(d * d))).collect()
        fresh: Model = {}
        for r in total:
            if r["n"] and r["n"] > d:
                mean = np.array([r[f"s{i}"] for i in range(d)]) / r["n"]
                fresh[r["lang_used"]] = fitted(mean, np.array([r[f"q{i}"] for i in range(d * d)]).reshape(d, d) / r["n"] - np.outer(mean, mean))
        model = model | fresh
    return model


def outlierness(stats: DataFrame, model: Model) -> DataFrame:
    """The statistics with *distance2* (squared Mahalanobis distance), *limit2* and one contribution ``c_<statistic>`` for each."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf = pdf.reset_index(drop=True)
            out, x = np.zeros((len(pdf), 2 + len(STATS))), pdf[STATS].to_numpy()
            langs = pdf["lang_used"].fillna("").where(pdf["lang_used"].isin(list(model)), "")
            for lang in langs.unique():
                if lang in model:
                    rows = (langs == lang).to_numpy()
                    out[rows, 0], out[rows, 2:] = _squared(x[rows], model[lang])
                    out[rows, 1] = model[lang][2]
            yield pd.concat([pdf, pd.DataFrame(out, columns=["distance2", "limit2", *(f"c_{s}" for s in STATS)])], axis=1)

    return stats.mapInPandas(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stats.schema.fields) + ", distance2 double, limit2 double, " + ", ".join(f"c_{s} double" for s in STATS))


def quality(documents: DataFrame, common_words: DataFrame) -> DataFrame:
    """Statistics, distance, limit and contributions of each document; see document_statistics and outlierness."""
    stats = settled(document_statistics(documents, common_words), documents.sparkSession)
    return outlierness(stats, prose_model(stats))


def not_prose(rated: DataFrame) -> DataFrame:
    """``doc_id``: the documents further from the prose of their language than its limit. Blank texts are neither."""
    return rated.filter((F.col("chars") > 0) & (F.col("distance2") > F.col("limit2"))).select("doc_id").distinct()
