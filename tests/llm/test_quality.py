"""Text statistics and outliers from prose."""

import random

import pytest

from tests.conftest import rows
from vellumine.llm import quality as Q

EN = "the a of and in is was with for that it as we by to on are has been".split()
DE = "die der das und in ist war mit für dass es wir von zu auf den nicht".split()


def prose(rng, words, n):
    body = [rng.choice(words) if i % 2 else "".join(rng.choice("bdfgklmnprstaeiou") for _ in range(rng.randrange(4, 10))) for i in range(n)]
    out = []
    for i, w in enumerate(body):
        out.append((w.capitalize() if i % 12 == 0 else w) + ("." if i % 12 == 11 else ""))
    return " ".join(out)


def corpus():
    rng, docs, junk = random.Random(1), [], set()
    for i in range(240):
        words = EN if i % 3 else DE
        text = prose(rng, words, rng.randrange(30, 200))
        if i % 10 == 0:
            kind = i // 10 % 4
            text = ["\n".join(f"{rng.random():.2f}\t{rng.random():.2f}" for _ in range(40)), "".join(rng.choice("#$%&/{}[]<>!? ") for _ in range(400)), "\n".join(f"- part{j};{j};ohm" for j in range(40)), text[:60] + "\n" + "\n".join(f"{j} 7.5 3.1 kHz" for j in range(60))][kind]
            junk.add(i)
        docs.append((i, text, (None if i % 7 == 0 else "en" if i % 3 else "de"), "x"))
    return docs + [(900, None, "en", "x"), (901, "", "en", "x"), (902, "word", None, "x"), docs[5]], junk


@pytest.fixture(scope="module")
def tables(spark):
    docs, junk = corpus()
    common = [("en", w) for w in EN] + [("de", w) for w in DE] + [(None, "q"), ("en", None)]
    return spark.createDataFrame(docs, "doc_id long, text string, lang string, distance2 string"), spark.createDataFrame(common, "lang string, word string"), junk


def test_junk_is_found(tables):
    docs, common, junk = tables
    found = {r[0] for r in Q.not_prose(Q.quality(docs, common)).collect()}
    assert found - {901, 902} == junk and 900 not in found


def test_contributions_add_up_to_the_distance(tables):
    docs, common, _ = tables
    for r in Q.quality(docs, common).collect():
        assert sum(r[f"c_{s}"] for s in Q.STATS) == pytest.approx(r["distance2"], rel=1e-6, abs=1e-6)


def reader():
    return Q.Reader({"en": frozenset(EN), "de": frozenset(DE)})


def test_statistics_by_hand():
    one = reader().statistics(["The cat is 12!\nNo aB", "", "12"], [None, "en", "xx"])
    got = one.iloc[0]
    assert got["lang_used"] == "en" and got["chars"] == 15 and got["word_length"] == pytest.approx((3 + 3 + 2 + 2 + 2) / 5) and got["digit_ratio"] == pytest.approx(2 / 15) and got["symbol_ratio"] == pytest.approx(1 / 15)
    assert got["line_end_share"] == 0.5 and got["common_share"] == pytest.approx(2 / 5) and got["odd_case_share"] == pytest.approx(1 / 5)
    assert one.iloc[1].tolist()[1:] == [0] * 9 and one.iloc[2]["digit_ratio"] == 1 and one.iloc[2]["lang_used"] is None


def test_passages_hold_the_whole_text():
    for lines in ([], ["a"], ["x" * 999], ["ab " * 300, "c"], ["short"] * 200):
        assert "".join("".join(Q.passages(lines)).split()) == "".join("".join(lines).split())
        assert all(len(p) <= 4 * Q.PASSAGE for p in Q.passages(lines))


@pytest.mark.parametrize("lines, is_prose", [(8, True), (60, False)])
def test_the_greater_part_decides(tables, spark, lines, is_prose):
    docs, common, _ = tables
    rng = random.Random(2)
    text = prose(rng, EN, 80) + "\n" + "\n".join("1.5\t2.5\t3.5" for _ in range(lines))
    more = docs.union(spark.createDataFrame([(1000, text, "en", "x"), (1001, "\n".join(reversed(text.split("\n"))), None, "x")], docs.schema))
    found = {r[0] for r in Q.not_prose(Q.quality(more, common)).collect()}
    assert ({1000, 1001} & found == set()) is is_prose


def test_capitals_and_other_languages_are_prose(tables, spark):
    docs, common, _ = tables
    rng = random.Random(3)
    more = docs.union(spark.createDataFrame([(1000, prose(rng, EN, 150).upper(), "en", "x"), (1001, prose(rng, DE, 150), "en", "x")], docs.schema))
    assert not {1000, 1001} & {r[0] for r in Q.not_prose(Q.quality(more, common)).collect()}


def test_empty_tables(tables):
    docs, common, _ = tables
    assert Q.quality(docs.limit(0), common).count() == 0
    assert rows(Q.document_statistics(docs, common.limit(0)).filter("lang_used is not null")) == []
