"""Linking of name variants."""

import itertools

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import rows
from vellumine.llm import names as N

SCHEMA = "ref_key long, authors array<string>, source string, extra string"


def refs(spark, authors, sources=()):
    data = [([a] * n, None) for a, n in authors] + [(None, s) for s, n in sources for _ in range(n)]
    return spark.createDataFrame([(i, a, s, "x") for i, (a, s) in enumerate(data)], SCHEMA)


PEOPLE = [
    ("Richard K. Vantorelu", 40), ("R. K. Vantorelu", 12), ("Vantorelu, R. K.", 5), ("Vantorelu RK", 4), ("RICHARD K. VANTORELU", 3), ("Dick Vantorelu", 2), ("Richrad K. Vantorelu", 2), ("R. K. Vantorleu", 2), ("Vantorelu Richard K", 2),
    ("Søren Vantorelu", 30), ("Soeren Vantorelu", 3), ("S. Vantorelu", 5), ("Vantorelu, Søren", 2), ("Sren Vantorelu", 1),
    ("Olga Pimaketor", 25), ("Pimaketor Olga", 4), ("O Pimaketor", 3), ("Olga Pimaketar", 1), ("Olga Tonabrek", 9), ("Tonabrek, Olga", 2),
]
GROUPS = [range(0, 9), range(9, 14), range(14, 18), range(18, 20)]


def wanted(forms, groups):
    return sorted(tuple(sorted(p)) for g in groups for p in itertools.combinations([forms[i][0] for i in g], 2))


def test_persons(spark):
    df = refs(spark, PEOPLE)
    got = N.variant_pairs(N.linked(df))
    assert rows(got, "name_lo", "name_hi") == wanted(PEOPLE, GROUPS)
    assert {r["kind"] for r in got.collect()} == {"author"}


VENUES = [
    ("Journal of Planar Optics", 30), ("J. Planar Opt.", 4), ("J Planar Opt", 3), ("JPO", 2), ("Planar Optics, Journal of", 2), ("The Journal of Planar Optics", 2), ("JOURNAL OF PLANAR OPTICS", 2), ("Journal of Planar Opttics", 1),
    ("Letters in Planar Optics", 20), ("Lett. Planar Opt.", 3), ("Transactions on Heat and Mass", 15), ("Transactions on Heat & Mass", 2), ("Trans. on Heat and Mass", 2),
]


def test_venues_and_kinds_apart(spark):
    got = rows(N.variant_pairs(N.linked(refs(spark, [], VENUES))), "kind", "name_lo", "name_hi")
    assert got == [("source", *p) for p in wanted(VENUES, [range(0, 8), range(8, 10), range(10, 13)])]


WORDS = [("Nature", 20), ("NATURE", 4), ("Natrue", 1), ("Optica", 9), ("Optica.", 2), ("Opticca", 1), ("Cell", 6), ("JPO", 3), ("JPA", 2), ("of the", 2), ("in", 1)]


def test_venues_of_one_word(spark):
    got = rows(N.variant_pairs(N.linked(refs(spark, [], WORDS + VENUES[:3]))), "kind", "name_lo", "name_hi")
    assert got == sorted(("source", *p) for p in wanted(WORDS, [range(0, 3), range(3, 6)]) + wanted([*VENUES[:3], ("JPO", 3)], [range(0, 4)]))


def test_a_surname_with_fifty_thousand_given_names(spark):
    import random

    rng = random.Random(5)
    names = sorted({"X" + "".join(rng.choice("abcdefghijklmnopqrstuvwyz") for _ in range(9)) for _ in range(50_000)})
    data = [(i, [f"{g} Wang"] * (3 if i == 7 else 1), None, "x") for i, g in enumerate(names)]
    data += [(-1, [f"{names[7][:4]}{names[7][5:]} Wang", f"Wang, {names[7]}"], None, "x")]
    links = N.linked(spark.createDataFrame(data, SCHEMA)).filter(f"entity = '{names[7]} Wang'")
    assert rows(links, "name") == sorted((x,) for x in (f"{names[7]} Wang", f"{names[7][:4]}{names[7][5:]} Wang", f"Wang, {names[7]}"))


def test_an_acronym_of_two_venues_goes_to_the_likelier(spark):
    venues = [("Journal of Planar Optics", 30), ("Journal of Polymer Oscillations", 9), ("JPO", 4)]
    got = N.variant_pairs(N.linked(refs(spark, [], venues)))
    assert rows(got, "name_lo", "name_hi") == [("JPO", "Journal of Planar Optics")]


def test_chains_are_followed_to_their_end(spark):
    chain = [("Vantorelup Olga", 1), ("Vantorelu Olga", 40), ("Vantorel Olga", 20), ("Vantore Olga", 10), ("Vantor Olga", 6), ("Vanto Olga", 3), ("Vant Olga", 2)]
    links = N.linked(refs(spark, [(f"Olga {x.split()[0]}", n) for x, n in chain]))
    assert {r["entity"] for r in links.collect()} == {"Olga Vantorelu"}


def test_ties_go_to_the_lesser_spelling(spark):
    links = N.linked(refs(spark, [("Olga Pimaketor", 9), ("Olga Pimaketir", 9), ("Olga Pimaketr", 1)]))
    assert {r["name"]: r["entity"] for r in links.collect()}["Olga Pimaketr"] in ("Olga Pimaketir", "Olga Pimaketor")
    assert rows(N.linked(refs(spark, [], [("Optic", 5), ("Optik", 5)])), "name", "entity") == [("Optic", "Optic"), ("Optik", "Optic")]


def test_no_side_is_broadcast(spark, monkeypatch):
    plans, settled = [], N.settled

    def noted(df, *rest):
        plans.append(df._jdf.queryExecution().sparkPlan().toString())
        return settled(df, *rest)

    monkeypatch.setattr(N, "settled", noted)
    last = N.variant_pairs(N.linked(refs(spark, PEOPLE, VENUES)))
    plans.append(last._jdf.queryExecution().sparkPlan().toString())
    assert any("SortMergeJoin" in p for p in plans) and not [p for p in plans if "Broadcast" in p]


def test_same_result_whatever_the_partitions(spark):
    df = refs(spark, PEOPLE, VENUES)
    assert rows(N.linked(df)) == rows(N.linked(df.repartition(7).orderBy("ref_key", ascending=False)))


def test_nulls_blanks_long_names_and_empty_tables(spark):
    odd = spark.createDataFrame([(1, None, None, None), (2, [None, "", "  ", ",", "."], "", "a"), (3, ["x" * 5000, "\n", "A. " * 300], "b" * 3000, "c")], SCHEMA)
    assert N.linked(odd).count() == 3  # what has a letter is a spelling
    assert N.variant_pairs(N.linked(odd)).count() == 0
    assert N.linked(odd.limit(0)).count() == 0


@pytest.mark.parametrize(
    "name, wanted",
    [
        ("Vantorelu, R. K.", ("vantorelu", "", "r", "k", True)), ("R. K. Vantorelu", ("vantorelu", "", "r", "k", True)), ("Vantorelu RK", ("vantorelu", "", "r", "k", True)), ("R.K. Vantorelu", ("vantorelu", "", "r", "k", True)),
        ("Łukasz B. Nado", ("nado", "", "lukasz", "b", True)), ("Olga Pimaketor", ("olga", "pimaketor", "", "", False)), ("Plato", ("plato", "", "", "", True)), ("WEI LU", ("wei", "lu", "", "", False)), ("", ("", "", "", "", True)),
    ],
)
def test_parts(name, wanted):
    assert N.parse_person(name) == wanted


def test_venue_words():
    assert N.parse_venue("Planar Optics & Heat, Proceedings of the Symposium on") == ["proceedings", "symposium", "planar", "optics", "heat"]


def distance(a, b):
    """Edit distance with transpositions of neighbours, by the table."""
    d = {(i, j): max(i, j) for i in range(len(a) + 1) for j in range(len(b) + 1) if not i or not j}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


@settings(max_examples=300, deadline=None)
@given(st.text("abc", max_size=6), st.text("abc", max_size=6))
def test_one_error(a, b):
    assert N.within_one(a, b) == (distance(a, b) <= 1)
    if N.within_one(a, b) and len(a) and len(b):
        assert set(N.deletions(a)) & set(N.deletions(b)) or distance(a, b) > 1


def test_long_words_share_a_key():
    word = "abcdefghij" * 30
    for typo in (word[:150] + word[151:], word[1:], word[:-1], word + "x", "x" + word, word[:60] + "xy" + word[62:]):
        near = N.within_one(word, typo)
        assert bool(set(N.deletions(word)) & set(N.deletions(typo))) or not near
    for n in range(60, 70):
        assert set(N.deletions("a" * 5 + "b" * n)) & set(N.deletions("a" * 5 + "b" * (n + 1)))
