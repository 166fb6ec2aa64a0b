"""One form for look-alike texts."""

import unicodedata

import pytest
from hypothesis import given
from hypothesis import strategies as st

from tests.conftest import rows
from vellumine.llm import confusables as C


@pytest.mark.parametrize(
    "a, b",
    [
        ("ｆｕｌｌ １２３", "full 123"), ("résumé", "résumé"), ("ze​ro­", "zero"), ("a b c", "a b c"), ("pаypаl", "paypal"), ("сор", "cop"), ("5 µm Ω Å K", "5 μm Ω Å K"),
        ("eﬃcient ﬁlm", "efficient film"), ("Κατ", "Kατ"), ("Νature", "Nature"), ("ӧber", "öber"), ("ӧber", "öber"), ("time‐dependent", "time-dependent"),
    ],
)
def test_alike(a, b):
    assert C.look(a) == C.look(b)


@pytest.mark.parametrize("a, b", [("10²", "102"), ("α-Phase", "a-Phase"), ("Rôle", "Role"), ("Text", "text"), ("kΩ", "kO"), ("a b", "ab"), ("a  b", "a b"), ("β", "B"), ("ω", "w")])
def test_unlike(a, b):
    assert C.look(a) != C.look(b)


@pytest.mark.parametrize("word", "он сон рот Том то το τον Νίκος Россия Ελλάδα kΩ MΩ μm μA αβ Հայաստան".split())
def test_words_of_one_script_and_units_stay(word):
    assert C.look(word) == unicodedata.normalize("NFC", word)


@pytest.mark.parametrize("a, b", [("Росcия", "Россия"), ("Օk", "Ok"), ("Ꭺpple", "Apple"), ("𝐀bc", "Abc"), ("ｶﾞｽ", "ガス"), ("￥5", "¥5"), ("Ⅳ", "IV"), ("ⲥhemi", "chemi"), ("ϹΟ2", "CO2"), ("Ｍΐκρο", "Μΐκρο")])
def test_other_scripts(a, b):
    assert C.look(a) == b


def test_whole_script_words_follow_the_text():
    latin, foreign = "cop", "сор"
    assert C.look(f"Он сказал {latin} и ушёл") == C.look(f"Он сказал {foreign} и ушёл") == f"Он сказал {foreign} и ушёл"
    assert C.look(f"The {foreign} has left, он said") == C.look(f"The {latin} has left, он said") == f"The {latin} has left, он said"
    assert C.look(foreign) == latin


def test_script_sets():
    assert C.resolved("он") == {"CYRILLIC"} and C.resolved("сор") >= {"LATIN", "CYRILLIC"} and C.resolved("12") is None
    assert C.is_mixed("βeta") and not C.is_mixed("pаypаl") and C.consistent("оtеl") == "otel"


@given(st.text("абвсерοναΑаbcopeτМΩμ ", max_size=30))
def test_a_form_does_not_depend_on_the_coding(text):
    back = {"CYRILLIC": {}, "GREEK": {}}
    for script in back:
        letters, latin = C.LETTERS[script]
        back[script] = dict(zip(letters, latin))
    plain = "".join(back["CYRILLIC"].get(c, back["GREEK"].get(c, c)) for c in text)
    assert C.look(text) == C.look(plain)


def test_groups_hold_all_pairs(spark):
    texts = ["abc", "аbc", "abc", "x", "х", "y", "y", None, ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k long, t string")
    assert rows(C.look_groups({"one": (df.union(df), "k", "t")})) == [("one", 0, 0, 2), ("one", 1, 0, 2), ("one", 2, 0, 2), ("one", 3, 3, 2), ("one", 4, 3, 2)]


@given(st.text(max_size=60))
def test_idempotent_and_never_raises(text):
    once = C.look(text)
    assert C.look(once) == once


@given(st.text("abc éäö²αΩ", max_size=40))
def test_composition_never_matters(text):
    assert C.look(unicodedata.normalize("NFD", text)) == C.look(unicodedata.normalize("NFC", text))


def test_pairs_match_brute_force(spark):
    texts = ["abc", "аbc", "abc", "ab​c", "x", "х", None, "", "  ", " ", "y" * 9000, "y" * 8999 + "у", "10²", "102", "same", "same"]
    df = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "k long, t string, key string")
    df = df.union(df.filter("k < 3"))
    wanted = sorted(("one", i, j) for i in range(len(texts)) for j in range(i + 1, len(texts)) if texts[i] and texts[j] and texts[i].strip() and texts[j].strip() and texts[i] != texts[j] and C.look(texts[i]) == C.look(texts[j]))
    assert wanted and sorted(tuple(r) for r in C.lookalikes({"one": (df, "k", "t")}).collect()) == wanted
    assert C.lookalikes({"one": (df.limit(0), "k", "t")}).count() == 0


def test_one_form_column(spark):
    df = spark.createDataFrame([(1, "ﬁ"), (2, None), (3, "")], "key long, text string")
    assert rows(C.one_form(df, "text"), "key", "look") == [(1, "fi"), (2, None), (3, "")]
    assert C.one_form(df.limit(0), "text").count() == 0
