"""Test items in documents."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import rows
from vellumine.llm import leaks as K


def covered(item, doc):
    """The item's words in common runs of twelve or more words, by all diagonals."""
    inside = set()
    for shift in range(-len(item) + 1, len(doc)):
        run = []
        for i in range(len(item) + 1):
            if i < len(item) and 0 <= i + shift < len(doc) and item[i] == doc[i + shift]:
                run.append(i)
            else:
                if len(run) >= K.RUN:
                    inside.update(run)
                run = []
    return len(inside)


def edit(a, b):
    d = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, d[0] = d[0], i
        for j, y in enumerate(b, 1):
            last, d[j] = d[j], min(d[j] + 1, d[j - 1] + 1, last + (x != y))
    return d[-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=80), st.lists(st.sampled_from("abc"), max_size=20))
def test_myers_is_the_edit_distance(a, b):
    assert K.myers(a, b) == edit(a, b)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=12), st.lists(st.sampled_from("abc"), max_size=20))
def test_myers_inside_is_the_least_distance_of_a_stretch(a, b):
    assert K.myers(a, b, inside=True) == min(edit(a, b[i:j]) for i in range(len(b) + 1) for j in range(i, len(b) + 1))


def test_edited_copies(spark):
    item = [f"w{i}" for i in range(60)]
    wrong = [w if i % 9 != 4 or i > 50 else f"no{i}" for i, w in enumerate(item)]  # six errors, no run of twelve
    far = [w if i % 5 else f"no{i}" for i, w in enumerate(item)]
    less = wrong[:10] + wrong[11:30] + ["more"] + wrong[30:]
    docs = spark.createDataFrame([(i, " ".join(["so"] * 30 + w + ["on"] * 30)) for i, w in enumerate([wrong, far, item, less])], "doc_id long, text string")
    got = K.leaks(docs, spark.createDataFrame([(7, " ".join(item))], "item_id long, item_text string"))
    assert rows(got, "doc_id", "in_runs", "edits", "kind") == [(0, 0, 6, "edited"), (2, 60, 0, "exact"), (3, 0, 8, "edited")]


def test_soft_hyphens_at_line_ends():
    assert K.words("sepa\u00ad\n rate and co\u00adoperate") == ["separate", "and", "cooperate"]


def test_words():
    assert K.words("Time-\ndependent, TIME-dependent ti¬ \nme timе ｔｉｍｅ 10.5") == ["timedependent", "timedependent", "time", "time", "time", "10", "5"]


def damaged(words, rng):
    """A document: pieces of an item between other words, changed in case and broken by hyphens."""
    out = [rng.choice("pqrs") + str(rng.randrange(50)) for _ in range(rng.randrange(0, 40))]
    lo = rng.randrange(0, len(words))
    part = words[lo : lo + rng.randrange(1, len(words) + 1)]
    for i in range(len(part)):
        if rng.random() < 0.05:
            part[i] = "zzz"
    return out + part + out[:5] + words[: rng.randrange(0, 20)]


def test_found_matches_brute_force(spark):
    rng = random.Random(4)
    items = [(i, [f"w{rng.randrange(300)}" for _ in range(rng.choice([5, 11, 12, 13, 30, 64, 90]))]) for i in range(40)]
    docs = [(d, damaged(list(rng.choice(items)[1]), rng)) for d in range(400)]
    wanted = sorted((d, i) for d, doc in docs for i, item in items if covered(item, doc) * 2 >= len(item) > 0 and covered(item, doc))
    text = lambda ws: " ".join(w.upper() if k % 7 == 0 else w + "," if k % 5 == 0 else w[:1] + "-\n" + w[1:] if k % 11 == 0 and len(w) > 2 else w for k, w in enumerate(ws))
    d = spark.createDataFrame([(i, text(w), 9) for i, w in docs] + [(1000, None, 1), (1001, "", 1), (5, text(docs[5][1]), 9)], "doc_id long, text string, item_id long")
    t = spark.createDataFrame([(i, text(w), "x") for i, w in items] + [(99, None, "y"), (None, "a b", "z")], "item_id long, item_text string, text string")
    assert len(wanted) > 50 and rows(K.leaks(d, t).filter("kind = 'exact'"), "doc_id", "item_id") == sorted(wanted, key=lambda r: tuple((True, str(x)) for x in r))
    assert K.leaks(d.limit(0), t).count() == 0 and K.leaks(d, t.limit(0)).count() == 0
    few = K.leaks(d, t, most_chars=500)  # several blocks give what one gives
    assert rows(few) == rows(K.leaks(d, t))
    assert rows(K.leaked_items(few).filter("exact_docs > 0"), "item_id") == sorted({(i,) for _, i in wanted}, key=lambda r: str(r[0]))


def test_blocks_of_items_cover_all(spark):
    t = spark.createDataFrame([(i, "x" * 100) for i in range(50)], "item_id long, item_text string")
    blocks = list(K.item_blocks(t, most_chars=1000))
    assert len(blocks) == 5 and sorted(i for b in blocks for i, _ in b) == list(range(50))
