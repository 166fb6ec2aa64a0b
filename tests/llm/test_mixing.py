"""Mixing to target shares."""

import os

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import rows
from vellumine.llm import mixing as M

pytestmark = pytest.mark.skipif(not os.path.exists(M.TOKENIZER), reason="no vocabulary file")


def mixer(spark, **options):
    docs = [(i, f"word{i} " * (20 + i % 30), "big") for i in range(300)] + [(1000 + i, "small text here " * 10, "small") for i in range(40)] + [(2000, None, "big"), (2001, "", "small"), (2002, "no source", None), (3, "word3 " * 23, "big")]
    targets = [(1, "big", 0.5, 2), (1, "small", 0.3, 2), (1, "none", 0.2, 9), (2, "big", 0.9, 1), (2, "small", 0.1, 4), (3, "none", 1.0, 1), (2, "small", 0.1, 4), (None, "big", 1.0, 1), (4, None, 1.0, 3), (5, "big", float("nan"), 1), (5, "small", None, 1), (6, "small", 1.0, None), (7, "small", -1.0, -1)]
    d = spark.createDataFrame([(*x, "c") for x in docs], "doc_id long, text string, source string, tokens string")
    t = spark.createDataFrame(targets, "mix_id long, source string, target_share double, max_repeats int")
    return M.Mixer(d, t, **{"block": 64, "slots": 32, "part_docs": 100, **options})


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 3000), st.integers(0, 1 << 50))
def test_permutation(n, key):
    assert sorted(M.permuted(np.arange(n), n, key)) == list(range(n))


def test_blocks_hold_every_token_once(spark):
    m = mixer(spark)
    counted = {r["doc_id"]: r["n_tokens"] for r in m.counted.collect()}
    pieces = m.pieces().collect()
    got, blocks = {}, {}
    for p in pieces:
        got.setdefault(p["doc_id"], []).append((p["token_from"], p["token_to"]))
        blocks[p["source"], p["block_no"]] = blocks.get((p["source"], p["block_no"]), 0) + p["token_to"] - p["token_from"]
    for doc, n in counted.items():
        spans = sorted(got[doc])
        assert spans[0][0] == 0 and spans[-1][1] == n and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    assert blocks == {(r["source"], r["block_no"]): r["block_tokens"] for r in m.blocks.collect()} and max(blocks.values()) == 64


def test_unreachable_matches_brute_force(spark):
    m = mixer(spark)
    tokens = {}
    for r in m.counted.collect():
        tokens[r["source"]] = tokens.get(r["source"], 0) + r["n_tokens"]
    targets = [tuple(r) for r in m.targets.collect()]
    wanted = sorted((i, s) for i, s, share, most in targets if share is not None and most is not None and most * tokens.get(s, 0) < share * sum(tokens.get(x, 0) for j, x, _, _ in targets if j == i))
    assert sorted(tuple(r) for r in m.unreachable().collect()) == wanted and (1, "none") in wanted and (1, "small") in wanted


def test_no_block_is_used_too_often_and_shares_add_up(spark):
    m = mixer(spark)
    used = {}
    for r in m.slotted.collect():
        used[r["mix_id"], r["source"], r["block_no"]] = used.get((r["mix_id"], r["source"], r["block_no"]), 0) + 1
        assert r["use"] < 4
    most = {(r["mix_id"], r["source"]): r["max_repeats"] for r in m.targets.collect()}
    assert all(most[k[:2]] is None or n <= most[k[:2]] for k, n in used.items())
    slots = {}
    for (mix, _, _), n in used.items():
        slots[mix] = slots.get(mix, 0) + n
    room = {r["mix_id"]: r["mix_blocks"] for r in m.capacity.collect()}
    assert slots[1] == room[1] and slots[6] == room[6]  # what "none" and "small" can't give is drawn again
    shares = m.shares().collect()
    for mix in (1, 2):
        assert sum(r["actual_share"] for r in shares if r["mix_id"] == mix) == pytest.approx(1)
    big = next(r for r in shares if (r["mix_id"], r["source"]) == (2, "big"))
    assert big["actual_share"] == pytest.approx(0.9, abs=0.08)
    assert m.mixed().filter("mix_id = 2").groupBy("source").count().count() == 2


def test_same_mix_again(spark):
    assert rows(mixer(spark).slotted) == rows(mixer(spark).slotted)


def test_empty_tables(spark):
    m = mixer(spark)
    none = M.Mixer(m.documents.limit(0), m.targets)
    assert none.mixed().count() == 0 and none.shares().count() == m.targets.count()
    assert M.Mixer(m.documents, m.targets.limit(0)).shares().count() == 0
