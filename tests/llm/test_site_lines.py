"""Lines repeated within one source, and the bitmaps they are kept in."""

import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import rows
from vellumine.llm import bitmaps as B
from vellumine.llm import site_lines as L

SCHEMA = "item_id long, paper_id long, source string, type string, text string, text_level int, chunk string, line_key string"


def brute(data, least=3, share=0.15):
    """By plain loops over distinct rows."""
    papers, seen, at = {}, {}, []
    for item, paper, source, kind, text, level in set(data):
        if paper is not None:
            papers.setdefault(source, set()).add(paper)
        if kind and kind.lower() == "text" and level is None and text is not None and paper is not None:
            for n, line in enumerate(text.split("\n")):
                if len(re.findall(r"[^\W\d_]+", line)) >= 4:
                    key = source, re.sub(r"\d+", "0", line.lower())
                    seen.setdefault(key, set()).add(paper)
                    at.append((key, item, n))
    keep = {k for k, p in seen.items() if len(p) >= least and len(p) >= share * len(papers[k[0]])}
    return sorted({(item, n) for k, item, n in at if k in keep})


def corpus():
    rng, data, item = np.random.default_rng(3), [], 0
    for source, papers in (("big", 60), ("mid", 12), (None, 5), ("tiny", 2)):
        for p in range(papers):
            paper = hash((source, p)) % (1 << 40) - (1 << 30)
            for i in range(3):
                item += 1
                lines = [f"Body {item} of its own words here"]
                if rng.random() < 0.2:
                    lines.insert(int(rng.integers(0, 2)), f"Downloaded from Site on {rng.integers(1, 99)} by reader {rng.integers(1, 99)}")
                if rng.random() < 0.12:
                    lines.append("THE PROOF IS GIVEN BELOW" if rng.random() < 0.5 else "The proof is given below")
                if rng.random() < 0.5:
                    lines.append("three words only 7")
                data.append((item, paper, source, "Text" if i else "text", "\n".join(lines), None))
    data += [(item + 1, 5, "big", "equation", "x\nDownloaded from Site on 1 by reader 2", None), (item + 2, 5, "big", "text", "Downloaded from Site on 1 by reader 2", 1), (item + 3, None, "big", "text", "a b c d", None), (item + 4, 5, "big", "text", None, None), (item + 5, 5, "big", "text", "", None)]
    return data + data[:20]


def table(spark, data):
    return spark.createDataFrame([(*d, "c", "k") for d in data], SCHEMA)


def test_places_match_brute_force(spark):
    data = corpus()
    wanted = brute(data)
    assert wanted and sorted(tuple(r) for r in L.site_lines(table(spark, data)).collect()) == wanted


def test_text_without_them(spark):
    data = corpus()
    gone = set(brute(data))
    got = dict(rows(L.without_site_lines(table(spark, data)), "item_id", "clean_text"))
    for item, _, _, _, text, _ in data:
        assert got[item] == (None if text is None else "\n".join(x for n, x in enumerate(text.split("\n")) if (item, n) not in gone))


def test_report_counts(spark):
    found = L.site_line_report(table(spark, corpus())).collect()
    assert sum(r["n_lines"] for r in found) == len(brute(corpus())) and all(r["line_papers"] >= 0.15 * r["papers"] for r in found)


def test_empty_table(spark):
    assert L.site_lines(table(spark, corpus()).limit(0)).count() == 0


ids = st.lists(st.integers(-(1 << 62), 1 << 62), max_size=50)


@settings(max_examples=100, deadline=None)
@given(ids, ids)
def test_bitmaps_are_sets(a, b):
    x, y = B.pack(a), B.pack(b)
    assert list(B.unpack(x)) == sorted(set(a)) and B.cardinality(x) == len(set(a))
    assert list(B.unpack(B.union([x, y]))) == sorted(set(a) | set(b))
    assert list(B.contains_all(x, np.array(b, dtype=np.int64))) == [v in set(a) for v in b]
    assert [v for _, c in B.chunks(x) for v in B.unpack(c)] == sorted(set(a))


def test_dense_chunks_become_bits():
    some = range(10, 60_000)
    packed = B.pack(some)
    assert len(packed) < 8300 and list(B.unpack(packed)) == list(some) and B.union([packed, B.pack([5])])[:1] is not None
    assert B.cardinality(B.union([packed, B.pack([5, 70_000])])) == len(some) + 2
