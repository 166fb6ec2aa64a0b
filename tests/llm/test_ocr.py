"""Damage of scanned text and its repair."""

import pytest

from tests.conftest import rows
from vellumine.llm import ocr as O

CLEAN = "The amplifier was measured before the detector and the crystal rises with the small-signal plasma in the layer because they differ which means the time-dependent symmetry fundamental modulator"
BODY = [
    ("c", 1, "The ampli-\nfier was measured be-\nfore the crystal.", {"hyphen"}),
    ("c", 2, "The small-\nsignal plasma was measured\nin the layer.", set()),
    ("c", 3, "The bef0re layer wh!ch\nmeans the fundamenfal\nplasma.", {"misread"}),
    ("c", 4, "The amplifier was meas-\n382   Norte and others / On the Symmetry of\nured before the layer.", {"header", "hyphen"}),
    ("c", 5, "The amplifier was measured\n— 617 —\nbefore the layer.", {"pageno"}),
    ("c", 6, "ON THE SYMMETRY OF LAYERS   383", {"header"}),
    ("c", 7, "Norte et al.: On the Symmetry of", {"header"}),
    ("c", 8, "Page 12", {"pageno"}),
    ("c", 9, "A. Norte, B. Suda, C. Vest", set()),
    ("c", 10, "The authors of\n[13].", set()),
    ("c", 11, "The аmplіfier was\nmeａsured in the lay­er.", set()),
    ("c", 12, "The crys-\ntаl was measurcd.", {"hyphen", "misread"}),
    ("c", 13, None, set()), ("c", 14, "", set()), ("c", 15, "  \n ", set()), ("c", 16, "the layer\n" * 3000, set()),
    ("c", 17, "the fundamental modul-\n-\n\nator rises", None),
]


@pytest.fixture(scope="module")
def scans(spark):
    data = [(k, "Text" if k % 2 else "text", None, t) for _, k, t, _ in BODY] + [(100 + i, "text", None, CLEAN) for i in range(60)]
    data += [(500, "text", 1, "ON THE SYMMETRY OF LAYERS   383"), (501, "equation", None, "12"), (502, None, None, "12"), data[0]]
    content = spark.createDataFrame([(*d, "clash") for d in data], "item_id long, type string, text_level int, text string, row_key string")
    return O.Scans({"content_list": (content, "item_id"), "paragraphs": (content.filter("item_id in (4, 6)").select(content["item_id"].alias("para_key"), "text"), "para_key")})


def test_damage(scans):
    got = {}
    for tbl, key, damage in (tuple(r) for r in scans.damaged().collect()):
        got.setdefault((tbl, key), set()).add(damage)
    for _, key, text, wanted in BODY:
        if wanted is not None:
            assert got.get(("content_list", key), set()) == wanted, text
    assert got["paragraphs", 4] == {"header", "hyphen"} and not {k for k in got if k[1] >= 100}


def test_repair(scans):
    text = dict(rows(scans.repaired().filter("tbl = 'content_list'"), "row_key", "repaired"))
    assert text[1] == "The amplifier was measured before the crystal."
    assert text[2] == "The small-signal plasma was measured in the layer."
    assert text[3] == "The before layer which means the fundamental plasma."
    assert text[4] == "The amplifier was measured before the layer."
    assert text[5] == "The amplifier was measured before the layer."
    assert text[6] == "" and text[12] == "The crystal was measured."


def test_empty_table(spark):
    none = spark.createDataFrame([], "item_id long, type string, text_level int, text string")
    s = O.Scans({"content_list": (none, "item_id")})
    assert s.damaged().count() == 0 and s.repaired().count() == 0


def test_corrections_undo_shapes():
    assert "before" in O.corrections("bef0re") and "modern" in O.corrections("modem") and "crystal" in O.corrections("crvsfal") and "in" in O.corrections("m")
    assert O.corrections("plain-text") is not None


def test_quiet_lines_are_never_heads():
    model = O.Model.prior()
    lines = [O.features(x.split("\n")) for x in ("the body goes on\nand on.", "ON THE SYMMETRY   3", "12", "A. Norte, B. Suda")]
    for row in lines:
        if all(map(model.quiet, row)):
            assert max(model.decode(row)) < 2
    assert not model.quiet(lines[1][0]) and not model.quiet(lines[2][0]) and model.quiet(lines[0][0])


def test_fit_keeps_probabilities():
    import numpy as np

    rows_ = [O.features(t.split("\n")) for _, _, t, _ in BODY if t and t.strip()]
    m = O.Model.prior().fitted(rows_)
    assert np.allclose(np.exp(m.start).sum(), 1) and np.allclose(np.exp(m.move).sum(axis=1), 1) and all(np.allclose(np.exp(e).sum(axis=1), 1) for e in m.emit)


def test_words_of_every_row_are_judged(spark):
    line = "The bef0re layer rises. " + " ".join([CLEAN] * 4)
    data = [(1, "text", None, line), (2, "text", None, "The bef0re layer."), (3, "text", 1, "Layers bef0re the plasma"), (4, None, None, "The crystal\nbef0re the ampli-\nfier"), (5, "text", 1, "Layers before the plasma")]
    assert len(line) > 500
    rest = [(100 + i, "text", None, CLEAN) for i in range(60)]
    s = O.Scans({"content_list": (spark.createDataFrame(data + rest, "item_id long, type string, text_level int, text string"), "item_id")})
    assert rows(s.damaged(), "row_key", "damage") == [(k, "misread") for k in (1, 2, 3, 4)]
    text = dict(rows(s.repaired(), "row_key", "repaired"))
    assert text[1] == line.replace("bef0re", "before") and text[2] == "The before layer." and text[3] == "Layers before the plasma"
    assert text[4] == "The crystal\nbefore the ampli-\nfier" and 5 not in text and len(text) == 64


def test_long_rows_of_one_line_are_read_for_heads(spark):
    head = "THERMAL SYMMETRY OF PLANAR LAYERS AND THEIR VERTICAL BOUNDARIES IN THE PERIODIC SYSTEMS OF THE NORTHERN LABORATORY FOR PHYSICS   " + "AND OF ITS MANY NEIGHBOURS   " * 2 + "212"
    data = [(1, "text", None, head), (2, "text", None, " ".join([CLEAN] * 3))] + [(100 + i, "text", None, CLEAN) for i in range(40)]
    s = O.Scans({"content_list": (spark.createDataFrame(data, "item_id long, type string, text_level int, text string"), "item_id")})
    assert len(head) > 160 and rows(s.damaged(), "row_key", "damage") == [(1, "header")]


def test_lexicon_changes_no_result(spark):
    data = [(k, "text", None, t) for _, k, t, _ in BODY] + [(100 + i, "text", None, CLEAN) for i in range(60)] + [(200, "text", None, "the plasma-\ncrystal rises"), (201, "text", None, "the layer-\nsymmetry rises")]
    content = spark.createDataFrame(data, "item_id long, type string, text_level int, text string")
    few, many = (O.Scans({"content_list": (content, "item_id")}, lexicon_words=n) for n in (3, 20_000))
    got = rows(few.damaged())
    assert got == rows(many.damaged()) and not [r for r in got if r[1] in (200, 201)]
    text = dict(rows(few.repaired(), "row_key", "repaired"))
    assert text[200] == "the plasma-crystal rises" and rows(few.repaired()) == rows(many.repaired())


def test_every_row_counts_in_the_fit(spark):
    import numpy as np

    texts = ["The amplifier was measured\nbefore the layer."] * 5500 + ["12"] * 300 + ["the layer\n" * 3000, "  \n "]
    schema = "item_id long, type string, text_level int, text string"
    content = spark.createDataFrame([(i, "text", None, t) for i, t in enumerate(texts)], schema)
    got = O.Scans({"content_list": (content, "item_id")}).model
    wanted = O.Model.prior().fitted([O.features(t.split("\n")) for t in texts if t.strip()])
    assert np.allclose(got.start, wanted.start) and np.allclose(got.move, wanted.move) and all(np.allclose(a, b) for a, b in zip(got.emit, wanted.emit))
    again = O.Scans({"content_list": (content.repartition(7), "item_id")}).model
    assert (got.start == again.start).all() and (got.move == again.move).all() and all((a == b).all() for a, b in zip(got.emit, again.emit))


def test_expected_numbers_by_hand():
    import itertools

    import numpy as np

    model, row = O.Model.prior(), O.features(["ON THE SYMMETRY   3", "the body goes on", "12"])
    sums = model.expected([O.coded(row)], [2])[:4] / O._UNIT
    weigh = lambda p: model.start[p[0]] + sum(model.at(x)[s] for x, s in zip(row, p)) + sum(model.move[a, b] for a, b in zip(p, p[1:]))
    paths = {p: np.exp(weigh(p)) for p in itertools.product(range(4), repeat=3)}
    assert np.allclose(sums, [2 / 3 * sum(w for p, w in paths.items() if p[0] == s) / sum(paths.values()) for s in range(4)], atol=1e-6)


def test_emissions_are_reported(spark):
    content = spark.createDataFrame([(k, "text", None, t) for _, k, t, _ in BODY], "item_id long, type string, text_level int, text string")
    got = O.Scans({"content_list": (content, "item_id")}).emissions().collect()
    for state in O.STATES:
        for feature in O.FEATURES:
            own = [r for r in got if (r["state"], r["feature"]) == (state, feature)]
            assert abs(sum(r["fitted"] for r in own) - 1) < 1e-6 and abs(sum(r["prior"] for r in own) - 1) < 1e-6
    assert any(abs(r["fitted"] - r["prior"]) > 1e-4 for r in got)
