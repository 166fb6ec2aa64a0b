"""Text, LaTeX, reference and box functions."""

import math

import pytest
from pyspark.sql import functions as F

from vellumine.functions import geometry as G
from vellumine.functions import latex
from vellumine.functions import references as R
from vellumine.functions import text as X


def value(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.mark.parametrize(
    "text, is_bad",
    [("Manuscript received May 1", True), ("© 2011 IEEE", True), ("©2011IEEE", True), ("2011 IEEE", True), ("ISBN 978-1-4244-5309-2", True), ("2011IEEE", False), ("isbn 978-1-4244-5309-2", False), ("ISBN: 978-1-4244-5309-2", False), (None, False), ("", False)],
)
def test_boilerplate(spark, text, is_bad):
    assert value(spark, X.is_boilerplate(F.lit(text).cast("string"))) is is_bad


@pytest.mark.parametrize(
    "function, text, wanted",
    [
        (X.html_to_marks, "H<sub>2</sub>O <b>x</b>", "H_2O x"),
        (X.math_to_text, r"\frac{a}{b}", "(a) / (b)"),
        (X.restore_commands, "maximum", r"maxi\mum"),
        (X.compact_latex, r"$$( 1 + \lambda )$$", r"$(1+\lambda)$"),
        (X.squeeze_commands, r"a \frac { x }", r"a\frac{x}"),
        (X.squeeze_commands, r"a b \\frac { x } c d", r"ab\\frac { x }cd"),
        (X.plain_blanks, "a b c", "a b c"),
        (X.strip, "  a \n", "a"),
        (X.unfold_malformed, r"a\over b\tag{(3)} \ll &", "a/ b << "),
        (X.reference_text, r"a \$x\$  b ", "a b"),
        (X.tidy_latex, r"{a} \foo  b", "(a) b"),
        (latex.latex_to_text, r"\frac{\alpha}{b} \times 2", "α/b ×2"),
        (latex.cleaned_inline, "x $ C _ { p } = 2 $ y z", "x C_p = 2 y z"),
    ],
)
def test_text(spark, function, text, wanted):
    assert value(spark, function(F.lit(text))) == wanted


def test_nulls_stay_null(spark):
    for f in (X.html_to_marks, X.math_to_text, X.normalise_malformed, X.compact_latex, X.squeeze_commands, X.plain_blanks, X.reference_text, latex.latex_to_text, latex.cleaned_inline):
        assert value(spark, f(F.lit(None).cast("string"))) is None


def test_captions(spark):
    got = spark.sql("select explode(array(array('a', 'b'), array(), null, array(null))) c").select(X.first_or_empty(F.col("c"))).collect()
    assert [r[0] for r in got] == ["a", "", "", None]


def test_reference(spark):
    d = value(spark, R.details(F.lit('A. Bee, C. Dee, and E. Eff, "A title," <em>J. Test</em>, vol. 12, no. 3, pp. 45-67, 2011.')))
    assert (d["authors"], d["title"], d["source"], d["volume"], d["issue"], d["pages"], d["year"]) == (["A. Bee", "C. Dee", "E. Eff"], "A title,", "J. Test", "12", "3", "45-67", "2011")
    d = value(spark, R.details(F.lit("Anonymous report pp. 1999, vol 3")))
    assert (d["authors"], d["title"], d["source"], d["volume"], d["issue"], d["pages"], d["year"]) == ([""], None, "", None, None, "1999", "1999")


def boxed(*numbers):
    return [F.lit(float(x)) for x in numbers]


def test_boxes(spark):
    assert value(spark, G.iou(boxed(0, 0, 10, 10), boxed(1, 0, 10, 10))) == pytest.approx(0.9)
    assert value(spark, G.iou(boxed(0, 0, 10, 10), boxed(0, 0, 10, 5))) == pytest.approx(0.5)
    assert value(spark, G.iou(boxed(0, 0, 10, 10), boxed(10, 0, 20, 10))) == 0
    assert value(spark, G.weighted_distance(boxed(-1, -1, 1, 1), boxed(2, 3, 4, 5), 5, 1)) == pytest.approx(math.sqrt(61))
    assert value(spark, G.touches(boxed(0, 0, 1, 1), boxed(1, 1, 2, 2))) is True


@pytest.mark.parametrize(
    "text, wanted",
    [
        (r"\unknown{a} \alpha", "a α"), (r"\frac{\frac{a}{b}}{\sqrt{\frac{1}{\frac{2}{\frac{3}{\frac{4}{5}}}}}}", "a/b/√(1/2/3/4/5)"), (r"\left( \mathbf{x} \right)", "( x )"),
        (r"\hat{x} + \bar y", "x̂ + ȳ"), (r"caf\'e", "café"), (r"\begin{array}{cc} a & b \\ c \end{array}", " a & b   c "), (r"\Omega \varepsilon \sin x", "Ωεsinx"), (r"10\%\, \{a\}", "10%  a"),
        ("", ""), ("\\", ""), ("$", "$"), (r"\frac{", ""), (r"\sqrt", ""),
    ],
)
def test_latex(spark, text, wanted):
    assert value(spark, latex.to_unicode(F.lit(text))) == wanted


def test_inline_formulas(spark):
    for text, wanted in [("a $x$ b $ y + z $ $", "a x b y + z $"), (r"$ \alpha $ and $ 3 \mathrm { n m } $", "α and 3nm"), ("no formula  here", "no formula  here"), ("$a\nb$", "$a\nb$")]:
        assert value(spark, latex.cleaned_inline(F.lit(text))) == wanted
