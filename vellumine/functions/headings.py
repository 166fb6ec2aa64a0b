"""Numbering of headings, as expressions on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _roman(n: int) -> str:
    out = ""
    for value, sign in ((50, "L"), (40, "XL"), (10, "X"), (9, "IX"), (5, "V"), (4, "IV"), (1, "I")):
        while n >= value:
            out, n = out + sign, n - value
    return out


#: The Roman numerals that count as numbering: 1 to 30, 40 and 50.
ROMAN = [_roman(n) for n in (*range(1, 31), 40, 50)]
# Names of the depths of the tree.
DEPTH_NAMES = ["section", "subsection", "subsubsection", "paragraph", "subparagraph"]


def prefix(title: Column) -> Column:
    """The leading token before white space, its dot kept; empty for one-word titles."""
    return F.regexp_extract(title, r"(?U)^(\S+)\s+", 1)


def prefix_format(token: Column) -> Column:
    """roman, arabic, alpha, numeric or none; closing dots and brackets don't count. Single I, V, X and L are roman."""
    p = F.upper(F.regexp_replace(token, r"[.)]+$", ""))
    return (
        F.when(p.isin(ROMAN), "roman")
        .when(p.rlike(r"^[0-9]+$"), "arabic")
        .when(p.rlike(r"^[A-Z]$"), "alpha")
        .when(p.rlike(r"^[0-9]+(\.[0-9]+)+$"), "numeric")
        .otherwise("none")
    )


def depth_label(depth: Column) -> Column:
    label = F.concat(F.lit("level"), depth.cast("string"))
    for i, name in reversed(list(enumerate(DEPTH_NAMES))):
        label = F.when(depth == i, name).otherwise(label)
    return label


def level_of_format(fmt: Column) -> Column:
    """Numerals and unnumbered titles head sections; letters and dotted numbers head subsections."""
    return F.when(fmt.isin("alpha", "numeric"), "subsection").otherwise("section")
