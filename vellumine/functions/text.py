"""Text and LaTeX expressions on columns; all stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Phrases and patterns that mark boilerplate of a publisher.
PHRASES = [
    "Manuscript received",
    "ieee copyright",
    "digital object identifier",
    "This material is based on research sponsored",
    "the associate editor",
    "Authorized licensed use",
]
ISBN = r"ISBN\s+\d{1,5}-\d{1,7}-\d{1,7}-\d{1,7}-\d{1}"
COPYRIGHT = r"©\s*\d{4}\s*IEEE"
YEAR_PUBLISHER = r"\b\d{4}\b\s*IEEE"
# Bare names before which a backslash is restored.
BARE_COMMANDS = ["text", "frac", "sqrt", "sum", "int", "lim", "log", "sin", "cos", "tan", "hbox", "mu", "ohm", "omega"]
# The patterns that spell math out, and what they become, in their order.
MATH_PATTERNS = [
    (r"\\frac\s*\{(.*?)\}\s*\{(.*?)\}", r"($1) / ($2)"),
    (r"\\sqrt\s*\{(.*?)\}", r"sqrt($1)"),
    (r"\\text\{([^}]*)\}", r"$1"),
    (r"\^\{(.*?)\}", r"^$1"),
    (r"_\{(.*?)\}", r"_$1"),
]


def strip(text: Column) -> Column:
    """White space of any kind off both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def collapse_spaces(text: Column) -> Column:
    return strip(F.regexp_replace(text, r"(?U)\s+", " "))


def plain_blanks(text: Column) -> Column:
    """Every Unicode space separator as a plain blank."""
    return F.regexp_replace(text, r"\p{Zs}", " ")


def html_to_marks(text: Column) -> Column:
    """Sub- and superscript elements as _x and ^x; other tags dropped."""
    text = F.regexp_replace(text, r"<sub[^>]*>(.*?)</sub>", r"_$1")
    text = F.regexp_replace(text, r"<sup[^>]*>(.*?)</sup>", r"^$1")
    return F.regexp_replace(text, r"<[^>]+>", "")


def unfold_malformed(text: Column) -> Column:
    """The literal replacements for malformed LaTeX, in their fixed order."""
    text = F.replace(text, F.lit(r"\over"), F.lit("/"))
    text = F.regexp_replace(text, r"\\(hbox|tag)\{\(\d+\)\}", "")
    for old, new in ((r"\$", "$"), (r"\cr", "\n"), (r"\ll", "<<"), (r"\eqalignno{", ""), ("}&", ")"), ("&", "")):
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def restore_commands(text: Column) -> Column:
    """A backslash before each bare command name that has none, even inside words."""
    return F.regexp_replace(text, r"(?<!\\)(" + "|".join(BARE_COMMANDS) + ")", r"\\$1")


def normalise_malformed(text: Column) -> Column:
    return restore_commands(unfold_malformed(text))


def math_to_text(text: Column) -> Column:
    """Fractions, roots, text groups and braced sub- and superscripts in plain notation."""
    for pattern, plain in MATH_PATTERNS:
        text = F.regexp_replace(text, pattern, plain)
    return text


def tidy_latex(text: Column) -> Column:
    """Braces as brackets, leftover commands dropped, blanks collapsed."""
    text = F.replace(F.replace(text, F.lit("{"), F.lit("(")), F.lit("}"), F.lit(")"))
    return collapse_spaces(F.regexp_replace(text, r"\\[a-zA-Z]+", ""))


def compact_latex(text: Column) -> Column:
    """Doubled backslashes and dollars halved, all white space removed."""
    text = F.replace(F.replace(text, F.lit("\\\\"), F.lit("\\")), F.lit("$$"), F.lit("$"))
    return F.regexp_replace(text, r"(?U)\s+", "")


def squeeze_commands(text: Column) -> Column:
    """Blanks removed outside commands that are written with two backslashes and a braced argument, which stay as they are."""
    command = r"\\\\[a-zA-Z]+\*?\s*\{[^}]*\}"
    kept = F.regexp_extract_all(text, F.lit(f"({command})"), F.lit(1))
    rest = F.transform(F.split(text, command, -1), lambda x: F.replace(x, F.lit(" "), F.lit("")))
    return F.array_join(F.flatten(F.transform(rest, lambda x, i: F.array(x, F.coalesce(F.get(kept, i), F.lit(""))))), "")


def reference_text(raw: Column) -> Column:
    """A raw reference without escaped-dollar formulas, blanks collapsed."""
    return collapse_spaces(F.regexp_replace(raw, r"\\\$.*?\\\$", ""))


def is_boilerplate(text: Column) -> Column:
    """Whether a text holds a publisher's boilerplate; a null text holds none."""
    text = F.coalesce(text, F.lit(""))
    phrases = "(?i)" + "|".join(PHRASES)
    return text.rlike(phrases) | text.rlike(ISBN) | text.rlike("(?i)" + COPYRIGHT) | text.rlike("(?i)" + YEAR_PUBLISHER)


def formulae(text: Column) -> Column:
    """array<struct<cleaned, raw>> of the inline formulas $...$ whose cleaned form is not empty."""
    inner = F.regexp_extract_all(text, F.lit(r"\$([^$]+)\$"), F.lit(1))
    cleaned = lambda x: F.replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(x, r"\\[a-zA-Z]+|[{}]", ""), r"(?U)^\s+|\s+$", ""), r"(?U)\s+", " "), F.lit("__"), F.lit("_"))
    both = F.transform(inner, lambda x: F.struct(cleaned(x).alias("cleaned"), F.concat(F.lit("$"), x, F.lit("$")).alias("raw")))
    return F.filter(both, lambda x: x["cleaned"] != "")


def citations(text: Column) -> Column:
    """array<string> of the numbers of [n] marks."""
    return F.regexp_extract_all(text, F.lit(r"\[(\d+)\]"), F.lit(1))


def none_if_empty(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def first_or_empty(captions: Column) -> Column:
    """The first caption; empty if there is no list or it is empty; null if the first one is null."""
    return F.when(F.size(captions) > 0, F.get(captions, F.lit(0))).otherwise(F.lit(""))
