"""LaTeX to plain text, a documented converter on columns; every step stays in the JVM.

Greek letters, symbols, arrows and named functions become characters; fractions and roots are spelt out to any depth;
accents become combining marks; environments, sizes and fonts are dropped and what they hold is kept; an unknown
command is dropped, its arguments stay. Nothing raises, whatever the text.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from vellumine.functions import text as X

# Commands and the characters they stand for.
SYMBOLS = {
    "times": "×", "cdot": "·", "pm": "±", "mp": "∓", "div": "÷", "ast": "∗", "star": "⋆", "bullet": "∙", "oplus": "⊕", "otimes": "⊗",
    "leq": "≤", "le": "≤", "geq": "≥", "ge": "≥", "neq": "≠", "ne": "≠", "ll": "≪", "gg": "≫", "approx": "≈", "sim": "∼", "simeq": "≃",
    "cong": "≅", "equiv": "≡", "propto": "∝", "parallel": "∥", "perp": "⊥", "mid": "∣", "infty": "∞", "partial": "∂", "nabla": "∇",
    "sum": "∑", "prod": "∏", "int": "∫", "oint": "∮", "rightarrow": "→", "leftarrow": "←", "to": "→", "Rightarrow": "⇒", "Leftarrow": "⇐",
    "leftrightarrow": "↔", "mapsto": "↦", "uparrow": "↑", "downarrow": "↓", "in": "∈", "notin": "∉", "subset": "⊂", "subseteq": "⊆",
    "cup": "∪", "cap": "∩", "emptyset": "∅", "forall": "∀", "exists": "∃", "neg": "¬", "land": "∧", "lor": "∨", "circ": "∘", "degree": "°",
    "angle": "∠", "ldots": "…", "dots": "…", "cdots": "⋯", "vdots": "⋮", "ddots": "⋱", "prime": "′", "ell": "ℓ", "hbar": "ℏ", "Re": "ℜ",
    "Im": "ℑ", "ohm": "Ω", "langle": "⟨", "rangle": "⟩", "vert": "|", "Vert": "‖", "backslash": "\\", "quad": "  ", "qquad": "    ",
}
# Named functions, which stay as words.
FUNCTIONS = "arccos arcsin arctan arg cos cosh cot coth csc deg det dim exp gcd inf ker lim liminf limsup ln log max min sec sin sinh sup tan tanh".split()
# Accent commands and the combining marks they stand for.
ACCENTS = {"hat": "\u0302", "widehat": "\u0302", "tilde": "\u0303", "widetilde": "\u0303", "bar": "\u0304", "overline": "\u0304", "vec": "\u20d7", "dot": "\u0307", "ddot": "\u0308", "acute": "\u0301", "grave": "\u0300", "check": "\u030c", "breve": "\u0306"}
_MARKS = {"'": "\u0301", "`": "\u0300", "^": "\u0302", '"': "\u0308", "~": "\u0303"}
# Fixed value: the Greek letters by their Unicode names; a capital letter's command begins with a capital.
GREEK = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()

_ENVIRONMENT = r"\\(?:begin\{(?:array|tabular)\}\s*(?:\{[^{}]*\})?|(?:begin|end)\{[^{}]*\})"
_FRACTION, _ROOT = r"\\[dtc]?frac\s*\{([^{}]*)\}\s*\{([^{}]*)\}", r"\\sqrt\s*\{([^{}]*)\}"
_TOKEN = r"\\[a-zA-Z]+\*?\s*|\\(?s:.)|[^\\]+|\\"


def commands() -> dict[str, str]:
    """Each command that stands for characters: symbols, functions and the Greek letters, by their names' rule."""
    greek = {}
    for name in GREEK:
        letter = "LAMDA" if name == "lambda" else name.upper()
        greek[name] = unicodedata.lookup(f"GREEK SMALL LETTER {letter}")
        greek[name.capitalize()] = unicodedata.lookup(f"GREEK CAPITAL LETTER {letter}")
    shapes = {f"var{name}": char for name, char in greek.items() if name in ("epsilon", "theta", "pi", "rho", "sigma", "phi", "kappa")}
    return greek | shapes | {name: name for name in FUNCTIONS} | SYMBOLS


def _times(text: Column, pattern: str, step) -> Column:
    """*step* applied as often as *pattern* stands in the text, which is at least its depth of nesting."""
    n = F.coalesce(F.regexp_count(text, F.lit(pattern)), F.lit(0))
    return F.when(n == 0, text).otherwise(F.aggregate(F.sequence(F.lit(1), n), text, lambda t, _: step(t)))


def _accented(text: Column) -> Column:
    """The accents of single letters as letter and mark; of longer arguments the accent falls with the command."""
    argument = r"\s*(?:\{\s*(\p{L})\s*\}|(\p{L}))"
    for name, mark in [*((rf"{n}(?![a-zA-Z])", m) for n, m in ACCENTS.items()), *((rf"\{n}", m) for n, m in _MARKS.items())]:
        text = F.regexp_replace(text, rf"\\{name}{argument}", f"$1$2{mark}")
    return text


def to_unicode(text: Column, keep_braces: bool = False) -> Column:
    """Commands as characters. Braces are dropped or, with *keep_braces*, kept around two characters or more; an
    escaped character stands for itself; null stays null."""
    known = F.create_map(*(F.lit(x) for pair in commands().items() for x in pair))

    def spelt(token: Column) -> Column:
        name = F.regexp_extract(token, r"^\\([a-zA-Z]+)", 1)
        other = F.when(token.rlike(r"^\\[,;: ]$"), " ").when(token.rlike(r"^\\!$"), "").when(token == "\\\\", " ").otherwise(F.substring(token, 2, 1))
        return F.when(~token.startswith("\\"), token).when(name != "", F.coalesce(F.try_element_at(known, name), F.lit(""))).otherwise(other)

    bare = _accented(F.regexp_replace(text, _ENVIRONMENT, ""))
    bare = _times(bare, r"\\(?:[dtc]?frac|sqrt)", lambda t: F.regexp_replace(F.regexp_replace(t, _ROOT, "√($1)"), _FRACTION, "$1/$2"))
    whole = F.array_join(F.transform(F.regexp_extract_all(bare, F.lit(_TOKEN), F.lit(0)), spelt), "")
    whole = F.when(F.instr(bare, "\\") > 0, whole).otherwise(bare)
    return F.regexp_replace(whole, r"\{([^{}]?)\}", "$1") if keep_braces else F.translate(whole, "{}", "")


# Fixed value: the blanks that fall in a formula: next to what opens and closes a group or a command, and between
# signs none of which is an operator.
NEEDLESS = r"(?U)(?<=\{)\s+|\s+(?=\})|\\\s+|\s+(?=\\)|(?<![\\+\-*/=])\s+(?![\\+\-*/=])"


def cleaned_inline(text: Column) -> Column:
    """Inline formulas as characters without needless blanks and without their dollars; every space separator as a blank.

    A formula stands between two dollars of one line. Null stays null.
    """
    formula = r"\$(.*?)\$"
    inner = F.transform(F.regexp_extract_all(text, F.lit(formula), F.lit(1)), lambda f: F.regexp_replace(to_unicode(f), NEEDLESS, ""))
    around = F.split(text, formula, -1)
    woven = F.array_join(F.flatten(F.transform(around, lambda x, i: F.array(x, F.coalesce(F.get(inner, i), F.lit(""))))), "")
    return X.plain_blanks(F.when(F.instr(text, "$") > 0, woven).otherwise(text))


def latex_to_text(text: Column) -> Column:
    """Malformed LaTeX unfolded, tags marked, commands as characters, math that is left spelt out, the rest tidied."""
    return X.tidy_latex(X.math_to_text(to_unicode(X.html_to_marks(X.normalise_malformed(text)), keep_braces=True)))
