"""Formulas in texts: finding, normalising, keeping and rendering them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import text as T

# How formulas are written, in the order they are reported.
KINDS = {
    "display": r"\$\$([^$]+)\$\$", "bracket": r"\\\[(.+?)\\\]", "environment": r"\\begin\{(?:equation|align|gather)\*?\}", "inline": r"(?:^|[^$])\$([^$\n]+)\$(?!\$)", "command": rf"\\(?:frac|sum|int|sqrt|alpha|beta|gamma){T.END}",
}
SYMBOLS = {"\\alpha": "α", "\\beta": "β", "\\gamma": "γ", "\\delta": "δ", "\\lambda": "λ", "\\mu": "μ", "\\pi": "π", "\\sigma": "σ", "\\omega": "ω", "\\sum": "∑", "\\int": "∫", "\\infty": "∞", "\\leq": "≤", "\\geq": "≥", "\\neq": "≠", "\\times": "×", "\\pm": "±", "\\rightarrow": "→", "\\in": "∈", "\\forall": "∀", "\\exists": "∃", "\\partial": "∂", "\\nabla": "∇", "\\cdot": "·", "\\sqrt": "√"}
FORMULA = r"\$\$[^$]+\$\$|\\\[.+?\\\]|\$[^$\n]+\$"


def counts(text: Column) -> Column:
    """Map of kind to how many there are."""
    return F.map_from_arrays(F.array(*map(F.lit, KINDS)), F.array(*[F.regexp_count(text, F.lit(p)).cast("long") for p in KINDS.values()]))


def is_mathematical(text: Column) -> Column:
    """Holds an operator, a command, or a letter beside a digit."""
    return text.rlike(r"[=+*/^<>∑∫√≤≥≠±×÷∂∇]|\\[a-z]+|[A-Za-z]_|[0-9][a-z]\b")


def formulas(text: Column) -> Column:
    return F.filter(F.regexp_extract_all(text, F.lit(f"({FORMULA})"), F.lit(1)), is_mathematical)


def preserve(text: Column) -> Column:
    """struct(text, formulas): each formula as ``__FORMULA_n__``."""
    found = F.regexp_extract_all(text, F.lit(f"({FORMULA})"), F.lit(1))
    cut = F.split(text, FORMULA)
    marked = F.array_join(F.transform(cut, lambda s, i: F.when(i == 0, s).otherwise(F.concat(F.lit("__FORMULA_"), (i - 1).cast("string"), F.lit("__"), s))), "")
    return F.struct(marked.alias("text"), found.alias("formulas"))


def restore(text: Column, kept: Column) -> Column:
    """The inverse of ``preserve``, by number."""
    cut = F.split(text, r"__FORMULA_[0-9]+__")
    ids = F.transform(F.regexp_extract_all(text, F.lit(r"__FORMULA_([0-9]+)__"), F.lit(1)), lambda n: n.cast("int"))
    return F.array_join(F.transform(cut, lambda s, i: F.when(i == 0, s).otherwise(F.concat(F.coalesce(F.try_element_at(kept, F.try_element_at(ids, i) + 1), F.lit("")), s))), "")


def normalise(text: Column) -> Column:
    """Single spaces about relations and operators, none before sub- and superscripts."""
    for p, to in ((r" *([=<>≤≥≠]) *", " $1 "), (r" *([+×÷]) *", " $1 "), (r" *([_^]) *", "$1"), (r"\( +", "("), (r" +\)", ")"), (r"\{ +", "{"), (r" +\}", "}"), (r" {2,}", " ")):
        text = F.regexp_replace(text, p, to)
    return F.regexp_replace(text, "^ +| +$", "")


def as_unicode(text: Column) -> Column:
    for k in sorted(SYMBOLS, key=len, reverse=True):
        text = F.replace(text, F.lit(k), F.lit(SYMBOLS[k]))
    return F.regexp_replace(text, r"[${}]", "")


def as_text(text: Column) -> Column:
    text = F.regexp_replace(text, r"\\frac\{([^}]*)\}\{([^}]*)\}", "($1)/($2)")
    return F.regexp_replace(F.regexp_replace(text, r"\\([a-zA-Z]+)", "$1"), r"[${}]", "")
