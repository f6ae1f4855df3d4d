"""Text expressions. All offsets and lengths are code points; patterns are Java's."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The stop words and the token pattern of lexical matching.
STOP_WORDS = (
    "the", "a", "an", "and", "or", "of", "to", "in", "for", "on", "at", "by",
    "with", "is", "are", "was", "were", "be", "been", "that", "this", "it",
    "as", "from", "not", "no", "but", "than", "then", "when", "which", "we",
)
TOKEN = r"[a-z0-9][a-z0-9\-']*"

# What carries quantitative force, and what is removed before looking.
UNITS = (
    r"%|percent|percentage[ -]points?|pp\b|bps?\b|basis points?"
    r"|ms\b|s\b|sec(?:onds?)?\b|min(?:utes?)?\b|hours?\b|days?\b|weeks?\b|months?\b|years?\b"
    r"|[kmgt]?b\b|bytes?\b|[kmg]hz\b|rps\b|qps\b|req/(?:s|min)\b"
    r"|kg\b|lbs?\b|km\b|mi\b|m\b|cm\b|mm\b"
    r"|x\b|fold\b|times\b"
)
CURRENCY = r"[$€£¥]|\b(?:usd|eur|gbp|jpy|chf)\b"
NUMBER = r"\d[\d,]*(?:\.\d+)?"
MEASURED = rf"(?i:{UNITS}|{CURRENCY}|\w+s\s+per\b)"
NOT_QUANTITATIVE = (
    r"(?U)\b\d{4}-\d{2}-\d{2}\b",
    r"(?U)\b\d{1,2}/\d{1,2}/\d{2,4}\b",
    r"(?iU)\b(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\s+\d{1,2}\b",
    r"(?U)§\s*\d+(?:\.\d+)*",
    r"(?iU)\bv\d+(?:\.\d+)*\b",
    rf"(?U)\b[A-Z][A-Za-z+#.]*\s+\d+(?:\.\d+)+\b(?!\s*{MEASURED})",
    r"(?iU)\bversion\s+\d+(?:\.\d+)*\b",
    r"(?U)\b[A-Z]{2,}-\d+\b",
    r"(?iU)\bstep\s+\d+\b",
    rf"(?U)(?<![$€£¥])(?<![$€£¥]\s)\b(?:19|20)\d{{2}}\b(?!\s*{MEASURED})",
)
QUANTITATIVE = (
    rf"(?iU){NUMBER}\s*(?:{UNITS})",
    rf"(?iU)(?:{CURRENCY})\s*\d|{NUMBER}\s*(?:{CURRENCY})",
    r"(?iU)\b(?:n|p|r|d|f|t|z|k|alpha|beta|kappa|rho)\s*[=<>≤≥]\s*\.?\d",
    r"(?iU)\b(?:ci|confidence interval|std|sd|stdev|median|mean|average)\b.{0,20}?\d",
    rf"(?iU)\b{NUMBER}\s*(?::|to|–|—|-)\s*{NUMBER}\b",
    r"(?iU)(?:[<>≤≥]=?|\bat least\b|\bat most\b|\bno more than\b|\bfewer than\b|\bmore than\b|\bexceeds?\b|\bunder\b|\bover\b)\s*\d",
    r"(?iU)\b(?:capped|limited|restricted|fixed|set|bounded)\s+(?:at|to)\s+\d|\b(?:maximum|minimum|max|min|up to|no more than|at least|at most|only)\s+(?:of\s+)?\d",
    rf"(?iU)\b{NUMBER}\s*(?:k|m|bn|b|t)\b",
    rf"(?iU)\b{NUMBER}\s+[a-z]+s\s+per\s+[a-z]",
    r"(?U)\b\d[\d,]*\.\d+\b",
    r"(?U)\b\d{1,3}(?:,\d{3})+\b",
)

# Closed vocabularies of unit fields.
GROUNDING = ("attributable", "conventions_added", "unattributed_content")
MODALITIES = ("required", "permitted", "prohibited")
FLAGS = ("negative_result", "caveat")
NODE_KINDS = ("unit", "question")


def slug(col: Column, empty: str = "source") -> Column:
    """Lower-case, other characters to single hyphens, trimmed; ``empty`` where nothing is left."""
    dashed = F.regexp_replace(F.lower(col), "[^a-z0-9]+", "-")
    return F.coalesce(F.nullif(F.regexp_replace(dashed, "^-+|-+$", ""), F.lit("")), F.lit(empty))


def leaf_slug(col: Column) -> Column:
    """The slug of a title: cut to 80 characters after trimming; ``leaf`` where empty."""
    return F.coalesce(F.nullif(F.substring(slug(col, ""), 1, 80), F.lit("")), F.lit("leaf"))


def stem(path: Column) -> Column:
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"(?<=.)\.[^.]*$", "")


def suffix(path: Column) -> Column:
    return F.lower(F.regexp_extract(F.element_at(F.split(path, "/"), -1), r"(?<=.)(\.[^.]*)$", 1))


def tokens(col: Column) -> Column:
    """Lexical tokens in order, with repeats, without stop words and single characters."""
    found = F.regexp_extract_all(F.lower(col), F.lit(TOKEN), F.lit(0))
    return F.filter(found, lambda t: (F.length(t) > 1) & ~t.isin(*STOP_WORDS))


def strip(col: Column) -> Column:
    """Trim Unicode white space."""
    return F.regexp_replace(col, r"(?U)^\s+|\s+$", "")


def squeeze(col: Column) -> Column:
    """White space runs to one space, trimmed."""
    return strip(F.regexp_replace(col, r"(?U)\s+", " "))


def fold_breaks(col: Column) -> Column:
    """CRLF and CR to LF, before anything is hashed or located."""
    return F.regexp_replace(col, "\r\n?", "\n")


def is_quantitative(col: Column) -> Column:
    """Whether a statement has a number with quantitative force (null and empty: false).

    Every pattern needs a digit, so text without one is decided by one look at it.
    """
    left = col
    for pattern in NOT_QUANTITATIVE:
        left = F.regexp_replace(left, pattern, " ")
    found = F.lit(False)
    for pattern in QUANTITATIVE:
        found = found | left.rlike(pattern)
    return F.when(col.rlike(r"(?U)\d"), F.coalesce(found, F.lit(False))).otherwise(F.lit(False))


def known_only(values: Column, known: tuple[str, ...]) -> Column:
    """Known entries, first occurrences in order."""
    return F.array_distinct(F.filter(values, lambda v: v.isin(*known)))


def one_of(col: Column, known: tuple[str, ...], default: str | None = None) -> Column:
    return F.when(col.isin(*known), col).otherwise(F.lit(default))


def mentions(raw: Column) -> Column:
    """Entity mentions (surface, line) with a surface; lines that are no number become 0, negative ones too."""
    kept = F.filter(raw, lambda m: strip(F.coalesce(m["surface"], F.lit(""))) != "")
    return F.transform(kept, lambda m: F.struct(strip(m["surface"]).alias("surface"), F.greatest(F.lit(0).cast("long"), F.coalesce(m["line"].try_cast("long"), F.lit(0).cast("long"))).alias("line")))


def datamark(col: Column) -> Column:
    """Spaces to U+2581, so quoted text can't pass for instructions."""
    return F.replace(col, F.lit(" "), F.lit("▁"))


def wrap_untrusted(col: Column, tag: str = "document") -> Column:
    return F.concat(F.lit(f"<{tag}>\n"), datamark(col), F.lit(f"\n</{tag}>"))


def approx_tokens(col: Column) -> Column:
    return F.floor(F.length(col) / 4)


def numbered(line_no: Column, line: Column) -> Column:
    return F.format_string("%5d| %s", line_no, line)


def rotate(items: Column, by: Column) -> Column:
    """A cyclic shift to the left by ``by`` modulo the size."""
    n = F.size(items)
    k = F.pmod(by, F.greatest(n, F.lit(1))).cast("int")
    return F.when(n > 0, F.concat(F.slice(items, k + 1, n), F.slice(items, F.lit(1), k))).otherwise(items)


def batch_of(position: Column, size: int) -> Column:
    """Number of the consecutive batch of a zero-based position."""
    return F.floor(position / size)


def overlaps(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    """Half-open spans meet; unknown spans do not."""
    return F.coalesce((a_start < b_end) & (b_start < a_end), F.lit(False))


def stream(col: Column) -> Column:
    """Text without white space and without hyphens that end a line."""
    return F.regexp_replace(F.regexp_replace(col, "-[ \t]*\n", ""), r"(?U)\s", "")


def latex_key(col: Column) -> Column:
    """LaTeX without sizing and spacing commands, white space and braces."""
    return F.regexp_replace(F.regexp_replace(col, r"\\(?:left|right|qquad|quad|displaystyle|textstyle)|\\[,;:!]", ""), r"(?U)[\s{}]", "")


def clean_latex(col: Column) -> Column:
    inner = F.regexp_extract(strip(col), r"(?s)^\{\\(?:displaystyle|textstyle)\s*(.*)\}$", 1)
    return squeeze(F.coalesce(F.nullif(inner, F.lit("")), col))


def matches_asset(excerpt: Column, kind: Column, text: Column, latex: Column) -> Column:
    """Whether an excerpt is a recovered formula (or part of it) or part of a recovered grid's text."""
    flat = lambda c: squeeze(F.replace(c, F.lit("|"), F.lit(" ")))
    key = latex_key(excerpt)
    formula = (key != "") & (F.instr(latex_key(latex), key) > 0)
    grid = (flat(excerpt) != "") & (F.instr(flat(text), flat(excerpt)) > 0)
    return F.coalesce(F.when(kind == "formula", formula).when(kind == "table", grid), F.lit(False))


def numeric_tokens(col: Column) -> Column:
    """Numbers as printed, reduced to digits and dots."""
    found = F.regexp_extract_all(col, F.lit(r"-?\(?\$?\d[\d,]*\.?\d*\)?%?"), F.lit(0))
    return F.filter(F.transform(found, digits), lambda t: (t != "") & (t != "."))


def digits(col: Column) -> Column:
    return F.regexp_replace(col, r"[^\d.]", "")


def is_numeric_cell(col: Column) -> Column:
    return col.rlike(r"^[\s$€£(]*-?[\d,.]+\s*[)%]?\s*$") & col.rlike(r"\d")


def is_period_label(col: Column) -> Column:
    return strip(col).rlike(r"^(19|20)\d{2}$")


def span_of(col: Column) -> Column:
    """A row or column span: 1 to 1000, else 1."""
    n = col.try_cast("int")
    return F.when(n.between(1, 1000), n).otherwise(F.lit(1))


def line_at(text: Column, offset: Column) -> Column:
    """One-based line of a zero-based offset."""
    before = F.substring(text, F.lit(1), offset.cast("int"))
    return F.length(before) - F.length(F.replace(before, F.lit("\n"), F.lit(""))) + 1
