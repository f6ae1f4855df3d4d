"""Protection of statements that must survive synthesis: surface cues of seven kinds."""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Cues of each protected kind, in order.
CUES: dict[str, tuple[str, ...]] = {
    "definition": (
        r"\b(cue|excludes)\b\s*[.:]", r"\b(is|are) defined as\b", r"\bare\b\s+\w+\s+(that|which)\b", r"\bcomprises\b", r"\bconsists of\b",
        r"\bdenotes\b", r"\bdistinguish(es|ed)? between\b", r"\bfires on\b", r"\bis known as\b", r"\bis termed\b", r"\bis the term for\b",
        r"\bis\s+(a|an|the)\b", r"\bmeans that\b", r"\brefers to\b", r"\btakes the values?\b", r"\bthe (test|rule|criterion) (is|for)\b", r"\bwe (call|define)\b",
    ),
    "procedure": (
        r"\bapply\b", r"\bassign(s|ed)?\b", r"\bby (code|hand)\b", r"\bfirst,\b", r"\bfollowed every time\b", r"\bhow (it|the .{1,30}) is (used|done|built)\b",
        r"\bin code\b", r"\bis calculated (as|by)\b", r"\bis computed (as|by)\b", r"\border\b", r"\bresolve[sd]?\b", r"\brun\b", r"\bstep \d\b",
        r"\bthe procedure is\b", r"\bthen\b", r"\bto (do|run|build|compute) (this|it|that),\b",
    ),
    "obligation": (
        r"\bare required to\b", r"\bhas to\b", r"\bhave to\b", r"\bis expected to\b", r"\bis obliged to\b", r"\bis required to\b", r"\bmandatory\b",
        r"\bmust\b", r"\bneeds? to be\b", r"\brequired\b", r"\bshall\b", r"\bshould\b",
    ),
    "prohibition": (
        r"\bavoid\b", r"\bcan not\b", r"\bcannot\b", r"\bdo not\b", r"\bdoes not (fire|apply|count)\b", r"\bexcludes\b", r"\bis forbidden\b",
        r"\bis prohibited\b", r"\bmay never\b", r"\bmay not\b", r"\bmust be excluded\b", r"\bmust not\b", r"\bnever\b",
    ),
    "formula": (
        r"=", r"\b\d+\.\d+\b", r"\bcoefficient\b", r"\bdivided by\b", r"\bequals\b", r"\bis given by\b",
        r"\bis the (ratio|sum|product|quotient|average|weighted average) of\b", r"\bper cent\b", r"\bratio\b", r"\bthreshold\b", r"\bweighted by\b",
        r"\bα\b", r"\bκ\b", r"\d+\s*%",
    ),
    "dependency": (
        r"\bcannot run without\b", r"\bdepends on\b", r"\bin the presence of\b", r"\bis a prerequisite\b", r"\bneeds\b", r"\bonly (works|holds) (if|when|with)\b",
        r"\bpresumes\b", r"\brelies on\b", r"\brequires\b", r"\brests on\b", r"\bwithout .{1,40}, you cannot\b",
    ),
    "assumption": (
        r"\bassumes\b", r"\bby construction\b", r"\bconditional on\b", r"\bfor the .{1,30} to hold\b", r"\bholds only if\b", r"\bon the (standing )?assumption\b",
        r"\bpresupposes\b", r"\bprovided that\b", r"\bstipulat(es|ed|ion)\b", r"\btaken (on trust|for granted)\b", r"\bwe assume\b",
    ),
}


def load_cues(path: str) -> dict[str, tuple[str, ...]]:
    """Cues from a taxonomy file {"protected": [{"label", "cues"}]}; a missing file raises."""
    with open(path, encoding="utf-8") as f:
        return {x["label"]: tuple(x.get("cues", ())) for x in json.load(f).get("protected", ())}


# What matches an ASCII letter or a kappa of a cue without regard to case but is not lowered to it.
ODD_CASES = ("\u0130\u0131\u017f\u212a\u03f0", "iisk\u03ba")


def folded(statement):
    """Lower case as patterns without regard to case see it, so plain searches miss nothing that they find."""
    return F.lower(F.translate(statement, *ODD_CASES))


def needed(pattern: str) -> list[str]:
    """Folded texts one of which stands in whatever matches a cue; empty where none is certain.

    The longest run of plain characters outside groups, or else the alternatives of a group of plain words.
    """
    runs, groups, run, i = [], [], "", 0
    if "(?" in pattern or any(ord(c) > 127 and c not in "ακ" for c in pattern):
        return []
    while i < len(pattern):
        c = pattern[i]
        size, lit, group = 1, c, None
        if c == "\\":
            size, lit = 2, pattern[i + 1 : i + 2]
            if lit in "bBdDsSwW":
                lit = ""
            elif lit.isalnum():
                return []
        elif c == "(":
            depth, j = 1, i + 1
            while j < len(pattern) and depth:
                if pattern[j] in "[\\":  # too much for this reading
                    return []
                depth += (pattern[j] == "(") - (pattern[j] == ")")
                j += 1
            group, size, lit = pattern[i + 1 : j - 1], j - i, ""
        elif c == "[" and re.match(r"\[[^\[\]\\&]+\]", pattern[i:]):
            size, lit = pattern.index("]", i) + 1 - i, ""
        elif c in "|[]{}?*+^$":
            return []
        elif c == ".":
            lit = ""
        i += size
        optional = repeated = False
        if i < len(pattern) and pattern[i] in "?*+{":
            optional, repeated = pattern[i] in "?*{", True
            i = pattern.find("}", i) + 1 if pattern[i] == "{" else i + 1
            if i < len(pattern) and pattern[i] in "?+":
                i += 1
        if group is not None and not optional and all(w and all(x.isalnum() or x == " " for x in w) for w in group.split("|")):
            groups.append([w.lower() for w in group.split("|")])
        if lit and not optional:
            run += lit
        if not lit or repeated:
            runs.append(run)
            run = ""
    best = max([*runs, run], key=len).lower()
    alternatives = max(groups, key=lambda g: min(map(len, g)), default=[])
    if alternatives and min(map(len, alternatives)) > max(2, len(best)):
        return alternatives
    return [best] if best else []


def _first_cue(statement, low, patterns):
    """The first cue that matches; a pattern is tried only where a text that it needs stands."""
    found = []
    for p in patterns:
        may = None
        for text in needed(p):
            here = F.contains(low, F.lit(text))
            may = here if may is None else may | here
        hit = statement.rlike(f"(?iU){p}")
        found.append(F.when(hit if may is None else may & hit, F.lit(p)))
    return F.coalesce(*found)


def protections(statement, cues: dict[str, tuple[str, ...]] = CUES):
    """Array of (label, cue): for each kind the first cue that matches, kinds in order."""
    hits = F.transform(F.array(folded(statement)), lambda low: F.array(*[F.struct(F.lit(label).alias("label"), _first_cue(statement, low, patterns).alias("cue")) for label, patterns in cues.items()]))
    return F.filter(F.get(hits, F.lit(0)), lambda h: h["cue"].isNotNull())


def hits(rows: DataFrame, statement: str, cues: dict[str, tuple[str, ...]] = CUES) -> DataFrame:
    """Each row with each of its protections as ``h`` (label, cue); rows without one go.

    The outer form, as for the other Spark adds a filter on the array and makes it twice.
    """
    return rows.select("*", F.explode_outer(protections(F.col(statement), cues)).alias("h")).where("h IS NOT NULL")


def annotate(units: DataFrame, cues: dict[str, tuple[str, ...]] | None = CUES, statement: str = "canonical_statement") -> DataFrame:
    """Adds ``protected_by`` (null where nothing protects; no column content without a taxonomy)."""
    if not cues:
        return units.withColumn("protected_by", F.lit(None).cast("array<struct<label:string,cue:string>>"))
    hits = protections(F.col(statement), cues)
    return units.withColumn("protected_by", hits).withColumn("protected_by", F.when(F.size("protected_by") > 0, F.col("protected_by")))


def protected_ids(units: DataFrame, id_col: str = "unit_id") -> DataFrame:
    return units.where(F.size("protected_by") > 0).select(id_col)
