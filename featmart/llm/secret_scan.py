"""Secrets in texts: fixed forms, and strings whose sliding-window entropy is high for their class.

A candidate is a maximal run of at least ``WINDOW`` characters of the secret alphabet that holds a
digit. It belongs to the narrowest character class that holds all of it. A window of ``WINDOW``
characters slides over it; the counts of the characters in the window change by the one that enters
and the one that leaves, and with them the sum of ``n * log2(n)``, which gives the window's Shannon
entropy. Windows at or above the threshold of the class are joined to spans. A candidate that an
allow-list pattern matches from end to end is suppressed. Allow words are judged for each part between
``/`` and ``=``: windows that touch a part with such a word do not count, the others do. Spans of the
fixed forms always stay; windows count where they overlap none of them. Entropy is held in fixed point,
so results are exact.

All of it uses Spark's own functions, in one pass without a shuffle.

Defined edge cases: a null or empty text has no spans; repeated rows are scanned each; an empty
table gives an empty table; candidates may be of any length (work is in proportion to it).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featmart.llm.spans import find, listing, packed_rows, tagged, unpacked

BASE = ("assign", "access", "hex")
WINDOW = 20
# The base forms; runs are guarded so that a match starts where the run does.
ASSIGN = r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
PATTERNS = {
    "assign": (r"(?=[apstAPST])" + ASSIGN, None),
    "access": (r"AKIA[A-Z0-9]{16,}+", "AKIA"),
    "hex": (r"(?<![0-9a-f])[0-9a-f]{24,}+", None),
    "run": (r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])[A-Za-z0-9+/_=-]{20,}+", None),
}
ALPHABET = "0123456789abcdefABCDEFghijklmnopqrstuvwxyzGHIJKLMNOPQRSTUVWXYZ+/_=-"
#: Class name, pattern that all of a candidate matches, least entropy of a window in bits. The first
#: class that fits counts.
CLASSES = (
    ("entropy_hex", r"^([0-9a-f]+|[0-9A-F]+)$", 3.0),
    ("entropy_upper", r"^[A-Z0-9]+$", 3.6),
    ("entropy_lower", r"^[a-z0-9]+$", 3.7),
    ("entropy_base64", r"^[A-Za-z0-9+/_=-]+$", 3.8),
)
#: No secrets: parts of a candidate with a placeholder word; candidates that are dates, separators,
#: repeats or numbers from end to end (patterns that begin with ``^`` look at the whole candidate).
ALLOW = (
    r"(?i)(?<![a-z0-9])(example|sample|placeholder|changeme|your|dummy|x{4,}|test)(?![a-z0-9])",
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T_-][0-9Z-]*)?$",
    r"^[=_-]+$",
    r"^(.{1,4})\1{3,}.{0,3}$",
    r"^[0-9-]+$",
)
PIECE = 1024  # windows slid over at a time
BLANK = " "  # stands where a candidate must not be looked at
_FIXED = 1_000_000
_N_LOG_N = [round(n * math.log2(n) * _FIXED) if n else 0 for n in range(WINDOW + 1)]


def entropy_spans(value: Column, least_bits: Column) -> Column:
    """Maximal unions of windows of ``value`` with at least ``least_bits`` of entropy and without a
    blank, as ``array<struct<start,end>>`` within it.

    The characters are looked up once, and the window slides over pieces of ``PIECE`` of them (each begins with the
    window before it), so that the work is in proportion to the length."""
    table = F.array(*(F.lit(v).cast("long") for v in _N_LOG_N))
    codes = F.transform(F.filter(F.split(value, ""), lambda c: c != ""), lambda c: F.position(c, F.lit(ALPHABET + BLANK)) - 1)
    # entropy = log2(WINDOW) - sum / WINDOW, so high entropy is a small sum
    most = ((math.log2(WINDOW) - least_bits) * (WINDOW * _FIXED)).cast("long")
    none = F.array().cast("array<struct<start:int,end:int>>")
    # the counts stand in a string, one character each from "0" on: changing one copies a few dozen bytes
    begin = F.struct(F.lit("0" * len(ALPHABET + BLANK)).alias("n"), F.lit(0).cast("long").alias("sum"), none.alias("out"))

    def count(counts: Column, code: Column) -> Column:
        return F.ascii(F.substring(counts, code + 1, F.lit(1))) - ord("0")

    def counted(counts: Column, code: Column, n: Column) -> Column:
        return F.overlay(counts, F.char(n + ord("0")), code + 1, F.lit(1))

    def piece(text: Column, first: Column) -> Column:
        """Unions of the windows that end in ``first`` to ``first + PIECE - 1``."""
        warm = F.greatest(first - (WINDOW - 1), F.lit(0))

        def step(a: Column, i: Column) -> Column:
            new = F.get(text, i)
            old = F.when(i - WINDOW >= warm, F.get(text, F.greatest(i - WINDOW, F.lit(0)))).otherwise(-1)
            n_old = F.when(old >= 0, count(a["n"], old)).otherwise(0)
            without = a["sum"] - F.when(n_old > 0, F.get(table, n_old) - F.get(table, n_old - 1)).otherwise(0)
            rest = F.when(old >= 0, counted(a["n"], old, n_old - 1)).otherwise(a["n"])
            n_new = count(a["n"], new) - F.when(new == old, 1).otherwise(0)
            total = without + F.get(table, n_new + 1) - F.get(table, n_new)
            counts = counted(rest, new, n_new + 1)
            start, end = i - (WINDOW - 1), i + 1
            joins = (F.size(a["out"]) > 0) & (F.element_at(a["out"], -1)["end"] >= start)
            grown = F.when(joins, F.concat(F.slice(a["out"], 1, F.size(a["out"]) - 1), F.array(F.struct(
                F.element_at(a["out"], -1)["start"].alias("start"), end.alias("end"))))).otherwise(
                F.concat(a["out"], F.array(F.struct(start.alias("start"), end.alias("end")))))
            full = (start >= 0) & (i >= first) & (total <= most) & counts.endswith("0")
            return F.struct(counts.alias("n"), total.alias("sum"), F.when(full, grown).otherwise(a["out"]).alias("out"))

        return F.aggregate(F.sequence(warm, F.least(first + PIECE, F.size(text)) - 1), begin, step, lambda a: a["out"])

    def pieces(text: Column) -> Column:
        return F.flatten(F.transform(F.sequence(F.lit(0), F.size(text) - 1, F.lit(PIECE)), lambda first: piece(text, first)))

    def united(spans: Column) -> Column:
        """Unions of pieces that touch: a span begins where the one before ends earlier, and ends likewise."""
        starts = F.filter(spans, lambda s, i: (i == 0) | (F.get(spans, i - 1)["end"] < s["start"]))
        ends = F.filter(spans, lambda s, i: (i == F.size(spans) - 1) | (F.get(spans, i + 1)["start"] > s["end"]))
        return F.zip_with(starts, ends, lambda s, e: F.struct(s["start"].alias("start"), e["end"].alias("end")))

    def bound(expression: Column, body) -> Column:
        """``body`` of a value that is worked out once."""
        return F.get(F.transform(F.array(expression), body), F.lit(0))

    return bound(codes, lambda text: F.when(F.size(text) > 0, bound(pieces(text), united)).otherwise(none))


def _class(value: Column) -> Column:
    """Number of the narrowest class that holds all of ``value``."""
    out = None
    for k, c in enumerate(CLASSES):
        out = F.when(value.rlike(c[1]), k) if out is None else out.when(value.rlike(c[1]), k)
    return out


def _free(run: Column, base: Column, allow: Sequence[str]) -> Column:
    """The value of ``run``, blank where ``allow`` matches (all of it, or a part) and under the spans ``base``."""
    value = run["value"]

    def matched(x: Column, patterns: list[str]) -> Column:
        return reduce(Column.__or__, [x.rlike(p) for p in patterns], F.lit(False))

    def blank(x: Column) -> Column:
        return F.repeat(F.lit(BLANK), F.length(x))

    whole, words = ([p for p in allow if p.startswith("^") == w] for w in (True, False))
    parts = F.split(value, "(?<=[/=])", -1)  # a part keeps the delimiter after it
    parted = F.array_join(F.transform(parts, lambda part: F.when(matched(part, words), blank(part)).otherwise(part)), "")
    value = F.when(matched(value, whole), blank(value)).when(matched(value, words), parted).otherwise(value)

    def covered(a: Column, b: Column) -> Column:
        start = F.greatest(b["start"], run["start"])
        n = F.least(b["end"], run["end"]) - start
        return F.overlay(a, F.repeat(F.lit(BLANK), n), start - run["start"] + 1, n)

    over = F.filter(base, lambda b: (b["start"] < run["end"]) & (run["start"] < b["end"]))
    return F.aggregate(over, value, covered)


def secrets(docs: DataFrame, text_col: str = "text", allow: Sequence[str] = ALLOW) -> DataFrame:
    """``docs`` with ``base`` (fixed forms) and ``spans`` (these and the entropy spans): arrays of
    ``struct(start, place, end, kind)`` by start, then kind (columns of these names are replaced)."""
    rows, names = packed_rows(docs, text_col, ("base", "spans"))
    found = find(rows, "__text", {f"__{k}": p for k, p in PATTERNS.items()})
    forms = {k: F.col(f"__{k}") for k in BASE}
    forms["assign"] = F.filter("__assign", lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 2)) >= 6)
    found = found.withColumn("__base", F.array_sort(F.concat(*(tagged(k, i, forms[k]) for i, k in enumerate(BASE)))))
    runs = F.transform("__run", lambda s: F.struct(s["start"].alias("start"), _class(s["value"]).alias("class"),
                                                   _free(s, F.col("__base"), allow).alias("free")))
    runs = F.filter(runs, lambda s: s["free"].rlike(f"[^{BLANK}]{{{WINDOW}}}"))

    names_of, bits_of = (F.array(*(F.lit(c[i]) for c in CLASSES)) for i in (0, 2))

    def windows(s: Column) -> Column:
        return F.transform(entropy_spans(s["free"], F.get(bits_of, s["class"])), lambda w: F.struct(
            (s["start"] + w["start"]).alias("start"), (s["class"] + len(BASE)).alias("place"),
            (s["start"] + w["end"]).alias("end"), F.get(names_of, s["class"]).alias("kind")))

    found = found.withColumn("__free", runs)
    found = found.withColumn("__high", F.when(F.size("__free") > 0, F.flatten(F.transform("__free", windows)))
                             .otherwise(F.array().cast("array<struct<start:int,place:int,end:int,kind:string>>")))
    return found.select(*unpacked(names), F.col("__base").alias("base"),
                        F.array_sort(F.concat("__base", "__high")).alias("spans"))


__all__ = ["entropy_spans", "listing", "secrets"]
