"""Spans of pattern matches in whole texts, found with Spark's own functions only.

Offsets are code points, ends exclusive. The matches of a pattern come from ``regexp_extract_all`` and
the text between them from ``split`` on the same pattern; running sums of their lengths are the
offsets. Patterns are possessive or guarded so that Java's matcher neither recurses nor rescans.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTEXT = 40  # characters kept before a match
STEP = 256  # matches summed at once: running offsets cost little more than the number of matches

SPAN = "array<struct<start:int,end:int,value:string,before:string,after:string>>"


def _offsets(steps: Column) -> Column:
    """Running end offset before each entry of an array of lengths, in pieces of ``STEP``."""
    def running(values: Column, base: Column) -> Column:
        return F.aggregate(values, F.struct(base.alias("at"), F.array().cast("array<int>").alias("all")),
                           lambda a, v: F.struct((a["at"] + v).alias("at"), F.concat(a["all"], F.array(a["at"])).alias("all")),
                           lambda a: a["all"])
    pieces = F.transform(F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / STEP).cast("int")),
                         lambda i: F.slice(steps, i * STEP + 1, STEP))
    sums = F.transform(pieces, lambda p: F.aggregate(p, F.lit(0), lambda a, v: a + v))
    return F.flatten(F.zip_with(pieces, running(sums, F.lit(0)), running))


def find(df: DataFrame, text: str, patterns: dict[str, tuple[str, str | tuple[str, ...] | None]]) -> DataFrame:
    """``df`` with a column for each pattern: its leftmost non-overlapping matches as ``SPAN``.

    ``patterns`` maps a column name to the pattern and a string that every match contains, strings of
    which every match contains one, or None.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    none = F.array().cast("array<string>")

    def hits(pattern: str, needle: str | tuple[str, ...] | None) -> Column:
        got = F.regexp_extract_all(body, F.lit(pattern), F.lit(0))
        if needle is None:
            return got
        some = [F.contains(body, F.lit(n)) for n in ((needle,) if isinstance(needle, str) else needle)]
        return F.when(reduce(Column.__or__, some), got).otherwise(none)

    df = df.withColumns({f"__hit_{k}": hits(*p) for k, p in patterns.items()})
    df = df.withColumns({f"__gap_{k}": F.when(F.size(f"__hit_{k}") > 0, F.transform(
        F.split(body, p[0], -1), lambda g: F.struct(F.length(g).alias("n"), F.right(g, F.lit(CONTEXT)).alias("before"),
                                                    F.left(g, F.lit(1)).alias("after")))) for k, p in patterns.items()})
    df = df.withColumns({f"__at_{k}": F.when(F.size(f"__hit_{k}") > 0, _offsets(F.zip_with(
        F.col(f"__hit_{k}"), F.slice(f"__gap_{k}", 1, F.size(f"__hit_{k}")), lambda h, g: F.length(h) + g["n"])))
        for k in patterns})

    def spans(k: str) -> Column:
        hit, gap, at = (F.col(f"__{x}_{k}") for x in ("hit", "gap", "at"))
        return F.coalesce(F.transform(hit, lambda h, i: F.struct(
            (at[i] + gap[i]["n"]).alias("start"), (at[i] + gap[i]["n"] + F.length(h)).alias("end"), h.alias("value"),
            gap[i]["before"].alias("before"), gap[i + 1]["after"].alias("after"))), F.array().cast(SPAN))

    return df.withColumns({k: spans(k) for k in patterns}).drop(
        *(f"__{x}_{k}" for x in ("hit", "gap", "at") for k in patterns))


def packed_rows(docs: DataFrame, text_col: str, taken: tuple[str, ...]) -> tuple[DataFrame, list[str]]:
    """``docs`` as two columns, ``__row`` (a struct of all but the columns named in ``taken``) and
    ``__text`` (null as empty), so that no name of the caller meets a working column; and the names."""
    names = [c for c in docs.columns if c.lower() not in taken]
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("__row"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("__text")), names


def unpacked(names: list[str]) -> list[Column]:
    return [F.col("__row").getField(c).alias(c) for c in names]


def tagged(kind: str, order: int, spans: Column) -> Column:
    """Spans as ``struct(start, place, end, kind)``, which sort by start and then by kind."""
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(order).alias("place"),
                                                 s["end"].alias("end"), F.lit(kind).alias("kind")))


def listing(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def apart(spans: Column, taken: Column) -> Column:
    """Those of ``spans`` that overlap none of ``taken`` (both with ``start`` and ``end``)."""
    return F.filter(spans, lambda s: ~F.exists(taken, lambda t: (s["start"] < t["end"]) & (t["start"] < s["end"])))


def luhn(digits: Column) -> Column:
    """Does a string of digits pass the Luhn check?"""
    one = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""), lambda c: c.cast("int"))
    two = F.transform(one, lambda d, i: F.when(i % 2 == 0, d).when(d < 5, 2 * d).otherwise(2 * d - 9))
    return F.aggregate(two, F.lit(0), lambda a, d: a + d) % 10 == 0


def replaced(text: Column, spans: Column) -> Column:
    """``text`` with every span of ``spans`` (``start``, ``end``, ``kind``, sorted by start) replaced by
    ``[KIND]``; overlapping spans are replaced once, by the kind of the first."""
    merged = F.aggregate(spans, F.array().cast("array<struct<start:int,end:int,kind:string>>"), lambda a, s: F.when(
        (F.size(a) > 0) & (s["start"] < F.element_at(a, -1)["end"]),
        F.concat(F.slice(a, 1, F.size(a) - 1), F.array(F.struct(
            F.element_at(a, -1)["start"].alias("start"), F.greatest(F.element_at(a, -1)["end"], s["end"]).alias("end"),
            F.element_at(a, -1)["kind"].alias("kind"))))).otherwise(
        F.concat(a, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))))
    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(
        merged, F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")),
        lambda a, s: F.struct(s["end"].alias("at"), F.concat(a["out"], F.array(
            F.substring(text, a["at"] + 1, s["start"] - a["at"]), F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))).alias("out")),
        lambda a: F.concat(F.array_join(a["out"], ""), F.substring(text, a["at"] + 1, F.length(text)))))
