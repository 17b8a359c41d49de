"""Query registry."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass
class Query:
    name: str
    fn: Callable
    sql: str | None
    covers: tuple[str, ...]


REGISTRY: dict[str, Query] = {}

DECIMALS = 6  # D12: doubles are rounded on both sides of the oracle comparison


def query(name: str, sql: str | None = None, covers: tuple[str, ...] = ()):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, covers)
        return fn
    return deco


def rounded(df: DataFrame, decimals: int = DECIMALS) -> DataFrame:
    """Round every double / float column (top level and inside arrays of doubles)."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), decimals)
        elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, (T.DoubleType, T.FloatType)):
            c = F.transform(c, lambda x: F.round(x.cast("double"), decimals))
        out.append(c.alias(f.name))
    return df.select(*out)


def r(c: Column | str, decimals: int = DECIMALS) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, decimals)


def case_sql(x: str, rules, exact=None, default="others") -> str:
    """The same first-match rules as an SQL CASE (used only for the oracles)."""
    parts = []
    if exact:
        parts.append(f"WHEN {x} IN ({', '.join(repr(v) for v in exact)}) THEN {x}")
    for needles, label in rules:
        cond = " OR ".join(f"contains({x}, '{nd}')" for nd in needles)
        out = x if label is None else f"'{label}'"
        parts.append(f"WHEN {cond} THEN {out}")
    return "CASE " + " ".join(parts) + f" ELSE '{default}' END"
