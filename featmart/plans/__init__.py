"""Registered queries over the dataset tables and their SQL oracles.

Each query is a function ``(spark, base_dir) -> DataFrame``; ``oracle`` is an equivalent SQL text
over the same tables (DuckDB dialect) or ``None`` when the result is model/seed dependent. Importing
the submodules fills ``REGISTRY``.
"""

from featmart.plans.registry import REGISTRY, query  # noqa: F401
from featmart.plans import mart, sessions, prep, text, evaluation, models, boosted, io, wide  # noqa: F401,E402


def queries():
    return {name: q.fn for name, q in REGISTRY.items()}


def oracle_sql():
    return {name: q.sql for name, q in REGISTRY.items() if q.sql is not None}
