"""Column-expression builders. Each returns a ``pyspark.sql.Column`` built from Spark built-ins, so
the whole expression stays inside whole-stage code generation (no Python per row)."""

from featmart.functions.scalar import *  # noqa: F401,F403
from featmart.functions.scalar import __all__ as _scalar_all
from featmart.functions.rows import *  # noqa: F401,F403
from featmart.functions.rows import __all__ as _rows_all
from featmart.functions.keywords import *  # noqa: F401,F403
from featmart.functions.keywords import __all__ as _kw_all

__all__ = list(_scalar_all) + list(_rows_all) + list(_kw_all)
