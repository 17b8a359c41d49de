"""featmart: feature marts, data preparation and evaluation as plain Spark DataFrame plans.

Subpackages
-----------
sources    typed readers / writers (CSV, TSV, Parquet, binary-file directories)
functions  column-expression builders (safe arithmetic, dates, JSON, keyword rules, row statistics,
           tokenisation) -- every builder returns a ``Column`` so Catalyst sees the whole expression
operators  DataFrame -> DataFrame operators (relational roll-ups, windows, profiling, encodings,
           splits, text preparation, evaluation metrics, lag-key leak search, MLlib models)
plans      the registered queries over the test tables and their SQL oracles
"""

from featmart.session import get_spark, checkpoint_dir, materialize

__all__ = ["get_spark", "checkpoint_dir", "materialize"]
