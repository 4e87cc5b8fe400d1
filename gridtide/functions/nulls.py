"""Boundary conversion of NaN to NULL.

Spark orders NaN above every number (``NaN > 100`` is TRUE) while Python
comparisons with NaN are False; converting NaN to NULL at ingest makes a
non-number operand mean "rule does not fire" everywhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


def nan_to_null(df: DataFrame, columns=None) -> DataFrame:
    fractional = {f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))}
    targets = [c for c in (columns or df.columns) if c in fractional]
    if not targets:
        return df
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast(df.schema[c].dataType)) for c in targets})
