"""Small frame utilities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def preview(df: DataFrame | None, n: int = 5, order_by: Sequence[str] | None = None) -> DataFrame:
    """The first ``n`` rows (in ``order_by`` order when given; a top-n sort)."""
    if df is None:
        raise ValueError("preview needs a DataFrame, got None")
    if order_by:
        df = df.orderBy(*order_by)
    return df.limit(n)


def empty_like(df: DataFrame) -> DataFrame:
    """An empty DataFrame with exactly the same schema (no job is run)."""
    return df.limit(0)


def append(*frames: DataFrame) -> DataFrame:
    """Union by column name; columns missing on one side become NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
