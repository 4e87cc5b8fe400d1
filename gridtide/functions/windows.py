"""Window helpers shared by calendar completion, derivation and cleansing.

Every per-device window is ordered **newest first** (time descending, NULL
times last -- the exact reverse of ascending order with NULLs first). One
order for everything means one sort per partitioning for the whole chain:

* "previous row" (``lag`` ascending) is ``lead`` over the descending order;
* backward fill (first non-null at or after the row) is a *running*
  ``last(ignorenulls)`` over the descending order, which Spark evaluates
  incrementally in O(n), unlike a ``currentRow .. unboundedFollowing`` frame
  that is re-aggregated per row (O(n^2)).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridtide.config import TelemetryConfig


def order_columns(df: DataFrame, cfg: TelemetryConfig) -> list[str]:
    """The configured total order, restricted to columns present in ``df``."""
    return [c for c in cfg.order if c in df.columns]


def newest_first(partition_by, order_by):
    order = [F.col(c).desc_nulls_last() if isinstance(c, str) else c for c in order_by]
    return Window.partitionBy(*partition_by).orderBy(*order)


def device_window(df: DataFrame, cfg: TelemetryConfig):
    """Per device, newest first, on the configured (time, tie) order."""
    return newest_first([cfg.key], order_columns(df, cfg))


def running(window):
    """Frame from the partition's first row (the newest) to the current row."""
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def whole(window):
    return window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def previous(col: str | Column, window, offset: int = 1) -> Column:
    """Value ``offset`` rows earlier in time (``window`` is newest first)."""
    return F.lead(col, offset).over(window)


def later(col: str | Column, window, offset: int = 1) -> Column:
    """Value ``offset`` rows later in time (``window`` is newest first)."""
    return F.lag(col, offset).over(window)


def bfill(col: str | Column, window) -> Column:
    """Backward fill: the first non-null value at or after the current row.

    Trailing NULLs stay NULL, as with a pandas ``bfill``.
    """
    col = F.col(col) if isinstance(col, str) else col
    return F.last(col, ignorenulls=True).over(running(window))
