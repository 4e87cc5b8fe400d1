"""Streaming use of the row-level operators.

The reference is a batch job and has no streaming stage. What carries over
unchanged is the stateless part of the chain: the season / time-of-day
labels and the rule verdict are plain column expressions, so they run on a
Structured Streaming DataFrame exactly as on a batch one. Per-interval deltas
need the previous reading of the device and therefore come from the batch
chain (or an upstream producer); nothing here keeps state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from gridtide.config import TelemetryConfig
from gridtide.operators import derive, validate


def stateless_checks(readings: DataFrame, cfg: TelemetryConfig = TelemetryConfig()) -> DataFrame:
    """Labels (D1, D2, D3, D4, D5) and the rule verdict (V0) for rows that already
    carry the ``Instantaneous_*`` deltas; works on streaming and batch frames."""
    out = derive.fill_null_deltas(readings, cfg)
    for step in (derive.add_battery_behaviour, derive.add_house_power, derive.add_month, derive.add_season, derive.add_time_of_day):
        out = step(out, cfg)
    return validate.validate_rows(out, cfg)
