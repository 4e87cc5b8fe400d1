"""Derived labels and sums (D1, D2, D4, D5) as plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridtide import fixed


def _c(x):
    return F.col(x) if isinstance(x, str) else x


def battery_behaviour(pv_delta, charge_delta, consume_delta, discharge_delta) -> Column:
    """First matching case wins; the deltas are per-interval values."""
    pv, charge, consume, discharge = map(_c, (pv_delta, charge_delta, consume_delta, discharge_delta))
    return (
        F.when((pv > 0) & (charge > 0), fixed.SOLAR_CHARGING)
        .when((consume > 0) & (charge > 0), fixed.GRID_CHARGING)
        .when(discharge > 0, fixed.DISCHARGING)
        .otherwise(fixed.OTHER)
    )


def house_power(yield_delta, consume_delta, feed_in_delta) -> Column:
    """Yield + grid consumption + feed-in (the rule book adds feed-in). NULL if any is NULL."""
    return _c(yield_delta) + _c(consume_delta) + _c(feed_in_delta)


def season(month) -> Column:
    month = _c(month)
    expr = None
    for name, months in fixed.SEASON_MONTHS:
        cond = month.isin(*months)
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return expr.otherwise(fixed.UNKNOWN)


def time_of_day(season_col, hour) -> Column:
    """Day when the hour lies in the season's daylight span (inclusive), else Night.

    Season ``Unknown`` gives ``Unknown``; a season outside the table gives NULL.
    """
    season_col, hour = _c(season_col), _c(hour)
    expr = None
    for name, first, last in fixed.DAYLIGHT_HOURS:
        label = F.when(hour.between(first, last), fixed.DAY).otherwise(fixed.NIGHT)
        expr = F.when(season_col == name, label) if expr is None else expr.when(season_col == name, label)
    return expr.when(season_col == fixed.UNKNOWN, fixed.UNKNOWN)
