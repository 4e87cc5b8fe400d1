"""Per-interval deltas and labels.

The only window is the previous row of the device: one exchange on the device
key (none at all when the input is already partitioned by device, as after
calendar completion), or on (device, chunk) where a device is too long.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtide import fixed
from gridtide.config import TelemetryConfig
from gridtide.functions import labels
from gridtide.operators.chunks import previous_of_device

DEFAULT = TelemetryConfig()


def project_analysis_columns(
    df: DataFrame, cfg: TelemetryConfig = DEFAULT, keep_tie: bool = False, also: tuple[str, ...] = ()
) -> DataFrame:
    """Key, time, the counters and the capacity gauge (sorting is left to the output); ``also`` are kept beside them."""
    cols = [cfg.key, cfg.time, *cfg.counters, cfg.capacity, *also]
    if keep_tie and cfg.tie and cfg.tie in df.columns and cfg.tie not in cols:
        cols.append(cfg.tie)
    return df.select(*cols)


def sort_output(df: DataFrame, cfg: TelemetryConfig = DEFAULT) -> DataFrame:
    """O1: rows by device and time (range-partitioned; ties by the tie column where it is kept)."""
    return df.orderBy(cfg.key, cfg.time, *[c for c in (cfg.tie,) if c in df.columns])


def counter_deltas(df: DataFrame, cfg: TelemetryConfig = DEFAULT, counters=None, bounded: bool = False) -> DataFrame:
    """``Instantaneous_<c> = c - previous c`` within the device; NULL on the first row.

    A device with more readings than a task should hold is read in chunks (see
    :mod:`gridtide.operators.chunks`); ``bounded`` says that no device can have
    (calendar-completed series) and saves the count.
    """
    counters = list(counters or cfg.counters)
    if not counters:
        return df
    prev = previous_of_device(df, cfg, {"__prev": (1, counters)}, bounded)
    out = prev.withColumns({cfg.delta(c): F.col(c) - F.col("__prev").getField(c) for c in counters})
    return out.drop("__prev")


def fill_null_deltas(df: DataFrame, cfg: TelemetryConfig = DEFAULT) -> DataFrame:
    """NULL (and NaN) deltas become 0."""
    return df.na.fill(0, subset=[c for c in cfg.deltas if c in df.columns])


def add_battery_behaviour(df: DataFrame, cfg: TelemetryConfig = DEFAULT) -> DataFrame:
    d = cfg.delta
    return df.withColumn(
        fixed.BATTERY_BEHAVIOUR,
        labels.battery_behaviour(
            d("pv_total_power_generation_kwh"),
            d("total_battery_charge_kwh"),
            d("total_consume_energy_from_grid_kwh"),
            d("total_battery_discharge_kwh"),
        ),
    )


def add_house_power(df: DataFrame, cfg: TelemetryConfig = DEFAULT) -> DataFrame:
    d = cfg.delta
    return df.withColumn(
        fixed.HOUSE_POWER,
        labels.house_power(
            d("on_grid_total_yield_kwh"),
            d("total_consume_energy_from_grid_kwh"),
            d("total_feed_in_energy_kwh"),
        ),
    )


def add_month(df: DataFrame, cfg: TelemetryConfig = DEFAULT) -> DataFrame:
    return df.withColumn(fixed.MONTH, F.month(cfg.time))


def add_season(df: DataFrame, cfg: TelemetryConfig = DEFAULT) -> DataFrame:
    return df.withColumn(fixed.SEASON, labels.season(fixed.MONTH))


def add_time_of_day(df: DataFrame, cfg: TelemetryConfig = DEFAULT) -> DataFrame:
    return df.withColumn(fixed.TIME_OF_DAY, labels.time_of_day(fixed.SEASON, F.hour(cfg.time)))


def derive_all(
    df: DataFrame, cfg: TelemetryConfig = DEFAULT, keep_tie: bool = False, bounded: bool = False, also: tuple[str, ...] = ()
) -> DataFrame:
    """P1 -> W1 -> P8 -> D1 -> D2 -> D3 -> D4 -> D5.

    The deltas follow (time, tie); ``keep_tie`` keeps the tie column in the
    result, so that later windows stay deterministic too on readings that share
    a timestamp. ``also`` names further columns to keep.
    """
    out = project_analysis_columns(df, cfg, keep_tie=True, also=also)
    out = fill_null_deltas(counter_deltas(out, cfg, bounded=bounded), cfg)
    if not keep_tie and cfg.tie not in (cfg.key, cfg.time, *cfg.counters, cfg.capacity, None):
        out = out.drop(cfg.tie)
    for step in (add_battery_behaviour, add_house_power, add_month, add_season, add_time_of_day):
        out = step(out, cfg)
    return out


# ---- calendar part columns (P3 / P2) --------------------------------------------------
CALENDAR_PARTS = ("dayOfWeek", "hour", "minute", "weekOfYear", "yearMonth")


def add_calendar_parts(df: DataFrame, cfg: TelemetryConfig = DEFAULT) -> DataFrame:
    """Weekday (Monday = 0), hour, minute, ISO week and year-month (first day of month)."""
    t = F.col(cfg.time)
    return df.withColumns(
        {
            "dayOfWeek": F.weekday(t),
            "hour": F.hour(t),
            "minute": F.minute(t),
            "weekOfYear": F.weekofyear(t),
            "yearMonth": F.to_date(F.make_date(F.year(t), F.month(t), F.lit(1))),
        }
    )


def drop_calendar_parts(df: DataFrame) -> DataFrame:
    """Remove the helper columns (absent ones are ignored)."""
    return df.drop(*CALENDAR_PARTS)
