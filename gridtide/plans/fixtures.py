"""Telemetry-shaped tables derived by Spark from the driver's parquet tables.

``telemetry`` turns ``events`` into half-hourly-ish inverter readings whose
counters are running sums of whole cents (exact in double arithmetic, so deltas
and ``= 0`` tests agree across engines). ``daily_supply`` turns ``lineitem``
into a daily series per supplier with one blanked month per supplier, to drive
the calendar and gap-month operators. Both read the whole source table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridtide.config import TelemetryConfig


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Event types feeding each counter's running sum (fixture definition).
_RUNS = {
    "on_grid_total_yield_kwh": ("view", "signup"),
    "total_feed_in_energy_kwh": ("error",),
    "total_consume_energy_from_grid_kwh": ("signup", "purchase"),
    "pv_total_power_generation_kwh": ("view", "click"),
    "total_battery_charge_kwh": ("click", "purchase"),
    "total_battery_discharge_kwh": ("purchase", "click"),
}
_FAULT_MOD = 37
_FAULT_DROP = 50000


def telemetry_from_events(events: DataFrame) -> DataFrame:
    cents = F.round(F.col("value") * 100).cast("bigint")
    w = (
        Window.partitionBy("user_id")
        .orderBy("ts", "event_id")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )

    def run(types):
        return F.sum(F.when(F.col("event_type").isin(*types), cents).otherwise(F.lit(0).cast("bigint"))).over(w)

    def fault(r):
        return F.when(F.col("event_id") % _FAULT_MOD == r, F.lit(_FAULT_DROP)).otherwise(F.lit(0))

    yield_cut = F.when(
        (F.col("event_type") == "signup") & (F.col("event_id") % 3 == 0), 2 * cents
    ).otherwise(fault(1))
    cuts = {
        "on_grid_total_yield_kwh": yield_cut,
        "total_feed_in_energy_kwh": fault(2),
        "total_consume_energy_from_grid_kwh": fault(3),
        "pv_total_power_generation_kwh": fault(4),
        "total_battery_charge_kwh": fault(5),
        "total_battery_discharge_kwh": fault(6),
    }
    return events.select(
        F.concat(F.lit("INV-"), F.col("user_id").cast("string")).alias("inverter_serial_no"),
        (F.col("ts") + F.make_dt_interval((F.col("user_id") % 12) * 30)).alias("date_time"),
        F.concat(F.lit("SITE-"), (F.col("user_id") % 7).cast("string")).alias("site_name"),
        F.concat(F.lit("REG-"), F.col("user_id").cast("string")).alias("registration_no"),
        F.col("event_id").alias("file_id"),
        *[(run(types) - cuts[name]).cast("double").alias(name) for name, types in _RUNS.items()],
        ((F.col("event_id") * 7) % 120 - 10).cast("double").alias("battery_capacity_percentage"),
    )


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry_from_events(table(spark, sf_dir, "events"))


# Calendar used for telemetry completion: the shifted readings span 2024.
TELEMETRY_CALENDAR = dict(calendar_start="2024-01-01 00:00:00", calendar_days=365, step_minutes=30)


def telemetry_config(**changes) -> TelemetryConfig:
    return TelemetryConfig(**{**TELEMETRY_CALENDAR, **changes})


# ---- daily supplier series -----------------------------------------------------------
SUPPLY_CALENDAR = dict(calendar_start="1995-01-01 00:00:00", calendar_days=2500, step_minutes=24 * 60)


def supply_config(**changes) -> TelemetryConfig:
    base = dict(
        key="l_suppkey",
        time="day",
        tie=None,
        counters=(),
        capacity="v1",
        attributes=(),
        provenance=None,
        **SUPPLY_CALENDAR,
    )
    base.update(changes)
    return TelemetryConfig(**base)


def daily_supply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (supplier, ship day): v1 = sum(quantity), v2 = count, as doubles.

    Values in the month numbered ``2 + suppkey % 10`` of the first shipping year
    (1995) are blanked, so every supplier has one whole missing month there
    (February to November) while every lineitem row is still read.
    """
    li = table(spark, sf_dir, "lineitem")
    daily = li.groupBy("l_suppkey", F.col("l_shipdate").alias("day")).agg(
        F.sum("l_quantity").alias("v1"), F.count(F.lit(1)).cast("double").alias("v2")
    )
    blank = (F.year("day") == 1995) & (F.month("day") == 2 + F.col("l_suppkey") % 10)
    return daily.select(
        "l_suppkey",
        "day",
        F.when(blank, F.lit(None)).otherwise(F.col("v1")).cast("double").alias("v1"),
        F.when(blank, F.lit(None)).otherwise(F.col("v2")).cast("double").alias("v2"),
    )
