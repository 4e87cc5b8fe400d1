"""Registered queries: one per operator of the inventory, each reading the
driver's tables (or data Spark derives from them) in full.

Every callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame whose
column names equal those of the matching SQL in :mod:`gridtide.plans.oracle`.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtide import fixed
from gridtide.config import TelemetryConfig
from gridtide.functions.rules import BatchRule, custom_rules
from gridtide.operators import calendar, cleanse, derive, quality, validate
from gridtide.operators.outliers import iqr_fences, replace_outliers
from gridtide.plans import chain, fixtures
from gridtide.sources import csv as csv_source
from gridtide.sources import frames

# Registered queries use exact fences (the lower quantile the SQL computes);
# the pipeline default stays approximate as in the reference.

EVENTS = TelemetryConfig(key="user_id", time="ts", tie="event_id", counters=(), attributes=(), provenance=None)
EVENTS_MONTH = EVENTS.with_(calendar_start="2024-01-01 00:00:00", calendar_days=30, step_minutes=30)
EVENTS_THIN = EVENTS.with_(min_rows=66)
LINEITEM = TelemetryConfig(
    key="l_suppkey", time="l_shipdate", tie=None, counters=(), attributes=(), provenance=None, min_rows=600
)
TELEMETRY = fixtures.telemetry_config()
FLAGSHIP = fixtures.telemetry_config(min_rows=66)
SUPPLY = fixtures.supply_config()


def _events(spark, sf):
    return fixtures.table(spark, sf, "events")


def _lineitem(spark, sf):
    return fixtures.table(spark, sf, "lineitem")


def _telemetry(spark, sf):
    return fixtures.telemetry(spark, sf)


def _derived(spark, sf):
    return derive.derive_all(_telemetry(spark, sf), TELEMETRY)


def _validated(spark, sf):
    return validate.validate_rows(_derived(spark, sf), TELEMETRY)


def _flat(df: DataFrame) -> DataFrame:
    return df.drop(fixed.VALIDATION_RESULT)


def _supply_calendar(spark, sf):
    return calendar.complete_calendar(fixtures.daily_supply(spark, sf), SUPPLY)


def _supply_seasonal(spark, sf):
    return calendar.seasonal_bfill(_supply_calendar(spark, sf), SUPPLY)


# ---- sources ------------------------------------------------------------------------------
def q_csv_load(spark, sf):
    """Events written as text CSV (day-first minute times) and read back."""
    from gridtide.session import checkpoint_dir

    path = f"{checkpoint_dir(spark).rstrip('/')}/csv-load-{uuid.uuid4().hex}"
    src = _events(spark, sf).select(
        "event_id", "ts", "user_id", "event_type", "value", "props", F.col("ts").cast("string").alias(fixed.DROPPED_AT_LOAD)
    )
    csv_source.write_readings_csv(src, path, EVENTS)
    schema = "event_id bigint, ts string, user_id bigint, event_type string, value double, props string, date_time_simulated string"
    return csv_source.load_readings(spark, path, EVENTS, schema=schema)


def q_csv_any(spark, sf):
    """Events written as header CSV (quoted text included) and read with a schema."""
    from gridtide.session import checkpoint_dir

    path = f"{checkpoint_dir(spark).rstrip('/')}/csv-any-{uuid.uuid4().hex}"
    _events(spark, sf).withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")).write.option("header", True).csv(path)
    schema = "event_id bigint, ts string, user_id bigint, event_type string, value double, props string"
    return csv_source.load_csv(spark, path, schema)


def _damaged_lines(spark, sf):
    """Events as lines of text, of which some are cut off, too long, no number or without a readable time."""
    from gridtide.session import checkpoint_dir

    path = f"{checkpoint_dir(spark).rstrip('/')}/csv-lines-{uuid.uuid4().hex}"
    kind = F.col("event_id") % 50
    day = F.when(kind == 3, F.lit("yesterday")).otherwise(F.date_format("ts", "dd/MM/yyyy HH:mm"))
    cents = F.when(kind == 2, F.lit("n/a")).otherwise(F.round(F.col("value") * 100).cast("bigint").cast("string"))
    start = F.concat_ws(",", F.col("event_id").cast("string"), day)
    whole = F.concat_ws(",", start, F.coalesce(F.col("user_id").cast("string"), F.lit("")), F.coalesce("event_type", F.lit("")), cents)
    line = F.when(kind == 0, start).when(kind == 1, F.concat(whole, F.lit(",extra"))).otherwise(whole)
    _events(spark, sf).select(line.alias("value")).write.text(path)
    schema = "event_id bigint, ts string, user_id bigint, event_type string, cents bigint"
    return csv_source.split_readings(spark, path, schema, EVENTS, header=False)


def q_csv_kept(spark, sf):
    """The readings of a damaged file."""
    return _damaged_lines(spark, sf)[0]


def q_csv_malformed(spark, sf):
    """The lines of a damaged file that hold no reading, with the reason."""
    return _damaged_lines(spark, sf)[1].drop(csv_source.FILE)


def q_preview_head(spark, sf):
    return frames.preview(_events(spark, sf), 5, order_by=["event_id"])


def q_empty_like(spark, sf):
    return frames.empty_like(_events(spark, sf))


def q_append(spark, sf):
    ev = _events(spark, sf)
    first = F.coalesce(F.col("event_type").isin("view", "click"), F.lit(False))
    return frames.append(ev.filter(first).withColumn("batch", F.lit("first")), ev.filter(~first))


# ---- projections ----------------------------------------------------------------------------
def q_project_sorted(spark, sf):
    return derive.sort_output(derive.project_analysis_columns(_telemetry(spark, sf), TELEMETRY), TELEMETRY)


def q_calendar_parts_dropped(spark, sf):
    """The helper columns are added and removed again."""
    ev = _events(spark, sf).select("event_id", "ts")
    return derive.drop_calendar_parts(derive.add_calendar_parts(ev, EVENTS))


def q_bfill_device(spark, sf):
    """values of error events are missing and filled from the device's next event."""
    ev = _events(spark, sf)
    value = F.when(F.col("event_type") != "error", F.col("value")).alias("value")
    return calendar.bfill_all(ev.select("event_id", "user_id", "ts", value), EVENTS)


def q_quarantine(spark, sf):
    """Readings without a user or a time, made from events of two types, leave the chain with the reason."""
    ev = _events(spark, sf)
    user = F.when(F.col("event_type") != "signup", F.col("user_id")).alias("user_id")
    ts = F.when(F.col("value") < 400, F.col("ts")).alias("ts")
    return quality.quarantine(ev.select("event_id", user, ts, "value"), EVENTS)[1]


def q_calendar_parts(spark, sf):
    ev = _events(spark, sf).select("event_id", "ts")
    return derive.add_month(derive.add_calendar_parts(ev, EVENTS), EVENTS)


def _even_split(quantity, linenumber):
    """The quantity can be split evenly by the line number (whole numbers, by batch)."""
    import pyarrow.compute as pc

    return pc.equal(pc.multiply(pc.floor(pc.divide(quantity, linenumber)), linenumber), quantity)


def _same_keys(part, supplier):
    import pyarrow.compute as pc

    return pc.equal(pc.bit_wise_and(part, 7), pc.bit_wise_and(supplier, 7))


def q_batch_rules(spark, sf):
    """Two rules over Arrow batches between two column rules."""
    rules = [
        *custom_rules(LINEITEM_RULES[:1]),
        BatchRule("Even split", ("l_quantity", "l_linenumber"), _even_split),
        *custom_rules(LINEITEM_RULES[1:2]),
        BatchRule("Same low key bits", ("l_partkey", "l_suppkey"), _same_keys),
    ]
    out = validate.validate_rows(_lineitem(spark, sf), LINEITEM, rules=rules)
    return out.select("l_orderkey", "l_linenumber", fixed.IS_VALID, fixed.ERROR_MESSAGE)


# ---- generic validation --------------------------------------------------------------------
def q_thin_devices(spark, sf):
    return quality.flag_thin_devices(_events(spark, sf), EVENTS_THIN)


def q_duplicate_keys(spark, sf):
    return quality.flag_duplicate_times(_lineitem(spark, sf), LINEITEM)


def q_generic_flags(spark, sf):
    return quality.flag_generic(_lineitem(spark, sf), LINEITEM)


def q_generic_valid(spark, sf):
    return quality.generic_validation(_lineitem(spark, sf), LINEITEM)[0]


def q_generic_failed(spark, sf):
    return quality.generic_validation(_lineitem(spark, sf), LINEITEM)[1]


def q_device_list(spark, sf):
    return quality.device_list(_events(spark, sf), EVENTS)


# ---- calendar -------------------------------------------------------------------------------
def q_half_hour_slots(spark, sf):
    return calendar.keep_first_per_slot(_events(spark, sf), EVENTS)


def q_calendar_complete(spark, sf):
    return calendar.complete_calendar(_events(spark, sf), EVENTS_MONTH)


def q_attribute_bfill(spark, sf):
    # the fill needs a row per stretch of empty slots, not one per slot
    stretches = calendar.calendar_stretches(_telemetry(spark, sf), TELEMETRY)
    filled = calendar.expand(calendar.fill_attributes(stretches, TELEMETRY), TELEMETRY)
    return filled.select(TELEMETRY.key, TELEMETRY.time, "site_name", "registration_no", "file_id")


def q_bfill(spark, sf):
    return calendar.final_bfill(_supply_calendar(spark, sf), SUPPLY)


def q_first_record_null(spark, sf):
    return calendar.first_record_null(_supply_calendar(spark, sf), SUPPLY)


def q_seasonal_bfill(spark, sf):
    return _supply_seasonal(spark, sf)


def q_gap_month(spark, sf):
    return calendar.first_gap_month(_supply_seasonal(spark, sf), SUPPLY)


def q_fill_gap_month(spark, sf):
    return calendar.fill_gap_month(_supply_seasonal(spark, sf), SUPPLY)


def q_make_full(spark, sf):
    return calendar.complete_series(fixtures.daily_supply(spark, sf), SUPPLY)


# ---- derivation and rules -------------------------------------------------------------------
def q_counter_delta(spark, sf):
    proj = derive.project_analysis_columns(_telemetry(spark, sf), TELEMETRY)
    return derive.fill_null_deltas(derive.counter_deltas(proj, TELEMETRY), TELEMETRY)


def _label(column):
    def q(spark, sf):
        return _derived(spark, sf).select(TELEMETRY.key, TELEMETRY.time, column)

    return q


def q_derive_all(spark, sf):
    return _derived(spark, sf)


def q_validate_rows(spark, sf):
    return _flat(_validated(spark, sf))


def q_season_rule_counts(spark, sf):
    return chain.season_rule_report(_validated(spark, sf), TELEMETRY)


LINEITEM_RULES = [
    ("Discount above eight percent", lambda cfg: F.col("l_discount") > 0.08),
    ("Quantity above forty five", lambda cfg: F.col("l_quantity") > 45),
    ("Returned with tax", lambda cfg: (F.col("l_returnflag") == "R") & (F.col("l_tax") > 0)),
]


def q_custom_rules(spark, sf):
    out = validate.validate_rows(_lineitem(spark, sf), LINEITEM, rules=custom_rules(LINEITEM_RULES))
    return out.select("l_orderkey", "l_linenumber", fixed.IS_VALID, fixed.ERROR_MESSAGE)


# ---- cleansing ------------------------------------------------------------------------------


def _repair(step):
    def q(spark, sf):
        out = step(_validated(spark, sf), TELEMETRY)
        return out.select(
            TELEMETRY.key, TELEMETRY.time, *TELEMETRY.counters, TELEMETRY.capacity, *TELEMETRY.deltas
        )

    return q


def q_iqr_fences(spark, sf):
    return iqr_fences(_events(spark, sf), ["value"], exact=True)


def q_outlier_previous(spark, sf):
    out = replace_outliers(_events(spark, sf), EVENTS, ["value"], exact=True)
    return out.select("event_id", "user_id", "ts", "value")


def q_outlier_previous_global(spark, sf):
    out = replace_outliers(_events(spark, sf), EVENTS, ["value"], scope="global", exact=True)
    return out.select("event_id", "user_id", "ts", "value")


def q_clean_all(spark, sf):
    return _flat(cleanse.clean_all(_validated(spark, sf), TELEMETRY, materialize=True, exact=True))


# ---- whole chain ----------------------------------------------------------------------------
def q_season_rule_report(spark, sf):
    """Flagship: readings -> generic checks -> one-year calendar -> derive ->
    rules -> repairs -> outliers -> per-season rule report."""
    res = chain.run_chain(_telemetry(spark, sf), FLAGSHIP, exact=True)
    return chain.season_rule_report(res.counted, FLAGSHIP, times=chain.SLOTS)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "csv_load": q_csv_load,
    "preview_head": q_preview_head,
    "empty_like": q_empty_like,
    "append": q_append,
    "project_sorted": q_project_sorted,
    "calendar_parts": q_calendar_parts,
    "calendar_parts_dropped": q_calendar_parts_dropped,
    "bfill_device": q_bfill_device,
    "quarantine": q_quarantine,
    "csv_any": q_csv_any,
    "csv_kept": q_csv_kept,
    "csv_malformed": q_csv_malformed,
    "thin_devices": q_thin_devices,
    "duplicate_keys": q_duplicate_keys,
    "generic_flags": q_generic_flags,
    "generic_valid": q_generic_valid,
    "generic_failed": q_generic_failed,
    "device_list": q_device_list,
    "half_hour_slots": q_half_hour_slots,
    "calendar_complete": q_calendar_complete,
    "attribute_bfill": q_attribute_bfill,
    "bfill": q_bfill,
    "first_record_null": q_first_record_null,
    "seasonal_bfill": q_seasonal_bfill,
    "gap_month": q_gap_month,
    "fill_gap_month": q_fill_gap_month,
    "make_full": q_make_full,
    "counter_delta": q_counter_delta,
    "battery_behaviour": _label(fixed.BATTERY_BEHAVIOUR),
    "house_power": _label(fixed.HOUSE_POWER),
    "season": _label(fixed.SEASON),
    "time_of_day": _label(fixed.TIME_OF_DAY),
    "derive_all": q_derive_all,
    "validate_rows": q_validate_rows,
    "season_rule_counts": q_season_rule_counts,
    "custom_rules": q_custom_rules,
    "batch_rules": q_batch_rules,
    "fix_negative": _repair(cleanse.fix_negative_deltas),
    "fix_pv_night": _repair(cleanse.fix_pv_at_night),
    "fix_feed_in": _repair(cleanse.fix_feed_in_with_consumption),
    "fix_capacity": _repair(cleanse.fix_capacity),
    "fix_charge_discharge": _repair(cleanse.fix_charge_and_discharge),
    "fix_discharge": _repair(cleanse.fix_discharge_without_use),
    "fix_grid_use": _repair(cleanse.fix_grid_use_without_load),
    "iqr_fences": q_iqr_fences,
    "outlier_previous": q_outlier_previous,
    "outlier_previous_global": q_outlier_previous_global,
    "clean_all": q_clean_all,
    "season_rule_report": q_season_rule_report,
}
