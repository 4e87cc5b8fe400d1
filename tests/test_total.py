"""Quantiles over any values, quarantine, calendar alignment, typed CSV times, ties."""

import math

import duckdb
import pytest
from pyspark.sql import functions as F

from gridtide.config import TelemetryConfig
from gridtide.operators import derive, quality
from gridtide.operators.outliers import exact_quantiles, iqr_fences
from gridtide.plans import chain
from gridtide.sources import csv as csv_source

VALUES = {
    "distinct": [float(i) for i in range(3000)],
    "ties": [1.0] * 900 + [2.0] * 1200 + [3.0] * 5,
    "nan": [float(i) for i in range(1, 9)] + [math.nan] * 8,
    "infinite": [-math.inf] * 3 + [1.0, 2.0, 3.0] + [math.inf] * 4,
    "none": [None] * 4,
    "one": [7.5],
}


@pytest.mark.parametrize("name", sorted(VALUES))
@pytest.mark.parametrize("band_limit", [1, 50, 1_000_000])
def test_exact_quantiles_are_total(spark, name, band_limit):
    df = spark.createDataFrame([(v,) for v in VALUES[name]], "x double")
    got = exact_quantiles(df, ["x"], accuracy=100, band_limit=band_limit)["x"]
    usable = sorted(v for v in VALUES[name] if v is not None and not math.isnan(v))
    want = [usable[max(1, math.ceil(len(usable) * p)) - 1] if usable else None for p in (0.25, 0.75)]
    assert got == want


def test_exact_quantiles_of_decimals(spark):
    df = spark.range(1000).select((F.col("id") / 7).cast("decimal(12,4)").alias("x"))
    want = duckdb.sql("SELECT quantile_disc(CAST(i / 7 AS DECIMAL(12,4)), [0.25, 0.75]) FROM range(1000) t(i)").fetchall()[0][0]
    assert exact_quantiles(df, ["x"], accuracy=100, band_limit=20)["x"] == [float(x) for x in want]


def test_approximate_fences_ignore_nan(spark):
    df = spark.createDataFrame([(v,) for v in VALUES["nan"]], "x double")
    row = iqr_fences(df, ["x"]).first()
    assert (row["q1"], row["q3"]) == (2.0, 6.0)


def test_default_fences_are_within_one_percent_of_ranks(spark):
    n = 5000
    df = spark.range(n).select((F.col("id") * 1.0).alias("x"))
    row = iqr_fences(df, ["x"]).first()
    assert abs(row["q1"] - 0.25 * n) <= 0.01 * n + 1 and abs(row["q3"] - 0.75 * n) <= 0.01 * n + 1


def test_quarantine_takes_readings_without_key_or_time(spark):
    cfg = TelemetryConfig(key="k", time="t", tie=None, counters=(), attributes=(), provenance=None)
    df = spark.createDataFrame([("a", 1), (None, 2), ("b", None), (None, None)], "k string, t int")
    usable, out = quality.quarantine(df, cfg)
    assert [tuple(r) for r in usable.collect()] == [("a", 1)]
    assert sorted(r["quarantine_reason"] for r in out.collect()) == ["no k", "no k, no t", "no t"]


def test_chain_accounts_for_every_reading(spark):
    from gridtide.plans import catalog

    raw = catalog._telemetry(spark, "/root/testdata/sf0.001").withColumn(
        "inverter_serial_no", F.when(F.col("file_id") % 50 != 0, F.col("inverter_serial_no"))
    )
    cfg = catalog.FLAGSHIP.with_(min_rows=10**6)
    res = chain.run_chain(raw, cfg, materialize=False)
    assert res.quarantined.count() > 0 and res.quarantined.count() + res.failed.count() == raw.count()


def test_calendar_start_must_lie_on_a_slot():
    with pytest.raises(ValueError, match="calendar_start"):
        TelemetryConfig(calendar_start="2024-01-01 00:10:00", step_minutes=30)
    TelemetryConfig(calendar_start="2024-01-01 00:30:00", step_minutes=30)


def test_typed_csv_times_pass_through(spark, tmp_path):
    cfg = TelemetryConfig(key="k", time="t", tie=None, counters=(), attributes=(), provenance=None)
    for name, lines, want in (
        ("iso", "k,t\na,2024-02-03 10:30:00\n", "2024-02-03 10:30:00"),
        ("dayfirst", "k,t\na,03/02/2024 10:30\n", "2024-02-03 10:30:00"),
        ("bad", "k,t\na,never\n", None),
    ):
        path = tmp_path / f"{name}.csv"
        path.write_text(lines)
        row = csv_source.load_readings(spark, str(path), cfg).first()
        assert (None if row["t"] is None else str(row["t"])) == want


def test_deltas_follow_the_tie_whatever_the_input_order(spark):
    cfg = TelemetryConfig(counters=("pv_total_power_generation_kwh",))
    base = spark.range(6).select(
        F.lit("d").alias(cfg.key), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias(cfg.time),
        F.col("id").alias(cfg.tie), (F.col("id") * F.col("id")).cast("double").alias(cfg.counters[0]), F.lit(1.0).alias(cfg.capacity),
    )

    def deltas(df):
        out = derive.fill_null_deltas(derive.counter_deltas(derive.project_analysis_columns(df, cfg, keep_tie=True), cfg), cfg)
        return sorted(r[cfg.deltas[0]] for r in out.collect())

    assert deltas(base) == deltas(base.orderBy(F.desc("id"))) == deltas(base.orderBy(F.rand(3)))
