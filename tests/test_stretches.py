"""The series as stretches of equal slots: as many rows as the readings ask for, and the rows of the slot-by-slot way."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gridtide import fixed
from gridtide.config import TelemetryConfig
from gridtide.operators import calendar, cleanse, derive, outliers, validate
from gridtide.plans import chain
from tests.helpers import READING_SCHEMA

CFG = TelemetryConfig(calendar_start="2022-07-01 00:00:00", calendar_days=150, step_minutes=120, attributes=("site_name",), min_rows=2)


def _rows(seed: int, start=datetime(2022, 7, 1)):
    """Devices with readings in some months only, missing values, faults and a reading outside the calendar."""
    rnd = random.Random(seed)
    rows, n = [], 0
    for device in range(6):
        months = rnd.sample(range(5), rnd.randint(0, 4))
        times = {start + timedelta(days=-9 - device)}
        for m in months:
            for _ in range(rnd.randint(1, 9)):
                times.add(start + timedelta(days=30 * m + rnd.randint(0, 29), minutes=120 * rnd.randint(0, 11)))
        if device == 0:
            times.add(start)
        total = [0] * 6
        for t in sorted(times):
            n += 1
            total = [max(0, x + rnd.choice([-2, 0, 0, 1, 3, 40])) for x in total]
            counters = [None if rnd.random() < 0.2 else float(x) for x in total]
            site = None if rnd.random() < 0.4 else f"s{rnd.randint(0, 2)}"
            rows.append((f"D{device}", t, n, *counters, rnd.choice([None, -5.0, 8.0, 50.0, 120.0]), site))
    return rows


def _readings(spark, rows):
    return spark.createDataFrame(rows, READING_SCHEMA + ", site_name string").coalesce(1)


def _same(a, b):
    assert a.columns == b.columns
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_a_calendar_between_two_readings_is_one_row(spark):
    df = _readings(spark, _rows(1)).cache()
    stretches = calendar.calendar_stretches(df, CFG)
    devices = df.select(CFG.key).distinct().count()
    assert stretches.count() <= 2 * df.count() + 2 * devices < devices * CFG.slots / 10
    filled = calendar.expand(calendar.fill_attributes(stretches, CFG), CFG)
    _same(filled, calendar.fill_attributes(calendar.complete_calendar(df, CFG), CFG))
    assert filled.count() == devices * CFG.slots


@pytest.mark.parametrize("start", ["2022-07-01 00:00:00", "2022-07-11 00:00:00"])
def test_series_of_stretches_equal_the_single_operators(spark, start):
    cfg = CFG.with_(calendar_start=start)
    df = _readings(spark, _rows(2) + [(f"E{r[0]}", *r[1:]) for r in _rows(3)]).cache()
    _same(calendar.complete_series(df, cfg), calendar.complete_series_stepwise(df, cfg))
    slots = df.select(cfg.key).distinct().count() * cfg.slots
    assert calendar.series_stretches(df, cfg).count() < slots / 4


@pytest.mark.parametrize("exact", [True, False])
def test_chain_on_stretches_equals_the_operators_on_all_slots(spark, exact):
    df = _readings(spark, _rows(4) + [(f"E{r[0]}", *r[1:]) for r in _rows(5)]).cache()
    res = chain.run_chain(df, CFG, exact=exact, accuracy=10_000)
    valid = df.join(df.groupBy(CFG.key).count().where("count >= 2").select(CFG.key), CFG.key, "left_semi").select(*df.columns)
    checked = validate.validate_rows(derive.derive_all(calendar.complete_series_stepwise(valid, CFG), CFG), CFG)
    repaired = cleanse.repair_rule_failures_stepwise(checked, CFG)
    want = outliers.replace_outliers(repaired, CFG, CFG.outlier_columns, CFG.iqr_multiplier, exact=exact, accuracy=10_000).cache()
    assert want.select(fixed.ERROR_MESSAGE).distinct().count() > 8
    flat = lambda d: d.drop(fixed.VALIDATION_RESULT)
    _same(flat(res.cleaned), flat(want))
    assert res.counted.count() < want.count() / 2
    _same(chain.season_rule_report(res.counted, CFG, times=chain.SLOTS), chain.season_rule_report(want, CFG))


@pytest.mark.parametrize("band_limit", [2, 50, 1_000_000])
def test_weighted_quantiles_equal_those_of_the_repeated_rows(spark, band_limit):
    rnd = random.Random(7)
    rows = [(rnd.choice([None, float("nan"), float("inf"), 0.0, -0.0, rnd.randint(-40, 40) / 4]), rnd.randint(0, 30)) for _ in range(600)]
    df = spark.createDataFrame(rows, "x double, n long")
    probs = (0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0)
    repeated = df.select("x", F.explode(F.expr("array_repeat(1, int(n))")))
    want = outliers.exact_quantiles(repeated, ["x"], probs)["x"]
    assert outliers.exact_weighted_quantiles(df, ["x"], "n", probs, band_limit)["x"] == want
    assert outliers.exact_weighted_quantiles(df.limit(0), ["x"], "n", probs)["x"] == [None] * len(probs)
