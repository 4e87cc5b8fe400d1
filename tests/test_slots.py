"""The one exchange by (device, slot): equal to the single steps, bounded, and without a sort aggregate."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gridtide.operators import calendar, quality
from gridtide.plans import catalog, fixtures
from gridtide.session import checkpoint_table

SF = "/root/testdata/sf0.001"
CFG = catalog.FLAGSHIP
SCHEMA = "k string, t timestamp_ntz, tie long, v double"
HALF_HOURS = CFG.with_(
    key="k", time="t", tie="tie", counters=(), capacity="v", attributes=(), provenance=None,
    calendar_start="2024-01-01 00:00:00", calendar_days=3, min_rows=3,
)
T0 = datetime(2024, 1, 1)


def same(a, b):
    assert a.columns == b.columns
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def shuffled_rows(df) -> list[int]:
    """Rows written by each exchange of the executed plan."""
    df.collect()
    found = []

    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if name.endswith("QueryStage"):
            return walk(node.plan())
        if name == "Exchange":
            found.append(node.metrics().get("shuffleRecordsWritten").get().value())
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return found


def rows_of(minutes_and_values, key="a"):
    return [(key, None if m is None else T0 + timedelta(minutes=m), i, v) for i, (m, v) in enumerate(minutes_and_values)]


@pytest.fixture
def two_joins(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    adaptive = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    if adaptive:
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", adaptive)


def odd_rows():
    rows = rows_of([(0, 1.0), (5, 2.0), (5, 3.0), (31, None), (31, 4.0), (40, 5.0), (None, 6.0), (-10_000, 7.0)])  # copies and history
    rows += rows_of([(10, 1.0), (20, 2.0)], "thin")
    rows += rows_of([(m, 1.0) for m in (-90_000, -80_000, -70_000)], "only history")
    rows += rows_of([(-90_000, 1.0)] * 4, "only copies outside")
    rows += rows_of([(90, 1.0)] * 4, "only copies inside")
    rows += rows_of([(None, 1.0)] * 4, "no times")
    rows += rows_of([(3 * 1440, 1.0), (3 * 1440 + 29, 2.0), (3 * 1440 + 30, 3.0)], "last slot")
    return rows


def test_checks_and_slots_together_equal_the_single_steps(spark):
    df = spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)
    valid = quality.generic_validation(df, HALF_HOURS)[0]
    got = calendar.complete_series(df, HALF_HOURS, raw=True)
    same(got, calendar.complete_series_stepwise(valid, HALF_HOURS))
    assert {r.k for r in got.select("k").distinct().collect()} == {"a", "only history", "no times", "last slot"}
    t = checkpoint_table(fixtures.telemetry(spark, SF))
    same(calendar.complete_series(t, CFG, raw=True), calendar.complete_series(quality.generic_validation(t, CFG)[0], CFG))
    none = df.limit(0)
    assert calendar.complete_series(none, HALF_HOURS, raw=True).count() == 0


def test_groups_of_copies_leave_before_the_shuffle(spark):
    """A third of all rows are copies of one reading: a sample shows them, and the result is the same."""
    rows = odd_rows() + rows_of([(125, 9.0)] * 400, "a") + rows_of([(30 * i, 1.0) for i in range(300)], "b")
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    small = HALF_HOURS.with_(group_rows=100)
    left = quality.without_proven_copies(df, small)
    assert left.where("k = 'a' and v = 9").count() == 0 and left.count() < df.count()
    assert quality.without_proven_copies(df, HALF_HOURS).count() == df.count()
    same(calendar.complete_series(df, small, raw=True), calendar.complete_series(quality.generic_validation(df, HALF_HOURS)[0], HALF_HOURS))


def test_two_exchanges_of_the_readings_and_no_sort_aggregate(spark, two_joins):
    t = checkpoint_table(fixtures.telemetry(spark, SF))
    plan = calendar.valid_slots(t, CFG)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
    # exchanges that carry a value of the readings: by slot, and by device
    wide = [line for line in plan.splitlines() if "Exchange" in line]
    assert sum("REPARTITION_BY_NUM" in line for line in wide) == 2
    n = t.count()
    counts = sorted(shuffled_rows(calendar.valid_slots(t, CFG)), reverse=True)
    assert sum(c > n // 2 for c in counts) <= 2, counts
    for df in (calendar.keep_first_per_slot(t, CFG), calendar.complete_calendar(t, CFG)):
        assert "SortAggregate" not in df._jdf.queryExecution().executedPlan().toString()


def test_years_of_history_are_not_shuffled(spark):
    """Ten years of readings, a calendar of one year: about a tenth of the rows is shuffled, and devices without any in it stay."""
    days = spark.range(3650 * 4).select(
        F.concat(F.lit("d"), (F.col("id") % 4).cast("string")).alias("k"),
        F.expr("TIMESTAMP_NTZ '2015-01-01 00:00:00' + make_dt_interval(cast(id div 4 as int))").alias("t"),
        F.col("id").alias("tie"), F.col("id").cast("double").alias("v"),
    )
    old = spark.createDataFrame([("old", T0 - timedelta(days=2000 + i), i, 1.0) for i in range(500)], SCHEMA)
    cfg = HALF_HOURS.with_(calendar_start="2020-01-01 00:00:00", calendar_days=365, step_minutes=1440)
    df = checkpoint_table(days.unionByName(old))
    full = calendar.complete_calendar(df, cfg)
    assert full.count() == 5 * 366 and full.where("k = 'old' and v is null").count() == 366
    assert max(shuffled_rows(full)) < 4 * 366 + 100
    same(full, calendar.complete_calendar(df, cfg, deduplicate=False))
    assert max(shuffled_rows(calendar.complete_calendar(df, cfg, deduplicate=False))) < 4 * 366 + 100


def test_a_hot_group_of_copies_is_reduced_before_the_shuffle(spark):
    df = checkpoint_table(spark.createDataFrame(rows_of([(7, float(i)) for i in range(3000)]), SCHEMA).repartition(3))
    kept = calendar.keep_first_per_slot(df, HALF_HOURS)
    assert max(shuffled_rows(kept)) <= 3
    assert [tuple(r) for r in kept.collect()] == [("a", T0, 0, 0.0)]
