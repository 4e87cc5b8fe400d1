"""Long devices read in chunks: every operator equals the plain device window, and no plan holds a whole device."""

import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from gridtide.operators import calendar, chunks, cleanse, derive, outliers, validate
from gridtide.plans import catalog, fixtures
from gridtide.session import checkpoint_table

SF = "/root/testdata/sf0.001"
PLAIN = catalog.TELEMETRY
HOT = PLAIN.with_(group_rows=60)


def same(a, b):
    assert a.columns == b.columns
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def planned(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def assert_no_device_window(df, key):
    """Every window over the device also has the chunk (or reads the table with a row per chunk)."""
    for line in planned(df).splitlines():
        if "Window [" in line and "specwindowframe" not in line and f"[{key}#" in line:
            assert "__chunk" in line, line


@pytest.fixture(scope="module")
def readings(spark):
    """Telemetry with half of all readings on one device."""
    t = fixtures.telemetry(spark, SF)
    hot = t.withColumn("inverter_serial_no", F.when(F.col("file_id") % 2 == 0, F.lit("INV-hot")).otherwise(F.col("inverter_serial_no")))
    return checkpoint_table(hot.repartition(5, "file_id"))  # rows in no order


@pytest.fixture(scope="module")
def checked(readings):
    return checkpoint_table(validate.validate_rows(derive.derive_all(readings, PLAIN, keep_tie=True), PLAIN))


def test_bounds_are_found_for_long_devices_only(readings):
    bounds = chunks.find_bounds(readings, [PLAIN.key], ["date_time", "file_id"], 60)
    found = {r[PLAIN.key]: len(r["__bounds"]) for r in bounds.collect()}
    counts = {r[PLAIN.key]: r["count"] for r in readings.groupBy(PLAIN.key).count().collect()}
    assert set(found) == {k for k, n in counts.items() if n > 60} and "INV-hot" in found
    assert found["INV-hot"] >= counts["INV-hot"] // 120
    assert chunks.find_bounds(readings, [PLAIN.key], ["date_time"], 10**6) is None


def test_deltas(readings):
    got = derive.counter_deltas(readings, HOT)
    same(got, derive.counter_deltas(readings, PLAIN))
    assert_no_device_window(got, PLAIN.key)


@pytest.mark.parametrize("step", cleanse.RULE_REPAIRS, ids=lambda f: f.__name__)
def test_each_repair(checked, step):
    got = step(checked, HOT)
    same(got.drop("validation_result"), step(checked, PLAIN).drop("validation_result"))
    assert_no_device_window(got, PLAIN.key)


def test_all_repairs_at_once_with_four_rows_of_halo(checked):
    columns = PLAIN.outlier_columns
    got = cleanse.repair_rule_failures(checked, HOT, previous_of=columns)
    same(got.drop("validation_result"), cleanse.repair_rule_failures(checked, PLAIN, previous_of=columns).drop("validation_result"))
    assert_no_device_window(got, PLAIN.key)


def test_outliers_and_the_whole_cleaning(readings, checked):
    got = outliers.replace_outliers(readings, HOT, ["battery_capacity_percentage"], exact=True, multiplier=0.2)
    same(got, outliers.replace_outliers(readings, PLAIN, ["battery_capacity_percentage"], exact=True, multiplier=0.2))
    assert_no_device_window(got, PLAIN.key)
    a = cleanse.clean_all(checked, HOT, exact=True).drop("validation_result")
    same(a, cleanse.clean_all(checked, PLAIN, exact=True).drop("validation_result"))


def test_backward_fill_on_two_levels(readings):
    sparse = readings.select(
        PLAIN.key, PLAIN.time, "file_id",
        F.when(F.col("file_id") % 97 == 0, F.col("site_name")).alias("site_name"),
        F.when(F.col("file_id") % 5 == 0, F.col("battery_capacity_percentage")).alias("v"),
        F.lit(None).cast("double").alias("never"),
    )
    got = calendar.bfill_all(sparse, HOT)
    same(got, calendar.bfill_all(sparse, PLAIN))
    assert_no_device_window(got, PLAIN.key)
    # one device holds all rows
    one = sparse.withColumn(PLAIN.key, F.lit("INV-hot"))
    same(calendar.bfill_all(one, HOT), calendar.bfill_all(one, PLAIN))


def test_random_groups_nulls_and_chunks_of_one_row(spark):
    """Null keys, null times, null ties and bounds at almost every row, against a plain lag."""
    r = random.Random(4)
    t0 = datetime(2024, 1, 1)
    rows = [
        (r.choice(["a", "a", "a", None, "b"]), None if r.random() < 0.02 else t0 + timedelta(minutes=r.randint(0, 400)), i, r.choice([None, i, -i]))
        for i in range(700)
    ]
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz, tie long, v long")
    w = Window.partitionBy("k").orderBy("t", "tie")
    places = df.select("k", F.struct(F.col("t").alias("o0"), F.col("tie").alias("o1")).alias("p"))
    dense = places.groupBy("k").agg(F.array_sort(F.collect_list("p")).alias("p"))
    for every in (1, 2, 13):
        bounds = dense.select("k", F.filter("p", lambda _, i: (i > 0) & (i % every == 0)).alias("__bounds"))
        got = chunks.previous_rows(df, ["k"], ["t", "tie"], {"x": (1, ["v"]), "y": (4, ["v", "tie"])}, bounds)
        want = df.withColumns({"x": F.lag(F.struct("v"), 1).over(w), "y": F.lag(F.struct("v", "tie"), 4).over(w)})
        same(got, want)
        filled = chunks.backward_fill(df, ["k"], ["t", "tie"], ["v"], bounds)
        same(filled, chunks.backward_fill(df, ["k"], ["t", "tie"], ["v"]))


def test_previous_over_all_rows_shuffles_them_once(readings):
    got = outliers.global_previous(readings, ["battery_capacity_percentage"], ["date_time", PLAIN.key, "file_id"], partitions=4)
    w = Window.orderBy("date_time", PLAIN.key, "file_id")
    want = readings.withColumn("__prev_battery_capacity_percentage", F.lag("battery_capacity_percentage").over(w))
    same(got, want)
    plan = planned(got)
    # one exchange of the rows; the other one lies behind a rank limit that leaves a row per chunk and task
    rows, tail = plan.split("BroadcastExchange", 1)
    assert len(re.findall(r"Exchange hashpartitioning\(__chunk#\d+", rows)) == 1 == rows.count("Exchange")
    assert len(re.findall(r"Exchange hashpartitioning\(__chunk#\d+, 4\).*\n[ +-]*WindowGroupLimit.*Partial", tail)) == 1


def test_copies_of_one_place_cannot_fill_the_sample(spark):
    """All rows of a long device at one place: one chunk, and the result of the window."""
    df = spark.range(500).select(F.lit("a").alias("k"), F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz").alias("t"), F.lit(7).alias("v"))
    bounds = chunks.find_bounds(df, ["k"], ["t"], 50)
    assert bounds is None or bounds.first()["__bounds"] == []
    got = chunks.previous_rows(df, ["k"], ["t"], {"x": (2, ["v"])}, bounds)
    assert got.where("x is null").count() == 2 and got.count() == 500


def test_empty_table(spark):
    df = spark.createDataFrame([], "k string, t timestamp_ntz, v long")
    assert chunks.find_bounds(df, ["k"], ["t"], 5) is None
    bounds = chunks.find_all_bounds(df, ["t"], 8)
    assert chunks.previous_rows(df, [], ["t"], {"x": (1, ["v"])}, bounds).collect() == []
