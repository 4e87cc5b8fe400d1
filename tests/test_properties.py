
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from gridtide.operators import calendar, cleanse, derive, quality
from gridtide.plans import catalog, fixtures
from tests.test_calendar import DAILY

SF = "/root/testdata/sf0.001"


def test_deltas_sum_to_last_minus_first(spark):
    cfg = catalog.TELEMETRY
    d = derive.derive_all(fixtures.telemetry(spark, SF), cfg)
    c = "total_battery_charge_kwh"
    per = d.groupBy(cfg.key).agg(
        F.sum(cfg.delta(c)).alias("s"),
        (F.max_by(c, cfg.time) - F.min_by(c, cfg.time)).alias("span"),
    )
    assert per.filter(F.col("s") != F.col("span")).count() == 0


def test_repaired_deltas_are_never_negative(spark):
    cfg = catalog.TELEMETRY
    out = cleanse.repair_rule_failures(catalog._validated(spark, SF), cfg)
    assert out.filter(" OR ".join(f"`{d}` < 0" for d in cfg.deltas)).count() == 0


def test_valid_plus_failed_is_input(spark):
    li = fixtures.table(spark, SF, "lineitem")
    valid, failed = quality.generic_validation(li, catalog.LINEITEM)
    assert valid.count() + failed.count() == li.count()


def test_completion_idempotent_on_a_complete_series(spark):
    rows = [("A", datetime(2023, 1, 1) + timedelta(days=i), float(i)) for i in range(DAILY.slots)]
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz, v double")
    once = calendar.complete_series(df, DAILY)
    twice = calendar.complete_series(once, DAILY)
    assert once.exceptAll(df).count() == 0 and twice.exceptAll(once).count() == 0


def test_independent_of_partition_count_and_row_order(spark):
    prev = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        a = calendar.complete_series(fixtures.daily_supply(spark, SF), catalog.SUPPLY).collect()
        spark.conf.set("spark.sql.shuffle.partitions", "7")
        shuffled = fixtures.daily_supply(spark, SF).orderBy(F.rand(7))
        b = calendar.complete_series(shuffled, catalog.SUPPLY).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", prev)
    assert sorted(a) == sorted(b)
    assert len(a) == 100 * catalog.SUPPLY.slots or len(a) % catalog.SUPPLY.slots == 0
