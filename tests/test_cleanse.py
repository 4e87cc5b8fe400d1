from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gridtide import fixed
from gridtide.config import TelemetryConfig
from gridtide.operators import cleanse, derive, validate
from gridtide.operators.outliers import iqr_fences, replace_outliers
from tests.helpers import READING_SCHEMA, half_hours, reading

CFG = TelemetryConfig()
Y = "on_grid_total_yield_kwh"


def _validated(spark, rows):
    return validate.validate_rows(derive.derive_all(spark.createDataFrame(rows, READING_SCHEMA), CFG), CFG)


def test_negative_deltas_carry_one_step_back(spark):
    ts = half_hours("2022-07-01 10:00:00", 4)
    rows = [reading("A", t, i, (v, 0, 0, 0, 0, 0)) for i, (t, v) in enumerate(zip(ts, [10, 5, 3, 8]))]
    for fix in (cleanse.fix_negative_deltas, cleanse.repair_rule_failures, cleanse.repair_rule_failures_stepwise):
        out = fix(_validated(spark, rows), CFG).orderBy(CFG.time).collect()
        assert [r[Y] for r in out] == [10.0, 10.0, 5.0, 8.0]  # the second flagged row gets the first one's old value
        assert [r[CFG.delta(Y)] for r in out] == [0.0, 0.0, 0.0, 5.0]


def test_first_flagged_row_becomes_null(spark):
    # PV at night on the first row: no previous value exists
    rows = [reading("A", "2022-07-01 01:00:00", 1, (0, 0, 0, 0, 0, 0)), reading("A", "2022-07-01 01:30:00", 2, (0, 0, 0, 7, 0, 0))]
    v = _validated(spark, rows)
    out = cleanse.fix_pv_at_night(v, CFG).orderBy(CFG.time).collect()
    assert fixed.MSG_PV_AT_NIGHT in out[1][fixed.ERROR_MESSAGE]
    assert out[1]["pv_total_power_generation_kwh"] == 0.0
    assert out[1][CFG.delta("pv_total_power_generation_kwh")] == 0.0
    first = v.withColumn(fixed.ERROR_MESSAGE, F.lit(fixed.MSG_PV_AT_NIGHT))
    assert cleanse.fix_pv_at_night(first, CFG).orderBy(CFG.time).first()["pv_total_power_generation_kwh"] is None


def test_charge_discharge_by_time_of_day(spark):
    rows = [
        reading("A", "2022-07-01 12:00:00", 1, (0, 0, 0, 0, 1, 1)),
        reading("A", "2022-07-01 12:30:00", 2, (0, 0, 0, 0, 2, 2)),
        reading("A", "2022-07-01 23:00:00", 3, (0, 0, 0, 0, 3, 3)),
    ]
    out = cleanse.fix_charge_and_discharge(_validated(spark, rows), CFG).orderBy(CFG.time).collect()
    assert (out[1]["total_battery_charge_kwh"], out[1]["total_battery_discharge_kwh"]) == (2.0, 1.0)  # day
    assert (out[2]["total_battery_charge_kwh"], out[2]["total_battery_discharge_kwh"]) == (2.0, 3.0)  # night


def test_fused_repair_equals_stepwise_on_fixture(spark):
    from gridtide.plans import catalog

    v = catalog._validated(spark, "/root/testdata/sf0.001").drop(fixed.VALIDATION_RESULT)
    a = cleanse.repair_rule_failures(v, catalog.TELEMETRY)
    b = cleanse.repair_rule_failures_stepwise(v, catalog.TELEMETRY)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _series(spark, values, key="A"):
    return spark.createDataFrame(
        [(key, datetime(2024, 1, 1, 0, i), i, float(v)) for i, v in enumerate(values)],
        "k string, t timestamp_ntz, id bigint, x double",
    )


OUT_CFG = TelemetryConfig(key="k", time="t", tie="id", counters=(), attributes=(), provenance=None)


def test_outliers_take_previous_value(spark):
    df = _series(spark, [10, 11, 12, 13, 500, 12, 11, 10, -400, 12])
    out = replace_outliers(df, OUT_CFG, ["x"], accuracy=10_000).orderBy("t").collect()
    assert [r.x for r in out] == [10, 11, 12, 13, 13, 12, 11, 10, 10, 12]
    exact = replace_outliers(df, OUT_CFG, ["x"], exact=True).orderBy("t").collect()
    assert [r.x for r in exact] == [r.x for r in out]


def test_global_scope_reads_previous_row_of_any_device(spark):
    a = spark.createDataFrame([("A", datetime(2024, 1, 1, 0, 0), 1, 10.0), ("A", datetime(2024, 1, 1, 0, 2), 3, 900.0)],
                              "k string, t timestamp_ntz, id bigint, x double")
    b = spark.createDataFrame([("B", datetime(2024, 1, 1, 0, 1), 2, 20.0), ("B", datetime(2024, 1, 1, 0, 3), 4, 21.0)],
                              "k string, t timestamp_ntz, id bigint, x double")
    df = a.unionByName(b)
    dev = {r.id: r.x for r in replace_outliers(df, OUT_CFG, ["x"], accuracy=10_000).collect()}
    glob = {r.id: r.x for r in replace_outliers(df, OUT_CFG, ["x"], scope="global", accuracy=10_000).collect()}
    assert dev[3] == 10.0 and glob[3] == 20.0


def test_outlier_edge_cases(spark):
    empty = _series(spark, [1]).limit(0)
    assert replace_outliers(empty, OUT_CFG, ["x"]).count() == 0
    with pytest.raises(ValueError):
        replace_outliers(_series(spark, [1]), OUT_CFG, [1])
    fences = iqr_fences(_series(spark, [1, 2, 3, 4]), ["x"], accuracy=10_000).first()
    assert (fences.q1, fences.q3, fences.lower, fences.upper) == (1.0, 3.0, -2.0, 6.0)


def test_exact_quantiles_equal_percentile_disc_with_narrowing(spark):
    from gridtide.operators.outliers import exact_quantiles

    rows = [(float((i * 7919) % 3001),) for i in range(20000)] + [(5.0,)] * 3000
    df = spark.createDataFrame(rows, "x double")
    probs = [0.01, 0.25, 0.5, 0.75, 0.99]
    want = list(df.select(*[F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY x)") for p in probs]).first())
    assert exact_quantiles(df, ["x"], probs, accuracy=100, band_limit=50)["x"] == want
    assert exact_quantiles(df.limit(0), ["x"], probs)["x"] == [None] * len(probs)


def test_keyed_previous_splits_a_hot_device_and_matches_a_window(spark):
    from pyspark.sql import Window

    from gridtide.operators.derive import counter_deltas
    from gridtide.operators.outliers import keyed_previous
    from gridtide.plans import catalog, fixtures

    ev = fixtures.table(spark, "/root/testdata/sf0.001", "events")
    hot = ev.withColumn("user_id", F.when(F.col("event_id") % 2 == 0, F.lit(7)).otherwise(F.col("user_id")))
    hot = hot.repartition(5, "event_type")  # input order not fixed
    got = keyed_previous(hot, ["value"], ["user_id"], ["ts", "event_id"], partitions=6)
    want = hot.withColumn("__prev_value", F.lag("value").over(Window.partitionBy("user_id").orderBy("ts", "event_id")))
    cols = ["event_id", "__prev_value"]
    assert got.select(*cols).exceptAll(want.select(*cols)).count() == 0
    assert got.count() == hot.count()
    t = fixtures.telemetry(spark, "/root/testdata/sf0.001")
    a = counter_deltas(t, catalog.TELEMETRY)
    b = counter_deltas(t, catalog.TELEMETRY.with_(group_rows=50))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
