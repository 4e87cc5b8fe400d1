from pyspark.sql import functions as F

from gridtide import fixed
from gridtide.config import TelemetryConfig
from gridtide.operators.derive import derive_all
from gridtide.operators.validate import validate_rows
from tests.helpers import READING_SCHEMA, reading

CFG = TelemetryConfig()
DELTA_COLS = [CFG.delta(c) for c in fixed.COUNTERS]


def _row(spark, **values):
    base = {c: 0.0 for c in DELTA_COLS}
    base.update(
        {
            "total_consume_energy_from_grid_kwh": 0.0,
            fixed.CAPACITY: 50.0,
            fixed.HOUSE_POWER: 1.0,
            fixed.TIME_OF_DAY: "Day",
        }
    )
    base.update(values)
    cols = list(base)
    types = {fixed.TIME_OF_DAY: "string"}
    schema = ", ".join(f"`{c}` {types.get(c, 'double')}" for c in cols)
    return spark.createDataFrame([tuple(base[c] for c in cols)], schema)


def _verdict(spark, **values):
    r = validate_rows(_row(spark, **values), CFG).select(fixed.IS_VALID, fixed.ERROR_MESSAGE).first()
    return r[0], r[1]


def test_clean_row_is_valid(spark):
    assert _verdict(spark) == (True, "Valid")


def test_each_rule_message(spark):
    d = CFG.delta
    cases = [
        ({d("on_grid_total_yield_kwh"): -1.0}, fixed.MSG_YIELD_NEGATIVE),
        ({d("total_feed_in_energy_kwh"): -1.0}, fixed.MSG_FEED_IN_NEGATIVE),
        ({fixed.CAPACITY: 5.0, d("total_feed_in_energy_kwh"): 1.0}, fixed.MSG_FEED_IN_LOW_BATTERY),
        ({"total_consume_energy_from_grid_kwh": 3.0, d("total_feed_in_energy_kwh"): 1.0}, fixed.MSG_FEED_IN_AND_CONSUME),
        ({"total_consume_energy_from_grid_kwh": -3.0}, fixed.MSG_CONSUME_NEGATIVE),
        ({fixed.CAPACITY: 101.0}, fixed.MSG_CAPACITY_RANGE),
        ({d("total_battery_charge_kwh"): 1.0, d("total_battery_discharge_kwh"): 1.0}, fixed.MSG_CHARGE_AND_DISCHARGE),
        ({d("total_battery_charge_kwh"): -1.0}, fixed.MSG_CHARGE_NEGATIVE),
        ({d("total_battery_discharge_kwh"): -1.0}, fixed.MSG_DISCHARGE_NEGATIVE),
        ({fixed.HOUSE_POWER: 0.0, d("total_battery_discharge_kwh"): 2.0}, fixed.MSG_DISCHARGE_NO_USE),
        ({d("pv_total_power_generation_kwh"): -1.0}, fixed.MSG_PV_NEGATIVE),
        ({fixed.TIME_OF_DAY: "Night", d("pv_total_power_generation_kwh"): 2.0}, fixed.MSG_PV_AT_NIGHT),
        ({fixed.HOUSE_POWER: 0.0, d("total_consume_energy_from_grid_kwh"): 2.0}, fixed.MSG_GRID_NO_USE),
    ]
    for values, message in cases:
        ok, msg = _verdict(spark, **values)
        assert not ok
        assert message in msg, (values, msg)


def test_several_errors_keep_rule_order(spark):
    d = CFG.delta
    ok, msg = _verdict(
        spark,
        **{d("total_battery_charge_kwh"): -1.0, d("on_grid_total_yield_kwh"): -2.0, fixed.CAPACITY: -5.0},
    )
    assert not ok
    assert msg == ", ".join([fixed.MSG_YIELD_NEGATIVE, fixed.MSG_CAPACITY_RANGE, fixed.MSG_CHARGE_NEGATIVE])


def test_null_operand_does_not_fire(spark):
    assert _verdict(spark, **{fixed.CAPACITY: None}) == (True, "Valid")


def test_capacity_boundaries(spark):
    assert _verdict(spark, **{fixed.CAPACITY: 0.0})[0]
    assert _verdict(spark, **{fixed.CAPACITY: 100.0})[0]
    assert not _verdict(spark, **{fixed.CAPACITY: 100.5})[0]


def test_cumulative_consumption_quirk_and_option(spark):
    d = CFG.delta
    row = _row(spark, **{"total_consume_energy_from_grid_kwh": 9.0, d("total_feed_in_energy_kwh"): 1.0})
    assert fixed.MSG_FEED_IN_AND_CONSUME in validate_rows(row, CFG).first()[fixed.ERROR_MESSAGE]
    inst = CFG.with_(instantaneous_consumption_rules=True)
    assert validate_rows(row, inst).first()[fixed.IS_VALID]


def test_rule_counts_match_fixture_table(spark):
    """FIXTURES.md section 3 rule counts at sf0.001 (both engines agreed on them)."""
    from gridtide.plans import catalog

    v = catalog._validated(spark, "/root/testdata/sf0.001")
    expected = [88, 27, 26, 203, 11, 160, 385, 26, 26, 163, 26, 205, 56]
    from gridtide.plans.chain import rule_columns

    got = v.agg(*[F.count_if(F.col(fixed.ERROR_MESSAGE).contains(m)).alias(n) for n, m in rule_columns()]).first()
    assert list(got) == expected
    assert v.filter(F.col(fixed.IS_VALID)).count() == 164


def test_struct_and_flat_columns(spark):
    df = derive_all(
        spark.createDataFrame([reading("A", "2022-07-01 10:00:00", 1)], READING_SCHEMA), CFG
    )
    out = validate_rows(df, CFG)
    r = out.first()
    assert r[fixed.VALIDATION_RESULT][fixed.IS_VALID] == r[fixed.IS_VALID]
    assert r[fixed.VALIDATION_RESULT][fixed.ERROR_MESSAGE] == r[fixed.ERROR_MESSAGE]
