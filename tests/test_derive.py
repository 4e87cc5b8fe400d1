from datetime import datetime


from gridtide import fixed
from gridtide.config import TelemetryConfig
from gridtide.operators import derive
from tests.helpers import READING_SCHEMA, reading

CFG = TelemetryConfig()


def test_deltas_first_row_zero_and_difference(spark):
    rows = [
        reading("A", "2022-07-01 00:00:00", 1, (10, 0, 0, 0, 0, 0)),
        reading("A", "2022-07-01 00:30:00", 2, (15, 0, 0, 0, 0, 0)),
        reading("A", "2022-07-01 01:00:00", 3, (12, 0, 0, 0, 0, 0)),
        reading("B", "2022-07-01 00:00:00", 4, (100, 0, 0, 0, 0, 0)),
    ]
    out = derive.derive_all(spark.createDataFrame(rows, READING_SCHEMA), CFG)
    got = {(r[0], r[1].minute, r[1].hour): r[2] for r in out.select(CFG.key, CFG.time, CFG.delta("on_grid_total_yield_kwh")).collect()}
    assert got[("A", 0, 0)] == 0.0
    assert got[("A", 30, 0)] == 5.0
    assert got[("A", 0, 1)] == -3.0
    assert got[("B", 0, 0)] == 0.0  # first row of another device, never the previous device


def test_order_is_by_time_not_arrival(spark):
    rows = [
        reading("A", "2022-07-01 01:00:00", 3, (30, 0, 0, 0, 0, 0)),
        reading("A", "2022-07-01 00:00:00", 1, (10, 0, 0, 0, 0, 0)),
        reading("A", "2022-07-01 00:30:00", 2, (20, 0, 0, 0, 0, 0)),
    ]
    out = derive.derive_all(spark.createDataFrame(rows, READING_SCHEMA), CFG)
    assert sorted(r[0] for r in out.select(CFG.delta("on_grid_total_yield_kwh")).collect()) == [0.0, 10.0, 10.0]


def _labels(spark, stamps):
    rows = [reading("A", t, i) for i, t in enumerate(stamps)]
    out = derive.derive_all(spark.createDataFrame(rows, READING_SCHEMA), CFG)
    return {r[0]: (r[1], r[2]) for r in out.select(CFG.time, fixed.SEASON, fixed.TIME_OF_DAY).collect()}


def test_season_borders(spark):
    got = _labels(
        spark,
        [datetime(2023, 2, 28, 12), datetime(2023, 3, 1, 12), datetime(2023, 5, 31, 12), datetime(2023, 6, 1, 12),
         datetime(2023, 8, 31, 12), datetime(2023, 9, 1, 12), datetime(2023, 11, 30, 12), datetime(2023, 12, 1, 12)],
    )
    seasons = [got[k][0] for k in sorted(got)]
    assert seasons == ["Winter", "Spring", "Spring", "Summer", "Summer", "Autumn", "Autumn", "Winter"]


def test_time_of_day_hour_borders(spark):
    cases = {
        datetime(2023, 7, 1, 4, 59): "Night", datetime(2023, 7, 1, 5, 0): "Day", datetime(2023, 7, 1, 21, 59): "Day",
        datetime(2023, 7, 1, 22, 0): "Night", datetime(2023, 4, 1, 6, 59): "Night", datetime(2023, 4, 1, 7, 0): "Day",
        datetime(2023, 4, 1, 19, 30): "Day", datetime(2023, 4, 1, 20, 0): "Night", datetime(2023, 1, 1, 7, 59): "Night",
        datetime(2023, 1, 1, 8, 0): "Day", datetime(2023, 1, 1, 17, 59): "Day", datetime(2023, 1, 1, 18, 0): "Night",
        datetime(2023, 10, 1, 19, 0): "Day",
    }
    got = _labels(spark, list(cases))
    assert {k: v[1] for k, v in got.items()} == cases


def test_battery_behaviour_precedence_and_house_power(spark):
    d = CFG.delta
    schema = ", ".join(f"{c} double" for c in CFG.deltas)
    vals = {
        "solar": {d("pv_total_power_generation_kwh"): 1, d("total_battery_charge_kwh"): 1, d("total_consume_energy_from_grid_kwh"): 1},
        "grid": {d("total_battery_charge_kwh"): 1, d("total_consume_energy_from_grid_kwh"): 1},
        "dis": {d("total_battery_discharge_kwh"): 1, d("on_grid_total_yield_kwh"): 2, d("total_feed_in_energy_kwh"): 3},
        "other": {},
    }
    rows = [tuple(float(v.get(c, 0)) for c in CFG.deltas) for v in vals.values()]
    df = spark.createDataFrame(rows, schema)
    out = derive.add_house_power(derive.add_battery_behaviour(df, CFG), CFG).collect()
    assert [r[fixed.BATTERY_BEHAVIOUR] for r in out] == ["Solar Charging", "Grid Charging", "Discharging", "Other"]
    assert [r[fixed.HOUSE_POWER] for r in out] == [1.0, 1.0, 5.0, 0.0]
    nulls = spark.createDataFrame([tuple([None] * 6)], schema)
    assert derive.add_house_power(nulls, CFG).first()[fixed.HOUSE_POWER] is None


def test_calendar_parts_monday_zero(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 13, 45),)], "date_time timestamp_ntz")
    r = derive.add_calendar_parts(df, CFG).first()
    assert (r["dayOfWeek"], r["hour"], r["minute"], r["weekOfYear"]) == (0, 13, 45, 1)
    assert str(r["yearMonth"]) == "2024-01-01"
    assert derive.drop_calendar_parts(derive.add_calendar_parts(df, CFG)).columns == ["date_time"]


def test_projection_keeps_nine_columns(spark):
    df = spark.createDataFrame([reading("A", "2022-07-01 00:00:00", 1)], READING_SCHEMA)
    assert len(derive.project_analysis_columns(df, CFG).columns) == 9
