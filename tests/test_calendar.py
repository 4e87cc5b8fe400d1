from datetime import datetime, timedelta


from gridtide.config import TelemetryConfig
from gridtide.operators import calendar, quality

HH = TelemetryConfig(
    key="k", time="t", tie="id", counters=(), attributes=("site",), provenance="id",
    calendar_start="2022-07-01 00:00:00", calendar_days=1, step_minutes=30,
)
DAILY = TelemetryConfig(
    key="k", time="t", tie=None, counters=(), attributes=(), provenance=None,
    calendar_start="2023-01-01 00:00:00", calendar_days=119, step_minutes=24 * 60,
)
SCHEMA = "k string, t timestamp_ntz, id bigint, site string, v double"


def test_floor_keeps_earliest_reading_and_strips_subseconds(spark):
    rows = [
        ("A", datetime(2022, 7, 1, 10, 44, 59, 900000), 3, "s", 3.0),
        ("A", datetime(2022, 7, 1, 10, 31), 2, "s", 2.0),
        ("A", datetime(2022, 7, 1, 10, 30, 0), 9, "s", 1.0),
        ("A", datetime(2022, 7, 1, 10, 30, 0), 1, "s", 0.5),
        ("A", datetime(2022, 7, 1, 11, 0, 0, 1), 4, "s", 4.0),
    ]
    out = calendar.keep_first_per_slot(spark.createDataFrame(rows, SCHEMA), HH).orderBy("t").collect()
    assert [(r.t, r.id, r.v) for r in out] == [
        (datetime(2022, 7, 1, 10, 30), 1, 0.5),
        (datetime(2022, 7, 1, 11, 0), 4, 4.0),
    ]


def test_calendar_is_complete_per_device(spark):
    rows = [
        ("A", datetime(2022, 7, 1, 0, 40), 1, None, 1.0),
        ("A", datetime(2022, 7, 1, 5, 0), 2, "x", 2.0),
        ("A", datetime(2022, 7, 2, 0, 0), 3, None, 3.0),  # exactly the (inclusive) end slot
        ("A", datetime(2022, 7, 2, 0, 30), 4, None, 4.0),  # after the end: dropped
        ("B", datetime(2022, 6, 1, 0, 0), 5, "y", 5.0),  # only outside: empty calendar
        ("C", None, 6, "z", 6.0),  # only a NULL time: empty calendar
    ]
    out = calendar.complete_calendar(spark.createDataFrame(rows, SCHEMA), HH)
    assert HH.slots == 49
    counts = {r[0]: r[1] for r in out.groupBy("k").count().collect()}
    assert counts == {"A": 49, "B": 49, "C": 49}
    a = {r.t: r.v for r in out.filter("k = 'A'").collect()}
    assert a[datetime(2022, 7, 1, 0, 30)] == 1.0
    assert a[datetime(2022, 7, 1, 5, 0)] == 2.0
    assert a[datetime(2022, 7, 2, 0, 0)] == 3.0
    assert sum(v is not None for v in a.values()) == 3
    assert out.filter("k = 'B' and v is not null").count() == 0
    assert out.select("t").distinct().count() == 49


def test_attribute_fill_and_final_fill_leave_trailing_nulls(spark):
    rows = [("A", datetime(2022, 7, 1, 1, 0), 1, None, 1.0), ("A", datetime(2022, 7, 1, 2, 0), 2, "x", 2.0)]
    full = calendar.complete_calendar(spark.createDataFrame(rows, SCHEMA), HH)
    out = calendar.final_bfill(calendar.fill_attributes(full, HH), HH)
    got = {r.t: (r.site, r.v, r.id) for r in out.collect()}
    assert got[datetime(2022, 7, 1, 0, 0)] == ("x", 1.0, None)  # provenance is not filled
    assert got[datetime(2022, 7, 1, 1, 30)] == ("x", 2.0, None)
    assert got[datetime(2022, 7, 1, 2, 30)] == (None, None, None)  # trailing NULLs stay


def _daily(spark, values):
    rows = [("A", datetime(2023, 1, 1) + timedelta(days=d), float(v)) for d, v in values]
    return spark.createDataFrame(rows, "k string, t timestamp_ntz, v double")


def test_seasonal_fill_runs_only_when_first_record_is_null(spark):
    # 2023-01-01 is a Sunday; the next Sunday in January holds 5.0
    df = calendar.complete_calendar(_daily(spark, [(7, 5.0), (1, 7.0), (33, 1.0)]), DAILY)
    out = {r.t: r.v for r in calendar.seasonal_bfill(df, DAILY).collect()}
    assert out[datetime(2023, 1, 1)] == 5.0
    assert out[datetime(2023, 1, 2)] == 7.0
    assert out[datetime(2023, 1, 3)] is None  # no later Tuesday with a value in January
    assert out[datetime(2023, 1, 27)] is None  # the next Friday (Feb 3) is in another month
    assert out[datetime(2023, 2, 3)] == 1.0
    first = {r[0]: r[1] for r in calendar.first_record_null(df, DAILY).collect()}
    assert first == {"A": True}
    df2 = calendar.complete_calendar(_daily(spark, [(0, 1.0), (7, 5.0)]), DAILY)
    kept = {r.t: r.v for r in calendar.seasonal_bfill(df2, DAILY).collect()}
    assert kept[datetime(2023, 1, 7)] is None  # first record present: no seasonal fill


def test_gap_month_head_from_two_weeks_before_tail_from_three_weeks_after(spark):
    doy = [(d, d + 1) for d in range(119) if not (31 <= d < 59)]  # February (days 31..58) missing
    df = calendar.complete_calendar(_daily(spark, doy), DAILY)
    gap = calendar.first_gap_month(df, DAILY).first()
    assert str(gap.gap_month) == "2023-02-01"
    out = {r.t: r.v for r in calendar.fill_gap_month(df, DAILY).collect()}
    assert out[datetime(2023, 2, 1)] == 18.0  # Jan 18
    assert out[datetime(2023, 2, 14)] == 31.0  # Jan 31
    assert out[datetime(2023, 2, 15)] == 67.0  # Mar 8
    assert out[datetime(2023, 2, 28)] == 80.0  # Mar 21


def test_only_first_gap_month_is_filled_and_edges_become_null(spark):
    # January and March empty: January is the first gap; its head has no source
    vals = [(d, d + 1) for d in range(119) if not (d < 31 or 59 <= d < 90)]
    df = calendar.complete_calendar(_daily(spark, vals), DAILY)
    out = {r.t: r.v for r in calendar.fill_gap_month(df, DAILY).collect()}
    assert out[datetime(2023, 1, 1)] is None  # 14 days earlier is before the calendar
    assert out[datetime(2023, 1, 15)] == 36.0  # Feb 5
    assert out[datetime(2023, 3, 1)] is None  # second gap month untouched


def test_fused_series_equals_stepwise(spark):
    from gridtide.plans import catalog, fixtures

    sf = "/root/testdata/sf0.001"
    for cfg, src in [
        (catalog.SUPPLY, fixtures.daily_supply(spark, sf)),
        (catalog.FLAGSHIP, quality.generic_validation(fixtures.telemetry(spark, sf), catalog.FLAGSHIP)[0]),
    ]:
        a = calendar.complete_series(src, cfg)
        b = calendar.complete_series_stepwise(src, cfg)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_bfill_all_within_device(spark):
    rows = [("A", datetime(2022, 7, 1, 0, 0), None, None, None), ("A", datetime(2022, 7, 1, 1, 0), 2, "x", 2.0),
            ("B", datetime(2022, 7, 1, 0, 0), None, None, None)]
    out = {(r.k, r.t): (r.site, r.v) for r in calendar.bfill_all(spark.createDataFrame(rows, SCHEMA), HH).collect()}
    assert out[("A", datetime(2022, 7, 1, 0, 0))] == ("x", 2.0)
    assert out[("B", datetime(2022, 7, 1, 0, 0))] == (None, None)  # never bleeds across devices


def test_fused_series_equals_stepwise_on_edge_cases(spark):
    cases = [
        [(d, d + 1) for d in range(119) if not (31 <= d < 59)],  # February empty
        [(d, d + 1) for d in range(119) if not (d < 31 or 59 <= d < 90)],  # January and March empty
        [(0, 1.0), (7, 5.0), (100, 2.0)],  # first record present, sparse
        [(7, 5.0), (1, 7.0), (33, 1.0)],  # first record empty
        [(-30, 1.0), (200, 2.0)],  # only readings outside the calendar
        [(d, d + 1) for d in range(60)],  # trailing months empty
    ]
    for vals in cases:
        src = _daily(spark, vals)
        a = calendar.complete_series(src, DAILY)
        b = calendar.complete_series_stepwise(src, DAILY)
        assert a.count() == DAILY.slots
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, vals
