
from datetime import datetime

from gridtide import fixed
from gridtide.config import TelemetryConfig
from gridtide.functions.nulls import nan_to_null
from gridtide.operators import calendar, derive, validate
from gridtide.plans import chain
from tests.helpers import READING_SCHEMA, reading
from tests.test_calendar import DAILY, _daily


def test_nan_metric_becomes_null_and_fires_no_rule(spark):
    cfg = TelemetryConfig()
    rows = [reading("A", "2022-07-01 10:00:00", 1, cap=float("nan"))]
    df = nan_to_null(spark.createDataFrame(rows, READING_SCHEMA))
    assert df.first()[fixed.CAPACITY] is None
    out = validate.validate_rows(derive.derive_all(df, cfg), cfg).first()
    assert (out[fixed.IS_VALID], out[fixed.ERROR_MESSAGE]) == (True, "Valid")


def test_thirty_and_thirty_one_day_gap_months(spark):
    # April (30 days, day offsets 90..119) and, separately, March (31 days, 59..89) missing
    cfg = DAILY.with_(calendar_days=150)
    for lo, hi, first_tail, last_day in [(90, 120, datetime(2023, 4, 15), datetime(2023, 4, 30)),
                                         (59, 90, datetime(2023, 3, 15), datetime(2023, 3, 31))]:
        vals = [(d, d + 1) for d in range(151) if not (lo <= d < hi)]
        df = calendar.complete_calendar(_daily(spark, vals), cfg)
        out = {r.t: r.v for r in calendar.fill_gap_month(df, cfg).collect()}
        doy = lambda t: (t - datetime(2023, 1, 1)).days + 1
        assert out[first_tail] == doy(first_tail) + 21
        assert out[last_day] == doy(last_day) + 21
        first = datetime(first_tail.year, first_tail.month, 1)
        assert out[first] == doy(first) - 14


def test_whole_chain_on_empty_input(spark):
    cfg = TelemetryConfig(min_rows=1)
    empty = spark.createDataFrame([], READING_SCHEMA)
    res = chain.run_chain(empty, cfg, exact=True)
    assert res.cleaned.count() == 0 and res.failed.count() == 0
    assert chain.season_rule_report(res.cleaned, cfg).count() == 0


def test_device_with_a_single_reading_gets_the_full_calendar(spark):
    src = _daily(spark, [(45, 3.0)])  # Feb 15 only
    df = calendar.complete_series(src, DAILY)
    vals = [r.v for r in df.orderBy("t").collect()]
    assert len(vals) == DAILY.slots
    # every earlier day back-fills to the reading; later days stay NULL
    assert vals[:46] == [3.0] * 46
    assert all(v is None for v in vals[46:])
    b = calendar.complete_series_stepwise(src, DAILY)
    assert df.exceptAll(b).count() == 0 and b.exceptAll(df).count() == 0
