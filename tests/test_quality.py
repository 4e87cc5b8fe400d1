from gridtide import fixed
from gridtide.config import TelemetryConfig
from gridtide.operators import quality
from tests.helpers import READING_SCHEMA, half_hours, reading


def test_threshold_is_exact_at_the_reference_counts(spark):
    cfg = TelemetryConfig()
    assert cfg.slots == 17521
    assert cfg.rejection_threshold == 14641  # 14,641 accepted, 14,640 rejected


def test_thin_devices_and_boundary(spark):
    cfg = TelemetryConfig(min_rows=3)
    rows = [reading("A", t, i) for i, t in enumerate(half_hours("2022-07-01 00:00:00", 3))]
    rows += [reading("B", t, 10 + i) for i, t in enumerate(half_hours("2022-07-01 00:00:00", 2))]
    rows += [reading(None, "2022-07-01 00:00:00", 99)]
    out = quality.flag_thin_devices(spark.createDataFrame(rows, READING_SCHEMA), cfg)
    got = {(r[0], r[1]) for r in out.select(cfg.key, fixed.IS_REJECTED).distinct().collect()}
    assert got == {("A", 0), ("B", 1), (None, 0)}
    assert dict(out.select(fixed.IS_REJECTED).dtypes)[fixed.IS_REJECTED] == "bigint"


def test_duplicates_flag_every_member(spark):
    cfg = TelemetryConfig(min_rows=1)
    rows = [
        reading("A", "2022-07-01 00:00:00", 1),
        reading("A", "2022-07-01 00:00:00", 2),
        reading("A", "2022-07-01 00:30:00", 3),
        reading("A", None, 4),
        reading("A", None, 5),
    ]
    out = quality.flag_duplicate_times(spark.createDataFrame(rows, READING_SCHEMA), cfg)
    flags = {r[0]: r[1] for r in out.select("file_id", fixed.IS_DUPLICATE).collect()}
    assert flags == {1: 1, 2: 1, 3: 0, 4: 0, 5: 0}


def test_generic_split_sums_to_input_and_matches_separate_checks(spark):
    cfg = TelemetryConfig(min_rows=3)
    rows = [reading("A", t, i) for i, t in enumerate(half_hours("2022-07-01 00:00:00", 4))]
    rows += [reading("A", "2022-07-01 00:00:00", 50)]  # duplicate time
    rows += [reading("B", "2022-07-01 00:00:00", 60)]  # thin
    rows += [reading("C", None, 70), reading("C", None, 71), reading("C", "2022-07-01 00:00:00", 72)]
    df = spark.createDataFrame(rows, READING_SCHEMA)
    valid, failed = quality.generic_validation(df, cfg)
    assert valid.count() + failed.count() == df.count()
    assert valid.columns == df.columns
    sep = quality.flag_duplicate_times(quality.flag_thin_devices(df, cfg), cfg)
    a = sep.select("file_id", fixed.IS_REJECTED, fixed.IS_DUPLICATE)
    b = quality.flag_generic(df, cfg).select("file_id", fixed.IS_REJECTED, fixed.IS_DUPLICATE)
    assert sorted(a.collect()) == sorted(b.collect())
    assert sorted(r[0] for r in valid.select("file_id").collect()) == [1, 2, 3, 70, 71, 72]


def test_device_list_is_distinct(spark):
    rows = [reading("A", "2022-07-01 00:00:00", 1), reading("A", "2022-07-01 00:30:00", 2), reading("B", "2022-07-01 00:00:00", 3)]
    assert sorted(r[0] for r in quality.device_list(spark.createDataFrame(rows, READING_SCHEMA)).collect()) == ["A", "B"]
