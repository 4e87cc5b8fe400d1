import os
import tempfile

import pytest

from gridtide import fixed
from gridtide.config import TelemetryConfig
from gridtide.sources import csv as csv_source
from gridtide.sources import frames, jdbc


def test_csv_readings_parse_day_first_and_drop_simulated(spark):
    d = tempfile.mkdtemp(prefix="gridtide-csv-")
    path = os.path.join(d, "r.csv")
    with open(path, "w") as fh:
        fh.write("inverter_serial_no,date_time,date_time_simulated,total_feed_in_energy_kwh\n")
        fh.write("A,01/07/2022 00:30,x,1.5\n")
        fh.write("A,1/7/2022 0:30,x,2.5\n")
        fh.write("A,garbage,x,3.5\n")
    df = csv_source.load_readings(
        spark, path, TelemetryConfig(),
        schema="inverter_serial_no string, date_time string, date_time_simulated string, total_feed_in_energy_kwh double",
    )
    assert fixed.DROPPED_AT_LOAD not in df.columns
    assert dict(df.dtypes)["date_time"] == "timestamp_ntz"
    got = [r.date_time for r in df.orderBy("total_feed_in_energy_kwh").collect()]
    assert str(got[0]) == "2022-07-01 00:30:00" and got[1] is None and got[2] is None
    lenient = csv_source.load_readings(spark, path, TelemetryConfig(time_format="d/M/yyyy H:mm"))
    assert lenient.filter("date_time is not null").count() == 2
    assert csv_source.load_csv(spark, path).count() == 3


def test_every_line_is_a_reading_or_a_malformed_line(spark, tmp_path):
    """Short, long, unparseable, empty and odd lines: all accounted for, with file and text, by any query."""
    good = ["A,01/07/2022 00:30,x,1.5", "B,01/07/2022 01:00,,", ",01/07/2022 01:30,x,2", "C,,x,3", '"D,E",01/07/2022 02:00,x,4']
    bad = ["A,01/07/2022 00:30", "A,01/07/2022 00:30,x,1.5,9", "A,01/07/2022 00:30,x,much", "A", "A,01/07/2022 00:30,x,1.5,,,,"]
    late = ["A,32/07/2022 00:30,x,1.5", "A,2022-07-01,x,1.5"]
    header = "inverter_serial_no,date_time,date_time_simulated,total_feed_in_energy_kwh"
    (tmp_path / "a.csv").write_text("\n".join([header, *good[:3], *bad[:3], late[0]]) + "\n")
    (tmp_path / "b.csv").write_text("\n".join([header, *bad[3:], *good[3:], late[1], ""]))
    schema = "inverter_serial_no string, date_time string, date_time_simulated string, total_feed_in_energy_kwh double"
    kept, other = csv_source.split_readings(spark, str(tmp_path), schema, TelemetryConfig())
    assert (kept.count(), other.count()) == (5, 7)
    assert kept.columns == ["inverter_serial_no", "date_time", "total_feed_in_energy_kwh"]
    assert {r.inverter_serial_no for r in kept.collect()} == {"A", "B", "C", "D,E", None}
    got = {(r.source_file.rsplit("/", 1)[1], r.line, r.quarantine_reason) for r in other.collect()}
    assert got == {
        *{("a.csv", x, csv_source.BAD_LINE) for x in bad[:3]}, *{("b.csv", x, csv_source.BAD_LINE) for x in bad[3:]},
        ("a.csv", late[0], csv_source.BAD_TIME), ("b.csv", late[1], csv_source.BAD_TIME),
    }
    rows, lines = csv_source.split_csv(spark, str(tmp_path), schema)
    assert (rows.count(), lines.count()) == (7, 5)
    assert rows.select("date_time").count() == 7 and lines.groupBy("line").count().count() == 5
    none = tmp_path / "none"
    none.mkdir()
    (none / "c.csv").write_text(header + "\n")
    assert [df.count() for df in csv_source.split_readings(spark, str(none), schema, TelemetryConfig())] == [0, 0]


def test_preview_empty_like_append(spark):
    df = spark.range(10).withColumnRenamed("id", "n")
    assert [r.n for r in frames.preview(df, 3, order_by=["n"]).collect()] == [0, 1, 2]
    with pytest.raises(ValueError):
        frames.preview(None)
    e = frames.empty_like(df)
    assert e.count() == 0 and e.schema == df.schema
    both = frames.append(df.withColumn("m", df.n * 2), df)
    assert both.count() == 20 and both.filter("m is null").count() == 10


def test_jdbc_partitioned_read_needs_bounds(spark):
    with pytest.raises(ValueError):
        jdbc.read_table(spark, "jdbc:none", "t", partition_column="id", num_partitions=4)
