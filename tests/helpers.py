from datetime import datetime, timedelta

from gridtide import fixed

READING_SCHEMA = (
    "inverter_serial_no string, date_time timestamp_ntz, file_id bigint, "
    + ", ".join(f"{c} double" for c in fixed.COUNTERS)
    + ", battery_capacity_percentage double"
)


def ts(text: str) -> datetime:
    return datetime.fromisoformat(text)


def reading(key, when, file_id, counters=(0, 0, 0, 0, 0, 0), cap=50.0):
    return (key, ts(when) if isinstance(when, str) else when, file_id, *[float(c) for c in counters], cap)


def half_hours(start: str, n: int):
    t0 = ts(start)
    return [t0 + timedelta(minutes=30 * i) for i in range(n)]
