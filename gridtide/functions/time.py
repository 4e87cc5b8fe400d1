"""Wall-clock time helpers on ``timestamp_ntz`` columns.

Readings carry naive wall-clock times, so everything stays ``timestamp_ntz``:
no session time zone can shift a slot. ``date_trunc`` would turn the type into
a zoned timestamp, hence the interval arithmetic below.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ntz(text: str) -> Column:
    """A ``timestamp_ntz`` literal from ``'YYYY-MM-DD HH:MM:SS'``."""
    return F.expr(f"TIMESTAMP_NTZ '{text}'")


def minutes(n: int) -> Column:
    return F.expr(f"INTERVAL {int(n)} MINUTES")


def days(n: int) -> Column:
    return F.expr(f"INTERVAL {int(n)} DAYS")


def floor_to_step(ts: Column | str, step_minutes: int) -> Column:
    """Floor a wall-clock time to the start of its ``step_minutes`` slot.

    The step divides a day, so the slot start is midnight plus a whole number
    of steps. Seconds and sub-seconds are removed too (a reading at 10:44:59.9
    belongs to the 10:30 slot). NULL stays NULL.
    """
    ts = F.col(ts) if isinstance(ts, str) else ts
    minute_of_day = F.hour(ts) * 60 + F.minute(ts)
    return ts - F.make_dt_interval(
        F.lit(0),
        F.lit(0),
        minute_of_day % F.lit(step_minutes),
        F.date_part(F.lit("SECONDS"), ts),
    )
