"""Pipeline settings: column roles, calendar and thresholds.

One frozen dataclass replaces hard-coded names so every operator works on any
table whose columns play the same roles (the tests run the operators on tables
derived from the driver's TPC-H-like data).
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import datetime, timedelta

from gridtide import fixed


@dataclass(frozen=True)
class TelemetryConfig:
    key: str = fixed.KEY
    time: str = fixed.TIME
    # Total order inside a device: (time, tie). The reference orders by time only,
    # which is non-deterministic on ties; a declared tie column makes it stable.
    tie: str | None = fixed.PROVENANCE
    counters: tuple[str, ...] = fixed.COUNTERS
    capacity: str = fixed.CAPACITY
    attributes: tuple[str, ...] = fixed.ATTRIBUTES
    provenance: str | None = fixed.PROVENANCE
    delta_prefix: str = fixed.DELTA_PREFIX
    # Calendar: [start, start + days] inclusive, one slot every step_minutes.
    calendar_start: str = fixed.CALENDAR_START
    calendar_days: int = fixed.CALENDAR_DAYS
    step_minutes: int = fixed.STEP_MINUTES
    # A device is rejected when it has fewer than slots - missing_threshold rows,
    # unless min_rows is given explicitly.
    missing_threshold: int = fixed.MISSING_THRESHOLD
    min_rows: int | None = None
    time_format: str = fixed.TIME_FORMAT
    # V4/V5 read the cumulative consumption counter in the reference rule book;
    # True switches them to the per-interval delta.
    instantaneous_consumption_rules: bool = False
    outlier_columns: tuple[str, ...] = fixed.OUTLIER_COLUMNS
    iqr_multiplier: float = fixed.IQR_MULTIPLIER
    # Relative accuracy of percentile_approx (1/0.01 = 100, as approxQuantile(0.01)).
    quantile_accuracy: int = 100
    # Rows of one device that a task may hold; a longer device is read in chunks of its time order.
    group_rows: int = 1_000_000

    def __post_init__(self):
        if self.step_minutes <= 0 or (24 * 60) % self.step_minutes:
            raise ValueError("step_minutes must divide one day")
        if (self.start - self.start.replace(hour=0, minute=0, second=0, microsecond=0)) % timedelta(minutes=self.step_minutes):
            raise ValueError("calendar_start must lie on a slot of step_minutes")
        if self.calendar_days < 0:
            raise ValueError("calendar_days must be >= 0")

    # ---- derived values -----------------------------------------------------------
    @property
    def start(self) -> datetime:
        return datetime.fromisoformat(self.calendar_start)

    @property
    def end(self) -> datetime:
        return self.start + timedelta(days=self.calendar_days)

    @property
    def slots_per_day(self) -> int:
        return (24 * 60) // self.step_minutes

    @property
    def slots(self) -> int:
        """Rows of one complete device (calendar end is inclusive)."""
        return self.calendar_days * self.slots_per_day + 1

    @property
    def rejection_threshold(self) -> int:
        """A device with fewer rows than this is rejected."""
        if self.min_rows is not None:
            return self.min_rows
        return self.slots - self.missing_threshold

    def delta(self, counter: str) -> str:
        return self.delta_prefix + counter

    @property
    def deltas(self) -> tuple[str, ...]:
        return tuple(self.delta(c) for c in self.counters)

    @property
    def order(self) -> tuple[str, ...]:
        return (self.time,) if self.tie is None else (self.time, self.tie)

    def with_(self, **changes) -> "TelemetryConfig":
        return replace(self, **changes)
