"""Calendar completion and gap filling.

Plan shape, per device and without any join:

1. One exchange by (device, slot): times are floored to the step and the
   earliest reading of each slot is kept by its rank. The rank limit is applied
   before the shuffle as well, so a hot group of copies leaves its tasks as one
   row each, and no row is compared as a whole. Readings outside the calendar
   share one slot, so that of years of history only a row per device and task
   is shuffled -- enough to know the device. After it a device holds at most
   one row per slot, which bounds every later per-device window by the calendar
   length. From raw readings (``raw=True``) the generic checks run in the same
   exchange, on the same sorted rows.
2. ``complete_calendar`` hash-partitions by device once. A calendar between two
   readings is one empty stretch (:func:`calendar_stretches`): a row with the
   first and the last of its slots, so a device has about two rows per reading,
   however long the calendar. ``expand`` makes one row per slot of them, without
   a join and without a calendar-sized shuffle. A device whose readings all fall
   outside the calendar still gets the full (empty) calendar.
3. The fills of the whole series (:func:`series_stretches`) work on stretches
   too, so their cost follows the readings, not the slots. The single operators
   also take completed rows: because the calendar is complete and regular, "the
   row 14 days earlier" or "the same slot next week" is a fixed row offset there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridtide.config import TelemetryConfig
from gridtide.functions.time import days, floor_to_step, minutes, ntz
from gridtide.functions.windows import bfill, later, newest_first, order_columns, previous, running, whole
from gridtide.operators import chunks, quality

DEFAULT = TelemetryConfig()

GAP_HEAD_DAYS = 14  # days 1-14 of a gap month copy the value 14 days earlier
GAP_TAIL_SHIFT_DAYS = 21  # days 15-end copy the value 21 days later
WEEK_DAYS = 7


# ---- column roles ------------------------------------------------------------------------
def value_columns(df: DataFrame, cfg: TelemetryConfig) -> list[str]:
    """Everything except key, time and device attributes (provenance included)."""
    skip = {cfg.key, cfg.time, *cfg.attributes}
    return [c for c in df.columns if c not in skip]


def fillable_columns(df: DataFrame, cfg: TelemetryConfig) -> list[str]:
    """Columns of the final backward fill: values without the provenance column."""
    return [c for c in value_columns(df, cfg) if c != cfg.provenance]


def _year_month(t: Column) -> Column:
    return F.make_date(F.year(t), F.month(t), F.lit(1))


def _all_null(cols) -> Column:
    if not cols:
        return F.lit(True)
    return F.coalesce(*[F.col(c) for c in cols]).isNull() if len(cols) > 1 else F.col(cols[0]).isNull()


def _w(cfg: TelemetryConfig):
    """Device window, newest first; the one order of the whole chain."""
    return newest_first([cfg.key], [cfg.time])


# ---- F1 / A4 -------------------------------------------------------------------------------
def _first_per_slot(df: DataFrame, cfg: TelemetryConfig, slot: Column) -> DataFrame:
    """One row per (device, ``slot``), the earliest, with the slot as its time."""
    taken = df.withColumn("__slot", slot)
    order = [F.col(c).asc_nulls_first() for c in order_columns(df, cfg)]
    rank = F.row_number().over(Window.partitionBy(cfg.key, "__slot").orderBy(*order))
    kept = taken.withColumn("__rank", rank).where(F.col("__rank") == 1)
    return kept.select(*[F.col("__slot").alias(c) if c == cfg.time else F.col(c) for c in df.columns])


def keep_first_per_slot(df: DataFrame, cfg: TelemetryConfig = DEFAULT) -> DataFrame:
    """F1 + A4: floor the time to the step, keep the first reading per (device, slot).

    "First" is the earliest original time, then the tie column. Rows with a
    NULL time form their own group and keep a NULL time.
    """
    return _first_per_slot(df, cfg, floor_to_step(cfg.time, cfg.step_minutes))


def _bounds(cfg: TelemetryConfig) -> tuple[Column, Column]:
    return ntz(cfg.start.isoformat(sep=" ")), ntz(cfg.end.isoformat(sep=" "))


def _calendar_slot(cfg: TelemetryConfig) -> Column:
    """The reading's slot; NULL outside the calendar and for a NULL time."""
    slot = floor_to_step(cfg.time, cfg.step_minutes)
    return F.when(slot.between(*_bounds(cfg)), slot)


def valid_slots(raw: DataFrame, cfg: TelemetryConfig = DEFAULT, partitions: int | None = None) -> DataFrame:
    """V17 and F1 in one exchange of the rows: the first valid reading of each slot of the calendar,
    and a row without a time for each device whose valid readings are not all there.

    Valid readings are those of :func:`gridtide.operators.quality.generic_validation`: the
    device has rows enough, and no other reading has its device and time. Equal
    times share a slot, so the copies and the slot are read off one sorted run.
    The rows come hash-partitioned by device into ``partitions``, the layout of
    the calendar; the devices with too few rows leave there, without a further
    exchange of the readings.
    """
    k, t = cfg.key, cfg.time
    n = partitions or int(raw.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = raw.groupBy(k).agg(F.count(F.lit(1)).alias("__rows"))
    thin = counts.where(F.col("__rows") < F.lit(cfg.rejection_threshold)).select(k)
    df = quality.without_proven_copies(raw, cfg).withColumn("__slot", _calendar_slot(cfg))
    slot = Window.partitionBy(k, "__slot")
    single = F.count(F.lit(1)).over(Window.partitionBy(k, "__slot", t)) == 1
    inside = df.where(F.col("__slot").isNotNull()).repartition(n, k, "__slot")
    inside = inside.withColumn("__single", single | F.col(k).isNull())
    order = [F.desc("__single"), *[F.col(c).asc_nulls_first() for c in order_columns(raw, cfg)]]
    inside = inside.withColumn("__rank", F.row_number().over(slot.orderBy(*order))).where(F.col("__single") & (F.col("__rank") == 1))
    inside = inside.select(*[F.col("__slot").alias(c) if c == t else F.col(c) for c in raw.columns])
    # outside the calendar only the device counts: two narrow aggregates
    outside = df.where(F.col("__slot").isNull()).groupBy(k, t).agg(F.count(F.lit(1)).alias("__n"))
    others = outside.where((F.col("__n") == 1) | F.col(k).isNull() | F.col(t).isNull()).select(k).distinct()
    both = inside.unionByName(others, allowMissingColumns=True).select(*raw.columns).repartition(n, k)
    # an outer join stays above the repartition, whose layout it shares
    marked = both.join(thin.withColumn("__thin", F.lit(True)), k, "left")
    return marked.where(F.col("__thin").isNull()).select(*raw.columns)


# ---- F2 / J3 -------------------------------------------------------------------------------
#: Last slot of a stretch, a row that stands for all slots from its time to this one.
LAST = "__last"


def complete_calendar(
    df: DataFrame, cfg: TelemetryConfig = DEFAULT, deduplicate: bool = True, partitions: int | None = None
) -> DataFrame:
    """exactly one row per (device, calendar slot); missing slots are NULL rows.

    Readings outside ``[start, end]`` (and NULL times) are dropped, but their
    device still receives its calendar.

    The rows are hash-partitioned by device into ``partitions`` (default
    ``spark.sql.shuffle.partitions``) with an explicit repartition: the
    expansion multiplies the rows *after* this exchange, so AQE's size-based
    coalescing, which only sees the sparse readings, must not shrink it. Every
    later per-device window reuses this partitioning.
    """
    return expand(calendar_stretches(df, cfg, deduplicate, partitions), cfg)


def calendar_stretches(
    df: DataFrame, cfg: TelemetryConfig = DEFAULT, deduplicate: bool = True, partitions: int | None = None
) -> DataFrame:
    """:func:`complete_calendar` before its expansion: a row per reading, and one per run of empty slots
    from its time to :data:`LAST`."""
    readings = _readings(df, cfg, deduplicate, partitions)
    start, end = _bounds(cfg)
    values = [c for c in readings.columns if c not in (cfg.key, cfg.time)]
    pieces = _pieces(cfg, [])
    here = F.col("__piece.kind") == _READING
    out = readings.withColumns(_neighbours(cfg)).select(cfg.key, *values, F.explode(pieces).alias("__piece"))
    return out.select(
        cfg.key,
        F.col("__piece.lo").alias(cfg.time),
        *[F.when(here, F.col(c)).alias(c) for c in values],
        F.col("__piece.hi").alias(LAST),
    )


def expand(stretches: DataFrame, cfg: TelemetryConfig = DEFAULT) -> DataFrame:
    """One row per slot of each stretch, with its values."""
    slots = F.sequence(F.col(cfg.time), F.col(LAST), minutes(cfg.step_minutes))
    columns = [c for c in stretches.columns if c != LAST]
    staged = stretches.withColumn("__slots", slots)
    return staged.select(*[c for c in columns if c != cfg.time], F.explode("__slots").alias(cfg.time)).select(*columns)


def _readings(df, cfg, deduplicate=True, partitions=None, raw=False) -> DataFrame:
    """The readings of the calendar's slots, one each, and a row without a time for devices that have others."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if raw:
        return valid_slots(df, cfg, n)
    if deduplicate:
        # readings outside the calendar share a slot: one row per device is left of them
        return _first_per_slot(df, cfg, _calendar_slot(cfg)).repartition(n, cfg.key)
    within = df.where(F.coalesce(F.col(cfg.time).between(*_bounds(cfg)), F.lit(False)))
    return within.unionByName(df.select(cfg.key).distinct(), allowMissingColumns=True).repartition(n, cfg.key)


_READING, _BEFORE, _BEHIND = range(3)


def _neighbours(cfg: TelemetryConfig) -> dict[str, Column]:
    """The times of the next older and newer reading, and which row speaks for a device without readings."""
    t, w = F.col(cfg.time), _w(cfg)
    return {
        "__older": previous(t, w),
        "__newer": later(t, w),
        "__only": F.max(t.isNotNull()).over(Window.partitionBy(cfg.key)) == F.lit(False),
        "__nth": F.row_number().over(w),
    }


def _pieces(cfg: TelemetryConfig, more: list[Column]) -> Column:
    """array<struct<lo, hi, kind>>: the reading's slot, the empty slots before it, and behind the newest reading;
    ``more`` are further pieces. Those without a slot are left out."""
    (start, end), step, t = _bounds(cfg), minutes(cfg.step_minutes), F.col(cfg.time)
    first = F.col("__nth") == 1  # the newest row: its reading, or the device has none
    older = F.coalesce(F.col("__older") + step, start)
    found = F.array(
        F.when(t.isNotNull(), _piece(t, t, _READING)),
        F.when(t.isNotNull() & (older < t), _piece(older, t - step, _BEFORE)),
        F.when(first & t.isNotNull() & (t < end), _piece(t + step, end, _BEHIND)),
        F.when(first & F.col("__only"), _piece(start, end, _BEHIND)),
        *more,
    )
    return F.array_compact(found)


def _piece(lo: Column, hi: Column, kind: int) -> Column:
    return F.struct(lo.alias("lo"), hi.alias("hi"), F.lit(kind).alias("kind"))


def _with_device_flags(df: DataFrame, cfg: TelemetryConfig) -> DataFrame:
    """Per-device facts of the completed calendar, read off the sparse readings:

    - ``__first_null``: the first record (the start slot) is all NULL unless a
      reading with a value sits exactly on it;
    - ``__gap``: a calendar month is all NULL (also after the seasonal fill, which
      never crosses months) unless a reading with a value falls in it, so the
      first gap month is the first month without one.
    """
    start, end = _bounds(cfg)
    t = F.col(cfg.time)
    device = Window.partitionBy(cfg.key)
    valued = t.isNotNull() & ~_all_null(value_columns(df, cfg))
    months = F.sequence(_year_month(start), _year_month(end), F.expr("INTERVAL 1 MONTH"))
    held = F.collect_set(F.when(valued, _year_month(t))).over(device)
    return df.withColumns(
        {
            "__first_null": ~F.max(valued & t.eqNullSafe(start)).over(device),
            "__gap": F.array_min(F.array_except(months, held)),
        }
    )


# ---- F3 --------------------------------------------------------------------------------------
def fill_attributes(df: DataFrame, cfg: TelemetryConfig = DEFAULT) -> DataFrame:
    """backward-fill the device attributes (trailing NULLs stay NULL)."""
    attrs = [a for a in cfg.attributes if a in df.columns]
    if not attrs:
        return df
    w = _w(cfg)
    return df.withColumns({a: bfill(a, w) for a in attrs})


# ---- A7 --------------------------------------------------------------------------------------
def first_record_null(df: DataFrame, cfg: TelemetryConfig = DEFAULT) -> DataFrame:
    """A7 per device: ``(key, first_record_null)`` -- TRUE when every value column is
    NULL on the device's earliest row."""
    cols = value_columns(df, cfg)
    return df.groupBy(cfg.key).agg(F.min_by(_all_null(cols), F.col(cfg.time)).alias("first_record_null"))


def _first_record_null_flag(df: DataFrame, cfg: TelemetryConfig) -> Column:
    """Per row: is the device's earliest row all NULL (the last row, newest first)."""
    return F.last(_all_null(value_columns(df, cfg))).over(whole(_w(cfg)))


# ---- F4 --------------------------------------------------------------------------------------
def seasonal_bfill(df: DataFrame, cfg: TelemetryConfig = DEFAULT, only_if_first_null: bool = True) -> DataFrame:
    """backward fill within (device, weekday, hour, minute, year-month).

    On a complete calendar the later rows of that group are exactly the same
    slot 7, 14, 21 and 28 days later, while still in the same month, so the
    fill is a ``coalesce`` of four fixed-offset reads in the device window (no
    separate partitioning). Applied to the whole device series when its
    first record is all NULL (the reference's trigger);
    ``only_if_first_null=False`` applies it always.
    """
    cols = value_columns(df, cfg)
    if not cols:
        return df
    t = F.col(cfg.time)
    w = _w(cfg)
    days_left = F.dayofmonth(F.last_day(F.to_date(t))) - F.dayofmonth(t)
    weeks = range(1, 5)
    # One struct per offset: four offset frames in total instead of four per column.
    packed = F.struct(*[F.col(c) for c in cols])
    staged = df.withColumns(
        {
            f"__week{k}": F.when(days_left >= WEEK_DAYS * k, later(packed, w, WEEK_DAYS * k * cfg.slots_per_day))
            for k in weeks
        }
    )

    def filled(c: str) -> Column:
        return F.coalesce(F.col(c), *[F.col(f"__week{k}").getField(c) for k in weeks])

    helpers = [f"__week{k}" for k in weeks]
    if only_if_first_null:
        staged = staged.withColumn("__first_null", _first_record_null_flag(df, cfg))
        out = staged.withColumns({c: F.when(F.col("__first_null"), filled(c)).otherwise(F.col(c)) for c in cols})
        return out.drop("__first_null", *helpers)
    return staged.withColumns({c: filled(c) for c in cols}).drop(*helpers)


# ---- A5 / F5 -----------------------------------------------------------------------------
def first_gap_month(df: DataFrame, cfg: TelemetryConfig = DEFAULT) -> DataFrame:
    """A5 per device: ``(key, gap_month)`` -- the first month whose rows have every
    value column NULL, as the first day of that month; NULL when there is none."""
    cols = value_columns(df, cfg)
    months = df.groupBy(cfg.key, _year_month(F.col(cfg.time)).alias("__ym")).agg(
        F.max(~_all_null(cols)).alias("__any")
    )
    return months.groupBy(cfg.key).agg(F.min(F.when(~F.col("__any"), F.col("__ym"))).alias("gap_month"))


def _with_gap_month(df: DataFrame, cfg: TelemetryConfig) -> DataFrame:
    """Adds ``__ym`` and ``__gap`` (the device's first all-NULL month) with
    windows in the device order: a month is all NULL when, from its earliest
    row, the next row holding any value lies in a later month."""
    t = F.col(cfg.time)
    w = _w(cfg)
    ym = _year_month(t)
    has_value = ~_all_null(value_columns(df, cfg))
    staged = df.withColumn("__ym", ym).withColumns(
        {
            "__next_value_at": F.last(F.when(has_value, t), ignorenulls=True).over(running(w)),
            "__month_start_row": F.coalesce(previous("__ym", w) != F.col("__ym"), F.lit(True)),
        }
    )
    empty = staged["__month_start_row"] & (
        staged["__next_value_at"].isNull() | (_year_month(staged["__next_value_at"]) > staged["__ym"])
    )
    return staged.withColumn("__gap", F.min(F.when(empty, F.col("__ym"))).over(Window.partitionBy(cfg.key))).drop(
        "__next_value_at", "__month_start_row"
    )


# ---- F6 / J4 -----------------------------------------------------------------------------
def fill_gap_month(df: DataFrame, cfg: TelemetryConfig = DEFAULT) -> DataFrame:
    """fill the device's first all-NULL month from neighbouring weeks.

    Days 1-14 take the row 14 days earlier, days 15-end the row 21 days later
    (both keep the weekday). Every column except key and time is copied. A
    source outside the calendar gives NULL (the final fill handles it). Only
    the first gap month of a device is filled. Expects a complete calendar.
    """
    staged = _with_gap_month(df, cfg)
    w = _w(cfg)
    back, ahead = GAP_HEAD_DAYS * cfg.slots_per_day, GAP_TAIL_SHIFT_DAYS * cfg.slots_per_day
    in_gap = F.col("__ym") == F.col("__gap")
    head = F.dayofmonth(cfg.time) <= GAP_HEAD_DAYS
    copied = [c for c in df.columns if c not in (cfg.key, cfg.time)]
    packed = F.struct(*[F.col(c) for c in copied])
    staged = staged.withColumns({"__back": previous(packed, w, back), "__ahead": later(packed, w, ahead)})
    out = staged.withColumns(
        {
            c: F.when(in_gap & head, F.col("__back").getField(c))
            .when(in_gap, F.col("__ahead").getField(c))
            .otherwise(F.col(c))
            for c in copied
        }
    )
    return out.drop("__ym", "__gap", "__back", "__ahead")


# ---- F7 / F9 -----------------------------------------------------------------------------
def final_bfill(df: DataFrame, cfg: TelemetryConfig = DEFAULT) -> DataFrame:
    """backward-fill every value column except provenance, per device."""
    w = _w(cfg)
    return df.withColumns({c: bfill(c, w) for c in fillable_columns(df, cfg)})


def bfill_all(df: DataFrame, cfg: TelemetryConfig = DEFAULT, bounded: bool = False) -> DataFrame:
    """backward-fill every column but key and time within each device; one too long for
    a task is filled on two levels (:mod:`gridtide.operators.chunks`)."""
    columns = [c for c in df.columns if c not in (cfg.key, cfg.time)]
    return chunks.backward_fill(df, [cfg.key], order_columns(df, cfg), columns, chunks.device_bounds(df, cfg, bounded))


# ---- F8 --------------------------------------------------------------------------------------
def complete_series_stepwise(df: DataFrame, cfg: TelemetryConfig = DEFAULT) -> DataFrame:
    """F8 as the sequence of the individual operators (one window pass each)."""
    out = complete_calendar(df, cfg)
    out = fill_attributes(out, cfg)
    out = seasonal_bfill(out, cfg)
    out = fill_gap_month(out, cfg)
    return final_bfill(out, cfg)


def complete_series(df: DataFrame, cfg: TelemetryConfig = DEFAULT, raw: bool = False) -> DataFrame:
    """F8: F1 -> F2 -> F3 -> A7/F4 -> F5/F6 -> F7 as one lazy plan over all devices.

    ``raw`` readings pass the generic checks (V17) on the way, in the exchange
    that also finds the slots (:func:`valid_slots`).

    Same result as :func:`complete_series_stepwise`, but the fills run on
    stretches (:func:`series_stretches`); only their result has a row per slot.
    """
    return expand(series_stretches(df, cfg, raw), cfg)


def series_stretches(df: DataFrame, cfg: TelemetryConfig = DEFAULT, raw: bool = False) -> DataFrame:
    """:func:`complete_series` before its expansion: stretches of slots (time to :data:`LAST`) with equal values.

    The first-record test (A7) and the first gap month (F5) are read off the
    readings. F4 copies a reading to the same slot of the weeks before it in its
    month; F3 and F7 give a run of empty slots what the next reading has; F6
    moves the stretches of the neighbouring weeks, cut to the days they fill.
    """
    readings = _with_device_flags(_readings(df, cfg, raw=raw), cfg)
    (start, end), step = _bounds(cfg), minutes(cfg.step_minutes)
    k, t = cfg.key, F.col(cfg.time)
    columns = [c for c in df.columns if c not in (k, cfg.time)]
    attrs = [a for a in cfg.attributes if a in columns]
    values = [c for c in value_columns(df, cfg) if c in columns]
    flags = ["__first_null", "__gap"]

    # a reading counts k weeks earlier too, where no reading of fewer weeks has a value
    weeks = F.sequence(F.lit(0), F.floor((F.dayofmonth(t) - 1) / WEEK_DAYS).cast("int"))
    copies = F.when(F.col("__first_null") & t.isNotNull() & (~_all_null(values)), weeks).otherwise(F.array(F.lit(0)))
    spread = readings.withColumn("__week", F.explode(copies)).withColumn(
        "__at", t - F.make_dt_interval(F.col("__week") * F.lit(WEEK_DAYS))
    )
    spread = spread.where(F.col("__at").isNull() | (F.col("__at") >= start))
    points = spread.groupBy(k, *flags, F.col("__at").alias(cfg.time)).agg(
        *[F.min_by(c, F.when(F.col("__week") == 0, F.lit(0))).alias(c) for c in attrs],
        *[F.min_by(c, F.when(F.col(c).isNotNull(), F.col("__week"))).alias(c) for c in values],
    )
    # F3, and the stretches; where a month will be filled also those of NULLs beside the calendar
    w = _w(cfg)
    gap = F.col("__gap")
    beside = F.col("__nth").eqNullSafe(1) & gap.isNotNull()
    before = F.when(beside, _piece(start - days(GAP_HEAD_DAYS), start - step, _BEHIND))
    behind = F.when(beside, _piece(end + step, end + days(GAP_TAIL_SHIFT_DAYS + 31), _BEHIND))
    cut = points.withColumns({**{a: bfill(a, w) for a in attrs}, **_neighbours(cfg)})
    cut = cut.withColumn("__piece", F.explode(_pieces(cfg, [before, behind])))
    kind, lo, hi = (F.col(f"__piece.{x}") for x in ("kind", "lo", "hi"))
    filled = {a: F.when(kind != _BEHIND, F.col(a)) for a in attrs} | {c: F.when(kind == _READING, F.col(c)) for c in values}

    # the gap month's own stretches give way to those of the neighbouring weeks
    from_, to = gap.cast("timestamp_ntz"), F.add_months(gap, 1).cast("timestamp_ntz")
    middle, back, ahead = from_ + days(GAP_HEAD_DAYS), days(GAP_HEAD_DAYS), days(GAP_TAIL_SHIFT_DAYS)
    parts = F.when(gap.isNull(), F.array(_span(lo, hi))).otherwise(
        F.array(
            _span(F.greatest(lo, start), F.least(hi, end, from_ - step)),
            _span(F.greatest(lo, start, to), F.least(hi, end)),
            _span(F.greatest(lo + back, start, from_), F.least(hi + back, end, middle - step)),
            _span(F.greatest(lo - ahead, start, middle), F.least(hi - ahead, end, to - step)),
        )
    )
    parts = F.filter(parts, lambda p: p["lo"] <= p["hi"])
    moved = cut.select(k, *[filled[c].alias(c) for c in columns], F.explode(parts).alias("__part"))
    out = moved.select(k, F.col("__part.lo").alias(cfg.time), *columns, F.col("__part.hi").alias(LAST))
    # F7
    return out.withColumns({c: bfill(c, w) for c in values if c != cfg.provenance})


def slot_count(cfg: TelemetryConfig) -> Column:
    """How many slots a stretch has."""
    return (F.timestamp_diff("MINUTE", F.col(cfg.time), F.col(LAST)) / cfg.step_minutes + 1).cast("long")


def _span(lo: Column, hi: Column) -> Column:
    return F.struct(lo.alias("lo"), hi.alias("hi"))


def leading_rows(stretches: DataFrame, cfg: TelemetryConfig, rows: int) -> DataFrame:
    """The stretches with their first ``rows`` slots as rows of their own and the rest cut at the months' starts.

    A window that reads fewer than ``rows`` rows back then finds the same values
    before each row as on the expanded series: the rows behind the first ones of
    a stretch have equal rows before them, so that one row speaks for all of them.
    """
    step, lo, hi = minutes(cfg.step_minutes), F.col(cfg.time), F.col(LAST)
    rest = lo + minutes(cfg.step_minutes * rows)
    single = F.transform(F.sequence(lo, F.least(hi, rest - step), step), lambda x: _span(x, x))
    month = lambda x: _year_month(x).cast("timestamp_ntz")
    months = F.sequence(month(rest), month(hi), F.expr("INTERVAL 1 MONTH"))
    cut = F.transform(
        months, lambda m: _span(F.greatest(m, rest), F.least(F.add_months(m, 1).cast("timestamp_ntz") - step, hi))
    )
    parts = F.when(rest <= hi, F.concat(single, cut)).otherwise(single)
    columns = [c for c in stretches.columns if c not in (cfg.time, LAST)]
    out = stretches.select(*columns, F.explode(parts).alias("__part"))
    return out.select(*columns, F.col("__part.lo").alias(cfg.time), F.col("__part.hi").alias(LAST)).select(*stretches.columns)
