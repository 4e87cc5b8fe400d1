"""Repair of rows that failed the rule book.

Each step replaces a counter by its previous value within the device (one
step back, reading the column as the previous step left it) and zeroes the
matching delta. Steps are applied in a fixed order; every read of the previous
row uses the same device order, so the chain is one exchange and one sort. A
device that is too long for one task is read in chunks, each with a halo of the
rows before it (:mod:`gridtide.operators.chunks`); ``bounded`` says that the
series are calendar-completed, so that no device can be.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtide import fixed
from gridtide.config import TelemetryConfig
from gridtide.functions.rules import has_error
from gridtide.operators.chunks import previous_of_device

DEFAULT = TelemetryConfig()

PV = "pv_total_power_generation_kwh"
FEED_IN = "total_feed_in_energy_kwh"
CONSUME = "total_consume_energy_from_grid_kwh"
CHARGE = "total_battery_charge_kwh"
DISCHARGE = "total_battery_discharge_kwh"


def _zero_if(cond, col: str):
    return F.when(cond, F.lit(0)).otherwise(F.col(col))


def _carry(df: DataFrame, cfg: TelemetryConfig, conds: dict, bounded: bool) -> DataFrame:
    """Each column of ``conds`` takes the previous row's value where its condition holds (one step back only).

    The previous value is read as the column is before this step, so two
    flagged rows in a row give the second one the first one's (unrepaired)
    value, and a flagged first row becomes NULL.
    """
    staged = previous_of_device(df, cfg, {"__prev": (1, list(conds))}, bounded)
    prev = F.col("__prev")
    return staged.withColumns({c: F.when(cond, prev.getField(c)).otherwise(F.col(c)) for c, cond in conds.items()}).drop("__prev")


def _repair(df: DataFrame, cfg: TelemetryConfig, cond, counter: str, bounded: bool, zero_delta: bool = True) -> DataFrame:
    out = _carry(df, cfg, {counter: cond}, bounded)
    return out.withColumn(cfg.delta(counter), _zero_if(cond, cfg.delta(counter))) if zero_delta else out


def fix_negative_deltas(df: DataFrame, cfg: TelemetryConfig = DEFAULT, bounded: bool = False) -> DataFrame:
    """A counter whose delta is negative takes the previous value; negative deltas become 0."""
    out = _carry(df, cfg, {c: F.col(cfg.delta(c)) < 0 for c in cfg.counters}, bounded)
    return out.withColumns({d: _zero_if(F.col(d) < 0, d) for d in cfg.deltas})


def fix_pv_at_night(df: DataFrame, cfg: TelemetryConfig = DEFAULT, bounded: bool = False) -> DataFrame:
    """PV generation flagged at night."""
    return _repair(df, cfg, has_error(fixed.MSG_PV_AT_NIGHT), PV, bounded)


def fix_feed_in_with_consumption(df: DataFrame, cfg: TelemetryConfig = DEFAULT, bounded: bool = False) -> DataFrame:
    """Feed-in flagged together with grid consumption."""
    return _repair(df, cfg, has_error(fixed.MSG_FEED_IN_AND_CONSUME), FEED_IN, bounded)


def fix_capacity(df: DataFrame, cfg: TelemetryConfig = DEFAULT, bounded: bool = False) -> DataFrame:
    """C4: battery capacity out of range (the gauge has no delta)."""
    return _repair(df, cfg, has_error(fixed.MSG_CAPACITY_RANGE), cfg.capacity, bounded, zero_delta=False)


def fix_charge_and_discharge(df: DataFrame, cfg: TelemetryConfig = DEFAULT, bounded: bool = False) -> DataFrame:
    """Charge and discharge together -- at night the charge is repaired, by
    day the discharge; ``Unknown`` time of day repairs neither."""
    flagged = has_error(fixed.MSG_CHARGE_AND_DISCHARGE)
    night = flagged & (F.col(fixed.TIME_OF_DAY) == fixed.NIGHT)
    day = flagged & (F.col(fixed.TIME_OF_DAY) == fixed.DAY)
    out = _carry(df, cfg, {CHARGE: night, DISCHARGE: day}, bounded)
    return out.withColumns(
        {cfg.delta(CHARGE): _zero_if(night, cfg.delta(CHARGE)), cfg.delta(DISCHARGE): _zero_if(day, cfg.delta(DISCHARGE))}
    )


def fix_discharge_without_use(df: DataFrame, cfg: TelemetryConfig = DEFAULT, bounded: bool = False) -> DataFrame:
    """Discharge with neither consumption nor feed-in."""
    return _repair(df, cfg, has_error(fixed.MSG_DISCHARGE_NO_USE), DISCHARGE, bounded)


def fix_grid_use_without_load(df: DataFrame, cfg: TelemetryConfig = DEFAULT, bounded: bool = False) -> DataFrame:
    """Grid consumption with no house load."""
    return _repair(df, cfg, has_error(fixed.MSG_GRID_NO_USE), CONSUME, bounded)


RULE_REPAIRS = (
    fix_negative_deltas,
    fix_pv_at_night,
    fix_feed_in_with_consumption,
    fix_capacity,
    fix_charge_and_discharge,
    fix_discharge_without_use,
    fix_grid_use_without_load,
)


def repair_rule_failures_stepwise(df: DataFrame, cfg: TelemetryConfig = DEFAULT, bounded: bool = False) -> DataFrame:
    """C1 -> C7 applied one step (one window pass) after the other."""
    for step in RULE_REPAIRS:
        df = step(df, cfg, bounded)
    return df


def _repair_plan(cfg: TelemetryConfig) -> tuple[dict[str, list], dict[str, list]]:
    """Per counter, the ordered row conditions of the steps that carry its previous
    value; per delta, the conditions that zero it. Conditions read only the
    row's own original fields (deltas, error text, time of day)."""
    d = cfg.delta
    msg_night = has_error(fixed.MSG_CHARGE_AND_DISCHARGE) & (F.col(fixed.TIME_OF_DAY) == fixed.NIGHT)
    msg_day = has_error(fixed.MSG_CHARGE_AND_DISCHARGE) & (F.col(fixed.TIME_OF_DAY) == fixed.DAY)
    carry: dict[str, list] = {c: [F.col(d(c)) < 0] for c in cfg.counters}  # C1
    zero: dict[str, list] = {d(c): [F.col(d(c)) < 0] for c in cfg.counters}  # C1
    for col, cond in (
        (PV, has_error(fixed.MSG_PV_AT_NIGHT)),  # C2
        (FEED_IN, has_error(fixed.MSG_FEED_IN_AND_CONSUME)),  # C3
        (cfg.capacity, has_error(fixed.MSG_CAPACITY_RANGE)),  # C4
        (CHARGE, msg_night),  # C5
        (DISCHARGE, msg_day),  # C5
        (DISCHARGE, has_error(fixed.MSG_DISCHARGE_NO_USE)),  # C6
        (CONSUME, has_error(fixed.MSG_GRID_NO_USE)),  # C7
    ):
        carry.setdefault(col, []).append(cond)
        if col != cfg.capacity:
            zero[d(col)].append(cond)
    return carry, zero


def reach(cfg: TelemetryConfig = DEFAULT) -> int:
    """How many rows back a repair may read, with the repaired previous value that C8 takes."""
    return max(len(conds) for conds in _repair_plan(cfg)[0].values()) + 1


def repair_rule_failures(
    df: DataFrame, cfg: TelemetryConfig = DEFAULT, previous_of: tuple[str, ...] = (), bounded: bool = False
) -> DataFrame:
    """C1 -> C7 in one window pass.

    Every step replaces a value by the previous row's value *as the earlier
    steps left it*. Unrolled, the value of column X after its m steps at row
    i is the original X at row i - j, where j counts the steps whose
    condition holds while walking back; so one pass reading the original
    rows 1..m back (one struct per offset) gives exactly the stepwise result,
    instead of one window pass per step. ``previous_of`` columns also get
    ``__prev_<c>``, the repaired value of the previous row (used by C8).
    """
    carry, zero = _repair_plan(cfg)
    conds = [(col, k) for col, cs in carry.items() for k in range(len(cs))]
    flag = {(col, k): f"__c_{i}" for i, (col, k) in enumerate(conds)}
    staged = df.withColumns({flag[(col, k)]: F.coalesce(carry[col][k], F.lit(False)) for col, k in conds})
    # Which (field, offset) pairs the unrolled expressions read: each offset's
    # struct carries only those fields.
    needed: set[tuple[str, int]] = set()

    def walk(col: str, steps: int, j: int):
        if steps == 0:
            needed.add((col, j))
            return
        needed.add((flag[(col, steps - 1)], j))
        walk(col, steps - 1, j + 1)
        walk(col, steps - 1, j)

    for col, cs in carry.items():
        walk(col, len(cs), 0)
    for c in previous_of:
        walk(c, len(carry[c]), 1)
    depth = max(j for _, j in needed)
    back = {j: f"__back{j}" for j in range(1, depth + 1)}
    reads = {back[j]: (j, [f for f, jj in sorted(needed) if jj == j]) for j in back}
    staged = previous_of_device(staged, cfg, reads, bounded)

    def at(name: str, j: int):
        return F.col(name) if j == 0 else F.col(back[j]).getField(name)

    def value(col: str, steps: int, j: int):
        # value of col after its first `steps` steps, at row i - j
        if steps == 0:
            return at(col, j)
        cond = at(flag[(col, steps - 1)], j)
        return F.when(cond, value(col, steps - 1, j + 1)).otherwise(value(col, steps - 1, j))

    out = staged.withColumns({f"__prev_{c}": value(c, len(carry[c]), 1) for c in previous_of})
    out = out.withColumns({col: value(col, len(cs), 0) for col, cs in carry.items()})
    out = out.withColumns(
        {dc: F.when(_any(cs), F.lit(0)).otherwise(F.col(dc)) for dc, cs in zero.items() if dc in df.columns}
    )
    return out.drop(*flag.values(), *back.values())


def _any(conds):
    out = None
    for c in conds:
        c = F.coalesce(c, F.lit(False))
        out = c if out is None else (out | c)
    return out


def clean_all(
    df: DataFrame,
    cfg: TelemetryConfig = DEFAULT,
    scope: str = "device",
    materialize: bool = True,
    exact: bool = False,
    bounded: bool = False,
) -> DataFrame:
    """C1 -> C7, then outlier replacement (C8) on the configured columns.

    ``materialize`` writes the repaired rows once under ``spark.checkpoint.dir``
    so that the fences and the replacement read stored data instead of
    recomputing the lineage.
    """
    from gridtide.operators.outliers import replace_outliers

    # the repaired previous values are read in the same pass as the repairs
    ready = cfg.outlier_columns if scope == "device" else ()
    out = repair_rule_failures(df, cfg, previous_of=ready, bounded=bounded)
    return replace_outliers(
        out, cfg, cfg.outlier_columns, cfg.iqr_multiplier, scope=scope, exact=exact, materialize=materialize, previous_ready=bool(ready)
    )
