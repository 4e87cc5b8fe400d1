"""The row rule book (V1-V13) as native column predicates, and the verdict (V0).

A rule is ``(message, predicate)``. The verdict collects the messages of the
rules that fire, in rule-book order, into an array; a rule whose predicate is
NULL (a missing operand) does not fire. No Python worker is involved, unless a
user's own rule needs one: a :class:`BatchRule` sees whole Arrow batches.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridtide import fixed
from gridtide.config import TelemetryConfig


@dataclass(frozen=True)
class Rule:
    message: str
    predicate: Callable[[TelemetryConfig], Column]


def _d(cfg: TelemetryConfig, counter: str) -> Column:
    return F.col(cfg.delta(counter))


def _consumption(cfg: TelemetryConfig) -> Column:
    # The rule book tests the cumulative counter here; the option switches to the delta.
    name = "total_consume_energy_from_grid_kwh"
    return _d(cfg, name) if cfg.instantaneous_consumption_rules else F.col(name)


def default_rules() -> list[Rule]:
    cap = lambda cfg: F.col(cfg.capacity)
    house = lambda: F.col(fixed.HOUSE_POWER)
    y = lambda c: _d(c, "on_grid_total_yield_kwh")
    feed = lambda c: _d(c, "total_feed_in_energy_kwh")
    cons = lambda c: _d(c, "total_consume_energy_from_grid_kwh")
    pv = lambda c: _d(c, "pv_total_power_generation_kwh")
    chg = lambda c: _d(c, "total_battery_charge_kwh")
    dis = lambda c: _d(c, "total_battery_discharge_kwh")
    return [
        Rule(fixed.MSG_YIELD_NEGATIVE, lambda c: y(c) < 0),
        Rule(fixed.MSG_FEED_IN_NEGATIVE, lambda c: feed(c) < 0),
        Rule(fixed.MSG_FEED_IN_LOW_BATTERY, lambda c: (cap(c) < fixed.LOW_BATTERY_PERCENT) & (feed(c) > 0)),
        Rule(fixed.MSG_FEED_IN_AND_CONSUME, lambda c: (feed(c) > 0) & (_consumption(c) > 0)),
        Rule(fixed.MSG_CONSUME_NEGATIVE, lambda c: _consumption(c) < 0),
        Rule(fixed.MSG_CAPACITY_RANGE, lambda c: (cap(c) < fixed.CAPACITY_MIN) | (cap(c) > fixed.CAPACITY_MAX)),
        Rule(fixed.MSG_CHARGE_AND_DISCHARGE, lambda c: (chg(c) > 0) & (dis(c) > 0)),
        Rule(fixed.MSG_CHARGE_NEGATIVE, lambda c: chg(c) < 0),
        Rule(fixed.MSG_DISCHARGE_NEGATIVE, lambda c: dis(c) < 0),
        Rule(fixed.MSG_DISCHARGE_NO_USE, lambda c: (house() == 0) & (feed(c) == 0) & (dis(c) > 0)),
        Rule(fixed.MSG_PV_NEGATIVE, lambda c: pv(c) < 0),
        Rule(fixed.MSG_PV_AT_NIGHT, lambda c: (F.col(fixed.TIME_OF_DAY) == fixed.NIGHT) & (pv(c) != 0)),
        Rule(fixed.MSG_GRID_NO_USE, lambda c: (cons(c) > 0) & (house() == 0)),
    ]


@dataclass(frozen=True)
class BatchRule:
    """A rule that column expressions can't say: ``test`` gets the named columns of a batch of rows as
    Arrow arrays and returns a boolean for each row (null: the rule doesn't fire)."""

    message: str
    columns: tuple[str, ...]
    test: Callable[..., object]


def batch_flags(rules: Sequence[Rule | BatchRule]) -> Column | None:
    """array<boolean> of all batch rules, in order: one pass over the rows in Python, however many rules."""
    batch = [r for r in rules if isinstance(r, BatchRule)]
    if not batch:
        return None
    names = list(dict.fromkeys(c for r in batch for c in r.columns))
    tests = [(r.test, [names.index(c) for c in r.columns]) for r in batch]

    def flags(*columns):
        import numpy as np
        import pyarrow as pa

        found = []
        for test, places in tests:
            fires = test(*[columns[i] for i in places])
            fires = fires.combine_chunks() if isinstance(fires, pa.ChunkedArray) else pa.array(fires, pa.bool_())
            found.append(np.asarray(fires.fill_null(False)).astype(bool))
        values = pa.array(np.stack(found, axis=1).ravel())
        return pa.ListArray.from_arrays(pa.array(np.arange(len(columns[0]) + 1) * len(tests), pa.int32()), values)

    flags.__annotations__ = {}
    return F.arrow_udf(flags, "array<boolean>", F.ArrowUDFType.SCALAR)(*[F.col(n) for n in names])


def error_list(rules: Sequence[Rule | BatchRule], cfg: TelemetryConfig, flags: Column | None = None) -> Column:
    """array<string> of the messages of the rules that fire, in order; ``flags`` holds those of the batch rules."""
    fires, at = [], 0
    for r in rules:
        if isinstance(r, BatchRule):
            fires.append(F.when(flags[at], F.lit(r.message)))
            at += 1
        else:
            fires.append(F.when(r.predicate(cfg), F.lit(r.message)))
    return F.array_compact(F.array(*fires))


def verdict(rules: Sequence[Rule | BatchRule], cfg: TelemetryConfig, flags: Column | None = None) -> Column:
    """struct<is_valid boolean, error_message string>."""
    errs = error_list(rules, cfg, flags)
    ok = F.size(errs) == 0
    msg = F.when(ok, F.lit(fixed.VALID)).otherwise(F.concat_ws(fixed.ERROR_SEPARATOR, errs))
    return F.struct(ok.alias(fixed.IS_VALID), msg.alias(fixed.ERROR_MESSAGE))


def custom_rules(pairs: Sequence[tuple[str, Column | Callable[[TelemetryConfig], Column]]]) -> list[Rule]:
    """User rules from ``(message, Column)`` or ``(message, cfg -> Column)`` pairs."""
    out = []
    for message, pred in pairs:
        out.append(Rule(message, pred if callable(pred) and not isinstance(pred, Column) else (lambda _c, p=pred: p)))
    return out


def has_error(message: str) -> Column:
    """TRUE when the row's error text contains ``message`` (NULL text -> FALSE)."""
    return F.coalesce(F.col(fixed.ERROR_MESSAGE).contains(message), F.lit(False))
