"""The end-to-end plan: readings -> accepted -> completed -> derived ->
validated -> repaired -> report.

Exchanges of the readings, in order: by (key, slot), where the generic checks
and the slots are read off the same sorted rows, and by the device key.
Calendar completion, derivation, validation and cleansing all run on that last
partitioning, on stretches of slots with equal values instead of on each slot:
behind the first rows of a stretch (as many as the repairs read back) all rows
have the values of the rows before them and zero deltas. No rule and no repair
tells such rows apart -- those that read the time of day need a delta above or
below zero -- so one row with its number of slots speaks for them. With ``materialize`` (the default) the repaired rows are written
once, so that the fences read stored data; building the chain then runs it up
to there. ``failed`` is a plan of its own, computed only if it is used.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtide import fixed
from gridtide.config import TelemetryConfig
from gridtide.functions.nulls import nan_to_null
from gridtide.functions.rules import default_rules, has_error
from gridtide.operators import calendar, cleanse, derive, quality, validate
from gridtide.operators.outliers import replace_outliers
from gridtide.session import StageStore


#: Number of slots that a row stands for.
SLOTS = "__slot_count"


@dataclass
class ChainResult:
    cleaned: DataFrame
    failed: DataFrame
    quarantined: DataFrame
    #: ``cleaned`` with equal rows of a device's month as one, which :data:`SLOTS` counts.
    counted: DataFrame


def run_chain(
    raw: DataFrame,
    cfg: TelemetryConfig = TelemetryConfig(),
    scope: str = "device",
    accuracy: int | None = None,
    materialize: bool = True,
    exact: bool = False,
    store: StageStore | None = None,
) -> ChainResult:
    """The whole chain. ``store`` keeps the flagged readings (once, for the valid, the failed and the
    quarantined ones) and the repaired rows, until its owner closes it; without it the checks
    run in the exchange that finds the slots, and ``failed`` reads the input again if it is used."""
    if store is not None:
        tagged = nan_to_null(raw).withColumn(quality.QUARANTINE_REASON, quality.quarantine_reason(cfg))
        usable = F.col(quality.QUARANTINE_REASON).isNull()
        flagged = store.table(quality.flag_generic(tagged, cfg, counted=tagged.where(usable)), "flagged")
        valid, failed = quality.split_valid_failed(flagged.where(usable).drop(quality.QUARANTINE_REASON))
        quarantined = flagged.where(~usable).select(*raw.columns, quality.QUARANTINE_REASON)
        cleaned, counted = _clean(calendar.series_stretches(valid, cfg), cfg, scope, accuracy, exact, store)
        return ChainResult(cleaned, failed, quarantined, counted)
    df, quarantined = quality.quarantine(nan_to_null(raw), cfg)
    failed = quality.generic_validation(df, cfg)[1]
    cleaned, counted = _clean(calendar.series_stretches(df, cfg, raw=True), cfg, scope, accuracy, exact, materialize)
    return ChainResult(cleaned, failed, quarantined, counted)


def _clean(
    series: DataFrame, cfg: TelemetryConfig, scope: str, accuracy: int | None, exact: bool, materialize
) -> tuple[DataFrame, DataFrame]:
    """Completed series (its stretches) -> derived -> checked -> repaired -> outliers replaced: the rows of all
    slots, and the same with equal rows counted."""
    by_device = scope == "device"
    # the previous row of all devices may be any slot's
    rows = calendar.leading_rows(series, cfg, cleanse.reach(cfg) + 1) if by_device else calendar.expand(series, cfg)
    if by_device:
        rows = rows.withColumn(SLOTS, calendar.slot_count(cfg))
    derived = derive.derive_all(rows, cfg, bounded=True, also=(calendar.LAST, SLOTS) if by_device else ())
    checked = validate.validate_rows(derived, cfg)
    fused_previous = cfg.outlier_columns if by_device else ()
    repaired = cleanse.repair_rule_failures(checked, cfg, previous_of=fused_previous, bounded=True)
    out = replace_outliers(
        repaired,
        cfg,
        cfg.outlier_columns,
        cfg.iqr_multiplier,
        scope=scope,
        accuracy=accuracy,
        exact=exact,
        materialize=materialize,
        previous_ready=bool(fused_previous),
        bounded=True,
        times=SLOTS if by_device else None,
    )
    if not by_device:
        return out, out.withColumn(SLOTS, F.lit(1).cast("long"))
    # the rows of a stretch differ in their time of day
    return derive.add_time_of_day(calendar.expand(out, cfg).drop(SLOTS), cfg), out.drop(calendar.LAST)


def rule_columns() -> list[tuple[str, str]]:
    """(report column, message) for each rule, in rule-book order."""
    return [(f"rule_{i:02d}", r.message) for i, r in enumerate(default_rules(), start=1)]


def season_rule_report(
    checked: DataFrame, cfg: TelemetryConfig = TelemetryConfig(), times: str | None = None
) -> DataFrame:
    """Per season: rows, valid rows, rows breaking each rule, and the sums of the
    (repaired) counters and deltas. A row counts as often as the column ``times`` says."""
    n = F.lit(1).cast("long") if times is None else F.col(times)
    held = F.col if times is None else lambda c: F.col(c) * n

    def rows(cond):
        return F.coalesce(F.sum(F.when(cond, n)), F.lit(0).cast("long"))

    aggs = [
        F.sum(n).alias("n_rows"),
        rows(F.col(fixed.IS_VALID)).alias("n_valid"),
        *[rows(has_error(msg)).alias(name) for name, msg in rule_columns()],
        *[F.sum(held(c)).alias(f"sum_{c}") for c in cfg.counters],
        *[F.sum(held(d)).alias(f"sum_{d}") for d in cfg.deltas],
    ]
    return checked.groupBy(fixed.SEASON).agg(*aggs)
