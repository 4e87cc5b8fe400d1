"""Generic validation.

Both checks are aggregates joined back to the readings. Aggregates combine
map-side, so a hot device or a hot group of copies is reduced before the
shuffle; the join back is a plain equi-join that AQE may turn into a broadcast
when the runtime size of the aggregate allows it, or split on skew.

NULL semantics follow an equi-join: a NULL key never matches, so its rows are
never rejected; a NULL key or NULL time is never a duplicate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtide import fixed
from gridtide.config import TelemetryConfig

DEFAULT = TelemetryConfig()

DEVICE_ROW_COUNT = "device_row_count"
DUPLICATE_COUNT = "duplicate_count"
#: Sampled rows for each group of copies that is looked for, and such groups at most.
_SAMPLE = 32
_MOST_GROUPS = 1000


def _flag(count_col: str):
    return F.when(F.col(count_col) > 0, F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def flag_thin_devices(df: DataFrame, cfg: TelemetryConfig = DEFAULT) -> DataFrame:
    """A1 + J1: ``device_row_count`` (the device's row count when below the
    threshold, else NULL) and ``Is_Rejected`` 0/1. Counts raw rows, copies included."""
    counts = (
        df.groupBy(cfg.key)
        .agg(F.count(F.lit(1)).alias(DEVICE_ROW_COUNT))
        .filter(F.col(DEVICE_ROW_COUNT) < F.lit(cfg.rejection_threshold))
    )
    out = df.join(counts, on=cfg.key, how="left")
    return out.withColumn(fixed.IS_REJECTED, _flag(DEVICE_ROW_COUNT)).select(
        *df.columns, DEVICE_ROW_COUNT, fixed.IS_REJECTED
    )


def flag_duplicate_times(df: DataFrame, cfg: TelemetryConfig = DEFAULT) -> DataFrame:
    """A2 + J2: ``duplicate_count`` and ``Is_Duplicate`` 0/1; every member of a
    duplicate (key, time) group is flagged, none is kept."""
    dups = (
        df.groupBy(cfg.key, cfg.time)
        .agg(F.count(F.lit(1)).alias(DUPLICATE_COUNT))
        .filter(F.col(DUPLICATE_COUNT) > 1)
    )
    out = df.join(dups, on=[cfg.key, cfg.time], how="left")
    return out.withColumn(fixed.IS_DUPLICATE, _flag(DUPLICATE_COUNT)).select(
        *df.columns, DUPLICATE_COUNT, fixed.IS_DUPLICATE
    )


def flag_generic(df: DataFrame, cfg: TelemetryConfig = DEFAULT, counted: DataFrame | None = None) -> DataFrame:
    """A1 and A2 together, of the readings in ``counted`` (all of ``df`` by default).

    Both counts are aggregated map-side from the readings and only the thin
    devices and the repeated times are joined back, so the joined sides are
    small (AQE broadcasts them when their size allows) and clean readings need
    not be shuffled.
    """
    k, t = cfg.key, cfg.time
    n = F.count(F.lit(1))
    counted = df if counted is None else counted
    thin = counted.groupBy(k).agg(n.alias(DEVICE_ROW_COUNT)).filter(F.col(DEVICE_ROW_COUNT) < F.lit(cfg.rejection_threshold))
    dups = counted.groupBy(k, t).agg(n.alias(DUPLICATE_COUNT)).filter(F.col(DUPLICATE_COUNT) > 1)
    out = df.join(thin, on=k, how="left").join(dups, on=[k, t], how="left")
    return out.select(
        *df.columns,
        DEVICE_ROW_COUNT,
        _flag(DEVICE_ROW_COUNT).alias(fixed.IS_REJECTED),
        DUPLICATE_COUNT,
        _flag(DUPLICATE_COUNT).alias(fixed.IS_DUPLICATE),
    )


def without_proven_copies(df: DataFrame, cfg: TelemetryConfig = DEFAULT) -> DataFrame:
    """``df`` without the large groups of copies that a small sample of its rows shows.

    A (device, time) met twice in the sample is a duplicate for certain, so the
    rows of large groups can leave before a shuffle that deals by device and
    time; smaller groups are left to that shuffle. The sample only takes load off: the
    duplicates are all found in any case. At most ``_MOST_GROUPS`` groups are broadcast.
    """
    total = df.count()
    if total <= cfg.group_rows:
        return df
    share = min(1.0, _SAMPLE * _MOST_GROUPS / total)
    sample = df.select(cfg.key, cfg.time).where(F.rand(seed=_SAMPLE) < share).na.drop()
    groups = sample.groupBy(cfg.key, cfg.time).count().where(F.col("count") >= max(2, _SAMPLE // 4))
    found = groups.orderBy(F.desc("count")).limit(_MOST_GROUPS).select(cfg.key, cfg.time).collect()
    if not found:
        return df
    copies = df.sparkSession.createDataFrame(found, df.select(cfg.key, cfg.time).schema)
    return df.join(F.broadcast(copies), [cfg.key, cfg.time], "left_anti")


QUARANTINE_REASON = "quarantine_reason"


def quarantine_reason(cfg: TelemetryConfig = DEFAULT) -> Column:
    """Why a reading can be placed on no device's calendar; NULL if it can."""
    no_key, no_time = F.col(cfg.key).isNull(), F.col(cfg.time).isNull()
    reasons = F.concat_ws(", ", F.when(no_key, F.lit(f"no {cfg.key}")), F.when(no_time, F.lit(f"no {cfg.time}")))
    return F.when(no_key | no_time, reasons)


def quarantine(df: DataFrame, cfg: TelemetryConfig = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """(usable, quarantined): readings without a key or a time leave the chain here, with the reason."""
    reason = quarantine_reason(cfg)
    return df.filter(reason.isNull()), df.filter(reason.isNotNull()).withColumn(QUARANTINE_REASON, reason)


def split_valid_failed(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, failed). Valid rows have both flags 0 and lose the flag and
    count columns; failed rows (either flag 1) keep them."""
    rej, dup = F.col(fixed.IS_REJECTED), F.col(fixed.IS_DUPLICATE)
    failed = flagged.filter((rej == 1) | (dup == 1))
    valid = flagged.filter((rej == 0) & (dup == 0)).drop(
        fixed.IS_REJECTED, fixed.IS_DUPLICATE, DEVICE_ROW_COUNT, DUPLICATE_COUNT
    )
    return valid, failed


def generic_validation(df: DataFrame, cfg: TelemetryConfig = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """Thin-device and duplicate-time checks, split into (valid, failed).

    Both outputs share one flagged plan; persist or checkpoint it when both
    are consumed by separate actions.
    """
    return split_valid_failed(flag_generic(df, cfg))


def device_list(df: DataFrame, cfg: TelemetryConfig = DEFAULT) -> DataFrame:
    """A3: distinct device keys, as a DataFrame (never collected)."""
    return df.select(cfg.key).distinct()
