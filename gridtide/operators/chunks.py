"""Windows over groups too long for one task: chunks of the order, with a halo.

A window over a device puts all its rows into one task. A device that holds
more rows than a task should (``group_rows``, or a thousandth of all rows) is cut
into chunks of its (time, tie) order instead: the chunk is a function of the
row, by binary search among bounds taken from a small sample, so rows are
shuffled once, by (device, chunk), and the window runs per chunk. What it needs
from beyond its chunk comes in a table with a few rows per chunk:

* the last ``k`` rows before the chunk (*halo*), for reads of previous rows;
* the first non-null value behind the chunk, for a backward fill.

The sample only places the bounds; results don't depend on them. There are at
most ``MOST_CHUNKS`` long devices and as many further chunks, so the bounds and
the halo are broadcast whatever the data size. Devices below the limit keep
their plain window in the same plan, and a table without a long device gets the
plain window's plan.

Rows that are equal in device, time and tie share a place in the order and stay
together; between them "previous" is not defined, as in any window.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridtide.config import TelemetryConfig
from gridtide.functions.windows import newest_first, order_columns, running

#: Chunks (and groups cut into chunks) at most, whatever the data size.
MOST_CHUNKS = 1000
#: Sampled places of the order for each chunk.
SAMPLE = 32
_HASHES = 1 << 30
_CHUNK, _BOUNDS, _N = "__chunk", "__bounds", "__n"


def _place(order: Sequence[str]) -> Column:
    """A row's place in the order; nulls first, as the ascending windows have them."""
    return F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])


def _sampled(df: DataFrame, names: Sequence[str], share: Column | float) -> DataFrame:
    """The rows whose places fall below ``share`` by a hash: the same ones at every reading."""
    return df.where(F.pmod(F.xxhash64(*names), F.lit(_HASHES)) < F.lit(_HASHES) * share)


def _bounds_of(sample: Column) -> Column:
    """Each ``SAMPLE``-th of the sorted places begins a chunk."""
    return F.filter(sample, lambda _, i: (i > 0) & (i % SAMPLE == 0))


def find_bounds(df: DataFrame, keys: Sequence[str], order: Sequence[str], group_rows: int) -> DataFrame | None:
    """(keys, bounds) of the groups that are too long for one task; None if there is none.

    Two small aggregates, and one sampled read if a group is too long.
    """
    spark = df.sparkSession
    keys, order = list(keys), list(order)
    total = df.count()
    if total <= group_rows:
        return None
    limit = max(group_rows, total // MOST_CHUNKS)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(_N))
    long = counts.where(F.col(_N) > limit).collect()
    if not long:
        return None
    groups = spark.createDataFrame(long, counts.schema)
    rows = _joined(df.select(*keys, *[c for c in order if c not in keys]), groups, keys, [_N])
    rows = _sampled(rows.where(F.col(_N).isNotNull()), [*keys, *order], SAMPLE / limit)
    # places occur once, so that a group of copies can't fill the sample
    places = rows.select(*keys, _place(order).alias("place")).distinct().groupBy(*keys).agg(F.collect_list("place").alias("s"))
    found = places.select(*keys, _bounds_of(F.array_sort("s")).alias(_BOUNDS))
    return spark.createDataFrame(found.collect(), found.schema)


def find_all_bounds(df: DataFrame, order: Sequence[str], chunks: int) -> DataFrame:
    """One row with the bounds that cut all rows into about ``chunks`` chunks of ``order``."""
    spark = df.sparkSession
    chunks = max(1, min(chunks, MOST_CHUNKS))
    limit = max(1, -(-df.count() // chunks))
    places = _sampled(df.select(*order), order, SAMPLE / limit).select(_place(order).alias("place")).distinct()
    found = places.agg(_bounds_of(F.array_sort(F.collect_list("place"))).alias(_BOUNDS))
    return spark.createDataFrame(found.collect(), found.schema)


def _joined(df: DataFrame, small: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``df`` with ``columns`` of the row of ``small`` (bounded by MOST_CHUNKS) that has the same keys, nulls included."""
    names = {k: f"__k{i}" for i, k in enumerate(keys)}
    side = small.select(*[F.col(k).alias(n) for k, n in names.items()], *columns)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()])
    return df.join(F.broadcast(side), same, "left").drop(*names.values())


def _chunked(df: DataFrame, keys: Sequence[str], order: Sequence[str], bounds: DataFrame) -> DataFrame:
    """``df`` with its chunk (null for the groups that aren't cut): how many bounds are at or before the row."""
    df = _joined(df, bounds, keys, [_BOUNDS]) if keys else df.withColumn(_BOUNDS, bounds.select(_BOUNDS).scalar())
    held = F.col(_BOUNDS)
    here = _place(order)
    steps = F.array(*[F.lit(1 << s) for s in range(MOST_CHUNKS.bit_length(), -1, -1)])
    search = F.aggregate(
        steps, F.lit(0), lambda at, step: F.when(F.try_element_at(held, at + step) <= here, at + step).otherwise(at)
    )
    return df.withColumn(_CHUNK, F.when(held.isNotNull(), search)).drop(_BOUNDS)


def _oldest_first(partition_by, order):
    return Window.partitionBy(*partition_by).orderBy(*[F.col(c).asc_nulls_first() for c in order])


def previous_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    reads: Mapping[str, tuple[int, Sequence[str]]],
    bounds: DataFrame | None = None,
) -> DataFrame:
    """``df`` with a struct of the named fields of the row ``j`` places earlier, for each ``name: (j, fields)``.

    ``bounds`` come from :func:`find_bounds` (or :func:`find_all_bounds`, with
    no keys); without them it is the plain window over ``keys``.
    """
    keys, order = list(keys), list(order)
    struct = lambda fields: F.struct(*[F.col(f) for f in fields])
    if bounds is None:
        w = newest_first(keys, order)
        return df.withColumns({name: F.lead(struct(fields), j).over(w) for name, (j, fields) in reads.items()})
    depth = max(j for j, _ in reads.values())
    fields = sorted({f for _, fs in reads.values() for f in fs})
    staged = _chunked(df, keys, order, bounds)
    group = [*keys, _CHUNK]

    # the last rows of each chunk; the rank limit is applied before the shuffle too
    rank = F.row_number().over(newest_first(group, order))
    last = staged.where(F.col(_CHUNK).isNotNull()).select(*group, *[c for c in order if c not in group], struct(fields).alias("__v"))
    last = last.withColumn("__r", rank).where(F.col("__r") <= depth)
    tails = last.groupBy(*group).agg(F.array_sort(F.collect_list(F.struct((-F.col("__r")).alias("r"), F.col("__v").alias("v")))).alias("__t"))
    before = F.flatten(F.collect_list("__t").over(Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(-depth, -1)))
    halo = tails.select(*group, F.transform(before, lambda x: x["v"]).alias("__halo"))

    w = _oldest_first(group, order)
    local = staged.withColumns(
        {"__rn": F.row_number().over(w), **{name: F.lag(struct(fs), j).over(w) for name, (j, fs) in reads.items()}}
    )
    out = _joined(local, halo, group, ["__halo"])

    def read(name: str, j: int, fs: Sequence[str]) -> Column:
        place = F.when(F.col("__rn") <= j, F.col("__rn") - j - 1).otherwise(F.lit(-depth - 1))
        far = F.try_element_at(F.col("__halo"), place)
        return F.when(F.col("__rn") > j, F.col(name)).otherwise(F.when(far.isNotNull(), F.struct(*[far.getField(f).alias(f) for f in fs])))

    return out.withColumns({name: read(name, j, fs) for name, (j, fs) in reads.items()}).drop("__rn", "__halo", _CHUNK)


def device_bounds(df: DataFrame, cfg: TelemetryConfig, bounded: bool = False) -> DataFrame | None:
    """Bounds of the devices that hold more than ``cfg.group_rows`` rows; ``bounded`` series have none."""
    return None if bounded else find_bounds(df, [cfg.key], order_columns(df, cfg), cfg.group_rows)


def previous_of_device(
    df: DataFrame, cfg: TelemetryConfig, reads: Mapping[str, tuple[int, Sequence[str]]], bounded: bool = False
) -> DataFrame:
    """:func:`previous_rows` of the device in the configured order."""
    return previous_rows(df, [cfg.key], order_columns(df, cfg), reads, device_bounds(df, cfg, bounded))


def backward_fill(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str], bounds: DataFrame | None = None
) -> DataFrame:
    """Each column with the first non-null value at or after the row within ``keys``.

    In a cut group it is a scan on two levels: a running fill within the chunk,
    and behind its last value the first one of a later chunk, from a table with
    one row per chunk.
    """
    keys, order, columns = list(keys), list(order), list(columns)
    if bounds is None:
        w = running(newest_first(keys, order))
        return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in columns})
    staged = _chunked(df, keys, order, bounds)
    group = [*keys, _CHUNK]
    first = {c: f"__f{i}" for i, c in enumerate(columns)}
    firsts = (
        staged.where(F.col(_CHUNK).isNotNull())
        .groupBy(*group)
        .agg(*[F.min_by(c, F.when(F.col(c).isNotNull(), _place(order))).alias(n) for c, n in first.items()])
    )
    later = Window.partitionBy(*keys).orderBy(F.desc(_CHUNK)).rowsBetween(Window.unboundedPreceding, -1)
    behind = firsts.select(*group, *[F.last(n, ignorenulls=True).over(later).alias(n) for n in first.values()])
    w = running(newest_first(group, order))
    local = staged.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in columns})
    out = _joined(local, behind, group, list(first.values()))
    return out.withColumns({c: F.coalesce(c, n) for c, n in first.items()}).drop(*first.values(), _CHUNK)
