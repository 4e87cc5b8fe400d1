"""IQR outliers (A6, C8) and the all-device previous row.

Approximate fences (the reference's behaviour) come from one
``percentile_approx`` aggregate over all target columns, attached to the rows
as a scalar subquery: no join, a bounded sketch whatever the data size, and
the quantile pass shares the upstream exchange with the main plan.
``accuracy`` 100 is the reference's relative error of 0.01.

Exact fences (``exact=True``, the lower quantile of ``percentile_disc``) use
:func:`exact_quantiles`: an approximate bracket, counts, then an exact
aggregate over the few rows inside the bracket -- bounded memory at any
scale, a few small aggregate rows to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from fractions import Fraction
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from gridtide import fixed
from gridtide.config import TelemetryConfig
from gridtide.operators import chunks
from gridtide.session import StageStore, checkpoint_table

DEFAULT = TelemetryConfig()


def _check_names(columns) -> list[str]:
    columns = [columns] if isinstance(columns, str) else list(columns)
    if not all(isinstance(c, str) for c in columns):
        raise ValueError(f"columns must be given by their names, got {columns!r}")
    return columns


def _quartiles(df: DataFrame, col: str, accuracy: int) -> Column:
    lo_q, hi_q = fixed.IQR_QUANTILES
    return F.percentile_approx(_usable(df, col), F.array(F.lit(lo_q), F.lit(hi_q)), F.lit(accuracy))


@dataclass
class _Target:
    col: str
    p: float
    k: int  # 1-based rank of the wanted order statistic among the usable values
    lo: object
    hi: object
    rank: int = 0  # rank inside [lo, hi]
    inside: int = 0
    done: bool = False


def _usable(df: DataFrame, col: str) -> Column:
    """The column with NaN as NULL (quantiles ignore both)."""
    if df.schema[col].dataType in (DoubleType(), FloatType()):
        return F.nanvl(F.col(col), F.lit(None))
    return F.col(col)


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float] = fixed.IQR_QUANTILES,
    accuracy: int = 10_000,
    band_limit: int = 1_000_000,
) -> dict[str, list]:
    """Exact lower quantiles (``percentile_disc``: the value at rank
    ceil(p * N)) of the values that are neither NULL nor NaN.

    1. One aggregate: counts, and an approximate bracket per quantile
       (``percentile_approx`` at p -/+ 2/accuracy).
    2. One aggregate: rows below and inside each bracket, which give the rank
       inside it. A bracket of more than ``band_limit`` rows is narrowed by an
       approximate pass over its rows and counted again, until it fits or stops
       shrinking (many equal values). ``band_limit`` bounds memory only: the
       result is the same for any value of it.
    3. One exact ``percentile_disc`` restricted to the bracket.

    Each pass returns one small row to the driver; the data is only scanned.
    """
    columns = _check_names(columns)
    delta = 2.0 / accuracy
    usable = {c: _usable(df, c) for c in columns}

    def around(src: Column, p: float) -> Column:
        ends = F.array(F.lit(max(0.0, p - delta)), F.lit(min(1.0, p + delta)))
        return F.percentile_approx(src, ends, F.lit(accuracy))

    def inside(t: _Target) -> Column:
        x = usable[t.col]
        return F.when(x.between(F.lit(t.lo), F.lit(t.hi)), x)

    wanted = [(c, p) for c in columns for p in probs]
    first = df.select(
        *[F.count(usable[c]).alias(f"n{i}") for i, c in enumerate(columns)],
        *[around(usable[c], float(p)).alias(f"b{i}") for i, (c, p) in enumerate(wanted)],
    ).first()
    n = {c: first[f"n{i}"] for i, c in enumerate(columns)}
    live = [
        _Target(c, p, max(1, ceil(Fraction(str(p)) * n[c])), *first[f"b{i}"]) for i, (c, p) in enumerate(wanted) if n[c]
    ]

    def count(ts: list[_Target]) -> list[tuple[int, int]]:
        row = df.select(
            *[F.count_if(usable[t.col] < F.lit(t.lo)).alias(f"lt{i}") for i, t in enumerate(ts)],
            *[F.count(inside(t)).alias(f"in{i}") for i, t in enumerate(ts)],
        ).first()
        return [(t.k - row[f"lt{i}"], row[f"in{i}"]) for i, t in enumerate(ts)]

    # the first brackets; one that misses its rank (a sketch may) is opened to all values
    for t, (rank, size) in zip(live, count(live) if live else [], strict=True):
        t.rank, t.inside = rank, size
    missed = [t for t in live if not 1 <= t.rank <= t.inside]
    if missed:
        ends = df.select(*[F.struct(F.min(usable[t.col]), F.max(usable[t.col])).alias(f"e{i}") for i, t in enumerate(missed)]).first()
        for i, t in enumerate(missed):
            t.lo, t.hi, t.rank, t.inside = *ends[f"e{i}"], t.k, n[t.col]
    while wide := [t for t in live if t.inside > band_limit and t.lo != t.hi and not t.done]:
        row = df.select(*[around(inside(t), (t.rank - 0.5) / t.inside).alias(f"b{i}") for i, t in enumerate(wide)]).first()
        tried = [replace(t, lo=row[f"b{i}"][0], hi=row[f"b{i}"][1]) for i, t in enumerate(wide)]
        for t, new, (rank, size) in zip(wide, tried, count(tried), strict=True):
            if 1 <= rank <= size < t.inside:
                t.lo, t.hi, t.rank, t.inside = new.lo, new.hi, rank, size
            else:
                t.done = True  # it can't be narrowed further; the last counted bracket stands
    result: dict[tuple[str, float], object] = dict.fromkeys(wanted)
    if live:
        banded = df.select(*[inside(t).alias(f"x{i}") for i, t in enumerate(live)])
        row = banded.select(
            *[
                F.expr(f"percentile_disc({(t.rank - 0.5) / t.inside!r}) WITHIN GROUP (ORDER BY x{i})").alias(f"q{i}")
                for i, t in enumerate(live)
            ]
        ).first()
        for i, t in enumerate(live):
            result[(t.col, t.p)] = row[f"q{i}"]
    return {c: [result[(c, p)] for p in probs] for c in columns}


def _total_of(counted: DataFrame, parts: int) -> list:
    """The value ranges of rows (x, n), in order: how often their values count in all, how many values they hold."""
    ranged = counted.repartitionByRange(parts, "x").groupBy(F.spark_partition_id().alias("part"))
    return sorted(ranged.agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.sum("n").alias("n"), F.count("*").alias("rows")).collect())


def exact_weighted_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    times: str,
    probs: Sequence[float] = fixed.IQR_QUANTILES,
    band_limit: int = 1_000_000,
) -> dict[str, list]:
    """:func:`exact_quantiles` of rows that count as often as the column ``times`` says.

    Equal values are counted together and cut into ranges; the range that holds
    the rank is cut again until it has at most ``band_limit`` different values,
    which one running sum reads in order. A few rows per range reach the driver.
    """
    columns = _check_names(columns)
    parts = max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    result: dict[str, list] = {}
    for c in columns:
        x = _usable(df, c)
        counted = df.select(x.alias("x"), F.col(times).alias("n")).where(F.col("x").isNotNull() & (F.col("n") > 0))
        counted = counted.groupBy("x").agg(F.sum("n").alias("n"))
        ranges = _total_of(counted, parts)
        total = sum(r["n"] for r in ranges)
        result[c] = []
        for p in probs:
            rank, here, held = max(1, ceil(Fraction(str(p)) * total)), ranges, counted
            while total:
                for r in here:
                    if rank <= r["n"]:
                        break
                    rank -= r["n"]
                held = counted.where(F.col("x").between(F.lit(r["lo"]), F.lit(r["hi"])))
                if r["rows"] <= band_limit:
                    break
                here = _total_of(held, parts)
            if not total:
                result[c].append(None)
                continue
            upto = held.withColumn("upto", F.sum("n").over(Window.orderBy("x")))
            result[c].append(upto.where(F.col("upto") >= rank).agg(F.min("x").alias("x")).first()["x"])
    return result


def iqr_fences(
    df: DataFrame,
    columns: Sequence[str],
    multiplier: float = fixed.IQR_MULTIPLIER,
    accuracy: int = 100,
    exact: bool = False,
) -> DataFrame:
    """One row per column: ``column, q1, q3, lower, upper``.

    Approximate (one aggregate pass, bounded sketch) by default; ``exact``
    uses :func:`exact_quantiles`. NULL and NaN are ignored; an all-NULL or
    empty column gives NULL fences.
    """
    columns = _check_names(columns)
    spark = df.sparkSession
    if exact:
        qs = exact_quantiles(df, columns)
        as_double = lambda v: None if v is None else float(v)
        quart = spark.createDataFrame(
            [tuple([as_double(qs[c][0]), as_double(qs[c][1])] for c in columns)],
            ", ".join(f"`{c}` array<double>" for c in columns),
        )
    else:
        quart = df.select(*[_quartiles(df, c, accuracy).alias(c) for c in columns])
    rows = quart.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("q")) for c in columns])).alias("r")
    )
    q1, q3 = F.col("r.q")[0], F.col("r.q")[1]
    return rows.select(
        F.col("r.column").alias("column"),
        q1.alias("q1"),
        q3.alias("q3"),
        (q1 - F.lit(multiplier) * (q3 - q1)).alias("lower"),
        (q3 + F.lit(multiplier) * (q3 - q1)).alias("upper"),
    )


def _fence_subquery(df: DataFrame, columns, accuracy) -> Column:
    """A scalar subquery: struct of [q1, q3] arrays, one field per column."""
    quart = df.select(F.struct(*[_quartiles(df, c, accuracy).alias(c) for c in columns]).alias("q"))
    return quart.scalar()


def _fence_literals(df: DataFrame, columns, times: str | None) -> Column:
    """Exact quartiles as a literal struct (computed by :func:`exact_quantiles`)."""
    qs = exact_quantiles(df, columns) if times is None else exact_weighted_quantiles(df, columns, times)
    return F.struct(
        *[
            F.array(F.lit(qs[c][0]).cast("double"), F.lit(qs[c][1]).cast("double")).alias(c)
            for c in columns
        ]
    )


def keyed_previous(
    df: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str],
    order: Sequence[str],
    partitions: int | None = None,
    prefix: str = "__prev_",
) -> DataFrame:
    """``<prefix><c>`` = value of ``c`` on the previous row of the same ``keys``
    group in ``order`` (all rows when ``keys`` is empty), with no task holding
    a whole group.

    All rows are cut into chunks of the order (keys, order) and shuffled once,
    by chunk; the row before a chunk comes from a table with one row per chunk
    (see :mod:`gridtide.operators.chunks`).
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys, order, columns = list(keys), list(order), list(columns)
    whole_order = [*keys, *[c for c in order if c not in keys]]
    # a few chunks per partition, since chunks are dealt by hash
    bounds = chunks.find_all_bounds(df, whole_order, 4 * n)
    fields = list(dict.fromkeys([*keys, *columns]))
    out = chunks.previous_rows(df, [], whole_order, {"__before": (1, fields)}, bounds)
    before = F.col("__before")
    same = F.lit(True)
    for k in keys:
        same = same & before.getField(k).eqNullSafe(F.col(k))
    same = before.isNotNull() & same
    return out.withColumns({f"{prefix}{c}": F.when(same, before.getField(c)) for c in columns}).drop("__before")


def global_previous(df: DataFrame, columns: Sequence[str], order: Sequence[str], partitions: int | None = None) -> DataFrame:
    """``__prev_<c>`` from the previous row over *all* rows (any device) in
    ``order``, without a single-partition window (see :func:`keyed_previous`)."""
    return keyed_previous(df, columns, [], order, partitions)


def replace_outliers(
    df: DataFrame,
    cfg: TelemetryConfig = DEFAULT,
    columns: Sequence[str] | None = None,
    multiplier: float = fixed.IQR_MULTIPLIER,
    scope: str = "device",
    accuracy: int | None = None,
    exact: bool = False,
    global_order: Sequence[str] | None = None,
    materialize: bool | StageStore = False,
    previous_ready: bool = False,
    bounded: bool = False,
    times: str | None = None,
) -> DataFrame:
    """A value outside ``[q1 - m*iqr, q3 + m*iqr]`` takes the previous value.

    Fences are global (all devices). ``scope='device'`` takes the previous
    value within the device; ``scope='global'`` the previous row over all
    devices in (time, key, tie) order, as the reference's unpartitioned lag.
    Only the tested column changes. ``previous_ready`` means the input already
    carries ``__prev_<c>`` columns (e.g. from the fused repair pass). A device
    too long for one task is read in chunks, unless ``bounded`` says that none can be.
    ``times`` names a column that says how often a row counts for the fences.

    The previous values are computed first (in the same window pass as any
    upstream per-device step). With ``materialize`` the rows are then written
    once (to the given :class:`gridtide.session.StageStore`, or as a table that
    stays under ``spark.checkpoint.dir``) and read back, so the
    quantile pass scans two columns of stored data instead of recomputing the
    lineage, and the replacement is a plain projection.
    """
    columns = _check_names(columns if columns is not None else cfg.outlier_columns)
    if not columns:
        return df
    accuracy = accuracy or cfg.quantile_accuracy
    prev_cols = {c: f"__prev_{c}" for c in columns}
    if previous_ready:
        staged = df
    elif scope == "device":
        read = chunks.previous_of_device(df, cfg, {"__before": (1, columns)}, bounded)
        staged = read.withColumns({p: F.col("__before").getField(c) for c, p in prev_cols.items()}).drop("__before")
    elif scope == "global":
        order = list(global_order or [o for o in (cfg.time, cfg.key, cfg.tie) if o and o in df.columns])
        staged = global_previous(df, columns, order)
    else:
        raise ValueError(f"unknown scope {scope!r}")
    # the tested columns are those of the input: the fences need no previous values
    tested = df
    if isinstance(materialize, StageStore):
        tested = staged = materialize.table(staged, "outliers")
    elif materialize:
        tested = staged = checkpoint_table(staged, "outliers")
    if exact:
        fences_value = _fence_literals(tested, columns, times)
    else:
        if times is not None:
            tested = tested.select(*columns, F.explode(F.sequence(F.lit(1).cast("long"), F.col(times))))
        fences_value = _fence_subquery(tested, columns, accuracy)
    staged = staged.withColumn("__fences", fences_value)
    fences = F.col("__fences")

    def outlier(c: str) -> Column:
        q1, q3 = fences.getField(c)[0], fences.getField(c)[1]
        iqr = q3 - q1
        return (F.col(c) < q1 - F.lit(multiplier) * iqr) | (F.col(c) > q3 + F.lit(multiplier) * iqr)

    out = staged.withColumns({c: F.when(outlier(c), F.col(p)).otherwise(F.col(c)) for c, p in prev_cols.items()})
    return out.drop("__fences", *prev_cols.values())
