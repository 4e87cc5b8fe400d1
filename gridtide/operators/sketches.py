"""Fences from stored quantile sketches.

Each batch of readings leaves one small sketch per column (KLL, mergeable); the
fences of everything read so far come from the stored sketches, without another
look at the readings. With ``K`` = 800 a quantile's rank is within about 0.4 %
of the asked one, inside the 1 % that the approximate fences promise.

NULL and NaN are ignored; a batch or a column without a value adds nothing; a
column without any value has NULL fences.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtide import fixed

#: Size of a sketch: the rank error falls with it (800: about 0.4 %).
K = 800
SCHEMA = "batch string, column string, n long, sketch binary"


def sketch_columns(df: DataFrame, columns: Sequence[str], batch: str, k: int = K) -> DataFrame:
    """(batch, column, n, sketch) of each column: one aggregate pass, one row per column."""
    value = {c: F.nanvl(F.col(c).cast("double"), F.lit(None)) for c in columns}
    one = df.agg(
        *[F.count(v).alias(f"n{i}") for i, v in enumerate(value.values())],
        *[F.kll_sketch_agg_double(v, F.lit(k)).alias(f"s{i}") for i, v in enumerate(value.values())],
    )
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("n"), F.col(f"s{i}").alias("sketch")) for i, c in enumerate(columns)]
    return one.select(F.explode(F.array(*rows)).alias("r")).select(
        F.lit(batch).alias("batch"), "r.column", "r.n", F.when(F.col("r.n") > 0, F.col("r.sketch")).alias("sketch")
    )


def add_batch(df: DataFrame, columns: Sequence[str], store: str, batch: str, k: int = K) -> None:
    """Write the batch's sketches to the store; the same batch again replaces its own rows only."""
    sketch_columns(df, columns, batch, k).write.mode("overwrite").parquet(f"{store.rstrip('/')}/batch={batch}")


def stored_sketches(spark: SparkSession, store: str) -> DataFrame:
    """All batches' sketches of a store."""
    return spark.read.schema(SCHEMA).option("recursiveFileLookup", True).parquet(store)


def sketched_quantiles(sketches: DataFrame, probs: Sequence[float] = fixed.IQR_QUANTILES) -> DataFrame:
    """(column, n, q): the quantiles of each column over all its sketches, merged map-side."""
    merged = sketches.groupBy("column").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("s"))
    quantiles = F.array(*[F.kll_sketch_get_quantile_double("s", F.lit(float(p))) for p in probs])
    return merged.select("column", "n", F.when(F.col("n") > 0, quantiles).alias("q"))


def sketched_fences(sketches: DataFrame, multiplier: float = fixed.IQR_MULTIPLIER) -> DataFrame:
    """A6 from stored sketches, in the form of :func:`gridtide.operators.outliers.iqr_fences`."""
    q1, q3 = F.col("q")[0], F.col("q")[1]
    return sketched_quantiles(sketches).select(
        "column",
        q1.alias("q1"),
        q3.alias("q3"),
        (q1 - F.lit(multiplier) * (q3 - q1)).alias("lower"),
        (q3 + F.lit(multiplier) * (q3 - q1)).alias("upper"),
    )
