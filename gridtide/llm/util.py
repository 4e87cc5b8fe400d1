"""Shared plumbing of the text operators: tables, per-document Arrow passes, stored stages.

The heavy per-document work runs in ``mapInArrow`` tasks. A task sees slices of
a bounded number of characters (one very long text is a slice of its own), so a
worker's memory follows the longest single text, never a partition.
"""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from gridtide.session import checkpoint_dir

#: Bytes of text handed to an operator's function at once.
SLICE_BYTES = 2_000_000

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    # executors fetch it from the shared folder
    target = context._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_dir(spark).rstrip('/')}/package-{uuid.uuid4().hex}/{root.name}.zip")
    fs = target.getFileSystem(context._jsc.hadoopConfiguration())
    out = fs.create(target, True)
    out.write(bytearray(packed.getvalue()))
    out.close()
    context.addPyFile(fs.makeQualified(target).toString())
    _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder, read by Spark (any file system)."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have (names clash whatever their case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of whole rows with at most ``limit`` bytes in ``column`` (or one row)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if i > start and held + n > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < len(sizes):
        yield batch.slice(start)


def per_text(
    df: DataFrame, column: str, fields: list[tuple[str, T.DataType]], make: Callable[[], Callable[[list], list[list]]]
) -> DataFrame:
    """``df`` with ``fields`` appended, computed from the texts of ``column``.

    ``make()`` runs once per task and returns a function from a list of texts
    (``None`` allowed) to one list per field. Columns of ``df`` that have a
    field's name are replaced.
    """
    ship(df.sparkSession)
    names = [n for n, _ in fields]
    kept = df.drop(*names) if column not in names else df.drop(*[n for n in names if n != column])
    out_names = [c for c in kept.columns if c not in names] + names
    schema = T.StructType([f for f in kept.schema.fields if f.name not in names] + [T.StructField(n, t) for n, t in fields])
    kinds = [to_arrow_type(t) for _, t in fields]

    def run(batches):
        work = make()
        for batch in batches:
            for part in slices(batch, column):
                made = work(part.column(column).to_pylist())
                keep = [part.column(c) for c in out_names[: len(out_names) - len(names)]]
                yield pa.RecordBatch.from_arrays(
                    keep + [pa.array(v, type=k) for v, k in zip(made, kinds, strict=True)], names=out_names
                )

    return kept.mapInArrow(run, schema)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """The jobs that run inside hand their Python workers at most ``rows`` rows at once."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(rows))
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def stored(df: DataFrame, name: str = "llm") -> DataFrame:
    """``df`` written once under the shared checkpoint folder and read back.

    Cuts the lineage (a lost executor re-reads files, it does not recompute)
    and keeps two readers of one costly result from computing it twice.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of a small table; its files go when Spark drops the table."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
