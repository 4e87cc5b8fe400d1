"""CSV sources.

``load_*`` read leniently: what can't be read becomes NULL. ``split_*`` read
the same files and give every line that doesn't fit beside the readings -- too
few or too many fields, a value that its type can't hold, a time that the
pattern rejects -- with its file and its text, so that no line is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType, TimestampNTZType, TimestampType

from gridtide import fixed
from gridtide.config import TelemetryConfig
from gridtide.operators.quality import QUARANTINE_REASON

DEFAULT = TelemetryConfig()

#: Columns of the lines that don't fit.
FILE, LINE = "source_file", "line"
BAD_LINE, BAD_TIME = "malformed line", "unreadable time"


def parse_wall_clock(text: str | Column, fmt: str) -> Column:
    """Text -> ``timestamp_ntz``; NULL (not an error) for text the pattern rejects.

    ``try_to_timestamp`` guards the ANSI-strict ``to_timestamp_ntz``, whose
    result is exact wall-clock time independent of the session time zone.
    """
    text = F.col(text) if isinstance(text, str) else text
    pattern = F.lit(fmt)
    return F.when(F.try_to_timestamp(text, pattern).isNotNull(), F.to_timestamp_ntz(text, pattern))


def _reader(spark: SparkSession, schema: StructType | str | None):
    reader = spark.read.option("header", True)
    return reader.schema(schema) if schema is not None else reader.option("inferSchema", True)


def _time(df: DataFrame, cfg: TelemetryConfig, time_format: str | None) -> Column:
    if isinstance(df.schema[cfg.time].dataType, TimestampType | TimestampNTZType | DateType):
        return F.col(cfg.time).cast("timestamp_ntz")  # read as a time already
    return parse_wall_clock(F.col(cfg.time).cast("string"), time_format or cfg.time_format)


def load_readings(
    spark: SparkSession,
    path: str,
    cfg: TelemetryConfig = DEFAULT,
    schema: StructType | str | None = None,
    time_format: str | None = None,
    drop: tuple[str, ...] = (fixed.DROPPED_AT_LOAD,),
) -> DataFrame:
    """Header CSV of readings; the time column is parsed with ``time_format``
    (default ``dd/MM/yyyy HH:mm``) and the simulated-time column is dropped.

    Pass ``schema`` (with the time column as string) in production: inference
    costs an extra pass over the files and may type ids as int.
    """
    df = _reader(spark, schema).csv(path)
    return df.withColumn(cfg.time, _time(df, cfg, time_format)).drop(*drop)


def load_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Any header CSV; types inferred unless a schema is given."""
    return _reader(spark, schema).csv(path)


def _with_lines(spark: SparkSession, path: str, schema: StructType | str, header: bool) -> tuple[DataFrame, list[str], str]:
    """All lines read with their file and, where they don't fit, their text; the schema's columns; the text's column."""
    if isinstance(schema, str):
        schema = spark.createDataFrame([], schema).schema
    text, file = "__line", "__file"
    # every field of a line is looked at, whatever columns a query needs later
    reader = spark.read.option("header", header).option("columnPruning", False).option("mode", "PERMISSIVE")
    reader = reader.option("columnNameOfCorruptRecord", text).schema(StructType([*schema.fields, StructField(text, StringType())]))
    return reader.csv(path).withColumn(file, F.col("_metadata.file_path")), schema.names, text


def _judged(df: DataFrame, names: list[str], fits: Column) -> DataFrame:
    # the reader only judges the fields that a query needs: the hash needs them all
    return df.where(fits & (F.hash(*names) >= F.lit(-(2**31))))


def _lines(df: DataFrame, reason: Column, names: list[str], text: Column) -> DataFrame:
    bad = _judged(df, names, reason.isNotNull())
    return bad.select(F.col("__file").alias(FILE), text.alias(LINE), reason.alias(QUARANTINE_REASON))


def split_csv(spark: SparkSession, path: str, schema: StructType | str, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """S4 with nothing lost: (rows that fit ``schema``, the other lines: file, text, reason)."""
    df, names, text = _with_lines(spark, path, schema, header)
    bad = F.when(F.col(text).isNotNull(), F.lit(BAD_LINE))
    return _judged(df, names, F.col(text).isNull()).select(*names), _lines(df, bad, names, F.col(text))


def split_readings(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    cfg: TelemetryConfig = DEFAULT,
    time_format: str | None = None,
    drop: tuple[str, ...] = (fixed.DROPPED_AT_LOAD,),
    header: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """S1 and P11 with nothing lost: (readings, the lines that hold none: file, text, reason).

    A line whose fields fit but whose time the pattern rejects is given with its
    fields joined by commas. A missing time is no fault of the line: such a
    reading goes on to :func:`gridtide.operators.quality.quarantine`.
    """
    df, names, text = _with_lines(spark, path, schema, header)
    time = _time(df, cfg, time_format)
    late = F.col(cfg.time).isNotNull() & time.isNull()
    reason = F.when(F.col(text).isNotNull(), F.lit(BAD_LINE)).when(late, F.lit(BAD_TIME))
    joined = F.concat_ws(",", *[F.coalesce(F.col(n).cast("string"), F.lit("")) for n in names])
    readings = _judged(df, names, reason.isNull()).select(*names).withColumn(cfg.time, time).drop(*drop)
    return readings, _lines(df, reason, names, F.coalesce(F.col(text), joined))


def write_readings_csv(df: DataFrame, path: str, cfg: TelemetryConfig = DEFAULT, time_format: str | None = None) -> None:
    """Write readings as header CSV with the time rendered in ``time_format``."""
    out = df.withColumn(cfg.time, F.date_format(cfg.time, time_format or cfg.time_format))
    out.write.mode("overwrite").option("header", True).csv(path)
