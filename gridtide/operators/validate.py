"""Row validation (V14-V18): attach the verdict of the rule book to every row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtide import fixed
from gridtide.config import TelemetryConfig
from gridtide.functions.rules import BatchRule, Rule, batch_flags, default_rules, verdict

DEFAULT = TelemetryConfig()


def validate_rows(df: DataFrame, cfg: TelemetryConfig = DEFAULT, rules: Sequence[Rule | BatchRule] | None = None) -> DataFrame:
    """Adds ``validation_result`` struct<is_valid, error_message>, ``is_valid`` and ``error_message``.

    Rules are column expressions evaluated inside whole-stage codegen; pass
    ``rules`` (see :func:`gridtide.functions.rules.custom_rules`) for a custom book.
    Batch rules among them (:class:`gridtide.functions.rules.BatchRule`) share
    one pass over Arrow batches; the verdict keeps the order of the book.
    """
    rules = default_rules() if rules is None else list(rules)
    res, held = fixed.VALIDATION_RESULT, "__batch_flags"
    flags = batch_flags(rules)
    if flags is None:
        out = df.withColumn(res, verdict(rules, cfg))
    else:
        out = df.withColumn(held, flags).withColumn(res, verdict(rules, cfg, F.col(held))).drop(held)
    return out.withColumns(
        {
            fixed.IS_VALID: F.col(res).getField(fixed.IS_VALID),
            fixed.ERROR_MESSAGE: F.col(res).getField(fixed.ERROR_MESSAGE),
        }
    )

