"""gridtide: Spark-native cleaning and completion of device telemetry.

Every public operator is a ``DataFrame -> DataFrame`` function driven by a
:class:`~gridtide.config.TelemetryConfig`, so stages chain with ``df.transform``.
"""

from gridtide.config import TelemetryConfig

__all__ = ["TelemetryConfig"]
