"""Session settings the operators rely on."""

from __future__ import annotations

from weakref import WeakSet

from pyspark.sql import SparkSession

# A rank filter is applied before the shuffle for ranks up to the group limit threshold.
# Adaptive execution sizes the shuffles, and splits a hot key of a join even when the
# split costs another exchange. Instants are UTC everywhere. A batch of rows for Python is
# bounded in bytes: by rows alone it grows with the texts, on both sides of the pipe.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.optimizer.windowGroupLimitThreshold": "100000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


def build_session(app: str = "opsframe", master: str | None = None, **extra) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


_prepared: WeakSet[SparkSession] = WeakSet()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings, once, to a session made elsewhere."""
    if spark not in _prepared:
        for name, value in SETTINGS.items():
            spark.conf.set(name, value)
        _prepared.add(spark)
    return spark
