"""Session settings the operators are tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "tallyforge", master: str | None = None, **conf: object) -> SparkSession:
    """A session with adaptive execution and runtime skew splitting on, and UTC time.

    Values in ``conf`` win; dots in setting names are written as double underscores.
    """
    settings: dict[str, object] = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # Split hot join keys even where that costs one more shuffle afterwards.
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # State of streams lies outside the heap, so that it may outgrow an executor's memory.
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.session.timeZone": "UTC",
    }
    settings.update({name.replace("__", "."): value for name, value in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name, str(value))
    return builder.getOrCreate()
