"""Tables that cut lineage and outlive a lost executor.

Loops and stream results are written as Parquet below the checkpoint folder of the session. The folder is the shared one
named by ``spark.checkpoint.dir``; one of our own is made only for a local master, where there is nothing to share.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="tallyforge-")
    context.setCheckpointDir(named)
    return context.getCheckpointDir() or named


def new_folder(spark: SparkSession, tag: str) -> str:
    """The path of a folder that does not exist yet."""
    return f"{checkpoint_root(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write_clean(df: DataFrame, path: str) -> None:
    """Write ``df``; the shuffle files of the job are deleted behind it, whenever the driver's collector runs.

    Rows that were sent are not needed once the table stands; a lost executor's files are made again as long as the job runs.
    """
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, None)
    conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.unset(_CLEANUP) if before is None else conf.set(_CLEANUP, before)


def materialize(df: DataFrame, tag: str = "table") -> DataFrame:
    """Write ``df`` once and read it back, so that later plans start from the files."""
    path = new_folder(df.sparkSession, tag)
    write_clean(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class RoundTables:
    """Durable tables for the rounds of a loop; superseded rounds are deleted."""

    def __init__(self, spark: SparkSession, tag: str, keep: int = 2):
        self._spark, self._tag, self._keep = spark, tag, keep
        self._paths: list[str] = []

    def save(self, df: DataFrame) -> DataFrame:
        path = new_folder(self._spark, self._tag)
        write_clean(df, path)
        self._paths.append(path)
        while len(self._paths) > self._keep:
            self._delete(self._paths.pop(0))
        return self._spark.read.schema(df.schema).parquet(path)

    def _delete(self, path: str) -> None:
        hadoop_path = self._spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        conf = self._spark.sparkContext._jsc.hadoopConfiguration()
        hadoop_path.getFileSystem(conf).delete(hadoop_path, True)
