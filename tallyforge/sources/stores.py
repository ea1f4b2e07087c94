"""Keyed stores that stream sinks write: a folder per micro-batch, folded now and then into a numbered snapshot.

A reader takes the newest snapshot and the batches after it, so a read costs the live keys and a few batches, not the
history. A snapshot counts from the moment its marker file is there, which is created in one step; a fold that dies before
leaves nothing behind that is read. A replayed batch replaces its folder, and one that a snapshot already holds is not
written again, so replays are exact before and after a fold.

A store belongs to one stream checkpoint, whose batch numbers it relies on.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SNAPSHOTS = "_snapshots"
_MARK = ".done"
_BATCH = "batch_id"


def replace_batch(rows: DataFrame, batch_id: int, path: str) -> None:
    """Write the rows of one batch to a folder of their own; a replay replaces it."""
    (
        rows.withColumn(_BATCH, F.lit(batch_id).cast("bigint"))
        .write.partitionBy(_BATCH).option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)
    )


class BatchStore:
    """The batches and snapshots below one folder; ``schema`` is that of the rows, without the number of their batch."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self._spark, self._path, self._schema = spark, path.rstrip("/"), schema

    def put(self, rows: DataFrame, batch_id: int) -> None:
        """Store a batch, unless the newest snapshot holds it already."""
        if batch_id > self.folded():
            replace_batch(rows, batch_id, self._path)

    def rows(self, upto: int | None = None) -> DataFrame:
        """The newest snapshot, numbered as the last batch it holds, and the batches after it (not past ``upto``)."""
        done = self.folded()
        later = self._spark.read.schema(f"{self._schema}, {_BATCH} BIGINT").parquet(self._path).where(F.col(_BATCH) > done)
        if upto is not None:
            later = later.where(F.col(_BATCH) <= upto)
        if done < 0:
            return later
        snapshot = self._spark.read.schema(self._schema).parquet(self._snapshot(done))
        return snapshot.withColumn(_BATCH, F.lit(done).cast("bigint")).unionByName(later)

    def fold(self, merge: Callable[[DataFrame], DataFrame], upto: int | None = None) -> None:
        """Write ``merge`` of all rows up to a batch (default: the newest) as a snapshot.

        What the snapshot before it holds is deleted. That snapshot and the batches after it stay until the next fold, for
        readers that began with them.
        """
        before, batches = self.folded(), self._numbers(self._path, f"{_BATCH}=", "")
        last = max((b for b in batches if upto is None or b <= upto), default=-1)
        if last <= before:
            return
        merge(self.rows(last)).write.mode("overwrite").parquet(self._snapshot(last))
        self._fs().create(self._hadoop(self._snapshot(last) + _MARK), True).close()
        for batch in batches:
            if batch <= before:
                self._delete(f"{self._path}/{_BATCH}={batch}")
        for number in self._numbers(f"{self._path}/{_SNAPSHOTS}", "", ""):
            if number < before:
                self._delete(self._snapshot(number) + _MARK)
                self._delete(self._snapshot(number))

    def folded(self) -> int:
        """The last batch in the newest snapshot, -1 without one."""
        return max(self._numbers(f"{self._path}/{_SNAPSHOTS}", "", _MARK), default=-1)

    def _snapshot(self, number: int) -> str:
        return f"{self._path}/{_SNAPSHOTS}/{number}"

    def _hadoop(self, path: str):
        return self._spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self):
        return self._hadoop(self._path).getFileSystem(self._spark.sparkContext._jsc.hadoopConfiguration())

    def _delete(self, path: str) -> None:
        self._fs().delete(self._hadoop(path), True)

    def _numbers(self, folder: str, head: str, tail: str) -> list[int]:
        """Numbers of the entries named ``head``, digits, ``tail``."""
        fs, place = self._fs(), self._hadoop(folder)
        if not fs.exists(place):
            return []
        names = [status.getPath().getName() for status in fs.listStatus(place)]
        middles = [n[len(head):len(n) - len(tail)] for n in names if n.startswith(head) and n.endswith(tail)]
        return sorted(int(m) for m in middles if m.isdigit())
