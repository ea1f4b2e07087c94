"""Helpers that several operators of the subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.plans.durable import materialize

#: Rows of (id, hash) that are sent to every task, at most.
BROADCAST_ROWS = 200_000
#: A word is a run of characters other than these: the space and U+0009 to U+000D. ``bytes.split()`` cuts at the same.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def texts(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column; NULL counts as empty."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


def word_count(text: Column) -> Column:
    """Number of words of a text, by built-in functions; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("bigint")


def small_batches(spark: SparkSession, rows: int = 500) -> None:
    """Send rows to Python in batches of at most ``rows``, so that a batch of very long texts fits in memory."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) > rows or int(spark.conf.get(name)) <= 0:
        spark.conf.set(name, str(rows))


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """Apply a function to every Arrow batch; empty batches are passed over. Made for rows that hold whole texts."""
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield function(batch)

    return df.mapInArrow(run, schema)


def sql_type(df: DataFrame, column: str) -> str:
    """The type of a column as it is written in a schema string."""
    return df.schema[column].dataType.simpleString()


def without(docs: DataFrame, gone: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs`` whose id and ``xxhash64`` of the text are not in ``gone`` (id, th); rows with a NULL id stay.

    Few rows that go are sent to every task, so that texts are not shuffled; from ``BROADCAST_ROWS`` on it is a shuffled join.
    """
    gone = materialize(gone.select(F.col("id").alias("_gone_id"), F.col("th").alias("_gone_th")), "gone")
    if gone.count() <= BROADCAST_ROWS:
        gone = F.broadcast(gone)
    same = (docs[id_col] == F.col("_gone_id")) & (F.xxhash64(docs[text_col]) == F.col("_gone_th"))
    return docs.join(gone, same, "left_anti").select(docs.columns)
