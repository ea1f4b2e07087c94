"""Batch writers and the keyed stream sinks.

The stream sinks write one folder per micro-batch and replace it when the batch is replayed, so a restart never counts a
batch twice. Reading merges the batches; folding replaces them by a snapshot (`stores`).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import IntegralType

from tallyforge.functions.scalars import composite_key
from tallyforge.sources.stores import BatchStore

# A counter lives two days after its last update; a put names its time after an @.
COUNTER_DAYS = 2
TIME_MARK = "@"
#: Members per word of a set.
WORD_BITS = 64


def sink_text(df: DataFrame, path: str, separator: str = ",") -> None:
    """All columns as text lines."""
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    df.select(F.concat_ws(separator, *texts).alias("value")).write.text(path)


def sink_tsv(df: DataFrame, path: str) -> None:
    df.write.csv(path, sep="\t", quote="", escape="")


def sink_print(stream: DataFrame, rows: int = 10, mode: str = "append") -> DataStreamWriter:
    """The first rows of every batch on the console.

    Every batch is worked off whole and once, but a task hands over its first rows only: Spark's own console format sends all
    rows of a batch to the driver.
    """

    def show(batch: DataFrame, batch_id: int) -> None:
        place = "_place"
        while place in batch.columns:
            place = f"_{place}"
        placed = batch.withColumn(place, F.monotonically_increasing_id())
        print(f"{'-' * 43}\nBatch: {batch_id}\n{'-' * 43}")
        # One more than is shown, so that it is said if there are more.
        placed.orderBy(place).limit(rows + 1).drop(place).show(rows)

    return stream.writeStream.outputMode(mode).foreachBatch(show)


def _writer(
    path: str, schema: str, to_rows: Callable[[DataFrame], DataFrame], merge: Callable[[DataFrame], DataFrame],
    fold_every: int | None,
) -> Callable[[DataFrame, int], None]:
    """Store what ``to_rows`` makes of each batch; fold after every ``fold_every`` batches."""

    def write(batch: DataFrame, batch_id: int) -> None:
        store = BatchStore(batch.sparkSession, path, schema)
        store.put(to_rows(batch), batch_id)
        if fold_every and (batch_id + 1) % fold_every == 0:
            store.fold(merge, batch_id)

    return write


_COUNTER_ROWS = "key STRING, cnt BIGINT, batch_ts TIMESTAMP"
_PUT_ROWS = "key STRING, column STRING, value STRING"
_SET_ROWS = "key STRING, column STRING, word BIGINT, text STRING, bits BIGINT"


def sink_counter_upsert(
    path: str, key_columns: Sequence[str], count: str = "cnt", batch_time: Column | None = None,
    fold_every: int | None = None,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer that adds each group's count to the counter named by the joined key columns.

    ``batch_time`` is the time of the batch (default: now); a counter expires two days after its last one. With
    ``fold_every``, a snapshot of the live counters takes the place of their batches after so many batches.
    """
    when = F.current_timestamp() if batch_time is None else batch_time

    def sums(batch: DataFrame) -> DataFrame:
        keyed = batch.select(composite_key(key_columns).alias("key"), F.col(count).alias("n"), when.alias("at"))
        return keyed.groupBy("key").agg(F.sum("n").cast("bigint").alias("cnt"), F.max("at").alias("batch_ts"))

    return _writer(path, _COUNTER_ROWS, sums, _unexpired, fold_every)


def _life() -> Column:
    return F.expr(f"INTERVAL {COUNTER_DAYS} DAYS")


def _since_last_gap(rows: DataFrame) -> DataFrame:
    """Per key, the sum of the batches since its last gap of over two days, and the time of its last batch."""
    # One row per key and batch, however many events were behind it, so a group is as long as the number of batches.
    in_order = Window.partitionBy("key").orderBy("batch_ts", "batch_id")
    last = Window.partitionBy("key").orderBy("batch_ts", "batch_id").rowsBetween(0, Window.unboundedFollowing)
    starts = F.lag("batch_ts").over(in_order)
    marked = rows.withColumn("restarts", (F.col("batch_ts") > starts + _life()).cast("int"))
    restart = F.coalesce("restarts", F.lit(0))
    later = marked.withColumn("later_restarts", F.sum(restart).over(last) - restart)
    return later.where("later_restarts = 0").groupBy("key").agg(
        F.sum("cnt").cast("bigint").alias("cnt"), F.max("batch_ts").alias("batch_ts")
    )


def _unexpired(rows: DataFrame) -> DataFrame:
    """Counters that a later batch may still add to, if times of batches do not go back; all others start anew."""
    oldest = rows.agg(F.max("batch_ts") - _life()).scalar()
    return _since_last_gap(rows).where(F.col("batch_ts") >= oldest)


def fold_counters(spark: SparkSession, path: str, upto: int | None = None) -> None:
    """Fold the batches up to a number (default: the newest) into a snapshot of the live counters.

    Whoever is past two days at the newest of these batches is left out, and would start anew in any case as long as the
    times of later batches are no earlier.
    """
    BatchStore(spark, path, _COUNTER_ROWS).fold(_unexpired, upto)


def read_counters(spark: SparkSession, path: str, now: Column | None = None) -> DataFrame:
    """Current counters: per key, the batches since its last gap of over two days, if it has not expired by ``now``."""
    now = F.current_timestamp() if now is None else now
    live = _since_last_gap(BatchStore(spark, path, _COUNTER_ROWS).rows()).withColumnRenamed("batch_ts", "updated")
    return live.where(F.col("updated") + _life() > now).select("key", "cnt", "updated")


def put_key(key: Column | str, time: Column | str | None = None) -> Column:
    """Row key of a put, with its time after an ``@`` if there is one."""
    key = F.col(key) if isinstance(key, str) else key
    if time is None:
        return key
    time = F.col(time) if isinstance(time, str) else time
    return F.concat(key, F.lit(TIME_MARK), time)


def sink_keyed_put(
    path: str, key: Column, value: Column, column: str, fold_every: int | None = None
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer that puts one named column under a row key; the last batch wins."""

    def puts(batch: DataFrame) -> DataFrame:
        named = batch.select(key.alias("key"), F.lit(column).alias("column"), value.cast("string").alias("value"))
        # Within one batch the largest value wins, so that a replay gives the same answer.
        return named.groupBy("key", "column").agg(F.max("value").alias("value"))

    return _writer(path, _PUT_ROWS, puts, _last_puts, fold_every)


def _last_puts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("key", "column").agg(F.max_by("value", "batch_id").alias("value"))


def fold_puts(spark: SparkSession, path: str, upto: int | None = None) -> None:
    """Fold the batches up to a number (default: the newest) into a snapshot of the latest values."""
    BatchStore(spark, path, _PUT_ROWS).fold(_last_puts, upto)


def read_puts(spark: SparkSession, path: str) -> DataFrame:
    """The latest value of every row key and column."""
    return _last_puts(BatchStore(spark, path, _PUT_ROWS).rows())


def sink_keyed_set(
    path: str, key: Column, member: Column, column: str, fold_every: int | None = None
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer that adds members to the set under a row key and column; batches merge exactly.

    Whole numbers are kept as bits of words of 64, so a dense set takes one row per 64 members and a sparse one no more
    rows than members; other types are kept as text, one row per member. NULL is no member.
    """

    def members(batch: DataFrame) -> DataFrame:
        named = batch.select(key.alias("key"), F.lit(column).alias("column"), member.alias("m")).where("m IS NOT NULL")
        if isinstance(named.schema["m"].dataType, IntegralType):
            number = F.col("m").cast("bigint")
            place = F.pmod(number, F.lit(WORD_BITS)).cast("int")
            word, text = F.shiftright(number, 6), F.lit(None).cast("string")
            bits = F.call_function("shiftleft", F.lit(1).cast("bigint"), place)
        else:
            word, bits, text = F.lit(None).cast("bigint"), F.lit(None).cast("bigint"), F.col("m").cast("string")
        rows = named.select("key", "column", word.alias("word"), text.alias("text"), bits.alias("bits"))
        return _merged_sets(rows)

    return _writer(path, _SET_ROWS, members, _merged_sets, fold_every)


def _merged_sets(rows: DataFrame) -> DataFrame:
    return rows.groupBy("key", "column", "word", "text").agg(F.bit_or("bits").alias("bits"))


def fold_sets(spark: SparkSession, path: str, upto: int | None = None) -> None:
    """Fold the batches up to a number (default: the newest) into a snapshot of the sets."""
    BatchStore(spark, path, _SET_ROWS).fold(_merged_sets, upto)


def read_set_sizes(spark: SparkSession, path: str) -> DataFrame:
    """The number of distinct members of every row key and column over all batches, as the value of a put."""
    words = _merged_sets(BatchStore(spark, path, _SET_ROWS).rows())
    size = F.sum(F.when(F.col("text").isNull(), F.bit_count("bits")).otherwise(1))
    return words.groupBy("key", "column").agg(size.cast("string").alias("value"))
