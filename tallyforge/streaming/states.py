"""State by an arbitrary function: a value per key that each batch's rows are folded into."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: State before and rows of a key; gives the state after, or None to drop it.
Fold = Callable[[tuple | None, pd.DataFrame], tuple | None]

LIVE, SHARD = "live", "shard"


def update_state_by_key(
    rows: DataFrame, keys: list[str], fold: Fold, state: str, shards: int = 1, idle_seconds: int | None = None,
    ts: str = "ts", delay: str = "1 hour",
) -> DataFrame:
    """Keys, the columns of ``state`` (a schema) and ``live``, for every key whose state changed; run it in update mode.

    ``fold`` gets the state (None at first) and some of the key's rows as a frame, as often as the batch has pieces of
    them, in no fixed order. So a key of any size is folded in bounded memory. If it gives None the state is dropped,
    which shows as a row with ``live`` false and NULL state.

    With ``shards`` over 1 a key has that many states, each of a part of its rows by their hash; they have a column
    ``shard`` and are for the reader to merge. So a hot key is work of many tasks. With ``idle_seconds`` a state is dropped
    once the watermark on ``ts`` is that far past the key's newest row; a later row starts anew.

    It needs neither a certain state store nor packages or ports beyond those of Spark's grouped frames.

    The state must be the same in a second run from the same batches, so ``fold`` must not look at clocks or chance.
    """
    places = [*keys, SHARD] if shards > 1 else list(keys)
    if shards > 1:
        rows = rows.withColumn(SHARD, F.pmod(F.xxhash64(*rows.columns), F.lit(shards)).cast("int"))
    if idle_seconds is not None:
        rows = rows.withWatermark(ts, delay)
    value = T._parse_datatype_string(state)
    columns = value.fieldNames()
    newest_name = "newest"
    while newest_name in columns:
        newest_name = f"_{newest_name}"
    kept = T.StructType([*value.fields, T.StructField(newest_name, T.LongType())])
    out = T.StructType([*[rows.schema[c] for c in places], *value.fields, T.StructField(LIVE, T.BooleanType())])

    # Local, so that it travels with the query and executors need not have this module.
    def update(key: tuple, chunks: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        if held.hasTimedOut:
            held.remove()
            yield shown(key, None)
            return
        *before, newest = tuple(held.get) if held.exists else (None,)
        before = after = tuple(before) if held.exists else None
        for chunk in chunks:
            if not len(chunk):
                continue
            after = fold(after, chunk)
            if idle_seconds is not None and chunk[ts].notna().any():
                last = int(pd.Timestamp(chunk[ts].max()).timestamp() * 1000)
                newest = last if newest is None else max(newest, last)
        if after is None:
            if before is None:
                return
            held.remove()
        else:
            held.update((*after, newest))
            if newest is not None:
                held.setTimeoutTimestamp(max(newest + idle_seconds * 1000, held.getCurrentWatermarkMs() + 1))
        yield shown(key, after)

    def shown(key, value):
        # A frame shows a NULL number as NaN.
        filled = {c: None if v is None or v != v else v for c, v in zip(places, key, strict=True)}
        filled |= dict(zip(columns, value or (None,) * len(columns), strict=True))
        return pd.DataFrame({c: pd.Series([v], dtype="object") for c, v in (filled | {LIVE: value is not None}).items()})

    timeout = GroupStateTimeout.NoTimeout if idle_seconds is None else GroupStateTimeout.EventTimeTimeout
    return rows.groupBy(*places).applyInPandasWithState(update, out, kept, "update", timeout)
