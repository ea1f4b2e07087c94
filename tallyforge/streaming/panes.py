"""Sliding windows from panes: sums per common step of length and slide, each event counted once.

The stream keeps one row of state per pane and key, however many windows overlap. A window is made of its panes by adding
those that enter and taking off those that leave, so its measures must be exact under subtraction: whole numbers or
decimals.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.streaming.jobs import COUNT_SLIDE, COUNT_WINDOW

_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}
#: Windows of one key that are one running total; a key's time is cut into stretches of so many.
STRETCH = 4096


def seconds(text: str) -> int:
    """The length of a fixed interval like ``30 seconds``."""
    number, unit = text.split()
    return int(number) * _SECONDS[unit.rstrip("s")]


def pane_sums(
    events: DataFrame, *keys: str, sums: dict[str, Column] | None = None, ts: str = "ts", delay: str = "1 hour",
    length: str = COUNT_WINDOW, slide: str = COUNT_SLIDE,
) -> DataFrame:
    """Per pane (its start) and key, the number of events ``cnt`` and the ``sums``; run it in update mode.

    A pane ends before the last of its windows, and so stays open longer by the difference: an event that any of its
    windows would still take is taken, and then by all of them. Events without a time are in no pane.
    """
    step = math.gcd(seconds(length), seconds(slide))
    held = f"{delay} {seconds(length) - step} seconds"
    pane = F.window(ts, f"{step} seconds").alias("window")
    measures = [F.sum(column).alias(name) for name, column in (sums or {}).items()]
    counted = events.withWatermark(ts, held).groupBy(pane, *keys).agg(F.count(F.lit(1)).alias("cnt"), *measures)
    return counted.select(F.col("window.start").alias("pane"), *keys, "cnt", *(sums or {}))


def windows_of_panes(
    panes: DataFrame, *keys: str, length: str = COUNT_WINDOW, slide: str = COUNT_SLIDE
) -> DataFrame:
    """``start``, ``end``, keys and measures of every window that holds an event, from one row per pane and key.

    All other columns are measures; a sum of nothing is 0.
    """
    measures = [c for c in panes.columns if c not in ("pane", *keys)]
    for name in measures:
        if not isinstance(panes.schema[name].dataType, (T.IntegralType, T.DecimalType)):
            raise TypeError(f"{name} can't be taken off again exactly")
    size, step = seconds(length), seconds(slide)
    at = F.unix_timestamp("pane")
    # Windows are numbered: w lasts from w * step for size seconds. A pane is in windows first to last.
    ranges = panes.select(
        *keys, _floor_div(at - size, step).alias("_first"), _floor_div(at, step).alias("_last"), *measures
    ).where("_first < _last")
    cut = ranges.withColumn("_first", F.col("_first") + 1).withColumn(
        "_stretch",
        F.explode(F.sequence(_floor_div(F.col("_first"), STRETCH), _floor_div(F.col("_last"), STRETCH))),
    )
    enters = F.greatest("_first", F.col("_stretch") * STRETCH)
    leaves = F.least("_last", F.col("_stretch") * STRETCH + (STRETCH - 1)) + 1
    signed = [
        F.struct(place.alias("_at"), F.lit(sign).cast("bigint").alias("_panes"),
                 *[(F.coalesce(F.col(m), F.lit(0)) * sign).alias(m) for m in measures])
        for place, sign in ((enters, 1), (leaves, -1))
    ]
    changes = cut.select(*keys, "_stretch", F.inline(F.array(*signed))).groupBy(*keys, "_stretch", "_at").agg(
        *[F.sum(c).alias(c) for c in ("_panes", *measures)]
    )
    in_order = Window.partitionBy(*keys, "_stretch").orderBy("_at")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = changes.select(
        *keys, "_at", F.lead("_at").over(in_order).alias("_until"),
        *[F.sum(c).over(so_far).cast(changes.schema[c].dataType).alias(c) for c in ("_panes", *measures)],
    ).where("_panes > 0")
    numbered = totals.withColumn("_window", F.explode(F.sequence(F.col("_at"), F.col("_until") - 1)))
    start = F.col("_window") * step
    return numbered.select(
        F.timestamp_seconds(start).alias("start"), F.timestamp_seconds(start + size).alias("end"), *keys, *measures
    )


def _floor_div(number: Column, by: int) -> Column:
    """Whole division that rounds down, below zero as well."""
    return F.call_function("div", number - F.pmod(number, F.lit(by)), F.lit(by))
