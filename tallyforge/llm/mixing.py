"""Mixing sources to target weights by a low-discrepancy schedule, with built-in functions only.

- A source's *target* is its share of the mix by weight, stopped at ``most`` times its size; the excess is shared again.
- The documents of a source are shuffled by a hash and laid end to end; the line is cut into blocks of equal numbers of words,
  and goes on from its start when its end is reached.
- The *schedule* is a sequence of slots. Slot i has the point i / golden ratio, modulo 1, which is mapped through the
  cumulative targets to a source. Slots are ranked within their source; the slot of rank r takes block r. Golden-ratio points
  are spread so evenly that every stretch of the schedule holds each source in proportion. A source that has its target drops
  out; the last blocks of sources that the points have left a little short are appended. The last block of a source is cut, so
  that the words taken are the target, rounded.

Running totals within a source, which may hold a large share of all rows, are made in two steps: over ranges of the order, and
within a range.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.llm.common import word_count
from tallyforge.plans.durable import materialize

#: Weights of sources in the order of their names, again and again; words of the mix per word given; copies at most.
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2
#: Words of a block.
BLOCK = 2048
#: Rows of a range of a running total, at least; with more rows there are as many ranges as rows in each.
RANGE_ROWS = 2_000
#: Golden-ratio points are multiples of this number modulo 2^31.
_STEP, _POINTS = 1_327_217_885, 1 << 31
_SEED = 20_240_229


def _range_rows(rows: int) -> int:
    """Rows of a range: neither the ranges of a key nor the rows of a range grow faster than the root of all rows."""
    return max(RANGE_ROWS, math.isqrt(rows))


def _running_total(df: DataFrame, key: str, part: Column, order: Sequence[str], value: str, out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows of the key that stand before.

    ``part`` numbers ranges that follow each other in the order and hold about equally many rows, so that no window has more
    rows than a range, or one per range.
    """
    df = df.withColumn("_part", part)
    sums = df.groupBy(key, "_part").agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        F.col(key).alias("_key"), F.col("_part").alias("_at"), F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset")
    )
    within = Window.partitionBy(key, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.withColumn("_within", F.coalesce(F.sum(value).over(within), F.lit(0)))
        .join(offsets, (F.col(key) == F.col("_key")) & (F.col("_part") == F.col("_at")))
        .withColumn(out, F.col("_offset") + F.col("_within"))
        .drop("_part", "_key", "_at", "_offset", "_within")
    )


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """(source, place, source_size, target): one row per source; ``sizes`` has the columns source and size.

    A level is sought at which every source has the smaller of its limit (``most`` times its size) and level times weight. It
    is the same as sharing the excess again until no source is above its limit: sources ordered by limit per weight reach it
    one after the other, and the level that the rest can pay for is known after each. The windows run over one row per source.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    names = Window.orderBy(F.col("source").asc_nulls_last())
    totals = totals.withColumn("place", F.row_number().over(names).cast("bigint"))
    values = F.array(*[F.lit(float(w)) for w in weights])
    rows = totals.withColumn("_weight", F.element_at(values, (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int")))
    rows = rows.withColumn("_limit", F.lit(float(most)) * F.col("source_size"))
    everything = Window.partitionBy(F.lit(0))
    ordered = Window.orderBy(F.col("_limit") / F.col("_weight"), "place")
    rows = rows.withColumn("_mix", F.lit(float(share)) * F.sum("source_size").over(everything))
    paid = F.coalesce(F.sum("_limit").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("_weight").over(ordered.rowsBetween(0, Window.unboundedFollowing))
    rows = rows.withColumn("_level", (F.col("_mix") - paid) / rest)
    # The level that holds is that of the first source in this order that stays below its limit.
    below = F.when(F.col("_level") * F.col("_weight") < F.col("_limit"), F.struct(F.col("_limit") / F.col("_weight"), "place", "_level"))
    rows = rows.withColumn("_holds", F.min(below).over(everything)["_level"])
    target = F.coalesce(F.least(F.col("_limit"), F.col("_holds") * F.col("_weight")), F.col("_limit"))
    return rows.select("source", "place", "source_size", target.alias("target"))


def schedule(targets: DataFrame, block: int) -> DataFrame:
    """(slot, place, rank, words): which source each slot of the mix serves, and the how-manieth of the source it is."""
    spark = targets.sparkSession
    rows = targets.withColumn("_goal", F.round("target").cast("bigint")).where(F.col("_goal") > 0)
    rows = rows.withColumn("blocks", F.ceil(F.col("_goal") / block).cast("bigint"))
    ordered = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.partitionBy(F.lit(0))
    high = F.floor(F.lit(_POINTS) * F.sum("blocks").over(ordered) / F.sum("blocks").over(everything)).cast("bigint")
    rows = rows.withColumn("high", high)
    rows = rows.withColumn("low", F.coalesce(F.lag("high").over(Window.orderBy("place")), F.lit(0)))
    rows = materialize(rows.select("place", "_goal", "blocks", "low", "high"), "mix-sources")
    count, sources = rows.agg(F.coalesce(F.sum("blocks"), F.lit(0)), F.count("place")).head()

    slots = spark.range(count).select(
        F.col("id").alias("slot"), F.pmod(F.pmod(F.col("id"), F.lit(_POINTS)) * F.lit(_STEP), F.lit(_POINTS)).alias("point")
    )
    # Points and sources meet in cells of the line from 0 to 1: an equality join, where a cell holds few sources.
    width = max(1, _POINTS // (4 * max(1, sources)))
    cells = rows.select(
        "place", "_goal", "blocks", "low", "high",
        F.explode(F.sequence(F.floor(F.col("low") / width), F.floor((F.col("high") - 1) / width))).alias("cell"),
    ).where(F.col("high") > F.col("low"))
    served = slots.withColumn("cell", F.floor(F.col("point") / width)).join(cells, "cell")
    served = served.where((F.col("point") >= F.col("low")) & (F.col("point") < F.col("high")))
    served = served.select("slot", "place", "_goal", "blocks", F.lit(1).cast("bigint").alias("_one"))
    ranked = _running_total(served, "place", F.floor(F.col("slot") / _range_rows(count)), ["slot"], "_one", "rank")
    ranked = ranked.where(F.col("rank") < F.col("blocks")).select("slot", "place", "rank", "_goal")
    # What the points have left short.
    had = ranked.groupBy(F.col("place").alias("_of")).agg(F.count(F.lit(1)).alias("_had"))
    short = rows.join(had, F.col("place") == F.col("_of"), "left").withColumn("_had", F.coalesce("_had", F.lit(0)))
    short = short.where(F.col("_had") < F.col("blocks")).select(
        F.lit(count).alias("slot"), "place", F.explode(F.sequence(F.col("_had"), F.col("blocks") - 1)).alias("rank"), "_goal"
    )
    words = F.least(F.lit(block), F.col("_goal") - F.col("rank") * block)
    return ranked.unionByName(short).select("slot", "place", "rank", words.cast("bigint").alias("words"))


def _place(key: Column, spread: Column | None) -> Column:
    """Where a row stands in the shuffle of its source."""
    place = F.xxhash64(key, F.lit(_SEED))
    return place if spread is None else F.when(key.isNull(), F.xxhash64(spread, F.lit(_SEED))).otherwise(place)


def mix(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
    weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: int = MOST, block: int = BLOCK, tag: Sequence[str] = (),
    spread: str | None = None, id_as: str | None = None, tag_as: Sequence[str] | None = None,
) -> DataFrame:
    """(id, size, source_size, target, taken) of every row, and the columns ``tag``.

    ``size`` counts words, 0 for NULL, ``target`` is that of the row's source and ``taken`` the words of the row in the mix,
    at most ``most`` times its size. Sources are ordered by code point with NULL, which is a source too, last. The result
    depends on the rows alone, not on their order; rows with equal id, size and source share one place in the shuffle and so
    may stand in either order. Repeated rows and rows with a NULL id count each; the latter are shuffled by the column
    ``spread`` if it is given, since they would stand at one place otherwise. Empty texts take nothing; an empty table
    gives an empty result; other columns of ``docs`` are not looked at. ``id_as`` and ``tag_as`` name id and tags anew.
    """
    place = _place(F.col(id_col), None if spread is None else F.col(spread))
    sizes = docs.select(
        F.col(id_col).alias("_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
        place.alias("_hash"), *[F.col(c).alias(f"_tag{n}") for n, c in enumerate(tag)],
    )
    sizes = materialize(sizes, "mix-sizes")
    targets = materialize(source_targets(sizes, weights, share, most), "mix-targets")
    slots = schedule(targets, block)

    named = targets.select(F.col("source").alias("_source"), "place", "source_size", "target")
    rows = sizes.join(named, F.col("source").eqNullSafe(F.col("_source")))
    number = sizes.count()
    ranges = max(1, number // _range_rows(number))
    part = F.floor((F.col("_hash") / F.lit(2.0**64) + 0.5) * ranges)
    order = ["_hash", "_id", "size", *[f"_tag{n}" for n in range(len(tag))]]
    rows = _running_total(rows, "place", part, order, "size", "start")
    rows = materialize(rows.withColumn("_row", F.monotonically_increasing_id()), "mix-rows")

    # The line of a source goes on from its start when its end is reached, so a row stands on it once per round.
    rounds = F.sequence(F.lit(0), F.lit(most - 1))
    stands = rows.where(F.col("size") > 0).select("_row", "place", "size", "start", "source_size", F.explode(rounds).alias("_round"))
    stands = stands.withColumn("start", F.col("start") + F.col("_round") * F.col("source_size"))
    first, last = F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block)
    pieces = stands.select("_row", "place", "start", "size", F.explode(F.sequence(first, last)).alias("rank"))
    begin = F.col("rank") * block
    overlap = F.least(begin + F.col("words"), F.col("start") + F.col("size")) - F.greatest(begin, F.col("start"))
    taken = pieces.join(slots, ["place", "rank"]).groupBy("_row").agg(F.sum(F.greatest(F.lit(0), overlap)).alias("taken"))
    out = rows.join(taken, "_row", "left")
    return out.select(
        F.col("_id").alias(id_as or id_col), F.col("size").cast("bigint").alias("size"), F.col("source_size").cast("bigint").alias("source_size"),
        "target", F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"), *[F.col(f"_tag{n}").alias(c) for n, c in enumerate(tag_as or tag)],
    )


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """The mix as whole documents: each row as often as the words taken make it up, rounded.

    Only rows at the end of a source's target are taken in part, so rounding moves less than one document per source. Rows
    without words are left out. Rows with a NULL or a repeated id count each, by their own text and source. All columns stay.
    """
    # Columns go by place, so that names in ``docs`` can't clash with those made here.
    names = [f"_c{n}" for n in range(len(docs.columns))]
    key, source, text = (names[docs.columns.index(c)] for c in (id_col, source_col, text_col))
    # Written with a number and what rows stand in order by, so that copies find their row whatever its id.
    rows = docs.toDF(*names).withColumn("_number", F.monotonically_increasing_id())
    rows = rows.withColumn("_at", _place(F.col(key), F.col(text))).withColumn("_words", word_count(F.col(text)))
    rows = materialize(rows, "mix-docs")
    found = mix(rows, key, source, text, tag=["_number", "_at", source], spread=text, id_as="_id", tag_as=["_number", "_at", "_of"])
    copies = found.where(F.col("size") > 0).select(
        "_of", F.round(F.col("taken") / F.col("size")).cast("int").alias("_copies"),
        F.struct("_at", "_id", F.col("size").alias("_words"), "_number").alias("_stands"),
    )
    # A source is taken from its start round by round, so rows with equally many copies stand together: from where to where
    # is a row per source and number of copies, and no text is shuffled.
    copies = copies.where(F.col("_copies") > 0).groupBy("_of", "_copies").agg(
        F.min("_stands").alias("_from"), F.max("_stands").alias("_to")
    )
    copies = materialize(copies, "mix-copies")
    stands = F.struct("_at", F.col(key).alias("_id"), "_words", "_number")
    within = F.col(source).eqNullSafe(F.col("_of")) & (stands >= F.col("_from")) & (stands <= F.col("_to"))
    out = rows.where(F.col("_words") > 0).join(copies, within)
    out = out.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return out.select(*names).toDF(*docs.columns)
