"""Removal of repeated byte strings by merging Burrows-Wheeler transforms of shards.

A *window* is ``SPAN`` bytes. Only windows that may repeat are worth sorting, and equal windows must meet:

- The smallest hash among the runs of a window (``RUNS`` bytes each) is its *anchor*, the leftmost of equal ones. Equal windows
  have equal anchors at the same place. The windows that share one anchor in a text follow each other and make up a *passage*;
  each window of the corpus belongs to one passage.
- Anchors that occur once can't repeat. The occurrences of the others are aggregated to distinct passages, each with its first
  occurrence (by id, then place). All windows of later occurrences go. What is left to find out is which windows of a first
  occurrence also stand in other passages of the anchor.
- The distinct passages of an anchor meet in a bucket of bounded size. A bucket is cut into shards, and each shard gets the
  Burrows-Wheeler transform of its passages: the symbols are grams of ``STEP`` bytes, and a passage is ``STEP`` rows of symbols,
  one for each phase, so that every byte starts a suffix. The transforms are merged by refining their interleave: round k
  distributes the interleave of round k - 1 stably by the symbols of the transforms, after which the suffixes of all shards
  stand in the order of their first k symbols, and neighbours are told apart or share k symbols. Suffixes of a shard are never
  compared again. After ``SPAN / STEP`` rounds, each interval of a common prefix is a window that repeats.
- An anchor with more than ``MOST_PASSAGES`` distinct passages doesn't go into one bucket: its passages are cut at anchors of
  longer runs, the last of which are whole windows, and go through the same steps again.

Texts are read again where their bytes are needed: filters of bounded size, which hold what is sought and may let more by, tell
the passages and texts to be sent. Whatever passes them is a true occurrence, so passing more is harmless.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import small_batches, sql_type, texts
from tallyforge.llm.rolling import RANDOM, BitFilter, Counts, Sums, bit_filter, mix
from tallyforge.plans.durable import materialize

SPAN, STEP = 100, 25
#: Bytes of a run, by level. Passages have at most 64 windows (a number of 64 bits tells them), so that runs have 37 at least.
RUNS = (37, 68, SPAN)
#: Distinct passages of an anchor that go into one bucket; bytes of a bucket and of a shard, about.
MOST_PASSAGES, BUCKET, SHARD = 4_096, 500_000, 62_500
#: Bytes of text that are taken together, and bits of a place in a comparison.
_BYTES, _PLACE = 500_000, 26

#: Stretches of texts: (row, place of the first byte, bytes).
_Stretch = tuple[int, int, bytes]


def _stretches(rows: list[bytes]) -> Iterator[_Stretch]:
    """The texts that have a window, long ones in parts that share no window."""
    for n, row in enumerate(rows):
        for start in range(0, len(row) - SPAN + 1, _BYTES):
            yield n, start, row[start : start + _BYTES + SPAN - 1]


def _together(stretches: Iterator[_Stretch]) -> Iterator[list[_Stretch]]:
    some, size = [], 0
    for stretch in stretches:
        some.append(stretch)
        size += len(stretch[2])
        if size >= _BYTES:
            yield some
            some, size = [], 0
    if some:
        yield some


class _Passages:
    """The passages of some stretches: anchor, number of the stretch, place in the text, bytes, and hash."""

    def __init__(self, some: list[_Stretch], run: int):
        self.data = b"".join([part for _, _, part in some])
        sizes = np.array([len(part) for _, _, part in some])
        ends = np.cumsum(sizes)
        sums = Sums(RANDOM[np.frombuffer(self.data, dtype=np.uint8)], "bytes")
        runs = sums.runs(run)
        # Hash and place in one number: the smallest is the smallest hash, the leftmost of equal ones.
        low = np.uint64((1 << _PLACE) - 1)
        least = (runs & ~low) | np.arange(len(runs), dtype=np.uint64)
        reach, wanted = 1, SPAN - run + 1
        while reach < wanted:
            step = min(reach, wanted - reach)
            least = np.minimum(least[: len(least) - step], least[step:])
            reach += step
        fits = np.ones(len(least), dtype=bool)
        for end in ends[:-1].tolist():
            fits[end - SPAN + 1 : end] = False
        windows = np.flatnonzero(fits)
        place = (least[windows] & low).astype(np.int64)
        new = np.concatenate(([True], (place[1:] != place[:-1]) | (np.diff(windows) > 1)))
        self.at = windows[new]
        last = windows[np.concatenate((np.flatnonzero(new)[1:], [len(windows)])) - 1]
        self.size = last + SPAN - self.at
        # The smallest hashes have few leading bits; mixed again, anchors are spread evenly.
        self.anchor = mix(runs[place[new]])
        self.hash = sums.of(self.at, self.at + self.size)
        self.stretch = np.searchsorted(ends, self.at, side="right")
        begins = np.array([begin for _, begin, _ in some]) - (ends - sizes)
        self.place = self.at + begins[self.stretch]
        self.row = np.array([row for row, _, _ in some])[self.stretch]

    def taken(self, n: int) -> bytes:
        return self.data[self.at[n] : self.at[n] + self.size[n]]


def _keys(doc: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Numbers of occurrences, by the number of the text and the place in it."""
    return mix(doc.view(np.uint64) + (place + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


class _Sought:
    """What is sought on a level: anchors of several passages, those that have too many, first occurrences of these passages,
    and the texts that hold one that goes into a bucket, and one that is cut further."""

    def __init__(self, anchors: BitFilter, hot: BitFilter, keys: BitFilter, docs: BitFilter, hot_docs: BitFilter):
        self.anchors, self.hot, self.keys, self.docs, self.hot_docs = anchors, hot, keys, docs, hot_docs

    def of(self, passages: _Passages, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The passages that go into buckets, and those that are cut further."""
        found = np.flatnonzero(self.anchors.passes(passages.anchor))
        found = found[self.keys.passes(_keys(docs[passages.row[found]], passages.place[found]))]
        hot = self.hot.passes(passages.anchor[found])
        return found[~hot], found[hot]


def _only(rows: list[bytes], passes: np.ndarray) -> list[bytes]:
    return [row if good else b"" for row, good in zip(rows, passes.tolist(), strict=True)]


def _on_level(rows: list[bytes], docs: np.ndarray, sought: list[_Sought], level: int) -> Iterator[_Passages]:
    """The passages of a level: of whole texts, or of what the levels above it cut further."""
    for above in sought[:level]:
        rows = _only(rows, above.hot_docs.passes(docs))
    if level == 0:
        for some in _together(_stretches(rows)):
            yield _Passages(some, RUNS[0])
        return

    def cut() -> Iterator[_Stretch]:
        for passages in _on_level(rows, docs, sought, level - 1):
            for n in sought[level - 1].of(passages, docs)[1].tolist():
                yield int(passages.row[n]), int(passages.place[n]), passages.taken(n)

    for some in _together(cut()):
        yield _Passages(some, RUNS[level])


def _occurrences(rows: DataFrame, sought: list[_Sought], level: int, repeated: BitFilter | None) -> DataFrame:
    """(id, doc, anchor, passage, place, size) of the passages of a level, of those with an anchor that ``repeated`` passes."""
    shared = rows.sparkSession.sparkContext.broadcast((sought, repeated))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sought, repeated = shared.value
        for batch in batches:
            docs = batch.column(1).to_numpy()
            for p in _on_level(texts(batch.column(2)), docs, sought, level):
                kept = np.arange(len(p.at)) if repeated is None else np.flatnonzero(repeated.passes(p.anchor))
                row = pa.array(p.row[kept])
                columns = [
                    batch.column(0).take(row), batch.column(1).take(row), pa.array(p.anchor[kept].view(np.int64)),
                    pa.array(p.hash[kept].view(np.int64)), pa.array(p.place[kept]), pa.array(p.size[kept].astype(np.int16)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["id", "doc", "anchor", "passage", "place", "size"])

    return rows.mapInArrow(find, f"id {sql_type(rows, 'id')}, doc bigint, anchor bigint, passage bigint, place bigint, size smallint")


def _repeated_anchors(rows: DataFrame) -> BitFilter:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counts()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c) for c in counts.take()], ["anchor", "n"])

        for batch in batches:
            for some in _together(_stretches(texts(batch.column(0)))):
                counts.add(_Passages(some, RUNS[0]).anchor)
                if counts.due():
                    yield out()
        yield out()

    counted = rows.select("text").mapInArrow(count, "anchor bigint, n bigint").groupBy("anchor").agg(F.sum("n").alias("n"))
    return bit_filter(materialize(counted.where(F.col("n") > 1).select("anchor"), "bwt-anchors"), "anchor")


def _seek(firsts: DataFrame) -> tuple[_Sought, int, bool]:
    """What is sought among distinct passages (anchor, doc, place), how many they are, and whether anchors have too many."""
    kinds = firsts.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).where(F.col("kinds") > 1)
    kinds = materialize(kinds, "bwt-kinds")
    anchors = bit_filter(kinds, "anchor")
    too_many = kinds.where(F.col("kinds") > MOST_PASSAGES)
    passages = kinds.agg(F.coalesce(F.sum("kinds"), F.lit(0))).head()[0]

    hot = bit_filter(too_many, "anchor")

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            anchor, doc, place = (c.to_numpy() for c in batch.columns)
            kept = anchors.passes(anchor)
            columns = [pa.array(_keys(doc[kept], place[kept]).view(np.int64)), pa.array(doc[kept]), pa.array(hot.passes(anchor[kept]))]
            yield pa.RecordBatch.from_arrays(columns, ["key", "doc", "hot"])

    found = materialize(firsts.select("anchor", "doc", "place").mapInArrow(keys, "key bigint, doc bigint, hot boolean"), "bwt-keys")
    docs = [bit_filter(materialize(found.where(F.col("hot") == is_hot).select("doc").distinct(), "bwt-docs"), "doc") for is_hot in (False, True)]
    return _Sought(anchors, hot, bit_filter(found.select("key"), "key"), *docs), passages, not too_many.isEmpty()


def _bytes(rows: DataFrame, sought: list[_Sought], level: int) -> DataFrame:
    """(anchor, id, doc, place, text) of the first occurrences of the passages that go into buckets."""
    shared = rows.sparkSession.sparkContext.broadcast(sought)

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sought, sent = shared.value, set()
        for batch in batches:
            docs = batch.column(1).to_numpy()
            for p in _on_level(_only(texts(batch.column(2)), sought[level].docs.passes(docs)), docs, sought, level):
                kept = sought[level].of(p, docs)[0]
                # Rows that are equal are one; a task sends their passages once.
                places = zip(docs[p.row[kept]].tolist(), p.place[kept].tolist(), strict=True)
                kept = kept[[not (place in sent or sent.add(place)) for place in places]]
                row = pa.array(p.row[kept])
                columns = [
                    pa.array(p.anchor[kept].view(np.int64)), batch.column(0).take(row), batch.column(1).take(row), pa.array(p.place[kept]),
                    pa.array([p.taken(n) for n in kept.tolist()], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["anchor", "id", "doc", "place", "text"])

    return rows.mapInArrow(take, f"anchor bigint, id {sql_type(rows, 'id')}, doc bigint, place bigint, text binary")


class ShardTransform:
    """The Burrows-Wheeler transform of a shard: for each suffix in order, the symbol before it and the place it starts at.

    Symbol 0 stands before the first suffix of a phase. The empty suffixes, one per phase, come first, in the order of places.
    """

    def __init__(self, symbols: np.ndarray, filled: np.ndarray, fresh: np.ndarray):
        """``symbols`` has the gram at each place (from 1 on), ``filled`` tells whether there is one, ``fresh`` whether none is before."""
        size = len(symbols)
        self.empty = int((~filled).sum())
        rank = np.where(filled, symbols + self.empty, 0)
        rank[~filled] = np.arange(self.empty)
        reach = STEP
        # Twice as many symbols are compared in every round; ends are unlike each other, so that all suffixes are told apart.
        while True:
            ahead = np.zeros(size, dtype=np.int64)
            ahead[: max(0, size - reach)] = rank[reach:]
            # A suffix that ends before is unlike all others already.
            _, rank = np.unique((rank << 31) | ahead, return_inverse=True)
            if rank.max() == size - 1:
                break
            reach *= 2
        self.places = np.empty(size, dtype=np.int64)
        self.places[rank] = np.arange(size)
        self.before = np.where(fresh, 0, np.concatenate((np.zeros(STEP, dtype=np.int64), symbols[:-STEP])))[self.places]


def merge_transforms(shards: list[ShardTransform], starts: list[int], rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, interval) of all suffixes, merged: equal intervals share their first ``rounds`` symbols; all shards' places count on."""
    places = np.concatenate([shard.places + start for shard, start in zip(shards, starts, strict=True)])
    before = np.concatenate([shard.before for shard in shards])
    of_shard = np.repeat(np.arange(len(shards), dtype=np.uint16), [len(shard.places) for shard in shards])
    empties = np.repeat(np.arange(len(shards), dtype=np.uint16), [shard.empty for shard in shards])
    interleave, interval = of_shard, np.zeros(len(places), dtype=np.int64)
    for _ in range(rounds):
        # The how-manieth of the interleave that names a shard is the how-manieth of its transform.
        named = np.argsort(interleave, kind="stable")
        symbol = np.empty(len(places), dtype=np.int64)
        symbol[named] = before
        moves = np.flatnonzero(symbol)
        # Stable by symbol: symbol and position in one number.
        order = np.sort((symbol[moves] << 32) | moves) & ((1 << 32) - 1)
        parts = np.ones(len(order), dtype=bool)
        parts[1:] = (symbol[order[1:]] != symbol[order[:-1]]) | (interval[order[1:]] != interval[order[:-1]])
        interleave = np.concatenate((empties, interleave[order]))
        interval = np.concatenate((np.arange(len(empties)), len(empties) + np.cumsum(parts) - 1))
    named = np.argsort(interleave, kind="stable")
    merged = np.empty(len(places), dtype=np.int64)
    merged[named] = places
    return merged, interval


def repeated_windows(passages: list[bytes]) -> np.ndarray:
    """Per passage, the bits of its windows that also stand in an earlier one."""
    sizes = np.array([len(p) for p in passages])
    data = np.frombuffer(b"".join(passages), dtype=np.uint8)
    grams = Sums(RANDOM[data], "bytes").runs(STEP)
    # A place per byte, and one more behind each passage: there are STEP places without a gram, one for each phase.
    begins = np.concatenate(([0], np.cumsum(sizes + 1)))
    of = np.repeat(np.arange(len(sizes)), sizes + 1)
    offset = np.arange(begins[-1]) - begins[of]
    filled = offset + STEP <= sizes[of]
    symbols = np.zeros(begins[-1], dtype=np.int64)
    _, number = np.unique(grams[np.arange(begins[-1])[filled] - of[filled]], return_inverse=True)
    symbols[filled] = number + 1
    shards, starts, first = [], [], 0
    for n in range(len(sizes)):
        if begins[n + 1] - begins[first] >= SHARD or n + 1 == len(sizes):
            some = slice(begins[first], begins[n + 1])
            shards.append(ShardTransform(symbols[some], filled[some], offset[some] < STEP))
            starts.append(int(begins[first]))
            first = n + 1
    places, interval = merge_transforms(shards, starts, SPAN // STEP)
    edges = np.flatnonzero(np.concatenate(([True], interval[1:] != interval[:-1])))
    later = places != np.minimum.reduceat(places, edges)[interval_numbers(edges, len(places))]
    found = places[later]
    masks = np.zeros(len(sizes), dtype=np.uint64)
    np.bitwise_or.at(masks, of[found], np.uint64(1) << offset[found].astype(np.uint64))
    return masks


def interval_numbers(edges: np.ndarray, size: int) -> np.ndarray:
    """The number of the interval of each place, given where intervals begin."""
    return np.repeat(np.arange(len(edges)), np.diff(np.concatenate((edges, [size]))))


def _search_bucket(table: pa.Table) -> pa.Table:
    """(id, doc, place, mask) of the passages of a bucket."""
    order = pc.sort_indices(table, sort_keys=[(c, "ascending") for c in ("id", "doc", "place")], null_placement="at_start")
    table = table.take(order)
    doc, place = table.column("doc").to_numpy(), table.column("place").to_numpy()
    table = table.filter(pa.array(np.concatenate(([True], (doc[1:] != doc[:-1]) | (place[1:] != place[:-1])))))
    masks = repeated_windows(table.column("text").to_pylist())
    return table.select(["id", "doc", "place"]).append_column("mask", pa.array(masks.view(np.int64)))


def _cut_text(text: bytes, place: np.ndarray, size: np.ndarray, mask: np.ndarray) -> tuple[int, int, bytes]:
    """(bytes removed, maximal runs of them, what stays) of a text; a mask of 0 stands for all windows of a passage."""
    change = np.zeros(len(text) + 1, dtype=np.int32)
    whole = mask == 0
    np.add.at(change, place[whole], 1)
    np.add.at(change, place[whole] + size[whole], -1)
    row, bit = np.unpackbits(mask[~whole].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").nonzero()
    windows = place[~whole][row] + bit
    np.add.at(change, windows, 1)
    np.add.at(change, windows + SPAN, -1)
    gone = np.cumsum(change[:-1]) > 0
    runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if len(gone) else 0
    return int(gone.sum()), runs, np.frombuffer(text, dtype=np.uint8)[~gone].tobytes()


def remove_repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, kept) of every row; ``kept`` has the bytes that stay.

    A byte of the UTF-8 text is removed if a string of 100 bytes that covers it also starts earlier: in a row of a smaller id, or
    in the same row at an earlier place, as the texts are given. ``n_spans`` counts maximal runs of removed bytes. NULL ids are
    the smallest; rows of one id are ordered by a hash of their text, and of equal rows one counts as the first. NULL and empty
    texts, and those of fewer than 100 bytes, lose nothing. An empty table gives an empty result; other columns are not looked at.
    """
    spark = docs.sparkSession
    small_batches(spark)
    kind = sql_type(docs, id_col)
    # A text is known by its id and a hash of both, which are the same in every scan.
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(id_col, text_col).alias("doc"), F.col(text_col).alias("text"))

    repeated = _repeated_anchors(rows)
    sought: list[_Sought] = []
    marks = None
    for level in range(len(RUNS)):
        found = materialize(_occurrences(rows, sought, level, repeated if level == 0 else None), "bwt-occurrences")
        one = F.min(F.struct("id", "doc", "place")).alias("one")
        firsts = materialize(found.groupBy("anchor", "passage").agg(one).select("anchor", "one.*"), "bwt-firsts")
        seek, passages, more = _seek(firsts)
        sought.append(seek)
        none, here = F.lit(None).cast("bigint").alias("mask"), F.lit(level).alias("level")
        own = found.select("id", "doc", here, "place", "size", none)
        own = own.unionByName(firsts.select("id", "doc", here, "place", F.lit(0).cast("smallint").alias("size"), none))
        if passages:
            size = passages * (SPAN + (SPAN - RUNS[level]) // 2)
            buckets = max(spark.sparkContext.defaultParallelism, math.ceil(size / BUCKET))
            dealt = _bytes(rows, sought, level).withColumn("bucket", F.pmod(F.xxhash64("anchor"), F.lit(buckets)))
            searched = dealt.groupBy("bucket").applyInArrow(_search_bucket, f"id {kind}, doc bigint, place bigint, mask bigint")
            searched = materialize(searched.where(F.col("mask") != 0), "bwt-masks")
            own = own.unionByName(searched.select("id", "doc", here, "place", F.lit(-1).cast("smallint").alias("size"), "mask"))
        marks = own if marks is None else marks.unionByName(own)
        if not more:
            break

    # However often a text is repeated under one id, its occurrences are those of one. First occurrences keep what no mask names.
    lost = marks.groupBy("id", "doc", "level", "place").agg(
        F.max("size").alias("size"), F.min("size").alias("first"), F.max("mask").alias("mask"), F.count(F.when(F.col("size") > 0, 1)).alias("met")
    ).where((F.col("first") > 0) | F.col("mask").isNotNull() | (F.col("met") > 1))
    goes = F.when((F.col("first") > 0) | F.col("mask").isNotNull(), F.struct("place", "size", F.coalesce("mask", F.lit(0)).alias("mask")))
    marked = lost.groupBy(F.col("id").alias("_id"), F.col("doc").alias("_doc")).agg(F.collect_list(goes).alias("marks"))
    marked = materialize(marked, "bwt-marks")
    shared = spark.sparkContext.broadcast(bit_filter(marked, "_doc"))
    schema = f"`{id_col}` {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"

    def out(ids: pa.Array, found: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
        sizes, gone, spans, kept = ([f[n] for f in found] for n in range(4))
        digests = [hashlib.sha256(k).hexdigest() for k in kept]
        numbers = [pa.array(n, pa.int64()) for n in (sizes, gone, spans)]
        return pa.RecordBatch.from_arrays([ids, *numbers, pa.array(digests, pa.string()), pa.array(kept, pa.binary())],
                                          [id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(~shared.value.passes(batch.column(1).to_numpy())))
            yield out(batch.column(0), [(len(text), 0, 0, text) for text in texts(batch.column(2))])

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(shared.value.passes(batch.column(1).to_numpy())))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            again, size, marks = batch.column(3).to_pylist(), batch.column(4).to_pylist(), batch.column(2)
            for n, text in enumerate(texts(batch.column(1))):
                if again[n] and size[n] >= SPAN:
                    found.append((size[n], size[n], 1, b""))
                elif again[n] or not marks[n].is_valid or not len(marks[n]):
                    found.append((len(text), 0, 0, text))
                else:
                    place, length, mask = (c.to_numpy() for c in marks[n].values.flatten())
                    found.append((len(text), *_cut_text(text, place, length.astype(np.int64), mask)))
            yield out(batch.column(0), found)

    # Only texts that may lose something are sent to their marks; equal rows as one.
    sent = rows.mapInArrow(passed, f"id {kind}, doc bigint, text string")
    sent = sent.groupBy("id", "doc").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("rows"))
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("doc") == F.col("_doc"))
    met = sent.join(marked, same, "left").select("id", "text", "marks", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("rows"))).alias("nth"))
    again, size = F.col("nth") > 1, F.coalesce(F.octet_length("text"), F.lit(0))
    met = met.select("id", F.when(~again | (size < SPAN), F.col("text")).alias("text"), F.when(~again, F.col("marks")).alias("marks"), again.alias("again"), size.alias("size"))
    return rows.mapInArrow(whole, schema).unionByName(met.mapInArrow(cut, schema))
