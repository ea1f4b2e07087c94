"""Removal of passages that repeat, by suffix automata of reference shards.

The reference is the corpus itself, so its automata can be neither broadcast whole nor met by every document: that would grow
with the square of the corpus. They are cut into shards by content, and passages are sent to the shard that can hold their
repeats:

- A *window* is ``WINDOW`` consecutive words. The smallest hash among its runs of ``RUN`` words is its *anchor*, the leftmost
  of equal ones. Equal windows have equal anchors at the same place, so repeats are only to be sought under one anchor.
- The windows that share one anchor in a text follow each other; together they are a *passage*. Each window of the corpus
  belongs to exactly one passage, so that counting passages counts no window twice.
- Passages whose anchor occurs once can't repeat. A filter of bits, of bounded size, tells nearly all of them; what it lets by
  is counted exactly.
- Equal passages are counted and go on as one. If all passages of an anchor are equal, all of their windows repeat. Otherwise
  they go to the shard of the anchor: a suffix automaton is built of all its passages, each state with its number of
  occurrences, and the passages are streamed through it for matching statistics, the longest ending at each word that occurs
  at least twice. Where it reaches ``WINDOW`` words, these words are removed.
- An anchor with more than ``MOST_PASSAGES`` different passages (the edges of a passage that very many documents share) isn't
  gathered: its windows are dealt out by their own hash and counted, which spreads them evenly.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import small_batches, sql_type, texts
from tallyforge.llm.rolling import BitFilter, bit_filter
from tallyforge.plans.durable import materialize

WINDOW, RUN = 35, 16
#: Different passages of an anchor that are gathered, and words of a shard, about.
MOST_PASSAGES, SHARD_WORDS = 3_000, 150_000
#: Bytes of text that are taken together, and bits of a word's place in a comparison.
_BYTES, _PLACE = 4_000_000, 26
_ODD = np.uint64(0x9E3779B97F4A7C15)
_RANDOM = np.random.default_rng(35).integers(1, 1 << 63, 256, dtype=np.uint64)
#: Odd bases of the sums below, and their inverses modulo 2^64.
_P, _Q = 0xD1342543DE82EF95, 0xAF251AF3B0F025B5
_P_INVERSE, _Q_INVERSE = pow(_P, -1, 1 << 64), pow(_Q, -1, 1 << 64)
_SPACE = np.array([chr(b) in " \t\n\v\f\r" for b in range(256)])


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class _Sums:
    """Hashes of any stretch of a row of numbers, from running sums of numbers times powers of an odd base."""

    def __init__(self, values: np.ndarray, base: int, inverse: int):
        powers = np.full(len(values) + 1, base, dtype=np.uint64)
        back = np.full(len(values) + 1, inverse, dtype=np.uint64)
        powers[0] = back[0] = 1
        self._back = np.cumprod(back, dtype=np.uint64)
        terms = np.empty(len(values) + 1, dtype=np.uint64)
        terms[0], terms[1:] = 0, values * np.cumprod(powers, dtype=np.uint64)[:-1]
        self._sums = np.cumsum(terms, dtype=np.uint64)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self._sums[end] - self._sums[start]) * self._back[start] + (end - start).astype(np.uint64) * _ODD)


class _Words:
    """The words of some texts, laid end to end: hashes of each, and which words each text has."""

    def __init__(self, rows: list[bytes]):
        data = np.frombuffer(b" ".join([*rows, b""]), dtype=np.uint8)
        solid = np.concatenate(([False], ~_SPACE[data], [False]))
        edges = np.flatnonzero(solid[1:] != solid[:-1])
        starts, ends = edges[::2], edges[1::2]
        text_ends = np.cumsum([len(row) + 1 for row in rows])
        self.last = np.searchsorted(starts, text_ends)  # per text, the end of its words
        self.first = np.concatenate(([0], self.last[:-1]))
        hashes = _Sums(_RANDOM[data], _P, _P_INVERSE).of(starts, ends) if len(starts) else np.empty(0, dtype=np.uint64)
        self.sums = _Sums(hashes, _Q, _Q_INVERSE)
        self.count = len(starts)

    def passages(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, text, first word, words) of each passage; the first word is counted over all texts."""
        inner = WINDOW - RUN
        of = np.repeat(np.arange(len(self.first)), self.last - self.first)
        windows = np.flatnonzero(np.arange(self.count) + WINDOW <= self.last[of]) if self.count else np.empty(0, dtype=int)
        if not len(windows):
            none = np.empty(0, dtype=np.int64)
            return none.astype(np.uint64), none, none, none
        starts = np.arange(self.count - RUN + 1)
        runs = self.sums.of(starts, starts + RUN)
        # Hash and place in one number: the smallest is the smallest hash, the leftmost of equal ones.
        low = np.uint64((1 << _PLACE) - 1)
        least = (runs & ~low) | (starts.astype(np.uint64) & low)
        reach = 1
        while reach < inner + 1:
            step = min(reach, inner + 1 - reach)
            least = np.minimum(least[: len(least) - step], least[step:])
            reach += step
        place = least[windows] & low
        new = np.concatenate(([True], (place[1:] != place[:-1]) | (of[windows[1:]] != of[windows[:-1]]) | (np.diff(windows) > 1)))
        first = windows[new]
        after = np.concatenate((np.flatnonzero(new)[1:], [len(windows)])) - 1
        anchor_at = first + ((place[new].astype(np.int64) - first) & int(low))
        # The smallest hashes have few leading bits; mixed again, anchors are spread evenly over the filter.
        return _mix(runs[anchor_at]), of[first], first, windows[after] + WINDOW - first


def _slices(rows: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    start, size = 0, 0
    for n, row in enumerate(rows):
        size += len(row)
        if size >= _BYTES or n + 1 == len(rows):
            yield start, rows[start : n + 1]
            start, size = n + 1, 0


class SuffixAutomaton:
    """All stretches of some rows of symbols, with the number of times each occurs."""

    def __init__(self, rows: list[list[int]], times: list[int]):
        self.to: list[dict[int, int]] = [{}]
        self.link, self.length, self.times = [-1], [0], [0]
        for row, weight in zip(rows, times, strict=True):
            last = 0
            for symbol in row:
                last = self._extend(last, symbol)
                self.times[last] += weight
        # An occurrence of a state is one of all its shorter suffixes.
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            self.times[self.link[state]] += self.times[state]

    def _state(self, length: int, to: dict[int, int], link: int) -> int:
        self.to.append(to), self.link.append(link), self.length.append(length), self.times.append(0)
        return len(self.link) - 1

    def _split(self, state: int, symbol: int, there: int) -> int:
        """The state of the longest stretch of ``state`` and the symbol; parted from a longer one if need be."""
        to, link, length = self.to, self.link, self.length
        if length[there] == length[state] + 1:
            return there
        copy = self._state(length[state] + 1, to[there].copy(), link[there])
        link[there] = copy
        while state >= 0 and to[state].get(symbol) == there:
            to[state][symbol] = copy
            state = link[state]
        return copy

    def _extend(self, last: int, symbol: int) -> int:
        to, link = self.to, self.link
        there = to[last].get(symbol)
        if there is not None:
            return self._split(last, symbol, there)
        new = self._state(self.length[last] + 1, {}, 0)
        state = last
        while state >= 0 and symbol not in to[state]:
            to[state][symbol] = new
            state = link[state]
        if state >= 0:
            link[new] = self._split(state, symbol, to[state][symbol])
        return new

    def repeated(self, row: list[int], least: int) -> int:
        """Bits of the words of a row that are in a stretch of ``least`` or more that occurs at least twice."""
        to, link, lengths, times = self.to, self.link, self.length, self.times
        state = size = mask = 0
        for at, symbol in enumerate(row):
            while state and symbol not in to[state]:
                state = link[state]
                size = lengths[state]
            there = to[state].get(symbol)
            if there is not None:
                state, size = there, size + 1
            while state and times[state] < 2:
                state = link[state]
                size = lengths[state]
            if size >= least:
                mask |= ((1 << size) - 1) << (at - size + 1)
        return mask


def _search_shard(table: pa.Table) -> pa.Table:
    """(anchor, passage, mask) of the passages of a shard."""
    numbers: dict[bytes, int] = {}
    rows = [
        [numbers.setdefault(word, len(numbers)) for word in words.split()]
        for words in table.column("words").cast(pa.binary()).to_pylist()
    ]
    automaton = SuffixAutomaton(rows, table.column("n").to_pylist())
    masks = [automaton.repeated(row, WINDOW) for row in rows]
    return table.select(["anchor", "passage"]).append_column("mask", pa.array(masks, pa.int64()))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_removed, kept_sha256, kept) of every row; ``kept`` has the words that stay, joined by a space.

    A word is removed if a window of 35 words that covers it also starts anywhere else, in the same text or another, as the
    texts are given. Repeated rows repeat each other. NULL and empty texts, and those of fewer words than a window, lose
    nothing. NULL ids are ids like others. An empty table gives an empty result; other columns are not looked at.
    """
    small_batches(docs.sparkSession)
    kind = sql_type(docs, id_col)
    # A text is known by its id and hash, which are the same in every scan.
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))

    def passed(of: BitFilter, wanted: bool) -> DataFrame:
        """The texts that a filter passes, or those it does not."""
        shared = docs.sparkSession.sparkContext.broadcast(of)

        def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array(shared.value.passes(batch.column(1).to_numpy()) == wanted))

        return rows.mapInArrow(choose, f"id {kind}, th bigint, text string")

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, some in _slices(texts(batch.column(0))):
                anchor, count = np.unique(_Words(some).passages()[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(count)], ["anchor", "n"])

    counted = rows.select("text").mapInArrow(anchors, "anchor bigint, n bigint").groupBy("anchor").agg(F.sum("n").alias("n"))
    repeated = materialize(counted.where(F.col("n") > 1).select("anchor"), "repeats-anchors")
    shared = docs.sparkSession.sparkContext.broadcast(bit_filter(repeated, "anchor"))

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, some in _slices(texts(batch.column(2))):
                words = _Words(some)
                anchor, of, first, size = words.passages()
                kept = np.flatnonzero(shared.value.passes(anchor))
                anchor, of, first, size = anchor[kept], of[kept], first[kept], size[kept]
                passage = words.sums.of(first, first + size)
                where = pa.array(of + start)
                columns = [
                    batch.column(0).take(where), batch.column(1).take(where), pa.array(anchor.view(np.int64)),
                    pa.array(passage.view(np.int64)), pa.array((first - words.first[of]).astype(np.int32)), pa.array(size.astype(np.int32)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["id", "th", "anchor", "passage", "first", "size"])

    schema = f"id {kind}, th bigint, anchor bigint, passage bigint, first int, size int"
    found = materialize(rows.mapInArrow(occurrences, schema), "repeats-passages")
    passages = found.groupBy("anchor", "passage").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "th", "first", "size")).alias("one"))
    passages = materialize(passages, "repeats-distinct")
    kinds = passages.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("total"))
    kinds = materialize(kinds.where(F.col("total") > 1).withColumnRenamed("anchor", "_anchor"), "repeats-kinds")
    passages = passages.join(kinds, F.col("anchor") == F.col("_anchor")).select("anchor", "passage", "n", "kinds", "one.*")
    alone = passages.where(F.col("kinds") == 1)
    all_words = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("size")) - 1
    masks = alone.select("anchor", "passage", all_words.alias("mask"))

    # The words of one occurrence of each other passage are fetched from its text.
    wanted = passages.where(F.col("kinds") > 1).withColumn("hot", F.col("kinds") > MOST_PASSAGES)
    wanted = wanted.groupBy("id", "th").agg(F.collect_list(F.struct("anchor", "passage", "n", "first", "size", "hot")).alias("wanted"))
    # Written, and told by a filter of bounded size, so that only texts that have one are sent to the join.
    wanted = materialize(wanted.toDF("_id", "_th", "wanted"), "repeats-wanted")
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th"))
    sources = passed(bit_filter(wanted, "_th"), True).join(wanted, same).dropDuplicates(["_id", "_th"]).select("text", "wanted")

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1).to_pylist()
            for text, found in zip(texts(batch.column(0)), lists, strict=True):
                words, sums = text.split(), None
                out = []
                for p in found:
                    first, size, windows = p["first"], p["size"], None
                    if p["hot"]:
                        sums = sums or _Words([text]).sums
                        starts = np.arange(first, first + size - WINDOW + 1)
                        windows = sums.of(starts, starts + WINDOW).view(np.int64).tolist()
                    out.append((p["anchor"], p["passage"], p["n"], None if windows else b" ".join(words[first : first + size]), windows))
                columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), fetched, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["anchor", "passage", "n", "words", "windows"])

    fetched = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
    taken = sources.mapInArrow(fetch, "anchor bigint, passage bigint, n bigint, words binary, windows array<bigint>")
    taken = materialize(taken, "repeats-words")

    gathered = taken.where(F.col("words").isNotNull())
    shards = max(docs.sparkSession.sparkContext.defaultParallelism, math.ceil(gathered.count() * (WINDOW + 8) / SHARD_WORDS))
    gathered = gathered.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    searched = gathered.groupBy("shard").applyInArrow(_search_shard, "anchor bigint, passage bigint, mask bigint")

    spread = taken.where(F.col("windows").isNotNull()).select("anchor", "passage", "n", F.posexplode("windows").alias("at", "window"))
    twice = spread.groupBy(F.col("window").alias("_window")).agg(F.sum("n").alias("total")).where(F.col("total") > 1).select("_window")
    twice = materialize(twice, "repeats-windows")
    window_bits = F.call_function("shiftleft", F.lit((1 << WINDOW) - 1).cast("bigint"), F.col("at"))
    hot = spread.join(twice, F.col("window") == F.col("_window")).groupBy("anchor", "passage").agg(F.bit_or(window_bits).alias("mask"))

    masks = masks.unionByName(searched).unionByName(hot).where(F.col("mask") != 0)
    # Written, so that the join can split a passage that very many texts have.
    masks = materialize(masks.toDF("_anchor", "_passage", "mask"), "repeats-masks")
    marked = found.join(masks, (F.col("anchor") == F.col("_anchor")) & (F.col("passage") == F.col("_passage")))
    # A set: however often a text is repeated under one id, its marks are no more than its passages.
    marked = marked.groupBy("id", "th").agg(F.collect_set(F.struct("first", "mask")).alias("marks")).toDF("_id", "_th", "marks")
    marked = materialize(marked, "repeats-marked")
    of_marked = bit_filter(marked, "_th")
    joined = passed(of_marked, True).join(marked, same, "left").select("id", "text", "marks.first", "marks.mask")
    # Texts without marks need no join.
    none = F.lit(None)
    alone = passed(of_marked, False).select("id", "text", none.cast("array<int>").alias("first"), none.cast("array<bigint>").alias("mask"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sizes, removed, digests, kept_texts = [], [], [], []
            for text, firsts, masks in zip(texts(batch.column(1)), batch.column(2), batch.column(3), strict=True):
                words, gone = text.split(), 0
                sizes.append(len(words))
                if firsts.is_valid:
                    starts = firsts.values.to_numpy().astype(np.int64)
                    rows = np.unpackbits(masks.values.to_numpy().view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                    row, bit = rows.nonzero()
                    goes = np.zeros(len(words), dtype=bool)
                    goes[starts[row] + bit] = True
                    gone = int(goes.sum())
                    words = [word for word, out in zip(words, goes.tolist(), strict=True) if not out]
                removed.append(gone)
                kept_texts.append(b" ".join(words))
                digests.append(hashlib.sha256(kept_texts[-1]).hexdigest())
            columns = [
                batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests),
                pa.array(kept_texts, pa.binary()).cast(pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, [id_col, "n_words", "n_removed", "kept_sha256", "kept"])

    schema = f"`{id_col}` {kind}, n_words bigint, n_removed bigint, kept_sha256 string, kept string"
    return joined.mapInArrow(cut, schema).unionByName(alone.mapInArrow(cut, schema))
