"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most three bits have a common variant: one of them reaches it by at most two flips, the
other by at most one. Only variants of even parity are used, which halves the work and loses nothing. A fingerprint of
even parity emits itself and its variants with two flips; one of odd parity its variants with one flip:

- three bits apart: the parities differ, and the variant two flips from the even one is one flip from the odd one;
- two apart, both even: one of them is a two-flip variant of the other;
- two apart, both odd: flipping either of the two bits of one gives a one-flip variant of the other;
- one apart: the even one is a one-flip variant of the odd one.

The variants are shuffled by their leading bits. A fingerprint is sent once to each group of leading bits that its
variants have, and the variants of the group are made there, so that a few dozen rows stand for two thousand. More leading
bits are taken until no group holds more than ``GROUP_ROWS``; a group of one variant can't hold more than 2,081, so that
this ends whatever the fingerprints are.

All fingerprints at one variant need no pairs: if an odd one or the variant itself is among them, it is a neighbour of
every other, so links to it keep the group connected; if none is, the pairs that are near meet at another variant.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import map_batches, sql_type, texts, without
from tallyforge.operators.graph import connected_components
from tallyforge.plans.durable import materialize

SEED = 42
RADIUS = 3
#: Rows of a group of leading bits, at most.
GROUP_ROWS = 60_000
#: Variants made at a time within a group.
_SLICE = 2_000_000
#: Words of a batch that are hashed together.
_WORDS = 400_000

#: For each byte, its bits in eight counters of one byte each, lowest bit first.
_LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").reshape(-1).view(np.uint64)


def _shingle_hashes(text: bytes, size: int) -> list[int]:
    words = text.lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    ends, at = [], -1
    for word in words:
        at += len(word) + 1
        ends.append(at)
    starts = [0, *(end + 1 for end in ends[:-1])]
    hash64 = xxhash.xxh64_intdigest
    if len(words) <= size:
        return [hash64(joined, SEED)]
    return [hash64(joined[start:end], SEED) for start, end in zip(starts, ends[size - 1 :], strict=False)]


def _majority(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Per document, the bits that are set in over half of its hashes; ``sizes`` has the numbers of hashes, none zero.

    Runs of at most 255 hashes are added up in counters of one byte, eight to a number, and the runs then per document.
    """
    runs = -(-sizes // 255)
    first_run = np.concatenate(([0], np.cumsum(runs)[:-1]))
    first = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    within = np.arange(runs.sum()) - np.repeat(first_run, runs)
    starts = np.repeat(first, runs) + 255 * within
    out = np.zeros(len(sizes), dtype=np.uint64)
    for byte, values in enumerate(hashes.view(np.uint8).reshape(-1, 8).T):
        counters = np.add.reduceat(_LANES[values], starts).view(np.uint8).reshape(-1, 8)
        counts = np.add.reduceat(counters, first_run, axis=0, dtype=np.int64)
        bits = np.packbits(counts * 2 > sizes[:, None], axis=1, bitorder="little")[:, 0]
        out |= bits.astype(np.uint64) << np.uint64(8 * byte)
    return out


def fingerprints_of(documents: list[bytes], size: int = 3) -> np.ndarray:
    """Fingerprints of texts given as UTF-8."""
    out = np.zeros(len(documents), dtype=np.uint64)
    rows: list[int] = []
    sizes: list[int] = []
    hashes: list[int] = []

    def flush() -> None:
        if rows:
            out[rows] = _majority(np.array(hashes, dtype=np.uint64), np.array(sizes, dtype=np.int64))
            rows.clear(), sizes.clear(), hashes.clear()

    for row, text in enumerate(documents):
        found = _shingle_hashes(text, size)
        if found:
            rows.append(row), sizes.append(len(found))
            hashes += found
        if len(hashes) >= _WORDS:
            flush()
    flush()
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """(id, th bigint, fp bigint) of every row: ASCII letters lower-cased, shingles of ``size`` words, repeats included.

    ``th`` is a hash of the text, which tells rows of one id apart.

    A text of fewer words is one shingle; one of no words, and NULL, has the fingerprint zero.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = fingerprints_of(texts(batch.column(2)), size).view(np.int64)
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps)], ["id", "th", "fp"])

    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("th"), text_col)
    return map_batches(rows, run, f"id {sql_type(docs, id_col)}, th bigint, fp bigint")


def _flips(low: int, high: int, most: int) -> list[int]:
    """Masks of up to ``most`` set bits among the bits ``low`` to ``high`` - 1."""
    ones = [1 << bit for bit in range(low, high)]
    masks = [0]
    if most >= 1:
        masks += ones
    if most >= 2:
        masks += [a | b for at, a in enumerate(ones) for b in ones[:at]]
    return masks


def _grouped(fps: DataFrame, depth: int) -> DataFrame:
    """(grp, fp, mask, flips): a row for each group of ``depth`` leading bits in which a fingerprint has variants."""
    masks = [m - (1 << 64) if m >= 1 << 63 else m for m in _flips(64 - depth, 64, 2)]
    odd = F.bit_count("fp") % 2 == 1
    rows = fps.select("fp", F.explode(F.array(*map(F.lit, masks))).alias("mask"))
    rows = rows.select("fp", "mask", F.bit_count("mask").alias("flips")).where(~odd | (F.col("flips") <= 1))
    return rows.select(F.shiftrightunsigned(F.col("fp").bitwiseXOR(F.col("mask")), 64 - depth).alias("grp"), "fp", "mask", "flips")


def _group_links(fp: np.ndarray, mask: np.ndarray, flips: np.ndarray, depth: int) -> np.ndarray:
    """Links (pairs of fingerprints) among the variants of one group."""
    ones = np.array(_flips(0, 64 - depth, 1)[1:], dtype=np.uint64)
    twos = np.array(_flips(0, 64 - depth, 2)[1 + len(ones) :], dtype=np.uint64)
    base = fp ^ mask
    odd = (np.bitwise_count(fp) & 1).astype(bool)

    def spread(rows: np.ndarray, flip: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return (base[rows][:, None] ^ flip[None, :]).ravel(), np.repeat(fp[rows], len(flip))

    # Variants that can stand for all others at the same place: the fingerprint itself, or one flip of an odd one.
    still = np.flatnonzero(~odd & (flips == 0))
    near, near_fp = spread(np.flatnonzero(odd & (flips == 0)), ones)
    moved = np.flatnonzero(odd & (flips == 1))
    keys = np.concatenate((base[still], near, base[moved]))
    owners = np.concatenate((fp[still], near_fp, fp[moved]))
    if not len(keys):
        return np.empty((0, 2), dtype=np.uint64)
    # The variant itself comes first among the owners, then the smallest.
    order = np.lexsort((owners, owners != keys, keys))
    keys, owners = keys[order], owners[order]
    new = np.concatenate(([True], keys[1:] != keys[:-1]))
    hubs = owners[new]
    found = [np.stack((owners, hubs[np.cumsum(new) - 1]), axis=1)[~new]]
    keys = keys[new]

    # A table of bits passes most of the two-flip variants by; the rest is looked up.
    bits = max(10, int(len(keys)).bit_length() + 4)
    multiplier, shift = np.uint64(0x9E3779B97F4A7C15), np.uint64(64 - bits)
    seen = np.zeros(1 << bits, dtype=bool)
    seen[(keys * multiplier) >> shift] = True

    def look_up(variants: np.ndarray, of: np.ndarray) -> None:
        hits = np.flatnonzero(seen[(variants * multiplier) >> shift])
        variants, of = variants[hits], of[hits]
        at = np.minimum(np.searchsorted(keys, variants), len(keys) - 1)
        same = keys[at] == variants
        found.append(np.stack((of[same], hubs[at[same]]), axis=1))

    far = np.flatnonzero(~odd & (flips == 2))
    look_up(base[far], fp[far])
    for chosen, flip in ((np.flatnonzero(~odd & (flips == 1)), ones), (still, twos)):
        step = max(1, _SLICE // max(1, len(flip)))
        for start in range(0, len(chosen) if len(flip) else 0, step):
            look_up(*spread(chosen[start : start + step], flip))
    links = np.concatenate(found)
    distance = np.bitwise_count(links[:, 0] ^ links[:, 1])
    links = links[(distance > 0) & (distance <= RADIUS)]
    return np.unique(np.sort(links, axis=1), axis=0)


def near_links(fps: DataFrame) -> DataFrame:
    """(a, b): links between distinct fingerprints at most three bits apart, enough to connect all that are linked.

    ``fps`` has the column ``fp`` without repeats or NULL. Every link returned is verified.
    """
    depth = max(6, math.ceil(math.log2(max(2, fps.count()) * 24 / GROUP_ROWS)))
    while depth < 64:
        load = _grouped(fps, depth).groupBy("grp").count().agg(F.max("count")).head()[0] or 0
        if load <= GROUP_ROWS:
            break
        depth = min(64, depth + max(2, math.ceil(math.log2(load / GROUP_ROWS))))

    def run(groups: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(groups))
        fp, mask = (table.column(c).to_numpy().view(np.uint64) for c in ("fp", "mask"))
        links = _group_links(fp, mask, table.column("flips").to_numpy(), depth).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(links[:, 0]), pa.array(links[:, 1])], ["a", "b"])

    return _grouped(fps, depth).groupBy("grp").applyInArrow(run, "a bigint, b bigint")


def _classes(rows: DataFrame) -> DataFrame:
    """(fp, kept): of each fingerprint, the smallest (id, th) that can be reached from it; ``rows`` has (id, th, fp)."""
    nodes = rows.where(F.col("id").isNotNull()).groupBy("fp").agg(F.min(F.struct("id", "th")).alias("least"))
    # Fingerprints are nodes by number, since one id may stand on several.
    nodes = materialize(nodes.withColumn("node", F.monotonically_increasing_id()), "simhash-nodes")
    links = materialize(near_links(nodes.select("fp")), "simhash-links")
    left, right = nodes.select(F.col("fp").alias("a"), F.col("node").alias("src")), nodes.select(F.col("fp").alias("b"), F.col("node").alias("dst"))
    edges = links.join(left, "a").join(right, "b").select("src", "dst")
    parts = connected_components(nodes.select(F.col("node").alias("id")), edges).withColumnRenamed("id", "node")
    parts = materialize(nodes.join(parts, "node").select("fp", "least", "component"), "simhash-parts")
    kept = parts.groupBy("component").agg(F.min("least").alias("kept"))
    # Written, so that a join with it can split a fingerprint that very many documents have.
    return materialize(parts.join(kept, "component").select("fp", "kept"), "simhash-classes")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """(id, fingerprint, component_id) of every row of ``docs``.

    ``fingerprint`` has 16 hexadecimal digits; ``component_id`` is the smallest id that can be reached over fingerprints
    of three or fewer differing bits. Empty, blank and NULL texts have the fingerprint zero, linked like any other.
    Repeated rows are repeated in the result, and rows of one id with different texts go by their own fingerprints. A row with a
    NULL id gets its fingerprint, links nothing and has no component. An empty table gives an empty result; other columns of
    ``docs`` are not looked at.
    """
    rows = materialize(fingerprints(docs, id_col, text_col, size), "simhash")
    fingerprint = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    component = F.when(F.col("id").isNotNull(), F.col("kept.id")).alias("component_id")
    return rows.join(_classes(rows), "fp", "left").select(F.col("id").alias(id_col), fingerprint, component)


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """``docs`` without all but one row of each group of near-duplicates: the one with the smallest id stays.

    Of rows with the same id that are near-duplicates one stays, and one of equal rows. Rows with a NULL id stay. An empty table
    gives an empty result; all columns stay.
    """
    rows = materialize(fingerprints(docs, id_col, text_col, size), "simhash")
    found = rows.where(F.col("id").isNotNull()).join(_classes(rows), "fp")
    gone = found.where((F.col("id") != F.col("kept.id")) | (F.col("th") != F.col("kept.th"))).select("id", "th").distinct()
    left = without(docs, gone, id_col, text_col)
    named, place = F.col(id_col).isNotNull(), F.xxhash64(text_col)
    # Rows that are repeated under one id and text are few or none; only they are grouped.
    again = rows.where(F.col("id").isNotNull()).groupBy("id", "th").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    again = materialize(again.select("id", "th"), "simhash-again")
    if again.isEmpty():
        return left
    alone = without(left, again, id_col, text_col)
    marked = left.where(named).join(again, (F.col(id_col) == again["id"]) & (place == again["th"]), "left_semi")
    return alone.unionByName(marked.dropDuplicates([id_col, text_col]))
