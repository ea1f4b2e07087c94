"""Collocations from a weighted de Bruijn graph of words.

The longest grams (five words) are the edges, from the node of their first four words to that of their last four; an edge is
weighted with its occurrences. Every word of a piece starts one gram: the longest that fits into the piece, so that a piece ends
in grams of four, three, two and one words. These shorter grams are the corrections for piece ends, and the occurrences of any
shorter phrase are the flow out of it (the weights of all edges that begin with it) plus the corrections that begin with it.

Edges are only made where they can matter. A phrase of ``LEAST`` occurrences has no part of fewer, so grams are cut where a pair
or a triple of words is rarer; what is cut starts a shorter gram, exactly like a piece end, so that the counts of all phrases of
``LEAST`` or more stay exact. Pairs and triples are counted whole, by hash, and told by filters of bounded size that may pass a
rare one (which costs a row) and never hold a frequent one back.

Unary paths are compacted: where a node has one edge in and one out, of one weight, they are one longer path. Paths are cut at
nodes chosen by hash, one of ``_EVERY``, which bounds their length; circles without such a node stay single edges. The table of
paths and corrections is the graph, from which all counts are derived.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.llm.common import small_batches, texts
from tallyforge.llm.rolling import RANDOM, BitFilter, Counts, Sums, bit_filter, mix, slices
from tallyforge.plans.durable import RoundTables, materialize

LONGEST, LEAST, MOST = 5, 100, 2000
#: Bytes of text that are taken together.
_BYTES = 2_000_000
#: One node of so many ends a path.
_EVERY = 16
#: Capitals of ASCII become small letters, a tab a space, and each character that ends a piece a line feed.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else 32 if b == 9 else 10 if chr(b) in ".,;:!?\n\v\f\r" else b for b in range(256))


class _Words:
    """The words of some texts, laid end to end, with hashes of stretches of them that tell languages apart."""

    def __init__(self, rows: list[bytes], seeds: np.ndarray):
        self.text = b"\n".join([*rows, b""]).translate(_FOLD)
        data = np.frombuffer(self.text, dtype=np.uint8)
        solid = np.concatenate(([False], (data != 32) & (data != 10), [False]))
        edges = np.flatnonzero(solid[1:] != solid[:-1])
        self.starts, self.ends = edges[::2], edges[1::2]
        self.count = len(self.starts)
        self.of = np.searchsorted(np.cumsum([len(row) + 1 for row in rows]), self.starts, side="right")
        hashes = Sums(RANDOM[data], "bytes").of(self.starts, self.ends)
        self.sums = Sums(mix(hashes + seeds[self.of]), "words")
        piece = np.cumsum(data == 10)[self.starts] if self.count else np.empty(0, dtype=np.int64)
        #: Whether a word and the next are of one piece.
        self.goes_on = np.concatenate((piece[1:] == piece[:-1], [False])) if self.count else np.empty(0, dtype=bool)

    def hashes(self, at: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        return self.sums.of(at, at + size)

    def frequent_pairs(self, pairs: BitFilter) -> np.ndarray:
        """Whether each word starts a pair that passes."""
        out = self.goes_on.copy()
        at = np.flatnonzero(out)
        out[at] = pairs.passes(self.hashes(at, 2))
        return out

    def possible_triples(self, pairs: BitFilter) -> np.ndarray:
        """The words that start a triple of which both pairs pass."""
        good = self.frequent_pairs(pairs)
        return np.flatnonzero(good[:-1] & good[1:])

    def gram(self, at: int, size: int) -> bytes:
        words = zip(self.starts[at : at + size].tolist(), self.ends[at : at + size].tolist(), strict=True)
        return b" ".join([self.text[start:end] for start, end in words])


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Words, list[str]]]:
    """The words of (lang, text), and the language of each text."""
    for batch in batches:
        names = batch.column(0).to_pylist()
        for start, some in slices(texts(batch.column(1)), _BYTES):
            of = names[start : start + len(some)]
            seeds = {name: xxhash.xxh64_intdigest(name) for name in set(of)}
            yield _Words(some, np.array([seeds[name] for name in of], dtype=np.uint64)), of


def _frequent(rows: DataFrame, least: int, pairs: BitFilter | None = None) -> BitFilter:
    """The filter of the pairs of words that occur ``least`` times or more; of the triples, given that of the pairs."""
    shared = rows.sparkSession.sparkContext.broadcast(pairs)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, known = Counts(), shared.value

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c) for c in counts.take()], ["gram", "n"])

        for words, _ in _batches(batches):
            if known is None:
                counts.add(words.hashes(np.flatnonzero(words.goes_on), 2))
            else:
                counts.add(words.hashes(words.possible_triples(known), 3))
            if counts.due():
                yield out()
        yield out()

    found = rows.mapInArrow(count, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
    return bit_filter(materialize(found.where(F.col("n") >= least).select("gram"), "collocations-grams"), "gram")


def gram_edges(rows: DataFrame, least: int) -> DataFrame:
    """(lang, gram, size, n): the grams that words start, of ``LONGEST`` words or as many as their piece (or a rare pair) leaves."""
    pairs = _frequent(rows, least)
    triples = _frequent(rows, least, pairs)
    shared = rows.sparkSession.sparkContext.broadcast((pairs, triples))

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, triples = shared.value
        for words, names in _batches(batches):
            if not words.count:
                continue
            good = np.zeros(words.count + LONGEST, dtype=bool)
            at = words.possible_triples(pairs)
            good[at[triples.passes(words.hashes(at, 3))]] = True
            size = 1 + words.frequent_pairs(pairs).astype(np.int64)
            more = np.ones(words.count, dtype=bool)
            for step in range(LONGEST - 2):
                more &= good[step : step + words.count]
                size += more & (size == step + 2)
            _, first, n = np.unique(words.hashes(np.arange(words.count), size), return_index=True, return_counts=True)
            sizes = size[first]
            found = [words.gram(at, k) for at, k in zip(first.tolist(), sizes.tolist(), strict=True)]
            columns = [
                pa.array([names[t] for t in words.of[first].tolist()], pa.string()), pa.array(found, pa.binary()).cast(pa.string()),
                pa.array(sizes.astype(np.int32)), pa.array(n),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "gram", "size", "n"])

    found = rows.mapInArrow(grams, "lang string, gram string, size int, n bigint")
    return found.groupBy("lang", "gram", "size").agg(F.sum("n").alias("n"))


def _joined(words: Column) -> Column:
    return F.array_join(words, " ")


def compact_paths(edges: DataFrame) -> DataFrame:
    """(lang, words, n): unary paths of the graph of ``edges`` (lang, words, n), an array of ``LONGEST`` words each."""
    spark = edges.sparkSession
    number = F.monotonically_increasing_id().alias("id")
    node = LONGEST - 1
    edges = edges.select(number, "lang", "words", "n", _joined(F.slice("words", 1, node)).alias("src"), _joined(F.slice("words", 2, node)).alias("dst"))
    edges = materialize(edges, "collocations-edges")
    outs = edges.groupBy("lang", F.col("src").alias("node")).agg(F.count("id").alias("outs"), F.min("id").alias("id"), F.min("n").alias("n_out"))
    ins = edges.groupBy(F.col("lang").alias("_lang"), F.col("dst").alias("_node")).agg(
        F.count("id").alias("ins"), F.min("id").alias("head"), F.min("n").alias("n_in")
    )
    unary = outs.where(F.col("outs") == 1).join(ins.where(F.col("ins") == 1), (F.col("lang") == F.col("_lang")) & (F.col("node") == F.col("_node")))
    unary = unary.where((F.col("n_out") == F.col("n_in")) & (F.pmod(F.xxhash64("node"), F.lit(_EVERY)) != 0))
    # Each edge that goes on another one points at it; pointers are doubled until they point at the first of their path.
    tables = RoundTables(spark, "collocations-paths")
    found = tables.save(unary.select("id", "head", F.lit(1).cast("bigint").alias("far")))
    open_ = -1
    while True:
        there = found.select(F.col("id").alias("_id"), F.col("head").alias("_head"), F.col("far").alias("_far"))
        joined = found.join(there, F.col("head") == F.col("_id"), "left")
        found = tables.save(joined.select(
            "id", F.coalesce("_head", "head").alias("head"), (F.col("far") + F.coalesce("_far", F.lit(0))).alias("far"),
            F.col("_id").isNotNull().alias("open"),
        ))
        left = found.where("open").count()
        # Every round ends some path that still can end; what remains then are circles.
        if left in (0, open_):
            break
        open_ = left
    ended = found.where(~F.col("open")).select(F.col("id").alias("_id"), "head", "far")
    placed = edges.join(ended, F.col("id") == F.col("_id"), "left")
    placed = placed.select("lang", "words", "n", F.coalesce("head", "id").alias("path"), F.coalesce("far", F.lit(0)).alias("far"))
    one = F.sort_array(F.collect_list(F.struct("far", "words")))
    paths = placed.groupBy("path").agg(F.first("lang").alias("lang"), F.first("n").alias("n"), one.alias("edges"))
    last = F.transform(F.slice("edges", 2, F.size("edges")), lambda e: F.element_at(e["words"], -1))
    return paths.select("lang", F.concat(F.col("edges")[0]["words"], last).alias("words"), "n")


def collocation_graph(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """(lang, words, n, path): the paths of the graph, and with ``path`` false the corrections, grams of fewer words."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.coalesce(lang_col, F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    edges = materialize(gram_edges(rows, least), "collocations-grams")
    words = F.split("gram", " ").alias("words")
    paths = compact_paths(edges.where(F.col("size") == LONGEST).select("lang", words, "n"))
    ends = edges.where(F.col("size") < LONGEST).select("lang", words, "n", F.lit(False).alias("path"))
    return paths.select("lang", "words", "n", F.lit(True).alias("path")).unionByName(ends)


def phrase_counts(graph: DataFrame) -> DataFrame:
    """(lang, gram, size, f): the occurrences of phrases, from the edges of paths and the corrections that begin with them."""
    starts = F.when(F.col("path"), F.sequence(F.lit(1), F.size("words") - (LONGEST - 1))).otherwise(F.array(F.lit(1)))
    edges = graph.select("lang", "words", "n", F.explode(starts).alias("at"))
    edges = edges.select("lang", F.slice("words", F.col("at"), F.least(F.lit(LONGEST), F.size("words"))).alias("words"), "n")
    grams = edges.select("lang", "n", "words", F.explode(F.sequence(F.lit(1), F.size("words"))).alias("size"))
    grams = grams.select("lang", _joined(F.slice("words", 1, F.col("size"))).alias("gram"), "size", "n")
    return grams.groupBy("lang", "gram", "size").agg(F.sum("n").alias("f"))


def score_of(a: str, left: str, right: str, n: str) -> Column:
    """1000 * a * n / (left * right), rounded down. Products may pass 64 bits: decimals of up to 38 digits, divided exactly."""
    def whole(*columns: str) -> str:
        return " * ".join(f"cast({c} as decimal(18, 0))" for c in columns)

    return F.expr(f"(cast(1000 * cast({a} as decimal(18, 0)) as decimal(20, 0)) * {whole(n)}) div ({whole(left, right)})")


def collocations(
    docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST, most: int = MOST
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``most`` phrases of the highest scores of each language.

    Phrases have 2 to 5 words of one piece of a text and at least ``least`` occurrences. NULL languages are ``und``. NULL and
    empty texts have no words; texts may be of any length; repeated rows count each. Equal scores go by ``a``, then by the
    phrase. An empty table gives an empty result; other columns are not looked at.
    """
    graph = materialize(collocation_graph(docs, lang_col, text_col, least), "collocations-graph")
    # Each word starts one gram, so that the weights add up to the words of a language.
    edges = F.when(F.col("path"), F.size("words") - (LONGEST - 1)).otherwise(1)
    totals = graph.groupBy(F.col("lang").alias("_lang")).agg(F.sum(F.col("n") * edges).alias("n"))
    counts = materialize(phrase_counts(graph).where(F.col("f") >= least), "collocations-counts")
    found = counts.where(F.col("size") > 1).select("lang", "gram", "size", F.split("gram", " ").alias("words"), F.col("f").alias("a"))

    # The most occurrences of a longer phrase that a phrase lies in.
    longer = found.where(F.col("size") > 2).select("lang", "words", "size", "a", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("part"))
    longer = longer.select("lang", "words", "a", "part", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("part") + 1)).alias("at"))
    inner = longer.select(F.col("lang").alias("_lang"), _joined(F.slice("words", F.col("at"), F.col("part"))).alias("_gram"), "a")
    inner = inner.groupBy("_lang", "_gram").agg(F.max("a").alias("longest"))
    kept = found.join(inner, (F.col("lang") == F.col("_lang")) & (F.col("gram") == F.col("_gram")), "left")
    kept = kept.where(F.col("longest").isNull() | (100 * F.col("longest") < 100 * F.col("a"))).select("lang", "gram", "words", "size", "a")

    cuts = kept.select("lang", "gram", "words", "size", "a", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("cut"))
    cuts = cuts.withColumn("_first", _joined(F.slice("words", 1, F.col("cut"))))
    cuts = cuts.withColumn("_rest", _joined(F.slice("words", F.col("cut") + 1, F.col("size"))))
    for part, out in (("_first", "l"), ("_rest", "r")):
        of = counts.select(F.col("lang").alias("_lang"), F.col("gram").alias("_gram"), F.col("f").alias(out))
        cuts = cuts.join(of, (F.col("lang") == F.col("_lang")) & (F.col(part) == F.col("_gram"))).drop("_lang", "_gram", part)
    cuts = cuts.join(totals, F.col("lang") == F.col("_lang"))
    worst = cuts.withColumn("score", score_of("a", "l", "r", "n")).groupBy("lang", "gram", "a").agg(F.min(F.struct("score", "cut", "l", "r", "n")).alias("worst"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    worst = worst.select("lang", F.col("gram").alias("phrase"), "a", "worst.l", "worst.r", "worst.n", "worst.score")
    ranked = worst.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("bigint").alias("score"))
