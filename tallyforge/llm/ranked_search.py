"""Ranked lexical search without an index of the documents: one automaton of all terms of the items scans the texts.

The items that are searched for are few next to the documents, so it is their terms that are indexed: an Aho-Corasick automaton
of all distinct terms of a block of items is sent to every task. Each term stands in it between two guards (spaces), and the
texts are folded so that everything between terms is spaces: what the automaton finds are whole terms, and a guard may close
one term and open the next. Its outputs are numbers of terms, which map to items through a table of (item, repeats) per term.

Two scans: the first counts documents, terms and document frequencies, a task adding up its own; the second counts term
frequencies and scores every document for every item. A task hands on a document for an item only if it may still be among the
best of this task, so that about ``k`` times the logarithm of its batches leave it per item.

A block holds ``MOST_TERMS`` terms and ``MOST_ITEMS`` items at most (or one item with more terms), whatever the table of items
holds; further blocks take further scans.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.llm.common import small_batches, sql_type, texts

MOST_TERMS, MOST_ITEMS = 100_000, 2_000
#: Products of a term frequency and an item that are added up at a time.
_PRODUCTS = 2_000_000
#: Capitals of ASCII become small letters; ASCII that is neither letter nor digit becomes the guard. Other bytes are of terms.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Places of the sums over all documents beside the document frequencies.
_DOCUMENTS, _TERMS = -1, -2


class _Block:
    """Some items: their terms by number, and per term the items that hold it with the number of times."""

    def __init__(self) -> None:
        self.ids: list[object] = []
        self.terms: dict[bytes, int] = {}
        self._holds: list[tuple[int, int, int]] = []

    def add(self, item: object, terms: Counter[bytes]) -> None:
        number = len(self.ids)
        self.ids.append(item)
        self._holds += [(self.terms.setdefault(term, len(self.terms)), number, times) for term, times in terms.items()]

    def fits(self, terms: Counter[bytes]) -> bool:
        new = sum(term not in self.terms for term in terms)
        return not self.ids or (len(self.ids) < MOST_ITEMS and len(self.terms) + new <= MOST_TERMS)

    def outputs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first, items, times): the items of term t are those from ``first[t]`` to before ``first[t + 1]``."""
        holds = np.array(sorted(self._holds), dtype=np.int64).reshape(-1, 3)
        return np.searchsorted(holds[:, 0], np.arange(len(self.terms) + 1)), holds[:, 1], holds[:, 2]


def _blocks(items: DataFrame) -> Iterator[_Block]:
    """The items with at least one term, in blocks; one partition of the table is on the driver at a time."""
    block = _Block()
    for item, text in items.toLocalIterator():
        terms = Counter((text or "").encode().translate(_FOLD).split())
        if not terms:
            continue
        if not block.fits(terms):
            yield block
            block = _Block()
        block.add(item, terms)
    if block.ids:
        yield block


def _automaton(terms: list[bytes]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for number, term in enumerate(terms):
        found.add_word(f" {term.decode()} ", number)
    found.make_automaton()
    return found


def _folded(column: pa.Array) -> list[bytes]:
    return [b" " + text.translate(_FOLD) + b" " for text in texts(column)]


def _frequencies(automaton: ahocorasick.Automaton, text: bytes) -> Counter[int]:
    return Counter(map(itemgetter(1), automaton.iter(text.decode())))


def _totals(docs: DataFrame, terms: list[bytes]) -> tuple[int, int, np.ndarray]:
    """Documents with a term, terms of all documents, and the documents that hold each of ``terms``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, sums = _automaton(terms), Counter()
        for batch in batches:
            for text in _folded(batch.column(0)):
                size = len(text.split())
                if size:
                    sums[_DOCUMENTS] += 1
                    sums[_TERMS] += size
                    sums.update(_frequencies(automaton, text).keys())
        yield pa.RecordBatch.from_arrays([pa.array(sums.keys(), pa.int32()), pa.array(sums.values(), pa.int64())], ["term", "n"])

    found = docs.mapInArrow(count, "term int, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    sums = dict(found.toLocalIterator())
    return sums.get(_DOCUMENTS, 0), sums.get(_TERMS, 0), np.array([sums.get(t, 0) for t in range(len(terms))], dtype=np.int64)


def _scores(found: list[Counter[int]], lengths: np.ndarray, first: np.ndarray, item: np.ndarray, weight: np.ndarray, items: int) -> np.ndarray:
    """Scores, documents by items. ``lengths`` has the number m of each document."""
    sizes = np.array([len(f) for f in found])
    doc = np.repeat(np.arange(len(found)), sizes)
    term = np.fromiter((t for f in found for t in f), dtype=np.int64, count=sizes.sum())
    tf = np.fromiter((n for f in found for n in f.values()), dtype=np.int64, count=sizes.sum())
    share = (1_000_000_000 * tf) // (1000 * tf + 12 * lengths[doc])
    out = np.zeros(len(found) * items, dtype=np.int64)
    holders = first[term + 1] - first[term]
    ends = np.cumsum(holders)
    start = 0
    while start < len(term):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + _PRODUCTS)))
        some = slice(start, stop)
        n = holders[some]
        places = np.repeat(first[term[some]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        np.add.at(out, np.repeat(doc[some], n) * items + item[places], np.repeat(share[some], n) * weight[places])
        start = stop
    return out.reshape(len(found), items)


def _best_of(docs: DataFrame, block: _Block, number: int, kinds: tuple[str, str], item_type: pa.DataType, k: int) -> DataFrame:
    """(_block, _item, item, id, score): what may be among the ``k`` best of each item of a block."""
    terms = list(block.terms)
    documents, length, df = _totals(docs.select("text"), terms)
    first, item, times = block.outputs()
    held = [math.floor(1000 * math.log((2 * documents + 2) / (2 * d + 1))) for d in df.tolist()]
    weight = times * np.repeat(np.array(held, dtype=np.int64), np.diff(first))
    ids = pa.array(block.ids, item_type)
    shared = docs.sparkSession.sparkContext.broadcast((terms, first, item, weight, ids))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, first, item, weight, ids = shared.value
        automaton, items = _automaton(terms), len(ids)
        best = np.zeros((0, items), dtype=np.int64)
        for batch in batches:
            folded = _folded(batch.column(1))
            sizes = np.array([len(text.split()) for text in folded], dtype=np.int64)
            rows = np.flatnonzero(sizes)
            if not len(rows):
                continue
            lengths = 75 + (25 * sizes[rows] * documents) // length
            score = _scores([_frequencies(automaton, folded[row]) for row in rows], lengths, first, item, weight, items)
            # A row that scores less than k others of this task is not among the k best, whatever its id.
            best = np.sort(np.concatenate((best, score)), axis=0)[-k:]
            least = np.maximum(best[0], 1) if len(best) == k else np.ones(items, dtype=np.int64)
            row, of = np.nonzero(score >= least)
            columns = [
                pa.array(np.full(len(row), number, dtype=np.int32)), pa.array(of.astype(np.int32)), ids.take(pa.array(of)),
                batch.column(0).take(pa.array(rows[row])), pa.array(score[row, of]),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["_block", "_item", "item", "id", "score"])

    return docs.mapInArrow(search, f"_block int, _item int, item {kinds[0]}, id {kinds[1]}, score bigint")


def ranked_search(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", k: int = 20,
) -> DataFrame:
    """(item, rank, id, score): the ``k`` documents of the highest scores above 0 for each row of ``items``.

    Terms are runs of ASCII letters and digits and of characters beyond ASCII, with A to Z lower-cased. Equal scores go by
    ascending id, NULL ids last. NULL and empty texts have no term: as documents they count for nothing, as items they have no
    rows. Repeated documents count and are listed each; equal rows of ``items`` count once, and rows with one id and different
    texts are ranked each by itself. Empty tables give an empty result; other columns are not looked at.
    """
    spark = docs.sparkSession
    small_batches(spark)
    kinds = sql_type(items, item_col), sql_type(docs, id_col)
    asked = items.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text")).distinct().orderBy("item", "text")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    item_type = spark.createDataFrame([], f"item {kinds[0]}").toArrow().schema.field("item").type
    found = spark.createDataFrame([], f"_block int, _item int, item {kinds[0]}, id {kinds[1]}, score bigint")
    for number, block in enumerate(_blocks(asked)):
        best = _best_of(rows, block, number, kinds, item_type, k)
        found = best if number == 0 else found.unionByName(best)
    order = Window.partitionBy("_block", "_item").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score")
