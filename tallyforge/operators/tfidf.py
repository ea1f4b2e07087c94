"""Term and document frequencies and the weighted document-term matrix, all in long form."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.functions.scalars import idf as idf_of
from tallyforge.plans.durable import materialize
from tallyforge.plans.layout import computed_once, unnest

# Default vocabulary size and the least number of terms of a document.
VOCABULARY = 50_000
MIN_TERMS = 1

# A vocabulary is a top-n by definition; up to this many rows of (term, number, weight) it is sent to every executor.
BROADCAST_TERMS = 200_000


def min_terms_filter(docs: DataFrame, terms: str = "terms", more_than: int = MIN_TERMS) -> DataFrame:
    """Documents with more than one term."""
    return docs.where(F.size(terms) > more_than)


def term_freq(
    docs: DataFrame, doc: str = "doc_id", terms: str = "terms", more_than: int = MIN_TERMS
) -> DataFrame:
    """Count ``tf`` of each term within a document, for documents with more than one term.

    ``doc_terms`` is the number of terms of the document: the length of its array, carried along, so it needs no second
    aggregation and no join. ``opens`` is 1 in one row per document (that of its first term), so its sum counts the
    documents. The least number of terms is checked on the result: a filter on the array would build it twice. A document
    that is one row, as a rule, is counted within the row, so that no term is shuffled with its document; only documents of
    several rows, of which a list is written first, are put together.
    """
    rows = docs.select(F.col(doc).alias("doc"), F.col(terms).alias("_terms"))
    several = rows.groupBy("doc").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)
    several = materialize(several.select(F.col("doc").alias("_doc")), "repeated-documents")
    if several.isEmpty():
        return _of_rows(rows).where(F.col("doc_terms") > more_than).withColumnRenamed("doc", doc)
    repeated = F.col("doc").eqNullSafe(F.col("_doc"))
    again = materialize(rows.join(several, repeated, "left_semi"), "repeated-terms")
    counts = _of_rows(again).groupBy("doc", "term").agg(
        F.sum("tf").alias("tf"), F.max("doc_terms").alias("doc_terms"), F.max("opens").alias("opens")
    )
    counts = counts.unionByName(_of_rows(rows.join(several, repeated, "left_anti")))
    return counts.where(F.col("doc_terms") > more_than).withColumnRenamed("doc", doc)


def _of_rows(rows: DataFrame) -> DataFrame:
    """(doc, term, tf, doc_terms, opens) of each row by itself.

    Equal terms stand together in the sorted list, so the count of a term is the distance to where the next one starts.
    Lists that lambdas look into are columns of their own, computed once; beside an explode they would be copied into
    every row.
    """
    once = computed_once(rows.select("doc", "_terms"), "_list", F.col("_terms"))
    first = F.get("_list", F.lit(0))
    once = once.select("doc", F.size("_list").alias("doc_terms"), first.alias("_first"), F.array_sort("_list").alias("_sorted"))
    once = computed_once(once, "_in_order", F.col("_sorted")).drop("_sorted")
    heads = F.filter(
        F.transform("_in_order", lambda t, i: F.when((i == 0) | ~t.eqNullSafe(F.get("_in_order", i - 1)), i)), lambda i: i.isNotNull()
    )
    once = computed_once(once, "_heads", heads)
    counted = F.transform("_heads", lambda i, n: F.struct(
        F.get("_in_order", i).alias("term"),
        (F.coalesce(F.get("_heads", n + 1), F.col("doc_terms")) - i).cast("bigint").alias("tf"),
        F.get("_in_order", i).eqNullSafe(F.col("_first")).cast("int").alias("opens"),
    ))
    cells = unnest(once, ("doc", "doc_terms"), counted, "_cell").where(F.col("_cell.term").isNotNull())
    return cells.select("doc", "_cell.term", "_cell.tf", "doc_terms", "_cell.opens")


def doc_count(tf: DataFrame):
    """Number of documents, as a scalar column."""
    return tf.agg(F.sum("opens")).scalar()


def doc_freq(tf: DataFrame) -> DataFrame:
    """Number of documents per term; ``tf`` has one row per document and term."""
    return tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def vocabulary(df: DataFrame, n: int = VOCABULARY) -> DataFrame:
    """The n terms in most documents, numbered from 0 by frequency and then by name."""
    top = df.orderBy(F.desc("df"), "term").limit(n)
    # n rows at most reach this window.
    order = Window.orderBy(F.desc("df"), "term")
    return top.withColumn("idx", F.row_number().over(order) - 1)


def idf(df: DataFrame, n_docs, n: int = VOCABULARY) -> DataFrame:
    """Vocabulary with ``idf`` = ln(documents / document frequency). ``n_docs`` is a number or scalar column."""
    return vocabulary(df, n).withColumn("idf", idf_of(F.lit(n_docs) if isinstance(n_docs, int) else n_docs, "df"))


def vocabulary_of(tf: DataFrame, n: int = VOCABULARY) -> DataFrame:
    """The vocabulary with its idf, from term frequencies."""
    return idf(doc_freq(tf), doc_count(tf), n)


def weigh(tf: DataFrame, vocab: DataFrame, n: int = VOCABULARY, doc: str = "doc_id") -> DataFrame:
    """Rows (document, term, idx, weight), weight = idf * tf / terms of the document, for terms of the vocabulary."""
    small = vocab.select("term", "idx", "idf")
    small = F.broadcast(small) if n <= BROADCAST_TERMS else small
    return tf.join(small, "term").select(
        doc, "term", "idx", (F.col("idf") * F.col("tf") / F.col("doc_terms")).alias("weight")
    )


def tfidf_matrix(docs: DataFrame, n: int = VOCABULARY, doc: str = "doc_id", terms: str = "terms") -> DataFrame:
    """The weighted document-term matrix over the n commonest terms, in long form.

    ``docs`` has one row per document. Terms outside the vocabulary count towards the document's total. The frequencies
    are needed for the vocabulary, the document count and the weights, so they are written once and texts are split once.
    """
    tf = materialize(term_freq(docs, doc, terms), "term-frequencies")
    return weigh(tf, vocabulary_of(tf, n), n, doc)
