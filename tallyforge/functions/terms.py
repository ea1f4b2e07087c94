"""From text to terms."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.stopwords import ENGLISH_STOPWORDS
from tallyforge.plans.durable import materialize
from tallyforge.plans.layout import unnest

# Fixed value: a word is a run of letters, digits and apostrophes.
WORD_BREAK = r"[^\p{L}\p{N}']+"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def only_letters(text: Column | str) -> Column:
    """Whether every character is a letter; true for empty text."""
    return _col(text).rlike(r"^\p{L}*\z")


def words(text: Column | str) -> Column:
    return F.filter(F.split(_col(text), WORD_BREAK), lambda w: F.length(w) > 0)


def _is_term(word: Column, stopwords: Iterable[str]) -> Column:
    # The stop list is matched before lower-casing, so a capitalised stop word is a term.
    return (F.length(word) > 2) & only_letters(word) & ~word.isin(*stopwords)


def term_rows(
    df: DataFrame,
    text: str,
    keep: tuple[str, ...],
    stopwords: Iterable[str] | DataFrame = ENGLISH_STOPWORDS,
    lemmas: DataFrame | None = None,
) -> DataFrame:
    """One row per term of each text, in lower case.

    ``stopwords`` is a word list or a DataFrame with column ``word``; ``lemmas`` maps ``word`` to ``lemma``. Word tables are
    written without repeats first, so that adaptive execution can split frequent words in the joins.
    """
    rows = unnest(df, keep, F.split(F.col(text), WORD_BREAK), "word")
    if lemmas is not None:
        base = materialize(lemmas.groupBy("word").agg(F.min("lemma").alias("lemma")), "lemmas")
        rows = rows.join(base, "word", "left").select(*keep, F.coalesce("lemma", "word").alias("word"))
    if isinstance(stopwords, DataFrame):
        rows = rows.join(materialize(stopwords.select("word").distinct(), "stopwords"), "word", "left_anti")
        stopwords = ()
    banned = list(stopwords)
    word = F.col("word")
    rule = (F.length(word) > 2) & only_letters(word)
    if banned:
        rule = rule & ~word.isin(*banned)
    return rows.where(rule).select(*keep, F.lower(word).alias("term"))


def term_list(text: Column | str, stopwords: Iterable[str] = ENGLISH_STOPWORDS) -> Column:
    """The terms of a text as one array, without a shuffle."""
    banned = list(stopwords)
    kept = F.filter(F.split(_col(text), WORD_BREAK), lambda w: _is_term(w, banned))
    return F.transform(kept, lambda w: F.lower(w))
