"""Words, terms, TF-IDF and latent semantic analysis."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyforge.catalog import fixtures as fx
from tallyforge.catalog.registry import query, rounded, table
from tallyforge.catalog.sources import _WORDS, document_lines, terms_sql
from tallyforge.functions.terms import only_letters, term_rows, words
from tallyforge.functions.vectors import array_literal
from tallyforge.operators import counting, lsa, tfidf
from tallyforge.plans.durable import materialize


@query("tokenize_space", r"""
WITH lines AS (SELECT doc_id, unnest(regexp_split_to_array(text, '\r\n|\r|\n')) AS value FROM documents),
words AS (SELECT doc_id, unnest(CASE WHEN length(value) > 0 AND rtrim(value, ' ') = '' THEN []
                                ELSE string_split(rtrim(value, ' '), ' ') END) AS word FROM lines)
SELECT doc_id, word, count(*) AS cnt FROM words GROUP BY ALL""")
def tokenize_space(spark, folder):
    rows = document_lines(spark, folder).withColumn("words", counting.split_on_spaces("value"))
    rows = rows.select("doc_id", F.explode("words").alias("word"))
    return rows.groupBy("doc_id", "word").agg(F.count(F.lit(1)).alias("cnt"))


@query("word_count", f"{_WORDS} SELECT word, count(*) AS cnt FROM words GROUP BY word")
def word_count(spark, folder):
    return counting.word_count(document_lines(spark, folder))


_TERMS = f"WITH {terms_sql()}"


@query("normalize_terms", f"{_TERMS} SELECT doc_id, term, count(*) AS cnt FROM terms GROUP BY ALL")
def normalize_terms(spark, folder):
    rows = term_rows(fx.documents(spark, folder), "text", ("doc_id",))
    return rows.groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("cnt"))


@query("only_letters", r"""
SELECT doc_id, regexp_full_match(word, '\p{L}*') AS letters, count(*) AS cnt
FROM (SELECT doc_id, unnest(regexp_split_to_array(text, '[^\p{L}\p{N}'']+')) AS word FROM documents)
WHERE word <> '' GROUP BY ALL""")
def only_letters_query(spark, folder):
    rows = fx.documents(spark, folder).select("doc_id", F.explode(words("text")).alias("word"))
    return rows.groupBy("doc_id", only_letters("word").alias("letters")).agg(F.count(F.lit(1)).alias("cnt"))


@query("min_terms_filter", f"{_TERMS} SELECT doc_id, count(*)::INT AS n FROM terms GROUP BY doc_id HAVING count(*) > 1")
def min_terms_filter(spark, folder):
    docs = fx.document_terms(spark, folder)
    return tfidf.min_terms_filter(docs).select("doc_id", F.size("terms").alias("n"))


_DOCS = f"""{_TERMS}, sized AS (SELECT doc_id, count(*) AS doc_terms FROM terms GROUP BY 1 HAVING count(*) > 1),
tf AS (SELECT doc_id, doc_terms, term, count(*) AS tf FROM terms JOIN sized USING (doc_id) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1)"""
_VOCAB = f"""{_DOCS}, vocab AS (
SELECT term, df, (row_number() OVER (ORDER BY df DESC, term) - 1)::INT AS idx,
       ln((SELECT count(*) FROM sized) / df) AS idf FROM df QUALIFY idx < SIZE)"""
SIZE = 50_000


@query("term_freq", f"{_DOCS} SELECT doc_id, doc_terms::INT AS doc_terms, term, tf FROM tf")
def term_freq(spark, folder):
    return tfidf.term_freq(fx.document_terms(spark, folder)).drop("opens")


@query("doc_freq", f"{_DOCS} SELECT term, df FROM df")
def doc_freq(spark, folder):
    return tfidf.doc_freq(tfidf.term_freq(fx.document_terms(spark, folder)))


@query("idf", _VOCAB.replace("SIZE", str(SIZE)) + " SELECT term, df, idx, round(idf, 6) AS idf FROM vocab")
def idf(spark, folder):
    tf = tfidf.term_freq(fx.document_terms(spark, folder))
    return tfidf.vocabulary_of(tf, SIZE).withColumn("idf", rounded("idf"))


_MATRIX = _VOCAB + ", m AS (SELECT doc_id, term, idx, idf * tf / doc_terms AS weight FROM tf JOIN vocab USING (term))"


@query("tfidf_matrix", _MATRIX.replace("SIZE", "50000") + " SELECT doc_id, term, idx, round(weight, 6) AS weight FROM m")
def tfidf_matrix(spark, folder):
    return tfidf.tfidf_matrix(fx.document_terms(spark, folder)).withColumn("weight", rounded("weight"))


@query("term_doc_lookup", _MATRIX.replace("SIZE", str(SIZE)) + """
SELECT term, concat(source, '/', doc_id) AS title, round(weight, 6) AS weight
FROM (SELECT * FROM m ORDER BY round(weight, 9) DESC, doc_id, term LIMIT 100) JOIN documents USING (doc_id)""")
def term_doc_lookup(spark, folder):
    weights = tfidf.tfidf_matrix(fx.document_terms(spark, folder), SIZE)
    best = counting.topk_by_count(weights.withColumn("w", F.round("weight", 9)), 100, "w", ["doc_id", "term"])
    titles = table(spark, folder, "documents").select("doc_id", F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("title"))
    return lsa.attach_names(best, titles, "doc_id").select("term", "title", rounded("weight").alias("weight"))


@query("topk_by_count", f"{_WORDS} SELECT word, count(*) AS cnt FROM words GROUP BY 1 ORDER BY cnt DESC, word LIMIT 10")
def topk_by_count(spark, folder):
    return counting.topk_by_count(counting.word_count(document_lines(spark, folder)), 10, ties=["word"])


@query("trim_by_frequency", f"{_WORDS} SELECT word, count(*) AS cnt FROM words GROUP BY 1 ORDER BY cnt, word LIMIT 1000")
def trim_by_frequency(spark, folder):
    return counting.trim_by_frequency(counting.word_count(document_lines(spark, folder)), 1000, ties=["word"])


@query("contains_filter", """
SELECT p_name AS topic, count(*) AS cnt FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE contains(p_name, 'plate') GROUP BY 1""")
def contains_filter(spark, folder):
    topics = fx.fixture(spark, folder, fx.NAME_TOPICS)
    return counting.count_by_value(counting.contains_filter(topics, "topic", "plate"), "topic")


# Matrix operators on the embeddings, taken as rows of a factor.
_ROWS = """rows AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS vec FROM embeddings),
diag AS (SELECT list_transform(range(64), lambda i: 1.0 + i / 64.0) AS s),
scaled AS (SELECT vec_id, list_transform(list_zip(vec, s), lambda p: p[1] * p[2]) AS vec FROM rows, diag),
normal AS (SELECT vec_id, list_transform(vec, lambda x: x / n) AS vec
           FROM (SELECT *, sqrt(list_sum(list_transform(vec, lambda x: x * x))) AS n FROM scaled))"""
_DOT = "list_sum(list_transform(list_zip(a.vec, b.vec), lambda p: p[1] * p[2]))"
_DIAGONAL = [1.0 + i / 64.0 for i in range(64)]


def rows(spark, folder):
    return fx.vectors(spark, folder, "vec").select("vec_id", "vec")


def _long(df, digits=6):
    cells = df.select("vec_id", F.posexplode("vec").alias("pos", "x"))
    return cells.select("vec_id", "pos", rounded("x", digits).alias("x"))


_CELLS = "SELECT vec_id, unnest(range(64))::INT AS pos, round(unnest(vec), 6) + 0.0 AS x FROM"


@query("matrix_row", f"WITH {_ROWS} {_CELLS} rows WHERE vec_id = 42")
def matrix_row(spark, folder):
    return _long(lsa.matrix_row(rows(spark, folder), "vec_id", 42))


@query("scale_by_diagonal", f"WITH {_ROWS} {_CELLS} scaled")
def scale_by_diagonal(spark, folder):
    return _long(lsa.scale_by_diagonal(rows(spark, folder), _DIAGONAL))


def normal(spark, folder):
    return lsa.rows_normalize(lsa.scale_by_diagonal(rows(spark, folder), _DIAGONAL))


@query("rows_normalize", f"WITH {_ROWS} {_CELLS} normal")
def rows_normalize(spark, folder):
    return _long(normal(spark, folder))


def _best(a, b, where):
    return f"""WITH {_ROWS} SELECT a.vec_id, round({_DOT}, 6) + 0.0 AS score FROM {a} a, {b} b WHERE {where}
ORDER BY {_DOT} DESC, a.vec_id LIMIT 10"""


def _scores(df):
    return df.withColumn("score", rounded("score"))


@query("lsa_terms_for_term", _best("normal", "normal", "b.vec_id = 7"))
def lsa_terms_for_term(spark, folder):
    return _scores(lsa.similar_rows(normal(spark, folder), "vec_id", 7))


@query("lsa_docs_for_doc", _best("normal", "normal", "b.vec_id = 11"))
def lsa_docs_for_doc(spark, folder):
    return _scores(lsa.similar_rows(normal(spark, folder), "vec_id", 11))


@query("lsa_docs_for_term", _best("scaled", "rows", "b.vec_id = 13"))
def lsa_docs_for_term(spark, folder):
    us = lsa.scale_by_diagonal(rows(spark, folder), _DIAGONAL)
    return _scores(lsa.docs_for_row(us, rows(spark, folder), "vec_id", 13, doc="vec_id"))


@query("lsa_docs_for_query", f"""
WITH {_ROWS}, cells AS (SELECT unnest(range(64)) AS pos, unnest(vec) * ((vec_id % 7) / 10) AS x FROM rows),
concepts AS (SELECT pos, sum(x) AS x FROM cells GROUP BY 1), b AS (SELECT list(x ORDER BY pos) AS vec FROM concepts)
SELECT vec_id, round({_DOT}, 6) + 0.0 AS score FROM scaled a, b ORDER BY {_DOT} DESC, vec_id LIMIT 10""")
def lsa_docs_for_query(spark, folder):
    v = rows(spark, folder).withColumnRenamed("vec_id", "idx")
    query_vector = v.select("idx", ((F.col("idx") % 7) / 10).alias("value"))
    us = lsa.scale_by_diagonal(rows(spark, folder), array_literal(_DIAGONAL))
    return _scores(lsa.docs_for_query(us, v, query_vector, doc="vec_id"))


QUERY_TERMS = ("the", "and", "ion", "que", "der", "und", "leth")


@query("lsa_query_vector", _VOCAB.replace("SIZE", str(SIZE)) + f"""
SELECT idx, term, round(idf, 6) AS value FROM vocab WHERE term IN {QUERY_TERMS}""")
def lsa_query_vector(spark, folder):
    vocab = tfidf.vocabulary_of(tfidf.term_freq(fx.document_terms(spark, folder)), SIZE)
    return lsa.lsa_query_vector(vocab, QUERY_TERMS).withColumn("value", rounded("value"))


@query("topk_per_group", f"""
WITH {_ROWS}, cells AS (SELECT vec_id, unnest(range(64))::INT AS concept, unnest(vec) AS weight FROM rows)
SELECT concept, vec_id, round(weight, 6) + 0.0 AS weight,
       row_number() OVER (PARTITION BY concept ORDER BY weight DESC, vec_id)::INT AS rank
FROM cells QUALIFY rank <= 10""")
def topk_per_group(spark, folder):
    top = lsa.lsa_top(rows(spark, folder), "vec_id", concepts=64, n=10)
    return top.select("concept", "vec_id", rounded("weight").alias("weight"), "rank")


def decomposition(spark, folder, k=lsa.RANK):
    tf = materialize(tfidf.term_freq(fx.document_terms(spark, folder)))
    vocab = materialize(tfidf.vocabulary_of(tf, SIZE))
    return lsa.lsa_svd(tfidf.weigh(tf, vocab, SIZE), vocab.count(), k), vocab


@query("lsa_svd")
def lsa_svd(spark, folder):
    svd, _ = decomposition(spark, folder)
    return svd.u.select("doc_id", F.posexplode("vec").alias("concept", "weight"))


@query("lsa_top_terms")
def lsa_top_terms(spark, folder):
    svd, vocab = decomposition(spark, folder)
    return lsa.lsa_top_terms(svd, vocab)


@query("lsa_top_docs")
def lsa_top_docs(spark, folder):
    svd, _ = decomposition(spark, folder)
    titles = table(spark, folder, "documents").select("doc_id", F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("title"))
    return lsa.lsa_top_docs(svd, titles)
