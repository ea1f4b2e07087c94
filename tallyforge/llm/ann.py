"""Nearest neighbours by randomly rotated one-bit codes.

Each vector, less the mean, is scaled to length one and rotated at random; the signs of its coordinates are its code. With two
numbers beside it, the length and the inner product of vector and code, the inner product with any query can be estimated, and
the error is below a bound except with small probability. So each distance has a lower and an upper bound. A vector can be
left out for a query if its lower bound is above the k-th smallest upper bound; the rest is ranked by exact distances, in the
task that has chosen it, so that only the nearest of each task leave it and never the pairs that were ranked.

Codes and queries meet in a grid: codes are dealt into chunks, queries into blocks, and each pair of chunk and block is a task
of bounded size. Equal vectors have one code, and only as many of their ids as a result can show are carried along, so that
copies in any number cost nothing in the grid.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.llm.vectors import comparable, matrix
from tallyforge.plans.durable import materialize

#: Rows of a chunk of codes and of a block of queries, at most about; smaller chunks give every core work.
CHUNK, BLOCK, _LEAST_CHUNK = 131_072, 16_384, 4_096
#: Width of the error bound: it holds for an estimate with a probability of about 95%.
BOUND = 1.9
#: Codes that are unpacked at a time, and queries they are held against.
_CODES, _QUERIES = 4_096, 512
_SEED = 7


def rotation(size: int) -> np.ndarray:
    """A random rotation, the same for every run."""
    q, r = np.linalg.qr(np.random.default_rng(_SEED).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def _codes(classes: DataFrame, centre: np.ndarray, turn: np.ndarray) -> DataFrame:
    """(rep, vec, code, length, factor): signs of the rotated unit vectors, and their inner product with the vector they stand for."""
    size = len(centre)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            moved = matrix(batch.column(1), size) - centre
            length = np.linalg.norm(moved, axis=1)
            unit = np.divide(moved, length[:, None], out=np.zeros_like(moved), where=length[:, None] > 0) @ turn.T
            bits = np.packbits(unit > 0, axis=1)
            factor = np.abs(unit).sum(axis=1) / math.sqrt(size)
            columns = [*batch.columns, pa.array([row.tobytes() for row in bits]), pa.array(length), pa.array(factor)]
            yield pa.RecordBatch.from_arrays(columns, ["rep", "vec", "code", "length", "factor"])

    rep = classes.schema["rep"].dataType.simpleString()
    return classes.select("rep", "vec").mapInArrow(run, f"rep {rep}, vec array<double>, code binary, length double, factor double")


def _bounds(codes: np.ndarray, length: np.ndarray, factor: np.ndarray, queries: np.ndarray, reach: np.ndarray) -> tuple:
    """Lower and upper bounds of the squared distances, codes by queries; ``queries`` are rotated unit vectors."""
    size = queries.shape[1]
    signs = np.unpackbits(codes, axis=1, count=size).astype(np.float32) * 2 - 1
    inner = (signs @ queries.T.astype(np.float32)) / math.sqrt(size)
    # A vector at the mean has no direction: its factor is zero, and so is what it adds.
    safe = np.where(factor > 0, factor, 1.0)[:, None]
    cosine = inner / safe
    error = np.sqrt(np.maximum(0, 1 - safe**2)) / safe * (BOUND / math.sqrt(max(1, size - 1))) + 1e-5
    both = 2 * length[:, None] * reach[None, :]
    base = length[:, None] ** 2 + reach[None, :] ** 2
    return base - both * np.minimum(1, cosine + error), base - both * np.maximum(-1, cosine - error)


def _nearest_of_block(codes: pa.Table, queries: pa.Table, centre: np.ndarray, turn: np.ndarray, most: int) -> pa.Table:
    """(query, rep, score): the ``most`` nearest of one chunk for each query of one block, ties to the smaller rep."""
    size = len(centre)
    reps, vectors = codes.column("rep").to_numpy(), matrix(codes.column("vec").combine_chunks(), size)
    code = np.frombuffer(b"".join(codes.column("code").to_pylist()), dtype=np.uint8).reshape(len(reps), -1)
    length, factor = codes.column("length").to_numpy(), codes.column("factor").to_numpy()
    names, asked = queries.column("query").to_numpy(), matrix(queries.column("vec").combine_chunks(), size)
    moved = asked - centre
    reach = np.linalg.norm(moved, axis=1)
    unit = np.divide(moved, reach[:, None], out=np.zeros_like(moved), where=reach[:, None] > 0) @ turn.T
    out = []
    for q in range(0, len(names), _QUERIES):
        some = slice(q, q + _QUERIES)
        count = len(names[some])
        near = np.empty((0, count))
        rows, cols, lows = [], [], []
        for c in range(0, len(reps), _CODES):
            part = slice(c, c + _CODES)
            low, high = _bounds(code[part], length[part], factor[part], unit[some], reach[some])
            near = np.concatenate((near, high))
            if len(near) > most:
                near = np.partition(near, most - 1, axis=0)[:most]
            limit = near.max(axis=0) if len(near) == most else np.full(count, np.inf)
            row, col = np.nonzero(low <= limit)
            rows.append((row + c).astype(np.int32)), cols.append(col.astype(np.int32)), lows.append(low[row, col])
        row, col, low = (np.concatenate(x) for x in (rows, cols, lows))
        last = low <= limit[col]
        row, col = row[last], col[last]
        order = np.argsort(col, kind="stable")
        row, col = row[order], col[order]
        # The rest is ranked exactly, one query at a time.
        edges = np.searchsorted(col, np.arange(count + 1))
        for n in range(count):
            chosen = row[edges[n] : edges[n + 1]]
            score = np.sqrt(((vectors[chosen] - asked[q + n]) ** 2).sum(axis=1))
            best = np.lexsort((reps[chosen], score))[:most]
            out.append((np.full(len(best), names[q + n]), reps[chosen[best]], score[best]))
    columns = [np.concatenate(x) for x in zip(*out, strict=True)]
    return pa.table(columns, names=["query", "rep", "score"])


def nearest(
    vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries`` the ``k`` nearest rows of ``vectors`` with another id.

    ``score`` is the Euclidean distance of the vectors as given, in double precision; ties go to the smaller id. NULL ids, and
    vectors that are NULL, zero, or hold a NULL or a number that is not finite, take no part. Vectors are compared with those of
    their own length. An id on several vectors is as far as the nearest of them, on either side. A row that is repeated counts
    once as a neighbour, and once as a query. Fewer than ``k`` rows give shorter results, an empty table an empty one; other
    columns are not looked at.
    """
    rows = materialize(comparable(vectors, id_col, vector_col), "ann-vectors")
    asked = materialize(comparable(queries, id_col, vector_col), "ann-queries")
    sizes = [row["size"] for row in asked.select(F.size("_vec").alias("size")).distinct().orderBy("size").collect()]
    found = None
    for size in sizes:  # one, in a table of embeddings
        near = _nearest_of_size(rows.where(F.size("_vec") == size), asked.where(F.size("_vec") == size), size, k)
        found = near if found is None else found.unionByName(near)
    if found is None:
        found = asked.select(F.col("_id").alias("query_id"), F.col("_id").alias("vec_id"), F.lit(0.0).alias("score"))
    if len(sizes) > 1:  # an id may stand on vectors of several lengths
        found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id")))
    return found.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _nearest_of_size(rows: DataFrame, asked: DataFrame, size: int, k: int) -> DataFrame:
    """(query_id, vec_id, score) of (_id, _vec) of one length: what can be among the ``k`` nearest of each query."""
    spark = rows.sparkSession
    # One row per distinct vector, with the ids a result can show: k, and one more, since a query is not its own neighbour.
    firsts = rows.distinct().withColumn("_n", F.row_number().over(Window.partitionBy("_vec").orderBy("_id")))
    firsts = firsts.where(F.col("_n") <= k + 1).groupBy(F.col("_vec").alias("vec"))
    # Classes go by number, in the order of their smallest ids, by which ties are told: two vectors may have one id.
    classes = firsts.agg(F.min("_id").alias("least"), F.collect_list("_id").alias("ids")).orderBy("least", "vec")
    classes = classes.withColumn("rep", F.monotonically_increasing_id())
    classes = materialize(classes, "ann-classes")
    asked = asked.distinct()
    asked = asked.join(classes, F.col("_vec") == F.col("vec")).select(F.col("_id").alias("query_id"), F.col("rep").alias("query"))
    asked = materialize(asked, "ann-asked")

    means = classes.agg(F.count(F.lit(1)).alias("n"), *[F.avg(F.col("vec")[i]).alias(f"m{i}") for i in range(size)]).head()
    centre, turn = np.array([means[f"m{i}"] or 0.0 for i in range(size)], dtype=float), rotation(size)
    codes = materialize(_codes(classes, centre, turn), "ann-codes")
    distinct_queries = asked.select(F.col("query").alias("rep")).distinct().join(classes.select("rep", "vec"), "rep")
    distinct_queries = materialize(distinct_queries.withColumnRenamed("rep", "query"), "ann-queries")

    cores = spark.sparkContext.defaultParallelism
    chunks = max(1, math.ceil(means["n"] / CHUNK), min(cores, math.ceil(means["n"] / _LEAST_CHUNK)))
    blocks = max(1, math.ceil(distinct_queries.count() / BLOCK))
    dealt = codes.withColumn("chunk", F.pmod(F.xxhash64("rep"), F.lit(chunks)))
    dealt = dealt.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    posed = distinct_queries.withColumn("block", F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int"))
    posed = posed.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(chunks - 1).cast("bigint"))))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            key = left.schema.field("rep").type
            return pa.table([pa.array([], key), pa.array([], key), pa.array([], pa.float64())], names=["query", "rep", "score"])
        return _nearest_of_block(left, right, centre, turn, k + 1)

    found = dealt.groupBy("chunk", "block").cogroup(posed.groupBy("chunk", "block")).applyInArrow(
        search, "query bigint, rep bigint, score double"
    )
    best = Window.partitionBy("query").orderBy("score", "rep")
    found = found.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= k + 1).drop("_n")
    ranked = found.join(classes.select("rep", "ids"), "rep").select("query", "score", F.explode("ids").alias("vec_id"))
    order = ["score", "vec_id"]
    ranked = ranked.withColumn("_n", F.row_number().over(Window.partitionBy("query").orderBy(*order))).where(F.col("_n") <= k + 1)
    ranked = materialize(ranked.drop("_n"), "ann-ranked")
    out = asked.join(ranked, "query").where(F.col("query_id") != F.col("vec_id"))
    return out.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
