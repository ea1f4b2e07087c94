"""Inputs in the operators' own layouts, derived from whole test tables.

Every SQL text gives the same rows in Spark and in the checking engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.catalog.registry import sql, table
from tallyforge.functions.terms import term_list
from tallyforge.plans.durable import new_folder
from tallyforge.plans.layout import spread

AD_LINES = """
SELECT event_id, ts,
       CASE WHEN event_id % 97 = 0 THEN '{bad' ELSE concat(
         '{"type":"', CASE WHEN event_type = 'error' THEN 'sys_log' ELSE 'ad_log' END,
         '","payload":{"time":"', substring(cast(ts AS string), 1, 19),
         '","query_type":"', event_type,
         '","os":"os', cast(user_id % 3 AS string),
         '","source_type":"st', cast(user_id % 2 AS string),
         '","appid":"app', cast(event_id % 4 AS string),
         CASE WHEN event_id % 89 = 0 THEN '' ELSE concat('","source":"src', cast(event_id % 5 AS string)) END,
         '","active":"', CASE WHEN value >= 100 THEN '1' ELSE '0' END,
         '","did":"d', cast(user_id AS string), '","user_type":"u', cast(user_id % 2 AS string),
         '","gameuid":"g', cast(user_id AS string), '","ip":"10.0.0.', cast(user_id % 256 AS string), '"}}') END AS line
FROM events"""

ACCESS_LINES = """
SELECT event_id, ts,
       CASE WHEN event_id % 50 = 0 THEN 'garbage line' ELSE concat(
         '10.0.0.', cast(user_id % 256 AS string), ' - u', cast(user_id AS string),
         ' [', substring(cast(ts AS string), 9, 2), '/Jan/2024:', substring(cast(ts AS string), 12, 8), ' +0000] "GET /',
         event_type, '/', cast(event_id % 7 AS string), CASE WHEN event_id % 3 = 0 THEN '/' ELSE '' END,
         ' HTTP/1.1" ', CASE WHEN event_type = 'error' THEN '500' WHEN event_id % 9 = 0 THEN '404' ELSE '200' END, ' ',
         CASE WHEN event_id % 10 = 1 THEN '-' ELSE cast(event_id % 5000 AS string) END,
         ' "http://ref.example/x" "agent a"') END AS line
FROM events"""

LINKAGE = """
SELECT cast(l_orderkey AS int) AS id_1, l_linenumber AS id_2,
       CASE WHEN (l_orderkey + 0) % 11 = 0 THEN NULL ELSE l_quantity / 50.0 END AS s0,
       CASE WHEN (l_orderkey + 1) % 11 = 0 THEN NULL ELSE l_discount * 10.0 END AS s1,
       CASE WHEN (l_orderkey + 2) % 11 = 0 THEN NULL ELSE l_tax * 10.0 END AS s2,
       CASE WHEN (l_orderkey + 3) % 11 = 0 THEN NULL ELSE l_linenumber / cast(7.0 AS double) END AS s3,
       CASE WHEN (l_orderkey + 4) % 11 = 0 THEN NULL ELSE (l_partkey % 100) / cast(100.0 AS double) END AS s4,
       CASE WHEN (l_orderkey + 5) % 11 = 0 THEN NULL ELSE (l_suppkey % 10) / cast(10.0 AS double) END AS s5,
       CASE WHEN (l_orderkey + 6) % 11 = 0 THEN NULL ELSE (l_orderkey % 10) / cast(10.0 AS double) END AS s6,
       CASE WHEN (l_orderkey + 7) % 11 = 0 THEN NULL ELSE l_quantity / 25.0 END AS s7,
       CASE WHEN (l_orderkey + 8) % 11 = 0 THEN NULL ELSE l_discount * 5.0 END AS s8,
       l_returnflag = 'R' AS is_match
FROM lineitem"""
SCORE_COLUMNS = [f"s{i}" for i in range(9)]

RATINGS = """
SELECT cast(o_custkey AS int) AS user_id, cast(l_partkey AS int) AS item_id, cast(count(*) AS int) AS cnt
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey, l_partkey"""

ITEM_NAMES = """
SELECT CASE WHEN p_partkey % 100 = 7 THEN concat('no tab ', p_name)
            ELSE concat(cast(p_partkey AS string), chr(9), ' ', p_name) END AS line FROM part"""

# One line per part; those that are no alias have an empty first field.
ITEM_ALIASES = """
SELECT concat(CASE WHEN p_partkey % 10 = 3 THEN cast(p_partkey AS string) ELSE '' END, chr(9),
              cast(p_partkey - 3 AS string)) AS line FROM part"""

COVER = """
SELECT l_orderkey, l_linenumber, l_quantity AS n0, l_extendedprice AS n1, l_discount AS n2, l_tax AS n3,
       cast(p_size AS double) AS n4, p_retailprice AS n5, cast(l_suppkey AS double) AS n6,
       cast(l_partkey AS double) AS n7, cast(l_linenumber AS double) AS n8, cast(l_orderkey % 100 AS double) AS n9,
       CASE WHEN l_orderkey % 41 = 0 THEN -1 ELSE l_linenumber % 4 END AS wilderness,
       p_size % 40 AS soil, cast(1 + p_size % 7 AS double) AS label
FROM lineitem JOIN part ON l_partkey = p_partkey"""
COVER_NUMBERS = [f"n{i}" for i in range(10)]

NETWORK = """
SELECT l_orderkey, l_linenumber, l_quantity AS c0, l_returnflag AS c1, l_linestatus AS c2, p_type AS c3,
       l_extendedprice AS c4, l_discount AS c5, l_tax AS c6, cast(1.0 AS double) AS c7_constant, o_orderpriority AS label
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey"""
NETWORK_NUMBERS = ["c0", "c4", "c5", "c6", "c7_constant"]
NETWORK_CATEGORIES = ["c1", "c2", "c3"]

# A document is an order. Names repeat within documents; part numbers make a larger and sparser graph.
NAME_TOPICS = "SELECT l_orderkey AS doc, p_name AS topic FROM lineitem JOIN part ON l_partkey = p_partkey"
PART_TOPICS = "SELECT l_orderkey AS doc, concat('part-', cast(l_partkey AS string)) AS topic FROM lineitem"

# Customers and their orders: many components of two levels.
ORDER_LINKS = """
SELECT concat('customer-', cast(o_custkey AS string)) AS a, concat('order-', cast(o_orderkey AS string)) AS b FROM orders"""

USER_LINKS = """
SELECT cast(e.user_id AS string) AS user_id, i.info, cast(e.event_id % 10 AS string) AS link, e.event_id
FROM events e JOIN (SELECT DISTINCT user_id, concat(cast(user_id % 10 AS string), ',', cast((user_id + 3) % 10 AS string))
AS info FROM events) i ON e.user_id = i.user_id"""


def with_values(cover: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The 55 numbers of a land-cover row: ten numbers, two one-hot blocks, the label."""
    def block(width: int, code: str):
        return F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.when(i == F.col(code), 1.0).otherwise(0.0))

    numbers = F.array(*[F.col(c) for c in COVER_NUMBERS])
    values = F.concat(numbers, block(4, "wilderness"), block(40, "soil"), F.array("label"))
    return cover.select(*keep, values.alias("values"))


def value_lines(cover: DataFrame) -> DataFrame:
    """The numbers of :func:`with_values` as one line each; a block's text is looked up by its code. NULL is left out."""
    def block(width: int, code: str):
        ones = F.array(*[F.lit(",".join(str(float(i == j)) for j in range(width))) for i in range(width)])
        return F.coalesce(F.get(ones, F.col(code)), F.lit(",".join(["0.0"] * width)))

    numbers = [F.col(c).cast("double").cast("string") for c in COVER_NUMBERS]
    line = F.concat_ws(",", *numbers, block(4, "wilderness"), block(40, "soil"), F.col("label").cast("string"))
    return cover.select(line.alias("value"))


def written_text(spark: SparkSession, lines: DataFrame, tag: str) -> str:
    """Write one text column and return the folder."""
    path = new_folder(spark, tag)
    lines.write.text(path)
    return path


def document_terms(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as term arrays."""
    return documents(spark, folder).select("doc_id", term_list("text").alias("terms"))


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """Ids and texts, on all cores."""
    return spread(table(spark, folder, "documents").select("doc_id", "text"), "doc_id")


def log_lines(spark: SparkSession, folder: str, text: str) -> DataFrame:
    """Log lines (advertising or access), on all cores."""
    spread(table(spark, folder, "events"), "event_id").createOrReplaceTempView("spread_events")
    return spark.sql(text.replace("FROM events", "FROM spread_events"))


def vectors(spark: SparkSession, folder: str, column: str = "features") -> DataFrame:
    embeddings = table(spark, folder, "embeddings")
    return embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias(column), "label")


def centroids(spark: SparkSession, folder: str) -> DataFrame:
    """Ten fixed centres, one per cluster number."""
    rows = vectors(spark, folder, "centre").where("vec_id < 10")
    return rows.select(F.col("vec_id").cast("int").alias("cluster"), "centre")


def fixture(spark: SparkSession, folder: str, text: str) -> DataFrame:
    return sql(spark, folder, text)
