"""Co-occurrence graphs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyforge.catalog import fixtures as fx
from tallyforge.catalog.registry import query, rounded, sql, table
from tallyforge.functions.scalars import hash_id
from tallyforge.operators import counting, graph
from tallyforge.operators.sampling import sample_by_hash


def _h(text: str) -> str:
    n = f"md5_number_upper({text})"
    return f"CASE WHEN {n} > 9223372036854775807 THEN ({n}::HUGEINT - 18446744073709551616)::BIGINT ELSE {n}::BIGINT END"


@query("hash_id", f"SELECT doc_id, {_h('text')} AS id FROM documents UNION ALL SELECT c_custkey, {_h('c_name')} FROM customer")
def hash_id_query(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", hash_id("text").alias("id"))
    names = table(spark, folder, "customer").select(F.col("c_custkey").alias("doc_id"), hash_id("c_name").alias("id"))
    return documents.unionByName(names)


def _pairs_sql(topics: str) -> str:
    return f"""topics AS ({topics}),
t AS (SELECT doc, topic, count(*) AS n FROM topics GROUP BY ALL),
pairs AS (SELECT a.topic AS topic_a, b.topic AS topic_b, count(*) AS cnt FROM t a JOIN t b
          ON a.doc = b.doc AND a.topic < b.topic GROUP BY ALL
          UNION ALL SELECT topic, topic, count(*) FROM t WHERE n > 1 GROUP BY ALL)"""


_NAMES, _PARTS = _pairs_sql(fx.NAME_TOPICS), _pairs_sql(fx.PART_TOPICS)
_GRAPH = f"""{_PARTS},
vertices AS (SELECT DISTINCT {_h('topic')} AS id, topic FROM topics),
edges AS (SELECT least({_h('topic_a')}, {_h('topic_b')}) AS src, greatest({_h('topic_a')}, {_h('topic_b')}) AS dst, cnt AS attr
          FROM pairs)"""
_CHI = f"""{_GRAPH}, counted AS (SELECT {_h('topic')} AS id, count(*) AS c FROM topics GROUP BY 1),
four AS (SELECT src, dst, attr::DOUBLE AS n11, a.c::DOUBLE AS na, b.c::DOUBLE AS nb,
                (SELECT count(DISTINCT doc) FROM topics)::DOUBLE AS n
         FROM edges JOIN counted a ON a.id = src JOIN counted b ON b.id = dst),
chi AS (SELECT src, dst, n * pow(abs(n11 * (n - na - nb + n11) - (nb - n11) * (na - n11)) - n / 2, 2)
                         / (na * (n - na) * nb * (n - nb)) AS attr FROM four),
heavy AS (SELECT * FROM chi WHERE attr > 19.5)"""
_LINKS = f"""{_CHI}, simple AS (SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM heavy WHERE src <> dst),
links AS (SELECT a AS u, b AS v FROM simple UNION ALL SELECT b, a FROM simple)"""


def part_topics(spark, folder):
    return fx.fixture(spark, folder, fx.PART_TOPICS)


def part_graph(spark, folder):
    return graph.build_topic_graph(part_topics(spark, folder))


def weighted(spark, folder):
    """Vertices with their counts, and edges weighted by chi-square."""
    topics = part_topics(spark, folder)
    _, edges = part_graph(spark, folder)
    documents = topics.agg(F.count_distinct("doc")).scalar()
    return graph.topic_counts(topics), graph.chi_square_edges(graph.topic_counts(topics), edges, documents)


def significant(spark, folder):
    vertices, edges = weighted(spark, folder)
    return vertices, graph.filter_edges(edges)


@query("cooccurrence", f"WITH {_PARTS} SELECT topic_a, topic_b, cnt FROM pairs")
def cooccurrence(spark, folder):
    return graph.cooccurrence(part_topics(spark, folder))


@query("cooccurrence_names", f"WITH {_NAMES} SELECT topic_a, topic_b, cnt FROM pairs")
def cooccurrence_names(spark, folder):
    return graph.cooccurrence(fx.fixture(spark, folder, fx.NAME_TOPICS))


@query("freq_of_freq", f"""
WITH t AS (SELECT topic, count(*) AS n FROM ({fx.PART_TOPICS}) GROUP BY 1)
SELECT n AS occurrences, count(*) AS values_with FROM t GROUP BY 1""")
def freq_of_freq(spark, folder):
    return counting.freq_of_freq(counting.count_by_value(part_topics(spark, folder), "topic"))


@query("build_topic_graph", f"""
WITH {_GRAPH} SELECT 'edge' AS kind, src, dst, attr, NULL AS topic FROM edges
UNION ALL SELECT 'vertex', id, NULL, NULL, topic FROM vertices""")
def build_topic_graph(spark, folder):
    topics = part_topics(spark, folder)
    vertices, edges = graph.build_topic_graph(topics, graph.cooccurrence(topics))
    v = vertices.selectExpr("'vertex' AS kind", "id AS src", "CAST(NULL AS BIGINT) AS dst", "CAST(NULL AS BIGINT) AS attr", "topic")
    return edges.selectExpr("'edge' AS kind", "src", "dst", "attr", "CAST(NULL AS STRING) AS topic").unionByName(v)


_DEGREES = f"{_GRAPH}, degree AS (SELECT id, count(*) AS degree FROM (SELECT src AS id FROM edges UNION ALL SELECT dst FROM edges) GROUP BY 1)"


@query("degrees", f"WITH {_DEGREES} SELECT id, degree FROM degree")
def degrees(spark, folder):
    return graph.degrees(part_graph(spark, folder)[1])


@query("vertex_join", f"WITH {_DEGREES} SELECT id, topic, degree FROM degree JOIN vertices USING (id)")
def vertex_join(spark, folder):
    vertices, edges = part_graph(spark, folder)
    return graph.vertex_join(vertices, graph.degrees(edges))


@query("top_degree_names", f"""
WITH {_DEGREES} SELECT topic AS name, degree FROM degree JOIN vertices USING (id) ORDER BY degree DESC, name LIMIT 10""")
def top_degree_names(spark, folder):
    vertices, edges = part_graph(spark, folder)
    return graph.top_degree_names(graph.degrees(edges), vertices)


@query("triplets", f"""
WITH {_GRAPH}, counted AS (SELECT {_h('topic')} AS id, count(*) AS c FROM topics GROUP BY 1)
SELECT src, dst, attr, a.c AS src_attr, b.c AS dst_attr FROM edges JOIN counted a ON a.id = src JOIN counted b ON b.id = dst""")
def triplets(spark, folder):
    topics = part_topics(spark, folder)
    return graph.triplets(graph.topic_counts(topics), part_graph(spark, folder)[1])


@query("chi_square", f"""
WITH {_NAMES}, counted AS (SELECT topic, count(DISTINCT doc) AS c FROM topics GROUP BY 1),
four AS (SELECT topic_a, topic_b, cnt::DOUBLE AS n11, a.c::DOUBLE AS na, b.c::DOUBLE AS nb,
                (SELECT count(DISTINCT doc) FROM topics)::DOUBLE AS n
         FROM pairs JOIN counted a ON a.topic = topic_a JOIN counted b ON b.topic = topic_b)
SELECT topic_a, topic_b, round(n * pow(abs(n11 * (n - na - nb + n11) - (nb - n11) * (na - n11)) - n / 2, 2)
                               / (na * (n - na) * nb * (n - nb)), 4) AS chi FROM four""")
def chi_square(spark, folder):
    from tallyforge.functions.scalars import chi_square as statistic

    topics = fx.fixture(spark, folder, fx.NAME_TOPICS)
    counts = topics.groupBy("topic").agg(F.count_distinct("doc").alias("c"))
    a = counts.select(F.col("topic").alias("topic_a"), F.col("c").alias("ca"))
    b = counts.select(F.col("topic").alias("topic_b"), F.col("c").alias("cb"))
    pairs = graph.cooccurrence(topics).join(a, "topic_a").join(b, "topic_b")
    documents = topics.agg(F.count_distinct("doc")).scalar()
    return pairs.select("topic_a", "topic_b", rounded(statistic("cnt", "ca", "cb", documents), 4).alias("chi"))


@query("chi_square_edges", f"WITH {_CHI} SELECT src, dst, round(attr, 4) AS attr FROM chi")
def chi_square_edges(spark, folder):
    return weighted(spark, folder)[1].withColumn("attr", rounded("attr", 4))


@query("filter_edges", f"WITH {_CHI} SELECT src, dst FROM heavy")
def filter_edges(spark, folder):
    return significant(spark, folder)[1].select("src", "dst")


_REACH = """reach(id, root) AS (SELECT id, id FROM vertices
UNION SELECT v, root FROM reach JOIN links ON u = id WHERE root < v),
component AS (SELECT id, min(root) AS component FROM reach GROUP BY 1)"""


@query("connected_components", f"WITH RECURSIVE {_LINKS}, {_REACH} SELECT id, component FROM component")
def connected_components(spark, folder):
    return graph.connected_components(*significant(spark, folder))


@query("component_members", f"""
WITH RECURSIVE {_LINKS}, {_REACH}, sizes AS (SELECT component, count(*) AS c FROM component GROUP BY 1)
SELECT id, component, topic FROM component JOIN vertices USING (id)
WHERE component = (SELECT component FROM sizes ORDER BY c DESC, component LIMIT 1 OFFSET 1)""")
def component_members(spark, folder):
    vertices, edges = significant(spark, folder)
    components = graph.connected_components(vertices, edges)
    return graph.component_members(vertices.select("id", "topic"), components).select("id", "component", "topic")


@query("component_sizes", f"""
WITH links AS ({fx.ORDER_LINKS}), g AS (SELECT a, least(min({_h('b')}), min({_h('a')})) AS component, count(*) + 1 AS cnt FROM links GROUP BY a)
SELECT component, cnt FROM g""")
def component_sizes(spark, folder):
    links = sql(spark, folder, fx.ORDER_LINKS)
    edges = links.select(hash_id("a").alias("src"), hash_id("b").alias("dst"))
    vertices = edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    return graph.component_sizes(graph.connected_components(vertices, edges))


_TRIANGLES = f"""{_LINKS}, tri AS (SELECT x.a AS p, x.b AS q, y.b AS r FROM simple x JOIN simple y ON x.b = y.a
JOIN simple z ON z.a = x.a AND z.b = y.b),
corners AS (SELECT unnest([p, q, r]) AS id FROM tri),
counts AS (SELECT id, count(*) AS n FROM corners GROUP BY 1)"""


@query("triangle_count", f"WITH {_TRIANGLES} SELECT id, coalesce(n, 0) AS triangles FROM vertices LEFT JOIN counts USING (id)")
def triangle_count(spark, folder):
    return graph.triangle_count(*significant(spark, folder))


@query("avg_clustering_coef", f"""
WITH {_TRIANGLES}, degree AS (SELECT id, count(*) AS d FROM (SELECT src AS id FROM heavy UNION ALL SELECT dst FROM heavy) GROUP BY 1)
SELECT round(avg(CASE WHEN d > 1 THEN coalesce(n, 0) / (d * (d - 1) / 2) ELSE 0 END), 6) AS avg_clustering
FROM vertices LEFT JOIN counts USING (id) LEFT JOIN degree USING (id)""")
def avg_clustering_coef(spark, folder):
    return graph.avg_clustering_coef(*significant(spark, folder)).withColumn("avg_clustering", rounded("avg_clustering"))


_KEY = "((id % 1000003) + 1000003) % 1000003"
_BFS = f"""{_LINKS}, sources AS (SELECT id FROM vertices WHERE ((({_KEY}) + 1729) % 1000003 * 7919 + 104729) % 1000003 % 10000 < 200),
walk(source, id, dist) AS (SELECT id, id, 0 FROM sources
UNION SELECT source, v, dist + 1 FROM walk JOIN links ON u = id WHERE dist < 40),
near AS (SELECT source, id, min(dist) AS dist FROM walk GROUP BY 1, 2),
paths AS (SELECT DISTINCT least(source, id) AS low, greatest(source, id) AS high, dist FROM near)"""


def path_sources(vertices):
    keyed = vertices.select("id", F.pmod("id", F.lit(1000003)).alias("key"))
    return sample_by_hash(keyed, "key", graph.PATH_SHARE, graph.PATH_SEED).select("id")


def path_counts(spark, folder):
    vertices, edges = significant(spark, folder)
    return graph.path_length_counts(path_sources(vertices), edges)


@query("bfs_multi_source", f"WITH RECURSIVE {_BFS} SELECT low, high, dist FROM paths")
def bfs_multi_source(spark, folder):
    vertices, edges = significant(spark, folder)
    return graph.bfs_multi_source(vertices, edges, sources=path_sources(vertices))


@query("path_length_hist", f"WITH RECURSIVE {_BFS} SELECT dist, count(*) AS cnt FROM paths GROUP BY 1")
def path_length_hist(spark, folder):
    return path_counts(spark, folder)


@query("path_length_stats", f"""
WITH RECURSIVE {_BFS} SELECT count(*) AS cnt, round(avg(dist), 6) AS mean, round(stddev_pop(dist), 6) AS stdev,
max(dist)::DOUBLE AS max, min(dist)::DOUBLE AS min FROM paths WHERE dist > 0""")
def path_length_stats(spark, folder):
    stats = graph.path_count_stats(path_counts(spark, folder))
    return stats.withColumn("mean", rounded("mean")).withColumn("stdev", rounded("stdev"))
