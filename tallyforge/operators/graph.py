"""Co-occurrence graphs on two DataFrames: ``vertices(id, …)`` and ``edges(src, dst, attr)``."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.scalars import chi_square, hash_id
from tallyforge.operators.counting import topk_by_count
from tallyforge.operators.profiling import summary_stats
from tallyforge.operators.sampling import sample_rows
from tallyforge.operators.searches import REACHED, bits_by_place, first_reached, next_reached, packed_edges
from tallyforge.plans.durable import RoundTables, materialize, new_folder, write_clean
from tallyforge.plans.ordered import dense_positions, sum_below

# The significance bound, the length of name lists, and the share and seed of path sources.
SIGNIFICANT, TOP, PATH_SHARE, PATH_SEED = 19.5, 10, 0.02, 1729

# Topics of one document are cut into blocks of about this many before they are paired.
_BLOCK = 500

# Numbers of neighbour lists that a round of the triangles sends, about.
SENT = 100_000_000

# Sources of a search per word of bits, and vertices that the words of a round reach, about.
_WORD, ROUND = 64, 64_000_000

# Two links of each vertex are followed before the others, where there are at least this many times as many.
DENSE = 3


def cooccurrence(doc_topics: DataFrame, doc: str = "doc", topic: str = "topic", block: int = _BLOCK) -> DataFrame:
    """Number of documents per unordered pair of topics; a topic repeated in a document pairs once with itself.

    The pairs of a document are the result asked for. The topics of a common document are gathered in one row and paired
    there. So that a document with very many topics does not land in one task, its topics are cut into blocks and each pair
    of blocks is a join group of its own, of at most about (2 * block)^2 pairs. Pairs are counted before they are shuffled.
    """
    rows = doc_topics.select(F.col(doc).alias("doc"), F.col(topic).alias("topic"))
    sizes = rows.groupBy("doc").agg(F.count(F.lit(1)).alias("rows")).where((F.col("rows") > block) & F.col("doc").isNotNull())
    large = materialize(sizes.select("doc"), "large-documents")
    # A NULL pairs with nothing but itself: such rows go the way of large documents, where no list is gathered.
    unknown = F.col("doc").isNull() | F.col("topic").isNull()
    common = rows.where(~unknown).join(large, "doc", "left_anti")
    lists = common.groupBy("doc").agg(F.sort_array(F.collect_list("topic")).alias("topics"))
    at = lists.select("topics", F.posexplode("topics").alias("at", "topic_a")).where(
        (F.col("at") == 0) | (F.get("topics", F.col("at") - 1) != F.col("topic_a"))
    )
    # Behind the first of equal topics stand those that it pairs with, itself too if it is repeated.
    others = F.array_distinct(F.slice("topics", F.col("at") + 2, F.size("topics")))
    pairs = at.select("topic_a", F.explode(others).alias("topic_b"))
    rest = rows.where(unknown)
    if not large.isEmpty():
        rest = rest.unionByName(rows.where(~unknown).join(large, "doc", "left_semi"))
    pairs = pairs.unionByName(_pairs_by_blocks(rest, block))
    return pairs.groupBy("topic_a", "topic_b").agg(F.count(F.lit(1)).alias("cnt"))


def _pairs_by_blocks(rows: DataFrame, block: int) -> DataFrame:
    """(topic_a, topic_b), a row for each document that holds both, by a join of blocks of topics.

    The topics of documents are written once, as every step needs them.
    """
    repeats = materialize(rows.groupBy("doc", "topic").agg(F.count(F.lit(1)).alias("n")), "document-topics")
    sizes = repeats.groupBy("doc").agg(F.count(F.lit(1)).alias("topics")).where(F.col("topics") > block)
    sizes = materialize(sizes, "large-documents")  # so that the join can split such a document
    blocks = F.coalesce(F.ceil(F.col("topics") / block).cast("int"), F.lit(1))
    placed = repeats.join(sizes, "doc", "left").select(
        "doc", "topic", blocks.alias("blocks"), F.pmod(F.xxhash64("topic"), blocks).cast("int").alias("own")
    )
    copies = placed.select(
        "doc", "topic", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    ).select("doc", "topic", "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    a, b = copies.alias("a"), copies.alias("b")
    same_cell = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("doc", "low", "high")]
    once = (F.col("a.topic") < F.col("b.topic")) & (
        (F.col("a.low") == F.col("a.high")) | (F.col("a.own") != F.col("b.own"))
    )
    pairs = a.join(b, [*same_cell, once]).select(F.col("a.topic").alias("topic_a"), F.col("b.topic").alias("topic_b"))
    doubled = repeats.where(F.col("n") > 1).select(F.col("topic").alias("topic_a"), F.col("topic").alias("topic_b"))
    return pairs.unionByName(doubled)


def vertex_id(topic: Column | str) -> Column:
    """The hash id of a topic, declared never NULL.

    Otherwise a join on ids would make the optimizer hash every single pair further down, to filter NULL ids out.
    """
    return F.coalesce(hash_id(topic), F.lit(0).cast("bigint"))


def topic_counts(doc_topics: DataFrame, topic: str = "topic") -> DataFrame:
    """Occurrences of each topic, by vertex id."""
    counts = doc_topics.groupBy(F.col(topic).alias("topic")).agg(F.count(F.lit(1)).alias("attr"))
    return counts.select(vertex_id("topic").alias("id"), "topic", "attr")


def topic_vertices(doc_topics: DataFrame, topic: str = "topic") -> DataFrame:
    return doc_topics.select(F.col(topic).alias("topic")).distinct().select(vertex_id("topic").alias("id"), "topic")


def topic_edges(doc_topics: DataFrame, doc: str = "doc", topic: str = "topic", drop_self_loops: bool = False) -> DataFrame:
    """Co-occurrence edges (src, dst, attr) straight from documents.

    Topics are hashed once per occurrence and paired as ids, so the shuffle of pairs carries two numbers, not two texts.
    """
    ids = doc_topics.select(F.col(doc).alias("doc"), vertex_id(topic).alias("topic"))
    pairs = cooccurrence(ids)
    edges = pairs.select(F.col("topic_a").alias("src"), F.col("topic_b").alias("dst"), F.col("cnt").alias("attr"))
    return edges.where(F.col("src") != F.col("dst")) if drop_self_loops else edges


def build_topic_graph(
    doc_topics: DataFrame, pairs: DataFrame | None = None, topic: str = "topic", drop_self_loops: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Vertices (id, topic) and edges (src, dst, attr), the smaller id first, attr the co-occurrence count.

    ``pairs`` are named pairs that were counted before; without them the edges come straight from the documents.
    """
    if pairs is None:
        edges = topic_edges(doc_topics, topic=topic)
    else:
        a, b = vertex_id("topic_a"), vertex_id("topic_b")
        edges = pairs.select(F.least(a, b).alias("src"), F.greatest(a, b).alias("dst"), F.col("cnt").alias("attr"))
    edges = edges.where(F.col("src") != F.col("dst")) if drop_self_loops else edges
    return topic_vertices(doc_topics, topic), edges


def degrees(edges: DataFrame) -> DataFrame:
    """Edge ends per vertex; a self-loop has two, a vertex without edges is absent."""
    ends = edges.select(F.explode(F.array("src", "dst")).alias("id"))
    return ends.groupBy("id").agg(F.count(F.lit(1)).alias("degree"))


def vertex_join(vertices: DataFrame, values: DataFrame) -> DataFrame:
    return vertices.join(values, "id")


def triplets(vertices: DataFrame, edges: DataFrame, attr: str = "attr") -> DataFrame:
    """Edges with the attribute of both ends."""
    src = vertices.select(F.col("id").alias("src"), F.col(attr).alias("src_attr"))
    dst = vertices.select(F.col("id").alias("dst"), F.col(attr).alias("dst_attr"))
    return edges.join(src, "src").join(dst, "dst").select("src", "dst", "attr", "src_attr", "dst_attr")


def top_degree_names(degree: DataFrame, vertices: DataFrame, n: int = TOP, name: str = "topic") -> DataFrame:
    named = vertex_join(vertices, degree).select(F.col(name).alias("name"), "degree")
    return topk_by_count(named, n, "degree", ["name"])


def chi_square_edges(vertices: DataFrame, edges: DataFrame, documents) -> DataFrame:
    """Edges re-weighted by the chi-square of pair count, both topic counts (vertex ``attr``) and document count."""
    documents = F.lit(documents) if isinstance(documents, int) else documents
    weight = chi_square("attr", "src_attr", "dst_attr", documents)
    return triplets(vertices, edges).select("src", "dst", weight.alias("attr"))


def filter_edges(edges: DataFrame, more_than: float = SIGNIFICANT) -> DataFrame:
    """The subgraph of heavy edges; its vertices are all vertices of the graph."""
    return edges.where(F.col("attr") > more_than)


def _star_round(links: DataFrame, large: bool, save: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Hook the neighbours of every node to the smallest of them: the larger ones (``large``), or the smaller ones."""
    if large:
        around = links.select("node", "to").unionByName(links.select(F.col("to").alias("node"), F.col("node").alias("to")))
    else:
        around = links.select("node", "to")
    least = around.groupBy("node").agg(F.min("to").alias("least"))
    least = least.select("node", F.least("node", "least").alias("root"))
    # Written first: runtime skew splitting needs a shuffle directly below both sides of the join, and an aggregate on the
    # key would stand in its place.
    least = save(least)
    hooked = around.join(least, "node")
    if large:
        moved = hooked.where(F.col("to") > F.col("node")).select(F.col("to").alias("node"), F.col("root").alias("to"))
    else:
        moved = hooked.select(F.col("to").alias("node"), F.col("root").alias("to")).unionByName(
            least.select("node", F.col("root").alias("to"))
        )
    return moved.where(F.col("node") != F.col("to")).distinct()


def _is_settled(links: DataFrame) -> bool:
    """Whether the links are stars: every node hangs on one root, and no root hangs on anything."""
    roles = links.select("node", F.lit(1).alias("hangs"), F.lit(0).alias("holds")).unionByName(
        links.select(F.col("to").alias("node"), F.lit(0).alias("hangs"), F.lit(1).alias("holds"))
    )
    nodes = roles.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return nodes.where((F.col("hangs") > 1) | ((F.col("hangs") > 0) & (F.col("holds") > 0))).isEmpty()


def connected_components(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id that can be reached; a vertex without edges is its own component."""
    roots = _stars(edges).select(F.col("node").alias("id"), F.col("to").alias("component"))
    return vertices.select("id").join(roots, "id", "left").select("id", F.coalesce("component", "id").alias("component"))


def _stars(edges: DataFrame, written: bool = False) -> DataFrame:
    """(node, to): every vertex but the smallest of its component, with that smallest one.

    In a dense graph most links lie within components that a few of them connect already. So two links of each vertex are
    followed first; all links are then led to the roots found, and those between different roots, often none, are followed
    in turn. This sends each link a few times, instead of in every step of the rounds. Edges that are ``written`` already are
    read from where they are.
    """
    links = edges.where(F.col("src") != F.col("dst")).select(
        F.greatest("src", "dst").alias("node"), F.least("src", "dst").alias("to")
    )
    links = links if written else materialize(links, "component-links")
    ends = F.array_distinct(F.array(F.min("to"), F.max("to")))
    few = materialize(links.groupBy("node").agg(ends.alias("to")).select("node", F.explode("to").alias("to")), "few-links")
    if few.count() * DENSE > links.count():
        return _settled(links.distinct())
    stars = materialize(_settled(few), "few-stars")
    low = stars.select(F.col("node").alias("_low"), F.col("to").alias("_low_root"))
    high = stars.select(F.col("node").alias("_high"), F.col("to").alias("_high_root"))
    led = links.join(high, F.col("node") == F.col("_high"), "left").select(F.coalesce("_high_root", "node").alias("node"), "to")
    led = led.join(low, F.col("to") == F.col("_low"), "left").select("node", F.coalesce("_low_root", "to").alias("to"))
    between = led.where(F.col("node") != F.col("to")).select(F.greatest("node", "to").alias("node"), F.least("node", "to").alias("to"))
    between = materialize(between.distinct(), "between-stars")
    return stars if between.isEmpty() else _settled(stars.unionByName(between))


def _settled(links: DataFrame) -> DataFrame:
    """The stars (node, to) that distinct links from larger to smaller vertices come to.

    Alternates two star rounds (hook larger neighbours, then smaller ones, to the smallest) until only stars are left,
    which takes about log^2 n rounds whatever the diameter. Each round is a durable table, and the number of links
    never grows.
    """
    rounds = RoundTables(links.sparkSession, "components")
    links = rounds.save(links)
    while not _is_settled(links):
        links = rounds.save(_star_round(links, True, rounds.save))
        links = rounds.save(_star_round(links, False, rounds.save))
    return links


def component_sizes(components: DataFrame) -> DataFrame:
    sizes = components.groupBy("component").agg(F.count(F.lit(1)).alias("cnt"))
    return sizes.orderBy(F.desc("cnt"), "component")


def component_members(vertices: DataFrame, components: DataFrame, rank: int = 2) -> DataFrame:
    """Vertices of the component that is ``rank``-th by size."""
    top = component_sizes(components).limit(rank)
    last = top.orderBy("cnt", F.desc("component")).limit(1)
    wanted = last.select("component")
    enough = top.agg(F.count(F.lit(1)) == rank).scalar()
    members = components.join(F.broadcast(wanted), "component", "left_semi").where(enough)
    return vertex_join(vertices, members)


def _simple_edges(edges: DataFrame) -> DataFrame:
    """Distinct edges a < b without loops."""
    return edges.where(F.col("src") != F.col("dst")).select(
        F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")
    ).distinct()


def _ranked(degree: DataFrame) -> DataFrame:
    """(id, rank): vertices numbered from 0 by degree, then id; as int if there are few enough."""
    in_order = degree.orderBy("degree", "id").select("id", F.monotonically_increasing_id().alias("place"))
    placed = materialize(in_order, "vertex-places")
    kind = "int" if placed.count() < 2**31 else "bigint"
    ranks = placed.join(dense_positions(placed, "place", "rank"), "place").select("id", F.col("rank").cast(kind).alias("rank"))
    return materialize(ranks, "vertex-ranks")


def _triangles(out: DataFrame) -> DataFrame:
    """(low, mid, highs) for every edge low -> mid of ``out`` (low, high) that closes triangles, with their third corners.

    An edge takes along what follows ``mid`` in the sorted list of its ``low``, and meets the list of ``mid``: one row per
    edge is shuffled, not one per path of two edges.
    """
    lists = _neighbours(out)
    return _closed(lists, lists)


def _neighbours(out: DataFrame) -> DataFrame:
    return materialize(out.groupBy("low").agg(F.sort_array(F.collect_list("high")).alias("next")), "neighbours")


def _closed(asking: DataFrame, lists: DataFrame) -> DataFrame:
    """The triangles (low, mid, highs) of those ``low`` that are ``asking``, some or all of the ``lists``."""
    asked = asking.select("low", "next", F.posexplode("next").alias("at", "mid")).where(F.col("at") + 1 < F.size("next"))
    asked = asked.select("low", "mid", F.slice("next", F.col("at") + 2, F.size("next")).alias("after"))
    near = lists.select(F.col("low").alias("mid"), F.col("next").alias("near"))
    closed = asked.join(near, "mid").select("low", "mid", F.array_intersect("after", "near").alias("highs"))
    return closed.where(F.size("highs") > 0)


def triangle_count(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, triangles) for every vertex.

    Edges point from the end of smaller degree to the other, so that no vertex has more than sqrt(2 * edges) outgoing
    ones and the numbers sent and compared stay below edges^1.5, hubs included. Vertices go by their rank in that order. Lists
    are sent in rounds of about ``SENT`` numbers, and what a round sent is deleted behind it.
    """
    simple = materialize(_simple_edges(edges), "simple-edges")
    ranks = _ranked(degrees(simple.select(F.col("a").alias("src"), F.col("b").alias("dst"))))
    numbered = simple.join(ranks.select(F.col("id").alias("a"), F.col("rank").alias("ra")), "a").join(
        ranks.select(F.col("id").alias("b"), F.col("rank").alias("rb")), "b"
    )
    out = numbered.select(F.least("ra", "rb").alias("low"), F.greatest("ra", "rb").alias("high"))
    one, n = F.lit(1).cast("bigint"), F.size("highs").cast("bigint")
    ends = F.array(F.struct(F.col("low").alias("rank"), n.alias("n")), F.struct(F.col("mid").alias("rank"), n.alias("n")))
    thirds = F.transform("highs", lambda high: F.struct(high.alias("rank"), one.alias("n")))

    def corners_of(closed: DataFrame) -> DataFrame:
        corners = closed.select(F.explode(F.concat(ends, thirds)).alias("corner")).select("corner.*")
        return corners.groupBy("rank").agg(F.sum("n").alias("n"))

    lists = _neighbours(out)
    sent = lists.agg(F.sum(F.expr("size(next) * (cast(size(next) AS BIGINT) - 1) div 2"))).first()[0] or 0
    rounds = -(-sent // SENT)
    parts = [_closed(lists, lists)]
    if rounds > 1:
        parts = [_closed(lists.where(F.pmod(F.xxhash64("low"), F.lit(rounds)) == turn), lists) for turn in range(rounds)]
    found = [corners_of(part) for part in parts]
    found = [materialize(part, "triangle-corners") for part in found] if rounds > 1 else found
    sums = reduce(DataFrame.unionByName, found).groupBy("rank").agg(F.sum("n").alias("triangles"))
    counts = sums.join(ranks, "rank").select("id", "triangles")
    return vertices.select("id").join(counts, "id", "left").select(
        "id", F.coalesce("triangles", F.lit(0).cast("bigint")).alias("triangles")
    )


def avg_clustering_coef(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Mean over all vertices of triangles / possible triangles; 0 for a vertex with fewer than two edge ends."""
    edges = materialize(edges, "edges")
    d = F.col("degree")
    possible = d * (d - 1) / 2.0
    measured = triangle_count(vertices, edges).join(degrees(edges), "id", "left")
    coefficient = F.when(possible > 0, F.col("triangles") / possible).otherwise(0.0)
    return measured.agg(F.avg(coefficient).alias("avg_clustering"))


def bfs_distances(sources: DataFrame, edges: DataFrame) -> DataFrame:
    """(source, id, dist) for everything reachable from each source over undirected edges, the source itself included."""
    reached, numbered, placed = _placed_searches(sources, edges)
    ones = F.filter(F.sequence(F.lit(0), F.lit(_WORD - 1)), lambda i: F.getbit("bits", i) == 1)
    found = reached.join(placed.select("place", "id"), "place").select("word", "id", "dist", F.explode(ones).alias("at"))
    found = found.select((F.col("word") * _WORD + F.col("at")).alias("number"), "id", "dist")
    return found.join(numbered.select("number", F.col("id").alias("source")), "number").select("source", "id", "dist")


def _bit_searches(sources: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What each hop reaches, as (word, place, bits, dist), and the numbers and places of the sources."""
    return _placed_searches(sources, edges)[:2]


def _placed_searches(sources: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(word, place, bits, dist), the numbered sources, and the places of vertices.

    Sources are numbered and searched 64 at a time, one bit each (``operators/searches.py``). Vertices are placed and sources
    numbered component by component, so that the searches of a word go over the same blocks of vertices: what is sent follows
    a component's words times its vertices. The sizes of components say when the searches of a word have reached everything;
    its last frontier is not followed. Words are searched in rounds of at most ``ROUND`` vertices reached, and what a
    hop sends is deleted behind it, so that disk holds the result and one hop of one round, however many sources there are.
    """
    spark = sources.sparkSession
    simple = materialize(_simple_edges(edges), "simple-edges")
    placed = _places(sources, _stars(simple.toDF("src", "dst"), written=True))
    numbered = _numbered(placed)
    ends = [placed.select(F.col("id").alias(c), F.col("place").alias(p)) for c, p in (("a", "p"), ("b", "q"))]
    packed = materialize(packed_edges(simple.join(ends[0], "a").join(ends[1], "b").select("p", "q")), "packed-edges")
    folder = new_folder(spark, "reached")
    bit = F.expr(f"shiftleft(1L, cast(pmod(number, {_WORD}) AS INT))")
    hops = RoundTables(spark, "unreached")
    schema = f"{REACHED}, dist int, round int"

    def saved(rows: DataFrame, hop: int, turn: int) -> DataFrame:
        path = f"{folder}/dist={hop}/round={turn}"
        write_clean(rows, path)
        return spark.read.schema(REACHED).parquet(path)

    def still_open(frontier: DataFrame, unreached: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The rows of words that have not reached everything, and what words have left."""
        found = frontier.groupBy("word").agg(F.sum("found").alias("found"))
        left = unreached.join(found, "word").select("word", (F.col("left") - F.col("found")).alias("left"))
        left = hops.save(left.where(F.col("left") > 0))
        return frontier.join(left, "word", "left_semi"), left

    numbered, turns = _in_rounds(numbered)
    for turn in range(turns):
        own = numbered.where(F.col("round") == turn)
        unreached = hops.save(own.groupBy("word").agg(F.sum("reaches").alias("left")))
        reached, before, hop = saved(first_reached(own.select("place", "word", bit.alias("bits"))), 0, turn), None, 0
        frontier, unreached = still_open(reached, unreached)
        while not frontier.isEmpty():
            hop += 1
            fresh = next_reached(packed, frontier, before)
            before, reached = reached, saved(fresh, hop, turn)
            frontier, unreached = still_open(reached, unreached)
    return bits_by_place(spark.read.schema(schema).parquet(folder)), numbered, placed


def _places(sources: DataFrame, stars: DataFrame) -> DataFrame:
    """(id, component, is_source, place): every vertex with edges and every source, its place by component and id."""
    roots = stars.select("to").distinct().select(F.col("to").alias("id"), F.col("to").alias("component"))
    linked = stars.select(F.col("node").alias("id"), F.col("to").alias("component")).unionByName(roots)
    marked = sources.select("id").distinct().withColumn("_source", F.lit(True))
    rows = linked.join(marked, "id", "full_outer").select(
        "id", F.coalesce("component", "id").alias("component"), F.col("_source").isNotNull().alias("is_source")
    )
    in_order = rows.orderBy("component", "id").withColumn("place", F.monotonically_increasing_id())
    return materialize(in_order, "vertex-places")


def _numbered(placed: DataFrame) -> DataFrame:
    """(id, number, word, reaches, place, component): sources, numbered from 0 by place; vertices of the component."""
    sizes = placed.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    rows = placed.where("is_source").join(sizes, "component", "left")
    rows = rows.select("id", "component", "place", F.coalesce("size", F.lit(1).cast("bigint")).alias("reaches"))
    rows = materialize(rows, "source-places")
    numbered = rows.join(dense_positions(rows, "place", "number"), "place")
    return materialize(numbered.select("id", "number", _word("number").alias("word"), "reaches", "place", "component"), "sources")


def _in_rounds(numbered: DataFrame) -> tuple[DataFrame, int]:
    """The sources with the ``round`` of their word, and the number of rounds; a round reaches about ``ROUND`` vertices."""
    words = numbered.groupBy("word", "component").agg(F.first("reaches").alias("size"))
    words = materialize(words.groupBy("word").agg(F.sum("size").alias("size")), "search-words")
    if (words.agg(F.sum("size")).first()[0] or 0) <= ROUND:
        return numbered.withColumn("round", F.lit(0)), 1
    below = sum_below(words.select(F.lit(0).alias("_all"), "word", "size", F.col("word").alias("_order")), ["_all"], "_order", "size", "_below")
    below = materialize(below.select("word", F.floor(F.col("_below") / ROUND).cast("int").alias("round")), "search-rounds")
    return numbered.join(below, "word"), below.agg(F.max("round")).first()[0] + 1


def _word(number: str) -> Column:
    return F.floor(F.col(number) / _WORD).cast("bigint")


def bfs_multi_source(
    vertices: DataFrame, edges: DataFrame, fraction: float = PATH_SHARE, seed: int = PATH_SEED,
    sources: DataFrame | None = None,
) -> DataFrame:
    """Distinct (low, high, dist): hop distance between each sampled vertex and all it reaches."""
    sources = sample_rows(vertices.select("id"), fraction, seed) if sources is None else sources.select("id")
    sources = materialize(sources.distinct(), "sources")
    return path_pairs(bfs_distances(sources, edges), sources)


def path_pairs(distances: DataFrame, sources: DataFrame) -> DataFrame:
    """Each pair once. A pair comes twice only if both ends are sources, so of those the larger source is left out."""
    marks = sources.select("id", F.lit(True).alias("_source"))
    once = distances.join(marks, "id", "left").where(F.col("_source").isNull() | (F.col("source") <= F.col("id")))
    return once.select(F.least("source", "id").alias("low"), F.greatest("source", "id").alias("high"), "dist")


def path_length_stats(pairs: DataFrame) -> DataFrame:
    return summary_stats(pairs.where(F.col("dist") > 0), "dist")


def path_length_hist(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("dist").agg(F.count(F.lit(1)).alias("cnt")).orderBy("dist")


def path_length_counts(sources: DataFrame, edges: DataFrame) -> DataFrame:
    """(dist, cnt) of the pairs that :func:`bfs_multi_source` would list, counted from the words of bits: no pair is made.

    Each set bit is one (source, vertex). Over undirected edges a pair of two sources is found from both ends, so half of
    the bits at vertices that are sources themselves are taken off. A source and itself, at distance 0, is found once.
    """
    reached, numbered = _bit_searches(sources, edges)
    marks = numbered.select("place", F.lit(True).alias("_source"))
    bits = F.bit_count("bits").cast("bigint")
    sums = reached.join(marks, "place", "left").groupBy("dist").agg(
        F.sum(bits).alias("found"), F.coalesce(F.sum(F.when(F.col("_source"), bits)), F.lit(0)).alias("both")
    )
    twice = F.when(F.col("dist") > 0, F.expr("both div 2")).otherwise(F.lit(0).cast("bigint"))
    return sums.select("dist", (F.col("found") - twice).alias("cnt")).orderBy("dist")


def path_count_stats(counts: DataFrame) -> DataFrame:
    """:func:`path_length_stats` from (dist, cnt). No path above distance 0 gives a count of 0 and NULLs."""
    n, d = F.col("cnt").cast("decimal(38,0)"), F.col("dist")
    sums = counts.where(d > 0).agg(
        F.coalesce(F.sum("cnt"), F.lit(0)).alias("cnt"), F.sum(n * d).alias("s"), F.sum(n * d * d).alias("q"),
        F.max("dist").cast("double").alias("max"), F.min("dist").cast("double").alias("min"),
    )
    n, s, q = (F.col(c).cast("double") for c in ("cnt", "s", "q"))
    variance = q / n - (s / n) * (s / n)
    stdev = F.sqrt(F.when(variance < 0, 0.0).otherwise(variance))
    return sums.select("cnt", (s / n).alias("mean"), stdev.alias("stdev"), "max", "min")
