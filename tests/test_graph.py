"""Graph operators against brute force, hubs and long chains included."""

from __future__ import annotations

import os
import random
import time
from collections import Counter, defaultdict, deque
from itertools import combinations

import pytest

from pyspark.sql import functions as F

from tallyforge.operators import graph, searches
from tallyforge.plans import durable
from tallyforge.plans.durable import materialize


def frame(spark, edges):
    return spark.createDataFrame([(a, b, 1) for a, b in edges], "src long, dst long, attr long")


def vertices(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "id long")


def random_edges(n, m, seed, hub=False):
    rng = random.Random(seed)
    edges = {(rng.randrange(n), rng.randrange(n)) for _ in range(m)}
    if hub:
        edges |= {(0, i) for i in range(1, n, 2)}
    return sorted(edges)


def around(edges):
    near = defaultdict(set)
    for a, b in edges:
        if a != b:
            near[a].add(b)
            near[b].add(a)
    return near


def walk(start, near):
    seen, queue = {start: 0}, deque([start])
    while queue:
        x = queue.popleft()
        for y in near[x]:
            if y not in seen:
                seen[y] = seen[x] + 1
                queue.append(y)
    return seen


CASES = {
    "sparse": (60, random_edges(60, 40, 1)), "hub": (80, random_edges(80, 60, 2, hub=True)), "loops": (6, [(0, 0), (1, 2), (2, 1)]),
    "chain": (70, [(i, i + 1) for i in range(60)]), "empty": (5, []),
}


@pytest.mark.parametrize("case", CASES)
def test_components(spark, case):
    n, edges = CASES[case]
    near = around(edges)
    wanted = {i: min(walk(i, near)) for i in range(n)}
    found = graph.connected_components(vertices(spark, range(n)), frame(spark, edges))
    assert {r.id: r.component for r in found.collect()} == wanted


@pytest.mark.parametrize("case", ["sparse", "hub", "loops", "empty"])
def test_triangles_and_clustering(spark, case):
    n, edges = CASES[case]
    near = around(edges)
    wanted = {i: sum(1 for a, b in combinations(sorted(near[i]), 2) if b in near[a]) for i in range(n)}
    v, e = vertices(spark, range(n)), frame(spark, edges)
    assert {r.id: r.triangles for r in graph.triangle_count(v, e).collect()} == wanted
    degree = Counter(x for edge in edges for x in edge)
    mean = sum(wanted[i] / (degree[i] * (degree[i] - 1) / 2) for i in range(n) if degree[i] > 1) / n
    assert abs(graph.avg_clustering_coef(v, e).first()[0] - mean) < 1e-9


@pytest.mark.parametrize("case", ["sparse", "hub", "chain", "empty"])
def test_distances(spark, case):
    n, edges = CASES[case]
    near = around(edges)
    starts = list(range(n))  # more than one word of bits
    wanted = {(s, t, d) for s in starts for t, d in walk(s, near).items()}
    found = graph.bfs_distances(vertices(spark, starts), frame(spark, edges)).collect()
    assert len(found) == len(wanted) and {(r.source, r.id, r.dist) for r in found} == wanted
    some = starts[::3]
    pairs = graph.bfs_multi_source(vertices(spark, range(n)), frame(spark, edges), sources=vertices(spark, some)).collect()
    expected = {(min(s, t), max(s, t), d) for s in some for t, d in walk(s, near).items()}
    assert len(pairs) == len(expected) and {tuple(p) for p in pairs} == expected


@pytest.mark.parametrize("case, step", [("sparse", 1), ("hub", 3), ("loops", 1)])
def test_path_counts_are_those_of_the_pairs(spark, case, step):
    n, edges = CASES[case]
    some, near = list(range(0, n, step)), around(edges)
    pairs = {(min(s, t), max(s, t), d) for s in some for t, d in walk(s, near).items()}
    counts = graph.path_length_counts(vertices(spark, some), frame(spark, edges))
    assert {r.dist: r.cnt for r in counts.collect()} == dict(Counter(d for _, _, d in pairs))
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan
    found = graph.path_count_stats(counts).first()
    listed = graph.path_length_stats(spark.createDataFrame(sorted(pairs), "low long, high long, dist int")).first()
    assert found.cnt == listed.cnt and (found.max, found.min) == (listed.max, listed.min)
    if listed.cnt:
        assert found.mean == pytest.approx(listed.mean) and found.stdev == pytest.approx(listed.stdev, abs=1e-9)


def test_path_counts_without_sources_or_edges(spark):
    assert graph.path_length_counts(vertices(spark, []), frame(spark, [(1, 2)])).count() == 0
    alone = graph.path_length_counts(vertices(spark, [5, 5, 7]), frame(spark, []))
    assert [tuple(r) for r in alone.collect()] == [(0, 2)]
    assert tuple(graph.path_count_stats(alone).first()) == (0, None, None, None, None)


def test_sampled_sources_repeat(spark):
    n, edges = CASES["hub"]
    runs = [set(map(tuple, graph.bfs_multi_source(vertices(spark, range(n)), frame(spark, edges), 0.2, 1729).collect())) for _ in range(2)]
    assert runs[0] == runs[1]


@pytest.mark.parametrize("block", [3, 500])
def test_cooccurrence(spark, block):
    rng = random.Random(3)
    docs = {d: [f"t{rng.randrange(12)}" for _ in range(rng.randrange(1, 9))] for d in range(30)}
    docs[99] = [f"t{i}" for i in range(40)] + ["t1"]  # one document with a large share of all topics
    wanted = Counter()
    for topics in docs.values():
        wanted.update(set(combinations(sorted(topics), 2)))
    rows = spark.createDataFrame([(d, t) for d, ts in docs.items() for t in ts], "doc long, topic string")
    found = {(r.topic_a, r.topic_b): r.cnt for r in graph.cooccurrence(rows, block=block).collect()}
    assert found == dict(wanted)


def test_topics_of_a_common_document_are_paired_in_its_row(spark):
    rows = spark.createDataFrame(
        [(1, "a"), (1, "b"), (1, "a"), (2, "b"), (2, "a"), (2, None), (2, None), (None, "a"), (None, "a"), (None, "b")],
        "doc long, topic string",
    )
    pairs = graph.cooccurrence(rows)
    wanted = {("a", "b"): 2, ("a", "a"): 2, (None, None): 1}
    assert {(r.topic_a, r.topic_b): r.cnt for r in pairs.collect()} == wanted
    pairs = graph.cooccurrence(rows.where("doc IS NOT NULL AND topic IS NOT NULL"))
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" in plan
    assert {(r.topic_a, r.topic_b): r.cnt for r in pairs.collect()} == {("a", "b"): 2, ("a", "a"): 1}


def test_named_and_direct_edges_agree(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (1, "a"), (2, "a"), (2, "b"), (3, "c")], "doc long, topic string")
    named = graph.build_topic_graph(rows, graph.cooccurrence(rows))
    direct = graph.build_topic_graph(rows)
    for x, y in zip(named, direct):
        assert sorted(map(tuple, x.collect())) == sorted(map(tuple, y.collect()))
    assert graph.build_topic_graph(rows, drop_self_loops=True)[1].count() == 1
    assert {r.degree for r in graph.degrees(direct[1].where("src = dst")).collect()} == {2}


def test_members_of_a_component_that_is_not_there(spark):
    v = spark.createDataFrame([(1, "a"), (2, "b")], "id long, topic string")
    one = graph.connected_components(v, frame(spark, [(1, 2)]))
    assert graph.component_members(v, one, rank=2).count() == 0
    assert graph.component_members(v, one, rank=1).count() == 2


def test_triangles_send_a_row_per_edge(spark):
    """All triangles of a clique come from at most as many rows as it has edges, far fewer than its paths."""
    n = 30
    out = spark.createDataFrame([(a, b) for a in range(n) for b in range(a + 1, n)], "low int, high int")
    rows = graph._triangles(out).collect()
    assert len(rows) <= n * (n - 1) // 2
    found = {(r.low, r.mid, high) for r in rows for high in r.highs}
    assert found == {(a, b, c) for a in range(n) for b in range(a + 1, n) for c in range(b + 1, n)}
    ids = [(7919 * a - 2**62, 7919 * b - 2**62) for a in range(n) for b in range(a + 1, n)]
    edges = spark.createDataFrame([(a, b, 1) for a, b in ids], "src long, dst long, attr int")
    vertices = edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    assert {r.triangles for r in graph.triangle_count(vertices, edges).collect()} == {(n - 1) * (n - 2) // 2}


def test_searches_of_a_word_share_their_component(spark):
    """Rows reached follow the vertices of the sources' components, and the last frontier is not followed."""
    size, groups = 64, 6
    edges = [(g + groups * i, g + groups * (i + 1)) for g in range(groups) for i in range(size - 1)]
    edges += [(g, g + groups * i) for g in range(groups) for i in range(2, size)]
    n = size * groups
    reached, _ = graph._bit_searches(vertices(spark, range(n)), frame(spark, edges))
    # A word per component: its vertices once at each distance from 0 to 2.
    assert reached.count() <= 3 * n
    assert set(graph.path_length_counts(vertices(spark, range(n)), frame(spark, edges)).select("dist").toPandas()["dist"]) == {0, 1, 2}


def test_components_of_a_dense_graph_follow_few_links(spark, monkeypatch):
    """Two links of each vertex settle a dense graph; the links between what they leave apart are followed too."""
    followed = []
    settled = graph._settled
    monkeypatch.setattr(graph, "_settled", lambda links: followed.append(links.count()) or settled(links))
    rng = random.Random(5)
    edges = [(a, b) for a, b in combinations(range(0, 60), 2)] + [(a, b) for a, b in combinations(range(100, 160), 2)]
    # Each of the middle vertices hangs on the least and the greatest of a group, and one link between joins two groups.
    edges += [(rng.randrange(60), 200 + i) for i in range(20) for _ in range(9)] + [(5, 60 + 5), (60 + 5, 30)]
    split = [(300, 400), (301, 400), (302, 400), (301, 402), (302, 403), (303, 403), (302, 404), (305, 404)]
    ids = sorted({x for edge in edges + split for x in edge})
    for some in (edges, edges + split, [*edges, (100, 500), (5, 500), (140, 500), (30, 500), (160, 500)]):
        followed.clear()
        near = around(some)
        found = graph.connected_components(vertices(spark, [*ids, 500]), frame(spark, some * 2))
        assert {r.id: r.component for r in found.collect()} == {i: min(walk(i, near)) for i in [*ids, 500]}
        assert followed[0] * graph.DENSE < 2 * len(some)


def test_links_between_stars_are_followed(spark, monkeypatch):
    """A vertex whose least and greatest links stay in one part while a third leads to another."""
    monkeypatch.setattr(graph, "DENSE", 1)
    edges = [(1, 2), (1, 9), (2, 9), (3, 4), (4, 9)] + [(a, b) for a, b in combinations(range(20, 30), 2)]
    edges += [(1, 100), (22, 100), (50, 100), (51, 100), (52, 60), (50, 60), (53, 60), (51, 60)]
    near = around(edges)
    ids = sorted(near)
    found = graph.connected_components(vertices(spark, ids), frame(spark, edges))
    assert {r.id: r.component for r in found.collect()} == {i: min(walk(i, near)) for i in ids}


def test_a_hop_sends_a_row_per_word_and_block(spark):
    n = 40
    pairs = spark.createDataFrame([(a, b) for a, b in combinations(range(n), 2)], "p long, q long")
    packed = searches.packed_edges(pairs)
    assert packed.count() == 1
    rows = spark.createDataFrame([(0, 0, 1), (3, 0, 2), (searches.SPAN, 0, 4)], "place long, word long, bits long")
    first = searches.first_reached(rows)
    assert sorted((r.block, r.found) for r in first.collect()) == [(0, 2), (1, 1)]
    found = searches.next_reached(packed, first, None).collect()
    assert [(r.block, r.word, r.found) for r in found] == [(0, 0, 2 * n - 2)]


def test_searches_go_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(graph, "ROUND", 50)
    seen = []
    rounds = graph._in_rounds
    monkeypatch.setattr(graph, "_in_rounds", lambda numbered: seen.append(rounds(numbered)) or seen[-1])
    n, edges = CASES["hub"]
    near = around(edges)
    wanted = Counter(d for s in range(n) for t, d in walk(s, near).items() if s <= t)
    counts = graph.path_length_counts(vertices(spark, range(n)), frame(spark, edges))
    assert {r.dist: r.cnt for r in counts.collect()} == wanted and seen[0][1] > 1


def test_rows_sent_for_a_written_table_are_deleted(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()

    def sent():
        return {f for folder in folders for _, _, files in os.walk(folder) for f in files if f.startswith("shuffle")}

    before = sent()
    table = materialize(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    until = time.time() + 20
    while sent() - before and time.time() < until:  # they are deleted beside the driver's next steps
        time.sleep(0.2)
    assert not sent() - before
    assert len(table.collect()) == 7 and spark.conf.get(durable._CLEANUP) == "false"


def test_triangles_are_sought_in_rounds(spark, monkeypatch):
    n, edges = CASES["hub"]
    near = around(edges)
    wanted = {i: sum(1 for a, b in combinations(sorted(near[i]), 2) if b in near[a]) for i in range(n)}
    tables = []
    monkeypatch.setattr(graph, "SENT", 30)
    monkeypatch.setattr(graph, "materialize", lambda df, tag="table": tables.append(tag) or materialize(df, tag))
    found = graph.triangle_count(vertices(spark, range(n)), frame(spark, edges))
    assert {r.id: r.triangles for r in found.collect()} == wanted and tables.count("triangle-corners") > 1
