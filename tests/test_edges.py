"""Edge cases of parsing, counting and statistics."""

from __future__ import annotations

import hashlib
import math
from xml.etree import ElementTree

import pytest
from pyspark.sql import functions as F

from tallyforge.catalog import fixtures as fx
from tallyforge.functions import adlogs, matrices, scalars, times, weblogs
from tallyforge.functions.terms import only_letters, term_list, term_rows
from tallyforge.operators import clustering, counting, cube, features, profiling, sampling, tfidf, trees
from tallyforge.sources import sinks, text, xml


def values(df, column):
    return [r[column] for r in df.collect()]


def lines(spark, *rows):
    return spark.createDataFrame([(r,) for r in rows], "value string")


def words(spark, line):
    return values(counting.tokenize_space(lines(spark, line)), "word")


def test_space_tokens(spark):
    assert words(spark, "a  b") == ["a", "", "b"]
    assert words(spark, "a b  ") == ["a", "b"]
    assert words(spark, "") == [""]
    assert words(spark, "   ") == []
    assert words(spark, " a") == ["", "a"]


def test_hash_id_by_bytes(spark):
    texts = ["", "a", "abc", "Zürich", "日本", "x" * 500]
    wanted = [int.from_bytes(hashlib.md5(t.encode()).digest()[:8], "little", signed=True) for t in texts]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", scalars.hash_id("t").alias("h"))
    assert [r.h for r in rows.orderBy("i").collect()] == wanted
    assert spark.createDataFrame([(None,)], "t string").select(scalars.hash_id("t").alias("h")).first().h is None


def test_ten_minute_bucket(spark):
    cases = {"2024-01-01 10:17:30": "202401011010", "2024-01-01 10:17": "202401011010", "2024-01-01 10": None,
             "": None, "2024/01/01 10:17:30": None, "202401011019": "202401011010"}
    rows = spark.createDataFrame([(k,) for k in cases], "t string").select("t", times.ten_minute_bucket("t").alias("b"))
    assert {r.t: r.b for r in rows.collect()} == cases


def test_zero_point(spark):
    rows = spark.sql("SELECT TIMESTAMP_NTZ '2024-03-01 00:01:30' AS a, TIMESTAMP_NTZ '2024-03-01 00:00:59' AS b")
    row = rows.select(
        times.is_zero_point("a").alias("a"), times.is_zero_point("b").alias("b"), times.minute_before("b").alias("m"),
        times.ten_minutes_before("b").alias("t"),
    ).first()
    assert (row.a, row.b, row.m, row.t) == (True, False, "202402292359", "202402292350")


def test_json_lines(spark):
    rows = spark.createDataFrame([
        (1, '{"type":"ad_log","payload":{"time":"2024-01-01 00:09:00","os":3,"appid":null}}'),
        (2, "{bad"), (3, '{"type":"sys_log"}'), (4, None), (5, '{"payload":{"os":"x"}}'),
    ], "i int, line string")
    parsed = adlogs.parse_json_safe(rows, "line").select("i", "record.error").orderBy("i")
    assert values(parsed, "error") == [None, "ParseException", None, "ParseException", None]
    flat = adlogs.read_ad_log(rows, keep=("i",)).collect()
    assert len(flat) == 1 and flat[0].time == "202401010000"
    assert (flat[0].os, flat[0].appid, flat[0].source) == ("3", "None", "None")


def test_access_log(spark):
    good = '1.2.3.4 - bob [10/Oct/2000:13:55:36 -0700] "GET /a HTTP/1.0" 200 {size} "http://r" "agent"'
    rows = spark.createDataFrame([
        (1, good.format(size="12")), (2, good.format(size="-")), (3, "junk"), (4, ""),
        (5, good.format(size="7") + " and more"), (6, good.format(size="7").replace("/a", "/a/")),
    ], "i int, line string")
    out = {r.i: r for r in weblogs.parse_access_log(rows, keep=("i",)).collect()}
    assert out[1].endpoint == "/a/" and out[1].content_size == 12 and out[1].agent == "agent"
    assert out[2].content_size == 0 and out[2].response_code == 200
    for i in (3, 4):
        assert out[i].ip_address == "" and out[i].response_code == 0 and out[i].endpoint == "" and out[i].agent == ""
    assert out[5].content_size == 7 and out[5].agent == "agent" and out[6].endpoint == "/a/"


def test_id_names_and_aliases(spark):
    named = text.parse_id_name(lines(spark, "1\t A b \t", "x\tname", "no tab", "2\t", "+3\tc", " 4\td", "5\te\tf"))
    assert {(r.id, r.name) for r in named.collect()} == {(1, "A b"), (2, ""), (3, "c"), (5, "e\tf")}
    alias = text.parse_alias(lines(spark, "1\t2", "\t3", "1\t5", "7"))
    assert {(r.bad, r.good) for r in alias.collect()} == {(1, 5)}


def test_stopword_file(spark, tmp_path):
    (tmp_path / "w.txt").write_text("a\nours\tourselves\n\nthe the\n")
    assert sorted(values(text.scan_stopwords(spark, str(tmp_path)), "word")) == ["a", "ours", "ourselves", "the"]


def test_linkage_file(spark, tmp_path):
    header = '"id_1","id_2",' + ",".join(f'"c{i}"' for i in range(9)) + ',"is_match"'
    for n, match in enumerate(("TRUE", "FALSE")):
        (tmp_path / f"{n}.csv").write_text(f"{header}\n{n},5,1,?,0.5,1,1,1,1,1,?,{match}\n")
    pairs = text.with_scores(text.scan_linkage_csv(spark, str(tmp_path))).orderBy("id_1").collect()
    assert [p.matched for p in pairs] == [True, False]
    assert pairs[0].scores[1] is None and pairs[0].scores[8] is None and pairs[0].scores[2] == 0.5


def test_xml_records(spark, tmp_path):
    record = '<MedlineCitation Owner="a">\n<PMID>{n}</PMID>{topics}\n</MedlineCitation>\n'
    topic = '<DescriptorName MajorTopicYN="{yn}">{name}</DescriptorName>'
    body = "<Set>\n" + record.format(n=1, topics=topic.format(yn="Y", name="A &amp; B") + topic.format(yn="N", name="C")) \
        + record.format(n=2, topics="") + record.format(n=3, topics=topic.format(yn="Y", name="Z") + topic.format(yn="Y", name="D")) + "</Set>\n"
    (tmp_path / "m.xml").write_text(body)
    records = xml.scan_xml_records(spark, str(tmp_path), xml.CITATION_TAG)
    assert sorted(map(tuple, values(records.select(xml.major_topics("xml").alias("t")), "t"))) == [(), ("A & B",), ("Z", "D")]


def test_node_texts(spark):
    records = [
        '<a><n>1</n><d k="Y">x<!-- c -->y<d k="Y">in</d>z</d></a>', '<a><n> 2 </n><b><d k="N">u</d><d k="Y"></d></b></a>', "", None,
    ]
    rows = spark.createDataFrame(list(enumerate(records)), "id int, xml string").coalesce(1)
    found = rows.select("id", xml.node_texts("xml", "/a/n"), xml.node_texts("xml", "//d"), xml.node_texts("xml", "//d", ("k", "Y")))
    assert [tuple(r)[1:] for r in found.orderBy("id").collect()] == [
        (["1"], ["x", "y", "in", "z"], ["x", "y", "in", "z"]), ([" 2 "], ["u"], []), (None, None, None), (None, None, None),
    ]
    # Records that only together look like as many records are errors, each by itself.
    for broken in (["<a></a><a>", "</a>"], ["<a/>t", "<a/>"], ["<a>"]):
        with pytest.raises(ElementTree.ParseError):
            xml.parsed_records(broken)


def test_records_are_cut_once_and_read_without_xpath(spark, tmp_path):
    (tmp_path / "m.xml").write_text("<MedlineCitation><PMID>1</PMID></MedlineCitation>")
    records = xml.scan_xml_records(spark, str(tmp_path), xml.CITATION_TAG).select(xml.major_topics("xml").alias("t"))
    plan = records._jdf.queryExecution().optimizedPlan().toString()
    assert "xpath" not in plan and plan.count("regexp_extract(") == 1


def test_numbers_of_a_line_are_parsed_once(spark, tmp_path):
    (tmp_path / "n.csv").write_text("1,2.5,3\n1,2\n4,NaN,6\n1,2,3,4\n")
    read = text.scan_numeric_csv(spark, str(tmp_path), width=3)
    assert read._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
    assert sorted(map(str, values(read, "values"))) == ["[1.0, 2.5, 3.0]", "[4.0, nan, 6.0]"]


def test_lines_of_cover_rows(spark):
    numbers = ", ".join(f"cast({i} + 0.25 AS double) AS n{i}" for i in range(10))
    rows = spark.sql(
        f"SELECT {numbers}, w AS wilderness, s AS soil, l AS label FROM VALUES (0, 39, 1D), (3, 0, 7D), (-1, 40, 2D), "
        "(cast(NULL AS int), cast(NULL AS int), cast(NULL AS double)) AS t(w, s, l)"
    )
    cells = F.concat_ws(",", F.transform("values", lambda x: x.cast("string")))
    wanted = values(fx.with_values(rows).select(cells.alias("value")), "value")
    assert sorted(values(fx.value_lines(rows), "value")) == sorted(wanted)


def test_terms_of_a_document_in_one_row_are_not_shuffled(spark):
    once = [(1, ["b", "a", "b", None]), (2, ["x"]), (3, []), (4, None), (None, ["n", "m", "n"])]
    several = [(5, ["q", "q"]), (5, ["q", "r", "s"]), (6, ["c"]), (6, ["c", "d"]), (None, ["n", "o"])]
    schema = "doc_id long, terms array<string>"

    def found(rows):
        tf = tfidf.term_freq(spark.createDataFrame(rows, schema))
        plan = tf._jdf.queryExecution().executedPlan().toString()
        return sorted(map(tuple, tf.select("doc_id", "term", "tf", "doc_terms", "opens").collect()), key=str), plan

    alone = [(1, "a", 1, 4, 0), (1, "b", 2, 4, 1), (None, "m", 1, 3, 0), (None, "n", 2, 3, 1)]
    rows, plan = found(once)
    assert rows == alone and "Exchange" not in plan
    rows, _ = found(once + several)
    assert rows == sorted(alone[:2] + [
        (5, "q", 3, 3, 1), (5, "r", 1, 3, 0), (5, "s", 1, 3, 0), (6, "c", 2, 2, 1), (6, "d", 1, 2, 0),
        (None, "m", 1, 3, 0), (None, "n", 3, 3, 1), (None, "o", 1, 2, 0),
    ], key=str)


def test_terms(spark):
    docs = spark.createDataFrame([(1, "The the cats aren't C3PO, and Über-cool; it"), (2, "")], "doc_id int, text string")
    as_rows = term_rows(docs, "text", ("doc_id",)).groupBy("doc_id").agg(F.sort_array(F.collect_list("term")).alias("t"))
    assert [tuple(r) for r in as_rows.collect()] == [(1, ["cats", "cool", "the", "über"])]
    lists = docs.select("doc_id", F.sort_array(term_list("text")).alias("t")).orderBy("doc_id")
    assert values(lists, "t") == [["cats", "cool", "the", "über"], []]
    lemmas = spark.createDataFrame([("cats", "cat")], "word string, lemma string")
    stop = spark.createDataFrame([("cool",)], "word string")
    other = term_rows(docs, "text", ("doc_id",), stop, lemmas)
    assert sorted(values(other, "term")) == ["and", "cat", "the", "the", "über"]
    assert spark.range(1).select(only_letters(F.lit("")).alias("a"), only_letters(F.lit("ab1")).alias("b")).first() == (True, False)


def test_cube_keeps_null_and_label_apart(spark):
    rows = spark.createDataFrame([("t", "a", None), ("t", "a", "_NONE"), ("t", "b", "x")], "f string, d string, e string")
    out = cube.labelled_cube(rows, ["f"], ["d", "e"], grouping_bits="bits")
    cells = {(r.d, r.e, r.bits): r.cnt for r in out.collect()}
    assert cells[("_NONE", "_NONE", 3)] == 3
    assert cells[("_NONE", None, 2)] == 1 and cells[("_NONE", "_NONE", 2)] == 1
    assert cells[("a", "_NONE", 1)] == 2 and cells[("a", "_NONE", 0)] == 1


def test_cube_total_is_row_count(spark):
    rows = spark.range(500).selectExpr("'t' AS f", "cast(id % 3 AS string) AS d", "cast(id % 7 AS string) AS e")
    out = cube.labelled_cube(rows, ["f"], ["d", "e"])
    assert out.where("d = '_NONE' AND e = '_NONE'").agg(F.sum("cnt")).first()[0] == 500


def test_missing_scores(spark):
    rows = spark.createDataFrame([(True, 1.0), (True, float("nan")), (False, None), (False, 3.0)], "m boolean, s double")
    one = profiling.stats_with_missing(rows, ["s"]).first()
    assert (one.cnt, one.missing, one.mean, one.stdev) == (2, 2, 2.0, 1.0)
    gap = profiling.match_separation(rows, ["s"], "m").first()
    assert (gap.missing, gap.mean_gap) == (2, -2.0)
    nothing = profiling.summary_stats(rows.where("false"), "s").first()
    assert nothing.cnt == 0 and nothing.mean is None


def test_zscore_of_a_constant_column(spark):
    rows = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    assert [tuple(r) for r in features.zscore(rows, ["a", "b"]).orderBy("a").collect()] == [(-1.0, 0.0), (1.0, 0.0)]
    arrays = rows.select(F.array("a", "b").alias("v"))
    assert sorted(map(tuple, values(features.zscore_vector(arrays, "v"), "v"))) == [(-1.0, 0.0), (1.0, 0.0)]


def test_onehot_positions(spark):
    block = [0.0] * 55
    block[12], block[54] = 1.0, 3.0
    row = features.unencode_onehot(spark.createDataFrame([(block,)], "values array<double>")).first()
    assert row.features[10:] == [2.0, -1.0] and row.label == 2.0


def test_onehot_of_nulls_and_nothing(spark):
    rows = spark.createDataFrame([(1, "b", "x"), (2, None, "x"), (3, "a", "y"), (4, "b", None)], "n int, kind string, `_value_0` string")
    found = {r.n: r.features for r in features.onehot_encode(rows, ["n"], ["kind", "_value_0"], keep=["n"]).collect()}
    assert found == {1: [1, 0, 1, 1, 0], 2: [2, 0, 0, 1, 0], 3: [3, 1, 0, 0, 1], 4: [4, 0, 1, 0, 0]}
    assert features.onehot_encode(rows.limit(0), ["n"], ["kind"]).count() == 0
    assert features.onehot_encode(rows.where("n = 2"), ["n"], ["kind"]).first().features == [2.0]
    many = spark.range(0, 5000, numPartitions=4).select(((F.col("id") * 7919) % 5000).alias("v"))
    assert features.category_numbers(many, "v").where("value <> place").count() == 0


def test_unit_of_zero_is_null(spark):
    row = spark.range(1).select(matrices.unit_rows(F.array(F.lit(0.0), F.lit(0.0))).alias("z"), matrices.unit_rows(F.array(F.lit(3.0), F.lit(4.0))).alias("u"))
    assert row.first().z is None and row.first().u == [0.6, 0.8]


def test_chi_square(spark):
    def plain(yy, yb, ya, t):
        nb, na, yn, ny = t - yb, t - ya, ya - yy, yb - yy
        nn = t - ny - yn - yy
        return t * (abs(yy * nn - yn * ny) - t / 2) ** 2 / (ya * na * yb * nb)

    cases = [(5, 10, 20, 100), (1, 1, 1, 1000), (300000, 600000, 700000, 10_000_000)]
    rows = spark.createDataFrame(cases, "yy long, yb long, ya long, t long")
    found = values(rows.select(scalars.chi_square("yy", "ya", "yb", "t").alias("c")), "c")
    assert all(math.isclose(a, plain(*b), rel_tol=1e-9) for a, b in zip(found, cases))
    assert rows.select(scalars.chi_square(F.lit(5), F.lit(9), F.lit(5), F.lit(9)).alias("c")).first().c is None


def test_entropy(spark):
    counts = spark.createDataFrame([(1, 4), (1, 4), (1, 0), (2, 9)], "cluster int, cnt int")
    found = {r.cluster: (r.total, r.entropy) for r in clustering.entropy(counts, by=("cluster",)).collect()}
    assert math.isclose(found[1][1], math.log(2)) and found[1][0] == 8 and found[2] == (9, 0.0)


def test_priors_join_on_label(spark):
    a = spark.createDataFrame([(0.0,), (1.0,)], "label double")
    b = spark.createDataFrame([(1.0,), (2.0,)], "label double")
    assert trees.random_guess_accuracy(a, b).first().accuracy == 0.25


def test_precision_of_an_unseen_class_is_null(spark):
    rows = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0)], "label double, prediction double")
    found = {r["class"]: (r.precision, r.recall) for r in trees.per_class_precision_recall(rows).collect()}
    assert found == {0.0: (0.5, 1.0), 1.0: (None, 0.0)}


def test_tfidf_counts_terms_outside_the_vocabulary(spark):
    docs = spark.createDataFrame(
        [(1, ["a", "a", "b", "z"]), (2, ["a", "b"]), (3, ["q"]), (4, ["b", "c"]), (5, [])], "doc_id int, terms array<string>"
    )
    found = {(r.doc_id, r.term): r.weight for r in tfidf.tfidf_matrix(docs, 2).collect()}
    assert set(found) == {(1, "a"), (1, "b"), (2, "a"), (2, "b"), (4, "b")}
    assert math.isclose(found[(1, "a")], math.log(3 / 2) * 2 / 4) and found[(4, "b")] == 0.0


def test_splits_cover_everything_once(spark):
    rows = spark.range(5000).withColumnRenamed("id", "k")
    parts = sampling.split_by_hash(rows, "k", (0.8, 0.1, 0.1))
    sizes = [p.count() for p in parts]
    assert sum(sizes) == 5000 and 3700 < sizes[0] < 4300
    assert sum(p.count() for p in sampling.random_split(rows, (0.5, 0.5), 1)) == 5000
    assert 0 < sampling.sample_rows(rows, 0.1, 11).count() < 1000


def test_kth_largest_of_few(spark):
    rows = spark.createDataFrame([(1.0,), (5.0,), (None,)], "x double")
    assert counting.kth_largest(rows, "x", 100).first().threshold == 1.0
    assert counting.trim_by_frequency(spark.createDataFrame([("a", 1), ("b", 9)], "w string, cnt int"), 1, least=False).first().w == "b"


def test_text_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), (None, 2)], "t string, n int")
    sinks.sink_text(rows, str(tmp_path / "t"))
    sinks.sink_tsv(rows.where("t = 'a'"), str(tmp_path / "v"))
    assert sorted(values(text.scan_text(spark, str(tmp_path / "t")), "value")) == [",2", "a,1"]
    assert values(text.scan_text(spark, str(tmp_path / "v"), min_partitions=2), "value") == ["a\t1"]
