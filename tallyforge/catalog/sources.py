"""Readers and writers: each query writes a derived file with Spark, reads it back, and is checked against the table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyforge.catalog import fixtures as fx
from tallyforge.catalog.registry import query, rounded, sql, table
from tallyforge.functions.scalars import composite_key, is_header
from tallyforge.operators.counting import word_count
from tallyforge.operators.sampling import label_split, sample_by_hash
from tallyforge.operators.tfidf import doc_freq, term_freq
from tallyforge.plans.durable import new_folder
from tallyforge.plans.layout import unnest
from tallyforge.sources import sinks, text, xml

_LINES = r"SELECT unnest(regexp_split_to_array(text, '\r\n|\r|\n')) AS value FROM documents"


@query("scan_text", _LINES)
def scan_text(spark, folder):
    path = fx.written_text(spark, table(spark, folder, "documents").select("text"), "text")
    return text.scan_text(spark, path)


def linkage_files(spark, folder) -> str:
    """The linkage pairs as CSV files, every file with its header."""
    path = new_folder(spark, "linkage")
    fx.fixture(spark, folder, fx.LINKAGE).write.csv(path, header=True, nullValue=text.MISSING_SCORE)
    return path


@query("scan_linkage_csv", fx.LINKAGE)
def scan_linkage_csv(spark, folder):
    return text.scan_linkage_csv(spark, linkage_files(spark, folder))


@query("drop_header", f"SELECT id_1, id_2, is_match FROM ({fx.LINKAGE})")
def drop_header(spark, folder):
    lines = text.scan_text(spark, linkage_files(spark, folder))
    parts = F.split("value", ",")
    return lines.where(~is_header("value")).select(
        parts[0].cast("int").alias("id_1"), parts[1].cast("int").alias("id_2"),
        F.element_at(parts, -1).cast("boolean").alias("is_match"),
    )


_COVER_LONG = f"""
WITH c AS ({fx.COVER}),
     numbers AS (SELECT unnest([n0, n1, n2, n3, n4, n5, n6, n7, n8, n9]) AS x, unnest(range(10)) AS pos FROM c),
     blocks AS (
       SELECT 10 + i AS pos, (wilderness = i)::DOUBLE AS x FROM c, range(4) r(i)
       UNION ALL SELECT 14 + i, (soil = i)::DOUBLE FROM c, range(40) r(i)
       UNION ALL SELECT 54, label FROM c),
     cells AS (SELECT pos, x FROM numbers UNION ALL SELECT pos, x FROM blocks)
SELECT pos::INT AS pos, count(*) AS cnt, round(sum(x), 2) AS total FROM cells GROUP BY pos"""


@query("scan_numeric_csv", _COVER_LONG)
def scan_numeric_csv(spark, folder):
    lines = fx.value_lines(fx.fixture(spark, folder, fx.COVER))
    read = text.scan_numeric_csv(spark, fx.written_text(spark, lines, "numbers"), width=55)
    cells = read.select(F.posexplode("values").alias("pos", "x"))
    return cells.groupBy("pos").agg(F.count(F.lit(1)).alias("cnt"), rounded(F.sum("x"), 2).alias("total"))


@query("scan_ratings", fx.RATINGS)
def scan_ratings(spark, folder):
    line = F.concat_ws(" ", "user_id", "item_id", "cnt").alias("value")
    path = fx.written_text(spark, fx.fixture(spark, folder, fx.RATINGS).select(line), "ratings")
    return text.scan_ratings(spark, path)


@query("scan_id_name", "SELECT p_partkey::INT AS id, trim(p_name) AS name FROM part WHERE p_partkey % 100 <> 7")
def scan_id_name(spark, folder):
    return text.scan_id_name(spark, fx.written_text(spark, fx.fixture(spark, folder, fx.ITEM_NAMES), "names"))


@query("scan_alias", """
SELECT p_partkey::INT AS bad, (p_partkey - 3)::INT AS good FROM part WHERE p_partkey % 10 = 3""")
def scan_alias(spark, folder):
    return text.scan_alias(spark, fx.written_text(spark, fx.fixture(spark, folder, fx.ITEM_ALIASES), "aliases"))


@query("scan_stopwords", r"SELECT DISTINCT unnest(regexp_split_to_array(p_name, '\s+')) AS word FROM part")
def scan_stopwords(spark, folder):
    return text.scan_stopwords(spark, fx.written_text(spark, table(spark, folder, "part").select("p_name"), "words"))


def citation_files(spark, folder) -> str:
    """One citation record per order; the topics of odd line numbers are major ones. Records span several lines."""
    lines = sql(spark, folder, "SELECT l_orderkey, l_linenumber, p_name FROM lineitem JOIN part ON l_partkey = p_partkey")
    heading = F.concat(
        F.lit('<MeshHeading>\n<DescriptorName MajorTopicYN="'),
        F.when(F.col("l_linenumber") % 2 == 1, "Y").otherwise("N"),
        F.lit('">'), F.col("p_name"), F.lit("</DescriptorName></MeshHeading>"),
    )
    records = lines.groupBy("l_orderkey").agg(
        F.sort_array(F.collect_list(F.struct("l_linenumber", "p_name", heading.alias("h")))).alias("hs")
    )
    record = F.concat(
        F.lit('<MedlineCitation Owner="NLM">\n<PMID>'), F.col("l_orderkey").cast("string"),
        F.lit("</PMID>\n<MeshHeadingList>"), F.array_join(F.transform("hs", lambda x: x.h), "\n"),
        F.lit("</MeshHeadingList>\n</MedlineCitation>"),
    )
    return fx.written_text(spark, records.select(record.alias("value")), "citations")


def citation_number(record):
    return F.get(xml.node_texts(record, "/MedlineCitation/PMID"), F.lit(0)).cast("bigint")


@query("scan_xml_records", "SELECT l_orderkey AS doc, count(*) AS descriptors FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1")
def scan_xml_records(spark, folder):
    records = xml.scan_xml_records(spark, citation_files(spark, folder), xml.CITATION_TAG)
    return records.select(
        citation_number("xml").alias("doc"), F.size(xml.node_texts("xml", "//DescriptorName")).cast("bigint").alias("descriptors")
    )


@query("major_topics", """
SELECT l_orderkey AS doc, p_name AS topic,
       row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, p_name)::INT - 1 AS pos
FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_linenumber % 2 = 1""")
def major_topics(spark, folder):
    records = xml.scan_xml_records(spark, citation_files(spark, folder), xml.CITATION_TAG)
    read = records.select(citation_number("xml").alias("doc"), xml.major_topics("xml").alias("topics"))
    return unnest(read, ("doc",), F.col("topics"), "topic", "pos").select("doc", "pos", "topic")


@query("wiki_article_filter", """
SELECT concat('Doc ', doc_id) AS title,
       md5(trim(concat('lead ', CASE WHEN doc_id % 7 = 0 THEN 'deep' ELSE ' ' END, 'link   ', words, ' end'))) AS content_md5
FROM (SELECT *, array_to_string(regexp_split_to_array(text, '[^\\p{L}\\p{N}]+'), ' ') AS words FROM documents)
WHERE doc_id % 13 <> 5 AND doc_id % 11 <> 4 AND doc_id % 17 <> 6""")
def wiki_article_filter(spark, folder):
    docs = table(spark, folder, "documents")
    words = F.array_join(F.split("text", r"[^\p{L}\p{N}]+", -1), " ")
    title = F.concat(F.lit("Doc "), F.col("doc_id").cast("string"),
                     F.when(F.col("doc_id") % 13 == 5, " (disambiguation)").otherwise(""))
    depth = (F.col("doc_id") % 7).cast("int")
    nested = F.concat(F.repeat(F.lit("{{box|a="), depth), F.lit("deep"), F.repeat(F.lit("}}"), depth))
    page = F.concat(
        F.lit("<page>\n<title>"), title, F.lit("</title>\n<ns>"),
        F.when(F.col("doc_id") % 11 == 4, "1").otherwise("0"), F.lit("</ns>\n"),
        F.when(F.col("doc_id") % 17 == 6, '<redirect title="Other" />\n').otherwise(""),
        F.lit("<revision><text>'''lead''' "), nested,
        F.lit("[[Target|link]] [[File:x.png|thumb|of [[Other|that]] {{tag}}]] "), words,
        F.lit("{| class=t |- {| inner |} {{cell|}} |}end</text></revision>\n</page>"),
    )
    path = fx.written_text(spark, docs.select(page.alias("value")), "pages")
    pages = xml.scan_xml_columns(spark, path, xml.PAGE_TAG, xml.PAGE_SCHEMA)
    return xml.wiki_articles(pages).select("title", F.md5(F.col("content").cast("binary")).alias("content_md5"))


_WORDS = r"""
WITH lines AS (SELECT unnest(regexp_split_to_array(text, '\r\n|\r|\n')) AS value FROM documents),
     words AS (SELECT unnest(CASE WHEN length(value) > 0 AND rtrim(value, ' ') = '' THEN []
                                  ELSE string_split(rtrim(value, ' '), ' ') END) AS word FROM lines)"""


def document_lines(spark, folder):
    lines = F.explode(F.split("text", r"\r\n|\r|\n", -1)).alias("value")
    return fx.documents(spark, folder).select("doc_id", lines)


@query("sink_text", f"{_WORDS} SELECT concat(word, ',', count(*)) AS value FROM words GROUP BY word")
def sink_text(spark, folder):
    path = new_folder(spark, "sink-text")
    sinks.sink_text(word_count(document_lines(spark, folder)), path)
    return text.scan_text(spark, path)


_TERMS = r"""
terms AS (SELECT doc_id, lower(word) AS term
          FROM (SELECT doc_id, unnest(regexp_split_to_array(text, '[^\p{L}\p{N}'']+')) AS word FROM documents)
          WHERE length(word) > 2 AND regexp_full_match(word, '\p{L}+') AND word NOT IN (STOPWORDS))"""


def terms_sql() -> str:
    from tallyforge.functions.stopwords import ENGLISH_STOPWORDS

    quoted = ", ".join("'" + w.replace("'", "''") + "'" for w in ENGLISH_STOPWORDS)
    return _TERMS.replace("STOPWORDS", quoted)


@query("sink_tsv", f"""WITH {terms_sql()} SELECT concat(term, chr(9), count(DISTINCT doc_id)) AS value FROM terms GROUP BY term""")
def sink_tsv(spark, folder):
    path = new_folder(spark, "sink-tsv")
    docs = fx.document_terms(spark, folder)
    sinks.sink_tsv(doc_freq(term_freq(docs, more_than=0)), path)
    return text.scan_text(spark, path)


_MIXED = "((event_id + 7) % 1000003 * 7919 + 104729) % 1000003 % 10000"


@query("sample_rows", f"SELECT event_id, user_id FROM events WHERE {_MIXED} < 500")
def sample_rows(spark, folder):
    return sample_by_hash(table(spark, folder, "events").select("event_id", "user_id"), "event_id", 0.05, seed=7)


@query("random_split", f"""
SELECT event_id, CASE WHEN b < 8000 THEN 0 WHEN b < 9000 THEN 1 ELSE 2 END AS part
FROM (SELECT event_id, {_MIXED} AS b FROM events)""")
def random_split(spark, folder):
    events = table(spark, folder, "events").select("event_id")
    return label_split(events, "event_id", (0.8, 0.1, 0.1), seed=7)


@query("concat_key", """
SELECT event_id, concat_ws(':', substring(ts::VARCHAR, 1, 10), event_type, user_id::VARCHAR) AS key FROM events""")
def concat_key(spark, folder):
    events = table(spark, folder, "events").withColumn("day", F.substring(F.col("ts").cast("string"), 1, 10))
    events = events.withColumn("user_id", F.col("user_id").cast("string"))
    return events.select("event_id", composite_key(["day", "event_type", "user_id"]).alias("key"))


# Batches are stretches of five days. Some users write under a second name for a while, so that keys have gaps.
_BATCHES = """
SELECT event_type, ts, cast(floor((day(ts) - 1) / 5) AS bigint) AS batch,
       concat('u', cast(user_id AS string), CASE WHEN user_id % 2 = 1 AND day(ts) BETWEEN 6 AND 16 THEN '-away'
              WHEN user_id % 7 = 3 AND day(ts) > 20 THEN '-late' ELSE '' END) AS who
FROM events"""


_SET_BATCHES = _BATCHES.replace("SELECT event_type", "SELECT event_id, event_type", 1)


def _batch_numbers(rows):
    """The batches that are there: one per five days of the month."""
    return [row["batch"] for row in rows.select("batch").distinct().orderBy("batch").collect()]


_COUNTERS = f"""
WITH b AS (SELECT concat(event_type, ':', who) AS key, batch, count(*) AS n, max(ts) AS seen FROM ({_BATCHES}) GROUP BY ALL),
     m AS (SELECT *, seen > lag(seen) OVER (PARTITION BY key ORDER BY seen) + INTERVAL 2 DAY AS restarts FROM b),
     l AS (SELECT *, coalesce(sum(restarts::INT) OVER (PARTITION BY key ORDER BY seen
                     ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0) AS later FROM m)
SELECT key, sum(n)::BIGINT AS cnt FROM l WHERE later = 0 GROUP BY key
HAVING max(seen) + INTERVAL 2 DAY > (SELECT max(ts) FROM events)"""


@query("sink_counter_upsert", _COUNTERS)
def sink_counter_upsert(spark, folder):
    rows = fx.fixture(spark, folder, _BATCHES).withColumn("cnt", F.lit(1).cast("bigint"))
    path = new_folder(spark, "counters")
    write = sinks.sink_counter_upsert(path, ["event_type", "who"], batch_time=F.col("ts").cast("timestamp"))
    batches = _batch_numbers(rows)
    for batch in [*batches, *batches[-1:]]:  # the last is a replay, which must change nothing
        write(rows.where(F.col("batch") == batch), batch)
    now = table(spark, folder, "events").agg(F.max(F.col("ts").cast("timestamp"))).scalar()
    return sinks.read_counters(spark, path, now).select("key", "cnt")


@query("counter_store", _COUNTERS)
def counter_store(spark, folder):
    """The same counters from a store that is folded after every second batch; folded batches are replayed as well."""
    rows = fx.fixture(spark, folder, _BATCHES).withColumn("cnt", F.lit(1).cast("bigint"))
    path = new_folder(spark, "counters")
    write = sinks.sink_counter_upsert(path, ["event_type", "who"], batch_time=F.col("ts").cast("timestamp"), fold_every=2)
    batches = _batch_numbers(rows)
    for batch in [*batches, *batches[:1], *batches[-1:]]:
        write(rows.where(F.col("batch") == batch), batch)
    now = table(spark, folder, "events").agg(F.max(F.col("ts").cast("timestamp"))).scalar()
    return sinks.read_counters(spark, path, now).select("key", "cnt")


@query("sink_keyed_set", f"""
WITH b AS (SELECT concat(event_type, '@', substring(ts::VARCHAR, 1, 7)) AS key, who, event_id FROM ({_SET_BATCHES}))
SELECT key, 'users' AS "column", count(DISTINCT who)::VARCHAR AS value FROM b GROUP BY key
UNION ALL SELECT key, 'events', count(DISTINCT event_id)::VARCHAR FROM b GROUP BY key""")
def sink_keyed_set(spark, folder):
    """Distinct names and ids per kind of event and month, over batches of five days; each batch comes twice."""
    rows = fx.fixture(spark, folder, _SET_BATCHES)
    key = sinks.put_key("event_type", F.substring(F.col("ts").cast("string"), 1, 7))
    users, events = new_folder(spark, "user-sets"), new_folder(spark, "event-sets")
    put_users = sinks.sink_keyed_set(users, key, F.col("who"), "users", fold_every=3)
    put_events = sinks.sink_keyed_set(events, key, F.col("event_id"), "events", fold_every=2)
    for batch in _batch_numbers(rows):
        now = rows.where(F.col("batch") == batch)
        for put in (put_users, put_users, put_events, put_events):
            put(now, batch)
    return sinks.read_set_sizes(spark, users).unionByName(sinks.read_set_sizes(spark, events))


@query("sink_keyed_put", f"""
WITH b AS (SELECT * FROM ({_BATCHES})),
     counts AS (SELECT who, batch, count(*) AS n FROM b GROUP BY ALL),
     kinds AS (SELECT who, batch, substring(max(ts)::VARCHAR, 1, 10) AS day, count(DISTINCT event_type) AS n FROM b GROUP BY ALL)
SELECT who AS key, 'events' AS "column", arg_max(n, batch)::VARCHAR AS value FROM counts GROUP BY who
UNION ALL SELECT concat(who, '@', day), 'kinds', n::VARCHAR FROM kinds""")
def sink_keyed_put(spark, folder):
    rows = fx.fixture(spark, folder, _BATCHES)
    path, timed = new_folder(spark, "puts"), new_folder(spark, "timed-puts")
    put = sinks.sink_keyed_put(path, sinks.put_key("who"), F.col("n"), "events")
    put_timed = sinks.sink_keyed_put(timed, sinks.put_key("who", "day"), F.col("kinds"), "kinds")
    day = F.substring(F.max("ts").cast("string"), 1, 10).alias("day")
    for batch in _batch_numbers(rows):
        now = rows.where(F.col("batch") == batch).groupBy("who").agg(
            F.count(F.lit(1)).alias("n"), F.count_distinct("event_type").alias("kinds"), day
        )
        put(now, batch)
        put_timed(now, batch)
    return sinks.read_puts(spark, path).unionByName(sinks.read_puts(spark, timed))
