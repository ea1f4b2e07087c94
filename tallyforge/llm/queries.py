"""The operators of the subpackage as queries over whole test tables, and the SQL that checks them where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.catalog.registry import Query, table
from tallyforge.llm import ann, bpe, bwt_dedup, collocations, embed_neardup, language_id, mixing, ranked_search, secret_scan, simhash, substring_dedup, url_filter, warc

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def vocabulary_path() -> str:
    """The tokenizer's file as it is installed; a parameter of the operators."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@_query
def op1_embedding_neardup(spark: SparkSession, folder: str) -> DataFrame:
    return embed_neardup.near_duplicates(table(spark, folder, "embeddings"))


@_query
def op2_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    return url_filter.filter_urls(pages, url_filter.shared_addresses(pages))


@_query
def op3_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.secret_digests(table(spark, folder, "documents"))


@_query
def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs, pages = table(spark, folder, "documents"), table(spark, folder, "pages")
    none = F.lit(None).cast("bigint")
    of_docs = docs.select("doc_id", none.alias("page_id"), *language_id.document_evidence())
    of_pages = pages.select(none.alias("doc_id"), "page_id", *language_id.page_evidence(pages))
    return language_id.identify(of_docs.unionByName(of_pages), of_docs.select("text", "declared"), ["doc_id", "page_id"])


@_query
def op5_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archive_pages(table(spark, folder, "pages"))


@_query
def op6_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, folder, "documents")).drop("kept")


@_query
def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


@_query
def op8_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return ann.nearest(vectors, vectors.where(F.col("vec_id") % 100 == 0))


@_query
def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.simhash_components(table(spark, folder, "documents"))


@_query
def op10_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trip(table(spark, folder, "documents"), vocabulary_path())


@_query
def op11_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return bwt_dedup.remove_repeated_bytes(table(spark, folder, "documents")).drop("kept")


@_query
def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))


@_query
def op13_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search.ranked_search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


_IDLE = "^(utm_[a-z]+|ref|gclid|fbclid|sessionid)="
ORACLES["op2_url_filters"] = rf"""
WITH cut AS (
  SELECT page_id, coalesce(url, '') AS url,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
    list_filter(string_split(regexp_extract(coalesce(url, ''), '(?s)^[^?#]*\?([^#]*)', 1), '&'),
      lambda x: x <> '' AND NOT regexp_matches(x, '{_IDLE}')) AS parts
  FROM pages),
named AS (
  SELECT page_id, host, path, CASE WHEN host <> '' THEN
    regexp_replace(regexp_replace(host, '^www\.', ''), ':(80|443)$', '')
    || regexp_replace(regexp_replace(path, '(/index)?\.html?$', ''), '/+$', '')
    || CASE WHEN len(parts) > 0 THEN '?' || array_to_string(parts, '&') ELSE '' END END AS canonical
  FROM cut),
listed AS (SELECT canonical FROM named WHERE canonical IS NOT NULL GROUP BY 1 HAVING count(*) > 1),
rules(says, of_host, start) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
  ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
ruled AS (
  SELECT n.*, (SELECT arg_max(of_host || start || ' ' || says, length(of_host) + length(start)) FROM rules
    WHERE (n.host = of_host OR ends_with(n.host, '.' || of_host)) AND starts_with(n.path, start)) AS hit
  FROM named n)
SELECT r.page_id, r.host, r.path, split_part(hit, ' ', 1) AS rule, r.canonical, l.canonical IS NOT NULL AS listed,
  coalesce(split_part(hit, ' ', 2), CASE WHEN l.canonical IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled r LEFT JOIN listed l ON r.canonical = l.canonical
"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_SMALL = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLES["op13_ranked_search"] = rf"""
WITH words AS (SELECT doc_id, unnest(regexp_extract_all({_SMALL}, '{_TERM}')) AS term FROM documents),
counted AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
sizes AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM counted GROUP BY ALL),
whole AS (SELECT count(*) AS big_n, sum(n)::BIGINT AS big_l FROM sizes),
asked AS (SELECT item_id, term, count(*) AS times FROM
  (SELECT item_id, unnest(regexp_extract_all({_SMALL}, '{_TERM}')) AS term FROM benchmark) GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2 * max(big_n) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM counted, whole GROUP BY term),
scored AS (
  SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * big_n) // big_l))))::BIGINT AS score
  FROM asked JOIN counted USING (term) JOIN weights USING (term) JOIN sizes USING (doc_id), whole GROUP BY ALL),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
  FROM scored WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 20
"""

ORACLES["op12_collocations"] = rf"""
WITH pieces AS (
  SELECT lang, row_number() OVER () AS piece, words FROM (
    SELECT lang, regexp_extract_all(unnest(regexp_split_to_array({_SMALL}, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS words
    FROM (SELECT coalesce(lang, 'und') AS lang, coalesce(text, '') AS text FROM documents)) WHERE len(words) > 0),
sized AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS pos FROM pieces),
starts AS (SELECT lang, words[pos:pos + 4] AS words FROM sized),
grams AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS size FROM starts),
counts AS (SELECT lang, words[1:size] AS words, size, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
totals AS (SELECT lang, sum(len(words))::BIGINT AS n FROM pieces GROUP BY lang),
found AS (SELECT * FROM counts WHERE size > 1),
parts AS (SELECT lang, words, size, f, unnest(range(2, size)) AS part FROM found),
inner_parts AS (SELECT lang, words, f, part, unnest(range(1, size - part + 2)) AS pos FROM parts),
longer AS (SELECT lang, words[pos:pos + part - 1] AS words, max(f) AS longest FROM inner_parts GROUP BY ALL),
kept AS (SELECT found.* FROM found LEFT JOIN longer USING (lang, words) WHERE longest IS NULL OR 100 * longest < 100 * f),
cuts AS (SELECT *, unnest(range(1, size)) AS cut FROM kept),
scored AS (
  SELECT c.lang, c.words, c.f AS a, cut, x.f AS l, y.f AS r, n,
    (1000::HUGEINT * c.f::HUGEINT * n::HUGEINT) // (x.f::HUGEINT * y.f::HUGEINT) AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.words = c.words[1:cut]
    JOIN counts y ON y.lang = c.lang AND y.words = c.words[cut + 1:c.size] JOIN totals t ON t.lang = c.lang),
least AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, cut) = 1),
named AS (SELECT lang, array_to_string(words, ' ') AS phrase, a, l, r, n, score::BIGINT AS score FROM least),
ranked AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM named)
SELECT * FROM ranked WHERE rank <= 2000
"""
