"""URL filters: rules by host and path, and a list of canonical URLs behind a blocked Bloom filter; built-in functions only.

A canonical URL picks one block of 256 bits and one bit in each of the block's four 64-bit words. The list sets its bits, which
are combined with OR below the shuffle. A URL whose bits are not all set is not listed; the few that pass are joined with the
list itself, so that false positives fall out and the verdict is exact.

The filter is sent to all executors. It never has more than ``MOST_BLOCKS`` blocks, whatever the length of the list: a longer
list fills it more, so that more URLs go on to the exact join, which scales with the list.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.plans.durable import materialize

#: Verdict, host, path.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: Listed URLs per block, and blocks at most: 64 MB of bits.
_PER_BLOCK, MOST_BLOCKS = 16, 1 << 21
_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Names of query parameters that don't change the page, and file names that stand for their folder; fixed values.
_IDLE = r"(?:utm_[a-z]+|ref|gclid|fbclid|sessionid)"


def host_of(url: Column) -> Column:
    """What is between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _CAPITALS, _SMALL)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """One writing of URLs that name the same page; NULL without a host.

    The scheme, ``www.``, a default port, the fragment, idle query parameters, a final slash and ``index.html`` or ``.html``
    are dropped; the other parameters stay in their order.
    """
    host = F.regexp_replace(F.regexp_replace(host_of(url), r"^www\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(path_of(url), r"(/index)?\.html?$", "")
    path = F.regexp_replace(path, r"/+$", "")
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    kept = F.filter(F.split(query, "&"), lambda part: (part != "") & ~part.rlike(rf"^{_IDLE}="))
    query = F.array_join(kept, "&")
    return F.when(host != "", F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")))


def _rule_columns(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; NULL if none fits. Rules are few: each is one more condition."""
    rule = verdict = F.lit(None).cast("string")
    # The longest comes last and so is asked first.
    for says, of, start in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == of) | host.endswith(f".{of}")) & path.startswith(start)
        rule, verdict = F.when(fits, F.lit(of + start)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def _block(hash_: Column, blocks: int) -> Column:
    return F.pmod(hash_, F.lit(blocks))


def _masks(key: Column) -> list[Column]:
    """One bit in each of four words, from a second hash of the key."""
    bits = F.xxhash64(key, F.lit(1))
    places = [F.shiftrightunsigned(bits, 6 * n).bitwiseAND(F.lit(63)).cast("int") for n in range(4)]
    return [F.call_function("shiftleft", F.lit(1).cast("bigint"), place) for place in places]


def bloom_filter(listed: DataFrame, key_col: str, blocks: int) -> DataFrame:
    """(_block, w0, w1, w2, w3): the blocks that have a bit set."""
    masks = _masks(F.col(key_col))
    rows = listed.where(F.col(key_col).isNotNull()).select(
        _block(F.xxhash64(key_col), blocks).alias("_block"), *[m.alias(f"m{n}") for n, m in enumerate(masks)]
    )
    return rows.groupBy("_block").agg(*[F.bit_or(f"m{n}").alias(f"w{n}") for n in range(4)])


def filter_urls(
    pages: DataFrame, listed: DataFrame, id_col: str = "page_id", url_col: str = "url",
    rules: Sequence[tuple[str, str, str]] = RULES,
) -> DataFrame:
    """(id, host, path, rule, verdict, canonical, listed) of every row of ``pages``.

    ``listed`` has canonical URLs in its first column; repeats and NULL don't matter. The longest rule that fits decides; if
    none fits, a listed URL is blocked and any other allowed. A NULL URL, or one without ``://``, has an empty host and path,
    is not listed and so allowed. Repeated rows are repeated; empty tables give an empty result or an empty list; other
    columns of ``pages`` are not looked at.
    """
    name = listed.columns[0]
    known = materialize(listed.select(F.col(name).alias("_listed")).where(F.col("_listed").isNotNull()).distinct(), "url-list")
    blocks = max(1, min(MOST_BLOCKS, known.count() // _PER_BLOCK + 1))
    url = F.col("_url")
    rows = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"))
    rows = rows.select("_id", host_of(url).alias("host"), path_of(url).alias("path"), canonical(url).alias("canonical"))
    rule, verdict = _rule_columns(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "_ruled": verdict})

    # At most MOST_BLOCKS rows of five numbers.
    bits = F.broadcast(bloom_filter(known, "_listed", blocks).withColumnRenamed("_block", "_at"))
    probed = rows.withColumn("_block", _block(F.xxhash64("canonical"), blocks)).join(bits, F.col("_block") == F.col("_at"), "left")
    passes = F.lit(True)
    for n, mask in enumerate(_masks(F.col("canonical"))):
        passes = passes & (F.coalesce(F.col(f"w{n}"), F.lit(0)).bitwiseAND(mask) == mask)
    # Only what passes has a key in the exact join; the rest stays where it is.
    probed = probed.withColumn("_passes", F.col("canonical").isNotNull() & passes)
    kept = ["_id", "host", "path", "rule", "_ruled", "canonical", "_passes"]
    probed = materialize(probed.select(*kept), "url-probed")
    hits = probed.where("_passes").join(known, F.col("canonical") == F.col("_listed"), "left")
    judged = hits.withColumn("listed", F.col("_listed").isNotNull()).drop("_listed").unionByName(
        probed.where("not _passes").withColumn("listed", F.lit(False))
    )
    verdict = F.coalesce("_ruled", F.when(F.col("listed"), F.lit("block")).otherwise("allow"))
    return judged.select(F.col("_id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"), "canonical", "listed")


def shared_addresses(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """Canonical URLs that several pages have: addresses that a crawl has fetched again and again."""
    keys = pages.select(canonical(F.col(url_col)).alias("listed")).where(F.col("listed").isNotNull())
    return keys.groupBy("listed").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select("listed")
