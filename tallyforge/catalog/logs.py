"""Advertising and web access logs, batch form."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyforge.catalog import fixtures as fx
from tallyforge.catalog.registry import query, rounded, sql, table
from tallyforge.functions import adlogs, times, weblogs
from tallyforge.operators import access_log, counting, cube

_FIELDS = ["query_type", "os", "source_type", "appid", "source", "active", "did", "user_type", "gameuid", "ip"]
_PARSED = f"parsed AS (SELECT event_id, line, try_cast(line AS JSON) AS j FROM ({fx.AD_LINES}))"
_BUCKET = r"concat(substring(regexp_replace({0}, '[\s:-]', '', 'g'), 1, 11), '0')"
_FLAT = ", ".join(f"coalesce(j->>'$.payload.{f}', 'None') AS {f}" for f in _FIELDS)
_ADS = f"""{_PARSED}, ads AS (
SELECT event_id, {_BUCKET.format("(j->>'$.payload.time')")} AS time, {_FLAT} FROM parsed WHERE j->>'$.type' = 'ad_log')"""


def ad_lines(spark, folder):
    return fx.log_lines(spark, folder, fx.AD_LINES)


@query("parse_json_safe", f"""
WITH {_PARSED} SELECT event_id, j->>'$.type' AS type, j->>'$.payload.os' AS os,
CASE WHEN j IS NULL THEN 'ParseException' END AS error FROM parsed""")
def parse_json_safe(spark, folder):
    parsed = adlogs.parse_json_safe(ad_lines(spark, folder), "line")
    return parsed.select("event_id", "record.type", "record.payload.os", "record.error")


@query("filter_json_type", f"WITH {_PARSED} SELECT event_id, j->>'$.type' AS type FROM parsed WHERE j->>'$.type' = 'ad_log'")
def filter_json_type(spark, folder):
    parsed = adlogs.parse_json_safe(ad_lines(spark, folder), "line")
    return adlogs.keep_type(parsed).select("event_id", "record.type")


@query("flatten_ad_payload", f"WITH {_ADS} SELECT * FROM ads")
def flatten_ad_payload(spark, folder):
    return adlogs.read_ad_log(ad_lines(spark, folder), keep=("event_id",))


@query("bucket_10min", f"""
SELECT event_id, {_BUCKET.format('ts::VARCHAR')} AS bucket, CASE WHEN user_id % 2 = 0 THEN
{_BUCKET.format('substring(ts::VARCHAR, 1, 16)')} END AS short_bucket FROM events""")
def bucket_10min(spark, folder):
    text = F.col("ts").cast("string")
    short = F.when(F.col("user_id") % 2 == 0, F.substring(text, 1, 16)).otherwise(F.substring(text, 1, 13))
    return table(spark, folder, "events").select(
        "event_id", times.ten_minute_bucket(text).alias("bucket"), times.ten_minute_bucket(short).alias("short_bucket")
    )


@query("clock_bucket", """
SELECT event_id, strftime(ts - INTERVAL 60 SECOND, '%Y%m%d%H%M') AS minute,
       concat(substring(strftime(ts - INTERVAL 60 SECOND, '%Y%m%d%H%M'), 1, 11), '0') AS ten_minutes,
       strftime(ts - INTERVAL 60 SECOND, '%H%M') = '0000' AS zero_point FROM events""")
def clock_bucket(spark, folder):
    return table(spark, folder, "events").select(
        "event_id", times.minute_before("ts").alias("minute"), times.ten_minutes_before("ts").alias("ten_minutes"),
        times.is_zero_point("ts").alias("zero_point"),
    )


_CUBE_DIMS = ["os", "source_type", "appid", "source", "active"]
_CUBE_SHOWN = ", ".join(f"CASE WHEN grouping({d}) = 1 THEN '_NONE' ELSE {d} END AS {d}" for d in _CUBE_DIMS)


@query("ad_cube", f"""
WITH {_ADS} SELECT time, query_type, {_CUBE_SHOWN}, count(*) AS cnt FROM ads
GROUP BY time, query_type, CUBE ({', '.join(_CUBE_DIMS)})""")
def ad_cube(spark, folder):
    return cube.ad_cube(adlogs.read_ad_log(ad_lines(spark, folder)))


# The checking engine names groups up to 9 only, so the last two come from a second pattern that captures just them.
_PATTERN = weblogs.ACCESS_LOG_PATTERN
_TAIL = (
    r'^\S+ \S+ \S+ \[[\w\d:\/]+\s[+\-]\d{4}\] "\S+ \S+ \S+" \d{3} [\d\-]+ "([^"]+)" "([^"]+)'
)
_GROUP = {name: f"regexp_extract(line, '{_PATTERN}', {i})"
          for i, name in enumerate(weblogs.ACCESS_LOG_FIELDS[:9], start=1)}
_LOGS = f"""logs AS (
SELECT event_id, ts, {', '.join(f"{_GROUP[n]} AS {n}" for n in weblogs.ACCESS_LOG_FIELDS[:5])},
       CASE WHEN {_GROUP['endpoint']} = '' OR {_GROUP['endpoint']} LIKE '%/' THEN {_GROUP['endpoint']}
            ELSE concat({_GROUP['endpoint']}, '/') END AS endpoint,
       {_GROUP['protocol']} AS protocol,
       coalesce(try_cast({_GROUP['response_code']} AS INT), 0) AS response_code,
       coalesce(try_cast({_GROUP['content_size']} AS BIGINT), 0) AS content_size,
       regexp_extract(line, '{_TAIL}', 1) AS referer, regexp_extract(line, '{_TAIL}', 2) AS agent
FROM ({fx.ACCESS_LINES}))"""


def access_logs(spark, folder, keep=()):
    return weblogs.parse_access_log(fx.log_lines(spark, folder, fx.ACCESS_LINES), keep=keep)


@query("parse_access_log", f"WITH {_LOGS} SELECT * EXCLUDE (ts) FROM logs")
def parse_access_log(spark, folder):
    return access_logs(spark, folder, ("event_id",))


@query("log_content_stats", f"""
WITH {_LOGS} SELECT (sum(content_size) // count(*))::BIGINT AS avg_size, min(content_size) AS min_size,
max(content_size) AS max_size FROM logs""")
def log_content_stats(spark, folder):
    return access_log.content_stats(access_logs(spark, folder))


@query("log_status_counts", f"""
WITH {_LOGS} SELECT response_code, count(*) AS total FROM logs GROUP BY 1 ORDER BY 1 LIMIT 1000""")
def log_status_counts(spark, folder):
    return access_log.status_counts(access_logs(spark, folder))


@query("log_frequent_ips", f"""
WITH {_LOGS} SELECT ip_address, count(*) AS total FROM logs GROUP BY 1 HAVING count(*) > 10
ORDER BY total DESC, ip_address LIMIT 100""")
def log_frequent_ips(spark, folder):
    return access_log.frequent_ips(access_logs(spark, folder))


@query("log_top_endpoints", f"""
WITH {_LOGS} SELECT endpoint, count(*) AS total FROM logs GROUP BY 1 ORDER BY total DESC, endpoint LIMIT 10""")
def log_top_endpoints(spark, folder):
    return access_log.top_endpoints(access_logs(spark, folder))


@query("distinct_set_size", """
SELECT substring(ts::VARCHAR, 1, 10) AS day, event_type, count(DISTINCT user_id) AS set_size FROM events GROUP BY 1, 2""")
def distinct_set_size(spark, folder):
    events = table(spark, folder, "events").withColumn("day", F.substring(F.col("ts").cast("string"), 1, 10))
    return counting.distinct_set_size(events, ["day", "event_type"], "user_id")


@query("list_not_contains", f"""
SELECT event_id, user_id, info, link FROM ({fx.USER_LINKS}) WHERE NOT list_contains(string_split(info, ','), link)""")
def list_not_contains(spark, folder):
    joined = fx.fixture(spark, folder, fx.USER_LINKS)
    return counting.list_not_contains(joined, "info", "link")


@query("join_not_member", f"""
SELECT user_id, info, link, count(*) AS cnt FROM ({fx.USER_LINKS})
WHERE NOT list_contains(string_split(info, ','), link) GROUP BY ALL""")
def join_not_member(spark, folder):
    info = sql(spark, folder, """
        SELECT DISTINCT cast(user_id AS string) AS user_id,
               concat(cast(user_id % 10 AS string), ',', cast((user_id + 3) % 10 AS string)) AS info FROM events""")
    events = sql(spark, folder, """
        SELECT cast(user_id AS string) AS user_id, cast(event_id % 10 AS string) AS link FROM events""")
    kept = counting.join_not_member(info, events, "user_id", "info", "link")
    return kept.groupBy("user_id", "info", "link").agg(F.count(F.lit(1)).alias("cnt"))


@query("union_all", """
SELECT o_custkey AS key, o_totalprice AS amount, 'order' AS kind FROM orders
UNION ALL SELECT c_custkey, c_acctbal, 'balance' FROM customer
UNION ALL SELECT s_suppkey, s_acctbal, 'supplier' FROM supplier""")
def union_all(spark, folder):
    parts = [("orders", "o_custkey", "o_totalprice", "order"), ("customer", "c_custkey", "c_acctbal", "balance"),
             ("supplier", "s_suppkey", "s_acctbal", "supplier")]
    frames = [
        table(spark, folder, name).select(F.col(key).alias("key"), F.col(amount).alias("amount"), F.lit(kind).alias("kind"))
        for name, key, amount, kind in parts
    ]
    return counting.union_all(*frames)


@query("distinct_values", "SELECT DISTINCT l_returnflag, l_linestatus, l_suppkey FROM lineitem")
def distinct_values(spark, folder):
    return counting.distinct_values(table(spark, folder, "lineitem"), "l_returnflag", "l_linestatus", "l_suppkey")


@query("global_count", "SELECT count(*) AS cnt FROM lineitem")
def global_count(spark, folder):
    return counting.global_count(table(spark, folder, "lineitem"))


@query("count_by_value", "SELECT user_id, event_type, count(*) AS cnt FROM events GROUP BY ALL")
def count_by_value(spark, folder):
    return counting.count_by_value(table(spark, folder, "events"), "user_id", "event_type")


@query("sort_tuples", "SELECT user_id, event_type, count(*) AS cnt FROM events GROUP BY ALL ORDER BY 1, 2")
def sort_tuples(spark, folder):
    counts = counting.count_by_value(table(spark, folder, "events"), "user_id", "event_type")
    return counting.sort_tuples(counts, "user_id", "event_type")


@query("take_n", "SELECT event_id, user_id, round(value, 6) AS value FROM events ORDER BY event_id LIMIT 100")
def take_n(spark, folder):
    events = table(spark, folder, "events").select("event_id", "user_id", rounded("value").alias("value"))
    return counting.take_n(events, 100, "event_id")


@query("kth_largest", "SELECT min(value) AS threshold FROM (SELECT value FROM events ORDER BY value DESC LIMIT 100)")
def kth_largest(spark, folder):
    return counting.kth_largest(table(spark, folder, "events"), "value", 100)
