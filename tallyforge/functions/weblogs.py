"""Web access logs in combined format."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.plans.layout import computed_once

# The line pattern and the fields of its groups, in order.
ACCESS_LOG_PATTERN = (
    r'^(\S+) (\S+) (\S+) \[([\w\d:\/]+\s[+\-]\d{4})\] "(\S+) (\S+) (\S+)" (\d{3}) ([\d\-]+) "([^"]+)" "([^"]+)'
)
ACCESS_LOG_FIELDS = [
    "ip_address", "client_identd", "user_id", "date_time", "method", "endpoint", "protocol",
    "response_code", "content_size", "referer", "agent",
]


# What the pattern leaves of a line that matches: its groups, a control character before each.
_MARK = "\x01"
_GROUPS_APART = "".join(f"{_MARK}${i}" for i in range(1, len(ACCESS_LOG_FIELDS) + 1))


def parse_access_log(df: DataFrame, column: str = "line", keep: tuple[str, ...] = ()) -> DataFrame:
    """Eleven columns from a log line. A line that does not match stays, with empty texts and zeros.

    The pattern runs once per line, not once per column: it puts a control character between groups. Only a line that
    holds this character itself is matched again for each group. A line may be a message with line breaks.
    """
    line = F.col(column)
    apart = F.split(F.regexp_replace(line, ACCESS_LOG_PATTERN + "(?s:.*)", _GROUPS_APART), _MARK, -1)
    each = F.array(F.lit(""), *[F.regexp_extract(line, ACCESS_LOG_PATTERN, i + 1) for i in range(len(ACCESS_LOG_FIELDS))])
    marked = F.when(line.rlike(ACCESS_LOG_PATTERN), each).otherwise(F.array(F.lit("")))
    apart = F.when(line.contains(_MARK), marked).otherwise(apart)
    lines = computed_once(df.select(*dict.fromkeys([*keep, column])), "_groups", apart)
    matched = F.size("_groups") == len(ACCESS_LOG_FIELDS) + 1
    groups = {
        name: F.when(matched, F.get("_groups", F.lit(i))).otherwise("")
        for i, name in enumerate(ACCESS_LOG_FIELDS, start=1)
    }
    endpoint, size = groups["endpoint"], groups["content_size"]
    groups["endpoint"] = F.when((endpoint == "") | endpoint.endswith("/"), endpoint).otherwise(
        F.concat(endpoint, F.lit("/"))
    )
    groups["response_code"] = F.coalesce(groups["response_code"].try_cast("int"), F.lit(0))
    groups["content_size"] = F.coalesce(size.try_cast("bigint"), F.lit(0).cast("bigint"))
    return lines.select(*keep, *[expr.alias(name) for name, expr in groups.items()])
