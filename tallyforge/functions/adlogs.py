"""Advertising logs: one JSON object per message."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.functions.times import ten_minute_bucket
from tallyforge.plans.layout import computed_once

# Names of the payload fields, record type, and texts for missing and malformed input.
PAYLOAD_FIELDS = [
    "time", "query_type", "os", "source_type", "appid", "source", "active", "did", "user_type", "gameuid", "ip",
]
AD_TYPE = "ad_log"
MISSING = "None"
PARSE_ERROR = "ParseException"

AD_SCHEMA = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("payload", T.StructType([T.StructField(f, T.StringType()) for f in PAYLOAD_FIELDS])),
])


def parse_json_safe(df: DataFrame, column: str, schema: T.StructType = AD_SCHEMA, into: str = "record") -> DataFrame:
    """Add struct ``into``; its field ``error`` is set, and all others NULL, where the text is not a JSON object."""
    permissive = T.StructType([*schema.fields, T.StructField("_malformed", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_malformed"}
    parsed = computed_once(df, into, F.from_json(F.col(column), permissive, options))
    failed = F.col(f"{into}._malformed").isNotNull() | F.col(column).isNull()
    fields = [F.when(~failed, F.col(f"{into}.{f.name}")).alias(f.name) for f in schema.fields]
    return parsed.withColumn(into, F.struct(*fields, F.when(failed, F.lit(PARSE_ERROR)).alias("error")))


def keep_type(df: DataFrame, record: str = "record", wanted: str = AD_TYPE) -> DataFrame:
    """Records of one type; malformed text has no type and goes."""
    return df.where(F.col(f"{record}.type") == wanted)


def _text(field: Column) -> Column:
    return F.coalesce(field, F.lit(MISSING))


def flatten_payload(df: DataFrame, record: str = "record", keep: tuple[str, ...] = ()) -> DataFrame:
    """The payload as 11 text columns, ``time`` cut to its ten-minute bucket. Columns in ``keep`` stay in front."""
    payload = f"{record}.payload"
    rest = [_text(F.col(f"{payload}.{f}")).alias(f) for f in PAYLOAD_FIELDS[1:]]
    return df.select(*keep, ten_minute_bucket(F.col(f"{payload}.time")).alias("time"), *rest)


def read_ad_log(df: DataFrame, column: str = "line", keep: tuple[str, ...] = ()) -> DataFrame:
    """Parse, keep advertising records, flatten. Works on batch and stream alike."""
    return flatten_payload(keep_type(parse_json_safe(df, column)), keep=keep)
