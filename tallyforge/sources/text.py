"""Text files in the layouts the operators read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.functions.scalars import is_header
from tallyforge.plans.layout import computed_once

# Layout of a record-linkage file.
LINKAGE_SCORES = 9
MISSING_SCORE = "?"


def scan_text(spark: SparkSession, path: str, min_partitions: int | None = None) -> DataFrame:
    """Lines of text as column ``value``; a minimum number of partitions costs a shuffle, so give it only if needed."""
    lines = spark.read.text(path)
    return lines.repartition(min_partitions) if min_partitions else lines


def linkage_schema() -> T.StructType:
    fields = [T.StructField("id_1", T.IntegerType()), T.StructField("id_2", T.IntegerType())]
    fields += [T.StructField(f"s{i}", T.DoubleType()) for i in range(LINKAGE_SCORES)]
    return T.StructType([*fields, T.StructField("is_match", T.BooleanType())])


def scan_linkage_csv(spark: SparkSession, path: str) -> DataFrame:
    """Pairs with nine scores and a match flag. Header lines go wherever they stand in a file, ``?`` is NULL."""
    lines = spark.read.text(path).where(~is_header("value") & (F.trim("value") != ""))
    fields = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in linkage_schema().fields)
    row = F.from_csv("value", fields, {"nullValue": MISSING_SCORE})
    return computed_once(lines, "_row", row).select("_row.*")


def with_scores(linkage: DataFrame) -> DataFrame:
    """The nine score columns as one array."""
    scores = F.array(*[F.col(f"s{i}") for i in range(LINKAGE_SCORES)])
    return linkage.select("id_1", "id_2", scores.alias("scores"), F.col("is_match").alias("matched"))


def scan_numeric_csv(spark: SparkSession, path: str, width: int | None = None) -> DataFrame:
    """Headerless numbers as ``values ARRAY<DOUBLE>``, the label last. With a ``width``, short or long lines go."""
    parsed = computed_once(spark.read.text(path), "values", F.split("value", ",").cast("array<double>")).select("values")
    return parsed if width is None else parsed.where(F.size("values") == width)


def scan_ratings(spark: SparkSession, path: str) -> DataFrame:
    """``user item count``, separated by single spaces."""
    return spark.read.schema("user_id INT, item_id INT, cnt INT").csv(path, sep=" ")


# Java's trim: everything up to the space character counts as blank.
_BLANK_ENDS = r"^[\x00-\x20]+|[\x00-\x20]+$"


def parse_id_name(lines: DataFrame, column: str = "value") -> DataFrame:
    """``id<TAB>name``; lines without a tab or with a head that is no INT go."""
    head = F.regexp_extract(F.col(column), r"^([^\t]*)\t", 1)
    name = F.regexp_replace(F.regexp_extract(F.col(column), r"(?s)^[^\t]*\t(.*)\z", 1), _BLANK_ENDS, "")
    number = F.when(head.rlike(r"^[+-]?[0-9]+$"), head.try_cast("int"))
    return lines.select(number.alias("id"), name.alias("name")).where(F.col("id").isNotNull())


def scan_id_name(spark: SparkSession, path: str) -> DataFrame:
    return parse_id_name(spark.read.text(path))


def parse_alias(lines: DataFrame, column: str = "value") -> DataFrame:
    """``bad<TAB>good``; lines with an empty first field go. One row per bad id: the largest good id stays."""
    parts = F.split(F.col(column), "\t")
    pairs = lines.where(parts.getItem(0) != "").select(
        parts.getItem(0).try_cast("int").alias("bad"), F.get(parts, F.lit(1)).try_cast("int").alias("good")
    )
    return pairs.where("bad IS NOT NULL AND good IS NOT NULL").groupBy("bad").agg(F.max("good").alias("good"))


def scan_alias(spark: SparkSession, path: str) -> DataFrame:
    return parse_alias(spark.read.text(path))


def scan_stopwords(spark: SparkSession, path: str) -> DataFrame:
    """Words separated by any white space, each once."""
    tokens = spark.read.text(path).select(F.explode(F.split("value", r"\s+")).alias("word"))
    return tokens.where(F.col("word") != "").distinct()
