"""Scalar expressions on single columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_on_spaces(line: Column | str) -> Column:
    """Words between single spaces. Inner empty words stay, trailing ones go, an empty line is one empty word."""
    line = _col(line)
    trimmed = F.rtrim(line)
    blank = (F.length(line) > 0) & (F.length(trimmed) == 0)
    return F.when(blank, F.array().cast("array<string>")).otherwise(F.split(trimmed, " ", -1))


def is_header(line: Column | str, mark: str = "id_1") -> Column:
    return _col(line).contains(mark)


def hash_id(text: Column | str) -> Column:
    """The first 8 bytes of the MD5 digest, least significant byte first, as a signed BIGINT."""
    # One pattern turns the byte order round, so that the digest is an operand once and is computed once.
    half = F.substring(F.md5(_col(text).cast("binary")), 1, 16)
    turned = F.regexp_replace(half, "(..)(..)(..)(..)(..)(..)(..)(..)", "$8$7$6$5$4$3$2$1")
    return F.conv(turned, 16, -10).cast("bigint")


def nan_to_zero(x: Column | str) -> Column:
    """Missing (NULL or NaN) becomes 0."""
    return F.coalesce(F.nanvl(_col(x), F.lit(0.0)), F.lit(0.0))


def linkage_score(scores: Column | str, positions: Sequence[int] = (2, 5, 6, 7, 8)) -> Column:
    """Sum of the scores at the given 0-based positions, missing ones counting 0."""
    parts = [nan_to_zero(_col(scores).getItem(i)) for i in positions]
    return sum(parts[1:], parts[0])


def composite_key(columns: Sequence[str], separator: str = ":") -> Column:
    return F.concat_ws(separator, *[F.col(c) for c in columns])


def list_has(text: Column | str, item: Column | str) -> Column:
    """Whether a comma-separated list holds the item."""
    return F.array_contains(F.split(_col(text), ","), _col(item))


def chi_square(both: Column | str, a: Column | str, b: Column | str, total: Column | str) -> Column:
    """Chi-square statistic with Yates correction for a pair seen ``both`` times in ``total`` documents.

    ``a`` and ``b`` count the documents of each side. NULL where a side is in all documents or none.
    """
    n11, na, nb, n = (_col(c).cast("double") for c in (both, a, b, total))
    n01, n10 = nb - n11, na - n11
    n00 = n - n01 - n10 - n11
    deviation = F.abs(n11 * n00 - n10 * n01) - n / 2.0
    return F.try_divide(n * deviation * deviation, na * (n - na) * nb * (n - nb))


def idf(documents: Column | str, document_frequency: Column | str) -> Column:
    return F.log(_col(documents).cast("double") / _col(document_frequency))


def entropy_term(count: Column | str, total: Column | str) -> Column:
    """-p ln p for p = count / total; 0 for an empty cell."""
    share = _col(count).cast("double") / _col(total)
    return F.when(_col(count) > 0, -share * F.log(share)).otherwise(F.lit(0.0))


def portable_bucket(key: Column | str, buckets: int, seed: int = 0) -> Column:
    """A bucket number from integer arithmetic that any SQL engine can repeat."""
    mixed = (_col(key).cast("bigint") + F.lit(seed)) % 1000003 * 7919 + F.lit(104729)
    return F.pmod(F.pmod(mixed, F.lit(1000003)), F.lit(buckets)).cast("bigint")
