"""Language identification by Bayesian fusion of four kinds of evidence.

- *Text*: likelihoods of byte trigrams, counted over all rows with a declared language.
- *Declared language*: how often each declaration is made for texts of each language, counted over all rows.
- *Address suffix*: the same for the last label of the host.
- *Host*: the shares of languages among the rows of a host, smoothed toward those of its domain, these toward those of the
  suffix, and these toward those of all rows. They are grouped counts; hosts of any size are added up before the shuffle.

The logarithms are added and turned into probabilities. Missing evidence adds nothing.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import small_batches, texts, without
from tallyforge.plans.durable import materialize

LANGUAGES = ("en", "es", "fr", "de")
#: Rows below this probability are undetermined.
LEAST_PROBABILITY = 0.5
#: Trigrams overlap and depend on each other, so that their logarithms count for less.
_TEXT_WEIGHT = 0.3
#: Letters from which the text alone names a language in the grouped counts.
_LETTERS = 20
#: Rows that a level of the host hierarchy counts for in the level below; smoothing of declarations and suffixes.
_PRIOR_ROWS, _SMOOTH = 20.0, 1.0
#: Trigrams fall into so many codes.
_CODES = 1 << 16
#: Bytes of text that are taken together.
_BYTES = 4_000_000

#: Capitals become small letters; the other ASCII bytes, letters aside, become spaces. Bytes of other letters stay.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
#: Markup that is not text; fixed value.
_NOT_TEXT = r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>"


def _codes(folded: bytes) -> np.ndarray:
    """The code of the trigram at every byte but the last two; the code 0 is kept for trigrams of spaces."""
    data = np.frombuffer(folded, dtype=np.uint8).astype(np.uint32)
    mixed = data[:-2] * np.uint32(0x9E3779B1) + data[1:-1] * np.uint32(0x85EBCA77) + data[2:] * np.uint32(0xC2B2AE3D)
    codes = (mixed >> np.uint32(16)) % np.uint32(_CODES - 1) + np.uint32(1)
    codes[(data[:-2] == 32) & (data[1:-1] == 32) & (data[2:] == 32)] = 0
    return codes


def _slices(rows: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``_BYTES`` bytes."""
    start, size = 0, 0
    for n, row in enumerate(rows):
        size += len(row)
        if size >= _BYTES:
            yield start, n + 1
            start, size = n + 1, 0
    if start < len(rows):
        yield start, len(rows)


def trigram_model(labelled: DataFrame, languages: Sequence[str] = LANGUAGES) -> np.ndarray:
    """Log-likelihoods of trigram codes, one row per language, from all rows of (text, declared).

    What comes to the driver is one number per language and code at most, however many rows there are.
    """
    small_batches(labelled.sparkSession)
    known = {language: n for n, language in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(known), _CODES), dtype=np.int64)
        for batch in batches:
            rows, names = texts(batch.column(0)), batch.column(1).to_pylist()
            for name, n in known.items():
                own = [row.translate(_FOLD) for row, of in zip(rows, names, strict=True) if of == name]
                for start, end in _slices(own):
                    counts[n] += np.bincount(_codes(b"   ".join([b" ", *own[start:end], b" "])), minlength=_CODES)
        n, code = counts.nonzero()
        columns = [pa.array(n.astype(np.int32)), pa.array(code.astype(np.int32)), pa.array(counts[n, code])]
        yield pa.RecordBatch.from_arrays(columns, ["lang", "code", "n"])

    found = labelled.select("text", "declared").where(F.col("declared").isin(list(languages)))
    sums = found.mapInArrow(count, "lang int, code int, n bigint").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    table = sums.toPandas()
    counts = np.zeros((len(known), _CODES))
    counts[table["lang"].to_numpy(dtype=int), table["code"].to_numpy(dtype=int)] = table["n"]
    counts[:, 0] = 0
    model = np.log((counts + 0.5) / (counts.sum(axis=1, keepdims=True) + 0.5 * _CODES))
    model[:, 0] = 0.0
    return model.astype(np.float32)


def _scored(rows: DataFrame, model: np.ndarray, keys: Sequence[str]) -> DataFrame:
    """Add the log-likelihoods of the text (``ll``) and its number of letters (``letters``) instead of the text."""
    small_batches(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(model)
    plain = rows.select(*[F.col(c) for c in keys], "text")
    width = len(keys)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            folded = [row.translate(_FOLD) for row in texts(batch.column(width))]
            ll = np.zeros((len(folded), len(model)))
            for start, end in _slices(folded):
                some = folded[start:end]
                codes = _codes(b"  ".join([b"", *some, b""]) + b"  ")
                starts = np.cumsum([0, *(len(row) + 2 for row in some[:-1])])
                for n, weights in enumerate(model):
                    ll[start:end, n] = np.add.reduceat(weights[codes], starts, dtype=np.float64)
            letters = [len(row) - row.count(b" ") for row in folded]
            columns = [*batch.columns[:width], pa.array(ll.tolist(), pa.list_(pa.float64())), pa.array(letters, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*keys, "ll", "letters"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields[:width])
    return plain.mapInArrow(score, f"{fields}, ll array<double>, letters bigint")


def _counts(languages: Sequence[str], prefix: str) -> list[Column]:
    return [F.sum(F.when(F.col("named") == n, F.col("rows"))).alias(f"{prefix}{n}") for n in range(len(languages))]


def _filled(prefix: str, n: int) -> Column:
    return F.coalesce(F.col(f"{prefix}{n}"), F.lit(0)).cast("double")


def _given_language(named: DataFrame, column: str, languages: Sequence[str]) -> DataFrame:
    """(column, <column>_evidence): the log-probability of a value in rows of each language."""
    size = range(len(languages))
    counts = named.where(F.col(column).isNotNull() & F.col("named").isNotNull()).groupBy(column).agg(*_counts(languages, "c"))
    totals = counts.agg(*[F.sum(f"c{n}").alias(f"t{n}") for n in size], F.count(F.lit(1)).alias("kinds"))
    joined = counts.crossJoin(F.broadcast(totals))  # one row of totals
    logs = [
        F.log((_filled("c", n) + _SMOOTH) / (_filled("t", n) + _SMOOTH * (F.col("kinds") + 1))) for n in size
    ]
    return joined.select(F.col(column).alias(f"_{column}"), F.array(*logs).alias(f"{column}_evidence"))


def host_priors(named: DataFrame, languages: Sequence[str]) -> DataFrame:
    """(_host, host_evidence): the smoothed log-shares of the languages of each host; of no host, those of all rows."""
    size = range(len(languages))
    labels = F.split("host", r"\.")
    hosts = named.where(F.col("named").isNotNull()).groupBy("host").agg(*_counts(languages, "h"))
    hosts = hosts.withColumn("suffix", F.element_at(labels, -1))
    hosts = hosts.withColumn("domain", F.array_join(F.slice(labels, F.greatest(F.lit(1), F.size(labels) - 1), 2), "."))
    hosts = materialize(hosts, "language-hosts")

    def level(prefix: str, *by: str) -> DataFrame:
        sums = hosts.groupBy(*by).agg(*[F.sum(f"h{n}").alias(f"{prefix}{n}") for n in size])
        return materialize(sums.toDF(*[f"_{c}" for c in by], *[f"{prefix}{n}" for n in size]), "language-level")

    joined = hosts.join(level("d", "domain"), F.col("domain") == F.col("_domain"), "left")
    joined = joined.join(level("s", "suffix"), F.col("suffix") == F.col("_suffix"), "left")
    joined = joined.crossJoin(F.broadcast(level("a")))  # one row
    share = [F.lit(1.0 / len(languages))] * len(languages)
    for prefix in "asdh":
        total = sum((_filled(prefix, n) for n in size), F.lit(0.0))
        share = [(_filled(prefix, n) + _PRIOR_ROWS * share[n]) / (total + _PRIOR_ROWS) for n in size]
        # Columns, so that the expressions of the levels don't nest.
        joined = joined.select("*", *[column.alias(f"p_{prefix}{n}") for n, column in enumerate(share)])
        share = [F.col(f"p_{prefix}{n}") for n in size]
    return joined.select(F.col("host").alias("_host"), F.array(*[F.log(s) for s in share]).alias("host_evidence"))


def identify(
    rows: DataFrame, labelled: DataFrame, keys: Sequence[str], languages: Sequence[str] = LANGUAGES,
    least_probability: float = LEAST_PROBABILITY,
) -> DataFrame:
    """(keys, declared, language, probability, accepted) of every row.

    ``rows`` has the columns text, declared, host and suffix beside ``keys``; ``labelled`` has text and declared. NULL in any
    of them is missing evidence, and so is a declaration or host without counted rows. A row is accepted if its text has a
    letter and its best language reaches ``least_probability``; else ``language`` is NULL. Texts may be empty or of any
    length; repeated rows are repeated and count each; empty tables give an empty result.
    """
    size = range(len(languages))
    names = [f"_k{n}" for n in range(len(keys))]
    plain = rows.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], "declared", "host", "suffix", "text")
    scored = _scored(plain, trigram_model(labelled, languages), [*names, "declared", "host", "suffix"])
    best = F.array_position("ll", F.array_max("ll")).cast("int") - 1
    scored = materialize(scored.withColumn("named", F.when(F.col("letters") >= _LETTERS, best)), "language-scores")

    named = scored.groupBy("declared", "host", "suffix", "named").agg(F.count(F.lit(1)).alias("rows"))
    named = materialize(named, "language-counts")
    fused = scored
    for column in ("declared", "suffix"):
        evidence = materialize(_given_language(named, column, languages), "language-evidence")
        fused = fused.join(evidence, F.col(column) == F.col(f"_{column}"), "left")
    priors = materialize(host_priors(named, languages), "language-priors")
    fused = fused.join(priors, F.col("host") == F.col("_host"), "left")

    def log(n: int) -> Column:
        total = _TEXT_WEIGHT * F.col("ll")[n]
        for column in ("declared_evidence", "suffix_evidence", "host_evidence"):
            total = total + F.coalesce(F.col(column)[n], F.lit(0.0))
        return total

    fused = fused.select(*names, "declared", "letters", F.array(*[log(n) for n in size]).alias("logs"))
    top = F.array_max("logs")
    chances = F.aggregate("logs", F.lit(0.0), lambda total, value: total + F.exp(value - top))
    fused = fused.withColumn("probability", 1.0 / chances).withColumn("best", F.array_position("logs", top).cast("int"))
    accepted = (F.col("letters") > 0) & (F.col("probability") >= least_probability)
    language = F.when(accepted, F.element_at(F.array(*map(F.lit, languages)), F.col("best")))
    return fused.select(
        *[F.col(n).alias(k) for k, n in zip(keys, names, strict=True)], "declared", language.alias("language"), "probability",
        accepted.alias("accepted"),
    )


def page_evidence(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> list[Column]:
    """text, declared, host and suffix of web pages, as columns."""
    host = F.regexp_extract(F.lower(F.col(url_col)), r"(?s)^.*?://([^/?#:]*)", 1)
    host = F.when(host != "", host)
    declared = F.lower(F.regexp_extract(F.col(html_col), r"(?is)<html\b[^>]*?\slang\s*=\s*[\"']?([a-z]+)", 1))
    return [
        F.regexp_replace(F.col(html_col), _NOT_TEXT, " ").alias("text"), F.when(declared != "", declared).alias("declared"),
        host.alias("host"), F.substring_index(host, ".", -1).alias("suffix"),
    ]


def document_evidence(lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> list[Column]:
    """text, declared, host and suffix of documents: the source stands for the host, and there is no address."""
    none = F.lit(None).cast("string")
    return [F.col(text_col).alias("text"), F.col(lang_col).alias("declared"), F.col(source_col).alias("host"), none.alias("suffix")]


def accepted_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose language can't be determined. Rows with a NULL id can't be told apart and stay.

    Of rows with the same id each goes by its own text; equal rows with different declarations or sources go if one is rejected.
    An empty table gives an empty result; all columns stay.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("th"), *document_evidence(text_col=text_col))
    found = identify(rows, rows.select("text", "declared"), ["id", "th"])
    rejected = found.where(~F.col("accepted") & F.col("id").isNotNull()).select("id", "th").distinct()
    return without(docs, rejected, id_col, text_col)
