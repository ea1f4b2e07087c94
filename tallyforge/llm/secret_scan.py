"""Secret scans with one deterministic automaton for all rules, in one pass over the bytes of a text.

The automaton tells at which byte some rule has first been fulfilled. Only there, which is rare, a second automaton for that
rule alone walks back to the leftmost start, and a third forward to the longest end. Per rule the matches are the leftmost
ones that don't overlap, each as long as possible; for these rules that is what a backtracking search finds too.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm.automata import compile_rules
from tallyforge.llm.common import map_batches, sql_type, texts


@dataclass(frozen=True)
class Rule:
    """A kind of secret; ``mirror`` matches the reversed secret.

    A match counts if its group, or all of it where the pattern has no group, is ``at_least`` bytes long.
    """

    kind: str
    pattern: bytes
    mirror: bytes
    at_least: int


#: Bytes of the values of assignments.
_VALUE = rb"[A-Za-z0-9+/_.=-]"
#: The base rules, then those added, in the order in which ties are listed.
BASE = ("assign", "access", "hex")
RULES = (
    Rule(
        "assign",
        rb"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?(" + _VALUE + b"+)",
        _VALUE + rb"+[\"']?\x20*[:=]\x20*[\"']?(?i:drowssap|dwssap|terces|nekot|yek_?ipa)",
        6,
    ),
    Rule("access", rb"AKIA[A-Z0-9]+", rb"[A-Z0-9]+AIKA", 20),
    Rule("hex", rb"[0-9a-f]{24}[0-9a-f]*", rb"[0-9a-f]{24}[0-9a-f]*", 24),
    Rule("github", rb"gh[opsur]_[A-Za-z0-9]+", rb"[A-Za-z0-9]+_[opsur]hg", 40),
    Rule("slack", rb"xox[abprs]-[A-Za-z0-9-]+", rb"[A-Za-z0-9-]+-[abprs]xox", 20),
    Rule("google", rb"AIza[A-Za-z0-9_-]+", rb"[A-Za-z0-9_-]+azIA", 39),
    Rule("pem", rb"-----BEGIN [A-Z ]*PRIVATE KEY-----", rb"-----YEK ETAVIRP[A-Z ]* NIGEB-----", 27),
)


class Scanner:
    """The compiled rules."""

    def __init__(self, rules: Sequence[Rule] = RULES):
        self.rules = tuple(rules)
        self.checks = [re.compile(rule.pattern) for rule in rules]
        self.combined = compile_rules([rule.pattern for rule in rules])
        self.forward = [compile_rules([rule.pattern], anywhere=False) for rule in rules]
        self.backward = [compile_rules([rule.mirror], anywhere=False) for rule in rules]

    def _span(self, rule: int, text: bytes, end: int, after: int) -> tuple[int, int] | None:
        """The match of a rule that is fulfilled at ``end``, if it starts at ``after`` or later."""
        table, state, start = self.backward[rule], 0, None
        for at in range(end - 1, after - 1, -1):
            state = table.rows[state][text[at]]
            if state >= table.first_accept:
                start = at
            elif state == table.sink:
                break
        if start is None:
            return None
        table, state = self.forward[rule], 0
        for at in range(start, len(text)):
            state = table.rows[state][text[at]]
            if state >= table.first_accept:
                end = max(end, at + 1)
            elif state == table.sink:
                break
        return start, end

    def spans(self, text: bytes) -> list[tuple[int, int, int]]:
        """(start, end, rule) in bytes, by start and then rule."""
        rows, first_accept, accepts = self.combined.rows, self.combined.first_accept, self.combined.accepts
        ends = [0] * len(self.rules)
        found: list[tuple[int, int, int]] = []
        row, at = rows[0], 0
        for byte in text:
            state = row[byte]
            row = rows[state]
            at += 1
            if state >= first_accept:
                bits = accepts[state]
                for n, done in enumerate(ends):
                    if bits >> n & 1 and at > done:
                        span = self._span(n, text, at, done)
                        if span:
                            ends[n] = span[1]
                            found.append((*span, n))
        kept = []
        for start, end, n in sorted(found, key=lambda span: (span[0], span[2])):
            match = self.checks[n].fullmatch(text, start, end)
            if len(match[match.re.groups]) >= self.rules[n].at_least:
                kept.append((start, end, n))
        return kept

    def points(self, text: bytes) -> list[tuple[str, int, int]]:
        """(kind, start, end) in code points."""
        out, at, points = [], 0, 0
        spans = self.spans(text)
        places: dict[int, int] = {}
        for place in sorted({p for start, end, _ in spans for p in (start, end)}):
            points += len(text[at:place].decode("utf-8", "replace"))
            at = place
            places[place] = points
        for start, end, n in spans:
            out.append((self.rules[n].kind, places[start], places[end]))
        return out


@lru_cache(maxsize=8)
def scanner(rules: tuple[Rule, ...] = RULES) -> Scanner:
    return Scanner(rules)


def _share(spark: SparkSession, rules: Sequence[Rule]) -> Broadcast:
    """Compile on the driver and send the tables, whose size is that of the rules, to the executors."""
    return spark.sparkContext.broadcast(scanner(tuple(rules)))


def find_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Sequence[Rule] = RULES
) -> DataFrame:
    """(id, spans array<struct<kind, start, end>>) of every row, in code points with the end exclusive, by start.

    Whole texts are scanned whatever their length. NULL and empty texts have no spans; repeated rows are repeated; an empty
    table gives an empty result; other columns of ``docs`` are not looked at.
    """
    shared = _share(docs.sparkSession, rules)
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        find = shared.value.points
        names = ("kind", "start", "end")
        spans = [[dict(zip(names, span, strict=True)) for span in find(text)] for text in texts(batch.column(1))]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(kind))], [id_col, "spans"])

    schema = f"`{id_col}` {sql_type(docs, id_col)}, spans array<struct<kind: string, start: bigint, end: bigint>>"
    return map_batches(docs.select(id_col, text_col), run, schema)


def secret_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_assign, n_access, n_hex, base_sha256, spans) of every row; spans are written as ``kind:start:end``."""
    found = find_secrets(docs, id_col, text_col)
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))

    def written(spans):
        parts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
        return F.array_join(parts, ",")

    def number(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        id_col, *map(number, BASE), F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans")
    )


def _masked(text: bytes, spans: list[tuple[int, int, int]], rules: Sequence[Rule]) -> bytes:
    out, at = [], 0
    for start, end, n in spans:
        if end <= at:
            continue
        out += [text[at : max(at, start)], b"[" + rules[n].kind.upper().encode() + b"]"]
        at = end
    return b"".join([*out, text[at:]])


def mask_secrets(docs: DataFrame, text_col: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """``docs`` with each secret replaced by its kind in brackets; of secrets that overlap the first names the whole.

    All columns and rows stay. A NULL text stays NULL, and a text without secrets is unchanged.
    """
    shared = _share(docs.sparkSession, rules)
    place = docs.columns.index(text_col)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        find = shared.value.spans
        values = batch.column(place).cast(pa.binary()).to_pylist()
        masked = []
        for value in values:
            spans = find(value) if value else []
            masked.append(_masked(value, spans, rules) if spans else value)
        columns = list(batch.columns)
        columns[place] = pa.array(masked, pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays(columns, names=[str(n) for n in range(len(columns))])

    # Columns go by place, since names may differ only in case.
    plain = docs.toDF(*[str(n) for n in range(len(docs.columns))])
    return map_batches(plain, run, plain.schema).toDF(*docs.columns)
