"""The rows of the pipeline's mixing stage: documents without an id, and with one id over different texts, count each."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyforge.llm import mixing


def level_targets(sizes):
    """Targets by source: 1.5 times all words by weight, no source above twice its size."""
    total = Counter()
    for name, size in sizes:
        total[name] += size
    order = sorted(total, key=lambda name: (name is None, name or ""))
    weight = {name: (5, 2, 1)[n % 3] for n, name in enumerate(order)}
    fixed, everything = {}, 1.5 * sum(total.values())
    while True:
        level = (everything - sum(fixed.values())) / max(1, sum(w for name, w in weight.items() if name not in fixed))
        over = [name for name in order if name not in fixed and level * weight[name] > 2 * total[name]]
        if not over:
            return {name: fixed.get(name, level * weight[name]) for name in order}
        fixed |= {name: 2 * total[name] for name in over}


def test_every_row_has_its_own_copies(spark):
    words = lambda n, size: " ".join(f"t{n}w{k}" for k in range(size))
    rows = [(None if n % 3 == 0 else n // 6, words(n, 5 + n % 7), f"s{n % 3}" if n % 4 else None, n) for n in range(240)]
    rows += [(7, None, "s0", 240), (None, " ", "s1", 241)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, _number int")
    found = Counter(r["_number"] for r in mixing.mixed_documents(docs).collect())
    sizes = {n: len((text or "").split()) for _, text, _, n in rows}
    sources = {n: source for _, _, source, n in rows}
    goal = level_targets([(sources[n], sizes[n]) for n in sizes])
    assert all(found[n] <= 2 for n in sizes) and not found[240] and not found[241]
    for name, target in goal.items():
        taken = sum(found[n] * sizes[n] for n in sizes if sources[n] == name)
        assert abs(taken - target) <= 11, name  # less than one document, of 11 words at most
    full = {name for name, target in goal.items() if target == pytest.approx(2 * sum(sizes[n] for n in sizes if sources[n] == name))}
    assert all(found[n] == 2 for n in sizes if sources[n] in full and sizes[n])
    assert any(found[n] for n in sizes if rows[n][0] is None)


def test_copies_are_marked_by_a_few_ranges(spark, monkeypatch):
    """What meets the texts is a row per source and number of copies, not one per document."""
    written = {}

    def kept(df, tag, materialize=mixing.materialize):
        written[tag] = materialize(df, tag)
        return written[tag]

    monkeypatch.setattr(mixing, "materialize", kept)
    docs = spark.createDataFrame(
        [(None if n % 7 == 0 else n // 2, (None, "a", "b")[n % 3], " ".join(["w"] * (n % 11))) for n in range(300)],
        "doc_id long, source string, text string",
    )
    mixed = mixing.mixed_documents(docs)
    found = {tuple(r)[:3]: r["count"] for r in mixed.groupBy(*docs.columns).count().collect()}
    assert written["mix-copies"].count() <= 3 * 3
    rows = written["mix-docs"].toDF(*docs.columns, "number", "at", "words")
    taken = mixing.mix(rows, "doc_id", "source", "text", tag=["number"], spread="text").where("size > 0")
    each = taken.select("number", F.round(F.col("taken") / F.col("size")).alias("copies")).join(rows, "number")
    wanted = {tuple(r)[:3]: r["n"] for r in each.groupBy(*docs.columns).agg(F.sum("copies").cast("long").alias("n")).collect() if r["n"]}
    assert found == wanted
