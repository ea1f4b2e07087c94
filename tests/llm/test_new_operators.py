"""Operators 11 to 13 against brute force over small tables: NULLs, empty, short and long texts, ties, repeats, clashing names."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallyforge.llm import bwt_dedup, collocations, ranked_search
from tallyforge.llm.rolling import Counts, Sums

WORDS = [f"w{n}" for n in range(30)]
SCHEMA = "doc_id bigint, text string, lang string, id bigint, doc string, n bigint, words string, _lang string"


def _texts():
    rng = random.Random(11)
    shared = " ".join(rng.choices(WORDS, k=60))
    long = " ".join(rng.choices(WORDS, k=4_000))
    out = [None, "", " ", "short", "A" * 400, "ab" * 150, "é" * 99, "é" * 120, long, long, long[:3_000] + "!" + long[3_000:], long.upper()]
    out += [f"{rng.random()} {shared} {rng.random()}" for _ in range(12)] + [shared, shared + shared, f"x{shared}", shared[:99], shared[:100]]
    out += [" ".join(rng.choices(WORDS, k=rng.randint(1, 80))) + rng.choice([".", ";\n", " ", "\t"]) for _ in range(40)]
    return out + ["big cat. Big CAT, big\tcat  sat; big cat\nbig cat sat" * 3, "\x1cone\x1ctwo \x0bthree\x0c", "1 ,, 2"]


@pytest.fixture(scope="module")
def samples():
    return _texts()


def _table(spark, texts, extra=()):
    rows = [(n, t, ["en", None, "de"][n % 3]) for n, t in enumerate(texts)] + list(extra)
    rng = random.Random(1)
    rng.shuffle(rows)
    return spark.createDataFrame([(*row, 7, "d", 0, "x", "und") for row in rows], SCHEMA)


def _first_windows(rows):
    """Per (row number), the bytes removed; ``rows`` in order."""
    seen, out = set(), []
    for text in rows:
        gone = np.zeros(len(text), dtype=bool)
        for k in range(len(text) - 99):
            window = text[k : k + 100]
            if window in seen:
                gone[k : k + 100] = True
            seen.add(window)
        out.append(gone)
    return out


def _of(text, gone):
    kept = bytes(b for b, g in zip(text, gone.tolist(), strict=True) if not g)
    runs = sum(1 for k, g in enumerate(gone.tolist()) if g and (k == 0 or not gone[k - 1]))
    return len(text), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest(), kept


@pytest.mark.parametrize(("most", "shard"), [(4_096, 125_000), (3, 300)])
def test_suffix_array_dedup(spark, samples, monkeypatch, most, shard):
    """With few passages per bucket, anchors are cut further, down to whole windows; small shards are merged in many ways."""
    monkeypatch.setattr(bwt_dedup, "MOST_PASSAGES", most)
    monkeypatch.setattr(bwt_dedup, "SHARD", shard)
    monkeypatch.setattr(bwt_dedup, "_BYTES", 2_500)
    docs = _table(spark, samples)
    found = {r["doc_id"]: tuple(r)[1:] for r in bwt_dedup.remove_repeated_bytes(docs).collect()}
    rows = [(t or "").encode() for t in samples]
    for n, gone in enumerate(_first_windows(rows)):
        assert tuple(bytes(v) if isinstance(v, bytearray) else v for v in found[n]) == _of(rows[n], gone), n


def test_suffix_array_dedup_of_repeated_rows_and_null_ids(spark, samples):
    long = samples[8]
    extra = [(8, long, "en"), (8, long, "en"), (None, samples[24], None), (3, "short", "en")]
    found = bwt_dedup.remove_repeated_bytes(_table(spark, samples, extra)).collect()
    assert len(found) == len(samples) + len(extra)
    eights = sorted(r["n_removed"] for r in found if r["doc_id"] == 8)
    assert eights == [0, len(long), len(long)] and sorted(r["n_spans"] for r in found if r["doc_id"] == 8) == [0, 1, 1]
    # A NULL id is the smallest: its text stays, the other goes.
    assert [r["n_removed"] for r in found if r["doc_id"] is None] == [0]
    assert [r["n_removed"] for r in found if r["doc_id"] == 24] == [len(samples[24])]
    assert [r["n_removed"] for r in found if r["doc_id"] == 3] == [0, 0]
    assert bwt_dedup.remove_repeated_bytes(_table(spark, samples).limit(0)).count() == 0


def test_merged_transforms_stand_in_order():
    rng = random.Random(3)
    passages = [bytes(rng.choices(b"ab", k=rng.randint(100, 140))) for _ in range(30)]
    passages += [p[:60] + p[:70] for p in passages[:10]]
    masks = bwt_dedup.repeated_windows(passages)
    seen = set()
    for passage, mask in zip(passages, masks.tolist(), strict=True):
        windows = [passage[k : k + 100] for k in range(len(passage) - 99)]
        assert [bool(mask >> k & 1) for k in range(len(windows))] == [w in seen for w in windows]
        seen.update(windows)


def test_sums_and_counts():
    values = np.random.default_rng(1).integers(0, 1 << 63, 300, dtype=np.uint64)
    sums = Sums(values, "bytes")
    starts = np.arange(291)
    assert (sums.runs(10) == sums.of(starts, starts + 10)).all()
    doubled = Sums(np.concatenate((values, values)), "bytes")
    assert (doubled.of(starts + 300, starts + 310) == sums.runs(10)).all()
    counts = Counts()
    counts.add(np.array([3, 1, 3], dtype=np.uint64)), counts.add(np.array([1], dtype=np.uint64))
    assert [c.tolist() for c in counts.take()] == [[1, 3], [2, 2]] and [len(c) for c in counts.take()] == [0, 0]


def _fold(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def _collocations(rows, least, most):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", _fold(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 6):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = {}
    for lang, counts in f.items():
        cands = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        longest = Counter()
        for q, b in cands.items():
            for part in {q[i:j] for i in range(len(q)) for j in range(i + 2, len(q) + 1)} - {q}:
                longest[part] = max(longest[part], b)
        ranked = []
        for p, a in cands.items():
            if 100 * longest[p] >= 100 * a:
                continue
            score, k = min(((1000 * a * n[lang]) // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            ranked.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]], n[lang]))
        out |= {(lang, place): (p.decode(), -a, left, right, total, -score)
                for place, (score, a, p, left, right, total) in enumerate(sorted(ranked)[:most], 1)}
    return out


@pytest.mark.parametrize(("least", "most"), [(3, 2000), (1, 50)])
def test_collocations(spark, samples, least, most):
    rng = random.Random(6)
    text = " ".join(f"u{n}" for n in range(120))  # a long unary path
    texts = [*samples, *[text] * 8, "circle " * 40, "a b " * 30, *[" ".join(rng.choices(["p", "q", "r"], k=40)) for _ in range(10)]]
    extra = [(5, "big cat sat", "en"), (5, "big cat sat", "en"), (None, "big cat sat", None), (1, "big cat", "und"), (2, None, "fr")]
    found = collocations.collocations(_table(spark, texts, extra), least=least, most=most).collect()
    rows = [(["en", None, "de"][n % 3], t) for n, t in enumerate(texts)] + [(lang, t) for _, t, lang in extra]
    wanted = _collocations(rows, least, most)
    assert {(r["lang"], r["rank"]): tuple(r)[2:] for r in found} == wanted and len(found) == len(wanted)
    assert collocations.collocations(_table(spark, texts).limit(0)).count() == 0


def test_paths_are_compacted(spark):
    words = [f"n{k}" for k in range(200)]
    edges = [("en", words[k : k + 5], 7) for k in range(196)] + [("de", ["a"] * 5, 3), ("fr", words[:5], 2)]
    paths = collocations.compact_paths(spark.createDataFrame(edges, "lang string, words array<string>, n bigint")).collect()
    assert len(paths) < 40
    assert sorted((p["lang"], p["words"][k : k + 5], p["n"]) for p in paths for k in range(len(p["words"]) - 4)) == sorted(edges)


def test_scores_past_64_bits(spark):
    """1000 * a * n passes 2^63 where neither factor does; the quotient must be exact."""
    a, n, left, right = 90_071_992_547_409, 900_719_925_474_099, 4_000_000_007, 90_071_992_547_411
    row = spark.createDataFrame([(a, n, left, right)], "a bigint, n bigint, l bigint, r bigint")
    assert row.select(collocations.score_of("a", "l", "r", "n")).first()[0] == 1000 * a * n // (left * right)


def test_counts_follow_from_the_graph(spark):
    graph = [("en", ["x", "y"], 3, False), ("en", ["y"], 2, False), ("en", ["a", "b", "c", "d", "e", "f"], 4, True)]
    table = spark.createDataFrame(graph, "lang string, words array<string>, n bigint, path boolean")
    counts = {r["gram"]: r["f"] for r in collocations.phrase_counts(table).collect()}
    assert counts == {"x y": 3, "x": 3, "y": 2} | {t[: 2 * k - 1]: 4 for t in ("a b c d e", "b c d e f") for k in range(1, 6)}


def _search(docs, items, k):
    terms = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", _fold(t))
    bags = [(n, terms(t)) for n, t in docs]
    whole, length = sum(bool(b) for _, b in bags), sum(len(b) for _, b in bags)
    df = Counter(t for _, b in bags for t in set(b))
    out = {}
    for item, text in items:
        scored = []
        for n, bag in bags:
            tf, m = Counter(bag), 75 + (25 * len(bag) * whole) // max(1, length)
            score = sum(math.floor(1000 * math.log((2 * whole + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 12 * m)) for t in terms(text) if tf[t])
            if score > 0:
                scored.append((-score, n))
        out |= {(item, rank): (n, -score) for rank, (score, n) in enumerate(sorted(scored)[:k], 1)}
    return out


@pytest.mark.parametrize("most", [100_000, 5])
def test_ranked_search(spark, samples, monkeypatch, most):
    """Few terms per block: the items go through several scans."""
    monkeypatch.setattr(ranked_search, "MOST_TERMS", most)
    items = [(1, "big cat w1 w1"), (2, None), (3, ""), (4, "W2 w3,w4"), (5, "nowhere"), (6, samples[24]), (7, "éé ab big"), (None, "one two"), (4, "W2 w3,w4")]
    table = spark.createDataFrame([(*i, 0, "x") for i in items], "item_id bigint, text string, doc_id bigint, score string")
    found = ranked_search.ranked_search(_table(spark, samples), table).collect()
    wanted = _search(list(enumerate(samples)), items[:-1], 20)
    assert {(r["item_id"], r["rank"]): (r["doc_id"], r["score"]) for r in found} == wanted and len(found) == len(wanted)
    assert dict(ranked_search.ranked_search(_table(spark, samples), table).dtypes)["rank"] == "int"
    docs = _table(spark, samples)
    assert ranked_search.ranked_search(docs.limit(0), table).count() == 0 == ranked_search.ranked_search(docs, table.limit(0)).count()


def test_ranked_search_of_repeated_rows_and_null_ids(spark, samples):
    extra = [(100, "big cat", "en"), (100, "big cat", "en"), (None, "big cat", None)]
    table = spark.createDataFrame([(1, "big cat")], "item_id int, text string")
    found = ranked_search.ranked_search(_table(spark, samples, extra), table).orderBy("rank").collect()
    ids = [r["doc_id"] for r in found]
    at = ids.index(100)
    assert ids[at : at + 3] == [100, 100, None] and len({r["score"] for r in found[at : at + 3]}) == 1
