"""Markup of articles: nested, unclosed and very deep brackets."""

from __future__ import annotations

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from tallyforge.sources.xml import flat_markup, strip_markup

CASES = {
    "a {{b {{c}} d}} e": "a   e",
    "{{{1}}} {{a|{{b}}}} {{{{x}} y}} {{{{{1}}}}}": "       ",
    "{{a|}} {| b {{c|}}|}": "   ",
    "{{a|b=[[x|y]]|c={| t |}}} z": "  z",
    "[[a]] [[b|c]] [[d|e|f]] [[g|h {{i}} j]]": "a c e|f h   j",
    "[[File:x|thumb|see [[a|b]] {{c}}]]t [[ category : y]]": " t  ",
    "{| a {| b |} {{c|}} |}d": " d",
    "open {{a [[b": "open {{a [[b",
    "close a}} b]] c|} d": "close a}} b]] c|} d",
    "{{a [[b}} c]]": "  c]]",
    "[[a {{b]] c}}": "a {{b c}}",
    "{single} [one] a|b": "{single} [one] a|b",
    "": "",
}


@pytest.mark.parametrize("text", CASES)
def test_cases(text):
    assert flat_markup(text) == CASES[text]


def test_well_formed_nesting_equals_repeated_patterns():
    rng = random.Random(5)

    def piece(depth):
        if depth == 0 or rng.random() < 0.3:
            return rng.choice(["a", "b c", " ", "x"])
        inner = "".join(piece(depth - 1) for _ in range(rng.randrange(1, 4)))
        return rng.choice(["{{" + inner + "}}", "[[t|" + inner + "]]", "[[" + inner + "]]", inner])

    for _ in range(500):
        text = "".join(piece(5) for _ in range(4))
        wanted, before = text, None
        while wanted != before:  # innermost first
            before = wanted
            wanted = re.sub(r"\{\{[^{}\[\]]*\}\}", " ", wanted)
            wanted = re.sub(r"\[\[(?:[^{}\[\]|]*\|)?([^{}\[\]|]*)\]\]", r"\1", wanted)
        assert flat_markup(text) == wanted


def test_time_is_linear():
    texts = ["{{a|" * 200_000, "[[a|" * 100_000 + "]]" * 100_000, "{{" * 100_000 + "x" + "}}" * 100_000, "[[{{{|" * 100_000 + "]]" * 9]
    start = time.time()
    for text in texts:
        flat_markup(text)
    assert time.time() - start < 30


def test_columns(spark):
    rows = [("== Head ==\n'''a''' {{b {{c}}}}<ref>d</ref>[https://e f]<!-- {{ -->",), (None,), ("",)]
    found = [r[0] for r in spark.createDataFrame(rows, "t string").select(strip_markup(F.col("t"))).collect()]
    assert found == ["Head\na   f", None, ""]
