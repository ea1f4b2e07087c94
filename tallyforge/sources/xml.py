"""Records inside large XML files."""

from __future__ import annotations

import re
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.plans.layout import computed_once

# Record tags, the marker of a major topic, and the marker of a disambiguation title.
CITATION_TAG = "MedlineCitation"
PAGE_TAG = "page"
_PARSED = 200  # records that are parsed together
TOPIC_PATH, MAJOR = "//DescriptorName", ("MajorTopicYN", "Y")
DISAMBIGUATION = "(disambiguation)"
ARTICLE_NAMESPACE = 0

PAGE_SCHEMA = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("ns", T.IntegerType()),
    T.StructField("redirect", T.StructType([T.StructField("_title", T.StringType())])),
    T.StructField("revision", T.StructType([T.StructField("text", T.StringType())])),
])


def scan_xml_records(spark: SparkSession, path: str, tag: str) -> DataFrame:
    """The raw text of every ``<tag …>…</tag>``, as column ``xml``.

    The end tag is the record separator, so the files stay splittable.
    """
    end = f"</{tag}>"
    chunk = F.regexp_extract("value", rf"(?s)(<{tag}(?:\s|>).*)\z", 1)
    bodies = computed_once(spark.read.option("lineSep", end).text(path), "body", chunk).where(F.col("body") != "")
    return bodies.select(F.concat("body", F.lit(end)).alias("xml"))


def scan_xml_columns(spark: SparkSession, path: str, tag: str, schema: T.StructType) -> DataFrame:
    """Records as typed columns. Built on the raw records, so files need no root element and stay splittable."""
    record = F.from_xml("xml", schema)
    return scan_xml_records(spark, path, tag).select(record.alias("record")).select("record.*")


def major_topics(xml: Column | str) -> Column:
    """Texts of the major topics of a citation, in document order."""
    return node_texts(xml, TOPIC_PATH, MAJOR)


def node_texts(xml: Column | str, path: str, mark: tuple[str, str] | None = None) -> Column:
    """The text nodes of all elements at a path (``/a/b``, or ``//b`` at any depth), in document order.

    With a ``mark``, only of elements that have this attribute with this value. NULL and empty text give NULL; a record that
    is no XML is an error. The built-in ``xpath`` makes a parser for every record and path, which takes many times longer
    than reading the record.
    """

    @F.pandas_udf("array<string>")
    def found(records: pd.Series) -> pd.Series:
        out: list[list[str] | None] = [None] * len(records)
        some = [(at, record) for at, record in enumerate(records) if record]
        for start in range(0, len(some), _PARSED):
            part = some[start:start + _PARSED]
            for (at, _), root in zip(part, parsed_records([record for _, record in part]), strict=True):
                out[at] = texts_at(root, path, mark)
        return pd.Series(out, dtype=object)

    return found(F.col(xml) if isinstance(xml, str) else xml)


def parsed_records(records: list[str]) -> list[ElementTree.Element]:
    """The root element of each record: one parser reads them all, unless their bounds are not what they should be."""
    keeps = ElementTree.TreeBuilder(insert_comments=True, insert_pis=True)  # as they part text nodes
    try:
        cells = ElementTree.XML(f"<_>{''.join(f'<_>{record}</_>' for record in records)}</_>", ElementTree.XMLParser(target=keeps))
    except ElementTree.ParseError:
        return [ElementTree.XML(record) for record in records]
    alone = (len(cell) == 1 and not f"{cell.text or ''}{cell[0].tail or ''}{cell.tail or ''}".strip() for cell in cells)
    if len(cells) != len(records) or not all(alone):
        return [ElementTree.XML(record) for record in records]
    return [cell[0] for cell in cells]


def texts_at(root: ElementTree.Element, path: str, mark: tuple[str, str] | None = None) -> list[str]:
    """What :func:`node_texts` finds in one record."""
    if path.startswith("//"):
        elements = list(root.iter(path[2:]))
    else:
        first, *rest = path[1:].split("/")
        elements = [] if root.tag != first else root.findall("/".join(rest)) if rest else [root]
    if mark is not None:
        elements = [element for element in elements if element.get(mark[0]) == mark[1]]
    if not any(len(element) for element in elements):
        return [element.text for element in elements if element.text]
    wanted, texts = {id(element) for element in elements}, []

    def walk(element: ElementTree.Element) -> None:
        here = id(element) in wanted
        if here and element.text:
            texts.append(element.text)
        for child in element:
            walk(child)
            if here and child.tail:
                texts.append(child.tail)

    walk(root)
    return texts


def wiki_articles(pages: DataFrame) -> DataFrame:
    """Title and text of real articles: not empty, no redirect, no disambiguation page."""
    return pages.where(
        (F.col("ns") == ARTICLE_NAMESPACE)
        & F.col("redirect").isNull()
        & (F.length("revision.text") > 0)
        & ~F.col("title").contains(DISAMBIGUATION)
    ).select("title", strip_markup(F.col("revision.text")).alias("content"))


# Wiki markup to take out before and after nested brackets, what stays of it, and links that are no text.
_BEFORE = [
    (r"(?s)<!--.*?-->", " "),
    (r"(?s)<ref[^>/]*/>|<ref[^>]*>.*?</ref>", " "),
]
_AFTER = [
    (r"\[https?://[^\s\]]+\s*([^\]]*)\]", "$1"),
    (r"'{2,}", ""),
    (r"<[^>]+>", " "),
    (r"(?m)^=+\s*(.*?)\s*=+\s*$", "$1"),
]
_NO_TEXT = re.compile(r"\s*(?:File|Image|Category)\s*:", re.IGNORECASE)
_BRACKET = re.compile(r"\{{2,}|\}{2,}|\{\||\|\}+|\[\[|\]\]|\|")


def strip_markup(text: Column) -> Column:
    """Plain text of wiki markup, whatever its nesting; NULL stays NULL."""
    for pattern, kept in _BEFORE:
        text = F.regexp_replace(text, pattern, kept)
    text = without_brackets(text)
    for pattern, kept in _AFTER:
        text = F.regexp_replace(text, pattern, kept)
    return F.trim(text)


def without_brackets(text: Column) -> Column:
    """Templates, parameters and tables become a space, links their label: patterns can't follow nested brackets."""

    @F.pandas_udf("string")
    def flatten(texts: pd.Series) -> pd.Series:
        return texts.map(flat_markup, na_action="ignore")

    return flatten(text)


def flat_markup(text: str) -> str:
    """One pass with a stack of open brackets.

    An open bracket is its kind, its place in ``out``, what is left of a run of braces, and the place of the first pipe of
    a link. A closing bracket ends the last open one of its kind; brackets in between that never close are plain text, and
    so is a closing bracket without an open one. Runs of braces close in twos, but three at a time (a parameter) while the
    shorter run is odd. Links to files and categories go with all they hold.
    """
    out: list[str] = []
    stack: list[list] = []
    depth = {"{": 0, "|": 0, "[": 0}
    end = 0

    def opened(kind: str) -> bool:
        """Whether one of this kind is open; if so it is on top afterwards."""
        if not depth[kind]:
            return False
        while stack[-1][0] != kind:
            depth[stack.pop()[0]] -= 1
        return True

    def close_braces(left: int) -> None:
        while left >= 2 and opened("{"):
            top = stack[-1]
            taken = 2 + min(left, top[2]) % 2
            left, top[2] = left - taken, top[2] - taken
            out[top[1]] = "{" * top[2]
            out[top[1] + 1:] = [" "]
            if top[2] < 2:
                depth[stack.pop()[0]] -= 1
        out.append("}" * left)

    def pipe() -> None:
        if stack and stack[-1][0] == "[" and stack[-1][3] is None:
            stack[-1][3] = len(out)
        out.append("|")

    for found in _BRACKET.finditer(text):
        if found.start() > end:
            out.append(text[end:found.start()])
        token, end = found.group(), found.end()
        if token[0] == "{" or token == "[[":
            kind = "|" if token == "{|" else token[0]
            stack.append([kind, len(out), len(token), None])
            depth[kind] += 1
            out.append(token)
        elif token[0] == "}":
            close_braces(len(token))
        elif token[0] == "|" and len(token) > 1:
            if depth["|"] and (len(token) == 2 or (len(token) % 2 == 0 and stack[-1][0] == "|")):
                opened("|")
                out[stack.pop()[1]:] = [" "]
                depth["|"] -= 1
                close_braces(len(token) - 2)
            else:
                pipe()
                close_braces(len(token) - 1)
        elif token == "]]" and opened("["):
            _, start, _, first = stack.pop()
            depth["["] -= 1
            if start + 1 < len(out) and _NO_TEXT.match(out[start + 1]):
                out[start:] = [" "]
            elif first is None:
                out[start] = ""
            else:
                del out[start:first + 1]
        elif token == "|":
            pipe()
        else:
            out.append(token)
    out.append(text[end:])
    return "".join(out)
