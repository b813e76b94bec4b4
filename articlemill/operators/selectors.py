"""General HTML selectors as one `mapInPandas` job over a page table.

Rules are data, `(field, selector)`, so another site needs no new code. A selector is
compound parts such as `tag#id.class[attr^=value]`, parted by blanks (descendant) or
`>` (child). Pages are parsed by the tolerant parser of the standard library.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from articlemill.schemas import SELECTED_SCHEMA

# Fixed values of HTML: elements without content, without visible text, and inline ones.
VOID = set("area base br col embed hr img input link meta source track wbr".split())
HIDDEN = set("script style".split())
INLINE = set("a abbr b cite code em font i mark q s small span strong sub sup u".split())

# Opening one of the values ends an open element of the key.
ENDED_BY = {
    "p": set("p div ul ol dl table h1 h2 h3 h4 h5 h6 article section footer nav".split()),
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr"},
    "td": {"td", "th", "tr"},
    "th": {"td", "th", "tr"},
    "option": {"option"},
}

ROWS_PER_BATCH = 2_000

BATCH_CHARS = 8 << 20
BLANKS = re.compile("[ \\t\\r\\n]+")
PART = re.compile(r"([#.]?[\w-]+|\[[^\]]*\]|\*)")
CONDITION = re.compile(r"\[\s*([\w:-]+)\s*(?:([\^$*~]?=)\s*[\"']?([^\"'\]]*)[\"']?)?\s*\]")


class PageTree(HTMLParser):
    """Elements of one page in document order, with parent, text and source range."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.html = html
        self.line_starts = [0] + [m.end() for m in re.finditer("\n", html)]
        self.nodes: list[dict] = []
        self.open: list[int] = []
        self.words: list[str] = []
        self.feed(html)
        self.close()
        self._end_down_to(0, len(html))

    def _offset(self) -> int:
        line, column = self.getpos()
        return self.line_starts[line - 1] + column

    def _end_down_to(self, depth: int, offset: int) -> None:
        while len(self.open) > depth:
            node = self.nodes[self.open.pop()]
            node["words_end"], node["end"] = len(self.words), offset

    def handle_starttag(self, tag, attrs):
        offset = self._offset()
        for depth in range(len(self.open) - 1, -1, -1):
            name = self.nodes[self.open[depth]]["tag"]
            if tag in ENDED_BY.get(name, ()):
                self._end_down_to(depth, offset)
                break
            if name not in INLINE:
                break
        if tag not in INLINE:
            self.words.append(" ")
        values: dict[str, str] = {}
        for name, value in attrs:
            values.setdefault(name, value or "")
        node = {
            "tag": tag, "attrs": values, "parent": self.open[-1] if self.open else -1,
            "start": offset, "words_start": len(self.words),
            "end": offset + len(self.get_starttag_text() or ""), "words_end": len(self.words),
        }
        self.nodes.append(node)
        if tag not in VOID:
            self.open.append(len(self.nodes) - 1)

    def handle_endtag(self, tag):
        for depth in range(len(self.open) - 1, -1, -1):
            if self.nodes[self.open[depth]]["tag"] == tag:
                close = self.html.find(">", self._offset())
                self._end_down_to(depth, close + 1 if close >= 0 else len(self.html))
                break
        if tag not in INLINE:
            self.words.append(" ")

    def handle_data(self, data):
        if not self.open or self.nodes[self.open[-1]]["tag"] not in HIDDEN:
            self.words.append(data)

    def text(self, node: dict) -> str:
        pieces = BLANKS.split("".join(self.words[node["words_start"] : node["words_end"]]))
        return " ".join(p for p in pieces if p)

    def markup(self, node: dict) -> str:
        return self.html[node["start"] : node["end"]]


def condition_holds(attrs: dict, condition: str) -> bool:
    name, operator, wanted = CONDITION.fullmatch(condition).groups()
    value = attrs.get(name)
    if value is None or operator is None:
        return value is not None
    tests = {
        "=": value == wanted,
        "^=": value.startswith(wanted),
        "$=": value.endswith(wanted),
        "*=": wanted in value,
        "~=": wanted in value.split(),
    }
    return tests[operator]


def part_matches(node: dict, part: str) -> bool:
    for piece in PART.findall(part):
        if piece[0] == "#":
            ok = node["attrs"].get("id") == piece[1:]
        elif piece[0] == ".":
            ok = piece[1:] in node["attrs"].get("class", "").split()
        elif piece[0] == "[":
            ok = condition_holds(node["attrs"], piece)
        else:
            ok = piece == "*" or node["tag"] == piece.lower()
        if not ok:
            return False
    return True


def steps_of(selector: str) -> list[str]:
    """Compound parts with the combinators between them; a blank stands for descendant."""
    return re.findall(r"(?:\[[^\]]*\]|[^\s>\[])+|>", selector)


def node_matches(tree: PageTree, index: int, steps: list[str]) -> bool:
    node = tree.nodes[index]
    if not part_matches(node, steps[-1]):
        return False
    rest = steps[:-1]
    if not rest:
        return True
    if rest[-1] == ">":
        return node["parent"] >= 0 and node_matches(tree, node["parent"], rest[:-1])
    parent = node["parent"]
    while parent >= 0:
        if node_matches(tree, parent, rest):
            return True
        parent = tree.nodes[parent]["parent"]
    return False


def _batched(rows: Iterator[tuple[list, int]], names: list[str]) -> Iterator[pd.DataFrame]:
    """Rows, each with its size in characters, in batches bounded by both."""
    held, size = [], 0
    for row, chars in rows:
        held.append(row)
        size += chars
        if len(held) >= ROWS_PER_BATCH or size >= BATCH_CHARS:
            yield pd.DataFrame(held, columns=names)
            held, size = [], 0
    if held:
        yield pd.DataFrame(held, columns=names)


def _matches(html: str | None, compiled: list[tuple[str, list[str]]]) -> Iterator[tuple[str, int, PageTree, dict]]:
    tree = PageTree(html or "")
    for field, steps in compiled:
        hits = (n for n in range(len(tree.nodes)) if node_matches(tree, n, steps))
        for pos, n in enumerate(hits):
            yield field, pos, tree, tree.nodes[n]


def select_elements(
    pages: DataFrame, keys: list[str], html: str, rules: list[tuple[str, str]], columns: list[str] | None = None
) -> DataFrame:
    """Rows `(keys, field, pos, tag, text, markup, attrs)` for every element a rule finds.

    `columns` names those of the last four that are wanted; others are neither built nor sent.
    """
    compiled = [(field, steps_of(selector)) for field, selector in rules]
    wanted = [f for f in T.StructType.fromDDL(SELECTED_SCHEMA).fields if f.name in ("field", "pos") or columns is None or f.name in columns]
    schema = T.StructType([pages.schema[k] for k in keys] + wanted)
    parts = {
        "tag": lambda tree, node: node["tag"], "text": lambda tree, node: tree.text(node),
        "markup": lambda tree, node: tree.markup(node), "attrs": lambda tree, node: node["attrs"],
    }
    chosen = [parts[f.name] for f in wanted[2:]]

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[list, int]]:
        for batch in batches:
            for record in batch.itertuples(index=False):
                for field, pos, tree, node in _matches(record[-1], compiled):
                    values = [part(tree, node) for part in chosen]
                    yield [*record[:-1], field, pos, *values], sum(len(v) for v in values)

    return pages.select(*keys, html).mapInPandas(lambda batches: _batched(rows(batches), schema.names), schema)


def articles_by_rules(
    pages: DataFrame,
    keys: list[str],
    html: str,
    rules: dict[str, str],
    required: str = "content",
) -> DataFrame:
    """One row per page with the text of each rule's elements, made where the page is read.

    A field is the joined text of all elements its rule finds, empty if there are none;
    a page without the required element is left out.
    """
    compiled = [(field, steps_of(selector)) for field, selector in rules.items()]
    fields = [T.StructField(field, T.StringType()) for field in rules]
    schema = T.StructType([pages.schema[k] for k in keys] + fields)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[list, int]]:
        for batch in batches:
            for record in batch.itertuples(index=False):
                texts: dict[str, list[str]] = {field: [] for field in rules}
                for field, _, tree, node in _matches(record[-1], compiled):
                    texts[field].append(tree.text(node))
                if texts[required]:
                    joined = [" ".join(t) for t in texts.values()]
                    yield [*record[:-1], *joined], sum(map(len, joined))

    return pages.select(*keys, html).mapInPandas(lambda batches: _batched(rows(batches), schema.names), schema)


# Tasks carry this module along, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
