"""HTML page parsing, run as an Arrow-batched ``mapInPandas`` job.

Spark has no HTML parser, so each landed page is parsed in a Python worker
with the standard library's ``html.parser`` into a light element tree, and
the selector logic of a layout turns it into plain records (strings, arrays,
flags).  Everything after that (typing, dates, ratings, cut-offs, joins) is
Column expressions.  Pages are independent rows: no page is grouped with
another, so a target with many pages spreads over many tasks.

Matching follows the usual tree-library conventions: an attribute selector
on ``class`` matches one class token or the whole class string; other
attributes match exactly; ``find`` is the first match in document order and
``find_all`` all matches including nested ones; ``text`` joins all
descendant text (comments excluded).  Cells, rows and sections of a table may
lack their end tags.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from revlens.session import ship_package, small_batches

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source",
         "track", "wbr"}


#: A start tag ends the open parts of the same table that it can't stand in.
_ENDS = {"td": ("td", "th"), "th": ("td", "th"), "tr": ("tr",), "tbody": ("tbody", "thead", "tfoot", "tr"),
         "thead": ("tbody", "thead", "tfoot", "tr"), "tfoot": ("tbody", "thead", "tfoot", "tr")}


class Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: dict, parent: "Node | None"):
        self.tag, self.attrs, self.children, self.parent = tag, attrs, [], parent

    # -- selection -----------------------------------------------------------
    def _matches(self, tag: str | None, attr: str | None, value: str | None) -> bool:
        if tag is not None and self.tag != tag:
            return False
        if attr is None:
            return True
        got = self.attrs.get(attr)
        if got is None:
            return False
        if attr == "class":
            # one class token, the whole class string, or (compound selector)
            # every token of ``value``
            return value == got or set(value.split()) <= set(got.split())
        return got == value

    def iter(self) -> Iterator["Node"]:
        stack = list(reversed([c for c in self.children if isinstance(c, Node)]))
        while stack:
            n = stack.pop()
            yield n
            stack.extend(reversed([c for c in n.children if isinstance(c, Node)]))

    def find_all(self, tag: str | None = None, attr: str | None = None, value: str | None = None) -> list["Node"]:
        return [n for n in self.iter() if n._matches(tag, attr, value)]

    def find(self, tag: str | None = None, attr: str | None = None, value: str | None = None) -> "Node | None":
        for n in self.iter():
            if n._matches(tag, attr, value):
                return n
        return None

    def sel(self, spec: tuple[str, str, str]) -> "Node | None":
        return self.find(*spec)

    def sel_all(self, spec: tuple[str, str, str]) -> list["Node"]:
        return self.find_all(*spec)

    @property
    def text(self) -> str:
        out: list[str] = []
        stack: list = [self]
        while stack:
            n = stack.pop()
            if isinstance(n, str):
                out.append(n)
            else:
                stack.extend(reversed(n.children))
        return "".join(out)


class _TreeBuilder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("[document]", {}, None)
        self.cur = self.root

    def _end_parts(self, ends: tuple[str, ...]) -> None:
        """End the outermost open part among ``ends`` of the innermost open table."""
        n, outermost = self.cur, None
        while n is not self.root and n.tag != "table":
            if n.tag in ends:
                outermost = n
            n = n.parent
        if outermost is not None:
            self.cur = outermost.parent

    def handle_starttag(self, tag, attrs):
        if tag in _ENDS:
            self._end_parts(_ENDS[tag])
        node = Node(tag, {k: (v if v is not None else "") for k, v in attrs}, self.cur)
        self.cur.children.append(node)
        if tag not in _VOID:
            self.cur = node

    def handle_startendtag(self, tag, attrs):
        self.cur.children.append(Node(tag, {k: (v if v is not None else "") for k, v in attrs}, self.cur))

    def handle_endtag(self, tag):
        n = self.cur
        while n is not self.root and n.tag != tag:
            if tag in _ENDS and n.tag == "table":
                return                   # a part's end tag does not reach out of its table
            n = n.parent
        if n is not self.root:           # an end tag with no open element is ignored
            self.cur = n.parent

    def handle_data(self, data):
        self.cur.children.append(data)


def parse(html: str | None) -> Node:
    b = _TreeBuilder()
    if html:
        b.feed(html)
        b.close()
    return b.root


def strip(s: str | None) -> str | None:
    return None if s is None else s.strip()


def parse_pages(df: DataFrame, extractor: Callable[[Node], object], out_col: str, out_type: T.DataType,
                html_col: str = "html") -> DataFrame:
    """Run ``extractor`` on the parsed tree of every page; the result goes to
    ``out_col`` and the html column is dropped.  Arrow batches are sized by
    ``spark.sql.execution.arrow.maxRecordsPerBatch``."""
    spark = df.sparkSession
    ship_package(spark)
    small_batches(spark)                                # pages can be large
    keep = [f for f in df.schema.fields if f.name != html_col]
    schema = T.StructType(keep + [T.StructField(out_col, out_type)])
    names = [f.name for f in keep]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = pdf[names].copy()
            out[out_col] = [extractor(parse(h)) for h in pdf[html_col]]
            yield out

    return df.mapInPandas(run, schema)
