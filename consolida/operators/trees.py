"""Documents as tables of nodes, and operators on them.

``nodes`` parses each document once; selections, lookups and ancestor tests are
then relational, on the path of a node.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from html import escape, unescape
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from consolida.operators import fragments
from consolida.plans.storage import stored

NODES = "node_id int, parent_id int, path array<int>, pos int, tag string, attrs map<string,string>, text string"


def _rows(html: str | None) -> list[tuple]:
    """(node_id, parent_id, path, pos, tag, attrs, text) of all elements, in page order."""
    root, out = fragments.parse(html), []
    known: dict[int, tuple[int, list[int]]] = {id(root): (-1, [])}
    places = {id(c): i for n in (root, *root.walk()) for i, c in enumerate(n.children)}
    for n in root.walk():
        if n.tag is not None:
            parent, path = known[id(n.parent)]
            own = len(out), [*path, len(out)]
            known[id(n)] = own
            said = " ".join("".join(c.text for c in n.children if c.tag is None).split())
            out.append((own[0], parent, own[1], places[id(n)], n.tag, n.attrs, said))
    return out


def _articles(html: str | None) -> list[tuple]:
    """(article_id, pos, title, content) of every numbered section, read off one tree; equal ids have the first one's."""
    root = fragments.parse(html)
    inside = {id(n) for a in root.spec("appendix") for n in a.walk()}
    out, first = [], {}
    for pos, n in enumerate(x for x in root.walk() if x.tag is not None):
        number = n.attrs.get("data-number")
        if n.attrs.get("data-spec") == "section" and number is not None:
            name = f"APPENDIX:{number}" if id(n) in inside else number
            if name not in first:
                first[name] = fragments.split_title(n.html())
            out.append((name, pos, *first[name]))
    return out


#: Documents of a batch that are Python objects at a time (fixed value).
SLICE = 64
_ARROW = {"string": pa.string(), "int": pa.int32(), "boolean": pa.bool_()}


def per_document(docs: DataFrame, keys: Sequence[str], html: str, columns: str, step: Callable[[str | None], list]) -> DataFrame:
    """The keys and ``columns`` of the rows that ``step`` gives for each document, a few documents of a batch at a time."""
    names, kinds = zip(*(c.split() for c in columns.split(", ")), strict=True)

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            types = [*batch.schema.types[:-1], *(_ARROW[k] for k in kinds)]
            for row in sliced(batch):
                if found := step(row[-1]):
                    cells = zip(*((*row[:-1], *f) for f in found), strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cells, types, strict=True)], names=[*keys, *names])

    held = dict(docs.dtypes)
    return docs.select(*keys, html).mapInArrow(expand, ", ".join([*(f"{k} {held[k]}" for k in keys), columns]))


def sliced(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Rows of a batch as tuples, ``SLICE`` of them Python objects at a time."""
    for at in range(0, batch.num_rows, SLICE):
        yield from zip(*(c.to_pylist() for c in batch.slice(at, SLICE).columns), strict=True)


def articles(docs: DataFrame, *keys: str, html: str = "html") -> DataFrame:
    """(keys, article_id, pos, title, content) of every numbered section; each document is parsed once."""
    return per_document(docs, keys, html, "article_id string, pos int, title string, content string", _articles)


OUTLINE = (
    "kind string, start int, open_end int, close int, end int, article_id string, data_title string, opened string, in_main boolean, top boolean, own boolean, "
    "title_html string, heading_end int, html string, text string"
)
_OUTLINE = [c.split()[0] for c in OUTLINE.split(", ")]
#: Elements whose own HTML an outline has.
PARTS = frozenset(("identification", "arrete_title", "visa", "motifs"))


class _Outline(HTMLParser):
    """Main part, appendix, sections and named parts of a decree with their places in its text."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=False)
        self.html, self.lines = html, [0, *(m.end() for m in re.finditer("\n", html))]
        self.open: list[tuple[str, dict | None, str | None]] = []
        self.found: list[dict] = []
        self.sections: list[dict] = []
        self.main = self.appendix = None
        self.untitled: list[dict] = []
        self.feed(html)
        self.close()
        while self.open:
            self._end(len(html), len(html))

    def _at(self) -> int:
        line, column = self.getpos()
        return self.lines[line - 1] + column

    def _inside(self) -> None:
        """Something that is neither section nor title stands in the innermost element."""
        if self.open and self.open[-1][1] is not None and self.open[-1][1].get("kind") == "section":
            self.open[-1][1]["own"] = True

    def handle_data(self, data: str) -> None:
        if data.strip():
            self._inside()

    def handle_entityref(self, name: str) -> None:
        self._inside()

    def handle_charref(self, name: str) -> None:
        self._inside()

    def handle_starttag(self, tag: str, attrs: list) -> None:
        start, known = self._at(), {k: v or "" for k, v in attrs}
        spec = known.get("data-spec")
        if spec not in ("section", "section_title"):
            self._inside()
        row = {"start": start, "open_end": start + len(self.get_starttag_text())}
        if tag == "main" and self.main is None:
            row = self.main = {**row, "kind": "main"}
        elif tag == "footer" and spec == "appendix" and self.appendix is None:
            row = self.appendix = {**row, "kind": "appendix"}
        elif tag == "section" and spec == "section":
            number, inside = known.get("data-number"), self.appendix is not None and "end" not in self.appendix
            named = "".join(f' {k}="{escape("section_version" if k == "data-spec" else v)}"' for k, v in known.items())
            row |= {"kind": "section", "article_id": (f"APPENDIX:{number}" if inside else number) if number else None, "data_title": known.get("data-title"), "opened": "<section" + named}
            row |= {"own": False, "in_main": self.main is not None and "end" not in self.main, "top": bool(self.open) and self.open[-1][1] is self.main and self.main is not None}
            self.sections.append(row)
            self.untitled.append(row)
        elif spec in PARTS:
            row["kind"] = spec
        else:
            row = {**row, "kind": None} if spec == "section_title" or tag in fragments.HEADINGS else None
            if row is not None and spec == "section_title":
                row["titles"] = self.untitled
                self.untitled = []
            if row is not None and tag in fragments.HEADINGS and self.sections and "heading_end" not in self.sections[-1]:
                row["heads"] = self.sections[-1]
                self.sections[-1]["heading_end"] = None
        if row is not None and row.get("kind"):
            self.found.append(row)
        if tag in fragments.VOID:
            return
        self.open.append((tag, row, spec))

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in fragments.VOID:
            self._end(self._at() + len(self.get_starttag_text()), self._at() + len(self.get_starttag_text()))

    def handle_endtag(self, tag: str) -> None:
        if not any(t == tag for t, _, _ in reversed(self.open)):
            return
        at = self._at()
        while self.open[-1][0] != tag:
            self._end(at, at)
        self._end(at, self.html.find(">", at) + 1 or len(self.html))

    def _end(self, close: int, end: int) -> None:
        _, row, _ = self.open.pop()
        if row is None:
            return
        row["close"], row["end"] = close, end
        for section in row.pop("titles", ()):
            section["title_html"] = self.html[row["start"] : end]
        if (section := row.pop("heads", None)) is not None:
            section["heading_end"] = end
        if row.get("kind") in PARTS:
            row["html"] = self.html[row["start"] : end]
            row["text"] = " ".join(unescape(re.sub(r"<[^>]*>", " ", row["html"])).split())
        if row.get("kind") == "section":
            self.sections.pop()
            if self.untitled and self.untitled[-1] is row:
                self.untitled.pop()


def outline(docs: DataFrame, *keys: str, html: str = "html") -> DataFrame:
    """(keys, kind, start, open_end, close, end, ...) of main part, appendix, sections and named parts of each document.

    ``start`` and ``end`` hold an element with its tags, ``open_end`` and
    ``close`` what is in it.  ``opened``: the tag of a section as one of a
    version, without its end; ``heading_end``: where the section's own first
    heading ends; ``title_html``: its first title, wherever in it.
    """
    return per_document(docs, keys, html, OUTLINE, lambda text: [[f.get(c) for c in _OUTLINE] for f in (_Outline(text).found if text else [])])


def nodes(docs: DataFrame, *keys: str, html: str = "html") -> DataFrame:
    """Elements of every document in page order, with parent, path, attributes and the text that is directly in them."""
    names = [*keys, *(c.split()[0] for c in NODES.split(", "))]

    def expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                found = _rows(row[-1])
                if found:
                    yield pd.DataFrame([(*row[:-1], *f) for f in found], columns=names)

    types = dict(docs.dtypes)
    ddl = ", ".join([*(f"{k} {types[k]}" for k in keys), NODES])
    return docs.select(*keys, html).mapInPandas(expand, ddl)


def of_spec(table: DataFrame, spec: str) -> DataFrame:
    return table.where(F.element_at("attrs", "data-spec") == spec)


def inside(table: DataFrame, holders: DataFrame, *keys: str) -> DataFrame:
    """Rows of ``table`` that stand inside a node of ``holders``, with that node's id as ``holder``."""
    up = table.withColumn("holder", F.explode("path")).where("holder <> node_id")
    return up.join(holders.select(*keys, F.col("node_id").alias("holder")), [*keys, "holder"])


def enclosing(table: DataFrame, holders: DataFrame, *keys: str) -> DataFrame:
    """The innermost node of ``holders`` around each row."""
    met = inside(table, holders, *keys)
    return met.groupBy(*keys, "node_id").agg(F.max("holder").alias("holder"))


def section_ids(table: DataFrame, *keys: str) -> DataFrame:
    """Logical id of every section: its number, with ``APPENDIX:`` before it inside the appendix."""
    sections = of_spec(table, "section")
    held = inside(sections, of_spec(table, "appendix"), *keys).select(*keys, "node_id", F.lit(True).alias("_in")).distinct()
    number = F.element_at("attrs", "data-number")
    return sections.join(held, [*keys, "node_id"], "left").withColumn("article_id", F.when(F.col("_in"), F.concat(F.lit("APPENDIX:"), number)).otherwise(number)).drop("_in")


def resolve_documents(references: DataFrame, *keys: str) -> DataFrame:
    """The reference at the end of each chain of parents: (keys, tag_id, root, steps), one join per step.

    Chains of any length are followed; a reference whose chain runs in a circle
    has no end and no row.
    """
    at = references.select(*keys, "tag_id", F.col("parent_ref").alias("root"), F.lit(1).alias("steps")).where("root is not null")
    up = references.select(*keys, F.col("tag_id").alias("root"), F.col("parent_ref").alias("next"))
    done = references.where("parent_ref is null").select(*keys, "tag_id", F.col("tag_id").alias("root"), F.lit(0).alias("steps"))
    longest = references.count()
    for _ in range(longest):
        met = at.join(up, [*keys, "root"], "left")
        done = done.unionByName(met.where("next is null").select(*keys, "tag_id", "root", "steps"))
        at = stored(met.where("next is not null").select(*keys, "tag_id", F.col("next").alias("root"), (F.col("steps") + 1).alias("steps")).where("root <> tag_id"), "chains")
        if at.isEmpty():
            break
    return done


@F.pandas_udf(T.StringType())
def quotes_to_alineas(s: pd.Series) -> pd.Series:
    return s.map(lambda t: None if t is None else fragments.quotes_to_alineas(t))


@F.pandas_udf(T.StringType())
def find_section(html: pd.Series, number: pd.Series) -> pd.Series:
    return pd.Series([None if h is None or n is None else fragments.find_section(h, n) for h, n in zip(html, number, strict=True)])


@F.pandas_udf(T.StringType())
def operand_between(section: pd.Series, whole: pd.Series, start: pd.Series, end: pd.Series) -> pd.Series:
    return pd.Series([None if w is None or s is None else fragments.between_markers(x, w, s, e) for x, w, s, e in zip(section, whole, start, end, strict=True)])


@F.pandas_udf(T.StructType([T.StructField("title", T.StringType()), T.StructField("body", T.StringType())]))
def split_title(html: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([(None, None) if h is None else fragments.split_title(h) for h in html], columns=["title", "body"])


def _changed(step):  # noqa: ANN001, ANN202
    @F.pandas_udf(T.StringType())
    def apply(html: pd.Series, kind: pd.Series, position: pd.Series, operand: pd.Series) -> pd.Series:
        cells = zip(html, kind, position, operand, strict=True)
        return pd.Series([None if h is None or k is None else step(h, k, None if pd.isna(at) else int(at), op) for h, k, at, op in cells], dtype=object)

    return apply


#: HTML with a part replaced (removed, without an operand), or with an operand behind a part; null where the part is not there.
changed = _changed(lambda h, k, at, op: fragments.change_fragment(h, k, at, op))
inserted = _changed(lambda h, k, at, op: fragments.insert_fragment(h, k, at, op or ""))


@F.pandas_udf(T.StringType())
def without_heading(operand: pd.Series, title: pd.Series) -> pd.Series:
    """An operand without a heading that repeats its section's title."""
    return pd.Series([None if o is None else fragments.strip_heading(o, t) for o, t in zip(operand, title, strict=True)], dtype=object)
