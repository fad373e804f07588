"""HTML page tables (S8-S11, X4) as element records.

Pages arrive as a table (page_id, url, html).  A small element stack per page
(``Elements``) follows the markup: nesting, end tags that may be left out,
elements without content, comments, scripts and style sheets passed over,
character references decoded.  It returns the wanted elements of a page in
document order as an array of records, each with the place of its nearest
wanted ancestor; everything after that is array expressions in the JVM, one
row per page, with no shuffle.

A null page has no elements.  Markup that is broken is read as far as it
goes: an end tag without a start is passed over, what is open at the end ends
there.  The text of an element is all text inside it as it stands, white space
included.
"""

from __future__ import annotations

from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values of the HTML standard:
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
SILENT = {"script", "style"}
BLOCKS = ("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav "
          "ol p pre section table ul").split()
CELLS, ROWS = {"td", "th"}, {"thead", "tbody", "tfoot"}
#: start tag: (what it ends, where the search for that stops)
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": (CELLS, {"tr", "table"}), "th": (CELLS, {"tr", "table"}),
    "tr": ({"tr"}, {"table"}), **{t: (ROWS | {"caption", "colgroup"}, {"table"}) for t in ROWS},
    "body": ({"head"}, {"html"}),
    **{t: ({"p"}, {"table", "caption", "button", "object", *CELLS}) for t in BLOCKS},
}
# ---------------------------------------------------------------------------

ELEMENT = pa.struct([("parent", pa.int32()), ("tag", pa.string()), ("attrs", pa.map_(pa.string(), pa.string())), ("text", pa.string())])
ELEMENTS = "array<struct<parent:int,tag:string,attrs:map<string,string>,text:string>>"


class Elements(HTMLParser):
    """The wanted elements of one page: dicts of parent (place in the list or -1), tag, attrs and text."""

    def __init__(self, wanted: set[str]):
        super().__init__(convert_charrefs=True)
        self.wanted, self.found, self.pieces = wanted, [], []
        self.open: list[tuple[str, int, int]] = []           # tag, place among the found (-1: not wanted), first piece

    def _end(self, depth: int) -> None:
        """Ends all open elements from ``depth`` on."""
        while len(self.open) > depth:
            _, place, first = self.open.pop()
            if place >= 0:
                self.found[place]["text"] = "".join(self.pieces[first:])

    def handle_starttag(self, tag, attrs):
        ended, stop = ENDS.get(tag, ((), ()))
        for depth in range(len(self.open) - 1, -1, -1) if ended else ():
            if self.open[depth][0] in stop:
                break
            if self.open[depth][0] in ended:
                self._end(depth)
                break
        place = -1
        if tag in self.wanted:
            place = len(self.found)
            parent = next((p for _, p, _ in reversed(self.open) if p >= 0), -1)
            named = {}
            for name, value in attrs:
                named.setdefault(name, value or "")              # of a repeated attribute the first counts
            self.found.append({"parent": parent, "tag": tag, "attrs": list(named.items()), "text": ""})
        if tag not in VOID:
            self.open.append((tag, place, len(self.pieces)))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)                         # a slash ends no HTML element

    def handle_endtag(self, tag):
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth][0] == tag:
                self._end(depth)
                return
            if self.open[depth][0] in CELLS and tag not in {"table", "tr", *ROWS, "body", "html"}:
                return                                           # an end tag does not leave its table cell

    def handle_data(self, data):
        if not (self.open and self.open[-1][0] in SILENT):
            self.pieces.append(data)

    def read(self, html: str | None) -> list[dict]:
        if html:
            self.feed(html)
            self.close()
            self._end(0)
        return self.found


def page_elements(pages: DataFrame, tags: list[str], id_col: str = "page_id", html: str = "html") -> DataFrame:
    """(id, elements): the elements with one of ``tags`` in document order, one row per page.

    ``parent`` is the place of the nearest of these elements around one, -1
    for none.
    """
    wanted, kind = {t.lower() for t in tags}, pages.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [Elements(wanted).read(h) for h in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.list_(ELEMENT))], names=["id", "elements"])

    out = pages.select(F.col(id_col).alias("id"), F.col(html).cast("string").alias("html")).mapInArrow(run, f"id {kind}, elements {ELEMENTS}")
    return out.withColumnRenamed("id", id_col)


def strip_tags(c: Column) -> Column:
    return F.regexp_replace(c, "<[^>]+>", "")


def page_items(pages: DataFrame, tag: str = "li", id_col: str = "page_id",
               html: str = "html") -> DataFrame:
    """Repeated elements of a page -> rows (id, pos, item text), pos from 0; nested ones are items too."""
    found = page_elements(pages, [tag], id_col, html)
    return found.select(id_col, F.posexplode(F.col("elements.text")).alias("pos", "item"))


def page_links(pages: DataFrame, id_col: str = "page_id", html: str = "html") -> DataFrame:
    """(id, pos, text, href) of every anchor that has an href."""
    found = page_elements(pages, ["a"], id_col, html)
    anchors = F.filter("elements", lambda e: F.map_contains_key(e["attrs"], "href"))
    z = found.select(id_col, F.posexplode(anchors).alias("pos", "a"))
    return z.select(id_col, "pos", F.col("a.text").alias("text"), F.col("a.attrs")["href"].alias("href"))


def page_field(pages: DataFrame, keyword: str, tag: str = "li", id_col: str = "page_id",
               html: str = "html", name: str = "field") -> DataFrame:
    """The text of the first element whose lower-cased text contains ``keyword``."""
    found = page_elements(pages, [tag], id_col, html)
    hits = F.filter(F.col("elements.text"), lambda x: F.lower(x).contains(keyword.lower()))
    return found.select(id_col, F.try_element_at(hits, F.lit(1)).alias(name))


def page_labelled(pages: DataFrame, labels: list[str | tuple[str, str, str]], id_col: str = "page_id",
                  html: str = "html", name: str = "value") -> DataFrame:
    """The first of ``labels``, in their order, that gives a text.

    A label is a tag (the text of the first such element) or (label tag,
    label, value tag): the first value element beside a label element of that
    text, such as ``("th", "Born", "td")`` in a table row.  Texts are
    trimmed; empty ones and missing labels go on to the next.
    """
    around = {"tr", "dl", "li", "div"} if any(isinstance(x, tuple) for x in labels) else set()
    tags = around | {t for x in labels for t in ((x,) if isinstance(x, str) else (x[0], x[2]))}
    found = page_elements(pages, sorted(tags), id_col, html)

    def value(label) -> Column:
        if isinstance(label, str):
            hits = F.filter("elements", lambda e: e["tag"] == label.lower())
        else:
            heads = F.filter("elements", lambda e: (e["tag"] == label[0].lower()) & (F.trim(e["text"]) == label[1]))
            beside = F.transform(heads, lambda e: e["parent"])
            hits = F.filter("elements", lambda e: (e["tag"] == label[2].lower()) & F.array_contains(beside, e["parent"]))
        return F.nullif(F.trim(F.try_element_at(hits, F.lit(1))["text"]), F.lit(""))

    return found.select(id_col, F.coalesce(*(value(x) for x in labels)).alias(name))


RECORD = pa.struct([("tag", pa.string()), ("text", pa.string()), ("href", pa.string())])
RECORDS = "array<array<struct<tag:string,text:string,href:string>>>"


def nested_records(found: list[dict], container: str, row: str, cells: set[str], where: dict[str, str]) -> list[list[dict]]:
    """The rows of the first matching container: each the cells of the row (trimmed text, first link)."""
    def matches(e) -> bool:
        attrs = dict(e["attrs"])
        return e["tag"] == container and all(v == attrs.get(k) or k == "class" and v in attrs.get(k, "").split() for k, v in where.items())

    top = next((i for i, e in enumerate(found) if matches(e)), None)
    holder: dict[int, int] = {}                                   # row element -> its place among the rows
    owner: dict[int, dict] = {}                                   # cell element -> its record
    rows: list[list[dict]] = []
    inside = {top}
    for i, e in enumerate(found if top is not None else []):
        if e["parent"] not in inside:
            continue
        inside.add(i)
        up = e["parent"]
        if e["tag"] == row and up == top:
            holder[i] = len(rows)
            rows.append([])
        elif e["tag"] in cells and up in holder:
            owner[i] = {"tag": e["tag"], "text": e["text"].strip(), "href": dict(e["attrs"]).get("href")}
            rows[holder[up]].append(owner[i])
        elif e["tag"] == "a" and up in owner and owner[up]["href"] is None:
            owner[up]["href"] = dict(e["attrs"]).get("href")
    return rows


def page_records(pages: DataFrame, container: str = "table", row: str = "tr", cells: tuple[str, ...] = ("td", "th"),
                 where: dict[str, str] | None = None, id_col: str = "page_id", html: str = "html") -> DataFrame:
    """(id, records): the rows of a page's first matching container as a nested list of cells.

    ``where`` names attributes of the container (a class matches as one word
    of the attribute).  A cell has its tag, trimmed text and the target of
    its first link (its own, for a link).  Rows of a container nested in a
    cell belong to that container.  Pages without the container, or null,
    have an empty list.
    """
    kind, inner = pages.schema[id_col].dataType.simpleString(), {c.lower() for c in cells}
    wanted = {container, row, "a"} | inner

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [nested_records(Elements(wanted).read(h), container, row, inner, where or {}) for h in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.list_(pa.list_(RECORD)))], names=["id", "records"])

    out = pages.select(F.col(id_col).alias("id"), F.col(html).cast("string").alias("html")).mapInArrow(run, f"id {kind}, records {RECORDS}")
    return out.withColumnRenamed("id", id_col)
