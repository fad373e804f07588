"""HTML page queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from duelframe.sources import pages as H
from duelframe.plans.registry import register, table

# pages without comments, scripts and style sheets; texts without tags, their references decoded
_SEEN = r"regexp_replace(html, '<!--.*?-->|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>', '', 'gs')"


def _decoded(c: str) -> str:
    for ref, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
        c = f"replace({c}, '{ref}', '{sign}')"
    return c


def _text(c: str) -> str:
    return _decoded(f"regexp_replace({c}, '<[^>]+>', '', 'g')")


_ITEMS = f"SELECT page_id, regexp_extract_all({_SEEN}, '<li>(.*?)</li>', 1, 's') AS it FROM pages"
_ANCHORS = f"SELECT page_id, regexp_extract_all({_SEEN}, '<a href=\"[^\"]*\">.*?</a>', 0, 's') AS a FROM pages"
_HREF = _decoded("regexp_extract(a[i], 'href=\"([^\"]*)\"', 1)")


@register("page_items", f"""
WITH p AS ({_ITEMS})
SELECT page_id, CAST(i - 1 AS INTEGER) AS pos, {_text('it[i]')} AS item
FROM p, range(1, len(it) + 1) r(i)
""")
def q_page_items(spark, sf_dir):
    """List items with positions."""
    return H.page_items(table(spark, sf_dir, "pages"))


@register("page_links", f"""
WITH p AS ({_ANCHORS})
SELECT page_id, CAST(i - 1 AS INTEGER) AS pos, {_text('a[i]')} AS text, {_HREF} AS href
FROM p, range(1, len(a) + 1) r(i)
""")
def q_page_links(spark, sf_dir):
    """Link text and href."""
    return H.page_links(table(spark, sf_dir, "pages"))


@register("page_field", f"""
WITH p AS ({_ITEMS})
SELECT page_id, list_filter(list_transform(it, lambda x: {_text('x')}), lambda x: contains(lower(x), 'the'))[1] AS field
FROM p
""")
def q_page_field(spark, sf_dir):
    """First list item containing a keyword."""
    return H.page_field(table(spark, sf_dir, "pages"), "the")


def _first(tag: str) -> str:
    return f"""nullif(trim({_text(f"regexp_extract(h, '<{tag}>(.*?)</{tag}>', 1, 's')")}), '')"""


@register("page_labelled", f"""
WITH p AS (SELECT page_id, {_SEEN} AS h FROM pages)
SELECT page_id, coalesce({_first('h2')}, {_first('h1')}, {_first('title')}) AS value FROM p
""")
def q_page_labelled(spark, sf_dir):
    """Labelled field with priority fallback (h2, then h1, then title)."""
    return H.page_labelled(table(spark, sf_dir, "pages"), ["h2", "h1", "title"])


@register("page_absolute_links", f"""
WITH p AS ({_ANCHORS})
SELECT page_id, concat('https://example.org', {_HREF}) AS url
FROM p, range(1, len(a) + 1) r(i)
WHERE starts_with({_HREF}, '/')
""")
def q_absolute_links(spark, sf_dir):
    """F23 on S9: relative links made absolute."""
    links = H.page_links(table(spark, sf_dir, "pages"))
    return links.filter(F.col("href").startswith("/")).select(
        "page_id", F.concat(F.lit("https://example.org"), F.col("href")).alias("url"))


@register("page_records", f"""
WITH l AS (SELECT page_id, regexp_extract({_SEEN}, '<ul>(.*?)</ul>', 1, 's') AS ul FROM pages),
p AS (SELECT page_id, regexp_extract_all(ul, '<li>(.*?)</li>', 1, 's') AS it FROM l),
e AS (SELECT page_id, u.raw, u.row FROM p, LATERAL (SELECT unnest(CASE WHEN len(it) = 0 THEN [NULL] ELSE it END) AS raw,
      unnest(CASE WHEN len(it) = 0 THEN [NULL] ELSE range(len(it)) END) AS row) u),
c AS (SELECT page_id, row::INTEGER AS row, trim({_text('raw')}) AS item, {_decoded("regexp_extract(raw, 'href=\"([^\"]*)\"', 1)")} AS href FROM e)
SELECT page_id, row, item, href, string_split(href, '/')[1] AS part_1, string_split(href, '/')[2] AS part_2,
       string_split(href, '/')[3] AS part_3 FROM c
""")
def q_page_records(spark, sf_dir):
    """X4 + U5 + U6: each page's first list as a nested list of links, exploded
    (a page without items keeps one NULL row), each target split into fields."""
    from duelframe.operators.reshape import array_to_columns

    p = H.page_records(table(spark, sf_dir, "pages"), "ul", "li", ("a",))
    e = p.select("page_id", F.posexplode_outer("records").alias("row", "cells"))
    link = F.try_element_at("cells", F.lit(1))
    e = e.select("page_id", "row", link["text"].alias("item"), link["href"].alias("href"),
                 F.split(link["href"], "/").alias("parts"))
    return array_to_columns(e, "parts", ["part_1", "part_2", "part_3"])
