"""File links in HTML pages held in a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LIST_ITEM_LINK = r'<li><a href="([^"]*)"'


def list_resource_links(pages: DataFrame, suffix: str, html: str = "html", pattern: str = LIST_ITEM_LINK) -> DataFrame:
    """One row per matching link: all columns but the page text, plus ``link`` and ``file_name``."""
    found = F.explode(F.regexp_extract_all(F.col(html), F.lit(pattern), F.lit(1))).alias("link")
    return _named(pages.select(*_without(pages, html), found), suffix)


def list_catalog_files(pages: DataFrame, suffix: str = "zip", html: str = "html") -> DataFrame:
    """Download links of a catalogue page, one per titled entry that has one.

    The catalogue is the first ``ul`` of class ``resource-list``, up to the end tag that balances it.
    Its text is cut at each anchor of class ``heading``; the first anchor of class
    ``resource-url-analytics`` in a piece is that entry's download. Entries without a download, or
    whose link does not end with ``suffix``, give no row. A heading needs no title attribute.
    """
    pieces = F.split(_catalogue(F.col(html)), f"(?={_anchor('heading')})")
    entries = pages.select(*_without(pages, html), F.explode(F.slice(pieces, F.lit(2), F.size(pieces))).alias("_entry"))
    download = F.regexp_extract("_entry", f"({_anchor('resource-url-analytics')})", 1)
    link = F.regexp_extract(download, r"""\shref\s*=\s*["']([^"']*)["']""", 1)
    return _named(entries.withColumn("link", link).drop("_entry"), suffix)


def _named(links: DataFrame, suffix: str) -> DataFrame:
    return links.where(F.col("link").endswith(suffix) & (F.col("link") != "")).withColumn(
        "file_name", F.substring_index("link", "/", -1)
    )


def _without(frame: DataFrame, column: str) -> list[str]:
    return [name for name in frame.columns if name != column]


def _tag(name: str, css_class: str) -> str:
    """Pattern of a start tag that carries the class, alone or among others."""
    return rf"""(?i)<{name}\s[^>]*?\bclass\s*=\s*["'](?:[^"']*\s)?{css_class}(?:\s[^"']*)?["'][^>]*>"""


def _anchor(css_class: str) -> str:
    return _tag("a", css_class)


def _catalogue(html: Column) -> Column:
    """Page text from the catalogue's start tag to its balancing end tag."""
    # The added blank makes a page that starts with the catalogue split like any other.
    tail = F.get(F.split(F.concat(F.lit(" "), html), f"(?={_tag('ul', 'resource-list')})", 2), F.lit(1))
    parts = F.split(tail, r"(?i)(?=</?ul\b)")
    zero = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("chars"), F.lit(False).alias("closed"))

    def step(state: Column, part: Column) -> Column:
        depth = state["depth"] + F.when(part.startswith("</"), -1).when(part.startswith("<"), 1).otherwise(0)
        closed = state["closed"] | (depth <= 0)
        return F.struct(
            depth.alias("depth"),
            F.when(closed, state["chars"]).otherwise(state["chars"] + F.length(part)).alias("chars"),
            closed.alias("closed"),
        )

    return F.substring(tail, F.lit(1), F.aggregate(parts, zero, step, lambda state: state["chars"]))
