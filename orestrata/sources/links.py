"""Discovery of the files a listing page offers, as a job over a table of pages."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orestrata.functions.urls import anchor_hrefs, percent_decoded, resolved_parts, url_parts
from orestrata.session import staged
from orestrata.sources.contracts import told


class EmptyListing(ValueError):
    """A listing without links: refusing to read it as a mass deletion."""


def discover_links(pages: DataFrame, base: Column, html: str = "html", keep: tuple[str, ...] = ()) -> DataFrame:
    """Direct children of each page's base folder -> (keep.., name, url), one row per page and name.

    Of several links that decode to one name, the last in the document counts. A link counts if it has the base's scheme and host, no query and no fragment, and its decoded
    name below the base path is a plain file name: no slash, no backslash, no leading dot.
    """
    links = pages.select(*keep, base.alias("_base"), F.posexplode(anchor_hrefs(F.col(html))).alias("_at", "_href"))
    links = links.select(
        *keep, "_at", url_parts(F.col("_base")).alias("b"), resolved_parts(F.col("_base"), F.col("_href")).alias("u")
    )
    rest = F.substring(F.col("u.path"), F.length("b.path") + 1, F.length("u.path"))
    return (
        links.filter(
            (F.col("u.scheme") == F.lower("b.scheme"))
            & (F.col("u.authority") == F.col("b.authority"))
            & (F.col("u.query") == "")
            & (F.col("u.fragment") == "")
            & F.col("u.path").startswith(F.col("b.path"))
        )
        .select(
            *keep,
            "_at",
            percent_decoded(rest).alias("name"),
            F.concat("u.scheme", F.lit("://"), "u.authority", "u.path").alias("url"),
        )
        .filter((F.col("name") != "") & ~F.col("name").rlike(r"[/\\]|\A\."))
        .groupBy(*keep, "name")
        .agg(F.max_by("url", "_at").alias("url"))
    )


def listing_of(pages: DataFrame, base: Column, key: str, html: str = "html") -> DataFrame:
    """The checked listing of every page: its links with their place in the order of names. A page without any link
    fails the job. Only the small link rows are stored, so that the check and the reader see the same."""
    links = staged(pages.sparkSession, discover_links(pages, base, html, (key,)), "links")
    require_links(pages, links, key)
    place = F.row_number().over(Window.partitionBy(key).orderBy("name"))
    return links.withColumn("place", place)


def pages_without_links(pages: DataFrame, links: DataFrame, key: str) -> DataFrame:
    return pages.select(key).join(links.select(key).distinct(), key, "left_anti")


def require_links(pages: DataFrame, links: DataFrame, key: str) -> None:
    """Raise if any listing came back empty."""
    bare = pages_without_links(pages, links, key)
    if not bare.isEmpty():
        raise EmptyListing(told("no links on", bare, key))
