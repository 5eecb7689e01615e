"""Index pages as a table: every ``<a href>`` of every page, resolved and
checked against the crawl root — one hop of the mirror's listing, for all
pages at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import urls as U

# Markup whose content is not parsed as tags (comments, scripts, styles).
_OPAQUE = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
# A start tag whose quoted values may hold ">" and spaces; its attributes one by one.
_ATTRIBUTE = r"""[^\s"'>/=]+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+))?"""
_ANCHOR = rf"""(?i)<a(?:[\s/]+(?:{_ATTRIBUTE}))*[\s/]*>"""
_VALUE = r"""(?i)[\s/"']href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
_OTHER = r"""(?i)([\s/]+(?!href[\s=])[^\s"'>/=]+)\s*=\s*(?:"[^"]*"|'[^']*')"""

# The character references that occur in attribute values of listings.
_NAMED = {"&quot;": '"', "&apos;": "'", "&lt;": "<", "&gt;": ">", "&nbsp;": "\u00a0"}


def _unescape(value: Column) -> Column:
    """Character references decoded; ``&amp;`` last, so that its result is not decoded again."""
    def number(digits: Column, base: int) -> Column:
        code = F.conv(digits, base, 10).cast("int")
        # UTF-16 surrogates carry code points beyond the first plane.
        high, low = F.floor((code - 0x10000) / 1024) + 0xD800, (code - 0x10000) % 1024 + 0xDC00
        wide = F.concat(F.lpad(F.hex(high.cast("long")), 4, "0"), F.lpad(F.hex(low.cast("long")), 4, "0"))
        return F.decode(F.unhex(F.when(code < 0x10000, F.lpad(F.hex(code.cast("long")), 4, "0")).otherwise(wide)), "UTF-16BE")

    for name, plain in _NAMED.items():
        value = F.replace(value, F.lit(name), F.lit(plain))
    # Numeric references: split at them, decode, join again.
    pieces = F.split(value, r"(?i)(?=&#x?[0-9a-f]{1,6};)")

    def piece(p: Column) -> Column:
        decimal, hexa = F.regexp_extract(p, r"^&#([0-9]{1,6});", 1), F.regexp_extract(p, r"(?i)^&#x([0-9a-f]{1,6});", 1)
        rest = F.regexp_replace(p, r"(?i)^&#x?[0-9a-f]{1,6};", "")
        return F.when(decimal != "", F.concat(number(decimal, 10), rest)).when(
            hexa != "", F.concat(number(hexa, 16), rest)).otherwise(p)

    joined = F.array_join(F.transform(pieces, piece), "")
    return F.replace(F.when(value.contains("&#"), joined).otherwise(value), F.lit("&amp;"), F.lit("&"))


def hrefs(html: Column) -> Column:
    """All non-empty ``href`` values of anchor tags, in document order.

    Quoted values keep their spaces and the other kind of quote; a ``>`` in any
    quoted value does not end the tag; character references are decoded.
    """
    anchors = F.regexp_extract_all(F.regexp_replace(html, _OPAQUE, ""), F.lit(_ANCHOR), F.lit(0))

    def value(tag: Column) -> Column:
        # Other attributes go first: their values may hold text that looks like an href.
        found = F.regexp_extract(F.regexp_replace(tag, _OTHER, " "), _VALUE, 1)
        return F.trim(_unescape(F.regexp_replace(found, r"""^["']|["']$""", "")))

    return F.filter(F.transform(anchors, value), lambda h: h != "")


def page_links(pages: DataFrame, url_col: str = "url", html_col: str = "html", keep=("page_id",)) -> DataFrame:
    return pages.select(*keep, F.col(url_col).alias("page_url"),
                        F.posexplode(hrefs(F.col(html_col))).alias("pos", "href"))


def classify_links(links: DataFrame, root: Column | None = None) -> DataFrame:
    """Resolve each href and decide whether it is a child of the crawl root.

    ``root`` defaults to the site root of each page.
    """
    root = root if root is not None else U.site_root(F.col("page_url"))
    current = U.canonical_directory(F.col("page_url"))
    child = U.resolve(F.col("page_url"), F.col("href"))
    out = links.withColumn("root", root).withColumn("child_url", child)
    return out.withColumn("in_scope", F.coalesce(U.in_scope(F.col("child_url"), F.col("root"), current), F.lit(False))) \
        .withColumn("is_directory", F.col("child_url").endswith("/") | F.col("href").endswith("/"))


def local_files(classified: DataFrame) -> DataFrame:
    """In-scope file links with their decoded local path; one per (root,
    path) — a later link (page, position) replaces an earlier one."""
    files = classified.filter(F.col("in_scope") & ~F.col("is_directory")).withColumn(
        "local_path", U.local_relative(F.col("child_url"), F.col("root"))).filter(
        ~F.col("local_path").isin("", "."))
    return files.groupBy("root", "local_path").agg(
        F.max_by(F.col("child_url"), F.struct("page_id", "pos")).alias("url"))
