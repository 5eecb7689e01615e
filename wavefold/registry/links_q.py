"""Registered link queries over the ``pages`` table (every page, whole HTML)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import pages as PG
from .common import table


def _links(spark, sf_dir):
    return PG.page_links(table(spark, sf_dir, "pages"))


def q_page_links(spark, sf_dir):
    return _links(spark, sf_dir).select("page_id", F.col("pos").cast("int").alias("pos"), "href")


def q_links_in_scope(spark, sf_dir):
    c = PG.classify_links(_links(spark, sf_dir))
    return c.select("page_id", F.col("pos").cast("int").alias("pos"), "child_url", "in_scope")


def q_link_local_path(spark, sf_dir):
    return PG.local_files(PG.classify_links(_links(spark, sf_dir))).select("root", "local_path", "url")


# Link forms beside those of the table: markup and the href it holds, both with the page's id.
FORMS = [
    ('<a href="a b{id}.zip">', "a b{id}.zip"),
    ("<a title=\"x>y\" href='q\"{id}.zip'>", 'q"{id}.zip'),
    ("<a class=k href=\"it's{id}.zip\">", "it's{id}.zip"),
    ('<a href="../up{id}.zip">', "../up{id}.zip"),
    ('<a href="s%2Ft{id}.zip">', "s%2Ft{id}.zip"),
    ("<a href=p+q{id}.zip>", "p+q{id}.zip"),
    ('<a href="c&amp;d&#38;&#xE7;{id}.zip">', "c&d&ç{id}.zip"),
    ('<A data-href="no" HREF = "./sub/{id}/" >', "./sub/{id}/"),
]


def q_page_link_forms(spark, sf_dir):
    """Every page with a list of links of other forms in place of its text."""
    number = F.col("page_id").cast("string")
    parts = [F.replace(F.lit(markup), F.lit("{id}"), number) for markup, _ in FORMS]
    listing = table(spark, sf_dir, "pages").select("page_id", "url", F.concat(*parts, F.lit("<a name=x>")).alias("html"))
    return PG.page_links(listing).select("page_id", F.col("pos").cast("int").alias("pos"), "href")


QUERIES = {
    "page_link_forms": q_page_link_forms,
    "page_links": q_page_links,
    "links_in_scope": q_links_in_scope,
    "link_local_path": q_link_local_path,
}

# ---------------------------------------------------------------- oracle SQL

_HREFS = r"""
  SELECT page_id, url AS page_url, CAST(generate_subscripts(hs, 1) - 1 AS INTEGER) AS pos, unnest(hs) AS href FROM (
    SELECT page_id, url, list_filter(list_transform(regexp_extract_all(
             regexp_replace(html, '(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>', '', 'g'),
             '(?i)<a\s(?:[^>]*?\s)?href\s*=\s*["'']?([^"''\s>]*)', 1), lambda h: replace(h, '&amp;', '&')),
             lambda h: h <> '') AS hs
    FROM pages)"""

_U = "'^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)'"

_CLASSIFIED = f"""
  SELECT *, coalesce(child_url IS NOT NULL AND lower(regexp_extract(child_url, {_U}, 1)) = 'https'
           AND regexp_extract(child_url, {_U}, 2) = regexp_extract(root, {_U}, 2)
           AND starts_with(url_decode(regexp_extract(child_url, {_U}, 3)), url_decode(regexp_extract(root, {_U}, 3)))
           AND NOT list_contains(string_split(url_decode(regexp_extract(child_url, {_U}, 3)), '/'), '..')
           AND child_url <> cur AND rtrim(child_url, '/') <> rtrim(root, '/'), false) AS in_scope
  FROM (
    SELECT page_id, pos, href,
      lower(regexp_extract(page_url, {_U}, 1)) || '://' || regexp_extract(page_url, {_U}, 2) || '/' AS root,
      lower(regexp_extract(page_url, {_U}, 1)) || '://' || regexp_extract(page_url, {_U}, 2) ||
        CASE WHEN suffix(regexp_extract(page_url, {_U}, 3), '/') THEN regexp_extract(page_url, {_U}, 3)
             ELSE regexp_extract(page_url, {_U}, 3) || '/' END AS cur,
      CASE WHEN href = '' OR starts_with(href, '?') OR starts_with(href, '#') THEN NULL
           WHEN starts_with(href, '/') AND NOT starts_with(href, '//')
             THEN lower(regexp_extract(page_url, {_U}, 1)) || '://' || regexp_extract(page_url, {_U}, 2) ||
                  regexp_extract(href, '^([^?#]*)', 1)
      END AS child_url
    FROM ({_HREFS}))"""

_FORMS = " UNION ALL ".join(
    f"SELECT page_id, {n} AS pos, replace('{href.replace(chr(39), chr(39) * 2)}', '{{id}}', CAST(page_id AS VARCHAR)) AS href FROM pages"
    for n, (_, href) in enumerate(FORMS))

ORACLE = {
    "page_link_forms": _FORMS,
    "page_links": f"SELECT page_id, pos, href FROM ({_HREFS})",
    "links_in_scope": f"SELECT page_id, pos, child_url, in_scope FROM ({_CLASSIFIED})",
    "link_local_path": f"""
        SELECT root, local_path, arg_max(child_url, page_id * 100000 + pos) AS url FROM (
          SELECT *, array_to_string(list_filter(string_split(url_decode(
                   substr(regexp_extract(child_url, {_U}, 3), length(regexp_extract(root, {_U}, 3)) + 1)), '/'),
                   lambda s: s <> '' AND s <> '.'), '/') AS local_path
          FROM ({_CLASSIFIED}) WHERE in_scope AND NOT suffix(child_url, '/') AND NOT suffix(href, '/'))
        WHERE local_path NOT IN ('', '.')
        GROUP BY root, local_path""",
}
