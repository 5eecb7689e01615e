"""URL expressions for index-page links: split, resolve, contain, localise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_URL = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)"
_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:"


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, _URL, 1))


def netloc(url: Column) -> Column:
    return F.regexp_extract(url, _URL, 2)


def url_path(url: Column) -> Column:
    return F.regexp_extract(url, _URL, 3)


def canonical_directory(url: Column) -> Column:
    """``scheme://netloc/path/`` with query and fragment dropped."""
    path = url_path(url)
    path = F.when(path.endswith("/"), path).otherwise(F.concat(path, F.lit("/")))
    return F.concat(scheme(url), F.lit("://"), netloc(url), path)


def site_root(url: Column) -> Column:
    return F.concat(scheme(url), F.lit("://"), netloc(url), F.lit("/"))


def remove_dot_segments(path: Column) -> Column:
    """RFC 3986 dot-segment removal with a segment stack (exact, linear)."""
    segs = F.split(path, "/")
    stacked = F.aggregate(
        segs,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
        .when(s == ".", acc)
        .otherwise(F.array_append(acc, s)),
    )
    last = F.element_at(segs, -1)
    trailing = F.when(last.isin(".", ".."), F.lit("/")).otherwise(F.lit(""))
    joined = F.concat(F.array_join(stacked, "/"), trailing)
    return F.when(path.startswith("/") & ~joined.startswith("/"), F.concat(F.lit("/"), joined)).otherwise(joined)


def resolve(base: Column, href: Column) -> Column:
    """Resolve ``href`` against the page URL; query and fragment are dropped.

    Fragment/query-only references resolve to nothing (they never name a file).
    """
    base_dir = F.regexp_extract(url_path(base), r"^(.*/)", 1)
    base_origin = F.concat(scheme(base), F.lit("://"), netloc(base))
    target = (
        F.when(href.rlike(_SCHEME), href)
        .when(href.startswith("//"), F.concat(scheme(base), F.lit(":"), href))
        .when(href.startswith("/"), F.concat(base_origin, href))
        .otherwise(F.concat(base_origin, F.when(base_dir == "", F.lit("/")).otherwise(base_dir), href))
    )
    clean = F.concat(scheme(target), F.lit("://"), netloc(target), remove_dot_segments(url_path(target)))
    return F.when((href == "") | href.startswith("?") | href.startswith("#"), F.lit(None)).otherwise(clean)


def unquote(text: Column) -> Column:
    """Percent-decoding that leaves ``+`` alone (``url_decode`` alone would
    turn it into a space) and keeps malformed escapes as they are."""
    return F.coalesce(F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))), text)


def in_scope(child: Column, root: Column, current: Column) -> Column:
    """https only, same host, decoded path under the root, no ``..``
    component, neither the listed directory itself nor the root."""
    cpath = unquote(url_path(child))
    rpath = unquote(url_path(root))
    return (
        child.isNotNull()
        & (scheme(child) == "https")
        & (netloc(child) == netloc(root))
        & cpath.startswith(rpath)
        & ~F.array_contains(F.split(cpath, "/"), "..")
        & (child != current)
        & (F.rtrim(child, F.lit("/")) != F.rtrim(root, F.lit("/")))
    )


def local_relative(child: Column, root: Column) -> Column:
    """Decoded path of ``child`` below ``root``, normalised like a POSIX path."""
    rel = unquote(F.substring(url_path(child), F.length(url_path(root)) + 1, 1 << 30))
    parts = F.filter(F.split(rel, "/"), lambda s: (s != "") & (s != "."))
    return F.array_join(parts, "/")
