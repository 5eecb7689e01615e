"""Registered catalog queries.

* discovery and slugs run over the archive listing derived from ``orders``
  (see ``paths_q``), whose documentation ZIPs and loose span-named
  workbooks are the dictionaries;
* member choice runs over one dictionary ZIP per ``part`` row, its members
  named from the words of ``p_name`` (shape chosen by ``p_partkey % 4``);
* the scored match pairs every microdata record of the listing with one of
  25 dictionaries derived from ``nation`` (scope from the region, visit/topic
  kind, a year or none, some with three-year spans, varied parent folders).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import paths as P
from ..operators import catalog as C
from ..operators import revisions as R
from . import paths_q as PQ
from .common import table


def q_dictionary_discovery(spark, sf_dir):
    found = C.discover_dictionaries(PQ.archive_paths(spark, sf_dir))
    return found.select("path", "member", "scope", "anual_kind", "year",
                        F.array_join(F.col("years").cast("array<string>"), ",").alias("years"))


def dictionary_archives(spark, sf_dir) -> DataFrame:
    part = table(spark, sf_dir, "part")
    pk = F.col("p_partkey")
    words = F.split("p_name", " ")
    w1, w2 = words[0], words[1]
    m4 = pk % 4
    members = (
        F.when(m4 == 0, F.array(F.concat(F.lit("dicionario_"), w1, F.lit(".xls")), F.concat(F.lit("notas_"), w2, F.lit(".xlsx"))))
        .when(m4 == 1, F.array(F.concat(w1, F.lit(".xls")), F.concat(w2, F.lit(".xlsx"))))
        .when(m4 == 2, F.array(F.concat(F.lit("planilha_"), w1, F.lit(".xlsx")), F.lit("leia.txt")))
        .otherwise(F.array(F.concat(F.lit("docs/Layout_"), w1, F.lit(".XLSX")), F.concat(F.lit("input_"), w2, F.lit(".xls"))))
    )
    requested = F.when(pk % 9 == 0, members[0]).when(pk % 11 == 0, F.lit("missing.xls"))
    return part.select(
        F.format_string("originals/trimestral/Documentacao/dic_%05d.zip", pk).alias("archive"),
        members.alias("members"), requested.alias("requested"))


def q_dictionary_member(spark, sf_dir):
    return C.choose_dictionary_member(dictionary_archives(spark, sf_dir)).select("archive", "member", "status")


def _dictionary_sources(spark, sf_dir):
    found = C.discover_dictionaries(PQ.archive_paths(spark, sf_dir))
    source_name = P.file_name(F.coalesce(F.col("member"), F.col("path")))
    return found.withColumn("slug_base", P.slug_base(source_name, F.col("scope"), F.col("anual_kind"), F.col("year")))


def q_layout_slug(spark, sf_dir):
    slugged = C.assign_slugs(_dictionary_sources(spark, sf_dir), ["path", "member_pos"])
    return slugged.select("path", "member", "slug")


def catalog_layouts(spark, sf_dir) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    nk = F.col("n_nationkey")
    scope = F.when(F.col("n_regionkey").isin(0, 1), F.lit("trimestral")).otherwise(F.lit("anual"))
    kind = F.when(scope == "anual", F.when(nk % 3 == 0, F.lit("visita")).when(nk % 3 == 1, F.lit("trimestre")))
    year = F.when(nk % 4 == 0, F.lit(None)).otherwise(nk % 8 + 2012).cast("int")
    years = F.when(year.isNull(), F.array().cast("array<int>")).when(nk % 5 == 1, F.sequence(year, year + 2)) \
        .otherwise(F.array(year))
    folder = (
        F.when(scope == "trimestral", F.lit("originals/trimestral/Documentacao"))
        .when(kind == "visita", F.lit("originals/anual/Visita/Documentacao"))
        .when(kind == "trimestre", F.lit("originals/anual/Trimestre/Documentacao"))
        .otherwise(F.lit("originals/anual/Documentacao"))
    )
    source = F.concat(folder, F.lit("/dicionario_"), F.lower("n_name"), F.lit(".xls"))
    return nation.select(
        F.concat(F.lit("layout-"), nk.cast("string")).alias("layout_id"),
        F.concat(F.lit("metadata/layouts/layout-"), nk.cast("string"), F.lit(".json")).alias("layout"),
        scope.alias("scope"), kind.alias("anual_kind"), year.alias("year"), years.alias("years"),
        source.alias("source"), nk.alias("layout_ord"),
    )


def catalog_data(spark, sf_dir) -> DataFrame:
    records = R.data_records(PQ.archive_paths(spark, sf_dir))
    text = F.concat(F.col("path"), F.lit(" "), F.array_join("text_members", " "))
    return records.select("path_id", F.col("path").alias("source"), "scope", "anual_kind",
                          P.catalog_year(text).alias("year"))


def q_catalog_match(spark, sf_dir):
    matched = C.choose_layouts(catalog_data(spark, sf_dir), catalog_layouts(spark, sf_dir))
    return matched.select("path_id", "layout_id", "score")


QUERIES = {
    "dictionary_discovery": q_dictionary_discovery,
    "dictionary_member": q_dictionary_member,
    "layout_slug": q_layout_slug,
    "catalog_match": q_catalog_match,
}

# ---------------------------------------------------------------- oracle SQL


def _tokens(x: str, tokens) -> str:
    return "(" + " OR ".join(f"contains(lower({x}), '{t}')" for t in tokens) + ")"


_WB = "regexp_matches({x}, '(?i)\\.(xls|xlsx)$')"
_NAME = PQ.sql_name


def _cov(x: str) -> str:
    return PQ.sql_covered_years(x)


_DISCOVERY = f"""
  SELECT DISTINCT path, member, {PQ.sql_scope('path')} AS scope, {PQ.sql_kind('path')} AS anual_kind, year, years,
         member_pos
  FROM (
    SELECT path, CAST(NULL AS VARCHAR) AS member, -1 AS member_pos, {PQ.sql_catalog_year(_NAME('path'))} AS year,
           {_cov(_NAME('path'))} AS years
    FROM ({PQ.PATHS_SQL})
    WHERE NOT {PQ.sql_excluded('path', P.DEFAULT_EXCLUDE)} AND {_WB.format(x=_NAME('path'))}
          AND {_tokens(_NAME('path'), P.DICTIONARY_NAME_TOKENS)}
    UNION ALL
    SELECT path, member, member_pos,
           coalesce({PQ.sql_catalog_year('member')}, {PQ.sql_catalog_year(_NAME('path'))}),
           CASE WHEN {_cov('member')} <> '' THEN {_cov('member')} ELSE {_cov(_NAME('path'))} END
    FROM (SELECT path, unnest(members) AS member, generate_subscripts(members, 1) - 1 AS member_pos
          FROM ({PQ.PATHS_SQL})
          WHERE NOT {PQ.sql_excluded('path', P.DEFAULT_EXCLUDE)} AND lower(path) LIKE '%.zip'
                AND {_tokens(_NAME('path'), P.DICTIONARY_ARCHIVE_TOKENS)})
    WHERE {_WB.format(x='member')} AND {_tokens(_NAME('member'), P.DICTIONARY_NAME_TOKENS)}
  )"""


def _slug_base() -> str:
    src = f"{_NAME('coalesce(member, path)')}"
    cleaned = f"trim(regexp_replace(lower({PQ.sql_stem(src)}), '[^a-z0-9]+', '-', 'g'), '-')"
    return (f"concat_ws('-', scope, anual_kind, CASE WHEN year IS NOT NULL AND year <> 0 THEN CAST(year AS VARCHAR) END, "
            f"{cleaned})")


_ARCH = """
  SELECT printf('originals/trimestral/Documentacao/dic_%05d.zip', p_partkey) AS archive, members,
         CASE WHEN p_partkey % 9 = 0 THEN members[1] WHEN p_partkey % 11 = 0 THEN 'missing.xls' END AS requested
  FROM (SELECT p_partkey, CASE p_partkey % 4
          WHEN 0 THEN ['dicionario_' || string_split(p_name, ' ')[1] || '.xls', 'notas_' || string_split(p_name, ' ')[2] || '.xlsx']
          WHEN 1 THEN [string_split(p_name, ' ')[1] || '.xls', string_split(p_name, ' ')[2] || '.xlsx']
          WHEN 2 THEN ['planilha_' || string_split(p_name, ' ')[1] || '.xlsx', 'leia.txt']
          ELSE ['docs/Layout_' || string_split(p_name, ' ')[1] || '.XLSX', 'input_' || string_split(p_name, ' ')[2] || '.xls'] END
          AS members FROM part)"""

_MEMBER = f"""
  SELECT archive, CASE WHEN status = 'explicit' THEN requested WHEN status = 'chosen' THEN cands[1] END AS member, status
  FROM (
    SELECT *, CASE WHEN requested IS NOT NULL AND list_contains(members, requested) THEN 'explicit'
                   WHEN requested IS NOT NULL THEN 'not found'
                   WHEN len(cands) = 1 THEN 'chosen' ELSE 'ambiguous' END AS status
    FROM (
      SELECT *, CASE WHEN len(tok) > 0 THEN tok ELSE books END AS cands FROM (
        SELECT *, list_filter(books, lambda m: {_tokens(_NAME('m'), P.DICTIONARY_NAME_TOKENS)}) AS tok FROM (
          SELECT *, list_filter(members, lambda m: regexp_matches(m, '(?i)\\.(xls|xlsx)$')) AS books FROM ({_ARCH})))))"""

_LAYOUTS = """
  SELECT 'layout-' || CAST(n_nationkey AS VARCHAR) AS layout_id, scope, anual_kind, year,
         CASE WHEN year IS NULL THEN []::INTEGER[] WHEN n_nationkey % 5 = 1 THEN [year, year + 1, year + 2] ELSE [year] END AS years,
         CASE WHEN scope = 'trimestral' THEN 'originals/trimestral/Documentacao'
              WHEN anual_kind = 'visita' THEN 'originals/anual/Visita/Documentacao'
              WHEN anual_kind = 'trimestre' THEN 'originals/anual/Trimestre/Documentacao'
              ELSE 'originals/anual/Documentacao' END AS folder,
         n_nationkey AS ord
  FROM (SELECT *, CASE WHEN n_regionkey IN (0, 1) THEN 'trimestral' ELSE 'anual' END AS scope,
               CASE WHEN n_regionkey NOT IN (0, 1) THEN CASE n_nationkey % 3 WHEN 0 THEN 'visita' WHEN 1 THEN 'trimestre' END END AS anual_kind,
               CAST(CASE WHEN n_nationkey % 4 = 0 THEN NULL ELSE n_nationkey % 8 + 2012 END AS INTEGER) AS year
        FROM nation)"""

_DATA = f"""
  SELECT path_id, path AS source, scope, anual_kind,
         {PQ.sql_catalog_year("path || ' ' || array_to_string(list_filter(members, lambda m: regexp_matches(m, '(?i)\\.(txt|dat)$') AND NOT suffix(m, '/')), ' ')")} AS year,
         regexp_extract(path, '^(.*)/[^/]*$', 1) AS dparent
  FROM (SELECT *, {PQ.sql_scope('path')} AS scope, {PQ.sql_kind('path')} AS anual_kind FROM ({PQ.PATHS_SQL}))
  WHERE lower(path) LIKE '%.zip' AND NOT {PQ.sql_excluded('path', P.DEFAULT_EXCLUDE)} AND {PQ.sql_is_data('path')}
    AND len(list_filter(members, lambda m: regexp_matches(m, '(?i)\\.(txt|dat)$') AND NOT suffix(m, '/'))) > 0"""


def _positional(a: str, b: str) -> str:
    return (f"coalesce(list_sum(list_transform(range(1, least(len({a}), len({b})) + 1), "
            f"lambda i: CASE WHEN {a}[i] = {b}[i] THEN 1 ELSE 0 END)), 0)")


_MATCH = f"""
  WITH pairs AS (
    SELECT D.path_id, D.scope, D.anual_kind AS dkind, D.year AS dyear,
           CASE WHEN D.dparent = '' THEN []::VARCHAR[] ELSE string_split(D.dparent, '/') END AS dp,
           string_split(L.folder, '/') AS lp, L.layout_id, L.anual_kind AS lkind, L.year AS lyear, L.years, L.ord
    FROM ({_DATA}) D JOIN ({_LAYOUTS}) L ON D.scope = L.scope),
  k AS (
    SELECT *, max(CASE WHEN lkind = dkind THEN 1 ELSE 0 END) OVER (PARTITION BY path_id) AS has_kind FROM pairs),
  narrowed AS (
    SELECT * FROM k WHERE NOT (scope = 'anual' AND dkind IS NOT NULL AND has_kind = 1) OR lkind = dkind),
  y AS (
    SELECT *, coalesce(list_contains(years, dyear) OR lyear = dyear, false) AS exact,
           max(CASE WHEN coalesce(list_contains(years, dyear) OR lyear = dyear, false) THEN 1 ELSE 0 END)
             OVER (PARTITION BY path_id) AS has_exact
    FROM narrowed),
  cands AS (
    SELECT * FROM y
    WHERE NOT (scope = 'anual' AND dyear IS NOT NULL AND dyear <> 0)
       OR (has_exact = 1 AND exact) OR (has_exact = 0 AND lyear IS NULL)),
  scored AS (
    SELECT path_id, layout_id, ord,
           CAST(100 + CASE WHEN dyear IS NOT NULL AND dyear <> 0 AND lyear = dyear THEN 30
                           WHEN dyear IS NOT NULL AND dyear <> 0 AND list_contains(years, dyear) THEN 25
                           WHEN lyear IS NULL THEN 10 ELSE 0 END + {_positional('dp', 'lp')} AS INTEGER) AS score
    FROM cands),
  best AS (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY path_id ORDER BY score DESC, ord) AS rn FROM scored)
    WHERE rn = 1)
  SELECT D.path_id, best.layout_id, best.score FROM ({_DATA}) D LEFT JOIN best ON D.path_id = best.path_id"""

ORACLE = {
    "dictionary_discovery": f"SELECT path, member, scope, anual_kind, year, years FROM ({_DISCOVERY})",
    "dictionary_member": _MEMBER,
    "layout_slug": f"""
        SELECT path, member, CASE WHEN rn = 1 THEN base ELSE base || '-' || CAST(rn AS VARCHAR) END AS slug FROM (
          SELECT path, member, base, row_number() OVER (PARTITION BY base ORDER BY path, member_pos) AS rn
          FROM (SELECT *, {_slug_base()} AS base FROM ({_DISCOVERY})))""",
    "catalog_match": _MATCH,
}
