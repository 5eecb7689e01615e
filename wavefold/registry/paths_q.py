"""Registered path queries over an archive listing derived from ``orders``.

Every order becomes one archive path whose shape is chosen by
``o_orderkey % 10`` (quarterly with and without a revision date, annual visit
and topic files, a documentation archive, a superseded-tree file, an upper
case extension, a loose dictionary with a year span).  Years are the order
year + 17, the quarter is the order quarter, ``lote`` directories come from
the customer key, and the revision is ``20`` + six digits of the order key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import paths as P
from ..functions.text import human_size
from ..operators import revisions as R
from .common import table

# (kind, path format, path args, member formats with their args)
TEMPLATES = [
    ((0, 1, 2), "originals/trimestral/%d/lote_%d/PNADC_0%d%d_%s.zip", ("Y", "B", "Q", "Y", "REV"),
     [("PNADC_0%d%d.txt", ("Q", "Y"))]),
    ((3,), "originals/trimestral/%d/lote_%d/PNADC_0%d%d.zip", ("Y", "B", "Q", "Y"),
     [("PNADC_0%d%d.txt", ("Q", "Y"))]),
    ((4,), "originals/anual/Visita/Visita_%d/%d/PNADC_%d_visita%d_%s.zip", ("V", "Y", "Y", "V", "REV"),
     [("PNADC_%d_visita%d.txt", ("Y", "V"))]),
    ((5,), "originals/anual/Trimestre/Trimestre_%d/PNADC_%d_trimestre%d.zip", ("T", "Y", "T"),
     [("PNADC_%d_trimestre%d.txt", ("Y", "T"))]),
    ((6,), "originals/trimestral/Documentacao/Dicionario_e_input_%d_%s.zip", ("Y", "REV"),
     [("dicionario_PNADC_microdados_%d.xls", ("Y",)), ("input_PNADC_%d.txt", ("Y",))]),
    ((7,), "originals/anual/Projecoes_Anteriores/%d/PNADC_0%d%d_%s.zip", ("Y", "Q", "Y", "REV"),
     [("PNADC_0%d%d.txt", ("Q", "Y"))]),
    ((8,), "originals/trimestral/%d/lote_%d/PNADC_0%d%d_%s.ZIP", ("Y", "B", "Q", "Y", "REV"),
     [("PNADC_0%d%d.txt", ("Q", "Y"))]),
    ((9,), "originals/anual/Visita/Documentacao/dicionario_PNADC_microdados_%d_a_%d_visita%d.xls",
     ("Y", "Y2", "V"), []),
]
DATA_KINDS = (0, 1, 2, 3, 4, 5, 7, 8)


def _spark_args():
    y = (F.year("o_orderdate") + 17).cast("int")
    return {
        "Y": y, "Y2": y + 2, "Q": F.quarter("o_orderdate"),
        "B": (F.col("o_custkey") % 50).cast("int"),
        "V": (F.col("o_custkey") % 5 + 1).cast("int"),
        "T": (F.col("o_custkey") % 4 + 1).cast("int"),
        "REV": F.concat(F.lit("20"), F.lpad((F.col("o_orderkey") % 1000000).cast("string"), 6, "0")),
    }


def fmt(template: str, *args):
    """``printf``-style ``%d``/``%0Nd``/``%s`` formatting with concat/lpad
    (``format_string`` goes through java.util.Formatter per row, which is
    far slower); the output is identical for the non-negative values used."""
    import re as _re

    parts, pos, i = [], 0, 0
    for m in _re.finditer(r"%(0(\d+))?([ds])", template):
        if m.start() > pos:
            parts.append(F.lit(template[pos:m.start()]))
        text = args[i].cast("string")
        if m.group(2):
            width = int(m.group(2))
            text = F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))
        parts.append(text)
        pos, i = m.end(), i + 1
    if pos < len(template):
        parts.append(F.lit(template[pos:]))
    return F.concat(*parts)


def archive_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``path_id, path, members ARRAY<STRING>, size`` for every order."""
    orders = table(spark, sf_dir, "orders")
    args = _spark_args()
    kind = (F.col("o_orderkey") % 10).cast("int")
    path, members = None, None
    for kinds, fmt, names, member_fmts in TEMPLATES:
        cond = kind.isin(list(kinds))
        p = globals()["fmt"](fmt, *[args[n] for n in names])
        m = F.array(*[globals()["fmt"](f, *[args[n] for n in ns]) for f, ns in member_fmts]) if member_fmts \
            else F.array().cast("array<string>")
        path = F.when(cond, p) if path is None else path.when(cond, p)
        members = F.when(cond, m) if members is None else members.when(cond, m)
    ok = F.col("o_orderkey")
    members = (
        F.when(ok % 37 == 0, F.array(F.lit("notas.pdf")))
        .when((ok % 31 == 0) & kind.isin(list(DATA_KINDS)), F.array_append(members, F.lit("LEIA_ME.txt")))
        .otherwise(members)
    )
    return orders.select(
        ok.alias("path_id"), path.alias("path"), members.alias("members"),
        (F.col("o_totalprice") * 100).cast("long").alias("size"),
    )


def _joined(arr):
    return F.array_join(arr, "|")


def q_period_from_path(spark, sf_dir):
    df = archive_paths(spark, sf_dir)
    return df.select("path_id", P.period_year(F.col("path")).alias("year"),
                     P.period_quarter(F.col("path")).alias("quarter"))


def _catalog_text(df):
    texts = F.filter("members", P.is_text_member)
    return F.concat(F.col("path"), F.lit(" "), F.array_join(texts, " "))


def q_catalog_period(spark, sf_dir):
    df = archive_paths(spark, sf_dir)
    text = _catalog_text(df)
    return df.select("path_id", P.catalog_year(text).alias("year"), P.catalog_quarter(text).alias("quarter"))


def q_revision_key(spark, sf_dir):
    df = archive_paths(spark, sf_dir)
    name = P.file_name(F.col("path"))
    return df.select("path_id", P.revision_key(name).alias("revision"),
                     P.output_stem(P.stem(name)).alias("output_stem"))


def q_flat_name(spark, sf_dir):
    df = archive_paths(spark, sf_dir)
    return df.select("path_id", P.flat_name(P.file_name(F.col("path")), P.scope(F.col("path"))).alias("flat_name"))


def q_output_placement(spark, sf_dir):
    df = archive_paths(spark, sf_dir)
    sc = P.scope(F.col("path"))
    return df.select(
        "path_id",
        P.nested_output(F.col("path"), sc).alias("nested_output"),
        F.concat(F.lit("parquet/"), P.flat_name(P.file_name(F.col("path")), sc), F.lit(".parquet")).alias("flat_output"),
    )


def q_path_classify(spark, sf_dir):
    df = archive_paths(spark, sf_dir)
    return df.select("path_id", P.scope(F.col("path")).alias("scope"), P.anual_kind(F.col("path")).alias("anual_kind"))


def q_covered_years(spark, sf_dir):
    df = archive_paths(spark, sf_dir)
    names = F.filter(F.array_prepend("members", P.file_name(F.col("path"))), P.is_dictionary_name)
    exploded = df.select("path_id", F.posexplode(names).alias("pos", "name"))
    return exploded.select("path_id", "pos", "name",
                           F.array_join(P.covered_years(F.col("name")).cast("array<string>"), ",").alias("years"))


def q_portable_path(spark, sf_dir):
    df = archive_paths(spark, sf_dir)
    absolute = F.when(F.col("path_id") % 13 == 0, F.concat(F.lit("/elsewhere/"), F.col("path"))) \
        .otherwise(F.concat(F.lit("/archive/"), F.col("path")))
    return df.select("path_id", P.portable_path(absolute, "/archive/").alias("portable"))


CUSTOM_EXCLUDE = ["projecoes_anteriores", "LOTE_1/", "visita\\visita_3"]


def _windowsish(df):
    # Some listings arrive with Windows separators.
    return F.when(F.col("path_id") % 4 == 0, F.translate(F.col("path"), "/", "\\")).otherwise(F.col("path"))


def q_exclude_paths(spark, sf_dir):
    df = archive_paths(spark, sf_dir)
    p = _windowsish(df)
    return df.select(
        "path_id",
        P.excluded(p, P.check_exclusions(None)).alias("excluded_default"),
        P.excluded(p, P.check_exclusions(CUSTOM_EXCLUDE)).alias("excluded_custom"),
        P.excluded(p, P.without_default(CUSTOM_EXCLUDE)).alias("excluded_with_superseded"),
        P.excluded(p, P.check_exclusions([])).alias("excluded_none"),
    )


def q_period_filter(spark, sf_dir):
    df = archive_paths(spark, sf_dir)
    survey = P.scope(F.col("path"))
    return df.select(
        "path_id",
        P.period_selected(F.col("path"), survey, [2013, 2015], None).alias("by_year"),
        P.period_selected(F.col("path"), survey, [2013, 2015], [1, 4]).alias("by_year_quarter"),
        P.period_selected(F.col("path"), survey, None, [2]).alias("by_quarter"),
    )


def q_data_file_filter(spark, sf_dir):
    df = archive_paths(spark, sf_dir)
    return df.select("path_id", P.is_data_file(F.col("path")).alias("is_data"))


def q_human_size(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    size = F.when(F.col("o_orderkey") % 29 == 0, F.lit(None)).otherwise(
        F.col("o_totalprice").cast("long") * F.col("o_orderkey") * 1013
    )
    return orders.select(F.col("o_orderkey").alias("path_id"), size.alias("size"), human_size(size).alias("human"))


def _records(spark, sf_dir):
    return R.data_records(archive_paths(spark, sf_dir))


def q_latest_revision(spark, sf_dir):
    chosen = R.latest_revision(_records(spark, sf_dir), "parquet", flat=False)
    return chosen.select("path_id", "output_key")


def q_latest_revision_flat(spark, sf_dir):
    chosen = R.latest_revision(_records(spark, sf_dir), "parquet", flat=True)
    return chosen.select("path_id", "output_key")


def q_batch_filter(spark, sf_dir):
    chosen = R.latest_revision(_records(spark, sf_dir), "parquet", flat=False)
    return R.batch_filter(chosen, scope="trimestral", years=[2013, 2014], quarters=[2, 3]).select(
        "path_id", "scope", "year", "quarter"
    )


QUERIES = {
    "period_from_path": q_period_from_path,
    "catalog_period": q_catalog_period,
    "revision_key": q_revision_key,
    "flat_name": q_flat_name,
    "output_placement": q_output_placement,
    "path_classify": q_path_classify,
    "covered_years": q_covered_years,
    "portable_path": q_portable_path,
    "exclude_paths": q_exclude_paths,
    "period_filter": q_period_filter,
    "data_file_filter": q_data_file_filter,
    "human_size": q_human_size,
    "latest_revision": q_latest_revision,
    "latest_revision_flat": q_latest_revision_flat,
    "batch_filter": q_batch_filter,
}

# ---------------------------------------------------------------- oracle SQL

_SQL_ARGS = {
    "Y": "CAST(year(o_orderdate) + 17 AS INTEGER)",
    "Y2": "CAST(year(o_orderdate) + 19 AS INTEGER)",
    "Q": "CAST(quarter(o_orderdate) AS INTEGER)",
    "B": "CAST(o_custkey % 50 AS INTEGER)",
    "V": "CAST(o_custkey % 5 + 1 AS INTEGER)",
    "T": "CAST(o_custkey % 4 + 1 AS INTEGER)",
    "REV": "'20' || lpad(CAST(o_orderkey % 1000000 AS VARCHAR), 6, '0')",
}


def _sql_paths() -> str:
    path_cases, member_cases = [], []
    for kinds, fmt, names, member_fmts in TEMPLATES:
        cond = f"o_orderkey % 10 IN ({', '.join(map(str, kinds))})"
        path_cases.append(f"WHEN {cond} THEN printf('{fmt}', {', '.join(_SQL_ARGS[n] for n in names)})")
        items = [f"printf('{f}', {', '.join(_SQL_ARGS[n] for n in ns)})" for f, ns in member_fmts]
        member_cases.append(f"WHEN {cond} THEN {'[' + ', '.join(items) + ']' if items else '[]::VARCHAR[]'}")
    base_members = f"CASE {' '.join(member_cases)} END"
    members = (
        f"CASE WHEN o_orderkey % 37 = 0 THEN ['notas.pdf'] "
        f"WHEN o_orderkey % 31 = 0 AND o_orderkey % 10 IN ({', '.join(map(str, DATA_KINDS))}) "
        f"THEN list_append({base_members}, 'LEIA_ME.txt') ELSE {base_members} END"
    )
    return f"""
        SELECT o_orderkey AS path_id, CASE {' '.join(path_cases)} END AS path, {members} AS members,
               CAST(trunc(o_totalprice * 100) AS BIGINT) AS size
        FROM orders"""


PATHS_SQL = _sql_paths()


def sql_name(p: str) -> str:
    return f"regexp_extract({p}, '[^/]*$', 0)"


def sql_stem(n: str) -> str:
    return f"regexp_extract({n}, '^(.+?)(\\.[^.]*)?$', 1)"


def sql_scope(p: str) -> str:
    return (f"CASE WHEN contains(lower({p}), 'trimestral') THEN 'trimestral' "
            f"WHEN contains(lower({p}), 'anual') THEN 'anual' ELSE 'unknown' END")


def sql_kind(p: str) -> str:
    return (f"CASE WHEN contains(lower({p}), 'visita') THEN 'visita' "
            f"WHEN contains(lower({p}), 'trimestre') THEN 'trimestre' END")


def sql_period_year(p: str) -> str:
    from_dir = (f"list_filter(string_split({p}, '/')[1:len(string_split({p}, '/')) - 1], "
                f"lambda x: regexp_full_match(x, '20[0-9]{{2}}'))[1]")
    from_name = f"nullif(regexp_extract({sql_name(p)}, '(?i)pnadc_(?:0?[1-4])?(20[0-9]{{2}})(?:_|\\.|$)', 1), '')"
    return f"CAST(coalesce({from_dir}, {from_name}) AS INTEGER)"


def sql_period_quarter(p: str) -> str:
    return f"CAST(nullif(regexp_extract({sql_name(p)}, '(?i)pnadc_0?([1-4])(20[0-9]{{2}})(?:_|\\.|$)', 1), '') AS INTEGER)"


def sql_catalog_year(t: str) -> str:
    return f"CAST(nullif(regexp_extract({t}, '(?:^|[^0-9])(20[0-9]{{2}})(?:[^0-9]|$)', 1), '') AS INTEGER)"


def sql_catalog_quarter(t: str) -> str:
    low = f"lower({t})"
    a = f"nullif(regexp_extract({low}, '(?:^|[_./-])([1-4])(?:tri|t)?[_./-]?(20[0-9]{{2}})', 1), '')"
    b = f"nullif(regexp_extract({low}, '(?:^|[_./-])(20[0-9]{{2}})[_./-]?([1-4])(?:t|tri)?', 2), '')"
    c = f"nullif(regexp_extract({low}, '(?:^|[_./-])0?([1-4])(20[0-9]{{2}})(?:[_./-]|$)', 1), '')"
    return f"CAST(coalesce({a}, {b}, {c}) AS INTEGER)"


def sql_output_stem(s: str) -> str:
    return f"regexp_replace({s}, '(?i)_20[0-9]{{6}}$', '')"


def sql_flat_name(n: str, scope: str) -> str:
    s = sql_output_stem(sql_stem(n))
    q = "(?i)^PNADC_(0?[1-4])(20[0-9]{2})$"
    a = "(?i)^PNADC_(20[0-9]{2})_(visita[0-9]|trimestre[0-9])$"
    return (
        f"CASE WHEN regexp_matches({s}, '{q}') THEN 'pnadc.microdados.trimestral.' || regexp_extract({s}, '{q}', 2)"
        f" || '.' || CAST(CAST(regexp_extract({s}, '{q}', 1) AS INTEGER) AS VARCHAR)"
        f" WHEN regexp_matches({s}, '{a}') THEN 'pnadc.microdados.anual.' || lower(regexp_extract({s}, '{a}', 2))"
        f" || '.' || regexp_extract({s}, '{a}', 1)"
        f" ELSE 'pnadc.microdados.' || CASE WHEN {scope} = 'anual' THEN 'anual' ELSE 'trimestral' END"
        f" || '.' || lower({s}) END"
    )


def sql_excluded(p: str, fragments) -> str:
    if not fragments:
        return "false"
    low = f"lower(replace({p}, '\\', '/'))"
    return "(" + " OR ".join(f"contains({low}, '{f.lower()}')" for f in fragments) + ")"


def sql_is_data(p: str) -> str:
    name = f"lower({sql_name(p)})"
    by_name = " OR ".join(f"contains({name}, '{t}')" for t in P.NON_DATA_NAME_TOKENS)
    dirs = ", ".join(f"'{d}'" for d in P.DOCUMENTATION_DIRS)
    return f"NOT ({by_name} OR list_has_any(string_split(lower({p}), '/'), [{dirs}]))"


def sql_shared(p: str) -> str:
    return "(" + " OR ".join(f"contains(lower({p}), '{t}')" for t in P.SHARED_DOCUMENT_TOKENS) + ")"


def sql_period_selected(p: str, survey: str, years, quarters) -> str:
    keep = "true"
    if years:
        keep += f" AND ({sql_shared(p)} OR coalesce({sql_period_year(p)} IN ({', '.join(map(str, years))}), false))"
    if quarters:
        keep += (f" AND ({sql_shared(p)} OR {survey} <> 'trimestral' OR "
                 f"coalesce({sql_period_quarter(p)} IN ({', '.join(map(str, quarters))}), false))")
    return keep


def sql_covered_years(n: str) -> str:
    span = "(?:^|[^0-9])(20[0-9]{2})_[aA]_(20[0-9]{2})(?:[^0-9]|$)"
    first = f"CAST(nullif(regexp_extract({n}, '{span}', 1), '') AS INTEGER)"
    last = f"CAST(nullif(regexp_extract({n}, '{span}', 2), '') AS INTEGER)"
    single = sql_catalog_year(n)
    return (f"CASE WHEN {first} IS NOT NULL AND {first} <= {last} "
            f"THEN array_to_string(list_transform(range({first}, {last} + 1), lambda x: CAST(x AS VARCHAR)), ',') "
            f"WHEN {single} IS NOT NULL THEN CAST({single} AS VARCHAR) ELSE '' END")


def sql_human_size(size: str) -> str:
    units = ["B", "KiB", "MiB", "GiB", "TiB"]
    parts = []
    for power, unit in enumerate(units):
        scaled = f"(CAST({size} AS DOUBLE) / {float(1024 ** power)})"
        fmt = f"printf('%.1f {unit}', {scaled})"
        parts.append(f"WHEN {scaled} < 1024 THEN {fmt}" if unit != "TiB" else f"ELSE {fmt}")
    return f"CASE WHEN {size} IS NULL THEN 'unknown' {' '.join(parts)} END"


_TEXT = "path || ' ' || array_to_string(list_filter(members, lambda m: regexp_matches(m, '(?i)\\.(txt|dat)$') AND NOT suffix(m, '/')), ' ')"

_RECORDS = f"""
    SELECT path_id, path, scope, anual_kind, year, quarter, n_text,
           {sql_name('path')} AS name,
           regexp_extract({sql_stem(sql_name('path'))}, '(?i)_(20[0-9]{{6}})$', 1) AS revision
    FROM (
      SELECT path_id, path, {sql_scope('path')} AS scope, {sql_kind('path')} AS anual_kind,
             {sql_period_year('path')} AS year, {sql_period_quarter('path')} AS quarter,
             len(list_filter(members, lambda m: regexp_matches(m, '(?i)\\.(txt|dat)$') AND NOT suffix(m, '/'))) AS n_text
      FROM ({PATHS_SQL})
      WHERE lower(path) LIKE '%.zip' AND NOT {sql_excluded('path', P.DEFAULT_EXCLUDE)} AND {sql_is_data('path')}
    ) WHERE n_text > 0
"""

_NESTED_KEY = (f"scope || '/' || regexp_extract(path, '^(.*)/[^/]*$', 1) || '/' || "
               f"{sql_output_stem(sql_stem(sql_name('path')))} || '.parquet'")
_FLAT_KEY = f"{sql_flat_name(sql_name('path'), 'scope')} || '.parquet'"


def _latest(key: str) -> str:
    return f"""
        SELECT path_id, output_key, scope, year, quarter FROM (
          SELECT *, {key} AS output_key,
                 row_number() OVER (PARTITION BY {key} ORDER BY revision DESC, name DESC, path_id) AS rn
          FROM ({_RECORDS})) WHERE rn = 1"""


ORACLE = {
    "period_from_path": f"SELECT path_id, {sql_period_year('path')} AS year, {sql_period_quarter('path')} AS quarter FROM ({PATHS_SQL})",
    "catalog_period": f"SELECT path_id, {sql_catalog_year(_TEXT)} AS year, {sql_catalog_quarter(_TEXT)} AS quarter FROM ({PATHS_SQL})",
    "revision_key": f"""SELECT path_id, regexp_extract({sql_stem(sql_name('path'))}, '(?i)_(20[0-9]{{6}})$', 1) AS revision,
                               {sql_output_stem(sql_stem(sql_name('path')))} AS output_stem FROM ({PATHS_SQL})""",
    "flat_name": f"SELECT path_id, {sql_flat_name(sql_name('path'), sql_scope('path'))} AS flat_name FROM ({PATHS_SQL})",
    "output_placement": f"""
        SELECT path_id,
          concat_ws('/', scope, nullif(regexp_extract(CASE WHEN starts_with(path, 'originals/' || scope || '/')
                 THEN substr(path, length('originals/' || scope || '/') + 1) END, '^(.*)/[^/]*$', 1), ''),
                 {sql_output_stem(sql_stem(sql_name('path')))}) AS nested_output,
          'parquet/' || {sql_flat_name(sql_name('path'), 'scope')} || '.parquet' AS flat_output
        FROM (SELECT *, {sql_scope('path')} AS scope FROM ({PATHS_SQL}))""",
    "path_classify": f"SELECT path_id, {sql_scope('path')} AS scope, {sql_kind('path')} AS anual_kind FROM ({PATHS_SQL})",
    "covered_years": f"""
        SELECT path_id, CAST(pos AS INTEGER) AS pos, name, {sql_covered_years('name')} AS years FROM (
          SELECT path_id, generate_subscripts(names, 1) - 1 AS pos, unnest(names) AS name FROM (
            SELECT path_id, list_filter(list_prepend({sql_name('path')}, members),
                   lambda x: contains(lower(x), 'dicion') OR contains(lower(x), 'input') OR contains(lower(x), 'layout')) AS names
            FROM ({PATHS_SQL})))""",
    "portable_path": f"""
        SELECT path_id, CASE WHEN starts_with(ap, '/archive/') THEN substr(ap, 10) ELSE ap END AS portable FROM (
          SELECT path_id, CASE WHEN path_id % 13 = 0 THEN '/elsewhere/' || path ELSE '/archive/' || path END AS ap
          FROM ({PATHS_SQL}))""",
    "exclude_paths": f"""
        SELECT path_id,
          {sql_excluded('p', P.DEFAULT_EXCLUDE)} AS excluded_default,
          {sql_excluded('p', CUSTOM_EXCLUDE)} AS excluded_custom,
          {sql_excluded('p', P.without_default(CUSTOM_EXCLUDE))} AS excluded_with_superseded,
          false AS excluded_none
        FROM (SELECT path_id, CASE WHEN path_id % 4 = 0 THEN replace(path, '/', '\\') ELSE path END AS p FROM ({PATHS_SQL}))""",
    "period_filter": f"""
        SELECT path_id,
          {sql_period_selected('path', 'survey', [2013, 2015], None)} AS by_year,
          {sql_period_selected('path', 'survey', [2013, 2015], [1, 4])} AS by_year_quarter,
          {sql_period_selected('path', 'survey', None, [2])} AS by_quarter
        FROM (SELECT *, {sql_scope('path')} AS survey FROM ({PATHS_SQL}))""",
    "data_file_filter": f"SELECT path_id, {sql_is_data('path')} AS is_data FROM ({PATHS_SQL})",
    "human_size": f"""
        SELECT path_id, size, {sql_human_size('size')} AS human FROM (
          SELECT o_orderkey AS path_id,
                 CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE CAST(trunc(o_totalprice) AS BIGINT) * o_orderkey * 1013 END AS size
          FROM orders)""",
    "latest_revision": f"SELECT path_id, output_key FROM ({_latest(_NESTED_KEY)})",
    "latest_revision_flat": f"SELECT path_id, output_key FROM ({_latest(_FLAT_KEY)})",
    "batch_filter": f"""
        SELECT path_id, scope, year, quarter FROM ({_latest(_NESTED_KEY)})
        WHERE scope = 'trimestral' AND year IN (2013, 2014) AND quarter IN (2, 3)""",
}
