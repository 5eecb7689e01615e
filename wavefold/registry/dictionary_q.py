"""Registered dictionary queries over a worksheet grid built from
``customer ⋈ nation ⋈ region``.

One document per (nation, block of 50,000 customer keys), so a document stays
bounded like a real worksheet while the number of documents grows with the
data.  Each document starts with three header rows and a ``Parte <region>``
section; every customer contributes a variable row (start ``3*ck+1``, width
``1 + ck % 20``, name ``V<ck>``), followed by category continuation rows whose
shape depends on ``ck % 4``; customers with ``ck % 50 = 0`` open a new
``Bloco`` section, ``ck % 6 = 0`` add an ignored junk row and ``ck % 97 = 0``
add a second variable with the same name.  One extra document per region holds
only header rows (a dictionary without variables).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dictionary as D
from ..operators.layout import layout_table_from_json
from ..plans.sinks import write_layout_documents
from ..session import staging_path
from .common import table

HEADERS = ["PNAD Contínua", "Dicionário das variáveis", "Microdados"]
BLOCK = 50_000


def _row(row_no, c0="", c1="", c2="", c3="", c4="", c5="", c6="", c7=""):
    def lit(v):
        return v if not isinstance(v, str) else F.lit(v)

    return F.struct(
        row_no.cast("long").alias("row_no"),
        *[lit(v).cast("string").alias(f"c{i}") for i, v in enumerate([c0, c1, c2, c3, c4, c5, c6, c7])],
    )


def _zero_pad(text, width: int):
    """Left zero padding that never truncates (``lpad`` cuts longer text)."""
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def grid_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    base = cust.join(nation, cust.c_nationkey == nation.n_nationkey).join(
        region, nation.n_regionkey == region.r_regionkey)
    ck = F.col("c_custkey")
    doc = (F.col("n_nationkey").cast("long") * 1_000_000_000 + F.expr(f"c_custkey div {BLOCK}")).alias("doc_id")
    seg = F.col("c_mktsegment")
    r = F.lit(10) + ck * 8
    m4 = ck % 4
    variable = _row(
        r, _zero_pad((ck * 3 + 1).cast("string"), 4), (ck % 20 + 1).cast("string"),
        F.concat(F.lit("V"), ck.cast("string")), F.lpad((ck % 9).cast("string"), 2, "0"),
        F.concat(F.lit('  "Cliente"   '), F.col("c_name")),
        F.when(m4 == 0, F.lit("1")).when(m4 == 1, F.lit("Código de segmento"))
        .when(m4 == 2, F.concat(F.lit("Texto livre "), seg)).otherwise(F.lit("")),
        F.when(m4 == 0, seg).when(m4 == 1, seg).when(m4 == 2, F.lit("nota")).otherwise(F.lit("")),
        F.when(ck % 2 == 0, F.lit("2012-atual")).otherwise(F.lit("2015-2019")),
    )
    rows = F.array(
        F.when(ck % 50 == 0, _row(r - 1, F.concat(F.lit("Bloco "), ck.cast("string")))),
        variable,
        F.when(m4 == 0, _row(r + 1, c5="2", c6="Outro"))
        .when(m4 == 2, _row(r + 1, c5="9", c6="ignorado"))
        .when(m4 == 3, _row(r + 1, c5="0", c6="")),
        F.when(m4 == 0, _row(r + 2, c5="", c6="Ignorado")).when(m4 == 3, _row(r + 2, c5="03", c6=seg)),
        F.when(m4 == 0, _row(r + 3, c5="2", c6="Outro Final")),
        F.when(ck % 6 == 0, _row(r + 4, c0="Total", c1="5")),
        F.when(ck % 97 == 0, _row(r + 5, (ck * 3 + 2).cast("string"), "2",
                                  F.concat(F.lit("v"), ck.cast("string")), c4="duplicada")),
    )
    body = base.select(doc, F.explode(rows).alias("cell")).filter(F.col("cell").isNotNull()).select("doc_id", "cell.*")
    docs = base.select(doc, F.col("r_name")).distinct()
    head_rows = F.array(*[_row(F.lit(i), h) for i, h in enumerate(HEADERS)],
                        _row(F.lit(3), F.concat(F.lit("Parte "), F.col("r_name"))))
    heads = docs.select("doc_id", F.explode(head_rows).alias("cell")).select("doc_id", "cell.*")
    empty_docs = region.select((F.lit(10 ** 15) + F.col("r_regionkey")).cast("long").alias("doc_id"),
                               F.explode(F.array(*[_row(F.lit(i), h) for i, h in enumerate(HEADERS)])).alias("cell")
                               ).select("doc_id", "cell.*")
    return body.unionByName(heads).unionByName(empty_docs)


def parsed(spark, sf_dir):
    return D.parse_grid(grid_cells(spark, sf_dir))


def q_dictionary_parse(spark, sf_dir):
    v = parsed(spark, sf_dir)
    return v.select(
        "doc_id", "name", "start", "width", "end", "label", "section", "question", "period", "storage_type",
        "category_note",
        F.when(F.col("categories").isNotNull(), F.size("categories")).alias("n_categories"),
        D.categories_text(F.col("categories")).alias("categories"),
    )


def q_layout_validate(spark, sf_dir):
    cells = grid_cells(spark, sf_dir)
    return D.layout_problems(D.parse_grid(cells), cells).select("doc_id", "name", "occurrences", "problem")


def q_layout_plan(spark, sf_dir):
    digests = D.document_digest(grid_cells(spark, sf_dir))
    d = F.col("doc_id")
    recorded = digests.filter(d % 3 != 0).select(
        "doc_id", F.when(d % 4 == 0, F.lit("old")).otherwise(F.col("dictionary_sha256")).alias("dictionary_sha256"))
    return D.layout_plan(digests, recorded).select("doc_id", "dictionary_sha256", "action")


def q_layout_table(spark, sf_dir):
    target = staging_path(spark, "layouts")
    write_layout_documents(parsed(spark, sf_dir), target)
    return layout_table_from_json(spark, target).select("layout_id", "pos", "name", "start", "width", "end",
                                                        "storage_type")


QUERIES = {
    "dictionary_parse": q_dictionary_parse,
    "layout_validate": q_layout_validate,
    "layout_plan": q_layout_plan,
    "layout_table": q_layout_table,
}

# ---------------------------------------------------------------- oracle SQL

_BASE = f"""
  SELECT c_custkey AS ck, c_name, c_mktsegment AS seg, r_name,
         CAST(n_nationkey AS BIGINT) * 1000000000 + c_custkey // {BLOCK} AS doc_id
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""

_VARS = f"""
  SELECT doc_id, ck, 0 AS sub, 'v' || CAST(ck AS VARCHAR) AS name, CAST(ck * 3 + 1 AS INTEGER) AS start,
         CAST(ck % 20 + 1 AS INTEGER) AS width, CAST(ck * 3 + 1 + ck % 20 AS INTEGER) AS "end",
         CAST(ck % 9 AS VARCHAR) AS question, 'cliente ' || lower(c_name) AS label,
         CASE WHEN blk IS NULL THEN 'parte ' || lower(r_name) ELSE 'bloco ' || CAST(blk AS VARCHAR) END AS section,
         CASE WHEN ck % 2 = 0 THEN '2012-atual' ELSE '2015-2019' END AS period,
         CASE WHEN ck % 4 = 2 THEN 'texto livre ' || lower(seg) || ', nota' END AS category_note,
         CASE ck % 4 WHEN 0 THEN 3 WHEN 1 THEN 1 WHEN 2 THEN NULL ELSE 1 END AS n_categories,
         CASE ck % 4 WHEN 0 THEN '1=' || lower(seg) || ';2=outro final;vazio=ignorado'
                     WHEN 1 THEN 'Código de segmento=' || lower(seg)
                     WHEN 2 THEN NULL ELSE '3=' || lower(seg) END AS categories
  FROM (SELECT *, max(CASE WHEN ck % 50 = 0 THEN ck END)
                    OVER (PARTITION BY doc_id ORDER BY ck ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS blk
        FROM ({_BASE}))
  UNION ALL
  SELECT doc_id, ck, 1, 'v' || CAST(ck AS VARCHAR), CAST(ck * 3 + 2 AS INTEGER), 2, CAST(ck * 3 + 3 AS INTEGER),
         '', 'duplicada',
         CASE WHEN blk IS NULL THEN 'parte ' || lower(r_name) ELSE 'bloco ' || CAST(blk AS VARCHAR) END,
         '', NULL, 0, ''
  FROM (SELECT *, max(CASE WHEN ck % 50 = 0 THEN ck END)
                    OVER (PARTITION BY doc_id ORDER BY ck ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS blk
        FROM ({_BASE})) WHERE ck % 97 = 0"""

_STORAGE = """CASE WHEN width = 15 THEN 'float64' WHEN width <= 2 THEN 'int8' WHEN width <= 4 THEN 'int16'
                   WHEN width <= 9 THEN 'int32' WHEN width <= 18 THEN 'int64' ELSE 'string' END"""


def _cell_rows() -> str:
    """The grid itself, for the digest oracle (same cells as ``grid_cells``)."""
    r = "(10 + ck * 8)"
    rows = [
        f"SELECT doc_id, {r} - 1 AS row_no, 'Bloco ' || CAST(ck AS VARCHAR) AS c0, '' c1, '' c2, '' c3, '' c4, '' c5, '' c6, '' c7 FROM B WHERE ck % 50 = 0",
        f"""SELECT doc_id, {r}, CASE WHEN length(CAST(ck * 3 + 1 AS VARCHAR)) >= 4 THEN CAST(ck * 3 + 1 AS VARCHAR) ELSE lpad(CAST(ck * 3 + 1 AS VARCHAR), 4, '0') END, CAST(ck % 20 + 1 AS VARCHAR),
                   'V' || CAST(ck AS VARCHAR), lpad(CAST(ck % 9 AS VARCHAR), 2, '0'), '  "Cliente"   ' || c_name,
                   CASE ck % 4 WHEN 0 THEN '1' WHEN 1 THEN 'Código de segmento' WHEN 2 THEN 'Texto livre ' || seg ELSE '' END,
                   CASE ck % 4 WHEN 0 THEN seg WHEN 1 THEN seg WHEN 2 THEN 'nota' ELSE '' END,
                   CASE WHEN ck % 2 = 0 THEN '2012-atual' ELSE '2015-2019' END FROM B""",
        f"SELECT doc_id, {r} + 1, '', '', '', '', '', '2', 'Outro', '' FROM B WHERE ck % 4 = 0",
        f"SELECT doc_id, {r} + 1, '', '', '', '', '', '9', 'ignorado', '' FROM B WHERE ck % 4 = 2",
        f"SELECT doc_id, {r} + 1, '', '', '', '', '', '0', '', '' FROM B WHERE ck % 4 = 3",
        f"SELECT doc_id, {r} + 2, '', '', '', '', '', '', 'Ignorado', '' FROM B WHERE ck % 4 = 0",
        f"SELECT doc_id, {r} + 2, '', '', '', '', '', '03', seg, '' FROM B WHERE ck % 4 = 3",
        f"SELECT doc_id, {r} + 3, '', '', '', '', '', '2', 'Outro Final', '' FROM B WHERE ck % 4 = 0",
        f"SELECT doc_id, {r} + 4, 'Total', '5', '', '', '', '', '', '' FROM B WHERE ck % 6 = 0",
        f"""SELECT doc_id, {r} + 5, CAST(ck * 3 + 2 AS VARCHAR), '2', 'v' || CAST(ck AS VARCHAR), '', 'duplicada', '', '', ''
            FROM B WHERE ck % 97 = 0""",
    ]
    docs = "SELECT DISTINCT doc_id, r_name FROM B"
    for i, h in enumerate(HEADERS):
        rows.append(f"SELECT doc_id, {i}, '{h}', '', '', '', '', '', '', '' FROM ({docs})")
        rows.append(f"SELECT CAST(1000000000000000 + r_regionkey AS BIGINT), {i}, '{h}', '', '', '', '', '', '', '' FROM region")
    rows.append(f"SELECT doc_id, 3, 'Parte ' || r_name, '', '', '', '', '', '', '' FROM ({docs})")
    return f"WITH B AS ({_BASE}) " + " UNION ALL ".join(rows)


_DIGEST = f"""
  SELECT doc_id, sha256(string_agg(concat_ws(chr(31), c0, c1, c2, c3, c4, c5, c6, c7), chr(10) ORDER BY row_no))
         AS dictionary_sha256
  FROM ({_cell_rows()}) GROUP BY doc_id"""

ORACLE = {
    "dictionary_parse": f"""
        SELECT doc_id, name, start, width, "end", label, section, question, period, {_STORAGE} AS storage_type,
               category_note, n_categories, categories
        FROM ({_VARS})""",
    "layout_validate": f"""
        SELECT doc_id, name, count(*) AS occurrences, 'duplicate name' AS problem
        FROM ({_VARS}) GROUP BY doc_id, name HAVING count(*) > 1
        UNION ALL
        SELECT CAST(1000000000000000 + r_regionkey AS BIGINT), CAST(NULL AS VARCHAR), CAST(0 AS BIGINT), 'no variables' FROM region""",
    "layout_plan": f"""
        SELECT doc_id, dictionary_sha256,
               CASE WHEN doc_id % 3 = 0 OR doc_id % 4 = 0 THEN 'parse' ELSE 'keep' END AS action
        FROM ({_DIGEST})""",
    "layout_table": f"""
        SELECT CAST(doc_id AS VARCHAR) AS layout_id,
               CAST(row_number() OVER (PARTITION BY doc_id ORDER BY ck, sub) - 1 AS INTEGER) AS pos,
               name, start, width, "end", {_STORAGE} AS storage_type
        FROM ({_VARS})""",
}
