"""Registered incremental-maintenance queries.

Inputs are derived from the driver tables so that every case occurs:

* sync: remote listing, manifest and local files from ``orders`` — orders with
  ``o_orderkey % 11 = 0`` are no longer published, ``% 5 = 0`` were never
  recorded, ``% 13 = 0`` are absent on disk; sizes, URLs and ETags are
  perturbed on other residues, and ``% 43 = 0`` are recorded under a survey
  outside the selection;
* conversion: one source per block of 100 order keys of ``lineitem``, with a
  recorded provenance table that is missing, legacy or perturbed per block;
* verify: one mirrored file per ``documents`` row, its digest taken over the
  whole text, with tampered, unhashed, missing and escaping entries;
* unpack: one archive per ``part`` row, members from the words of ``p_name``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import conversion as C
from ..operators import sync as S
from ..operators import unpack as U
from ..operators import verify as V
from .common import table
from .fixed_width_q import LINE_LAYOUT, SOURCE_KEYS, fw_lines
from .paths_q import fmt

SURVEYS = ("trimestral", "anual")

# ------------------------------------------------------------------ sync


def _orders_keys(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    ok = F.col("o_orderkey")
    survey = F.when(ok % 2 == 0, F.lit("trimestral")).otherwise(F.lit("anual"))
    path = fmt("%d/PNADC_%06d.zip", (F.year("o_orderdate") + 17).cast("int"), ok)
    size = (F.col("o_totalprice") * 100).cast("long")
    return o.select("*", survey.alias("_survey"), path.alias("_path"), size.alias("_size"))


def remote_listing(spark, sf_dir) -> DataFrame:
    o = _orders_keys(spark, sf_dir)
    ok = F.col("o_orderkey")
    key = F.concat(F.col("_survey"), F.lit("/"), F.col("_path"))
    return o.filter(ok % 11 != 0).select(
        key.alias("key"), F.col("_survey").alias("survey"), F.col("_path").alias("path"),
        F.concat(F.lit("https://mirror.example/"), key).alias("url"),
        F.when(ok % 17 == 0, F.lit(None)).otherwise(F.col("_size")).alias("size"),
        F.when(ok % 3 == 0, F.lit(None)).otherwise(F.concat(F.lit("e"), F.col("o_custkey").cast("string"))).alias("etag"),
        F.when(ok % 19 == 0, F.lit(None)).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("last_modified"),
    )


def recorded_manifest(spark, sf_dir) -> DataFrame:
    o = _orders_keys(spark, sf_dir)
    ok = F.col("o_orderkey")
    survey = F.when(ok % 43 == 0, F.lit("outro")).otherwise(F.col("_survey"))
    key = F.concat(survey, F.lit("/"), F.col("_path"))
    return o.filter(ok % 5 != 0).select(
        key.alias("key"), survey.alias("survey"), F.col("_path").alias("path"),
        F.when(ok % 23 == 0, F.concat(F.lit("http://old.example/"), key))
        .otherwise(F.concat(F.lit("https://mirror.example/"), key)).alias("url"),
        F.when(ok % 7 == 0, F.col("_size") + 1).otherwise(F.col("_size")).alias("size"),
        F.when(ok % 29 == 0, F.lit("stale")).otherwise(F.concat(F.lit("e"), F.col("o_custkey").cast("string"))).alias("etag"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("last_modified"),
        F.concat(F.lit("originals/"), key).alias("local"),
        F.sha2(key, 256).alias("sha256"),
        F.lit(None).cast("boolean").alias("adopted"),
    )


def local_files(spark, sf_dir) -> DataFrame:
    o = _orders_keys(spark, sf_dir)
    ok = F.col("o_orderkey")
    return o.filter(ok % 13 != 0).select(
        F.concat(F.col("_survey"), F.lit("/"), F.col("_path")).alias("key"),
        F.when(ok % 47 == 0, F.col("_size") - 5).otherwise(F.col("_size")).alias("size"),
        (ok % 53 != 0).alias("readable"),
    )


def fetched(spark, sf_dir) -> DataFrame:
    o = _orders_keys(spark, sf_dir)
    key = F.concat(F.col("_survey"), F.lit("/"), F.col("_path"))
    return o.select(key.alias("key"), F.sha2(F.concat(F.lit("https://mirror.example/"), key), 256).alias("sha256"),
                    (F.col("o_orderkey") % 31 != 0).alias("ok"))


def _plan(spark, sf_dir):
    return S.sync_plan(remote_listing(spark, sf_dir), recorded_manifest(spark, sf_dir), local_files(spark, sf_dir), SURVEYS)


def q_sync_plan(spark, sf_dir):
    return _plan(spark, sf_dir).select("key", "status")


def q_stale_keys(spark, sf_dir):
    return S.stale_keys(remote_listing(spark, sf_dir), recorded_manifest(spark, sf_dir), SURVEYS).select("key")


def q_sync_summary(spark, sf_dir):
    return S.sync_summary(_plan(spark, sf_dir))


def q_manifest_merge(spark, sf_dir):
    merged = S.manifest_merge(recorded_manifest(spark, sf_dir), _plan(spark, sf_dir), fetched(spark, sf_dir))
    return merged.select("key", "url", "size", "sha256", "adopted", "origin")


# ------------------------------------------------------------ conversion


def conversion_sources(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    blocks = li.groupBy(F.expr("l_orderkey div 100").alias("b")).agg(F.count(F.lit(1)).alias("n_lines"))
    b = F.col("b")
    layout = F.when(b % 23 == 0, F.lit(None).cast("string")).otherwise(
        F.format_string("metadata/layouts/trimestral-%d.json", b % 3))
    return blocks.select(
        F.format_string("trimestral/src/PNADC_%05d.parquet", b).alias("output"),
        F.format_string("PNADC_%05d.zip", b).alias("source_name"),
        (F.col("n_lines") * 69).alias("source_size"),
        (F.lit(1600000000000000000) + b * 1000000007).alias("source_mtime_ns"),
        layout.alias("layout"),
        F.sha2(F.coalesce(layout, F.lit("")), 256).alias("layout_sha256"),
        F.when(b % 29 == 0, 2).otherwise(1).alias("n_text"),
        F.when(b % 29 == 0, F.lit(None)).otherwise(F.format_string("PNADC_%05d.txt", b)).alias("member"),
        b,
    )


def recorded_provenance(spark, sf_dir) -> DataFrame:
    exp = C.expected_fingerprint(conversion_sources(spark, sf_dir), None, False, "parquet")
    b, fp = F.col("b"), F.col("fingerprint")
    perturbed = F.struct(
        fp["source_name"],
        F.when(b % 5 == 0, fp["source_size"] + 1).otherwise(fp["source_size"]).alias("source_size"),
        fp["source_mtime_ns"],
        F.when(b % 13 == 0, F.lit("x")).otherwise(fp["layout_sha256"]).alias("layout_sha256"),
        F.when(b % 17 == 0, F.lit("orderkey")).otherwise(fp["columns"]).alias("columns"),
        F.when(b % 19 == 0, F.lit(True)).otherwise(fp["all_string"]).alias("all_string"),
        fp["output_format"], fp["conversion_format_version"],
    )
    return exp.filter(b % 7 != 0).select(
        "output", F.when(b % 11 == 0, F.lit(None)).otherwise(perturbed).alias("fingerprint"))


def _conversion_plan(spark, sf_dir):
    exp = C.expected_fingerprint(conversion_sources(spark, sf_dir), None, False, "parquet")
    # Outputs on disk: every ninth one is gone, recorded or not.
    present = exp.filter(F.col("b") % 9 != 0).select("output")
    return C.conversion_plan(exp, recorded_provenance(spark, sf_dir), present=present)


def q_fingerprint(spark, sf_dir):
    exp = C.expected_fingerprint(conversion_sources(spark, sf_dir), None, False, "parquet")
    return exp.select("output", C.fingerprint_digest(F.col("fingerprint")).alias("fingerprint"))


def q_conversion_plan(spark, sf_dir):
    return _conversion_plan(spark, sf_dir).select("output", "status", "reason")


def q_conversion_summary(spark, sf_dir):
    return C.conversion_summary(_conversion_plan(spark, sf_dir))


def q_provenance_rows(spark, sf_dir):
    from ..sources.fixed_width import parse_lines

    parsed = parse_lines(fw_lines(spark, sf_dir), LINE_LAYOUT, keep=["source"], with_errors=False)
    return C.provenance_rows(parsed, "source", n_columns=len(LINE_LAYOUT.variables))


# ---------------------------------------------------------------- verify


def verify_inputs(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    i = F.col("doc_id")
    local = F.concat(F.lit("originals/docs/"), i.cast("string"), F.lit(".txt"))
    manifest = d.select(
        F.concat(F.lit("docs/"), i.cast("string")).alias("key"),
        F.when(i % 17 == 0, F.concat(F.lit("../outside/"), i.cast("string"), F.lit(".txt"))).otherwise(local).alias("local"),
        F.when(i % 7 == 0, F.octet_length("text") + 1).otherwise(F.octet_length("text")).cast("long").alias("size"),
        F.when(i % 5 == 0, F.lit(None)).when(i % 11 == 0, F.sha2(F.concat("text", F.lit("x")), 256))
        .otherwise(F.sha2("text", 256)).alias("sha256"),
    )
    files = d.filter(i % 13 != 0).select(
        local.alias("local"), F.octet_length("text").cast("long").alias("file_size"), F.sha2("text", 256).alias("digest"))
    return manifest, files


def q_verify_digest(spark, sf_dir):
    manifest, files = verify_inputs(spark, sf_dir)
    return V.verify_files(manifest, files)


def q_verify_summary(spark, sf_dir):
    manifest, files = verify_inputs(spark, sf_dir)
    return V.verify_summary(V.verify_files(manifest, files))


# ---------------------------------------------------------------- unpack


def _archive_col():
    pk = F.col("p_partkey")
    return F.when(pk % 13 == 0, F.format_string("originals/anual/Projecoes_Anteriores/arq_%05d.zip", pk)).otherwise(
        F.format_string("originals/trimestral/%d/arq_%05d.zip", (pk % 7 + 2012).cast("int"), pk))


def unpack_inputs(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    pk = F.col("p_partkey")
    archive = _archive_col()
    size = F.col("p_size") * 1000 + pk
    mtime = F.lit(1700000000000000000) + pk * 1000
    words = F.transform(F.split("p_name", " "), lambda w: F.concat(w, F.lit(".txt")))
    outputs = F.transform(words, lambda m: U.extracted_path(archive, m))
    previous = F.when(pk % 3 == 0, F.array_append(F.slice(outputs, F.lit(2), F.greatest(F.size(outputs), F.lit(1))),
                                                  U.extracted_path(archive, F.concat(F.lit("old_"), F.col("p_brand"), F.lit(".txt"))))
                      ).otherwise(outputs)
    archives = part.filter(pk % 17 != 0).select(archive.alias("archive"), size.alias("size"), mtime.alias("mtime_ns"))
    state = part.filter(pk % 7 != 0).select(
        archive.alias("archive"),
        F.when(pk % 5 == 0, size + 1).otherwise(size).alias("size"),
        F.when(pk % 11 == 0, mtime + 1).otherwise(mtime).alias("mtime_ns"),
        previous.alias("outputs"),
    )
    current = part.filter(pk % 17 != 0).select(archive.alias("archive"), F.explode(outputs).alias("output"))
    return archives, state, current


def q_unpack_plan(spark, sf_dir):
    archives, state, _ = unpack_inputs(spark, sf_dir)
    return U.unpack_plan(archives, state).select("archive", "action")


def q_obsolete_members(spark, sf_dir):
    archives, state, current = unpack_inputs(spark, sf_dir)
    plan = U.unpack_plan(archives, state)
    return U.obsolete_members(plan, current, state).select("archive", "output", "reason")


def q_unsafe_members(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    pk = F.col("p_partkey")
    archive = _archive_col()
    words = part.select(archive.alias("archive"), F.explode(F.split("p_name", " ")).alias("w")).select(
        "archive", F.concat("w", F.lit(".txt")).alias("member"))
    extra = part.select(archive.alias("archive"), F.when(pk % 19 == 0, F.lit("../escape.txt"))
                        .when(pk % 23 == 0, F.lit("/etc/passwd.txt"))
                        .when(pk % 29 == 0, F.lit("dados\\..\\..\\fora.txt"))
                        .when(pk % 31 == 0, F.lit("a/./b/../c.txt")).alias("member")).filter(F.col("member").isNotNull())
    return U.unsafe_members(words.unionByName(extra)).select("archive", "member", "reason")


QUERIES = {
    "sync_plan": q_sync_plan,
    "stale_keys": q_stale_keys,
    "sync_summary": q_sync_summary,
    "manifest_merge": q_manifest_merge,
    "fingerprint": q_fingerprint,
    "conversion_plan": q_conversion_plan,
    "conversion_summary": q_conversion_summary,
    "provenance_rows": q_provenance_rows,
    "verify_digest": q_verify_digest,
    "verify_summary": q_verify_summary,
    "unpack_plan": q_unpack_plan,
    "obsolete_members": q_obsolete_members,
    "unsafe_members": q_unsafe_members,
}

# ---------------------------------------------------------------- oracle SQL

_O = """
  SELECT *, CASE WHEN o_orderkey % 2 = 0 THEN 'trimestral' ELSE 'anual' END AS sv,
         printf('%d/PNADC_%06d.zip', CAST(year(o_orderdate) + 17 AS INTEGER), o_orderkey) AS pth,
         CAST(trunc(o_totalprice * 100) AS BIGINT) AS sz
  FROM orders"""

_R = f"""
  SELECT sv || '/' || pth AS key, 'https://mirror.example/' || sv || '/' || pth AS url,
         CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE sz END AS size,
         CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'e' || CAST(o_custkey AS VARCHAR) END AS etag,
         CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS last_modified
  FROM ({_O}) WHERE o_orderkey % 11 <> 0"""

_M = f"""
  SELECT k AS key, CASE WHEN o_orderkey % 23 = 0 THEN 'http://old.example/' || k ELSE 'https://mirror.example/' || k END AS url,
         CASE WHEN o_orderkey % 7 = 0 THEN sz + 1 ELSE sz END AS size,
         CASE WHEN o_orderkey % 29 = 0 THEN 'stale' ELSE 'e' || CAST(o_custkey AS VARCHAR) END AS etag,
         strftime(o_orderdate, '%Y-%m-%d') AS last_modified, sha256(k) AS sha256, CAST(NULL AS BOOLEAN) AS adopted
  FROM (SELECT *, CASE WHEN o_orderkey % 43 = 0 THEN 'outro' ELSE sv END || '/' || pth AS k FROM ({_O}))
  WHERE o_orderkey % 5 <> 0"""

_L = f"""
  SELECT sv || '/' || pth AS key, CASE WHEN o_orderkey % 47 = 0 THEN sz - 5 ELSE sz END AS size,
         o_orderkey % 53 <> 0 AS readable
  FROM ({_O}) WHERE o_orderkey % 13 <> 0"""

_PLAN = f"""
  SELECT coalesce(R.key, M.key) AS key, R.size AS r_size, R.url AS r_url, R.etag AS r_etag,
         R.last_modified AS r_last_modified,
    CASE
      WHEN R.key IS NULL AND (starts_with(M.key, 'trimestral/') OR starts_with(M.key, 'anual/')) THEN 'stale'
      WHEN R.key IS NULL THEN 'kept'
      WHEN L.key IS NOT NULL AND M.key IS NOT NULL
           AND (R.size IS NULL OR coalesce(L.size = R.size, false))
           AND coalesce(M.url = R.url, false)
           AND (R.etag IS NULL OR coalesce(M.etag = R.etag, false))
           AND (R.last_modified IS NULL OR coalesce(M.last_modified = R.last_modified, false))
           AND (R.size IS NULL OR coalesce(M.size = R.size, false)) THEN 'unchanged'
      WHEN M.key IS NULL AND R.size IS NOT NULL AND L.key IS NOT NULL
           AND coalesce(L.size = R.size, false) AND coalesce(L.readable, false) THEN 'adopt'
      ELSE 'download' END AS status
  FROM ({_R}) R FULL OUTER JOIN ({_M}) M ON R.key = M.key
  LEFT JOIN ({_L}) L ON coalesce(R.key, M.key) = L.key"""

_FETCHED = f"""
  SELECT sv || '/' || pth AS key, sha256('https://mirror.example/' || sv || '/' || pth) AS sha256,
         o_orderkey % 31 <> 0 AS ok FROM ({_O})"""

_SOURCES = """
  SELECT printf('trimestral/src/PNADC_%05d.parquet', b) AS output,
         printf('PNADC_%05d.zip', b) AS source_name, n_lines * 69 AS source_size,
         1600000000000000000 + b * 1000000007 AS source_mtime_ns,
         CASE WHEN b % 23 = 0 THEN NULL ELSE printf('metadata/layouts/trimestral-%d.json', b % 3) END AS layout,
         CASE WHEN b % 29 = 0 THEN 2 ELSE 1 END AS n_text,
         CASE WHEN b % 29 = 0 THEN NULL ELSE printf('PNADC_%05d.txt', b) END AS member, b
  FROM (SELECT l_orderkey // 100 AS b, count(*) AS n_lines FROM lineitem GROUP BY 1)"""

_EXPECTED_FP = f"""
  SELECT *, sha256(coalesce(layout, '')) AS layout_sha256, CAST(NULL AS VARCHAR) AS columns,
         false AS all_string, 'parquet' AS output_format, 1 AS conversion_format_version
  FROM ({_SOURCES})"""

_RECORDED = f"""
  SELECT output, b % 11 = 0 AS legacy,
         source_name AS r_source_name,
         CASE WHEN b % 5 = 0 THEN source_size + 1 ELSE source_size END AS r_source_size,
         source_mtime_ns AS r_source_mtime_ns,
         CASE WHEN b % 13 = 0 THEN 'x' ELSE layout_sha256 END AS r_layout_sha256,
         CASE WHEN b % 17 = 0 THEN 'orderkey' ELSE columns END AS r_columns,
         CASE WHEN b % 19 = 0 THEN true ELSE all_string END AS r_all_string,
         output_format AS r_output_format, conversion_format_version AS r_conversion_format_version
  FROM ({_EXPECTED_FP}) WHERE b % 7 <> 0"""

_CURRENT = " AND ".join(
    f"E.{f} IS NOT DISTINCT FROM R.r_{f}" for f in C.FINGERPRINT_FIELDS
)

_CPLAN = f"""
  SELECT output, CASE WHEN reason IN ('no layout', 'several text members') THEN 'unresolved'
                      WHEN reason = 'current' THEN 'skipped' ELSE 'convert' END AS status, reason
  FROM (
    SELECT E.output,
      CASE WHEN E.layout IS NULL THEN 'no layout'
           WHEN E.member IS NULL AND E.n_text > 1 THEN 'several text members'
           WHEN E.b % 9 = 0 THEN 'output absent'
           WHEN R.output IS NULL THEN 'no record'
           WHEN R.legacy THEN 'legacy record'
           WHEN NOT ({_CURRENT}) THEN 'inputs changed'
           ELSE 'current' END AS reason
    FROM ({_EXPECTED_FP}) E LEFT JOIN ({_RECORDED}) R ON E.output = R.output)"""

_FP_DIGEST = ("sha256(concat_ws(chr(31), source_name, CAST(source_size AS VARCHAR), CAST(source_mtime_ns AS VARCHAR), "
              "layout_sha256, coalesce(columns, ''), coalesce(CAST(all_string AS VARCHAR), ''), output_format, "
              "CAST(conversion_format_version AS VARCHAR)))")

_VMANIFEST = """
  SELECT 'docs/' || CAST(doc_id AS VARCHAR) AS key,
         CASE WHEN doc_id % 17 = 0 THEN '../outside/' || CAST(doc_id AS VARCHAR) || '.txt'
              ELSE 'originals/docs/' || CAST(doc_id AS VARCHAR) || '.txt' END AS local,
         CAST(CASE WHEN doc_id % 7 = 0 THEN strlen(text) + 1 ELSE strlen(text) END AS BIGINT) AS size,
         CASE WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 11 = 0 THEN sha256(text || 'x') ELSE sha256(text) END AS sha256
  FROM documents"""

_VFILES = """
  SELECT 'originals/docs/' || CAST(doc_id AS VARCHAR) || '.txt' AS local, CAST(strlen(text) AS BIGINT) AS file_size,
         sha256(text) AS digest FROM documents WHERE doc_id % 13 <> 0"""

_VERIFY = f"""
  SELECT key,
    CASE WHEN regexp_matches(M.local, '^(/|\\.\\./)') THEN 'failed' WHEN F.local IS NULL THEN 'failed'
         WHEN M.size IS NOT NULL AND F.file_size <> M.size THEN 'failed'
         WHEN length(M.sha256) > 0 AND F.digest <> M.sha256 THEN 'failed'
         WHEN length(M.sha256) > 0 THEN 'ok' ELSE 'unverifiable' END AS status,
    CASE WHEN regexp_matches(M.local, '^(/|\\.\\./)') THEN 'manifest path escapes the repository'
         WHEN F.local IS NULL THEN 'missing'
         WHEN M.size IS NOT NULL AND F.file_size <> M.size THEN printf('size %d != recorded %d', F.file_size, M.size)
         WHEN length(M.sha256) > 0 AND F.digest <> M.sha256 THEN 'sha256 mismatch'
         ELSE '' END AS detail
  FROM ({_VMANIFEST}) M LEFT JOIN ({_VFILES}) F ON M.local = F.local"""

_ARCHIVE = ("CASE WHEN p_partkey % 13 = 0 THEN printf('originals/anual/Projecoes_Anteriores/arq_%05d.zip', p_partkey) "
            "ELSE printf('originals/trimestral/%d/arq_%05d.zip', CAST(p_partkey % 7 + 2012 AS INTEGER), p_partkey) END")


def _extracted(archive: str, member: str) -> str:
    return (f"'extracted/' || regexp_replace(regexp_replace({archive}, '^originals/', ''), '(?i)\\.zip$', '') "
            f"|| '/' || replace({member}, '\\', '/')")


_PART_A = f"""
  SELECT *, {_ARCHIVE} AS archive, p_size * 1000 + p_partkey AS size0,
         1700000000000000000 + p_partkey * 1000 AS mtime0,
         list_transform(string_split(p_name, ' '), lambda w: {_extracted(_ARCHIVE, "w || '.txt'")}) AS outs
  FROM part"""

_UPLAN = f"""
  SELECT A.archive, S.outputs AS previous_outputs,
    CASE WHEN contains(lower(A.archive), 'projecoes_anteriores') THEN 'excluded'
         WHEN S.archive IS NULL OR S.size <> A.size OR S.mtime_ns <> A.mtime_ns THEN 'process'
         ELSE 'skip' END AS action
  FROM (SELECT archive, size0 AS size, mtime0 AS mtime_ns FROM ({_PART_A}) WHERE p_partkey % 17 <> 0) A
  LEFT JOIN (
    SELECT archive, CASE WHEN p_partkey % 5 = 0 THEN size0 + 1 ELSE size0 END AS size,
           CASE WHEN p_partkey % 11 = 0 THEN mtime0 + 1 ELSE mtime0 END AS mtime_ns,
           CASE WHEN p_partkey % 3 = 0
                THEN list_append(outs[2:], {_extracted('archive', "'old_' || p_brand || '.txt'")})
                ELSE outs END AS outputs
    FROM ({_PART_A}) WHERE p_partkey % 7 <> 0) S ON A.archive = S.archive"""

_STATE = f"""
  SELECT archive, CASE WHEN p_partkey % 3 = 0
                THEN list_append(outs[2:], {_extracted('archive', "'old_' || p_brand || '.txt'")})
                ELSE outs END AS outputs
  FROM ({_PART_A}) WHERE p_partkey % 7 <> 0"""

_CURRENT_MEMBERS = f"SELECT archive, unnest(outs) AS output FROM ({_PART_A}) WHERE p_partkey % 17 <> 0"

_OBSOLETE = f"""
  SELECT archive, output, 'dropped member' AS reason FROM (
    SELECT archive, unnest(previous_outputs) AS output FROM ({_UPLAN}) WHERE action = 'process') P
  WHERE NOT EXISTS (SELECT 1 FROM ({_CURRENT_MEMBERS}) C WHERE C.archive = P.archive AND C.output = P.output)
  UNION ALL
  SELECT archive, unnest(outputs) AS output, 'archive removed' AS reason FROM ({_STATE}) S
  WHERE NOT EXISTS (SELECT 1 FROM ({_UPLAN}) A WHERE A.archive = S.archive)"""

_MEMBERS = f"""
  SELECT {_ARCHIVE} AS archive, unnest(string_split(p_name, ' ')) || '.txt' AS member FROM part
  UNION ALL
  SELECT archive, member FROM (
    SELECT {_ARCHIVE} AS archive,
      CASE WHEN p_partkey % 19 = 0 THEN '../escape.txt' WHEN p_partkey % 23 = 0 THEN '/etc/passwd.txt'
           WHEN p_partkey % 29 = 0 THEN 'dados\\..\\..\\fora.txt' WHEN p_partkey % 31 = 0 THEN 'a/./b/../c.txt'
      END AS member FROM part) WHERE member IS NOT NULL"""

ORACLE = {
    "sync_plan": f"SELECT key, status FROM ({_PLAN})",
    "stale_keys": f"""SELECT key FROM ({_M}) M WHERE (starts_with(key, 'trimestral/') OR starts_with(key, 'anual/'))
                      AND NOT EXISTS (SELECT 1 FROM ({_R}) R WHERE R.key = M.key)""",
    "sync_summary": f"""SELECT status, count(*) AS files, CAST(coalesce(sum(r_size), 0) AS BIGINT) AS bytes
                        FROM ({_PLAN}) GROUP BY status""",
    "manifest_merge": f"""
        WITH P AS ({_PLAN}), U AS (
          SELECT key, r_url AS url, r_size AS size, CAST(NULL AS VARCHAR) AS sha256, true AS adopted, 'adopted' AS origin
          FROM P WHERE status = 'adopt'
          UNION ALL
          SELECT P.key, r_url, r_size, F.sha256, CAST(NULL AS BOOLEAN), 'downloaded'
          FROM P JOIN ({_FETCHED}) F ON P.key = F.key WHERE status = 'download' AND F.ok)
        SELECT key, url, size, sha256, adopted, 'kept' AS origin FROM ({_M}) M
        WHERE NOT EXISTS (SELECT 1 FROM U WHERE U.key = M.key)
        UNION ALL SELECT * FROM U""",
    "fingerprint": f"SELECT output, {_FP_DIGEST} AS fingerprint FROM ({_EXPECTED_FP})",
    "conversion_plan": _CPLAN,
    "conversion_summary": f"SELECT status, count(*) AS files FROM ({_CPLAN}) GROUP BY status",
    "provenance_rows": f"""
        SELECT 'lineitem_' || CAST(l_orderkey // {SOURCE_KEYS} AS VARCHAR) || '.txt' AS source, count(*) AS rows,
               7 AS columns, CAST(NULL AS VARCHAR) AS variables
        FROM lineitem GROUP BY 1""",
    "verify_digest": _VERIFY,
    "verify_summary": f"""
        SELECT count(*) AS checked,
               CAST(sum(CASE WHEN status = 'ok' THEN 1 ELSE 0 END) AS BIGINT) AS ok,
               CAST(sum(CASE WHEN status = 'failed' THEN 1 ELSE 0 END) AS BIGINT) AS failed,
               CAST(sum(CASE WHEN status = 'unverifiable' THEN 1 ELSE 0 END) AS BIGINT) AS unverifiable
        FROM ({_VERIFY})""",
    "unpack_plan": f"SELECT archive, action FROM ({_UPLAN})",
    "obsolete_members": _OBSOLETE,
    "unsafe_members": f"""
        SELECT archive, member,
          CASE WHEN starts_with(replace(member, '\\', '/'), '/') OR regexp_matches(replace(member, '\\', '/'), '^[A-Za-z]:/')
               THEN 'absolute path'
               WHEN list_contains(string_split(replace(member, '\\', '/'), '/'), '..') THEN 'parent traversal' END AS reason
        FROM ({_MEMBERS}) WHERE reason IS NOT NULL""",
}
