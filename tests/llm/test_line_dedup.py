from collections import defaultdict

from helpers import LOWER, WHITE, corpus, sha
from pyspark.sql import functions as F

from wavefold.llm import line_dedup


def key(line):
    return line.strip(WHITE).translate(LOWER)


def brute(rows, least=10):
    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least:
                holders[key(line)].add(doc)
    out = {}
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(holders[key(x)]) < 2 or min(holders[key(x)]) == doc]
        out[doc] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def result(df):
    return {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept_text"]) for r in df.collect()}


def test_against_brute_force(make):
    rows = corpus()
    expected = brute([(r[0], r[1]) for r in rows])
    assert any(v[1] for v in expected.values())
    for batches, fanout in ((4, 2), (1, 2), (7, 3)):
        assert result(line_dedup.line_dedup(make(rows), batches=batches, fanout=fanout)) == expected


def test_all_lines_of_the_smallest_document_stay(make):
    rows = [(2, "A shared line\nA shared line\nx", "", "", 0), (1, "a SHARED line \nown\na shared line", "", "", 0)]
    got = result(line_dedup.line_dedup(make(rows)))
    assert got == {1: (3, 0, rows[1][1]), 2: (3, 2, "x")}


def test_null_ids_repeated_rows_and_clashing_columns(make):
    rows = [(None, "a line that is shared", "", "", 0), (5, "a line that is shared", "", "", 0),
            (5, "a line that is shared", "", "", 0), (9, "a line that is shared\nrest", "", "", 0)]
    docs = make(rows)
    for name in ("_doc", "_key", "_drop", "_lines", "_text_key", "h1", "owner", "pos", "line", "n_lines"):
        docs = docs.withColumn(name, F.lit("extra"))
    out = line_dedup.line_dedup(docs)
    assert {"_doc", "_drop", "owner"} <= set(out.columns) and out.columns.count("n_lines") == 1
    got = sorted(((r["doc_id"] or -1, r["n_dropped"], r["kept_text"], r["_doc"]) for r in out.collect()))
    assert got == [(-1, 0, rows[0][1], "extra"), (5, 0, rows[1][1], "extra"), (5, 0, rows[1][1], "extra"), (9, 1, "rest", "extra")]


def test_empty_table(make):
    assert line_dedup.line_dedup(make([])).count() == 0


def test_runs_are_compacted_by_levels(make, spark):
    runs = line_dedup.LineRuns(fanout=2)
    for n in range(4):
        batch = spark.range(n * 5, n * 5 + 10).selectExpr("id AS h1", "id AS h2", f"CAST({n} AS BIGINT) AS owner", f"CAST({n} AS BIGINT) AS last")
        shared = {r["h1"]: r["owner"] for r in runs.merge(batch).collect()}
        assert shared == {h: n - 1 for h in range(n * 5, n * 5 + 5)} if n else shared == {}
    assert [len(level) for level in runs.levels] == [0, 0, 1]
    assert runs.levels[2][0].count() == 25


def test_query_digest(spark, make, tmp_path):
    rows = corpus(seed=9, groups=4)
    make(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: tuple(r)[1:] for r in line_dedup.op1_line_dedup(spark, str(tmp_path)).collect()}
    assert got == {d: (n, g, sha(t)) for d, (n, g, t) in brute([(r[0], r[1]) for r in rows]).items()}
