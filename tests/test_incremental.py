import pytest
from pyspark.sql import functions as F

from wavefold.operators import conversion as C
from wavefold.operators import sync as S
from wavefold.operators import unpack as U
from wavefold.operators import verify as V

REMOTE = "key string, survey string, path string, url string, size long, etag string, last_modified string"
MANIFEST = "key string, survey string, path string, url string, size long, etag string, last_modified string, " \
           "local string, sha256 string, adopted boolean"
LOCAL = "key string, size long, readable boolean"


def test_adopt_then_unchanged_wrong_size_and_unreadable(spark):
    remote = spark.createDataFrame([
        ("trimestral/a.zip", "trimestral", "a.zip", "https://h/a.zip", 10, "e1", "d1"),
        ("trimestral/b.zip", "trimestral", "b.zip", "https://h/b.zip", 10, None, None),
        ("trimestral/c.zip", "trimestral", "c.zip", "https://h/c.zip", 10, None, None),
    ], REMOTE)
    empty = spark.createDataFrame([], MANIFEST)
    local = spark.createDataFrame([("trimestral/a.zip", 10, True), ("trimestral/b.zip", 9, True),
                                   ("trimestral/c.zip", 10, False)], LOCAL)
    plan = {r["key"]: r["status"] for r in S.sync_plan(remote, empty, local).collect()}
    assert plan == {"trimestral/a.zip": "adopt", "trimestral/b.zip": "download", "trimestral/c.zip": "download"}
    fetched = spark.createDataFrame([("trimestral/b.zip", "abc", True), ("trimestral/c.zip", None, False)],
                                    "key string, sha256 string, ok boolean")
    merged = S.manifest_merge(empty, S.sync_plan(remote, empty, local), fetched)
    got = {r["key"]: (r["origin"], r["sha256"], r["adopted"]) for r in merged.collect()}
    assert got == {"trimestral/a.zip": ("adopted", None, True), "trimestral/b.zip": ("downloaded", "abc", None)}
    # Second run with the merged manifest: the adopted file is unchanged.
    local2 = spark.createDataFrame([("trimestral/a.zip", 10, True), ("trimestral/b.zip", 10, True)], LOCAL)
    plan2 = {r["key"]: r["status"] for r in S.sync_plan(remote, merged.drop("origin"), local2).collect()}
    assert plan2["trimestral/a.zip"] == "unchanged" and plan2["trimestral/b.zip"] == "unchanged"


def test_stale_only_within_selected_surveys(spark):
    remote = spark.createDataFrame([], REMOTE)
    manifest = spark.createDataFrame([
        ("anual/x.zip", "anual", "x.zip", "u", 1, None, None, "l", None, None),
        ("outro/y.zip", "outro", "y.zip", "u", 1, None, None, "l", None, None)], MANIFEST)
    assert [r["key"] for r in S.stale_keys(remote, manifest).collect()] == ["anual/x.zip"]
    with pytest.raises(ValueError, match="partial"):
        S.stale_keys(remote, manifest, period_filtered=True)


def test_verify_statuses(spark):
    manifest = spark.createDataFrame([
        ("k1", "a.zip", 3, "h"), ("k2", "b.zip", 3, None), ("k3", "c.zip", 4, "h"),
        ("k4", "../out.zip", 3, "h"), ("k5", "gone.zip", 3, "h"), ("k6", "d.zip", 3, "h")],
        "key string, local string, size long, sha256 string")
    files = spark.createDataFrame([("a.zip", 3, "h"), ("b.zip", 3, None), ("c.zip", 3, "h"), ("d.zip", 3, "x")],
                                  "local string, file_size long, digest string")
    got = {r["key"]: (r["status"], r["detail"]) for r in V.verify_files(manifest, files).collect()}
    assert got["k1"] == ("ok", "") and got["k2"][0] == "unverifiable"
    assert got["k3"] == ("failed", "size 3 != recorded 4")
    assert got["k4"] == ("failed", "manifest path escapes the repository")
    assert got["k5"] == ("failed", "missing") and got["k6"] == ("failed", "sha256 mismatch")
    deep = spark.createDataFrame([("b.zip", True, None)], "local string, crc_ok boolean, bad_member string")
    got = {r["key"]: r["status"] for r in V.verify_files(manifest, files, deep).collect()}
    assert got["k2"] == "ok"
    summary = V.verify_summary(V.verify_files(manifest, files)).first()
    assert (summary["checked"], summary["ok"], summary["failed"], summary["unverifiable"]) == (6, 1, 4, 1)


def test_escape_detection(spark):
    df = spark.createDataFrame([("a/../b",), ("a/../../b",), ("/abs",), ("./x",)], "p string")
    assert [r[0] for r in df.select(V.escapes_root(F.col("p"))).collect()] == [False, True, True, False]


def test_conversion_currency(spark):
    sources = spark.createDataFrame([("o1", "s1.zip", 10, 5, "h", "layout", 1, "m"),
                                     ("o2", "s2.zip", 10, 5, "h", "layout", 1, "m"),
                                     ("o3", "s3.zip", 10, 5, "h", None, 1, "m"),
                                     ("o4", "s4.zip", 10, 5, "h", "layout", 2, None)],
                                    "output string, source_name string, source_size long, source_mtime_ns long, "
                                    "layout_sha256 string, layout string, n_text int, member string")
    exp = C.expected_fingerprint(sources, None, False, "parquet")
    recorded = exp.filter(F.col("output") == "o1").select("output", "fingerprint")
    got = {r["output"]: r["status"] for r in C.conversion_plan(exp, recorded).collect()}
    assert got == {"o1": "skipped", "o2": "convert", "o3": "unresolved", "o4": "unresolved"}
    flipped = C.expected_fingerprint(sources, ["B", "a"], False, "parquet")
    got = {r["output"]: r["reason"] for r in C.conversion_plan(flipped, recorded).collect()}
    assert got["o1"] == "inputs changed"
    csv = C.expected_fingerprint(sources, None, True, "csv").first()["fingerprint"]
    assert csv["all_string"] is None


def test_member_lists_are_not_broadcast(spark, tmpdir_path):
    names = ["a/x.txt", "a/y.txt"]
    spark.createDataFrame([("a.zip", 1, 1)], "archive string, size long, mtime_ns long").write.parquet(f"{tmpdir_path}/archives")
    spark.createDataFrame([("a.zip", 2, 1, names), ("b.zip", 1, 1, ["b/z.txt"])],
                          "archive string, size long, mtime_ns long, outputs array<string>").write.parquet(f"{tmpdir_path}/state")
    spark.createDataFrame([("a.zip", "a/x.txt")], "archive string, output string").write.parquet(f"{tmpdir_path}/current")
    archives, state, current = (spark.read.parquet(f"{tmpdir_path}/{t}") for t in ("archives", "state", "current"))
    found = U.obsolete_members(U.unpack_plan(archives, state), current, state)
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(tuple(r) for r in found.collect()) == [("a.zip", "a/y.txt", "dropped member"), ("b.zip", "b/z.txt", "archive removed")]


def test_unpack_plan_and_obsolete(spark):
    archives = spark.createDataFrame([("a.zip", 1, 1), ("b.zip", 2, 2), ("Projecoes_Anteriores/c.zip", 1, 1)],
                                     "archive string, size long, mtime_ns long")
    state = spark.createDataFrame([("a.zip", 1, 1, ["x/1", "x/2"]), ("b.zip", 2, 3, ["y/1", "y/old"]),
                                   ("gone.zip", 1, 1, ["z/1"])],
                                  "archive string, size long, mtime_ns long, outputs array<string>")
    plan = U.unpack_plan(archives, state)
    assert {r["archive"]: r["action"] for r in plan.collect()} == {
        "a.zip": "skip", "b.zip": "process", "Projecoes_Anteriores/c.zip": "excluded"}
    current = spark.createDataFrame([("b.zip", "y/1")], "archive string, output string")
    got = sorted((r["archive"], r["output"]) for r in U.obsolete_members(plan, current, state).collect())
    assert got == [("b.zip", "y/old"), ("gone.zip", "z/1")]


def test_unsafe_members(spark):
    df = spark.createDataFrame([("a", "../escape.txt"), ("a", "ok/file.txt"), ("a", "/etc/x"), ("a", "d\\..\\x")],
                               "archive string, member string")
    got = sorted((r["member"], r["reason"]) for r in U.unsafe_members(df).collect())
    assert got == [("../escape.txt", "parent traversal"), ("/etc/x", "absolute path"),
                   ("d\\..\\x", "parent traversal")]
