import os

import pytest
from pyspark.sql import functions as F

from wavefold.plans.snapshots import SnapshotTable

SCHEMA = "key string, n long"


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), SCHEMA)


def state(table):
    return {r["key"]: r["n"] for r in table.read().collect()}


def test_last_commit_of_a_key_stays(spark, tmpdir_path):
    table = SnapshotTable(spark, f"{tmpdir_path}/t", SCHEMA, ["key"])
    assert state(table) == {} and table.version() == -1 and table.read().columns == ["key", "n"] and not table.compact()
    assert table.commit(rows(spark, ("a", 1), ("b", 2), (None, 3))) == 0
    assert table.commit(rows(spark, ("b", None), ("c", 4)).withColumn("other", F.lit(1))) == 1
    assert state(table) == {"a": 1, "b": None, "c": 4, None: 3}
    assert table.commit(rows(spark)) == 2 and state(table) == {"a": 1, "b": None, "c": 4, None: 3}
    assert SnapshotTable(spark, f"{tmpdir_path}/t", SCHEMA, ["key"]).read().count() == 4
    table.commit(rows(spark, ("d", 1), ("d", 2)))
    assert state(table)["d"] == state(table)["d"] and table.read().count() == 5


def test_two_writers_lose_no_rows(spark, tmpdir_path):
    """The second writer has chosen its version before the first one claims the same."""
    one, two = (SnapshotTable(spark, f"{tmpdir_path}/t", SCHEMA, ["key"]) for _ in range(2))
    late = two.version
    two.version = lambda: (one.commit(rows(spark, ("a", 1), ("both", 1))) - 1)
    assert two.commit(rows(spark, ("b", 2), ("both", 2))) == 1
    two.version = late
    assert state(one) == state(two) == {"a": 1, "b": 2, "both": 2}


def test_a_claim_never_replaces_an_entry(spark, tmpdir_path):
    table = SnapshotTable(spark, f"{tmpdir_path}/t", SCHEMA, ["key"])
    table.commit(rows(spark, ("a", 1)))
    assert not table._claim(0, "delta", "data/other") and state(table) == {"a": 1}
    assert [f for f in os.listdir(f"{tmpdir_path}/t/log") if f.startswith("_")] == []


def test_state_is_read_without_history(spark, tmpdir_path):
    table = SnapshotTable(spark, f"{tmpdir_path}/t", SCHEMA, ["key"], compact_every=3)
    for i in range(14):
        table.commit(rows(spark, (f"k{i % 5}", i), ("always", i)))
    assert state(table) == {"k0": 10, "k1": 11, "k2": 12, "k3": 13, "k4": 9, "always": 13}
    deltas, base, _ = table._current(table._log())
    assert len(deltas) < 3 and base is not None
    assert len(table._log()) <= 8 and len(os.listdir(f"{tmpdir_path}/t/data")) == len(table._log())
    assert table.compact()
    deltas, base, _ = table._current(table._log())
    assert deltas == []
    stored = spark.read.parquet(f"{tmpdir_path}/t/{base}").select("key", "_metadata.file_name", "_metadata.row_index").orderBy("file_name", "row_index")
    assert [r["key"] for r in stored.collect()] == sorted(state(table))


def test_a_compaction_that_comes_second_changes_nothing(spark, tmpdir_path):
    table = SnapshotTable(spark, f"{tmpdir_path}/t", SCHEMA, ["key"])
    table.commit(rows(spark, ("a", 1)))
    seen = table._log()
    table.commit(rows(spark, ("b", 2)))
    other = SnapshotTable(spark, f"{tmpdir_path}/t", SCHEMA, ["key"])
    other._log = lambda: seen
    assert not other.compact()
    assert state(table) == {"a": 1, "b": 2} and len(os.listdir(f"{tmpdir_path}/t/data")) == 2


def test_unknown_columns_are_an_error(spark, tmpdir_path):
    with pytest.raises(Exception, match="n"):
        SnapshotTable(spark, f"{tmpdir_path}/t", SCHEMA, ["key"]).commit(spark.createDataFrame([("a",)], "key string"))
