import os

from wavefold.operators.layout import Layout, Variable
from wavefold.streaming.convert_stream import start_conversion

UF_DOM = Layout([Variable("uf", 1, 2), Variable("dom", 3, 4)])


def write(path, lines):
    with open(path, "w", newline="") as out:
        out.write("\n".join(lines) + "\n")


def test_incremental_stream_converts_only_new_files(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "in")
    os.makedirs(src)
    out = os.path.join(tmpdir_path, "out")
    ckpt = os.path.join(tmpdir_path, "ckpt")
    write(os.path.join(src, "a.txt"), ["110001", "120042"])
    write(os.path.join(src, "bad.txt"), ["11x001"])
    q = start_conversion(spark, src, UF_DOM, out, checkpoint=ckpt)
    q.awaitTermination(120)
    first = spark.read.parquet(out)
    assert sorted(r["dom"] for r in first.collect()) == [1, 42]
    rejected = spark.read.parquet(out + "_rejected").collect()
    assert [r["source"].split("/")[-1] for r in rejected] == ["bad.txt"]
    # A second run sees only the new file.
    write(os.path.join(src, "b.txt"), ["130007"])
    q = start_conversion(spark, src, UF_DOM, out, checkpoint=ckpt)
    q.awaitTermination(120)
    rows = spark.read.parquet(out).collect()
    assert sorted(r["dom"] for r in rows) == [1, 7, 42]
    assert len({r["_batch"] for r in rows}) == 2
