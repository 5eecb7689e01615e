import os

import pytest
from pyspark.sql import functions as F

from wavefold.operators.layout import Layout, Variable, storage_type_for_width
from wavefold.plans.convert import convert_lines
from wavefold.sources.fixed_width import ERRORS, parse_lines, raw_fields, read_fixed_width

UF_DOM = Layout([Variable("uf", 1, 2), Variable("dom", 3, 4)])


def lines(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "line_no long, value string")


def test_typed_values_and_types(spark):
    df = parse_lines(lines(spark, ["110001", "120042"]), UF_DOM, keep=["line_no"])
    types = dict(df.dtypes)
    assert types["uf"] == "tinyint" and types["dom"] == "smallint"
    rows = df.orderBy("line_no").collect()
    assert [r["uf"] for r in rows] == [11, 12]
    assert [r["dom"] for r in rows] == [1, 42]
    assert all(r[ERRORS] == "" for r in rows)


def test_text_form_keeps_leading_zeros(spark):
    rows = raw_fields(lines(spark, ["110001", "120042"]), UF_DOM, keep=["line_no"]).orderBy("line_no").collect()
    assert [(r["uf"], r["dom"]) for r in rows] == [("11", "0001"), ("12", "0042")]


def test_column_selection_case_insensitive_layout_order(spark):
    df = parse_lines(lines(spark, ["110001"]), UF_DOM, ["DOM"])
    assert [c for c in df.columns if c != ERRORS] == ["dom"]
    df = parse_lines(lines(spark, ["110001"]), UF_DOM, ["DOM", "uf"])
    assert [c for c in df.columns if c != ERRORS] == ["uf", "dom"]


def test_unknown_and_empty_selection(spark):
    with pytest.raises(ValueError, match="not in the layout"):
        parse_lines(lines(spark, ["110001"]), UF_DOM, ["nope", "zz"])
    with pytest.raises(ValueError):
        parse_lines(lines(spark, ["110001"]), UF_DOM, [])


def test_missing_sentinels_and_errors(spark):
    layout = Layout([Variable("a", 1, 3), Variable("b", 4, 3), Variable("w", 7, 15)])
    values = ["..." + "  7" + ".5".rjust(15), "   " + "x1 " + "000126,89953875", "1.2" + "012" + "1d".rjust(15)]
    rows = parse_lines(lines(spark, values), layout, keep=["line_no"]).orderBy("line_no").collect()
    assert rows[0]["a"] is None and rows[0]["b"] == 7 and rows[0]["w"] == 0.5
    assert rows[1]["a"] is None and rows[1]["b"] is None and rows[1][ERRORS] == "b"
    assert abs(rows[1]["w"] - 126.89953875) < 1e-12
    # '1.2' is not an integer and '1d' is not a Python float: both are errors.
    assert rows[2]["a"] is None and rows[2]["w"] is None and rows[2][ERRORS] == "a,w"


def test_positions_are_characters(spark):
    layout = Layout([Variable("a", 1, 2), Variable("b", 4, 2)])
    rows = parse_lines(lines(spark, ["ãb 12", "ab 34"]), layout, all_string=True, keep=["line_no"]) \
        .orderBy("line_no").collect()
    assert [(r["a"], r["b"]) for r in rows] == [("ãb", "12"), ("ab", "34")]


def test_unicode_whitespace_trimmed(spark):
    layout = Layout([Variable("t", 1, 6)])
    rows = parse_lines(lines(spark, [" ab　 ", "\x1cxy\x1f "]), layout, all_string=True, keep=["line_no"]) \
        .orderBy("line_no").collect()
    assert [r["t"] for r in rows] == ["ab", "xy"]


def test_storage_types():
    assert [storage_type_for_width(w) for w in (1, 2, 3, 4, 5, 9, 10, 14, 15, 16, 18, 19, 40)] == [
        "int8", "int8", "int16", "int16", "int32", "int32", "int64", "int64", "float64", "int64", "int64",
        "string", "string"]


def test_read_files_with_any_line_end(spark, tmpdir_path):
    for name, sep in (("a.txt", "\n"), ("b.txt", "\r\n"), ("c.txt", "\r")):
        with open(os.path.join(tmpdir_path, name), "w", newline="") as out:
            out.write(sep.join(["110001", "120042"]) + sep)
    df = read_fixed_width(spark, tmpdir_path, UF_DOM)
    assert df.count() == 6
    assert sorted(r["dom"] for r in df.collect()) == [1, 1, 1, 42, 42, 42]


def test_conversion_isolates_bad_files(spark, tmpdir_path):
    data = spark.createDataFrame(
        [("good.txt", "110001"), ("good.txt", "120042"), ("bad.txt", "11x001"), ("bad.txt", "130001")],
        "source string, value string")
    out = os.path.join(tmpdir_path, "out")
    report = {r["source"]: r for r in convert_lines(spark, data, UF_DOM, out).collect()}
    assert report["good.txt"]["status"] == "converted" and report["good.txt"]["rows"] == 2
    assert report["bad.txt"]["status"] == "unresolved" and report["bad.txt"]["failed"]
    written = spark.read.parquet(os.path.join(out, "good.parquet"))
    assert sorted(r["uf"] for r in written.collect()) == [11, 12]
    assert not os.path.exists(os.path.join(out, "bad.parquet"))


def test_csv_dialect(spark, tmpdir_path):
    data = spark.createDataFrame([("s.txt", '1,"2'), ("s.txt", "3   ")], "source string, value string")
    layout = Layout([Variable("a", 1, 4)])
    out = os.path.join(tmpdir_path, "csv")
    convert_lines(spark, data, layout, out, "csv")
    target = os.path.join(out, "s.csv")
    parts = [p for p in os.listdir(target) if p.startswith("part-")]
    content = b"".join(open(os.path.join(target, p), "rb").read() for p in sorted(parts))
    assert b'a\r\n' in content and b'"1,""2"\r\n' in content and b"3\r\n" in content


def test_one_column_csv_keeps_empty_values(spark, tmpdir_path):
    data = spark.createDataFrame([("s.txt", "11"), ("s.txt", "  "), ("s.txt", 'a"'), ("s.txt", "13")], "source string, value string")
    out = os.path.join(tmpdir_path, "csv")
    report = convert_lines(spark, data, Layout([Variable("uf", 1, 2)]), out, "csv").first()
    assert (report["rows"], report["status"]) == (4, "converted")
    lines = [x for p in os.listdir(report["output"]) if p.startswith("part-")
             for x in open(os.path.join(report["output"], p), newline="").read().split("\r\n")]
    assert sorted(x for x in lines if x not in ("", "uf")) == ['""', '"a"""', "11", "13"]


def test_rendered_prices_and_keys_are_those_of_the_formatter(spark, tmpdir_path):
    """Lines are rendered without the formatter where its text is certain, and by it elsewhere."""
    from pyspark.sql import functions as F
    from wavefold.registry import fixed_width_q as FQ

    prices = [None, 0.0, -0.0, 0.004, 0.005, 0.01, 0.29, 1.005, 2.675, 1234.5, 104949.5, 999999999.99, 1e9, 1e15 + 0.5, -3.25, 0.1 + 0.2,
              float("nan"), float("inf"), float("-inf")]
    keys = [None, 0, 7, 999_999_999, 10 ** 9, 10 ** 10, 10 ** 12, -4]
    n = len(prices) * len(keys)
    rows = [(i * 3 % 100 if i % 11 else None, keys[i % len(keys)], keys[(i + 3) % len(keys)], i % 7 + 1, 5.0, prices[i % len(prices)], "R", "F")
            for i in range(n)]
    li = spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                                     "l_extendedprice double, l_returnflag string, l_linestatus string")
    li.write.parquet(f"{tmpdir_path}/lineitem.parquet")
    read = FQ.table(spark, tmpdir_path, "lineitem")
    tie = F.format_string("%09d%010d%015.2f", "l_partkey", "l_suppkey", "l_extendedprice")
    assert sorted(r["tie"] for r in FQ.fw_lines(spark, tmpdir_path).collect()) == sorted(r["tie"] for r in read.select(tie.alias("tie")).collect())
    price = F.format_string("%015.2f", F.col("l_extendedprice"))
    assert FQ._with_price(read).filter(~F.col("_price").eqNullSafe(price)).count() == 0
