"""Registered fixed-width queries over lines rendered from ``lineitem``.

Every ``lineitem`` row becomes one 74-character record.  Scenario variants are
derived from the order key (not used to drop rows): dots-only order keys,
blank part keys, a bad quantity token, decimal commas, a non-ASCII character
before a later field, and a trailing no-break space.

Record layout (1-based, inclusive):

    orderkey 1-12 (int64)  partkey 13-24 (int64)   linenumber 25-26 (int8)
    quantity 27-30 (int16) extendedprice 31-45 (float64)
    flag 46-64 (string)    suppkey 65-74 (int64)

A source holds the lines of 8,192 consecutive order keys, so their number grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.layout import Layout, Variable, storage_type_col
from ..sources.fixed_width import ERRORS, parse_lines, raw_fields
from .common import table

KEY_WIDTH = 12
SOURCE_KEYS = 8192

LINE_LAYOUT = Layout(
    [
        Variable("orderkey", 1, KEY_WIDTH),
        Variable("partkey", 13, KEY_WIDTH),
        Variable("linenumber", 25, 2),
        Variable("quantity", 27, 4),
        Variable("extendedprice", 31, 15),
        Variable("flag", 46, 19),
        Variable("suppkey", 65, 10),
    ]
)


def _lpad(text: F.Column, width: int, fill: str) -> F.Column:
    """``lpad`` by a fill as wide as the field, which is copied once; a single character is copied one by one."""
    return F.lpad(text, width, fill * width)


def _digits(key: str, width: int) -> F.Column:
    """``%0<width>d`` of a key; the formatter, which is slow, is kept for what needs it (null, negative, wider)."""
    k = F.col(key)
    return F.when((k >= 0) & (k < 10 ** width), _lpad(k.cast("string"), width, "0")).otherwise(F.format_string(f"%0{width}d", k))


def _with_price(li: DataFrame) -> DataFrame:
    """Add ``_price``: ``%015.2f`` of the extended price; the formatter is kept for what is no positive number of whole cents."""
    price, cents = F.col("l_extendedprice"), F.col("_cents")
    whole = (price > 0) & (price < 10 ** 9) & (cents / F.lit(100.0) == price)
    text = F.concat(_lpad(F.expr("_cents div 100").cast("string"), 12, "0"), F.lit("."), _lpad((cents % 100).cast("string"), 2, "0"))
    return li.withColumn("_cents", F.floor(price * F.lit(100.0) + F.lit(0.5))).withColumn(
        "_price", F.when(whole, text).otherwise(F.format_string("%015.2f", price)))


def fw_lines(spark: SparkSession, sf_dir: str, faults: bool = True) -> DataFrame:
    """``source, line_no, value`` records rendered from every lineitem row; without ``faults`` every quantity is a number."""
    li = _with_price(table(spark, sf_dir, "lineitem"))
    k = F.col("l_orderkey")
    first_line = F.col("l_linenumber") == 1
    orderkey = F.when(k % 7 == 0, F.lit("." * KEY_WIDTH)).otherwise(_lpad(k.cast("string"), KEY_WIDTH, "0"))
    partkey = F.when(k % 11 == 0, F.lit(" " * KEY_WIDTH)).otherwise(_lpad(F.col("l_partkey").cast("string"), KEY_WIDTH, " "))
    linenumber = _lpad(F.col("l_linenumber").cast("string"), 2, "0")
    quantity = F.when((k % 13 == 0) & first_line & F.lit(faults), F.lit("  x1")).otherwise(
        _lpad(F.col("l_quantity").cast("int").cast("string"), 4, "0")
    )
    price = F.when(k % 3 == 0, F.replace(F.col("_price"), F.lit("."), F.lit(","))).otherwise(F.col("_price"))
    rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
    flag = (
        F.when(k % 5 == 0, F.concat(rf, F.lit("ã"), ls))
        .when(k % 17 == 0, F.concat(rf, F.lit("-"), ls, F.lit(" ")))
        .otherwise(F.concat(rf, F.lit("-"), ls))
    )
    suppkey = _lpad(F.col("l_suppkey").cast("string"), 10, "0")
    value = F.concat(orderkey, partkey, linenumber, quantity, price, F.rpad(flag, 19, " " * 19), suppkey)
    return li.select(
        F.concat(F.lit("lineitem_"), F.expr(f"l_orderkey div {SOURCE_KEYS}").cast("string"), F.lit(".txt")).alias("source"),
        (k * 8 + F.col("l_linenumber")).alias("line_no"),
        value.alias("value"),
        # (order key, line number) repeats in the generated data; this
        # content key makes the record order total.
        F.concat(_digits("l_partkey", 9), _digits("l_suppkey", 10), F.col("_price")).alias("tie"),
    )


def parsed_lines(spark: SparkSession, sf_dir: str, columns=None, all_string: bool = False) -> DataFrame:
    return parse_lines(fw_lines(spark, sf_dir), LINE_LAYOUT, columns, all_string, keep=["line_no"])


def q_fixed_width_scan(spark, sf_dir):
    df = parsed_lines(spark, sf_dir)
    return df.withColumn("parse_errors", F.col(ERRORS)).drop(ERRORS)


def q_typed_parse(spark, sf_dir):
    df = parsed_lines(spark, sf_dir, ["quantity", "EXTENDEDPRICE"])
    return df.select(
        "line_no", "quantity", "extendedprice",
        F.when(F.col(ERRORS) == "", 0).otherwise(F.size(F.split(ERRORS, ","))).cast("int").alias("n_errors"),
        F.col(ERRORS).alias("parse_errors"),
    )


def q_all_string_parse(spark, sf_dir):
    return parsed_lines(spark, sf_dir, all_string=True).drop(ERRORS)


def q_column_selection(spark, sf_dir):
    # Requested out of order and in mixed case; output follows layout order.
    return parsed_lines(spark, sf_dir, ["SUPPKEY", "OrderKey"]).drop(ERRORS)


def q_field_trim(spark, sf_dir):
    return raw_fields(fw_lines(spark, sf_dir), LINE_LAYOUT, keep=["line_no"]).select(
        "line_no", "flag", F.length("flag").cast("int").alias("flag_chars")
    )


def q_dot_sentinel(spark, sf_dir):
    return raw_fields(fw_lines(spark, sf_dir), LINE_LAYOUT, keep=["line_no"]).select(
        "line_no", "orderkey", "partkey", "quantity"
    )


def q_storage_type(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return part.select(
        "p_partkey", F.col("p_size").alias("width"), storage_type_col(F.col("p_size")).alias("storage_type")
    )


def q_dataset_group_count(spark, sf_dir):
    return parsed_lines(spark, sf_dir, ["linenumber"]).groupBy("linenumber").agg(
        F.count(F.lit(1)).alias("n")
    )


QUERIES = {
    "fixed_width_scan": q_fixed_width_scan,
    "typed_parse": q_typed_parse,
    "all_string_parse": q_all_string_parse,
    "column_selection": q_column_selection,
    "field_trim": q_field_trim,
    "dot_sentinel": q_dot_sentinel,
    "storage_type": q_storage_type,
    "dataset_group_count": q_dataset_group_count,
}

# ---------------------------------------------------------------- oracle SQL

_EXPECTED = """
SELECT
  l_orderkey * 8 + l_linenumber AS line_no,
  CAST(CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_orderkey END AS BIGINT) AS orderkey,
  CAST(CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE l_partkey END AS BIGINT) AS partkey,
  CAST(l_linenumber AS TINYINT) AS linenumber,
  CAST(CASE WHEN l_orderkey % 13 = 0 AND l_linenumber = 1 THEN NULL
            ELSE CAST(l_quantity AS INTEGER) END AS SMALLINT) AS quantity,
  CAST(printf('%.2f', l_extendedprice) AS DOUBLE) AS extendedprice,
  CASE WHEN l_orderkey % 5 = 0 THEN l_returnflag || 'ã' || l_linestatus
       ELSE l_returnflag || '-' || l_linestatus END AS flag,
  CAST(l_suppkey AS BIGINT) AS suppkey,
  CASE WHEN l_orderkey % 13 = 0 AND l_linenumber = 1 THEN 'quantity' ELSE '' END AS parse_errors
FROM lineitem
"""

_TEXT = """
SELECT
  l_orderkey * 8 + l_linenumber AS line_no,
  CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE lpad(CAST(l_orderkey AS VARCHAR), 12, '0') END AS orderkey,
  CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE CAST(l_partkey AS VARCHAR) END AS partkey,
  lpad(CAST(l_linenumber AS VARCHAR), 2, '0') AS linenumber,
  CASE WHEN l_orderkey % 13 = 0 AND l_linenumber = 1 THEN 'x1'
       ELSE lpad(CAST(CAST(l_quantity AS INTEGER) AS VARCHAR), 4, '0') END AS quantity,
  CASE WHEN l_orderkey % 3 = 0 THEN replace(printf('%015.2f', l_extendedprice), '.', ',')
       ELSE printf('%015.2f', l_extendedprice) END AS extendedprice,
  CASE WHEN l_orderkey % 5 = 0 THEN l_returnflag || 'ã' || l_linestatus
       ELSE l_returnflag || '-' || l_linestatus END AS flag,
  lpad(CAST(l_suppkey AS VARCHAR), 10, '0') AS suppkey
FROM lineitem
"""

COLUMNS = ", ".join(LINE_LAYOUT.names)


def without_faults(sql: str, value: str) -> str:
    """``sql`` with the quantity of every line."""
    at, end = sql.index("CASE WHEN l_orderkey % 13 = 0 AND l_linenumber = 1 THEN"), sql.index("AS quantity")
    close = sql.rindex("END", at, end) + 3
    return sql[:at] + value + sql[close:]


ORACLE = {
    "fixed_width_scan": _EXPECTED,
    "typed_parse": f"""
        SELECT line_no, quantity, extendedprice,
               CAST(CASE WHEN parse_errors = '' THEN 0 ELSE 1 END AS INTEGER) AS n_errors, parse_errors
        FROM ({_EXPECTED})""",
    "all_string_parse": _TEXT,
    "column_selection": f"SELECT line_no, orderkey, suppkey FROM ({_EXPECTED})",
    "field_trim": f"SELECT line_no, flag, CAST(length(flag) AS INTEGER) AS flag_chars FROM ({_TEXT})",
    "dot_sentinel": f"SELECT line_no, orderkey, partkey, quantity FROM ({_TEXT})",
    "storage_type": """
        SELECT p_partkey, p_size AS width,
          CASE WHEN p_size = 15 THEN 'float64' WHEN p_size <= 2 THEN 'int8'
               WHEN p_size <= 4 THEN 'int16' WHEN p_size <= 9 THEN 'int32'
               WHEN p_size <= 18 THEN 'int64' ELSE 'string' END AS storage_type
        FROM part""",
    "dataset_group_count": """
        SELECT CAST(l_linenumber AS TINYINT) AS linenumber, count(*) AS n
        FROM lineitem GROUP BY l_linenumber""",
}
