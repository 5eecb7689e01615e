"""Registered panel queries: five quarterly waves derived from orders ⋈ customer.

Wave ``n`` is the ``n``-th quarter from 1995Q1 (panel id ``19951``... which is
not a ``20YYQ`` id, so the years are shifted by 25: 1995 → 2020, id ``20201``).
Every order is one interview record.  Later quarters join in groups of five:
a group's dwellings are its own (``upa``), its quarters are waves 1 to 5.

    upa = c_nationkey + 1000 * group, v1008 = o_custkey % 40           (dwelling)
    v2007 = 1 + custkey % 2, v2008 = 1 + custkey % 28,
    v20081 = 1 + custkey % 12, v20082 = 1940 + custkey % 60, null when custkey % 19 = 0
    v2003 = o_orderkey (null when o_orderkey % 23 = 0)   (order within dwelling)
    v1016 = the wave, or another visit when o_orderkey % 9 = 0
    line_no = o_orderkey (input ordinal, used to break ties)

Several orders of one customer in one quarter share a signature, so ranks 2
and 3 occur (the "twins" case), and null birth years link by rank.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import panel as P
from .common import table

PANEL_ID = "20201"
N_WAVES = 5
YEAR_SHIFT = 25
FIRST_ORDINAL = 1995 * 4
GROUP_STEP = 1000


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey)
    ck, ok = F.col("o_custkey"), F.col("o_orderkey")
    quarter = F.year("o_orderdate") * 4 + F.quarter("o_orderdate") - 1 - FIRST_ORDINAL
    group, wave = F.floor(quarter / N_WAVES).cast("int"), (F.pmod(quarter, F.lit(N_WAVES)) + 1).cast("int")
    ordinal = wave - 1 + FIRST_ORDINAL
    return joined.select(
        wave.alias("_wave"),
        (F.floor(ordinal / 4) + YEAR_SHIFT).cast("int").alias("ano"),
        (ordinal % 4 + 1).cast("int").alias("trimestre"),
        (F.col("c_nationkey") + group * GROUP_STEP).cast("int").alias("upa"),
        (ck % 40).cast("int").alias("v1008"),
        F.when(ok % 9 == 0, wave % 5 + 1).otherwise(wave).cast("int").alias("v1016"),
        F.when(ok % 23 == 0, F.lit(None)).otherwise(ok).cast("int").alias("v2003"),
        (ck % 2 + 1).cast("int").alias("v2007"),
        (ck % 28 + 1).cast("int").alias("v2008"),
        (ck % 12 + 1).cast("int").alias("v20081"),
        F.when(ck % 19 == 0, F.lit(None)).otherwise(ck % 60 + 1940).cast("int").alias("v20082"),
        F.col("o_totalprice"),
        ok.alias("line_no"),
    )


def waves(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    base = _base(spark, sf_dir)
    return [base.filter(F.col("_wave") == w).drop("_wave") for w in range(1, N_WAVES + 1)]


def long_panel(spark, sf_dir):
    return P.panel_long(waves(spark, sf_dir), PANEL_ID, tiebreak=["line_no"])


def q_wave_union(spark, sf_dir):
    ws = waves(spark, sf_dir)
    # Wave-only columns and a narrower type in one wave exercise by-name union.
    ws[0] = ws[0].withColumn("first_only", F.lit("w1"))
    ws[1] = ws[1].withColumn("v1016", F.col("v1016").cast("tinyint"))
    return P.wave_union(ws)


def q_signature_rank(spark, sf_dir):
    return long_panel(spark, sf_dir).select("line_no", "panel_wave", "signature_rank")


def q_panel_long(spark, sf_dir):
    return long_panel(spark, sf_dir)


def q_panel_wide(spark, sf_dir):
    return P.panel_wide(long_panel(spark, sf_dir), N_WAVES)


def q_panel_summary(spark, sf_dir):
    return P.panel_summary(long_panel(spark, sf_dir), PANEL_ID, wide=False)


def q_panel_validate(spark, sf_dir):
    return P.wave_checks(P.wave_union(waves(spark, sf_dir)), PANEL_ID)


QUERIES = {
    "wave_union": q_wave_union,
    "signature_rank": q_signature_rank,
    "panel_long": q_panel_long,
    "panel_wide": q_panel_wide,
    "panel_summary": q_panel_summary,
    "panel_validate": q_panel_validate,
}

# ---------------------------------------------------------------- oracle SQL

_VALUE_COLS = ["ano", "trimestre", "upa", "v1008", "v1016", "v2003", "v2007", "v2008", "v20081",
               "v20082", "o_totalprice", "line_no"]

_QUARTER = f"(year(o_orderdate) * 4 + quarter(o_orderdate) - 1 - {FIRST_ORDINAL})"

_WAVES = f"""
SELECT
  CAST(wave AS INTEGER) AS panel_wave,
  CAST((wave - 1 + {FIRST_ORDINAL}) // 4 + {YEAR_SHIFT} AS INTEGER) AS ano,
  CAST((wave - 1 + {FIRST_ORDINAL}) % 4 + 1 AS INTEGER) AS trimestre,
  CAST(c_nationkey + ({_QUARTER} // {N_WAVES}) * {GROUP_STEP} AS INTEGER) AS upa,
  CAST(o_custkey % 40 AS INTEGER) AS v1008,
  CAST(CASE WHEN o_orderkey % 9 = 0 THEN wave % 5 + 1 ELSE wave END AS INTEGER) AS v1016,
  CAST(CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE o_orderkey END AS INTEGER) AS v2003,
  CAST(o_custkey % 2 + 1 AS INTEGER) AS v2007,
  CAST(o_custkey % 28 + 1 AS INTEGER) AS v2008,
  CAST(o_custkey % 12 + 1 AS INTEGER) AS v20081,
  CAST(CASE WHEN o_custkey % 19 = 0 THEN NULL ELSE o_custkey % 60 + 1940 END AS INTEGER) AS v20082,
  o_totalprice,
  o_orderkey AS line_no
FROM (SELECT *, {_QUARTER} % {N_WAVES} + 1 AS wave FROM orders) JOIN customer ON o_custkey = c_custkey
"""


def _key(parts: list[str]) -> str:
    joined = ", ".join(f"coalesce(CAST({p} AS VARCHAR), '')" for p in parts)
    return f"substr(sha256(concat_ws(chr(31), {joined})), 1, 16)"


_LONG = f"""
SELECT *, {_key(["panel_id", "household_id", "v2007", "v2008", "v20081", "v20082", "signature_rank"])} AS person_id
FROM (
  SELECT {", ".join(_VALUE_COLS)}, panel_wave, '{PANEL_ID}' AS panel_id,
    {_key([f"'{PANEL_ID}'", "upa", "v1008"])} AS household_id,
    CAST(row_number() OVER (PARTITION BY upa, v1008, v2007, v2008, v20081, v20082, panel_wave
                            ORDER BY v2003 ASC NULLS LAST, line_no) AS INTEGER) AS signature_rank
  FROM ({_WAVES}) WHERE v1016 = panel_wave
)
"""


def _wide() -> str:
    cols = []
    for v in _VALUE_COLS + ["signature_rank"]:
        for w in range(1, N_WAVES + 1):
            cols.append(f"max(CASE WHEN panel_wave = {w} THEN {v} END) AS {v}_{w}")
    return f"SELECT panel_id, household_id, person_id, {', '.join(cols)} FROM ({_LONG}) GROUP BY ALL"


ORACLE = {
    "wave_union": f"""
        SELECT panel_wave, ano, trimestre, upa, v1008, v1016, v2003, v2007, v2008, v20081, v20082,
               o_totalprice, line_no,
               CASE WHEN panel_wave = 1 THEN 'w1' END AS first_only
        FROM ({_WAVES})""",
    "signature_rank": f"SELECT line_no, panel_wave, signature_rank FROM ({_LONG})",
    "panel_long": _LONG,
    "panel_wide": _wide(),
    "panel_summary": f"""
        SELECT '{PANEL_ID}' AS panel_id, false AS wide, count(*) AS rows,
               count(DISTINCT person_id) AS persons, '{P.METHOD}' AS method
        FROM ({_LONG})""",
    "panel_validate": f"""
        SELECT panel_wave, count(DISTINCT (ano, trimestre)) AS n_periods,
               CAST(min(ano) AS INTEGER) AS ano, CAST(min(trimestre) AS INTEGER) AS trimestre,
               CAST(({PANEL_ID[:4]} * 4 + {PANEL_ID[4]} - 1 + panel_wave - 1) // 4 AS INTEGER) AS expected_ano,
               CAST(({PANEL_ID[:4]} * 4 + {PANEL_ID[4]} - 1 + panel_wave - 1) % 4 + 1 AS INTEGER) AS expected_trimestre,
               CAST(sum(CASE WHEN v1016 = panel_wave THEN 1 ELSE 0 END) AS BIGINT) AS visit_rows,
               count(*) AS rows,
               count(DISTINCT (ano, trimestre)) = 1 AND min(trimestre) BETWEEN 1 AND 4
                 AND min(ano) * 4 + min(trimestre) - 1 = {PANEL_ID[:4]} * 4 + {PANEL_ID[4]} - 1 + panel_wave - 1
                 AND sum(CASE WHEN v1016 = panel_wave THEN 1 ELSE 0 END) > 0 AS ok
        FROM ({_WAVES}) GROUP BY panel_wave""",
}
