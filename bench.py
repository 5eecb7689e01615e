"""Benchmark: headline operations at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Each query is forced end to end with Spark's ``noop`` sink (full execution,
no driver collection), once to warm up and then ``$BENCH_REPEAT`` times; the
median is reported.  The fixed-width scan reads real text files rendered once
from ``lineitem`` into the checkpoint folder.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from wavefold.registry import all_queries  # noqa: E402
from wavefold.registry import fixed_width_q as FQ  # noqa: E402
from wavefold.session import local_session, ship_package, staging_path  # noqa: E402
from wavefold.sources.fixed_width import read_fixed_width  # noqa: E402

HEADLINE = [
    "panel_long", "panel_wide", "sync_plan", "catalog_match", "latest_revision",
    "page_links", "verify_digest", "conversion_plan", "dictionary_parse",
]


def run_noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn, repeat: int) -> float:
    fn()  # warm-up
    samples = []
    for _ in range(repeat):
        t0 = time.perf_counter()
        fn()
        samples.append(time.perf_counter() - t0)
    return statistics.median(samples)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = local_session(cpus, shuffle_partitions=max(8, 2 * int(cpus) if cpus.isdigit() else 16), memory="16g")
    ship_package(spark)

    # Render lineitem into plain fixed-width text files once.
    text_dir = staging_path(spark, "bench-lines")
    lines = FQ.fw_lines(spark, sf_dir)
    lines.select("value").repartition(int(cpus) if cpus.isdigit() else 8).write.text(text_dir)
    n_lines = lines.count()
    text_bytes = sum(
        os.path.getsize(os.path.join(text_dir, f)) for f in os.listdir(text_dir) if f.startswith("part-")
    ) if os.path.isdir(text_dir) else 0

    queries = {}
    queries["fw_scan_all"] = timed(lambda: run_noop(read_fixed_width(spark, text_dir, FQ.LINE_LAYOUT)), repeat)
    queries["fw_scan_one"] = timed(
        lambda: run_noop(read_fixed_width(spark, text_dir, FQ.LINE_LAYOUT, ["suppkey"])), repeat)
    registered = all_queries()
    for key in HEADLINE:
        queries[key] = timed(lambda k=key: run_noop(registered[k](spark, sf_dir)), repeat)

    # Conversion plan where every output is current (recorded == expected).
    from wavefold.operators import conversion as CV
    from wavefold.registry import incremental_q as IQ

    def current_plan():
        exp = CV.expected_fingerprint(IQ.conversion_sources(spark, sf_dir), None, False, "parquet")
        return CV.conversion_plan(exp, exp.select("output", "fingerprint"))

    queries["conversion_plan_all_current"] = timed(lambda: run_noop(current_plan()), repeat)

    total = sum(queries.values())
    out = {
        "metric": "headline_total_median_sec",
        "value": round(total, 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in queries.items()},
        "sf": os.path.basename(sf_dir).replace("sf", ""),
        "cpus": cpus,
        "repeat": repeat,
        "fw_lines": n_lines,
        "fw_lines_per_sec_all_columns": round(n_lines / queries["fw_scan_all"], 1),
        "fw_mb_per_sec_all_columns": round(text_bytes / 1e6 / queries["fw_scan_all"], 2),
        "spark": spark.version,
    }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
