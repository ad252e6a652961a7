"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs to completion through the ``noop`` sink (full execution, no
collect).  The reported value is the sum of the per-query wall times.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidewater.plans.catalog import load_all  # noqa: E402
from tidewater.session import local_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [a for a in sys.argv[1:] if not a.startswith("-")]
    spark = local_session(cpus, "tidewater-bench", **{"spark.sql.shuffle.partitions": str(max(8, int(cpus) * 2))})
    reg = load_all()
    names = only or sorted(n for n, q in reg.items() if q.headline)
    # warm-up: JVM, parquet footers, Python workers
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr("sum(l_quantity)").collect()
    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()  # includes plan building (some operators size their blocks/buckets first)
        df = reg[name].spark_df(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
