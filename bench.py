"""Headline queries on ``$BENCH_SF_DIR`` with ``$BENCH_CPUS`` threads; prints one JSON line.

Every query runs ``$BENCH_RUNS`` times (three by default) after one warm-up of
the session, writes its whole result to the noop sink, and reports its median.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from postings.session import session
from verification.queries import QUERIES

HEADLINES = [
    "flatten_pages", "day_problems", "gated_rows", "stage_filter", "dedup_observations",
    "gone_rows", "daily_status", "scd2_history", "fact", "asof_fact",
    "market_daily", "salary_daily", "salary_disclosure", "company_role_latest", "city_daily",
    "bi_flat", "kpi", "repeat_positions", "keyword_coverage", "dq_results",
]


def main(names: list[str]) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "6g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("market_daily")
    seconds = {n: round(statistics.median(run(n) for _ in range(runs)), 3) for n in names}
    print(json.dumps({
        "metric": "posting history queries, median wall time, total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
        "runs": runs,
    }))


if __name__ == "__main__":
    main(sys.argv[1:] or HEADLINES)
