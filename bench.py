"""Time the headline queries: one JSON line on stdout.

Each query is computed in full (``noop`` sink): one warm-up run, then the median
of ``BENCH_RUNS`` runs.  The inputs are derived and written before the clock starts;
that time is reported as ``inputs_sec``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from claimworks import fixtures  # noqa: E402
from claimworks.queries import QUERIES  # noqa: E402
from claimworks.session import spark_session  # noqa: E402

HEADLINE = (
    "city_report", "city_report_sql", "city_prescriber_agg", "top5_prescribers",
    "top5_prescribers_total", "presc_rank_by_state", "impute_trx", "clean_presc",
    "scan_presc_csv", "csv_skip_malformed", "dq_column_profile", "whole_job",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    conf = {
        "spark.ui.enabled": "false",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        "spark.sql.shuffle.partitions": cpus,
    }
    # a folder of its own, which is enough on one machine
    scratch = tempfile.TemporaryDirectory(prefix="bench-")
    spark = spark_session(
        "bench", f"local[{cpus}]", **conf, **{"spark.checkpoint.dir": scratch.name}
    )
    spark.sparkContext.setLogLevel("ERROR")

    start = time.perf_counter()
    fixtures.city_path(spark, sf_dir)
    fixtures.prescriber_csv_path(spark, sf_dir)
    inputs = time.perf_counter() - start

    seconds, every = {}, {}
    for name in HEADLINE:
        times = []
        for _ in range(1 + runs):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
        every[name] = [round(t, 3) for t in times]
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds, headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "inputs_sec": round(inputs, 3),
                "all_runs": every,
            }
        )
    )


if __name__ == "__main__":
    main()
