"""Times the ETL run, the stored-warehouse KPIs, the raw KPIs and the rules.

Prints one JSON line. ``BENCH_SF_DIR`` names the folder of tables and
``BENCH_CPUS`` the local cores. Each figure is the median of three runs after
one warm-up run, building of the query included; results are fully computed.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession

from skyledger import fixtures
from skyledger.operators import reports
from skyledger.plans import kpis, raw_kpis, violations
from skyledger.plans import transform as tr
from skyledger.plans.etl import run_etl_on
from skyledger.plans.warehouse import Warehouse

RUNS = 3


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("skyledger-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="skyledger-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def compute(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    location = f"{spark.conf.get('spark.checkpoint.dir')}/warehouse"
    sources = lambda: fixtures.sources(spark, folder)

    def raw(fn, *names):
        s = sources()
        return fn(*[s[n] for n in names])

    def stored(fn):
        return fn(Warehouse(spark, location).tables())

    def summary():
        s = sources()
        return violations.rule_summary(tr.usage(s), reports.count_reports(s["reports"]), s["aircrafts"])

    runs = {
        "etl_load": lambda: run_etl_on(spark, sources(), location),
        "warehouse_utilization": lambda: compute(stored(kpis.query_utilization)),
        "warehouse_reporting": lambda: compute(stored(kpis.query_reporting)),
        "warehouse_reporting_per_role": lambda: compute(stored(kpis.query_reporting_per_role)),
        "raw_utilization": lambda: compute(
            raw(raw_kpis.query_utilization_baseline, "flights", "maintenance", "aircrafts")
        ),
        "raw_reporting": lambda: compute(raw(raw_kpis.query_reporting_baseline, "flights", "reports", "aircrafts")),
        "raw_reporting_per_role": lambda: compute(
            raw(raw_kpis.query_reporting_per_role_baseline, "flights", "reports", "aircrafts")
        ),
        "usage_by_day": lambda: compute(tr.usage(sources())),
        "usage_by_day_norules": lambda: compute(tr.usage(sources(), apply_business_rules=False)),
        "reportage_usage": lambda: compute(tr.transform(sources())["reportage_usage"]),
        "br21_decisions": lambda: compute(violations.event_decisions(sources())),
        "rule_violations": lambda: compute(violations.rule_violations(sources())),
        "rule_summary": lambda: compute(summary()),
    }
    seconds = {}
    for name, run in runs.items():
        run()
        taken = []
        for _ in range(RUNS):
            start = time.perf_counter()
            run()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken), 3)
    print(
        json.dumps(
            {
                "metric": "total seconds, median of warm runs",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
