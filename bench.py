"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import time

from tillspark.checks.queries import QUERIES, prepared_features
from tillspark.plans import churn_model
from tillspark.session import build_session
from tillspark.sources.sample_tables import SampleTables

HEADLINE = [
    "sales_summary",
    "kpi_summary",
    "customer_activity",
    "churn_dashboard",
    "inventory_snapshot",
    "inventory_intelligence",
    "top_product_groups",
    "sales_yoy",
    "sales_ytd",
    "fact_sales_load",
    "sales_outcomes",
    "customer_upsert",
    "churn_features",
]
WARM_RUNS = 3
DRIVER_MEMORY = "16g"


def run(name: str, spark, folder: str) -> float:
    """Seconds to plan and compute every row of a query."""
    started = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def fit_seconds(spark, folder: str) -> float:
    """Median seconds to train the forest on stored features."""
    train = churn_model.split_by_label(prepared_features(SampleTables(spark, folder)))[0]

    def fit() -> float:
        started = time.perf_counter()
        churn_model.train(train)
        return time.perf_counter() - started

    return statistics.median(fit() for _ in range(WARM_RUNS))


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        spark__driver__memory=DRIVER_MEMORY,
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions=cpus,
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        run(name, spark, folder)
        seconds[name] = round(statistics.median(run(name, spark, folder) for _ in range(WARM_RUNS)), 3)
    seconds["churn_model_fit"] = round(fit_seconds(spark, folder), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, median of warm runs, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "driver_memory": DRIVER_MEMORY,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
