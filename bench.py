"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS set the data and the local cores. Every result is
computed in full and thrown away; the time is the better of two runs after one
warm-up query, so that it measures plans rather than JVM start.
"""

from __future__ import annotations

import json
import os
import time

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
QUERIES = (
    "churn_by_state", "churn_label", "window_sweep", "order_gaps", "gap_percentiles",
    "order_features", "spend_features", "event_features", "churn_dataset",
    "clean_complaints", "complaint_months", "order_months", "newest_order_per_customer",
    "churn_split", "budget_targets", "ranking_metrics", "score_histogram",
    "fact_churn_prediction", "fact_complaints", "churn_per_state", "text_vocabulary",
)


def scale() -> float | str:
    name = os.path.basename(FOLDER.rstrip("/"))
    try:
        return float(name.removeprefix("sf"))
    except ValueError:
        return name


def main() -> None:
    from checks.catalog import CATALOG
    from tallyshore.session import get_session

    spark = get_session("bench", **{
        "spark.master": f"local[{CPUS}]", "spark.sql.shuffle.partitions": CPUS,
        "spark.driver.memory": os.environ.get("SPARK_DRIVER_MEMORY", "8g"),
        "spark.ui.enabled": "false", "spark.log.level": "ERROR",
        "spark.ui.showConsoleProgress": "false"})

    def run(name: str) -> float:
        start = time.perf_counter()
        CATALOG[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("churn_by_state")
    seconds = {name: round(min(run(name), run(name)), 3) for name in QUERIES}
    print(json.dumps({
        "metric": "total_query_time", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": scale()}))
    spark.stop()


if __name__ == "__main__":
    main()
