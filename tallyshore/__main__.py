"""Command line: python -m tallyshore <job> [options]"""

from __future__ import annotations

import argparse

from tallyshore.plans import jobs
from tallyshore.session import get_session


def main() -> None:
    parser = argparse.ArgumentParser(prog="tallyshore", description=__doc__)
    parser.add_argument("job", choices=[
        "check", "check-complaints", "explore", "dataset", "complaints", "churn-model", "forest-depths", "topic-model",
        "star", "report", "inspect", "all"])
    parser.add_argument("--raw", default="data/raw/shop", help="folder of the shop CSVs")
    parser.add_argument("--complaints", default="data/raw/complaints.csv")
    parser.add_argument("--out", default="data/processed")
    parser.add_argument("--models", default="models")
    parser.add_argument("--window-days", type=int, default=180)
    parser.add_argument("--forest-depth", type=int, default=10)
    parser.add_argument("--top", type=int, default=10)
    parser.add_argument("--one-task-csv", action="store_true",
                        help="read the complaints with Spark's own multiline reader")
    parser.add_argument("--legacy-regex", action="store_true",
                        help="clean texts with doubled backslashes, as older results were")
    a = parser.parse_args()
    spark = get_session(f"tallyshore-{a.job}")
    spark.sparkContext.setLogLevel("ERROR")

    def show(result) -> None:
        for title, df in (result.items() if isinstance(result, dict) else [("", result)]):
            print(title)
            df.show(100, truncate=80)

    run = {
        "check": lambda: jobs.check_raw(spark, a.raw),
        "check-complaints": lambda: jobs.check_complaints(spark, a.complaints),
        "explore": lambda: jobs.explore(spark, a.raw),
        "dataset": lambda: jobs.build_dataset(spark, a.raw, a.out, a.window_days),
        "complaints": lambda: jobs.prepare_complaints(
            spark, a.complaints, a.out, not a.one_task_csv, a.legacy_regex),
        "churn-model": lambda: jobs.train_churn_model(spark, a.out, a.models, max_depth=a.forest_depth),
        "forest-depths": lambda: jobs.forest_depths(spark, a.out, a.models),
        "topic-model": lambda: jobs.train_topic_model(spark, a.out, a.models),
        "star": lambda: jobs.build_star(spark, a.out),
        "report": lambda: jobs.reports(spark, a.out, a.top),
        "inspect": lambda: jobs.inspect_models(spark, a.out, a.models),
    }
    order = ("dataset", "complaints", "churn-model", "topic-model", "star", "report")
    for name in order if a.job == "all" else (a.job,):
        show(run[name]())
    spark.stop()


if __name__ == "__main__":
    main()
