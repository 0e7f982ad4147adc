"""The batch jobs, from raw files to served tables. Each reads and writes paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyshore.operators import audit, churn, features, metrics, star, text
from tallyshore.operators.ordered import pin_value
from tallyshore.plans import churn_model, marts, topic_model
from tallyshore.schemas import shop_tables
from tallyshore.sources import readers, writers
from tallyshore.sources.multiline import read_complaints_split


def build_dataset(spark: SparkSession, raw: str, out: str, window_days: int = 180) -> DataFrame:
    """Raw shop tables to the churn dataset, and the cutoff that it is as of. Returns the summary of what was written."""
    tables = {name: readers.read_shop_csv(spark, name, f"{raw}/{name}.csv")
              for name in ("users", "orders", "order_items", "products", "events")}
    dataset = features.churn_dataset(
        features.home_users(tables["users"]), tables["orders"], tables["order_items"],
        tables["products"], tables["events"], window_days)
    writers.write_parquet(churn.cutoff_frame(tables["orders"], window_days), f"{out}/churn_cutoff")
    return features.dataset_summary(writers.write_parquet(dataset, f"{out}/churn_dataset"))


def scoring_date(spark: SparkSession, out: str) -> Column:
    """The day as of which customers are scored: the cutoff that was written with the dataset."""
    return pin_value(spark.read.parquet(f"{out}/churn_cutoff"))


def prepare_complaints(
    spark: SparkSession, csv: str, out: str, split_files: bool = True,
    legacy_regex: bool = False,
) -> dict[str, DataFrame]:
    """Complaints CSV to bronze (once), cleaned texts, sample and monthly counts.

    The cleaned texts are written, so cleaning and deduplication run once for
    both products; the counts then read four narrow columns.
    """
    def convert() -> DataFrame:
        if split_files:
            return read_complaints_split(spark, csv, f"{out}/complaints_lines")
        return readers.read_complaints_csv(spark, csv)

    bronze = writers.parquet_once(spark, f"{out}/complaints_bronze", convert)
    silver = writers.write_parquet(
        text.clean_complaints(bronze, legacy_regex=legacy_regex), f"{out}/complaints_clean")
    return {
        "sample": writers.write_parquet(text.complaint_sample(silver), f"{out}/complaints_sample"),
        "stats": writers.write_parquet(text.monthly_counts(silver), f"{out}/complaint_stats"),
    }


def train_churn_model(spark: SparkSession, out: str, models: str, **sizes: int) -> DataFrame:
    """Trains on the written dataset; writes model, metrics, confusions, importances and everybody's scores."""
    dataset = spark.read.parquet(f"{out}/churn_dataset")
    run = churn_model.train_churn(dataset, **sizes)
    best = run.models[run.best]
    churn_model.save_model(best, f"{models}/churn_model")
    part = F.lit("validation").alias("split")
    writers.write_json(
        run.validation.select("*", part).unionByName(run.test.select("*", F.lit("test").alias("split"))),
        f"{models}/churn_metrics")
    writers.write_json(run.confusion(), f"{models}/churn_confusion")
    writers.write_json(run.importances(), f"{models}/churn_importances")
    writers.write_json(run.report(), f"{models}/churn_report")
    writers.write_parquet(churn_model.score_customers(best, run.data), f"{out}/churn_scores")
    return run.validation


def forest_depths(spark: SparkSession, out: str, models: str, **sizes) -> DataFrame:
    """Forests of several depths on validation, written beside the models."""
    scores = churn_model.forest_depths(spark.read.parquet(f"{out}/churn_dataset"), **sizes)
    path = f"{models}/forest_depths"
    writers.write_json(scores, path)
    return spark.read.schema(scores.schema).json(path).orderBy("depth")


def train_topic_model(spark: SparkSession, out: str, models: str, **sizes: int) -> DataFrame:
    """Trains on the written sample with current product names; writes model and report."""
    sample = text.recode_products(spark.read.parquet(f"{out}/complaints_sample"))
    run = topic_model.train_topics(sample, **sizes)
    churn_model.save_model(run.model, f"{models}/topic_model")
    writers.write_json(run.report(), f"{models}/topic_report")
    return run.macro_f1()


def build_star(spark: SparkSession, out: str) -> DataFrame:
    """Datasets, scores and counts to the served tables. Returns the load summary.

    Dimensions are written first, and the facts look their keys up in what was written.
    """
    tables = star.Star(
        spark.read.parquet(f"{out}/churn_dataset"), spark.read.parquet(f"{out}/churn_scores"),
        spark.read.parquet(f"{out}/complaint_stats"), scoring_date(spark, out))
    written = tables.load(lambda df, name: writers.write_parquet(df, f"{out}/served/{name}"))
    broken = star.integrity_checks(written).filter("violations > 0").collect()
    if broken:
        raise ValueError(f"integrity: {[r.asDict() for r in broken]}")
    return tables.summary()


def open_served(spark: SparkSession, out: str) -> None:
    writers.register(writers.read_tables(spark, f"{out}/served", star.PRIMARY_KEYS))


def reports(spark: SparkSession, out: str, top: int = 10) -> dict[str, DataFrame]:
    open_served(spark, out)
    return {
        "churn": marts.churn_headline(spark),
        "churn by split": marts.churn_headline_by_split(spark),
        "complaints": marts.complaint_headline(spark),
        "churn by state": marts.churn_by_state(spark, top),
        "complaints by state": marts.complaints_by_state(spark, top),
    }


def explore(spark: SparkSession, raw: str) -> dict[str, DataFrame]:
    """Sizes, ranges, null audit and window evidence of the raw shop tables."""
    tables = {name: readers.read_shop_csv(spark, name, f"{raw}/{name}.csv")
              for name in shop_tables()}
    orders, users = tables["orders"], tables["users"]
    return {
        "rows": audit.row_counts(tables),
        "countries": audit.value_counts(users, "country"),
        "states": audit.value_counts(features.home_users(users), "state", top=15),
        "order dates": audit.date_range(orders),
        "order status": audit.value_counts(orders, "status"),
        "nulls": audit.null_audit({
            "users": (users, ["id", "country", "state", "created_at"]),
            "orders": (orders, ["order_id", "user_id", "status", "created_at"]),
            "order_items": (tables["order_items"],
                            ["order_id", "user_id", "sale_price", "status"])}),
        "gap percentiles": churn.gap_percentiles(orders),
        "gap histogram": churn.gap_histogram(orders),
        "window sweep": churn.window_sweep(orders),
    }


def check_raw(spark: SparkSession, raw: str) -> DataFrame:
    """Parses every value of every shop table: table_name, rows, fingerprint, missing_keys."""
    parts = None
    for name in shop_tables():
        df = readers.read_shop_csv(spark, name, f"{raw}/{name}.csv")
        key = df.columns[0]
        row = df.agg(
            F.count("*").alias("rows"), F.bit_xor(F.xxhash64(*df.columns)).alias("fingerprint"),
            F.count_if(F.col(key).isNull()).alias("missing_keys"),
        ).select(F.lit(name).alias("table_name"), "*")
        parts = row if parts is None else parts.unionByName(row)
    return parts


def check_complaints(spark: SparkSession, csv: str) -> dict[str, DataFrame]:
    """Columns and types of the complaints, their rows, and those with a narrative."""
    complaints = readers.read_complaints_csv(spark, csv)
    columns = [(f.name, f.dataType.simpleString()) for f in complaints.schema.fields]
    return {
        "complaint columns": spark.createDataFrame(columns, "column_name string, type string"),
        "complaints": audit.coverage(complaints),
    }


def inspect_models(spark: SparkSession, out: str, models: str, top: int = 15) -> dict[str, DataFrame]:
    """Score distributions of held-out customers, and what the models learned."""
    weights = spark.read.schema("model string, feature string, importance double").json(f"{models}/churn_importances")
    scores = spark.read.parquet(f"{out}/churn_scores")
    sample = spark.read.parquet(f"{out}/complaints_sample")
    return {
        "score histogram": metrics.histogram(
            metrics.held_out(scores), "churn_probability", 50, by=["churned"]),
        "importances": weights.filter("model = 'random_forest'").orderBy(F.desc("importance"), "feature").limit(top),
        "products": audit.value_counts(sample, "product"),
        "texts": text.peek(sample),
        "terms": topic_model.top_terms(churn_model.load_model(f"{models}/topic_model")),
    }
