"""One query per operator, over whole check tables."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import standins as s
from tallyshore.functions.columns import age_group, date_key, in_sample, squeeze_text
from tallyshore.operators import audit, churn, features, metrics, split, star, text
from tallyshore.operators.ordered import number_rows
from tallyshore.operators.split import with_weights
from tallyshore.plans import churn_model, marts, topic_model
from tallyshore.schemas import COMPLAINT_COLUMNS, shop_schema
from tallyshore.session import shared_folder
from tallyshore.sources import readers
from tallyshore.sources.multiline import csv_records, read_complaints_split, stage_lines, wrong_headers
from tallyshore.sources.writers import parquet_once, read_tables, register, write_json, write_parquet, write_tables

Query = Callable[[SparkSession, str], DataFrame]
CATALOG: dict[str, Query] = {}


def query(function: Query) -> Query:
    CATALOG[function.__name__] = function
    return function


def text_dates(df: DataFrame) -> DataFrame:
    """Dates and times as text, so that both engines return the same values."""
    kinds = ("date", "timestamp", "timestamp_ntz")
    return df.select(*[
        F.date_format(c, "yyyy-MM-dd" if t == "date" else "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c)
        if t in kinds else F.col(c) for c, t in df.dtypes])


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Averages of doubles depend on the order of rows in the last bits."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- churn label and window -------------------------------------------------

@query
def churn_by_state(spark, d):
    """Flagship: label every customer, then churn per state."""
    orders = s.orders(spark, d)
    labels = churn.label_churn(orders, churn.cutoff_date(orders))
    people = features.customer_profile(s.users(spark, d)).select("user_id", "state")
    return labels.join(people, "user_id").groupBy("state").agg(
        F.count("*").alias("customers"), F.count_if(F.col("churned") == 1).alias("churned"),
        F.avg("churned").alias("churn_rate")).orderBy(F.desc("customers"), "state")


@query
def cutoff_date(spark, d):
    return text_dates(churn.cutoff_frame(s.orders(spark, d)))


@query
def valid_orders(spark, d):
    return text_dates(churn.purchases(s.orders(spark, d)))


@query
def churn_label(spark, d):
    orders = s.orders(spark, d)
    return churn.label_churn(orders, churn.cutoff_date(orders))


@query
def window_sweep(spark, d):
    return churn.window_sweep(s.orders(spark, d))


@query
def order_gaps(spark, d):
    return text_dates(churn.order_gaps(s.orders(spark, d)))


@query
def gap_percentiles(spark, d):
    return churn.gap_percentiles(s.orders(spark, d))


@query
def gap_histogram(spark, d):
    return rounded(churn.gap_histogram(s.orders(spark, d)), "low", "high")


# --- features ---------------------------------------------------------------

@query
def home_users(spark, d):
    return features.customer_profile(features.home_users(s.users(spark, d), s.HOME))


@query
def order_features(spark, d):
    orders = s.orders(spark, d)
    return features.order_features(orders, churn.cutoff_date(orders))


@query
def spend_features(spark, d):
    cutoff = churn.cutoff_date(s.orders(spark, d))
    return features.spend_features(s.order_items(spark, d), s.products(spark, d), cutoff)


@query
def event_features(spark, d):
    return features.event_features(s.events(spark, d), s.event_cutoff(spark, d), "purchase")


def dataset(spark, d):
    return features.churn_dataset(
        s.home(spark, d), s.orders(spark, d), s.order_items(spark, d), s.products(spark, d),
        s.events(spark, d), event_cutoff=s.event_cutoff(spark, d), cart_event="purchase")


@query
def churn_dataset(spark, d):
    return dataset(spark, d)


@query
def dataset_summary(spark, d):
    return features.dataset_summary(dataset(spark, d))


# --- audits -----------------------------------------------------------------

@query
def table_rows(spark, d):
    names = ("customer", "orders", "lineitem", "part", "events", "documents")
    return audit.row_counts({n: s.table(spark, d, n) for n in names})


@query
def users_by_country(spark, d):
    return audit.value_counts(s.users(spark, d), "country")


@query
def home_users_by_state_top15(spark, d):
    return audit.value_counts(s.users(spark, d), "state", top=15)


@query
def orders_by_status(spark, d):
    return audit.value_counts(s.orders(spark, d), "status")


@query
def order_date_range(spark, d):
    return text_dates(audit.date_range(s.orders(spark, d)))


@query
def null_audit(spark, d):
    return audit.null_audit({
        "users": (s.users(spark, d), ["id", "age", "country", "state"]),
        "orders": (s.orders(spark, d), ["order_id", "user_id", "status", "created_at"]),
        "complaints": (s.complaints(spark, d), ["complaint_id", "date_received", "state"])})


@query
def narrative_coverage(spark, d):
    return audit.coverage(s.complaints(spark, d))


@query
def distinct_products(spark, d):
    return audit.distinct_values(s.products(spark, d), "category")


@query
def distinct_product_count(spark, d):
    return audit.distinct_count(s.products(spark, d), "category")


# --- sources ----------------------------------------------------------------

def _folder(spark, d: str, name: str) -> str:
    """A folder per query and data set, overwritten by the next run of the same query."""
    return f"{shared_folder(spark)}/checks/{os.path.basename(d.rstrip('/'))}-{name}"


@query
def csv_round_trip(spark, d):
    """Events written as a raw CSV export, ids as decimal text, and read by the typed reader."""
    events = s.events(spark, d).withColumns({
        "user_id": F.concat(F.col("user_id").cast("string"), F.lit(".0")),
        "created_at": F.date_format("created_at", "yyyy-MM-dd HH:mm:ss.SSSSSS")})
    blank = F.lit(None).cast("string")
    path = _folder(spark, d, "events-csv")
    events.select(*[F.col(c) if c in events.columns else blank.alias(c)
                    for c in shop_schema("events").names]).write.csv(path, mode="overwrite", header=True)
    return text_dates(readers.read_shop_csv(spark, "events", path).select(*events.columns))


@query
def complaints_round_trip(spark, d):
    """Texts with newlines, commas and quotes through CSV and the parallel reader."""
    source = s.complaints(spark, d)
    blank = F.lit(None).cast("string")
    path = _folder(spark, d, "complaints-csv")
    source.select(*[
        (F.col(ours) if ours in source.columns else blank).alias(header)
        for header, ours in COMPLAINT_COLUMNS.items()
    ]).write.csv(path, mode="overwrite", header=True, quote='"', escape='"',
                 ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    back = read_complaints_split(spark, path, _folder(spark, d, "complaint-lines"))
    return text_dates(back.select(*source.columns))


HEADER_STYLES = ("plain", "quoted", "marked", "swapped")


@query
def complaint_headers(spark, d):
    """Files with headers spelled in three valid ways and a wrong one: which are refused, and their records."""
    source = s.complaints(spark, d)
    blank = F.lit(None).cast("string")
    root = _folder(spark, d, "complaint-headers")
    for number, style in enumerate(HEADER_STYLES):
        names = list(COMPLAINT_COLUMNS.items())
        if style == "swapped":
            names[1], names[3] = names[3], names[1]
        mark = "\ufeff" if style == "marked" else ""
        rows = source.filter(F.pmod(F.col("complaint_id"), F.lit(len(HEADER_STYLES))) == number)
        rows.select(*[
            (F.col(ours) if ours in source.columns else blank).alias(mark * (i == 0) + header)
            for i, (header, ours) in enumerate(names)
        ]).write.csv(f"{root}/style={style}", mode="overwrite", header=True, quote='"', escape='"',
                     quoteAll=style == "quoted", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    lines = stage_lines(spark, root, _folder(spark, d, "header-lines"))
    style = F.regexp_extract("file", "style=(\\w+)", 1).alias("style")
    wrong = wrong_headers(lines, list(COMPLAINT_COLUMNS)).select(style).distinct().withColumn("refused", F.lit(True))
    records = csv_records(lines).groupBy(style).agg(F.count("*").alias("records"))
    return records.join(wrong, "style", "left").select("style", "records", F.coalesce("refused", F.lit(False)).alias("refused"))


@query
def refused_file(spark, d):
    """Reading files of which one has another header raises, and names the file."""
    complaint_headers(spark, d)
    try:
        read_complaints_split(spark, _folder(spark, d, "complaint-headers"), _folder(spark, d, "header-lines"))
        said = "nothing"
    except ValueError as error:
        said = re.search(r"style=(\w+)", str(error))[1]
    return s.complaints(spark, d).agg(F.count("*").alias("complaints")).withColumn("refused", F.lit(said))


@query
def bronze_once(spark, d):
    """A second build of a stored table is skipped: it would have half of the rows."""
    path = f"{_folder(spark, d, 'bronze')}-{uuid.uuid4().hex}"
    docs = s.table(spark, d, "documents").select("doc_id", "lang")
    first = parquet_once(spark, path, lambda: docs)
    second = parquet_once(spark, path, lambda: docs.filter("doc_id % 2 = 0"))
    return first.groupBy("lang").agg(F.count("*").alias("first_rows")).join(
        second.groupBy("lang").agg(F.count("*").alias("second_rows")), "lang")


@query
def word_keys(spark, d):
    """The distinct words of all texts, numbered in their order."""
    words = s.table(spark, d, "documents").select(F.explode(F.regexp_extract_all("text", F.lit("[^ \t\n\r]+"), 0)).alias("word"))
    return number_rows(words.distinct(), "word", "word_sk")


@query
def served_tables(spark, d):
    """Named tables written in order, read back and counted."""
    names = ("nation", "customer", "orders", "lineitem")
    folder = _folder(spark, d, "served")
    write_tables({name: s.table(spark, d, name) for name in names}, folder)
    return reduce(DataFrame.unionByName, [
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in read_tables(spark, folder, names).items()])


@query
def json_report(spark, d):
    """A confusion matrix through the JSON sink."""
    counts = metrics.confusion_counts(s.scored_documents(spark, d))
    path = _folder(spark, d, "confusion-json")
    write_json(counts, path)
    return spark.read.schema(counts.schema).json(path)


# --- texts ------------------------------------------------------------------

@query
def redacted_texts(spark, d):
    """Whole texts with redaction blocks, digits and slashes behind them, put in and tidied away."""
    marked = F.replace("text", F.lit("e "), F.lit("XXXX12/3 "))
    return s.table(spark, d, "documents").select("doc_id", squeeze_text(marked).alias("narrative"))



def cleaned(spark, d):
    return text.clean_complaints(s.complaints(spark, d))


@query
def clean_complaints(spark, d):
    return text_dates(cleaned(spark, d))


@query
def newest_order_per_customer(spark, d):
    return text_dates(text.newest_per_key(s.orders(spark, d), "user_id", "created_at"))


@query
def complaint_sample(spark, d):
    return text.complaint_sample(cleaned(spark, d))


@query
def narrative_peek(spark, d):
    return text.peek(text.complaint_sample(cleaned(spark, d)))


@query
def complaint_months(spark, d):
    return text_dates(text.monthly_counts(cleaned(spark, d)))


@query
def order_months(spark, d):
    return text_dates(text.monthly_counts(s.order_complaints(spark, d)))


@query
def recoded_products(spark, d):
    renamed = text.recode_products(
        s.complaints(spark, d), {"fr": "romance", "es": "romance", "de": "germanic"})
    return audit.value_counts(renamed, "product")


@query
def complaint_totals_by_state_top15(spark, d):
    stats = text.monthly_counts(s.order_complaints(spark, d))
    return stats.groupBy("state").agg(F.sum("complaint_count").alias("complaints")).orderBy(
        F.desc("complaints"), "state").limit(15)


# --- splits, weights, metrics -----------------------------------------------

@query
def churn_split(spark, d):
    orders = s.orders(spark, d)
    labels = churn.label_churn(orders, churn.cutoff_date(orders))
    return split.stratified_split(labels, "user_id", "churned")


@query
def topic_split(spark, d):
    docs = s.table(spark, d, "documents").selectExpr("doc_id", "lang as product")
    return split.stratified_split(docs, "doc_id", "product", split.TOPIC_SHARES)


def _keyed_lines(spark, d, *columns):
    return s.table(spark, d, "lineitem").selectExpr("l_orderkey * 8 + l_linenumber as k", *columns)


@query
def tiny_sample(spark, d):
    lines = s.table(spark, d, "lineitem")
    return lines.filter(in_sample("42", "l_orderkey", 0.00037)).select("l_orderkey", "l_linenumber")


@query
def uneven_split(spark, d):
    lines = _keyed_lines(spark, d, "l_returnflag")
    return split.stratified_split(lines, "k", "l_returnflag", {"train": 0.9996, "test": 0.0004})


@query
def tiny_top_share(spark, d):
    return split.top_share(_keyed_lines(spark, d, "l_extendedprice"), "k", "l_extendedprice", 0.0004)


@query
def class_weights(spark, d):
    return split.balanced_weights(s.complaints(spark, d), "product")


@query
def budget_targets(spark, d):
    cutoff = churn.cutoff_date(s.orders(spark, d))
    return split.top_share(s.scores(spark, d, cutoff), "user_id", "churn_probability")


@query
def ranking_metrics(spark, d):
    return metrics.ranking_metrics(s.scored_documents(spark, d))


@query
def ranking_metrics_by_split(spark, d):
    cutoff = churn.cutoff_date(s.orders(spark, d))
    return metrics.ranking_metrics(
        s.scores(spark, d, cutoff), "churned", "churn_probability", by=["split"])


@query
def baseline_metrics(spark, d):
    constant = s.scored_documents(spark, d).withColumn("probability", F.lit(1.0))
    return metrics.ranking_metrics(constant)


@query
def baseline_predictions(spark, d):
    """The model that always says churn, by the same path as the fitted ones."""
    held = metrics.held_out(s.scores(spark, d, churn.cutoff_date(s.orders(spark, d))), "validation")
    guesses = churn_model.predict(None, churn_model.BASELINE, held)
    return metrics.ranking_metrics(guesses, by=["model"])


@query
def best_language(spark, d):
    """The language whose scores rank best, English left out as the baseline."""
    languages = s.table(spark, d, "documents").select("doc_id", F.col("lang").alias("model"))
    scored = s.scored_documents(spark, d).join(languages, "doc_id")
    return metrics.best_model(metrics.ranking_metrics(scored, by=["model"]), "en")


@query
def confusion_matrix(spark, d):
    return metrics.confusion_counts(s.scored_documents(spark, d))


@query
def classification_report(spark, d):
    report = metrics.classification_report(metrics.confusion_counts(s.guessed_languages(spark, d)))
    return rounded(report, "precision", "recall", "f1")


@query
def macro_f1(spark, d):
    score = metrics.macro_f1(metrics.confusion_counts(s.guessed_languages(spark, d)))
    return rounded(score, "macro_f1")


@query
def score_histogram(spark, d):
    cutoff = churn.cutoff_date(s.orders(spark, d))
    bins = metrics.histogram(
        metrics.held_out(s.scores(spark, d, cutoff)), "churn_probability", 50, by=["churned"])
    return rounded(bins, "low", "high", "density")


# --- star schema ------------------------------------------------------------

CHURN_TABLES = ("dim_state", "dim_customer", "fact_churn_prediction")
COMPLAINT_TABLES = ("dim_state", "dim_product", "fact_complaints")


def star_tables(spark, d, *names: str) -> star.Star:
    """The star; what these tables, or all, are made from is written first, as the jobs do."""
    orders = s.orders(spark, d)
    cutoff = churn.cutoff_date(orders)
    people = features.customer_profile(s.home(spark, d))
    labeled = churn.label_churn(orders, cutoff).join(people, "user_id")
    stats = text.monthly_counts(s.order_complaints(spark, d))
    if not names or {"dim_customer", "fact_churn_prediction"} & set(names):
        labeled = written(labeled, d, "star-labeled")
    if not names or {"dim_product", "dim_date", "fact_complaints"} & set(names):
        stats = written(stats, d, "star-stats")
    return star.Star(labeled, s.made_up_scores(labeled), stats, cutoff, s.states(spark, d))


def loaded(spark, d, *names: str) -> star.Star:
    """The star with these tables, or all, written and read back."""
    tables = star_tables(spark, d, *names)
    tables.load(lambda df, name: written(df, d, f"star-{name}"), names or None)
    return tables


def _star_table(name: str) -> None:
    dimensions = {"fact_churn_prediction": CHURN_TABLES[:2], "fact_complaints": COMPLAINT_TABLES[:2]}.get(name)

    def run(spark, d):
        if name == "dim_state":
            return star.dim_state(s.states(spark, d))
        return text_dates((loaded(spark, d, *dimensions) if dimensions else star_tables(spark, d, name))[name])
    run.__name__ = name
    query(run)


for _name in star.PRIMARY_KEYS:
    _star_table(_name)


@query
def star_load_summary(spark, d):
    return loaded(spark, d).summary()


@query
def star_integrity(spark, d):
    return star.integrity_checks(dict(loaded(spark, d)))


@query
def age_groups(spark, d):
    return s.table(spark, d, "part").select(
        "p_partkey", F.col("p_size").alias("age"), age_group("p_size").alias("age_group"))


@query
def date_keys(spark, d):
    day = F.col("o_orderdate")
    return s.table(spark, d, "orders").select(
        date_key(day).alias("date_sk"), F.year(day).alias("year"), F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name")).groupBy(
        "date_sk", "year", "month", "month_name").agg(F.count("*").alias("rows"))


def _report(name: str, function: Callable, *averages: str) -> None:
    """A report over the tables that it reads, written and read back."""
    names = CHURN_TABLES if averages else COMPLAINT_TABLES

    def run(spark, d):
        tables = loaded(spark, d, *names)
        register({n: tables[n] for n in names})
        return rounded(function(spark), *averages)
    run.__name__ = name
    query(run)


_report("churn_headline", marts.churn_headline, "avg_probability")
_report("churn_headline_by_split", marts.churn_headline_by_split, "avg_probability")
_report("complaint_headline", marts.complaint_headline)
_report("churn_per_state", marts.churn_by_state, "avg_probability")
_report("churn_per_state_top10", lambda spark: marts.churn_by_state(spark, 10), "avg_probability")
_report("complaints_per_state", marts.complaints_by_state)
_report("complaints_per_state_top10", lambda spark: marts.complaints_by_state(spark, 10))


# --- models -----------------------------------------------------------------

def topic_texts(spark, d):
    """Cleaned texts in the shape of the complaint sample; the product is the language."""
    return cleaned(spark, d).select("complaint_id", "product", "state", "narrative")


@query
def text_vocabulary(spark, d):
    docs = written(topic_texts(spark, d), d, "vocabulary-texts")
    terms = topic_model.term_stages(stop_words=s.STOP_WORDS).transform(docs)
    found = topic_model.with_idf(topic_model.vocabulary(terms), docs.count())
    return rounded(found, "idf")


@query
def imputation_medians(spark, d):
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    medians = churn_model.exact_medians(s.table(spark, d, "lineitem"), columns)
    return spark.createDataFrame(list(medians.items()), "column_name string, median double")


def written(df: DataFrame, d: str, name: str) -> DataFrame:
    """Training reads its input many times, so it is written first, as the jobs do."""
    return write_parquet(df, _folder(df.sparkSession, d, name))


@query
def model_inputs(spark, d):
    """Imputed, scaled and one-hot columns as the models see them."""
    data = written(dataset(spark, d), d, "model-inputs")
    categorical, numeric = churn_model.feature_columns(data)
    fitted = churn_model.fit_preprocessor(data, categorical, numeric)
    names = churn_model.feature_names(fitted, categorical, numeric)
    ready = fitted.transform(data)
    values = vector_to_array(ready["features"])
    wanted = ["gender=F", "gender=M", *numeric]
    return ready.select("user_id", *[
        (F.round(values[names.index(n)], 6) + 0.0).alias(n.replace("=", "_").lower())
        for n in wanted])


_RUNS: dict[tuple, object] = {}


def _run(kind: str, spark, d: str, train: Callable):
    """One training run of a kind and data set, for the life of the session that made it."""
    key = (kind, spark.sparkContext.applicationId, d)
    if key not in _RUNS:
        for other in [k for k in _RUNS if k[0] == kind]:
            del _RUNS[other]
        _RUNS[key] = train()
    return _RUNS[key]


def churn_run(spark, d) -> churn_model.ChurnTraining:
    """One training run on the written dataset, shared by the queries that look at it."""
    return _run("churn", spark, d, lambda: churn_model.train_churn(written(dataset(spark, d), d, "churn-dataset")))


def topic_run(spark, d) -> topic_model.TopicTraining:
    return _run("topic", spark, d, lambda: topic_model.train_topics(written(topic_texts(spark, d), d, "topic-texts")))


@query
def churn_model_validation(spark, d):
    """All four models on the validation part."""
    return churn_run(spark, d).validation


@query
def churn_scores(spark, d):
    """Every customer's score by the chosen model, with the split."""
    run = churn_run(spark, d)
    return churn_model.score_customers(run.models[run.best], run.data)


@query
def churn_feature_importances(spark, d):
    run = churn_run(spark, d)
    return churn_model.feature_importances(run.models["random_forest"], run.names)


@query
def churn_test_metrics(spark, d):
    """The chosen model on the test part."""
    return churn_run(spark, d).test


@query
def churn_reports(spark, d):
    return churn_run(spark, d).report()


@query
def topic_report(spark, d):
    return topic_run(spark, d).report()


@query
def topic_terms(spark, d):
    return topic_model.top_terms(topic_run(spark, d).model)


@query
def forest_depths(spark, d):
    """Validation scores of forests by depth: which are worked out, and whether deeper ones have no fewer nodes."""
    data = written(dataset(spark, d), d, "forest-depths")
    scores = written(churn_model.forest_depths(data, depths=(2, 5, 10), trees=20), d, "forest-scores")
    wider = scores.alias("one").join(
        scores.select(F.col("depth").alias("less"), F.col("nodes").alias("fewer")), F.col("less") < F.col("depth"), "left")
    return wider.groupBy("depth").agg(
        F.coalesce(F.every(F.col("fewer") <= F.col("nodes")), F.lit(True)).alias("grown"),
        F.every(F.col("roc_auc").between(0, 1) & F.col("pr_auc").between(0, 1)).alias("in_range"))


@query
def churn_regression_fit(spark, d):
    """The binary model of one feature, the number of orders: intercept and coefficient."""
    vector = VectorAssembler(inputCols=["order_count"], outputCol="features")
    data = written(vector.transform(with_weights(dataset(spark, d), churn_model.TARGET)), d, "one-feature")
    fitted = churn_model.candidate_models(data.count())["logistic_regression"].fit(data)
    return rounded(spark.createDataFrame(
        [("intercept", fitted.intercept), ("order_count", float(fitted.coefficients[0]))],
        "term string, coefficient double"), "coefficient", digits=3)


@query
def topic_regression_fit(spark, d):
    """The multinomial model of two terms, English against the rest: a row per class."""
    docs = s.table(spark, d, "documents").filter("lang is not null and text is not null").selectExpr(
        "if(lang = 'en', 1, 0) as label", "double(contains(text, ' the ')) as the", "double(contains(text, ' and ')) as and")
    vector = VectorAssembler(inputCols=["the", "and"], outputCol="features")
    data = written(vector.transform(with_weights(docs, "label")), d, "two-terms")
    fitted = topic_model.topic_regression(data.count()).fit(data)
    terms, starts = fitted.coefficientMatrix.toArray().tolist(), fitted.interceptVector.toArray().tolist()
    return rounded(spark.createDataFrame(
        [(label, starts[label], *terms[label]) for label in (0, 1)],
        "label int, intercept double, the double, and double"), "intercept", "the", "and", digits=3)


# --- what training leaves behind, read back -----------------------------------

@query
def stored_scores(spark, d):
    """Scores written and read back: everybody once, with label and split; probabilities are from 0 to 1."""
    run = churn_run(spark, d)
    stored = written(churn_model.score_customers(run.models[run.best], run.data), d, "churn-scores")
    return stored.select("user_id", "state", "churned", "split",
                         F.col("churn_probability").between(0, 1).alias("in_range"))


@query
def reloaded_model(spark, d):
    """The model that is saved and loaded again gives every customer the score of the one that was fitted."""
    run = churn_run(spark, d)
    path = _folder(spark, d, "churn-model")
    churn_model.save_model(run.models[run.best], path)
    fitted = churn_model.score_customers(run.models[run.best], run.data)
    again = churn_model.score_customers(churn_model.load_model(path), run.data).select(
        "user_id", F.col("churn_probability").alias("_again"))
    return fitted.join(again, "user_id").select("user_id", (F.col("churn_probability") == F.col("_again")).alias("same"))


@query
def training_supports(spark, d):
    """Rows per class in the confusions of a run: all four models on validation, the chosen one on test."""
    counts = churn_run(spark, d).confusion()
    totals = counts.groupBy("split", "model", "actual").agg(F.sum("rows").alias("support"))
    return totals.groupBy("split", "actual").agg(
        F.count("*").alias("models"), F.min("support").alias("least"), F.max("support").alias("most"))


@query
def importance_names(spark, d):
    """The features of the tree models: names in full, importances from 0 to 1 that add up to 1.

    A model of bare leaves, as boosting leaves it on few rows, has none: they add up to 0.
    """
    run = churn_run(spark, d)
    weights = run.importances()
    trees = {name: run.models[name].stages[-1] for name in ("random_forest", "gradient_boosting")}
    wanted = spark.createDataFrame(
        [(name, float(model.totalNumNodes > model.getNumTrees)) for name, model in trees.items()], "model string, _wanted double")
    sums = weights.groupBy("model").agg(F.round(F.sum("importance"), 9).alias("_sum")).join(wanted, "model")
    return weights.join(sums, "model").withColumn("whole", F.col("_sum") == F.col("_wanted")).select(
        "model", "feature", F.col("importance").between(0, 1).alias("in_range"), "whole")


@query
def importance_ranks(spark, d):
    """The first 15 importances are the greatest ones: how many of the others exceed the least of them."""
    run = churn_run(spark, d)
    model = run.models["random_forest"]
    top = churn_model.feature_importances(model, run.names)
    every = churn_model.feature_importances(model, run.names, len(run.names))
    least = top.agg(F.min("importance").alias("least"), F.count("*").alias("listed"))
    return every.crossJoin(F.broadcast(least)).groupBy("listed").agg(
        F.count_if(F.col("importance") > F.col("least")).alias("_greater"), F.count("*").alias("features")).select(
        "listed", "features", (F.col("_greater") < F.col("listed")).alias("greatest"))


@query
def topic_term_counts(spark, d):
    """The terms of each product, joined to one text: eight of the vocabulary, all different."""
    run = topic_run(spark, d)
    words = F.split("terms", ", ")
    vocabulary = set(next(stage for stage in run.model.stages if hasattr(stage, "vocabulary")).vocabulary)
    known = spark.createDataFrame([(w,) for w in vocabulary], "term string")
    found = topic_model.top_terms(run.model).select(F.col("label").alias("product"), F.explode(words).alias("term"))
    return found.join(known, "term").groupBy("product").agg(F.count_distinct("term").alias("terms"))


@query
def topic_supports(spark, d):
    """Held-out texts per product, by the report of a training run."""
    report = topic_run(spark, d).report()
    return report.filter(~F.col("name").isin("accuracy", "macro avg", "weighted avg")).select("name", "support")
