"""Churn models as MLlib pipelines: preprocess once, fit four, pick by validation.

The split is a column of the data from the start. Only model parameters and
reports of fixed size reach the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.ml import PipelineModel, Pipeline
from pyspark.ml.classification import (
    GBTClassifier, LogisticRegression, RandomForestClassifier)
from pyspark.ml.feature import (
    OneHotEncoder, SQLTransformer, StandardScaler, StringIndexer, VectorAssembler)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyshore.functions.columns import in_sample
from tallyshore.operators import metrics
from tallyshore.operators.ordered import pin_small, values_at_ranks
from tallyshore.operators.split import stratified_split, with_weights
from tallyshore.schemas import CATEGORICAL_COLUMNS
from tallyshore.session import ensure_checkpoint_dir

TARGET, ID = "churned", "user_id"
BASELINE = "always_churn_baseline"
MISSING = "(missing)"
SEED = 42
# Rows of a task. Every task sends the statistics of all nodes, so that beyond
# so many tasks each takes more rows first, and only then are there more of them.
ROWS_PER_PARTITION, PARTITIONS, FULL_PARTITION = 10_000, 12, 100_000
# Boosting keeps a tenth of more than so many rows back to see when to stop.
EARLY_STOP_ROWS, HELD_BACK, LEAST_GAIN = 10_000, 0.1, 1e-7


def feature_columns(dataset: DataFrame) -> tuple[list[str], list[str]]:
    """Categorical and numeric feature names: all columns but id, target and split."""
    left = [c for c in dataset.columns if c not in (ID, TARGET, "split")]
    categorical = [c for c in CATEGORICAL_COLUMNS if c in left]
    return categorical, [c for c in left if c not in categorical]


def exact_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Exact medians of many columns, all bracketed and counted in the same few passes, without a sort."""
    doubles = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    middle = values_at_ranks(doubles, {c: lambda n: [(n + 1) // 2, n // 2 + 1] for c in columns})
    return {c: sum(found) / 2 if found else None for c, found in middle.items()}


def fit_preprocessor(train: DataFrame, categorical: Sequence[str], numeric: Sequence[str]):
    """One-hot categories (unseen ones are all zero) and imputed, scaled numbers."""
    medians = exact_medians(train, numeric)
    filled = [f"coalesce(cast(`{c}` as string), '{MISSING}') as `{c}_cat`" for c in categorical]
    filled += [f"coalesce(cast(`{c}` as double), {medians[c] or 0.0!r}D) as `{c}_num`"
               for c in numeric]
    categories = [f"{c}_cat" for c in categorical]
    hot = [f"{c}_hot" for c in categorical]
    return Pipeline(stages=[
        SQLTransformer(statement=f"select *, {', '.join(filled)} from __THIS__"),
        StringIndexer(inputCols=categories, outputCols=[f"{c}_index" for c in categorical],
                      handleInvalid="keep", stringOrderType="alphabetAsc"),
        # the slot for unseen values is the last one, and is the one dropped
        OneHotEncoder(inputCols=[f"{c}_index" for c in categorical], outputCols=hot),
        VectorAssembler(inputCols=[f"{c}_num" for c in numeric], outputCol="numbers"),
        StandardScaler(inputCol="numbers", outputCol="scaled", withMean=True, withStd=True),
        VectorAssembler(inputCols=[*hot, "scaled"], outputCol="features"),
    ]).fit(train)


def feature_names(preprocessor: PipelineModel, categorical, numeric) -> list[str]:
    """Names of the feature vector's slots, in order."""
    labels = preprocessor.stages[1].labelsArray
    return [f"{c}={v}" for c, values in zip(categorical, labels) for v in values] + list(numeric)


def candidate_models(rows: int, trees: int = 300, max_depth: int = 10, rounds: int = 100,
                     stop_early: bool | None = None) -> dict:
    """The three real models. ``rows`` is the sum of the balanced weights.

    ``stop_early``: boosting ends with the first round that gains nothing on the rows
    marked ``held_back``, which it doesn't learn from. By default it does so on large data only.
    """
    common = {"labelCol": TARGET, "weightCol": "weight", "featuresCol": "features"}
    stop = rows > EARLY_STOP_ROWS if stop_early is None else stop_early
    stopping = {"validationIndicatorCol": "held_back", "validationTol": LEAST_GAIN} if stop else {}
    return {
        # the penalty is 1/2 |w|^2 against the summed loss, which MLlib averages
        "logistic_regression": LogisticRegression(
            maxIter=2000, regParam=1.0 / rows, standardization=False, **common),
        "random_forest": RandomForestClassifier(
            numTrees=trees, maxDepth=max_depth, featureSubsetStrategy="sqrt", seed=SEED,
            maxMemoryInMB=512, **common),
        "gradient_boosting": GBTClassifier(
            maxIter=rounds, stepSize=0.1, maxDepth=5, maxBins=255, minInstancesPerNode=20,
            seed=SEED, maxMemoryInMB=512, checkpointInterval=10, **stopping, **common),
    }


@dataclass
class ChurnTraining:
    """What a training run leaves behind."""

    data: DataFrame  # the dataset with its split
    models: dict[str, PipelineModel]
    names: list[str]
    validation: DataFrame  # model, roc_auc, pr_auc
    validation_confusion: DataFrame
    best: str
    test: DataFrame
    test_confusion: DataFrame

    def confusion(self) -> DataFrame:
        """model, actual, predicted, rows, split: all models on validation, the chosen one on test."""
        return self.validation_confusion.withColumn("split", F.lit("validation")).unionByName(
            self.test_confusion.withColumn("split", F.lit("test")))

    def importances(self) -> DataFrame:
        """model, feature, importance: every feature of the tree models, whichever was chosen."""
        return reduce(DataFrame.unionByName, [
            feature_importances(self.models[name], self.names, len(self.names)).select(F.lit(name).alias("model"), "*")
            for name in ("random_forest", "gradient_boosting")])

    def report(self) -> DataFrame:
        """Class reports of all models on validation and of the chosen one on test."""
        parts = [(self.validation_confusion, "validation"), (self.test_confusion, "test")]
        return reduce(DataFrame.unionByName, [
            metrics.classification_report(c, ["model"]).withColumn("split", F.lit(part))
            for c, part in parts])


def predict(model: PipelineModel | None, name: str, df: DataFrame) -> DataFrame:
    """model, label, probability of churn, prediction at 0.5. No model: always churn."""
    if model is None:
        scored = df.select(TARGET, F.lit(1.0).alias("probability"), F.lit(1).alias("prediction"))
    else:
        scored = model.transform(df).select(
            TARGET, vector_to_array("probability")[1].alias("probability"),
            F.col("prediction").cast("int").alias("prediction"))
    return scored.select(F.lit(name).alias("model"), F.col(TARGET).alias("label"),
                         "probability", "prediction")


def partitions(rows: int) -> int:
    """Tasks that training rows are laid out in: it follows from their number alone."""
    return max(min(1 + rows // ROWS_PER_PARTITION, PARTITIONS), -(-rows // FULL_PARTITION))


def laid_out(preprocessor: PipelineModel, train: DataFrame, rows: int) -> DataFrame:
    """Persisted training rows with weight, features and ``held_back``, in places that follow from their ids."""
    return (
        preprocessor.transform(with_weights(train, TARGET))
        .select(ID, TARGET, "weight", "features", in_sample("held-back", ID, HELD_BACK).alias("held_back"))
        .repartition(partitions(rows), ID).sortWithinPartitions(ID)
        .persist(StorageLevel.MEMORY_AND_DISK))


def forest_depths(dataset: DataFrame, depths: Sequence[int] = (5, 10, 20, 30), trees: int = 300) -> DataFrame:
    """depth, nodes, roc_auc, pr_auc: forests of several depths on the validation part of the usual split.

    What ``max_depth`` is chosen by; each depth is a fit of its own on the same rows.
    """
    spark = dataset.sparkSession
    ensure_checkpoint_dir(spark)
    data = stratified_split(dataset, ID, TARGET)
    train, validation = data.filter("split = 'train'"), data.filter("split = 'validation'")
    preprocessor = fit_preprocessor(train, *feature_columns(dataset))
    rows = train.count()
    prepared = laid_out(preprocessor, train, rows)
    guesses, nodes = [], []
    for depth in depths:
        fitted = candidate_models(rows, trees, depth)["random_forest"].fit(prepared)
        nodes.append((str(depth), depth, fitted.totalNumNodes))
        guesses.append(predict(PipelineModel(stages=[*preprocessor.stages, fitted]), str(depth), validation))
    prepared.unpersist()
    scores = metrics.ranking_metrics(reduce(DataFrame.unionByName, guesses), by=["model"])
    sizes = spark.createDataFrame(nodes, "model string, depth int, nodes long")
    return scores.join(F.broadcast(sizes), "model").select("depth", "nodes", "roc_auc", "pr_auc")


def train_churn(
    dataset: DataFrame, trees: int = 300, max_depth: int = 10, rounds: int = 100,
) -> ChurnTraining:
    """Split 60/20/20, fit on train, choose on validation, look at test once.

    The trees draw their samples by partition and position. So training rows are
    laid out by id first, in a number of partitions that follows from the row
    count: any cluster, and any task that is run again, draws the same samples.
    """
    spark = dataset.sparkSession
    ensure_checkpoint_dir(spark)
    data = stratified_split(dataset, ID, TARGET)
    train = data.filter("split = 'train'")
    categorical, numeric = feature_columns(dataset)
    preprocessor = fit_preprocessor(train, categorical, numeric)
    rows = train.count()
    prepared = laid_out(preprocessor, train, rows)
    models: dict[str, PipelineModel] = {
        name: PipelineModel(stages=[*preprocessor.stages, estimator.fit(prepared)])
        for name, estimator in candidate_models(rows, trees, max_depth, rounds).items()}
    prepared.unpersist()

    validation = data.filter("split = 'validation'")
    guesses = reduce(DataFrame.unionByName, [
        predict(models.get(name), name, validation) for name in (BASELINE, *models)])
    scores = pin_small(metrics.ranking_metrics(guesses, by=["model"]))
    best = metrics.best_model(scores, BASELINE).first()["model"]
    final = predict(models[best], best, metrics.held_out(data))
    return ChurnTraining(
        data=data, models=models, names=feature_names(preprocessor, categorical, numeric),
        validation=scores, validation_confusion=metrics.confusion_counts(guesses, by=["model"]),
        best=best, test=metrics.ranking_metrics(final, by=["model"]),
        test_confusion=metrics.confusion_counts(final, by=["model"]))


def score_customers(model: PipelineModel, data: DataFrame) -> DataFrame:
    """user_id, state, churned, churn_probability, split for every customer."""
    return model.transform(data).select(
        ID, "state", TARGET, vector_to_array("probability")[1].alias("churn_probability"), "split")


def feature_importances(model: PipelineModel, names: Sequence[str], top: int = 15) -> DataFrame:
    """feature, importance: the most important ones of a tree model."""
    from pyspark.sql import SparkSession

    weights = model.stages[-1].featureImportances.toArray().tolist()
    rows = SparkSession.active().createDataFrame(
        list(zip(names, weights)), "feature string, importance double")
    return rows.orderBy(F.desc("importance"), "feature").limit(top)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
