"""Topic classifier: TF-IDF of words and word pairs, multinomial regression."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import SparkContext, StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.feature import (
    CountVectorizerModel, ElementwiseProduct, IndexToString, Normalizer, SQLTransformer,
    StopWordsRemover, StringIndexer)
from pyspark.ml.linalg import Vectors
from pyspark.serializers import CPickleSerializer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyshore.operators import metrics
from tallyshore.operators.occurrences import occurrences, small_batches
from tallyshore.operators.ordered import number_rows, values_at_ranks
from tallyshore.operators.softmax import MultinomialRegression
from tallyshore.operators.split import TOPIC_SHARES, stratified_split, with_weights
from tallyshore.session import shared_folder
from tallyshore.sources.writers import write_parquet

# A word is a run of at least two letters, digits or underscores
# of any script; the vocabulary keeps this many terms that occur in so many texts.
WORD = r"[\p{L}\p{N}_]{2,}"
MAX_TERMS, MIN_DOCS = 100_000, 5
TEXTS_PER_PARTITION = 5_000


def term_stages(text: str = "narrative", stop_words: Sequence[str] | None = None) -> PipelineModel:
    """Adds ``terms``: lower-case words without stop words, then pairs of neighbours.

    Plain SQL, so texts stay in Spark's own format until they are counted.
    """
    if stop_words is None:
        stop_words = StopWordsRemover.loadDefaultStopWords("english")
    # words never contain an apostrophe, so stop words with one need no test
    stops = ", ".join(f"'{w}'" for w in stop_words if "'" not in w)
    kept = f"w -> w not in ({stops})" if stops else "w -> true"
    return PipelineModel(stages=[
        SQLTransformer(statement=f"""
            select *, filter(regexp_extract_all(lower(`{text}`), r'{WORD}', 0), {kept}) as words
            from __THIS__"""),
        SQLTransformer(statement="""
            select *, concat(words, if(size(words) < 2, array(), zip_with(
                slice(words, 1, size(words) - 1), slice(words, 2, size(words) - 1),
                (a, b) -> concat(a, ' ', b)))) as terms
            from __THIS__"""),
    ])


def vocabulary(terms: DataFrame, max_terms: int = MAX_TERMS, min_docs: int = MIN_DOCS) -> DataFrame:
    """term, total, docs: the most frequent terms, ties by term.

    One pass counts occurrences and documents together, in arrays; both are merged on the
    map side, so a very common term costs no more than others. The counts are written once. The least
    total that gets in is found by rank, and among the terms that have it, they are
    numbered in ranges: no task sorts, or holds, the terms of all the others.
    """
    spark = terms.sparkSession
    path = f"{shared_folder(spark)}/terms-{uuid.uuid4().hex}"
    with small_batches(spark):
        counted = write_parquet(occurrences(terms, "terms", "term", "docs").filter(F.col("docs") >= min_docs), path)
    found = {}

    def last(count: int) -> list[int]:
        found["count"] = count
        return [count - max_terms + 1] if count > max_terms > 0 else []

    (least,) = values_at_ranks(counted.select("total"), {"total": last}).values()
    if not least:
        return counted if found["count"] <= max_terms else counted.limit(0)
    above = counted.filter(F.col("total") > least[0])
    tied = counted.filter(F.col("total") == least[0])
    places = number_rows(tied, "term", "_place").filter(F.col("_place") <= max_terms - above.count())
    return above.unionByName(places.drop("_place"))


def with_idf(vocabulary: DataFrame, texts: int) -> DataFrame:
    """Adds idf = ln((1 + texts) / (1 + docs)) + 1."""
    return vocabulary.withColumn("idf", F.log(F.lit(1.0 + texts) / (1 + F.col("docs"))) + 1)


def term_counter(terms: list[str]) -> CountVectorizerModel:
    """Counts of ``terms``, as by ``CountVectorizerModel.from_vocabulary``, which sends them to the JVM one by one."""
    context = SparkContext._active_spark_context
    listed = context._jvm.org.apache.spark.ml.python.MLSerDe.loads(bytearray(CPickleSerializer().dumps(terms)))
    array = context._jvm.org.apache.commons.lang3.ArrayUtils.toStringArray(listed.toArray())
    model = CountVectorizerModel._create_from_java_class("org.apache.spark.ml.feature.CountVectorizerModel", array)
    model._set(vocabSize=len(terms))
    return model.setInputCol("terms").setOutputCol("counts")


def fit_tfidf(texts: DataFrame, stages: PipelineModel, max_terms: int = MAX_TERMS,
              min_docs: int = MIN_DOCS) -> PipelineModel:
    """Text to ``features``, a sparse unit vector. Runs two passes over the texts.

    The vocabulary, at most ``max_terms`` strings, is what comes to the driver.
    """
    found = with_idf(vocabulary(stages.transform(texts), max_terms, min_docs), texts.count())
    rows = found.select("term", "idf", "total").toPandas()
    if not len(rows):
        raise ValueError(f"no term occurs in {min_docs} texts")
    rows = rows.sort_values(["total", "term"], ascending=[False, True])
    rows = {"term": rows["term"].tolist(), "idf": rows["idf"].tolist()}
    return PipelineModel(stages=[
        *stages.stages,
        term_counter(rows["term"]),
        ElementwiseProduct(scalingVec=Vectors.dense(rows["idf"]), inputCol="counts",
                           outputCol="weighted"),
        Normalizer(p=2.0, inputCol="weighted", outputCol="features"),
    ])


@dataclass
class TopicTraining:
    model: PipelineModel
    confusion: DataFrame  # actual, predicted, rows on the held-out texts
    predictions: DataFrame

    def report(self) -> DataFrame:
        return metrics.classification_report(self.confusion)

    def macro_f1(self) -> DataFrame:
        return metrics.macro_f1(self.confusion)


def topic_regression(rows: int, iterations: int = 1000) -> MultinomialRegression:
    """Multinomial regression whose penalty is 1/2 |w|^2 against the summed, balanced loss."""
    return MultinomialRegression(1.0 / rows, iterations)


def train_topics(
    sample: DataFrame, id_col: str = "complaint_id", stop_words: Sequence[str] | None = None,
    max_terms: int = MAX_TERMS, min_docs: int = MIN_DOCS, iterations: int = 1000,
) -> TopicTraining:
    """Fit on 80 % of each product's texts, report on the rest."""
    data = stratified_split(sample, id_col, "product", TOPIC_SHARES)
    train = data.filter("split = 'train'")
    tfidf = fit_tfidf(train, term_stages("narrative", stop_words), max_terms, min_docs)
    indexer = StringIndexer(inputCol="product", outputCol="label", handleInvalid="skip",
                            stringOrderType="alphabetAsc").fit(train)
    rows = train.count()
    prepared = (
        tfidf.transform(with_weights(indexer.transform(train), "label"))
        .select(id_col, "label", "weight", "features")
        .repartition(1 + rows // TEXTS_PER_PARTITION, id_col)
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    regression = topic_regression(rows, iterations).fit(prepared)
    prepared.unpersist()
    naming = IndexToString(inputCol="prediction", outputCol="predicted_product",
                           labels=indexer.labels)
    model = PipelineModel(stages=[*tfidf.stages, regression, naming])
    guesses = model.transform(metrics.held_out(data)).select(
        id_col, "product", "predicted_product")
    return TopicTraining(
        model, metrics.confusion_counts(guesses, "product", "predicted_product"), guesses)


def top_terms(model: PipelineModel, top: int = 8, label_chars: int = 55) -> DataFrame:
    """label, terms: the words that speak most for each label, strongest first.

    The model's own coefficients (labels x vocabulary) are all it reads.
    """
    from pyspark.sql import SparkSession

    spark = SparkSession.active()
    counter = next(s for s in model.stages if isinstance(s, CountVectorizerModel))
    labels = model.stages[-1].getLabels()
    matrix = model.stages[-2].coefficientMatrix.toArray()
    coefficients = spark.createDataFrame(
        [(label, row.tolist()) for label, row in zip(labels, matrix)],
        "label string, weights array<double>")
    words = spark.createDataFrame(
        list(enumerate(counter.vocabulary)), "slot int, term string")
    rank = F.row_number().over(Window.partitionBy("label").orderBy(F.desc("weight"), "slot"))
    best = (
        coefficients.select("label", F.posexplode("weights").alias("slot", "weight"))
        .withColumn("rank", rank).filter(F.col("rank") <= top).join(words, "slot"))
    return best.groupBy("label").agg(
        F.concat_ws(", ", F.transform(F.array_sort(F.collect_list(F.struct("rank", "term"))),
                                      lambda x: x["term"])).alias("terms")
    ).select(F.substring("label", 1, label_chars).alias("label"), "terms").orderBy("label")
