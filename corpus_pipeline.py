"""From raw documents to token ids: quality, lines, near copies, mixture, tokens.

``STAGES`` lists the stages in order. Each takes (spark, docs, folder) and returns a
DataFrame, which is written and read again as the next one's docs. All but the last
keep the columns of ``documents``. Those with Python tasks bound Arrow's batches in bytes for
the session, unless it does.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyshore.llm import lines, minhash, mixture, quality, tokens
from tallyshore.llm.common import Scratch, bound_batches, fresh, table, with_nodes

QUALITY = 0.3
#: A classifier, and near copies by MinHash, are beyond SQL.
ORACLE_SQL = None


def keep_good(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents with a quality score of 0.3 or more."""
    bound_batches(spark)
    model = quality.fit(docs, table(spark, folder, "labels"))
    score = fresh(docs, "__score")
    return quality.score(docs, model, keep=score).filter(F.col(score) >= QUALITY).drop(score)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without lines that an earlier one has, up to two edits; those without text left go."""
    bound_batches(spark)
    return lines.remove(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The document of smallest id of each group of near copies, on shingles of five words.

    Rows that repeat an id, or have none, are documents of their own, behind all others in that order.
    """
    bound_batches(spark)
    node = fresh(docs, "__node")
    rows = with_nodes(docs, Scratch(spark, "near-copies"), node)
    copies = minhash.near_duplicates(rows.select(F.col(node).alias("doc_id"), "text")).filter("not kept").select(
        F.col("doc_id").alias("__copy"))
    return rows.join(copies, F.col(node) == F.col("__copy"), "left_anti").drop(node)


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Whole documents as often as the mixture takes them, the one at a source's fraction if half of it is wanted."""
    return mixture.materialize(docs, whole=True)


def encode(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """``doc_id, source, n_tokens, token_ids, round_trip``: ids, and whether they decode to the text."""
    bound_batches(spark)
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = tokens.encode_documents(
        docs.withColumn("digest", F.sha2(F.coalesce("text", F.lit("")), 256)), path, public_tokenizers.PATTERN,
        decode=True, keep=("doc_id", "source", "digest"))
    return encoded.select(
        "doc_id", "source", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids",
        (F.sha2("decoded", 256) == F.col("digest")).alias("round_trip"))


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", drop_repeated_lines),
    ("minhash near-dedup", drop_near_copies),
    ("source mix", mix_sources),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = scratch.keep(stage(spark, docs, sf_dir), f"stage-{number}")
    return docs
