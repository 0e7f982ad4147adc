"""Quality by positive-unlabelled learning with non-negative risk."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyshore.llm.common import SLICE_BYTES, Scratch, held_out, slices, text_bytes, word_hashes
from tallyshore.llm.sampling import SAMPLE, labelled, thin

STEPS, RATE, RIDGE = 600, 0.05, 1e-3
_MARKS = np.array([b for b in range(33, 127) if not chr(b).isalnum()])


def features(texts: pa.Array) -> np.ndarray:
    """Per text: shares of kinds of characters, of marks, of repeated words and lines; lengths."""
    data, at = text_bytes(texts)
    count, sizes = len(texts), np.diff(at)
    owner = np.repeat(np.arange(count), sizes)
    chars = np.bincount(owner * 256 + data, minlength=count * 256).reshape(count, 256)
    size = np.maximum(sizes, 1)[:, None]
    kinds = np.stack([
        chars[:, 65:91].sum(1), chars[:, 97:123].sum(1), chars[:, 48:58].sum(1), chars[:, _MARKS].sum(1),
        chars[:, 128:].sum(1), chars[:, [9, 11, 12, 13, 32]].sum(1), chars[:, 10]], axis=1) / size
    words, first = word_hashes(texts)
    number = np.diff(first)
    ends = np.flatnonzero(data == 10)
    starts = np.concatenate([at[:-1], ends + 1])
    lines = np.bincount(np.searchsorted(at, starts, "right") - 1, minlength=count + 1)[:count] if count else number
    distinct, pairs = np.zeros(count), np.zeros(count)
    for i in range(count):
        own = words[first[i]:first[i + 1]]
        if len(own):
            distinct[i] = len(np.unique(own)) / len(own)
            pairs[i] = len(np.unique(own[:-1] * np.uint64(31) + own[1:])) / max(1, len(own) - 1)
    lengths = np.stack([
        np.log1p(number), np.log1p(sizes / np.maximum(number, 1)), np.log1p(number / np.maximum(lines, 1)),
        distinct, pairs, distinct * np.log1p(number)], axis=1)
    marks = np.sqrt(chars[:, _MARKS] / np.maximum(number, 1)[:, None])
    return np.concatenate([kinds, np.sqrt(kinds), lengths, marks], axis=1)


@dataclass(frozen=True)
class Model:
    center: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def inputs(self, found: np.ndarray) -> np.ndarray:
        x = np.clip((found - self.center) / self.spread, -6, 6)
        return np.concatenate([x, x * x], axis=1)

    def score(self, texts: pa.Array) -> np.ndarray:
        logits = self.inputs(features(texts)) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(logits, -30, 30)))


def minimize(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> tuple[np.ndarray, float]:
    """Linear weights of least non-negative unbiased risk, by Adam on all rows.

    The risk is prior * P[l(+g)] + max(0, U[l(-g)] - prior * P[l(-g)]) with logistic loss l.
    Where the second part is negative, which no true risk can be, the step goes
    against it, as it then fits the sample and not the texts.
    """
    def sigmoid(z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def with_one(x: np.ndarray) -> np.ndarray:
        return np.concatenate([x, np.ones((len(x), 1))], axis=1)

    positive, unlabelled = with_one(positive), with_one(unlabelled)
    weights = np.zeros(positive.shape[1])
    mean, square = np.zeros_like(weights), np.zeros_like(weights)
    total, parts = np.zeros_like(weights), 0
    for step in range(1, STEPS + 1):
        p, u = sigmoid(positive @ weights), sigmoid(unlabelled @ weights)
        pull = -prior * ((1 - p) @ positive) / len(p)
        push = (u @ unlabelled) / len(u) - prior * (p @ positive) / len(p)
        rest = -np.log(1 - u + 1e-12).mean() + prior * np.log(1 - p + 1e-12).mean()
        gradient = pull + push if rest >= 0 else -push
        gradient = gradient + RIDGE * np.append(weights[:-1], 0)
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient * gradient
        rate = RATE * (1 - step / (STEPS + 1))
        weights = weights - rate * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.999 ** step)) + 1e-8)
        if 4 * step > 3 * STEPS:  # the mean of the last quarter
            total, parts = total + weights, parts + 1
    weights = total / parts
    return weights[:-1], float(weights[-1])


def fit(docs: DataFrame, labels: DataFrame, column: str = "quality", bound: int = SAMPLE) -> Model:
    """Learns from trusted positives and unlabelled documents, about ``bound`` of either.

    Positives have label 1 in the learning fold. The unlabelled sample is drawn
    from all documents, whatever labels they have. The class prior is
    the share of label 1 in the learning fold, which is what all documents
    hold if labels were given at random; negatives serve for nothing else.
    Only the features of the bounded sample reach the driver.
    """
    scratch = Scratch(docs.sparkSession, "quality")
    learning = scratch.keep(labelled(labels, column, 2 * bound), "learning")
    known = learning.agg(F.count("*"), F.sum("label")).first()
    prior = min(0.98, max(0.02, (known[1] or 0) / known[0])) if known[0] else 0.5
    ids = docs.select("doc_id").filter("doc_id is not null").distinct()
    others = scratch.keep(thin(ids, bound, "all"), "all")
    kinds = scratch.keep(
        thin(learning.filter("label = 1").select("doc_id"), bound, "positive").withColumn("kind", F.lit(1))
        .unionByName(others.withColumn("kind", F.lit(0))), "kinds")  # about 2 * bound rows of 12 bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, most=SLICE_BYTES // 2):
                found = features(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("kind"), pa.array(list(found), pa.list_(pa.float64()))], ["kind", "found"])

    rows = docs.select("doc_id", "text").join(F.broadcast(kinds), "doc_id").select("kind", "text").mapInArrow(
        run, "kind int, found array<double>").toArrow()
    width = features(pa.array([""])).shape[1]
    found = rows["found"].combine_chunks().flatten().to_numpy().reshape(-1, width)
    kind = rows["kind"].to_numpy()
    blank = Model(np.zeros(width), np.ones(width), np.zeros(2 * width), 0.0, prior)
    if not (kind == 1).any() or not (kind == 0).any():
        return blank
    order = np.lexsort((*found.T, kind))  # rows arrive in any order; sums must not depend on it
    found, kind = found[order], kind[order]
    center, spread = found[kind == 0].mean(axis=0), found[kind == 0].std(axis=0)
    scaled = Model(center, np.maximum(spread, 1e-3), blank.weights, 0.0, prior)
    weights, bias = minimize(scaled.inputs(found[kind == 1]), scaled.inputs(found[kind == 0]), prior)
    return Model(scaled.center, scaled.spread, weights, bias, prior)


def score(docs: DataFrame, model: Model, threshold: float = 0.3, keep: str | None = None) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row; with ``keep``, all columns of ``docs`` and the score
    under that name, which must not be one of theirs.

    Scores come from the whole text alone. Null and empty texts have the score
    of a text without characters.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, most=SLICE_BYTES // 2):
                scores = pa.array(model.score(part.column("text")))
                yield pa.RecordBatch.from_arrays([*part.columns, scores], [*part.schema.names, name])

    name, rows = keep or "score", docs if keep else docs.select("doc_id", "text")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    scored = rows.mapInArrow(run, f"{fields}, `{name}` double")
    if keep:
        return scored
    return scored.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
