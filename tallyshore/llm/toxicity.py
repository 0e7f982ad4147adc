"""Toxicity by a character n-gram linear classifier over naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyshore.llm.common import Scratch, held_out, slices
from tallyshore.llm.sampling import SAMPLE, labelled

BITS = 20  # of the hash of an n-gram
SIZES = (3, 4, 5, 6)  # characters in an n-gram
KEPT = 1 << 11  # n-grams that the linear model weighs, unless told otherwise
SMOOTH, RIDGE, STEPS = 1.0, 1e-4, 300


def _hashes(texts: list[str]) -> tuple[dict[int, np.ndarray], np.ndarray]:
    """For each size the hash of the n-gram at each place of all texts, which end at the places given.

    Texts are in lower case, with a blank at both ends; n-grams that run into the next text count for none.
    """
    texts = [f" {t.lower()} " for t in texts]
    code = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    hashes, rolled = {}, np.zeros(len(code), np.uint32)
    for n in range(1, max(SIZES) + 1):
        rolled = rolled[:max(0, len(code) - n + 1)] * np.uint32(0x01000193) + code[n - 1:]
        if n in SIZES:
            mixed = (rolled ^ (rolled >> np.uint32(15)) ^ np.uint32(n)) * np.uint32(0x85EBCA6B)
            mixed ^= mixed >> np.uint32(13)
            hashes[n] = (mixed * np.uint32(0xC2B2AE35)) >> np.uint32(32 - BITS)
    return hashes, np.cumsum([len(t) for t in texts], dtype=np.int64)


def ngrams(texts: list[str]) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its n-grams."""
    hashes, ends = _hashes(texts)
    seen, start = np.zeros(1 << BITS, bool), 0
    for end in ends.tolist():
        for n in SIZES:
            seen[hashes[n][start:max(start, end - n + 1)]] = True
        found = np.flatnonzero(seen)
        seen[found] = False
        yield found
        start = end


@dataclass(frozen=True)
class Model:
    """Log odds: ``bias`` plus the weights of the n-grams that occur."""

    weights: np.ndarray
    bias: float

    def score(self, texts: list[str]) -> np.ndarray:
        hashes, ends = _hashes(texts)
        found = []
        for n, own in hashes.items():
            place = np.flatnonzero(self.weights[own])
            text = np.searchsorted(ends, place, "right")
            inside = place + n <= ends[text]
            found.append(text[inside] << BITS | own[place[inside]].astype(np.int64))
        once = np.unique(np.concatenate(found))
        logits = self.bias + np.bincount(once >> BITS, self.weights[once & ((1 << BITS) - 1)], len(texts))
        return 1 / (1 + np.exp(-np.clip(logits, -30, 30)))


def balance(label: np.ndarray) -> np.ndarray:
    """A weight for each row, 1 in the mean, so that both labels weigh the same; there must be both."""
    yes = label.mean()
    return np.where(label == 1, 0.5 / yes, 0.5 / (1 - yes))


def logistic(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, label: np.ndarray,
             width: int) -> tuple[np.ndarray, float]:
    """Ridge logistic regression on sparse rows, balanced by label, by accelerated gradient steps."""
    count, share = len(label), balance(label)
    weights, bias = np.zeros(width), 0.0
    ahead, ahead_bias = weights, bias
    # the largest eigenvalue of the Hessian is at most a quarter of the mean squared length
    # of a row with its constant; the steps use a tighter bound by power iteration
    vector = np.ones(width + 1) / np.sqrt(width + 1)
    top = 1.0
    for _ in range(20):
        out = share * (np.bincount(rows, values * vector[columns], count) + vector[-1])
        vector = np.append(np.bincount(columns, values * out[rows], width), out.sum()) / count
        top = float(np.linalg.norm(vector))
        vector = vector / (top or 1.0)
    rate = 1 / (0.3 * top + RIDGE)
    for step in range(1, STEPS + 1):
        logits = np.bincount(rows, values * ahead[columns], count) + ahead_bias
        error = share * (1 / (1 + np.exp(-np.clip(logits, -30, 30))) - label)
        gradient = np.bincount(columns, values * error[rows], width) / count + RIDGE * ahead
        new, new_bias = ahead - rate * gradient, ahead_bias - rate * float(error.mean())
        speed = (step - 1) / (step + 2)
        ahead, ahead_bias = new + speed * (new - weights), new_bias + speed * (new_bias - bias)
        weights, bias = new, new_bias
    return weights, bias


def fit(docs: DataFrame, labels: DataFrame, column: str = "toxic", bound: int = SAMPLE, kept: int = KEPT) -> Model:
    """Learns ``labels.<column>`` from at most about ``bound`` rows of the learning fold.

    Two passes over the sample: counts per n-gram and label, added up in tasks
    and by n-gram; then, for the ``kept`` n-grams whose shares differ most between the
    labels, which documents have them. Only those reach the driver: 2^20
    counts, and a few hundred numbers for each document of the bounded sample.
    """
    scratch = Scratch(docs.sparkSession, "toxicity")
    sample = scratch.keep(labelled(labels, column, bound), "labels")
    texts = scratch.keep(
        docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
        .select("label", F.coalesce("text", F.lit("")).alias("text")), "sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, rows = np.zeros((2, 1 << BITS), np.int64), np.zeros(2, np.int64)
        for batch in batches:
            for part in slices(batch):
                own = part.column("label").to_pylist()
                for label, found in zip(own, ngrams(part.column("text").to_pylist())):
                    sums[label, found] += 1
                    rows[label] += 1
        some = np.flatnonzero(sums.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(some, -1)), pa.array(np.append(sums[0, some], rows[0])),
             pa.array(np.append(sums[1, some], rows[1]))], ["ngram", "no", "yes"])

    counts = (
        texts.mapInArrow(count, "ngram long, no long, yes long")
        .groupBy("ngram").agg(F.sum("no").alias("no"), F.sum("yes").alias("yes")).toArrow())
    ngram, no, yes = (counts[c].to_numpy() for c in ("ngram", "no", "yes"))
    rows_no, rows_yes = (int(x[ngram == -1].sum()) for x in (no, yes))
    weights = np.zeros(1 << BITS)
    if not rows_no or not rows_yes:
        return Model(weights, 0.0)
    ngram, no, yes = (x[ngram >= 0] for x in (ngram, no, yes))
    share_no = (no + SMOOTH) / (rows_no + 2 * SMOOTH)
    share_yes = (yes + SMOOTH) / (rows_yes + 2 * SMOOTH)
    ratio = np.log(share_yes / share_no)
    both = (no + yes + 2 * SMOOTH) / (rows_no + rows_yes + 4 * SMOOTH)
    distance = np.abs(share_yes - share_no) / np.sqrt(both * (1 - both) + 1e-9)
    order = np.lexsort((ngram, -distance))[:kept]
    place = np.full(1 << BITS, -1, np.int32)
    place[ngram[order]] = np.arange(len(order))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = [place[f] for f in ngrams(part.column("text").to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column("label"), pa.array([f[f >= 0] for f in found], pa.list_(pa.int32()))],
                    ["label", "places"])

    picked = texts.mapInArrow(pick, "label int, places array<int>").toArrow()
    places = picked["places"].combine_chunks()
    lengths = places.value_lengths().to_numpy(zero_copy_only=False)
    columns = places.flatten().to_numpy()
    learned, bias = logistic(np.repeat(np.arange(len(lengths)), lengths), columns,
                             ratio[order][columns], picked["label"].to_numpy().astype(float), len(order))
    weights[ngram[order]] = learned * ratio[order]
    return Model(weights, bias)


def score(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row, from the whole text alone.

    Null and empty texts have a score as well: that of no n-gram but the blanks.
    The weights that aren't 0, ``kept`` at most, go to the executors once.
    """
    some = np.flatnonzero(model.weights)
    sent = docs.sparkSession.sparkContext.broadcast((some, model.weights[some], model.bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some, weights, bias = sent.value
        model = Model(np.zeros(1 << BITS), bias)
        model.weights[some] = weights
        for batch in batches:
            for part in slices(batch):
                scores = model.score([t or "" for t in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(scores)], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double").select(
        "doc_id", held_out("doc_id").alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
