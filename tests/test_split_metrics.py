"""Splits, ranks, weights and metrics against brute force, with hot values."""

import hashlib
import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tallyshore.operators import metrics, ordered, split


def brute_split(rows, cuts, last):
    out = {}
    for stratum in {s for _, s in rows}:
        ids = sorted((i for i, s in rows if s == stratum),
                     key=lambda i: hashlib.md5(f"42|{i}".encode()).hexdigest())
        for rank, i in enumerate(ids, 1):
            out[i] = next((name for name, share in cuts if rank <= -(-len(ids) * share // 1000)), last)
    return out


def test_split_is_exact_per_class_and_independent_of_partitions(spark):
    sizes = {"hot": 900, "one": 1, "four": 4, "five": 5, None: 33}
    rows = [(i, s) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    df = spark.createDataFrame(rows, "id long, label string")
    want = brute_split(rows, [("train", 600), ("validation", 800)], "test")
    for parts in (1, 6):
        got = split.stratified_split(df.repartition(parts), "id", "label").collect()
        assert len(got) == len(rows) and {r.id: r.split for r in got} == want
    for part, share in split.CHURN_SHARES.items():
        n = sum(1 for i, s in rows if s == "hot" and want[i] == part)
        assert abs(n - 900 * share) <= 1


def test_split_without_rows(spark):
    df = spark.createDataFrame([], "id long, label int")
    assert split.stratified_split(df, "id", "label").count() == 0


def test_shares_out_of_range_are_refused(spark):
    df = spark.createDataFrame([(1, "a")], "id long, label string")
    for shares in ({"train": 0.9, "test": 0.2}, {"train": 1.2, "test": -0.2}):
        with pytest.raises(ValueError):
            split.stratified_split(df, "id", "label", shares)
    with pytest.raises(ValueError):
        split.top_share(df, "id", "id", 1.5)


@pytest.mark.parametrize("share", [0.2, 0.5, 0.1, 1.0, 0.0004])
def test_top_share_with_a_hot_score(spark, share):
    rng = random.Random(2)
    rows = [(i, 0.7 if i % 3 else rng.random()) for i in range(1, 400)]
    df = spark.createDataFrame(rows, "id long, p double").repartition(5)
    key = lambda r: (-r[1], hashlib.md5(f"42|{r[0]}".encode()).hexdigest())
    want = {i for i, _ in sorted(rows, key=key)[: -(-len(rows) * round(share * 10_000) // 10_000)]}
    assert {r.id for r in split.top_share(df, "id", "p", share).collect()} == want


def test_weights_balance_the_classes(spark):
    df = spark.createDataFrame([(1,)] * 85 + [(0,)] * 15, "churned int")
    weighted = split.with_weights(df, "churned").groupBy("churned").agg(F.sum("weight").alias("w"))
    assert {r.churned: round(r.w, 9) for r in weighted.collect()} == {0: 50.0, 1: 50.0}


def test_running_totals_and_numbers(spark):
    values = random.Random(4).sample(range(10_000), 500)
    df = spark.createDataFrame([(v, v % 3, 2) for v in values], "k long, g int, w long")
    ordered_values = sorted(values)
    got = {r.k: r.n for r in ordered.number_rows(df.select("k"), "k", "n", buckets=9).collect()}
    assert got == {v: i for i, v in enumerate(ordered_values, 1)}
    down = ordered.running_totals(df, "k", ["w"], by=["g"], descending=True, buckets=9).collect()
    for r in down:
        assert r.cum_w == 2 * sum(1 for v in values if v % 3 == r.g and v >= r.k)
        assert r.all_w == 2 * sum(1 for v in values if v % 3 == r.g)


def test_pin_small_keeps_a_large_result_whole(spark):
    df = spark.range(100)
    assert ordered.pin_small(df, 10) is df
    assert ordered.pin_small(df, 100).count() == 100


def brute_auc(rows):
    pos = [p for y, p in rows if y == 1]
    neg = [p for y, p in rows if y == 0]
    wins = sum((a > b) + (a == b) / 2 for a in pos for b in neg)
    ap, hit, seen = 0.0, 0, 0
    for score in sorted({p for _, p in rows}, reverse=True):
        tie = [y for y, p in rows if p == score]
        hit, seen = hit + sum(tie), seen + len(tie)
        ap += sum(tie) / len(pos) * hit / seen
    return wins / (len(pos) * len(neg)), ap


def test_auc_and_average_precision(spark):
    rng = random.Random(9)
    rows = [(int(rng.random() < 0.7), 0.5 if i % 3 == 0 else round(rng.random(), 2))
            for i in range(300)]
    df = spark.createDataFrame(rows, "label int, probability double").repartition(5)
    got = metrics.ranking_metrics(df, digits=None).first()
    assert (got.roc_auc, got.pr_auc) == pytest.approx(brute_auc(rows))


def test_auc_is_the_same_when_the_scores_are_too_many_to_pin(spark, monkeypatch):
    rng = random.Random(6)
    rows = [(int(rng.random() < 0.7), rng.random()) for _ in range(300)]
    df = spark.createDataFrame(rows, "label int, probability double").repartition(5)
    monkeypatch.setattr(ordered, "PIN_ROWS", 10)
    got = metrics.ranking_metrics(df, digits=None).first()
    assert (got.roc_auc, got.pr_auc) == pytest.approx(brute_auc(rows))


def test_auc_of_one_class(spark):
    only = lambda y: spark.createDataFrame([(y, 0.3), (y, 0.6)], "label int, probability double")
    assert tuple(metrics.ranking_metrics(only(1)).first()) == (None, 1.0)
    assert tuple(metrics.ranking_metrics(only(0)).first()) == (None, 0.0)


def test_report_counts_a_class_that_is_never_predicted(spark):
    rows = [("a", "a")] * 3 + [("a", "b")] + [("b", "b")] * 2 + [("c", "a")] + [("a", "d")]
    df = spark.createDataFrame(rows, "label string, prediction string")
    report = {r["name"]: r for r in metrics.classification_report(metrics.confusion_counts(df)).collect()}
    assert report["c"].precision == 0 and report["c"].f1 == 0 and report["c"].support == 1
    assert report["d"].recall == 0 and report["d"].support == 0
    assert report["a"].recall == pytest.approx(3 / 5) and report["a"].precision == pytest.approx(3 / 4)
    assert report["accuracy"].f1 == pytest.approx(5 / 8)
    f1 = [report[c].f1 for c in "abcd"]
    assert report["macro avg"].f1 == pytest.approx(sum(f1) / 4)
    assert report["weighted avg"].f1 == pytest.approx(
        sum(report[c].f1 * report[c].support for c in "abcd") / 8)


def test_histogram_lists_empty_bins_and_closes_the_last(spark):
    values = [0.0, 0.1, 0.1, 1.0]
    df = spark.createDataFrame([(v, "x") for v in values] + [(3.0, "y")], "v double, g string")
    got = metrics.histogram(df, "v", 4, by=["g"]).orderBy("g", "bin").collect()
    assert [r.rows for r in got if r.g == "x"] == [3, 0, 0, 1]
    assert sum(r.density * (r.high - r.low) for r in got if r.g == "x") == pytest.approx(1)
    assert sum(r.rows for r in got if r.g == "y") == 1
    whole = {r.bin: r.rows for r in metrics.histogram(df, "v", 3).collect()}
    assert whole == {1: 3, 2: 1, 3: 1}


def test_values_at_ranks_equal_a_sort(spark):
    """Ties at the ends, nulls, few and many distinct values, and brackets that are narrowed again and again."""
    rng = random.Random(21)
    rows = [(rng.gauss(0, 1), rng.choice([1.0, 2.0, 2.0, 2.0, None]), i % 7, None) for i in range(5_000)]
    df = spark.createDataFrame(rows, "a double, b double, c long, d double").repartition(3)
    ranks = {c: lambda n: [1, (n + 1) // 2, n] for c in "abcd"}
    for most in (100_000, 50, 3):
        got = ordered.values_at_ranks(df, ranks, most=most)
        for at, c in enumerate("abcd"):
            column = sorted(r[at] for r in rows if r[at] is not None)
            assert got[c] == ([column[0], column[(len(column) + 1) // 2 - 1], column[-1]] if column else [])


def test_numbers_follow_the_order_of_texts(spark):
    rng = random.Random(22)
    words = {"".join(rng.choices("abcé語😀 ", k=rng.randint(0, 6))) for _ in range(4_000)}
    df = spark.createDataFrame([(w,) for w in words], "word string").repartition(3)
    got = {r.word: r.place for r in ordered.number_rows(df, "word", "place", buckets=16).collect()}
    assert got == {w: i + 1 for i, w in enumerate(sorted(words, key=lambda w: w.encode()))}


def test_top_share_cuts_ties_by_hash(spark):
    rows = [(i, float(i % 3)) for i in range(999)]
    df = spark.createDataFrame(rows, "id long, score double").repartition(4)
    for share in (0.0, 0.001, 0.2, 1 / 3, 0.5, 1.0):
        want = sorted(rows, key=lambda r: (-r[1], hashlib.md5(f"42|{r[0]}".encode()).hexdigest()))
        count = math.ceil(Fraction(repr(share)) * len(rows))
        got = {r.id for r in split.top_share(df, "id", "score", share).collect()}
        assert got == {r[0] for r in want[:count]}
