"""Cleaning, deduplication, sampling, counts and the TF-IDF features."""

import datetime as dt
import math
import re

import pyarrow as pa
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import functions as F

from tallyshore.functions.columns import age_group, iso_date, squeeze_text
from tallyshore.operators import occurrences, text
from tallyshore.plans import topic_model

SCHEMA = ("complaint_id long, date_received date, product string, state string, narrative string")
LONG = "word " * 30


def complaints(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def value(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.mark.parametrize("raw, tidy", [
    ("XXXX1234 d/", " d/"), ("on XX/XX/2023 I", "on I"), ("a \n\t b", "a b"),
    (r"a\s\s b", r"a\s\s b"), ("X marks", "X marks"), ("XXXX", " "), ("", "")])
def test_squeeze(spark, raw, tidy):
    assert value(spark, squeeze_text(F.lit(raw))) == tidy


def test_legacy_regex_matches_its_literal_meaning(spark):
    for raw in ("XXXX1234 d/", r"XXdd/\\9", "on XX/XX/2023", "a \n b", r"a\ss b"):
        once = re.sub(r"X{2,}[\\d/]*", " ", raw)
        want = re.sub(r"\\s+", " ", once)
        assert value(spark, squeeze_text(F.lit(raw), legacy_regex=True)) == want


def test_iso_dates(spark):
    texts = ["2023-07-11T15:12:42.000Z", "2023-07-11", "07/11/2023", None]
    got = [value(spark, iso_date(F.lit(t).cast("string"))) for t in texts]
    assert got == [dt.date(2023, 7, 11), dt.date(2023, 7, 11), None, None]


def test_age_groups(spark):
    want = {None: "unknown", 24: "under 25", 25: "25-34", 34: "25-34", 35: "35-49", 49: "35-49",
            50: "50 plus"}
    for age, group in want.items():
        assert value(spark, age_group(F.lit(age).cast("int"))) == group


def test_clean_keeps_usable_rows_of_enough_length(spark):
    rows = [(1, None, "Loan", "CA", "a" * 99), (2, None, "Loan", "CA", "a" * 100),
            (3, None, "Loan", "PR", LONG), (4, None, None, "CA", LONG), (5, None, "Loan", "CA", None),
            (6, None, "Loan", None, LONG), (7, None, "Loan", "DC", "b " * 49 + " " * 50 + "c")]
    got = text.clean_complaints(complaints(spark, rows)).collect()
    assert [r.complaint_id for r in got] == [2]


def test_dedupe_takes_the_newest_and_is_stable(spark):
    rows = [(1, dt.date(2023, 1, 1), "Loan", "CA", LONG + "old"),
            (1, dt.date(2023, 5, 1), "Loan", "CA", LONG + "new"),
            (1, None, "Loan", "CA", LONG + "undated"),
            (2, None, "Loan", "CA", LONG + "x"), (2, None, "Loan", "CA", LONG + "y"),
            (3, dt.date(2023, 1, 1), "Loan", "TX", LONG), (3, dt.date(2023, 1, 1), "Loan", "TX", LONG)]
    results = [sorted(text.clean_complaints(complaints(spark, rows).repartition(n)).collect())
               for n in (1, 3, 5)]
    assert results[0] == results[1] == results[2] and len(results[0]) == 3
    assert results[0][0].narrative.endswith("new")


def test_sample_does_not_depend_on_partitions(spark):
    rows = [(i, None, "Loan", "CA", LONG) for i in range(5000)]
    picks = [{r.complaint_id for r in text.complaint_sample(complaints(spark, rows).repartition(n)).collect()}
             for n in (1, 3)]
    assert picks[0] == picks[1] and 400 < len(picks[0]) < 600


def test_months_recode_peek(spark):
    rows = [(1, dt.date(2023, 1, 31), "Loan", "CA", LONG), (2, dt.date(2023, 1, 1), "Loan", "CA", LONG),
            (3, None, "Loan", "CA", LONG * 9),
            (4, dt.date(2023, 2, 1), "Money transfer, virtual currency, or money service", "CA", LONG)]
    df = complaints(spark, rows)
    got = {(r.product, r.month): r.complaint_count for r in text.monthly_counts(df).collect()}
    assert got[("Loan", dt.datetime(2023, 1, 1))] == 2 and got[("Loan", None)] == 1
    assert text.recode_products(df).filter("product = 'Money transfers'").count() == 1
    assert max(len(r.narrative) for r in text.peek(df, rows=4).collect()) == 400


def brute_tfidf(texts, stop, min_docs, max_terms):
    docs = []
    for t in texts:
        words = [w for w in re.findall(r"\b\w\w+\b", t.lower()) if w not in stop]
        docs.append(words + [f"{a} {b}" for a, b in zip(words, words[1:])])
    vocabulary = {t for d in docs for t in d}
    df = {t: sum(t in d for d in docs) for t in vocabulary}
    total = {t: sum(d.count(t) for d in docs) for t in vocabulary}
    kept = sorted((t for t in vocabulary if df[t] >= min_docs), key=lambda t: (-total[t], t))
    kept = kept[:max_terms]
    idf = {t: math.log((1 + len(docs)) / (1 + df[t])) + 1 for t in kept}
    out = []
    for d in docs:
        row = {t: d.count(t) * idf[t] for t in kept if t in d}
        norm = math.sqrt(sum(v * v for v in row.values()))
        out.append({t: v / norm for t, v in row.items()})
    return kept, out


def test_terms_are_counted_in_arrays_in_any_steps(spark, monkeypatch):
    lists = [["b", "a", "b"], None, [], ["a", None, None], ["c c"], ["a"] * 40] * 3
    df = spark.createDataFrame([(x,) for x in lists], "terms array<string>").repartition(2)
    want = {(t, sum((x or []).count(t) for x in lists), sum(t in (x or []) for x in lists)) for t in ("a", "b", "c c", None)}
    for step in (1, 16 << 20):
        monkeypatch.setattr(occurrences, "STEP_BYTES", step)
        assert {tuple(r) for r in occurrences.occurrences(df, "terms", "term", "docs").collect()} == want
    assert occurrences.occurrences(df.filter("terms is null"), "terms", "term").collect() == []
    values, total, rows = occurrences.count_lists([pa.array([["b", "a", "b"], ["a"]]), pa.array([None, ["b"]], pa.list_(pa.string()))])
    assert values.to_pylist() == ["b", "a"] and total.tolist() == [3, 2] and rows.tolist() == [2, 2]


def test_only_different_terms_of_a_step_leave_its_task_and_the_batch_size_is_put_back(spark):
    terms = spark.createDataFrame([(["fee", "late"] * 500,)] * 20, "terms array<string>").coalesce(1)
    batches = [pa.RecordBatch.from_pydict({"terms": [["fee", "late"] * 500] * 10})] * 2
    assert [b.num_rows for b in occurrences.counted(batches, "term", 1 << 20)] == [2]
    held = spark.conf.get(occurrences.BATCH_KEY, None)  # other tests may have set it
    try:
        spark.conf.unset(occurrences.BATCH_KEY)
        found = {tuple(r) for r in topic_model.vocabulary(terms, 10, 5).collect()}
        assert found == {("fee", 10_000, 20), ("late", 10_000, 20)}
        assert spark.conf.get(occurrences.BATCH_KEY, None) is None
        spark.conf.set(occurrences.BATCH_KEY, "1000")
        with occurrences.small_batches(spark):
            assert spark.conf.get(occurrences.BATCH_KEY) == "1000"
        assert spark.conf.get(occurrences.BATCH_KEY) == "1000"
    finally:
        spark.conf.unset(occurrences.BATCH_KEY)
        if held is not None:
            spark.conf.set(occurrences.BATCH_KEY, held)


def test_the_vocabulary_goes_to_the_jvm_whole_and_in_order(spark):
    terms = ["fee", "späte fee", "a\nb", "x"]
    model = topic_model.term_counter(terms)
    made = CountVectorizerModel.from_vocabulary(terms, inputCol="terms", outputCol="counts")
    assert model.vocabulary == terms and model.getVocabSize() == 4
    assert {p.name: v for p, v in model.extractParamMap().items()} == {p.name: v for p, v in made.extractParamMap().items()}


def test_tfidf_matches_brute_force(spark):
    texts = ["The café charged a late fee, a LATE fee!", "Über late fee and café_2 fee",
             "late café x y z", "nothing shared here", "", "fee fee fee late café"]
    stop = {"the", "and", "here"}
    df = spark.createDataFrame(list(enumerate(texts)), "id int, narrative string")
    kept, want = brute_tfidf(texts, stop, 2, 6)
    model = topic_model.fit_tfidf(df, topic_model.term_stages(stop_words=sorted(stop)), 6, 2)
    rows = model.transform(df).orderBy("id").select("features").collect()
    assert model.stages[-3].vocabulary == kept
    for row, expected in zip(rows, want):
        got = {kept[i]: v for i, v in zip(row.features.indices, row.features.values)}
        assert got == pytest.approx(expected)


def test_topics_beat_chance_and_survive_a_reload(spark, tmp_path):
    topics = {"Mortgage": "house escrow lender rate", "Card": "card purchase merchant charge",
              "Debt": "collector letter owed validate"}
    rows = [(i, name, f"{w} about my {words} issue number{i % 7} again " * 2)
            for i, (name, words, w) in enumerate(
                (n, ws, w) for n, ws in topics.items() for w in ws.split() for _ in range(15))]
    df = spark.createDataFrame(rows, "complaint_id long, product string, narrative string")
    run = topic_model.train_topics(df, iterations=50)
    assert run.macro_f1().first().macro_f1 > 0.9
    terms = {r.label: r.terms for r in topic_model.top_terms(run.model).collect()}
    assert set(terms) == set(topics) and "escrow" in terms["Mortgage"]
    run.model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m")).transform(df)
    first = run.model.transform(df)
    pick = ("complaint_id", "predicted_product")
    assert sorted(again.select(*pick).collect()) == sorted(first.select(*pick).collect())
