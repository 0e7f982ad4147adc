"""Star schema, checks, and the jobs from raw files to reports."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallyshore.operators import star
from tallyshore.plans import churn_model, jobs
from tallyshore.schemas import COMPLAINT_COLUMNS, US_STATES, shop_schema
from tests.test_sources import complaint, write_csv

DAY = dt.datetime(2023, 7, 21, 6, 54)


def parts(spark):
    dataset = spark.createDataFrame(
        [(7, 24, "F", "Email"), (3, None, "M", "Search"), (11, 50, None, "Email")],
        "user_id long, age int, gender string, traffic_source string")
    scores = spark.createDataFrame(
        [(7, "California", 1, 0.9, "train"), (3, "Texas", 0, 0.2, "test"),
         (11, "Bavaria", 1, 0.5, "train"), (99, "Texas", 1, 0.5, "train")],
        "user_id long, state string, churned int, churn_probability double, split string")
    stats = spark.createDataFrame(
        [("CA", "Loan", dt.datetime(2023, 7, 1), 5), ("TX", "Card", dt.datetime(2023, 8, 1), 2),
         ("ZZ", "Card", dt.datetime(2023, 8, 1), 3), ("TX", None, dt.datetime(2023, 8, 1), 1),
         ("TX", "Card", None, 4)],
        "state string, product string, month timestamp, complaint_count long")
    return dataset, scores, stats


def test_star_conforms_resolves_and_counts_dropped_rows(spark):
    tables, summary = star.build_star(*parts(spark), F.lit(str(DAY)).cast("timestamp"))
    rows = {n: df.collect() for n, df in tables.items()}
    assert len(rows["dim_state"]) == 51
    keys = {r.state_name: r.state_sk for r in rows["dim_state"]}
    assert [r.product_name for r in sorted(rows["dim_product"])] == ["Card", "Loan"]
    assert sorted(r.date_sk for r in rows["dim_date"]) == [20230701, 20230721, 20230801]
    assert {r.month_name for r in rows["dim_date"]} == {"July", "August"}
    assert [(r.user_sk, r.user_id, r.age_group) for r in sorted(rows["dim_customer"])] == [
        (1, 3, "unknown"), (2, 7, "under 25"), (3, 11, "50 plus")]
    churn = {r.user_sk: r for r in rows["fact_churn_prediction"]}
    assert churn[2].state_sk == keys["California"] and churn[2].date_sk == 20230721
    assert churn[1].split == "test" and len(churn) == 2
    complaints = rows["fact_complaints"]
    assert {(r.state_sk, r.complaint_count) for r in complaints} == {
        (keys["California"], 5), (keys["Texas"], 2)}
    counts = {r.table_name: (r.rows, r.dropped) for r in summary.collect()}
    assert counts["fact_churn_prediction"] == (2, 2) and counts["fact_complaints"] == (2, 3)
    assert star.integrity_checks(tables).filter("violations > 0").isEmpty()


def test_integrity_finds_each_kind_of_violation(spark):
    tables, _ = star.build_star(*parts(spark), F.lit(str(DAY)).cast("timestamp"))
    tables = dict(tables)
    tables["dim_product"] = tables["dim_product"].union(tables["dim_product"].limit(1))
    tables["dim_date"] = tables["dim_date"].filter("date_sk <> 20230721")
    tables["dim_customer"] = tables["dim_customer"].withColumn(
        "user_id", F.when(F.col("user_id") != 7, F.col("user_id")))
    found = {(r.check_name, r.table_name): r.violations
             for r in star.integrity_checks(tables).filter("violations > 0").collect()}
    assert found == {("primary key", "dim_product"): 1, ("unique", "dim_product"): 1,
                     ("not null", "dim_customer"): 1, ("foreign key", "fact_churn_prediction"): 2}


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    """Small raw files in which recent, frequent buyers tend to come back."""
    folder = tmp_path_factory.mktemp("raw")
    rng = random.Random(8)
    names = list(US_STATES.values())
    start = dt.datetime(2023, 1, 1)
    users, orders, items, events = [], [], [], []
    for u in range(1, 241):
        users.append([u, "A", "B", "e", rng.randint(18, 70), rng.choice("FM"), names[u % 51], "s",
                      "p", "c", "United States" if u % 6 else "France", 1.5, 2.5,
                      rng.choice(["Search", "Email"]), "2022-01-01 00:00:00"])
        loyal = u % 3 == 0
        for _ in range(6 if loyal else 2):
            day = rng.uniform(60, 400) if loyal else rng.uniform(0, 215)
            at = (start + dt.timedelta(days=day)).strftime("%Y-%m-%d %H:%M:%S")
            orders.append([len(orders) + 1, u, "Complete", "F", at, "", "", "", 1])
            items.append([len(items) + 1, len(orders), u, rng.randint(1, 9), 1, "Complete", at, "",
                          "", "", round(rng.uniform(5, 90), 2)])
            events.append([len(events) + 1, f"{u}.0", 1, f"s{len(events) // 2}", at, "i", "c", "s",
                           "p", "b", "Search", "/", rng.choice(["cart", "home"])])
    tables = {
        "users": users, "orders": orders, "order_items": items, "events": events,
        "products": [[i, 1.0, f"c{i % 4}", "n", "b", 2.0, "Men", "s", 1] for i in range(1, 10)],
        "distribution_centers": [[1, "A", 1.0, 2.0]],
        "inventory_items": [[1, 1, "2023-01-01 00:00:00", "", 1.0, "c", "n", "b", 2.0, "Men", "s", 1]],
    }
    for name, rows in tables.items():
        write_csv(folder / f"{name}.csv", rows, header=shop_schema(name).names)
    topics = {"Mortgage": "escrow lender house", "Card": "purchase merchant card"}
    texts = []
    for i in range(600):
        product = list(topics)[i % 2]
        words = topics[product].split()
        body = f"My {rng.choice(words)} {rng.choice(words)} XXXX problem,\n" * 5
        texts.append(complaint(i, body, f"2023-0{1 + i % 9}-11T15:12:42.000Z", product,
                               list(US_STATES)[i % 51]))
    write_csv(folder / "complaints.csv", texts, header=list(COMPLAINT_COLUMNS))
    return folder


def test_jobs_end_to_end(spark, raw, tmp_path):
    out, models = str(tmp_path / "out"), str(tmp_path / "models")
    checked = {r.table_name: r for r in jobs.check_raw(spark, str(raw)).collect()}
    assert len(checked) == 7 and checked["users"].rows == 240
    assert all(r.missing_keys == 0 for r in checked.values())
    load = jobs.check_complaints(spark, f"{raw}/complaints.csv")
    assert tuple(load["complaints"].first()) == (600, 600)
    assert load["complaint columns"].count() == len(COMPLAINT_COLUMNS)
    looks = jobs.explore(spark, str(raw))
    assert looks["rows"].count() == 7 and looks["gap percentiles"].first().p50 is not None

    summary = jobs.build_dataset(spark, str(raw), out).first()
    assert summary.customers > 100 and 0 < summary.churn_rate < 1

    made = jobs.prepare_complaints(spark, f"{raw}/complaints.csv", out)
    assert made["stats"].agg(F.sum("complaint_count")).first()[0] == 600
    assert 30 < made["sample"].count() < 90
    assert made["sample"].filter("narrative like '%XX%'").isEmpty()

    validation = {r.model: r for r in jobs.train_churn_model(
        spark, out, models, trees=20, max_depth=5, rounds=5).collect()}
    assert validation[churn_model.BASELINE].roc_auc == 0.5
    assert max(r.roc_auc for r in validation.values()) > 0.6
    scores = spark.read.parquet(f"{out}/churn_scores")
    confusion = spark.read.json(f"{models}/churn_confusion")
    held = dict(scores.groupBy("split").count().collect())
    assert {(r.model, r.split): r["sum(rows)"] for r in confusion.groupBy("model", "split").sum("rows").collect()
            if r.split == "validation"} == {(m, "validation"): held["validation"] for m in validation}
    assert confusion.filter("split = 'test'").agg(F.sum("rows")).first()[0] == held["test"]
    weights = spark.read.json(f"{models}/churn_importances")
    assert weights.filter("importance < 0").isEmpty()
    assert all(abs(total - 1) < 1e-9 for _, total in weights.groupBy("model").sum("importance").collect())
    assert scores.count() == summary.customers
    assert {r.split for r in scores.select("split").distinct().collect()} == {
        "train", "validation", "test"}
    best = churn_model.load_model(f"{models}/churn_model")
    data = spark.read.parquet(f"{out}/churn_dataset").withColumn("split", F.lit("x"))
    again = {r.user_id: r.churn_probability for r in churn_model.score_customers(best, data).collect()}
    assert again == {r.user_id: r.churn_probability for r in scores.collect()}

    assert jobs.train_topic_model(spark, out, models, min_docs=2).first().macro_f1 > 0.9

    loaded = {r.table_name: r for r in jobs.build_star(spark, out).collect()}
    assert loaded["fact_churn_prediction"].rows == summary.customers
    assert loaded["fact_complaints"].dropped == 0
    reports = jobs.reports(spark, out, top=5)
    assert reports["churn"].first().customers == summary.customers
    assert reports["complaints"].first().complaints == 600
    assert reports["churn by state"].count() == 5
    looks = jobs.inspect_models(spark, out, models)
    assert 0 < looks["importances"].count() <= 15
    assert looks["terms"].count() == 2 and looks["texts"].count() == 3
    assert looks["score histogram"].agg(F.sum("rows")).first()[0] == scores.filter("split = 'test'").count()


def test_training_does_not_depend_on_the_layout(spark, raw, tmp_path):
    jobs.build_dataset(spark, str(raw), str(tmp_path))
    data = spark.read.parquet(f"{tmp_path}/churn_dataset")
    runs = [churn_model.train_churn(data.repartition(n), trees=10, max_depth=4, rounds=3)
            for n in (1, 5)]
    a, b = [{r.model: (r.roc_auc, r.pr_auc) for r in run.validation.collect()} for run in runs]
    assert a.pop("logistic_regression") == pytest.approx(b.pop("logistic_regression"))
    assert a == b
    unseen = data.limit(1).withColumns({"state": F.lit("Atlantis"), "gender": F.lit(None).cast("string")})
    scored = churn_model.score_customers(
        runs[0].models["random_forest"], unseen.withColumn("split", F.lit("x"))).first()
    assert 0 <= scored.churn_probability <= 1
    top = churn_model.feature_importances(runs[0].models["random_forest"], runs[0].names).collect()
    assert len(top) == 15 and top[0].importance > 0.05 and "=" not in top[0].feature
