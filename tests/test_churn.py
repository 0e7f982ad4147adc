"""Cutoff, label, gaps, sweep and features on literal rows."""

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tallyshore.operators import churn, features
from tallyshore.schemas import DATASET_COLUMNS

D = dt.datetime
ORDERS = "order_id long, user_id long, status string, created_at timestamp, num_of_item int"
ITEMS = ("id long, user_id long, product_id long, status string, created_at timestamp, "
         "sale_price double")
EVENTS = "id long, user_id long, session_id string, created_at timestamp, event_type string"
USERS = "id long, age int, gender string, state string, country string, traffic_source string"


def utc(*parts):
    return D(*parts, tzinfo=dt.timezone.utc)


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


LAST = utc(2024, 1, 17, 6, 54)
CUT = LAST - dt.timedelta(days=180)
US = dt.timedelta(microseconds=1)


@pytest.fixture(scope="module")
def orders(spark):
    rows = [
        (1, 1, "Complete", CUT, 2),                       # exactly at the cutoff: in scope
        (2, 2, "Shipped", CUT + US, 1),                   # only after it: not in scope
        (3, 3, "Returned", CUT - dt.timedelta(days=10), 3),
        (4, 3, "Processing", LAST, 1),                    # comes back
        (5, 4, "Complete", CUT - dt.timedelta(days=20), 1),
        (6, 4, "Cancelled", LAST, 9),                     # a cancelled return does not count
        (7, 5, "Cancelled", CUT - dt.timedelta(days=5), 1),
        (8, None, "Complete", CUT - dt.timedelta(days=5), 1),
        (9, 6, None, CUT - dt.timedelta(days=5), 1),
        (10, 6, "Mislaid", CUT - dt.timedelta(days=5), 1),
        (11, 7, "Cancelled", LAST + dt.timedelta(days=90), 1),  # newest of all, but cancelled
    ]
    return frame(spark, rows, ORDERS)


def test_cutoff_is_newest_purchase_minus_window(spark, orders):
    text = spark.range(1).select(churn.cutoff_date(orders).cast("string")).first()[0]
    assert text == "2023-07-21 06:54:00"


def test_cutoff_ignores_the_host_time_zone(spark, monkeypatch, orders):
    import time

    for zone in ("America/New_York", "Europe/Brussels", "UTC"):
        monkeypatch.setenv("TZ", zone)
        time.tzset()
        text = spark.range(1).select(churn.cutoff_date(orders).cast("string")).first()[0]
        assert text == "2023-07-21 06:54:00"
    monkeypatch.undo()
    time.tzset()


def test_label(spark, orders):
    got = {r.user_id: r.churned for r in churn.label_churn(orders, churn.cutoff_date(orders)).collect()}
    assert got == {1: 1, 3: 0, 4: 1}


def test_label_of_no_purchases_is_empty(spark, orders):
    none = orders.filter("status = 'Cancelled'")
    assert churn.label_churn(none, churn.cutoff_date(none)).count() == 0


def test_sweep_agrees_with_single_windows(spark, orders):
    for row in churn.window_sweep(orders, (1, 90, 180, 195)).collect():
        label = churn.label_churn(orders, churn.cutoff_date(orders, row.window_days))
        counts = {r.churned: r["count"] for r in label.groupBy("churned").count().collect()}
        assert (row.churned, row.retained) == (counts.get(1, 0), counts.get(0, 0))


def gap_orders(spark, hot=False):
    rng = random.Random(3)
    base = utc(2023, 1, 1)
    rows = []
    for i in range(600):
        user = 1 if hot and i % 3 == 0 else rng.randint(1, 60)
        minutes = rng.choice([rng.randint(0, 400_000), 60, 1439, 1441, 2880])
        rows.append((i, user, "Complete", base + dt.timedelta(minutes=minutes), 1))
    return rows


@pytest.mark.parametrize("hot", [False, True])
def test_gaps_percentiles_and_counts_match_brute_force(spark, hot):
    rows = gap_orders(spark, hot)
    histories = {}
    for _, user, _, at, _ in rows:
        histories.setdefault(user, []).append(at)
    pairs = [(u, a, b) for u, times in histories.items()
             for a, b in zip(sorted(times), sorted(times)[1:])]
    days = sorted((b.date() - a.date()).days for _, a, b in pairs)

    df = frame(spark, rows, ORDERS).repartition(7)
    got = churn.order_gaps(df).withColumns({
        c: F.unix_micros(c) for c in ("created_at", "prev_order_at")}).collect()
    micros = lambda t: int((t - utc(1970, 1, 1)) / US)
    assert sorted((r.user_id, r.prev_order_at, r.created_at) for r in got) == sorted(
        (u, micros(a), micros(b)) for u, a, b in pairs)
    assert sorted(r.gap_days for r in got) == days

    counts = {r.gap_days: r.gaps for r in churn.gap_counts(df).collect()}
    assert counts == {d: days.count(d) for d in set(days)}
    row = churn.gap_percentiles(df).first().asDict()
    for p in (25, 50, 75, 80, 90, 95):
        assert row[f"p{p}"] == days[-(-p * len(days) // 100) - 1]
    bins = churn.gap_histogram(df, 8).orderBy("bin").collect()
    assert len(bins) == 8 and sum(b.gaps for b in bins) == len(days)
    assert bins[-1].high == pytest.approx(days[-1])


def test_gap_across_midnight_is_one_day_and_single_orders_have_none(spark):
    rows = [(1, 1, "Complete", utc(2023, 1, 1, 23, 59), 1),
            (2, 1, "Complete", utc(2023, 1, 2, 0, 1), 1),
            (3, 2, "Complete", utc(2023, 1, 1), 1),
            (4, 3, "Complete", utc(2023, 1, 1), 1), (5, 3, "Complete", utc(2023, 1, 1), 1)]
    got = churn.order_gaps(frame(spark, rows, ORDERS)).collect()
    assert sorted((r.user_id, r.gap_days) for r in got) == [(1, 1), (3, 0)]


# --- features ---------------------------------------------------------------

YEAR_EDGE = utc(2022, 7, 21)  # midnight, 365 days before the day of the cutoff


def data(spark):
    orders = [(1, 1, "Complete", CUT, 2), (2, 1, "Complete", YEAR_EDGE, 4),
              (3, 1, "Complete", YEAR_EDGE - dt.timedelta(minutes=1), 3),
              (4, 1, "Cancelled", CUT, 50), (5, 2, "Complete", CUT, 1), (6, 3, "Shipped", LAST, 1),
              (7, 9, "Complete", CUT, 1)]
    items = [(1, 1, 10, "Complete", CUT, 10.004), (2, 1, 11, "Returned", CUT, 20.001),
             (3, 1, 12, "Cancelled", CUT, 99.0), (4, 1, 12, None, CUT, 99.0),
             (5, 1, 77, "Complete", CUT, 1.0),     # not a known product
             (6, 1, 13, "Complete", CUT, 1.0),     # a product without category
             (7, 1, 10, "Complete", CUT + US, 500.0), (8, 9, 10, "Complete", CUT, 5.0)]
    products = [(10, "Jeans", "Men"), (11, "Socks", "Men"), (12, "Hats", "Men"), (13, None, "Men")]
    events = [(1, 1, "a", CUT, "cart"), (2, 1, "a", CUT - dt.timedelta(days=2), "home"),
              (3, 1, "b", CUT - dt.timedelta(days=2), "cart"), (4, None, "c", CUT, "cart"),
              (5, 9, None, CUT, None), (6, 1, "z", CUT + US, "cart")]
    users = [(1, 30, "F", "Texas", "United States", "Search"),
             (2, None, None, "Ohio", "United States", "Email"),
             (3, 40, "M", "Ohio", "United States", "Email"),
             (4, 40, "M", "Ohio", "United States", "Email"),
             (9, 50, "M", "Bavaria", "Germany", "Email")]
    return (frame(spark, users, USERS), frame(spark, orders, ORDERS), frame(spark, items, ITEMS),
            frame(spark, products, "id long, category string, department string"),
            frame(spark, events, EVENTS))


def dataset(spark, tables, **options):
    users, *rest = tables
    return features.churn_dataset(features.home_users(users), *rest, **options)


def test_dataset(spark):
    df = dataset(spark, data(spark))
    assert tuple(df.columns) == DATASET_COLUMNS
    rows = {r.user_id: r for r in df.collect()}
    assert set(rows) == {1, 2}  # 3 has no history, 4 no orders, 9 lives elsewhere
    one = rows[1]
    assert (one.churned, one.order_count, one.recency_days, one.orders_last_365d) == (1, 3, 0, 2)
    assert one.tenure_days == 366 and one.avg_items_per_order == 3.0
    assert one.total_spent == 32.01 and one.avg_item_price == 8.0 and one.items_bought == 4
    assert one.distinct_categories == 2 and one.return_rate == 0.25
    assert (one.session_count, one.avg_events_per_session, one.cart_events) == (2, 1.5, 2)
    assert one.days_since_last_visit == 0
    two = rows[2]
    assert two.total_spent == 0 and two.session_count == 0 and two.return_rate == 0
    assert two.avg_item_price is None and two.days_since_last_visit is None and two.age is None


def test_sessions_without_id_do_not_divide_by_zero(spark):
    *_, events = data(spark)
    cut = F.lit("2023-07-21 06:54:00").cast("timestamp")
    row = features.event_features(events, cut).filter("user_id = 9").first()
    assert row.session_count == 0 and row.avg_events_per_session is None and row.cart_events == 0


def test_one_pass_equals_separate_label_and_features(spark):
    _, orders, *_ = data(spark)
    cut = churn.cutoff_date(orders)
    together = features.labeled_order_features(orders, cut)
    apart = churn.label_churn(orders, cut).join(features.order_features(orders, cut), "user_id")
    assert sorted(together.select(*apart.columns).collect()) == sorted(apart.collect())


def test_rows_after_the_cutoff_change_no_feature(spark):
    users, orders, items, products, events = data(spark)
    cut = churn.cutoff_date(orders)
    late = LAST + dt.timedelta(days=1)
    before = dataset(spark, data(spark), cutoff=cut)
    after = dataset(spark, (
        users, orders.union(frame(spark, [(90, 1, "Complete", late, 7)], ORDERS)),
        items.union(frame(spark, [(90, 1, 12, "Returned", late, 900.0)], ITEMS)), products,
        events.union(frame(spark, [(90, 1, "q", late, "cart")], EVENTS))), cutoff=cut)
    assert sorted(before.drop("churned").collect(), key=str) == sorted(
        after.drop("churned").collect(), key=str)
    assert {r.user_id: r.churned for r in after.collect()} == {1: 0, 2: 1}


def test_summary(spark):
    row = features.dataset_summary(dataset(spark, data(spark))).first()
    assert (row.customers, row.churned, row.churn_rate) == (2, 2, 1.0)


def test_exact_medians(spark):
    from tallyshore.plans.churn_model import exact_medians

    rng = random.Random(1)
    for n in (1, 2, 3, 10, 5001):
        columns = {"a": [rng.random() for _ in range(n)],
                   "b": [float(rng.choice([0, 0, 0, 1, 2])) for _ in range(n)]}
        rows = list(zip(columns["a"], columns["b"], [None] * n)) + [(None, None, None)]
        got = exact_medians(frame(spark, rows, "a double, b double, c double"), ["a", "b", "c"])
        assert got == {"a": statistics.median(columns["a"]),
                       "b": statistics.median(columns["b"]), "c": None}
