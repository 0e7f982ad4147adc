"""The check tables in the shape the operators expect.

Each function has a twin of the same name in ``oracles.CTE``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyshore.operators.churn import label_churn
from tallyshore.operators.ordered import pin_value
from tallyshore.schemas import US_STATES

HOME = "AMERICA"
STATE_CODES = [*US_STATES, "PR", "ZZ"]  # the last two are not states
EVENT_WINDOW_DAYS = 7
STOP_WORDS = ("and", "the", "for", "with", "that", "this", "from", "not", "que", "und", "die",
              "der", "des", "les", "las", "los", "est", "une", "par", "dans")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def users(spark, folder) -> DataFrame:
    customers = table(spark, folder, "customer")
    nations = table(spark, folder, "nation")
    regions = table(spark, folder, "region")
    return (
        customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
        .selectExpr(
            "c_custkey as id",
            "cast(case when c_custkey % 17 <> 0 then 18 + c_custkey % 55 end as int) as age",
            "case when c_custkey % 2 = 0 then 'F' else 'M' end as gender",
            "n_name as state", "r_name as country", "c_mktsegment as traffic_source")
    )


def home(spark, folder) -> DataFrame:
    return users(spark, folder).filter(F.col("country") == HOME)


def orders(spark, folder) -> DataFrame:
    return table(spark, folder, "orders").selectExpr(
        "o_orderkey as order_id", "o_custkey as user_id",
        "case o_orderstatus when 'F' then 'Complete' when 'O' then 'Shipped' "
        "else 'Cancelled' end as status",
        "o_orderdate as created_at",
        "cast(1 + floor(o_totalprice / 100000) as int) as num_of_item")


def order_items(spark, folder) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    heads = table(spark, folder, "orders")
    return lines.join(heads, F.col("l_orderkey") == F.col("o_orderkey")).selectExpr(
        "l_orderkey * 10 + l_linenumber as id", "o_custkey as user_id",
        "l_partkey as product_id",
        "case when l_returnflag = 'R' then 'Returned' when o_orderstatus = 'P' "
        "then 'Cancelled' else 'Complete' end as status",
        "o_orderdate as created_at", "l_extendedprice * (1 - l_discount) as sale_price")


def products(spark, folder) -> DataFrame:
    return table(spark, folder, "part").selectExpr(
        "p_partkey as id", "p_type as category", "p_brand as department")


def events(spark, folder) -> DataFrame:
    return table(spark, folder, "events").selectExpr(
        "event_id as id", "user_id",
        "concat(user_id, '-', date_format(ts, 'yyyy-MM-dd')) as session_id",
        "ts as created_at", "event_type")


def event_cutoff(spark, folder):
    """The events are newer than all orders, so they get a cutoff of their own."""
    newest = F.max("created_at") - F.make_dt_interval(F.lit(EVENT_WINDOW_DAYS))
    return pin_value(events(spark, folder).agg(newest.alias("cutoff")))


def complaints(spark, folder) -> DataFrame:
    codes = ", ".join(f"'{c}'" for c in STATE_CODES)
    return table(spark, folder, "documents").selectExpr(
        "case when doc_id % 10 = 9 then doc_id - 1 else doc_id end as complaint_id",
        "case when doc_id % 97 <> 0 then date_add(date'2020-01-01', "
        "cast(doc_id * 7 % 1500 as int)) end as date_received",
        "lang as product",
        f"array({codes})[cast(doc_id % {len(STATE_CODES)} as int)] as state",
        "text as narrative")


def order_complaints(spark, folder) -> DataFrame:
    """Orders as complaints, for the monthly counts: some states and months are unknown."""
    heads = table(spark, folder, "orders")
    customers = table(spark, folder, "customer")
    return heads.join(customers, F.col("o_custkey") == F.col("c_custkey")).selectExpr(
        "o_orderkey as complaint_id",
        "case when o_orderkey % 101 <> 0 then cast(o_orderdate as date) end as date_received",
        "o_orderpriority as product",
        "case when o_custkey % 50 = 0 then 'ZZ' "
        "else concat('S', lpad(cast(c_nationkey as string), 2, '0')) end as state")


def states(spark, folder) -> DataFrame:
    return table(spark, folder, "nation").selectExpr(
        "concat('S', lpad(cast(n_nationkey as string), 2, '0')) as state_code",
        "n_name as state_name")


def scores(spark, folder, cutoff) -> DataFrame:
    """A made-up but deterministic score per labeled customer, with ties."""
    labels = label_churn(orders(spark, folder), cutoff)
    people = home(spark, folder).selectExpr("id as user_id", "state")
    return made_up_scores(labels.join(people, "user_id"))


def made_up_scores(labeled) -> DataFrame:
    return labeled.selectExpr(
        "user_id", "case when user_id % 40 = 0 then 'Nowhere' else state end as state", "churned",
        "(user_id * 7919 % 1000) / 1000.0D as churn_probability",
        "case user_id % 5 when 0 then 'test' when 1 then 'validation' else 'train' end as split")


def scored_documents(spark, folder) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "lang", "n_chars")
    return table(spark, folder, "labels").join(docs, "doc_id").selectExpr(
        "doc_id", "quality as label", "((n_chars * 31 + doc_id) % 997) / 997.0D as probability",
        "if(((n_chars * 31 + doc_id) % 997) / 997.0D >= 0.5D, 1, 0) as prediction")


def guessed_languages(spark, folder) -> DataFrame:
    """'es' is never guessed."""
    return table(spark, folder, "documents").selectExpr(
        "lang as label",
        "case when doc_id % 5 = 0 or lang = 'es' then 'en' when doc_id % 7 = 0 then 'fr' "
        "else lang end as prediction")
