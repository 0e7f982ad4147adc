"""Reports over the served tables, as SQL on registered views.

Each fact is aggregated by itself and never joined to the other one, as their
grains differ. The state is joined to per-key sums, so a state with most of the
rows is already one row by then.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def churn_headline(spark: SparkSession) -> DataFrame:
    return spark.sql("""
        select count(*) as customers,
               avg(cast(churned as double)) as churn_rate,
               avg(churn_probability) as avg_probability
        from fact_churn_prediction""")


def churn_headline_by_split(spark: SparkSession) -> DataFrame:
    """The same numbers per split, so held-out customers can be read alone."""
    return spark.sql("""
        select split, count(*) as customers,
               avg(cast(churned as double)) as churn_rate,
               avg(churn_probability) as avg_probability
        from fact_churn_prediction group by split""")


def complaint_headline(spark: SparkSession) -> DataFrame:
    return spark.sql("select sum(complaint_count) as complaints from fact_complaints")


def churn_by_state(spark: SparkSession, top: int | None = None) -> DataFrame:
    ranked = spark.sql("""
        with per_state as (
            select state_sk, count(*) as customers, avg(churn_probability) as avg_probability,
                   avg(cast(churned as double)) as churn_rate
            from fact_churn_prediction group by state_sk)
        select state_code, state_name, customers, avg_probability, churn_rate
        from per_state join dim_state using (state_sk)
        order by customers desc, state_code""")
    return ranked if top is None else ranked.limit(top)


def complaints_by_state(spark: SparkSession, top: int | None = None) -> DataFrame:
    ranked = spark.sql("""
        with per_state as (
            select state_sk, sum(complaint_count) as complaints
            from fact_complaints group by state_sk)
        select state_code, state_name, complaints
        from per_state join dim_state using (state_sk)
        order by complaints desc, state_code""")
    return ranked if top is None else ranked.limit(top)
