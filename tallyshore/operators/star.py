"""Star schema: two facts over conformed dimensions, and its integrity checks.

The state dimension holds both the code and the name of a state, so one fact
can look it up by name and the other by code and both get the same key.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyshore.functions.columns import age_group, date_key
from tallyshore.operators.ordered import number_rows, pin_small
from tallyshore.schemas import US_STATES

# Keys and columns of the served tables, dimensions first.
PRIMARY_KEYS = {
    "dim_state": ("state_sk",), "dim_date": ("date_sk",), "dim_customer": ("user_sk",),
    "dim_product": ("product_sk",), "fact_churn_prediction": ("user_sk", "date_sk"),
    "fact_complaints": ("state_sk", "product_sk", "date_sk"),
}
UNIQUE_COLUMNS = {
    "dim_state": ("state_code",), "dim_date": ("full_date",), "dim_customer": ("user_id",),
    "dim_product": ("product_name",),
}
REQUIRED_COLUMNS = {
    "dim_state": ("state_sk", "state_code", "state_name"),
    "dim_date": ("date_sk", "full_date", "year", "month", "month_name"),
    "dim_customer": ("user_sk", "user_id"),
    "dim_product": ("product_sk", "product_name"),
    "fact_churn_prediction": ("user_sk", "state_sk", "date_sk", "churn_probability", "churned"),
    "fact_complaints": ("state_sk", "product_sk", "date_sk", "complaint_count"),
}
FOREIGN_KEYS = {
    ("fact_churn_prediction", "user_sk"): "dim_customer",
    ("fact_churn_prediction", "state_sk"): "dim_state",
    ("fact_churn_prediction", "date_sk"): "dim_date",
    ("fact_complaints", "state_sk"): "dim_state",
    ("fact_complaints", "product_sk"): "dim_product",
    ("fact_complaints", "date_sk"): "dim_date",
}


def us_states(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(US_STATES.items()), "state_code string, state_name string")


def _numbered(df: DataFrame, name: str, order: str) -> DataFrame:
    """1-based int keys by natural order, of any number of rows."""
    return number_rows(df, order, name).withColumn(name, F.col(name).cast("int"))


def dim_state(states: DataFrame) -> DataFrame:
    """States numbered by code; a few dozen rows, so in one small window."""
    number = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("state_code"))
    return states.select("state_code", "state_name").distinct().select(number.alias("state_sk"), "*")


def dim_product(stats: DataFrame) -> DataFrame:
    names = stats.select(F.col("product").alias("product_name")).filter(
        F.col("product_name").isNotNull()).distinct()
    return _numbered(pin_small(names), "product_sk", "product_name")


def dim_date(stats: DataFrame, scoring_date: Column) -> DataFrame:
    """The scoring date and every month in the complaint statistics, once each."""
    months = stats.select(F.to_date("month").alias("full_date"))
    scored = stats.sparkSession.range(1).select(F.to_date(scoring_date).alias("full_date"))
    day = F.col("full_date")
    return (
        months.union(scored).filter(day.isNotNull()).distinct()
        .select(date_key("full_date").alias("date_sk"), day,
                F.year(day).alias("year"), F.month(day).alias("month"),
                F.date_format(day, "MMMM").alias("month_name"))
    )


def dim_customer(dataset: DataFrame) -> DataFrame:
    """One row per customer, numbered by user_id without a single-task sort."""
    one = dataset.groupBy("user_id").agg(
        F.min(F.struct("age", "gender", "traffic_source")).alias("_row"))
    flat = one.select("user_id", "_row.*")
    return number_rows(flat, "user_id", "user_sk").select(
        "user_sk", "user_id", "age", age_group("age").alias("age_group"), "gender",
        "traffic_source")


def resolve_churn(
    scores: DataFrame, customers: DataFrame, states: DataFrame, scoring_date: Column
) -> DataFrame:
    """Scores with looked-up keys; a key that is not found stays null."""
    return (
        scores.join(customers.select("user_id", "user_sk"), "user_id", "left")
        .join(states.select(F.col("state_name").alias("state"), "state_sk"), "state", "left")
        .select("user_sk", "state_sk", date_key(scoring_date).alias("date_sk"),
                F.col("churn_probability").cast("double").alias("churn_probability"),
                F.col("churned").cast("int").alias("churned"), "split")
    )


def resolve_complaints(stats: DataFrame, states: DataFrame, products: DataFrame) -> DataFrame:
    """Complaint counts with looked-up keys; a missing month has no date key."""
    return (
        stats.join(states.select(F.col("state_code").alias("state"), "state_sk"), "state", "left")
        .join(products.select(F.col("product_name").alias("product"), "product_sk"),
              "product", "left")
        .select("state_sk", "product_sk", date_key("month").alias("date_sk"), "complaint_count")
    )


def resolved(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    return df.dropna(subset=list(keys))


CHURN_KEYS = ("user_sk", "state_sk")
COMPLAINT_KEYS = ("state_sk", "product_sk", "date_sk")


class Star(Mapping):
    """The six served tables, dimensions first, each worked out when it is asked for.

    Facts look their keys up in the dimensions of this mapping: those that were put
    in by ``keep`` once they are written, else the frames that define them.
    """

    def __init__(self, dataset: DataFrame, scores: DataFrame, stats: DataFrame, scoring_date: Column,
                 states: DataFrame | None = None):
        self._made: dict[str, DataFrame] = {}
        self.scores, self.stats = scores, stats
        small = us_states(stats.sparkSession) if states is None else states
        self._makers = {
            "dim_state": lambda: dim_state(small),
            "dim_date": lambda: dim_date(stats, scoring_date),
            "dim_customer": lambda: dim_customer(dataset),
            "dim_product": lambda: dim_product(stats),
            "fact_churn_prediction": lambda: resolved(
                resolve_churn(scores, self["dim_customer"], self["dim_state"], scoring_date), CHURN_KEYS),
            "fact_complaints": lambda: resolved(
                resolve_complaints(stats, self["dim_state"], self["dim_product"]), COMPLAINT_KEYS),
        }

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._makers[name]()
        return self._made[name]

    def __iter__(self):
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)

    def keep(self, name: str, written: DataFrame) -> None:
        self._made[name] = written

    def load(self, write: Callable[[DataFrame, str], DataFrame], names: Sequence[str] | None = None) -> dict[str, DataFrame]:
        """Writes tables by ``write``, which gives them back as written, dimensions before the facts that use them."""
        for name in [n for n in self if names is None or n in names]:
            self.keep(name, write(self[name], name))
        return {name: self._made[name] for name in self if name in self._made}

    def summary(self) -> DataFrame:
        """table_name, rows, dropped. A fact has dropped the source rows that it lacks, as a lookup adds none."""
        sources = {"fact_churn_prediction": self.scores, "fact_complaints": self.stats}
        counts = [df.agg(F.count("*").alias("n")).select(
            F.lit(name).alias("table_name"), F.lit(kind).alias("kind"), "n")
            for kind, tables in (("rows", self), ("given", sources)) for name, df in tables.items()]
        rows, given = (F.sum(F.when(F.col("kind") == kind, F.col("n")).otherwise(0)) for kind in ("rows", "given"))
        return reduce(DataFrame.unionByName, counts).groupBy("table_name").agg(
            rows.alias("rows"), F.greatest(given - rows, F.lit(0)).alias("dropped"))


def build_star(
    dataset: DataFrame, scores: DataFrame, stats: DataFrame, scoring_date: Column,
    states: DataFrame | None = None,
) -> tuple[Star, DataFrame]:
    """The six served tables, and the load summary as of the frames that define them."""
    tables = Star(dataset, scores, stats, scoring_date, states)
    return tables, tables.summary()


def _key_text(columns: Sequence[str]) -> Column:
    """One text per key: each value with its length in front, so that no two keys share one; null has none."""
    texts = [F.col(c).cast("string") for c in columns]
    return F.concat(*[F.when(t.isNull(), "-").otherwise(F.concat(F.length(t), F.lit(":"), t)) for t in texts])


def integrity_checks(tables: Mapping[str, DataFrame]) -> DataFrame:
    """check_name, table_name, columns, violations. All violations are 0 in a sound load.

    Each table is read once. A row gives one cell for every constraint it takes
    part in: the constraint, the key itself, and whether it owns the key, refers to
    it, or lacks a value. All cells meet in one aggregate, merged before the shuffle.
    Violations are keys that occur again, rows with a gap, and rows that refer to no key.
    """
    checks: list[tuple[int, str, str, str]] = []
    cells: dict[str, list[Column]] = {table: [] for table in tables}

    def add(check: str, table: str, columns: Sequence[str]) -> int:
        checks.append((len(checks), check, table, ",".join(columns)))
        return len(checks) - 1

    def cell(table: str, number: int, key: Column, role: str, counts: Column | None = None) -> None:
        made = F.struct(F.lit(number).alias("number"), key.alias("key"), *[
            F.lit(int(r == role)).cast("long").alias(r) for r in ("owns", "refers", "lacks")])
        cells[table].append(made if counts is None else F.when(counts, made))

    for check, keys in (("primary key", PRIMARY_KEYS), ("unique", UNIQUE_COLUMNS)):
        for table, columns in keys.items():
            cell(table, add(check, table, columns), _key_text(columns), "owns")
    for table, columns in REQUIRED_COLUMNS.items():
        gaps = reduce(Column.__or__, [F.col(c).isNull() for c in columns])
        cell(table, add("not null", table, columns), F.lit(""), "lacks", gaps)
    for (table, column), target in FOREIGN_KEYS.items():
        number = add("foreign key", table, [column])
        cell(table, number, _key_text([column]), "refers", F.col(column).isNotNull())
        cell(target, number, _key_text([column]), "owns")
    kinds = ("owns", "refers", "lacks")
    found = reduce(DataFrame.unionByName, [
        df.select(F.explode(F.array_compact(F.array(*cells[name]))).alias("cell")).select("cell.*")
        for name, df in tables.items()])
    keyed = found.groupBy("number", "key").agg(*[F.sum(k).alias(k) for k in kinds])
    listed = tables["dim_state"].sparkSession.createDataFrame(
        checks, "number int, check_name string, table_name string, columns string")
    repeated = (F.col("owns") > 1).cast("long")
    orphans = F.when(F.col("owns") == 0, F.col("refers")).otherwise(0)
    totals = keyed.groupBy("number").agg(
        F.sum(repeated).alias("repeated"), F.sum(orphans).alias("orphans"), F.sum("lacks").alias("gaps"))
    violations = (
        F.when(F.col("check_name") == "foreign key", F.col("orphans"))
        .when(F.col("check_name") == "not null", F.col("gaps")).otherwise(F.col("repeated")))
    return listed.join(F.broadcast(totals), "number", "left").select(  # one row per constraint
        "check_name", "table_name", "columns", F.coalesce(violations, F.lit(0)).cast("long").alias("violations"))
