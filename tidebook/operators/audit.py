"""Cross-day aggregates and data-quality audits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidebook.functions.scalar import ratio

def union_days(parts: list[DataFrame]) -> DataFrame:
    """All days' tables as one; columns that some lack are null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def best_per_group(df: DataFrame, by: list[str], value: str, order: list[str], n: int = 1) -> DataFrame:
    """The n rows of the largest values in each group, the first by order on ties."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc(value), *order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def top_features(ranks: DataFrame, item: str, n: int = 20) -> DataFrame:
    """The n items of the lowest mean rank, the first by name on ties; a report, so a limit."""
    return ranks.orderBy("mean_rank", item).limit(n)


def mean_ranks(df: DataFrame, by: list[str], item: str, value: str) -> DataFrame:
    """By item: mean, deviation and number of its average ranks, the largest value of a group ranking first."""
    w, peers = Window.partitionBy(*by).orderBy(F.desc(value)), Window.partitionBy(*by, value)
    ranked = df.withColumn("_r", F.rank().over(w) + (F.count("*").over(peers) - 1) / 2.0)
    return ranked.groupBy(item).agg(F.round(F.avg("_r"), 6).alias("mean_rank"), F.round(F.stddev_samp("_r"), 6).alias("std_rank"), F.count("*").alias("n"))


def class_distribution(df: DataFrame, by: list[str], label: str) -> DataFrame:
    """By group and label: count and percentage."""
    g = df.groupBy(*by, label).agg(F.count("*").alias("n"))
    return g.withColumn("pct", F.round(F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy(*by)), 6))


def row_counts(df: DataFrame, by: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("n"))


def count_stats(counts: DataFrame) -> DataFrame:
    """One row: mean, population deviation, median, least and most of the counts above 0."""
    c = counts.filter("n > 0")
    return c.agg(F.round(F.avg("n"), 6).alias("mean"), F.round(F.stddev_pop("n"), 6).alias("std"), F.round(F.median("n"), 6).alias("median"), F.min("n").alias("least"), F.max("n").alias("most"))


def count_anomalies(counts: DataFrame, most: float = 3.0) -> DataFrame:
    """counts with z and whether it is beyond most deviations from the mean of the counts above 0."""
    s = counts.filter("n > 0").agg(F.avg("n").alias("_m"), F.stddev_pop("n").alias("_s"))
    z = ratio(F.col("n") - F.col("_m"), F.col("_s"))
    return counts.join(F.broadcast(s), F.lit(True)).select(*counts.columns, F.round(z, 6).alias("z"), (F.abs(z) > most).alias("anomaly"))  # s: one row


def null_rates(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """By column: share of null or NaN cells in percent, in one pass."""
    kinds = dict(df.dtypes)
    columns = columns or df.columns
    missing = lambda c: F.col(c).isNull() | F.isnan(c) if kinds[c] in ("double", "float") else F.col(c).isNull()
    one = df.agg(F.count("*").alias("_n"), *[F.count_if(missing(c)).alias(c) for c in columns])
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("missing")) for c in columns]))
    return one.select("_n", cells.alias("x")).select("x.column", "x.missing", F.round(ratio(F.col("x.missing") * 100.0, F.col("_n")), 6).alias("pct"))


def duplicates(df: DataFrame, by: list[str], key: str) -> DataFrame:
    """By group: rows, rows beyond the first of each key, and their percentage."""
    g = df.groupBy(*by, key).agg(F.count("*").alias("c")).groupBy(*by).agg(F.sum("c").alias("n"), F.sum(F.col("c") - 1).alias("duplicates"))
    return g.withColumn("pct", F.round(F.col("duplicates") * 100.0 / F.col("n"), 6))


def missing(expected: DataFrame, actual: DataFrame, on: list[str]) -> DataFrame:
    """Expected keys that have no output."""
    return expected.select(*on).distinct().join(actual.select(*on).distinct(), on, "left_anti")


def constant_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """By column: number of distinct values and whether there is at most one."""
    one = df.agg(*[F.count_distinct(c).alias(c) for c in columns])
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_distinct")) for c in columns]))
    return one.select(cells.alias("x")).select("x.column", "x.n_distinct", (F.col("x.n_distinct") <= 1).alias("constant"))


def last_by(df: DataFrame, key: list[str], order: str, values: list[str]) -> DataFrame:
    """By key the values of its last row: later rows win."""
    return df.groupBy(*key).agg(F.max_by(F.struct(*values), order).alias("_v")).select(*key, "_v.*")


def matched(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """One row: rows of left with and without a partner."""
    flag = left.join(right.select(*on).distinct().withColumn("_hit", F.lit(True)), on, "left")
    return flag.agg(F.count_if("_hit").alias("n_matched"), F.count_if(F.col("_hit").isNull()).alias("n_missing"))


def command_counts(events: DataFrame, by: list[str] | None = None) -> DataFrame:
    """By command: records, and those that end a batch."""
    return events.groupBy(*(by or []), "command_name").agg(F.count("*").alias("n"), F.count_if("end_of_batch").alias("n_end_of_batch"))


def categories(features: list[str]) -> dict[str, str]:
    """Feature name -> family, by name parts."""
    rules = (("vpin", "toxicity"), ("vwap", "price"), ("microprice", "price"), ("sweep", "book"), ("qi_", "book"), ("imb", "book"), ("ofi", "flow"), ("delta", "flow"), ("spread", "book"))
    return {f: next((family for part, family in rules if part in f), "other") for f in features}
