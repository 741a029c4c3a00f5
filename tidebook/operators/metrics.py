"""Classification metrics from one confusion table, and the union-over-intersection score of trading signals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidebook.functions.scalar import ratio

NO_OVERLAP = 9999.0


def confusion(df: DataFrame, truth: str = "y", predicted: str = "p") -> DataFrame:
    """(truth, predicted, n, share): counts, and each as a share of its true class."""
    g = df.groupBy(truth, predicted).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy(truth))
    return g.withColumn("share", F.round(ratio(F.col("n"), total), 6))


def class_report(df: DataFrame, truth: str = "y", predicted: str = "p") -> DataFrame:
    """By class: precision, recall, F1 and support."""
    g = df.groupBy(truth, predicted).agg(F.count("*").alias("n"))
    t = g.groupBy(F.col(truth).alias("class")).agg(F.sum("n").alias("support"), F.sum(F.when(F.col(truth) == F.col(predicted), F.col("n")).otherwise(0)).alias("hit"))
    p = g.groupBy(F.col(predicted).alias("class")).agg(F.sum("n").alias("called"))
    m = t.join(p, "class", "full").fillna(0, subset=["support", "hit", "called"])
    precision, recall = ratio(F.col("hit"), F.col("called")), ratio(F.col("hit"), F.col("support"))
    return m.select("class", F.round(precision, 6).alias("precision"), F.round(recall, 6).alias("recall"), F.round(ratio(2 * precision * recall, precision + recall), 6).alias("f1"), "support")


def totals(df: DataFrame, truth: str = "y", predicted: str = "p") -> DataFrame:
    """One row: accuracy, balanced accuracy, macro and weighted F1 over the classes that occur."""
    r = class_report(df, truth, predicted)
    n = F.sum("support")
    return r.agg(
        n.alias("n"), F.round(F.sum(F.col("recall") * F.col("support")) / n, 5).alias("accuracy"), F.round(F.avg(F.when(F.col("support") > 0, F.col("recall"))), 5).alias("balanced_accuracy"),
        F.round(F.avg("f1"), 5).alias("macro_f1"), F.round(F.sum(F.col("f1") * F.col("support")) / n, 5).alias("weighted_f1"),
    )


def log_loss(df: DataFrame, truth: str = "y", probability: str = "prob") -> DataFrame:
    """One row: mean negative log of the probability given to the true class."""
    p = F.greatest(F.lit(1e-15), F.least(F.lit(1 - 1e-15), F.element_at(F.col(probability), F.col(truth).cast("int") + 1)))
    return df.agg(F.round(-F.avg(F.log(p)), 6).alias("log_loss"))


def pt_score(df: DataFrame, truth: str = "y", predicted: str = "p", short: int = 0, long: int = 2) -> DataFrame:
    """One row: (predicted or true) over (predicted and true) for the short and the long class, and their mean; 1 is best."""

    def score(c):
        t, p = F.count_if(F.col(truth) == c), F.count_if(F.col(predicted) == c)
        both = F.count_if((F.col(truth) == c) & (F.col(predicted) == c))
        return F.when(both > 0, (t + p - both) / both).otherwise(F.lit(NO_OVERLAP))

    s, ln = score(short), score(long)
    return df.agg(F.round(s, 6).alias("pt_short"), F.round(ln, 6).alias("pt_long"), F.round((s + ln) / 2, 6).alias("pt_avg"))


def dataset_summary(df: DataFrame, by: list[str], label: str = "label", ts: str = "us") -> DataFrame:
    """By candidate: rows, class counts, balance and time range."""
    down, flat, up = (F.count_if(F.col(label) == v) for v in (-1, 0, 1))
    return df.groupBy(*by).agg(
        F.count("*").alias("n"), down.alias("n_short"), flat.alias("n_flat"), up.alias("n_long"), F.round(ratio(F.least(down, up), F.greatest(down, up)), 6).alias("balance"),
        F.min(ts).alias("first_us"), F.max(ts).alias("last_us"),
    )
