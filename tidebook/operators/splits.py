"""Temporal splits: by time of day, or by day for walk-forward evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidebook.functions.scalar import session_split


def intraday(df: DataFrame, ts: str = "ts") -> DataFrame:
    """df with split: train, val or test by time of day, null outside the session."""
    return df.withColumn("split", session_split(ts))


def walk_forward(df: DataFrame, train: float = 0.6, val: float = 0.2, day: str = "day") -> DataFrame:
    """df with split by day: the last days test, those before validation, the rest training.

    With fewer than three days validation and test take one each as far as they go.
    """
    days = df.select(day).distinct()
    n = days.count()  # one row a day
    n_test, n_val = max(1, int(n * (1 - train - val) + 1e-9)), max(1, int(n * val + 1e-9))
    if n_test + n_val >= n:
        n_test, n_val = 1, 1 if n > 1 else 0
    rank = F.dense_rank().over(Window.orderBy(day))
    split = F.when(rank > n - n_test, "test").when(rank > n - n_test - n_val, "val").otherwise("train")
    return df.join(F.broadcast(days.withColumn("split", split)), day)
