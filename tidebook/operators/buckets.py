"""Trade-tape features in tumbling time buckets, and their as-of join to snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidebook.functions.windows import ordered, rows, running
from tidebook.operators.fusion import asof

EPS = 1e-9


def bucket(us: str, width_us: int) -> Column:
    """Start of the tumbling bucket, in microseconds."""
    return F.expr(f"({us} div {width_us}) * {width_us}")


def flow(trades: DataFrame, width_us: int, by: list[str] | None = None, us: str = "us") -> DataFrame:
    """By bucket: volume, signed volume, counts, mean price, true VWAP, range and derived shares."""
    by = by or []
    buy = F.col("side") == "buy"
    g = trades.groupBy(*by, bucket(us, width_us).alias("bucket")).agg(
        F.sum("size").alias("vol"), F.sum(F.when(buy, F.col("size")).otherwise(-F.col("size"))).alias("ofi_raw"), F.count_if(buy).alias("buy_count"), F.count_if(~buy).alias("sell_count"),
        F.count("*").alias("trade_count"), F.avg("price").alias("mean_price"), F.sum(F.col("price") * F.col("size")).alias("_pv"), F.max("price").alias("high"), F.min("price").alias("low"),
    )
    return g.withColumns({
        "true_vwap": F.when(F.col("vol") > 0, F.col("_pv") / F.col("vol")).otherwise(F.col("mean_price")),
        "directional_bias": F.col("buy_count") - F.col("sell_count"),
        "buy_ratio": F.col("buy_count") / F.col("trade_count"),
        "range": F.col("high") - F.col("low"),
        "range_pct": F.when(F.col("low") != 0, (F.col("high") - F.col("low")) / F.col("low")),
    }).drop("_pv")


def merged(trades: DataFrame, fast_us: int, mid_us: int, slow_us: int, us: str = "us", by: list[str] | None = None) -> DataFrame:
    """By group, fast buckets with the mid and slow bucket that start at the same time, null where none does."""
    by = by or []
    name = lambda df, tag, cols: df.select(*by, "bucket", *[F.col(c).alias(f"{c}_{tag}") for c in cols])
    common = ["vol", "ofi_raw", "buy_count", "sell_count", "trade_count", "mean_price"]
    fast = name(flow(trades, fast_us, by, us), "fast", [*common, "directional_bias", "buy_ratio"])
    mid = name(flow(trades, mid_us, by, us), "mid", [*common, "directional_bias", "buy_ratio", "high", "low", "range_pct"])
    slow = name(flow(trades, slow_us, by, us), "slow", [*common, "high", "low", "range"])
    return fast.join(mid, [*by, "bucket"], "left").join(slow, [*by, "bucket"], "left")


def derived(m: DataFrame, by: list[str] | None = None) -> DataFrame:
    """merged() with surges, absorption, deviation, momentum, realised volatility and cumulative flow.

    Windows count rows of the merged table in bucket order within a group of by (a day, or a symbol's day) and
    skip nulls; at the end nulls become 0. Without by all buckets are one group, and one task.
    """
    by, o = by or [], ["bucket"]
    col = F.col
    m = m.withColumns({
        "vol_ma": F.avg("vol_mid").over(rows(by, o, 6)), "range_ma": F.avg("range_pct_mid").over(rows(by, o, 6)),
        "price_cum": F.avg("mean_price_mid").over(rows(by, o, 1000)), "cum_ofi_mid": F.sum("ofi_raw_mid").over(running(by, o)), "cum_ofi_slow": F.sum("ofi_raw_slow").over(running(by, o)),
        "_before": F.last("mean_price_mid", ignorenulls=True).over(ordered(by, o).rowsBetween(-(1 << 30), -1)),
    })
    m = m.withColumns({
        "vol_surge": col("vol_mid") / (col("vol_ma") + EPS), "range_surge": col("range_pct_mid") / (col("range_ma") + EPS),
        "price_dev_bps": F.when(col("price_cum") != 0, (col("mean_price_mid") - col("price_cum")) / col("price_cum") * 1e4),
        "momentum": F.abs("ofi_raw_mid") * col("range_pct_mid") * 1e4, "ofi_ratio": col("ofi_raw_mid") / (col("vol_mid") + 1),
        "_change": F.when(col("_before") != 0, (col("mean_price_mid") - col("_before")) / col("_before")),
    })
    m = m.withColumns({"absorption": col("vol_surge") / (col("range_surge") + 1e-10), "realized_vol_mid": F.stddev_samp("_change").over(rows(by, o, 6)) * 1e4})
    m = m.withColumn("realized_vol_slow", col("realized_vol_mid") * F.sqrt(F.lit(6.0))).drop("_before", "_change")
    return m.fillna(0)


def onto(snapshots: DataFrame, features: DataFrame, width_us: int, values: list[str], by: list[str] | None = None, us: str = "us", seq: str = "seq", on_start: bool = False) -> DataFrame:
    """snapshots with the values of the last bucket that has ended (with on_start: begun) by then, 0 if none.

    Joining on the start sees trades after the snapshot, up to one bucket ahead.
    """
    by = by or ["day"]
    at = F.col("bucket") if on_start else F.col("bucket") + width_us
    right = features.select(*[c for c in by], at.alias(us), *values)
    return asof(snapshots, right, by, us, seq, values).fillna(0, subset=values)
