"""Time-window aggregates of the features: the last second (and five) at every snapshot, ties by position."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebook.functions.windows import rolling_time

MEANS = (
    "imb_trend_10 imb_trend_50 imb_ma_ratio_10 imb_ma_ratio_50 microprice_momentum_10 microprice_momentum_50 microprice_dev_from_ma ofi_50 ofi_100 ofi_500 "
    "bid_sweep_count ask_sweep_count vwap_dev_ticks vpin_100 ofi_L1 ofi_L2 ofi_L3 ofi_L4 ofi_L5 qi_L1 qi_L2 qi_L3 qi_L4 qi_L5 microprice_vol_20 microprice_vol_100"
).split()
DELTAS = ("delta_50", "delta_100", "delta_200")
FLAGS = ("stack_sweep_bid_flag", "stack_sweep_ask_flag", "stack_sweep_any_flag")


def compute(features: DataFrame, by: list[str] | None = None, us: str = "us", order: list[str] | None = None, short_us: int = 1_000_000, long_us: int = 5_000_000) -> DataFrame:
    """(by, order, ts_ms, 38 aggregates): means, deviations and sums over the short window, queue means over the long."""
    by, order = by or ["day"], order or ["seq"]
    short = {f"{c}_mean_1s": ("mean", c) for c in (*DELTAS, *MEANS)} | {f"{c}_std_1s": ("std", c) for c in DELTAS} | {f"{c}_sum_1s": ("sum", c) for c in FLAGS}
    out = rolling_time(features, short, by, us, order, short_us)
    out = rolling_time(out, {f"{c}_mean_5s": ("mean", c) for c in ("qi_L1", "qi_L2")}, by, us, order, long_us)
    ratio = (F.col("stack_sweep_bid_flag_sum_1s") + F.col("stack_sweep_ask_flag_sum_1s")) / (F.col("bid_sweep_count_mean_1s") + F.col("ask_sweep_count_mean_1s") + 1e-9)
    out = out.withColumn("add_cancel_ratio_1s", F.coalesce(ratio, F.lit(1.0)))
    names = [*short, "qi_L1_mean_5s", "qi_L2_mean_5s", "add_cancel_ratio_1s"]
    ms = F.expr(f"pmod({us}, 86400000000) div 1000").alias("ts_ms")
    return out.select(*by, *order, ms, *names)
