"""Tape buckets and CUSUM sampling over streams.

Late data has no meaning in the batch pipeline; here rows later than the watermark are dropped.
"""

from __future__ import annotations

from typing import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def bucket_flow(trades: DataFrame, width: str = "1 second", late: str = "0 seconds") -> DataFrame:
    """Volume, signed volume, counts, mean price and range of each closed bucket of a stream of (ts, price, size, side)."""
    buy = F.col("side") == "buy"
    return (
        trades.withWatermark("ts", late)
        .groupBy(F.window("ts", width))
        .agg(
            F.sum("size").alias("vol"), F.sum(F.when(buy, F.col("size")).otherwise(-F.col("size"))).alias("ofi_raw"), F.count_if(buy).alias("buy_count"), F.count_if(~buy).alias("sell_count"),
            F.count("*").alias("trade_count"), F.avg("price").alias("mean_price"), F.max("price").alias("high"), F.min("price").alias("low"),
        )
        .select(F.col("window.start").alias("bucket"), "vol", "ofi_raw", "buy_count", "sell_count", "trade_count", "mean_price", "high", "low")
    )


def cusum(mids: DataFrame, h: float, by: str = "symbol") -> DataFrame:
    """(by, seq, s) of the rows of a stream of (by, seq, mid) at which the running change leaves the band h.

    The state of a key is its last value and its sum; rows of one micro-batch are taken in seq order.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, total = state.get if state.exists else (None, 0.0)
        parts = list(batches)
        rows = pd.concat(parts).sort_values("seq") if parts else pd.DataFrame({"seq": [], "mid": []})
        out = []
        for seq, mid in zip(rows["seq"].tolist(), rows["mid"].tolist()):
            total += 0.0 if last is None else mid - last
            last = mid
            if abs(total) > h:
                out.append((key[0], seq, total))
                total = 0.0
        state.update((last, total))
        yield pd.DataFrame(out, columns=[by, "seq", "s"])

    kind = mids.schema[by].dataType.simpleString()
    return mids.groupBy(by).applyInPandasWithState(step, f"{by} {kind}, seq bigint, s double", "last double, total double", "append", GroupStateTimeout.NoTimeout)
