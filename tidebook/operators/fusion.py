"""Backward as-of joins: the last row of one ordered table at or before each row of another.

Both tables are laid into one sequence and the last known value is carried forward by a window, which
needs one exchange by key and no range join. On equal times the right side comes first if exact matches
count, else last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof(left: DataFrame, right: DataFrame, by: list[str], us: str, seq: str, values: list[str], allow_exact: bool = True, ties: list[str] = []) -> DataFrame:
    """left with values of the last right row at or before it (before it, without allow_exact); null if none.

    Of right rows at equal us the last by their columns ties, then by seq, counts.
    """
    place = (0, 1) if allow_exact else (1, 0)
    packed = F.struct(*values).alias("_right")
    r = right.select(*by, us, F.lit(None).cast("long").alias(seq) if seq not in right.columns else F.col(seq), F.lit(place[0]).alias("_place"), packed, F.lit(False).alias("_left"), *[F.col(c).alias(f"_tie_{c}") for c in ties])
    keep = [c for c in left.columns if c not in (*by, us, seq)]
    kept = F.struct(*keep).alias("_kept") if keep else F.lit(None).alias("_kept")
    l_ = left.select(*by, us, seq, F.lit(place[1]).alias("_place"), kept, F.lit(True).alias("_left"))
    both = l_.unionByName(r, allowMissingColumns=True)
    w = Window.partitionBy(*by).orderBy(us, "_place", *[f"_tie_{c}" for c in ties], seq).rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("_last", F.last("_right", ignorenulls=True).over(w)).filter("_left")
    return found.select(*by, us, seq, *[F.col(f"_kept.{c}").alias(c) for c in keep], *[F.col(f"_last.{v}").alias(v) for v in values])


def cumulative_volume(snapshots: DataFrame, trades: DataFrame, by: list[str] = ["day"], us: str = "us", seq: str = "seq") -> DataFrame:
    """snapshots with traded_vol_bid and traded_vol_ask since the snapshot before: as-of cumulative volumes, differenced.

    A buy trades at the ask, a sell at the bid. The first snapshot of a partition gets 0.
    """
    w = Window.partitionBy(*by).orderBy(us, seq).rowsBetween(Window.unboundedPreceding, 0)
    cum = trades.select(*by, us, seq, F.sum(F.when(F.col("side") == "sell", F.col("size")).otherwise(0)).over(w).alias("cum_bid"), F.sum(F.when(F.col("side") == "buy", F.col("size")).otherwise(0)).over(w).alias("cum_ask"))
    joined = asof(snapshots, cum, by, us, seq, ["cum_bid", "cum_ask"])
    step = Window.partitionBy(*by).orderBy(us, seq)
    gain = lambda c: F.coalesce(F.greatest(F.lit(0), F.coalesce(F.col(c), F.lit(0)) - F.lag(F.coalesce(F.col(c), F.lit(0))).over(step)), F.lit(0)).cast("double")
    return joined.withColumns({"traded_vol_bid": gain("cum_bid"), "traded_vol_ask": gain("cum_ask")}).drop("cum_bid", "cum_ask")


def enrich(events: DataFrame, trades: DataFrame, by: list[str] = ["day"], us: str = "us", seq: str = "seq") -> DataFrame:
    """events with the last trade strictly before at millisecond precision, and the running sum of its signed size.

    Of trades in one millisecond the last by us, then seq, counts.
    """
    ms = F.expr(f"{us} div 1000")
    t = trades.select(*by, ms.alias("_ms"), us, seq, F.col("side").alias("trade_side"), F.col("size").alias("trade_size"), F.when(F.col("side") == "buy", F.col("size")).otherwise(-F.col("size")).alias("trade_delta"))
    e = asof(events.withColumn("_ms", ms), t, by, "_ms", seq, ["trade_side", "trade_size", "trade_delta"], allow_exact=False, ties=[us]).drop("_ms")
    w = Window.partitionBy(*by).orderBy(us, seq).rowsBetween(Window.unboundedPreceding, 0)
    return e.withColumns({
        "trade_side": F.coalesce("trade_side", F.lit("none")), "trade_size": F.coalesce("trade_size", F.lit(0)), "trade_delta": F.coalesce("trade_delta", F.lit(0)),
    }).withColumn("cum_trade_delta_session", F.sum("trade_delta").over(w))
