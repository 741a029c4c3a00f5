"""The generic events table as a market: trades, mid path, book commands, snapshots.

Every value is derived from the event's own fields and lies on the tick grid, so that any engine that
computes the same expressions gets bit-equal inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebook.functions.scalar import us
from tidebook.functions.windows import running
from tidebook.session import table

BUYS, SELLS = ("purchase", "click"), ("view", "error")


def tape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """day, us, seq, k, sign (1 buy, -1 sell, 0 neither) and the raw fields that the others need."""
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("long")
    sign = F.when(F.col("event_type").isin(*BUYS), 1).when(F.col("event_type").isin(*SELLS), -1).otherwise(0)
    return e.select(
        F.to_date("ts").alias("day"), F.col("ts"), us("ts").alias("us"), F.col("event_id").alias("seq"), "user_id", "value", k.alias("k"), sign.alias("sign"), "event_type"
    )


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """day, ts, us, seq, price, size, side of the events that are trades."""
    t = tape(spark, sf_dir).filter("sign <> 0")
    return t.select("day", "ts", "us", "seq", (F.floor("value") * 0.25).alias("price"), F.col("k").alias("size"), F.when(F.col("sign") > 0, "buy").otherwise("sell").alias("side"))


def mids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """day, ts, us, seq, mid: a walk of one tick a trade, restarting at 100 each day."""
    t = tape(spark, sf_dir)
    mid = 100 + 0.25 * F.sum("sign").over(running(["day"], ["seq"]))
    return t.select("day", "ts", "us", "seq", mid.alias("mid"))


def commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """day, us, seq, code, price, qty: book commands with clears, deletes, misses and crossings."""
    t = tape(spark, sf_dir)
    code = (F.col("seq") % 8).cast("int")
    code = F.when((code == 1) & (F.col("seq") % 512 != 1), 2).otherwise(code)
    bid = code.isin(2, 4, 6)
    depth = 0.25 * (1 + F.col("user_id") % 60)
    price = F.when(bid, F.when(F.col("k") == 99, 100.5).otherwise(100 - depth)).otherwise(F.when(F.col("k") == 99, 99.5).otherwise(100 + depth))
    return t.select("day", "us", "seq", code.alias("code"), price.alias("price"), F.col("k").alias("qty"))


def snapshots(spark: SparkSession, sf_dir: str, levels: int = 10) -> DataFrame:
    """day, ts, us, seq, best_bid, best_ask, spread, mid_price, bq_1.., aq_1.., vol_bid, vol_ask."""
    t = tape(spark, sf_dir)
    mid = 100 + 0.25 * F.sum("sign").over(running(["day"], ["seq"]))
    t = t.withColumn("mid_price", mid)
    size = F.col("k").cast("double")
    quantities = {}
    for i in range(1, levels + 1):
        quantities[f"bq_{i}"] = ((F.col("k") * (i + 3) + F.col("seq") * 7) % 50).cast("double")
        quantities[f"aq_{i}"] = ((F.col("k") * (i + 5) + F.col("seq") * 11) % 50).cast("double")
    return t.select(
        "day", "ts", "us", "seq", (F.col("mid_price") - 0.25).alias("best_bid"), (F.col("mid_price") + 0.25).alias("best_ask"), F.lit(0.5).alias("spread"), "mid_price",
        *[q.alias(n) for n, q in quantities.items()],
        F.when(F.col("sign") < 0, size).otherwise(0.0).alias("vol_bid"), F.when(F.col("sign") > 0, size).otherwise(0.0).alias("vol_ask"),
    )
