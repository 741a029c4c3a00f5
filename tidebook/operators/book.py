"""Order-book reconstruction from level commands.

A book is a fold over the commands of one day. A clear empties both sides, so the runs between clears are
independent and are dealt out as such; inside a run, rows stream through one Python worker in order and
only the current book is held. A side keeps its best max_levels prices; what falls off is gone for good.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebook.functions.windows import running
from tidebook.schemas import MAX_LEVELS, TOP_LEVELS

CLEAR, BID, ASK, DELETE = 1, (2, 4, 6), (3, 5, 7), (6, 7)
STATE_SCHEMA = "day date, seq bigint, bid_px array<double>, bid_qty array<int>, ask_px array<double>, ask_qty array<int>, missed boolean"


class Side:
    """One side's levels, best first; keys are prices, negated for bids."""

    __slots__ = ("sign", "keys", "qty", "limit")

    def __init__(self, sign: int, limit: int):
        self.sign, self.limit = sign, limit
        self.keys: list[float] = []
        self.qty: dict[float, int] = {}

    def apply(self, price: float, qty: int) -> bool:
        """Set a level, or delete it for a quantity of 0; False if there was nothing to delete."""
        key = self.sign * price
        held = key in self.qty
        if qty > 0:
            self.qty[key] = qty
            if not held:
                insort(self.keys, key)
                if len(self.keys) > self.limit:
                    del self.qty[self.keys.pop()]
            return True
        if held:
            del self.keys[bisect_left(self.keys, key)]
            del self.qty[key]
        return held

    def top(self, n: int) -> tuple[list[float], list[int]]:
        return [self.sign * k for k in self.keys[:n]], [self.qty[k] for k in self.keys[:n]]


def states(commands: DataFrame, max_levels: int = MAX_LEVELS, levels: int = TOP_LEVELS) -> DataFrame:
    """(day, seq, bid_px, bid_qty, ask_px, ask_qty, missed) after every command that may change the book.

    commands has (day, seq, code, price, qty). Clears and commands without a meaning emit nothing.
    """
    epoch = F.sum(F.when(F.col("code") == CLEAR, 1).otherwise(0)).over(running(["day"], ["seq"]))
    dealt = commands.filter(F.col("code").between(1, 7)).withColumn("epoch", epoch).select("day", "epoch", "seq", "code", "price", "qty")

    def run(batches):
        key, bid, ask = None, None, None
        for b in batches:
            out = [[] for _ in range(7)]
            for day, epoch, seq, code, price, qty in zip(*[c.to_pylist() for c in b.columns]):
                if (day, epoch) != key:
                    key, bid, ask = (day, epoch), Side(-1, max_levels), Side(1, max_levels)
                if code == CLEAR:
                    continue
                hit = (bid if code in BID else ask).apply(price, 0 if code in DELETE else qty)
                (bp, bq), (ap, aq) = bid.top(levels), ask.top(levels)
                for part, value in zip(out, (day, seq, bp, bq, ap, aq, not hit)):
                    part.append(value)
            kinds = (pa.date32(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.int32()), pa.list_(pa.float64()), pa.list_(pa.int32()), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds)], names=["day", "seq", "bid_px", "bid_qty", "ask_px", "ask_qty", "missed"])

    return dealt.repartition("day", "epoch").sortWithinPartitions("day", "epoch", "seq").mapInArrow(run, STATE_SCHEMA)


def two_sided(states: DataFrame) -> DataFrame:
    """States with at least one level on each side."""
    return states.filter((F.size("bid_px") > 0) & (F.size("ask_px") > 0))


def snapshots(states: DataFrame, levels: int = TOP_LEVELS) -> DataFrame:
    """Wide snapshots of the states that are two-sided and not crossed; missing levels are null."""
    bid, ask = F.get("bid_px", F.lit(0)), F.get("ask_px", F.lit(0))
    wide = [F.get(c, F.lit(i)).alias(f"{c}_{i + 1}") for c in ("bid_px", "bid_qty", "ask_px", "ask_qty") for i in range(levels)]
    return two_sided(states).filter(bid < ask).select(
        "day", "seq", bid.alias("best_bid"), ask.alias("best_ask"), (ask - bid).alias("spread"), ((bid + ask) / 2).alias("mid_price"), *wide
    )


def crossed(states: DataFrame) -> DataFrame:
    """States whose best bid is not below the best ask: (day, seq, best_bid, best_ask)."""
    bid, ask = F.get("bid_px", F.lit(0)), F.get("ask_px", F.lit(0))
    return two_sided(states).filter(bid >= ask).select("day", "seq", bid.alias("best_bid"), ask.alias("best_ask"))


def stats(commands: DataFrame, states: DataFrame) -> DataFrame:
    """By day: snapshots, clears, crossed states, missed deletes, mean levels of valid snapshots, first and last seq."""
    bid, ask = F.get("bid_px", F.lit(0)), F.get("ask_px", F.lit(0))
    both = (F.size("bid_px") > 0) & (F.size("ask_px") > 0)
    valid = both & (bid < ask)
    found = states.groupBy("day").agg(
        F.count_if(valid).alias("n_snapshots"), F.count_if(both & (bid >= ask)).alias("n_crossed"), F.count_if("missed").alias("n_missed"),
        F.round(F.avg(F.when(valid, F.size("bid_px"))), 6).alias("mean_bid_levels"), F.round(F.avg(F.when(valid, F.size("ask_px"))), 6).alias("mean_ask_levels"),
        F.min(F.when(valid, F.col("seq"))).alias("first_seq"), F.max(F.when(valid, F.col("seq"))).alias("last_seq"),
    )
    clears = commands.groupBy("day").agg(F.count_if(F.col("code") == CLEAR).alias("n_clears"))
    return clears.join(found, "day", "left")


def depth_imbalance(states: DataFrame, n: int = 5) -> DataFrame:
    """Imbalance of the quantities in the first n levels, 0 where there are none: (day, seq, imbalance)."""
    total = lambda c: F.aggregate(F.slice(c, 1, n), F.lit(0).cast("double"), lambda a, x: a + x)
    b, a = total("bid_qty"), total("ask_qty")
    return states.select("day", "seq", F.when(b + a > 0, (b - a) / (b + a)).otherwise(0.0).alias("imbalance"))
