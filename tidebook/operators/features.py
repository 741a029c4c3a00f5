"""Snapshot features: microprice, imbalances, order flow, sweeps, volume-synchronised toxicity, session VWAP.

snapshots has by-columns, an order column, best_bid, best_ask, spread, mid_price, bq_1..bq_N, aq_1..aq_N and
the volumes traded since the snapshot before, vol_bid and vol_ask. All features of a table share one sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidebook.functions.windows import LONG, ordered, rolling_std, rolling_sum, rolling_sums, rows, running
from tidebook.schemas import TICK

EPS = 1e-9


def microprice() -> Column:
    total = F.col("bq_1") + F.col("aq_1")
    return F.when(total > 0, (F.col("best_bid") * F.col("aq_1") + F.col("best_ask") * F.col("bq_1")) / total).otherwise((F.col("best_bid") + F.col("best_ask")) / 2)


def imbalance(level: int) -> Column:
    total = F.col(f"bq_{level}") + F.col(f"aq_{level}")
    return F.when(total > 0, (F.col(f"bq_{level}") - F.col(f"aq_{level}")) / total).otherwise(0.0)


class Features:
    """Feature expressions over one ordering."""

    def __init__(self, by: list[str] | None = None, order: list[str] | None = None, levels: int = 10):
        self.by, self.order, self.levels = by or ["day"], order or ["seq"], levels
        self.step = ordered(self.by, self.order)

    def before(self, c: str) -> Column:
        """The value of the row before; of the first row itself."""
        return F.coalesce(F.lag(c).over(self.step), F.col(c))

    def stack(self, c: str) -> Column:
        return F.greatest(F.lit(0.0), F.col(c) - self.before(c))

    def pull(self, c: str) -> Column:
        return F.greatest(F.lit(0.0), self.before(c) - F.col(c))

    def order_flow(self, level: int) -> Column:
        """Stacking less pulling of the bid, less that of the ask, at a level."""
        return (F.col(f"bq_{level}") - self.before(f"bq_{level}")) - (F.col(f"aq_{level}") - self.before(f"aq_{level}"))

    def swept(self, c: str) -> Column:
        """Whether more than half of the level was pulled."""
        return self.pull(c) / (self.before(c) + EPS) > 0.5

    def sweep_flag(self, side: str) -> Column:
        a, b, c = (self.swept(f"{side}q_{i}") for i in (1, 2, 3))
        return (a & b & c).cast("int")

    def sweep_count(self, side: str) -> Column:
        return sum((self.swept(f"{side}q_{i}").cast("int") for i in range(2, self.levels + 1)), self.swept(f"{side}q_1").cast("int"))

    def change(self, x: Column, n: int) -> Column:
        """x less its value n rows before, which is 0 in the first n rows."""
        return x - F.lag(x, n, 0.0).over(self.step)

    def mean(self, x: Column, n: int) -> Column:
        return F.avg(x).over(rows(self.by, self.order, n))

    def vwap(self) -> Column:
        volume = F.col("vol_bid") + F.col("vol_ask")
        w = running(self.by, self.order)
        return F.sum(F.col("mid_price") * volume).over(w) / (F.sum(volume).over(w) + EPS)


def trade_delta(double_diff: bool = False, f: Features | None = None) -> Column:
    """Volume at the ask less volume at the bid; with double_diff of their increases only."""
    if not double_diff:
        return F.col("vol_ask") - F.col("vol_bid")
    f = f or Features()
    return f.stack("vol_ask") - f.stack("vol_bid")


def compute(snapshots: DataFrame, by: list[str] | None = None, order: list[str] | None = None, levels: int = 10, double_diff: bool = False) -> DataFrame:
    """All feature columns of the snapshots, with by and order columns and us and ts where present."""
    f = Features(by, order, levels)
    base = snapshots.withColumns({
        "td": trade_delta(double_diff, f), "microprice": microprice(), "imbalance_1": imbalance(1), "volume": F.col("vol_bid") + F.col("vol_ask"),
        **{f"ofi_L{i}": f.order_flow(i) for i in range(1, 6)}, **{f"qi_L{i}": imbalance(i) for i in range(1, 6)},
    })
    base = base.withColumns({"ps_delta_L1": F.col("ofi_L1"), "skew": F.abs("td")})
    mp, imb, td, flow = (F.col(c) for c in ("microprice", "imbalance_1", "td", "ps_delta_L1"))
    out = base.withColumns({
        **{f"delta_{n}": rolling_sum(td, f.by, f.order, n) for n in (50, 100, 200)},
        **{f"imb_trend_{n}": f.change(imb, n) for n in (10, 50)},
        **{f"imb_ma_ratio_{n}": imb / (f.mean(imb, n) + EPS) for n in (10, 50)},
        **{f"microprice_momentum_{n}": f.change(mp, n) for n in (10, 50)},
        "microprice_dev_from_ma": mp - f.mean(mp, 20),
        **{f"ofi_{n}": rolling_sum(flow, f.by, f.order, n) for n in (50, 100)},
        "stack_sweep_bid_flag": f.sweep_flag("b"), "stack_sweep_ask_flag": f.sweep_flag("a"),
        "bid_sweep_count": f.sweep_count("b"), "ask_sweep_count": f.sweep_count("a"),
        **{f"microprice_vol_{n}": rolling_std(mp, f.by, f.order, n) for n in (20, 100)},
        "vwap_dev_ticks": (F.col("mid_price") - f.vwap()) / TICK,
        "vpin_100": rolling_sum(F.col("skew"), f.by, f.order, 100) / (rolling_sum(F.col("volume"), f.by, f.order, 100) + EPS),
        "cum_delta": F.sum(td).over(running(f.by, f.order)),
    })
    out = rolling_sums(out, {f"delta_{LONG}": F.col("td"), f"ofi_{LONG}": F.col("ps_delta_L1")}, f.by, f.order, LONG)
    out = out.withColumn("stack_sweep_any_flag", F.greatest("stack_sweep_bid_flag", "stack_sweep_ask_flag"))
    names = (
        "spread mid_price microprice delta_50 delta_100 delta_200 delta_500 imb_trend_10 imb_trend_50 imb_ma_ratio_10 imb_ma_ratio_50 microprice_momentum_10 "
        "microprice_momentum_50 microprice_dev_from_ma ofi_50 ofi_100 ofi_500 stack_sweep_bid_flag stack_sweep_ask_flag stack_sweep_any_flag bid_sweep_count "
        "ask_sweep_count ofi_L1 ofi_L2 ofi_L3 ofi_L4 ofi_L5 qi_L1 qi_L2 qi_L3 qi_L4 qi_L5 microprice_vol_20 microprice_vol_100 vwap_dev_ticks vpin_100 cum_delta "
        "imbalance_1 ps_delta_L1"
    ).split()
    keys = [c for c in ("ts", "us") if c in snapshots.columns]
    return out.select(*f.by, *f.order, *keys, *names)
