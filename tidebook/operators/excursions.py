"""Forward excursions: how far the mid price goes within a horizon after each event.

Snapshots are dealt into time cells one horizon wide and copied into the cell before, so that an event finds
its whole window in its own cell; each cell is searched with sorted arrays and range extremes. The frame form
computes the same by a forward RANGE window and serves small tables and tests.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidebook.schemas import TICK

_KERNEL = "day date, seq bigint, mid_price_at_t double, max_mid double, min_mid double, n_obs bigint, last_us bigint"


def _extremes(x: np.ndarray, best) -> list[np.ndarray]:
    """Sparse table: level k holds the extreme of 2**k values from each place."""
    out, k = [x], 1
    while 2 * k <= len(x):
        out.append(best(out[-1][:-k], out[-1][k:]))
        k *= 2
    return out


def _range(table: list[np.ndarray], lo: np.ndarray, hi: np.ndarray, best) -> np.ndarray:
    level = np.floor(np.log2(np.maximum(1, hi - lo))).astype(int)
    out = np.empty(len(lo))
    for k in np.unique(level):
        at = np.flatnonzero(level == k)
        out[at] = best(table[k][lo[at]], table[k][hi[at] - (1 << k)])
    return out


def search(events: DataFrame, snapshots: DataFrame, horizon_us: int) -> DataFrame:
    """(day, seq, mid_price_at_t, max_mid, min_mid, n_obs, last_us) over snapshots in [t, t + horizon]."""
    cell = F.expr(f"us div {horizon_us}")
    e = events.select("day", "seq", "us", cell.alias("cell"))
    s = snapshots.select("day", "us", "seq", "mid", F.explode(F.array(cell, cell - 1)).alias("cell"))

    def kernel(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        right = right.sort_values(["us", "seq"], kind="stable")
        t, mid = right["us"].to_numpy(), right["mid"].to_numpy(np.float64)
        lo = np.searchsorted(t, left["us"].to_numpy(), "left")
        hi = np.searchsorted(t, left["us"].to_numpy() + horizon_us, "right")
        ok = hi > lo
        left, lo, hi = left[ok], lo[ok], hi[ok]
        if not len(left):
            return pd.DataFrame({c: pd.Series(dtype=k) for c, k in (("day", object), ("seq", "int64"), ("mid_price_at_t", float), ("max_mid", float), ("min_mid", float), ("n_obs", "int64"), ("last_us", "int64"))})
        return pd.DataFrame({
            "day": left["day"].to_numpy(), "seq": left["seq"].to_numpy(), "mid_price_at_t": mid[lo], "max_mid": _range(_extremes(mid, np.maximum), lo, hi, np.maximum),
            "min_mid": _range(_extremes(mid, np.minimum), lo, hi, np.minimum), "n_obs": hi - lo, "last_us": t[hi - 1],
        })

    return e.groupBy("day", "cell").cogroup(s.groupBy("day", "cell")).applyInPandas(kernel, _KERNEL)


def search_frames(snapshots: DataFrame, horizon_us: int) -> DataFrame:
    """The same for every snapshot as event, by RANGE windows."""
    w = Window.partitionBy("day").orderBy("us").rangeBetween(0, horizon_us)
    first = F.min_by("mid", "seq").over(Window.partitionBy("day", "us"))
    return snapshots.select("day", "seq", first.alias("mid_price_at_t"), F.max("mid").over(w).alias("max_mid"), F.min("mid").over(w).alias("min_mid"), F.count("*").over(w).alias("n_obs"), F.max("us").over(w).alias("last_us"))


def excursions(events: DataFrame, snapshots: DataFrame, horizon_us: int, slack_us: int = 1_000_000) -> DataFrame:
    """Excursions of each event in points and ticks; all zeros for events without a snapshot after them."""
    found = search(events, snapshots, horizon_us)
    all_ = events.select("day", "seq", "us").join(found, ["day", "seq"], "left")
    zero = lambda x: F.coalesce(x, F.lit(0.0))
    up, down = F.col("max_mid") - F.col("mid_price_at_t"), F.col("mid_price_at_t") - F.col("min_mid")
    return all_.select(
        "day", "seq", zero(F.col("mid_price_at_t")).alias("mid_price_at_t"), zero(up).alias("max_up_pts"), zero(down).alias("max_down_pts"), zero(up / TICK).alias("max_up_ticks"),
        zero(down / TICK).alias("max_down_ticks"), zero(F.greatest(up, down)).alias("mae_pts"), zero(F.greatest(up, down) / TICK).alias("mae_ticks"), zero(F.abs(down)).alias("max_down_abs"),
        F.when(F.col("n_obs") > 0, F.floor((F.col("us") + horizon_us) / 1_000_000)).otherwise(0).cast("long").alias("horizon_end_ts"),
        F.coalesce((F.col("last_us") >= F.col("us") + horizon_us - slack_us).cast("int"), F.lit(0)).alias("window_complete"),
        F.coalesce("n_obs", F.lit(0)).alias("n_obs"), zero(F.col("min_mid")).alias("min_mid"), zero(F.col("max_mid")).alias("max_mid"),
    )


def by_horizon(events: DataFrame, snapshots: DataFrame, horizons_us: dict[str, int], slack_us: int = 1_000_000) -> DataFrame:
    """Excursions of all horizons in long form, with a horizon column."""
    parts = [excursions(events, snapshots, h, slack_us).withColumn("horizon", F.lit(name)) for name, h in horizons_us.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def summary(long: DataFrame) -> DataFrame:
    """By horizon: counts, percentiles and means of up and worst ticks, their median ratio, completeness.

    Ticks are few distinct values: events are counted by them first, and percentiles are taken of the counts.
    """
    cuts = (0.5, 0.75, 0.9, 0.95)
    names = {"up": "max_up_ticks", "mae": "mae_ticks"}
    counts = long.groupBy("horizon", *names.values()).agg(
        F.count("*").alias("c"), F.sum(F.col("window_complete").cast("long")).alias("complete"), F.sum("n_obs").alias("obs"), F.max("n_obs").alias("most")
    )
    n = F.sum("c")
    aggs = [n.alias("n_events")]
    for tag, c in names.items():
        aggs += [F.round(F.percentile(c, F.lit(q), F.col("c")), 6).alias(f"p{int(q * 100)}_{tag}_ticks") for q in cuts]
        aggs.append(F.round(F.sum(F.col(c) * F.col("c")) / n, 6).alias(f"mean_{tag}_ticks"))
    ratio = F.when(F.col("mae_ticks") > 0, F.col("max_up_ticks") / F.col("mae_ticks")).otherwise(0.0)
    aggs += [F.round(F.percentile(ratio, F.lit(0.5), F.col("c")), 6).alias("median_up_over_mae"), F.round(F.sum("complete") / n * 100, 6).alias("pct_complete"), F.round(F.sum("obs") / n, 6).alias("mean_n_obs"), F.max("most").alias("max_n_obs")]
    return counts.groupBy("horizon").agg(*aggs)


def hit_rate(long: DataFrame, target_ticks: float) -> DataFrame:
    """By horizon and day: share of events that reach the target up and down, and the median worst ticks, of counts by value."""
    counts = long.groupBy("horizon", "day", "mae_ticks").agg(
        F.count("*").alias("c"), F.count_if(F.col("max_up_ticks") >= target_ticks).alias("up"), F.count_if(F.col("max_down_ticks") >= target_ticks).alias("down")
    )
    return counts.groupBy("horizon", "day").agg(
        F.sum("c").alias("n_events"), F.sum("up").alias("hits_up"), F.sum("down").alias("hits_down"), F.round(F.percentile("mae_ticks", F.lit(0.5), F.col("c")), 6).alias("median_mae_ticks")
    )


def overall_hit_rate(daily: DataFrame) -> DataFrame:
    """Hit rates over all days from the daily counts, and the median of the daily medians."""
    n = F.sum("n_events")
    return daily.groupBy("horizon").agg(n.alias("n_events"), F.round(F.sum("hits_up") / n, 6).alias("rate_up"), F.round(F.sum("hits_down") / n, 6).alias("rate_down"), F.round(F.median("median_mae_ticks"), 6).alias("median_mae_ticks"))


def histogram(long: DataFrame, column: str = "max_up_ticks", low: float = 0.0, high: float = 80.0, bins: int = 80) -> DataFrame:
    """By horizon and bin: counts; values beyond the ends go to the end bins."""
    at = F.least(F.lit(bins - 1), F.greatest(F.lit(0), F.floor((F.col(column) - low) / ((high - low) / bins)))).cast("long")
    return long.groupBy("horizon", at.alias("bin")).agg(F.count("*").alias("n"))


def check_growth(n_in: int, n_out: int, most: float = 15.0) -> None:
    """ValueError if the output has more than most times the input's rows."""
    if n_in and n_out > most * n_in:
        raise ValueError(f"{n_out} rows from {n_in}")
