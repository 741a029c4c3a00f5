"""Triple-barrier labels on the snapshot clock: which of two prices is touched first within a number of snapshots.

Events meet the snapshots of their own and the next cell of the tick clock by an equi-join; the index range and
the barriers are tested on what meets, and the first touch is a minimum, so nothing is sorted by event.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidebook.functions.scalar import ratio
from tidebook.schemas import CANDIDATES, TICK


def candidates(spark: SparkSession, grid=CANDIDATES, first: int | None = None) -> DataFrame:
    """The grid as (vb_ticks, pt_ticks, sl_ticks), optionally its first rows only."""
    return spark.createDataFrame([tuple(c) for c in grid[:first]], "vb_ticks int, pt_ticks double, sl_ticks double")


def indexed(snapshots: DataFrame) -> DataFrame:
    """(day, seq, us, mid, idx): the snapshot clock of each day."""
    return snapshots.select("day", "seq", "us", "mid", (F.row_number().over(Window.partitionBy("day").orderBy("us", "seq")) - 1).alias("idx"))


def first_touch(events: DataFrame, snapshots: DataFrame, grid: DataFrame) -> DataFrame:
    """Labels of every event under every candidate: 1 profit first, -1 stop first, 0 neither in time.

    events has (day, seq) of snapshots. The start snapshot itself is not tested; a tie goes to profit.
    """
    clock = indexed(snapshots)
    start = F.min("idx").over(Window.partitionBy("day", "us"))
    starts = clock.withColumn("i0", start).join(events.select("day", "seq"), ["day", "seq"]).filter("mid > 0")
    e = starts.select("day", "seq", "i0", F.col("mid").alias("p0")).join(F.broadcast(grid), F.lit(True)).withColumns({  # grid: a handful of parameter rows
        "pt_price": F.col("p0") + F.col("pt_ticks") * TICK, "sl_price": F.col("p0") - F.col("sl_ticks") * TICK,
    })
    cells = grid.select("vb_ticks").distinct()
    s = clock.select("day", "idx", "mid").join(F.broadcast(cells), F.lit(True)).withColumn("cell", F.floor(F.col("idx") / F.col("vb_ticks")))
    own = F.floor(F.col("i0") / F.col("vb_ticks"))
    probe = e.withColumn("cell", F.explode(F.array(own, own + 1)))
    near = (F.col("idx") > F.col("i0")) & (F.col("idx") < F.col("i0") + F.col("vb_ticks")) & ((F.col("mid") >= F.col("pt_price")) | (F.col("mid") <= F.col("sl_price")))
    keys = ["day", "seq", "vb_ticks", "pt_ticks", "sl_ticks"]
    hits = probe.join(s, ["day", "vb_ticks", "cell"]).filter(near).groupBy(*keys).agg(F.min(F.struct("idx", "mid")).alias("hit"))
    out = e.join(hits, keys, "left")
    label = F.when(F.col("hit").isNull(), 0).when(F.col("hit.mid") >= F.col("pt_price"), 1).otherwise(-1)
    return out.select(
        *keys, F.col("p0").alias("mid_price_at_t"), F.round("pt_price", 4).alias("pt_price"), F.round("sl_price", 4).alias("sl_price"), label.alias("label"),
        F.when(label == 1, "pt").when(label == -1, "sl").otherwise("vertical").alias("barrier_hit"), F.coalesce(F.round("hit.mid", 4), F.lit(0.0)).alias("hit_price"),
    )


def metrics(labels: DataFrame, by: list[str] | None = None) -> DataFrame:
    """By candidate: counts and shares of each outcome, balance, win rate and theoretical payoff (null if no stop)."""
    keys = [*(by or []), "vb_ticks", "pt_ticks", "sl_ticks"]
    g = labels.groupBy(*keys).agg(F.count("*").alias("n_events"), F.count_if(F.col("label") == 1).alias("n_pt"), F.count_if(F.col("label") == -1).alias("n_sl"), F.count_if(F.col("label") == 0).alias("n_vertical"))
    return _rates(g)


def _rates(g: DataFrame) -> DataFrame:
    n, p, s = F.col("n_events"), F.col("n_pt"), F.col("n_sl")
    pct = lambda x: F.round(ratio(x * 100.0, n), 6)
    return g.withColumns({
        "pt_sl_ratio": F.round(F.col("pt_ticks") / F.col("sl_ticks"), 6), "pct_pt": pct(p), "pct_sl": pct(s), "pct_vertical": pct(F.col("n_vertical")),
        "balance_ratio": F.round(ratio(F.least(p, s), F.greatest(p, s)), 6), "win_rate": F.round(ratio(p, p + s), 6),
        "payoff_theoretical": F.round(ratio(p * F.col("pt_ticks"), s * F.col("sl_ticks"), None), 6),
    })


def aggregate(daily: DataFrame) -> DataFrame:
    """Metrics over all days from the daily counts, with the number of days."""
    g = daily.groupBy("vb_ticks", "pt_ticks", "sl_ticks").agg(*[F.sum(c).alias(c) for c in ("n_events", "n_pt", "n_sl", "n_vertical")], F.count_distinct("day").alias("n_days"))
    return _rates(g)


def leaderboard(m: DataFrame) -> DataFrame:
    """Candidates by balance, then win rate, best first."""
    rank = F.row_number().over(Window.orderBy(F.desc("balance_ratio"), F.desc("win_rate"), "vb_ticks", "pt_ticks"))  # one row a candidate
    return m.withColumn("place", rank)


def outliers(daily: DataFrame, least: float = 0.80) -> DataFrame:
    """Days and candidates whose balance is below least."""
    return daily.filter((F.col("balance_ratio") < least) & (F.col("n_events") > 0))


def file_name(vb: int, pt: float, sl: float) -> str:
    """Name of a candidate's label partition."""
    text = lambda x: f"{x:g}".replace(".", "p")
    return f"phase7_labels_{vb}ticks_{text(pt)}_{text(sl)}"
