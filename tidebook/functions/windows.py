"""Rolling, cumulative and time windows over an ordered table.

by names the partition (for instance symbol and day), order the total order inside it. Short row frames
use Spark's frames; long sums and means use differences of running sums, whose cost does not grow with
the frame. Time windows are (t - width, t] and count rows of equal time by position, so no later peer of
the current row is seen; a row without a time sees the rows without one before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LONG = 500  # rows from which a frame is computed from running sums


def rows(by: list[str], order: list[str], n: int):
    """The last n rows, the current one included."""
    return Window.partitionBy(*by).orderBy(*order).rowsBetween(-(n - 1), 0)


def running(by: list[str], order: list[str]):
    return Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)


def ordered(by: list[str], order: list[str]):
    return Window.partitionBy(*by).orderBy(*order)


def rolling_sum(x: Column, by: list[str], order: list[str], n: int) -> Column:
    return F.sum(x).over(rows(by, order, n))


def rolling_std(x: Column, by: list[str], order: list[str], n: int) -> Column:
    """Sample deviation; 0 for a single row."""
    return F.coalesce(F.stddev_samp(x).over(rows(by, order, n)), F.lit(0.0))


def rolling_sums(df: DataFrame, cols: dict[str, Column], by: list[str], order: list[str], n: int) -> DataFrame:
    """df with the rolling sum of each named column over n rows."""
    if n < LONG:
        return df.withColumns({name: rolling_sum(x, by, order, n) for name, x in cols.items()})
    run, step = running(by, order), ordered(by, order)
    df = df.withColumns({f"_run_{name}": F.sum(x).over(run) for name, x in cols.items()})
    df = df.withColumns({name: F.col(f"_run_{name}") - F.coalesce(F.lag(f"_run_{name}", n).over(step), F.lit(0)) for name in cols})
    return df.drop(*[f"_run_{name}" for name in cols])


def rolling_time(df: DataFrame, aggs: dict[str, tuple[str, str]], by: list[str], us: str, order: list[str], width_us: int) -> DataFrame:
    """df with name -> (function, column) aggregated over the last width_us microseconds.

    Functions: mean, sum, std (sample, 0 for one row), count. Time is cut into cells of the window's width, so
    that a window is the end of one cell and the start of the next. Each row also goes into the next cell, a
    width later: there the running aggregates of these later copies, from the back, and of the cell's own rows,
    from the front, make up each window. The cost does not grow with the window and nothing is subtracted.
    """
    at, first = F.col(us), F.lit(0).cast("long")
    copies = F.when(at.isNull(), F.array(first)).otherwise(F.array(first, F.lit(width_us).cast("long")))
    both = df.withColumn("_later", F.explode(copies)).withColumn("_at", at + F.col("_later"))
    both = both.withColumn("_cell", F.col("_at") - F.pmod(F.col("_at"), F.lit(width_us)))
    front = Window.partitionBy(*by, "_cell").orderBy("_at", *order).rowsBetween(Window.unboundedPreceding, 0)
    # At equal times own rows come first from the back: a row that is a whole width old is outside.
    back = Window.partitionBy(*by, "_cell").orderBy(F.desc("_at"), "_later", *[F.desc(c) for c in order]).rowsBetween(Window.unboundedPreceding, 0)
    sides = {"front": (F.col("_later") == 0, front), "back": (F.col("_later") > 0, back)}
    make = {
        "n": F.count,
        "sum": F.sum,
        "total": lambda x: F.sum(x.cast("double")),
        "mean": F.avg,
        "var": F.var_pop,
    }
    need = {"mean": ("n", "total"), "sum": ("sum",), "std": ("n", "mean", "var"), "count": ("n",)}
    parts = sorted({(p, c) for f, c in aggs.values() for p in need[f]})
    both = both.withColumns({f"_{side}_{p}_{c}": make[p](F.when(own, F.col(c))).over(w) for side, (own, w) in sides.items() for p, c in parts})

    def pair(p: str, c: str) -> list[Column]:
        return [F.coalesce(F.col(f"_{side}_{p}_{c}"), F.lit(0)) for side in sides]

    def both_of(p: str, c: str) -> Column:
        x, y = pair(p, c)
        return x + y

    def std(c: str) -> Column:
        (n, m), (mx, my), (vx, vy) = pair("n", c), pair("mean", c), pair("var", c)
        squares = vx * n + vy * m + F.when((n > 0) & (m > 0), (mx - my) * (mx - my) * n * m / (n + m)).otherwise(0.0)
        return F.when(n + m > 1, F.sqrt(squares / (n + m - 1))).otherwise(0.0)

    result = {
        "mean": lambda c: F.when(both_of("n", c) > 0, both_of("total", c) / both_of("n", c)).otherwise(0.0),
        "sum": lambda c: both_of("sum", c),
        "std": std,
        "count": lambda c: both_of("n", c),
    }
    own = both.filter("_later = 0").withColumns({name: result[f](c) for name, (f, c) in aggs.items()})
    return own.drop("_later", "_at", "_cell", *[f"_{side}_{p}_{c}" for side in sides for p, c in parts])
