"""CUSUM event sampling: threshold, calibration and the filter with reset, plus features over the samples.

The accumulator restarts whenever it leaves the band, so a day is one sequential fold; days run in parallel
and each streams through a Python worker that holds one number.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidebook.functions.windows import ordered, rolling_sum, running

FLOOR, DEFAULT, CAP = 0.5, 0.25, 1e6
CALIBRATION_ROWS, MAX_RATE = 200_000, 0.10


def deltas(df: DataFrame, value: str = "mid", by: list[str] | None = None, order: list[str] | None = None, first_zero: bool = True) -> DataFrame:
    """df with d: the change of value since the row before; of a first row 0, or the value itself."""
    by, order = by or ["day"], order or ["seq"]
    before = F.lag(value).over(ordered(by, order))
    first = F.lit(0.0) if first_zero else F.col(value)
    return df.withColumn("d", F.coalesce(F.col(value) - before, first))


def keep_first(df: DataFrame, by: list[str], ts: str, seq: str) -> DataFrame:
    """One row for each time: the first by seq."""
    rank = F.row_number().over(Window.partitionBy(*by, ts).orderBy(seq))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def threshold(df: DataFrame, by: list[str] | None = None, percentile: float = 0.05) -> DataFrame:
    """(by, h): percentile of the non-zero absolute changes, DEFAULT if there are none, FLOOR at least."""
    by = by or ["day"]
    size = F.abs("d")
    h = F.coalesce(F.percentile(F.when(size > 0, size), F.lit(percentile)), F.lit(DEFAULT))
    return df.groupBy(*by).agg(F.greatest(h, F.lit(FLOOR)).alias("h"))


def crossings(d: np.ndarray, h: float, total: float = 0.0) -> tuple[np.ndarray, np.ndarray, float]:
    """(places, sums, rest): where the running sum from total leaves the band h and restarts, its value there, and the sum left at the end.

    Each stretch is a cumulative sum that is searched for its first crossing, over steps that grow until one is found.
    """
    places, sums, at, step = [], [], 0, 64
    while at < len(d):
        run = np.cumsum(np.concatenate([[total], d[at : at + step]]))[1:]
        out = np.abs(run) > h
        k = int(out.argmax())
        if out[k]:
            places.append(at + k)
            sums.append(run[k])
            at, total, step = at + k + 1, 0.0, max(64, min(step, 4 * (k + 1)))
        else:
            at, total, step = at + len(run), float(run[-1]), min(2 * step, 1 << 16)
    return np.array(places, dtype=np.int64), np.array(sums, dtype=np.float64), total


def _rate(x: np.ndarray, h: float) -> float:
    return len(crossings(x, h)[0]) / max(1, len(x))


def calibrated(df: DataFrame, thresholds: DataFrame, rows: int = CALIBRATION_ROWS, max_rate: float = MAX_RATE) -> DataFrame:
    """(day, h): h doubled until the first rows' absolute changes leave the band in at most max_rate of them."""
    rank = F.row_number().over(ordered(["day"], ["seq"]))
    head = df.select("day", "seq", F.abs("d").alias("a")).withColumn("_n", rank).filter(F.col("_n") <= rows).join(thresholds, "day")

    def run(batches):
        day, parts, h = None, [], 0.0

        def done():
            x, k = np.concatenate(parts), h
            while k < CAP and _rate(x, k) > max_rate:
                k *= 2
            return pa.RecordBatch.from_arrays([pa.array([day], pa.date32()), pa.array([k])], names=["day", "h"])

        for b in batches:
            days = b.column(0).to_pylist()
            values, hs = b.column(1).to_numpy(zero_copy_only=False), b.column(2).to_numpy(zero_copy_only=False)
            at = 0
            while at < len(days):
                stop = at
                while stop < len(days) and days[stop] == days[at]:
                    stop += 1
                if days[at] != day:
                    if parts:
                        yield done()
                    day, parts, h = days[at], [], float(hs[at])
                parts.append(values[at:stop])
                at = stop
        if parts:
            yield done()

    return head.repartition("day").sortWithinPartitions("day", "seq").select("day", "a", "h").mapInArrow(run, "day date, h double")


def cusum(df: DataFrame, thresholds: DataFrame) -> DataFrame:
    """(day, seq, s) of the rows at which the running sum of d leaves the band h and restarts at 0."""
    src = df.select("day", "seq", "d").join(thresholds, "day").repartition("day").sortWithinPartitions("day", "seq").select("day", "seq", "d", "h")

    def run(batches):
        last, total = None, 0.0
        for b in batches:
            day = b.column(0).cast(pa.int32()).to_numpy()
            seq, d, h = (b.column(c).to_numpy() for c in (1, 2, 3))
            cut = [0, *(np.flatnonzero(np.diff(day)) + 1), len(day)]
            for lo, hi in zip(cut, cut[1:]):
                if lo == hi:
                    continue
                if day[lo] != last:
                    last, total = day[lo], 0.0
                places, sums, total = crossings(d[lo:hi], h[lo], total)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(places), last, dtype=np.int32)).cast(pa.date32()), pa.array(seq[lo:hi][places]), pa.array(sums)], names=["day", "seq", "s"])

    return src.mapInArrow(run, "day date, seq bigint, s double")


def session_features(samples: DataFrame, delta: str = "td", by: list[str] | None = None, order: list[str] | None = None) -> DataFrame:
    """Samples with the sums of their last 30 and last 5 deltas."""
    by, order = by or ["day"], order or ["seq"]
    x: Column = F.col(delta)
    return samples.withColumns({"delta_rolling_sum_30": rolling_sum(x, by, order, 30), "delta_rolling_sum_5": rolling_sum(x, by, order, 5)})


def with_session_delta(df: DataFrame, delta: str = "td", by: list[str] | None = None, order: list[str] | None = None) -> DataFrame:
    """df with cum_delta_session: the running sum of delta over the session."""
    return df.withColumn("cum_delta_session", F.sum(delta).over(running(by or ["day"], order or ["seq"])))
