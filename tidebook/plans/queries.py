"""One query for each operator of the pipeline, over the generic tables.

The events table spans a month at minutes between rows, so windows of seconds become hours here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebook.functions import scalar
from tidebook.functions.windows import rolling_time
from tidebook.operators import aggregates, audit, book, buckets, daystate, excursions, features, fusion, labels, metrics, sampling, splits
from tidebook.plans.views import BOOK, COMMANDS, CUSUM, DELTAS, LADDER, MIDS, SNAPSHOTS, TAPE, TRADES, with_views
from tidebook.session import table
from tidebook.sources import adapters

HOUR = 3_600_000_000
HORIZONS = {"h2": 2 * HOUR, "h6": 6 * HOUR, "h12": 12 * HOUR}
GRID = ((20, 4.0, 4.0), (50, 8.0, 8.0), (100, 8.0, 8.0))
QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL where there is one."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """df with its double columns rounded."""
    return df.select(*[F.round(c, digits).alias(c) if k == "double" else F.col(c) for c, k in df.dtypes])


# --- projections and filters


@query(with_views(TAPE) + """SELECT seq, CASE WHEN user_id % 7 > k % 7 THEN 'buy' WHEN k % 7 > user_id % 7 THEN 'sell' END AS side FROM tape""")
def trade_side_classify(spark: SparkSession, sf: str) -> DataFrame:
    t = adapters.tape(spark, sf)
    return t.select("seq", scalar.side(F.col("k") % 7, F.col("user_id") % 7).alias("side"))


@query(with_views(TAPE) + """SELECT seq, CASE WHEN user_id % 7 > 0 AND k % 7 = 0 THEN 'buy' WHEN k % 7 > 0 AND user_id % 7 = 0 THEN 'sell' END AS side FROM tape""")
def trade_side_strict(spark: SparkSession, sf: str) -> DataFrame:
    t = adapters.tape(spark, sf)
    return t.select("seq", scalar.strict_side(F.col("k") % 7, F.col("user_id") % 7).alias("side"))


@query(with_views(TAPE) + """SELECT day, seq FROM tape WHERE CAST(ts AS TIME) BETWEEN TIME '13:40:00' AND TIME '19:50:00'""")
def session_time_filter(spark: SparkSession, sf: str) -> DataFrame:
    return adapters.tape(spark, sf).filter(scalar.in_session("ts")).select("day", "seq")


@query(with_views(TAPE) + """SELECT seq, CAST((us % 86400000000) // 1000 AS BIGINT) AS ms FROM tape""")
def ms_from_midnight(spark: SparkSession, sf: str) -> DataFrame:
    return adapters.tape(spark, sf).select("seq", scalar.ms_from_midnight("ts").alias("ms"))


@query(with_views(TAPE, COMMANDS) + """
SELECT day, ['NO_COMMAND', 'CLEAR_BOOK', 'ADD_BID_LEVEL', 'ADD_ASK_LEVEL', 'MODIFY_BID_LEVEL', 'MODIFY_ASK_LEVEL', 'DELETE_BID_LEVEL', 'DELETE_ASK_LEVEL'][code + 1] AS command_name,
       count(*) AS n, count(*) FILTER (WHERE qty % 2 = 1) AS n_end_of_batch FROM commands GROUP BY ALL""")
def command_counts(spark: SparkSession, sf: str) -> DataFrame:
    c = adapters.commands(spark, sf).select("day", scalar.command_name("code").alias("command_name"), (F.col("qty").bitwiseAND(F.lit(1)) != 0).alias("end_of_batch"))
    return audit.command_counts(c, ["day"])


@query(with_views(TAPE) + """SELECT seq, make_timestamp(us) AS ts2, coalesce(try_cast(event_type AS DOUBLE), 0) AS n FROM tape""")
def decode_and_cast(spark: SparkSession, sf: str) -> DataFrame:
    from tidebook.schemas import DEPTH_EPOCH_US

    t = adapters.tape(spark, sf)
    return t.select("seq", scalar.depth_time(F.col("us") + F.lit(DEPTH_EPOCH_US)).cast("timestamp_ntz").alias("ts2"), scalar.number("event_type").alias("n"))


# --- trade tape


def _flow_sql(width: int) -> str:
    return with_views(TAPE, TRADES) + f"""
SELECT (us // {width}) * {width} AS bucket, CAST(sum(size) AS BIGINT) AS vol, CAST(sum(CASE WHEN side = 'buy' THEN size ELSE -size END) AS BIGINT) AS ofi_raw,
       count(*) FILTER (WHERE side = 'buy') AS buy_count, count(*) FILTER (WHERE side = 'sell') AS sell_count, count(*) AS trade_count, round(avg(price), 6) AS mean_price,
       max(price) AS high, min(price) AS low, round(CASE WHEN sum(size) > 0 THEN sum(price * size) / sum(size) ELSE avg(price) END, 6) AS true_vwap,
       count(*) FILTER (WHERE side = 'buy') - count(*) FILTER (WHERE side = 'sell') AS directional_bias, round(count(*) FILTER (WHERE side = 'buy')::DOUBLE / count(*), 6) AS buy_ratio,
       max(price) - min(price) AS range, round(CASE WHEN min(price) <> 0 THEN (max(price) - min(price)) / min(price) END, 6) AS range_pct
FROM trades GROUP BY 1"""


@query(_flow_sql(HOUR))
def bucket_flow_fast(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(buckets.flow(adapters.trades(spark, sf), HOUR))


@query(_flow_sql(6 * HOUR))
def bucket_flow_mid(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(buckets.flow(adapters.trades(spark, sf), 6 * HOUR))


@query(_flow_sql(24 * HOUR))
def bucket_flow_slow(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(buckets.flow(adapters.trades(spark, sf), 24 * HOUR))


def _bucket_view(name: str, width: int) -> str:
    return f"""{name} AS (
  SELECT day, (us // {width}) * {width} AS bucket, CAST(sum(size) AS BIGINT) AS vol, CAST(sum(CASE WHEN side = 'buy' THEN size ELSE -size END) AS BIGINT) AS ofi_raw,
         count(*) FILTER (WHERE side = 'buy') AS buy_count, count(*) FILTER (WHERE side = 'sell') AS sell_count, count(*) AS trade_count, avg(price) AS mean_price, max(price) AS high, min(price) AS low
  FROM trades GROUP BY 1, 2)"""


_MERGED = """m AS (
  SELECT f.day, f.bucket, f.vol AS vol_fast, f.ofi_raw AS ofi_raw_fast, f.trade_count AS trade_count_fast, f.mean_price AS mean_price_fast,
         x.vol AS vol_mid, x.ofi_raw AS ofi_raw_mid, x.mean_price AS mean_price_mid, CASE WHEN x.low <> 0 THEN (x.high - x.low) / x.low END AS range_pct_mid,
         s.vol AS vol_slow, s.ofi_raw AS ofi_raw_slow, s.high - s.low AS range_slow
  FROM f LEFT JOIN x USING (day, bucket) LEFT JOIN s USING (day, bucket))"""
_BUCKETS = (TAPE, TRADES, _bucket_view("f", HOUR), _bucket_view("x", 6 * HOUR), _bucket_view("s", 24 * HOUR), _MERGED)


@query(with_views(*_BUCKETS) + """SELECT bucket, vol_fast, ofi_raw_fast, trade_count_fast, round(mean_price_fast, 6) AS mean_price_fast, vol_mid, round(range_pct_mid, 6) AS range_pct_mid, vol_slow, range_slow FROM m""")
def bucket_merge(spark: SparkSession, sf: str) -> DataFrame:
    m = buckets.merged(adapters.trades(spark, sf), HOUR, 6 * HOUR, 24 * HOUR, by=["day"])
    return rounded(m.select("bucket", "vol_fast", "ofi_raw_fast", "trade_count_fast", "mean_price_fast", "vol_mid", "range_pct_mid", "vol_slow", "range_slow"))


@query(with_views(*_BUCKETS, """w AS (
  SELECT *, avg(vol_mid) OVER r6 AS vol_ma, avg(range_pct_mid) OVER r6 AS range_ma, avg(mean_price_mid) OVER (PARTITION BY day ORDER BY bucket ROWS 999 PRECEDING) AS price_cum,
         sum(ofi_raw_mid) OVER (PARTITION BY day ORDER BY bucket ROWS UNBOUNDED PRECEDING) AS c_mid, sum(ofi_raw_slow) OVER (PARTITION BY day ORDER BY bucket ROWS UNBOUNDED PRECEDING) AS c_slow,
         last_value(mean_price_mid IGNORE NULLS) OVER (PARTITION BY day ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
  FROM m WINDOW r6 AS (PARTITION BY day ORDER BY bucket ROWS 5 PRECEDING)),
v AS (SELECT *, vol_mid / (vol_ma + 1e-9) AS vol_surge, range_pct_mid / (range_ma + 1e-9) AS range_surge, CASE WHEN before <> 0 THEN (mean_price_mid - before) / before END AS chg FROM w),
z AS (SELECT *, stddev_samp(chg) OVER (PARTITION BY day ORDER BY bucket ROWS 5 PRECEDING) * 1e4 AS rv FROM v)""") + """
SELECT bucket, round(coalesce(vol_surge, 0), 4) AS vol_surge, round(coalesce(range_surge, 0), 4) AS range_surge, round(coalesce(vol_surge / (range_surge + 1e-10), 0), 3) AS absorption,
       round(coalesce(CASE WHEN price_cum <> 0 THEN (mean_price_mid - price_cum) / price_cum * 1e4 END, 0), 4) AS price_dev_bps, round(coalesce(abs(ofi_raw_mid) * range_pct_mid * 1e4, 0), 3) AS momentum,
       round(coalesce(ofi_raw_mid / (vol_mid + 1), 0), 6) AS ofi_ratio, round(coalesce(rv, 0), 4) AS realized_vol_mid, round(coalesce(rv * sqrt(6.0), 0), 4) AS realized_vol_slow,
       CAST(coalesce(c_mid, 0) AS BIGINT) AS cum_ofi_mid, CAST(coalesce(c_slow, 0) AS BIGINT) AS cum_ofi_slow FROM z""")
def bucket_derived(spark: SparkSession, sf: str) -> DataFrame:
    d = buckets.derived(buckets.merged(adapters.trades(spark, sf), HOUR, 6 * HOUR, 24 * HOUR, by=["day"]), ["day"])
    digits = {"vol_surge": 4, "range_surge": 4, "absorption": 3, "price_dev_bps": 4, "momentum": 3, "ofi_ratio": 6, "realized_vol_mid": 4, "realized_vol_slow": 4}
    return d.select("bucket", *[F.round(c, n).alias(c) for c, n in digits.items()], "cum_ofi_mid", "cum_ofi_slow")


# --- as-of joins


@query(with_views(TAPE, TRADES, MIDS, """cum AS (
  SELECT day, us, sum(CASE WHEN side = 'sell' THEN size ELSE 0 END) OVER w AS cb, sum(CASE WHEN side = 'buy' THEN size ELSE 0 END) OVER w AS ca FROM trades WINDOW w AS (PARTITION BY day ORDER BY us, seq ROWS UNBOUNDED PRECEDING)),
j AS (SELECT m.day, m.us, m.seq, coalesce(cb, 0) AS cb, coalesce(ca, 0) AS ca FROM mids m ASOF LEFT JOIN cum c ON m.day = c.day AND m.us >= c.us)""") + """
SELECT day, seq, coalesce(greatest(0, cb - lag(cb) OVER (PARTITION BY day ORDER BY us, seq)), 0)::DOUBLE AS traded_vol_bid,
       coalesce(greatest(0, ca - lag(ca) OVER (PARTITION BY day ORDER BY us, seq)), 0)::DOUBLE AS traded_vol_ask FROM j""")
def asof_cum_volume_fusion(spark: SparkSession, sf: str) -> DataFrame:
    out = fusion.cumulative_volume(adapters.mids(spark, sf), adapters.trades(spark, sf))
    return out.select("day", "seq", "traded_vol_bid", "traded_vol_ask")


@query(with_views(TAPE, TRADES, MIDS, f"""b AS (
  SELECT day, (us // {HOUR}) * {HOUR} + {HOUR} AS ended, CAST(sum(size) AS BIGINT) AS vol, count(*) AS trade_count FROM trades GROUP BY 1, 2)""") + """
SELECT m.day, m.seq, coalesce(b.vol, 0) AS vol, coalesce(b.trade_count, 0) AS trade_count FROM mids m ASOF LEFT JOIN b ON m.day = b.day AND m.us >= b.ended""")
def asof_bucket_features(spark: SparkSession, sf: str) -> DataFrame:
    f = buckets.flow(adapters.trades(spark, sf), HOUR, by=["day"])
    return buckets.onto(adapters.mids(spark, sf), f, HOUR, ["vol", "trade_count"]).select("day", "seq", "vol", "trade_count")


@query(with_views(TAPE, TRADES, MIDS, """t AS (SELECT day, us // 1000 AS ms, side, size, CASE WHEN side = 'buy' THEN size ELSE -size END AS delta FROM trades),
j AS (SELECT m.day, m.us, m.seq, t.side, t.size, t.delta FROM (SELECT *, us // 1000 AS ms FROM mids) m ASOF LEFT JOIN t ON m.day = t.day AND m.ms > t.ms)""") + """
SELECT day, seq, coalesce(side, 'none') AS trade_side, coalesce(size, 0) AS trade_size, coalesce(delta, 0) AS trade_delta,
       CAST(sum(coalesce(delta, 0)) OVER (PARTITION BY day ORDER BY us, seq ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cum_trade_delta_session FROM j""")
def asof_trade_enrich(spark: SparkSession, sf: str) -> DataFrame:
    out = fusion.enrich(adapters.mids(spark, sf), adapters.trades(spark, sf))
    return out.select("day", "seq", "trade_side", "trade_size", "trade_delta", "cum_trade_delta_session")


# --- snapshot features

_W = "PARTITION BY day ORDER BY seq"


def _prev(c: str) -> str:
    return f"coalesce(lag({c}) OVER ({_W}), {c})"


def _imb(i: int) -> str:
    return f"CASE WHEN bq_{i} + aq_{i} > 0 THEN (bq_{i} - aq_{i}) / (bq_{i} + aq_{i}) ELSE 0 END"


_MICRO = "CASE WHEN bq_1 + aq_1 > 0 THEN (best_bid * aq_1 + best_ask * bq_1) / (bq_1 + aq_1) ELSE (best_bid + best_ask) / 2 END"
_SWEPT = {s: [f"greatest(0, {_prev(f'{s}q_{i}')} - {s}q_{i}) / ({_prev(f'{s}q_{i}')} + 1e-9) > 0.5" for i in range(1, 11)] for s in "ba"}
_FLAG = {s: f"(({_SWEPT[s][0]}) AND ({_SWEPT[s][1]}) AND ({_SWEPT[s][2]}))::INTEGER" for s in "ba"}
_COUNT = {s: " + ".join(f"({x})::INTEGER" for x in _SWEPT[s]) for s in "ba"}
_FLOW = {i: f"(bq_{i} - {_prev(f'bq_{i}')}) - (aq_{i} - {_prev(f'aq_{i}')})" for i in range(1, 6)}
_BASE = "base AS (SELECT day, ts, us, seq, spread, mid_price, vol_ask - vol_bid AS td, vol_ask + vol_bid AS volume, " + f"{_MICRO} AS microprice, {_imb(1)} AS imbalance_1, " + ", ".join(f"{_FLOW[i]} AS ofi_L{i}, {_imb(i)} AS qi_L{i}" for i in range(1, 6)) + f", {_FLAG['b']} AS stack_sweep_bid_flag, {_FLAG['a']} AS stack_sweep_ask_flag, {_COUNT['b']} AS bid_sweep_count, {_COUNT['a']} AS ask_sweep_count FROM snaps)"


def _over(expr: str, n: int) -> str:
    return f"{expr} OVER ({_W} ROWS {n - 1} PRECEDING)"


_FEATURES = "feats AS (SELECT *, ofi_L1 AS ps_delta_L1, greatest(stack_sweep_bid_flag, stack_sweep_ask_flag) AS stack_sweep_any_flag, " + ", ".join(
    [f"{_over('sum(td)', n)} AS delta_{n}" for n in (50, 100, 200, 500)]
    + [f"{_over('sum(ofi_L1)', n)} AS ofi_{n}" for n in (50, 100, 500)]
    + [f"imbalance_1 - coalesce(lag(imbalance_1, {n}) OVER ({_W}), 0) AS imb_trend_{n}, imbalance_1 / ({_over('avg(imbalance_1)', n)} + 1e-9) AS imb_ma_ratio_{n}, microprice - coalesce(lag(microprice, {n}) OVER ({_W}), 0) AS microprice_momentum_{n}" for n in (10, 50)]
    + [f"microprice - {_over('avg(microprice)', 20)} AS microprice_dev_from_ma"]
    + [f"coalesce({_over('stddev_samp(microprice)', n)}, 0) AS microprice_vol_{n}" for n in (20, 100)]
    + [f"(mid_price - sum(mid_price * volume) OVER ({_W} ROWS UNBOUNDED PRECEDING) / (sum(volume) OVER ({_W} ROWS UNBOUNDED PRECEDING) + 1e-9)) / 0.25 AS vwap_dev_ticks"]
    + [f"{_over('sum(abs(td))', 100)} / ({_over('sum(volume)', 100)} + 1e-9) AS vpin_100, sum(td) OVER ({_W} ROWS UNBOUNDED PRECEDING) AS cum_delta"]
) + " FROM base)"
_FEATS = (TAPE, MIDS, SNAPSHOTS, _BASE, _FEATURES)


def _feats(spark: SparkSession, sf: str) -> DataFrame:
    return features.compute(adapters.snapshots(spark, sf))


def _feature_query(name: str, columns: list[str]):
    """Register a query of some feature columns; ratios whose base may be near 0 are rounded to significance."""
    loose = lambda c: c.startswith("imb_ma_ratio")
    sql = with_views(*_FEATS) + "SELECT day, seq, " + ", ".join(f"round(CASE WHEN abs({c}) > 1000 THEN 0 ELSE {c} END, 4)::DOUBLE AS {c}" if loose(c) else f"round(({c})::DOUBLE, 6) AS {c}" for c in columns) + " FROM feats"

    def run(spark: SparkSession, sf: str) -> DataFrame:
        pick = lambda c: F.round(F.when(F.abs(c) > 1000, 0.0).otherwise(F.col(c)), 4) if loose(c) else F.round(F.col(c).cast("double"), 6)
        return _feats(spark, sf).select("day", "seq", *[pick(c).alias(c) for c in columns])

    run.__name__ = name
    query(sql)(run)


_feature_query("microprice_imbalance", ["spread", "mid_price", "microprice", "imbalance_1"])
_feature_query("queue_imbalance_levels", [f"qi_L{i}" for i in range(1, 6)])
_feature_query("ofi_levels", ["ps_delta_L1", *[f"ofi_L{i}" for i in range(1, 6)]])
_feature_query("stack_sweep", ["stack_sweep_bid_flag", "stack_sweep_ask_flag", "stack_sweep_any_flag", "bid_sweep_count", "ask_sweep_count"])
_feature_query("rolling_delta", ["delta_50", "delta_100", "delta_200", "delta_500", "cum_delta"])
_feature_query("rolling_ofi", ["ofi_50", "ofi_100", "ofi_500"])
_feature_query("imbalance_trend", ["imb_trend_10", "imb_trend_50"])
_feature_query("imbalance_ma_ratio", ["imb_ma_ratio_10", "imb_ma_ratio_50"])
_feature_query("microprice_momentum", ["microprice_momentum_10", "microprice_momentum_50", "microprice_dev_from_ma"])
_feature_query("microprice_vol", ["microprice_vol_20", "microprice_vol_100"])
_feature_query("vpin", ["vpin_100"])
_feature_query("session_vwap_dev", ["vwap_dev_ticks"])


@query(with_views(TAPE, MIDS, SNAPSHOTS) + f"""
SELECT day, seq, greatest(0, bq_1 - {_prev('bq_1')}) AS stack_bid, greatest(0, {_prev('bq_1')} - bq_1) AS pull_bid, greatest(0, aq_1 - {_prev('aq_1')}) AS stack_ask, greatest(0, {_prev('aq_1')} - aq_1) AS pull_ask FROM snaps""")
def stack_pull(spark: SparkSession, sf: str) -> DataFrame:
    f = features.Features()
    return adapters.snapshots(spark, sf).select("day", "seq", f.stack("bq_1").alias("stack_bid"), f.pull("bq_1").alias("pull_bid"), f.stack("aq_1").alias("stack_ask"), f.pull("aq_1").alias("pull_ask"))


# --- time windows


def _timed(c: str, f: str, hours: int) -> str:
    return f"coalesce({f}({c}) OVER (PARTITION BY day ORDER BY us RANGE BETWEEN {hours * HOUR - 1} PRECEDING AND CURRENT ROW), 0)"


_AGGS = {
    "rolling_time_mean_std": {**{f"{c}_mean_1s": (c, "avg", 1) for c in aggregates.DELTAS}, **{f"{c}_std_1s": (c, "stddev_samp", 1) for c in aggregates.DELTAS}},
    "rolling_time_means": {f"{c}_mean_1s": (c, "avg", 1) for c in aggregates.MEANS if not c.startswith("imb_ma_ratio")},
    "rolling_time_flags": {f"{c}_sum_1s": (c, "sum", 1) for c in aggregates.FLAGS},
    "rolling_time_queues": {f"{c}_mean_5s": (c, "avg", 5) for c in ("qi_L1", "qi_L2")},
}


def _aggregate_query(name: str, columns: dict[str, tuple[str, str, int]]):
    """Register a query of some aggregates; means of tick values can lie on a rounding half, so all are moved off it."""
    sql = with_views(*_FEATS) + "SELECT day, seq, " + ", ".join(f"round(({_timed(*spec)})::DOUBLE + 1e-7, 5) AS {c}" for c, spec in columns.items()) + " FROM feats"

    def run(spark: SparkSession, sf: str) -> DataFrame:
        a = aggregates.compute(_feats(spark, sf), short_us=HOUR, long_us=5 * HOUR)
        return a.select("day", "seq", *[F.round(F.col(c).cast("double") + 1e-7, 5).alias(c) for c in columns])

    run.__name__ = name
    query(sql)(run)


for _name, _columns in _AGGS.items():
    _aggregate_query(_name, _columns)


@query(with_views(*_FEATS) + f"""SELECT day, seq, CAST((us % 86400000000) // 1000 AS BIGINT) AS ts_ms,
  round(({_timed('stack_sweep_bid_flag', 'sum', 1)} + {_timed('stack_sweep_ask_flag', 'sum', 1)}) / ({_timed('bid_sweep_count', 'avg', 1)} + {_timed('ask_sweep_count', 'avg', 1)} + 1e-9), 5) AS add_cancel_ratio_1s FROM feats""")
def add_cancel_ratio(spark: SparkSession, sf: str) -> DataFrame:
    a = aggregates.compute(_feats(spark, sf), short_us=HOUR, long_us=5 * HOUR)
    return a.select("day", "seq", "ts_ms", F.round("add_cancel_ratio_1s", 5).alias("add_cancel_ratio_1s"))


@query(with_views(TAPE, f"""x AS (SELECT day, seq, k, us FROM tape UNION ALL SELECT day, seq + 1000000000 AS seq, k, (us // {HOUR}) * {HOUR} AS us FROM tape)""") + f"""
SELECT a.day, a.seq, round(avg(b.k), 6) AS k_mean, CAST(sum(b.k) AS BIGINT) AS k_sum, round(coalesce(stddev_samp(b.k), 0), 6) AS k_std, count(*) AS n
FROM x a JOIN x b ON b.day = a.day AND b.us > a.us - {2 * HOUR} AND (b.us < a.us OR (b.us = a.us AND b.seq <= a.seq)) GROUP BY a.day, a.seq""")
def rolling_time_ties(spark: SparkSession, sf: str) -> DataFrame:
    t = adapters.tape(spark, sf).select("day", "seq", "k", "us")
    x = t.union(t.select("day", (F.col("seq") + 1_000_000_000).alias("seq"), "k", buckets.bucket("us", HOUR).alias("us")))
    out = rolling_time(x, {"k_mean": ("mean", "k"), "k_sum": ("sum", "k"), "k_std": ("std", "k"), "n": ("count", "k")}, ["day"], "us", ["seq"], 2 * HOUR)
    return rounded(out.select("day", "seq", "k_mean", "k_sum", "k_std", "n"))


# --- order book


def _states(spark: SparkSession, sf: str) -> DataFrame:
    return book.states(adapters.commands(spark, sf))


_LEVELS = ", ".join(f"-b[{i}].x AS bid_px_{i}, b[{i}].q::INTEGER AS bid_qty_{i}, a[{i}].x AS ask_px_{i}, a[{i}].q::INTEGER AS ask_qty_{i}" for i in range(1, 11))


@query(with_views(TAPE, BOOK) + f"""SELECT day, seq, -b[1].x AS best_bid, a[1].x AS best_ask, a[1].x + b[1].x AS spread, (a[1].x - b[1].x) / 2 AS mid_price, {_LEVELS}
FROM states WHERE len(b) > 0 AND len(a) > 0 AND -b[1].x < a[1].x""")
def book_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    return book.snapshots(_states(spark, sf))


@query(with_views(TAPE, BOOK) + """SELECT day, seq, -b[1].x AS best_bid, a[1].x AS best_ask FROM states WHERE len(b) > 0 AND len(a) > 0 AND -b[1].x >= a[1].x""")
def book_crossed(spark: SparkSession, sf: str) -> DataFrame:
    return book.crossed(_states(spark, sf))


@query(with_views(TAPE, BOOK, """v AS (SELECT *, len(b) > 0 AND len(a) > 0 AS two, len(b) > 0 AND len(a) > 0 AND -b[1].x < a[1].x AS ok FROM states)""") + """
SELECT c.day, c.n_clears, s.* EXCLUDE (day) FROM (SELECT day, count(*) FILTER (WHERE code = 1) AS n_clears FROM commands GROUP BY day) c LEFT JOIN (
  SELECT day, count(*) FILTER (WHERE ok) AS n_snapshots, count(*) FILTER (WHERE two AND NOT ok) AS n_crossed, count(*) FILTER (WHERE missed) AS n_missed,
         round(avg(least(len(b), 10)) FILTER (WHERE ok), 6) AS mean_bid_levels, round(avg(least(len(a), 10)) FILTER (WHERE ok), 6) AS mean_ask_levels,
         min(seq) FILTER (WHERE ok) AS first_seq, max(seq) FILTER (WHERE ok) AS last_seq FROM v GROUP BY day) s USING (day)""")
def book_stats(spark: SparkSession, sf: str) -> DataFrame:
    c = adapters.commands(spark, sf)
    return book.stats(c, book.states(c))


@query(with_views(TAPE, BOOK, """t AS (SELECT day, seq, coalesce(list_sum(list_transform(b[1:5], lambda v: v.q)), 0)::DOUBLE AS bs, coalesce(list_sum(list_transform(a[1:5], lambda v: v.q)), 0)::DOUBLE AS as_ FROM states)""") + """
SELECT day, seq, round(CASE WHEN bs + as_ > 0 THEN (bs - as_) / (bs + as_) ELSE 0 END, 6) AS imbalance FROM t""")
def book_depth_imbalance(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(book.depth_imbalance(_states(spark, sf)))


# --- event sampling


def _deltas(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.deltas(adapters.mids(spark, sf))


@query(with_views(TAPE, MIDS, DELTAS) + "SELECT day, h FROM hs")
def cusum_threshold(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.threshold(_deltas(spark, sf))


@query(with_views(TAPE, MIDS, DELTAS, LADDER) + "SELECT day, h FROM cal")
def cusum_calibrated(spark: SparkSession, sf: str) -> DataFrame:
    d = _deltas(spark, sf)
    return sampling.calibrated(d, sampling.threshold(d))


@query(with_views(TAPE, MIDS, DELTAS, CUSUM.format(thresholds="hs")) + "SELECT day, seq, s FROM fold WHERE hit")
def cusum_events(spark: SparkSession, sf: str) -> DataFrame:
    d = _deltas(spark, sf)
    return sampling.cusum(d, sampling.threshold(d))


@query(with_views(TAPE, MIDS, DELTAS, CUSUM.format(thresholds="hs"), """e AS (SELECT f.day, f.seq, t.sign * t.k AS td FROM fold f JOIN tape t USING (day, seq) WHERE f.hit)""") + """
SELECT day, seq, CAST(sum(td) OVER (PARTITION BY day ORDER BY seq ROWS 29 PRECEDING) AS BIGINT) AS delta_rolling_sum_30, CAST(sum(td) OVER (PARTITION BY day ORDER BY seq ROWS 4 PRECEDING) AS BIGINT) AS delta_rolling_sum_5 FROM e""")
def sampled_rolling_delta(spark: SparkSession, sf: str) -> DataFrame:
    d = _deltas(spark, sf)
    e = sampling.cusum(d, sampling.threshold(d)).join(adapters.tape(spark, sf).select("day", "seq", (F.col("sign") * F.col("k")).alias("td")), ["day", "seq"])
    return sampling.session_features(e).select("day", "seq", "delta_rolling_sum_30", "delta_rolling_sum_5")


@query(with_views(TAPE) + "SELECT day, seq, CAST(sum(sign * k) OVER (PARTITION BY day ORDER BY seq ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cum_delta_session FROM tape")
def session_delta(spark: SparkSession, sf: str) -> DataFrame:
    t = adapters.tape(spark, sf).withColumn("td", F.col("sign") * F.col("k"))
    return sampling.with_session_delta(t).select("day", "seq", "cum_delta_session")


@query(with_views(TAPE) + f"SELECT day, seq, us // {HOUR} AS slot FROM tape QUALIFY row_number() OVER (PARTITION BY day, us // {HOUR} ORDER BY seq) = 1")
def dedup_keep_first(spark: SparkSession, sf: str) -> DataFrame:
    t = adapters.tape(spark, sf).withColumn("slot", F.expr(f"us div {HOUR}"))
    return sampling.keep_first(t, ["day"], "slot", "seq").select("day", "seq", "slot")


# --- excursions


def _exc_sql(name: str, h: int) -> str:
    return f"""{name} AS (
  SELECT e.day, e.seq, '{name}' AS horizon, e.us, arg_min(s.mid, s.us::HUGEINT * 1000000000 + s.seq) AS p0, max(s.mid) AS hi, min(s.mid) AS lo, count(*) AS n, max(s.us) AS last_us, {h} AS h
  FROM trades e JOIN mids s ON s.day = e.day AND s.us BETWEEN e.us AND e.us + {h} GROUP BY e.day, e.seq, e.us)"""


_LONG = (TAPE, TRADES, MIDS, *[_exc_sql(n, h) for n, h in HORIZONS.items()], """x AS (
  SELECT day, seq, horizon, p0, hi - p0 AS up, p0 - lo AS down, hi, lo, n, (us + h) // 1000000 AS horizon_end, (last_us >= us + h - 1000000)::INTEGER AS complete
  FROM (FROM h2 UNION ALL FROM h6 UNION ALL FROM h12))""")


def _long(spark: SparkSession, sf: str) -> DataFrame:
    return excursions.by_horizon(adapters.trades(spark, sf), adapters.mids(spark, sf), HORIZONS)


@query(with_views(*_LONG) + """SELECT day, seq, horizon, p0 AS mid_price_at_t, up AS max_up_pts, down AS max_down_pts, up / 0.25 AS max_up_ticks, down / 0.25 AS max_down_ticks, greatest(up, down) AS mae_pts,
  greatest(up, down) / 0.25 AS mae_ticks, abs(down) AS max_down_abs, horizon_end AS horizon_end_ts, complete AS window_complete, n AS n_obs, lo AS min_mid, hi AS max_mid FROM x""")
def excursions_by_horizon(spark: SparkSession, sf: str) -> DataFrame:
    return _long(spark, sf)


@query(with_views(*_LONG, "y AS (SELECT *, up / 0.25 AS u, greatest(up, down) / 0.25 AS w FROM x)") + "SELECT horizon, count(*) AS n_events, " + ", ".join(
    f"round(quantile_cont({c}, {q}), 6) AS p{int(q * 100)}_{t}_ticks" for t, c in (("up", "u"), ("mae", "w")) for q in (0.5, 0.75, 0.9, 0.95)
) + """, round(avg(u), 6) AS mean_up_ticks, round(avg(w), 6) AS mean_mae_ticks, round(median(CASE WHEN w > 0 THEN u / w ELSE 0 END), 6) AS median_up_over_mae,
  round(avg(complete) * 100, 6) AS pct_complete, round(avg(n), 6) AS mean_n_obs, max(n) AS max_n_obs FROM y GROUP BY horizon""")
def excursion_summary(spark: SparkSession, sf: str) -> DataFrame:
    return excursions.summary(_long(spark, sf))


_DAILY = "d AS (SELECT horizon, day, count(*) AS n_events, count(*) FILTER (WHERE up / 0.25 >= 4) AS hits_up, count(*) FILTER (WHERE down / 0.25 >= 4) AS hits_down, round(median(greatest(up, down) / 0.25), 6) AS median_mae_ticks FROM x GROUP BY horizon, day)"


@query(with_views(*_LONG, _DAILY) + "SELECT * FROM d")
def excursion_hit_rate(spark: SparkSession, sf: str) -> DataFrame:
    return excursions.hit_rate(_long(spark, sf), 4)


@query(with_views(*_LONG, _DAILY) + """SELECT horizon, CAST(sum(n_events) AS BIGINT) AS n_events, round(sum(hits_up) / sum(n_events), 6) AS rate_up, round(sum(hits_down) / sum(n_events), 6) AS rate_down,
  round(median(median_mae_ticks), 6) AS median_mae_ticks FROM d GROUP BY horizon""")
def excursion_overall(spark: SparkSession, sf: str) -> DataFrame:
    return excursions.overall_hit_rate(excursions.hit_rate(_long(spark, sf), 4))


@query(with_views(*_LONG) + "SELECT horizon, CAST(least(79, greatest(0, floor(up / 0.25))) AS BIGINT) AS bin, count(*) AS n FROM x GROUP BY 1, 2")
def excursion_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return excursions.histogram(_long(spark, sf))


# --- labels

_LABELS = (TAPE, MIDS, "grid AS (SELECT * FROM (VALUES " + ", ".join(f"({v}::INTEGER, {p}::DOUBLE, {s}::DOUBLE)" for v, p, s in GRID) + ") AS g(vb_ticks, pt_ticks, sl_ticks))", """
clock AS (SELECT day, seq, us, mid, row_number() OVER (PARTITION BY day ORDER BY us, seq) - 1 AS idx FROM mids),
ev AS (SELECT c.day, c.seq, c.idx AS i0, c.mid AS p0, g.*, c.mid + g.pt_ticks * 0.25 AS pt, c.mid - g.sl_ticks * 0.25 AS sl FROM clock c, grid g WHERE c.mid > 0),
hit AS (
  SELECT e.day, e.seq, e.vb_ticks, e.pt_ticks, arg_min(s.mid, s.idx) AS mid FROM ev e JOIN clock s ON s.day = e.day AND s.idx > e.i0 AND s.idx < e.i0 + e.vb_ticks AND (s.mid >= e.pt OR s.mid <= e.sl)
  GROUP BY e.day, e.seq, e.vb_ticks, e.pt_ticks),
lab AS (
  SELECT e.*, h.mid AS hit, CASE WHEN h.mid IS NULL THEN 0 WHEN h.mid >= e.pt THEN 1 ELSE -1 END AS label FROM ev e LEFT JOIN hit h USING (day, seq, vb_ticks, pt_ticks))""")
_COUNTS = "count(*) AS n_events, count(*) FILTER (WHERE label = 1) AS n_pt, count(*) FILTER (WHERE label = -1) AS n_sl, count(*) FILTER (WHERE label = 0) AS n_vertical"
_DAILY_LABELS = f"dl AS (SELECT day, vb_ticks, pt_ticks, sl_ticks, {_COUNTS} FROM lab GROUP BY ALL)"
_ALL_LABELS = f"al AS (SELECT vb_ticks, pt_ticks, sl_ticks, {_COUNTS} FROM lab GROUP BY ALL)"
_RATES = """round(pt_ticks / sl_ticks, 6) AS pt_sl_ratio, round(n_pt * 100.0::DOUBLE / n_events, 6) AS pct_pt, round(n_sl * 100.0::DOUBLE / n_events, 6) AS pct_sl, round(n_vertical * 100.0::DOUBLE / n_events, 6) AS pct_vertical,
  round(CASE WHEN greatest(n_pt, n_sl) > 0 THEN least(n_pt, n_sl)::DOUBLE / greatest(n_pt, n_sl) ELSE 0 END, 6) AS balance_ratio, round(CASE WHEN n_pt + n_sl > 0 THEN n_pt::DOUBLE / (n_pt + n_sl) ELSE 0 END, 6) AS win_rate,
  round(CASE WHEN n_sl > 0 THEN (n_pt * pt_ticks) / (n_sl * sl_ticks) END, 6) AS payoff_theoretical"""


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    m = adapters.mids(spark, sf)
    return labels.first_touch(m, m, labels.candidates(spark, GRID))


@query(with_views(*_LABELS) + """SELECT day, seq, vb_ticks, pt_ticks, sl_ticks, p0 AS mid_price_at_t, round(pt, 4) AS pt_price, round(sl, 4) AS sl_price, label,
  CASE label WHEN 1 THEN 'pt' WHEN -1 THEN 'sl' ELSE 'vertical' END AS barrier_hit, coalesce(round(hit, 4), 0) AS hit_price FROM lab""")
def first_touch_labels(spark: SparkSession, sf: str) -> DataFrame:
    return _labelled(spark, sf)


@query(with_views(*_LABELS, _ALL_LABELS) + f"SELECT *, {_RATES} FROM al")
def label_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return labels.metrics(_labelled(spark, sf))


@query(with_views(*_LABELS, _ALL_LABELS, f"r AS (SELECT *, {_RATES} FROM al)") + "SELECT *, CAST(row_number() OVER (ORDER BY balance_ratio DESC, win_rate DESC, vb_ticks, pt_ticks) AS INTEGER) AS place FROM r")
def label_leaderboard(spark: SparkSession, sf: str) -> DataFrame:
    return labels.leaderboard(labels.metrics(_labelled(spark, sf)))


@query(with_views(*_LABELS, _DAILY_LABELS) + f"SELECT *, {_RATES} FROM dl")
def label_distribution_daily(spark: SparkSession, sf: str) -> DataFrame:
    return labels.metrics(_labelled(spark, sf), ["day"])


@query(with_views(*_LABELS, _ALL_LABELS, "nd AS (SELECT vb_ticks, pt_ticks, sl_ticks, count(DISTINCT day) AS n_days FROM lab GROUP BY ALL)") + f"SELECT al.*, n_days, {_RATES} FROM al JOIN nd USING (vb_ticks, pt_ticks, sl_ticks)")
def label_distribution_aggregate(spark: SparkSession, sf: str) -> DataFrame:
    return labels.aggregate(labels.metrics(_labelled(spark, sf), ["day"]))


@query(with_views(*_LABELS, _DAILY_LABELS, f"r AS (SELECT *, {_RATES} FROM dl)") + "SELECT * FROM r WHERE balance_ratio < 0.8 AND n_events > 0")
def balance_outliers(spark: SparkSession, sf: str) -> DataFrame:
    return labels.outliers(labels.metrics(_labelled(spark, sf), ["day"]))


# --- splits and metrics


@query(with_views(TAPE) + """SELECT seq, CASE WHEN CAST(ts AS TIME) >= TIME '13:40:00' AND CAST(ts AS TIME) < TIME '18:00:00' THEN 'train' WHEN CAST(ts AS TIME) >= TIME '18:00:00' AND CAST(ts AS TIME) < TIME '18:55:00' THEN 'val'
  WHEN CAST(ts AS TIME) >= TIME '18:55:00' AND CAST(ts AS TIME) < TIME '19:50:00' THEN 'test' END AS split FROM tape""")
def split_intraday(spark: SparkSession, sf: str) -> DataFrame:
    return splits.intraday(adapters.tape(spark, sf)).select("seq", "split")


@query(with_views(TAPE, "r AS (SELECT day, dense_rank() OVER (ORDER BY day) AS r, count(*) OVER () AS n FROM (SELECT DISTINCT day FROM tape))", "q AS (SELECT *, greatest(1, floor(n * 0.2 + 1e-9)) AS t FROM r)") + """
SELECT seq, CASE WHEN r > n - t THEN 'test' WHEN r > n - 2 * t THEN 'val' ELSE 'train' END AS split FROM tape JOIN q USING (day)""")
def split_walk_forward(spark: SparkSession, sf: str) -> DataFrame:
    return splits.walk_forward(adapters.tape(spark, sf)).select("seq", "split")


_YP = "yp AS (SELECT day, us, seq, sign + 1 AS y, CASE WHEN value > 60 THEN 2 WHEN value > 25 THEN 1 ELSE 0 END AS p, [1 / (1 + k::DOUBLE), k / (2.0 * (1 + k)), k / (2.0 * (1 + k))] AS prob FROM tape)"


def _yp(spark: SparkSession, sf: str) -> DataFrame:
    t = adapters.tape(spark, sf)
    p = F.when(F.col("value") > 60, 2).when(F.col("value") > 25, 1).otherwise(0)
    k = F.col("k").cast("double")
    return t.select("day", "us", "seq", "sign", (F.col("sign") + 1).alias("y"), p.alias("p"), F.array(1 / (1 + k), k / (2 * (1 + k)), k / (2 * (1 + k))).alias("prob"))


@query(with_views(TAPE, _YP, "g AS (SELECT y, p, count(*) AS n FROM yp GROUP BY ALL)") + "SELECT y, p, n, round(n / sum(n) OVER (PARTITION BY y), 6) AS share FROM g")
def confusion_counts(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.confusion(_yp(spark, sf))


_REPORT = """t AS (SELECT y AS class, count(*) AS support, count(*) FILTER (WHERE y = p) AS hit FROM yp GROUP BY 1), c AS (SELECT p AS class, count(*) AS called FROM yp GROUP BY 1),
m AS (SELECT class, coalesce(support, 0) AS support, coalesce(hit, 0) AS hit, coalesce(called, 0) AS called FROM t FULL JOIN c USING (class)),
pr AS (SELECT *, CASE WHEN called > 0 THEN hit::DOUBLE / called ELSE 0 END AS pre, CASE WHEN support > 0 THEN hit::DOUBLE / support ELSE 0 END AS rec FROM m),
rep AS (SELECT class, round(pre, 6) AS precision, round(rec, 6) AS recall, round(CASE WHEN pre + rec > 0 THEN 2 * pre * rec / (pre + rec) ELSE 0 END, 6) AS f1, support FROM pr)"""


@query(with_views(TAPE, _YP, _REPORT) + "SELECT * FROM rep")
def class_report(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.class_report(_yp(spark, sf))


@query(with_views(TAPE, _YP, _REPORT) + """SELECT CAST(sum(support) AS BIGINT) AS n, round(sum(recall * support) / sum(support), 5) AS accuracy, round(avg(recall) FILTER (WHERE support > 0), 5) AS balanced_accuracy, round(avg(f1), 5) AS macro_f1,
  round(sum(f1 * support) / sum(support), 5) AS weighted_f1 FROM rep""")
def metric_totals(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.totals(_yp(spark, sf))


@query(with_views(TAPE, _YP) + "SELECT round(-avg(ln(greatest(1e-15, least(1 - 1e-15, prob[y + 1])))), 6) AS log_loss FROM yp")
def log_loss(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.log_loss(_yp(spark, sf))


@query(with_views(TAPE, _YP, """s AS (SELECT count(*) FILTER (WHERE y = 0 AND p = 0) AS b0, count(*) FILTER (WHERE y = 0 OR p = 0) AS u0, count(*) FILTER (WHERE y = 2 AND p = 2) AS b2, count(*) FILTER (WHERE y = 2 OR p = 2) AS u2 FROM yp),
r AS (SELECT CASE WHEN b0 > 0 THEN u0::DOUBLE / b0 ELSE 9999 END AS s0, CASE WHEN b2 > 0 THEN u2::DOUBLE / b2 ELSE 9999 END AS s2 FROM s)""") + "SELECT round(s0, 6) AS pt_short, round(s2, 6) AS pt_long, round((s0 + s2) / 2, 6) AS pt_avg FROM r")
def pt_score(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.pt_score(_yp(spark, sf))


@query(with_views(TAPE) + """SELECT event_type, count(*) AS n, count(*) FILTER (WHERE sign = -1) AS n_short, count(*) FILTER (WHERE sign = 0) AS n_flat, count(*) FILTER (WHERE sign = 1) AS n_long,
  round(CASE WHEN greatest(count(*) FILTER (WHERE sign = -1), count(*) FILTER (WHERE sign = 1)) > 0 THEN least(count(*) FILTER (WHERE sign = -1), count(*) FILTER (WHERE sign = 1))::DOUBLE / greatest(count(*) FILTER (WHERE sign = -1), count(*) FILTER (WHERE sign = 1)) ELSE 0 END, 6) AS balance,
  min(us) AS first_us, max(us) AS last_us FROM tape GROUP BY event_type""")
def dataset_summary(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.dataset_summary(adapters.tape(spark, sf), ["event_type"], "sign")


# --- audits


@query(with_views(TAPE, "c AS (SELECT day, event_type, count(*) AS n, avg(value) AS v FROM tape GROUP BY ALL)") + "SELECT day, event_type, n FROM c QUALIFY row_number() OVER (PARTITION BY day ORDER BY n DESC, event_type) = 1")
def best_per_day(spark: SparkSession, sf: str) -> DataFrame:
    return audit.best_per_group(audit.row_counts(adapters.tape(spark, sf), ["day", "event_type"]), ["day"], "n", ["event_type"])


@query(with_views(TAPE, "c AS (SELECT day, event_type, count(*) AS n FROM tape GROUP BY ALL)", "r AS (SELECT *, rank() OVER (PARTITION BY day ORDER BY n DESC) + (count(*) OVER (PARTITION BY day, n) - 1) / 2.0 AS r FROM c)") + """
SELECT event_type, round(avg(r)::DOUBLE, 6) AS mean_rank, round(stddev_samp(r), 6) AS std_rank, count(*) AS n FROM r GROUP BY 1""")
def mean_rank_features(spark: SparkSession, sf: str) -> DataFrame:
    return audit.mean_ranks(audit.row_counts(adapters.tape(spark, sf), ["day", "event_type"]), ["day"], "event_type", "n")


@query(with_views(TAPE, "c AS (SELECT day, sign, count(*) AS n FROM tape GROUP BY ALL)") + "SELECT day, sign, n, round(n * 100.0::DOUBLE / sum(n) OVER (PARTITION BY day), 6) AS pct FROM c")
def class_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return audit.class_distribution(adapters.tape(spark, sf), ["day"], "sign")


@query(with_views(TAPE, "c AS (SELECT day, count(*) AS n FROM tape GROUP BY 1)") + "SELECT round(avg(n), 6) AS mean, round(stddev_pop(n), 6) AS std, round(median(n), 6) AS median, min(n) AS least, max(n) AS most FROM c WHERE n > 0")
def row_count_stats(spark: SparkSession, sf: str) -> DataFrame:
    return audit.count_stats(audit.row_counts(adapters.tape(spark, sf), ["day"]))


@query(with_views(TAPE, "c AS (SELECT day, count(*) AS n FROM tape GROUP BY 1)", "s AS (SELECT avg(n) AS m, stddev_pop(n) AS d FROM c WHERE n > 0)") + """
SELECT day, n, round(CASE WHEN d <> 0 THEN (n - m) / d ELSE 0 END, 6) AS z, abs(CASE WHEN d <> 0 THEN (n - m) / d ELSE 0 END) > 3 AS anomaly FROM c, s""")
def row_count_anomalies(spark: SparkSession, sf: str) -> DataFrame:
    return audit.count_anomalies(audit.row_counts(adapters.tape(spark, sf), ["day"]))


@query("""WITH j AS (SELECT d.doc_id, d.lang, d.text, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id))
SELECT c.column, c.missing, round(c.missing * 100.0::DOUBLE / n, 6) AS pct FROM (SELECT count(*) AS n, count(*) FILTER (WHERE doc_id IS NULL) AS a, count(*) FILTER (WHERE lang IS NULL) AS b, count(*) FILTER (WHERE text IS NULL) AS c,
  count(*) FILTER (WHERE quality IS NULL) AS d, count(*) FILTER (WHERE toxic IS NULL) AS e FROM j), LATERAL (VALUES ('doc_id', a), ('lang', b), ('text', c), ('quality', d), ('toxic', e)) AS c("column", missing)""")
def null_rates(spark: SparkSession, sf: str) -> DataFrame:
    j = table(spark, sf, "documents").select("doc_id", "lang", "text").join(table(spark, sf, "labels"), "doc_id", "left")
    return audit.null_rates(j.select("doc_id", "lang", "text", "quality", "toxic"))


@query(f"""WITH c AS (SELECT l_returnflag, l_shipdate, count(*) AS c FROM lineitem GROUP BY ALL)
SELECT l_returnflag, CAST(sum(c) AS BIGINT) AS n, CAST(sum(c - 1) AS BIGINT) AS duplicates, round(sum(c - 1) * 100.0::DOUBLE / sum(c), 6) AS pct FROM c GROUP BY 1""")
def duplicate_ts(spark: SparkSession, sf: str) -> DataFrame:
    return audit.duplicates(table(spark, sf, "lineitem"), ["l_returnflag"], "l_shipdate")


@query("SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def missing_outputs(spark: SparkSession, sf: str) -> DataFrame:
    have = table(spark, sf, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    return audit.missing(table(spark, sf, "orders"), have, ["o_custkey"])


@query("""SELECT c.column, c.n_distinct, c.n_distinct <= 1 AS constant FROM (SELECT count(DISTINCT event_type) AS a, count(DISTINCT user_id) AS b, count(DISTINCT props) AS c FROM events), LATERAL (VALUES ('event_type', a), ('user_id', b), ('props', c)) AS c("column", n_distinct)""")
def constant_columns(spark: SparkSession, sf: str) -> DataFrame:
    return audit.constant_columns(table(spark, sf, "events"), ["event_type", "user_id", "props"])


@query(with_views(TAPE) + "SELECT t.seq, coalesce(l.k, 0) AS k FROM tape t LEFT JOIN (SELECT user_id, arg_max(k, seq) AS k FROM tape WHERE sign > 0 GROUP BY user_id) l ON l.user_id = t.k")
def lookup_or_zero(spark: SparkSession, sf: str) -> DataFrame:
    """The last value of a key, 0 where there is none."""
    t = adapters.tape(spark, sf)
    last = audit.last_by(t.filter("sign > 0"), ["user_id"], "seq", ["k"])
    return t.select("seq", F.col("k").alias("user_id")).join(last, "user_id", "left").select("seq", F.coalesce("k", F.lit(0)).alias("k"))


@query(with_views(TAPE) + "SELECT user_id, arg_max(event_type, seq) AS event_type, arg_max(k, seq) AS k FROM tape GROUP BY user_id")
def last_wins_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return audit.last_by(adapters.tape(spark, sf), ["user_id"], "seq", ["event_type", "k"])


@query("""SELECT count(*) FILTER (WHERE l.doc_id IS NOT NULL) AS n_matched, count(*) FILTER (WHERE l.doc_id IS NULL) AS n_missing FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id)""")
def semi_anti_counts(spark: SparkSession, sf: str) -> DataFrame:
    return audit.matched(table(spark, sf, "documents").select("doc_id"), table(spark, sf, "labels").select("doc_id"), ["doc_id"])


@query(with_views(TAPE) + "SELECT day, seq, k, NULL::DOUBLE AS value FROM tape WHERE sign > 0 UNION ALL SELECT day, seq, NULL, value FROM tape WHERE sign < 0")
def union_days(spark: SparkSession, sf: str) -> DataFrame:
    t = adapters.tape(spark, sf)
    return audit.union_days([t.filter("sign > 0").select("day", "seq", "k"), t.filter("sign < 0").select("day", "seq", "value")])


def _runs(spark: SparkSession, sf: str) -> DataFrame:
    """Invented runs, one an event: reach phases done, then perhaps a failure, with or without output, and lost outputs."""
    t = adapters.tape(spark, sf).select("day", "seq")
    reach, odd = F.col("seq") % 10, F.floor(F.col("seq") / 10) % 5
    flags = {}
    for k in range(1, 9):
        flags[f"done{k}"] = reach >= k
        flags[f"failed{k}"] = (odd == 1) & (reach + 1 == k)
        flags[f"out{k}"] = ((reach >= k) & ~((odd == 2) & (k >= reach - 1))) | ((odd == 1) & (reach + 1 == k) & (F.floor(F.col("seq") / 50) % 2 == 0))
    rest = {
        "seconds": F.when(F.floor(F.col("seq") / 100) % 6 == 1, F.col("seq") * 37 % 5000),
        "labels": F.when(reach >= 7, F.lit(3)).otherwise(F.floor(F.col("seq") / 600) % 4),
        "sentinels": F.floor(F.col("seq") / 2400) % 4,
        "files": F.col("seq") % 3,
    }
    return t.select("day", "seq", *[c.alias(n) for n, c in (flags | rest).items()])


# Written out from the description of the states, without the rules of the operator.
_RUNS = """r0 AS (SELECT day, seq, seq % 10 AS reach, (seq // 10) % 5 AS odd, (seq // 50) % 2 = 0 AS left_over FROM tape),
r AS (SELECT day, seq, reach, odd,
  list_transform(range(1, 9), lambda k: reach >= k) AS done, list_transform(range(1, 9), lambda k: odd = 1 AND reach + 1 = k) AS failed,
  list_transform(range(1, 9), lambda k: (reach >= k AND NOT (odd = 2 AND k >= reach - 1)) OR (odd = 1 AND reach + 1 = k AND left_over)) AS out,
  CASE WHEN (seq // 100) % 6 = 1 THEN seq * 37 % 5000 END AS seconds, CASE WHEN reach >= 7 THEN 3 ELSE (seq // 600) % 4 END AS labels, (seq // 2400) % 4 AS sentinels, seq % 3 AS files FROM r0),
g AS (SELECT *, failed[1] AND NOT out[1] AND files = 0 AS empty,
  list_max(list_filter(range(1, 9), lambda k: done[k] AND CASE WHEN k = 7 THEN labels > 0 ELSE out[k] END)) AS last_ok,
  list_max(list_filter(range(1, 5), lambda k: failed[k] AND out[k])) AS broken FROM r),
st AS (SELECT day, seq, out, labels, sentinels, last_ok, empty,
  CASE WHEN seconds IS NOT NULL THEN CASE WHEN seconds > 3600 THEN 'hung' WHEN seconds > 600 THEN 'slow' ELSE 'running' END
       WHEN empty AND NOT out[1] AND NOT out[5] AND NOT out[6] THEN 'no_input'
       WHEN done[8] THEN 'done' WHEN labels = 3 AND sentinels = 3 THEN 'ready_p8'
       WHEN out[6] THEN CASE WHEN labels + sentinels > 0 THEN 'needs_p7' ELSE 'ready_p7' END
       WHEN out[5] THEN 'needs_p6'
       WHEN broken IS NOT NULL THEN 'needs_p' || broken
       WHEN done[3] AND out[3] AND (failed[4] OR NOT out[4]) THEN 'needs_p4'
       WHEN done[2] AND out[2] AND (failed[3] OR NOT out[3]) THEN 'needs_p3'
       WHEN out[1] AND NOT done[2] THEN 'needs_p2'
       WHEN failed[1] THEN CASE WHEN empty THEN 'no_input' ELSE 'needs_p1' END
       WHEN reach = 0 THEN 'unknown' ELSE 'stalled' END AS state FROM g),
ac AS (SELECT day, seq, state,
  CASE state WHEN 'done' THEN 'none' WHEN 'ready_p8' THEN 'run_p8_only' WHEN 'ready_p7' THEN 'run_p7_candidates' WHEN 'needs_p7' THEN 'run_p7_candidates' WHEN 'needs_p6' THEN 'rerun_p6_only'
    WHEN 'needs_p4' THEN CASE WHEN out[3] THEN 'rerun_p4_p6' ELSE 'inspect_p3_output' END WHEN 'needs_p3' THEN CASE WHEN out[2] THEN 'rerun_p3_p6' ELSE 'inspect_p2_output' END
    WHEN 'needs_p2' THEN CASE WHEN out[1] THEN 'rerun_p2_p6' ELSE 'inspect_p1_input' END
    WHEN 'needs_p1' THEN CASE WHEN empty THEN 'no_action_input_missing' WHEN out[1] THEN 'inspect_p1_checkpoint_bug' ELSE 'inspect_p1_input' END
    WHEN 'no_input' THEN 'manual_review_input' WHEN 'running' THEN 'monitor' WHEN 'slow' THEN 'monitor' WHEN 'hung' THEN 'monitor'
    WHEN 'stalled' THEN coalesce('rerun_from_' || ['p1_parse', 'p2_reconstruct', 'p3_features', 'p4_agg', 'p5_sample', 'p6_excursion', 'p7', 'p8_ml'][last_ok], 'manual_review')
    ELSE 'manual_review' END AS action FROM st)"""


@query(with_views(TAPE, _RUNS) + "SELECT seq, state, action FROM ac")
def phase_state(spark: SparkSession, sf: str) -> DataFrame:
    return daystate.states(_runs(spark, sf)).select("seq", "state", "action")


@query(with_views(TAPE, _RUNS, """q AS (SELECT * FROM (VALUES (1, 'manual_review_input', 'Manual Review — Input Missing'), (2, 'manual_review', 'Manual Review — Unknown State'),
  (0, 'no_action_input_missing', 'NO INPUT — Manual Required'), (3, 'inspect_p1_checkpoint_bug', 'Inspect — P1 Checkpoint Bug'), (4, 'inspect_p1_input', 'Inspect — P1 Input/Parse'),
  (6, 'run_p8_only', 'Run P8 Only'), (7, 'run_p7_candidates', 'Run P7 Candidates (all 3)'), (8, 'rerun_p6_only', 'Rerun P6 Only'), (10, 'rerun_p4_p6', 'Rerun P4-P6'), (11, 'rerun_p3_p6', 'Rerun P3-P6'),
  (12, 'rerun_p2_p6', 'Rerun P2-P6'), (20, 'none', 'Complete — No Action'), (21, 'monitor', 'Monitor (Running)')) AS v(place, action, label))""") + """
SELECT action, count(*) AS n_days, min(day) AS first_day, max(day) AS last_day, coalesce(any_value(q.place), 22) AS place, coalesce(any_value(q.label), 'Other: ' || action) AS label
FROM ac LEFT JOIN q USING (action) GROUP BY action""")
def recovery_queues(spark: SparkSession, sf: str) -> DataFrame:
    return daystate.queues(daystate.states(_runs(spark, sf)))


@query(with_views(TAPE) + """
, g AS (SELECT user_id, event_type AS feature, sum(value) AS v FROM tape GROUP BY ALL),
r AS (SELECT feature || '_' || (user_id % 9) AS feature, user_id // 9 AS part, sum(v) AS v FROM g GROUP BY ALL),
k AS (SELECT feature, rank() OVER (PARTITION BY part ORDER BY v DESC) + (count(*) OVER (PARTITION BY part, v) - 1) / 2.0 AS r FROM r),
m AS (SELECT feature, round(avg(r), 6) AS mean_rank, round(stddev_samp(r), 6) AS std_rank, count(*) AS n FROM k GROUP BY feature)
SELECT * FROM m ORDER BY mean_rank, feature LIMIT 20""")
def top_features(spark: SparkSession, sf: str) -> DataFrame:
    """A top-20 report, so a limit."""
    t = adapters.tape(spark, sf).groupBy("user_id", F.col("event_type").alias("feature")).agg(F.sum("value").alias("v"))
    t = t.groupBy(F.concat_ws("_", "feature", (F.col("user_id") % 9).cast("string")).alias("feature"), F.floor(F.col("user_id") / 9).alias("part")).agg(F.sum("v").alias("v"))
    return audit.top_features(audit.mean_ranks(t, ["part"], "feature", "v"), "feature")


# --- rows only


_COEF = ((-0.8, 0.02, -0.4), (0.1, -0.01, 0.2), (0.7, 0.015, 0.3))
_BIAS = (0.1, -0.2, 0.05)
_Z = [f"({b} + {c[0]} * imbalance_1 + {c[1]} * delta_50 + {c[2]} * qi_L2)" for b, c in zip(_BIAS, _COEF)]
_EXP = " + ".join(f"exp({z})" for z in _Z)


@query(with_views(*_FEATS) + "SELECT day, seq, " + ", ".join(
    f"round(exp({z}) / ({_EXP}), 6) AS p{i}" for i, z in enumerate(_Z)
) + " FROM feats")
def fixed_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Class probabilities of a given multinomial model."""
    from tidebook.operators import ml

    out = ml.softmax(_feats(spark, sf), ["imbalance_1", "delta_50", "qi_L2"], _COEF, _BIAS)
    return out.select("day", "seq", *[F.round(F.col("prob")[i], 6).alias(f"p{i}") for i in range(3)])


def _train_test(spark: SparkSession, sf: str, columns: list[str]) -> DataFrame:
    from tidebook.operators import ml

    m = adapters.mids(spark, sf)
    lab = labels.first_touch(m, m, labels.candidates(spark, GRID, 1)).select("day", "seq", "label")
    return splits.walk_forward(ml.matrix(_feats(spark, sf).join(lab, ["day", "seq"]), columns))


@query()
def model_selection(spark: SparkSession, sf: str) -> DataFrame:
    """Logistic, forest and boosted baselines: metrics on held-out days, and which one is selected."""
    from tidebook.operators import ml

    columns = ["imbalance_1", "delta_50", "ofi_50", "vpin_100", "qi_L1"]
    data = _train_test(spark, sf, columns)
    train, test = ml.balanced(data.filter("split = 'train'")), data.filter("split = 'test'")
    scores = {n: ml.evaluate(ml.predictions(p.fit(train), test, ["day", "seq"])) for n, p in ml.models(columns, trees=20, rounds=5).items()}
    chosen = ml.select(scores)
    return spark.createDataFrame([(n, float(s["accuracy"]), float(s["pt_avg"]), n == chosen) for n, s in sorted(scores.items())], "model string, accuracy double, pt_avg double, selected boolean")


@query()
def feature_importance(spark: SparkSession, sf: str) -> DataFrame:
    """The forest's importances."""
    from tidebook.operators import ml

    columns = ["imbalance_1", "delta_50", "ofi_50", "vpin_100", "qi_L1"]
    train = ml.balanced(_train_test(spark, sf, columns).filter("split = 'train'"))
    return ml.importance(spark, ml.models(columns, trees=20)["forest"].fit(train), columns)


@query()
def logreg_predictions(spark: SparkSession, sf: str) -> DataFrame:
    from tidebook.operators import ml

    f = _feats(spark, sf)
    m = adapters.mids(spark, sf)
    lab = labels.first_touch(m, m, labels.candidates(spark, GRID, 1)).select("day", "seq", "label")
    columns = ["imbalance_1", "delta_50", "ofi_50", "microprice_vol_20", "vpin_100", "qi_L1", "qi_L2"]
    data = splits.walk_forward(ml.matrix(f.join(lab, ["day", "seq"]), columns))
    model = ml.models(columns)["logistic"].fit(ml.balanced(data.filter("split = 'train'")))
    return ml.predictions(model, data.filter("split = 'test'"), ["day", "seq"]).select("day", "seq", "y", "p", F.transform("prob", lambda x: F.round(x, 6)).alias("prob"))
