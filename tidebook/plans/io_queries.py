"""Sources and sinks as queries: each writes files from the generic tables, reads them back and returns what it read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebook.plans.queries import query
from tidebook.plans.views import COMMANDS, TAPE, TRADES, with_views
from tidebook.session import scratch
from tidebook.schemas import DEPTH_EPOCH_US
from tidebook.sources import adapters, depth, trades

# One line in fifty has no price, one in seventy as much volume at the bid as at the ask.
_VENDOR = """v AS (SELECT day, ts, seq, price, size, side, seq % 50 = 0 AS no_price, seq % 70 = 3 AS no_side FROM trades)"""
_KEPT = "size > 0 AND NOT no_price AND NOT no_side"


def _vendor(spark: SparkSession, sf: str, both: bool = False) -> DataFrame:
    """Trades in the vendor's layout, as texts."""
    t = adapters.trades(spark, sf)
    other = F.floor(F.col("size") / 2) if both else F.lit(0)
    level = F.col("seq") % 70 == 3
    buy = F.col("side") == "buy"
    text = lambda c: c.cast("string")
    last = F.when(F.col("seq") % 50 == 0, "n/a").otherwise(text(F.col("price")))
    return t.select(
        F.date_format("ts", "yyyy/M/d").alias("Date"), F.date_format("ts", " H:mm:ss.SSSSSS").alias(" Time"), *[text(F.col("price")).alias(f" {c}") for c in ("Open", "High", "Low")],
        last.alias(" Last"), text(F.col("size")).alias(" Volume"), F.lit("1").alias(" NumberOfTrades"),
        text(F.when(level | ~buy, F.col("size")).otherwise(other)).alias(" BidVolume"), text(F.when(level | buy, F.col("size")).otherwise(other)).alias(" AskVolume"),
    )


def _plain(df: DataFrame) -> DataFrame:
    return df.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def _csv(df: DataFrame, name: str, **options) -> str:
    path = scratch(df.sparkSession, name)
    df.write.csv(path, quote="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, **options)
    return path


@query(with_views(TAPE, TRADES, _VENDOR) + f"SELECT ts, price, size, side FROM v WHERE {_KEPT}")
def vendor_trades(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(trades.read(spark, _csv(_vendor(spark, sf), "vendor", header=True)))


@query(with_views(TAPE, TRADES, _VENDOR) + f"SELECT ts, price, size, side FROM v WHERE {_KEPT} AND size // 2 = 0")
def vendor_trades_strict(spark: SparkSession, sf: str) -> DataFrame:
    """Prints with volume on both sides have no side."""
    return _plain(trades.read(spark, _csv(_vendor(spark, sf, both=True), "strict", header=True), strict=True))


@query(with_views(TAPE, TRADES, _VENDOR) + f"SELECT ts, price, size, side FROM v WHERE {_KEPT}")
def positional_trades(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(trades.read_positional(spark, _csv(_vendor(spark, sf), "positional", header=False)))


@query(with_views(TAPE, TRADES) + "SELECT ts, price, size, side FROM trades WHERE size > 0")
def canonical_trades(spark: SparkSession, sf: str) -> DataFrame:
    t = adapters.trades(spark, sf)
    stamp = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.when(F.col("seq") % 2 == 0, " UTC").otherwise(""))
    return _plain(trades.read(spark, _csv(t.select(stamp.alias("ts"), "price", "size", F.upper("side").alias("side")), "canonical", header=True)))


@query(with_views(TAPE, TRADES, _VENDOR) + f"SELECT ts, price, size, side FROM v WHERE {_KEPT}")
def latin_trades(spark: SparkSession, sf: str) -> DataFrame:
    """Files that are no UTF-8 are read as ISO-8859-1."""
    raw = _vendor(spark, sf).withColumn(" Note", F.lit("séance"))
    return _plain(trades.read(spark, _csv(raw, "latin", header=True, encoding="ISO-8859-1")))


@query(with_views(TAPE, TRADES) + "SELECT day, count(*) AS rows FROM trades WHERE day(day) % 2 = 0 GROUP BY day")
def day_sink(spark: SparkSession, sf: str) -> DataFrame:
    """Written by day, only even days allowed, then one of them written again."""
    t = adapters.trades(spark, sf).select("ts", "price", "size", "side")
    days = t.select(F.to_date("ts").alias("day")).distinct().filter(F.day("day") % 2 == 0)
    path = scratch(spark, "days")
    trades.write_days(t, path, days)
    trades.write_days(t, path, days.filter(F.day("day") % 4 == 0), force=True)
    return spark.read.parquet(path).groupBy("day").agg(F.count("*").alias("rows"))


@query(with_views(TAPE, TRADES, _VENDOR) + f"""
SELECT count(*) AS lines, count(*) FILTER (WHERE NOT ({_KEPT})) AS no_trade, count(*) FILTER (WHERE {_KEPT} AND day(day) % 3 <> 0) AS outside, count(*) FILTER (WHERE {_KEPT} AND day(day) % 3 = 0) AS kept FROM v""")
def split_counters(spark: SparkSession, sf: str) -> DataFrame:
    raw = spark.read.csv(_csv(_vendor(spark, sf), "counters", header=True), header=True, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
    days = adapters.trades(spark, sf).select("day").distinct().filter(F.day("day") % 3 == 0)
    return trades.split_counts(raw, days)


@query(with_views(TAPE) + "SELECT DISTINCT day FROM tape WHERE day(day) % 2 = 0 AND day(day) % 3 <> 1")
def complete_days(spark: SparkSession, sf: str) -> DataFrame:
    """Days with both result files; some have one, some an empty one."""
    t = adapters.tape(spark, sf)
    path = scratch(spark, "results")
    for name, rule in (("labels", F.day("day") % 2 == 0), ("scores", F.day("day") % 3 != 1)):
        t.filter(rule).groupBy("day").agg(F.count("*").cast("string").alias("value")).repartition(1, "day").write.partitionBy("day").text(f"{path}/{name}")
    listing = trades.files(spark, path, "part-*")
    kind = F.element_at(F.split("path", "/"), -3)
    return trades.complete_days(listing.withColumn("name", kind), ("labels", "scores"))


# Codes are moved on by one where the quantity is 98, so that some have no name.
_DEPTH = """d AS (SELECT make_timestamp(us) AS datetime_utc, CAST(CASE WHEN qty = 98 THEN code + 1 ELSE code END AS INTEGER) AS command_code, qty % 2 = 1 AS end_of_batch, CAST(seq % 300 AS INTEGER) AS num_orders, price, qty AS quantity FROM commands),
named AS (SELECT datetime_utc, coalesce(['NO_COMMAND', 'CLEAR_BOOK', 'ADD_BID_LEVEL', 'ADD_ASK_LEVEL', 'MODIFY_BID_LEVEL', 'MODIFY_ASK_LEVEL', 'DELETE_BID_LEVEL', 'DELETE_ASK_LEVEL'][command_code + 1], 'UNKNOWN_' || command_code) AS command_name,
  end_of_batch, num_orders, price, quantity FROM d)"""


def _depth_files(spark: SparkSession, sf: str) -> str:
    c = adapters.commands(spark, sf)
    path = scratch(spark, "depth")
    code = F.when(F.col("qty") == 98, F.col("code") + 1).otherwise(F.col("code"))
    rows = c.select("day", "seq", (F.col("us") + F.lit(DEPTH_EPOCH_US)).alias("datetime_raw"), code.alias("command_code"), (F.col("qty") % 2).alias("flags"), (F.col("seq") % 300).alias("num_orders"), "price", F.col("qty").alias("quantity"))
    depth.save(rows.repartition("day").sortWithinPartitions("day", "seq"), path)
    return path


def _depth_rows(df: DataFrame) -> DataFrame:
    return df.select(F.col("datetime_utc").cast("timestamp_ntz").alias("datetime_utc"), "command_name", "end_of_batch", "num_orders", "price", "quantity")


@query(with_views(TAPE, COMMANDS, _DEPTH) + "SELECT * FROM named")
def depth_records(spark: SparkSession, sf: str) -> DataFrame:
    """Depth files read by record ranges."""
    return _depth_rows(depth.read(spark, f"{_depth_files(spark, sf)}/*.depth", recordsPerPartition=500, recordsPerBatch=100))


@query(with_views(TAPE, COMMANDS, _DEPTH) + "SELECT * FROM named WHERE CAST(datetime_utc AS TIME) BETWEEN TIME '13:40:00' AND TIME '19:50:00'")
def depth_session(spark: SparkSession, sf: str) -> DataFrame:
    return _depth_rows(depth.read(spark, f"{_depth_files(spark, sf)}/*.depth", session=("13:40:00", "19:50:00")))


@query(with_views(TAPE, COMMANDS, _DEPTH) + "SELECT command_code, count(*) AS n FROM d WHERE command_code > 7 GROUP BY command_code")
def depth_unknown(spark: SparkSession, sf: str) -> DataFrame:
    return depth.unknown_commands(depth.read(spark, f"{_depth_files(spark, sf)}/*.depth"))
