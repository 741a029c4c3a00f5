"""Trade files: canonical and vendor layouts, detected by their header, and the day-partitioned sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebook.functions.scalar import side, strict_side, trade_time

VENDOR = {"date", "time", "last", "volume", "bidvolume", "askvolume"}
CANONICAL = {"ts", "price", "size", "side"}


def detect(columns: list[str]) -> str:
    """vendor or canonical, by header names without case or blanks; vendor wins."""
    names = {c.strip().lower() for c in columns}
    for kind, wanted in (("vendor", VENDOR), ("canonical", CANONICAL)):
        if wanted <= names:
            return kind
    raise ValueError(f"neither a vendor nor a canonical trade file: {sorted(names)}")


def normalise(raw: DataFrame, strict: bool = False) -> DataFrame:
    """ts, price, size, side from either layout; rows that cannot be read or have no side are dropped."""
    kind = detect(raw.columns)
    df = raw.select(*[F.col(f"`{c}`").alias(c.strip().lower()) for c in raw.columns])
    if kind == "vendor":
        bid, ask = F.col("bidvolume").try_cast("long"), F.col("askvolume").try_cast("long")
        of = strict_side if strict else side
        df = df.select(trade_time("date", "time").alias("ts"), F.col("last").try_cast("double").alias("price"), F.col("volume").try_cast("long").alias("size"), of(bid, ask).alias("side"))
    else:
        ts = F.coalesce(F.col("ts").try_cast("timestamp"), F.try_to_timestamp(F.regexp_replace(F.col("ts").cast("string"), " UTC$", "")))
        df = df.select(ts.alias("ts"), F.col("price").try_cast("double").alias("price"), F.col("size").try_cast("long").alias("size"), F.lower(F.trim(F.col("side").cast("string"))).alias("side"))
    return df.dropna(subset=["ts", "price", "size", "side"]).filter("size > 0")


def encoding_of(spark: SparkSession, path: str) -> str:
    """UTF-8, or ISO-8859-1 if a line of the files at path is no UTF-8."""
    broken = spark.read.text(path).filter(F.col("value").contains("\ufffd"))
    return "UTF-8" if broken.isEmpty() else "ISO-8859-1"


def read(spark: SparkSession, path: str, strict: bool = False, encoding: str | None = None) -> DataFrame:
    """Trades of a CSV file or folder with a header; the encoding is looked for where none is given."""
    encoding = encoding or encoding_of(spark, path)
    return normalise(spark.read.csv(path, header=True, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True, encoding=encoding), strict)


def read_positional(spark: SparkSession, path: str) -> DataFrame:
    """Trades of a headerless vendor export: date, time, last, volume, bid and ask volume at places 0, 1, 5, 6, 8, 9."""
    raw = spark.read.csv(path, header=False, ignoreLeadingWhiteSpace=True)
    names = {0: "date", 1: "time", 5: "last", 6: "volume", 8: "bidvolume", 9: "askvolume"}
    return normalise(raw.select(*[F.col(f"_c{i}").alias(n) for i, n in names.items()]))


def write_days(trades: DataFrame, path: str, allowed: DataFrame | None = None, force: bool = False) -> DataFrame:
    """Write trades by day and return (day, rows) as read back; only allowed days, and no day that exists unless forced.

    Only the partitions written are replaced.
    """
    spark = trades.sparkSession
    df = trades.withColumn("day", F.to_date("ts"))
    if allowed is not None:
        df = df.join(allowed.select("day").distinct(), "day", "left_semi")
    if not force:
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        if hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
            clash = spark.read.parquet(path).select("day").distinct().join(df.select("day").distinct(), "day", "left_semi")
            if not clash.isEmpty():
                raise ValueError("days exist already; pass force to replace them")
    df.write.partitionBy("day").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)
    written = spark.read.schema(df.schema).parquet(path).groupBy("day").agg(F.count("*").alias("rows"))
    return written.join(df.select("day").distinct(), "day", "left_semi")


def split_counts(raw: DataFrame, allowed: DataFrame | None = None, strict: bool = False, max_rows: int | None = None) -> DataFrame:
    """One row: lines read (the first max_rows, a parameter of the split), lines without a trade, trades outside the allowed days, trades kept."""
    if max_rows is not None:
        raw = raw.limit(max_rows)
    kept = normalise(raw, strict).withColumn("day", F.to_date("ts"))
    days = (allowed if allowed is not None else kept).select("day").distinct().withColumn("_in", F.lit(True))
    counts = kept.join(days, "day", "left").agg(F.count("*").alias("trades"), F.count_if(F.coalesce("_in", F.lit(False))).alias("kept"))
    lines = raw.agg(F.count("*").alias("lines"))
    # Both sides are one row.
    both = lines.join(F.broadcast(counts), F.lit(True))
    return both.select("lines", (F.col("lines") - F.col("trades")).alias("no_trade"), (F.col("trades") - F.col("kept")).alias("outside"), "kept")


def files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, name, day, bytes) of the files below path whose name fits pattern; day is the first date in the path's last two parts."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    name = F.element_at(F.split("path", "/"), -1)
    date = F.regexp_extract("path", r"(\d{4}-\d{2}-\d{2})[^/]*(?:/[^/]*)?$", 1)
    return found.select("path", name.alias("name"), F.try_to_date(date, "yyyy-MM-dd").alias("day"), F.col("length").alias("bytes"))


def complete_days(listing: DataFrame, required: tuple[str, ...]) -> DataFrame:
    """The days that have a file of every required name, which is not empty."""
    full = listing.filter(F.col("name").isin(*required) & (F.col("bytes") > 0) & F.col("day").isNotNull())
    return full.groupBy("day").agg(F.count_distinct("name").alias("n")).filter(F.col("n") == len(set(required))).select("day")
