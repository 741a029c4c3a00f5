"""Helpers that several training-data operators share: written tables, global order, components."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; one of our own, gone at exit, only where a local session names none (as in tests)."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="tidebook-checkpoints-")
        atexit.register(shutil.rmtree, folder, True)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return folder


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


FILE_ROWS, LEAST_FILES = 20_000, 6  # rows a file of a table of known size, and files it gets at least


def materialize(df: DataFrame, name: str, codec: str = "snappy", rows: int | None = None) -> DataFrame:
    """Write df to the shared folder and read it again: cuts lineage and survives lost executors.

    The write's own shuffle files go with it; else they stay until the driver collects its garbage.
    rows is what df has at most, where the caller knows it: a small table is then written by few tasks. Each
    part file makes the JVM start processes (chmod, on local folders) that share its memory for a moment.
    """
    if rows is not None:
        df = df.coalesce(max(LEAST_FILES, -(-rows // FILE_ROWS)))
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tidebook/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", codec).parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    made = spark.read.schema(df.schema).parquet(path)
    made._folder = path
    return made


def release(*tables: DataFrame) -> None:
    """Remove the files of tables from materialize() that nothing reads any more."""
    for t in tables:
        spark = t.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(t._folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fold(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo modulus; 0 for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus, F.lit(0))


def global_index(df: DataFrame, keys: list[Column], name: str, into: str = "pos") -> DataFrame:
    """Number the rows 0, 1, ... by keys, without one task seeing all rows.

    A range exchange sorts each partition; the only thing gathered is one row per partition.
    """
    spark = df.sparkSession
    ids = materialize(
        df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id()), name
    )
    part = F.shiftright("_at", 33)
    sizes = ids.groupBy(part.alias("_part")).count().orderBy("_part").collect()  # one row a partition
    offsets, total = [], 0
    for row in sizes:
        offsets.append((row["_part"], total))
        total += row["count"]
    table = spark.createDataFrame(offsets, "_part bigint, _base bigint")
    low = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        ids.withColumn("_part", part)
        .join(F.broadcast(table), "_part")
        .withColumn(into, F.col("_base") + low)
        .drop("_at", "_part", "_base")
    )


HOT = 256  # a key is hot if it holds at least this fraction (1/HOT) of all rows: fewer than HOT keys can


def join_hot(rows: DataFrame, table: DataFrame, keys: list[str], n: str, total: int | None = None) -> DataFrame:
    """Inner join of rows with a table of one row a key, n of rows each; hot keys are not dealt to one task.

    The at most HOT hot keys are broadcast; every key that is left holds less than 1/HOT of the rows.
    total is the number of rows where the caller knows it.
    """
    if total is None:
        total = table.agg(F.sum(n)).first()[0] or 0
    is_hot = F.col(n) * HOT >= F.lit(total)
    hot = F.broadcast(table.filter(is_hot))
    cold = rows.join(hot.select(*keys), keys, "left_anti").join(table.filter(~is_hot), keys)
    return rows.join(hot, keys).unionByName(cold).drop(n)


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of 0..n-1 over the links a-b."""
    lab = np.arange(n)
    while len(a):
        low = np.minimum(lab[a], lab[b])
        np.minimum.at(lab, a, low)
        np.minimum.at(lab, b, low)
        while True:
            hop = lab[lab]
            if np.array_equal(hop, lab):
                break
            lab = hop
        live = lab[a] != lab[b]
        a, b = lab[a[live]], lab[b[live]]
    return lab


def _solved(edges: DataFrame) -> DataFrame:
    """components() of a bounded edge table, by one task."""

    def run(batches):
        a, b = [], []
        for x in batches:
            a.append(x.column(0))
            b.append(x.column(1))
        if a:
            kind = a[0].type
            nodes, at = np.unique(pa.chunked_array([*a, *b]).to_numpy(), return_inverse=True)
            lab = local_roots(len(nodes), *np.split(at, 2))
            for lo in range(0, len(nodes), 10_000):
                part = slice(lo, lo + 10_000)
                yield pa.RecordBatch.from_arrays([pa.array(nodes[part], kind), pa.array(nodes[lab[part]], kind)], names=["node", "root"])

    kind = edges.schema["a"].dataType.simpleString()
    return edges.select("a", "b").coalesce(1).mapInArrow(run, f"node {kind}, root {kind}")


def components(edges: DataFrame, name: str, local: int = 0) -> DataFrame:
    """(node, root) for every node of edges (a, b): root is the smallest node it can reach.

    Alternates large-star and small-star steps; each step keeps at most one row per edge, is
    written to the shared folder, and stops once the edge set no longer changes. At most local
    edges, of a table that is cheap to read, go to one task instead.
    """
    if local and edges.count() <= local:
        return _solved(edges)

    def step(e: DataFrame, small: bool, total: int) -> DataFrame:
        if small:
            both = e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        else:
            both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select(F.col("b"), F.col("a")))
        low = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")
        low = materialize(low, name, rows=2 * total)  # it is read several times, and plans of plans grow fast
        # The smallest node of a large class is a hub, whose edges are not dealt to one task.
        out = join_hot(both, low, ["u"], "n", total)
        if small:
            out = out.select(F.col("v").alias("a"), F.col("m").alias("b")).union(low.select("u", "m"))
        else:
            out = out.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        made = materialize(out.filter("a <> b").distinct(), name, rows=2 * total)
        release(low)
        return made

    def mark(e: DataFrame):
        row = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return tuple(row)

    e = materialize(edges.select("a", "b").filter("a <> b").distinct(), name)
    seen = mark(e)
    while seen[0]:
        large = step(e, False, 2 * seen[0])
        small = step(large, True, seen[0])
        release(e, large)
        e = small
        now = mark(e)
        if now == seen:
            break
        seen = now
    return e.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        e.select(F.col("b"), F.col("b")).distinct()
    )
