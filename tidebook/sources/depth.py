"""Binary market-depth logs as a Spark data source.

A file is a 64-byte header and fixed 24-byte little-endian records. On a file system that is mounted the
file is split by record ranges, each read as one Arrow batch at a time; from any other store whole files
come through Spark's own reader, one a row. Numbering counts every record of the file, so filters may
follow. Writing makes one file a partition.
"""

from __future__ import annotations

import glob
import os
import re
import struct
import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from tidebook.functions.scalar import command_name, depth_time, in_session

MAGIC, HEADER, RECORD = b"SCDD", 64, 24
_LAYOUT = np.dtype([("raw", "<i8"), ("code", "u1"), ("flags", "u1"), ("orders", "<u2"), ("price", "<f4"), ("quantity", "<u4"), ("spare", "<u4")])
_HEAD = struct.pack("<4sIII48s", MAGIC, HEADER, RECORD, 1, b"")
RAW_SCHEMA = "file string, record_index bigint, datetime_raw bigint, command_code int, flags int, num_orders int, price double, quantity bigint"


def mounted(path: str) -> str | None:
    """The path of a file: URI or a plain path; None for any other store."""
    scheme = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):/", path)
    if scheme is None:
        return path
    return re.sub(r"^file:/+", "/", path) if scheme[1].lower() == "file" else None


def read_header(path: str) -> dict:
    """Header fields and record count of a depth file; ValueError if it is not one."""
    with open(path, "rb") as f:
        return _header(path, f.read(HEADER), os.path.getsize(path))


def _header(path: str, head: bytes, size: int) -> dict:
    if len(head) < HEADER:
        raise ValueError(f"{path}: header is truncated")
    magic, header_size, record_size, version = struct.unpack_from("<4sIII", head)
    if (magic, header_size, record_size) != (MAGIC, HEADER, RECORD):
        raise ValueError(f"{path}: magic {magic!r}, header {header_size}, record {record_size}")
    return {"version": version, "records": (size - HEADER) // RECORD, "remainder": (size - HEADER) % RECORD}


class _Range(InputPartition):
    def __init__(self, path: str, start: int, stop: int):
        self.path, self.start, self.stop = path, start, stop


class DepthReader(DataSourceReader):
    def __init__(self, options: dict):
        self.pattern = mounted(options["path"])
        self.split = int(options.get("recordsPerPartition", 2_000_000))
        self.batch = int(options.get("recordsPerBatch", 100_000))

    def partitions(self) -> list[_Range]:
        paths = sorted(glob.glob(self.pattern) or [self.pattern])
        out = []
        for p in paths:
            n = read_header(p)["records"]
            out += [_Range(p, at, min(n, at + self.split)) for at in range(0, n, self.split)]
        return out

    def read(self, part: _Range):
        with open(part.path, "rb") as f:
            for at in range(part.start, part.stop, self.batch):
                n = min(self.batch, part.stop - at)
                f.seek(HEADER + at * RECORD)
                yield _batch(part.path, at, f.read(n * RECORD))


def _batch(path: str, at: int, data: bytes) -> pa.RecordBatch:
    """Records from number at on as a batch of RAW_SCHEMA."""
    r = np.frombuffer(data, _LAYOUT)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([path] * len(r)), pa.array(np.arange(at, at + len(r))), pa.array(r["raw"]), pa.array(r["code"].astype(np.int32)), pa.array(r["flags"].astype(np.int32)),
            pa.array(r["orders"].astype(np.int32)), pa.array(np.round(r["price"].astype(np.float64), 4)), pa.array(r["quantity"].astype(np.int64)),
        ],
        names=["file", "record_index", "datetime_raw", "command_code", "flags", "num_orders", "price", "quantity"],
    )


class DepthWriter(DataSourceArrowWriter):
    """Writes each partition's rows (datetime_raw, command_code, flags, num_orders, price, quantity) as one file of a mounted folder."""

    def __init__(self, options: dict):
        self.folder = mounted(options["path"])
        if self.folder is None:
            raise ValueError("depth files are written to mounted file systems only")

    def write(self, batches):
        os.makedirs(self.folder, exist_ok=True)
        name = f"{self.folder}/part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.depth"
        with open(f"{name}.tmp", "wb") as f:
            f.write(_HEAD)
            for b in batches:
                rows = np.zeros(b.num_rows, dtype=_LAYOUT)
                for field, column in zip(("raw", "code", "flags", "orders", "price", "quantity"), ("datetime_raw", "command_code", "flags", "num_orders", "price", "quantity")):
                    rows[field] = b.column(column).to_numpy(zero_copy_only=False)
                f.write(rows.tobytes())
        return _Written(name)

    def commit(self, messages) -> None:
        """Only now do the files get their names, so that a task that is run again leaves no second copy."""
        for m in messages:
            if m is not None:
                os.replace(f"{m.path}.tmp", m.path)


class _Written(WriterCommitMessage):
    def __init__(self, path: str):
        self.path = path


class DepthSource(DataSource):
    """spark.read.format('depth').load(path or glob)."""

    @classmethod
    def name(cls) -> str:
        return "depth"

    def schema(self) -> str:
        return RAW_SCHEMA

    def reader(self, schema) -> DepthReader:
        return DepthReader(self.options)

    def writer(self, schema, overwrite: bool) -> DepthWriter:
        return DepthWriter(self.options)


def _ranges(spark: SparkSession, path: str, options: dict) -> DataFrame:
    spark.dataSource.register(DepthSource)
    return spark.read.format("depth").options(**options).load(path)


def _whole(spark: SparkSession, path: str, step: int) -> DataFrame:
    """The records of files that only Spark reaches, each file one value of at most 2 GB."""

    def run(batches):
        for b in batches:
            for name, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                n = _header(name, content[:HEADER], len(content))["records"]
                for at in range(0, n, step):
                    yield _batch(name, at, content[HEADER + at * RECORD : HEADER + min(n, at + step) * RECORD])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, RAW_SCHEMA)


def save(rows: DataFrame, folder: str) -> None:
    """Write rows (datetime_raw, command_code, flags, num_orders, price, quantity) as depth files, one a partition."""
    rows.sparkSession.dataSource.register(DepthSource)
    kinds = {"datetime_raw": "bigint", "command_code": "int", "flags": "int", "num_orders": "int", "price": "double", "quantity": "bigint"}
    rows.select(*[F.col(c).cast(k).alias(c) for c, k in kinds.items()]).write.format("depth").mode("append").save(folder)


def read(spark: SparkSession, path: str, session: tuple[str, str] | None = None, **options) -> DataFrame:
    """The events table of depth files: decoded times and commands, optionally only the session's."""
    raw = _ranges(spark, path, options) if mounted(path) else _whole(spark, path, int(options.get("recordsPerBatch", 100_000)))
    out = raw.select(
        "file", "record_index", "datetime_raw", depth_time("datetime_raw").alias("datetime_utc"), "command_code", command_name("command_code").alias("command_name"), "flags",
        (F.col("flags").bitwiseAND(F.lit(1)) != 0).alias("end_of_batch"), "num_orders", "price", "quantity",
    )
    return out.filter(in_session("datetime_utc", *session)) if session else out


def write(path: str, rows: list[tuple], version: int = 1) -> None:
    """A depth file of (raw time, code, flags, orders, price, quantity) rows, for tests and exports."""
    body = np.array([(*r, 0) for r in rows], dtype=_LAYOUT)
    with open(path, "wb") as f:
        f.write(struct.pack("<4sIII48s", MAGIC, HEADER, RECORD, version, b""))
        f.write(body.tobytes())


def unknown_commands(events: DataFrame) -> DataFrame:
    """(command_code, n) of records whose command has no name."""
    return events.filter(~F.col("command_code").between(0, 7)).groupBy("command_code").agg(F.count("*").alias("n"))
