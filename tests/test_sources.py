import datetime as dt
import struct

import pytest
from pyspark.sql import functions as F

from tidebook.operators import audit
from tidebook.schemas import DEPTH_EPOCH_US
from tidebook.sources import depth, trades


def micros(text):
    return int(dt.datetime.fromisoformat(text + "+00:00").timestamp() * 1e6) + DEPTH_EPOCH_US


def test_depth_round_trip_numbers_before_filtering(spark, tmp_path):
    rows = [(micros(f"2021-06-08T13:{39 + i // 30:02d}:{30 + i % 30:02d}"), i % 9, i % 2, i, 19000 + i * 0.25, i) for i in range(60)]
    path = str(tmp_path / "a.depth")
    depth.write(path, rows)
    with open(path, "ab") as f:
        f.write(b"\x00" * 7)  # an unfinished record
    assert depth.read_header(path) == {"version": 1, "records": 60, "remainder": 7}
    df = depth.read(spark, path, recordsPerPartition=17, recordsPerBatch=5)
    got = {r["record_index"]: r for r in df.collect()}
    assert sorted(got) == list(range(60))
    assert got[8]["command_name"] == "UNKNOWN_8" and got[1]["command_name"] == "CLEAR_BOOK"
    assert got[3]["price"] == 19000.75 and got[3]["end_of_batch"] and not got[4]["end_of_batch"]
    whole = depth._whole(spark, path, 7).orderBy("record_index").collect()
    assert [tuple(r)[1:] for r in whole] == [tuple(r)[1:] for r in depth._ranges(spark, path, {}).orderBy("record_index").collect()]
    assert depth.mounted("file:///a/b") == "/a/b" == depth.mounted("/a/b") and depth.mounted("viewfs://s/a") is None
    inside = depth.read(spark, path, session=("13:40:00", "19:50:00"))
    assert inside.agg(F.min("record_index")).first()[0] == 30
    assert [r["n"] for r in depth.unknown_commands(df).collect()] == [6]
    assert audit.command_counts(df).agg(F.sum("n")).first()[0] == 60


def test_depth_header_errors(tmp_path):
    bad = tmp_path / "bad.depth"
    bad.write_bytes(struct.pack("<4sIII48s", b"XXXX", 64, 24, 1, b""))
    with pytest.raises(ValueError):
        depth.read_header(str(bad))
    bad.write_bytes(b"SC")
    with pytest.raises(ValueError):
        depth.read_header(str(bad))


def test_trade_layouts(spark, tmp_path):
    vendor = tmp_path / "v.csv"
    vendor.write_text(
        "Date, Time, Open, High, Low, Last, Volume, NumberOfTrades, BidVolume, AskVolume\n"
        "2021/5/4, 09:15:02.125, 1, 1, 1, 310.25, 1, 1, 1, 0\n2021/5/4, 09:16:40.500, 1, 1, 1, 311.50, 1, 1, 1, 0\n2021-5-4, 9:17:03.875, 1, 1, 1, 312.75, 1, 1, 0, 1\n"
        "2021/5/4, 09:18:00, 1, 1, 1, 312.75, 2, 1, 1, 1\n2021/5/4, 09:18:01, 1, 1, 1, 312.75, 3, 1, 0, 0\nbad, 09:18:01, 1, 1, 1, 312.75, 3, 1, 0, 1\n2021/5/4, 09:19:00.5, 1, 1, 1, 7, 3, 1, 1, 2\n"
    )
    got = sorted((r["price"], r["size"], r["side"], r["ts"].isoformat()) for r in trades.read(spark, str(vendor)).withColumn("ts", F.col("ts").cast("timestamp_ntz")).collect())
    assert got == [(7.0, 3, "buy", "2021-05-04T09:19:00.500000"), (310.25, 1, "sell", "2021-05-04T09:15:02.125000"), (311.5, 1, "sell", "2021-05-04T09:16:40.500000"), (312.75, 1, "buy", "2021-05-04T09:17:03.875000")]
    assert trades.read(spark, str(vendor), strict=True).count() == 3
    canon = tmp_path / "c.csv"
    canon.write_text("ts,price,size,side\n2021-05-04 09:15:02.125 UTC,1.5,2,Buy\n2021-05-05 00:01:25,1.5,0,sell\n2021-05-05 00:01:25,2.5,4,sell\n")
    t = trades.read(spark, str(canon))
    assert t.count() == 2
    out = str(tmp_path / "days")
    assert {str(r["day"]): r["rows"] for r in trades.write_days(t, out).collect()} == {"2021-05-04": 1, "2021-05-05": 1}
    with pytest.raises(ValueError):
        trades.write_days(t, out)
    trades.write_days(t.filter("size = 4"), out, force=True)
    assert spark.read.parquet(out).count() == 2
    with pytest.raises(ValueError):
        trades.detect(["a", "b"])
