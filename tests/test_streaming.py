import json
import socket

import pytest

from tidebook.streaming import bridge, flows


def test_bucket_stream_closes_on_watermark(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    rows = [("2026-01-05 10:00:00", 1.0, 2, "buy"), ("2026-01-05 10:00:00.5", 2.0, 3, "sell"), ("2026-01-05 10:00:05", 2.0, 1, "buy")]
    (src / "a.json").write_text("\n".join(json.dumps(dict(zip(("ts", "price", "size", "side"), r))) for r in rows))
    s = spark.readStream.schema("ts timestamp, price double, size bigint, side string").json(str(src))
    q = flows.bucket_flow(s).writeStream.format("memory").queryName("tape_buckets").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    got = [(r["vol"], r["ofi_raw"], r["trade_count"]) for r in spark.table("tape_buckets").collect()]
    assert got == [(5, -1, 2)]


def test_cusum_stream_keeps_state_between_batches(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    mids = [100.0, 100.25, 100.5, 100.75, 100.5, 100.0]
    s = spark.readStream.schema("symbol string, seq bigint, mid double").json(str(src))
    q = flows.cusum(s, 0.5).writeStream.format("memory").queryName("cusum_hits").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).start()
    for i, part in enumerate((mids[:3], mids[3:])):
        (src / f"{i}.json").write_text("\n".join(json.dumps({"symbol": "x", "seq": 3 * i + k, "mid": m}) for k, m in enumerate(part)))
        q.processAllAvailable()
    q.stop()
    assert sorted((r["seq"], r["s"]) for r in spark.table("cusum_hits").collect()) == [(3, 0.75), (5, -0.75)]


def test_bridge_frames_and_server(spark):
    data = bridge.frame({"a": 1}) + bridge.frame({"b": "é"})
    assert bridge.unframe(data + b"\x05") == ([{"a": 1}, {"b": "é"}], b"\x05")
    server = bridge.ActionServer()
    assert not server.send({"x": 0})
    with socket.create_connection(("127.0.0.1", server.port)) as c:
        for _ in range(100):
            if server.send({"x": 1}):
                break
            __import__("time").sleep(0.02)
        bridge.sink(server)(spark.createDataFrame([(7,)], "y int"), 0)
        buffer, got = b"", []
        while len(got) < 2:
            messages, buffer = bridge.unframe(buffer + c.recv(100))
            got += messages
        assert got[0] == {"x": 1} and got[1] == {"y": 7}
    server.close()


def test_allocation_column(spark):
    got = spark.createDataFrame([([1.0, -1.0],)], "z array<double>").select(bridge.allocation_column("z").alias("a")).first()["a"]
    assert got == pytest.approx(bridge.allocation([1.0, -1.0])) and sum(got) == pytest.approx(1)
