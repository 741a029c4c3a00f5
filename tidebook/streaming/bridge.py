"""Length-prefixed JSON over TCP: one message a row, a little-endian length and then UTF-8 JSON."""

from __future__ import annotations

import json
import socket
import struct
import threading

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def frame(message: dict) -> bytes:
    """The bytes of one message."""
    body = json.dumps(message).encode("utf-8")
    return struct.pack("<I", len(body)) + body


def unframe(data: bytes) -> tuple[list[dict], bytes]:
    """(messages that are complete, bytes left over)."""
    out = []
    while len(data) >= 4:
        (size,) = struct.unpack_from("<I", data)
        if len(data) < 4 + size:
            break
        out.append(json.loads(data[4 : 4 + size]))
        data = data[4 + size :]
    return out, data


class ActionServer:
    """Serves one client at a time; messages sent while none is connected are dropped."""

    def __init__(self, host: str = "127.0.0.1", port: int = 0):
        self.server = socket.create_server((host, port))
        self.port = self.server.getsockname()[1]
        self.client: socket.socket | None = None
        self.lock = threading.Lock()
        threading.Thread(target=self._accept, daemon=True).start()

    def _accept(self) -> None:
        while True:
            try:
                client, _ = self.server.accept()
            except OSError:
                return
            client.setsockopt(socket.IPPROTO_TCP, socket.TCP_NODELAY, 1)
            with self.lock:
                if self.client:
                    self.client.close()
                self.client = client

    def send(self, message: dict) -> bool:
        """Whether a client got the message."""
        with self.lock:
            if self.client is None:
                return False
            try:
                self.client.sendall(frame(message))
                return True
            except OSError:
                self.client.close()
                self.client = None
                return False

    def close(self) -> None:
        with self.lock:
            if self.client:
                self.client.close()
        self.server.close()


def sink(server: ActionServer):
    """A foreachBatch function that sends each row of the (small) action stream in turn."""

    def send(batch: DataFrame, _: int) -> None:
        for row in batch.select(F.to_json(F.struct("*")).alias("j")).toLocalIterator():
            server.send(json.loads(row["j"]))

    return send


def allocation(z: list[float]) -> list[float]:
    """Shares of hold and each action from their scores: softmax with a fixed 0 for hold."""
    import math

    top = max([0.0, *z])
    e = [math.exp(-top), *[math.exp(x - top) for x in z]]
    return [x / sum(e) for x in e]


def allocation_column(z: str):
    """allocation() as an array expression."""
    scores = F.concat(F.array(F.lit(0.0)), F.col(z))
    top = F.array_max(scores)
    e = F.transform(scores, lambda x: F.exp(x - top))
    return F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, b: a + b))
