"""Messages between many chunks and many shards, each task sending to a bounded number of others.

A chunk has something for nearly every shard, so rows for each (chunk, shard) would grow with the square of the
data. Here a row is a bundle of messages for one next node, and a task has ``FAN`` next nodes at most: nodes are
numbers in base ``FAN``, and hop k puts digit k of its target in place of the node's own. Up to ``FAN`` nodes that is
one hop, straight to the target; beyond, relays put together what goes the same way, so rows grow with the
number of nodes, ``FAN`` for each of them and hop, and hops with its logarithm. A message is (target, sender, kind, parts).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

FAN = 128
#: Columns of a row: the next node and the bundle.
SCHEMA = "node long, data binary"
Message = tuple[int, int, int, tuple[bytes, ...]]


def bundle(messages: list[Message]) -> bytes:
    head = np.array([[*m[:3], *map(len, m[3])] for m in messages], dtype=np.int64)
    return b"".join([np.array(head.shape, dtype=np.int64).tobytes(), head.tobytes(), *(p for m in messages for p in m[3])])


def messages(bundles: Iterable[bytes]) -> Iterator[Message]:
    for data in bundles:
        shape = np.frombuffer(data, dtype=np.int64, count=2)
        head = np.frombuffer(data, dtype=np.int64, count=int(shape.prod()), offset=16).reshape(shape)
        at = 16 + head.nbytes
        for row in head.tolist():
            parts = []
            for size in row[3:]:
                parts.append(data[at:at + size])
                at += size
            yield row[0], row[1], row[2], tuple(parts)


def received(table: pa.Table, column: str = "data") -> Iterator[Message]:
    """Messages of a task's rows; rows without a bundle have none."""
    return messages(x.as_py() for x in table[column] if x.is_valid)


class Routes:
    """Ways between ``nodes`` chunks or shards, numbered from 0."""

    def __init__(self, nodes: int):
        self.fan, self.hops = FAN, 1
        while self.fan ** self.hops < nodes:
            self.hops += 1

    def next_node(self, node: int, target: int, hop: int) -> int:
        base = self.fan ** hop
        return node + ((target // base) % self.fan - (node // base) % self.fan) * base

    def sent(self, found: Iterable[Message], node: int, hop: int = 0) -> pa.Table:
        """Rows with the messages that ``node`` has at a hop."""
        ways: dict[int, list[Message]] = {}
        for m in found:
            ways.setdefault(self.next_node(node, m[0], hop), []).append(m)
        return pa.table({"node": pa.array(list(ways), pa.int64()), "data": pa.array([bundle(w) for w in ways.values()], pa.binary())})

    def delivered(self, rows: DataFrame) -> DataFrame:
        """Rows of ``sent`` taken on until their node is the target of all messages."""
        def forward(hop: int):
            return lambda table: self.sent(received(table), table["node"][0].as_py(), hop)
        for hop in range(1, self.hops):
            rows = rows.groupBy("node").applyInArrow(forward(hop), SCHEMA)
        return rows


def pack(keys: np.ndarray) -> bytes:
    """Sorted keys as differences of seven bytes where these fit."""
    step = np.diff(keys, prepend=np.uint64(0))
    if len(step) and step.max() < np.uint64(1 << 56):
        return b"\7" + step.view(np.uint8).reshape(-1, 8)[:, :7].tobytes()
    return b"\10" + step.tobytes()


def unpack(data: bytes) -> np.ndarray:
    wide = np.frombuffer(data, dtype=np.uint8, offset=1).reshape(-1, data[0])
    full = np.zeros((len(wide), 8), dtype=np.uint8)
    full[:, :data[0]] = wide
    return np.cumsum(full.view(np.uint64).ravel(), dtype=np.uint64)


def dealt(shard: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of keys by shard, the shards that have any, and where each begins; one bound more for the end."""
    order = np.argsort(shard, kind="stable")
    owners, first = np.unique(shard[order], return_index=True)
    return order, owners, np.append(first, len(order))
