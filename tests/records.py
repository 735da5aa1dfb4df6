"""Wire records for tests."""

from __future__ import annotations

import json
import os

import pyarrow as pa
import pyarrow.parquet as pq

from tillwatch.contract import KAFKA_SCHEMA


def wire_value(time: str, message: str, level: str = "INFO") -> bytes:
    return b"\x00\x00\x00\x00\x01" + json.dumps({"timestamp": time, "level": level, "message": message}).encode()


def payment(time: str, amount: float = 1.0, order: str = "o", failed: bool = False, kind: str = "Payment") -> bytes:
    if failed:
        tail, verb, level = "Reason: Card declined. IP: 1.2.3.4", "FAILED", "ERROR"
    else:
        tail, verb, level = "Payment ID: p. IP: 1.2.3.4", "successful", "INFO"
    return wire_value(time, f"{kind} {verb} for order {order}. Amount: ${amount:.2f}. User: u. {tail}", level)


def records(spark, *values: bytes | None):
    rows = [(b"key", value, "payment", 0, offset, None, 0) for offset, value in enumerate(values)]
    return spark.createDataFrame(rows, KAFKA_SCHEMA)


class Topic:
    """A folder of record files that are streamed in the order they were added."""

    def __init__(self, spark, path):
        self.spark, self.path, self.added = spark, path, 0

    def add(self, *values: bytes | None) -> None:
        target = self.path / f"part-{self.added:05}.parquet"
        self.path.mkdir(exist_ok=True)
        rows = len(values)
        table = pa.table(
            {
                "key": pa.array([b"key"] * rows, pa.binary()),
                "value": pa.array(values, pa.binary()),
                "topic": pa.array(["payment"] * rows),
                "partition": pa.array([0] * rows, pa.int32()),
                "offset": pa.array(range(self.added * 1000, self.added * 1000 + rows), pa.int64()),
                "timestamp": pa.array([None] * rows, pa.timestamp("us", "UTC")),
                "timestampType": pa.array([0] * rows, pa.int32()),
            }
        )
        pq.write_table(table, target)
        self.added += 1
        # distinct modification times fix the order of the files
        os.utime(target, (1_700_000_000 + self.added, 1_700_000_000 + self.added))
