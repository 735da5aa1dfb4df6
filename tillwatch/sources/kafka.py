"""Kafka as stream source and as batch or stream target.

Needs the connector that matches the Spark version on the class path, e.g.
``--packages org.apache.spark:spark-sql-kafka-0-10_2.13:4.1.2``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.readwriter import DataFrameWriter

from tillwatch.contract import TOPIC, TOPIC_PARTITIONS


# Tasks that share a topic, and records of one batch: limits of rate, they leave nothing out.
MIN_PARTITIONS = 64
MAX_OFFSETS_PER_TRIGGER = 10_000_000


@dataclass(frozen=True)
class KafkaSource:
    """Subscription to one topic.

    A stream whose next offsets the topic no longer holds fails, unless
    ``fail_on_data_loss`` is off: then it goes on and the lost records are in no result.

    ``starting_offsets`` counts at the first start only; later the checkpoint
    decides. ``min_partitions`` splits large topic partitions over more tasks:
    records are keyed by action and most have the same one, so one partition
    holds most of the topic. ``max_offsets_per_trigger`` bounds a batch, also
    the first one over a backlog.
    """

    bootstrap_servers: str
    topic: str = TOPIC
    starting_offsets: str = "earliest"
    fail_on_data_loss: bool = True
    min_partitions: int | None = MIN_PARTITIONS
    max_offsets_per_trigger: int | None = MAX_OFFSETS_PER_TRIGGER
    extra: dict[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        options = {
            "kafka.bootstrap.servers": self.bootstrap_servers,
            "subscribe": self.topic,
            "startingOffsets": self.starting_offsets,
            "failOnDataLoss": str(self.fail_on_data_loss).lower(),
        }
        if self.min_partitions is not None:
            options["minPartitions"] = str(self.min_partitions)
        if self.max_offsets_per_trigger is not None:
            options["maxOffsetsPerTrigger"] = str(self.max_offsets_per_trigger)
        return options | self.extra

    def stream(self, spark: SparkSession) -> DataFrame:
        return spark.readStream.format("kafka").options(**self.options()).load()

    def batch(self, spark: SparkSession) -> DataFrame:
        """What the topic holds now, as a table (bounded, so no per-batch limit)."""
        options = self.options()
        options.pop("maxOffsetsPerTrigger", None)
        return spark.read.format("kafka").options(**options).load()


@dataclass(frozen=True)
class KafkaTarget:
    """Topic to write records to.

    A record goes to one of ``spread_over`` partitions by its whole value
    instead of its key, so that a frequent action fills all of them evenly; with None its key decides.
    """

    bootstrap_servers: str
    topic: str = TOPIC
    spread_over: int | None = TOPIC_PARTITIONS
    extra: dict[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        return {"kafka.bootstrap.servers": self.bootstrap_servers, "topic": self.topic} | self.extra

    def rows(self, records: DataFrame) -> DataFrame:
        columns = [F.col("key"), F.col("value")]
        if self.spread_over is not None:
            spread = F.pmod(F.xxhash64("value"), F.lit(self.spread_over)).cast("int")
            columns.append(spread.alias("partition"))
        return records.select(*columns)

    def batch_writer(self, records: DataFrame) -> DataFrameWriter:
        return self.rows(records).write.format("kafka").options(**self.options())

    def stream_writer(self, records: DataFrame, checkpoint: str) -> DataStreamWriter:
        writer = self.rows(records).writeStream.format("kafka").options(**self.options())
        return writer.option("checkpointLocation", checkpoint)
