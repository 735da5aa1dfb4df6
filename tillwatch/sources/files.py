"""Record files with the columns of a topic, for replays and tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillwatch.contract import KAFKA_SCHEMA

# Records of one file. A file of a few MB is one row group, which one task reads.
FILE_RECORDS = 100_000


def read_records(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(KAFKA_SCHEMA).parquet(path)


def stream_records(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Records of a folder as a stream, oldest files first, picking up files added later."""
    reader = spark.readStream.schema(KAFKA_SCHEMA)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def append_records(records: DataFrame, path: str) -> None:
    """Add records to a folder. What one task writes goes to files that many tasks read, even if it wrote most of the records."""
    records.write.mode("append").option("maxRecordsPerFile", FILE_RECORDS).parquet(path)
