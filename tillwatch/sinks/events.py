"""The event log: decoded records in Parquet, written exactly once by Spark's file sink."""

from __future__ import annotations

from dataclasses import dataclass
from typing import ClassVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwatch.contract import ENRICHED_SCHEMA, QUARANTINE_SCHEMA
from tillwatch.operators.enrich import is_accepted, is_defective
from tillwatch.sinks.batches import STAMP

ENRICHED, QUARANTINE = "enriched", "quarantine"


def _row(kind: str, filled: T.StructType) -> Column:
    """A row of the log with the fields of one kind; those of the other are null."""
    cells = [
        (F.col(field.name) if field in filled.fields else F.lit(None).cast(field.dataType)).alias(field.name)
        for field in (*ENRICHED_SCHEMA, *QUARANTINE_SCHEMA)
    ]
    day, hour = F.date_format(STAMP, "yyyy-MM-dd").alias("proc_date"), F.date_format(STAMP, "HH").alias("proc_hour")
    return F.struct(*cells, F.lit(kind).alias("kind"), day, hour)


@dataclass(frozen=True)
class EventLog:
    """Folders ``<root>/kind=…/proc_date=…/proc_hour=…``, where ``kind`` is ``enriched`` or ``quarantine``.

    Spark's file sink lists in ``<root>/_spark_metadata`` the files of every committed batch. Readers, streams among them, see the listed
    files only, and a batch that is run again after a failure adds nothing to the list. So a stream over the log counts every event once,
    whenever either stream was stopped. The root must not be written by anything else.
    """

    root: str

    FOLDERS: ClassVar[tuple[str, ...]] = ("kind", "proc_date", "proc_hour")
    SCHEMA: ClassVar[T.StructType] = T.StructType([*ENRICHED_SCHEMA, *QUARANTINE_SCHEMA, *[T.StructField(name, T.StringType()) for name in FOLDERS]])

    @staticmethod
    def rows(classified: DataFrame, quarantine: bool = True) -> DataFrame:
        """Rows of the log from stamped, classified records; one without a usable time gives a row of each kind."""
        kinds = [F.when(is_accepted(), _row(ENRICHED, ENRICHED_SCHEMA))]
        if quarantine:
            kinds.append(F.when(is_defective(), _row(QUARANTINE, QUARANTINE_SCHEMA)))
        # A generator evaluates the record once for both kinds; see keep_rows.
        return classified.select(F.inline(F.filter(F.array(*kinds), lambda row: row.isNotNull())))

    def _kind(self, rows: DataFrame, kind: str, schema: T.StructType) -> DataFrame:
        return rows.where(F.col("kind") == kind).select(*schema.names, "proc_date", "proc_hour")

    def enriched(self, spark: SparkSession) -> DataFrame:
        return self._kind(spark.read.schema(self.SCHEMA).parquet(self.root), ENRICHED, ENRICHED_SCHEMA)

    def quarantined(self, spark: SparkSession) -> DataFrame:
        return self._kind(spark.read.schema(self.SCHEMA).parquet(self.root), QUARANTINE, QUARANTINE_SCHEMA)

    def stream(self, spark: SparkSession) -> DataFrame:
        """Enriched events as they are committed. The folder is made if the first batch has not been written yet."""
        path = spark._jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
        return self._kind(spark.readStream.schema(self.SCHEMA).parquet(self.root), ENRICHED, ENRICHED_SCHEMA)
