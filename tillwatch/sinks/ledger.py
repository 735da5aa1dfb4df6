"""Which streams wrote below a root, which succeeded which, and which of their batches are whole."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MAIN = "main"
#: Epoch of what streams wrote that no ledger knows.
UNLISTED = 0
ALL = "all"

_STREAMS = "lineage string, generation int, stream string, continues boolean"
_BATCHES = "stream string, batch_id long, proc_date string, proc_hour string, counts map<string, long>"


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON rows of all folders below a path; none before the first one is written."""
    try:
        return spark.read.schema(schema).option("recursiveFileLookup", "true").json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


@dataclass(frozen=True)
class Epochs:
    """The streams of one lineage by epoch, and all streams that any lineage lists."""

    by_epoch: dict[int, tuple[str, ...]]
    listed: tuple[str, ...]

    @property
    def newest(self) -> int:
        return max(self.by_epoch, default=UNLISTED)

    def holds(self, epoch: int | str | None) -> Column:
        """Whether a row's ``stream`` is in an epoch: the newest for None, any of this lineage for ``ALL``."""
        unlisted = ~F.col("stream").isin(*self.listed) if self.listed else F.lit(True)
        if epoch == ALL:
            own = [stream for streams in self.by_epoch.values() for stream in streams]
            return unlisted | F.col("stream").isin(*own)
        epoch = self.newest if epoch is None else epoch
        return unlisted if epoch == UNLISTED else F.col("stream").isin(*self.by_epoch.get(epoch, ()))


@dataclass(frozen=True)
class Ledger:
    """Folder of what one query, over all its checkpoints, has written below a root.

    A checkpoint is a stream with an id of its own, and its batch ids start at 0. The streams of a ``lineage`` are numbered in the order they
    began. One that ``continues`` goes on with the records behind those of the stream before it: its results add to what that one
    left, both are of one epoch. Any other stream reads the records anew and begins an epoch that replaces those
    before. Separate lineages may write below one root side by side.

    A batch is visible once it is committed, which is after all its folders are written, so a reader sees all of a batch or
    none of it. A committed batch is not written again.
    """

    path: str
    lineage: str = MAIN
    continues: bool = False

    def streams(self, spark: SparkSession) -> DataFrame:
        """One row per checkpoint that ever wrote."""
        return read_or_empty(spark, f"{self.path}/streams", _STREAMS)

    def batches(self, spark: SparkSession) -> DataFrame:
        """One row per committed batch, with what it counted."""
        return read_or_empty(spark, f"{self.path}/batches", _BATCHES)

    def epochs(self, spark: SparkSession, lineage: str | None = None) -> Epochs:
        """The lineage's epochs, from 1; collects a row per checkpoint."""
        rows = sorted(self.streams(spark).collect())
        by_epoch: dict[int, tuple[str, ...]] = {}
        epoch = UNLISTED
        for row in rows:
            if row.lineage == (lineage or self.lineage):
                epoch += not row.continues or epoch == UNLISTED
                by_epoch[epoch] = (*by_epoch.get(epoch, ()), row.stream)
        return Epochs(by_epoch, tuple(row.stream for row in rows))

    def enter(self, spark: SparkSession, stream: str) -> None:
        """List a stream behind the others of its lineage, unless it is listed. Of two that begin at the same moment one fails."""
        known = self.streams(spark).collect()
        if any(row.stream == stream for row in known):
            return
        generation = 1 + max((row.generation for row in known if row.lineage == self.lineage), default=0)
        row = spark.createDataFrame([(self.lineage, generation, stream, self.continues)], _STREAMS)
        row.coalesce(1).write.mode("error").json(f"{self.path}/streams/{self.lineage}/{generation}")

    def _batch(self, stream: str, batch_id: int) -> str:
        return f"{self.path}/batches/{stream}/{batch_id}"

    def is_committed(self, spark: SparkSession, stream: str, batch_id: int) -> bool:
        return not read_or_empty(spark, self._batch(stream, batch_id), _BATCHES).isEmpty()

    def commit(self, spark: SparkSession, stream: str, batch_id: int, date: str, hour: str, counts: dict[str, int]) -> None:
        """The batch as one small file; what a lost attempt left there is replaced."""
        row = spark.createDataFrame([(stream, batch_id, date, hour, counts)], _BATCHES)
        row.coalesce(1).write.mode("overwrite").json(self._batch(stream, batch_id))

    def committed_only(self, rows: DataFrame) -> DataFrame:
        """Rows of committed batches; those of streams that the ledger does not list are taken as they are."""
        spark = rows.sparkSession
        listed = [row.stream for row in self.streams(spark).collect()]
        if not listed:
            return rows
        whole = self.batches(spark).select(F.col("stream").alias("_stream"), F.col("batch_id").alias("_batch_id"), F.lit(True).alias("_whole"))
        joined = rows.join(whole, (F.col("stream") == F.col("_stream")) & (F.col("batch_id") == F.col("_batch_id")), "left")
        return joined.where(F.col("_whole") | ~F.col("stream").isin(*listed)).select(*rows.columns)


@dataclass(frozen=True)
class Written:
    """When a batch was processed, and what it counted."""

    date: str
    hour: str
    counts: dict[str, int]


def once(ledger: Ledger, write: Callable[[DataFrame, int], Written | None], stream_of: Callable[[DataFrame], str]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` callback that commits what ``write`` has written, and writes no committed batch again.

    Only the first batch after a start can be one that ran before. Even if it is committed it is run, without its results being kept: the
    state of an aggregation is saved by running it.
    """
    started = False

    def callback(batch: DataFrame, batch_id: int) -> None:
        nonlocal started
        spark, stream = batch.sparkSession, stream_of(batch)
        if not started:
            ledger.enter(spark, stream)
            started = True
            if ledger.is_committed(spark, stream, batch_id):
                batch.write.format("noop").mode("overwrite").save()
                return
        written = write(batch, batch_id)
        if written:
            ledger.commit(spark, stream, batch_id, written.date, written.hour, written.counts)

    return callback
