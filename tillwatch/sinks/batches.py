"""Write micro-batches to files so that a replayed batch replaces itself."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwatch.sinks.ledger import Epochs, Ledger, read_or_empty

STAMP = "_processed_at"
# Which file a row goes to, while the rows of a batch are gathered.
_DEALT = "dealt_to"
# Folder of a batch that no stream wrote.
NO_STREAM = "none"

_TIME = "yyyy-MM-dd HH:mm:ss.SSSSSS"

# Quotes are doubled, nulls are empty, empty text is quoted, blanks stay.
_CSV_OPTIONS = {
    "header": "true",
    "timestampFormat": _TIME,
    "quote": '"',
    "escape": '"',
    "nullValue": "",
    "emptyValue": '""',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
# The reader takes a cell equal to its null mark for null. With a mark that no
# cell holds, since NUL is escaped, "" stays an empty text and only a cell without
# quotes is null. A broken row fails the read.
_CSV_READ_OPTIONS = _CSV_OPTIONS | {"emptyValue": "", "nullValue": "\x00", "mode": "FAILFAST"}

# What no cell holds, and what stands for it. A row is one line, so a file of any size is
# read by many tasks. \x01 comes first when escaping and last when restoring.
_ESCAPES = (("\x01", "\x01b"), ("\x00", "\x01a"), ("\n", "\x01n"), ("\r", "\x01r"))


def _escaped(text: Column) -> Column:
    for char, mark in _ESCAPES:
        text = F.replace(text, F.lit(char), F.lit(mark))
    return text


def _restored(text: Column) -> Column:
    for char, mark in reversed(_ESCAPES):
        text = F.replace(text, F.lit(mark), F.lit(char))
    return text


def _texts(rows: DataFrame, change: Callable[[Column], Column]) -> DataFrame:
    return rows.withColumns({name: change(F.col(name)) for name, kind in rows.dtypes if kind == "string"})


def stamp(df: DataFrame, time: Column | None = None) -> DataFrame:
    """Add the processing time of the micro-batch.

    Within a stream ``current_timestamp`` is the batch's time in the
    checkpoint's offset log, so a replay gets the time of the first attempt,
    not the time of the replay. A batch job has no such log; there give one
    constant ``time`` for all writes of the job.
    """
    return df.withColumn(STAMP, F.current_timestamp() if time is None else time)


@dataclass(frozen=True)
class BatchSummary:
    """Rows of a stamped batch and when it was processed."""

    rows: int
    defects: int
    date: str | None
    hour: str | None


def summarize(batch: DataFrame, defective: Column | None = None) -> BatchSummary:
    """One pass over all tasks of a batch; it also fills the cache of a persisted one."""
    time = F.max(STAMP)
    row = batch.agg(
        F.count("*"),
        F.count_if(F.lit(False) if defective is None else defective),
        F.date_format(time, "yyyy-MM-dd"),
        F.date_format(time, "HH"),
    ).first()
    return BatchSummary(*row)


def glance(batch: DataFrame) -> BatchSummary:
    """Summary of whether there is a first row, for a batch that is not persisted."""
    time = F.col(STAMP)
    first = batch.select(F.date_format(time, "yyyy-MM-dd"), F.date_format(time, "HH")).head(1)
    return BatchSummary(1, 0, *first[0]) if first else BatchSummary(0, 0, None, None)


def stream_of(batch: DataFrame) -> str:
    """Id of the streaming query whose micro-batch this is; it stays the same as long as the checkpoint does."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or NO_STREAM


# Batches that are read from a merged folder in place of their own.
_MERGES = "run string, stream string, batch_id long, proc_date string, proc_hour string"


@dataclass(frozen=True)
class BatchFolders:
    """Folders ``<root>/proc_date=…[/proc_hour=…]/stream=…/batch_id=…``.

    The stamp of a batch survives a replay, hence so does its folder, and the
    write overwrites just that folder: no duplicates, and readers prune by
    date and hour. ``stream`` is the id that a streaming query keeps in its
    checkpoint: batch ids start again with a new checkpoint, and what the old
    one wrote stays beside what the new one writes.

    With a ``ledger`` readers take the newest epoch of its lineage and committed batches only, and
    closed hours can be merged: ``<root>-merged`` holds the rows of many batches in files of a good size, ``<root>-merges`` says of which.
    """

    root: str
    format: str = "csv"
    hourly: bool = False
    ledger: Ledger | None = None

    def folder(self, summary: BatchSummary, batch_id: int, stream: str = NO_STREAM) -> str:
        hour = f"/proc_hour={summary.hour}" if self.hourly else ""
        return f"{self.root.rstrip('/')}/proc_date={summary.date}{hour}/stream={stream}/batch_id={batch_id}"

    def _save(self, rows: DataFrame, folder: str, *partitions: str) -> None:
        options = {"partitionOverwriteMode": "static"}
        if self.format == "csv":
            rows = _texts(rows, _escaped)
            options |= _CSV_OPTIONS
        rows.write.mode("overwrite").options(**options).format(self.format).partitionBy(*partitions).save(folder)

    def write(self, rows: DataFrame, batch_id: int, summary: BatchSummary, files: int | None = None) -> str:
        """Write rows of a summarized batch from all tasks, or merged to at most ``files`` files."""
        folder = self.folder(summary, batch_id, stream_of(rows))
        rows = rows.drop(STAMP)
        if files is not None:
            rows = rows.coalesce(files)
        self._save(rows, folder)
        return folder

    def write_gathered(self, rows: DataFrame, batch_id: int, summary: BatchSummary, files: int) -> str:
        """Write rows of a summarized batch, which all tasks work out, to at most ``files`` files.

        Tasks deal their rows in turn to as many folders of compressed columns, and each folder is written as one file by a task. These
        columns are fewer bytes than the rows in a shuffle. A replay overwrites the folders; once the batch is written they are deleted.
        """
        spark, rows = rows.sparkSession, rows.drop(STAMP)
        folder = self.folder(summary, batch_id, stream_of(rows))
        aside = f"{self.root.rstrip('/')}-gathering/stream={stream_of(rows)}/batch_id={batch_id}"
        # the lower 33 bits number the rows of a task
        number = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) + F.spark_partition_id()
        dealt = rows.withColumn(_DEALT, F.pmod(number, F.lit(files)).cast("int"))
        dealt.write.mode("overwrite").options(partitionOverwriteMode="static", compression="zstd").partitionBy(_DEALT).parquet(aside)
        found = spark.read.schema(dealt.schema).parquet(aside)
        # A union of single partitions alone would be one partition; the last part, of no files, keeps them apart.
        parts = [found.where(F.col(_DEALT) == k).coalesce(1) for k in range(files)] + [found.where(F.col(_DEALT) < 0)]
        self._save(reduce(DataFrame.union, parts).drop(_DEALT), folder)
        path = spark._jvm.org.apache.hadoop.fs.Path(aside)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        return folder

    def _columns(self) -> dict[str, T.StructField]:
        """Of the folders, from the outermost."""
        hour = {"proc_hour": T.StringType()} if self.hourly else {}
        kinds = {"proc_date": T.StringType()} | hour | {"stream": T.StringType(), "batch_id": T.LongType()}
        return {name: T.StructField(name, kind) for name, kind in kinds.items()}

    def _load(self, spark: SparkSession, root: str, schema: T.StructType, missing_ok: bool) -> DataFrame:
        reader = spark.read.schema(schema).format(self.format)
        if self.format == "csv":
            reader = reader.options(**_CSV_READ_OPTIONS)
        try:
            return reader.load(root)
        except AnalysisException as error:
            if not missing_ok or error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], schema)

    def _restored(self, rows: DataFrame, schema: T.StructType) -> DataFrame:
        if self.format != "csv":
            return rows
        return rows.withColumns({name: _restored(F.col(name)) for name, kind in rows.dtypes if kind == "string" and name in schema.names})

    def _stored(self, spark: SparkSession, schema: T.StructType, missing_ok: bool) -> DataFrame:
        """Rows of all batches, each from where it is to be read."""
        folders = self._columns()
        names = [*schema.names, *folders]
        merges = read_or_empty(spark, f"{self.root.rstrip('/')}-merges", _MERGES)
        runs = [row.run for row in merges.select("run").distinct().collect()]
        own = self._load(spark, self.root, T.StructType([*schema, *folders.values()]), missing_ok or bool(runs)).select(*names)
        if runs:
            moved = merges.select("stream", "batch_id").distinct()
            # stream and batch id are cells of a merged file; its folders are run, date and hour
            cells = [folders[name] for name in ("stream", "batch_id")]
            outer = [field for name, field in folders.items() if name.startswith("proc_")]
            merged = self._load(spark, f"{self.root.rstrip('/')}-merged", T.StructType([*schema, *cells, T.StructField("run", T.StringType()), *outer]), False)
            own = own.join(moved, ["stream", "batch_id"], "left_anti").select(*names).unionByName(merged.where(F.col("run").isin(*runs)).select(*names))
        return self._restored(own, schema)

    def read(self, spark: SparkSession, schema: T.StructType, missing_ok: bool = False, epoch: int | str | None = None) -> DataFrame:
        """All batches, with ``proc_date``, ``proc_hour``, ``stream`` and ``batch_id`` as columns.

        With a ledger: the committed ones of one ``epoch`` of its lineage, the newest for None, or of ``ALL``; what no ledger lists is
        epoch 0, which is the newest only as long as nothing is listed.

        A root that is not there raises, since it may be a wrong path; with
        ``missing_ok`` it reads as no rows, as before the first batch.
        """
        rows = self._stored(spark, schema, missing_ok)
        if self.ledger is None:
            return rows
        epochs: Epochs = self.ledger.epochs(spark)
        return self.ledger.committed_only(rows.where(epochs.holds(epoch)))

    def merge_closed_hours(self, spark: SparkSession, schema: T.StructType, before: str) -> int:
        """Merge the committed batches of all hours before ``before`` (``yyyy-MM-dd HH``) that are not merged yet; how many these are.

        Rows go to files of about ``spark.sql.adaptive.advisoryPartitionSizeInBytes``, large hours to many, and keep their stream and batch.
        One small file, written last, says what was merged: until then readers take the batches' own folders, from then on the merged
        ones. A lost run leaves rows that nobody reads, and a replay of a merged batch is committed already and writes nothing.
        """
        if self.ledger is None or not self.hourly:
            raise ValueError("only hourly folders with a ledger are merged")
        root, run, keys = self.root.rstrip("/"), uuid.uuid4().hex, ["proc_date", "proc_hour", "stream", "batch_id"]
        merges = read_or_empty(spark, f"{root}-merges", _MERGES)
        closed = self.ledger.batches(spark).where(F.concat_ws(" ", "proc_date", "proc_hour") < before)
        found = closed.join(merges, ["stream", "batch_id"], "left_anti").select(F.lit(run).alias("run"), "stream", "batch_id", "proc_date", "proc_hour")
        # Fixed now: a batch of the last hour may be committed while the rows are written.
        found.coalesce(1).write.json(f"{root}-merging/{run}")
        todo = spark.read.schema(_MERGES).json(f"{root}-merging/{run}")
        batches = todo.count()
        if not batches:
            return 0
        rows = self._restored(self._load(spark, root, T.StructType([*schema, *self._columns().values()]), False), schema)
        self._save(rows.join(todo.drop("run"), keys, "left_semi").select(*schema.names, "stream", "batch_id", "proc_date", "proc_hour").hint("rebalance", "proc_date", "proc_hour"), f"{root}-merged/run={run}", "proc_date", "proc_hour")
        todo.coalesce(1).write.mode("error").json(f"{root}-merges/{run}")
        return batches

    def remove_merged(self, spark: SparkSession) -> int:
        """Delete the own folders of merged batches, once no reader that began before the merge is left; how many were there."""
        merges = read_or_empty(spark, f"{self.root.rstrip('/')}-merges", _MERGES)
        files = spark._jvm.org.apache.hadoop.fs
        removed = 0
        for row in merges.collect():
            path = files.Path(self.folder(BatchSummary(0, 0, row.proc_date, row.proc_hour), row.batch_id, row.stream))
            removed += path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        return removed
