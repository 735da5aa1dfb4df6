"""What the operators of this subpackage share: tables, written intermediates, columns, the training split."""

from __future__ import annotations

from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwatch.session import work_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Folders written on the way to the table that ``finished`` is making, if it is.
_on_the_way: ContextVar[list[str] | None] = ContextVar("on_the_way", default=None)


def written(frame: DataFrame, label: str) -> DataFrame:
    """The frame as a table in the shared folder: computed once, and safe from a lost executor."""
    path = work_dir(frame.sparkSession, label)
    folders = _on_the_way.get()
    if folders is not None:
        folders.append(path)
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


def finished(make: Callable[[], DataFrame], label: str) -> DataFrame:
    """What ``make`` returns, written; then the tables that were written to make it are removed, as nothing reads them any more.

    The result itself goes with the ``finished`` around this one, if there is one. After a failure everything stays.
    """
    folders: list[str] = []
    before = _on_the_way.set(folders)
    try:
        frame = make()
    finally:
        _on_the_way.reset(before)
    result = written(frame, label)
    spark = result.sparkSession
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return result


def remainder(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 3; rows with 1 are held out from learning."""
    return F.crc32(F.col(id_col).cast("string")) % 3


def held_out(id_col: str = "doc_id") -> Column:
    """A row without an id is in neither part; it counts as not held out and is never learned from."""
    return F.coalesce(remainder(id_col) == 1, F.lit(False))


def learnable(id_col: str = "doc_id") -> Column:
    return F.coalesce(remainder(id_col) != 1, F.lit(False))


def free_prefix(frame: DataFrame) -> str:
    """A prefix that no column of the frame starts with, for columns of our own beside them."""
    prefix = "_"
    while any(name.startswith(prefix) for name in frame.columns):
        prefix += "_"
    return prefix
