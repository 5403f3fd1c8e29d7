"""Results kept in the folder that all executors share."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: the cluster's spark.checkpoint.dir.

    Where that is unset, a local master gets a folder of its own, which goes when this process ends;
    any other master is an error, as its executors would write to folders that the others can't see.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not spark.sparkContext.getCheckpointDir():
        if not named and not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        own = "file://" + os.path.join(tempfile.gettempdir(), "checkpoints", uuid.uuid4().hex)
        spark.sparkContext.setCheckpointDir(named or own)
        if not named:
            delete_at_exit(spark, own)
    return named or spark.sparkContext.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Cuts the lineage: writes df once to the shared folder, so that several readers don't compute it again
    and a lost executor costs a read, not a recomputation.  The files go when this process ends, or by :func:`release`."""
    shared_folder(df.sparkSession)
    kept = df.checkpoint(eager=True)
    folder = _folder_of(kept)
    if folder:
        delete_at_exit(df.sparkSession, folder)
    return kept


def _folder_of(kept: DataFrame) -> str | None:
    plan = kept._jdf.queryExecution().logical()
    if plan.getClass().getSimpleName() != "LogicalRDD":
        return None
    file = plan.rdd().getCheckpointFile()
    return file.get() if file.isDefined() else None


def release(kept: DataFrame) -> None:
    """Deletes what :func:`materialize` wrote; for rounds that nothing reads any more."""
    folder = _folder_of(kept)
    if folder:
        _delete(kept.sparkSession, folder)
        _LEFT.pop(folder, None)


#: Folders to delete at the end, with a session that can.
_LEFT: dict[str, SparkSession] = {}


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def delete_at_exit(spark: SparkSession, folder: str) -> None:
    """Removes a shared folder when this process ends."""
    _LEFT[folder] = spark


@atexit.register
def _clear() -> None:
    for folder, spark in _LEFT.items():
        try:
            _delete(spark, folder)
        except Exception:  # the session is gone already; the cluster clears its own shared folder
            return
