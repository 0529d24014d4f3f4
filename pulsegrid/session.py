"""Session settings the jobs rely on, and lineage cuts."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the session to UTC, so that window grids and stamps mean the same everywhere.

    Timestamps are written as plain microseconds: unlike the older default they carry minimum
    and maximum per row group, which time-range reads skip by.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, ``spark.checkpoint.dir``.

    Only a session whose executors are threads of the driver gets a folder of its own without that
    setting, removed when the program ends; any other session without it is an error, since a
    machine-local folder is not seen by other machines.
    """
    context = spark.sparkContext
    configured = context.getCheckpointDir() or context.getConf().get("spark.checkpoint.dir")
    if configured is None:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="pulsegrid-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return context.getCheckpointDir()


#: Tables cut so far, by application.
_CUTS: dict[str, list[str]] = {}


def drop_cuts(spark: SparkSession) -> int:
    """Delete the tables that this application has cut, and return how many.

    For the end of a job: results that have not been written yet may still read them.
    """
    paths = _CUTS.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    return len(paths)


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to a table in the shared folder and go on from that table.

    Used where several later jobs read the same rows (training set, node table, scores), so
    that neither the second reader nor a lost executor repeats the work before it. A written
    table also tells the optimizer its true size. The table belongs to the application, which may
    remove all of them with :func:`drop_cuts`.
    """
    path = f"{shared_dir(df.sparkSession)}/cut-{uuid.uuid4().hex}"
    _CUTS.setdefault(df.sparkSession.sparkContext.applicationId, []).append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
