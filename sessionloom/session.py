"""Session settings, and cutting lineage through shared storage."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # call sites are looked up for each expression otherwise, which is most of a wide plan's making
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def session(master: str | None = None, app: str = "sessionloom", **conf: str) -> SparkSession:
    """A session with the engine's settings; on a cluster the master comes from spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or, where that is unset and the
    master is local, a fresh folder that is then recorded in the session. On a cluster a missing
    setting is an error, since each machine would write to a folder of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="sessionloom-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


#: What this process wrote and nobody has deleted yet.
_written: list[str] = []


def written(df: DataFrame, label: str = "cut") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The plan restarts at plain files, so losing an executor costs one stage's
    tasks at most and no upstream work is repeated by later branches.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_written(df: DataFrame) -> None:
    """Delete the files behind a frame made by :func:`written` once nothing reads it."""
    spark = df.sparkSession
    base = shared_dir(spark)
    for name in {os.path.dirname(f) for f in df.inputFiles()}:
        if name.replace("file:///", "file:/").startswith(base.replace("file:///", "file:/")):
            _delete(spark, name)


def _delete(spark: SparkSession, name: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Delete everything written so far. Results that read it must be done, for example saved: an
    operator can't know when, so whoever takes its result calls this."""
    while _written:
        _delete(spark, _written.pop())
