"""Spark session defaults and the shared scratch folder.

Everything here is plain Spark configuration; nothing runs outside Spark.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(
    master: str | None = None,
    app_name: str = "sliceflow",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the settings every sliceflow job expects.

    * UTC session time zone, so timestamp arithmetic is reproducible.
    * AQE on: runtime coalescing of shuffle partitions, skew-join splitting,
      and broadcast only when the runtime size is below the threshold.
    * UI off: no web server is started.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.shuffle.partitions": str(shuffle_partitions or 8),
    }
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster it must be set by the deployment (a file system that every
    executor and the driver can reach); without it a job fails here.  Only on a
    local master, where driver and executors are one process, a fresh folder
    is made and registered.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
        if not d:
            if not sc.master.split("[")[0] == "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            d = tempfile.mkdtemp(prefix="sliceflow-ckpt-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared checkpoint root.

    Used for job outputs that must be written and read back (artifacts,
    stream sinks, lineage cuts).  Each call returns a path nobody else uses.
    """
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/sliceflow-{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.  Every later use
    sees the same rows with the same values, whatever changes in between
    (split sizes, executors), and lineage ends here."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
