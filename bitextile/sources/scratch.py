"""Results that are written once in the shared folder, to cut their lineage."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_drops = {}


def folder(spark: SparkSession, name: str) -> str:
    """A new path under spark.checkpoint.dir, removed when the driver ends.

    Without that setting a new folder of this machine is set, where the master is local (tests); on a cluster, whose
    machines would not see it, that is an error.
    """
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        top = tempfile.mkdtemp(prefix="bitextile-")
        spark.conf.set("spark.checkpoint.dir", top)
    path = f"{top.rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def drop() -> None:
        try:
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # noqa: BLE001  the session has ended before
            return

    atexit.register(drop)
    _drops[path] = drop
    return path


def release(df: DataFrame) -> None:
    """Delete the folder of a result of written() that nothing will read again."""
    if drop := _drops.pop(getattr(df, "written_to", ""), None):
        drop()
        atexit.unregister(drop)


def written(df: DataFrame, name: str) -> DataFrame:
    """df written to a new folder and read back."""
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out
