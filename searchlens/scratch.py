"""Tables that are written once and read several times, in the folder that driver and executors share.

A lost executor then costs a new read of the table, not a new run of the plan behind it.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_paths: list[tuple[SparkSession, str]] = []
_local: dict[str, str] = {}   # the folders of local sessions, by application


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session. Where it is unset, a local session gets a fresh folder; a cluster must name one."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir is not set; name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local:
        _local[app] = "file://" + tempfile.mkdtemp(prefix="searchlens-")
    return _local[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder, deleted when the driver's Python ends."""
    path = f"{shared_dir(spark)}/searchlens/{uuid.uuid4().hex}/{name}"
    if not _paths:
        atexit.register(_drop)
    _paths.append((spark, path))
    return path


def _drop() -> None:
    for spark, path in _paths:
        try:
            where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path.rpartition("/")[0])
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
        except Exception:  # the session is gone already; the folder is left to its owner
            return


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
