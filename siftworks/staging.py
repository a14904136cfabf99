"""Intermediate tables in the folder that driver and executors share.

A staged table cuts lineage and survives the loss of executors, because its files live in
``spark.checkpoint.dir`` rather than on any executor's disk.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own_dirs: dict[str, str] = {}
_to_delete: dict[str, SparkSession] = {}


def shared_dir(spark: SparkSession) -> str:
    """This application's folder in ``spark.checkpoint.dir``; where that is unset, a temporary one, in local mode only."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    app = spark.sparkContext.applicationId
    if not where:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if app not in _own_dirs:
            _own_dirs[app] = tempfile.mkdtemp(prefix="siftworks-")
        where = _own_dirs[app]
    folder = f"{where.rstrip('/')}/siftworks-{app}"
    if folder not in _to_delete:
        if not _to_delete:
            atexit.register(_clean)
        _to_delete[folder] = spark
    return folder


def _clean() -> None:
    """Removes what this application staged; a killed driver leaves it for the folder's own retention."""
    for folder, spark in _to_delete.items():
        try:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        except Exception:  # noqa: BLE001  the JVM may be gone already
            pass


def stage(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` as Parquet into the shared folder and reads it back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(*frames: DataFrame) -> None:
    """Deletes tables that ``stage`` returned and nothing reads any more, and lets Spark remove shuffle files no longer in use.

    Spark removes these when the driver collects garbage, which a large heap puts off while disks fill.
    """
    jvm, conf = frames[0].sparkSession._jvm, frames[0].sparkSession._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for df in frames for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)
    jvm.System.gc()
