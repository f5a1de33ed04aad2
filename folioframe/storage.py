"""Tables kept in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: list[str] = []
_hooked: list[bool] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; one of our own only where it is unset and all run on one machine."""
    path = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not path and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    if not path:
        path = tempfile.mkdtemp(prefix="folioframe-")
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def scratch(spark: SparkSession, kind: str) -> str:
    """A new folder's name in the shared folder; what is written there is removed when the driver's process ends."""
    path = f"{shared_dir(spark)}/{kind}-{uuid.uuid4().hex}"
    if not _hooked:
        atexit.register(_remove, spark)
        _hooked.append(True)
    _written.append(path)
    return path


def stored(df: DataFrame) -> DataFrame:
    """Writes df as Parquet to the shared folder and reads it again: cuts the lineage, survives lost executors.

    The files are removed when the driver's process ends.
    """
    spark = df.sparkSession
    path = scratch(spark, "table")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Removes the files of a table that stored() returned, once nothing will read it again."""
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        name = path.rsplit("/", 1)[1]
        mine = [p for p in _written if p.rsplit("/", 1)[1] == name]
        for p in mine:
            _delete(df.sparkSession, p)
            _written.remove(p)


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _remove(spark: SparkSession) -> None:
    try:
        for path in _written:
            _delete(spark, path)
    except Exception:  # noqa: BLE001  the session may be gone at exit; the cluster's own cleaner takes the rest
        pass
