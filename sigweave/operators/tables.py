"""Tables in the folder of spark.checkpoint.dir, which driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_RUN = f"sigweave/{uuid.uuid4().hex}"
_own: str | None = None


def _folder(spark: SparkSession) -> str:
    """That of spark.checkpoint.dir; a folder of this machine serves only where it is unset and the session is local."""
    global _own
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    if _own is None:
        _own = tempfile.mkdtemp(prefix="sigweave-")
        atexit.register(shutil.rmtree, _own, ignore_errors=True)
    return _own


def stored(df: DataFrame, tag: str) -> DataFrame:
    """df as a written table: it cuts lineage and survives the loss of executors."""
    spark = df.sparkSession
    path = f"{_folder(spark)}/{_RUN}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Deletes this process's tables of stored(); call it when results that read them have been stored elsewhere."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{_folder(spark)}/{_RUN}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
