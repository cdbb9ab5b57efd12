"""Reading the parquet tables of one input folder, and intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of ``sf_dir``, which may be any path that Spark's readers open."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@lru_cache
def _scratch() -> str:
    return tempfile.mkdtemp(prefix="spark-")


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which all executors share; without one, a folder of this machine in local mode only."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.conf.get("spark.master", "").split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return _scratch()


def cut(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read again: its lineage ends there, and a lost executor loses nothing."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.cut_path = path
    return out


def forget(*tables: DataFrame | None) -> None:
    """Delete tables that ``cut`` made; only once nothing reads them any more."""
    for df in tables:
        path = getattr(df, "cut_path", None)
        if path:
            jvm = df.sparkSession._jvm
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(place, True)
