"""Session-level helpers that never change how queries compute."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_base(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of
    the session, else the context's checkpoint folder, else the session's
    warehouse folder. No setting is changed and no local folder is made up."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_logsift"
    return base.rstrip("/")


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder name in the application's part of the shared folder,
    which is removed when the application ends."""
    own = f"{shared_base(spark)}/logsift-{spark.sparkContext.applicationId}"
    fs, path = _file_system(spark, own)
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return f"{own}/{name}-{uuid.uuid4().hex}"


def persist(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: cuts the
    lineage, survives lost executors and is computed once. Runs a job."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Delete the folder behind a frame made by ``persist`` once nothing reads it."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        fs, path = _file_system(df.sparkSession, folder)
        fs.delete(path, True)


def input_state(spark: SparkSession, *paths: str) -> tuple:
    """Name, length and modification time of every file under ``paths``: equal
    states mean that the files were not changed."""
    out = []
    for given in paths:
        fs, path = _file_system(spark, given)
        files = fs.listFiles(path, True)
        while files.hasNext():
            f = files.next()
            out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(out))
