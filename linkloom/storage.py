"""Tables in the folder that a cluster's executors share: they cut lineage and survive lost executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names. Only a local session without one (as in tests) gets one here."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="linkloom-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Writes df to the shared folder and reads it again."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/linkloom/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    found = spark.read.schema(df.schema).parquet(path)
    found._written_to = path
    return found


def discard(*tables: DataFrame) -> None:
    """Deletes what materialize() wrote. For tables that nothing reads any more, neither results that are still to be worked out."""
    for df in tables:
        path = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(df._written_to)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
