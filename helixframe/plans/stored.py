"""Tables that cut the lineage of long jobs, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The session's shared folder. In local mode, where driver and executors are one process, a temporary one will do."""
    context = spark.sparkContext
    at = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not at:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("spark.checkpoint.dir names no folder that driver and executors share")
        at = tempfile.mkdtemp(prefix="spark-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(at)
    return at.rstrip("/")


def stored(df: DataFrame) -> DataFrame:
    """df, checkpointed: its partitions stay as they are."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


#: Of rows of many bytes few are written, and read, at a time.
HEAVY = {"parquet.block.size": 16 << 20, "parquet.block.size.row.check.min": 1, "parquet.page.size.row.check.min": 1}


def written(df: DataFrame, name: str, heavy: bool = False) -> DataFrame:
    """df, written as Parquet and read back: later scans read the columns they need. heavy: rows may have many bytes."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.options(**HEAVY if heavy else {}).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Deletes the folders of tables that written made."""
    for df in tables:
        spark = df.sparkSession
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            at = spark._jvm.org.apache.hadoop.fs.Path(folder)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
