"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


_made: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a session without one has its warehouse, which driver and executors share too."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/loomgraph-stages"
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, noted so that ``release`` can remove it."""
    _made.append(f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}")
    return _made[-1]


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and return a reader of it.

    Cuts the lineage: a lost executor makes later stages read the files again
    instead of running the earlier ones.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def mark() -> int:
    """How many paths have been given out; those after it belong to what follows."""
    return len(_made)


def release(spark: SparkSession, since: int, keep: int = 0) -> None:
    """Removes the tables given out after ``since`` but the last ``keep``; nothing may still read them."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for at in _made[since : len(_made) - keep]:
        path = jvm.org.apache.hadoop.fs.Path(at)
        path.getFileSystem(conf).delete(path, True)
    del _made[since : len(_made) - keep]


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
