"""Stage tables in the folder that driver and executors share."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a session without one has its warehouse, which driver and executors share too."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/loomgraph-stages"
    return folder.rstrip("/")


@contextlib.contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """What is written inside removes its shuffle files as soon as it is written; the session gets its own setting back."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write once as Parquet in the shared folder and read back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    with tidy(spark):
        df.write.option("compression", "zstd").parquet(path)
    return _noted(spark.read.schema(df.schema).parquet(path), path)


def bucketed(df: DataFrame, name: str, column: str, buckets: int) -> DataFrame:
    """``materialise`` in buckets of a column by which ``df`` is dealt out already: what groups or joins by it later exchanges nothing."""
    spark = df.sparkSession
    table = f"loomgraph_{name}_{uuid.uuid4().hex}"
    path = f"{shared_folder(spark)}/{table}"
    with tidy(spark):
        df.write.option("path", path).option("compression", "zstd").bucketBy(buckets, column).saveAsTable(table)
    held = spark.table(table)
    spark.sql(f"DROP TABLE {table}")  # only its name: the files stay in the shared folder, and the plan has them
    return _noted(held, path)


def _noted(df: DataFrame, path: str) -> DataFrame:
    df.loomgraph_path = path
    return df


def release(*tables: DataFrame) -> None:
    """Removes stage tables that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df.loomgraph_path)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def pieces(df: DataFrame, rows: int) -> int:
    """Into how many parts of about ``rows`` rows ``df`` goes; no fewer than a shuffle has."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // rows))


def spread(df: DataFrame, rows: int, *columns: str) -> DataFrame:
    """``df`` dealt out in parts of about ``rows`` rows: a small file that much is made of is read by few tasks."""
    return df.repartition(pieces(df, rows), *columns)
