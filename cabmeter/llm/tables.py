"""Written tables in the cluster's shared folder, and partition counts."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from cabmeter.session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a Parquet table in the shared folder: cuts the lineage, so
    a lost executor costs a file read."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def drop_written(*frames: DataFrame) -> None:
    """Delete written tables that nothing reads any more."""
    for df in frames:
        path = getattr(df, "_written_at", None)
        if path:
            jvm, jsc = df.sparkSession._jvm, df.sparkSession._jsc
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def arrow_rows(spark: SparkSession, most: int) -> Iterator[None]:
    """Tables written inside send Python workers at most so many rows at
    once: a batch of texts is held by the JVM and by the worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(int(before), most) if int(before) > 0 else most))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def partitions(df: DataFrame, bytes_each: int = 64 << 20) -> int:
    """Shuffle partitions for a pass over ``df``: the session's number, or
    more when the input's size asks for it."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if size >= 1 << 55:  # Spark has no idea: nobody has a table of 36 PB
        return least
    return max(least, -(-size // bytes_each))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
