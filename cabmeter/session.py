"""Session helpers: a local session for tests and benches, and the
checkpoint directory every lineage cut uses."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, app: str = "cabmeter",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """A local session sized for tests and benches (never used on a cluster)."""
    parts = shuffle_partitions or (int(cpus) if str(cpus).isdigit() else 8)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    Uses the folder the cluster names (``SparkContext`` setting or the
    ``spark.checkpoint.dir`` conf).  Only a local-mode session without one
    (tests, benches) gets a fresh scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; configure a shared folder")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="cabmeter-ckpt-"))
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (never local).

    The frame is persisted first so the checkpoint write does not compute
    it a second time; the cache is dropped once the files exist.
    """
    checkpoint_dir(df.sparkSession)
    df = df.persist()
    try:
        return df.checkpoint(eager=True)
    finally:
        df.unpersist()


def write_through(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage by writing a Parquet table into the shared checkpoint
    folder (one job) and reading it back: later stages read columnar files,
    and a lost executor costs a file re-read, not a recomputation."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for written tables under the shared checkpoint folder."""
    base = checkpoint_dir(spark)
    return os.path.join(base, "tables", f"{name}-{os.urandom(6).hex()}")
