"""Sinks: ZSTD Parquet writes with read-back, model save/load.

Writes go to a caller-given path (on a cluster: a shared folder); the
returned DataFrame reads the files back, so a later stage never recomputes
the lineage that produced them.
"""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import schema as S


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None,
                  mode: str = "overwrite") -> DataFrame:
    w = df.write.mode(mode).option("compression", "zstd")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return df.sparkSession.read.parquet(path)


def write_cleaned(cleaned: DataFrame, path: str) -> DataFrame:
    """Write the cleaned model frame and read it back in declared order."""
    back = write_parquet(cleaned, path)
    return back.select(*cleaned.columns)


def clean_and_write(trips: DataFrame, path: str, rules=None):
    """Clean, project and write in ONE pass while counting every rule on the
    input rows with an ``Observation`` (metrics ride along with the write
    job; only a handful of counts reach the driver).  Returns the read-back
    table and the observed counts as a dict."""
    from pyspark.sql import Observation

    from ..operators.features import model_frame
    from ..operators.rules import clean_trips, default_rules, removal_condition

    rules = rules or default_rules()
    obs = Observation("cleaning_rules")
    observed = trips.observe(
        obs, F.count(F.lit(1)).alias("original_rows"),
        F.count_if(removal_condition(rules)).alias("removed_rows"),
        *[F.count_if(r.condition()).alias(f"rule_{r.rule_id}") for r in rules])
    back = write_cleaned(model_frame(clean_trips(observed, rules)), path)
    return back, obs.get


def _move(spark, source: str, target: str | None) -> None:
    """Rename a folder, in place of what the target held; without a target
    delete it."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(source).getFileSystem(spark._jsc.hadoopConfiguration())
    if target is None:
        fs.delete(path(source), True)
        return
    fs.mkdirs(path(target).getParent())
    fs.delete(path(target), True)
    if not fs.rename(path(source), path(target)):
        raise OSError(f"cannot rename {source} to {target}")


def write_splits(split_df: DataFrame, path: str, split: str = "split",
                 strict: bool = True, expected: Mapping[str, int] | None = None) -> DataFrame:
    """Publish the splits as one: a folder for each (``split=train`` ...), so
    that reading a single split later prunes the others.

    Everything is written to a folder beside ``path`` first, while the rows of
    each split and those in none are counted in the same pass.  Only if the
    counts are right is the folder renamed to ``path``; otherwise it is
    removed, ``path`` keeps what it held, and ``ValueError`` is raised:

    * rows in no split (``strict=False`` leaves them out instead),
    * splits with other row counts than ``expected`` (split name to rows).
    """
    spark = split_df.sparkSession
    names = [F.col(split) == name for name in expected or {}]
    seen = Observation()
    counted = split_df.observe(seen, F.count_if(F.col(split).isNull()).alias("lost"),
                               *[F.count_if(n).alias(f"n{i}") for i, n in enumerate(names)])
    staged = f"{path.rstrip('/')}-staged-{os.urandom(6).hex()}"
    try:
        write_parquet(counted.where(F.col(split).isNotNull()), staged, [split])
        counts = seen.get
        wrong = {n: (want, counts[f"n{i}"]) for i, (n, want) in enumerate((expected or {}).items()) if counts[f"n{i}"] != want}
        if strict and counts["lost"]:
            raise ValueError(f"{counts['lost']} rows are in no split")
        if wrong:
            raise ValueError(f"rows of splits (expected, written): {wrong}")
        _move(spark, staged, path)
    except BaseException:
        _move(spark, staged, None)
        raise
    return spark.read.schema(split_df.schema).parquet(path).select(*split_df.columns)


def read_split(spark, path: str, name: str) -> DataFrame:
    return spark.read.parquet(path).where(F.col("split") == name)


def write_scored(scored: DataFrame, path: str, label: str = S.DURATION,
                 prediction: str = "prediction") -> DataFrame:
    """Persist label, prediction, distance and hour of every scored row."""
    cols = [F.col(label).alias("y_true"), F.col(prediction).alias("y_pred"),
            F.col(S.DISTANCE), F.col(S.HOUR)]
    return write_parquet(scored.select(*cols), path)


def model_round_trip(model: PipelineModel, path: str) -> PipelineModel:
    model.write().overwrite().save(path)
    return PipelineModel.load(path)


def save_model(model: PipelineModel, path: str, features: Sequence[str], spark: SparkSession) -> None:
    """A fitted pipeline with the order of its features beside it."""
    model.write().overwrite().save(f"{path}/model")
    listed = spark.createDataFrame(list(enumerate(features)), "position INT, feature STRING")
    listed.coalesce(1).write.mode("overwrite").parquet(f"{path}/features")


def load_model(spark: SparkSession, path: str, features: Sequence[str] | None = None) -> tuple[PipelineModel, list[str]]:
    """A saved pipeline and its features, in their order.  If ``features`` are
    given and are others or in another order, ``ValueError`` is raised."""
    stored = [r.feature for r in spark.read.parquet(f"{path}/features").orderBy("position").collect()]
    if features is not None and list(features) != stored:
        raise ValueError(f"the model at {path} was fitted on {stored}, not on {list(features)}")
    return PipelineModel.load(f"{path}/model"), stored
