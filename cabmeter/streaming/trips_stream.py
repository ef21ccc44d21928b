"""Structured Streaming over the row-local operators.

The reference is batch only; what carries over to a stream is everything
row-local: deriving trips, the cleaning filter, the model frame, request
validation and scoring.  Each is the same DataFrame function applied to a
streaming DataFrame (no state, no watermark needed).  ``run_available``
drains the source once (``availableNow``) into a Parquet table with a
checkpoint in the shared folder, so a restarted job resumes exactly where it
stopped.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..operators import features as FT
from ..operators import model as M
from ..operators import rules as R
from ..sources.trips import requests_from_trips, trips_from_lineitem


def lineitem_stream(spark: SparkSession, source_dir: str, pattern: str = "lineitem.parquet",
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """New ``lineitem`` files in ``source_dir`` as a stream (schema taken
    from the files present now, as a file stream needs one up front).  A
    micro-batch takes all new files unless a number is given."""
    schema = spark.read.parquet(f"{source_dir.rstrip('/')}/{pattern}").schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(source_dir)


def clean_stream(trips: DataFrame) -> DataFrame:
    """Raw trip stream -> cleaned, leakage-safe model frame."""
    return FT.model_frame(R.clean_trips(trips))


def validate_stream(trips: DataFrame) -> DataFrame:
    """Raw trip stream -> validated scoring requests (violations as text)."""
    v = R.validate_requests(requests_from_trips(trips))
    return v.withColumn("violation_text", F.array_join("violations", "; ")).drop("violations")


def score_stream(model: PipelineModel, validated: DataFrame) -> DataFrame:
    """Validated request stream -> clamped predictions (the model's weekday
    convention is Sunday = 0)."""
    req = validated.withColumn(S.DOW, F.col("dow_sunday0"))
    return M.batch_score(model, req, features=S.OLS_FEATURES)


def run_available(stream: DataFrame, out_path: str, checkpoint: str) -> DataFrame:
    """Process everything available now into Parquet and return the table."""
    q = (stream.writeStream.format("parquet")
         .option("path", out_path)
         .option("checkpointLocation", checkpoint)
         .option("compression", "zstd")
         .outputMode("append")
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return stream.sparkSession.read.parquet(out_path)


def trips_stream(spark: SparkSession, source_dir: str,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    return trips_from_lineitem(
        lineitem_stream(spark, source_dir, max_files_per_trigger=max_files_per_trigger))
