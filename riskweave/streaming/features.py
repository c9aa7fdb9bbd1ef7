"""The processing stage (clean + row-level risk features) on a stream.

The reference is batch-only. Its processing stage, though, is a pure per-row
projection, so the very same operators (``clean_fact`` then
``add_risk_features``) run unchanged on a Structured Streaming source of raw
fact files: new files are featurised incrementally into a Parquet sink, with
progress kept in the session's shared checkpoint folder. No state store is
needed because nothing is aggregated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.clean import clean_fact
from ..operators.features import add_risk_features
from ..session import checkpoint_dir
from ..sources.fact import FACT_SCHEMA


def raw_fact_stream(spark: SparkSession, source_dir: str, fmt: str = "csv",
                    schema: StructType = FACT_SCHEMA, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming scan of raw fact files (CSV with header, or Parquet)."""
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("mode", "PERMISSIVE")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(source_dir)


def processed_fact_stream(raw: DataFrame) -> DataFrame:
    """Same operators as the batch processed fact."""
    return add_risk_features(clean_fact(raw))


def start_feature_stream(spark: SparkSession, source_dir: str, sink_dir: str, name: str = "features",
                         fmt: str = "csv", available_now: bool = True,
                         checkpoint_location: str | None = None) -> StreamingQuery:
    """Start the incremental processing stage; append-only Parquet sink."""
    location = checkpoint_location or f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}"
    writer = (processed_fact_stream(raw_fact_stream(spark, source_dir, fmt))
              .writeStream.format("parquet").outputMode("append")
              .option("path", sink_dir).option("checkpointLocation", location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
