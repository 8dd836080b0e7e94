"""Apply a fitted feature pipeline and model to a batch or streaming frame."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tabreg.operators.models import predict


def score(df: DataFrame, pipeline, model, pred: str = "prediction") -> DataFrame:
    """Features then prediction; works for ``df.isStreaming`` as well."""
    return predict(model, pipeline.transform(df, assemble_vector=True), pred)


def score_stream_to_table(stream: DataFrame, pipeline, model, path: str, checkpoint: str,
                          pred: str = "prediction", available_now: bool = True):
    """Score a stream into parquet files; the checkpoint folder must be shared
    storage on a cluster (it records progress for exactly-once output)."""
    scored = score(stream, pipeline, model, pred)
    writer = scored.writeStream.format("parquet").option("path", path) \
        .option("checkpointLocation", checkpoint).outputMode("append")
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
