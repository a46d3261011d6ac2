"""Streams of documents through the chunkers that need one document alone (an extension: same functions, as a stream)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def document_stream(spark: SparkSession, path: str, schema: str = "doc_id long, text string") -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def chunk_stream(docs: DataFrame, chunker: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> StreamingQuery:
    """Append the chunks of documents as they come in; each file is taken in exactly once."""
    return chunker(docs).writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
