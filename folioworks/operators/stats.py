"""Statistics of chunks, positions, batches and histories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioworks.functions.text import keep_chunk, token_count


def chunk_stats(chunks: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Number of chunks, of split ones, and mean (rounded down), least and most tokens; nulls for no chunks."""
    tokens = token_count(F.col("chunk"))
    split = F.count_if("is_split") if "is_split" in chunks.columns else F.lit(0).cast("long")
    return chunks.groupBy(*by).agg(F.count("*").alias("n_chunks"), split.alias("n_split"), F.floor(F.sum(tokens) / F.count("*")).cast("long").alias("mean_tokens"), F.min(tokens).alias("min_tokens"), F.max(tokens).alias("max_tokens"))


def level_counts(chunks: DataFrame) -> DataFrame:
    return chunks.groupBy("level").agg(F.count("*").alias("n_chunks"))


def filter_stats(chunks: DataFrame, least: int = 50) -> DataFrame:
    kept = F.count_if(keep_chunk(F.col("chunk"), least))
    return chunks.agg(F.count("*").alias("original"), kept.alias("kept"), (F.count("*") - kept).alias("removed"))


def filter_chunks(chunks: DataFrame, least: int = 50) -> DataFrame:
    return chunks.where(keep_chunk(F.col("chunk"), least))


def numbered(rows: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "number") -> DataFrame:
    """Position from 1 within keys."""
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def batch_numbers(rows: DataFrame, keys: Sequence[str], order: Sequence[str], size: int = 100) -> DataFrame:
    """batch: number (from 0) of the batch of ``size`` rows within keys."""
    return numbered(rows, keys, order, "batch").withColumn("batch", F.floor((F.col("batch") - 1) / size).cast("long"))


def zipped(chunks: DataFrame, other: DataFrame, keys: Sequence[str] = ("doc_id", "chunk_no")) -> DataFrame:
    """Chunks with what belongs to them, by explicit keys instead of by position."""
    return chunks.join(other, list(keys))


def history(messages: DataFrame, n: int = 10, before: bool = True) -> DataFrame:
    """history: the last n messages of the conversation, before this one or with it."""
    frame = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(-n if before else 1 - n, -1 if before else 0)
    return messages.withColumn("history", F.collect_list(F.struct("role", "text")).over(frame))


def collection_counts(records: DataFrame, by: str = "collection") -> DataFrame:
    return records.groupBy(by).agg(F.count("*").alias("n_records"))
