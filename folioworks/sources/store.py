"""Sinks: collections of records, reports and session logs."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioworks.functions.text import chunk_id, metadata_json, metadata_map
from folioworks.operators.search import vector_topk
from folioworks.operators.stats import batch_numbers, filter_chunks

from .scratch import written

META = ["title", "level", "parent", "tokens", "split_by_llm", "file", "chunk_part", "llm_decision", "sub_chunk_part", "split_reason", "page_start"]


def records(chunks: DataFrame, keys: Sequence[str] = ("doc_id", "chunk_no"), typed: bool = False) -> DataFrame:
    """id, document, embedding (if there) and metadata, as a map of strings or as JSON with its types."""
    fields = [c for c in META if c in chunks.columns]
    meta = metadata_json(fields) if typed else metadata_map(fields)
    vector = [F.col("embedding")] if "embedding" in chunks.columns else []
    return chunks.select(chunk_id(*[F.col(k) for k in keys]).alias("id"), F.col("chunk").alias("document"), *vector, meta.alias("metadata"))


def replace_collection(rows: DataFrame, name: str) -> None:
    """Write a collection anew: all of it or nothing."""
    rows.write.mode("overwrite").format("parquet").saveAsTable(name)


def append_collection(rows: DataFrame, name: str) -> None:
    rows.write.mode("append").format("parquet").saveAsTable(name)


def reset_collection(docs: DataFrame, name: str, size: int = 512, overlap: int = 50) -> DataFrame:
    """Chunk docs recursively, filter, replace the collection; returns its first record as a probe."""
    from folioworks.operators.chunkers import recursive_chunks

    replace_collection(records(filter_chunks(recursive_chunks(docs, size, overlap))), name)
    return docs.sparkSession.table(name).orderBy("id").limit(1)


def collection_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def create_vector_table(spark: SparkSession, name: str) -> None:
    """An empty table of records by cell (see add_cells), if there is none."""
    spark.sql(f"create table if not exists {name} (id string, content string, metadata string, embedding array<float>, cell int) using parquet partitioned by (cell)")


def add_cells(rows: DataFrame, cells: int = 100, sample: int = 20_000, seed: int = 7) -> tuple[DataFrame, list[list[float]]]:
    """cell of each record and the cells' centres, from k-means on a bounded sample: a search that reads only the
    partitions of the nearest cells is an approximate one; reading all is exact."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    with_vector = rows.withColumn("fw_vector", array_to_vector(F.col("embedding").cast("array<double>")))
    some = with_vector.orderBy(F.xxhash64("id")).limit(sample)
    model = KMeans(k=cells, seed=seed, featuresCol="fw_vector", predictionCol="cell").fit(some)
    return model.transform(with_vector).drop("fw_vector"), [c.tolist() for c in model.clusterCenters()]


def nearest_cells(centres: Sequence[Sequence[float]], query: Sequence[float], n: int) -> list[int]:
    order = sorted(range(len(centres)), key=lambda i: sum((a - b) ** 2 for a, b in zip(centres[i], query, strict=True)))
    return order[:n]


def insert_batches(rows: DataFrame, write: Callable[[list[dict]], None], size: int = 100) -> DataFrame:
    """Insert records in batches by ``write`` (a client of the store, on the executors): part, batch, n and error, null
    where the batch went in. A batch that fails is reported and skipped, the others go on."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            done = []
            for no, at in enumerate(range(0, len(pdf), size)):
                some = pdf.iloc[at : at + size]
                try:
                    write(some.to_dict("records"))
                    done.append((no, len(some), None))
                except Exception as e:
                    done.append((no, len(some), str(e)))
            yield pd.DataFrame(done, columns=["batch", "n", "error"])

    report = rows.mapInPandas(run, "batch int, n int, error string").select(F.spark_partition_id().alias("part"), "batch", "n", "error")
    return written(report, "insert-report")  # inserted once, whatever is done with the report


def insert_jdbc(rows: DataFrame, url: str, table: str, properties: dict[str, str] | None = None, size: int = 100) -> None:
    """Insert records by JDBC in batches; all or an error."""
    rows.write.mode("append").option("batchsize", size).jdbc(url, table, properties=properties or {})


def search_cells(table: DataFrame, centres: Sequence[Sequence[float]], query: Sequence[float], k: int, cells: int | None = None, metric: str = "cosine") -> DataFrame:
    """id, distance of the k nearest records to one query, from the partitions of the nearest cells alone (all: exact)."""
    some = nearest_cells(centres, query, len(centres) if cells is None else cells)
    return vector_topk(table.where(F.col("cell").isin(some)), list(query), k, metric, "id", "embedding")


def batched(rows: DataFrame, size: int = 100) -> DataFrame:
    return batch_numbers(rows, ["doc_id"], ["chunk_no"], size)


def report_block(number: Column) -> Column:
    """The part of a report on one chunk (title, level, parent, tokens, is_split, chunk_part, chunk)."""
    rule = lambda c: F.lit(c * 80 + "\n")
    parent = F.when(F.coalesce("parent", F.lit("")) != "", F.concat(F.lit("Parent Section: "), F.col("parent"), F.lit("\n"))).otherwise("")
    split = F.when(F.col("is_split"), F.concat(F.lit("Yes (Part "), F.coalesce("chunk_part", F.lit(1)).cast("string"), F.lit(")"))).otherwise("No")
    return F.concat(
        F.lit("\n"), rule("="), F.lit("CHUNK #"), number.cast("string"), F.lit("\n"), rule("="), F.lit("Title: "), F.col("title"), F.lit("\nLevel: H"), F.col("level").cast("string"), F.lit("\n"),
        parent, F.lit("Tokens: "), F.col("tokens").cast("string"), F.lit("\nSplit: "), split, F.lit("\n"), rule("-"), F.col("chunk"), F.lit("\n"), rule("-"),
    )


def chunk_report(chunks: DataFrame) -> DataFrame:
    """doc_id, chunk_no, block in order."""
    return chunks.select("doc_id", "chunk_no", report_block(F.col("chunk_no") + 1).alias("block"))


def write_report(chunks: DataFrame, path: str) -> None:
    """The blocks as text files, a folder for each document, in order."""
    blocks = chunk_report(chunks).repartition("doc_id").sortWithinPartitions("doc_id", "chunk_no")
    blocks.select("doc_id", "block").write.mode("overwrite").partitionBy("doc_id").text(path)


def plain_dump(chunks: DataFrame) -> DataFrame:
    """Numbered chunks, as text."""
    return chunks.select("doc_id", "chunk_no", F.concat(F.lit("--- Chunk "), (F.col("chunk_no") + 1).cast("string"), F.lit(" ---\n"), F.col("chunk"), F.lit("\n\n")).alias("block"))


def interactions(rows: DataFrame) -> DataFrame:
    """JSON of each interaction (timestamp, question, answer, retrieved: array of content and score)."""
    numbered = F.transform("retrieved", lambda r, i: F.struct((i + 1).alias("chunk_id"), r["content"].alias("content"), r["score"].alias("score")))
    return rows.select("*", F.to_json(F.struct("timestamp", "question", "answer", numbered.alias("retrieved_chunks"), F.size("retrieved").alias("num_chunks"))).alias("entry"))


def append_log(rows: DataFrame, path: str) -> None:
    interactions(rows).select(F.col("entry").alias("value")).write.mode("append").text(path)


def sessions(rows: DataFrame, by: str = "session") -> DataFrame:
    """session and its interactions in order of time."""
    return rows.groupBy(by).agg(F.array_sort(F.collect_list(F.struct("timestamp", "question", "answer"))).alias("interactions"))
