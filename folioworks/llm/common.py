"""What the training-data operators share: scratch tables, input selection and Arrow batches."""

from __future__ import annotations

import gc
import time
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioworks.sources.scratch import shared_dir as scratch_dir

#: ASCII white space, as the operators' contracts give it.
WHITE_SPACE = r"[\x20\x09-\x0D]+"


def write_scratch(df: DataFrame, name: str) -> str:
    """Write df as Parquet in the shared folder, which cuts its lineage; returns the path."""
    path = f"{scratch_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return path


def through_scratch(df: DataFrame, name: str, made: list[str] | None = None) -> DataFrame:
    """df written in the shared folder and read again; made gets the path, for drop_scratch."""
    schema, path = df.schema, write_scratch(df, name)
    if made is not None:
        made.append(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def drop_scratch(spark: SparkSession, *paths: str) -> None:
    """Delete scratch tables that no later step reads."""
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of steps whose results are written; else they stay until the driver happens
    to collect its garbage. On a cluster listeners get a moment to let go of the last query first."""
    for _ in range(2):
        if not spark.sparkContext.master.startswith("local["):
            time.sleep(1)
        gc.collect()
        spark._jvm.System.gc()


def collect_garbage(spark: SparkSession) -> None:
    """Let the driver drop the plans and tasks of steps that are over, between steps that run many small tasks; else its heap
    grows to all it may have, beside the memory of its Python."""
    gc.collect()
    spark._jvm.System.gc()


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's estimate of the bytes that df gives; no job runs."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


#: Rows and bytes of an Arrow batch, and Spark's defaults. Rows are whole documents or blocks here, and as many as by
#: default are a lot of memory beside the heap; a session that has chosen other numbers keeps them.
BATCHES = {"maxRecordsPerBatch": ("10000", "1024"), "maxBytesPerBatch": ("67108864b", "8m")}


def modest_batches(spark: SparkSession) -> None:
    for name, (default, chosen) in BATCHES.items():
        if spark.conf.get(f"spark.sql.execution.arrow.{name}", None) == default:
            spark.conf.set(f"spark.sql.execution.arrow.{name}", chosen)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: A side of a join is sent to all executors if it has at most so many bytes by a check of its rows.
SMALL_SIDE = 64 << 20


def checked_side(side: DataFrame, n_bytes: Column) -> DataFrame:
    """side, which is written, marked for a broadcast if its rows have at most SMALL_SIDE bytes; beyond that for a
    shuffled join, which moves the other side too."""
    total = side.agg(F.sum(n_bytes.cast("long"))).first()[0] or 0
    return F.broadcast(side) if total <= SMALL_SIDE else side.hint("shuffle_hash")


def as_one(docs: DataFrame, id_col: str) -> DataFrame:
    """(doc, doc_id): each row of docs as a struct, so that no name of docs can clash with others'."""
    return docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("doc"), docs[id_col].cast("long").alias("doc_id"))


def text_or_empty(docs: DataFrame, text_col: str = "text") -> Column:
    return F.coalesce(docs[text_col].cast("string"), F.lit(""))


def doc_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only (doc_id, text): null texts are empty, other columns cannot clash."""
    modest_batches(docs.sparkSession)
    return docs.select(docs[id_col].cast("long").alias("doc_id"), text_or_empty(docs, text_col).alias("text"))


def partitions_for(spark: SparkSession, n_bytes: float, target: float = 32e6) -> int:
    """Enough partitions that one of them takes about ``target`` bytes."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(n_bytes / target) + 1)


def text_batches(batches: Iterable[pa.RecordBatch], max_bytes: int, id_name: str = "doc_id") -> Iterator[tuple[list, list[bytes]]]:
    """Regroup Arrow batches of (id, text) into lists of ids and UTF-8 texts of about max_bytes; a longer text stands alone."""
    ids: list = []
    texts: list[bytes] = []
    held = 0
    for batch in batches:
        raw = batch.column("text").cast(pa.binary())
        for doc_id, text in zip(batch.column(id_name).to_pylist(), raw, strict=True):
            t = text.as_py()
            if ids and held + len(t) > max_bytes:
                yield ids, texts
                ids, texts, held = [], [], 0
            ids.append(doc_id)
            texts.append(t)
            held += len(t)
    if ids:
        yield ids, texts


def crc_mod(column: str, mod: int) -> Column:
    """crc32 of the id as text, modulo mod; a null id counts as the text 'null'."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("null")).cast("binary")) % mod
