"""Questions and answers between blocks of documents and partitions of keys.

A block (some MB of documents) asks about its distinct keys, packed into one binary row for each key partition. A key
partition works on all rows it gets and gives each block a packed answer. A very common key arrives at most once from
each block, so no key makes a partition large, and few rows carry much data. Blocks lie in a bucketed table, so that
answers come to the blocks and the texts never move again.

Rows are blocks times key partitions. So that this product stays small beside the data, blocks grow with the input
from a least size up to ``MOST_BYTES`` (about 20,000 blocks up to a TB, 1.6 million at 100 TB) and there are at most
``MOST_PARTS`` key partitions, which then grow themselves; at 100 TB a row still carries some hundred bytes, and an
executor core should have 4 GB.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import doc_texts, drop_scratch, partitions_for, plan_bytes, scratch_dir, text_batches, write_scratch

#: Homes a task deals its blocks to: so many files it writes.
HOMES = 4
BLOCKS, MOST_BYTES, MOST_PARTS = 20_000, 64 << 20, 1 << 15
#: Arrow batches of questions have at most so many rows and about so many bytes.
BATCH_ROWS, BATCH_BYTES = 512, 4 << 20

ASKED = "kind int, part int, home long, seq int, keys binary, more binary"
ASKED_TYPES = (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
#: Home -1 has statistics and home -2 tables of the key partitions; all others are homes of blocks.
ANSWER = "kind int, home long, seq int, part int, data binary"
STATISTICS, TABLES = -1, -2

#: What a key partition gives: an answer to each row, its part of corpus-wide statistics, and a table to keep.
Worked = tuple[list[bytes], bytes | None, bytes | None]


def block_bytes(docs: DataFrame, least: int) -> int:
    return int(min(MOST_BYTES, max(least, plan_bytes(docs) / BLOCKS)))


def parts_for(spark: SparkSession, n_bytes: float) -> int:
    return min(MOST_PARTS, partitions_for(spark, n_bytes))


class BlockTable:
    """Blocks in the shared folder, bucketed by home, and the answers they got; leaving it drops them all."""

    def __init__(self, rows: DataFrame, buckets: int, name: str) -> None:
        self.spark = rows.sparkSession
        self.name = f"fw_{name}_{uuid.uuid4().hex}"
        self.path = f"{scratch_dir(self.spark)}/{self.name}"
        self.answers: list[str] = []
        rows.write.format("parquet").option("compression", "zstd").bucketBy(buckets, "home").option("path", self.path).saveAsTable(self.name)

    def __enter__(self) -> BlockTable:
        return self

    def __exit__(self, *_: object) -> None:
        self.spark.sql(f"drop table if exists {self.name}")
        drop_scratch(self.spark, self.path, *self.answers)

    def frame(self) -> DataFrame:
        return self.spark.table(self.name)

    def answered(self, asked: DataFrame, work: Callable[[int, list[bytes], list[bytes]], Worked], name: str) -> str:
        """Let each key partition work on its rows: lists of keys and more. Returns the path of the answers."""
        self.answers.append(answered(asked, work, name))
        return self.answers[-1]

    def with_answers(self, *paths: str) -> DataFrame:
        """The blocks with all answers of their home in these paths, as an array of structs."""
        if not paths:
            return self.frame().withColumn("answers", F.expr("cast(array() as array<struct<kind int, seq int, part int, data binary>>)"))
        answers = self.spark.read.schema(ANSWER).parquet(*paths).where("home >= 0")
        by_home = answers.groupBy("home").agg(F.collect_list(F.struct("kind", "seq", "part", "data")).alias("answers"))
        return self.frame().join(by_home.hint("shuffle_hash"), "home", "left")


def buckets_for(docs: DataFrame) -> int:
    """A bucket for each partition of the input, as far as Spark allows."""
    conf = docs.sparkSession.conf
    return min(max(int(conf.get("spark.sql.shuffle.partitions")), docs.rdd.getNumPartitions()), int(conf.get("spark.sql.sources.bucketing.maxBuckets")))


def text_blocks(docs: DataFrame, id_col: str, text_col: str, least: int) -> BlockTable:
    texts = doc_texts(docs, id_col, text_col).select(F.spark_partition_id().cast("long").alias("task"), "doc_id", "text")
    most = block_bytes(docs, least)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (home, seq, ids, sizes, text) from (task, doc_id, text)."""
        task = 0

        def noted() -> Iterator[pa.RecordBatch]:
            nonlocal task
            for b in batches:
                if b.num_rows:
                    task = b.column("task")[0].as_py()
                yield b

        for seq, (ids, texts) in enumerate(text_batches(noted(), most)):
            row = [[task * HOMES + seq % HOMES], [seq], [ids], [[len(t) for t in texts]], [b"".join(texts)]]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, (pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()), strict=True)], ["home", "seq", "ids", "sizes", "text"])

    return BlockTable(texts.mapInArrow(blocks, "home long, seq int, ids array<long>, sizes array<long>, text binary"), buckets_for(docs), "texts")


def parts_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """Part of each key; parts are ranges, so keys in order are in order of part."""
    return ((keys >> np.uint64(40)) * np.uint64(parts) >> np.uint64(24)).astype(np.int64)


def question(kind: int, keys: np.ndarray, more: Callable[[slice], bytes], home: int, seq: int, parts: int) -> Iterator[tuple]:
    """Rows of ASKED from keys in order; more gives extra data of a range of keys."""
    cuts = np.searchsorted(parts_of(keys, parts), np.arange(parts + 1))
    for p in np.flatnonzero(np.diff(cuts)):
        some = slice(int(cuts[p]), int(cuts[p + 1]))
        yield kind, int(p), home, seq, keys[some].tobytes(), more(some)


def answers_for(row_answers: list[dict] | None, kind: int, seq: int) -> list[bytes]:
    """The answers of a kind to a block, in order of part."""
    mine = [(a["part"], a["data"]) for a in row_answers or [] if a["kind"] == kind and a["seq"] == seq]
    return [d for _, d in sorted(mine)]


def answer_rows(pdf: pd.DataFrame, data: list[bytes], stats: bytes | None, table: bytes | None) -> pd.DataFrame:
    kind, part = int(pdf.kind.iloc[0]), int(pdf.part.iloc[0])
    out = [pd.DataFrame({"kind": kind, "home": pdf.home, "seq": pdf.seq, "part": part, "data": data})]
    out += [pd.DataFrame({"kind": [kind], "home": [home], "seq": [-1], "part": [part], "data": [x]}) for home, x in ((STATISTICS, stats), (TABLES, table)) if x is not None]
    return pd.concat(out)


def answered(asked: DataFrame, work: Callable[[int, list[bytes], list[bytes]], Worked], name: str) -> str:
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["home", "seq"])
        return answer_rows(pdf, *work(int(pdf.kind.iloc[0]), pdf["keys"].tolist(), pdf["more"].tolist()))

    return write_scratch(asked.groupBy("kind", "part").applyInPandas(run, ANSWER), name)


def statistics(spark: SparkSession, path: str, kind: int) -> list[bytes]:
    """The statistics of each key partition: one small row from each."""
    rows = spark.read.schema(ANSWER).parquet(path).where((F.col("home") == STATISTICS) & (F.col("kind") == kind))
    return [bytes(r.data) for r in rows.orderBy("part").select("data").collect()]


def asked_by(blocks: DataFrame, ask: Callable[[dict], Iterator[tuple]]) -> DataFrame:
    """Rows of ASKED that each block gives, many to a batch."""

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), ASKED_TYPES, strict=True)], ["kind", "part", "home", "seq", "keys", "more"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows: list[tuple] = []
                held = 0
                for row in ask(batch.slice(i, 1).to_pylist()[0]):
                    rows.append(row)
                    held += len(row[4]) + len(row[5])
                    if len(rows) == BATCH_ROWS or held >= BATCH_BYTES:
                        yield batch_of(rows)
                        rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    return blocks.mapInArrow(run, ASKED)
