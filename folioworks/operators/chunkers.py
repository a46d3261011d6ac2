"""Chunkers: one row for each chunk, (doc_id, chunk_no, chunk) and what is known about it."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioworks.functions import scalar
from folioworks.functions.text import MIN_CHARS, clean_content, clean_pages, context_header, oversize, page_header, token_count


def listed(make: Callable[..., list[str]]) -> Callable[..., Column]:
    """An Arrow function of columns to an array of strings; null gives an empty array."""

    @F.pandas_udf("array<string>")
    def run(*columns: pd.Series) -> pd.Series:
        return pd.Series([make(*row) if all(x is not None for x in row) else [] for row in zip(*columns, strict=True)], dtype=object)

    return run


def exploded(docs: DataFrame, chunks: Column, keys: Sequence[str]) -> DataFrame:
    return docs.select(*keys, chunks.alias("chunks")).select(*keys, F.posexplode("chunks").alias("chunk_no", "chunk"))


def one(f: Callable[[str], list[str]]) -> Callable[..., Column]:
    return listed(lambda text: f(text))


def fixed_chunks(docs: DataFrame, size: int = 512, overlap: int = 0, count: scalar.Count = scalar.quarter, keys: Sequence[str] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """Chunks of about size tokens that end at words."""
    if not 0 <= overlap < size:
        raise ValueError("overlap must be smaller than size")
    return exploded(docs, one(lambda t: scalar.fixed_chunks(t, size, overlap, count))(docs[text_col]), keys)


def recursive_chunks(docs: DataFrame, size: int = 512, overlap: int = 0, separators: Sequence[str] = scalar.SEPARATORS, keep: bool = True, count: scalar.Count = scalar.quarter, keys: Sequence[str] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """Chunks by ever finer separators."""
    return exploded(docs, one(lambda t: scalar.recursive_chunks(t, size, overlap, tuple(separators), keep, count))(docs[text_col]), keys)


def small_pieces(docs: DataFrame, keys: Sequence[str] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """The pieces of 50 tokens that the similarity-based and guided chunkers begin with."""
    return recursive_chunks(docs, 50, keys=keys, text_col=text_col)


def overlap_prefix(chunks: DataFrame, overlap: int, keys: Sequence[str] = ("doc_id",), count: scalar.Count = scalar.quarter) -> DataFrame:
    """Each chunk but the first of a document with the end of its predecessor (as it was) before it."""
    before = F.lag("chunk").over(Window.partitionBy(*keys).orderBy("chunk_no"))

    @F.pandas_udf("string")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for prev, chunk in batches:
            yield pd.Series([c if p is None else scalar.overlap_prefix(p, c, overlap, count) for p, c in zip(prev, chunk, strict=True)], dtype=object)

    if overlap <= 0:
        return chunks
    return chunks.withColumn("before", before).withColumn("chunk", run("before", "chunk")).drop("before")


def in_parts(whole: Column, is_whole: Column, parts: Column) -> Column:
    """array<struct<part, chunk>>: one without a number if is_whole, else the parts, numbered from 1."""
    alone = F.array(F.struct(F.lit(None).cast("int").alias("part"), whole.alias("chunk")))
    return F.when(is_whole, alone).otherwise(F.transform(parts, lambda c, i: F.struct((i + 1).cast("int").alias("part"), c.alias("chunk"))))


def section_chunks(sections: DataFrame, header: Column, most: int, paged: bool, keys: Sequence[str], count: scalar.Count = scalar.quarter) -> DataFrame:
    """Chunks of sections below their header: a section that fits is one chunk, others are packed by paragraphs with
    one repeated, and by sentences. Chunks shorter than 50 characters are dropped after numbering. Only the texts of
    sections that do not fit go to Python, and what comes before is worked out once."""
    clean = clean_pages if paged else clean_content
    pack = listed(lambda h, c: scalar.packed(h, c, most, True, paged, count))
    rows = sections.withColumn("header", header)
    rows = rows.withColumn("fits", token_count(F.col("header")) + token_count(F.col("content")) <= most)
    rows = rows.withColumn("parts", pack(F.when(~F.col("fits"), F.col("header")), F.when(~F.col("fits"), F.col("content"))))
    whole = clean(F.concat("header", F.lit("\n\n"), F.col("content")))
    rows = rows.withColumn("p", F.explode(in_parts(whole, F.col("fits"), F.col("parts"))))
    rows = rows.withColumns({"chunk": F.col("p.chunk"), "is_split": ~F.col("fits"), "chunk_part": F.col("p.part")})
    rows = rows.where(F.length("chunk") >= MIN_CHARS).drop("content", "header", "fits", "parts", "p")
    number = F.row_number().over(Window.partitionBy(*keys).orderBy("section_no", F.coalesce("chunk_part", F.lit(0)))) - 1
    return rows.withColumns({"chunk_no": number, "tokens": token_count(F.col("chunk"))})


def context_md_chunks(sections: DataFrame, most: int = 512, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Chunks of markdown sections that carry their titles."""
    return section_chunks(sections, context_header(F.col("title"), F.col("level"), F.col("parent")), most, False, keys)


def context_pdf_chunks(sections: DataFrame, most: int = 512, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Chunks of paged documents' sections that carry their titles."""
    return section_chunks(sections, page_header(F.col("title")), most, True, keys)


def split_oversized(chunks: DataFrame, header: Column, keys: Sequence[str] = ("doc_id",), most: int = 800) -> DataFrame:
    """Chunks over 800 tokens or 14,000 bytes in parts below the header (a column, so no text before it is lost).

    Others stay as they are. A chunk that is large by its bytes alone stays whole, as parts are counted in tokens.
    """
    rows = chunks.withColumn("header", header).withColumn("large", oversize(F.col("chunk")))
    body = F.when(F.startswith("chunk", F.col("header")), F.substring(F.col("chunk"), F.length("header") + 1, F.length("chunk"))).otherwise(F.col("chunk"))
    pack = listed(lambda h, c: scalar.packed(h, c, most, False, False))
    rows = rows.withColumn("parts", pack(F.when(F.col("large"), F.col("header")), F.when(F.col("large"), body)))
    rows = rows.withColumn("p", F.explode(in_parts(F.col("chunk"), ~F.col("large"), F.col("parts"))))
    rows = rows.withColumns({"chunk": F.col("p.chunk"), "sub_chunk_part": F.col("p.part"), "split_reason": F.when(F.col("large"), "size_exceeded")}).drop("header", "large", "parts", "p")
    if "tokens" in rows.columns:
        rows = rows.withColumn("tokens", token_count(F.col("chunk")))
    number = F.row_number().over(Window.partitionBy(*keys).orderBy("chunk_no", F.coalesce("sub_chunk_part", F.lit(0)))) - 1
    return rows.withColumn("chunk_no", number)


def register_all(spark: SparkSession) -> None:
    """The chunkers for SQL: scalar functions to arrays, and table functions for LATERAL."""
    spark.udf.register("recursive_chunks", listed(lambda t, n, o: scalar.recursive_chunks(t, int(n), int(o))))
    spark.udf.register("fixed_chunks", listed(lambda t, n, o: scalar.fixed_chunks(t, int(n), int(o))))

    schema = T.StructType().add("chunk_no", T.IntegerType()).add("chunk", T.StringType())

    class ChunkFixed:
        def eval(self, text: str, size: int):  # noqa: ANN201
            yield from enumerate(scalar.fixed_chunks(text or "", size))

    class ChunkRecursive:
        def eval(self, text: str, size: int):  # noqa: ANN201
            yield from enumerate(scalar.recursive_chunks(text or "", size))

    spark.udtf.register("chunk_fixed", F.udtf(ChunkFixed, returnType=schema))
    spark.udtf.register("chunk_recursive", F.udtf(ChunkRecursive, returnType=schema))
