"""Chunkers by the similarity of neighbouring pieces.

Windows give contexts, distances and groups; the threshold is an aggregate over a document's distances. Only the
segmentation, where each step needs the one before it, is grouped Python, of one document at a time.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioworks.functions import scalar
from folioworks.functions.models import Embedder, embed
from folioworks.functions.text import token_count
from folioworks.sources.scratch import written

from .chunkers import overlap_prefix, small_pieces


def sorted_by(keys: Sequence[str], order: str = "chunk_no") -> Window:
    return Window.partitionBy(*keys).orderBy(order)


def with_context(pieces: DataFrame, before_after: int = 3, keys: Sequence[str] = ("doc_id",), text_col: str = "chunk") -> DataFrame:
    """combined: each piece with its neighbours, joined by spaces."""
    frame = sorted_by(keys).rowsBetween(-before_after, before_after)
    return pieces.withColumn("combined", F.array_join(F.collect_list(text_col).over(frame), " "))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    n = F.sqrt(dot(a, a))
    return F.when(n == 0, F.lit(1.0)).otherwise(n)


def neighbour_distance(rows: DataFrame, keys: Sequence[str], order: str, vector_col: str = "embedding") -> DataFrame:
    """distance: 1 - cosine to the next row; null at the last. A zero vector is at distance 1."""
    rows = rows.withColumn("next_vector", F.lead(vector_col).over(sorted_by(keys, order)))
    similarity = dot(F.col(vector_col), F.col("next_vector")) / (norm(F.col(vector_col)) * norm(F.col("next_vector")))
    return rows.withColumn("distance", F.when(F.col("next_vector").isNotNull(), 1 - similarity)).drop("next_vector")


def bisected(distances: Column, cuts: Column) -> Column:
    """Threshold by twenty bisections of [0, 1] for about as many larger distances as cuts: the last middle tried."""
    start = F.struct(F.lit(0.0).alias("lo"), F.lit(1.0).alias("hi"), F.lit(0.5).alias("t"))

    def step(acc: Column, _: Column) -> Column:
        middle = (acc["lo"] + acc["hi"]) / 2
        many = F.size(F.filter(distances, lambda d: d > middle)) > cuts
        return F.struct(F.when(many, middle).otherwise(acc["lo"]).alias("lo"), F.when(many, acc["hi"]).otherwise(middle).alias("hi"), middle.alias("t"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(20)), start, step)["t"]


def thresholds(rows: DataFrame, keys: Sequence[str], average: int, tokens: Column) -> DataFrame:
    """keys, cuts and threshold of each document of rows (distance)."""
    sums = rows.groupBy(*keys).agg(F.sum(tokens).alias("tokens"), F.collect_list("distance").alias("distances"))
    cuts = F.greatest(F.lit(1), F.floor(F.col("tokens") / average)).cast("long")
    return sums.withColumn("cuts", cuts).select(*keys, "cuts", bisected(F.col("distances"), F.col("cuts")).alias("threshold"))


def regrouped(rows: DataFrame, keys: Sequence[str], order: str, cut: Column, text_col: str = "chunk") -> DataFrame:
    """Chunks of rows in order; a new one begins after each row where cut holds."""
    before = F.coalesce(F.lag(cut.cast("int")).over(sorted_by(keys, order)), F.lit(0))
    marked = rows.withColumn("starts", before)
    grouped = marked.withColumn("group", F.sum("starts").over(sorted_by(keys, order).rowsBetween(Window.unboundedPreceding, 0)))
    parts = F.array_sort(F.collect_list(F.struct(F.col(order).alias("at"), F.col(text_col).alias("text"))))
    return grouped.groupBy(*keys, F.col("group").cast("int").alias("chunk_no")).agg(F.array_join(F.transform(parts, lambda p: p["text"]), " ").alias("chunk"))


def breakpoint_chunks(docs: DataFrame, average: int = 400, least: int = 50, overlap: int = 0, before_after: int = 3, embedder: Embedder | None = None, keys: Sequence[str] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """Chunks cut where neighbouring contexts are far apart, about one for each ``average`` tokens."""
    from .chunkers import recursive_chunks

    pieces = with_context(recursive_chunks(docs, least, keys=keys, text_col=text_col), before_after, keys)
    rows = pieces.withColumn("vector", embed(F.col("combined"), embedder)).select("*", F.col("vector.embedding").alias("embedding")).drop("vector", "combined")
    far = written(neighbour_distance(rows, keys, "chunk_no").drop("embedding"), "distances")  # embedded once
    limits = thresholds(far, keys, average, token_count(F.col("chunk")))
    cut = F.coalesce(F.col("distance") > F.col("threshold"), F.lit(False))
    return overlap_prefix(regrouped(far.join(limits, list(keys)), keys, "chunk_no", cut), overlap, keys)


def band_similarity(rows: DataFrame, keys: Sequence[str], order: str, width: int, vector_col: str = "embedding") -> DataFrame:
    """keys, i, j, similarity of rows less than ``width`` places apart: a join on the place, not of all pairs."""
    placed = rows.select(*keys, (F.row_number().over(sorted_by(keys, order)) - 1).alias("i"), F.col(vector_col).alias("a"))
    ahead = placed.withColumn("j", F.explode(F.sequence(F.col("i") + 1, F.col("i") + width - 1))) if width > 1 else placed.withColumn("j", F.lit(-1))
    other = placed.select(*keys, F.col("i").alias("j"), F.col("a").alias("b"))
    return ahead.join(other, [*keys, "j"]).select(*keys, "i", "j", (dot(F.col("a"), F.col("b")) / (norm(F.col("a")) * norm(F.col("b")))).alias("similarity"))


def mean_similarity(rows: DataFrame, keys: Sequence[str], vector_col: str = "embedding") -> DataFrame:
    """keys, n, mean over all pairs of unit vectors, from the sum of the vectors: no pair is formed."""
    unit = rows.select(*keys, F.monotonically_increasing_id().alias("r"), F.posexplode(F.transform(vector_col, lambda x: x / norm(F.col(vector_col)))).alias("d", "x"))
    sums = unit.groupBy(*keys, "d").agg(F.sum("x").alias("s"), F.sum(F.col("x") * F.col("x")).alias("q"))
    n = rows.groupBy(*keys).agg(F.count("*").alias("n"))
    total = sums.groupBy(*keys).agg(F.sum(F.col("s") * F.col("s")).alias("ss"), F.sum("q").alias("qq")).join(n, list(keys))
    return total.select(*keys, "n", F.when(F.col("n") > 1, (F.col("ss") - F.col("qq")) / (F.col("n") * (F.col("n") - 1))).alias("mean"))


def cluster_segments(rows: DataFrame, keys: Sequence[str], order: str, most: int, vector_col: str = "embedding", enforce: bool = False) -> DataFrame:
    """keys, segment, first, last: the segmentation of each document's rows with the greatest similarity inside."""
    schema = ", ".join(f"{k} {dict(rows.dtypes)[k]}" for k in keys) + ", segment int, first int, last int"

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        found = scalar.segments(np.stack(pdf[vector_col].to_list()).astype(float), most, enforce)
        return pd.DataFrame([(*key, i, a, b) for i, (a, b) in enumerate(found)], columns=[*keys, "segment", "first", "last"])

    return rows.select(*keys, order, vector_col).groupBy(*keys).applyInPandas(run, schema)


def cluster_chunks(docs: DataFrame, most: int = 400, least: int = 50, overlap: int = 0, embedder: Embedder | None = None, enforce: bool = False, keys: Sequence[str] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """Chunks of neighbouring pieces that belong together, of at most about ``most`` tokens."""
    pieces = written(small_pieces(docs, keys, text_col), "pieces")
    rows = pieces.withColumn("vector", embed(F.col("chunk"), embedder)).select(*keys, "chunk_no", "chunk", F.col("vector.embedding").alias("embedding"))
    found = cluster_segments(rows, keys, "chunk_no", max(1, most // least), enforce=enforce)
    ends = found.select(*keys, F.col("last").alias("chunk_no"), F.lit(True).alias("cut"))
    marked = pieces.join(ends, [*keys, "chunk_no"], "left")
    return overlap_prefix(regrouped(marked, keys, "chunk_no", F.coalesce("cut", F.lit(False))), overlap, keys)
