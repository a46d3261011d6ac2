"""Exact dedup by a tree merge of sorted digest runs, with DataFrame functions only.

Each input partition becomes a run of (digest, smallest id, count), sorted by digest and written to the shared
folder. Runs then meet in rounds: a round takes ``fan_in`` neighbouring runs to one, which is binomial merging with a
wider fan, and keeps for each digest the smallest identifier and the summed count. A hot group arrives in a round as
one row for each run that is left, never as its members. A digest is SHA-256 together with the byte length and XXH64
of the normalised text, which are compared at every level: two texts that differ would have to agree on all three.
Up to ``fan_in`` runs are merged in the last round alone; above that there is a round for each further power of it.

Defined results: null text counts as empty; a text of any length is hashed whole; null ids come after all others; of rows that share id and text exactly
one is kept (the first by input partition and place); an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WHITE_SPACE, as_one, checked_side, text_or_empty, through_scratch

KEY = ["sha", "n_bytes", "xx"]


def digest_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: run (input partition), row (place), doc_id and the digest; each run sorted by digest."""
    text = docs.select(docs[id_col].cast("long").alias("doc_id"), F.regexp_replace(text_or_empty(docs, text_col), WHITE_SPACE, " ").alias("t"))
    rows = text.select(
        F.spark_partition_id().alias("run"), F.monotonically_increasing_id().alias("row"), "doc_id",
        F.unhex(F.sha2(F.col("t").cast("binary"), 256)).alias("sha"), F.octet_length("t").cast("long").alias("n_bytes"), F.xxhash64("t").alias("xx"),
    )
    return through_scratch(rows.sortWithinPartitions(*KEY), "digest-runs")


def merge_runs(runs: DataFrame, fan_in: int = 8) -> DataFrame:
    """Merge the runs round by round to one row per digest: first (null_id, doc_id, row) and n."""
    last = runs.agg(F.max("run")).first()[0]
    left = 0 if last is None else last + 1
    smallest = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    merged = runs.groupBy("run", *KEY).agg(F.min(smallest).alias("first"), F.count("*").alias("n"))
    for _ in range(max(0, math.ceil(math.log(max(1, left), fan_in) - 1e-9) - 1)):
        merged = merged.groupBy((F.col("run") / fan_in).cast("int").alias("run"), *KEY).agg(F.min("first").alias("first"), F.sum("n").alias("n"))
    return merged.groupBy(*KEY).agg(F.min("first").alias("first"), F.sum("n").alias("n"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan_in: int = 8) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row for each row of docs."""
    runs = digest_runs(docs, id_col, text_col)
    groups = merge_runs(runs, fan_in).where("n > 1").select(*(F.col(c).alias("g_" + c) for c in KEY), "first", "n")
    groups = through_scratch(groups, "digest-groups")  # so that a hot digest's rows can be split in the join
    same = [runs[c] == groups["g_" + c] for c in KEY]
    out = runs.join(groups, same, "left")
    return out.select(
        "doc_id",
        F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (F.col("n").isNull() | (F.col("first.row") == F.col("row"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def keep_one(docs: DataFrame, decisions: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that decisions (of exact_dedup) keep, with docs' own columns.

    An anti join takes out the ids of which not all rows stay; texts move only if those ids are too many to be sent.
    Ids of several rows with different decisions are rare; among those rows alone the digest says which one stays.
    """
    ids = decisions.groupBy("doc_id").agg(F.count("*").alias("n"), F.sum(F.col("kept").cast("int")).alias("stay"))
    ids = through_scratch(ids.where("stay < n").withColumnRenamed("doc_id", "id"), "dropped-ids")
    rows = as_one(docs, id_col)
    whole = rows.join(checked_side(ids.select("id"), F.lit(64)), F.col("doc_id").eqNullSafe(F.col("id")), "left_anti").select("doc.*")
    mixed = ids.where("stay > 0")
    if mixed.isEmpty():
        return whole
    held = rows.join(checked_side(mixed.select("id"), F.lit(64)), F.col("doc_id").eqNullSafe(F.col("id")), "left_semi")
    text = F.coalesce(F.col("doc").getField(text_col).cast("string"), F.lit(""))
    held = held.withColumns({"text": text, "sha": F.sha2(F.regexp_replace(text, WHITE_SPACE, " ").cast("binary"), 256)})
    chosen = decisions.where("kept").select(F.col("doc_id").alias("id"), F.col("text_sha256").alias("kept_sha"))
    held = held.join(chosen, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("sha") == F.col("kept_sha")), "left_semi")
    place = Window.partitionBy("doc_id", "sha").orderBy(F.length("text"), "text")
    held = held.withColumn("place", F.row_number().over(place)).where("place = 1")
    return whole.unionByName(held.select("doc.*"))
