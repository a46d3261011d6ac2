"""SimHash near-duplicates: pigeonhole blocks, then a check of the Hamming distance.

A fingerprint's 64 bits are cut into 4 blocks of 16. Two fingerprints that differ in at most 2 bits share at least 2
blocks, so they meet in one of the 6 tables keyed by a pair of blocks. Only distinct fingerprints enter the tables:
copies are settled before, by their common fingerprint. Pairs of a small bucket are joined and verified. A bucket of
more than ``hot`` fingerprints is never paired off: there each fingerprint goes to the keys that come from flipping
one of the 32 bits outside the bucket's blocks, or none. Two members are within 2 bits exactly if they share such a
key, and all that share one are within 2 bits of each other, so linking each to the key's smallest member loses no
component. Components come from star steps over these links.

Defined results: null text is empty; a text of any length counts whole, its shingles in pieces; texts without words have fingerprint zero and are linked like any other; a null
id is a node like others but never the smallest unless all ids of a component are null; repeated rows each give a row;
an empty table gives no rows; only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import as_one, checked_side, doc_texts, through_scratch
from .graph import components

SEED = 42
PIECE = 1 << 16


def shingles(text: bytes, n: int) -> Iterator[list[bytes]]:
    """Lists of at most PIECE space-joined n-word shingles of the text in lower case; one of all words if fewer."""
    words = text.lower().split()
    if not words:
        return
    joined = b" ".join(words)
    if len(words) <= n:
        yield [joined]
        return
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - n + 1]
    ends = ends[n - 1 :]
    for at in range(0, len(starts), PIECE):
        yield [joined[s:e] for s, e in zip(starts[at : at + PIECE].tolist(), ends[at : at + PIECE].tolist(), strict=True)]


def simhash(text: bytes, n: int) -> int:
    """64 bits, each set if it is set in more than half of the shingles' XXH64."""
    total, ones = 0, np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for some in shingles(text, n):
        h = np.fromiter((digest(s, SEED) for s in some), np.uint64, len(some))
        ones += np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
        total += len(some)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big") if total else 0


def fingerprinter(n: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            prints = np.fromiter((simhash(t.as_py(), n) for t in texts), np.uint64, len(texts)).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints, pa.int64())], ["doc_id", "fp"])

    return run


def block(fp: Column, i: int) -> Column:
    return F.shiftrightunsigned(fp, 16 * i).bitwiseAND(F.lit(0xFFFF).cast("long"))


def mask_of(pair: tuple[int, int]) -> int:
    """The bits of a pair of blocks, as a signed 64-bit number."""
    m = sum(0xFFFF << 16 * i for i in pair)
    return m - (1 << 64) if m >= 1 << 63 else m


PAIRS = list(combinations(range(4), 2))


def links(prints: DataFrame, distance: int = 2, hot: int = 64) -> DataFrame:
    """(a, b) links between distinct fingerprints (fp, node), enough to join all within the distance of 2 bits."""
    if distance != 2:
        raise ValueError("the blocks are cut for a distance of 2 bits")
    masks = F.array(*[F.lit(mask_of(p)).cast("long") for p in PAIRS])
    keyed = prints.select("fp", "node", F.posexplode(masks).alias("tab", "mask")).select("fp", "node", "tab", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"))
    keyed = through_scratch(keyed, "simhash-blocks")
    sizes = keyed.groupBy("tab", "key").agg(F.count("*").alias("n")).where("n > 1")
    met = through_scratch(keyed.join(sizes, ["tab", "key"]), "simhash-met")
    small = met.where(F.col("n") <= hot)
    left = small.select("tab", "key", F.col("fp").alias("fa"), F.col("node").alias("a"))
    right = small.select("tab", "key", F.col("fp").alias("fb"), F.col("node").alias("b"))
    near = left.join(right, ["tab", "key"]).where((F.col("fa") < F.col("fb")) & (F.bit_count(F.col("fa").bitwiseXOR(F.col("fb"))) <= distance)).select("a", "b")
    large = met.where(F.col("n") > hot)
    bits = F.concat(F.array(F.lit(0).cast("long")), F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), i)))
    flips = large.select("node", "tab", "fp", F.explode(F.filter(bits, lambda b: b.bitwiseAND(F.col("mask")) == 0)).alias("bit"))
    stars = flips.select("node", "tab", F.col("fp").bitwiseXOR(F.col("bit")).alias("flip"))
    stars = through_scratch(stars, "simhash-stars")
    centre = stars.groupBy("tab", "flip").agg(F.min("node").alias("a"), F.count("*").alias("c")).where("c > 1").drop("c")
    far = stars.join(centre, ["tab", "flip"]).where("a <> node").select("a", F.col("node").alias("b"))
    return near.unionByName(far).distinct()


def grouped(docs: DataFrame, id_col: str, text_col: str, n_words: int, distance: int, hot: int) -> DataFrame:
    """doc_id, fp, root (a fingerprint that names the component) and component_id of each row."""
    prints = through_scratch(doc_texts(docs, id_col, text_col).mapInArrow(fingerprinter(n_words), "doc_id long, fp long"), "simhash")
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    # Components are found among fingerprints; their nodes are the fingerprints themselves.
    found = components(links(classes.select("fp", F.col("fp").alias("node")), distance, hot))
    rooted = classes.join(found, classes["fp"] == found["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = through_scratch(rooted, "simhash-roots")
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(rooted.join(ids, "root").select("fp", "root", "component_id"), "fp")


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_words: int = 3, distance: int = 2, hot: int = 64) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (the smallest doc_id that links reach) for each row."""
    out = grouped(docs, id_col, text_col, n_words, distance, hot)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_words: int = 3, distance: int = 2, hot: int = 64) -> DataFrame:
    """The rows of docs, with its own columns, of which one of each component stays: that of the smallest id."""
    return keep_smallest(docs, grouped(docs, id_col, text_col, n_words, distance, hot), lambda t: simhash(t, n_words), id_col, text_col)


def keep_smallest(docs: DataFrame, groups: DataFrame, print_of: Callable[[bytes], int], id_col: str, text_col: str) -> DataFrame:
    """The rows of docs of which one of each component of groups (doc_id, fp, root, component_id) stays.

    Ids that stand in several rows are settled among those rows alone, where the fingerprint names the component.
    """
    decisions = through_scratch(groups, "simhash-decisions")
    stays = F.col("doc_id").eqNullSafe(F.col("component_id"))
    ids = decisions.groupBy(F.col("doc_id").alias("id")).agg(F.count("*").alias("n"), F.count_if(stays).alias("stay"))
    ids = through_scratch(ids.where("stay = 0 or n > 1"), "dropped-ids")
    rows = as_one(docs, id_col)
    whole = rows.join(checked_side(ids.select("id"), F.lit(64)), F.col("doc_id").eqNullSafe(F.col("id")), "left_anti").select("doc.*")
    mixed = ids.where("stay > 0")
    if mixed.isEmpty():
        return whole
    held = rows.join(checked_side(mixed.select("id"), F.lit(64)), F.col("doc_id").eqNullSafe(F.col("id")), "left_semi")
    held = held.withColumn("text", F.coalesce(F.col("doc").getField(text_col).cast("string"), F.lit("")))

    @F.pandas_udf("long")
    def print_of_text(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([print_of(t.encode()) & (1 << 64) - 1 for t in texts], np.uint64).view(np.int64))

    held = held.withColumn("print", print_of_text("text"))
    roots = decisions.where(stays).select(F.col("doc_id").alias("id"), "fp", "root").distinct()
    held = held.join(roots, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("print") == F.col("fp")))
    place = Window.partitionBy("root").orderBy(F.length("text"), "text")
    held = held.withColumn("place", F.row_number().over(place)).where("place = 1")
    return whole.unionByName(held.select("doc.*"))
