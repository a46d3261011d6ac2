"""Near copies by shingles: minhash bands for candidates, then the exact share of common 5-word shingles.

A text is the set of its shingles' XXH64; texts of equal sets are one node. 96 minima of a set make 24 bands of 4. Two
sets that have 0.8 of their union in common agree in no band with a chance of 3e-6, more similar ones with less. Nodes
that share a band's key are candidates, each is verified by the sets themselves. A key of more than ``hot`` nodes is
not paired off at once: its nodes are first compared with one of them, and then only nodes that links so far do not
join are compared, first by 2048 bits of further minima in the join's condition (a pair at 0.8 fails there with a
chance of 3e-7) and then, in the same condition, by their sets. So a large group of near copies costs few pairs; many unlinked nodes under a
key still cost a cheap comparison each.

SimHash's links (3 words, 2 bits) are added, so nothing that they join stays apart. Components, null and repeated ids,
empty tables and empty texts are as in simhash_dedup; texts without words are one node; a text of any length gives the
set of all its shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import collect_garbage, doc_texts, through_scratch
from .graph import components
from .simhash_dedup import SEED, keep_smallest, links, shingles, simhash

WORDS = 5
BANDS, ROWS = 24, 4
LONGS = 32
#: Bits of 64 * LONGS that may differ: 5 standard deviations above the mean at a similarity of 0.8.
DEVIATIONS = 5


def multipliers(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


BAND_BY, BIT_BY, MIX = multipliers(BANDS * ROWS, 42), multipliers(64 * LONGS, 43), multipliers(BANDS + ROWS + 1, 44)


def shingle_set(text: bytes, n: int = WORDS) -> np.ndarray:
    """The distinct shingles' XXH64, in order."""
    parts = [np.unique(np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in some), np.uint64, len(some))) for some in shingles(text, n)]
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)


def node_of(hashes: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(hashes.tobytes(), SEED)).view(np.int64))


def minima(hashes: np.ndarray, by: np.ndarray) -> np.ndarray:
    """The smallest product of each multiplier and a hash, modulo 2**64."""
    least, step = np.full(len(by), np.iinfo(np.uint64).max, np.uint64), max(1, (1 << 19) // len(by))
    for at in range(0, len(hashes), step):
        np.minimum(least, np.multiply.outer(by, hashes[at : at + step]).min(1), out=least)
    return least


def band_keys(hashes: np.ndarray) -> np.ndarray:
    each, keys = minima(hashes, BAND_BY).reshape(BANDS, ROWS), MIX[:BANDS].copy()
    for i in range(ROWS):
        keys = (keys ^ each[:, i]) * MIX[BANDS + i]
        keys ^= keys >> np.uint64(32)
    return keys.view(np.int64)


def bits_of(hashes: np.ndarray) -> np.ndarray:
    """64 * LONGS bits, each a bit of another minimum."""
    least = minima(hashes, BIT_BY)
    return np.packbits((((least ^ least >> np.uint64(29)) * MIX[-1]) >> np.uint64(63)).astype(np.uint8)).view(np.int64)


def lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int64), pa.int64()))


def printed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, fp (SimHash of 3 words), node, size of the set, and its bands' keys."""
    for batch in batches:
        ids, fps, nodes, sizes, keys = batch.column("doc_id"), [], [], [], []
        for text in batch.column("text").cast(pa.binary()):
            t = text.as_py()
            hashes = shingle_set(t)
            fps.append(simhash(t, 3))
            nodes.append(node_of(hashes))
            sizes.append(len(hashes))
            keys.append(band_keys(hashes))
        prints = np.array(fps, np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([ids, pa.array(prints, pa.int64()), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), lists(keys)], ["doc_id", "fp", "node", "size", "keys"])


def with_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw = batch.column("text").cast(pa.binary())
        for at in range(0, len(raw), 256):
            sets = [shingle_set(t.as_py()) for t in raw[at : at + 256]]
            columns = [pa.array([node_of(s) for s in sets], pa.int64()), lists([bits_of(s) for s in sets]), lists([s.view(np.int64) for s in sets])]
            yield pa.RecordBatch.from_arrays(columns, ["node", "bits", "hashes"])


def sizes_fit(a: Column, b: Column, similarity: float) -> Column:
    return F.least(a, b) >= F.greatest(a, b) * similarity - 1e-6


def alike(a: Column, b: Column, similarity: float) -> Column:
    common = F.size(F.array_intersect(a, b))
    return common >= (F.size(a) + F.size(b) - common) * similarity - 1e-6


def verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose sets have at least the given share of their union in common."""
    left, right = sets.select(F.col("node").alias("a"), F.col("hashes").alias("ha")), sets.select(F.col("node").alias("b"), F.col("hashes").alias("hb"))
    near = pairs.join(left, "a").join(right, "b").where(alike(F.col("ha"), F.col("hb"), similarity))
    return through_scratch(near.select("a", "b"), "near-links")


def shingle_links(docs: DataFrame, prints: DataFrame, known: DataFrame, similarity: float, hot: int) -> DataFrame:
    """(a, b) links that join, together with the known ones, all nodes of that similarity.

    docs: doc_id and text; prints: doc_id, node, size, keys.
    """
    nodes = prints.groupBy("node").agg(F.any_value("size").alias("size"), F.any_value("keys").alias("keys"))
    keyed = through_scratch(nodes.select("node", "size", F.explode("keys").alias("key")), "near-keys")
    counts = keyed.groupBy("key").agg(F.count("*").alias("n"), F.min_by(F.struct("node", "size"), F.xxhash64("node", "key")).alias("centre")).where("n > 1")
    met = through_scratch(keyed.join(counts, "key"), "near-met")
    collect_garbage(docs.sparkSession)

    ids = prints.join(met.select("node").distinct(), "node", "left_semi").select(F.col("doc_id").alias("met_id")).distinct()
    texts = docs.join(ids, docs["doc_id"].eqNullSafe(ids["met_id"]), "left_semi").select("text")
    sets = through_scratch(texts.mapInArrow(with_sets, "node long, bits array<long>, hashes array<long>"), "near-sets")
    sets = through_scratch(sets.groupBy("node").agg(F.any_value("bits").alias("bits"), F.any_value("hashes").alias("hashes")), "near-sets")
    collect_garbage(docs.sparkSession)

    small, large = met.where(F.col("n") <= hot), met.where(F.col("n") > hot)
    left, right = (small.select("key", F.col("node").alias(c), F.col("size").alias("s" + c)) for c in "ab")
    pairs = left.join(right, ["key"]).where((F.col("a") < F.col("b")) & sizes_fit(F.col("sa"), F.col("sb"), similarity)).select("a", "b")
    stars = large.where((F.col("node") != F.col("centre.node")) & sizes_fit(F.col("size"), F.col("centre.size"), similarity))
    stars = stars.select(F.least("node", "centre.node").alias("a"), F.greatest("node", "centre.node").alias("b"))
    first = verified(through_scratch(pairs.unionByName(stars).distinct(), "near-pairs"), sets, similarity)
    collect_garbage(docs.sparkSession)
    if large.isEmpty():
        return first

    roots = components(known.unionByName(first))
    rooted = large.select("key", "node", "size").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rooted = through_scratch(rooted, "near-rooted")
    held = rooted.groupBy("key", "root").agg(F.count("*").alias("n"))
    main = held.groupBy("key").agg(F.max(F.struct("n", "root"))["root"].alias("main"), F.count("*").alias("roots")).where("roots > 1")
    open_ = rooted.join(main, "key").join(sets, "node")
    open_ = through_scratch(open_, "near-open")
    collect_garbage(docs.sparkSession)
    names = ["node", "size", "root", "bits", "hashes"]
    left, right = (rows.select("key", "main", *(F.col(c).alias(c + side) for c in names)) for rows, side in ((open_.where("root <> main"), "_a"), (open_, "_b")))
    once = (F.col("root_b") == F.col("main")) | (F.col("node_a") < F.col("node_b"))
    apart = sum((F.bit_count(F.get("bits_a", F.lit(i)).bitwiseXOR(F.get("bits_b", F.lit(i)))) for i in range(LONGS)), F.lit(0))
    p = (1 - similarity) / 2
    most = 64 * LONGS * p + DEVIATIONS * (64 * LONGS * p * (1 - p)) ** 0.5
    rest = left.join(right.drop("main"), "key").where((F.col("root_a") != F.col("root_b")) & once & sizes_fit(F.col("size_a"), F.col("size_b"), similarity) & (apart <= most) & alike(F.col("hashes_a"), F.col("hashes_b"), similarity))
    rest = rest.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()
    return first.unionByName(through_scratch(rest, "near-links"))


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = 0.8, hot: int = 16) -> DataFrame:
    """doc_id, fp (the node), root and component_id of each row."""
    texts = doc_texts(docs, id_col, text_col)
    prints = through_scratch(texts.mapInArrow(printed, "doc_id long, fp long, node long, size long, keys array<long>"), "near-prints")
    both = prints.select("fp", "node").distinct()
    first = both.groupBy("fp").agg(F.min("node").alias("node"))
    equal = both.join(first.select("fp", F.col("node").alias("a")), "fp").where("a <> node").select("a", F.col("node").alias("b"))
    known = through_scratch(links(first).where("a <> b").unionByName(equal), "near-known")
    collect_garbage(docs.sparkSession)
    found = components(known.unionByName(shingle_links(texts, prints, known, similarity, hot)))
    classes = prints.groupBy("node").agg(F.min("doc_id").alias("least"))
    rooted = classes.join(found, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    rooted = through_scratch(rooted, "near-roots")
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.select("doc_id", "node").join(rooted.join(ids, "root").select("node", "root", "component_id"), "node").withColumnRenamed("node", "fp")


def one_of_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = 0.8, hot: int = 16) -> DataFrame:
    """The rows of docs, with its own columns, of which one of each component stays: that of the smallest id."""
    return keep_smallest(docs, near_groups(docs, id_col, text_col, similarity, hot), lambda t: node_of(shingle_set(t)), id_col, text_col)
