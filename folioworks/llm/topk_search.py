"""Exact top-k inner-product search by block-at-a-time pruning.

Vectors become integers floor(64 x), are ordered by id and cut into blocks of neighbouring ids (document ranges).
A dimension is a term: a block's summary holds each term's largest and smallest value, so the summed maxima of a
query's terms bound every score in the block. A query visits the blocks in descending order of that bound, scores a
block through its forward index (the block's matrix), and stops when the bound falls below its k-th score.

Distribution: neighbouring blocks form groups and pieces of queries chunks, both of at most a fixed size; a task has one
group and one chunk, so its memory does not grow with the input. Chunks meet groups in rounds: first the group their
own ids come from, then the next 8, the next 64 and so on. Each round begins with the k-th scores of the rounds before it: the
small table of block summaries is held against them, and only blocks whose bound reaches the k-th score of a query of
the chunk are sent to it. After each round at most k rows of each query stay.

Integers are exact at every size: blocks keep the narrowest type that holds them, and scores that float or 64-bit
arithmetic could round or overflow are worked out in Python's integers.

Defined results: null vectors, and those with null, NaN or infinite components, take no part; a shorter vector counts
as padded with zeros; null ids take no part; a query row never matches itself, but matches other rows of its id, and
each of several rows of one id asks and is found for itself; a score outside of 64 bits is held to the end of their
range; equal scores go to the smaller vec_id; fewer candidates than k give fewer rows; an empty table gives none; only
the named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_scratch, through_scratch

SCALE = 64
#: At most so many vectors are in a block and queries in a piece, blocks in a group and pieces in a chunk.
BLOCK, PIECE, GROUP, CHUNK = 256, 512, 128, 8
#: Groups whose summaries a task holds at once; how much wider each round is than the one before.
SUMMARIES, WIDEN = 64, 8
LOW, HIGH = np.iinfo(np.int64).min, np.iinfo(np.int64).max
#: No floor yet, and no result yet in 64 bits or in Python's integers.
NONE, NONE_WIDE = LOW, -(1 << 100)

SHAPE = "part int, seq int, n int, dim int, kind string, ids binary, rows binary, mat binary, tops binary, lows binary"
ARROW = pa.schema([(c, t) for c, t in zip(("part", "seq", "n", "dim", "kind", "ids", "rows", "mat", "tops", "lows"), (*[pa.int32()] * 4, pa.string(), *[pa.binary()] * 5), strict=True)])


def taking_part(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(row, vec_id, v array<double>) of the rows that take part."""
    rows = vectors.select(F.monotonically_increasing_id().alias("row"), vectors[id_col].cast("long").alias("vec_id"), vectors[vec_col].alias("v"))
    rows = rows.withColumn("v", F.transform("v", lambda x: x.cast("double")))
    return rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))


def narrow(x: np.ndarray) -> tuple[str, np.ndarray]:
    """floor(64 x) in the narrowest type that holds it exactly; components that a double cannot scale stay as they are."""
    with np.errstate(over="ignore"):
        v = np.floor(x * SCALE)
    if not np.isfinite(v).all():
        return "r", x
    most = np.abs(v).max(initial=0)
    kind = next((k for k, top in (("b", 2**7), ("h", 2**15), ("i", 2**31)) if most < top), "d")
    return kind, v.astype(kind)


def levels(kind: str, data: bytes, n: int, dim: int) -> np.ndarray:
    """The integers that narrow() was given, as numbers of a narrow type, doubles or Python's integers."""
    v = np.frombuffer(data, "<f8" if kind == "r" else kind)
    if kind == "r":
        v = np.array([math.floor(x * SCALE) if math.isfinite(x * SCALE) else int(x) * SCALE for x in v.tolist()], object)
    return v.reshape(n, dim)


def wide(m: np.ndarray) -> np.ndarray:
    return m if m.dtype == object else np.array([int(x) for x in m.ravel().tolist()], object).reshape(m.shape)


def packer(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (part, row, vec_id, v) in order to blocks of at most ``size`` rows."""

    def block(part: int, seq: int, ids: list, rows: list, vectors: list) -> pa.RecordBatch:
        dim = max((len(v) for v in vectors), default=0)
        x = np.zeros((len(ids), dim))
        for i, v in enumerate(vectors):
            x[i, : len(v)] = v
        kind, m = narrow(x)
        row = (part, seq, len(ids), dim, kind, np.array(ids, "<i8").tobytes(), np.array(rows, "<i8").tobytes(), m.tobytes(), m.max(0).tobytes(), m.min(0).tobytes())
        return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(row, ARROW.types, strict=True)], schema=ARROW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int] = []
        rows: list[int] = []
        vectors: list[np.ndarray] = []
        part, seq = 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column("part")[0].as_py()
            lists = batch.column("v")
            ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
            ids += batch.column("vec_id").to_pylist()
            rows += batch.column("row").to_pylist()
            vectors += [flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
            while len(ids) >= size:
                yield block(part, seq, ids[:size], rows[:size], vectors[:size])
                del ids[:size], rows[:size], vectors[:size]
                seq += 1
        if ids:
            yield block(part, seq, ids, rows, vectors)

    return run


def blocks_of(rows: DataFrame, parts: int, size: int, name: str, made: list[str]) -> DataFrame:
    """Rows dealt out by ranges of ids (rows of one id may lie in several), as written blocks, numbered in that order."""
    ranged = rows.repartitionByRange(parts, "vec_id", "row").sortWithinPartitions("vec_id", "row")
    ranged = ranged.select(F.spark_partition_id().alias("part"), "row", "vec_id", "v")
    blocks = through_scratch(ranged.mapInArrow(packer(size), SHAPE), name, made)
    sizes = blocks.groupBy("part").agg(F.count("*").alias("c"))  # one row for each partition
    before = sizes.select("part", (F.sum("c").over(Window.orderBy("part")) - F.col("c")).alias("before"))
    return blocks.join(before, "part").withColumn("no", F.col("before") + F.col("seq")).drop("part", "seq", "before")


def padded(m: np.ndarray, dim: int) -> np.ndarray:
    return m if m.shape[1] == dim else np.concatenate([m, np.zeros((len(m), dim - m.shape[1]), m.dtype)], axis=1)


def stacked(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([wide(m) for m in parts] if any(m.dtype == object for m in parts) else parts)


def largest(m: np.ndarray) -> float:
    return float(max(1, min(max(np.abs(m.astype(float) if m.dtype != object else m).max(initial=0), 0), 10**300)))


def exact_type(bound: float) -> type:
    """Arithmetic in which products and sums up to bound are exact."""
    return np.float32 if bound < 2**24 else np.float64 if bound < 2**53 else object


def in_type(m: np.ndarray, kind: type) -> np.ndarray:
    return wide(m) if kind is object else m.astype(kind)


def held(scores: np.ndarray) -> np.ndarray:
    """Scores as 64-bit integers, held to their range."""
    if scores.dtype == object:
        return np.array([min(HIGH, max(LOW, x)) for x in scores.ravel().tolist()], np.int64).reshape(scores.shape)
    return scores.astype(np.int64)


def bounds(q: np.ndarray, tops: np.ndarray, lows: np.ndarray) -> np.ndarray:
    """Summed maxima of each query's terms in each block."""
    return held(np.maximum(q, 0) @ tops.T + np.minimum(q, 0) @ lows.T)


def search_tile(query_rows: np.ndarray, queries: np.ndarray, floor: np.ndarray, blocks: list[tuple[np.ndarray, np.ndarray, np.ndarray]], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(query number, vec_id, row, score) of the up to k best of each query among the blocks (ids, rows, matrix).

    floor: scores that a result must at least have.
    """
    bound = max(largest(m) for _, _, m in blocks) * largest(queries) * queries.shape[1]
    kind = exact_type(bound)
    mats, q = [in_type(m, kind).T for _, _, m in blocks], in_type(queries, kind)
    most = bounds(q, np.stack([m.max(1) for m in mats]), np.stack([m.min(1) for m in mats]))
    order = np.argsort(most, axis=1, kind="stable")[:, ::-1]
    ids, rows = np.concatenate([i for i, _, _ in blocks]), np.concatenate([r for _, r, _ in blocks])
    base = np.cumsum([0, *(len(i) for i, _, _ in blocks)])
    by_id = np.lexsort((rows, ids))
    place = np.empty(len(ids), np.int64)
    place[by_id] = np.arange(len(ids))
    span = 1 << int(len(ids)).bit_length()
    # Score and place in one number: a higher score, then a smaller id, is larger.
    fits = bound * span * 2 < 2**62
    none, number = (NONE, np.int64) if fits else (NONE_WIDE, object)
    best = np.full((len(q), k), none, number)
    every = np.arange(len(q))
    open_ones = np.ones(len(q), bool)
    for r in range(len(blocks)):
        at = order[:, r]
        worst = best[:, 0]
        kth = np.where(worst == none, floor, np.maximum(floor, (worst // span).astype(np.int64) if fits else held(np.where(worst == none, LOW, worst // span))))
        open_ones &= most[every, at] >= kth
        if not open_ones.any():
            break  # bounds only fall from here
        for b in np.unique(at[open_ones]):
            some = np.flatnonzero(open_ones & (at == b))
            score = held(q[some] @ mats[b])
            here = slice(base[b], base[b + 1])
            mixed = score.astype(number) * span + (span - 1 - place[here]).astype(number)
            mixed[(score < floor[some, None]) | (rows[here][None, :] == query_rows[some, None])] = none
            both = np.concatenate([best[some], mixed], axis=1)
            both = np.partition(both, both.shape[1] - k, axis=1) if fits else np.sort(both, axis=1)
            best[some] = np.sort(both[:, -k:], axis=1)
    row, col = np.nonzero(best != none)
    value = best[row, col]
    where = by_id[(span - 1 - value % span).astype(np.int64)]
    return row, ids[where], rows[where], (value // span).astype(np.int64)


def of_row(r, name: str, dim: int, n: int | None = None) -> np.ndarray:
    return padded(levels(r.kind, getattr(r, name), r.n if n is None else n, r.dim), dim)


def asked_of(pdf: pd.DataFrame, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Queries of a tile's pieces: piece, place in it, id, row, vector and floor of each."""
    pieces, places, ids, rows, vectors, floors = [], [], [], [], [], []
    for r in pdf.sort_values("no").itertuples():
        floor = np.full(r.n, NONE, np.int64)
        for f in r.floors if r.floors is not None else []:
            floor[f["q"]] = f["floor"]
        pieces.append(np.full(r.n, r.no, np.int64))
        places.append(np.arange(r.n))
        ids.append(np.frombuffer(r.ids, "<i8"))
        rows.append(np.frombuffer(r.rows, "<i8"))
        vectors.append(of_row(r, "mat", dim))
        floors.append(floor)
    return np.concatenate(pieces), np.concatenate(places), np.concatenate(ids), np.concatenate(rows), stacked(vectors), np.concatenate(floors)


FOUND = "piece long, q int, query_id long, vec_id long, row long, score long"


def tile_search(k: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        dim = max(1, int(pdf.dim.max()))
        asked = pdf[pdf.is_query]
        blocks = [(np.frombuffer(r.ids, "<i8"), np.frombuffer(r.rows, "<i8"), of_row(r, "mat", dim)) for r in pdf[~pdf.is_query].sort_values("no").itertuples()]
        if not blocks or asked.empty:
            return pd.DataFrame({c: np.zeros(0, np.int64) for c in ("piece", "q", "query_id", "vec_id", "row", "score")})
        pieces, places, query_ids, query_rows, vectors, floors = asked_of(asked, dim)
        q, ids, rows, score = search_tile(query_rows, vectors, floors, blocks, k)
        return pd.DataFrame({"piece": pieces[q], "q": places[q].astype(np.int32), "query_id": query_ids[q], "vec_id": ids, "row": rows, "score": score})

    return run


def blocks_to_visit(pdf: pd.DataFrame) -> pd.DataFrame:
    """Blocks of some groups whose bound reaches the k-th score of a query of the chunk."""
    dim = max(1, int(pdf.dim.max()))
    asked, known = pdf[pdf.is_query], pdf[~pdf.is_query]
    if asked.empty or known.empty:
        return pd.DataFrame({"chunk": np.zeros(0, np.int64), "no": np.zeros(0, np.int64)})
    *_, q, floors = asked_of(asked, dim)
    tops, lows = (stacked([of_row(b, c, dim, 1) for b in known.itertuples()]) for c in ("tops", "lows"))
    kind = exact_type(max(largest(tops), largest(lows)) * largest(q) * dim)
    reached = (bounds(in_type(q, kind), in_type(tops, kind), in_type(lows, kind)) >= floors[:, None]).any(0)
    return pd.DataFrame({"chunk": int(pdf.chunk.iloc[0]), "no": known.no[reached]})


def topk_search(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", query_mod: int = 20, k: int = 20, group: int = GROUP, chunk: int = CHUNK) -> DataFrame:
    """query_id, rank, vec_id, score of the k best other vectors of every row whose id is divisible by query_mod.

    group, chunk: at most so many blocks, and pieces of queries, meet in a task; fewer where that leaves cores idle.
    """
    spark = vectors.sparkSession
    cores = spark.sparkContext.defaultParallelism
    made: list[str] = []
    rows = through_scratch(taking_part(vectors, id_col, vec_col), "vectors", made)
    asking = rows.where(F.col("vec_id") % query_mod == 0)
    n, n_asking = rows.count(), asking.count()
    docs = blocks_of(rows, max(1, -(-n // (group * BLOCK)), min(cores, -(-n // BLOCK))), BLOCK, "vector-blocks", made)
    asked = blocks_of(asking, max(1, -(-n_asking // (chunk * PIECE)), min(cores, -(-n_asking // BLOCK))), PIECE, "query-pieces", made)
    n_blocks, n_pieces = docs.count(), asked.count()
    group, chunk = max(1, min(group, -(-n_blocks // cores))), max(1, min(chunk, -(-n_pieces // cores)))
    groups, chunks = -(-n_blocks // group), -(-n_pieces // chunk)
    number = lambda c, size: F.floor(F.col(c) / size)
    docs = docs.withColumn("grp", number("no", group))
    asked = asked.withColumn("chunk", number("no", chunk))

    own = F.least(F.lit(groups - 1), F.floor((F.col("chunk") + 0.5) * groups / max(1, chunks)))  # ids of both are in the same order
    common = ["chunk", "grp", "is_query", "no", "n", "dim", "kind", "ids", "rows", "mat", "tops", "lows", "floors"]
    none = F.lit(None).cast("array<struct<q:int,floor:long>>")
    best: DataFrame | None = None
    first, width = 0, 1
    while first < max(1, groups):
        last = min(max(1, groups), first + width)
        floors = asked.withColumn("floors", none)
        if best is not None:
            kth = best.groupBy("piece", "q").agg(F.count("*").alias("c"), F.min("score").alias("floor")).where(F.col("c") >= k)
            kth = kth.groupBy(F.col("piece").alias("no")).agg(F.collect_list(F.struct("q", "floor")).alias("floors"))  # at most a piece's queries
            floors = through_scratch(asked.join(kth, "no", "left"), "query-floors", made)
        near = F.transform(F.sequence(F.lit(first), F.lit(last - 1)), lambda i: (own + i) % groups)
        pairs = floors.select("chunk").distinct().select("chunk", F.explode(near).alias("grp"))

        def tiles(blocks: DataFrame, keys: DataFrame, by: Column, most: int) -> DataFrame:
            """Rows of blocks (with chunk and grp) and, for each chunk and grp of keys, its queries; together by chunk and grp."""
            asked_rows = floors.join(keys, "chunk").withColumn("is_query", F.lit(True))
            block_rows = blocks.withColumn("grp", by).withColumns({"is_query": F.lit(False), "floors": none})
            return block_rows.select(*common).unionByName(asked_rows.select(*common)).repartition(min(most, 20000), "chunk", "grp")

        if best is None:
            visits = docs.join(pairs, "grp")
        else:
            summaries = docs.drop("ids", "rows", "mat").withColumns({c: F.lit(None).cast("binary") for c in ("ids", "rows", "mat")})
            many = number("grp", SUMMARIES)
            tests = tiles(summaries.join(pairs, "grp"), pairs.select("chunk", many.alias("grp")).distinct(), many, max(cores, chunks * -(-(last - first) // SUMMARIES)))
            alive = through_scratch(tests.groupBy("chunk", "grp").applyInPandas(blocks_to_visit, "chunk long, no long"), "blocks-to-visit", made)
            visits = docs.join(alive, "no")
            pairs = alive.select("chunk", number("no", group).alias("grp")).distinct()
        found = tiles(visits, pairs, F.col("grp"), max(cores, chunks * (last - first))).groupBy("chunk", "grp").applyInPandas(tile_search(k), FOUND)
        order = Window.partitionBy("piece", "q").orderBy(F.col("score").desc(), "vec_id", "row")
        found = found if best is None else found.unionByName(best.drop("rank"))
        best = through_scratch(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "best-so-far", made)
        first, width = last, width * WIDEN
    drop_scratch(spark, *made[:-1])  # all but the last round's result
    return best.select("query_id", "rank", "vec_id", "score")
