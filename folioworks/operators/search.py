"""Keyword, vector and hybrid search over tables, for many queries at once."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from folioworks.functions.text import keyword_tokens
from folioworks.sources.scratch import sent, written

# Parameters of the keyword score and of the fusion of ranks.
K1, B, EPSILON = 1.5, 0.75, 0.25
RRF_K, STRONG, MODERATE, NEAR, SEMANTIC = 60, 0.5, 0.2, 0.8, 0.7


#: Documents and about the bytes of tokens in a block of the keyword index; queries in a chunk; terms that are added up at once.
BLOCK_DOCS, BLOCK_BYTES, CHUNK, ADDED = 4096, 4 << 20, 256, 1 << 20


@dataclass
class KeywordIndex:
    """blocks (documents with their term counts), idf (term, idf) and stats (n, mean_length): tables written once and read by each search."""

    blocks: DataFrame
    idf: DataFrame
    stats: DataFrame


def rows_by_id(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc, tokens, length, n (rows), total (length of all rows): rows of the same id, if there are any, are one document."""
    tokens = docs.select(docs[id_col].alias("doc"), keyword_tokens(docs[text_col]).alias("tokens")).withColumn("length", F.size("tokens").cast("long"))
    again = written(docs.groupBy(docs[id_col].alias("again")).agg(F.count("*").alias("n")).where("n > 1").select("again"), "repeated-ids")
    single = tokens.select("doc", "tokens", "length", F.lit(1).cast("long").alias("n"), F.col("length").alias("total"))
    if again.isEmpty():
        return single
    again = sent(again, F.octet_length(F.col("again").cast("string")) + 8)
    same = F.col("doc").eqNullSafe(F.col("again"))
    sums = (F.flatten(F.collect_list("tokens")).alias("tokens"), F.max("length").alias("length"), F.count("*").alias("n"), F.sum("length").alias("total"))
    return single.join(again, same, "left_anti").unionByName(tokens.join(again, same, "left_semi").groupBy("doc").agg(*sums))


def ints(x: pa.Array) -> np.ndarray:
    return pc.fill_null(x, 0).to_numpy(zero_copy_only=False).astype(np.int64)


def listed(x: pa.Array | np.ndarray) -> pa.Array:
    """All values as the list of one row."""
    x = x if isinstance(x, pa.Array) else pa.array(x)
    return pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)


def document_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of documents in order of id: ids, lengths, terms and in how many documents each is; by document the number
    of its terms, and all their numbers and counts (little-endian 32 bits)."""
    for batch in batches:
        tokens = batch.column("tokens")
        many = ints(pc.list_value_length(tokens))
        ends = np.cumsum(many)
        held = np.cumsum(np.concatenate([[0], ints(pc.binary_length(pc.list_flatten(tokens)))]))[ends]  # bytes up to each document's end
        first = 0
        while first < len(many):
            before = held[first - 1] if first else 0
            last = max(first + 1, min(first + BLOCK_DOCS, int(np.searchsorted(held, before + BLOCK_BYTES, "right"))))
            some = batch.slice(first, last - first)
            some = some.take(pc.array_sort_indices(some.column("doc"), null_placement="at_start"))
            first = last
            own = ints(pc.list_value_length(some.column("tokens")))
            coded = pc.list_flatten(some.column("tokens")).dictionary_encode()
            terms, n_terms = coded.dictionary, max(1, len(coded.dictionary))
            met, tf = np.unique(np.repeat(np.arange(len(own)), own) * n_terms + ints(coded.indices), return_counts=True)
            doc, term = met // n_terms, met % n_terms
            df = np.bincount(term, minlength=len(terms)).astype(np.int64)
            often = np.argsort(-df, kind="stable")  # frequent terms get small numbers, which pack well
            number = np.empty(len(terms), np.int64)
            number[often] = np.arange(len(terms))
            row = {
                "ids": listed(some.column("doc")), "lengths": listed(ints(some.column("length"))), "terms": listed(terms.take(pa.array(often))), "df": listed(df[often]),
                "many": listed(np.bincount(doc, minlength=len(own)).astype(np.int64)), "at": pa.array([number[term].astype("<i4").tobytes()]), "tf": pa.array([tf.astype("<i4").tobytes()]),
                "n": pa.array([int(ints(some.column("n")).sum())]), "total": pa.array([int(ints(some.column("total")).sum())]),
            }
            yield pa.RecordBatch.from_pydict(row)


def keyword_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> KeywordIndex:
    """Term counts and inverse document frequencies; a negative one becomes a quarter of the mean over all terms."""
    rows = rows_by_id(docs, id_col, text_col)
    schema = f"ids array<{dict(rows.dtypes)['doc']}>, lengths array<long>, terms array<string>, df array<long>, many array<long>, at binary, tf binary, n long, total long"
    blocks = written(rows.mapInArrow(document_blocks, schema), "postings", compression="zstd")
    stats = written(blocks.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), (F.sum("total") / F.sum("n")).alias("mean_length")), "stats")
    df = blocks.select(F.explode(F.arrays_zip("terms", "df")).alias("t")).groupBy(F.col("t.terms").alias("term")).agg(F.sum("t.df").alias("df"))
    raw = df.join(F.broadcast(stats)).select("term", (F.log(F.col("n") - F.col("df") + 0.5) - F.log(F.col("df") + 0.5)).alias("raw"))  # one row of stats
    raw = written(raw, "raw-idf")
    mean = raw.agg(F.avg("raw").alias("mean"))
    idf = raw.join(F.broadcast(mean)).select("term", F.when(F.col("raw") < 0, EPSILON * F.col("mean")).otherwise(F.col("raw")).alias("idf"))
    return KeywordIndex(blocks, idf, stats)


def query_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of queries: their ids, the words of all, and for each word of each query the numbers of both and the weight,
    by word."""
    for batch in batches:
        for first in range(0, batch.num_rows, CHUNK):
            some = batch.slice(first, CHUNK)
            parts = pc.list_flatten(some.column("parts"))
            coded = parts.field("term").dictionary_encode()
            word, query = ints(coded.indices), np.repeat(np.arange(some.num_rows), ints(pc.list_value_length(some.column("parts"))))
            by = np.argsort(word, kind="stable")
            weight = parts.field("weight").to_numpy(zero_copy_only=False).astype(np.float64)
            yield pa.RecordBatch.from_pydict({"q_ids": listed(some.column("query_id")), "words": listed(coded.dictionary), "word": listed(word[by]), "query": listed(query[by].astype(np.int64)), "weight": listed(weight[by])})


def block_scores(terms: pa.Array, lengths: np.ndarray, many: np.ndarray, at: np.ndarray, tf: np.ndarray, words: pa.Array, word: np.ndarray, query: np.ndarray, weight: np.ndarray, n_queries: int, mean_length: float) -> np.ndarray:
    """Scores of each query (row) for each document of a block (column); 0 for a document without any of its terms."""
    scores = np.zeros(n_queries * len(lengths))
    known = pc.fill_null(pc.index_in(terms, value_set=words), -1).to_numpy(zero_copy_only=False)
    doc, word_of = np.repeat(np.arange(len(lengths)), many), known[at]
    hit = word_of >= 0
    doc, word_of, tf = doc[hit], word_of[hit], tf[hit].astype(np.float64)
    under = tf + K1 * (1 - B + B * lengths[doc] / mean_length) if len(doc) else tf
    asking = np.bincount(word, minlength=len(words))
    start, each = (np.cumsum(asking) - asking)[word_of], asking[word_of]
    ends = np.cumsum(each)
    first = 0
    while first < len(doc):  # a bounded number of products at a time
        last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + ADDED, "right")))
        own = each[first:last]
        hits = np.repeat(np.arange(first, last), own)
        entry = np.arange(len(hits)) - np.repeat(np.cumsum(own) - own, own) + start[hits]
        part = weight[entry] * tf[hits] * (K1 + 1) / under[hits]
        scores += np.bincount(query[entry] * len(lengths) + doc[hits], part, len(scores))
        first = last
    return scores.reshape(n_queries, len(lengths))


def rounded(scores: np.ndarray) -> np.ndarray:
    """Scores in units of 1e-9: what ranks are by."""
    return np.copysign(np.floor(np.abs(scores) * 1e9 + 0.5), scores) + 0.0


def best_of_blocks(n: int, query_type: pa.DataType, id_type: pa.DataType) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                value = lambda name: batch.column(name)[i].values  # noqa: B023, E731
                number = lambda name: value(name).to_numpy(zero_copy_only=False)  # noqa: B023, E731
                at, tf = (np.frombuffer(batch.column(c)[i].as_py(), "<i4") for c in ("at", "tf"))
                ids, asking = value("ids"), value("q_ids")
                scores = block_scores(value("terms"), number("lengths"), number("many"), at, tf, value("words"), number("word"), number("query"), number("weight"), len(asking), batch.column("mean_length")[i].as_py())
                order, top = rounded(scores), min(n, len(ids))
                least = np.partition(order, len(ids) - top, axis=1)[:, len(ids) - top]
                kept = []
                for q in range(len(asking)):  # documents are in order of id: of equal ones the first
                    over = np.flatnonzero(order[q] > least[q])
                    kept.append(np.concatenate([over, np.flatnonzero(order[q] == least[q])[: top - len(over)]]))
                docs, of = np.concatenate(kept), np.repeat(np.arange(len(asking)), top)
                yield pa.RecordBatch.from_arrays([asking.take(pa.array(of)).cast(query_type), ids.take(pa.array(docs)).cast(id_type), pa.array(scores[of, docs]), pa.array(order[of, docs])], ["query_id", "doc", "score", "rounded"])

    return run


def keyword_search(index: KeywordIndex, queries: DataFrame, n: int = 10, query_id: str = "query_id", text_col: str = "text") -> DataFrame:
    """query_id, doc, score, rank: the n best documents of each query, ties by id; documents without any of its terms
    (score 0) fill up what is missing, and a term counts as often as the query has it.

    Blocks of documents meet chunks of queries, as in vector_search, and each pair gives the n best of its block: scores of
    other documents are never rows. The blocks stay where they are, unless the queries are too large to be sent.
    """
    asked = queries.select(queries[query_id].alias("query_id"), F.explode(keyword_tokens(queries[text_col])).alias("term")).groupBy("query_id", "term").agg(F.count("*").alias("times"))
    weighted = asked.join(index.idf, "term").select("query_id", F.struct("term", (F.col("times") * F.col("idf")).alias("weight")).alias("part"))
    none = queries.select(queries[query_id].alias("query_id"), F.lit(None).cast("struct<term:string,weight:double>").alias("part"))
    each = weighted.unionByName(none).groupBy("query_id").agg(F.collect_list("part").alias("parts"))  # nulls are not collected
    q_type, id_type = dict(each.dtypes)["query_id"], dict(index.blocks.dtypes)["ids"][6:-1]
    each = each.coalesce(max(1, queries.sparkSession.sparkContext.defaultParallelism))
    chunks = written(each.mapInArrow(query_chunks, f"q_ids array<{q_type}>, words array<string>, word array<long>, query array<long>, weight array<double>"), "queries")
    blocks = index.blocks.drop("df", "n", "total").join(F.broadcast(index.stats.select("mean_length")))  # one row
    pairs = paired(blocks, chunks, 24 * F.size("word") + 40 * F.size("words") + 40 * F.size("q_ids"))
    types = (to_arrow_type(t) for t in (each.schema["query_id"].dataType, index.blocks.schema["ids"].dataType.elementType))
    found = pairs.mapInArrow(best_of_blocks(max(1, n), *types), f"query_id {q_type}, doc {id_type}, score double, rounded double")
    order = Window.partitionBy("query_id").orderBy(F.col("rounded").desc(), "doc")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n).drop("rounded")


def paired(blocks: DataFrame, chunks: DataFrame, n_bytes: Column) -> DataFrame:
    """Each block with each chunk: chunks of few bytes are sent to the blocks; else blocks are spread over slices, each with
    all chunks."""
    small = sent(chunks, n_bytes)
    if small is not chunks:
        return blocks.join(small)
    spark = blocks.sparkSession
    slices = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spread = blocks.withColumn("slice", F.pmod(F.xxhash64("at"), F.lit(slices)).cast("int"))
    return spread.join(chunks.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))), "slice").drop("slice")


def distance(a: Column, b: Column, metric: str) -> Column:
    """Squared Euclidean (sql2) or cosine distance of two arrays."""
    pairs = F.zip_with(a, b, lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y")))
    total = lambda f: F.aggregate(pairs, F.lit(0.0), lambda s, p: s + f(p["x"], p["y"]))
    if metric == "sql2":
        return total(lambda x, y: (x - y) * (x - y))
    if metric == "cosine":
        n = F.sqrt(total(lambda x, y: x * x)) * F.sqrt(total(lambda x, y: y * y))
        return 1 - F.when(n == 0, 0.0).otherwise(total(lambda x, y: x * y) / n)
    raise ValueError(f"unknown metric {metric}")


def vector_topk(table: DataFrame, query: list[float], k: int = 10, metric: str = "sql2", id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """id, distance of the k nearest vectors to one query: a narrow scan and a top-k by partition."""
    near = table.select(table[id_col].alias("id"), distance(table[vec_col], F.lit(query), metric).alias("distance"))
    return near.orderBy("distance", "id").limit(k)


def vector_blocks(rows: DataFrame, size: int, name: str) -> DataFrame:
    """Rows (id, v) as written blocks of at most size vectors: no (from 0, with gaps), ids, dim, mat."""
    id_type = dict(rows.dtypes)["id"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), size):
                some = pdf.iloc[at : at + size]
                m = np.stack(some.v.to_list()).astype("<f8")
                yield pd.DataFrame({"ids": [some.id.tolist()], "dim": [m.shape[1]], "mat": [m.tobytes()]})

    blocks = rows.mapInPandas(run, f"ids array<{id_type}>, dim int, mat binary")
    return written(blocks.withColumn("no", F.monotonically_increasing_id()), name)


def nearest(asked: np.ndarray, m: np.ndarray, ids: np.ndarray, k: int, metric: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Number, ids and distances of the k nearest rows of m to each query, ties by id. A product of matrices finds all
    that rounding could put among them, and only those are measured exactly."""
    squares, q_squares = (m * m).sum(1), (asked * asked).sum(1)
    dots = asked @ m.T
    if metric == "sql2":
        near = squares[None] - 2 * dots + q_squares[:, None]
        slack = 1e-9 * (squares.max(initial=0) + q_squares + 1)
    else:
        n = np.sqrt(q_squares)[:, None] * np.sqrt(squares)[None]
        near, slack = 1 - np.where(n == 0, 0, dots / np.where(n == 0, 1, n)), np.full(len(asked), 1e-9)
    top = min(k, len(m)) - 1
    kth = np.partition(near, top, axis=1)[:, top] if len(m) else np.zeros(len(asked))
    for i, q in enumerate(asked):
        some = np.flatnonzero(near[i] <= kth[i] + slack[i])
        part = m[some]
        if metric == "sql2":
            d = ((part - q) ** 2).sum(1)
        else:
            n = np.linalg.norm(q) * np.linalg.norm(part, axis=1)
            d = 1 - np.where(n == 0, 0, (part * q).sum(1) / np.where(n == 0, 1, n))
        order = np.lexsort((ids[some], np.round(d, 12)))[:k]
        yield i, ids[some][order], d[order]


def vector_search(table: DataFrame, queries: DataFrame, k: int = 10, metric: str = "sql2", id_col: str = "vec_id", vec_col: str = "embedding", query_id: str = "query_id", query_col: str = "embedding", block: int = 4096) -> DataFrame:
    """query_id, id, distance, rank: the k nearest vectors of each query.

    Vectors lie in blocks and queries in chunks of at most ``block`` and 1024; a row of the join is one of each, so what
    a task holds is bounded, nothing passes through the driver, and each gives the k best of its block. Blocks are
    spread over slices, each with all chunks, so few queries still use all tasks. Equal distances go to the smaller id.
    """
    if metric not in ("sql2", "cosine"):
        raise ValueError(f"unknown metric {metric}")
    spark = table.sparkSession
    blocks = vector_blocks(table.select(table[id_col].alias("id"), table[vec_col].alias("v")).where("v is not null"), block, "vectors")
    chunks = vector_blocks(queries.select(queries[query_id].alias("id"), queries[query_col].alias("v")).where("v is not null").coalesce(max(1, spark.sparkContext.defaultParallelism)), 1024, "queries")
    chunks = chunks.select(F.col("no").alias("chunk"), F.col("ids").alias("q_ids"), F.col("mat").alias("q_mat"))
    slices = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    slice_of = F.pmod(F.xxhash64("no"), F.lit(slices)).cast("int")
    pairs = blocks.withColumn("slice", slice_of).join(chunks.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))), "slice")
    q_type, id_type = dict(chunks.dtypes)["q_ids"][6:-1], dict(blocks.dtypes)["ids"][6:-1]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples():
                m, asked = (np.frombuffer(x, "<f8").reshape(-1, r.dim) for x in (r.mat, r.q_mat))
                ids = np.array(r.ids.tolist() if hasattr(r.ids, "tolist") else r.ids)
                got = [pd.DataFrame({"query_id": r.q_ids[i], "id": found, "distance": d}) for i, found, d in nearest(asked, m, ids, k, metric)]
                if got:
                    yield pd.concat(got)

    found = pairs.select("ids", "dim", "mat", "q_ids", "q_mat").mapInPandas(run, f"query_id {q_type}, id {id_type}, distance double")
    order = Window.partitionBy("query_id").orderBy(F.round("distance", 12), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def semantic_only(near: DataFrame, limit: float = SEMANTIC, n: int = 3) -> DataFrame:
    """Of ranked neighbours those below the limit; of a query without any, its first n."""
    some = F.count_if(F.col("distance") < limit).over(Window.partitionBy("query_id"))
    return near.withColumn("close", some).where((F.col("distance") < limit) | ((F.col("close") == 0) & (F.col("rank") <= n))).drop("close")


def fused(keyword: DataFrame, semantic: DataFrame, n: int = 100) -> DataFrame:
    """query_id, doc_key, score, rank by weighted reciprocal ranks.

    keyword: query_id, doc_key, score, rank; semantic: query_id, doc_key, distance, rank. A key that stands at several
    ranks is summed. Weights: 3, 2 or 1 by the keyword score's share of the query's best; 1.5 for a near vector whose key
    was a strong or moderate keyword match at its last rank, else 1. Ties keep the order in which keys first came in,
    keywords first.
    """
    top = F.max("score").over(Window.partitionBy("query_id"))
    share = F.col("score") / F.col("top")
    words = keyword.withColumn("top", top).where("score > 0").withColumns({"weight": F.when(share > STRONG, 3.0).when(share > MODERATE, 2.0).otherwise(1.0), "match": share > MODERATE})
    one = F.lit(1.0) / (F.lit(RRF_K) + F.col("rank"))
    words = words.groupBy("query_id", "doc_key").agg(F.sum(one * F.col("weight")).alias("k"), F.min("rank").alias("k_first"), F.max_by("match", "rank").alias("match"))
    near = semantic.where(F.col("distance") < NEAR).groupBy("query_id", "doc_key").agg(F.sum(one).alias("s"), F.min("rank").alias("s_first"))
    both = words.join(near, ["query_id", "doc_key"], "full_outer")
    boost = F.when(F.coalesce("match", F.lit(False)), 1.5).otherwise(1.0)
    score = F.coalesce("k", F.lit(0.0)) + F.coalesce(F.col("s") * boost, F.lit(0.0))
    order = Window.partitionBy("query_id").orderBy(F.round("score", 12).desc(), F.col("k_first").asc_nulls_last(), "s_first")
    return both.withColumn("score", score).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n).select("query_id", "doc_key", "score", "rank")


def hybrid_search(index: KeywordIndex, docs: DataFrame, vectors: DataFrame, queries: DataFrame, n: int = 100, metric: str = "sql2", key: str = "text") -> DataFrame:
    """query_id, doc_key, score, rank: 2n keyword and 2n vector results of each query (query_id, text, embedding), fused.

    docs: doc_id, text; vectors: vec_id of a document and embedding. key: what counts as the same result, text or id.
    """
    same = F.sha2(F.col("text").cast("binary"), 256) if key == "text" else F.col("doc_id").cast("string")
    by_id = written(docs.select(F.col("doc_id").alias("id"), same.alias("doc_key")), "doc-keys")  # digests stand for texts
    words = keyword_search(index, queries, 2 * n).withColumnRenamed("doc", "id").join(by_id, "id")
    near = vector_search(vectors, queries, 2 * n, metric).join(by_id, "id")
    found = fused(words.select("query_id", "doc_key", "score", "rank"), near.select("query_id", "doc_key", "distance", "rank"), n)
    if key != "text":
        return found
    found = written(found, "fused")
    first = written(by_id.join(found.select("doc_key").distinct(), "doc_key").groupBy("doc_key").agg(F.min("id").alias("doc_id")), "first-rows")
    first = sent(first, F.octet_length("doc_key") + 40)  # else all texts are shuffled
    texts = docs.select("doc_id", "text").join(first, "doc_id").groupBy("doc_key").agg(F.any_value("text").alias("text"))
    return found.join(texts, "doc_key").select("query_id", F.col("text").alias("doc_key"), "score", "rank")
