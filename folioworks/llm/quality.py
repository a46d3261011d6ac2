"""Quality classifier: a byte-level convolutional network in numpy.

Bytes are embedded by a learned table, learned filters of ``WIDTH`` bytes run over the whole text at every second
byte, and each filter is max-pooled over overlapping chunks of 512 bytes (448 apart). Over all chunks of a document
the pooled filters are combined by their maximum, mean and minimum, which go through a hidden layer to one
probability. The network is trained by Adam on a bounded sample of labelled rows: at most ``sample`` rows of docs that
have a label, those with the smallest hash of their id, and of a text longer than ``crop`` bytes one window of that size
for each epoch, cut out where it lies, at hashed places anywhere in the whole text; so the driver holds at most
sample * epochs * crop bytes (197 MB). Scoring reads whole texts, in pieces, so a long document takes two bytes of
memory for each of its own and the embedding of one piece.

Defined results: null and empty texts get the score of an empty text; without labelled rows of both kinds the score is
the share of label 1 in the sample (0.5 without labels); null labels and labels of ids that docs does not have are left
out, of several labels of an id the smallest counts; repeated rows each give a row; a text of any length is scored
whole; an empty table gives no rows; only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, doc_texts, modest_batches, text_batches

DIM, WIDTH, FILTERS, HIDDEN = 8, 8, 32, 32
STEP, CELL, CHUNK, STRIDE = 2, 64, 8, 7  # bytes between filter places, bytes in a cell, cells in a chunk, between chunks
PAD = 256
PIECE = 1 << 19
EPOCHS, CROP = 8, 6144

Model = dict[str, np.ndarray]


def fresh(seed: int = 7) -> Model:
    r = np.random.default_rng(seed)
    normal = lambda *shape: r.standard_normal(shape).astype(np.float32)
    embed = normal(257, DIM) * 0.5
    embed[PAD] = 0
    return {"embed": embed, "filters": normal(WIDTH * DIM, FILTERS) / np.sqrt(WIDTH * DIM), "bias": np.zeros(FILTERS, np.float32), "w1": normal(3 * FILTERS, HIDDEN) / np.sqrt(3 * FILTERS), "b1": np.zeros(HIDDEN, np.float32), "w2": normal(HIDDEN) / np.sqrt(HIDDEN), "b2": np.zeros(1, np.float32)}


def laid_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one array of byte numbers, each in whole cells; and the number of cells of each. A filter's width of
    padding comes before each text and after the last one, so no filter sees two texts."""
    cells = np.array([(len(t) + WIDTH + CELL - 1) // CELL for t in texts])
    line = np.full(int(cells.sum()) * CELL + WIDTH, PAD, np.uint16)
    at = 0
    for t, c in zip(texts, cells.tolist(), strict=True):
        line[at + WIDTH : at + WIDTH + len(t)] = np.frombuffer(t, np.uint8)
        at += c * CELL
    return line, cells


def largest(x: np.ndarray) -> np.ndarray:
    """Maximum over the second axis, whose length is a power of two, by halves."""
    while x.shape[1] > 1:
        half = x.shape[1] // 2
        x = np.maximum(x[:, :half], x[:, half:])
    return x[:, 0]


def responses(model: Model, line: np.ndarray) -> Iterator[np.ndarray]:
    """Responses without bias, for each offset: cell, place in the cell (WIDTH bytes apart), filter."""
    flat = np.take(model["embed"], line, axis=0).ravel()
    n = (len(line) - WIDTH) * DIM
    for p in range(0, WIDTH, STEP):  # places p, p + WIDTH, ... lie in the line without overlap
        yield (flat[p * DIM : p * DIM + n].reshape(-1, WIDTH * DIM) @ model["filters"]).reshape(-1, CELL // WIDTH, FILTERS)


def cell_peaks(model: Model, line: np.ndarray) -> np.ndarray:
    """Largest response of each filter in each cell, a piece of the line at a time."""
    n, per = (len(line) - WIDTH) // CELL, PIECE // CELL
    parts = []
    for a in range(0, n, per):
        best = None
        for got in responses(model, line[a * CELL : min(n, a + per) * CELL + WIDTH]):
            top = largest(got)
            best = top if best is None else np.maximum(best, top, out=best)
        parts.append(best)
    return np.concatenate(parts) + model["bias"]


def chunk_cells(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cell numbers of each chunk (the last one repeated where a document ends), and the number of chunks of each document."""
    counts = np.maximum(1, -(-(cells - 1) // STRIDE))
    first, last = np.cumsum(cells) - cells, np.cumsum(cells) - 1
    doc = np.repeat(np.arange(len(cells)), counts)
    order = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.minimum((first[doc] + order * STRIDE)[:, None] + np.arange(CHUNK), last[doc][:, None]), counts


def head(model: Model, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hidden = np.maximum(0, v @ model["w1"] + model["b1"])
    return hidden, 1 / (1 + np.exp(-np.clip(hidden @ model["w2"] + model["b2"], -30, 30)))


def score(model: Model, texts: list[bytes]) -> np.ndarray:
    """Probability of label 1 of each whole text."""
    line, cells = laid_out(texts)
    peaks = cell_peaks(model, line)
    index, counts = chunk_cells(cells)
    chunks = peaks[index[:, 0]]
    for j in range(1, CHUNK):
        np.maximum(chunks, peaks[index[:, j]], out=chunks)
    chunks = np.maximum(chunks, 0)
    at = np.cumsum(counts) - counts
    v = np.concatenate([np.maximum.reduceat(chunks, at), np.add.reduceat(chunks, at) / counts[:, None], np.minimum.reduceat(chunks, at)], axis=1).astype(np.float32)
    return head(model, v)[1]


def gradients(model: Model, texts: list[bytes], labels: np.ndarray) -> Model:
    """Gradients of the mean log loss; pooling passes them to the places of the maxima alone."""
    line, cells = laid_out(texts)
    every_response = np.stack(list(responses(model, line)))
    peaks = largest(np.maximum.reduce(every_response)) + model["bias"]
    index, counts = chunk_cells(cells)
    every = peaks[index]
    k = every.argmax(1)
    chunks = np.maximum(0, np.take_along_axis(every, k[:, None, :], 1)[:, 0])
    cell = np.take_along_axis(np.broadcast_to(index[:, :, None], every.shape), k[:, None, :], 1)[:, 0]
    inside = every_response[:, cell, :, np.arange(FILTERS)[None]].reshape(*cell.shape, -1).argmax(2)
    at = cell * CELL + inside % (CELL // WIDTH) * WIDTH + inside // (CELL // WIDTH) * STEP
    starts = np.cumsum(counts) - counts
    doc = np.repeat(np.arange(len(texts)), counts)
    high, low, mean = np.maximum.reduceat(chunks, starts), np.minimum.reduceat(chunks, starts), np.add.reduceat(chunks, starts) / counts[:, None]
    v = np.concatenate([high, mean, low], axis=1).astype(np.float32)
    hidden, p = head(model, v)
    d = ((p - labels) / len(labels)).astype(np.float32)
    g: Model = {"w2": hidden.T @ d, "b2": d.sum(keepdims=True)}
    dh = np.outer(d, model["w2"]) * (hidden > 0)
    g |= {"w1": v.T @ dh, "b1": dh.sum(0)}
    dv = dh @ model["w1"].T
    dc = dv[:, FILTERS : 2 * FILTERS][doc] / counts[doc][:, None]
    for part, value in ((0, high), (2, low)):
        hit = chunks == value[doc]
        ties = np.add.reduceat(hit, starts, dtype=np.int64)
        dc += hit * (dv[:, part * FILTERS : (part + 1) * FILTERS][doc] / ties[doc])
    dc *= chunks > 0
    g["bias"] = dc.sum(0)
    window = line[at[:, :, None] + np.arange(WIDTH)]  # chunk, filter, place in the filter
    seen = model["embed"][window].reshape(len(chunks), FILTERS, WIDTH * DIM)
    g["filters"] = np.einsum("ck,ckj->jk", dc, seen, optimize=True)
    back = (dc[:, :, None] * model["filters"].T[None]).reshape(-1, DIM)
    flat = window.ravel()
    g["embed"] = np.stack([np.bincount(flat, back[:, i], 257) for i in range(DIM)], axis=1).astype(np.float32)
    g["embed"][PAD] = 0
    return g


def train(texts: list[list[bytes]], labels: np.ndarray, epochs: int = EPOCHS, batch: int = 64, rate: float = 0.004, seed: int = 7) -> Model:
    """Adam over shuffled batches; each text is given by its windows, of which each epoch takes another."""
    model, r = fresh(seed), np.random.default_rng(seed)
    share = float(np.clip(labels.mean(), 0.001, 0.999))
    model["b2"][:] = np.log(share / (1 - share))
    first = {k: np.zeros_like(x) for k, x in model.items()}
    second = {k: np.zeros_like(x) for k, x in model.items()}
    total, step = epochs * -(-len(texts) // batch), 0
    for epoch in range(epochs):
        order = r.permutation(len(texts))
        for i in range(0, len(order), batch):
            some = order[i : i + batch]
            g = gradients(model, [texts[j][epoch % len(texts[j])] for j in some], labels[some])
            step += 1
            now = rate * (1 - step / (total + 1))
            for k in model:
                first[k] += 0.1 * (g[k] - first[k])
                second[k] += 0.01 * (g[k] ** 2 - second[k])
                model[k] -= (now * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
    return model


def windows(text: Column, crop: int, epochs: int) -> Column:
    """The bytes of a text, or of a longer one windows of crop bytes, at hashed places that may be anywhere in it."""
    data, size = text.cast("binary"), F.octet_length(text)
    at = lambda i: F.pmod(F.xxhash64(F.col("doc_id"), size, i), size - crop + 1).cast("int")
    cut = F.transform(F.sequence(F.lit(0), F.lit(epochs - 1)), lambda i: F.substring(data, at(i) + 1, F.lit(crop)))
    return F.when(size <= crop, F.array(data)).otherwise(cut)


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, sample: int, held_mod: int, crop: int, epochs: int) -> tuple[list[list[bytes]], np.ndarray]:
    """Windows of at most sample labelled texts outside of the held-out fold, with their labels."""
    marks = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["quality"].cast("int").alias("quality")).where("doc_id is not null and quality in (0, 1)")
    marks = marks.where(crc_mod("doc_id", held_mod) != 0).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    ids = docs.select(docs[id_col].cast("long").alias("doc_id"))
    chosen = marks.join(ids, "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)  # of the labels that docs has
    rows = doc_texts(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id")  # at most sample rows are sent
    rows = rows.select("doc_id", "quality", F.xxhash64("text").alias("hash"), windows(F.col("text"), crop, epochs).alias("windows"))
    got = sorted(rows.orderBy(F.xxhash64("doc_id"), "doc_id", "hash").limit(sample).collect(), key=lambda x: (x.doc_id, x.hash))
    return [[bytes(w) for w in x.windows] for x in got], np.array([x.quality for x in got], np.float32)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = 4000, held_mod: int = 5, crop: int = CROP) -> Model | float:
    texts, y = labelled_sample(docs, labels, id_col, text_col, sample, held_mod, crop, EPOCHS)
    if len(set(y.tolist())) < 2:
        return float(y.mean()) if len(y) else 0.5
    return train(texts, y)


def scorer(model: Model | float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in text_batches(batches, PIECE):
            s = np.full(len(ids), model) if isinstance(model, float) else score(model, texts)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(s.astype(np.float64))], ["doc_id", "score"])

    return run


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3, sample: int = 4000, held_mod: int = 5) -> DataFrame:
    """doc_id, held_out, score, predicted of each row of docs."""
    model = fit(docs, labels, id_col, text_col, sample, held_mod)
    scored = doc_texts(docs, id_col, text_col).mapInArrow(scorer(model), "doc_id long, score double")
    return scored.select("doc_id", (crc_mod("doc_id", held_mod) == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3, sample: int = 4000, held_mod: int = 5) -> DataFrame:
    """The rows of docs, with its own columns, whose text scores at least threshold. No row is shuffled."""
    model = fit(docs, labels, id_col, text_col, sample, held_mod)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column(text_col).cast(pa.binary()).to_pylist()]
            good: list[np.ndarray] = []
            at = 0
            while at < len(texts):  # pieces of bounded size, a longer text alone
                end, held = at + 1, len(texts[at])
                while end < len(texts) and held + len(texts[end]) <= PIECE:
                    held += len(texts[end])
                    end += 1
                good.append(np.full(end - at, model) if isinstance(model, float) else score(model, texts[at:end]))
                at = end
            if good:
                yield batch.filter(pa.array(np.concatenate(good) >= threshold))

    modest_batches(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)
