"""Language-model scoring with Katz backoff over word n-grams of any order (``order``, trigrams by default).

Counts are discounted by Good-Turing, each order by its own counts of counts (counts above ``K`` stay). What a context
loses goes to the words not seen after it, in proportion to the model of one order less; the backoff weight is the lost
mass over that model's mass of the unseen words, so each context's probabilities add up to exactly 1 over the known
words and one unknown word. The word model, which ends the recursion, backs off in the same way to the unknown word.
Each document begins after end tokens.

Everything is counted over all training documents. Blocks of documents (coded as word numbers, with the words' hashes)
ask partitions of keys (see asked): about the n-grams of each order, and then, from order 2 up, about contexts, to
which each n-gram's discounted mass and lower-order probability are summed through one block alone, the first that
trains on it. A context's weight is asked for only where it can matter: if texts outside of training have the context,
or if all its n-grams might be too common to be discounted. fit() asks for all, and keeps the answers' tables
(n-gram keys, counts, weights), partitioned by order and key range; score_with() scores any texts with them.

Tokens are scored by recursion over the orders: the discounted probability if the n-gram was seen, else the context's
weight times the probability of one order less.

Words are told apart by 64-bit hashes, n-grams by a hash of their words' hashes.

Defined results: null text is empty and has the end token alone; a text of any length is scored whole, its block alone
may be larger than others; a null id counts as the id 'null' for the fold; repeated rows are trained on and scored
each; without training documents every word is unknown, with probability 1 (score 0); an empty table gives no rows;
only the named columns are read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .asked import ANSWER, HOMES, TABLES, BlockTable, Worked, answer_rows, answers_for, asked_by, block_bytes, buckets_for, parts_for, parts_of, question, statistics
from .common import crc_mod, doc_texts, release, text_batches, through_scratch, write_scratch

K = 5
#: No word has a space, so this stands for the end of a document.
END = b" "
CODED_BYTES = 4 << 20
#: Kinds of questions: an order's counts have its number, its contexts' weights that and CONTEXTS.
CONTEXTS = 100

CODED = "home long, seq int, ids array<long>, sizes array<long>, trains array<boolean>, tokens binary, words binary"


def coder(most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Blocks of (task, doc_id, train, text): word numbers of all documents (0 is the end), and the words' hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, trains = 0, []

        def noted() -> Iterator[pa.RecordBatch]:
            nonlocal task
            for b in batches:
                if b.num_rows:
                    task = b.column("task")[0].as_py()
                    trains.extend(b.column("train").to_pylist())
                yield b

        for seq, (ids, texts) in enumerate(text_batches(noted(), most)):
            number: defaultdict[bytes, int] = defaultdict()
            number.default_factory = number.__len__
            number[END]  # word 0
            tokens, sizes = [], []
            for t in texts:
                words = t.lower().split()
                sizes.append(len(words) + 1)
                tokens.append(np.fromiter(map(number.__getitem__, words), np.int32, len(words)))
                tokens.append(np.zeros(1, np.int32))
            hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, number), "<u8", len(number))
            row = [task * HOMES + seq % HOMES, seq, ids, sizes, trains[: len(ids)], packed_numbers(np.concatenate(tokens)), hashes.tobytes()]
            del trains[: len(ids)]
            types = (pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)], ["home", "seq", "ids", "sizes", "trains", "tokens", "words"])

    return run


def packed_numbers(numbers: np.ndarray) -> bytes:
    """Lowest bytes first, then the next, so that numbers that are mostly small are mostly zeros."""
    return np.ascontiguousarray(numbers.astype("<i4").view(np.uint8).reshape(-1, 4).T).tobytes()


def unpacked_numbers(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<i4").ravel()


def packed_counts(counts: np.ndarray) -> bytes:
    """A byte for each count, and four more at the end for each that doesn't fit in one."""
    large = counts >= 255
    return np.where(large, 255, counts).astype(np.uint8).tobytes() + counts[large].astype("<u4").tobytes()


def unpacked_counts(data: bytes, n: int) -> np.ndarray:
    counts = np.frombuffer(data, np.uint8, n).astype(np.int64)
    large = counts == 255
    if large.any():
        counts[large] = np.frombuffer(data, "<u4", int(large.sum()), n)
    return counts


def packed_bits(bits: np.ndarray) -> bytes:
    return np.packbits(bits).tobytes()


def unpacked_bits(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8, -(-n // 8)), count=n).astype(bool)


class Discounts:
    """Good-Turing: discounted counts from the counts of counts (n[r]: how many have count r, up to K + 1)."""

    def __init__(self, n: np.ndarray) -> None:
        self.keep = np.ones(K + 1)
        for k in range(K, 0, -1):
            if (n[1 : k + 2] > 0).all():
                r = np.arange(1, k + 1)
                common = (k + 1) * n[k + 1] / n[1]
                keep = ((r + 1) * n[r + 1] / (r * n[r]) - common) / (1 - common) if common < 1 else np.zeros(k)
                if (keep > 0).all() and (keep <= 1).all():
                    self.keep[1 : k + 1] = keep
                    break
        else:
            if n[1] > 0:  # too few counts for Good-Turing: take half of those that stand once
                self.keep[1] = 0.5
        #: Whether a count stays whole, and the least that does.
        self.whole = np.append(self.keep[1:] == 1, True)
        self.least_whole = int(self.whole.argmax()) + 1

    def __call__(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts <= K, self.keep[np.minimum(counts, K)], 1.0) * counts

    def stay(self, counts: np.ndarray) -> np.ndarray:
        return self.whole[np.clip(counts, 1, K + 1) - 1]


class WordModel:
    """Word probabilities: n tokens of v words, counts of counts n_r."""

    def __init__(self, n: int, v: int, n_r: np.ndarray) -> None:
        self.n, self.v = n, v
        self.discounts = Discounts(n_r)
        r = np.arange(1, K + 1)
        lost = float(((r - self.discounts(r)) * n_r[1 : K + 1]).sum())
        self.scale = 1.0 if lost > 0 else n / (n + 1)
        self.unknown = (lost / n if lost > 0 else 1 / (n + 1)) if n else 1.0

    def __call__(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts > 0, self.scale * self.discounts(counts) / max(1, self.n), self.unknown)


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of pairs of hashes."""
    h = a * np.uint64(0x9E3779B97F4A7C15) + (b ^ (b >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@dataclass
class Model:
    """What the driver holds of a model: its order, key partitions and statistics by order (some numbers each)."""

    order: int
    parts: int
    stats: list[np.ndarray] = field(default_factory=list)

    def add(self, parts: list[bytes]) -> None:
        """Statistics of the next order: tokens, distinct n-grams, counts of counts."""
        self.stats.append(np.sum([np.frombuffer(s, "<i8") for s in parts] + [np.zeros(K + 4, np.int64)], axis=0))

    @property
    def words(self) -> WordModel:
        return WordModel(int(self.stats[0][0]), int(self.stats[0][1]), self.stats[0][2:])

    def discounts(self, k: int) -> Discounts:
        return Discounts(self.stats[k - 1][2:])


class Grams:
    """The n-grams of one order that end at a block's tokens: distinct keys in order, each token's place among them,
    and the key of the words before each token."""

    def __init__(self, keys: np.ndarray, before: np.ndarray | None) -> None:
        self.keys, at = np.unique(keys, return_inverse=True)
        self.at, self.before = at.astype(np.int32), before


class Coded:
    """A block: its tokens and their words' hashes."""

    def __init__(self, row: dict, model: Model, every: bool = False) -> None:
        """every: all contexts matter, not only those that texts outside of training have or that may lose nothing."""
        self.every = every
        self.home, self.seq, self.answers, self.model = row["home"], row["seq"], row.get("answers"), model
        self.words, self.tokens = np.frombuffer(row["words"], "<u8"), unpacked_numbers(row["tokens"])
        self.sizes = np.array(row["sizes"], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.train = np.repeat(np.array(row["trains"], bool), self.sizes)
        self.end = self.words[0]
        self.order, self.last, self.done = 0, np.zeros(0, np.uint64), Grams(np.zeros(0, np.uint64), None)

    def grams(self, k: int) -> Grams:
        """The n-grams of order k; those of one order are held at a time."""
        if self.order > k:
            self.order = 0
        while self.order < k:
            self.order += 1
            every, before = self.words[self.tokens], None
            if self.order > 1:
                pad = np.array([self.end])
                for _ in range(self.order - 2):
                    pad = mixed(pad, np.array([self.end]))
                before = np.roll(self.last, 1)
                before[self.starts] = pad[0]
                every = mixed(before, every)
            self.last = every
            if self.order == k:
                self.done = Grams(every, before)
        return self.done

    def answer(self, kind: int, keys: np.ndarray) -> list[tuple[bytes, int]]:
        """Answers and the number of keys each is about."""
        counts = np.bincount(parts_of(keys, self.model.parts), minlength=self.model.parts)
        return list(zip(answers_for(self.answers, kind, self.seq), counts[counts > 0].tolist(), strict=True))

    def ask_counts(self, *orders: int) -> Iterator[tuple]:
        """Training counts, and whether an n-gram is also outside of training."""
        for k in orders:
            g = self.grams(k)
            counts = np.bincount(g.at[self.train], minlength=len(g.keys))
            other = np.bincount(g.at[~self.train], minlength=len(g.keys)) > 0
            yield from question(k, g.keys, lambda s, c=counts, o=other: packed_bits(o[s]) + packed_counts(c[s]), self.home, self.seq, self.model.parts)

    def counts(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each distinct n-gram: training count, whether this block answers for it, whether texts outside of training
        have it."""
        counts, owned, wanted = [], [], []
        for data, n in self.answer(k, self.grams(k).keys):
            bits = -(-n // 8)
            owned.append(unpacked_bits(data, n))
            wanted.append(unpacked_bits(data[bits:], n))
            counts.append(unpacked_counts(data[2 * bits :], n))
        return np.concatenate(counts), np.concatenate(owned), np.concatenate(wanted)

    def context_tokens(self, k: int, c: np.ndarray, total: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens whose context's weight matters to anyone, and those for which this block has to know it.

        c, total: training counts of each token's n-gram and context; wanted: whether texts outside of training have the context.
        """
        d = self.model.discounts(k)
        matter = (total > 0) & (self.every | wanted | (total >= 2 * d.least_whole))
        return matter, matter & ((c == 0) | (d.stay(c) & (c < total)))

    def levels(self, k: int, weigh: bool = True) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """By order from 2 to k: order, training count and ownership of each token's n-gram, tokens whose context's
        weight matters, and those that need it. self.p has the tokens' probabilities by one order less at each step, and
        by order k after the last one if this is scoring; not weigh: no weights are known yet, so it has none."""
        total = wanted = np.zeros(0)
        for n in range(1, k + 1):
            g = self.grams(n)
            counts, owned, other = self.counts(n)
            c = counts[g.at]
            if n == 1:
                self.p, self.known = self.model.words(counts)[g.at], c
                ends = np.flatnonzero(g.keys == self.end)
                docs = int(counts[ends[0]]) if len(ends) else 0
            else:
                matter, needs = self.context_tokens(n, c, total, wanted)
                yield n, c, owned[g.at], matter, needs
                if weigh and (n < k or self.scoring):
                    self.p = self.probability(n, c, total, needs)
            total, wanted = np.roll(c, 1), np.roll(other[g.at], 1)
            total[self.starts], wanted[self.starts] = docs, True

    scoring = False

    def probability(self, k: int, c: np.ndarray, total: np.ndarray, needs: np.ndarray) -> np.ndarray:
        """Of each token in its context of k - 1 words, from the probabilities of one order less."""
        d = self.model.discounts(k)
        keys, at = np.unique(self.grams(k).before[needs], return_inverse=True)
        weights = np.frombuffer(b"".join(answers_for(self.answers, CONTEXTS + k, self.seq)), "<f8")
        if len(weights) != len(keys):
            raise ValueError("contexts and their weights do not fit")
        w = np.ones(len(c))
        w[needs] = weights[at]
        # A context that lost nothing gives one count more to the unseen words; its weight is negative.
        whole = np.where(needs, w < 0, d.stay(c) & (c == total))
        safe = np.maximum(1, total) + whole
        return np.where(c > 0, np.where(whole, c, d(c)) / safe, np.where(total == 0, 1.0, np.abs(w) / safe) * self.p)

    def ask_contexts(self, k: int) -> Iterator[tuple]:
        """Of each context, over the n-grams that this block answers for: the mass of counts lost, and the probability,
        by one order less, of the words seen. Contexts of which the block neither gives nor needs anything stay out."""
        *_, (_, c, owned, matter, needs) = self.levels(k)
        g = self.grams(k)
        first = np.empty(len(g.keys), np.int64)
        first[g.at[::-1]] = np.arange(len(c))[::-1]
        gives = np.zeros(len(c), bool)
        gives[first] = owned[first] & matter[first]
        own, ask = np.flatnonzero(gives), np.flatnonzero(gives | needs)
        keys, at = np.unique(g.before[ask], return_inverse=True)
        place = np.empty(len(c), np.int64)
        place[ask] = at
        lost = np.bincount(place[own], c[own] - self.model.discounts(k)(c[own]), len(keys))
        seen = np.bincount(place[own], self.p[own], len(keys))
        has, asks = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
        has[place[own]], asks[place[needs]] = True, True
        both = np.stack([lost, seen], axis=1)
        return question(CONTEXTS + k, keys, lambda s: packed_bits(has[s]) + packed_bits(asks[s]) + both[s][has[s]].tobytes(), self.home, self.seq, self.model.parts)

    def ask_weights(self) -> Iterator[tuple]:
        """The contexts of all orders whose weight this block needs."""
        for k, *_, needs in self.levels(self.model.order, False):
            keys = np.unique(self.grams(k).before[needs])
            yield from question(CONTEXTS + k, keys, lambda s: b"", self.home, self.seq, self.model.parts)

    def logs(self) -> tuple[np.ndarray, np.ndarray]:
        """Training count of each token, and log10 of its probability in its context."""
        self.scoring = True
        for _ in self.levels(self.model.order):
            pass
        return self.known, np.log10(self.p)


def merged_keys(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[int], np.ndarray]:
    """Distinct keys, the place of each key among them, the sizes of the rows and where to cut them."""
    sizes = [len(k) // 8 for k in keys]
    distinct, where = np.unique(np.frombuffer(b"".join(keys), "<u8"), return_inverse=True)
    return distinct, where, sizes, np.cumsum(sizes)[:-1]


def sum_counts(keep: bool) -> Callable[[list[bytes], list[bytes]], Worked]:
    def run(keys: list[bytes], more: list[bytes]) -> Worked:
        """Training counts, with a mark at the first block that trains on an n-gram, and one if others have it."""
        distinct, where, sizes, cuts = merged_keys(keys)
        other = np.concatenate([unpacked_bits(m, n) for m, n in zip(more, sizes, strict=True)])
        each = np.concatenate([unpacked_counts(m[-(-n // 8) :], n) for m, n in zip(more, sizes, strict=True)])
        total = np.bincount(where, each, len(distinct)).astype(np.int64)
        wanted = np.bincount(where, other, len(distinct)) > 0
        owner = np.full(len(total), len(where), np.int64)
        training = np.flatnonzero(each > 0)
        owner[where[training[::-1]]] = training[::-1]  # the last one set is the first in order
        owned = np.zeros(len(where), bool)
        owned[owner[owner < len(where)]] = True
        parts = zip(np.split(owned, cuts), np.split(wanted[where], cuts), np.split(total[where], cuts), strict=True)
        stats = np.concatenate([[total.sum(), (total > 0).sum()], np.bincount(np.minimum(total, K + 2), minlength=K + 3)[: K + 2]]).astype("<i8")
        kept = total > 0
        table = table_of(distinct[kept], packed_counts(total[kept])) if keep else None
        return [packed_bits(o) + packed_bits(w) + packed_counts(t) for o, w, t in parts], stats.tobytes(), table

    return run


def sum_contexts(keep: bool) -> Callable[[list[bytes], list[bytes]], Worked]:
    def run(keys: list[bytes], more: list[bytes]) -> Worked:
        """Backoff weight of each context times its count; if it lost no mass, minus the inverse of the unseen words' mass."""
        distinct, where, sizes, cuts = merged_keys(keys)
        has = np.concatenate([unpacked_bits(m, n) for m, n in zip(more, sizes, strict=True)])
        asks = np.concatenate([unpacked_bits(m[-(-n // 8) :], n) for m, n in zip(more, sizes, strict=True)])
        each = np.frombuffer(b"".join(m[2 * -(-n // 8) :] for m, n in zip(more, sizes, strict=True)), "<f8").reshape(-1, 2)
        lost, seen = (np.bincount(where[has], x, len(distinct)) for x in each.T)
        unseen = np.maximum(1 - seen, 1e-12)
        weight = np.where(lost > 0, lost / unseen, -1 / unseen).astype("<f8")
        answers = [w[a].tobytes() for w, a in zip(np.split(weight[where], cuts), np.split(asks, cuts), strict=True)]
        return answers, None, table_of(distinct, weight.tobytes()) if keep else None

    return run


def coded_table(docs: DataFrame, id_col: str, text_col: str, train: Column) -> BlockTable:
    texts = doc_texts(docs, id_col, text_col)
    texts = texts.select(F.spark_partition_id().cast("long").alias("task"), "doc_id", train.alias("train"), "text")
    return BlockTable(texts.mapInArrow(coder(block_bytes(docs, CODED_BYTES)), CODED), buckets_for(docs), "coded")


def learn(table: BlockTable, order: int, keep: bool) -> tuple[Model, list[str]]:
    """Count, discount and weigh, order by order; returns the model and the paths of its answers.

    keep: ask for all contexts' weights and keep the key partitions' tables.
    """
    spark = table.spark
    n_tokens = table.frame().agg(F.sum(F.octet_length("tokens"))).first()[0] or 0
    model = Model(order, parts_for(spark, 2 * n_tokens))
    paths = []
    for orders in ([1, 2][:order], *([k] for k in range(3, order + 1))):
        paths.append(table.answered(asked_by(table.frame(), lambda row, o=tuple(orders): Coded(row, model).ask_counts(*o)), lambda _, keys, more: sum_counts(keep)(keys, more), "lm-counts"))
        for k in orders:
            model.add(statistics(spark, paths[-1], k))
        release(spark)
    for k in range(2, order + 1):
        paths.append(table.answered(asked_by(table.with_answers(*paths), lambda row, k=k: Coded(row, model, keep).ask_contexts(k)), lambda _, keys, more: sum_contexts(keep)(keys, more), "lm-contexts"))
        release(spark)
    return model, paths


OUT = "doc_id long, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def scored(table: BlockTable, model: Model, paths: list[str]) -> DataFrame:
    """The scores of all documents, written; table may go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                block, words = Coded(row, model), model.words
                counts, logs = block.logs()
                base = np.log10((counts + 0.1) / (words.n + 0.1 * (words.v + 1)))
                known = np.add.reduceat((counts > 0).astype(np.int64), block.starts)
                columns = [row["ids"], row["trains"], block.sizes, known, np.full(len(block.sizes), words.n), np.add.reduceat(base, block.starts), np.add.reduceat(logs, block.starts)]
                types = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["doc_id", "train", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return through_scratch(table.with_answers(*paths).mapInArrow(run, OUT), "lm-scores")


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_mod: int = 10, order: int = 3) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of each row of docs."""
    with coded_table(docs, id_col, text_col, crc_mod("doc_id", held_mod) != 0) as table:
        model, paths = learn(table, order, False)
        out = scored(table, model, paths)
    release(docs.sparkSession)
    return out.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def fit(docs: DataFrame, model_dir: str, id_col: str = "doc_id", text_col: str = "text", order: int = 3) -> None:
    """Train on all of docs, and write the model's tables: model_dir/tables (kind, part, data), by kind, and model_dir/model."""
    spark = docs.sparkSession
    with coded_table(docs, id_col, text_col, F.lit(True)) as table:
        model, paths = learn(table, order, True)
        tables = spark.read.schema(ANSWER).parquet(*paths).where(F.col("home") == TABLES)
        tables.select("kind", "part", "data").write.partitionBy("kind").parquet(f"{model_dir}/tables")
    stats = [(model.order, model.parts, [s.tolist() for s in model.stats])]
    spark.createDataFrame(stats, "order int, parts int, stats array<array<long>>").write.parquet(f"{model_dir}/model")


def table_of(keys: np.ndarray, values: bytes) -> bytes:
    """The number of keys, the keys in order, and their values."""
    return np.array([len(keys)], "<u8").tobytes() + keys.tobytes() + values


def opened(kind: int, data: bytes) -> tuple[int, np.ndarray]:
    """Number of keys of a table, and their values."""
    n = int(np.frombuffer(data, "<u8", 1)[0])
    rest = data[8 + 8 * n :]
    return n, unpacked_counts(rest, n) if kind < CONTEXTS else np.frombuffer(rest, "<f8", n)


def looked_up(asked: DataFrame, tables: DataFrame) -> str:
    """Answers to questions from a model's tables."""

    def run(pdf: pd.DataFrame, table: pd.DataFrame) -> pd.DataFrame:
        if pdf.empty:
            return pd.DataFrame({"kind": [0], "home": [0], "seq": [0], "part": [0], "data": [b""]}).head(0)
        kind, data = int(pdf.kind.iloc[0]), bytes(table["data"].iloc[0]) if len(table) else bytes(8)
        n, value = opened(kind, data)
        known = np.frombuffer(data, "<u8", n, 8)
        answers = []
        for keys in (np.frombuffer(k, "<u8") for k in pdf["keys"]):
            at = np.minimum(np.searchsorted(known, keys), max(0, n - 1))
            found = np.where(known[at] == keys, value[at], 0) if n else np.zeros(len(keys))
            none = np.zeros(len(keys), bool)
            answers.append(found.astype("<f8").tobytes() if kind >= CONTEXTS else packed_bits(none) + packed_bits(~none) + packed_counts(found.astype(np.int64)))
        return answer_rows(pdf, answers, None, None)

    pairs = asked.groupBy("kind", "part").cogroup(tables.groupBy("kind", "part"))
    return write_scratch(pairs.applyInPandas(run, ANSWER), "lm-looked-up")


def score_with(docs: DataFrame, model_dir: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of each row of docs, by a model that fit() wrote."""
    spark = docs.sparkSession
    r = spark.read.parquet(f"{model_dir}/model").first()
    model = Model(r.order, r.parts, [np.array(s) for s in r.stats])
    tables = spark.read.schema("part int, data binary, kind int").parquet(f"{model_dir}/tables")
    with coded_table(docs, id_col, text_col, F.lit(False)) as table:
        table.answers.append(looked_up(asked_by(table.frame(), lambda row: Coded(row, model).ask_counts(*range(1, model.order + 1))), tables))
        table.answers.append(looked_up(asked_by(table.with_answers(*table.answers), lambda row: Coded(row, model).ask_weights()), tables))
        out = scored(table, model, table.answers)
    return out.select("doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def model_of(spark: SparkSession, model_dir: str) -> DataFrame:
    """The tables of a model as rows: order, whether of contexts, key, value (count, or weight times the context's count)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for kind, data in zip(batch.column("kind").to_pylist(), batch.column("data").to_pylist(), strict=True):
                n, value = opened(kind, data)
                keys = np.frombuffer(data, "<u8", n, 8).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, kind % CONTEXTS, np.int32)), pa.array(np.full(n, kind >= CONTEXTS)), pa.array(keys), pa.array(value.astype(float))], ["order", "context", "key", "value"])

    return spark.read.schema("part int, data binary, kind int").parquet(f"{model_dir}/tables").mapInArrow(run, "order int, context boolean, key long, value double")
