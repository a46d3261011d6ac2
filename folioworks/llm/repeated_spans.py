"""Removal of repeated long strings by prefix-free parsing.

Parse: a window of 8 bytes whose hash falls under a bound is a trigger. A phrase reaches from a trigger to the end of
the next one, so the phrases of a string of ``length`` bytes depend on that string alone. The dictionary is the set of
distinct phrases with their counts; a parse is a document's sequence of phrases. A string of ``length`` bytes is then a
suffix of one phrase, some whole phrases (the inner parse) and a prefix of another phrase, which is how prefix-free
parsing puts the suffixes of a corpus in order: by the suffix of the dictionary first, then by the parse.

Steps, each with all the corpus' keys dealt out evenly over key partitions:
1. dictionary: which phrases occur twice or more. A string with a phrase that occurs once is not repeated, which
   settles all that is unique in the corpus;
2. parse: neighbouring strings with the same inner parse form a segment. Segments are sorted by inner parse and, within
   one, by all bytes their strings cover. Equal neighbours in that order: all their strings are repeated. An inner
   parse that stands once: none is;
3. what is left (segments that share the inner parse, but not all of the suffix before or the prefix after it, at the
   ends of copied passages; and strings with fewer than two triggers) is ordered string by string, with one segment
   standing for all equal ones.
Suffixes are only ever compared within ``length`` bytes, so sorting the parse takes one step and no doubling, and
order is by hash instead of by letter, since only equal neighbours matter: no suffix array of the whole dictionary is
made, whose unique phrases are as large as the corpus' unique text.

Equality is by 128 bits of hashes (inner parse and covered bytes, or the string itself); hashes of phrases only
decide what is looked at further.

Defined results: null text is empty; a text longer than a block is a block by itself and worked on in slices, within
about 40 bytes of memory for each of its own; documents shorter than length lose nothing; null ids stay null; repeated rows
are copies of each other; an empty table gives no rows; only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .asked import answers_for, asked_by, parts_for, parts_of, question, text_blocks
from .common import release, through_scratch

#: A trigger's window, and its last bytes, whose hash decides. A window whose last bytes come earlier in it too is none,
#: so runs of one byte and of short periods do not consist of triggers.
TRIGGER, HASHED = 16, 8
MEAN_PHRASE = 24
BOUND = np.uint64((1 << 32) // MEAN_PHRASE)
BLOCK_BYTES = 2 << 20
#: Positions that are worked on at once, so that memory for each byte of a long text stays small.
SLICE = 1 << 19
PHRASES, SEGMENTS, STRINGS = range(3)  # kinds of questions
NOT, ALL, STANDS_FOR, LEFT = range(4)  # answers on segments: none repeated, all are, all are and others ask, not known


def triggers(text: bytes) -> np.ndarray:
    """First positions of the windows that are triggers."""
    found = []
    for at in range(0, len(text) - TRIGGER + 1, SLICE):
        piece = np.frombuffer(text[at : at + SLICE + TRIGGER - 1], np.uint8)
        h = np.ndarray((len(piece) - HASHED + 1,), "<u8", np.ascontiguousarray(piece), strides=(1,)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        some = np.flatnonzero((h[TRIGGER - HASHED :] >> np.uint64(32)) < BOUND)
        again = np.zeros(len(some), bool)
        for i in range(TRIGGER - HASHED):
            again |= h[some + i] == h[some + TRIGGER - HASHED]
        found.append(some[~again] + at)
    return np.concatenate(found) if found else np.zeros(0, np.int64)


class Parsed:
    """The parse of a block: triggers, phrases and segments."""

    def __init__(self, row: dict, length: int, parts: int) -> None:
        self.home, self.seq, self.length, self.parts = row["home"], row["seq"], length, parts
        self.text, self.answers = row["text"], row.get("answers")
        sizes = np.array(row["sizes"], np.int64)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        at = triggers(self.text)
        doc = np.searchsorted(self.starts, at, "right") - 1
        inside = at + TRIGGER <= self.ends[doc]
        self.at, self.doc = at[inside], doc[inside]
        whole = np.flatnonzero(self.doc[:-1] == self.doc[1:])  # phrases, by their first trigger
        text, digest = self.text, xxhash.xxh3_64_intdigest
        hashes = np.fromiter((digest(text[a:b]) for a, b in zip(self.at[whole].tolist(), (self.at[whole + 1] + TRIGGER).tolist(), strict=True)), np.uint64, len(whole))
        self.whole = whole
        order = np.argsort(hashes, kind="stable")
        sorted_hashes = hashes[order]
        new = np.concatenate([[True], sorted_hashes[1:] != sorted_hashes[:-1]]) if len(order) else np.zeros(0, bool)
        self.distinct = sorted_hashes[new]
        rank = np.cumsum(new) - 1
        self.rank = np.empty(len(order), np.int64)
        self.rank[order] = rank
        self.twice = (np.bincount(rank, minlength=len(self.distinct)) > 1).astype(np.uint8)

    def ask_phrases(self) -> Iterator[tuple]:
        return question(PHRASES, self.distinct, lambda s: self.twice[s].tobytes(), self.home, self.seq, self.parts)

    def segments(self) -> None:
        """Segments (first and last string, first and last trigger inside) that may be repeated, and bare strings."""
        counts = np.bincount(parts_of(self.distinct, self.parts), minlength=self.parts)
        bits = answers_for(self.answers, PHRASES, self.seq)
        known = [np.unpackbits(np.frombuffer(b, np.uint8), count=c) for b, c in zip(bits, counts[counts > 0].tolist(), strict=True)]
        often = np.concatenate(known) if known else np.zeros(0, np.uint8)
        rare = np.ones(len(self.at) + 1, np.int64)  # of the phrase that begins at a trigger
        rare[self.whole] = 1 - often[self.rank]
        before = np.concatenate([[0], np.cumsum(rare)])
        reach = self.length - TRIGGER
        last = self.ends - self.length
        long_docs = np.flatnonzero(last >= self.starts)
        marks = np.concatenate([self.at + 1, self.at - reach])
        docs = np.concatenate([self.doc, self.doc])
        ok = (marks > self.starts[docs]) & (marks <= last[docs])
        first = np.sort(np.concatenate([self.starts[long_docs], marks[ok]]), kind="stable")  # three runs in order
        first = first[np.concatenate([[True], first[1:] != first[:-1]])] if len(first) else first
        doc = np.searchsorted(self.starts, first, "right") - 1
        end = np.minimum(np.concatenate([first[1:], [np.iinfo(np.int64).max]]), last[doc] + 1)
        a, b = np.searchsorted(self.at, first, "left"), np.searchsorted(self.at, first + reach, "right") - 1
        inner = b > a
        hit = inner & (before[np.minimum(b, len(self.at))] == before[np.minimum(a, len(self.at))])
        self.first, self.end, self.a, self.b = first[hit], end[hit], a[hit], b[hit]
        self.bare = [(int(x), int(y)) for x, y in zip(first[~inner], end[~inner], strict=True)]
        text, digest, length = self.text, xxhash.xxh3_64_intdigest, self.length
        t = self.at.tolist()
        sides = list(zip(self.first.tolist(), self.end.tolist(), self.a.tolist(), self.b.tolist(), strict=True))
        core = np.fromiter((digest(text[t[i] : t[j] + TRIGGER]) for _, _, i, j in sides), np.uint64, len(sides))
        cover = np.fromiter((digest(text[x : y - 1 + length], t[i] - x) for x, y, i, _ in sides), np.uint64, len(sides))
        order = np.lexsort((cover, core))
        core, cover = core[order], cover[order]
        new = np.concatenate([[True], (core[1:] != core[:-1]) | (cover[1:] != cover[:-1])]) if len(order) else np.zeros(0, bool)
        rank = np.cumsum(new) - 1
        self.segment_rank = np.empty(len(order), np.int64)
        self.segment_rank[order] = rank
        self.core, self.cover = core[new], cover[new]
        self.stands = order[new]  # a segment of each kind
        self.segment_twice = (np.bincount(rank, minlength=len(self.core)) > 1).astype(np.uint64)

    def ask_segments(self) -> Iterator[tuple]:
        self.segments()
        more = np.stack([self.cover, self.segment_twice], axis=1)
        return question(SEGMENTS, self.core, lambda s: more[s].tobytes(), self.home, self.seq, self.parts)

    def strings(self) -> None:
        """Segments' answers, and the strings that are left, with their distinct hashes."""
        data = answers_for(self.answers, SEGMENTS, self.seq)
        self.verdict = np.frombuffer(b"".join(data), np.uint8) if data else np.zeros(0, np.uint8)
        open_ones = self.stands[self.verdict >= STANDS_FOR]
        spans = list(zip(self.first[open_ones].tolist(), self.end[open_ones].tolist(), strict=True)) + self.bare
        self.string_spans = [(x, min(y, x + SLICE)) for a, y in spans for x in range(a, y, SLICE)]
        text, digest, length = self.text, xxhash.xxh3_128_digest, self.length
        firsts, counts, ranks, held = [], [], [], 0
        waiting: list[bytes] = []
        for i, (x, y) in enumerate(self.string_spans):
            waiting += [digest(text[j : j + length]) for j in range(x, y)]
            if len(waiting) >= SLICE or i == len(self.string_spans) - 1:
                one, rank, count = distinct_pairs(np.frombuffer(b"".join(waiting), "<u8").reshape(-1, 2))
                firsts.append(one)
                counts.append(count)
                ranks.append((rank + held).astype(np.int32))
                held += len(one)
                waiting = []
        every = np.concatenate(firsts) if firsts else np.zeros((0, 2), np.uint64)
        self.pair, rank, _ = distinct_pairs(every)
        self.string_rank = [rank[r].astype(np.int32) for r in ranks]
        total = np.bincount(rank, np.concatenate(counts) if counts else None, len(self.pair))
        self.string_twice = (total > 1).astype(np.uint64)

    def ask_strings(self) -> Iterator[tuple]:
        self.segments()
        self.strings()
        more = np.stack([self.pair[:, 1], self.string_twice], axis=1)
        return question(STRINGS, self.pair[:, 0].copy(), lambda s: more[s].tobytes(), self.home, self.seq, self.parts)

    def covered(self) -> np.ndarray:
        """Mark of each byte that a repeated string covers."""
        self.segments()
        self.strings()
        counts = np.bincount(parts_of(self.pair[:, 0].copy(), self.parts), minlength=self.parts)
        bits = answers_for(self.answers, STRINGS, self.seq)
        known = [np.unpackbits(np.frombuffer(x, np.uint8), count=c) for x, c in zip(bits, counts[counts > 0].tolist(), strict=True)]
        often = np.concatenate(known) if known else np.zeros(0, np.uint8)
        change = np.zeros(len(self.text) + 1, np.int32)
        verdict = self.verdict[self.segment_rank]
        sure = (verdict == ALL) | (verdict == STANDS_FOR)
        change[self.first[sure]] += 1  # no two segments, and no two strings, begin or end at the same byte
        change[self.end[sure] - 1 + self.length] -= 1
        flags = np.concatenate([often[r].astype(np.int8) for r in self.string_rank]) if self.string_rank else np.zeros(0, np.int8)
        at = 0
        for x, y in self.string_spans:
            change[x:y] += flags[at : at + y - x]
            change[x + self.length : y + self.length] -= flags[at : at + y - x]
            at += y - x
        return np.cumsum(change[:-1], dtype=np.int32) > 0


def distinct_pairs(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct rows in order, the place of each row among them, and how often each occurs."""
    order = np.lexsort((pairs[:, 1], pairs[:, 0]))
    pairs = pairs[order]
    new = np.concatenate([[True], (pairs[1:] != pairs[:-1]).any(1)]) if len(order) else np.zeros(0, bool)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(new) - 1
    return pairs[new], rank, np.bincount(rank, minlength=int(new.sum()))


def twice_or_more(keys: list[bytes], more: list[bytes]) -> list[bytes]:
    """Bits: which phrases occur twice or more in the corpus."""
    every, flags = np.frombuffer(b"".join(keys), "<u8"), np.frombuffer(b"".join(more), np.uint8)
    _, where, counts = np.unique(every, return_inverse=True, return_counts=True)
    counts = counts + np.bincount(where, flags, len(counts))
    return split_bits(counts[where] > 1, keys)


def split_bits(marks: np.ndarray, keys: list[bytes]) -> list[bytes]:
    cuts = np.cumsum([len(k) // 8 for k in keys])[:-1]
    return [np.packbits(x).tobytes() for x in np.split(marks, cuts)]


def sorted_pairs(keys: list[bytes], more: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys and second keys in order, the order itself, and whether each occurs twice in its block."""
    a = np.frombuffer(b"".join(keys), "<u8")
    m = np.frombuffer(b"".join(more), "<u8").reshape(-1, 2)
    order = np.lexsort((m[:, 0], a))
    return a[order], m[order, 0], order, m[order, 1].astype(np.int64)


def changes(*columns: np.ndarray) -> np.ndarray:
    """Number of the run of equal rows that each row is in."""
    new = np.zeros(len(columns[0]), bool)
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.cumsum(new)


def judge_segments(keys: list[bytes], more: list[bytes]) -> list[bytes]:
    """One of NOT, ALL, STANDS_FOR and LEFT for each segment, from the order by inner parse and covered bytes."""
    core, cover, order, twice = sorted_pairs(keys, more)
    group, kind = changes(core), changes(core, cover)
    count = np.bincount(kind) + np.bincount(kind, twice).astype(np.int64)
    single = count[kind] == 1
    first = np.concatenate([[True], kind[1:] != kind[:-1]])
    kinds = np.bincount(group, first)[group]
    open_group = np.bincount(group, single & (kinds > 1))[group] > 0
    verdict = np.where(single, np.where(kinds > 1, LEFT, NOT), np.where(open_group & first, STANDS_FOR, ALL)).astype(np.uint8)
    out = np.empty(len(verdict), np.uint8)
    out[order] = verdict
    cuts = np.cumsum([len(k) // 8 for k in keys])[:-1]
    return [x.tobytes() for x in np.split(out, cuts)]


def judge_strings(keys: list[bytes], more: list[bytes]) -> list[bytes]:
    """Bits: which strings occur twice or more."""
    a, b, order, twice = sorted_pairs(keys, more)
    kind = changes(a, b)
    often = (np.bincount(kind) + np.bincount(kind, twice))[kind] > 1
    out = np.empty(len(often), bool)
    out[order] = often
    return split_bits(out, keys)


def spans_of(mark: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of marked bytes."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mark.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


SPANS = "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200, with_text: bool = True) -> DataFrame:
    """doc_id, n_bytes, spans (removed runs of bytes), kept (the bytes that stay; null unless with_text) and kept_sha256."""
    spark = docs.sparkSession
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary()), ("kept_sha256", pa.string())])
    judges = {PHRASES: twice_or_more, SEGMENTS: judge_segments, STRINGS: judge_strings}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                block = Parsed(row, length, parts)
                mark = block.covered()
                out: list[list] = [[], [], [], [], []]
                for doc_id, a, b in zip(row["ids"], block.starts.tolist(), block.ends.tolist(), strict=True):
                    spans = spans_of(mark[a:b])
                    kept, at = [], a
                    for x, y in spans:
                        kept.append(block.text[at : a + x])
                        at = a + y
                    kept.append(block.text[at:b])
                    left = b"".join(kept)
                    for column, v in zip(out, (doc_id, b - a, [{"start": x, "end": y} for x, y in spans], left if with_text else None, hashlib.sha256(left).hexdigest()), strict=True):
                        column.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, schema.types, strict=True)], schema=schema)

    with text_blocks(docs, id_col, text_col, BLOCK_BYTES) as table:
        total = table.frame().agg(F.sum(F.octet_length("text"))).first()[0] or 0
        parts = parts_for(spark, total / 3)
        for name in ("ask_phrases", "ask_segments", "ask_strings"):
            table.answered(asked_by(table.with_answers(*table.answers), lambda row, name=name: getattr(Parsed(row, length, parts), name)()), lambda kind, keys, more: (judges[kind](keys, more), None, None), name)
            release(spark)
        out = through_scratch(table.with_answers(*table.answers).mapInArrow(cut, SPANS + ", kept_sha256 string"), "kept-texts")
    return out
