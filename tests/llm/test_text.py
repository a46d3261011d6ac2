import hashlib
import math
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from folioworks.llm import katz_lm, packing, piece_bpe, quality, repeated_spans, secret_scan
from folioworks.llm.exact_dedup import exact_dedup
from folioworks.llm.simhash_dedup import simhash_dedup

WORD_FILE, PIECE_FILE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "piece_bpe_32k.model"))
ODD = ["  ", " ", "   ", "\n", " \n", "\n ", "\t", "\r\n", "a", "The", "the", "in", "é", "É", "日", "▁", "xxxxxxx", "😀", "=", "==", "ß", "0", "12", "</s>", "<|endoftext|>", "<|", "'s", "'LL", "'", "½", "ª", "\xa0", "\xad", "İ", "Σ", "\x00", "\x1c", "don't", "!", ".", "ing"]


@pytest.fixture(scope="module")
def pieces():
    return piece_bpe.PieceEncoder(PIECE_FILE)


@pytest.fixture(scope="module")
def words():
    return packing.WordTokenizer(WORD_FILE), Tokenizer.from_file(WORD_FILE)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(ODD), st.text(max_size=6)), max_size=14).map("".join))
def test_pieces_as_the_library(pieces, text):
    assert pieces.encoded(text) == pieces.library.encode(text)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(ODD), st.text(max_size=6)), max_size=14).map("".join))
def test_words_as_the_library(words, text):
    own, library = words
    assert np.frombuffer(own.ids(text), own.width).tolist() == library.encode(text, add_special_tokens=False).ids


def test_long_segments_go_by_windows(pieces, monkeypatch):
    text = "".join(ODD[i * 7 % len(ODD)].replace(" ", "e") for i in range(3000)) + "日本語" * 500 + "abab" * 700
    want = pieces.library.encode(text)
    assert pieces.encoded(text) == want
    monkeypatch.setattr(piece_bpe.Matches, "SIZE", 64)
    assert pieces.encoded(text) == want


def test_stores_stay_bounded(monkeypatch):
    own = packing.WordTokenizer(WORD_FILE, keep=5)
    library = Tokenizer.from_file(WORD_FILE)
    for text in ("one two three", "four five six seven eight nine", "one two", "a b c d e"):
        assert np.frombuffer(own.ids(text), own.width).tolist() == library.encode(text, add_special_tokens=False).ids
    monkeypatch.setattr(piece_bpe, "KEEP_SEGMENTS", 3)
    monkeypatch.setattr(piece_bpe, "KEEP_PAIRS", 10)
    encoder = piece_bpe.PieceEncoder(PIECE_FILE)
    text = "some words that do not fit and then some words again\nmore of them"
    assert encoder.encoded(text) == encoder.library.encode(text) and len(encoder.known) <= 3


def test_encode_decode(docs, rows, empty):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_FILE)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = Counter()
    for r in rows:
        ids = library.encode(r[1] or "")
        want[r[0], len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))] += 1
    assert Counter(tuple(r) for r in piece_bpe.encode_decode(docs, PIECE_FILE).collect()) == want
    assert {tuple(r.ids) for r in piece_bpe.encode(docs, PIECE_FILE).collect()} == {tuple(library.encode(r[1] or "")) for r in rows}
    assert piece_bpe.encode_decode(empty, PIECE_FILE).count() == 0


@pytest.mark.parametrize("length", [4096, 64])
def test_packing(docs, rows, empty, length):
    library = Tokenizer.from_file(WORD_FILE)
    got = packing.pack(docs, WORD_FILE, length=length).collect()
    line = {(r.sequence_id * length + r.offset): r for r in got}
    at, taken = 0, []
    while at in line:  # gapless
        taken.append(line[at])
        at += line[at].length
    assert len(taken) == len(got) and all(r.offset + r.length <= length for r in got)
    docs_seen, i = Counter(), 0
    while i < len(taken):
        first = taken[i]
        assert first.start == 0
        parts, n = [], 0
        while n < first.doc_tokens:
            assert taken[i].start == n and taken[i].doc_id == first.doc_id
            parts.append((taken[i].length, taken[i].ids_crc32))
            n += taken[i].length
            i += 1
        docs_seen[first.doc_id, first.doc_tokens, tuple(parts)] += 1
    by_id = defaultdict(list)
    for r in rows:
        by_id[r[0]].append([*library.encode(r[1] or "", add_special_tokens=False).ids, 2])
    for (doc_id, n, parts), _ in docs_seen.items():
        for ids in by_id[doc_id]:
            cut, ok = 0, len(ids) == n
            for size, crc in parts:
                ok = ok and zlib.crc32(np.array(ids[cut : cut + size], "<u4").tobytes()) == crc
                cut += size
            if ok:
                break
        assert ok
    assert sum(docs_seen.values()) == len(rows)
    assert packing.pack(empty, WORD_FILE).count() == 0


SHAPES = [("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 12), ("access", re.compile("AKIA[A-Z0-9]+"), 0, 18), ("hex", re.compile("[0-9a-f]+"), 0, 16)]


def base_spans(text):
    found = [(m.start(), k, m.end()) for k, (_, p, g, n) in enumerate(SHAPES) for m in p.finditer(text) if len(m.group(g)) >= n]
    return sorted(found)


def test_secret_scan(spark, docs, rows, empty):
    extra = [(i, t) for i, t in enumerate(["password: secret: abcdefghijklmnop", "AKIA12AKIA" + "Z" * 15, "api-key=1234567890123 API_KEY='Abc/def+ghi==x'", "0123456789abcdef" * 3 + "é0123456789abcdef", "x 0123456789abcde y", "token=" * 30 + "abc", ("secret=abcdefghijkl1 " * 700)])]
    df = spark.createDataFrame([(i, t, "o") for i, t in extra], "doc_id long, text string, source string")
    for table, given_rows in ((docs, rows), (df, extra)):
        want = Counter()
        for r in given_rows:
            spans = base_spans(r[1] or "")
            counts = [sum(k == n for _, k, _ in spans) for n in range(3)]
            want[r[0], *counts, hashlib.sha256(",".join(f"{SHAPES[k][0]}:{a}:{b}" for a, k, b in spans).encode()).hexdigest()] += 1
        got = secret_scan.secret_scan(table).collect()
        assert Counter((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got) == want
    assert secret_scan.secret_scan(empty).count() == 0


def test_ownership_divides_copied_from_live(spark):
    copied, live = "AbCdEfGhIjKlMnOpQr0123", "zYxWvUtSrQpOnMlKj98765"
    rows = [(i, f"see {copied} here", f"owner{i}") for i in range(10)] + [(99, f"see {live} here", "owner1")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r.spans for r in secret_scan.secret_scan(df).collect()}
    assert got[99] == f"live:4:{4 + len(live)}" and all(got[i] == "" for i in range(10))
    clean = {r.doc_id: r.text for r in secret_scan.redact_secrets(df).collect()}
    assert clean[99] == "see [SECRET] here" and clean[3] == rows[3][1]


def test_repositories_of_one_owner_count(spark):
    """A value that one owner has in 1000 repositories is an example; one in 3 of them looks live."""
    copied, live = "AbCdEfGhIjKlMnOpQr0123", "zYxWvUtSrQpOnMlKj98765"
    rows = [(i, f"see {copied} here", "owner") for i in range(1000)] + [(2000 + i % 3, f"see {live} here", "owner") for i in range(30)]
    got = secret_scan.secret_scan(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert Counter((r.spans, r.most_owners, r.most_repos) for r in got) == {("", 1, 1000): 1000, (f"live:4:{4 + len(live)}", 1, 3): 30}


def test_many_candidates_and_base_spans_in_one_text(spark):
    """Candidates that overlap base spans in any way go, in time that does not multiply their numbers."""
    parts = ["token=" + "Ab1" * 8, "Zz9_" * 6 + str(1), "x0123456789abcdef0123456789abcdefQ", "AKIA" + "B2" * 9, "pure" * 7]
    text = " ".join(parts[i % 5] + str(i) for i in range(20000))
    began = time.time()
    (r,) = secret_scan.scan(spark.createDataFrame([(1, text, "o")], "doc_id long, text string, source string")).select(F.transform("more", lambda x: F.struct(x["start"], x["end"])).alias("more")).collect()
    base = base_spans(text)
    want, at, reach = [], 0, 0
    for m in re.finditer(r"[A-Za-z0-9+/_-]{20,}", text):
        while at < len(base) and base[at][0] < m.end():
            reach, at = max(reach, base[at][2]), at + 1
        if re.search("[0-9]", m[0]) and re.search("[A-Za-z]", m[0]) and reach <= m.start():
            want.append((m.start(), m.end()))
    assert [tuple(x) for x in r.more] == want and len(want) > 4000
    assert time.time() - began < 60


def test_redaction(docs, rows):
    out = secret_scan.redact_secrets(docs)
    assert out.columns == docs.columns and out.schema["n_chars"] == docs.schema["n_chars"] and out.count() == len(rows)
    for r in out.collect():
        assert not base_spans(r.text or "")
        if r.text and "[SECRET]" in r.text:
            assert r.n_chars == len(r.text)
    untouched = {(r[0], r[1], r[4]) for r in rows if r[0] not in (11, 14, 15)}
    assert untouched <= {(r.doc_id, r.text, r.n_chars) for r in out.collect()}


def kept_share(grams):
    """Good-Turing: the share of a count that stays."""
    n = Counter(grams.values())
    for k in range(5, 0, -1):
        common = (k + 1) * n[k + 1] / n[1] if n[1] else 1
        if all(n[r] for r in range(1, k + 2)) and common < 1:
            shares = [((r + 1) * n[r + 1] / (r * n[r]) - common) / (1 - common) for r in range(1, k + 1)]
            if all(0 < x <= 1 for x in shares):
                return lambda c: shares[c - 1] if c <= k else 1.0
    return lambda c: 0.5 if c == 1 else 1.0


class Katz:
    """Katz backoff by dictionaries."""

    def __init__(self, texts, train, order):
        self.order, self.seqs = order, [[b" "] * (order - 1) + [*t.encode().lower().split(), b" "] for t in texts]
        self.counts = [Counter() for _ in range(order)]
        for s, t in zip(self.seqs, train, strict=True):
            for i in range(order - 1, len(s)) if t else ():
                for k in range(order):
                    self.counts[k][tuple(s[i - k : i + 1])] += 1
        self.share = [kept_share(c) for c in self.counts]
        self.after = [defaultdict(dict) for _ in range(order)]
        for k, grams in enumerate(self.counts):
            for g, c in grams.items():
                self.after[k][g[:-1]][g[-1]] = c
        self.n, self.v, self.memo = sum(self.counts[0].values()), len(self.counts[0]), {}

    def p(self, context, w):
        k = len(context)
        seen = self.after[k].get(context)
        if not seen:
            return self.p(context[1:], w) if k else 1.0
        if (context, w) not in self.memo:
            total = sum(seen.values())
            lost = sum(c - self.share[k](c) * c for c in seen.values())
            if lost < 1e-9:
                total, lost = total + 1, 1
                kept = seen.get(w, 0)
            else:
                kept = self.share[k](seen.get(w, 1)) * seen.get(w, 0)
            less = 1.0 if not k else self.p(context[1:], w) / (1 - sum(self.p(context[1:], x) for x in seen)) if w not in seen else 0
            self.memo[context, w] = kept / total if w in seen else lost / total * less
        return self.memo[context, w]

    def scores(self):
        o = self.order - 1
        for s in self.seqs:
            uni = [self.counts[0].get((w,), 0) for w in s[o:]]
            yield len(uni), sum(c > 0 for c in uni), self.n, sum(math.log10((c + 0.1) / (self.n + 0.1 * (self.v + 1))) for c in uni), sum(math.log10(self.p(tuple(s[i - o : i]), s[i])) for i in range(o, len(s)))


def in_training(rows):
    return [zlib.crc32(("null" if r[0] is None else str(r[0])).encode()) % 10 != 0 for r in rows]


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_katz(docs, rows, empty, monkeypatch, order):
    monkeypatch.setattr(katz_lm, "CODED_BYTES", 2000)
    train = in_training(rows)
    want = defaultdict(list)
    for r, t, w in zip(rows, train, Katz([r[1] or "" for r in rows], train, order).scores(), strict=True):
        want[r[0]].append((not t, *w[:3], round(w[3], 6), round(w[4], 6)))
    got = defaultdict(list)
    for r in katz_lm.score_texts(docs, order=order).collect():
        got[r.doc_id].append((r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    if order == 3:
        assert katz_lm.score_texts(empty).count() == 0


def test_katz_tables_score_other_texts(spark, docs, rows, monkeypatch, tmp_path):
    """A stored model scores as the corpus that it comes from does, and its tables have every n-gram and context."""
    monkeypatch.setattr(katz_lm, "CODED_BYTES", 3000)
    train = in_training(rows)
    model = Katz([r[1] or "" for r in rows], train, 3)
    held = [(i, r[1]) for i, (r, t) in enumerate(zip(rows, train, strict=True)) if not t]
    known = spark.createDataFrame([(r[0], r[1]) for r, t in zip(rows, train, strict=True) if t], "doc_id long, text string").repartition(3)
    katz_lm.fit(known, str(tmp_path / "model"))
    got = {r.doc_id: (r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in katz_lm.score_with(spark.createDataFrame(held, "doc_id long, text string"), str(tmp_path / "model")).collect()}
    want = [(*w[:3], round(w[3], 6), round(w[4], 6)) for w in model.scores()]
    assert got == {i: want[i] for i, _ in held}
    sizes = {(r.order, r.context): r["count"] for r in katz_lm.model_of(spark, str(tmp_path / "model")).groupBy("order", "context").count().collect()}
    assert sizes == {(k + 1, False): len(c) for k, c in enumerate(model.counts)} | {(k + 1, True): len(model.after[k]) for k in (1, 2)}


def test_katz_probabilities_add_up(rows):
    model = Katz([r[1] or "" for r in rows], [True] * len(rows), 3)
    words = [w for w, in model.counts[0]]
    for context in [g for g in model.counts[1]][:25] + [(b" ", b" "), (b"never", b"seen"), (b"never", words[3])]:
        assert abs(sum(model.p(context, w) for w in [*words, b"\xff"]) - 1) < 1e-9


@pytest.mark.parametrize("query", ["op2", "op3"])
def test_few_buckets_and_no_table_left(spark, rows, query, monkeypatch):
    df = spark.createDataFrame([(r[0], r[1]) for r in rows], "doc_id long, text string").repartition(40)
    spark.conf.set("spark.sql.sources.bucketing.maxBuckets", "4")
    try:
        run = katz_lm.score_texts if query == "op2" else repeated_spans.repeated_spans
        assert run(df).count() == len(rows)
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.maxBuckets")
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("fw_")]


def test_discounts_of_few_counts():
    for n in ([0] * 7, [0, 3, 0, 0, 0, 0, 0], [0, 0, 5, 0, 0, 0, 0], [0, 100, 40, 20, 12, 8, 5]):
        kept = katz_lm.Discounts(np.array(n))(np.arange(1, 9))
        assert (kept > 0).all() and (kept <= np.arange(1, 9)).all()


def test_quality(spark, docs, rows, empty, prose_of):
    good = [(i, prose_of(i, 80), 1) for i in range(240)]
    bad = [(1000 + i, " ".join(w.upper() + "!!" for w in prose_of(i, 80).split()), 0) for i in range(120)]
    every = spark.createDataFrame([(i, t, "x") for i, t, _ in good + bad], "doc_id long, text string, quality string")
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in good + bad] + [(None, 1, 0), (5, None, 0), (7, 1, 1)], "doc_id long, quality int, toxic int")
    scored = quality.classify(every, labels).collect()
    held = [r for r in scored if r.held_out]
    assert len(scored) == 360 and held and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in scored)
    assert np.mean([(r.predicted == 1) == (r.doc_id < 1000) for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in scored)
    odd = quality.classify(docs, labels).collect()
    assert len(odd) == len(rows)
    kept = quality.keep_good(every, labels)
    assert kept.columns == every.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in scored if r.predicted}
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality.classify(docs, none).collect()} == {0.5}
    assert quality.classify(empty, none).count() == 0 and quality.classify(empty, labels).count() == 0


def test_score_covers_whole_texts(prose_of):
    model = quality.fresh()
    texts = [prose_of(1, 20000).encode(), b"", b"x", "é".encode() * 300, prose_of(2, 90).encode()]
    together = quality.score(model, texts)
    assert np.allclose(together, [quality.score(model, [t])[0] for t in texts], atol=1e-5)
    changed = texts[0][:-400] + b"#" * 400
    assert quality.score(model, [changed])[0] != together[0]


def test_gradients():
    model = quality.fresh(3)
    r = np.random.default_rng(0)
    texts, y = [bytes(r.integers(32, 127, n).astype(np.uint8)) for n in (30, 700, 1500)], np.array([1, 0, 1], np.float32)
    loss = lambda: -np.mean(np.log(np.where(y == 1, p := quality.score(model, texts), 1 - p)))
    g = quality.gradients(model, texts, y)
    for name in ("filters", "w1", "w2", "b1", "bias", "embed"):
        i = np.unravel_index(np.abs(g[name]).argmax(), g[name].shape)
        old = model[name][i]
        model[name][i] = old + 3e-3
        up = loss()
        model[name][i] = old - 3e-3
        down = loss()
        model[name][i] = old
        assert abs((up - down) / 6e-3 - g[name][i]) < 0.1 * abs(g[name][i]) + 1e-3, name


def plain_score(model, text):
    """The network by loops: filters at every second byte, their maxima in chunks of 8 cells of 64 bytes, 7 apart."""
    n_cells = (len(text) + quality.WIDTH + quality.CELL - 1) // quality.CELL
    line = [quality.PAD] * quality.WIDTH + list(text) + [quality.PAD] * (n_cells * quality.CELL - len(text))
    at = {}
    for i in range(0, n_cells * quality.CELL, quality.STEP):
        seen = np.concatenate([model["embed"][b] for b in line[i : i + quality.WIDTH]]).astype(float)
        at.setdefault(i // quality.CELL, []).append(seen @ model["filters"].astype(float) + model["bias"])
    cells = [np.max(at[c], axis=0) for c in range(n_cells)]
    firsts = range(0, max(1, n_cells - 1), quality.STRIDE)
    chunks = np.maximum(0, [np.max(cells[f : f + quality.CHUNK], axis=0) for f in firsts])
    v = np.concatenate([chunks.max(0), chunks.mean(0), chunks.min(0)])
    hidden = np.maximum(0, v @ model["w1"].astype(float) + model["b1"])
    return 1 / (1 + math.exp(-(hidden @ model["w2"].astype(float) + model["b2"][0])))


def test_score_as_by_loops(prose_of):
    model = quality.fresh(11)
    model["bias"] += np.random.default_rng(1).standard_normal(quality.FILTERS).astype(np.float32) / 5
    texts = [b"", b"a", b"x" * 64, prose_of(1, 8).encode(), prose_of(2, 90).encode(), "Gr\u00fc\u00dfe \u65e5\u672c ".encode() * 90, prose_of(3, 700).encode()]
    assert np.allclose(quality.score(model, texts), [plain_score(model, t) for t in texts], atol=1e-4)


def test_sample_is_of_labels_that_the_table_has(spark, prose_of):
    """Two million labels of other ids do not use up the sample, and windows reach the end of long texts."""
    good = [(i, prose_of(i, 60), 1) for i in range(200)]
    bad = [(1000 + i, " ".join(w.upper() + "!!" for w in prose_of(i, 60).split()), 0) for i in range(100)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in good + bad], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in good + bad], "doc_id long, quality int").unionByName(spark.range(10_000, 2_010_000).selectExpr("id as doc_id", "cast(id % 2 as int) as quality"))
    right = [(r.predicted == 1) == (r.doc_id < 1000) for r in quality.classify(docs, labels).collect()]
    assert len(right) == 300 and np.mean(right) > 0.95
    long = spark.createDataFrame([(1, "a" * 100_000 + "b" * 100_000)], "doc_id long, text string")
    cut, _ = quality.labelled_sample(long, spark.createDataFrame([(1, 1)], "doc_id long, quality int"), "doc_id", "text", 10, 5, 6144, 8)
    assert len(cut[0]) == 8 and {len(w) for w in cut[0]} == {6144} and any(b"b" in w for w in cut[0])


def test_very_long_texts(spark, prose_of):
    """Texts far longer than a block or a piece are worked on whole by every operator, beside a short one."""
    long = prose_of(77, 150_000)
    texts = [long, "short one", long.replace(" ", "  ", 1)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    counts = {i: len(t.split()) + 1 for i, t in enumerate(texts)}
    assert {r.doc_id: r.n_tokens for r in katz_lm.score_texts(df).collect()} == counts
    tokenizer = Tokenizer.from_file(WORD_FILE)
    want = {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in enumerate(texts)}
    pieces = packing.pack(df, WORD_FILE).collect()
    assert {i: sum(r.length for r in pieces if r.doc_id == i) for i in want} == want and all(r.length <= 4096 for r in pieces)
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = {r.doc_id: r.ids_sha256 for r in piece_bpe.encode_decode(df, public_tokenizers.path("piece_bpe_32k.model")).collect()}
    assert got == {i: hashlib.sha256(",".join(map(str, library.encode(t))).encode()).hexdigest() for i, t in enumerate(texts)}
    groups = {r.doc_id: (r.keep_id, r.group_size, r.text_sha256) for r in exact_dedup(df).collect()}
    assert groups[0] == groups[2] == (0, 2, hashlib.sha256(long.encode()).hexdigest()) and groups[1][:2] == (1, 1)
    spans = {r.doc_id: (r.n_bytes, sum(x.end - x.start for x in r.spans)) for r in repeated_spans.repeated_spans(df, with_text=False).collect()}
    assert spans[1] == (9, 0) and all(spans[i][0] == len(texts[i]) and spans[i][1] >= len(texts[i]) - 1 - len(long.split(" ", 1)[0]) for i in (0, 2))
    prints = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash_dedup(df).collect()}
    words = long.lower().split()
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]), 42) for i in range(len(words) - 2)]
    bits = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert prints[0] == prints[2] == (f"{bits:016x}", 0) and prints[1][1] == 1
