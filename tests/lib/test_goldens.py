"""Hand goldens and scalar specifications of the library's operators."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folioworks.functions import models, scalar
from folioworks.functions import text as X
from folioworks.operators import chunkers, guided, search, sections, semantic, stats
from folioworks.sources import scratch

T = "Alpha beta gamma delta. Epsilon zeta eta theta.\n\nIota kappa lambda mu nu xi. Omicron pi rho sigma tau upsilon phi chi psi omega.\nLast line here."
P = "Paragraph one has forty characters here..\n\nParagraph two has forty characters here..\n\nParagraph three also has forty characters.\n\nLong first sentence that keeps going for a while now. Second sentence that is also quite long indeed. Third one ends."


def test_fixed():
    assert scalar.fixed_chunks(T, 10) == ["Alpha beta gamma delta. Epsilon zeta ", "eta theta.\n\nIota kappa lambda mu nu xi. ", "Omicron pi rho sigma tau upsilon phi ", "chi psi omega.\nLast line here."]
    assert scalar.fixed_chunks(T, 10, 3) == ["Alpha beta gamma delta. Epsilon zeta ", "zeta eta theta.\n\nIota kappa lambda mu ", "lambda mu nu xi. Omicron pi rho sigma ", "rho sigma tau upsilon phi chi psi ", "chi psi omega.\nLast line here."]
    with pytest.raises(ValueError):
        scalar.fixed_chunks(T, 10, 10)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab \n.", max_size=400), st.integers(1, 20))
def test_fixed_parts_join_to_the_text(text, size):
    assert "".join(scalar.fixed_chunks(text, size)) == text
    assert all(scalar.fixed_chunks(text, size, size - 1)) or not text


def test_recursive():
    plain = ["Alpha beta gamma delta", ". Epsilon zeta eta theta.", "Iota kappa lambda mu nu xi", ". Omicron pi rho sigma tau upsilon phi", "chi psi omega", ".", "Last line here."]
    assert scalar.recursive_chunks(T, 8) == plain
    assert scalar.recursive_chunks(T, 8, 4) == [*plain[:4], "tau upsilon phi chi psi omega", *plain[5:]]
    assert len(scalar.recursive_chunks(" ".join("abcdefghijklmnop"), 2)) == 1
    assert scalar.recursive_chunks("", 8) == []


def test_overlap_prefix(spark):
    rows = spark.createDataFrame([(0, 0, "The quick brown fox jumps over the lazy dog again"), (0, 1, "Second chunk"), (0, 2, "Third")], "doc_id long, chunk_no int, chunk string")
    got = [r.chunk for r in chunkers.overlap_prefix(rows, 5).orderBy("chunk_no").collect()]
    assert got == ["The quick brown fox jumps over the lazy dog again", "the lazy dog again Second chunk", "Third"]


def test_packed_sections(spark):
    p = P.split("\n\n")
    s = re.split(r"(?<=[.])\s+", p[3])
    head = "## T\n\n"
    want = [head + p[0] + "\n\n" + p[1], head + p[1] + "\n\n" + p[2], head + s[0], head + s[1] + " " + s[2]]
    assert scalar.packed("## T", P, 24, True, False) == want
    section = spark.createDataFrame([(1, 0, 2, "T", None, P)], "doc_id long, section_no int, level int, title string, parent string, content string")
    got = chunkers.context_md_chunks(section, 24).orderBy("chunk_no").collect()
    assert [r.chunk for r in got] == want and [r.chunk_part for r in got] == [1, 2, 3, 4] and all(r.is_split for r in got)


def test_spacing(spark):
    rows = spark.createDataFrame([("wordWord end.Start 2024Digital version2 Beta",), ("abc123Def",), (None,), ("",)], "t string")
    assert [r[0] for r in rows.select(X.fix_text_spacing(F.col("t"))).collect()] == ["word Word end. Start 2024 Digital version 2 Beta", "abc 123 Def", None, ""]


def test_md_sections(spark):
    text = "intro\nx\n## A\ntext a\n### A1\ntext a1\n#### deep\ny\n### A2\n## B\n### B1\nb1"
    docs = spark.createDataFrame([(1, text), (2, None), (3, ""), (4, "##\nno title\n## \n"), (5, "## T\r\nbody\r\n")], "doc_id long, text string")
    got = [tuple(r)[2:] for r in sections.md_sections(docs).where("doc_id = 1").orderBy("section_no").collect()]
    assert got == [(0, "Document Header", None, "intro\nx"), (2, "A", None, "text a"), (3, "A1", "A", "text a1\n#### deep\ny"), (3, "B1", "B", "b1")]
    assert [(r.title, r.content) for r in sections.md_sections(docs).where("doc_id = 5").collect()] == [("T", "body")]
    assert [r.content for r in sections.md_sections(docs).where("doc_id = 4").collect()] == ["##\nno title\n##"]


def test_pdf_sections(spark):
    opening = "o" * 73
    pages = [(1, 1, f"{opening}\n01. Scope of the policy\n{'x' * 60}"), (1, 2, f"DATA GOVERNANCE RULES\n{'y' * 60}\n3) Tiny\nz"), (2, 1, None)]
    docs = sections.pages_text(spark.createDataFrame(pages, "doc_id long, page_no int, text string"))
    got = [(r.title, r.page_start, len(r.content)) for r in sections.pdf_sections(docs).orderBy("section_no").collect()]
    assert got == [("Document Start", 1, 73), ("01. Scope of the policy", 2, 60), ("DATA GOVERNANCE RULES", 3, 70)]
    assert [r.true_page for r in sections.pdf_sections(docs).orderBy("section_no").collect()] == [1, 1, 2]


@pytest.mark.parametrize("distances, cuts, want", [([0.1, 0.6, 0.2, 0.61, 0.05], 1, 0.5999994277954102), ([0.1, 0.6, 0.2, 0.61, 0.05], 2, 0.19999980926513672), ([1.2, 1.3, 0.1], 1, 0.9999990463256836)])
def test_threshold(spark, distances, cuts, want):
    row = spark.createDataFrame([(distances,)], "d array<double>").select(semantic.bisected(F.col("d"), F.lit(cuts))).first()
    assert row[0] == want


def by_hand_segments(v, most):
    """The segmentation by all pairs."""
    v = scalar.unit(np.asarray(v, float))
    m, n = v @ v.T, len(v)
    m = m - (m[np.triu_indices(n, 1)].mean() if n > 1 else 0)
    np.fill_diagonal(m, 0)
    best, start = np.zeros(n), np.zeros(n, int)
    for i in range(n):
        for first in range(i, max(-1, i - most), -1):
            gain = m[first : i + 1, first : i + 1].sum() + (best[first - 1] if first else 0)
            if gain > best[i] + 1e-12:
                best[i], start[i] = gain, first
    out, i = [], n - 1
    while i >= 0:
        out.append((int(start[i]), i))
        i = start[i] - 1
    return out[::-1]


def test_segments():
    assert scalar.segments(np.eye(12), 3) == [(0, 11)]
    assert scalar.segments(np.eye(12), 3, enforce=True) == [(i, i) for i in range(12)]
    rng = np.random.default_rng(5)
    for n in (1, 2, 9, 40):
        v = np.repeat(rng.standard_normal((n // 3 + 1, 6)), 3, axis=0)[:n] + rng.standard_normal((n, 6)) / 4
        assert scalar.segments(v, 4) == by_hand_segments(v, 4)


@pytest.mark.parametrize("reply, want", [("split_after: 2, 5", [2, 5]), ("split_after: none", []), ("Split_After: 2", []), ("split_after: 7, 9, x, -1", []), ("ok\nsplit_after: 6", [6]), ("no marker 3", []), ("split_after: 5, 2", [5, 2])])
def test_replies(spark, reply, want):
    assert spark.createDataFrame([(reply,)], "r string").select(X.section_splits(F.col("r"), F.lit(8))).first()[0] == want


def test_text_replies(spark):
    rows = spark.createDataFrame([("split_after: 3, 5",), ("5 then 3",), ("4 and 6",), ("none",), ("1, 2",)], "r string")
    assert [r[0] for r in rows.select(X.text_splits(F.col("r"), F.lit(2))).collect()] == [[3, 5], None, [4, 6], None, None]


def test_apply_splits(spark):
    row = spark.createDataFrame([([f"s{i}" for i in range(6)],)], "s array<string>")
    cut = lambda inclusive: [p.text for p in row.select(guided.apply_splits(F.col("s"), F.array(F.lit(2), F.lit(4)), inclusive)).first()[0]]
    assert cut(False) == ["s0 s1", "s2 s3", "s4 s5"] and cut(True) == ["s0 s1 s2", "s3 s4", "s5"]


class Says:
    def __init__(self, *replies):
        self.replies, self.prompts = list(replies), []

    def reply(self, prompt):
        self.prompts.append(prompt)
        r = self.replies.pop(0) if self.replies else "nothing"
        if isinstance(r, Exception):
            raise r
        return r


def test_cut_points_always_end():
    pieces = ["word " * 40] * 30
    assert guided.cut_points(pieces, Says()) == []
    assert guided.cut_points(pieces, Says("split_after: 3, 7", ValueError("x"), "0", "split_after: 7", "split_after: 14")) == [3, 7, 14]


def test_guided_decisions(spark):
    rows = [(1, 0, 2, "T", None, " ".join(f"Sentence number {i} has some words." for i in range(8))), (1, 1, 2, "U", None, "Only one sentence in here, but it is long enough to stay."), (1, 2, 3, "V", "T", " ".join(f"N {i}." for i in range(6)))]
    table = spark.createDataFrame(rows, "doc_id long, section_no int, level int, title string, parent string, content string")
    got = guided.guided_md_chunks(table, models.EveryNth(3)).orderBy("chunk_no").collect()
    assert [(r.title, r.chunk_part, r.split_by_llm, r.llm_decision) for r in got] == [("T", 1, True, None), ("T", 2, True, None), ("T", 3, True, None), ("U", None, False, None)] or got[-1].llm_decision == "fallback"
    none = guided.guided_md_chunks(table, Always("split_after: none")).collect()
    assert {r.llm_decision for r in none if r.section_no == 0} == {"no_split_needed"}


class Always:
    def __init__(self, text):
        self.text = text

    def reply(self, prompt):
        return self.text


def test_oversized(spark):
    big = "\n\n".join("word " * 160 for _ in range(8))
    rows = [(1, 0, "## H\n\n" + big), (1, 1, "short"), (2, 0, "é" * 7001), (2, 1, "a" * 14000), (3, 0, "x" * 3203), (3, 1, "x" * 3204)]
    got = chunkers.split_oversized(spark.createDataFrame(rows, "doc_id long, chunk_no int, chunk string"), F.lit("## H"))
    first = [r for r in got.orderBy("chunk_no").collect() if r.doc_id == 1]
    assert [r.split_reason for r in first[-1:]] == [None] and first[0].sub_chunk_part == 1 and all(r.chunk.startswith("## H\n\n") for r in first[:-1])
    assert sum(r.chunk.count("word") for r in first) == 8 * 160
    assert {(r.doc_id, r.split_reason) for r in got.collect() if r.doc_id > 1} == {(2, "size_exceeded"), (3, None), (3, "size_exceeded")}


def test_fusion(spark):
    words = spark.createDataFrame([(0, "a", 4.0, 1), (0, "b", 1.0, 2), (0, "c", 0.5, 3), (0, "z", 0.0, 4)], "query_id int, doc_key string, score double, rank int")
    near = spark.createDataFrame([(0, "b", 0.1, 1), (0, "d", 0.3, 2), (0, "a", 0.9, 3)], "query_id int, doc_key string, distance double, rank int")
    got = {r.doc_key: round(r.score, 6) for r in search.fused(words, near).collect()}
    assert got == {"b": 0.056848, "a": 0.04918, "d": 0.016129, "c": 0.015873}
    assert search.fused(words.limit(0), near.limit(0)).count() == 0


def test_keyword_search_fills_up(spark):
    docs = spark.createDataFrame([(1, "red fish"), (2, "blue fish"), (3, None), (4, ""), (5, "كتاب جديد")], "doc_id long, text string")
    asked = spark.createDataFrame([(0, "red"), (1, "nothing"), (2, "كتاب")], "query_id int, text string")
    got = {(r.query_id, r["rank"]): (r.doc, r.score > 0) for r in search.keyword_search(search.keyword_index(docs), asked, 3).collect()}
    assert got[0, 1] == (1, True) and got[0, 2] == (2, False) and got[1, 1] == (1, False) and got[2, 1] == (5, True) and len(got) == 9


def brute_bm25(docs, asked):
    """Scores of all documents (rows of an id are one) for each query, in order of rank."""
    words = lambda t: re.findall(r"\w+", (t or "").lower())
    each, length = {}, {}
    for i, t in docs:
        each[i] = each.get(i, []) + words(t)
        length[i] = max(length.get(i, 0), len(words(t)))
    n, mean = len(docs), sum(len(words(t)) for _, t in docs) / len([t for _, t in docs])
    df = Counter(w for ws in each.values() for w in set(ws))
    raw = {w: math.log(n - k + 0.5) - math.log(k + 0.5) for w, k in df.items()}
    idf = {w: 0.25 * sum(raw.values()) / len(raw) if x < 0 else x for w, x in raw.items()}
    part = lambda w, i: idf[w] * each[i].count(w) * 2.5 / (each[i].count(w) + 1.5 * (0.25 + 0.75 * length[i] / mean))
    scores = {q: {i: sum(part(w, i) for w in words(t) if w in each[i]) for i in each} for q, t in asked}
    return {q: sorted(s.items(), key=lambda x: (-round(x[1], 9), x[0])) for q, s in scores.items()}


@pytest.mark.parametrize("small_side", [32 << 20, 0])
def test_keyword_search_writes_no_row_for_each_pair(spark, monkeypatch, small_side):
    """The n best of many documents with a common word, as by brute force, without a table of all their scores."""
    rng, sizes = np.random.default_rng(3), {}
    word = lambda: f"w{int(rng.zipf(1.4)) % 60}"
    docs = [(f"d{i}", "common " + " ".join(word() for _ in range(rng.integers(0, 12)))) for i in range(300)]
    docs += [("d7", docs[7][1]), ("d8", docs[8][1]), ("e1", None), ("e2", ""), ("e3", "common " * 500)]
    asked = [(q, "common Common " + " ".join(word() for _ in range(5))) for q in range(30)] + [(98, ""), (99, "unheard")]
    keep = lambda df, name, **more: sizes.update({name: (out := scratch.written(df, name, **more)).count()}) or out
    monkeypatch.setattr(scratch, "SMALL_SIDE", small_side)
    monkeypatch.setattr(search, "written", keep)
    table = spark.createDataFrame(docs, "doc_id string, text string").repartition(5)
    found = search.keyword_search(search.keyword_index(table), spark.createDataFrame(asked, "query_id long, text string"), 12)
    got = {(r.query_id, r["rank"]): (r.doc, round(r.score, 9)) for r in found.collect()}
    want = {(q, k + 1): (i, round(s, 9)) for q, all_ in brute_bm25(docs, asked).items() for k, (i, s) in enumerate(all_[:12])}
    assert {k: i for k, (i, _) in got.items()} == {k: i for k, (i, _) in want.items()}
    assert all(abs(got[k][1] - want[k][1]) < 2e-9 for k in want)
    assert max(sizes.values()) < len(docs)


def test_vector_edges(spark):
    table = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [1.0, 0.0])], "vec_id long, embedding array<double>")
    asked = spark.createDataFrame([(0, [1.0, 0.0]), (1, None)], "query_id int, embedding array<double>")
    for metric, far in (("sql2", 1.0), ("cosine", 1.0)):
        got = [(r.id, r.distance) for r in search.vector_search(table, asked, 3, metric, block=1).orderBy("rank").collect()]
        assert got == [(1, 0.0), (4, 0.0), (2, far)]
    rows = [(0, i, d, i + 1) for i, d in enumerate([0.7, 0.8, 0.9, 1.0])] + [(1, 9, 0.69, 1), (1, 8, 0.7, 2)]
    near = spark.createDataFrame(rows, "query_id int, id int, distance double, rank int")
    assert {(r.query_id, r.id) for r in search.semantic_only(near).collect()} == {(0, 0), (0, 1), (0, 2), (1, 9)}


def test_keys_rotate():
    slept = []
    keys = models.KeyRotation(["a", "b", "c"], sleep=slept.append)

    def call(key):
        if key != "c":
            raise RuntimeError("429 quota exceeded")
        return key

    assert keys.run(call) == "c" and keys.failed == {"a", "b"} and keys.info() == {"position": 3, "keys": 3, "failed": 2}
    with pytest.raises(ZeroDivisionError):
        keys.run(lambda _: 1 / 0)
    with pytest.raises(models.AllKeysFailed):
        keys.run(lambda _: (_ for _ in ()).throw(RuntimeError("rate limit")))
    assert slept and not models.is_rate_limit(ValueError("could not generate"))
    assert models.shared_rotation(["x"]) is models.shared_rotation(["x"])
    with pytest.raises(ValueError):
        models.KeyRotation([])


class Fails:
    dimensions = 3

    def embed(self, texts):
        if any("bad" in t for t in texts):
            raise RuntimeError("no")
        return [[1.0, 0.0, 0.0]] * len(texts)


def test_embedding_failures_are_marked(spark):
    rows = spark.createDataFrame([("fine",), ("bad",), (None,)], "t string").select(models.embed(F.col("t"), Fails()).alias("e")).collect()
    assert [(list(r.e.embedding), r.e.embed_ok) for r in rows] == [([1, 0, 0], True), ([0, 0, 0], False), ([1, 0, 0], True)]
    one, two = models.HashingEmbedder(16).embed(["some words", "some words"])
    assert one == two and abs(sum(x * x for x in one) - 1) < 1e-9


def test_stats_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, chunk_no int, chunk string")
    assert tuple(stats.chunk_stats(none).first()) == (0, 0, None, None, None)
    assert tuple(stats.filter_stats(none).first()) == (0, 0, 0)


def test_filters(spark):
    rows = spark.createDataFrame([("a" * 49,), ("a" * 50,), (" " + "a" * 49 + " ",), ("--- Page 1 ---" + "a" * 60,), ("a" * 51,)], "chunk string")
    assert [len(r.chunk) for r in stats.filter_chunks(rows).collect()] == [50, 51]


def test_sql_functions(spark):
    chunkers.register_all(spark)
    spark.createDataFrame([(1, T)], "doc_id long, text string").createOrReplaceTempView("texts")
    assert [r.chunk for r in spark.sql("select chunk from texts, lateral chunk_fixed(text, 10)").collect()] == scalar.fixed_chunks(T, 10)
    assert [r.chunk for r in spark.sql("select chunk from texts, lateral chunk_recursive(text, 8)").collect()] == scalar.recursive_chunks(T, 8)
    assert spark.sql("select recursive_chunks(text, 8, 0) as c from texts").first().c == scalar.recursive_chunks(T, 8)
