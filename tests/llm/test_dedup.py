import hashlib
import pathlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from folioworks.llm.exact_dedup import digest_runs, exact_dedup, keep_one, merge_runs
from folioworks.llm.graph import components
from folioworks.llm.repeated_spans import repeated_spans
from folioworks.llm.simhash_dedup import one_of_each, simhash_dedup


def norm(text):
    return re.sub(r"[\x20\x09-\x0d]+", " ", text or "")


@pytest.mark.parametrize("fan_in", [2, 16])
def test_exact_dedup(docs, rows, fan_in):
    groups = defaultdict(list)
    for r in rows:
        groups[norm(r[1])].append(r[0])
    want = Counter()
    for r in rows:
        ids = [i for i in groups[norm(r[1])] if i is not None]
        want[r[0], min(ids, default=None), len(groups[norm(r[1])]), hashlib.sha256(norm(r[1]).encode()).hexdigest()] += 1
    got = exact_dedup(docs, fan_in=fan_in).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    kept = [r for r in got if r.kept]
    assert len(kept) == len(groups) and len({r.text_sha256 for r in kept}) == len(groups)
    assert all(r.doc_id == r.keep_id for r in kept)


def test_many_runs_merge(spark):
    df = spark.range(2000).selectExpr("id as doc_id", "concat('t', id % 7) as text").repartition(40)
    assert {(r["first"]["doc_id"], r.n) for r in merge_runs(digest_runs(df), 3).collect()} == {(i, len(range(i, 2000, 7))) for i in range(7)}


def test_keep_one_has_each_text_once(docs, rows):
    out = keep_one(docs, exact_dedup(docs))
    assert out.columns == docs.columns
    texts = [norm(r.text) for r in out.collect()]
    assert sorted(texts) == sorted({norm(r[1]) for r in rows})


def test_empty_tables(empty):
    assert exact_dedup(empty).count() == 0
    assert keep_one(empty, exact_dedup(empty)).count() == 0
    assert simhash_dedup(empty).count() == 0
    assert one_of_each(empty).count() == 0
    assert repeated_spans(empty).count() == 0


def fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    parts = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(prints, ids):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, d in enumerate(ids):
        least[find(i)].append(d)
    return [min((d for d in least[find(i)] if d is not None), default=None) for i in range(len(prints))], [find(i) for i in range(len(prints))]


@pytest.mark.parametrize("hot", [64, 1])
def test_simhash(docs, rows, hot):
    prints = [fingerprint(r[1]) for r in rows]
    least, _ = linked(prints, [r[0] for r in rows])
    want = Counter((r[0], f"{p:016x}", c) for r, p, c in zip(rows, prints, least, strict=True))
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in simhash_dedup(docs, hot=hot).collect()) == want


def test_near_fingerprints_link_by_either_way(spark):
    from folioworks.llm.simhash_dedup import links

    rng = np.random.default_rng(3)
    base = rng.integers(-(2**63), 2**63, 6)
    prints = set()
    for b in base.tolist():
        for _ in range(30):
            flips = rng.integers(0, 64, int(rng.integers(0, 4)))
            x = b & (2**64 - 1)
            for f in flips.tolist():
                x ^= 1 << f
            prints.add(x - 2**64 if x >= 2**63 else x)
    prints = sorted(prints)
    df = spark.createDataFrame([(p, p) for p in prints], "fp long, node long")
    _, roots = linked([p & (2**64 - 1) for p in prints], prints)
    same = {frozenset(p for p, r in zip(prints, roots, strict=True) if r == k) for k in roots}
    for hot in (1000, 2):
        found = defaultdict(set)
        for r in components(links(df, hot=hot)).collect():
            found[r.root].add(r.node)
        assert {frozenset(v) for v in found.values()} == {s for s in same if len(s) > 1}


def test_one_of_each(docs, rows):
    out = one_of_each(docs)
    assert out.columns == docs.columns
    prints = [fingerprint(r[1]) for r in rows]
    _, roots = linked(prints, [r[0] for r in rows])
    got = sorted(fingerprint(r.text) for r in out.collect())
    assert len(got) == len(set(roots))


def test_components_of_a_long_chain(spark):
    edges = spark.range(60).selectExpr("id as a", "id + 1 as b").unionByName(spark.createDataFrame([(100, 101), (101, 101), (200, 200)], "a long, b long"))
    got = {r.node: r.root for r in components(edges).collect()}
    assert all(got[i] == 0 for i in range(61)) and got[101] == 100 and got[200] == 200


def marked(texts, length):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    for t in texts:
        mark = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                mark[i : i + length] = True
        yield bytes(np.frombuffer(t, np.uint8)[~mark]), int(mark.sum())


@pytest.mark.parametrize("length", [200, 40])
def test_repeated_spans(docs, rows, length):
    texts = [(r[1] or "").encode() for r in rows]
    want = Counter((r[0], len(t), kept) for r, t, (kept, _) in zip(rows, texts, marked(texts, length), strict=True))
    got = repeated_spans(docs, length=length).collect()
    assert Counter((r.doc_id, r.n_bytes, bytes(r.kept)) for r in got) == want
    for r in got:
        assert hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256
        assert sum(s.end - s.start for s in r.spans) == r.n_bytes - len(r.kept)


def test_repeated_spans_in_shifted_contexts(spark, prose_of, monkeypatch):
    from folioworks.llm import repeated_spans as spans

    monkeypatch.setattr(spans, "BLOCK_BYTES", 3000)
    core = prose_of(1, 60)
    texts = [prose_of(10 + i, 10 + i)[: 7 * i] + core[i : 300 + i % 3] + prose_of(50 + i, 12) for i in range(25)] + ["é" * 150, "zé" + "é" * 150, "-" * 450, "=" * 201, "=" * 200]
    raw = [t.encode() for t in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: bytes(r.kept) for r in repeated_spans(df).collect()}
    assert [got[i] for i in range(len(raw))] == [k for k, _ in marked(raw, 200)]


def test_text_without_triggers_takes_little_memory(tmp_path):
    """16 MB of one byte: judged whole, within 40 bytes of memory for each of the text."""
    import subprocess
    import sys

    code = """
import resource, tracemalloc
import numpy as np
from folioworks.llm import repeated_spans as rs
def blocks(fill):
    text = bytes([fill]) * (16 << 20)
    row = {"home": 0, "seq": 0, "ids": [1], "sizes": [len(text)], "text": text, "answers": []}
    work = {rs.PHRASES: rs.twice_or_more, rs.SEGMENTS: rs.judge_segments, rs.STRINGS: rs.judge_strings}
    for name in ("ask_phrases", "ask_segments", "ask_strings"):
        asked = list(getattr(rs.Parsed(row, 200, 1), name)())
        for kind, part, home, seq, keys, more in asked:
            row["answers"].append({"kind": kind, "seq": 0, "part": part, "data": work[kind]([keys], [more])[0]})
    mark = rs.Parsed(row, 200, 1).covered()
    assert len(mark) == len(text) and mark.all()
blocks(45)
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss)
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300, cwd=str(pathlib.Path(__file__).parents[2]))
    assert not done.returncode, done.stderr
    assert int(done.stdout) * 1024 < 40 * (16 << 20) + (250 << 20)


def test_runs_are_no_triggers():
    from folioworks.llm import repeated_spans as rs

    for period in range(1, 9):
        for seed in range(40):
            text = bytes((seed * 31 + i * 7) % 256 for i in range(period)) * (900 // period)
            assert len(rs.triggers(text)) == 0
