from collections import defaultdict

import corpus_pipeline
from folioworks.llm import near_copies as nc
from folioworks.llm.simhash_dedup import simhash


def edited(text, *places):
    words = text.split()
    for p in places:
        words[p] = f"edit{p}"
    return " ".join(words)


def brute(rows, similarity=0.8):
    """Row to smallest id of its component, by all pairs."""
    sets = [set(nc.shingle_set((t or "").encode()).tolist()) for _, t in rows]
    prints = [simhash((t or "").encode(), 3) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a == b or len(a & b) >= similarity * len(a | b) - 1e-6 or (prints[i] ^ prints[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        groups[find(i)].append(doc_id)
    return sorted((doc_id, min((x for x in groups[find(i)] if x is not None), default=-1)) for i, (doc_id, _) in enumerate(rows) if doc_id is not None)


def test_the_stage_finds_planted_near_copies(spark, prose_of):
    base = [prose_of(700 + i, 100) for i in range(20)]
    rows = [(i, t) for i, t in enumerate(base)] + [(100 + i, edited(t, 30, 60)) for i, t in enumerate(base)]  # 0.81 in common
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(r.doc_id for r in corpus_pipeline.near_copies(spark, docs, "").collect()) == list(range(20))


def test_large_groups_lose_no_link(spark, docs, rows, prose_of):
    base = prose_of(900, 120)
    group = [(2000 + i, edited(base, *range(i % 7, 120, 11 + 7 * (i % 9)), i % 120)) for i in range(70)]
    every = [(r[0], r[1]) for r in rows] + group
    table = spark.createDataFrame(every, "doc_id long, text string").repartition(4)
    got = sorted((r.doc_id, -1 if r.component_id is None else r.component_id) for r in nc.near_groups(table, hot=3).collect() if r.doc_id is not None)
    want = brute(every)
    assert got == want and len({c for _, c in want if c >= 2000}) > 2
