import math
import re
import time
from collections import Counter
from fractions import Fraction
from itertools import combinations

import numpy as np
import pandas as pd
import pytest

from folioworks.llm import common
from folioworks.llm import topk_search as tk
from folioworks.llm.url_filter import RULES, url_filter


def brute(rows, k):
    """Counter of (query_id, rank, vec_id, score), in Python's integers; rows are told apart by place."""
    good = [(i, [math.floor(Fraction(float(x)) * 64) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for at, (q, qv) in enumerate(good):
        if q % 20 == 0:
            scored = sorted((-min(2**63 - 1, max(-(2**63), sum(a * b for a, b in zip(qv, v, strict=False)))), i) for place, (i, v) in enumerate(good) if place != at)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return Counter(out)


def found(df):
    return Counter(tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect())


@pytest.mark.parametrize("group, block, chunk", [(128, 256, 8), (3, 8, 2)])
def test_topk(spark, monkeypatch, group, block, chunk):
    monkeypatch.setattr(tk, "BLOCK", block)
    monkeypatch.setattr(tk, "SUMMARIES", 3)
    monkeypatch.setattr(tk, "PIECE", block // 2)
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in np.round(rng.standard_normal(8) / 4, 2)]) for i in range(200)]
    rows += [(i, rows[7][1]) for i in range(300, 380)]  # a very common vector: ties
    rows += [(500, None), (None, rows[1][1]), (501, [None] * 8), (502, [float("nan")] * 8), (503, [float("inf")] + [0.0] * 7), (504, [1.0, 2.0]), (520, []), (3, rows[3][1])]
    rows += [(40, rows[40][1])] * 2 + [(60, [float(x) for x in np.round(rng.standard_normal(8), 2)])] * 90  # ids of several rows, one of a third of all
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, score string").repartition(5)
    assert found(tk.topk_search(df, group=group, chunk=chunk)) == brute(rows, 20)


@pytest.mark.parametrize("top", [3e4, 1e6, 1e9, 1e17, 1e300, 1e308])
def test_topk_large_components(spark, monkeypatch, top):
    monkeypatch.setattr(tk, "BLOCK", 8)
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in top * rng.uniform(-1, 1, 6)]) for i in range(50)] + [(100, [1.0] * 6), (120, [0.01, -0.01, 0.5, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert found(tk.topk_search(df, group=2, chunk=1)) == brute(rows, 20)


def test_topk_of_the_contract(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [20000.0]), (2, [30000.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in tk.topk_search(df).orderBy("rank").collect()] == [(0, 1, 2, 122880000), (0, 2, 1, 81920000)]


def test_topk_few_and_none(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (20, [-1.0, 0.0])], "vec_id long, embedding array<float>")
    assert found(tk.topk_search(df)) == brute([(r.vec_id, list(r.embedding)) for r in df.collect()], 20)
    assert tk.topk_search(df.limit(0)).count() == 0


def test_only_the_result_stays(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(common, "scratch_dir", lambda _: f"file://{tmp_path}")
    df = spark.createDataFrame([(i, [float(i % 7), 1.0]) for i in range(600)], "vec_id long, embedding array<double>")
    assert tk.topk_search(df, group=1).count() == 600
    assert [p.name.rsplit("-", 1)[0] for p in tmp_path.iterdir()] == ["best-so-far"]


def test_later_rounds_get_fewer_blocks():
    """Blocks whose bound is below all k-th scores are not sent."""
    near, far = np.full((4, 2), 100, np.int8), np.full((4, 2), -100, np.int8)
    nothing = np.zeros(1, "<i8").tobytes()
    asked = pd.DataFrame([{"chunk": 0, "is_query": True, "no": 0, "n": 1, "dim": 2, "kind": "b", "ids": nothing, "rows": nothing, "mat": np.array([[1, 1]], np.int8).tobytes(), "floors": [{"q": 0, "floor": 50}]}])
    known = pd.DataFrame([{"chunk": 0, "is_query": False, "no": p, "n": 4, "dim": 2, "kind": "b", "tops": m.max(0).tobytes(), "lows": m.min(0).tobytes()} for p, m in ((1, near), (2, far))])
    assert tk.blocks_to_visit(pd.concat([asked, known])).no.tolist() == [1]


def url_parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    m = re.match(r"([^/?#]*)([^?#]*)", rest, re.S)
    return m[1].translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")), m[2]


def rule_of(host, path):
    fits = [(len(r), r, v) for r, v in RULES if (host == r.split("/", 1)[0] or host.endswith("." + r.split("/", 1)[0])) and path.startswith("/" + r.split("/", 1)[1])]
    return max(fits)[1:] if fits else (None, None)


URLS = [None, "", "no scheme", "http://", "http://A.EXAMPLE.NET/en/1?x=/de/#t", "https://example.net", "https://example.net/", "https://notexample.net/en/", "https://x.example.com/de/y", "https://example.com/dex", "http://a.org/fr/", "http://org/fr/z", "http://a.org?/fr/", "x://b.net/en/", "http://bücher.net/ü", "http://a.example.com/en/1://x/"]


def test_url_filter(spark):
    rows = [(i, u, "host") for i, u in enumerate(URLS)] + [(4, URLS[4], None), (None, URLS[8], None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, verdict string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    want = Counter()
    for i, u, _ in rows:
        h, p = url_parts(u)
        rule, verdict = rule_of(h, p)
        want[i, h, p, rule, verdict or "allow"] += 1
    got = url_filter(pages, labels)
    assert Counter(tuple(r)[:5] for r in got.collect()) == want
    assert url_filter(pages.limit(0), labels).count() == 0


def test_mined_rules_block(spark):
    bad = [(i, f"https://spam{i % 3}.casino.example.org/en/{i}", 0) for i in range(40)]
    good = [(100 + i, f"https://site{i % 9}.example.org/en/{i}", 1) for i in range(80)]
    pages = spark.createDataFrame([(i, u) for i, u, _ in bad + good] + [(999, "https://new.casino.example.org/de/5"), (998, "https://new.example.org/de/5")], "page_id long, url string")
    labels = spark.createDataFrame([(i, q, None) for i, _, q in bad + good] + [(None, 0, 0), (3, None, 1)], "doc_id long, quality int, toxic int")
    got = {r.page_id: r.verdict for r in url_filter(pages, labels).collect()}
    assert got[999] == "block" and got[998] == "allow"
    assert all(got[i] == "block" for i, *_ in bad) and all(got[i] == "allow" for i, *_ in good)


def tokens_of(url):
    host, path = url_parts(url)
    query = re.search(r"\?([^#]*)", url or "")
    parts = [("host:", x) for x in host.split(".")] + [("path:", x) for x in path.split("/")] + [("query:", x) for x in (query[1] if query else "").split("&")]
    return frozenset(k + re.sub(r"\d+", "#", x) for k, x in parts if x)


def brute_rules(urls, bad, least, confidence=0.6, ratio=1.5):
    """All token combinations of labelled pages that are sure enough, the smallest only."""
    pages = [(tokens_of(u), b) for u, b in zip(urls, bad, strict=True)]
    share = sum(not b for b in bad) / len(bad)
    seen = {frozenset(c) for t, b in pages if b for n in range(1, len(t) + 1) for c in combinations(sorted(t), n)}
    rules = []
    for c in sorted(seen, key=len):
        n, m = sum(c <= t for t, _ in pages), sum(b for t, b in pages if c <= t)
        if m >= least and m >= confidence * n and (n - m) * ratio <= share * n and not any(r <= c for r in rules):
            rules.append(c)
    return rules


@pytest.mark.parametrize("base", [0.2, 0.8])
def test_rules_as_by_brute_force(spark, base):
    """Planted combinations at a low and a high share of bad pages: verdicts are those of all sure combinations."""
    rng = np.random.default_rng(int(base * 10))
    urls, bad = [], []
    for i in range(400):
        host, lang, ref = (str(rng.choice(x)) for x in (["alpha", "beta", "gamma"], ["en", "it"], ["a", "b", "c"]))
        planted = (host == "alpha" and ref == "c") or (lang == "it" and host == "beta")
        urls.append(f"https://{host}.example.org/{lang}/{i}?ref={ref}&v={i}")
        bad.append(bool(rng.random() < (0.97 if planted else base)))
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    labels = spark.createDataFrame([(i, 0 if b else 1, 0) for i, b in enumerate(bad)], "doc_id long, quality int, toxic int")
    rules = brute_rules(urls, bad, 10)
    got = {r.page_id: (r.verdict, r.rules_met) for r in url_filter(pages, labels).collect()}
    assert rules and any(m for _, m in got.values())
    assert {i: v for i, (v, _) in got.items()} == {i: "block" if any(r <= tokens_of(u) for r in rules) else "allow" for i, u in enumerate(urls)}


@pytest.mark.parametrize("max_items", [12, 100])
def test_pages_of_many_items_lose_none(spark, max_items):
    """A rule of two tokens that do not divide at all alone, in pages of 16 more: as by all combinations, by both growths."""
    rng, urls, bad = np.random.default_rng(8), [], []
    n_more = 16 if max_items == 12 else 8  # all combinations of 16 are too many for the plain growth
    for i in range(320):
        u, v = i % 2, i // 2 % 2
        more = "&".join(f"q{chr(97 + j)}=1" for j in range(n_more) if rng.random() < 0.95)
        urls.append(f"x://h?{'u=1&' * u}{'v=1&' * v}{more}")
        bad.append(u == v)
    pages = spark.createDataFrame([(i, x) for i, x in enumerate(urls)], "page_id long, url string")
    labels = spark.createDataFrame([(i, 0 if b else 1, 0) for i, b in enumerate(bad)], "doc_id long, quality int, toxic int")
    tokens = [tokens_of(x) for x in urls]
    masks = {t: sum(1 << i for i, x in enumerate(tokens) if t in x) for t in set().union(*tokens)}
    bad_mask, rules = sum(1 << i for i, b in enumerate(bad) if b), []

    def grow(chosen, mask, rest):
        n, m = mask.bit_count(), (mask & bad_mask).bit_count()
        if m < 30:
            return
        if chosen and m >= 0.6 * n and (n - m) * 1.5 <= 0.5 * n:
            rules.append(mask)
            return
        for k, t in enumerate(rest):
            grow([*chosen, t], mask & masks[t], rest[k + 1 :])

    grow([], (1 << len(urls)) - 1, sorted(masks))
    want = [i for i in range(len(urls)) if any(r >> i & 1 for r in rules)]
    got = {r.page_id for r in url_filter(pages, labels, rules=[], min_count=30, max_items=max_items).collect() if r.verdict == "block"}
    assert got == set(want) and set(range(3, 320, 4)) <= got


def test_many_shared_parameters_end(spark):
    """18 parameters that all pages share, and 18 that most have, are mined in a moment; long tokens count whole."""
    rng = np.random.default_rng(5)
    rows = []
    for i in range(240):
        some = "&".join(f"q{chr(97 + j)}=1" for j in range(18) if rng.random() < 0.95)
        rows.append((i, f"https://h{i}.example.org/{'x' * 80}{'bad' if i % 4 == 0 else 'good'}?" + "&".join(f"p{chr(97 + j)}=1" for j in range(18)) + "&" + some, i % 4 == 0))
    pages = spark.createDataFrame([(i, u) for i, u, _ in rows], "page_id long, url string")
    labels = spark.createDataFrame([(i, 0 if b else 1, 0) for i, _, b in rows], "doc_id long, quality int, toxic int")
    began = time.time()
    assert {r.page_id for r in url_filter(pages, labels).collect() if r.verdict == "block"} == {i for i, _, b in rows if b}
    assert time.time() - began < 60
