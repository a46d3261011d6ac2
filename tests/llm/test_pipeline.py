import re
import zlib
from collections import defaultdict

import corpus_pipeline
import numpy as np
import pytest
from tokenizers import Tokenizer

from folioworks.llm import common

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, doc string, places int, id long, kept boolean, fp string"


@pytest.mark.parametrize("small_side", [64 << 20, 0])
def test_pipeline(spark, tmp_path, prose_of, monkeypatch, small_side):
    """All stages over a table with null, empty and repeated rows and clashing names, with sides sent and shuffled."""
    monkeypatch.setattr(common, "SMALL_SIDE", small_side)
    good = [(i, prose_of(i, 90)) for i in range(160)]
    bad = [(1000 + i, " ".join(w.upper() + "!!" for w in prose_of(i, 80).split())) for i in range(80)]
    copies = [(2000 + i, prose_of(i, 90).replace(" ", "  ")) for i in range(10)] + [good[3], good[3], (None, prose_of(44, 90))]
    secret = [(3000 + i, prose_of(500 + i, 90) + f' password="abcdefgh1234567{i}"') for i in range(6)] + [(4001, None), (4002, "")]
    docs = good + bad + copies + secret
    d = str(tmp_path)
    spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), "x", 1, 2, False, "y") for i, t in docs], SCHEMA).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i, _ in good] + [(i, 0, 0) for i, _ in bad], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    table = spark.read.parquet(f"{d}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, table, d)
        if name != "packing":
            assert out.schema == table.schema
            out.write.parquet(f"{d}/{name}")
            table = spark.read.parquet(f"{d}/{name}")
            assert {(r.doc, r.places, r.id, r.kept, r.fp) for r in table.collect()} == {("x", 1, 2, False, "y")}
            seen[name] = [(r.doc_id, r.text) for r in table.collect()]
    first = dict(seen["quality_classifier"])
    assert len([i for i, _ in good if i in first]) >= 158 and len([i for i, _ in bad if i in first]) <= 2
    exact = seen["exact_dedup"]
    assert not any(i is None or 2000 <= i < 3000 for i, _ in exact) and len({re.sub(r"\s+", " ", t or "") for _, t in exact}) == len(exact)
    assert set(seen["simhash_near_dedup"]) <= set(exact)
    secrets = {i: t for i, t in seen["secret_scan"] if i is not None and 3000 <= i < 4000}
    assert secrets and all("[SECRET]" in t and "abcdefgh1234567" not in t for t in secrets.values())
    assert all(r.n_chars == len(r.text or "") or r.text is None for r in table.collect())
    tokenizer, pieces = Tokenizer.from_file(corpus_pipeline.public_tokenizers.path("word_bpe_49k.json")), defaultdict(list)
    for r in corpus_pipeline.run(spark, d).collect():
        pieces[r.doc_id].append((r.start, r.length, r.ids_crc32))
    assert set(pieces) == {i for i, _ in seen["secret_scan"]}
    for i, text in seen["secret_scan"]:
        ids, at = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], 0
        for start, length, crc in sorted(pieces[i]):
            assert start == at and zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes()) == crc
            at += length
        assert at == len(ids)


def test_pipeline_without_rows(spark, tmp_path):
    d = str(tmp_path)
    spark.createDataFrame([], SCHEMA).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    assert corpus_pipeline.run(spark, d).count() == 0


def test_the_entry_lists_all():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names and {n.split("_")[0] for n in names if re.match(r"op\d+_", n)} == {f"op{i}" for i in range(1, 11)}
    assert set(entry.oracle_sql()) <= set(names)
