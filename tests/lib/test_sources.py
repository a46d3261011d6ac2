import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from folioworks.operators import chunkers
from folioworks.plans import answer
from folioworks.operators.search import keyword_index
from folioworks.sources import files, store
from folioworks.streaming import ingest

W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'


def docx() -> bytes:
    cell = lambda t: f"<w:tc><w:p><w:r><w:t>{t}</w:t></w:r></w:p></w:tc>"
    body = f"<w:p><w:r><w:t>Hello</w:t></w:r><w:r><w:t> there</w:t></w:r></w:p><w:tbl><w:tr>{cell('a')}{cell('b')}</w:tr><w:tr>{cell('1')}{cell('2')}</w:tr></w:tbl><w:p/><w:sectPr/>"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f"<w:document {W}><w:body>{body}</w:body></w:document>")
        z.writestr("word/media/image1.png", b"png")
    return out.getvalue()


@pytest.fixture()
def folder(tmp_path):
    (tmp_path / "a.txt").write_bytes("one\r\ntwo\rthree".encode())
    (tmp_path / "b.md").write_text("# T\n| h | k |\n|---|---|\n| 1 | 2 |\n\nend")
    (tmp_path / "README.md").write_text("no")
    (tmp_path / "c.docx").write_bytes(docx())
    return tmp_path


def test_files(spark, folder):
    got = {r.metadata.file_name: r for r in files.read_files(spark, str(folder)).collect()}
    assert got["a.txt"].text == "one\ntwo\nthree"
    assert got["b.md"].tables == ["| h | k |\n|---|\n| 1 | 2 |\n\n".replace("\n\n", "\n\n")] and got["b.md"].metadata.num_tables == 1
    word = got["c.docx"]
    assert word.text == "Hello there\n\n[TABLE]\na | b\n1 | 2\n[/TABLE]\n\n" and word.tables == ["a | b\n1 | 2"] and word.images[0].format == "png"
    assert [r.name for r in files.discover_markdown(spark, str(folder)).collect()] == ["b.md"]
    (folder / "e.pdf").write_bytes(b"%PDF-1.4")
    with pytest.raises(Exception, match="pdfplumber|PDF"):  # PDF files are read or raise, and never get lost
        files.read_files(spark, str(folder)).collect()
    (folder / "e.pdf").unlink()
    (folder / "d.xyz").write_text("?")
    with pytest.raises(Exception, match="unknown kind of file"):
        files.read_files(spark, str(folder)).collect()


def test_collections(spark):
    docs = spark.createDataFrame([(1, "word " * 900), (2, "too short"), (3, None)], "doc_id long, text string")
    probe = store.reset_collection(docs, "chunks_of_docs")
    n = spark.table("chunks_of_docs").count()
    assert probe.count() == 1 and n > 1 and store.collection_exists(spark, "chunks_of_docs")
    rows = store.records(chunkers.recursive_chunks(docs, 512, 50))
    store.append_collection(rows, "chunks_of_docs")
    assert spark.table("chunks_of_docs").count() == n + rows.count()
    assert rows.select("id").distinct().count() == rows.count()
    store.create_vector_table(spark, "vectors_of_docs")
    store.create_vector_table(spark, "vectors_of_docs")
    assert spark.table("vectors_of_docs").count() == 0
    for t in ("chunks_of_docs", "vectors_of_docs"):
        spark.sql(f"drop table {t}")
    assert not store.collection_exists(spark, "chunks_of_docs")


def test_cells(spark):
    rows = spark.range(60).select(F.col("id").cast("string").alias("id"), F.array((F.col("id") % 3).cast("float"), F.lit(1.0).cast("float")).alias("embedding"))
    out, centres = store.add_cells(rows, 3)
    assert out.groupBy("cell").count().count() == 3 and len(store.nearest_cells(centres, [0.0, 1.0], 1)) == 1


def test_reports_and_logs(spark, tmp_path):
    chunks = spark.createDataFrame([(1, 0, "body", "T", 2, None, 1, False, None), (1, 1, "more", "U", 3, "T", 1, True, 2)], "doc_id long, chunk_no int, chunk string, title string, level int, parent string, tokens long, is_split boolean, chunk_part int")
    store.write_report(chunks, str(tmp_path / "report"))
    text = "\n".join(r.value for r in spark.read.text(str(tmp_path / "report")).collect())
    assert "CHUNK #1" in text and "Parent Section: T" in text and "Split: Yes (Part 2)" in text
    rows = spark.createDataFrame([("s", "t1", "q", "a", [("x", 0.5)])], "session string, timestamp string, question string, answer string, retrieved array<struct<content:string,score:double>>")
    store.append_log(rows, str(tmp_path / "log"))
    entry = json.loads(spark.read.text(str(tmp_path / "log")).first().value)
    assert entry["num_chunks"] == 1 and entry["retrieved_chunks"] == [{"chunk_id": 1, "content": "x", "score": 0.5}]
    assert store.sessions(rows).first().interactions[0].question == "q"


def test_stream(spark, tmp_path):
    spark.createDataFrame([(1, "one two three. " * 60)], "doc_id long, text string").write.parquet(str(tmp_path / "in"))
    out, mark = str(tmp_path / "out"), str(tmp_path / "mark")
    for _ in range(2):  # a second run finds nothing new
        ingest.chunk_stream(ingest.document_stream(spark, str(tmp_path / "in")), lambda d: chunkers.fixed_chunks(d, 20), out, mark).awaitTermination()
    want = chunkers.fixed_chunks(spark.read.parquet(str(tmp_path / "in")), 20).count()
    assert spark.read.parquet(out).count() == want


def test_answers(spark):
    docs = spark.createDataFrame([(1, "red fish swim"), (2, "blue birds fly")], "doc_id long, text string")
    vectors = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<double>")
    asked = spark.createDataFrame([(0, "red fish", [1.0, 0.0])], "query_id int, text string, embedding array<double>")
    got = answer.answer(keyword_index(docs), docs, vectors, asked, 1).first()
    assert got.answer == "red fish swim" and got.retrieved[0].content == "red fish swim"


def test_pages_of_a_pdf_become_its_content(spark):
    box = lambda w: {"page": 1, "x0": 0.0, "y0": 0.0, "x1": w, "y1": w, "width": w, "height": w, "format": None, "data": None}
    pages = [
        ("f/a.pdf", 2, "secondPage here", ["x | y"], [box(80.0)], [{"text": "sure", "confidence": 0.9}, {"text": "not", "confidence": 0.3}]),
        ("f/a.pdf", 1, "first page", [], [box(40.0)], [{"text": "small", "confidence": 0.9}]),
        ("f/a.pdf", 3, "", [], [], []),
    ]
    r = files.pdf_content(spark.createDataFrame(pages, files.PAGE)).first()
    assert r.text == "\n--- Page 1 ---\n\nfirst page\n\n--- Page 2 ---\n\nsecond Page here\n\n[TABLE]\nx | y\n[/TABLE]\n\n\n[OCR_TEXT_PAGE_2]\nsure\n[/OCR_TEXT]\n"
    assert r.tables == ["x | y"] and [i.width for i in r.images] == [80.0]
    assert tuple(r.metadata) == ("pdf", "a.pdf", 3, 1, 1, 1)


def test_failed_batches_are_reported_and_skipped(spark, tmp_path):
    place = str(tmp_path)

    def write(records):
        if any(r["id"] == "13" for r in records):
            raise ValueError("refused")
        with open(f"{place}/{records[0]['id']}", "w") as f:
            f.write(str(len(records)))

    rows = spark.range(40).coalesce(1).select(F.col("id").cast("string").alias("id"))
    report = sorted(tuple(r) for r in store.insert_batches(rows, write, 10).select("batch", "n", "error").collect())
    assert report == [(0, 10, None), (1, 10, "refused"), (2, 10, None), (3, 10, None)]
    assert sum(int(f.read_text()) for f in tmp_path.iterdir()) == 30


def test_a_model_is_asked_once_for_each_section(spark, tmp_path):
    from folioworks.operators import guided

    class Counting:
        def __init__(self, path):
            self.path = path

        def reply(self, prompt):
            import uuid

            open(f"{self.path}/{uuid.uuid4().hex}", "w").close()
            return "split_after: 2"

    text = "One sentence stands here. " * 3 + "Another one follows it. A last one ends."
    rows = [(i, n, 2, "T", None, text if n else "Too short.") for i in range(5) for n in range(4)]
    sections = spark.createDataFrame(rows, "doc_id long, section_no int, level int, title string, parent string, content string")
    for chunks in (guided.guided_md_chunks, guided.guided_pdf_chunks):
        place = tmp_path / chunks.__name__
        place.mkdir()
        out = chunks(sections, Counting(str(place)))
        assert out.count() == out.count() > 15
        assert len(list(place.iterdir())) == 15


def test_vector_search_by_brute_force(spark):
    import numpy as np

    from folioworks.operators import search

    r = np.random.default_rng(3)
    m = np.round(r.standard_normal((300, 6)), 1)
    m[40:60] = m[7]
    rows = spark.createDataFrame([(f"k{i:03d}", v.tolist()) for i, v in enumerate(m)] + [("none", None)], "vec_id string, embedding array<double>").repartition(4)
    asked = spark.createDataFrame([(i, m[i].tolist()) for i in range(0, 300, 3)] + [(999, [0.0] * 6), (998, None)], "query_id int, embedding array<double>")
    for metric in ("sql2", "cosine"):
        want = set()
        for q in [*range(0, 300, 3), 999]:
            v = m[q] if q < 300 else np.zeros(6)
            n = np.linalg.norm(m, axis=1) * np.linalg.norm(v)
            d = ((m - v) ** 2).sum(1) if metric == "sql2" else 1 - np.where(n == 0, 0, m @ v / np.where(n == 0, 1, n))
            want |= {(q, f"k{i:03d}", rank) for rank, i in enumerate(sorted(range(300), key=lambda i: (round(d[i], 12), i))[:8], 1)}
        got = {(x.query_id, x.id, x["rank"]) for x in search.vector_search(rows, asked, 8, metric, block=64).collect()}
        assert got == want
    assert search.vector_search(rows.limit(0), asked, 8).count() == 0
