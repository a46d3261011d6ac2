"""File sources: a corpus of text, markdown, Word and PDF files as rows of texts, tables, images and metadata."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from typing import Protocol
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioworks.functions.text import fix_text_spacing, image_gate, md_tables, ocr_text, unix_lines

IMAGE = "struct<page:int,x0:double,y0:double,x1:double,y1:double,width:double,height:double,format:string,data:binary>"
META = "struct<file_type:string,file_name:string,num_pages:int,num_tables:int,num_images:int,ocr_segments:int>"
CONTENT = f"path string, text string, tables array<string>, images array<{IMAGE}>, metadata {META}"
# The size that an image must pass, and how sure what is read on it must be.
LEAST_IMAGE, LEAST_SURE = 50, 0.3
KNOWN = (".txt", ".md", ".docx", ".pdf")
WORD = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def extension(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"(\.[^./]+)\z", 1))


def with_content(rows: DataFrame, file_type: str, tables: Column) -> DataFrame:
    """CONTENT of rows (path, text)."""
    none = F.lit(None).cast("int")
    meta = F.struct(F.lit(file_type).alias("file_type"), F.element_at(F.split("path", "/"), -1).alias("file_name"), none.alias("num_pages"), F.size("tables").alias("num_tables"), F.lit(0).alias("num_images"), none.alias("ocr_segments"))
    return rows.withColumn("tables", tables).withColumn("images", F.array().cast(f"array<{IMAGE}>")).withColumn("metadata", meta.cast(META))


def read_txt(spark: SparkSession, path: str, glob: str = "*.txt") -> DataFrame:
    """Text files, with newlines as in Unix."""
    rows = spark.read.option("pathGlobFilter", glob).text(path, wholetext=True)
    return with_content(rows.select(F.col("_metadata.file_path").alias("path"), unix_lines(F.col("value")).alias("text")), "txt", F.array().cast("array<string>"))


def read_md(spark: SparkSession, path: str, glob: str = "*.md") -> DataFrame:
    """Markdown files with their pipe tables."""
    rows = spark.read.option("pathGlobFilter", glob).text(path, wholetext=True)
    return with_content(rows.select(F.col("_metadata.file_path").alias("path"), unix_lines(F.col("value")).alias("text")), "md", md_tables(F.col("text")))


def docx_content(data: bytes) -> tuple[str, list[str], list[dict]]:
    """Text with tables in place, tables, and images of a Word file."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        body = ElementTree.fromstring(z.read("word/document.xml")).find(f"{WORD}body")
        images = [{"format": n.rsplit(".", 1)[-1], "data": z.read(n)} for n in z.namelist() if n.startswith("word/media/")]
    kinds = {f"{WORD}t": lambda e: e.text or "", f"{WORD}tab": lambda e: "\t", f"{WORD}br": lambda e: "\n", f"{WORD}cr": lambda e: "\n"}
    words = lambda p: "".join(kinds[e.tag](e) for e in p.iter() if e.tag in kinds)
    parts, tables = [], []
    for element in body if body is not None else []:
        if element.tag == f"{WORD}p":
            parts.append(words(element))
        elif element.tag == f"{WORD}tbl":
            cells = [["\n".join(words(p) for p in cell.iter(f"{WORD}p")).strip() for cell in row.findall(f"{WORD}tc")] for row in element.findall(f"{WORD}tr")]
            tables.append("\n".join(" | ".join(row) for row in cells))
            parts.append(f"\n[TABLE]\n{tables[-1]}\n[/TABLE]\n")
    return "\n".join(parts), tables, images


def binary_files(spark: SparkSession, path: str, glob: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "content")


def read_docx(spark: SparkSession, path: str, glob: str = "*.docx") -> DataFrame:
    """Word files, by their XML alone."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for name, data in zip(pdf.path, pdf.content, strict=True):
                text, tables, images = docx_content(data)
                blank = dict.fromkeys(("page", "x0", "y0", "x1", "y1", "width", "height"))
                rows.append((name, text, tables, [blank | i for i in images], {"file_type": "docx", "file_name": name.rsplit("/", 1)[-1], "num_pages": None, "num_tables": len(tables), "num_images": len(images), "ocr_segments": None}))
            yield pd.DataFrame(rows, columns=["path", "text", "tables", "images", "metadata"])

    return binary_files(spark, path, glob).mapInPandas(run, CONTENT)


class OcrModel(Protocol):
    def read(self, png: bytes) -> list[tuple[str, float]]:
        """Texts on a picture of a page, each with how sure it is."""
        ...


DETECTIONS = "array<struct<text:string,confidence:double>>"
PAGE = f"path string, page_no int, text string, tables array<string>, images array<{IMAGE}>, detections {DETECTIONS}"


def pdf_pages(spark: SparkSession, path: str, glob: str = "*.pdf", ocr: OcrModel | None = None) -> DataFrame:
    """path, page_no, text, tables, images, detections of PDF files; needs the optional library pdfplumber on the
    executors, and raises without it. Only pages with an image that passes the gate are shown to ocr, at 150 dpi."""

    def picture(page) -> bytes:  # noqa: ANN001
        out = io.BytesIO()
        page.to_image(resolution=150).original.save(out, format="PNG")
        return out.getvalue()

    def page_row(name: str, i: int, page) -> tuple:  # noqa: ANN001
        boxes = [{k: float(m.get(k, 0)) for k in ("x0", "y0", "x1", "y1")} for m in page.images]
        sizes = [{"width": abs(b["x1"] - b["x0"]), "height": abs(b["y1"] - b["y0"])} for b in boxes]
        images = [{"page": i + 1, **b, **s, "format": None, "data": None} for b, s in zip(boxes, sizes, strict=True)]
        shown = ocr is not None and any(s["width"] > LEAST_IMAGE and s["height"] > LEAST_IMAGE for s in sizes)
        seen = [{"text": t, "confidence": float(c)} for t, c in ocr.read(picture(page))] if shown else []
        tables = ["\n".join(" | ".join("" if c is None else str(c) for c in row) for row in t) for t in page.extract_tables() if t]
        return name, i + 1, page.extract_text(x_tolerance=2, y_tolerance=3) or "", tables, images, seen

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            import pdfplumber  # only where there are PDF files

            for name, data in zip(pdf.path, pdf.content, strict=True):
                with pdfplumber.open(io.BytesIO(data)) as doc:
                    rows = [page_row(name, i, page) for i, page in enumerate(doc.pages)]
                yield pd.DataFrame(rows, columns=["path", "page_no", "text", "tables", "images", "detections"])

    return binary_files(spark, path, glob).mapInPandas(run, PAGE)


def pdf_content(pages: DataFrame) -> DataFrame:
    """CONTENT of paged files: of each page in order its mark and text with spacing repaired, its tables, and what was
    read on its pictures; images that pass the gate."""
    number = F.col("page_no").cast("string")
    text = F.when(F.coalesce("text", F.lit("")) != "", F.array(F.concat(F.lit("\n--- Page "), number, F.lit(" ---\n")), fix_text_spacing(F.col("text"))))
    tables = F.transform("tables", lambda t: F.concat(F.lit("\n[TABLE]\n"), t, F.lit("\n[/TABLE]\n")))
    sure = F.filter("detections", lambda x: x["confidence"] > LEAST_SURE)
    read = F.when(image_gate(F.col("images"), LEAST_IMAGE) & (F.size(sure) > 0), F.array(F.concat(F.lit("\n[OCR_TEXT_PAGE_"), number, F.lit("]\n"), ocr_text(F.col("detections"), LEAST_SURE), F.lit("\n[/OCR_TEXT]\n"))))
    none = F.array().cast("array<string>")
    large = F.filter("images", lambda i: (F.abs(i["width"]) > LEAST_IMAGE) & (F.abs(i["height"]) > LEAST_IMAGE))
    rows = pages.select("path", "page_no", F.concat(F.coalesce(text, none), F.coalesce(tables, none), F.coalesce(read, none)).alias("parts"), F.coalesce("tables", none).alias("tables"), F.coalesce(large, F.array().cast(f"array<{IMAGE}>")).alias("images"), F.when(read.isNotNull(), F.size(sure)).otherwise(0).alias("read"))
    ordered = F.array_sort(F.collect_list(F.struct("page_no", "parts", "tables")))
    found = rows.groupBy("path").agg(ordered.alias("p"), F.flatten(F.collect_list("images")).alias("images"), F.count("*").cast("int").alias("num_pages"), F.sum("read").cast("int").alias("ocr_segments"))
    found = found.select("path", F.array_join(F.flatten(F.transform("p", lambda x: x["parts"])), "\n").alias("text"), F.flatten(F.transform("p", lambda x: x["tables"])).alias("tables"), F.array_sort("images").alias("images"), "num_pages", "ocr_segments")
    meta = F.struct(F.lit("pdf").alias("file_type"), F.element_at(F.split("path", "/"), -1).alias("file_name"), F.col("num_pages"), F.size("tables").alias("num_tables"), F.size("images").alias("num_images"), F.col("ocr_segments"))
    return found.select("path", "text", "tables", "images", meta.cast(META).alias("metadata"))


def read_pdf(spark: SparkSession, path: str, glob: str = "*.pdf", ocr: OcrModel | None = None) -> DataFrame:
    return pdf_content(pdf_pages(spark, path, glob, ocr))


def read_files(spark: SparkSession, path: str, ocr: OcrModel | None = None) -> DataFrame:
    """All files below path by their extension (txt, md, docx, pdf); raises on other ones when read."""
    names = spark.read.format("binaryFile").load(path).select("path")
    known = F.when(extension(F.col("path")).isin(*KNOWN), F.col("path")).otherwise(F.raise_error(F.concat(F.lit("unknown kind of file: "), F.col("path"))))
    kept = names.select(known.alias("path")).select("path")
    every = read_txt(spark, path).unionByName(read_md(spark, path)).unionByName(read_docx(spark, path)).unionByName(read_pdf(spark, path, ocr=ocr))
    return every.join(kept, "path", "left_semi")


def full_text(content: DataFrame) -> DataFrame:
    return content.select("path", "text")


def discover_markdown(spark: SparkSession, path: str) -> DataFrame:
    """Markdown files of a folder in order of name, without readmes and hidden files."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.md").load(path).select("path").withColumn("name", F.element_at(F.split("path", "/"), -1))
    return files.where((F.lower("name") != "readme.md") & ~F.startswith("name", F.lit("."))).orderBy("name")
