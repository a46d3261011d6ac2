"""Sections of markdown documents and of paged documents, as window operations over lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioworks.functions.text import WS, clean_content, context_header, strip, unix_lines


def heading(line: Column, marks: str) -> Column:
    """Title of a heading line with these marks, else null."""
    found = F.regexp_extract(line, rf"(?d)\A{marks}{WS}+(.+)\z", 1)
    return F.when(found != "", strip(found))


def lines_of(docs: DataFrame, keys: list[str], text_col: str) -> DataFrame:
    return docs.select(*keys, F.posexplode(F.split(unix_lines(F.col(text_col)), "\n", -1)).alias("pos", "line"))


def joined_lines(line: str = "line", order: tuple[str, ...] = ("pos",)) -> Column:
    """Lines of a group in order, with newlines."""
    ordered = F.array_sort(F.collect_list(F.struct(*order, F.col(line).alias("text"))))
    return F.array_join(F.transform(ordered, lambda x: x["text"]), "\n")


def md_sections(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, section_no, level, title, parent, content: a section begins at each second- or third-level heading.

    Other headings are content; what precedes the first heading is a section of level 0; empty sections are dropped.
    """
    by_doc = Window.partitionBy(id_col).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    lines = lines_of(docs, [id_col], text_col).withColumns({"h2": heading(F.col("line"), "##"), "h3": heading(F.col("line"), "###")})
    head = F.col("h2").isNotNull() | F.col("h3").isNotNull()
    lines = lines.withColumns({"section": F.sum(head.cast("int")).over(by_doc), "under": F.last("h2", ignorenulls=True).over(by_doc)})
    level = F.max(F.when(F.col("h2").isNotNull(), 2).when(F.col("h3").isNotNull(), 3).otherwise(0))
    found = lines.groupBy(id_col, "section").agg(
        level.alias("level"), F.max(F.coalesce("h2", "h3")).alias("title"), F.max("under").alias("under"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(~head, F.struct("pos", "line")))), lambda x: x["line"]), "\n").alias("content"),
    )
    found = found.withColumn("content", strip(F.col("content"))).where("content <> ''")
    number = F.row_number().over(Window.partitionBy(id_col).orderBy("section")) - 1
    return found.select(id_col, number.alias("section_no"), "level", F.coalesce("title", F.lit("Document Header")).alias("title"), F.when(F.col("level") == 3, F.col("under")).alias("parent"), "content")


def md_section_chunks(sections: DataFrame, least: int = 50) -> DataFrame:
    """A chunk of each section: parent, title and content, cleaned; short ones dropped."""
    parent = F.when(F.coalesce("parent", F.lit("")) != "", F.concat(F.lit("[Parent Section: "), F.col("parent"), F.lit("]")))
    title = context_header(F.col("title"), F.col("level"), F.lit(None).cast("string"))
    chunk = clean_content(F.concat_ws("\n\n", parent, F.when(title != "", title), F.col("content")))
    return sections.withColumn("chunk", chunk).where(F.length("chunk") >= least).withColumn("length", F.length("chunk").cast("long")).drop("content")


def pages_text(pages: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """doc_id, text: pages (page_no, text) in order, each after its mark; empty pages left out."""
    page = F.concat(F.lit("--- Page "), F.col("page_no").cast("string"), F.lit(" ---\n"), F.col("text"))
    some = pages.where(F.coalesce("text", F.lit("")) != "").select(id_col, "page_no", page.alias("page"))
    ordered = F.array_sort(F.collect_list(F.struct("page_no", "page")))
    return some.groupBy(id_col).agg(F.array_join(F.transform(ordered, lambda x: x["page"]), "\n\n").alias("text"))


def pdf_sections(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 50) -> DataFrame:
    """doc_id, section_no, title, page_start, content, true_page of paged texts: a section begins at a numbered line or
    at one in capitals. Sections of at most ``least`` characters are dropped. page_start counts pieces between page
    marks from 1, the piece before the first mark included; true_page is the number that the mark has."""
    text = F.col(text_col)
    pieces = F.split(text, r"--- Page \p{Nd}+ ---", -1)
    marks = F.concat(F.array(F.lit("0")), F.regexp_extract_all(text, F.lit(r"--- Page (\p{Nd}+) ---"), F.lit(1)))
    paged = docs.select(id_col, F.posexplode(F.arrays_zip(pieces.alias("piece"), marks.alias("mark"))).alias("page", "p"))
    lines = paged.select(id_col, (F.col("page") + 1).alias("page"), F.col("p.mark").cast("int").alias("true_page"), F.posexplode(F.split(F.col("p.piece"), "\n", -1)).alias("pos", "line"))
    bare = strip(F.col("line"))
    rest = F.regexp_extract(bare, rf"(?d)\A(\p{{Nd}}{{1,2}}){WS}*[.)]{WS}*(.+)\z", 2)
    number = F.regexp_extract(bare, rf"(?d)\A(\p{{Nd}}{{1,2}}){WS}*[.)]{WS}*(.+)\z", 1)
    capitals = F.when(bare.rlike(rf"\A[A-Z][A-Z{WS[1:-1]}]{{10,}}\z") & bare.rlike(rf"[A-Z]{WS}+[A-Z]"), bare)
    title = F.when(F.length(rest) > 5, F.concat(number, F.lit(". "), strip(rest))).otherwise(capitals)
    lines = lines.withColumn("head", title).where(bare != "")
    by_doc = Window.partitionBy(id_col).orderBy("page", "pos").rowsBetween(Window.unboundedPreceding, 0)
    lines = lines.withColumn("section", F.count("head").over(by_doc))
    body = F.array_sort(F.collect_list(F.when(F.col("head").isNull(), F.struct("page", "pos", "line"))))
    at_head = lambda c: F.max(F.when(F.col("head").isNotNull(), F.col(c)))
    found = lines.groupBy(id_col, "section").agg(F.max("head").alias("title"), at_head("page").alias("page_start"), at_head("true_page").alias("true_page"), F.array_join(F.transform(body, lambda x: x["line"]), "\n").alias("content"))
    found = found.withColumn("content", strip(F.col("content"))).where(F.length("content") > least)
    number = F.row_number().over(Window.partitionBy(id_col).orderBy("section")) - 1
    return found.select(id_col, number.alias("section_no"), F.coalesce("title", F.lit("Document Start")).alias("title"), F.coalesce("page_start", F.lit(1)).alias("page_start"), "content", F.coalesce("true_page", F.lit(1)).alias("true_page"))
