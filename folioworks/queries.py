"""Queries of the library's operators over the driver's tables, each with SQL for an independent check where SQL can say it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioworks.functions import text as X
from folioworks.functions.models import LetterEmbedder
from folioworks.operators import chunkers, guided, search, sections, semantic, stats
from folioworks.plans import answer
from folioworks.sources import files, store
from folioworks.sources.scratch import shared_dir, written

WS = r"[\s\x0b\x1c-\x1f\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
Q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        Q[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Inputs that are made from the tables, in both languages.


def md_docs(spark: SparkSession, d: str) -> DataFrame:
    """A markdown document for each conversation."""
    turns = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    body = F.array_join(F.transform(turns, lambda t: F.concat(F.lit("### "), t["role"], F.lit(" "), t["turn"].cast("string"), F.lit("\n\n"), t["text"])), "\n\n")
    name = F.col("conv_id").cast("string")
    head = F.concat(F.lit("Transcript preamble for conversation "), name, F.lit("\n\n## Conversation "), name, F.lit("\n\n"))
    return table(spark, d, "conversations").groupBy("conv_id").agg(body.alias("body")).select(F.col("conv_id").alias("doc_id"), F.concat(head, F.col("body")).alias("text"))


MD_DOCS = r"""md_docs as (
  select conv_id as doc_id, 'Transcript preamble for conversation ' || conv_id || chr(10) || chr(10) || '## Conversation ' || conv_id || chr(10) || chr(10)
    || string_agg('### ' || role || ' ' || turn || chr(10) || chr(10) || text, chr(10) || chr(10) order by turn, role, text) as text
  from conversations group by conv_id)"""


def pdf_pages(spark: SparkSession, d: str) -> DataFrame:
    """A page for each turn: a numbered title, or one in capitals on every third page, and the text."""
    n = F.col("turn") + 1
    head = F.concat(F.lpad(n.cast("string"), 2, "0"), F.lit(". Turn title words\n"), F.col("text"))
    page = F.when(n % 3 == 0, F.concat(F.lit("GENERAL PROVISIONS TEXT\n"), head)).otherwise(head)
    return table(spark, d, "conversations").select(F.col("conv_id").alias("doc_id"), n.cast("int").alias("page_no"), page.alias("text"))


PDF_PAGES = r"""pages_ as (
  select conv_id as doc_id, cast(turn + 1 as integer) as page_no,
    case when (turn + 1) % 3 = 0 then 'GENERAL PROVISIONS TEXT' || chr(10) else '' end || lpad(cast(turn + 1 as varchar), 2, '0') || '. Turn title words' || chr(10) || text as text
  from conversations),
pdf_docs as (
  select doc_id, string_agg('--- Page ' || page_no || ' ---' || chr(10) || text, chr(10) || chr(10) order by page_no, text) as text from pages_ where text <> '' group by doc_id)"""


def documents(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", "text", "source")


def para_docs(spark: SparkSession, d: str) -> DataFrame:
    return documents(spark, d).withColumn("text", F.regexp_replace("text", "\n", "\n\n"))


def asked(spark: SparkSession, d: str) -> DataFrame:
    """Benchmark texts as questions, with the vector of the same id."""
    vectors = table(spark, d, "embeddings").select(F.col("vec_id").alias("item_id"), "embedding")
    return table(spark, d, "benchmark").join(vectors, "item_id").select(F.col("item_id").alias("query_id"), "text", "embedding")


def strip_sql(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '\\A{WS}+', ''), '{WS}+\\z', '')"


# Text functions.


@query(f"select doc_id, {strip_sql(rf'''regexp_replace(regexp_replace(replace(text, chr(10), chr(10) || chr(10) || '<!-- image --> ' || chr(10) || chr(10)), '<!-- image -->{WS}*', '', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g')''')} as cleaned from documents")
def clean_content(spark: SparkSession, d: str) -> DataFrame:
    marked = F.regexp_replace("text", "\n", "\n\n<!-- image --> \n\n")
    return documents(spark, d).select("doc_id", X.clean_content(marked).alias("cleaned"))


@query(f"with {PDF_PAGES} select doc_id, {strip_sql(rf'''regexp_replace(regexp_replace(text, '--- Page \d+ ---{WS}*', '', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g')''')} as cleaned from pdf_docs")
def clean_pages(spark: SparkSession, d: str) -> DataFrame:
    return sections.pages_text(pdf_pages(spark, d)).select("doc_id", X.clean_pages(F.col("text")).alias("cleaned"))


@query(
    rf"""select doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(text, '. ', '.'), ' ([A-Z])', '\1', 'g'),
      '([a-z])([A-Z])', '\1 \2', 'g'), '(\d)([A-Z][a-z])', '\1 \2', 'g'), '([a-z])(\d+)([A-Z{WS[1:-1]}])', '\1 \2\3', 'g'), '([.!?])([A-Z])', '\1 \2', 'g') as fixed from documents"""
)
def fix_text_spacing(spark: SparkSession, d: str) -> DataFrame:
    broken = F.regexp_replace(F.replace("text", F.lit(". "), F.lit(".")), " ([A-Z])", "$1")
    return documents(spark, d).select("doc_id", X.fix_text_spacing(broken).alias("fixed"))


TABLE_TEXT = "'| a | b |' || chr(10) || '|---|---|' || chr(10) || '| ' || source || ' | ' || doc_id || ' |' || chr(10) || chr(10) || text || chr(10) || '| h |' || chr(10) || '|:-:|' || chr(10) || '| 1 |' || chr(10) || '| 2 |'"


@query(
    rf"""with t as (select doc_id, {TABLE_TEXT} as text from documents),
    m as (select doc_id, regexp_extract_all(text, '\|(.+)\|[\r\n]+\|[-:\s|]+\|[\r\n]+((?:\|.+\|[\r\n]*)+)', 1) as h, regexp_extract_all(text, '\|(.+)\|[\r\n]+\|[-:\s|]+\|[\r\n]+((?:\|.+\|[\r\n]*)+)', 2) as r from t)
    select doc_id, len(h) as n_tables, array_to_string(list_transform(list_zip(h, r), lambda x: '|' || x[1] || '|' || chr(10) || '|---|' || chr(10) || x[2]), '#') as tables from m"""
)
def md_tables(spark: SparkSession, d: str) -> DataFrame:
    text = F.concat(F.lit("| a | b |\n|---|---|\n| "), F.col("source"), F.lit(" | "), F.col("doc_id").cast("string"), F.lit(" |\n\n"), F.col("text"), F.lit("\n| h |\n|:-:|\n| 1 |\n| 2 |"))
    found = documents(spark, d).select("doc_id", X.md_tables(text).alias("t"))
    return found.select("doc_id", F.size("t").cast("long").alias("n_tables"), F.array_join("t", "#").alias("tables"))


@query("select doc_id, length(text) // 4 as tokens, strlen(text) as bytes, length(text) // 4 > 800 or strlen(text) > 14000 as oversize from documents")
def token_count(spark: SparkSession, d: str) -> DataFrame:
    text = F.col("text")
    return documents(spark, d).select("doc_id", X.token_count(text).alias("tokens"), F.octet_length("text").cast("long").alias("bytes"), X.oversize(text).alias("oversize"))


SENTENCES = f"list_filter(list_transform(string_split(regexp_replace(text, '([.!?]){WS}+', '\\1' || chr(1), 'g'), chr(1)), lambda s: {strip_sql('s')}), lambda s: s <> '')"


@query(f"with s as (select doc_id, unnest({SENTENCES}) as sentence, generate_subscripts({SENTENCES}, 1) - 1 as sentence_no from documents) select doc_id, cast(sentence_no as integer) as sentence_no, sentence from s")
def split_sentences(spark: SparkSession, d: str) -> DataFrame:
    return documents(spark, d).select("doc_id", F.posexplode(X.split_sentences(F.col("text"))).alias("sentence_no", "sentence"))


PARAGRAPHS = f"list_filter(list_transform(regexp_split_to_array(replace(text, chr(10), chr(10) || chr(10)), '\\n\\n+'), lambda s: {strip_sql('s')}), lambda s: s <> '')"


@query(f"with s as (select doc_id, unnest({PARAGRAPHS}) as paragraph, generate_subscripts({PARAGRAPHS}, 1) - 1 as n from documents) select doc_id, cast(n as integer) as paragraph_no, paragraph from s")
def split_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    return para_docs(spark, d).select("doc_id", F.posexplode(X.split_paragraphs(F.col("text"))).alias("paragraph_no", "paragraph"))


TOKENS = rf"list_filter(regexp_split_to_array(regexp_replace(lower(text), '[^\p{{L}}\p{{N}}_\x{{0600}}-\x{{06FF}}{WS[1:-1]}]', ' ', 'g'), '{WS}+'), lambda t: t <> '')"


@query(f"select doc_id, len({TOKENS}) as n_tokens, sha256(array_to_string({TOKENS}, ' ')) as tokens_sha256 from documents")
def keyword_tokens(spark: SparkSession, d: str) -> DataFrame:
    tokens = X.keyword_tokens(F.col("text"))
    return documents(spark, d).select("doc_id", tokens.alias("t")).select("doc_id", F.size("t").cast("long").alias("n_tokens"), F.sha2(F.array_join("t", " ").cast("binary"), 256).alias("tokens_sha256"))


@query(
    r"""select distinct source || '. é-Report__(v' || doc_id % 7 || ').md' as file,
    'llm_semantic_md_' || regexp_replace(regexp_replace(regexp_replace(source || '. é-Report__(v' || doc_id % 7 || ').md', '[^a-zA-Z0-9._-]', '_', 'g'), '_+', '_', 'g'), '\A[_-]+|[_-]+\z', '', 'g') as collection,
    'doc_' || lower(regexp_replace(regexp_replace(regexp_replace(source || '. é-Report__(v' || doc_id % 7 || ').md', '[^a-zA-Z0-9_]', '_', 'g'), '_+', '_', 'g'), '\A_+|_+\z', '', 'g')) as table_name from documents"""
)
def sanitize_names(spark: SparkSession, d: str) -> DataFrame:
    file = F.concat(F.col("source"), F.lit(". é-Report__(v"), (F.col("doc_id") % 7).cast("string"), F.lit(").md"))
    return documents(spark, d).select(file.alias("file")).distinct().select("file", X.collection_name(F.col("file")).alias("collection"), X.table_name(F.col("file")).alias("table_name"))


@query("select doc_id, sha256(doc_id || ':0') as id, text[:10000] as embed_input, case when length(text) > 300 then text[:300] || '...' else text end as preview from documents")
def ids_and_previews(spark: SparkSession, d: str) -> DataFrame:
    return documents(spark, d).select("doc_id", X.chunk_id(F.col("doc_id"), F.lit(0)).alias("id"), X.embed_input(F.col("text")).alias("embed_input"), X.preview(F.col("text")).alias("preview"))


@query(f"with s as (select doc_id, {SENTENCES} as s from documents) select doc_id, coalesce(array_to_string(list_transform(s, lambda x, i: '<|sent_' || (i - 1) || '|>' || x || '<|/sent_' || (i - 1) || '|> '), ''), '') as markup from s")
def sentence_markup(spark: SparkSession, d: str) -> DataFrame:
    return documents(spark, d).select("doc_id", X.sentence_markup(X.split_sentences(F.col("text"))).alias("markup"))


@query(
    f"""with s as (select doc_id, unnest({SENTENCES}) as c, generate_subscripts({SENTENCES}, 1) as i from documents),
    t as (select *, coalesce(sum(length(c) // 4) over (partition by doc_id order by i rows between unbounded preceding and 1 preceding), 0) as before from s)
    select doc_id, string_agg('<|start_chunk_' || i || '|>' || c || '<|end_chunk_' || i || '|>', '' order by i) as markup from t where before <= 800 group by doc_id"""
)
def chunk_markup(spark: SparkSession, d: str) -> DataFrame:
    parts = documents(spark, d).withColumn("s", X.split_sentences(F.col("text"))).where(F.size("s") > 0)
    return parts.select("doc_id", X.chunk_markup(F.col("s")).alias("markup"))


REPLIES = "case doc_id % 6 when 0 then 'split_after: 2, ' || doc_id % 9 when 1 then 'split_after: none' when 2 then 'Split_After: 2' when 3 then 'ok' || chr(10) || 'split_after: ' || doc_id % 4 || ', x, -1' when 4 then 'no marker 3 and ' || doc_id % 5 else 'split_after: 5, 2' end"


def reply_rows(spark: SparkSession, d: str) -> DataFrame:
    """A reply for each document, of several kinds, with the number of its sentences."""
    return documents(spark, d).select("doc_id", "text", X.split_sentences(F.col("text")).alias("s"), F.expr(REPLIES.replace("chr(10)", "'\n'")).alias("reply"))


@query(
    f"""with r as (select doc_id, {REPLIES} as reply, len({SENTENCES}) as n from documents),
    l as (select *, list_filter(string_split(trim(reply), chr(10)), lambda x: contains(lower(x), 'split_after:'))[1] as line from r),
    t as (select *, string_split(line, 'split_after:')[2] as tail from l)
    select doc_id, array_to_string(case when contains(lower(reply), 'none') or tail is null then [] else
      list_filter(list_transform(list_filter(list_transform(string_split(tail, ','), lambda w: trim(w)), lambda w: regexp_full_match(w, '\\d+')), lambda w: cast(w as integer)), lambda x: x >= 0 and x < n - 1) end, ',') as splits from t"""
)
def llm_parse_splits(spark: SparkSession, d: str) -> DataFrame:
    rows = reply_rows(spark, d)
    return rows.select("doc_id", F.array_join(X.section_splits(F.col("reply"), F.size("s")).cast("array<string>"), ",").alias("splits"))


@query(
    f"""with r as (select doc_id, {REPLIES} as reply from documents),
    f as (select doc_id, list_transform(regexp_extract_all(coalesce(list_filter(string_split(reply, chr(10)), lambda x: contains(lower(x), 'split_after:'))[1], reply), '\\d+'), lambda x: cast(x as integer)) as f from r)
    select doc_id, case when len(f) > 0 and list_sort(f) = f and len(list_filter(f, lambda x: x < 1)) = 0 then array_to_string(f, ',') end as splits from f"""
)
def llm_parse_text_splits(spark: SparkSession, d: str) -> DataFrame:
    found = X.text_splits(F.col("reply"), F.lit(1))
    return reply_rows(spark, d).select("doc_id", F.when(found.isNotNull(), F.array_join(found.cast("array<string>"), ",")).alias("splits"))


@query(
    f"""with s as (select doc_id, {SENTENCES} as s from documents),
    b as (select doc_id, s, list_sort(list_distinct(list_concat([0], list_filter([2, 5], lambda x: x < len(s) - 1), [len(s)]))) as b from s),
    e as (select doc_id, s, b, unnest(range(1, len(b))) as i from b)
    select doc_id, cast(i as integer) as part, array_to_string(s[b[i] + 1 : b[i + 1]], ' ') as chunk from e"""
)
def llm_apply_splits(spark: SparkSession, d: str) -> DataFrame:
    rows = documents(spark, d).select("doc_id", X.split_sentences(F.col("text")).alias("s"))
    splits = F.filter(F.array(F.lit(2), F.lit(5)), lambda x: x < F.size("s") - 1)
    return rows.select("doc_id", F.explode(guided.apply_splits(F.col("s"), splits)).alias("p")).select("doc_id", "p.part", F.col("p.text").alias("chunk"))


# Sources.


@query(
    """select vec_id as doc_id, len(list_filter([vec_id % 120, vec_id % 45 * 2], lambda w: w > 50 and vec_id % 77 > 50)) > 0 as has_images,
    array_to_string(list_transform(list_filter([1, 2, 3], lambda i: (vec_id * i) % 10 / 10.0 > 0.3), lambda i: 'word' || i), ' ') as ocr from embeddings"""
)
def image_gate_and_ocr(spark: SparkSession, d: str) -> DataFrame:
    v = F.col("vec_id")
    box = lambda w: F.struct(w.cast("double").alias("width"), (-(v % 77)).cast("double").alias("height"))
    seen = F.transform(F.array(F.lit(1), F.lit(2), F.lit(3)), lambda i: F.struct(F.concat(F.lit("word"), i.cast("string")).alias("text"), ((v * i) % 10 / 10.0).alias("confidence")))
    return table(spark, d, "embeddings").select(v.alias("doc_id"), X.image_gate(F.array(box(v % 120), box(v % 45 * 2))).alias("has_images"), X.ocr_text(seen).alias("ocr"))


@query(f"with {PDF_PAGES} select doc_id, text from pdf_docs")
def pdf_pages_text(spark: SparkSession, d: str) -> DataFrame:
    return sections.pages_text(pdf_pages(spark, d))


@query(
    r"""with p as (select conv_id, turn + 1 as n, turn, text, role from conversations),
    t as (select *, case when turn % 4 = 1 then [role || ' | ' || turn || chr(10) || 'a | b', 'x'] else [] end as tables, case when turn % 3 = 0 then 60 + turn else 20 end as width from p),
    parts as (select conv_id, n, tables, width, list_concat(
        case when text <> '' then [chr(10) || '--- Page ' || n || ' ---' || chr(10), regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '([a-z])([A-Z])', '\1 \2', 'g'), '(\d)([A-Z][a-z])', '\1 \2', 'g'), '([a-z])(\d+)([A-Z """
    + WS[1:-1]
    + r"""])', '\1 \2\3', 'g'), '([.!?])([A-Z])', '\1 \2', 'g')] else [] end,
        list_transform(tables, lambda x: chr(10) || '[TABLE]' || chr(10) || x || chr(10) || '[/TABLE]' || chr(10)),
        case when width > 50 then [chr(10) || '[OCR_TEXT_PAGE_' || n || ']' || chr(10) || 'seen ' || role || chr(10) || '[/OCR_TEXT]' || chr(10)] else [] end) as parts from t)
    select conv_id as doc_id, array_to_string(flatten(list(parts order by n)), chr(10)) as text, cast(count(*) as integer) as num_pages, cast(sum(len(tables)) as integer) as num_tables, cast(count(*) filter (where width > 50) as integer) as num_images, cast(2 * count(*) filter (where width > 50) as integer) as ocr_segments from parts group by conv_id"""
)
def pdf_content(spark: SparkSession, d: str) -> DataFrame:
    turn, number = F.col("turn"), F.col("turn").cast("string")
    cells = F.concat(F.col("role"), F.lit(" | "), number, F.lit("\na | b"))
    tables = F.when(turn % 4 == 1, F.array(cells, F.lit("x"))).otherwise(F.array().cast("array<string>"))
    image = F.struct((turn + 1).cast("int").alias("page"), F.lit(0.0).alias("x0"), F.lit(0.0).alias("y0"), F.lit(0.0).alias("x1"), F.lit(0.0).alias("y1"), F.when(turn % 3 == 0, 60.0 + turn).otherwise(20.0).alias("width"), F.lit(-70.0).alias("height"), F.lit(None).cast("string").alias("format"), F.lit(None).cast("binary").alias("data"))
    seen = F.array(*(F.struct(t.alias("text"), F.lit(c).alias("confidence")) for t, c in ((F.lit("seen"), 0.9), (F.lit("blurred"), 0.3), (F.col("role"), 0.31))))
    pages = table(spark, d, "conversations").select(F.col("conv_id").cast("string").alias("path"), (turn + 1).cast("int").alias("page_no"), "text", tables.alias("tables"), F.array(image).alias("images"), seen.alias("detections"))
    return files.pdf_content(pages).select(F.col("path").cast("long").alias("doc_id"), "text", *(F.col(f"metadata.{c}").alias(c) for c in ("num_pages", "num_tables", "num_images", "ocr_segments")))


def as_files(rows: DataFrame, name: str) -> str:
    """A file for each row (file, text) of a small table; returns their folder."""
    path = f"{shared_dir(rows.sparkSession)}/{name}-{uuid.uuid4().hex}"
    rows.select("file", "text").write.partitionBy("file").option("lineSep", "\r\n").text(path)
    return path


@query("select sha256(text || chr(10)) as text_sha256, count(*) as n, 'txt' as file_type, cast(0 as bigint) as n_tables from benchmark group by text")
def read_txt(spark: SparkSession, d: str) -> DataFrame:
    path = as_files(table(spark, d, "benchmark").select(F.col("item_id").alias("file"), "text"), "text-files")
    found = files.read_txt(spark, path, "*.txt").groupBy("text", "metadata.file_type", F.size("tables").alias("n_tables")).agg(F.count("*").alias("n"))
    return found.select(F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"), "n", "file_type", F.col("n_tables").cast("long").alias("n_tables"))


@query("select sha256('| a |' || chr(10) || '|---|' || chr(10) || '| 1 |' || chr(10) || chr(10) || text || chr(10)) as text_sha256, count(*) as n, 'md' as file_type, cast(1 as bigint) as n_tables from benchmark group by text")
def read_md(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "benchmark").select(F.col("item_id").alias("file"), F.concat(F.lit("| a |\n|---|\n| 1 |\n\n"), F.col("text")).alias("text"))
    found = files.full_text(files.read_md(spark, as_files(rows, "md-files"), "*.txt")).withColumn("n_tables", F.size(X.md_tables(F.col("text"))))
    return found.groupBy("text", "n_tables").agg(F.count("*").alias("n")).select(F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"), "n", F.lit("md").alias("file_type"), F.col("n_tables").cast("long").alias("n_tables"))


@query("select lower(regexp_extract(url, '(\\.[^./]+)$', 1)) as extension, count(*) as n from pages group by 1")
def extension_router(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select(files.extension(F.col("url")).alias("extension")).groupBy("extension").agg(F.count("*").alias("n"))


@query("select source as collection, count(*) as n_records from documents group by 1")
def collection_counts(spark: SparkSession, d: str) -> DataFrame:
    return stats.collection_counts(documents(spark, d), "source").withColumnRenamed("source", "collection")


# Sections.

MD_SECTIONS = rf"""{MD_DOCS},
md_lines as (select doc_id, unnest(range(len(l))) as pos, unnest(l) as line from (select doc_id, string_split(text, chr(10)) as l from md_docs)),
md_heads as (select *, case when regexp_matches(line, '\A##{WS}+.+\z') then {strip_sql(f"regexp_extract(line, '(?s)^##{WS}+(.+)$', 1)")} end as h2,
  case when regexp_matches(line, '\A###{WS}+.+\z') then {strip_sql(f"regexp_extract(line, '(?s)^###{WS}+(.+)$', 1)")} end as h3 from md_lines),
md_marked as (select *, sum(case when h2 is not null or h3 is not null then 1 else 0 end) over w as section, last_value(h2 ignore nulls) over w as under from md_heads window w as (partition by doc_id order by pos)),
md_found as (select doc_id, section, max(case when h2 is not null then 2 when h3 is not null then 3 else 0 end) as level, max(coalesce(h2, h3)) as title, max(under) as under,
  {strip_sql("coalesce(string_agg(line, chr(10) order by pos) filter (where h2 is null and h3 is null), '')")} as content from md_marked group by doc_id, section),
md_sections as (select doc_id, cast(row_number() over (partition by doc_id order by section) - 1 as integer) as section_no, level, coalesce(title, 'Document Header') as title, case when level = 3 then under end as parent, content
  from md_found where content <> '')"""


@query(f"with {MD_SECTIONS} select * from md_sections")
def md_sections(spark: SparkSession, d: str) -> DataFrame:
    return sections.md_sections(md_docs(spark, d))


def clean_sql(x: str) -> str:
    return strip_sql(rf"regexp_replace(regexp_replace({x}, '<!-- image -->{WS}*', '', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g')")


SECTION_CHUNK = clean_sql("coalesce('[Parent Section: ' || nullif(parent, '') || ']' || chr(10) || chr(10), '') || case level when 2 then '## ' || title || chr(10) || chr(10) when 3 then '### ' || title || chr(10) || chr(10) else '' end || content")


@query(f"with {MD_SECTIONS}, c as (select doc_id, section_no, level, title, parent, {SECTION_CHUNK} as chunk from md_sections) select *, length(chunk) as length from c where length(chunk) >= 50")
def md_section_chunks(spark: SparkSession, d: str) -> DataFrame:
    return sections.md_section_chunks(md_sections(spark, d))


PDF_SECTIONS = rf"""{PDF_PAGES},
    pieces as (select doc_id, unnest(range(1, len(p) + 1)) as page, unnest(p) as piece from (select doc_id, regexp_split_to_array(text, '--- Page \d+ ---') as p from pdf_docs)),
    ls as (select doc_id, page, unnest(range(len(l))) as pos, unnest(l) as line from (select doc_id, page, string_split(piece, chr(10)) as l from pieces)),
    bs as (select *, {strip_sql("line")} as bare from ls),
    hs as (select *, case when length(regexp_extract(bare, '^(\d{{1,2}})\s*[.)]\s*(.+)$', 2)) > 5 then regexp_extract(bare, '^(\d{{1,2}})\s*[.)]\s*(.+)$', 1) || '. ' || {strip_sql(r"regexp_extract(bare, '^(\d{1,2})\s*[.)]\s*(.+)$', 2)")}
      when regexp_full_match(bare, '[A-Z][A-Z\s]{{10,}}') and regexp_matches(bare, '[A-Z]\s+[A-Z]') then bare end as head from bs where bare <> ''),
    ms as (select *, count(head) over (partition by doc_id order by page, pos rows unbounded preceding) as section from hs),
    fs as (select doc_id, section, coalesce(max(head), 'Document Start') as title, coalesce(max(case when head is not null then page end), 1) as page_start,
      {strip_sql("coalesce(string_agg(line, chr(10) order by page, pos) filter (where head is null), '')")} as content from ms group by doc_id, section),
    pdf_sections as (select doc_id, cast(row_number() over (partition by doc_id order by section) - 1 as integer) as section_no, title, cast(page_start as integer) as page_start, content, cast(greatest(page_start - 1, 1) as integer) as true_page
    from fs where length(content) > 50)"""


@query(f"with {PDF_SECTIONS} select * from pdf_sections")
def pdf_sections(spark: SparkSession, d: str) -> DataFrame:
    return sections.pdf_sections(sections.pages_text(pdf_pages(spark, d)))


# Chunkers.


def fixed_sql(chars: int, repeat: int) -> str:
    """Recursive steps c (doc_id, n, chunk) of chunks of so many characters, with so many repeated."""
    piece = f"text[s + 1 : s + {chars}]"
    snap = f"greatest(coalesce({chars} - nullif(strpos(reverse({piece}), ' '), 0), -1), coalesce({chars} - nullif(strpos(reverse({piece}), chr(10)), 0), -1))"
    back = f"greatest(s, e - least({repeat}, e - s))"
    space = f"strpos(text[{back} + 1 : least({back} + 50, e)], ' ') - 1"
    begin = f"{back} + case when {back} > s and {space} > 0 and {space} < 20 then {space} + 1 else 0 end"
    following = f"case when n = 0 or e >= length(text) or {begin} <= s then e else {begin} end" if repeat else "e"
    return f"""c as (
      select doc_id, text, 0 as n, 0 as s, 0 as e, '' as chunk from documents
      union all
      select doc_id, text, n + 1, s, s + length(p), p from (
        select doc_id, text, n, s, case when s + {chars} < length(text) and {snap} > {chars // 2} then text[s + 1 : s + 1 + {snap}] else {piece} end as p
        from (select doc_id, text, n, {following} as s from c where n = 0 or e < length(text)) where s < length(text)))"""


@query(f"with recursive {fixed_sql(256, 0)} select doc_id, cast(n - 1 as integer) as chunk_no, chunk from c where n > 0")
def fixed_chunks(spark: SparkSession, d: str) -> DataFrame:
    return chunkers.fixed_chunks(documents(spark, d), 64)


@query(f"with recursive {fixed_sql(256, 64)} select doc_id, cast(n - 1 as integer) as chunk_no, chunk from c where n > 0")
def fixed_chunks_overlap(spark: SparkSession, d: str) -> DataFrame:
    return chunkers.fixed_chunks(documents(spark, d), 64, 16)


# The separators of recursive chunks.
SEPARATORS_SQL = "[chr(10) || chr(10), chr(10), '.', '?', '!', ' ', '']"


def pieces_sql(docs: str, size: int, overlap: int) -> str:
    """Recursive steps of pieces (doc_id, chunk_no, chunk) of the texts in docs.

    node: texts still to be divided, by path; part: their parts; runs: neighbouring parts that are small, with running
    sums of their tokens; chain: beginnings and ends of the chunks of a run.
    """
    split = f"""select *, list_filter(case when sep = '' then string_split(text, '') else list_transform(range(1, len(string_split(text, sep)) + 1), lambda i: case when i = 1 then string_split(text, sep)[1] else sep || string_split(text, sep)[i] end) end, lambda x: x <> '') as parts
        from (select *, {SEPARATORS_SQL}[lvl] as sep from (select *, list_filter(range(lev, 8), lambda i: {SEPARATORS_SQL}[i] = '' or contains(text, {SEPARATORS_SQL}[i]))[1] as lvl from {{nodes}}))"""
    return f"""node as (
      select doc_id, [0::bigint] as path, text, 1::bigint as lev from {docs} where text <> ''
      union all
      select doc_id, list_append(path, i), part, lvl + 1 from (select doc_id, path, lvl, unnest(parts) as part, unnest(range(1, len(parts) + 1)) as i from ({split.format(nodes="node")})) where length(part) // 4 >= {size}),
    part as (select doc_id, path, part, i, length(part) // 4 as n, count(*) filter (where length(part) // 4 >= {size}) over (partition by doc_id, path order by i) as g
      from (select doc_id, path, unnest(parts) as part, unnest(range(1, len(parts) + 1)) as i from ({split.format(nodes="node")}))),
    runs as materialized (select doc_id, list_append(path, min(i)) as path, list(part order by i) as parts, list_concat([0::hugeint], list(total order by i)) as sums
      from (select *, sum(n) over (partition by doc_id, path, g order by i) as total from part where n < {size}) group by doc_id, path, g),
    chain as (
      select doc_id, path, parts, sums, 1::bigint as a, len(list_filter(sums, lambda x: x <= {size})) - 1 as b from runs
      union all
      select doc_id, path, parts, sums, a, len(list_filter(sums, lambda x: x <= sums[a] + {size})) - 1
      from (select * replace (least(len(list_filter(sums, lambda x: x < greatest(sums[b + 1] - {overlap}, sums[b + 2] - {size}))) + 1, b + 1) as a) from chain where b < len(parts))),
    pieces as (select doc_id, cast(row_number() over (partition by doc_id order by path, a) - 1 as integer) as chunk_no, chunk
      from (select doc_id, path, a, {strip_sql("array_to_string(parts[a : b], '')")} as chunk from chain) where chunk <> '')"""


@query(f"with recursive docs as (select doc_id, replace(text, chr(10), chr(10) || chr(10)) as text from documents), {pieces_sql('docs', 100, 20)} select * from pieces")
def recursive_chunks(spark: SparkSession, d: str) -> DataFrame:
    return chunkers.recursive_chunks(para_docs(spark, d), 100, 20)


@query(f"with recursive {pieces_sql('documents', 50, 0)} select * from pieces")
def small_pieces(spark: SparkSession, d: str) -> DataFrame:
    return chunkers.small_pieces(documents(spark, d))


@query(
    f"""with recursive {fixed_sql(256, 0)},
    b as (select doc_id, n, chunk, lag(chunk) over (partition by doc_id order by n) as before from c where n > 0),
    t as (select *, before[greatest(0, length(before) - 64) + 1 :] as tail from b),
    u as (select *, strpos(tail, ' ') - 1 as place from t)
    select doc_id, cast(n - 1 as integer) as chunk_no, case when before is null or length(before) // 4 <= 16 then chunk when place > 0 and place < length(tail) // 4 then tail[place + 2 :] || ' ' || chunk else tail || ' ' || chunk end as chunk from u"""
)
def overlap_prefix(spark: SparkSession, d: str) -> DataFrame:
    return chunkers.overlap_prefix(chunkers.fixed_chunks(documents(spark, d), 64), 16)


def packed_sql(sections: str, table: str, header: str, clean: Callable[[str], str], most: int, columns: str) -> str:
    """Chunks of sections that have one paragraph each (as those of the test tables do), packed by sentences."""
    line = "chr(10) || chr(10)"
    return f"""with recursive {sections},
    sec as (select *, {header} as header from {table}),
    fits as (select *, length(header) // 4 + length(content) // 4 <= {most} as fits from sec),
    para as (select *, {strip_sql("content")} as para from fits where not fits),
    sen as (select doc_id, section_no, header, unnest(l) as s, generate_subscripts(l, 1) as i from (select *, case when length(para) // 4 > {most} then string_split(regexp_replace(para, '([.!?]){WS}+', '\\1' || chr(1), 'g'), chr(1)) else [para] end as l from para)),
    r as (select doc_id, section_no, i, 1 as g, case when length(header) // 4 + length(s) // 4 > {most} then length(header || {line} || s) // 4 else length(header) // 4 + length(s) // 4 end as used from sen where i = 1
      union all
      select sen.doc_id, sen.section_no, sen.i, case when used + length(s) // 4 > {most} then g + 1 else g end, case when used + length(s) // 4 > {most} then length(header || {line} || s) // 4 else used + length(s) // 4 end
      from r join sen on sen.doc_id = r.doc_id and sen.section_no = r.section_no and sen.i = r.i + 1),
    split as (select doc_id, section_no, g as chunk_part, string_agg(s, ' ' order by i) as body from r join sen using (doc_id, section_no, i) group by all),
    both_ as (select doc_id, section_no, cast(null as integer) as chunk_part, content as body from fits where fits union all select * from split),
    out_ as (select {columns}, {clean(f"header || {line} || body")} as chunk, chunk_part is not null as is_split, coalesce(chunk_part, 0) as chunk_part from both_ join sec using (doc_id, section_no))
    select *, cast(row_number() over (partition by doc_id order by section_no, chunk_part) - 1 as integer) as chunk_no, length(chunk) // 4 as tokens from out_ where length(chunk) >= 50"""


def clean_pages_sql(x: str) -> str:
    return strip_sql(rf"regexp_replace(regexp_replace({x}, '--- Page \d+ ---{WS}*', '', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g')")


MD_HEADER = "coalesce('[Parent Section: ' || nullif(parent, '') || ']' || case when level > 0 then chr(10) else '' end, '') || case level when 2 then '## ' || title when 3 then '### ' || title else '' end"


@query(packed_sql(MD_SECTIONS, "md_sections", MD_HEADER, clean_sql, 64, "doc_id, section_no, level, title, parent"))
def ctx_md_chunks(spark: SparkSession, d: str) -> DataFrame:
    return chunkers.context_md_chunks(md_sections(spark, d), 64).fillna(0, ["chunk_part"])


@query(packed_sql(PDF_SECTIONS, "pdf_sections", "'[Section: ' || title || ']'", clean_pages_sql, 64, "doc_id, section_no, title, page_start, true_page"))
def ctx_pdf_chunks(spark: SparkSession, d: str) -> DataFrame:
    return chunkers.context_pdf_chunks(pdf_sections(spark, d), 64).fillna(0, ["chunk_part"])


OVERSIZED = rf"""docs as (select doc_id, '## Document' || chr(10) || chr(10) || replace(text, chr(10), chr(10) || chr(10)) as chunk, chr(10) || chr(10) || replace(text, chr(10), chr(10) || chr(10)) as body from documents),
sized as (select *, length(chunk) // 4 > 800 or octet_length(encode(chunk)) > 14000 as large from docs),
paras as (select doc_id, unnest(l) as para, unnest(range(1, len(l) + 1)) as p from (
  select doc_id, list_filter(list_transform(string_split_regex(body, '\n\n+'), lambda x: {strip_sql("x")}), lambda x: x <> '') as l from sized where large)),
items as (select doc_id, kind, para, item, row_number() over (partition by doc_id order by p, k) as i, p from (
  select doc_id, 'p' as kind, p as para, para as item, p, 0 as k from paras where length(para) // 4 <= 800
  union all
  select doc_id, 's', p, unnest(l), p, unnest(range(1, len(l) + 1)) from (select doc_id, p, string_split(regexp_replace(para, '([.!?]){WS}+', '\1' || chr(1), 'g'), chr(1)) as l from paras where length(para) // 4 > 800))),
steps as (
  select doc_id, i, kind, para, item, 1 as g, case when over then length(full_) // 4 else base + n end as used from (select *, length('## Document' || chr(10) || chr(10) || item) as x, '## Document' || chr(10) || chr(10) || item as full_, 2 as base, length(item) // 4 as n, 2 + length(item) // 4 > 800 as over from items where i = 1)
  union all
  select doc_id, i, kind, para, item, case when fresh or base + n > 800 then g + 1 else g end, case when base + n > 800 then length('## Document' || chr(10) || chr(10) || item) // 4 else base + n end
  from (select t.*, s.g, length(t.item) // 4 as n, s.kind <> t.kind or (t.kind = 's' and s.para <> t.para) as fresh, case when s.kind <> t.kind or (t.kind = 's' and s.para <> t.para) then 2 else s.used end as base
    from steps s join items t on t.doc_id = s.doc_id and t.i = s.i + 1)),
parts as (select doc_id, g, {clean_sql("body")} as chunk from (select doc_id, g, '## Document' || chr(10) || chr(10) || case when kind = 's' then array_to_string(l, ' ') else array_to_string(l, chr(10) || chr(10)) end as body from (select doc_id, g, kind, list(item order by i) as l from steps group by doc_id, g, kind))),
both_ as (select doc_id, 0 as sub_chunk_part, '' as split_reason, chunk from sized where not large union all select doc_id, row_number() over (partition by doc_id order by g), 'size_exceeded', chunk from parts)"""


@query(f"with recursive {OVERSIZED} select doc_id, cast(row_number() over (partition by doc_id order by sub_chunk_part) - 1 as integer) as chunk_no, cast(sub_chunk_part as integer) as sub_chunk_part, split_reason, chunk from both_")
def oversized_split(spark: SparkSession, d: str) -> DataFrame:
    chunks = para_docs(spark, d).select("doc_id", F.lit(0).alias("chunk_no"), F.concat(F.lit("## Document\n\n"), F.col("text")).alias("chunk"))
    return chunkers.split_oversized(chunks, F.lit("## Document")).select("doc_id", "chunk_no", "sub_chunk_part", "split_reason", "chunk").fillna({"sub_chunk_part": 0, "split_reason": ""})


def series(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select("label", "vec_id", "embedding")


@query(
    f"""with s as (select doc_id, unnest({SENTENCES}) as c, generate_subscripts({SENTENCES}, 1) - 1 as n from documents)
    select doc_id, cast(n as integer) as chunk_no, string_agg(c, ' ') over (partition by doc_id order by n rows between 3 preceding and 3 following) as combined from s"""
)
def kamradt_context(spark: SparkSession, d: str) -> DataFrame:
    return semantic.with_context(documents(spark, d).select("doc_id", F.posexplode(X.split_sentences(F.col("text"))).alias("chunk_no", "chunk"))).drop("chunk")


DISTANCE = """v as (select label, vec_id, list_transform(embedding, lambda x: cast(x as double)) as v from embeddings),
dist as (select label, vec_id, 1 - list_dot_product(v, lead(v) over w) / (sqrt(list_dot_product(v, v)) * sqrt(list_dot_product(lead(v) over w, lead(v) over w))) as distance from v window w as (partition by label order by vec_id))"""


@query(f"with {DISTANCE} select label, vec_id, round(distance, 6) as distance from dist")
def kamradt_distance(spark: SparkSession, d: str) -> DataFrame:
    return semantic.neighbour_distance(series(spark, d), ["label"], "vec_id").select("label", "vec_id", F.round("distance", 6).alias("distance"))


@query(
    f"""with recursive {DISTANCE},
    base as (select label, greatest(1, count(*) * 40 // 400) as cuts, list(distance) filter (where distance is not null) as ds from dist group by label),
    b as (select label, cuts, ds, 0.0::double as lo, 1.0::double as hi, 0.5::double as t, 0 as n from base
      union all
      select label, cuts, ds, case when len(list_filter(ds, lambda x: x > (lo + hi) / 2)) > cuts then (lo + hi) / 2 else lo end, case when len(list_filter(ds, lambda x: x > (lo + hi) / 2)) > cuts then hi else (lo + hi) / 2 end, (lo + hi) / 2, n + 1
      from b where n < 20)
    select label, cuts, round(t, 9) as threshold from b where n = 20"""
)
def kamradt_threshold(spark: SparkSession, d: str) -> DataFrame:
    far = semantic.neighbour_distance(series(spark, d), ["label"], "vec_id")
    return semantic.thresholds(far, ["label"], 400, F.lit(40)).withColumn("threshold", F.round("threshold", 9))


@query(
    f"""with {DISTANCE}, m as (select *, coalesce(lag(distance > 0.9) over (partition by label order by vec_id), false) as cut from dist),
    g as (select *, sum(cast(cut as integer)) over (partition by label order by vec_id) as chunk_no from m)
    select label, cast(chunk_no as integer) as chunk_no, string_agg('v' || vec_id, ' ' order by vec_id) as chunk from g group by label, chunk_no"""
)
def kamradt_regroup(spark: SparkSession, d: str) -> DataFrame:
    far = semantic.neighbour_distance(series(spark, d), ["label"], "vec_id").withColumn("chunk", F.concat(F.lit("v"), F.col("vec_id").cast("string")))
    return semantic.regrouped(far, ["label"], "vec_id", F.coalesce(F.col("distance") > 0.9, F.lit(False)))


def letters_sql(x: str) -> str:
    """The vector of a text by how often it has each letter."""
    counted = f"list_transform(range(97, 123), lambda c: cast(2 * length({x}[:10000]) - length(replace({x}[:10000], chr(c::int), '')) - length(replace({x}[:10000], chr(c::int - 32), '')) as double))"
    return f"(select cast(case when list_dot_product(v, v) = 0 then v else list_transform(v, lambda y: y / sqrt(list_dot_product(v, v))) end as float[]) from (select {counted} as v))"


def unit_sql(v: str) -> str:
    return f"case when list_dot_product({v}, {v}) = 0 then {v} else list_transform({v}, lambda x: x / sqrt(list_dot_product({v}, {v}))) end"


@query(
    f"""with recursive {pieces_sql('documents', 50, 0)},
    near as (select *, string_agg(chunk, ' ') over (partition by doc_id order by chunk_no rows between 3 preceding and 3 following) as combined from pieces),
    v as (select doc_id, chunk_no, chunk, cast({letters_sql("combined")} as double[]) as v from near),
    n as (select *, lead(v) over (partition by doc_id order by chunk_no) as w from v),
    dist as materialized (select doc_id, chunk_no, chunk, case when w is not null then 1 - list_dot_product(v, w) / (case when list_dot_product(v, v) = 0 then 1 else sqrt(list_dot_product(v, v)) end * case when list_dot_product(w, w) = 0 then 1 else sqrt(list_dot_product(w, w)) end) end as distance from n),
    base as (select doc_id, greatest(1, sum(length(chunk) // 4) // 200) as cuts, coalesce(list(distance) filter (where distance is not null), []) as ds from dist group by doc_id),
    b as (select doc_id, cuts, ds, 0.0::double as lo, 1.0::double as hi, 0.5::double as t, 0 as n from base
      union all
      select doc_id, cuts, ds, case when len(list_filter(ds, lambda x: x > (lo + hi) / 2)) > cuts then (lo + hi) / 2 else lo end, case when len(list_filter(ds, lambda x: x > (lo + hi) / 2)) > cuts then hi else (lo + hi) / 2 end, (lo + hi) / 2, n + 1 from b where n < 20),
    m as (select dist.*, coalesce(lag(distance > t) over (partition by doc_id order by chunk_no), false) as cut from dist join (select doc_id, t from b where n = 20) using (doc_id)),
    g as (select *, sum(cast(cut as integer)) over (partition by doc_id order by chunk_no) as part from m)
    select doc_id, cast(part as integer) as chunk_no, string_agg(chunk, ' ' order by chunk_no) as chunk from g group by doc_id, part"""
)
def kamradt_chunks(spark: SparkSession, d: str) -> DataFrame:
    return semantic.breakpoint_chunks(documents(spark, d), 200, embedder=LetterEmbedder())


@query(
    """with v as (select label, row_number() over (partition by label order by vec_id) - 1 as i, list_transform(embedding, lambda x: cast(x as double)) as v from embeddings)
    select a.label, cast(a.i as integer) as i, cast(b.i as integer) as j, round(list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))), 6) as similarity
    from v a join v b on a.label = b.label and b.i > a.i and b.i < a.i + 8"""
)
def cluster_band_sim(spark: SparkSession, d: str) -> DataFrame:
    return semantic.band_similarity(series(spark, d), ["label"], "vec_id", 8).withColumn("similarity", F.round("similarity", 6))


@query(
    """with v as (select label, vec_id, list_transform(embedding, lambda x: cast(x as double)) as v from embeddings), u as (select label, vec_id, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) as v from v)
    select a.label, (select count(*) from v w where w.label = a.label) as n, round(avg(list_dot_product(a.v, b.v)), 6) as mean from u a join u b on a.label = b.label and a.vec_id < b.vec_id group by a.label"""
)
def cluster_mean_sim(spark: SparkSession, d: str) -> DataFrame:
    return semantic.mean_similarity(series(spark, d), ["label"]).withColumn("mean", F.round("mean", 6))


@query(
    """with recursive v as (select label, row_number() over (partition by label order by vec_id) - 1 as i, list_transform(embedding, lambda x: cast(x as double)) as v from embeddings),
    u as (select label, i, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) as v from v),
    m as (select a.label, avg(list_dot_product(a.v, b.v)) as mean from u a join u b on a.label = b.label and a.i < b.i group by a.label),
    near as (select a.label, a.i, b.i as j, list_dot_product(a.v, b.v) - mean as s from u a join u b on a.label = b.label and b.i > a.i and b.i < a.i + 8 join m on m.label = a.label),
    bounds as (select a.label, a.i as first, b.i as last from u a join u b on a.label = b.label and b.i >= a.i and b.i < a.i + 8),
    reward as materialized (select b.label, b.first, b.last, coalesce(sum(2 * s), 0) as reward from bounds b left join near n on n.label = b.label and n.i >= b.first and n.j <= b.last group by all),
    dp as (select distinct label, -1 as i, cast([] as double[]) as best, cast([] as bigint[]) as start from u
      union all
      select d.label, d.i + 1, list_append(d.best, greatest(0, max(g))), list_append(d.start, case when max(g) > 1e-12 then arg_max(first, g) else 0 end)
      from (select d.label, d.i, d.best, d.start, r.first, r.reward + case when r.first > 0 then d.best[r.first] else 0 end as g from dp d join reward r on r.label = d.label and r.last = d.i + 1) d group by d.label, d.i, d.best, d.start),
    full_ as (select label, start, i from dp where i = (select max(i) from u where u.label = dp.label)),
    walk as (select label, start, start[i + 1] as first, i as last, 0 as k from full_
      union all select label, start, start[first], first - 1, k + 1 from walk where first > 0)
    select label, cast(row_number() over (partition by label order by k desc) - 1 as integer) as segment, cast(first as integer) as first, cast(last as integer) as last from walk"""
)
def cluster_segments(spark: SparkSession, d: str) -> DataFrame:
    return semantic.cluster_segments(series(spark, d), ["label"], "vec_id", 8)


@query(
    f"""with recursive {pieces_sql('documents', 50, 0)},
    v as (select doc_id, chunk_no as i, chunk, cast({letters_sql("chunk")} as double[]) as v from pieces),
    u as materialized (select doc_id, i, {unit_sql("v")} as v from v),
    flat as (select doc_id, unnest(v) as x, unnest(range(1, 27)) as k from u),
    sums as (select doc_id, list(s order by k) as total, sum(q) as own from (select doc_id, k, sum(x) as s, sum(x * x) as q from flat group by all) group by doc_id),
    m as (select doc_id, case when n > 1 then (list_dot_product(total, total) - own) / (n * (n - 1)) else 0 end as mean from sums join (select doc_id, count(*) as n from u group by doc_id) using (doc_id)),
    near as (select a.doc_id, a.i, b.i as j, list_dot_product(a.v, b.v) - mean as s from u a join u b on a.doc_id = b.doc_id and b.i > a.i and b.i < a.i + 8 join m on m.doc_id = a.doc_id),
    bounds as (select a.doc_id, a.i as first, b.i as last from u a join u b on a.doc_id = b.doc_id and b.i >= a.i and b.i < a.i + 8),
    reward as materialized (select b.doc_id, b.first, b.last, coalesce(sum(2 * s), 0) as reward from bounds b left join near n on n.doc_id = b.doc_id and n.i >= b.first and n.j <= b.last group by all),
    dp as (select distinct doc_id, -1 as i, cast([] as double[]) as best, cast([] as integer[]) as start from u
      union all
      select d.doc_id, d.i + 1, list_append(d.best, greatest(0, max(g))), list_append(d.start, case when max(g) > 1e-12 then max(first) filter (where g > top - 1e-12) else 0 end)
      from (select d.doc_id, d.i, d.best, d.start, r.first, r.reward + case when r.first > 0 then d.best[r.first] else 0 end as g, max(r.reward + case when r.first > 0 then d.best[r.first] else 0 end) over (partition by d.doc_id) as top from dp d join reward r on r.doc_id = d.doc_id and r.last = d.i + 1) d group by d.doc_id, d.i, d.best, d.start),
    full_ as (select doc_id, start, i from dp where i = (select max(i) from u where u.doc_id = dp.doc_id)),
    walk as (select doc_id, start, start[i + 1] as first, i as last, 0 as k from full_
      union all select doc_id, start, start[first], first - 1, k + 1 from walk where first > 0)
    select w.doc_id, cast(row_number() over (partition by w.doc_id order by max(k) desc) - 1 as integer) as chunk_no, string_agg(chunk, ' ' order by i) as chunk
    from walk w join v on v.doc_id = w.doc_id and v.i between w.first and w.last group by w.doc_id, w.first"""
)
def cluster_chunks(spark: SparkSession, d: str) -> DataFrame:
    return semantic.cluster_chunks(documents(spark, d), embedder=LetterEmbedder())


@query(
    f"""with recursive {pieces_sql('documents', 50, 0)},
    lists as materialized (select doc_id, list(chunk order by chunk_no) as parts, list_concat([0::hugeint], list(total order by chunk_no)) as sums from (select *, sum(length(chunk) // 4) over (partition by doc_id order by chunk_no) as total from pieces) group by doc_id),
    walk as (
      select doc_id, parts, sums, 0::bigint as cur, []::bigint[] as cuts from lists
      union all
      select doc_id, parts, sums, case when len(here) > 0 then here[len(here)] else cur + 5 end, list_concat(cuts, here)
      from (select *, range(cur + 5, least(len(parts), len(list_filter(sums, lambda x: x <= sums[cur + 1] + 800))) + 1, 4) as here from walk where len(parts) > 3 and cur < len(parts) - 3)),
    last_ as (select doc_id, parts, list_distinct(list_filter(arg_max(cuts, cur), lambda c: c > 0 and c < len(parts))) as ends from walk group by doc_id, parts),
    bounds as (select doc_id, parts, list_sort(list_concat([0], ends, [len(parts)])) as b from last_ where len(parts) > 3),
    cut as (select doc_id, parts, unnest(range(1, len(b))) as k, b from bounds)
    select doc_id, cast(k - 1 as integer) as chunk_no, {strip_sql("array_to_string(parts[b[k] + 1 : b[k + 1]], ' ')")} as chunk from cut
    union all select doc_id, chunk_no, chunk from pieces where doc_id in (select doc_id from lists where len(parts) <= 3)"""
)
def guided_text_chunks(spark: SparkSession, d: str) -> DataFrame:
    return guided.guided_chunks(documents(spark, d))


def guided_sql(sections: str, table: str, header: str, clean: Callable[[str], str], columns: str, tail: str) -> str:
    """Chunks that the offline boundary model makes: a cut at every fourth sentence but the last."""
    sentences = SENTENCES.replace("text", "content")
    line = "chr(10) || chr(10)"
    return f"""with {sections},
    sec as (select *, {header} as header, {sentences} as s from {table}),
    cut as (select *, len(s) as n, case when len(s) > 3 then list_filter(range(4, len(s), 4), lambda x: x < len(s) - 1) else [] end as cuts from sec),
    part as (select *, unnest(range(1, len(cuts) + 2)) as part, list_concat([0], cuts, [n]) as b from cut where n > 2 and len(cuts) > 0),
    kept as (select * exclude (b), {clean(f"header || {line} || array_to_string(s[b[part] + 1 : b[part + 1]], ' ')")} as chunk from part),
    good as (select * from kept where length(chunk) >= 50),
    both_ as (
      select {columns}, n > 2 as split_by_llm, case when n > 2 then 'no_split_needed' else '' end as llm_decision, {clean(f"header || {line} || content")} as chunk, 0 as chunk_part from cut where n <= 2 or len(cuts) = 0
      union all select {columns}, true, '', chunk, cast(part as integer) from good
      union all select {columns}, true, 'fallback', header || {line} || content, 0 from cut c where n > 2 and len(cuts) > 0 and not exists (from good g where g.doc_id = c.doc_id and g.section_no = c.section_no))
    select *, cast(row_number() over (partition by doc_id order by section_no, chunk_part) - 1 as integer) as chunk_no{tail} from both_ where length(chunk) >= 50"""


NO_NULLS = {"chunk_part": 0, "llm_decision": "", "sub_chunk_part": 0, "split_reason": ""}


@query(guided_sql(MD_SECTIONS, "md_sections", MD_HEADER, clean_sql, "doc_id, section_no, level, title, parent", ", 0 as sub_chunk_part, '' as split_reason"))
def guided_md_chunks(spark: SparkSession, d: str) -> DataFrame:
    return guided.guided_md_chunks(md_sections(spark, d)).fillna(NO_NULLS)


@query(guided_sql(PDF_SECTIONS, "pdf_sections", "'[Section: ' || title || ']'", clean_pages_sql, "doc_id, section_no, title, page_start, true_page", ""))
def guided_pdf_chunks(spark: SparkSession, d: str) -> DataFrame:
    return guided.guided_pdf_chunks(pdf_sections(spark, d)).fillna({c: NO_NULLS[c] for c in ("chunk_part", "llm_decision")})


# Search.

BM25 = f"""listed as materialized (select doc_id, {TOKENS} as tokens from documents),
toks as (select doc_id, len(tokens) as length, unnest(tokens) as term from listed),
tf as materialized (select doc_id, term, count(*) as tf, any_value(length) as length from toks group by all),
stat as materialized (select count(*) as n, sum(len(tokens)) / count(*) as mean_length from listed),
raw as materialized (select term, ln(n - count(*) + 0.5) - ln(count(*) + 0.5) as raw from tf, stat group by term, n),
idf as materialized (select term, case when raw < 0 then 0.25 * (select avg(raw) from raw) else raw end as idf from raw)"""
SCORES = f"""{BM25},
asked as materialized (select query_id, term, count(*) as times from (select query_id, unnest({TOKENS}) as term from q) group by all),
scores as materialized (select query_id, doc_id as doc, sum(times * idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * length / mean_length))) as score from asked join idf using (term) join tf using (term), stat group by all),
filled as (select * from scores union all select p.query_id, p.doc_id, 0 from (select query_id, doc_id from q, documents) p anti join scores s on s.query_id = p.query_id and s.doc = p.doc_id),
keyword as (select *, row_number() over (partition by query_id order by round(score, 9) desc, doc) as rank from filled)"""


@query(f"with {BM25} select term, round(idf, 6) as idf from idf")
def bm25_idf(spark: SparkSession, d: str) -> DataFrame:
    return search.keyword_index(documents(spark, d)).idf.select("term", F.round("idf", 6).alias("idf"))


@query(f"with q as (select 0 as query_id, 'the of token ouen' as text), {SCORES} select doc, round(score, 6) as score, cast(rank as integer) as rank from keyword where rank <= 10")
def bm25_search(spark: SparkSession, d: str) -> DataFrame:
    question = spark.range(1).select(F.lit(0).alias("query_id"), F.lit("the of token ouen").alias("text"))
    return search.keyword_search(search.keyword_index(documents(spark, d)), question, 10).select("doc", F.round("score", 6).alias("score"), "rank")


@query(f"with q as (select item_id as query_id, text from benchmark), {SCORES} select query_id, doc, round(score, 6) as score, cast(rank as integer) as rank from keyword where rank <= 10")
def bm25_search_multi(spark: SparkSession, d: str) -> DataFrame:
    found = search.keyword_search(search.keyword_index(documents(spark, d)), table(spark, d, "benchmark").withColumnRenamed("item_id", "query_id"), 10)
    return found.withColumn("score", F.round("score", 6))


NEAR = """v as (select vec_id, list_transform(embedding, lambda x: cast(x as double)) as v from embeddings),
pairs as (select b.item_id as query_id, d.vec_id as id, {metric} as distance from benchmark b join v q on q.vec_id = b.item_id join v d on true),
near as (select *, row_number() over (partition by query_id order by round(distance, 12), id) as rank from pairs)"""
SQL2 = NEAR.format(metric="list_sum(list_transform(list_zip(q.v, d.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))")
COSINE = NEAR.format(metric="1 - list_dot_product(q.v, d.v) / (sqrt(list_dot_product(q.v, q.v)) * sqrt(list_dot_product(d.v, d.v)))")


@query(f"with {SQL2} select query_id, id, round(distance, 6) as distance, cast(rank as integer) as rank from near where rank <= 10")
def vector_topk_sql2(spark: SparkSession, d: str) -> DataFrame:
    return search.vector_search(table(spark, d, "embeddings"), asked(spark, d), 10, "sql2").withColumn("distance", F.round("distance", 6))


@query(f"with {COSINE} select query_id, id, round(distance, 6) + 0.0 as distance, cast(rank as integer) as rank from near where rank <= 10 and rank > 1")
def vector_topk_cosine(spark: SparkSession, d: str) -> DataFrame:
    return search.vector_search(table(spark, d, "embeddings"), asked(spark, d), 10, "cosine").where("rank > 1").withColumn("distance", F.round("distance", 6))


@query(f"with {SQL2.replace('near as', 'all_near as')} select id, round(distance, 6) as distance from all_near where query_id = 7 and rank <= 10")
def vector_topk_one(spark: SparkSession, d: str) -> DataFrame:
    vectors = table(spark, d, "embeddings")
    q = vectors.where("vec_id = 7").first()
    return search.vector_topk(vectors, [float(x) for x in q.embedding], 10).withColumn("distance", F.round("distance", 6))


@query(f"with {SQL2}, k as (select *, count(*) filter (where distance < 0.7) over (partition by query_id) as close from near where rank <= 20) select query_id, id, round(distance, 6) as distance, cast(rank as integer) as rank from k where distance < 0.7 or (close = 0 and rank <= 3)")
def semantic_only_fallback(spark: SparkSession, d: str) -> DataFrame:
    near = search.vector_search(table(spark, d, "embeddings"), asked(spark, d), 20)
    return search.semantic_only(near).withColumn("distance", F.round("distance", 6))


FUSED = """w as (select *, score / max(score) over (partition by query_id) as share from kw),
k as (select query_id, doc_key, sum(case when share > 0.5 then 3.0 when share > 0.2 then 2.0 else 1.0 end / (60 + rank)) as k, min(rank) as k_first, arg_max(share > 0.2, rank) as match from w where score > 0 group by all),
s as (select query_id, doc_key, sum(1.0 / (60 + rank)) as s, min(rank) as s_first from sem where distance < 0.8 group by all),
f as (select coalesce(k.query_id, s.query_id) as query_id, coalesce(k.doc_key, s.doc_key) as doc_key, coalesce(k, 0) + coalesce(s * case when match then 1.5 else 1.0 end, 0) as score, k_first, s_first from k full join s on k.query_id = s.query_id and k.doc_key = s.doc_key),
r as (select *, row_number() over (partition by query_id order by round(score, 12) desc, k_first nulls last, s_first) as rank from f)"""
RRF_ROWS = "(0, 'a', 4.0, 1), (0, 'b', 1.0, 2), (0, 'c', 0.5, 3), (0, 'z', 0.0, 4), (1, 'a', 4.0, 1), (1, 'a', 4.0, 2), (1, 'b', 3.0, 3)"
RRF_NEAR = "(0, 'b', 0.1, 1), (0, 'd', 0.3, 2), (0, 'a', 0.9, 3), (1, 'b', 0.1, 1), (1, 'a', 0.2, 2), (1, 'a', 0.2, 3)"


@query(f"with kw(query_id, doc_key, score, rank) as (values {RRF_ROWS}), sem(query_id, doc_key, distance, rank) as (values {RRF_NEAR}), {FUSED} select query_id, doc_key, round(score, 9) as score, cast(rank as integer) as rank from r")
def rrf_merge(spark: SparkSession, d: str) -> DataFrame:
    words = spark.sql(f"select query_id, doc_key, cast(score as double) as score, rank from values {RRF_ROWS} as t(query_id, doc_key, score, rank)")
    near = spark.sql(f"select query_id, doc_key, cast(distance as double) as distance, rank from values {RRF_NEAR} as t(query_id, doc_key, distance, rank)")
    return search.fused(words, near).withColumn("score", F.round("score", 9))


@query(
    f"""with q as (select item_id as query_id, text from benchmark where exists (from embeddings where vec_id = item_id)), {SCORES}, {SQL2},
    kw as (select query_id, text as doc_key, score, rank from keyword join documents on doc_id = doc where rank <= 40),
    sem as (select query_id, text as doc_key, distance, rank from near join documents on doc_id = id where rank <= 40), {FUSED}
    select query_id, sha256(doc_key) as doc_sha256, round(score, 9) as score, cast(rank as integer) as rank from r where rank <= 20"""
)
def hybrid_search(spark: SparkSession, d: str) -> DataFrame:
    docs = documents(spark, d)
    found = search.hybrid_search(search.keyword_index(docs), docs, table(spark, d, "embeddings"), asked(spark, d), 20)
    return found.select("query_id", F.sha2(F.col("doc_key").cast("binary"), 256).alias("doc_sha256"), F.round("score", 9).alias("score"), "rank")


@query(
    f"""with q as (select item_id as query_id, text from benchmark where exists (from embeddings where vec_id = item_id)), {SCORES}, {SQL2},
    kw as (select query_id, text as doc_key, score, rank from keyword join documents on doc_id = doc where rank <= 10),
    sem as (select query_id, text as doc_key, distance, rank from near join documents on doc_id = id where rank <= 10), {FUSED},
    best as (select query_id, list(doc_key order by rank) as found, list(round(score, 9) order by rank) as scores from r where rank <= 5 group by query_id)
    select query_id, sha256(text) as question_sha256, sha256(coalesce(found[1], 'No relevant passages were found.')) as answer_sha256, sha256(array_to_string(found, '#')) as found_sha256, scores from q left join best using (query_id)"""
)
def answered_questions(spark: SparkSession, d: str) -> DataFrame:
    docs = documents(spark, d)
    rows = answer.answer(search.keyword_index(docs), docs, table(spark, d, "embeddings"), asked(spark, d), 5)
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    found, scores = F.transform("retrieved", lambda r: r["content"]), F.transform("retrieved", lambda r: F.round(r["score"], 9))
    return rows.select("query_id", digest(F.col("question")).alias("question_sha256"), digest(F.col("answer")).alias("answer_sha256"), digest(F.array_join(found, "#")).alias("found_sha256"), scores.alias("scores"))


# Reports, stores and conversations.


@query("select count(*) as n_chunks, cast(0 as bigint) as n_split, cast(sum(length(text) // 4) // count(*) as bigint) as mean_tokens, min(length(text) // 4) as min_tokens, max(length(text) // 4) as max_tokens from documents")
def chunk_stats(spark: SparkSession, d: str) -> DataFrame:
    return stats.chunk_stats(documents(spark, d).withColumnRenamed("text", "chunk"))


@query(f"with {MD_SECTIONS} select level, count(*) as n_chunks from md_sections group by level")
def level_counts(spark: SparkSession, d: str) -> DataFrame:
    return stats.level_counts(md_sections(spark, d))


MARKED = "replace(text, chr(10), chr(10) || '--- Page 3 ---' || chr(10))"
LINES = f"s as (select doc_id, unnest(string_split({MARKED}, chr(10))) as c from documents)"
KEPT = f"length({strip_sql('c')}) >= 50 and not starts_with({strip_sql('c')}, '--- Page')"


def line_chunks(spark: SparkSession, d: str) -> DataFrame:
    """A chunk for each line, and for page marks between them: short ones, marks and others."""
    lines = F.split(F.replace("text", F.lit("\n"), F.lit("\n--- Page 3 ---\n")), "\n", -1)
    return documents(spark, d).select("doc_id", F.posexplode(lines).alias("chunk_no", "chunk"))


@query(f"with {LINES} select count(*) as original, count(*) filter (where {KEPT}) as kept, count(*) - count(*) filter (where {KEPT}) as removed from s")
def filter_stats(spark: SparkSession, d: str) -> DataFrame:
    return stats.filter_stats(line_chunks(spark, d))


@query(f"with {LINES} select doc_id, c as chunk from s where {KEPT}")
def filter_chunks(spark: SparkSession, d: str) -> DataFrame:
    return stats.filter_chunks(line_chunks(spark, d)).select("doc_id", "chunk")


@query("select source, doc_id, row_number() over (partition by source order by doc_id) as number, (row_number() over (partition by source order by doc_id) - 1) // 10 as batch from documents")
def batch_numbers(spark: SparkSession, d: str) -> DataFrame:
    rows = stats.batch_numbers(documents(spark, d).select("source", "doc_id"), ["source"], ["doc_id"], 10)
    return stats.numbered(rows, ["source"], ["doc_id"]).withColumn("number", F.col("number").cast("long"))


@query("select conv_id, turn, coalesce(string_agg(role || ': ' || text, chr(10)) over w, '') as history, count(*) over w as n from conversations window w as (partition by conv_id order by turn rows between 10 preceding and 1 preceding)")
def history_window(spark: SparkSession, d: str) -> DataFrame:
    rows = stats.history(table(spark, d, "conversations"))
    line = F.transform("history", lambda m: F.concat(m["role"], F.lit(": "), m["text"]))
    return rows.select("conv_id", "turn", F.array_join(line, "\n").alias("history"), F.size("history").cast("long").alias("n"))


@query("select conv_id, turn, string_agg(text, chr(10)) over w as state from conversations window w as (partition by conv_id order by turn rows between 9 preceding and current row)")
def history_state(spark: SparkSession, d: str) -> DataFrame:
    return stats.history(table(spark, d, "conversations"), before=False).select("conv_id", "turn", F.array_join(F.transform("history", lambda m: m["text"]), "\n").alias("state"))


@query(
    """with h as (select conv_id, turn, text, string_agg(role || ': ' || text || chr(10), '') over w as h from conversations window w as (partition by conv_id order by turn rows between 10 preceding and 1 preceding))
    select conv_id, turn, 'Answer from the passages below and from nothing else.' || chr(10) || chr(10) || 'Passages:' || chr(10) || 'one' || chr(10) || chr(10) || '---' || chr(10) || chr(10) || 'two' || chr(10) || chr(10)
      || case when h is null then '' else 'Conversation so far:' || chr(10) || h || chr(10) end || 'Question: ' || text || chr(10) || 'Answer:' as prompt from h"""
)
def prompt_text(spark: SparkSession, d: str) -> DataFrame:
    rows = stats.history(table(spark, d, "conversations"))
    return rows.select("conv_id", "turn", X.prompt_text(F.array(F.lit("one"), F.lit("two")), F.col("history"), F.col("text")).alias("prompt"))


@query("select d.doc_id, d.n_chars, e.lang from documents d join documents e on d.doc_id = e.doc_id")
def positional_zip(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return stats.zipped(docs.select("doc_id", "n_chars"), docs.select("doc_id", "lang"), ["doc_id"])


@query(f"with {MD_SECTIONS} select doc_id, section_no, 'level=' || level || coalesce(';parent=' || parent, '') || ';title=' || title as meta from md_sections")
def metadata_map(spark: SparkSession, d: str) -> DataFrame:
    found = md_sections(spark, d).withColumn("m", X.metadata_map(["level", "parent", "title"]))
    entries = F.transform(F.array_sort(F.map_entries("m")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return found.select("doc_id", "section_no", F.array_join(entries, ";").alias("meta"))


@query(f"""with {MD_SECTIONS} select doc_id, section_no, '{{"title":"' || title || '","level":' || level || coalesce(',"parent":"' || parent || '"', '') || '}}' as meta from md_sections""")
def metadata_json(spark: SparkSession, d: str) -> DataFrame:
    return md_sections(spark, d).select("doc_id", "section_no", X.metadata_json(["title", "level", "parent"]).alias("meta"))


@query(
    f"""with {MD_SECTIONS}, c as (select *, {SECTION_CHUNK} as chunk from md_sections)
    select doc_id, section_no as chunk_no, chr(10) || repeat('=', 80) || chr(10) || 'CHUNK #' || (section_no + 1) || chr(10) || repeat('=', 80) || chr(10) || 'Title: ' || title || chr(10) || 'Level: H' || level || chr(10)
      || coalesce('Parent Section: ' || nullif(parent, '') || chr(10), '') || 'Tokens: ' || length(chunk) // 4 || chr(10) || 'Split: No' || chr(10) || repeat('-', 80) || chr(10) || chunk || chr(10) || repeat('-', 80) || chr(10) as block from c where length(chunk) >= 50"""
)
def chunk_report(spark: SparkSession, d: str) -> DataFrame:
    chunks = md_section_chunks(spark, d).withColumns({"chunk_no": F.col("section_no"), "tokens": X.token_count(F.col("chunk")), "is_split": F.lit(False), "chunk_part": F.lit(None).cast("int")})
    return store.chunk_report(chunks)


@query("select doc_id, 0 as chunk_no, '--- Chunk 1 ---' || chr(10) || text || chr(10) || chr(10) as block from documents")
def plain_dump(spark: SparkSession, d: str) -> DataFrame:
    return store.plain_dump(documents(spark, d).select("doc_id", F.lit(0).alias("chunk_no"), F.col("text").alias("chunk")))


@query("select sha256(doc_id || ':0') as id, text as document, '{\"file\":\"' || source || '\"}' as metadata from documents")
def store_records(spark: SparkSession, d: str) -> DataFrame:
    chunks = documents(spark, d).select("doc_id", F.lit(0).alias("chunk_no"), F.col("text").alias("chunk"), F.col("source").alias("file"))
    return store.records(chunks, typed=True)


@query(
    """select conv_id, turn, '{"timestamp":"t' || turn || '","question":"q' || conv_id || '","answer":"a","retrieved_chunks":[{"chunk_id":1,"content":"x","score":0.5},{"chunk_id":2,"content":"y","score":0.25}],"num_chunks":2}' as entry from conversations"""
)
def session_log(spark: SparkSession, d: str) -> DataFrame:
    hit = lambda c, s: F.struct(F.lit(c).alias("content"), F.lit(s).alias("score"))
    rows = table(spark, d, "conversations").select("conv_id", "turn", F.concat(F.lit("t"), F.col("turn").cast("string")).alias("timestamp"), F.concat(F.lit("q"), F.col("conv_id").cast("string")).alias("question"), F.lit("a").alias("answer"), F.array(hit("x", 0.5), hit("y", 0.25)).alias("retrieved"))
    return store.interactions(rows).select("conv_id", "turn", "entry")


@query(
    """with c as (select sha256(doc_id || ':0') as id, sha256(text) as document_sha256 from documents union all select sha256(doc_id || ':1'), sha256(source) from documents)
    select *, (select count(*) from c) as n, true as was_there, false as is_there from c"""
)
def collections(spark: SparkSession, d: str) -> DataFrame:
    """A collection is written, replaced, added to, read and dropped."""
    name = f"fw_collection_{uuid.uuid4().hex}"
    chunk = lambda no, c: store.records(documents(spark, d).select("doc_id", F.lit(no).alias("chunk_no"), F.col(c).alias("chunk")))
    store.replace_collection(chunk(9, "source"), name)
    store.replace_collection(chunk(0, "text"), name)
    store.append_collection(chunk(1, "source"), name)
    kept, there = written(spark.table(name).select("id", "document"), "collection"), store.collection_exists(spark, name)
    spark.sql(f"drop table {name}")
    n = kept.count()
    return kept.select("id", F.sha2(F.col("document").cast("binary"), 256).alias("document_sha256"), F.lit(n).cast("long").alias("n"), F.lit(there).alias("was_there"), F.lit(store.collection_exists(spark, name)).alias("is_there"))


@query(
    f"""with recursive {pieces_sql('documents', 512, 50)}, kept as (select sha256(doc_id || ':' || chunk_no) as id, c from (select doc_id, chunk_no, chunk as c from pieces) where {KEPT})
    select min(id) as id, sha256(arg_min(c, id)) as document_sha256, count(*) as n from kept"""
)
def reset_collection(spark: SparkSession, d: str) -> DataFrame:
    """A collection made anew from documents, and its first record as a probe."""
    name = f"fw_collection_{uuid.uuid4().hex}"
    probe = written(store.reset_collection(documents(spark, d), name), "probe")
    n = spark.table(name).count()
    spark.sql(f"drop table {name}")
    return probe.select("id", F.sha2(F.col("document").cast("binary"), 256).alias("document_sha256"), F.lit(n).cast("long").alias("n"))


@query(f"with {SQL2.replace('near as', 'all_near as')} select id, round(distance, 6) as distance from all_near where query_id = 7 and rank <= 10")
def vector_cells(spark: SparkSession, d: str) -> DataFrame:
    """Records in cells; a search of all cells is exact."""
    vectors = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    q = vectors.where("id = 7").first()
    rows, centres = store.add_cells(vectors, 8)
    return store.search_cells(rows, centres, [float(x) for x in q.embedding], 10, metric="sql2").withColumn("distance", F.round("distance", 6))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(Q)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
