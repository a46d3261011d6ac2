"""Column expressions over texts: cleaning, repair, splitting, counting, naming and markup.

All are built-in functions, so they stay in whole-stage code generation. White space, digits and word characters are
spelled out as Unicode classes, as Java's short classes know ASCII alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that count as white space in Unicode strings, and the character class of words.
WS = r"[\s\x0b\x1c-\x1f\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
NOT_WORD = r"[^\p{L}\p{N}_\x{0600}-\x{06FF}]"
# The pattern of a pipe table (header, rule, rows), and sizes.
TABLE = r"\|(.+)\|[\r\n]+\|[-:\s|]+\|[\r\n]+((?:\|.+\|[\r\n]*)+)"
EMBED_CHARS = 10_000
MIN_CHARS = 50
MAX_TOKENS, MAX_BYTES = 800, 14_000


def strip(text: Column) -> Column:
    """text without white space at its ends."""
    return F.regexp_replace(F.regexp_replace(text, rf"\A{WS}+", ""), rf"{WS}+\z", "")


def unix_lines(text: Column) -> Column:
    return F.regexp_replace(text, r"\r\n?", "\n")


def token_count(text: Column) -> Column:
    """The default token counter: a token for every four characters."""
    return F.floor(F.length(text) / 4).cast("long")


def clean_content(text: Column) -> Column:
    """Drop image comments, shorten runs of newlines to two, strip."""
    return strip(F.regexp_replace(F.regexp_replace(text, rf"<!-- image -->{WS}*", ""), r"\n{3,}", "\n\n"))


def clean_pages(text: Column) -> Column:
    """Drop page marks, then as clean_content without image comments."""
    return strip(F.regexp_replace(F.regexp_replace(text, rf"--- Page \p{{Nd}}+ ---{WS}*", ""), r"\n{3,}", "\n\n"))


def fix_text_spacing(text: Column) -> Column:
    """Put back spaces that page extraction lost, by four rules in order."""
    # The rules.
    rules = [(r"([a-z])([A-Z])", "$1 $2"), (r"(\p{Nd})([A-Z][a-z])", "$1 $2"), (rf"([a-z])(\p{{Nd}}+)([A-Z{WS[1:-1]}])", "$1 $2$3"), (r"([.!?])([A-Z])", "$1 $2")]
    for pattern, put in rules:
        text = F.regexp_replace(text, pattern, put)
    return text


def split_sentences(text: Column, keep_all: bool = False) -> Column:
    """Sentences: cut at white space after . ! or ?; stripped and without empty ones unless keep_all."""
    parts = F.split(text, rf"(?<=[.!?]){WS}+", -1)
    return parts if keep_all else F.filter(F.transform(parts, strip), lambda s: s != "")


def split_paragraphs(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, r"\n\n+", -1), strip), lambda p: p != "")


def keyword_tokens(text: Column) -> Column:
    """Lower-case words; other characters than letters, digits, underscore and the Arabic block divide them."""
    return F.array_remove(F.split(F.lower(text), rf"{NOT_WORD}+", -1), "")


def md_tables(text: Column) -> Column:
    """Pipe tables of a text, each with a one-column rule line."""
    head, rows = (F.regexp_extract_all(text, F.lit(TABLE), F.lit(i)) for i in (1, 2))
    return F.zip_with(head, rows, lambda h, r: F.concat(F.lit("|"), h, F.lit("|\n|---|\n"), r))


def context_header(title: Column, level: Column, parent: Column) -> Column:
    """Header lines of a section: its parent, if there is one, and its title at its level; empty at level 0."""
    mark = F.when(level == 2, F.concat(F.lit("## "), title)).when(level == 3, F.concat(F.lit("### "), title))
    return F.concat_ws("\n", F.when(F.coalesce(parent, F.lit("")) != "", F.concat(F.lit("[Parent Section: "), parent, F.lit("]"))), mark)


def page_header(title: Column) -> Column:
    return F.concat(F.lit("[Section: "), title, F.lit("]"))


def embed_input(text: Column) -> Column:
    return F.substring(text, 1, EMBED_CHARS)


def preview(text: Column, n: int = 300) -> Column:
    return F.when(F.length(text) > n, F.concat(F.substring(text, 1, n), F.lit("..."))).otherwise(text)


def sentence_markup(sentences: Column) -> Column:
    """Numbered marks around sentences, from 0."""
    return F.array_join(F.transform(sentences, lambda s, i: F.concat(F.lit("<|sent_"), i.cast("string"), F.lit("|>"), s, F.lit("<|/sent_"), i.cast("string"), F.lit("|> "))), "")


def chunk_markup(chunks: Column, cursor: Column | int = 0, limit: int = 800) -> Column:
    """Numbered marks (from 1) around the chunks after cursor, up to the one whose tokens pass the limit."""
    at = F.lit(cursor) if isinstance(cursor, int) else cursor
    rest = F.slice(chunks, at + 1, F.greatest(F.size(chunks) - at, F.lit(0)))
    zero = F.struct(F.lit(0).cast("long").alias("tokens"), at.cast("int").alias("i"), F.lit("").alias("text"))

    def step(acc: Column, c: Column) -> Column:
        n = (acc["i"] + 1).cast("string")
        more = F.concat(acc["text"], F.lit("<|start_chunk_"), n, F.lit("|>"), c, F.lit("<|end_chunk_"), n, F.lit("|>"))
        return F.struct((acc["tokens"] + token_count(c)).alias("tokens"), (acc["i"] + 1).cast("int").alias("i"), F.when(acc["tokens"] <= limit, more).otherwise(acc["text"]).alias("text"))

    return F.aggregate(rest, zero, step)["text"]


def section_splits(reply: Column, n: Column) -> Column:
    """Split points of a reply on a section of n sentences: comma-separated numbers after ``split_after:`` on the first
    line that has it; none if the reply has the word none. The mark is found in any case, but read in lower case."""
    low = F.lower(reply)
    line = F.get(F.filter(F.split(strip(reply), "\n"), lambda x: F.contains(F.lower(x), F.lit("split_after:"))), F.lit(0))
    tail = F.get(F.split(line, "split_after:"), F.lit(1))
    words = F.transform(F.split(tail, ","), strip)
    numbers = F.transform(F.filter(words, lambda w: w.rlike(r"\A\p{Nd}{1,9}\z")), lambda w: w.cast("int"))
    good = F.filter(numbers, lambda x: (x >= 0) & (x < n - 1))
    none = F.array().cast("array<int>")
    return F.when(F.contains(low, F.lit("none")) | tail.isNull(), none).otherwise(good)


def text_splits(reply: Column, cursor: Column) -> Column:
    """Numbers of a reply on a whole text: of its first line with the mark, else of all; null unless they are sorted,
    not empty and none lies before cursor."""
    line = F.get(F.filter(F.split(reply, "\n"), lambda x: F.contains(F.lower(x), F.lit("split_after:"))), F.lit(0))
    found = F.transform(F.regexp_extract_all(F.coalesce(line, reply), F.lit(r"(\d{1,9})"), F.lit(1)), lambda x: x.cast("int"))
    good = (F.size(found) > 0) & (F.array_sort(found) == found) & F.forall(found, lambda x: x >= cursor)
    return F.when(good, found)


def image_gate(images: Column, least: int = 50) -> Column:
    """Whether an image is wider and higher than least."""
    return F.exists(images, lambda i: (F.abs(i["width"]) > least) & (F.abs(i["height"]) > least))


def ocr_text(detections: Column, least: float = 0.3) -> Column:
    """Texts of the detections that are sure enough, with spaces between."""
    return F.array_join(F.transform(F.filter(detections, lambda d: d["confidence"] > least), lambda d: d["text"]), " ")


#: Fixed value: what names of collections begin with.
COLLECTION_PREFIX = "llm_semantic_md_"


def collection_name(file_name: Column, prefix: str = COLLECTION_PREFIX) -> Column:
    """Name of a collection: other characters than letters, digits, dot, line and underscore become underscores."""
    return F.concat(F.lit(prefix), F.regexp_replace(F.regexp_replace(F.regexp_replace(file_name, r"[^a-zA-Z0-9._-]", "_"), r"_+", "_"), r"\A[_-]+|[_-]+\z", ""))


def table_name(file_name: Column, prefix: str = "doc_") -> Column:
    """Name of a table: lower-case letters, digits and underscores."""
    return F.concat(F.lit(prefix), F.lower(F.regexp_replace(F.regexp_replace(F.regexp_replace(file_name, r"[^a-zA-Z0-9_]", "_"), r"_+", "_"), r"\A_+|_+\z", "")))


def chunk_id(*keys: Column) -> Column:
    """An id that is the same in every run."""
    return F.sha2(F.concat_ws(":", *[k.cast("string") for k in keys]), 256)


def metadata_map(columns: Sequence[str]) -> Column:
    """Metadata as a map of strings, without the fields that are null."""
    pairs = [x for c in columns for x in (F.lit(c), F.col(c).cast("string"))]
    return F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())


def metadata_json(columns: Sequence[str]) -> Column:
    """Metadata as JSON with its types, without the fields that are null."""
    return F.to_json(F.struct(*columns))


def oversize(chunk: Column) -> Column:
    return (token_count(chunk) > MAX_TOKENS) | (F.octet_length(chunk) > MAX_BYTES)


def keep_chunk(chunk: Column, least: int = MIN_CHARS) -> Column:
    """Long enough when stripped, and no page mark."""
    return (F.length(strip(chunk)) >= least) & ~F.startswith(strip(chunk), F.lit("--- Page"))


def prompt_text(context: Column, history: Column, question: Column) -> Column:
    """The prompt for an answer: instructions, context, past messages (role, text) if any, and the question."""
    lines = F.array_join(F.transform(history, lambda m: F.concat(m["role"], F.lit(": "), m["text"], F.lit("\n"))), "")
    past = F.when(F.size(history) > 0, F.concat(F.lit("Conversation so far:\n"), lines, F.lit("\n"))).otherwise("")
    return F.concat(F.lit("Answer from the passages below and from nothing else.\n\nPassages:\n"), F.array_join(context, "\n\n---\n\n"), F.lit("\n\n"), past, F.lit("Question: "), question, F.lit("\nAnswer:"))
