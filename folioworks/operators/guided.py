"""Chunkers that ask a model where to divide. The model's replies are data: parsing and cutting them are expressions."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioworks.functions.models import BoundaryModel, EveryNth
from folioworks.functions.text import MIN_CHARS, clean_content, clean_pages, context_header, page_header, section_splits, sentence_markup, split_sentences

from folioworks.sources.scratch import written

from .chunkers import overlap_prefix, small_pieces, split_oversized

ASK = "Divide this section into parts of one theme each. Reply with 'split_after:' and the numbers of sentences, or 'split_after: none'.\n"


def apply_splits(sentences: Column, splits: Column, inclusive: bool = False) -> Column:
    """array<struct<part, text>>: slices of the sentences between split points. A split point is where the next slice
    begins; with inclusive, the sentence it names ends a slice."""
    points = F.transform(splits, lambda x: x + 1) if inclusive else splits
    bounds = F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0)), points, F.array(F.size(sentences)))))
    pairs = F.zip_with(F.slice(bounds, 1, F.greatest(F.size(bounds) - 1, F.lit(0))), F.slice(bounds, 2, F.size(bounds)), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    return F.transform(pairs, lambda p, i: F.struct((i + 1).alias("part"), F.array_join(F.slice(sentences, p["a"] + 1, p["b"] - p["a"]), " ").alias("text")))


def replies(sections: DataFrame, model: BoundaryModel | None = None) -> DataFrame:
    """sections (sentences) with the model's reply; null where there are too few sentences to ask, and for an error.
    Only prompts of asked sections go to Python. The result is written at once, so that each is asked once (but for
    tasks that run again) and all that follows sees the same reply."""
    chosen = model or EveryNth()

    @F.pandas_udf("string")
    def ask(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out = []
            for prompt in batch:
                try:
                    out.append(None if prompt is None else chosen.reply(prompt))
                except Exception:
                    out.append(None)
            yield pd.Series(out, dtype=object)

    prompt = F.concat(F.lit(ASK), F.col("title"), F.lit("\n"), sentence_markup(F.col("sentences")))
    return written(sections.withColumn("reply", ask(F.when(F.size("sentences") > 3, prompt))), "replies")


def guided_sections(replied: DataFrame, header: Column, paged: bool, inclusive: bool = False, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Chunks of sections (section_no, title, content, sentences, reply).

    Two sentences or fewer: whole. No split points: whole, no_split_needed. Else slices of at least 50 characters; if none
    is left, the section as it was, fallback.
    """
    clean = clean_pages if paged else clean_content
    splits = F.when(F.col("reply").isNotNull(), section_splits(F.col("reply"), F.size("sentences"))).otherwise(F.array().cast("array<int>"))
    rows = replied.withColumn("header", header).withColumn("splits", splits)
    whole = F.concat("header", F.lit("\n\n"), F.col("content"))
    few, none = F.size("sentences") <= 2, F.size("splits") == 0
    kept = F.filter(F.transform(apply_splits(F.col("sentences"), F.col("splits"), inclusive), lambda p: F.struct(p["part"].alias("part"), clean(F.concat(F.col("header"), F.lit("\n\n"), p["text"])).alias("text"))), lambda p: F.length(p["text"]) >= MIN_CHARS)
    rows = rows.withColumn("parts", F.when(~few & ~none, kept))
    alone = lambda text: F.array(F.struct(F.lit(None).cast("int").alias("part"), text.alias("text")))
    cut = F.coalesce(F.size("parts") > 0, F.lit(False))
    rows = rows.withColumn("out", F.when(few | none, alone(clean(whole))).when(cut, F.col("parts")).otherwise(alone(whole)))
    decision = F.when(few | cut, F.lit(None)).when(none, "no_split_needed").otherwise("fallback")
    rows = rows.withColumns({"split_by_llm": ~few, "llm_decision": decision})
    rows = rows.withColumn("p", F.explode("out")).withColumns({"chunk": F.col("p.text"), "chunk_part": F.col("p.part")}).where(F.length("chunk") >= MIN_CHARS)
    number = F.row_number().over(Window.partitionBy(*keys).orderBy("section_no", F.coalesce("chunk_part", F.lit(0)))) - 1
    return rows.withColumn("chunk_no", number).drop("content", "sentences", "reply", "splits", "parts", "out", "p")


def guided_md_chunks(sections: DataFrame, model: BoundaryModel | None = None, inclusive: bool = False, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Chunks of markdown sections where the model divides; chunks too large to store are split further."""
    asked = replies(sections.withColumn("sentences", split_sentences(F.col("content"))), model)
    header = context_header(F.col("title"), F.col("level"), F.col("parent"))
    return split_oversized(guided_sections(asked, header, False, inclusive, keys), F.col("header"), keys)


def guided_pdf_chunks(sections: DataFrame, model: BoundaryModel | None = None, inclusive: bool = False, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Chunks of paged documents' sections where the model divides."""
    asked = replies(sections.withColumn("sentences", split_sentences(F.col("content"))), model)
    return guided_sections(asked, page_header(F.col("title")), True, inclusive, keys).drop("header")


def cut_points(pieces: Sequence[str], model: BoundaryModel, limit: int = 800, tries: int = 3) -> list[int]:
    """Numbers (from 1) of the pieces after which the model divides a text, asked in windows of about ``limit`` tokens.

    A reply must be sorted and go beyond the cursor, so the walk always ends; after some bad ones the cursor moves on.
    """
    import re

    out: list[int] = []
    cursor = 0
    while cursor < len(pieces) - 3:
        shown, tokens, i = [], 0, cursor
        while i < len(pieces) and tokens <= limit:
            tokens += len(pieces[i]) // 4
            shown.append(f"<|start_chunk_{i + 1}|>{pieces[i]}<|end_chunk_{i + 1}|>")
            i += 1
        numbers: list[int] = []
        for _ in range(tries):
            try:
                reply = model.reply(f"Reply with 'split_after:' and numbers of at least {cursor}, in order.\n" + "".join(shown))
            except Exception:
                continue
            marked = [line for line in reply.split("\n") if "split_after:" in line.lower()]
            found = [int(x) for x in re.findall(r"\d+", marked[0] if marked else reply)]
            if found and found == sorted(found) and found[0] >= cursor and found[-1] > cursor and found[-1] <= len(pieces):
                numbers = found
                break
        if numbers:
            out += numbers
            cursor = numbers[-1]
        else:
            cursor += 5
    return out


def guided_chunks(docs: DataFrame, model: BoundaryModel | None = None, overlap: int = 0, keys: Sequence[str] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """Chunks of plain texts where the model divides; three pieces or fewer stay as they are."""
    chosen = model or EveryNth()
    pieces = small_pieces(docs, keys, text_col)
    schema = ", ".join(f"{k} {dict(pieces.dtypes)[k]}" for k in keys) + ", chunk_no int, chunk string"

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        parts = pdf.sort_values("chunk_no").chunk.tolist()
        if len(parts) > 3:
            ends = sorted({c for c in cut_points(parts, chosen) if 0 < c < len(parts)})
            parts = [" ".join(parts[a:b]).strip() for a, b in zip([0, *ends], [*ends, len(parts)], strict=True)]
        return pd.DataFrame([(*key, i, c) for i, c in enumerate(parts)], columns=[*keys, "chunk_no", "chunk"])

    return overlap_prefix(pieces.groupBy(*keys).applyInPandas(run, schema), overlap, keys)
