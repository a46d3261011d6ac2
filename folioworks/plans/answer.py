"""Whole pipelines: from chunks to a collection, and from questions to answers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioworks.functions.models import AnswerModel, Embedder, answers, embed
from folioworks.functions.text import prompt_text
from folioworks.operators.search import KeywordIndex, hybrid_search
from folioworks.sources.scratch import written


def embedded(chunks: DataFrame, embedder: Embedder | None = None) -> DataFrame:
    """Chunks with embedding and embed_ok."""
    return chunks.withColumn("fw_vector", embed(F.col("chunk"), embedder)).select(*chunks.columns, "fw_vector.embedding", "fw_vector.embed_ok")


def contexts(retrieved: DataFrame) -> DataFrame:
    """query_id and its passages (content, score) in order of rank."""
    ordered = F.array_sort(F.collect_list(F.struct("rank", F.col("doc_key").alias("content"), "score")))
    return retrieved.groupBy("query_id").agg(F.transform(ordered, lambda r: F.struct(r["content"].alias("content"), r["score"].alias("score"))).alias("retrieved"))


def answer(index: KeywordIndex, docs: DataFrame, vectors: DataFrame, questions: DataFrame, n: int = 100, model: AnswerModel | None = None, metric: str = "sql2") -> DataFrame:
    """query_id, question, answer, retrieved: questions (query_id, text, embedding, history) answered from the documents
    that hybrid search finds. A question without any gets a fixed answer and never reaches the model."""
    found = written(contexts(hybrid_search(index, docs, vectors, questions, n, metric)), "retrieved")  # read twice below
    rows = questions.join(found, "query_id", "left")
    past = F.col("history") if "history" in questions.columns else F.array().cast("array<struct<role:string,text:string>>")
    some = rows.where("retrieved is not null").withColumn("prompt", prompt_text(F.transform("retrieved", lambda r: r["content"]), past, F.col("text")))
    some = some.withColumn("answer", answers(F.col("prompt"), model)).select("query_id", F.col("text").alias("question"), "answer", "retrieved")
    none = rows.where("retrieved is null").select("query_id", F.col("text").alias("question"), F.lit("No relevant passages were found.").alias("answer"), "retrieved")
    return some.unionByName(none)
