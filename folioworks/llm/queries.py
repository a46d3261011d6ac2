"""The training-data queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table
from .exact_dedup import exact_dedup
from .katz_lm import score_texts
from .packing import pack
from .piece_bpe import encode_decode
from .quality import classify
from .repeated_spans import repeated_spans
from .secret_scan import ASSIGN, CANDIDATE, secret_scan
from .simhash_dedup import simhash_dedup
from .topk_search import topk_search
from .url_filter import url_filter


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op2_katz_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(read_table(spark, sf_dir, "documents"))


def op3_repeated_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_spans(read_table(spark, sf_dir, "documents"), with_text=False)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op5_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search(read_table(spark, sf_dir, "embeddings"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read_table(spark, sf_dir, "documents"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(read_table(spark, sf_dir, "pages"), read_table(spark, sf_dir, "labels"))


def op8_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup(read_table(spark, sf_dir, "documents"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(read_table(spark, sf_dir, "documents")).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_live", "n_copied", "most_owners", "most_repos")


def op10_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(read_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_quality, op2_katz_lm, op3_repeated_spans, op4_packing, op5_topk_search, op6_exact_dedup, op7_url_filter, op8_simhash_dedup, op9_secret_scan, op10_piece_bpe)}


OP5_SQL = """
with v as (
  select row_number() over () as row, vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as v from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select q.row as asked, q.vec_id as query_id, d.vec_id as vec_id, cast(list_sum(list_transform(list_zip(q.v, d.v), lambda p: p[1] * p[2])) as bigint) as score
  from v q join v d on q.vec_id % 20 = 0 and d.row <> q.row),
ranked as (select *, row_number() over (partition by asked order by score desc, vec_id) as rank from scored)
select query_id, cast(rank as integer) as rank, vec_id, score from ranked where rank <= 20
"""
OP6_SQL = r"""
with t as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as norm from documents)
select doc_id, min(doc_id) over w as keep_id, count(*) over w as group_size,
       doc_id = min(doc_id) over w as kept, sha256(norm) as text_sha256
from t window w as (partition by norm)
"""


ASSIGN_SQL = ASSIGN.replace("'", "''")
OP9_SQL = rf"""
with d as (select row_number() over () as row, doc_id, source, coalesce(text, '') as t from documents),
m as (
  select row, doc_id, source, 0 as k, 12 as least, regexp_extract_all(t, '{ASSIGN_SQL}', 0) as w, regexp_extract_all(t, '{ASSIGN_SQL}', 2) as v, string_split_regex(t, '{ASSIGN_SQL}') as g from d
  union all select row, doc_id, source, 1, 18, regexp_extract_all(t, 'AKIA[A-Z0-9]+'), regexp_extract_all(t, 'AKIA[A-Z0-9]+'), string_split_regex(t, 'AKIA[A-Z0-9]+') from d
  union all select row, doc_id, source, 2, 16, regexp_extract_all(t, '[0-9a-f]+'), regexp_extract_all(t, '[0-9a-f]+'), string_split_regex(t, '[0-9a-f]+') from d
  union all select row, doc_id, source, 3, 20, regexp_extract_all(t, '{CANDIDATE}'), regexp_extract_all(t, '{CANDIDATE}'), string_split_regex(t, '{CANDIDATE}') from d),
e as (select row, doc_id, source, k, least, unnest(w) as w, unnest(v) as v, unnest(g[1:len(w)]) as g, generate_subscripts(w, 1) as i from m where len(w) > 0),
s as (select row, doc_id, source, k, v, least, sum(length(g) + length(w)) over (partition by row, k order by i) - length(w) as a, sum(length(g) + length(w)) over (partition by row, k order by i) as z from e),
base as (select * from s where k < 3 and length(v) >= least),
more as (select * from s where k = 3 and regexp_matches(v, '[0-9]') and regexp_matches(v, '[A-Za-z]') and not exists (from base b where b.row = s.row and b.a < s.z and s.a < b.z)),
every as (select * from base union all select * from more),
owners as (select v, count(distinct coalesce(source, chr(1))) as n_owners, count(*) as n_repos from (select distinct v, source, doc_id from every) group by v),
judged as (select every.*, n_owners, n_repos, n_owners <= 2 and n_repos <= 10 as live, ['assign', 'access', 'hex', 'live'][k + 1] || ':' || cast(a as bigint) || ':' || cast(z as bigint) as written from every join owners using (v)),
sums as (
  select row, count(*) filter (where k = 0) as n_assign, count(*) filter (where k = 1) as n_access, count(*) filter (where k = 2) as n_hex, string_agg(written, ',' order by a, k) filter (where k < 3) as base,
    string_agg(written, ',' order by a, k) filter (where k < 3 or live) as spans, count(*) filter (where k < 3 and live) as n_live, count(*) filter (where k < 3 and not live) as n_copied, max(n_owners) as most_owners, max(n_repos) as most_repos from judged group by row)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans,
  coalesce(n_live, 0) as n_live, coalesce(n_copied, 0) as n_copied, coalesce(most_owners, 0) as most_owners, coalesce(most_repos, 0) as most_repos
from d left join sums using (row)
"""


def oracle_sql() -> dict[str, str]:
    return {"op5_topk_search": OP5_SQL, "op6_exact_dedup": OP6_SQL, "op9_secret_scan": OP9_SQL}
