"""Secret scans with corpus-wide ownership frequency, with DataFrame functions only.

Three shapes are always secrets: an assignment to a password-like name, an access key id, and a long run of hex
digits. Beside these the scan takes credential-shaped tokens (long, of letters and digits) as candidates. Every
candidate value is hashed, and its hash is counted over the corpus by distinct repository and distinct owner, in two
levels so that a value that stands in a third of all rows is summed before it is shuffled. A value of many owners, or of
many repositories of the same few, is a widely copied example; a value of few of both looks live. Live candidates become further spans; base spans always stay,
and carry the same verdict for whoever wants it.

Positions come from the regex engine alone: the pieces between matches (split) and the matches (extract) alternate, so
their running lengths are the matches' places, in code points.

Defined results: null text is empty; a text of any length is scanned whole; null ids, repositories and owners are
values like any other; repeated rows each give a row, and count as one repository; an empty table gives no rows; only
the named columns are read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_one, checked_side, text_or_empty, through_scratch

# The base patterns (kind, pattern, group that is the value, least length of that group). A run of hex
# digits, or what follows AKIA, is always matched to its end, so its least length can stand in the pattern; that of an
# assignment cannot, as a short match hides another that begins inside it.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = [("assign", ASSIGN, 2, 12), ("access", r"AKIA[A-Z0-9]{14,}", 0, 18), ("hex", r"[0-9a-f]{16,}", 0, 16)]
#: Shape of the further candidates.
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
KINDS = [k for k, *_ in BASE] + ["live"]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of value, with value worked out once however often body and its lambdas name it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(values: Column, zero: int, join: Callable[[Column, Column], Column]) -> Column:
    """Running sums, maxima or the like of an array of int."""
    begin = F.struct(F.lit(zero).alias("at"), F.array().cast("array<int>").alias("all"))
    return F.aggregate(values, begin, lambda acc, x: F.struct(join(acc["at"], x).alias("at"), F.array_append(acc["all"], join(acc["at"], x)).alias("all")))["all"]


def running_by_blocks(values: Column, zero: int, join: Callable[[Column, Column], Column], block: int = 256) -> Column:
    """running in two levels, so that texts of very many matches don't copy a growing array at each."""
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / block).cast("int")), lambda c: F.slice(values, c * block + 1, block))

    def joined(parts: Column) -> Column:
        lasts = F.transform(parts, lambda p: F.element_at(p, -1))
        return let(F.concat(F.array(F.lit(zero)), running(lasts, zero, join)), lambda bases: F.flatten(F.transform(parts, lambda p, i: F.transform(p, lambda x: join(x, F.get(bases, i))))))

    return let(F.transform(blocks, lambda p: running(p, zero, join)), joined)


def added(a: Column, b: Column) -> Column:
    return a + b


def clear_of(more: Column, base: Column) -> Column:
    """The spans of more (kind 3) that overlap no span of base, in time linear in both: a span is clear if no base span
    before it, in order of start, reaches beyond its start, and the next one begins at or after its end."""
    none = F.lit(-(1 << 30))

    def kept(e: Column) -> Column:
        reach = running_by_blocks(F.transform(e, lambda x: F.when(x["kind"] < 3, x["end"]).otherwise(none)), -(1 << 30), F.greatest)
        coming = F.reverse(running_by_blocks(F.transform(F.reverse(e), lambda x: F.when(x["kind"] < 3, -x["start"]).otherwise(none)), -(1 << 30), F.greatest))
        rows = F.arrays_zip(e.alias("x"), reach.alias("reach"), coming.alias("coming"))
        return F.transform(F.filter(rows, lambda r: (r["x"]["kind"] == 3) & (r["reach"] <= r["x"]["start"]) & (-r["coming"] >= r["x"]["end"])), lambda r: r["x"])

    return F.when((F.size(more) == 0) | (F.size(base) == 0), more).otherwise(let(F.array_sort(F.concat(base, more)), kept))


def found(text: Column, pattern: str, group: int, least: int, kind: int) -> Column:
    """array<struct<start, kind, end, value>> of the leftmost non-overlapping matches whose group is long enough."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    gaps = F.split(text, pattern, -1)

    def rows(m: Column) -> Column:
        # A match begins after its own gap and all gaps and matches before it.
        steps = F.transform(m["w"], lambda w, i: F.length(F.get(m["g"], i)) + F.when(i > 0, F.length(F.get(m["w"], i - 1))).otherwise(0))
        return F.transform(
            F.arrays_zip(running_by_blocks(steps, 0, added).alias("s"), m["w"].alias("w"), m["v"].alias("v")),
            lambda x: F.struct(x["s"].alias("start"), F.lit(kind).alias("kind"), (x["s"] + F.length(x["w"])).alias("end"), x["v"].alias("value")),
        )

    spans = let(F.struct(whole.alias("w"), value.alias("v"), gaps.alias("g")), lambda m: F.when(F.size(m["w"]) > 0, rows(m)))
    return F.filter(spans, lambda x: F.length(x["value"]) >= least)


SPANS = "array<struct<start:int,kind:int,end:int,value:string>>"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo_col: str = "doc_id", owner_col: str = "source") -> DataFrame:
    """row, doc_id, repo, owner, base and more (arrays of spans with their values) of each row of docs."""
    text, none = F.col("t"), F.array().cast(SPANS)
    low = F.lower(text)
    # A cheap test first: most texts have no match of a kind.
    worth = [F.contains(low, F.lit("passw")) | F.contains(low, F.lit("secret")) | F.contains(low, F.lit("token")) | F.contains(low, F.lit("api")), F.contains(text, F.lit("AKIA")), text.rlike("[0-9a-f]{16}"), text.rlike(CANDIDATE)]
    shapes = [*BASE, ("live", CANDIDATE, 0, 20)]
    parts = [F.coalesce(F.when(w, found(text, pattern, group, least, k)), none).cast(SPANS) for k, (w, (_, pattern, group, least)) in enumerate(zip(worth, shapes, strict=True))]
    rows = docs.select(F.monotonically_increasing_id().alias("row"), docs[id_col].cast("long").alias("doc_id"), docs[repo_col].cast("string").alias("repo"), docs[owner_col].cast("string").alias("owner"), text_or_empty(docs, text_col).alias("t"))
    rows = rows.select("row", "doc_id", "repo", "owner", F.xxhash64("t").alias("text_hash"), F.array_sort(F.concat(*parts[:3])).alias("base"), parts[3].alias("more"))
    mixed = lambda x: x["value"].rlike("[0-9]") & x["value"].rlike("[A-Za-z]")
    return rows.withColumn("more", clear_of(F.filter("more", mixed), F.col("base")))


def ownership(spans: DataFrame) -> DataFrame:
    """hash, n_spans, n_repos, n_owners of each candidate value over the corpus."""
    each = spans.select("repo", "owner", F.explode(F.concat("base", "more")).alias("x")).select("repo", "owner", F.sha2(F.col("x.value").cast("binary"), 256).alias("hash"))
    repos = each.groupBy("hash", "owner", "repo").agg(F.count("*").alias("n"))
    owners = repos.groupBy("hash", "owner").agg(F.sum("n").alias("n"), F.count("*").alias("r"))
    return owners.groupBy("hash").agg(F.sum("n").alias("n_spans"), F.sum("r").alias("n_repos"), F.count("*").alias("n_owners"))


def written(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def of_kind(kind: int) -> Column:
    """Number of base spans of a kind."""
    return F.size(F.filter("base", lambda x: x["kind"] == kind))


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo_col: str = "doc_id", owner_col: str = "source", max_owners: int = 2, max_repos: int = 10) -> DataFrame:
    """One row per row of docs: doc_id, base and added spans, how many base values look live or copied, and the most
    owners and repositories that any of its values has.

    max_owners, max_repos: a value that more distinct owners or repositories hold is a widely copied example.
    """
    spans = through_scratch(scan(docs, id_col, text_col, repo_col, owner_col), "secret-spans")
    held = ownership(spans).select("hash", "n_owners", "n_repos", ((F.col("n_owners") <= max_owners) & (F.col("n_repos") <= max_repos)).alias("live"))
    each = spans.select("row", F.explode(F.concat("base", "more")).alias("x")).withColumn("hash", F.sha2(F.col("x.value").cast("binary"), 256))
    judged = each.join(held, "hash").groupBy("row").agg(
        F.array_sort(F.collect_list(F.when((F.col("x.kind") == 3) & F.col("live"), F.col("x")))).alias("added"),
        F.count_if((F.col("x.kind") < 3) & F.col("live")).alias("n_live"), F.count_if((F.col("x.kind") < 3) & ~F.col("live")).alias("n_copied"),
        F.max("n_owners").alias("most_owners"), F.max("n_repos").alias("most_repos"),
    )
    out = spans.select("row", "doc_id", "text_hash", "base").join(judged, "row", "left").withColumn("added", F.coalesce("added", F.array().cast(SPANS)))
    counts = [of_kind(k).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS[:3])]
    return out.select(
        "row", "doc_id", "text_hash", *counts, F.sha2(written(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        written(F.array_sort(F.concat("base", "added"))).alias("spans"),
        *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_live", "n_copied", "most_owners", "most_repos")),
        F.transform(F.array_sort(F.concat("base", "added")), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))).alias("places"),
    )


def redact(text: Column, places: Column, mark: str = "[SECRET]") -> Column:
    """text with each place (sorted by start; overlapping ones count as one) replaced by mark."""
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(acc: Column, x: Column) -> Column:
        fresh = x["start"] >= acc["at"]
        return F.struct(
            F.greatest(acc["at"], x["end"]).alias("at"),
            F.when(fresh, F.concat(acc["parts"], F.array(F.substring(text, acc["at"] + 1, x["start"] - acc["at"]), F.lit(mark)))).otherwise(acc["parts"]).alias("parts"),
        )

    return F.aggregate(places, begin, step, lambda acc: F.concat(F.array_join(acc["parts"], ""), F.substring(text, acc["at"] + 1, F.length(text))))


def redact_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars", max_owners: int = 2, max_repos: int = 10) -> DataFrame:
    """docs with all base spans and live spans of its texts replaced; length_col, if there, follows the text."""
    found = secret_scan(docs, id_col, text_col, id_col, "source" if "source" in docs.columns else id_col, max_owners, max_repos).where(F.size("places") > 0)
    found = found.groupBy(F.col("doc_id").alias("id"), "text_hash").agg(F.any_value("places").alias("places"))
    found = checked_side(through_scratch(found, "secret-places"), 64 + 16 * F.size("places"))
    rows = as_one(docs, id_col).withColumn("hash", F.xxhash64(F.coalesce(F.col("doc").getField(text_col).cast("string"), F.lit(""))))
    rows = rows.join(found, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("hash") == F.col("text_hash")), "left")
    text = F.col("doc").getField(text_col)
    clean = F.when(F.col("places").isNull(), text).otherwise(redact(text, F.col("places")))
    out = rows.select("doc", "places", clean.alias("clean"))

    def column(name: str) -> Column:
        own = F.col("doc").getField(name)
        if name == text_col:
            return F.col("clean").alias(name)
        if name == length_col:
            return F.when(F.col("places").isNull(), own).otherwise(F.length("clean")).cast(docs.schema[name].dataType).alias(name)
        return own.alias(name)

    return out.select(*(column(c) for c in docs.columns))
