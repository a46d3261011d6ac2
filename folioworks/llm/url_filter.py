"""URL filters: fixed host-and-path rules first, then association rules mined from labelled URLs.

A URL is a set of tokens (host labels, path segments, parameter names and values; digits count as one shape). Spark's
FP-growth mines token combinations over the labelled pages with the label as one more item; rules whose consequent is
the block label, pruned by support, confidence and the share of good pages they hit, are kept, and of these only rules
that no smaller kept rule implies. Rules are matched by an inverted index: a rule stands under its rarest token only, a
page looks up its own tokens, and the few rules found are checked for their other tokens.

What FP-growth gets is made small first, without losing a verdict: a token in too few bad pages can be in no rule; a
token that is a rule by itself implies all rules that have it; tokens that stand in exactly the same labelled pages
count as one item (a rule then needs them all). Every page brings all its items. While no page has more than
``max_items``, FP-growth lists at most 2 ** max_items combinations of a page. If one has more, the same growth by
conditional pattern bases runs here, rarest items first, and goes on only where a smallest rule can be: not from a rule,
not by an item that all pages of a combination have, and not where the good pages that have all items left, and so stay
in whatever follows, are too many for any rule. Both ways give the same rules. A task holds the different rests of the
pages of one item. Pages of very many items that are nearly independent of each other and of the labels have as many
combinations to look at as they have, so the time (not the memory) grows exponentially there.

Defined results: a null url, or one without ``://``, has an empty host and path, no rule and the method's verdict on
no tokens (allow); null ids match no label; repeated rows each give a row; tokens of any length count whole; with no
labelled page of either kind, or no rule that is sure enough, the method allows; an empty table gives no rows; only the
named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import through_scratch

# Rule and verdict, as the contract lists them.
RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
BLOCK = "label=block"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def fixed_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null."""
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: len(r[0])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(slash + rest))
        chosen = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def url_tokens(host: Column, path: Column, url: Column) -> Column:
    """Distinct tokens of a URL; numbers become '#'."""
    shape = lambda x: F.regexp_replace(x, r"\d+", "#")
    named = lambda kind, parts: F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.concat(F.lit(kind), shape(x)))
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1)
    return F.array_distinct(F.concat(named("host:", F.split(host, r"\.")), named("path:", F.split(path, "/")), named("query:", F.split(query, "&"))))


def sure(n: Column, n_bad: Column, pages: int, bad: int, least: int, min_confidence: float, min_ratio: float) -> Column:
    """Whether a combination in n labelled pages, n_bad of them bad, is a rule: enough pages, enough of them bad, and
    good ones at least min_ratio times rarer among them than among all labelled pages, whatever their share is."""
    good_share = (pages - bad) / pages
    return (n_bad >= least) & (n_bad >= min_confidence * n) & ((n - n_bad) * min_ratio <= good_share * n)


def growing(pages: int, bad: int, least: int, min_confidence: float, min_ratio: float) -> Callable[[pa.Table], pa.Table]:
    """From the rests (arrays of item numbers, with their pages and bad pages) of one item: its combinations that are
    rules and extend no rule that they were grown from."""
    good_share = (pages - bad) / pages

    def is_sure(n_bad: int, n_good: int) -> bool:
        n = n_bad + n_good
        return bool(n_bad >= least and n_bad >= min_confidence * n and n_good * min_ratio <= good_share * n)

    def run(base: pa.Table) -> pa.Table:
        base = base.combine_chunks()
        rests, n_bad = base.column("rest").combine_chunks(), base.column("n_bad").to_numpy()
        n_good = base.column("n").to_numpy() - n_bad
        names, at = np.unique(pc.list_flatten(rests).to_numpy(zero_copy_only=False), return_inverse=True)
        has = np.zeros((len(names), len(n_bad)), bool)
        has[at, np.repeat(np.arange(len(n_bad)), pc.list_value_length(rests).to_numpy(zero_copy_only=False))] = True
        found: list[tuple[list[int], int, int]] = []

        def opened(items: tuple, held: np.ndarray, left: np.ndarray) -> list | None:
            """A combination with its pages and the items that it may grow by, unless no rule can follow."""
            all_bad, all_good = int(n_bad[held].sum()), int(n_good[held].sum())
            if is_sure(all_bad, all_good):
                found.append(([int(i) for i in items], all_bad + all_good, all_bad))
                return None
            inside = has[np.ix_(left, held)]
            bads = inside @ n_bad[held]
            some = (bads >= least) & ~inside.all(1)
            left, inside = left[some], inside[some]
            if not len(left) or not is_sure(int(bads[some].max()), int(n_good[held[inside.all(0)]].sum())):
                return None
            order = np.argsort(inside.sum(1), kind="stable")
            return [items, held, left[order], inside[order], 0]

        stack = [opened((base.column("head")[0].as_py(),), np.arange(len(n_bad)), np.arange(len(names)))]
        while stack:
            top = stack[-1]
            if top is None or top[4] == len(top[2]):
                stack.pop()
                continue
            items, held, left, inside, j = top
            top[4] += 1
            stack.append(opened((*items, names[left[j]]), held[inside[j]], left[j + 1 :]))
        columns = zip(*found, strict=True) if found else ([], [], [])
        return pa.Table.from_arrays([pa.array(list(c), t) for c, t in zip(columns, (pa.list_(pa.int32()), pa.int64(), pa.int64()), strict=True)], ["items", "n", "n_bad"])

    return run


def mined_rules(labelled: DataFrame, pages: int, bad: int, min_support: float, min_count: int, min_confidence: float, min_ratio: float, max_items: int) -> DataFrame:
    """rule_id, tokens, rarest, confidence from labelled (row, tokens, bad), of whose pages so many are bad."""
    least = max(min_count, math.ceil(min_support * pages))
    each = labelled.select("row", "bad", F.explode("tokens").alias("token"))
    mark = F.xxhash64(F.col("row"), F.lit("page")).cast("decimal(38,0)")
    counts = each.groupBy("token").agg(F.count("*").alias("n"), F.count_if("bad").alias("n_bad"), F.sum(mark).alias("same"), F.bit_xor(F.xxhash64("row")).alias("same2"))
    counts = through_scratch(counts.where(F.col("n_bad") >= least), "url-tokens-often")
    alone = sure(F.col("n"), F.col("n_bad"), pages, bad, least, min_confidence, min_ratio)
    single = counts.where(alone).select(F.array("token").alias("tokens"), (F.col("n_bad") / F.col("n")).alias("confidence"))
    # One item for all tokens of the same pages. Each is in min_support of the pages, so there are at most as many as a
    # page has tokens, over min_support.
    items = counts.where(~alone).groupBy("n", "n_bad", "same", "same2").agg(F.min("token").alias("item"), F.collect_list("token").alias("members"))
    items = through_scratch(items.withColumn("number", F.row_number().over(Window.orderBy("n", "item"))), "url-items")
    brought = each.join(items.select(F.col("item").alias("token"), "number"), "token")
    brought = brought.groupBy("row").agg(F.array_sort(F.collect_list("number")).alias("numbers"), F.collect_list("token").alias("items"), F.any_value("bad").alias("bad"))
    brought = through_scratch(brought, "url-baskets")
    if (brought.agg(F.max(F.size("items"))).first()[0] or 0) <= max_items:
        key = "item"
        baskets = brought.select(F.when(F.col("bad"), F.array_append("items", F.lit(BLOCK))).otherwise(F.col("items")).alias("items"))
        model = FPGrowth(itemsCol="items", minSupport=min(1.0, least / max(1, baskets.count(), least)), minConfidence=0.0).fit(baskets)
        sets = through_scratch(model.freqItemsets, "url-itemsets")
        with_block = sets.where(F.array_contains("items", BLOCK)).select(F.array_sort(F.array_remove("items", BLOCK)).alias("items"), F.col("freq").alias("n_bad"))
        found = with_block.join(sets.select(F.array_sort("items").alias("items"), F.col("freq").alias("n")), "items").where(F.size("items") > 0)
        found = found.where(sure(F.col("n"), F.col("n_bad"), pages, bad, least, min_confidence, min_ratio))
    else:
        key = "number"
        baskets = brought.groupBy("numbers").agg(F.count("*").alias("n"), F.count_if("bad").alias("n_bad"))
        base = baskets.select("n", "n_bad", "numbers", F.posexplode("numbers").alias("at", "head"))
        base = base.select("n", "n_bad", "head", F.slice("numbers", F.col("at") + 2, F.size("numbers")).alias("rest"))
        base = base.groupBy("head", "rest").agg(F.sum("n").alias("n"), F.sum("n_bad").alias("n_bad"))
        found = base.groupBy("head").applyInArrow(growing(pages, bad, least, min_confidence, min_ratio), "items array<int>, n long, n_bad long")
    found = through_scratch(found.withColumn("rule", F.monotonically_increasing_id()), "url-combinations")
    members = found.select("rule", "n", "n_bad", F.explode("items").alias(key)).join(items.select(key, "members"), key)
    pairs = members.groupBy("rule").agg(F.array_sort(F.flatten(F.collect_list("members"))).alias("tokens"), F.any_value(F.col("n_bad") / F.col("n")).alias("confidence"))
    rules = single.unionByName(pairs.select("tokens", "confidence")).withColumn("rule_id", F.xxhash64("tokens"))
    rules = through_scratch(rules, "url-rules")
    each = rules.select("rule_id", F.explode("tokens").alias("token"))
    rarest = each.join(counts.select("token", "n"), "token").groupBy("rule_id").agg(F.min(F.struct("n", "token"))["token"].alias("rarest"))
    rules = through_scratch(rules.join(rarest, "rule_id"), "url-rules")
    # A rule that contains another kept rule adds nothing to a yes-or-no verdict.
    other = rules.select(F.col("rule_id").alias("o"), F.col("tokens").alias("ot"), F.col("rarest").alias("token"))
    implied = each.join(rules.select("rule_id", "tokens"), "rule_id").join(other, "token").where((F.col("o") != F.col("rule_id")) & (F.size(F.array_except("ot", "tokens")) == 0))
    return rules.join(implied.select("rule_id").distinct(), "rule_id", "left_anti")


def url_filter(
    pages: DataFrame, labels: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: Sequence[tuple[str, str]] = tuple(RULES),
    min_support: float = 0.001, min_count: int = 10, min_confidence: float = 0.6, min_ratio: float = 1.5, max_items: int = 12,
) -> DataFrame:
    """page_id, host, path, rule, verdict and rules_met for each row of pages.

    labels: doc_id, quality, toxic; a page is bad if a label of its id has quality 0 or toxic 1. A rule needs both
    min_support, as a share of the labelled pages, and min_count of bad ones. max_items decides which growth mines the
    pages, not what is found.
    """
    url = pages[url_col].cast("string")
    rows = pages.select(F.monotonically_increasing_id().alias("row"), pages[id_col].cast("long").alias("page_id"), url.alias("url"))
    host, path = host_and_path(F.col("url"))
    rows = rows.withColumns({"host": host, "path": path})
    rows = rows.withColumns({"fixed": fixed_rule(F.col("host"), F.col("path"), rules), "tokens": url_tokens(F.col("host"), F.col("path"), F.col("url"))}).drop("url")
    rows = through_scratch(rows, "url-tokens")
    marks = labels.select(labels["doc_id"].cast("long").alias("page_id"), (F.coalesce(labels["quality"] == 0, F.lit(False)) | F.coalesce(labels["toxic"] == 1, F.lit(False))).alias("bad"))
    marks = marks.groupBy("page_id").agg(F.max("bad").alias("bad"))
    labelled = through_scratch(rows.join(marks, "page_id").select("row", "tokens", "bad"), "url-labelled")
    kinds = labelled.agg(F.count_if("bad"), F.count_if(~F.col("bad"))).first()
    if min(kinds) > 0:
        index = mined_rules(labelled, sum(kinds), kinds[0], min_support, min_count, min_confidence, min_ratio, max_items).select("rule_id", F.col("tokens").alias("needs"), F.col("rarest").alias("token"))
        seen = rows.where("fixed is null").select("row", "tokens", F.explode("tokens").alias("token")).join(index, "token")
        met = seen.where(F.size(F.array_except("needs", "tokens")) == 0).groupBy("row").agg(F.countDistinct("rule_id").alias("rules_met"))
        rows = rows.join(met, "row", "left")
    else:
        rows = rows.withColumn("rules_met", F.lit(0).cast("long"))
    met = F.coalesce("rules_met", F.lit(0)).cast("long")
    verdict = F.coalesce(F.col("fixed.verdict"), F.when(met > 0, "block").otherwise("allow"))
    return rows.select("page_id", "host", "path", F.col("fixed.rule").alias("rule"), verdict.alias("verdict"), met.alias("rules_met"))
