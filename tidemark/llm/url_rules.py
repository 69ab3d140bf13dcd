"""Verdicts on URLs: fixed host and path rules, then association rules mined by FP-growth, in DataFrame operations only."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans.durable import cut_lineage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for null and without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"^[\s\S]*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"^[\s\S]*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def url_tokens(url: Column) -> Column:
    """Distinct tokens of a URL: host, its last two labels, its first label, path words by depth (digits as 0), ending, query keys, fragment."""
    host, path = url_host(url), url_path(url)
    labels = F.split(host, r"\.")
    words = F.filter(F.split(path, "/"), lambda w: w != "")
    in_path = F.transform(words, lambda w, i: F.concat(F.lit("p"), F.least(i, F.lit(9)).cast("string"), F.lit(":"), F.regexp_replace(w, "[0-9]+", "0")))
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1)
    keys = F.transform(F.filter(F.split(query, "&"), lambda q: q != ""), lambda q: F.concat(F.lit("q:"), F.split(q, "=")[0]))
    mark = F.regexp_extract(F.coalesce(url, F.lit("")), r"#([\s\S]*)", 1)
    single = F.array(
        F.when(host != "", F.concat(F.lit("h:"), host)),
        F.when(F.size(labels) > 1, F.concat(F.lit("d:"), F.array_join(F.slice(labels, -2, 2), "."))),
        F.when(F.size(labels) > 2, F.concat(F.lit("s:"), labels[0])),
        F.when(path.rlike(r"\.[A-Za-z0-9]{1,5}$"), F.concat(F.lit("e:"), F.regexp_extract(path, r"\.([A-Za-z0-9]{1,5})$", 1))),
        F.when(mark != "", F.concat(F.lit("f:"), mark)),
    )
    return F.array_distinct(F.concat(F.array_compact(single), in_path, keys))


def with_anchor(rules: DataFrame, sizes: DataFrame) -> DataFrame:
    """``rules`` with the rarest token of each as ``anchor``; ``sizes``: token, n."""
    rare = rules.select(F.col("tokens").alias("all"), F.explode("tokens").alias("token")).join(sizes.select("token", "n"), "token")
    anchors = rare.groupBy("all").agg(F.min(F.struct("n", "token")).alias("m")).select(F.col("all").alias("tokens"), F.col("m.token").alias("anchor"))
    return rules.join(anchors, "tokens")


def mine_rules(pages: DataFrame, labels: DataFrame, min_support: float = 0.002, min_confidence: float = 0.6, min_pages: int = 5) -> DataFrame:
    """Token combinations of labelled URLs that mean a bad page: ``tokens``, ``anchor`` (the rarest of them), ``confidence``, ``support``.

    A page is bad if its label says toxic or of low quality; labels join pages on doc_id = page_id, null ids and labels of
    neither kind are left out. A rule holds on at least ``min_pages`` bad pages, and on ``min_support`` of all labelled ones, and of the
    labelled pages with its tokens ``min_confidence`` are bad. Rules are minimal: as one that fits is enough, none contains another.
    So FP-growth runs over the bad pages only, without tokens that are rules by themselves, and tokens on exactly the same
    labelled pages are one; neither implied tokens nor copies of a URL multiply combinations. Pages of all kinds are then counted
    for each combination. No labelled or no bad page gives no rules; long URLs are taken whole.
    """
    bad = F.max(((F.coalesce("toxic", F.lit(0)) == 1) | (F.coalesce("quality", F.lit(1)) == 0)).cast("int"))
    judged = labels.where("toxic is not null or quality is not null").groupBy(F.col("doc_id").alias("page_id")).agg(bad.alias("bad"))
    labelled = pages.join(judged, "page_id").select("bad", url_tokens(F.col("url")).alias("tokens"))
    labelled = cut_lineage(labelled.withColumn("row", F.monotonically_increasing_id()), "labelled")
    n, n_bad = labelled.agg(F.count(F.lit(1)), F.sum("bad")).first()
    least = max(min_pages, math.ceil(min_support * n))
    if (n_bad or 0) < least:
        return labelled.sparkSession.createDataFrame([], "tokens array<string>, anchor string, confidence double, support double")
    found = labelled.select("row", "bad", F.explode("tokens").alias("token"))
    counts = [F.count(F.lit(1)).alias("n"), F.sum("bad").alias("n_bad"), F.sum(F.xxhash64("row").cast("decimal(38,0)")).alias("pages")]
    stats = cut_lineage(found.groupBy("token").agg(*counts).where(F.col("n_bad") >= least), "url-tokens")
    kinds = stats.groupBy("n", "n_bad", "pages").agg(F.min("token").alias("token"))
    sure = F.col("n_bad") >= min_confidence * F.col("n")
    single = kinds.where(sure).select(F.array("token").alias("tokens"), "n", "n_bad")

    items = kinds.where(~sure).select("token")
    baskets = cut_lineage(found.join(items, "token").groupBy("row", "bad").agg(F.collect_set("token").alias("items")), "baskets")
    # half a page less, so that rounding does not raise the least count
    model = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / n_bad).fit(_bad_baskets(labelled, baskets))
    several = model.freqItemsets.where(F.size("items") > 1).select(F.sort_array("items").alias("tokens"), F.col("freq").alias("n_bad"))
    several = cut_lineage(with_anchor(several, stats), "combinations")
    asked = baskets.select(F.col("items").alias("own"), F.explode("items").alias("anchor"))
    held = asked.join(several, "anchor").where(F.size(F.array_except("tokens", "own")) == 0)
    several = held.groupBy("tokens", "anchor", "n_bad").agg(F.count(F.lit(1)).alias("n")).where(sure)
    several = cut_lineage(several, "combined")
    # a rule is dropped if a smaller one is in it; that too is found by the smaller one's anchor
    larger = several.select("tokens", F.explode("tokens").alias("anchor"))
    smaller = several.select("anchor", F.col("tokens").alias("part"))
    inside = (F.size("part") < F.size("tokens")) & (F.size(F.array_except("part", "tokens")) == 0)
    implied = larger.join(smaller, "anchor").where(inside).select("tokens").distinct()
    minimal = several.join(implied, "tokens", "left_anti").select("tokens", "anchor", "n", "n_bad")
    rules = minimal.unionByName(single.withColumn("anchor", F.col("tokens")[0]))
    confidence = (F.col("n_bad") / F.col("n")).alias("confidence")
    return cut_lineage(rules.select("tokens", "anchor", confidence, (F.col("n_bad") / F.lit(n)).alias("support")), "url-index")


def _bad_baskets(labelled: DataFrame, baskets: DataFrame) -> DataFrame:
    """One basket for every bad page, those without a token left too, as the share of pages is taken from their number."""
    rows = labelled.where("bad = 1").select("row").join(baskets.select("row", "items"), "row", "left")
    return rows.select(F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def judge(pages: DataFrame, fixed: Sequence[tuple[str, str, str]], mined: DataFrame) -> DataFrame:
    """Per row of ``pages``: ``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``confidence``.

    ``fixed`` are a caller's (verdict, host, path): a rule fits its host and subdomains if the path starts with the rule's, and
    the longest wins. Where none fits, a page is blocked if all tokens of a ``mined`` rule are in its URL, else allowed; rules are
    found by their anchor token. A null URL has neither host nor path and is allowed. Repeated rows and null page_ids all stay; other columns are ignored.
    """
    host, path = F.col("host"), F.col("path")
    fits = [
        F.when((F.concat(F.lit("."), host).endswith("." + h)) & path.startswith(p), F.struct(F.lit(len(h + p)).alias("n"), F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict")))
        for verdict, h, p in fixed
    ]
    best = F.array_max(F.array_compact(F.array(*fits))) if fits else F.lit(None).cast("struct<n:int,rule:string,verdict:string>")
    rows = pages.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("page_id").cast("long"),
        F.col("url").cast("string"),
        url_host(F.col("url")).alias("host"),
        url_path(F.col("url")).alias("path"),
    ).withColumn("best", best)
    tokens = F.when(F.col("best").isNull(), url_tokens(F.col("url")))
    asked = rows.select("row", "page_id", "host", "path", "best", tokens.alias("own"), F.explode_outer(tokens).alias("anchor"))
    index = mined.select("anchor", F.col("tokens").alias("needs"), F.col("confidence").alias("sure"))
    met = asked.join(index, "anchor", "left")
    sure = F.max(F.when(F.size(F.array_except("needs", "own")) == 0, F.col("sure")))
    judged = met.groupBy("row", "page_id", "host", "path", "best").agg(sure.alias("confidence"))
    by_method = F.when(F.col("confidence").isNotNull(), "block").otherwise("allow")
    return judged.select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", by_method).alias("verdict"), "confidence"
    )
