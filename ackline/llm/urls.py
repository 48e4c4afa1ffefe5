"""URL filtering by a rule list and by mined association rules.

Tokens of labelled URLs (host labels, path segments, file extension, query
keys) and the label itself are the items of one transaction per URL. Tokens
that are not in enough URLs to be blocked cannot be part of a rule and are left
out; tokens that always stand together are mined as one. Spark's FP-growth
finds the frequent item sets; those that with the label "block" reach the
wanted support and confidence become rules of any length. Each rule is
indexed under its rarest token, so a URL meets only rules one of whose tokens
it has, and matches if it has all of them.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ackline.llm.common import keep, prepare
from ackline.plans.joins import lookup_join

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLOCK = "=block"

# (host, path, verdict): a rule fits its host and all subdomains.
Rule = tuple[str, str, str]
LISTED: tuple[Rule, ...] = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty if null or without ``://``."""
    form = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(url, F.lit(""))
    return lower_ascii(F.regexp_extract(text, form, 1)), F.regexp_extract(text, form, 2)


def fits(host: Column, path: Column, rule: Rule) -> Column:
    same = (host == rule[0]) | host.endswith("." + rule[0])
    return same & path.startswith(rule[1])


def listed_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; null if none does.

    Equally long rules are taken in the order of their texts.
    """
    ranked = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[0] + r[1]))
    none = F.lit(None).cast("string")
    text = reduce(lambda rest, r: F.when(fits(host, path, r), F.lit(r[0] + r[1])).otherwise(rest), ranked[::-1], none)
    verdict = reduce(lambda rest, r: F.when(fits(host, path, r), F.lit(r[2])).otherwise(rest), ranked[::-1], none)
    return text, verdict


def url_tokens(url: Column) -> Column:
    """Distinct tokens of a URL.

    All host labels, path segments (digits become ``0``) and query keys, and the
    extension.
    """
    host, path = split_url(url)
    labels = F.split(host, r"\.")
    segments = F.split(lower_ascii(path), "/")
    extension = F.regexp_extract(lower_ascii(path), r"\.([a-z0-9]{1,8})$", 1)
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^[^?#]*\?([^#]*)", 1)
    keys = F.transform(F.split(query, "&"), lambda pair: F.substring_index(pair, "=", 1))

    def marked(mark: str, parts: Column) -> Column:
        return F.transform(F.filter(parts, lambda p: p != ""), lambda p: F.concat(F.lit(mark), p))

    digits = F.transform(segments, lambda s: F.regexp_replace(s, "[0-9]+", "0"))
    return F.array_distinct(
        F.concat(marked("h:", labels), marked("p:", digits), marked("x:", F.array(extension)), marked("q:", keys))
    )


def _frequent_tokens(tokens: DataFrame, least: int) -> DataFrame:
    """``(token, same)`` of all tokens in ``least`` URLs to be blocked.

    ``same`` is the first of the tokens that stand in the same URLs.
    """
    row = lambda seed: F.bit_xor(F.xxhash64("row", F.lit(seed)))
    found = tokens.groupBy("token").agg(
        F.count("*").alias("n"), F.count_if("blocked").alias("n_block"), row(1).alias("in_1"), row(2).alias("in_2")
    )
    frequent = keep(found.filter(F.col("n_block") >= least), "url-tokens")
    alike = frequent.groupBy("n", "n_block", "in_1", "in_2").agg(F.array_sort(F.collect_set("token")).alias("members"))
    return alike.select(F.explode("members").alias("token"), F.get("members", F.lit(0)).alias("same"))


def mine_rules(
    labelled: DataFrame,
    *,
    support: float = 0.002,
    least: int = 5,
    lift: float = 2.0,
    confidence: float | None = None,
    longest: int | None = None,
) -> DataFrame:
    """Rules ``(tokens, n, n_block, confidence)`` from ``(url, blocked)`` rows.

    A rule is a set of tokens (up to ``longest``, if given) found in at least
    ``max(least, support * rows)`` labelled URLs that are to be blocked, whose
    share among all with these tokens (its confidence) is at least ``lift`` times
    that among all labelled URLs, 1 at most; ``confidence`` sets that share
    itself. A rule is dropped if a part of it alone is at least as confident.
    Rows with a null label do not count.
    """
    spark = labelled.sparkSession
    prepare(spark)
    rows = labelled.filter(F.col("blocked").isNotNull()).select(F.monotonically_increasing_id().alias("row"), "blocked", url_tokens(F.col("url")).alias("has"))
    rows = keep(rows, "baskets")
    n, n_blocked = rows.agg(F.count("*"), F.count_if("blocked")).first()
    if confidence is None:
        confidence = min(1.0, lift * n_blocked / n) if n else 1.0
    none = spark.createDataFrame([], "tokens array<string>, n long, n_block long, confidence double")
    wanted = max(1, math.ceil(max(least, support * n) - 1e-9))
    each = rows.select("row", "blocked", F.explode("has").alias("token"))
    frequent = keep(_frequent_tokens(each, wanted), "url-token-groups")
    used = lookup_join(each, frequent, ["token"], spread=["row"])
    items = used.groupBy("row", "blocked").agg(F.collect_set("same").alias("items"))
    mark = F.when(F.col("blocked"), F.array(F.lit(BLOCK))).otherwise(F.array().cast("array<string>"))
    baskets = keep(items.select(F.concat("items", mark).alias("items")), "url-items")
    mined = baskets.count()
    if mined < wanted:
        return none
    # Half a row less, so that rounding up gives ``wanted`` rows.
    model = FPGrowth(itemsCol="items", minSupport=(wanted - 0.5) / mined, minConfidence=1.0).fit(baskets)
    sets = model.freqItemsets.select(
        F.array_sort(F.array_remove("items", BLOCK)).alias("tokens"),
        F.array_contains("items", BLOCK).alias("joint"),
        "freq",
    )
    if longest is not None:
        sets = sets.filter(F.size("tokens") <= longest)
    counted = sets.filter(F.size("tokens") > 0).groupBy("tokens").agg(
        F.sum(F.when(~F.col("joint"), F.col("freq"))).alias("n"),
        F.sum(F.when(F.col("joint"), F.col("freq"))).alias("n_block"),
    )
    rules = counted.filter("n_block is not null").withColumn("confidence", F.col("n_block") / F.col("n"))
    rules = keep(rules.filter(F.col("confidence") >= confidence), "url-all-rules")
    # A part that is as confident is a rule too: support only grows.
    part = rules.select(F.col("tokens").alias("part"), F.col("confidence").alias("reached"))
    part = rule_index(rules).withColumnRenamed("tokens", "part").join(part, "part")
    longer = rules.select("tokens", "confidence", F.explode("tokens").alias("token"))
    met = lookup_join(longer, keep(part, "url-rule-parts"), ["token"], spread=["tokens"])
    inside = (F.size("part") < F.size("tokens")) & (F.size(F.array_except("part", "tokens")) == 0)
    beaten = met.filter(inside & (F.col("reached") >= F.col("confidence"))).select("tokens").distinct()
    best = rules.join(beaten, "tokens", "left_anti")
    # Each token may stand for those it was mined with.
    members = frequent.groupBy("same").agg(F.collect_list("token").alias("members"))
    lists = best.select("*", F.explode("tokens").alias("same")).join(members, "same")
    lists = lists.groupBy("tokens", "n", "n_block", "confidence").agg(F.collect_list("members").alias("lists"))
    start = F.array(F.array().cast("array<string>"))
    grown = lambda made, more: F.flatten(F.transform(made, lambda m: F.transform(more, lambda t: F.concat(m, F.array(t)))))
    full = lists.select(F.explode(F.aggregate("lists", start, grown)).alias("tokens"), "n", "n_block", "confidence")
    return full.withColumn("tokens", F.array_sort("tokens"))


def rule_index(rules: DataFrame) -> DataFrame:
    """Every rule under its rarest token (ties by name)."""
    each = rules.select("tokens", F.explode("tokens").alias("token"))
    seen = each.groupBy("token").agg(F.count("*").alias("uses"))
    return (
        each.join(seen, "token")
        .groupBy("tokens")
        .agg(F.min_by("token", F.struct("uses", "token")).alias("token"))
        .select("token", "tokens")
    )


def matching_urls(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The distinct ``url`` values that have all tokens of some rule."""
    found = urls.select("url", url_tokens(F.col("url")).alias("has"))
    met = found.select("url", "has", F.explode("has").alias("token"))
    met = lookup_join(met, rule_index(rules), ["token"], spread=["url"])
    inside = F.size(F.array_except("tokens", "has")) == 0
    return met.filter(inside).select("url").distinct()


def judge_urls(pages: DataFrame, labelled: DataFrame, rules: Sequence[Rule] = LISTED, **mining) -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` to every row of ``pages``.

    The longest fitting rule of the list decides; where none fits, a mined rule
    blocks and all else is allowed. A null URL or one without ``://`` has an
    empty host and path. Repeated rows are judged each. Columns of the same
    names are replaced.
    """
    prepare(pages.sparkSession)
    host, path = split_url(F.col("url"))
    rule, listed = listed_rule(F.col("host"), F.col("path"), rules)
    judged = pages.drop("host", "path", "rule", "verdict").withColumns({"host": host, "path": path})
    judged = judged.withColumns({"rule": rule, "_listed": listed})
    mined = keep(mine_rules(labelled, **mining), "url-rules")
    open_urls = judged.filter(F.col("_listed").isNull() & F.col("url").isNotNull()).select("url")
    blocked = matching_urls(open_urls, mined).withColumn("_mined", F.lit("block"))
    verdict = F.coalesce("_listed", "_mined", F.lit("allow"))
    names = [*pages.drop("host", "path", "rule", "verdict").columns, "host", "path", "rule"]
    # Rows that no mined rule can reach stay out of the join; what many rows repeat is a skewed join.
    open_rows = F.col("_listed").isNull() & F.col("url").isNotNull()
    met = judged.filter(open_rows).join(blocked, "url", "left")
    settled = judged.filter(~open_rows).withColumn("_mined", F.lit(None).cast("string"))
    both = met.select(*names, "_listed", "_mined").unionByName(settled.select(*names, "_listed", "_mined"))
    return both.withColumn("verdict", verdict).drop("_listed", "_mined")
