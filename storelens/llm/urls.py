"""URL filter by mined association rules (operator 8).

Fixed host and path rules label the urls that they fit. Frequent combinations of url tokens
are mined with FP-growth from the labelled ones, together with the label; combinations that
foretell a label with enough confidence become rules, and judge the urls that no fixed rule
fits. An inverted index finds the rules of a url: each rule is listed under its rarest token.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"
# Fixed rules: verdict, host, path.
RULES = (
    (ALLOW, "com", "/"),
    (BLOCK, "example.com", "/en/"),
    (ALLOW, "www.example.com", "/en/"),
    (BLOCK, "net", "/es/"),
    (BLOCK, "net", "/fr/"),
)
MIN_SUPPORT = 0.005
MIN_CONFIDENCE = 0.8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def fixed_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """The longest fixed rule that fits, as a struct of rule and verdict; null if none does."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1], r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        named = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, named).otherwise(found)
    return found


def tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens: each domain suffix, first and last host name, path parts, query keys, fragment.

    Numbers are one token; the scheme and the suffix that all urls may share count as any other.
    """
    names = F.split(host, r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(names)),
        lambda i: F.concat(F.lit("host:"), F.array_join(F.slice(names, i, F.size(names)), ".")),
    )
    parts = F.filter(F.split(path, "/"), lambda x: x != "")
    steps = F.transform(parts, lambda x: F.concat(F.lit("path:"), F.regexp_replace(x, "[0-9]+", "0")))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    keys = F.transform(
        F.filter(F.split(query, "&"), lambda x: x != ""),
        lambda x: F.concat(F.lit("query:"), F.substring_index(x, "=", 1)),
    )
    rest = F.array(
        F.concat(F.lit("scheme:"), F.substring_index(url, "://", 1)),
        F.when(url.contains("#"), F.lit("fragment")),
        F.when(path.endswith("/") & (F.length(path) > 1), F.lit("slash")),
    )
    return F.array_distinct(F.array_compact(F.concat(suffixes, steps, keys, rest)))


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Rules (tokens, verdict, confidence, support) mined from rows with `tokens` and `label`.

    A rule is pruned if a part of it foretells the same label with no less confidence, or if
    its support (share of labelled urls) or confidence is too small.
    """
    marked = labelled.select(F.concat("tokens", F.array(F.concat(F.lit("label:"), F.col("label")))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(marked)
    is_label = lambda x: x.startswith("label:")
    sets = model.freqItemsets.select(
        F.array_sort(F.filter("items", lambda x: ~is_label(x))).alias("tokens"),
        F.element_at(F.concat(F.filter("items", is_label), F.array(F.lit(None).cast("string"))), 1).alias("label"),
        "freq",
    ).filter(F.size("tokens") > 0)
    whole = sets.filter(F.col("label").isNull()).select("tokens", F.col("freq").alias("all"))
    joined = sets.filter(F.col("label").isNotNull()).join(whole, "tokens")
    rules = joined.select(
        "tokens",
        F.substring_index("label", ":", -1).alias("verdict"),
        (F.col("freq") / F.col("all")).alias("confidence"),
        F.col("freq").alias("support"),
    ).filter(F.col("confidence") >= min_confidence)
    # A general rule with one token less covers a special one; what is left has no such rule.
    shorter = rules.select(
        F.explode(
            F.transform(F.sequence(F.lit(1), F.size("tokens")), lambda i: F.concat(
                F.slice("tokens", F.lit(1), i - 1), F.slice("tokens", i + 1, F.size("tokens"))
            ))
        ).alias("part"),
        "tokens",
        "verdict",
        "confidence",
    )
    known = rules.select(F.col("tokens").alias("part"), "verdict", F.col("confidence").alias("other"))
    covered = (
        shorter.join(known, ["part", "verdict"]).filter(F.col("other") >= F.col("confidence")).select("tokens", "verdict")
    )
    return rules.join(covered.distinct(), ["tokens", "verdict"], "left_anti")


def match(urls: DataFrame, rules: DataFrame, default: str = ALLOW) -> DataFrame:
    """url, verdict for distinct urls with `tokens`: the most confident rule that holds.

    Ties go to the rule with more support, then more tokens, then block. Rules are looked up
    under the rarest of their tokens, so that a token of most urls lists few rules.
    """
    found = urls.select("url", "tokens", F.explode("tokens").alias("token"))
    counts = found.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    listed = (
        rules.withColumn("rule_id", F.xxhash64("tokens", "verdict"))
        .select("*", F.explode("tokens").alias("token"))
        .join(counts, "token")
        .groupBy("rule_id")
        .agg(
            F.min_by("token", F.struct("n", "token")).alias("token"),
            *[F.first(c).alias(c) for c in ("verdict", "confidence", "support")],
            F.first("tokens").alias("needed"),
        )
    )
    best = F.struct("confidence", "support", F.size("needed").alias("size"), "verdict")
    judged = (
        found.join(listed, "token")
        .filter(F.size(F.array_except("needed", "tokens")) == 0)
        .groupBy("url")
        .agg(F.max(best).alias("best"))
    )
    return judged.select("url", F.col("best.verdict").alias("mined"))


def judge_urls(pages: DataFrame) -> DataFrame:
    """Every row of pages with host, path, rule and verdict; further columns stay.

    Urls that no fixed rule fits are judged by the mined rules, and allowed if none of these
    holds; so are null urls and urls without `://`, whose host and path are empty. Equal urls
    are judged once. Columns of the same names in the input are replaced.
    """
    url = F.col("url")
    named = pages.withColumns({"host": host_of(url), "path": path_of(url)})
    named = named.withColumn("_fixed", fixed_rule(F.col("host"), F.col("path")))
    distinct = named.filter(F.col("host") != "").select("url", "host", "path", "_fixed")
    distinct = distinct.distinct().withColumn("tokens", tokens(url, F.col("host"), F.col("path")))
    labelled = distinct.filter(F.col("_fixed").isNotNull()).select("tokens", F.col("_fixed.verdict").alias("label"))
    open_urls = distinct.filter(F.col("_fixed").isNull()).select("url", "tokens")
    mined = match(open_urls, mine(labelled))
    judged = named.join(mined, "url", "left")
    return judged.withColumns(
        {"rule": F.col("_fixed.rule"), "verdict": F.coalesce("_fixed.verdict", "mined", F.lit(ALLOW))}
    ).drop("_fixed", "mined")
