"""URL verdicts from host rules and mined association rules.

Host rules are given: a rule ``host/path`` fits its host and all subdomains
where the url's path starts with the rule's; the longest fitting one decides.
For all other urls, rules are mined: labelled urls become sets of tokens
(words of host and path, query keys, fragment, scheme) plus a class item;
FP-growth finds frequent sets, and those whose rule "tokens => block" reaches
the support and confidence wanted are kept. The support wanted is a number of
blocked urls, the same however many urls are labelled. Tokens that occur in
exactly the same labelled urls are one item: k words of a shared path are one
frequent set then, not 2^k. A rule holds a class of such tokens per item; it is
indexed under the tokens of its rarest class, and blocks a url that has a token
of each of its classes. DataFrame functions only (FP-growth is Spark's).

Defined cases: a null url or one without ``://`` has an empty host and path,
no tokens, and is allowed; without labelled urls nothing is mined and all
other urls are allowed; rows that repeat are all returned; columns of the
input with names of the output are replaced, others are passed on.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import materialise

MIN_URLS = 10  # blocked urls that a rule rests on, at least
MIN_CONFIDENCE = 0.6
BLOCK = "class=block"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, _URL, 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def longest_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest (host, path, verdict) rule that fits;
    nulls where none does. ``rules`` is a short list, tested in place."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0]), len(r[1]))):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def tokens_of(url: Column) -> Column:
    """Distinct tokens of a url; digits count as ``#``."""
    low = F.translate(F.coalesce(url, F.lit("")), _UPPER, _LOWER)

    def part(text: Column, tag: str, cut: str) -> Column:
        kept = F.filter(F.split(text, cut), lambda x: x != "")
        return F.transform(kept, lambda x: F.concat(F.lit(tag), F.regexp_replace(x, "[0-9]+", "#")))

    query = F.regexp_extract(low, r"(?s)^[^?#]*\?([^#]*)", 1)
    keys = F.transform(F.filter(F.split(query, "&"), lambda x: x != ""), lambda x: F.concat(F.lit("query:"), F.substring_index(x, "=", 1)))
    has_host = low.contains("://")
    all_ = F.concat(part(host_of(low), "host:", r"[^\p{L}\p{N}]+"), part(path_of(low), "path:", r"[^\p{L}\p{N}]+"), keys,
                    part(F.regexp_extract(low, r"(?s)#(.*)$", 1), "fragment:", r"[^\p{L}\p{N}]+"),
                    F.array(F.concat(F.lit("scheme:"), F.substring_index(low, "://", 1))))
    return F.when(has_host, F.array_distinct(all_)).otherwise(F.array().cast("array<string>"))


def _classes(items: DataFrame, least: float) -> DataFrame:
    """(token, class) of the tokens that ``least`` blocked urls have: tokens
    with the same urls share a class, named by its first token. The sets of
    urls are compared by their size and two hashes."""
    tokens = items.select("row", "block", F.explode("tokens").alias("token"))
    per = tokens.groupBy("token").agg(F.count("*").alias("n"), F.count_if("block").alias("blocked"), F.bit_xor(F.xxhash64("row")).alias("x"),
                                      F.bit_xor(F.xxhash64("row", F.lit(1))).alias("y")).where(F.col("blocked") >= least)
    names = per.groupBy("n", "blocked", "x", "y").agg(F.min("token").alias("class"))
    return per.join(names, ["n", "blocked", "x", "y"]).select("token", "class")


def mine_rules(labelled: DataFrame, url: str = "url", block: str = "block", min_support: float | None = None,
               min_confidence: float = MIN_CONFIDENCE, min_urls: int = MIN_URLS) -> DataFrame:
    """Rules from urls with a boolean label (rows without one are left out):
    ``key``, a token of the rarest class (a rule has a row for each of them),
    ``tokens``, the first token of every class, ``classes``, all their tokens,
    ``support`` and ``confidence``. A rule needs ``min_urls`` blocked urls, or
    ``min_support`` of all if that is given; one with one class more than
    another rule adds nothing and is pruned."""
    spark = labelled.sparkSession
    items = labelled.where(F.col(block).isNotNull()).select(tokens_of(F.col(url)).alias("tokens"), F.col(block).alias("block"))
    items = materialise(items.withColumn("row", F.monotonically_increasing_id()), "url-items")
    empty = spark.createDataFrame([], "key string, tokens array<string>, classes array<array<string>>, support double, confidence double")
    rows = items.count()
    if rows < (1 if min_support is not None else min_urls):
        return empty
    if min_support is None:
        min_support = (min_urls - 0.5) / rows  # FP-growth rounds the number of rows up
    classes = materialise(_classes(items, min_support * rows), "url-classes")
    named = items.select("row", F.explode("tokens").alias("token")).join(classes, "token").groupBy("row").agg(F.collect_set("class").alias("own"))
    items = items.join(named, "row", "left").select("block", F.coalesce("own", F.array().cast("array<string>")).alias("own"))
    items = items.select(F.when(F.col("block"), F.array_append("own", F.lit(BLOCK))).otherwise(F.col("own")).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(items)
    found = model.associationRules.where(F.col("consequent")[0] == BLOCK)
    found = materialise(found.select(F.array_sort("antecedent").alias("tokens"), "support", "confidence"), "url-rules")
    # dropping one token at a time: is the shorter set a rule already?
    shorter = found.select("tokens", F.explode("tokens").alias("without")).select(
        "tokens", F.array_remove("tokens", F.col("without")).alias("rest"))
    known = found.select(F.col("tokens").alias("known"))
    redundant = shorter.join(known, F.col("rest") == F.col("known"), "left_semi").select(F.col("tokens").alias("redundant")).distinct()
    rules = found.join(redundant, F.col("tokens") == F.col("redundant"), "left_anti")
    single = model.freqItemsets.where(F.size("items") == 1).select(F.col("items")[0].alias("class"), "freq")
    members = classes.groupBy("class").agg(F.array_sort(F.collect_list("token")).alias("members"))
    parts = rules.select("tokens", "support", "confidence", F.explode("tokens").alias("class")).join(single, "class").join(members, "class")
    whole = parts.groupBy("tokens").agg(F.min_by("members", F.struct("freq", "class")).alias("keys"), F.collect_list("members").alias("classes"),
                                        F.first("support").alias("support"), F.first("confidence").alias("confidence"))
    return whole.select(F.explode("keys").alias("key"), "tokens", "classes", "support", "confidence")


def blocked_urls(urls: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """The distinct urls that a mined rule blocks, as column ``blocked``."""
    rows = urls.select(F.col(url).alias("blocked")).where(F.col("blocked").isNotNull()).distinct()
    rows = rows.withColumn("all", tokens_of(F.col("blocked")))
    listed = rows.select("blocked", "all", F.explode("all").alias("token"))
    hit = listed.join(rules.select("key", "classes"), F.col("token") == F.col("key"))
    return hit.where(F.forall("classes", lambda c: F.arrays_overlap(c, F.col("all")))).select("blocked").distinct()


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], mined: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule (the fitting host rule or null) and
    verdict (``allow`` or ``block``)."""
    host, path = host_of(F.col(url)), path_of(F.col(url))
    rule, verdict = longest_rule(F.col("_host"), F.col("_path"), rules)
    keep = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    rows = pages.select(*keep, host.alias("_host"), path.alias("_path")).withColumns({"_rule": rule, "_verdict": verdict})
    open_ = rows.where(F.col("_rule").isNull())
    hit = blocked_urls(open_, mined, url)
    rows = rows.join(hit, F.col(url) == F.col("blocked"), "left")
    by_rules = F.when(F.col("blocked").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
    return rows.select(*keep, F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_rule").alias("rule"),
                       F.coalesce("_verdict", by_rules).alias("verdict"))
