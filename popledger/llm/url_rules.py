"""URL filter by mined association rules, with explicit rules before them. DataFrame functions only.

A URL is a set of words: ``h:`` words of the host, ``p:`` of the path, ``q:`` of the query, ``f:`` of the fragment, A-Z lower-cased, numbers
left out. FP-growth mines the combinations of words among labelled URLs, with the label as one more item. A combination becomes a
blocking rule if enough labelled URLs have it (``min_support``, a share of them) and the lower bound of its confidence (Wilson, at
``z`` standard errors, many because many
combinations are tried, so that few URLs prove nothing at any size) reaches ``min_confidence``; a rule that contains another of at least
its bound is pruned. Rules are matched by an inverted index: each rule hangs on its rarest word, the distinct word sets of
all URLs meet the rules at their words, and a rule fits if the set holds all its words.

Nothing is cut off. A word that is in too few blocked URLs for a rule of its own can be in none and is left out; words that stand in the
same labelled URLs are mined as one and told apart again in the rules, as any of them makes the same rule. Both leave the rules as they are
and keep repeated long URLs from multiplying combinations. What is left is mined whole: the work grows with the number of combinations
that are frequent among blocked URLs.

Explicit rules are a short list of the caller, (verdict, host, path): one fits its host and all subdomains where the URL's path starts
with its path; the longest host and path together wins, then the longer host, then the earlier one. It overrules what is mined.

Defined results: a null URL, or one without ``://``, has empty host and path, no words, and is allowed; every row is judged, also repeated
ones; the host runs from the first ``://`` to ``/``, ``?``, ``#`` or the end (with port and user as they stand), the path on to ``?``, ``#`` or the end;
without labelled URLs, blocked ones or words there are no mined rules and what has no explicit rule is allowed; unlabelled URLs (null label) are
not mined. Other columns are not read. Empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from popledger.llm.common import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What parts words: all ASCII but letters and digits.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: The item that stands for the label; no word looks like it.
BLOCKED = "!"
RULES = "words array<string>, anchor string, n bigint, blocked bigint, bound double"


def low(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def url_parts(url: Column) -> dict[str, Column]:
    """host (lower-cased), path, query and fragment; empty where there is none."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return {
        "host": low(F.regexp_extract(rest, r"^([^/?#]*)", 1)),
        "path": F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1),
        "query": F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1),
        "fragment": F.regexp_extract(rest, r"^[^#]*#([\s\S]*)", 1),
    }


def with_parts(urls: DataFrame, url: str) -> DataFrame:
    """The rows with url_host, url_path and url_words (distinct, in order)."""
    cut = urls.withColumns({f"url_{k}": c for k, c in url_parts(F.col(url).cast("string")).items()})

    def words(part: str) -> Column:
        found = F.filter(F.split(low(F.col(f"url_{part}")), SEPARATORS), lambda x: (x != "") & ~x.rlike("^[0-9]+$"))
        return F.transform(found, lambda x: F.concat(F.lit(f"{part[0]}:"), x))

    every = F.array_sort(F.array_distinct(F.concat(*[words(p) for p in ("host", "path", "query", "fragment")])))
    return cut.withColumn("url_words", every).drop("url_query", "url_fragment")


def explicit_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The text and the verdict of the explicit rule that wins; null if none fits."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # the last condition written around the others is asked first
    for own, h, p in sorted(reversed(list(rules)), key=lambda r: (len(r[1]) + len(r[2]), len(r[1]))):
        name = h.translate(str.maketrans(UPPER, LOWER))
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(p))
        text, verdict = F.when(fits, h + p).otherwise(text), F.when(fits, own).otherwise(verdict)
    return text, verdict


def contained(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """url_words of every set beside every rule whose words it holds: sets meet the rules at the rules' rarest word."""
    met = sets.select("url_words", F.explode("url_words").alias("anchor")).join(rules, "anchor")
    return met.where(F.size(F.array_except("words", "url_words")) == 0)


def wilson(hits: Column, n: Column, z: float) -> Column:
    """Lower bound of the share ``hits`` / ``n``."""
    share, part = hits / n, F.lit(z * z) / n
    return (share + part / 2 - F.lit(z) * F.sqrt((share * (1 - share) + part / 4) / n)) / (1 + part)


def mined_words(rows: DataFrame, least: int, min_confidence: float, z: float) -> DataFrame:
    """Words that a rule can hold, in classes that stand in the same rows (row, url_words, blocked): item (the first of the class), its n and words.

    The blocked URLs of a rule have each of its words, and no share of theirs has a greater bound than all of them. Rows are told apart
    by two sums of 64-bit hashes beside their number."""
    marks = [F.sum(F.xxhash64(F.lit(k), F.col("row")).cast("decimal(20,0)")).alias(f"mark_{k}") for k in (0, 1)]
    counts = rows.select("row", "blocked", F.explode("url_words").alias("word")).groupBy("word").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("blocked").alias("b"), *marks
    )
    enough = counts.where(F.col("b") >= least).where(wilson(F.col("b"), F.col("b"), z) >= min_confidence)
    return enough.groupBy("n", "b", "mark_0", "mark_1").agg(F.min("word").alias("item"), F.array_sort(F.collect_list("word")).alias("members")).select("item", "n", "members")


def rarest(rules: DataFrame, counts: DataFrame) -> DataFrame:
    """The rules with their rarest word as anchor; ``counts``: word and n."""
    found = rules.select("words", F.explode("words").alias("word")).join(counts, "word").groupBy("words").agg(F.min(F.struct("n", "word")).alias("_least"))
    return rules.join(found, "words").withColumn("anchor", F.col("_least.word")).drop("_least")


def no_rules(spark: SparkSession) -> DataFrame:
    return spark.range(0).select(*[F.lit(None).cast(t).alias(c) for c, t in (field.split() for field in RULES.split(", "))])


def mine(
    labelled: DataFrame, min_support: float = 0.005, min_confidence: float = 0.5, z: float = 4.0, url: str = "url", label: str = "blocked",
) -> DataFrame:
    """Blocking rules from labelled URLs (``label`` is boolean): words, anchor (the rarest), labelled URLs with them, blocked ones, bound."""
    spark = labelled.sparkSession
    rows = with_parts(labelled.where(F.col(label).isNotNull()).select(F.col(url).alias("url"), F.col(label).cast("boolean").alias("blocked")), "url")
    rows = stored(rows.select(F.monotonically_increasing_id().alias("row"), "url_words", "blocked"), "labelled")
    n, bad = rows.agg(F.count(F.lit(1)), F.count_if("blocked")).first()
    if not bad:
        return no_rules(spark)
    classes = stored(mined_words(rows, math.ceil(min_support * n), min_confidence, z), "words")
    if classes.isEmpty():
        return no_rules(spark)
    held = rows.select("row", F.explode("url_words").alias("item")).join(classes.select("item"), "item").groupBy("row").agg(F.collect_list("item").alias("items"))
    items = F.coalesce("items", F.array().cast("array<string>"))
    baskets = rows.join(held, "row", "left").select(F.when(F.col("blocked"), F.array_append(items, BLOCKED)).otherwise(items).alias("items"))
    found = stored(FPGrowth(itemsCol="items", minSupport=min_support).fit(baskets).freqItemsets, "combinations")
    whole = found.where(~F.array_contains("items", BLOCKED)).select(F.array_sort("items").alias("words"), F.col("freq").alias("n"))
    with_label = found.where(F.array_contains("items", BLOCKED) & (F.size("items") > 1))
    with_label = with_label.select(F.array_sort(F.array_remove("items", BLOCKED)).alias("words"), F.col("freq").alias("blocked"))
    rules = with_label.join(whole, "words").withColumn("bound", wilson(F.col("blocked"), F.col("n"), z)).where(F.col("bound") >= min_confidence)
    rules = stored(rarest(rules, classes.select(F.col("item").alias("word"), "n")), "rules")
    # a rule that holds all words of another of at least its bound says nothing new
    larger = contained(rules.select(F.col("words").alias("url_words")), rules).where(F.size("words") < F.size("url_words"))
    larger = larger.groupBy("url_words").agg(F.max("bound").alias("bound"))
    kept = rules.join(larger.select(F.col("url_words").alias("words"), F.col("bound").alias("other")), "words", "left").where("other is null or other < bound")
    # any word of a class for the one that was mined
    members = classes.select(F.col("item").alias("_item"), "members")
    spelt = kept.select("words", F.explode("words").alias("_item")).join(members, "_item").groupBy("words").agg(F.collect_list("members").alias("_members"))
    each = F.aggregate("_members", F.array(F.array().cast("array<string>")), lambda done, own: F.flatten(F.transform(done, lambda x: F.transform(own, lambda w: F.array_append(x, w)))))
    out = kept.drop("other", "anchor").join(spelt, "words").withColumn("words", F.explode(each)).withColumn("words", F.array_sort("words"))
    words = classes.select(F.explode("members").alias("word"), "n")
    return rarest(out.drop("_members"), words).select("words", "anchor", "n", "blocked", "bound")


def judge(urls: DataFrame, rules: DataFrame, explicit: Sequence[tuple[str, str, str]] = (), key: str = "page_id", url: str = "url") -> DataFrame:
    """page_id, host, path, rule and verdict of every row, and the mined rule of the greatest bound (words, null if none) with its bound."""
    rows = with_parts(urls.select(F.col(key).alias("page_id"), F.col(url).alias("url")), "url")
    hit = contained(rows.select("url_words").distinct(), rules).groupBy("url_words").agg(F.max(F.struct("bound", "n", "words")).alias("best"))
    text, verdict = explicit_rule(F.col("url_host"), F.col("url_path"), explicit)
    mined = F.when(F.col("best").isNotNull(), "block").otherwise("allow")
    return rows.join(hit, "url_words", "left").select(
        "page_id", F.col("url_host").alias("host"), F.col("url_path").alias("path"), text.alias("rule"), F.coalesce(verdict, mined).alias("verdict"),
        F.col("best.words").alias("mined_rule"), F.col("best.bound").alias("bound"),
    )
