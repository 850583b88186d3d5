"""URL filters: association rules over URL tokens, mined by FP-growth and matched by an inverted index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyweave.runtime import broadcast_checked, materialize

LABEL = "label=block"

MIN_SUPPORT = 0.001
MIN_CONFIDENCE = 0.6
MAX_TOKENS = 3  # for callers that want short rules only

LISTED = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


def _lower(column: Column) -> Column:
    """A to Z lower-cased, everything else as it is."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; empty for null or no ``://``."""
    return _lower(F.coalesce(F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; empty for null or no ``://``."""
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def url_tokens(host: Column, path: Column) -> Column:
    """Distinct labels of the host, its last two labels as one, and the path's folders."""
    labels = F.split(host, "\\.")
    site = F.concat(F.lit("site="), F.substring_index(host, ".", -2))
    folders = F.slice(F.split(path, "/"), 1, F.greatest(F.size(F.split(path, "/")) - 1, F.lit(0)))
    named = F.concat(
        F.transform(labels, lambda x: F.concat(F.lit("host="), x)),
        F.transform(F.filter(folders, lambda x: x != ""), lambda x: F.concat(F.lit("path="), x)),
        F.array(site),
    )
    return F.array_distinct(F.filter(named, lambda x: ~x.isin("host=", "site=")))


def listed_rules(rules: Sequence[tuple[str, str, str]], host: Column, path: Column) -> tuple[Column, Column]:
    """(rule, verdict) of the longest listed rule that fits host and path, nulls if none does.

    A rule fits its host and all subdomains where the path starts with the rule's; the text
    host + path decides which is longest, for equal lengths the smaller text.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, rule_path, kind in sorted(rules, key=lambda r: (len(r[0] + r[1]), r[0] + r[1])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        rule = F.when(fits, F.lit(rule_host + rule_path)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def mine_rules(
    labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, max_tokens: int | None = None
) -> DataFrame:
    """Rules ``rule_id``, ``tokens``, ``support``, ``confidence`` from rows (``tokens``, ``bad``).

    ``rule_id`` is the JSON text of the tokens, which differs for different tokens whatever they contain.

    Token sets that occur with the label in at least ``min_support`` of the rows and of whose rows at
    least ``min_confidence`` carry it. A rule is left out if a subset of its tokens is a rule of no
    less confidence. Rules have any number of tokens unless ``max_tokens`` bounds it. The
    number of frequent tokens is at most the tokens of a row / ``min_support``, whatever the number
    of rows; that of frequent sets can grow as 2 to the tokens of a row. No rows, or no labelled ones, give no rules.
    """
    label = F.when(F.col("bad"), F.array(F.lit(LABEL))).otherwise(F.array().cast("array<string>"))
    baskets = labelled.where(F.size("tokens") > 0).select(F.concat("tokens", label).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=0.0).fit(baskets)
    total = max(1, baskets.count())
    found = model.freqItemsets
    sets = materialize(found if max_tokens is None else found.where(F.size("items") <= max_tokens + 1))
    has = F.array_contains("items", LABEL)
    bad = sets.where(has & (F.size("items") > 1)).select(
        F.array_sort(F.array_remove("items", LABEL)).alias("tokens"), F.col("freq").alias("n_bad")
    )
    all_rows = sets.where(~has).select(F.array_sort("items").alias("tokens"), F.col("freq").alias("n"))
    rules = bad.join(all_rows, "tokens").select(
        "tokens",
        (F.col("n_bad") / total).alias("support"),
        (F.col("n_bad") / F.col("n")).alias("confidence"),
    ).where(F.col("confidence") >= min_confidence)
    rules = materialize(rules)
    # Each rule meets the smaller rules listed under its own tokens; its subsets are never written out.
    index = _by_rarest_token(rules, "tokens", "confidence").drop("tokens")
    whole = rules.where(F.size("tokens") > 1).select(F.col("tokens").alias("_whole"), F.col("confidence").alias("_of"), F.explode("tokens").alias("token"))
    smaller = (F.size("_needs") < F.size("_whole")) & (F.size(F.array_except("_needs", "_whole")) == 0)
    covered = whole.join(index, "token").where((F.col("confidence") >= F.col("_of")) & smaller).select(F.col("_whole").alias("tokens"))
    pruned = rules.join(covered.distinct(), "tokens", "left_anti")
    return pruned.withColumn("rule_id", F.to_json("tokens"))


def _by_rarest_token(rules: DataFrame, name: str, *columns: str) -> DataFrame:
    """Each rule (column ``name``, and ``columns``) under the one of its tokens in fewest rules; ``_needs`` has all."""
    listed = rules.select(name, F.col("tokens").alias("_needs"), *columns, F.explode("tokens").alias("token"))
    often = listed.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    return listed.join(often, "token").groupBy(name).agg(
        F.min(F.struct("n", "token"))["token"].alias("token"), F.first("_needs").alias("_needs"), *[F.first(c).alias(c) for c in columns]
    )


def match_rules(tokens: DataFrame, key: str, rules: DataFrame) -> DataFrame:
    """(``key``, ``rules``) of the rows whose tokens hold all tokens of some rule.

    The index lists each rule under one of its tokens, the one in fewest rules; a row meets the
    rules listed under its own tokens, and the whole rule is then compared.
    """
    index = _by_rarest_token(rules, "rule_id")
    found = tokens.select(key, F.col("tokens").alias("_has"), F.explode("tokens").alias("token")).join(
        F.broadcast(index) if _few(index) else index, "token"
    )
    whole = found.where(F.size(F.array_except("_needs", "_has")) == 0)
    return whole.groupBy(key).agg(F.sort_array(F.collect_set("rule_id")).alias("rules"))


def _few(index: DataFrame, most: int = 100_000) -> bool:
    """Rules are few strings each; so many are sent to all tasks."""
    return index.count() <= most


def judge_urls(
    pages: DataFrame, labels: DataFrame, key: str = "page_id", url: str = "url", listed: Sequence[tuple[str, str, str]] = LISTED,
    min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """``key``, ``host``, ``path``, ``rule``, ``mined`` (rules that match) and ``verdict`` for every row.

    Listed rules decide first. Where none fits, a page that matches a mined rule is blocked, any
    other allowed. ``labels`` (``key``, ``bad``) teach the miner; null keys or labels teach nothing.
    A null url has an empty host and path and no tokens. Repeated rows are judged alike; rows
    without a key match no mined rule. Equal token sets are matched once. Other columns are not read.
    """
    parts = pages.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{url}`").alias("_url"))
    parts = parts.select("_key", host_of(F.col("_url")).alias("host"), path_of(F.col("_url")).alias("path"))
    parts = parts.withColumn("tokens", F.array_sort(url_tokens(F.col("host"), F.col("path"))))
    taught = labels.select(F.col(f"`{key}`").alias("_key"), "bad").dropna()
    labelled = parts.join(taught, "_key").select("tokens", "bad")
    rules = materialize(mine_rules(labelled, min_support, min_confidence))
    # One row for each token set: hosts and folders repeat, pages are many.
    parts = parts.withColumn("_set", F.to_json("tokens"))
    distinct = parts.select("tokens", "_set").distinct()
    matched = match_rules(distinct, "_set", rules).select("_set", F.col("rules").alias("mined"))
    fitted = materialize(matched)
    rule, verdict = listed_rules(listed, F.col("host"), F.col("path"))
    judged = parts.join(broadcast_checked_arrays(fitted), "_set", "left")
    mined = F.coalesce("mined", F.array().cast("array<string>"))
    fallback = F.when(F.size(mined) > 0, "block").otherwise("allow")
    return judged.select(
        F.col("_key").alias(key), "host", "path", rule.alias("rule"), mined.alias("mined"),
        F.coalesce(verdict, fallback).alias("verdict"),
    )


def broadcast_checked_arrays(matched: DataFrame) -> DataFrame:
    """Broadcast the matched sets if they fit as strings, else let Spark shuffle."""
    flat = matched.select("_set", F.to_json("mined").alias("_mined"))
    return broadcast_checked(flat).select("_set", F.from_json("_mined", "array<string>").alias("mined"))
