"""URL filters: given rules by host and path, and rules mined from labelled URLs.

A URL is the set of its tokens: the labels of its host, the segments of its path and
the names of its parameters, digits as #. FP-growth mines sets of tokens that come with
the label "block" often enough (support) and mostly (confidence). A rule's tokens must
all be in a URL for it to fit. Rules are found by an inverted index: each is listed
under its rarest token, and a URL looks up its tokens there.

All of it is DataFrame expressions, joins and Spark's FP-growth.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, join_unique, stored

BLOCK = "=block"


@dataclass(frozen=True)
class Rule:
    """Fits its host and all its subdomains, where the path begins with the rule's."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    @staticmethod
    def read(verdict: str, text: str) -> Rule:
        host, slash, path = text.partition("/")
        return Rule(verdict, host, slash + path)


@dataclass(frozen=True)
class Mining:
    """A mined rule holds for at least ``pages`` labelled URLs, however many there are in
    all, and ``confidence`` of the URLs it fits are to be blocked. A ``support`` asks for a
    share of all labelled URLs as well."""

    pages: int = 20
    confidence: float = 0.5
    support: float = 0.0


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    found = F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)
    return F.coalesce(F.translate(found, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens_of(url: Column) -> Column:
    """The distinct tokens of a URL; none without a host or path."""
    query = F.coalesce(F.regexp_extract(url, r"\?([^#]*)", 1), F.lit(""))
    parts = [
        (F.split(host_of(url), r"\."), "host:"),
        (F.split(path_of(url), "/"), "path:"),
        (F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1)), "name:"),
    ]

    def tagged(found: Column, tag: str) -> Column:
        full = F.filter(found, lambda x: x != "")
        return F.transform(full, lambda x: F.concat(F.lit(tag), F.regexp_replace(x, "[0-9]+", "#")))

    return F.array_distinct(F.concat(*(tagged(found, tag) for found, tag in parts)))


def given_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The text of the longest rule that fits, else NULL."""
    fits = [
        F.when(
            ((host == rule.host) | F.endswith(host, F.lit("." + rule.host)))
            & F.startswith(path, F.lit(rule.path)),
            rule.text,
        )
        for rule in sorted(rules, key=lambda r: (-len(r.text), r.text))
    ]
    return F.coalesce(*fits, F.lit(None).cast("string")) if fits else F.lit(None).cast("string")


def verdict_of(rule: Column, rules: Sequence[Rule]) -> Column:
    return F.coalesce(*(F.when(rule == r.text, r.verdict) for r in rules), F.lit(None).cast("string"))


def mine(labelled: DataFrame, mining: Mining = Mining()) -> DataFrame:
    """The rules: ``groups``, of each of which a URL must have a token, and ``confidence``.

    ``labelled`` has ``url`` and ``block``, a boolean; rows with a NULL there teach nothing.
    Repeated URLs each count. Tokens of fewer URLs than a rule needs are left out before
    mining, and those that always occur together are one item there: the 2^n sets of n of
    them hold for the same URLs. For a URL to be judged any of them will do, as each is a
    rule of its own. ``tokens`` has the first one of each group.
    """
    rows = stored(
        labelled.filter(F.col("url").isNotNull() & F.col("block").isNotNull()).select(
            F.monotonically_increasing_id().alias("id"), tokens_of(F.col("url")).alias("tokens"), "block"
        )
    )
    n = rows.count()
    least = max(math.ceil(mining.support * n), mining.pages)
    if n < least:
        none = rows.select("tokens", F.array("tokens").alias("groups"), F.lit(0.0).alias("confidence"))
        return none.filter(F.lit(False))
    each = rows.select("id", F.explode("tokens").alias("token"))
    # Tokens of the same rows, told by two hashes of 64 bits over them.
    together = stored(
        each.groupBy("token")
        .agg(
            F.count("*").alias("n"),
            F.bit_xor(F.xxhash64("id")).alias("one"),
            F.bit_xor(F.xxhash64(F.lit("two"), "id")).alias("two"),
        )
        .filter(F.col("n") >= least)
        .groupBy("n", "one", "two")
        .agg(F.array_sort(F.collect_list("token")).alias("group"))
        .select(F.col("group")[0].alias("item"), "group")
    )
    named = together.select("item", F.explode("group").alias("token"))
    found = join_unique(each, named, "token").groupBy("id").agg(F.collect_set("item").alias("items"))
    block = F.when(F.col("block"), F.array(F.lit(BLOCK))).otherwise(F.array())
    items = rows.join(found, "id", "left").select(
        F.concat(F.coalesce("items", F.array().cast("array<string>")), block).alias("items")
    )
    # Half a row below, so that rounding can't ask for one row more.
    model = FPGrowth(
        itemsCol="items", minSupport=(least - 0.5) / n, minConfidence=mining.confidence
    ).fit(stored(items))
    rules = model.associationRules.filter(F.col("consequent")[0] == BLOCK).select(
        F.array_sort("antecedent").alias("tokens"), "confidence"
    )
    return (
        rules.select("tokens", "confidence", F.explode("tokens").alias("item"))
        .join(together, "item")
        .groupBy("tokens", "confidence")
        .agg(F.collect_list("group").alias("groups"))
        .select("tokens", "groups", "confidence")
    )


def fitted(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The distinct ``url`` values that some rule fits."""
    tokens = urls.select("url").distinct().select("url", tokens_of(F.col("url")).alias("has"))
    listed = rules.select("tokens", "groups", F.explode("groups").alias("group"))
    single = listed.select("tokens", "groups", "group", F.explode("group").alias("token"))
    frequency = (
        tokens.select(F.explode("has").alias("token"))
        .join(single.select("token").distinct(), "token", "left_semi")
        .groupBy("token")
        .agg(F.count("*").alias("n"))
    )
    index = (
        single.join(frequency, "token")  # a rule with a group of no URL fits none
        .groupBy("tokens", "groups", "group")
        .agg(F.sum("n").alias("n"))
        .groupBy("tokens", "groups")
        .agg(F.min_by("group", F.struct("n", "group")).alias("group"), F.count("*").alias("known"))
        .filter(F.col("known") == F.size("groups"))
        .select("groups", F.explode("group").alias("token"))
    )
    return (
        tokens.select("url", "has", F.explode("has").alias("token"))
        .join(index, "token")
        .filter(F.forall("groups", lambda group: F.arrays_overlap(group, F.col("has"))))
        .select("url")
        .distinct()
    )


def judge(
    pages: DataFrame,
    rules: Sequence[Rule],
    mined: DataFrame,
    page_id: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """A row per row of ``pages``: ``page_id``, ``host``, ``path``, ``rule``, ``verdict``.

    The longest given rule that fits decides; without one, URLs that a mined rule fits
    are blocked and all others allowed. A NULL URL and one without ``://`` have an empty
    host and path, and are allowed. Rows are judged each, repeated ones alike; columns
    besides are left out, and an empty table has no rows.
    """
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"))
    blocked = fitted(rows.filter("url IS NOT NULL"), mined).select(
        F.col("url").alias("blocked_url")
    )
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    return (
        rows.join(blocked, F.col("url") == F.col("blocked_url"), "left")
        .select("page_id", host.alias("host"), path.alias("path"), "blocked_url")
        .withColumn("rule", given_rule(F.col("host"), F.col("path"), rules))
        .withColumn(
            "verdict",
            F.coalesce(
                verdict_of(F.col("rule"), rules),
                F.when(F.col("blocked_url").isNotNull(), "block").otherwise("allow"),
            ),
        )
        .drop("blocked_url")
    )
