"""Quality rules: rules on single texts, and lines that a host repeats everywhere.

A line is known by its normalised form: white space stripped at both ends, A-Z in lower
case, each digit as 0. Per host, lines in more documents than the limit allows are
boilerplate; what is left of a document without them decides whether it is rejected.
Equal texts of a host are one document there: copies do not make a line boilerplate.

All of it is DataFrame expressions. Lines travel as hashes of 64 bits; counts per line
are added up within each task before they meet.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, SPACES, UPPER, join_unique, text_of, words_of

SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Limits:
    """A host's lines are boilerplate in more than ``documents`` and more than ``share``
    of its documents. A document is rejected as depleted when fewer than ``min_words``
    words or less than ``min_left`` of its words are left without them."""

    documents: int = 20
    share: float = 0.01
    min_words: int = 50
    min_left: float = 0.5


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value computed once however often it is used there: a
    lambda that refers to a column may else compute it anew for each element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def sorted_runs(words: Column, span: int = 3) -> Column:
    """The hash and place of each run of ``span`` words, in the order of hashes; else NULL."""
    return F.when(
        F.size(words) >= span,
        F.array_sort(
            F.transform(
                F.sequence(F.lit(1), F.size(words) - span + 1),
                lambda i: F.struct(
                    F.xxhash64(*(F.element_at(words, i + k) for k in range(span))).alias("hash"),
                    i.alias("at"),
                ),
            )
        ),
    )


def repeated_places(runs: Column) -> Column:
    """Where runs begin that the text has at least twice: those like a neighbour's."""
    same = lambda x, other: F.get(runs, other)["hash"] == x["hash"]
    return F.array_sort(
        F.transform(
            F.filter(
                runs,
                lambda x, i: F.coalesce(same(x, i - 1), F.lit(False))
                | F.coalesce(same(x, i + 1), F.lit(False)),
            ),
            lambda x: x["at"],
        )
    )


def covered_words(places: Column, span: int = 3) -> Column:
    """The size of the union of the runs that begin at these sorted places."""
    return F.aggregate(
        places,
        F.struct(F.lit(0).alias("n"), F.lit(-span).alias("last")),
        lambda x, at: F.struct(
            (x["n"] + F.least(F.lit(span), at - x["last"])).alias("n"), at.alias("last")
        ),
        lambda x: x["n"],
    )


def has_word(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACES)) != ""


def normal_line(line: Column) -> Column:
    stripped = F.btrim(line, F.lit(SPACES))
    return F.translate(F.translate(stripped, UPPER, LOWER), "123456789", "0" * 9)


def judge(
    docs: DataFrame,
    host: str = "source",
    text: str = "text",
    limits: Limits = Limits(),
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """``row``, which has all columns of ``docs`` or those to ``keep``, next to its counts
    and verdicts. What is kept is shuffled, so a caller without use for texts leaves them out.

    ``base_failed`` is the verdict of the rules on single texts; ``kept`` is false for
    those and for depleted documents. ``n_boilerplate_words`` are words in lines above
    the limits.

    NULL and empty texts have no words and fail. A NULL host is the host with the empty
    name. Each row is judged, repeated ones alike; ids play no part. An empty table has
    no rows.
    """
    judged = _judged_alone(docs, host, text, limits, keep)
    seen = _lines(docs, host, text)
    removed = (
        seen.join(boilerplate(docs, host, text, limits).select("host", "line"), ["host", "line"])
        .groupBy("host", "text_hash")
        .agg(F.sum("words").alias("n_boilerplate_words"))
    )
    return (
        judged.join(removed, ["host", "text_hash"], "left")
        .withColumn("n_boilerplate_words", F.coalesce("n_boilerplate_words", F.lit(0)))
        .withColumn("kept", ~F.col("base_failed") & ~_depleted(limits))
        .drop("host", "text_hash")
    )


def _depleted(limits: Limits) -> Column:
    left = F.col("n_words") - F.col("n_boilerplate_words")
    return (left < limits.min_words) | (left < limits.min_left * F.col("n_words"))


def _judged_alone(
    docs: DataFrame, host: str, text: str, limits: Limits, keep: Sequence[str] | None = None
) -> DataFrame:
    """Rows with host, text hash and counts, and the verdict of the rules on single texts."""
    long = lambda c: c.cast("long")
    lines = F.filter(F.split("body", "\n"), has_word)
    return (
        docs.select(
            F.struct(*(F.col(f"`{c}`") for c in keep or docs.columns)).alias("row"),
            *_host_and_text(F.col(host), F.col(text)),
        )
        .withColumn("words", words_of(F.col("body")))
        .withColumn(
            "places", let(F.col("words"), lambda ws: let(sorted_runs(ws), repeated_places))
        )
        .select(
            "row",
            "host",
            "text_hash",
            long(F.size("words")).alias("n_words"),
            long(F.length(F.translate("body", SPACES, ""))).alias("word_chars"),
            long(F.length("body") - F.length(F.translate("body", SYMBOLS, ""))).alias("n_symbols"),
            long(F.size(lines) - F.size(F.array_distinct(lines))).alias("n_dup_lines"),
            long(F.coalesce(covered_words(F.col("places")), F.lit(0))).alias("n_repeat_words"),
        )
        .withColumn(
            "base_failed",
            (F.col("n_words") < limits.min_words)
            | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
        )
    )


def _host_and_text(host: Column, text: Column) -> list[Column]:
    body = text_of(text)
    return [
        F.coalesce(host.cast("string"), F.lit("")).alias("host"),
        F.xxhash64(body).alias("text_hash"),
        body.alias("body"),
    ]


def _lines(docs: DataFrame, host: str, text: str) -> DataFrame:
    """Lines of each distinct text of a host: hash, place and number of words."""
    return (
        docs.select(*_host_and_text(F.col(host), F.col(text)))
        .select("host", "text_hash", F.posexplode(F.split("body", "\n")).alias("at", "body"))
        .filter(has_word(F.col("body")))
        .select(
            "host",
            "text_hash",
            "at",
            F.xxhash64(normal_line(F.col("body"))).alias("line"),
            F.size(words_of(F.col("body"))).alias("words"),
        )
        .distinct()
    )


def boilerplate(
    docs: DataFrame, host: str = "source", text: str = "text", limits: Limits = Limits()
) -> DataFrame:
    """``host``, ``line`` (a hash) and ``documents`` of lines above their host's limits."""
    sizes = (
        docs.select(*_host_and_text(F.col(host), F.col(text)))
        .groupBy("host")
        .agg(F.countDistinct("text_hash").alias("of"))
    )
    return (
        _lines(docs, host, text)
        .groupBy("host", "line")
        .agg(F.countDistinct("text_hash").alias("documents"))
        .filter(F.col("documents") > limits.documents)
        .join(sizes, "host")
        .filter(F.col("documents") > limits.share * F.col("of"))
        .select("host", "line", "documents")
    )


def without_boilerplate(
    docs: DataFrame,
    host: str = "source",
    text: str = "text",
    limits: Limits = Limits(),
    listed: DataFrame | None = None,
) -> DataFrame:
    """``docs`` with the lines above the limits taken out of its texts; no row goes.

    ``listed`` are the lines of a larger table, as from ``boilerplate``."""
    listed = boilerplate(docs, host, text, limits) if listed is None else listed
    listed = listed.select(
        F.col("host").alias("listed_host"), F.col("line").alias("listed_line")
    )
    seen = _lines(docs, host, text)
    gone = (
        seen.join(listed, (F.col("host") == F.col("listed_host")) & (F.col("line") == F.col("listed_line")))
        .groupBy("host", "text_hash")
        .agg(F.collect_set("at").alias("gone"))
    )
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    rows = rows.select("row", *_host_and_text(F.col(f"row.{host}"), F.col(f"row.{text}")))
    left = F.filter(
        F.split("body", "\n"),
        lambda _, i: ~F.array_contains(F.col("gone"), i),
    )
    return rows.join(gone, ["host", "text_hash"], "left").select(
        *(
            F.when(F.col("gone").isNull(), F.col(f"row.{c}"))
            .otherwise(F.array_join(left, "\n"))
            .alias(c)
            if c == text
            else F.col(f"row.`{c}`").alias(c)
            for c in docs.columns
        )
    )


def cleaned(
    docs: DataFrame,
    host: str = "source",
    text: str = "text",
    limits: Limits = Limits(),
    n_removed: str = "n_boilerplate_words",
) -> DataFrame:
    """The documents that ``judge`` keeps, without their lines above the limits, and how
    many words these had.

    As ``judge`` and ``without_boilerplate`` together, with the texts that pass the rules
    on single texts shuffled once. A text that loses no line is as it was.
    """
    listed = boilerplate(docs, host, text, limits).select(F.struct("host", "line").alias("named"))
    seen = _lines(docs, host, text).withColumn("named", F.struct("host", "line"))
    gone = (
        join_unique(seen, listed, "named")
        .groupBy(F.struct("host", "text_hash").alias("of"))
        .agg(F.sum("words").alias("n_boilerplate_words"), F.collect_set("at").alias("gone"))
    )
    alone = _judged_alone(docs, host, text, limits).filter(~F.col("base_failed"))
    alone = alone.select("row", "n_words", F.struct("host", "text_hash").alias("of"))
    joined = join_unique(alone, gone, "of", "left").withColumn(
        "n_boilerplate_words", F.coalesce("n_boilerplate_words", F.lit(0))
    )
    own = F.col(f"row.`{text}`")
    left = let(
        F.split(own, "\n"),
        lambda lines: F.transform(
            F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone")), lambda i: F.get(lines, i)
        ),
    )
    return joined.filter(~_depleted(limits)).select(
        *(
            F.when(F.col("gone").isNull(), own).otherwise(F.array_join(left, "\n")).alias(c)
            if c == text
            else F.col(f"row.`{c}`").alias(c)
            for c in docs.columns
            if c != n_removed
        ),
        F.col("n_boilerplate_words").alias(n_removed),
    )
