"""Rule bitmask ledger: each rule is evaluated once, policies are applied to its bits.

`ledger` adds the measurements and one integer of failure bits. A policy is a
named, versioned set of rules; applying one, or comparing many, is a bitwise
test on that integer and never reads the texts again. `ablations` groups by the
integer first, so that its cost after one aggregation is the number of bit
patterns.

Null and empty texts have no words and fail `few_words`; repeated rows are
judged one by one; columns of the input are kept, and those that have the name
of a measurement are replaced.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywork.llm.wording import computed, let, words

WINDOW = 5
MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


class Rule(NamedTuple):
    """A rule fails where `fails` is true; `fails` sees the measurements only."""

    name: str
    fails: Callable[[], Column]


#: The place of a rule in this list is its bit; append only, so that stored ledgers stay readable.
RULES = [
    Rule("few_words", lambda: F.col("n_words") < 10),
    Rule("repeats", lambda: 100 * F.col("n_repeat_words") > 20 * F.col("n_words")),
    Rule("symbols", lambda: 10 * F.col("n_symbols") > F.col("n_words")),
    Rule("dup_lines", lambda: 2 * F.col("n_dup_lines") > F.col("n_lines")),
    Rule("short_words", lambda: F.col("word_chars") < 2 * F.col("n_words")),
    Rule("long_words", lambda: F.col("word_chars") > 20 * F.col("n_words")),
]
POLICIES = {
    "base-1": ["few_words", "repeats"],
    "prose-1": ["few_words", "repeats", "symbols", "dup_lines", "short_words", "long_words"],
}


def mask(names: list[str], rules: list[Rule] = RULES) -> int:
    """The bits of the named rules."""
    places = {rule.name: place for place, rule in enumerate(rules)}
    return sum(1 << places[name] for name in set(names))


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the measurements, as longs."""
    own = F.struct(*[name for name in docs.columns if name not in (*MEASURES, "failed")])
    rows = computed(docs.select(own.alias("_row"), F.col(text).alias("_text")), "_words", words(F.col("_text")))
    found, full = F.col("_words"), F.coalesce(F.col("_text"), F.lit(""))
    lines = F.filter(F.split(full, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.select(
        "_row",
        F.size(found).cast("long").alias("n_words"),
        F.char_length(F.array_join(found, "")).cast("long").alias("word_chars"),
        F.regexp_count(full, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        let(
            lines,
            lambda each: F.struct(F.size(each).alias("all"), F.size(F.array_distinct(each)).alias("unlike")),
        ).alias("_lines"),
        _repeat_words(found).cast("long").alias("n_repeat_words"),
    )
    every, unlike = F.col("_lines.all").cast("long"), F.col("_lines.unlike").cast("long")
    return rows.select(
        "_row.*", "n_words", "word_chars", "n_symbols", every.alias("n_lines"), (every - unlike).alias("n_dup_lines"),
        "n_repeat_words",
    )


def _repeat_words(found: Column) -> Column:
    """Words covered by windows that occur twice or more in the same text.

    Windows are compared by 64-bit hashes within one text. Only a text that has
    an equal pair sorts its windows.
    """
    windows = F.transform(
        F.sequence(F.lit(0), F.size(found) - WINDOW),
        lambda at: F.xxhash64(*[F.get(found, at + step) for step in range(WINDOW)]),
    )
    count = let(
        windows,
        lambda each: F.when(F.size(F.array_distinct(each)) == F.size(each), F.lit(0)).otherwise(_covered(each)),
    )
    return F.when(F.size(found) < WINDOW, F.lit(0)).otherwise(count)


def _covered(windows: Column) -> Column:
    placed = F.sort_array(F.transform(windows, lambda key, at: F.struct(key.alias("key"), at.alias("at"))))

    def same(left: Column, right: Column) -> Column:
        return F.coalesce(left["key"] == right["key"], F.lit(False))

    repeated = let(
        placed,
        lambda each: F.filter(
            each, lambda item, n: same(F.get(each, n - 1), item) | same(F.get(each, n + 1), item)
        ),
    )
    starts = F.sort_array(F.transform(repeated, lambda item: item["at"]))
    lengths = let(
        starts,
        lambda each: F.transform(
            each, lambda at, n: F.least(F.lit(WINDOW), F.coalesce(F.get(each, n + 1) - at, F.lit(WINDOW)))
        ),
    )
    return F.aggregate(lengths, F.lit(0), lambda total, one: total + one)


def ledger(docs: DataFrame, text: str = "text", rules: list[Rule] = RULES) -> DataFrame:
    """The documents with their measurements and `failed`, the bits of the rules that they fail."""
    bits = F.lit(0).cast("long")
    for place, rule in enumerate(rules):
        bits = bits.bitwiseOR(F.when(rule.fails(), F.lit(1 << place)).otherwise(F.lit(0)).cast("long"))
    return measured(docs, text).withColumn("failed", bits)


def passes(policy: str = "prose-1", rules: list[Rule] = RULES) -> Column:
    """Whether a ledger row fails none of the policy's rules."""
    return F.col("failed").bitwiseAND(F.lit(mask(POLICIES[policy], rules)).cast("long")) == 0


def keep(docs: DataFrame, policy: str = "prose-1", text: str = "text") -> DataFrame:
    """The documents that pass a policy, with their own columns only."""
    marked = ledger(docs.select(F.struct("*").alias("_row"), F.col(text).alias("_text")), "_text")
    return marked.filter(passes(policy)).select("_row.*")


def ablations(marked: DataFrame, policy: str = "prose-1", rules: list[Rule] = RULES) -> DataFrame:
    """What each rule of a policy does: how many fail it, how many fail it alone, how many stay without it."""
    whole = mask(POLICIES[policy], rules)
    patterns = marked.groupBy(F.col("failed").bitwiseAND(F.lit(whole).cast("long")).alias("bits")).agg(
        F.count(F.lit(1)).alias("docs")
    )
    each = F.array(*[F.struct(F.lit(name).alias("rule"), F.lit(mask([name], rules)).cast("long").alias("bit"))
                     for name in POLICIES[policy]])
    bits, bit, docs = F.col("bits"), F.col("bit"), F.col("docs")
    return (
        patterns.select("bits", "docs", F.inline(each))
        .groupBy("rule")
        .agg(
            F.sum(F.when(bits.bitwiseAND(bit) != 0, docs).otherwise(0)).alias("n_failed"),
            F.sum(F.when(bits == bit, docs).otherwise(0)).alias("n_failed_alone"),
            F.sum(F.when(bits.bitwiseAND(F.bitwise_not(bit)) == 0, docs).otherwise(0)).alias("n_kept_without"),
            F.sum(F.when(bits == 0, docs).otherwise(0)).alias("n_kept"),
        )
    )


def summary(marked: DataFrame, keys: list[str]) -> DataFrame:
    """Per group: the bits that any document fails, those that all fail, and the number of documents."""
    return marked.groupBy(*keys).agg(
        F.bit_or("failed").alias("any_failed"), F.bit_and("failed").alias("all_failed"),
        F.count(F.lit(1)).alias("n_docs"),
    )
