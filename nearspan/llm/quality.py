"""Quality rules as a short-circuit cascade of SQL expressions.

A rule is a feature of the text and a limit on it.  Its cost and selectivity are estimated on a
sample, and the rules are applied in order of rejections per cost: a document that one rule rejects
is not measured by those behind it.  The verdict does not depend on the order; only the work does.

Everything is built of SQL functions on whole texts.  Null and empty texts have no words and fail
``few_words``.  Ties in the order of rules are broken by name.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearspan.llm.common import WORD, settle, whole

BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
SAMPLE_ROWS = 2000


def without(text: Column, letters: str) -> Column:
    return F.translate(text, letters, "")


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def word_chars(text: Column) -> Column:
    return F.char_length(without(text, BLANKS)).cast("long")


def n_symbols(text: Column) -> Column:
    return (F.char_length(text) - F.char_length(without(text, SYMBOLS))).cast("long")


def n_lines(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"(?m)^[^\n]*" + WORD.replace("+", ""))).cast("long")


def n_dup_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda line: without(line, BLANKS) != "")
    return bound(lines, lambda kept: F.size(kept) - F.size(F.array_distinct(kept))).cast("long")


def n_capital_pairs(text: Column) -> Column:
    return F.regexp_count(text, F.lit("[A-Z][A-Z]")).cast("long")


def n_repeat_words(text: Column) -> Column:
    """Words inside 3-word windows that occur at least twice in the text, the first one included."""

    def positions(hashes: Column) -> Column:
        """Begins of windows found twice or more, in order."""

        def neighbours(ordered: Column) -> Column:
            return F.filter(
                ordered,
                lambda x, i: F.coalesce(F.when(i > 0, F.get(ordered, i - 1)["h"] == x["h"]), F.lit(False))
                | F.coalesce(F.get(ordered, i + 1)["h"] == x["h"], F.lit(False)),
            )

        windows = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return F.sort_array(F.transform(bound(F.sort_array(windows), neighbours), lambda x: x["i"]))

    def covered(begins: Column) -> Column:
        gaps = F.transform(begins, lambda at, i: F.least(F.lit(3), F.coalesce(F.get(begins, i + 1) - at, F.lit(3))))
        return F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap)

    def of_hashes(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), bound(positions(hashes), covered)).otherwise(0)

    def of_words(found: Column) -> Column:
        begins = F.sequence(F.lit(0), F.size(found) - 3)
        windows = F.transform(
            begins, lambda i: F.xxhash64(F.get(found, i), F.get(found, i + 1), F.get(found, i + 2))
        )
        return F.when(F.size(found) > 3, bound(windows, of_hashes)).otherwise(0)

    return bound(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), of_words).cast("long")


def bound(value: Column, body) -> Column:
    """``body(value)`` with the value computed once: inside a lambda it would be computed per element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


FEATURES = {
    "n_words": n_words,
    "word_chars": word_chars,
    "n_symbols": n_symbols,
    "n_lines": n_lines,
    "n_dup_lines": n_dup_lines,
    "n_repeat_words": n_repeat_words,
    "n_capital_pairs": n_capital_pairs,
}


@dataclass(frozen=True)
class Rule:
    """Rejects a document if ``fails`` holds for its features, given by name."""

    name: str
    uses: tuple[str, ...]
    fails: Callable[[Mapping[str, Column]], Column]


# Limits in the range that published rule sets for web text use.
RULES = (
    Rule("few_words", ("n_words",), lambda f: f["n_words"] < 50),
    Rule("repeated_words", ("n_words", "n_repeat_words"), lambda f: f["n_repeat_words"] * 100 > f["n_words"] * 50),
    Rule("symbols", ("n_words", "n_symbols"), lambda f: f["n_symbols"] * 10 > f["n_words"]),
    Rule("repeated_lines", ("n_lines", "n_dup_lines"), lambda f: f["n_dup_lines"] * 10 > f["n_lines"] * 4),
    Rule("capitals", ("word_chars", "n_capital_pairs"), lambda f: f["n_capital_pairs"] * 4 > f["word_chars"]),
    Rule(
        "word_length",
        ("n_words", "word_chars"),
        lambda f: (f["word_chars"] < f["n_words"] * 2) | (f["word_chars"] > f["n_words"] * 15),
    ),
)
BASE = ("few_words", "repeated_words")


def fails(rule: Rule, text: Column, known: Mapping[str, Column] | None = None) -> Column:
    """Whether the rule rejects the text; features in ``known`` are taken, the others computed."""
    known = known or {}
    return rule.fails({name: known[name] if name in known else FEATURES[name](text) for name in rule.uses})


def rejected_by(text: Column, rules: Sequence[Rule], known: Mapping[str, Column] | None = None) -> Column:
    """Name of the first rule that rejects the text, null if none does.

    A ``CASE``: what stands behind the first failing rule is not evaluated.
    """
    cascade = F.lit(None).cast("string")
    for rule in reversed(rules):
        cascade = F.when(fails(rule, text, known), F.lit(rule.name)).otherwise(cascade)
    return cascade


def order_rules(
    frame: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS
) -> list[Rule]:
    """The rules by rejections per second on a sample of about ``sample_rows`` documents.

    The sample is written once and each rule is timed on it by itself, so that a rule is charged for
    all its features.  An empty table keeps the given order.
    """
    total = frame.count()
    if not total:
        return list(rules)
    sample = frame.select(whole(text).alias("_text")).sample(min(1.0, sample_rows / total), seed=11)
    sample = settle(sample.coalesce(4), "quality-sample")
    sample.agg(F.sum(F.char_length("_text"))).collect()
    worth = {}
    for rule in rules:
        begin = time.perf_counter()
        rejected = sample.filter(fails(rule, F.col("_text"))).count()
        worth[rule.name] = (rejected + 0.5) / (time.perf_counter() - begin)
    return sorted(rules, key=lambda rule: (-worth[rule.name], rule.name))


def keep_good(
    frame: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS
) -> DataFrame:
    """The rows that no rule rejects, with their columns as they are."""
    ordered = order_rules(frame, text, rules, sample_rows)
    uses = [name for rule in ordered for name in rule.uses]
    shared = [name for name in dict.fromkeys(uses) if uses.count(name) > 1]

    def verdict(values: Column) -> Column:
        return rejected_by(whole(text), ordered, {name: values[name] for name in shared}).isNull()

    # Features of several rules are computed once, the others when the cascade comes to them.
    once = F.struct(F.lit(0).alias("_"), *(FEATURES[name](whole(text)).alias(name) for name in shared))
    return frame.filter(bound(once, verdict))


def measure(
    frame: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS
) -> DataFrame:
    """Every row with ``measured``: a struct of all features and ``rejected_by`` of the ordered cascade.

    A column of this name is replaced.  Repeated rows are measured one by one.
    """
    ordered = order_rules(frame, text, rules, sample_rows)
    features = F.struct(*(function(whole(text)).alias(name) for name, function in FEATURES.items()))

    def judged(values: Column) -> Column:
        known = {name: values[name] for name in FEATURES}
        verdict = rejected_by(whole(text), ordered, known).alias("rejected_by")
        return F.struct(*(known[name].alias(name) for name in FEATURES), verdict)

    return frame.withColumn("measured", bound(features, judged))
