"""Quality rules: a threshold table compiled into one projection.

A rule is a ratio of two measures with a lower and an upper bound. The measures are Spark
expressions over the text alone, so the whole table becomes one projection of the scan: no shuffle,
no user function, and the same work for every row.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passagemill.llm.common import BLANKS, let, words_column

SYMBOLS = r"[#*$%&|<>]"

#: Frequent words of the languages that a text may be in.
STOP_WORDS = {
    "en": "the of and to in a is that it for on was be with this are by from or an as at not".split(),
    "fr": "le la les de des du et un une en est que qui dans pour sur pas au par avec".split(),
    "de": "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine".split(),
    "es": "el la los las de y que en un una por con no se del al es su para lo".split(),
}


class Rule(NamedTuple):
    """``low <= numerator / denominator <= high``; a ratio over zero is zero."""

    name: str
    numerator: str
    denominator: str | None
    low: float | None
    high: float | None


#: The production table. Bounds are wide: they are met by ordinary prose in any of the languages.
RULES = (
    Rule("word_length", "word_chars", "n_words", 2.0, 12.0),
    Rule("symbol_ratio", "n_symbols", "n_words", None, 0.1),
    Rule("stop_word_ratio", "n_stop_words", "n_words", 0.03, None),
    Rule("letter_word_ratio", "n_letter_words", "n_words", 0.7, None),
    Rule("capital_ratio", "n_capitals", "word_chars", None, 0.3),
    Rule("digit_ratio", "n_digits", "word_chars", None, 0.2),
    Rule("dup_line_ratio", "n_dup_lines", "n_lines", None, 0.3),
    Rule("repeat_word_ratio", "n_repeat_words", "n_words", None, 0.3),
)

MIN_WORDS = 50
WINDOW = 3


def _removed(text: Column, pattern: str) -> Column:
    """How many signs of ``text`` match the pattern."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _repeat_words(words: Column, window: int) -> Column:
    """Words that lie in a window of so many words found twice or more, each word once.

    Windows are sorted by their hash, so that equal ones are neighbours; the positions of those are
    sorted again, and each covers the words up to the next one. No step compares all pairs.
    """

    def positions(windows: Column) -> Column:
        same = lambda one, at: F.coalesce(F.get(windows, at)["key"] == one["key"], F.lit(False))
        kept = F.filter(windows, lambda one, at: same(one, at - 1) | same(one, at + 1))
        return F.sort_array(F.transform(kept, lambda one: one["at"]))

    def covered(starts: Column) -> Column:
        widths = F.transform(
            starts,
            lambda start, at: F.least(
                F.lit(window), F.coalesce(F.get(starts, at + 1) - start, F.lit(window))
            ),
        )
        return F.aggregate(widths, F.lit(0).cast("long"), lambda total, one: total + one)

    def windows(hashes: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(hashes) - window),
            lambda at: F.struct(
                F.xxhash64(*[F.get(hashes, at + step) for step in range(window)]).alias("key"),
                at.alias("at"),
            ),
        )

    def counted(hashes: Column) -> Column:
        found = let(
            let(F.sort_array(windows(hashes)), positions),
            covered,
        )
        return F.when(F.size(hashes) >= window, found).otherwise(F.lit(0).cast("long"))

    return let(F.transform(words, lambda word: F.xxhash64(word)), counted)


def measures(text: Column, stop_words: Sequence[str]) -> Column:
    """All counts of a text as one struct of longs."""
    stops = F.array(*[F.lit(word) for word in sorted(set(stop_words))])

    def of_words(words: Column) -> list[Column]:
        lower = F.transform(words, lambda word: F.lower(word))
        return [
            F.size(words).alias("n_words"),
            _repeat_words(words, WINDOW).alias("n_repeat_words"),
            F.size(F.filter(lower, lambda word: F.array_contains(stops, word))).alias(
                "n_stop_words"
            ),
            F.size(F.filter(words, lambda word: F.rlike(word, F.lit(r"\p{L}")))).alias(
                "n_letter_words"
            ),
        ]

    def of_lines(lines: Column) -> list[Column]:
        return [
            F.size(lines).alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).alias("n_dup_lines"),
        ]

    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.rlike(line, F.lit(r"[^\x20\x09-\x0D]")))
    parts = F.struct(
        let(words_column(text), lambda words: F.struct(*of_words(words))).alias("words"),
        let(lines, lambda found: F.struct(*of_lines(found))).alias("lines"),
        F.length(F.regexp_replace(text, BLANKS, "")).alias("word_chars"),
        _removed(text, SYMBOLS).alias("n_symbols"),
        _removed(text, r"\p{Lu}+").alias("n_capitals"),
        _removed(text, r"\p{Nd}+").alias("n_digits"),
    )

    def flat(part: Column) -> Column:
        names = {
            "words": ("n_words", "n_repeat_words", "n_stop_words", "n_letter_words"),
            "lines": ("n_lines", "n_dup_lines"),
        }
        nested = [part[group][name].cast("long").alias(name) for group in names for name in names[group]]
        single = [
            part[name].cast("long").alias(name)
            for name in ("word_chars", "n_symbols", "n_capitals", "n_digits")
        ]
        return F.struct(*nested, *single)

    return let(parts, flat)


def _passes(counts: Column, rule: Rule) -> Column:
    value = counts[rule.numerator].cast("double")
    if rule.denominator is not None:
        below = counts[rule.denominator]
        value = F.when(below > 0, value / below).otherwise(F.lit(0.0))
    passed = F.lit(True)
    if rule.low is not None:
        passed = passed & (value >= rule.low)
    if rule.high is not None:
        passed = passed & (value <= rule.high)
    return passed


def verdict(counts: Column, rules: Sequence[Rule], min_words: int = MIN_WORDS) -> Column:
    """A struct of ``base_failed``, ``failed`` (names of the rules that fail) and ``kept``."""
    base_failed = (counts["n_words"] < min_words) | (
        100 * counts["n_repeat_words"] > 50 * counts["n_words"]
    )
    failed = F.array_compact(
        F.array(*[F.when(~_passes(counts, rule), F.lit(rule.name)) for rule in rules])
    )
    return F.struct(
        base_failed.alias("base_failed"),
        failed.alias("failed"),
        (~base_failed & (F.size(failed) == 0)).alias("kept"),
    )


def apply_rules(
    documents: DataFrame,
    text: str = "text",
    rules: Sequence[Rule] = RULES,
    stop_words: Sequence[str] | None = None,
    min_words: int = MIN_WORDS,
    output: str = "quality",
) -> DataFrame:
    """Add one struct column ``output`` with all counts and the verdict; other columns stay.

    A column already called ``output`` is replaced. Null text counts as empty: no words, and so not
    kept. Repeated rows are judged each on its own; an empty table gives an empty table. A text of
    any length is read whole.
    """
    if stop_words is None:
        stop_words = [word for words in STOP_WORDS.values() for word in words]
    judged = let(
        measures(F.col(text), stop_words),
        lambda counts: F.struct(
            counts.alias("counts"), verdict(counts, rules, min_words).alias("verdict")
        ),
    )
    return documents.withColumn(output, judged)


def filter_quality(documents: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows that every rule keeps, with their own columns only."""
    columns = [F.col(f"`{name}`") for name in documents.columns]
    row = documents.select(F.struct(*columns).alias("row"), F.col(text).alias("text"))
    return apply_rules(row, **options).where("quality.verdict.kept").select("row.*")
