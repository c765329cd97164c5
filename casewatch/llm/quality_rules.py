"""Quality rules: a table of thresholds compiled into one projection.

Every measure is an expression over built-in functions, every rule a comparison of a
measure with a number. Texts are read once, nothing is shuffled and no user function
runs.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from casewatch.llm.common import SPACES, let, words

# The characters that count as symbols, and limits of the base rules.
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 50, 50, 3

# Frequent short words of four languages, and the codes of these.
LANGUAGES = ("de", "en", "es", "fr")
STOP_WORDS = (
    # English
    "the be to of and that have with in for on is was by at this from or an are as it a re "
    # German
    "der die und das den von zu mit sich des auf ist im dem nicht ein eine sie er es "
    # French
    "le la les de des et un une du en que qui pour dans sur pas par est au avec elle "
    # Spanish
    "el los las y con por para del se lo su como más que no una"
).split()


@dataclass(frozen=True)
class Rule:
    """A document fails if `measure` is outside of [low, high]; None is no limit.

    A ratio whose denominator is zero is NULL, and NULL fails no rule.
    """

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


RULES = (
    Rule("length", "n_words", low=50),
    Rule("word_length", "chars_per_word", low=1.5, high=20),
    Rule("symbols", "symbols_per_word", high=0.3),
    Rule("stop_words", "stop_word_ratio", low=0.03),
    Rule("repeated_lines", "dup_line_ratio", high=0.5),
)


def _size(array: Column) -> Column:
    return F.size(array).cast("bigint")


def _repeat_words(found: Column) -> Column:
    """Words inside windows of WINDOW words that occur twice or more in the text.

    Windows are sorted as (hash, position), so equal ones are neighbours. Each position
    that has an equal neighbour covers WINDOW words, less what the previous one covered.
    Hashes have 64 bits: two windows of one text are taken for equal by mistake with a
    chance below 1 in 10^9 even at 100,000 words.
    """
    n = F.size(found)
    spots = F.when(n < WINDOW, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), n - WINDOW))

    def window(at: Column) -> Column:
        return F.struct(
            F.xxhash64(*(F.get(found, at + k) for k in range(WINDOW))).alias("hash"), at.alias("at")
        )

    def positions(order: Column) -> Column:
        def repeated(item: Column, i: Column) -> Column:
            before, after = F.get(order, i - 1)["hash"], F.get(order, i + 1)["hash"]
            return F.coalesce(before == item["hash"], F.lit(False)) | F.coalesce(after == item["hash"], F.lit(False))

        return F.sort_array(F.transform(F.filter(order, repeated), lambda item: item["at"]))

    def covered(places: Column) -> Column:
        gaps = F.transform(
            places, lambda at, i: F.when(i == 0, WINDOW).otherwise(F.least(F.lit(WINDOW), at - F.get(places, i - 1)))
        )
        return F.aggregate(gaps, F.lit(0).cast("bigint"), lambda total, gap: total + gap)

    return let(F.sort_array(F.transform(spots, window)), lambda order: let(positions(order), covered))


def _count_of(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def _measures(text: Column) -> Column:
    """A struct of all counts of one text. Null is the empty text."""
    text = F.coalesce(text, F.lit(""))
    stop = F.array(*(F.lit(w) for w in sorted(set(STOP_WORDS))))

    def with_word(line: Column) -> Column:
        return F.trim(line, F.lit(SPACES)) != ""

    def over_lines(lines: Column) -> Column:
        return F.struct(_size(lines).alias("n_lines"), (_size(lines) - _size(F.array_distinct(lines))).alias("n_dup_lines"))

    def over_words(found: Column) -> Column:
        return F.struct(
            _size(found).alias("n_words"),
            _repeat_words(found).alias("n_repeat_words"),
            _size(F.filter(found, lambda w: F.array_contains(stop, F.lower(w)))).alias("n_stop_words"),
        )

    return F.struct(
        let(words(text), over_words).alias("words"),
        let(F.filter(F.split(text, "\n"), with_word), over_lines).alias("lines"),
        (F.length(text) - _count_of(text, SPACES)).cast("bigint").alias("word_chars"),
        _count_of(text, SYMBOLS).cast("bigint").alias("n_symbols"),
    )


def _fails(value: Column, rule: Rule) -> Column:
    limits = [value < rule.low] if rule.low is not None else []
    limits += [value > rule.high] if rule.high is not None else []
    return F.coalesce(reduce(Column.__or__, limits), F.lit(False))


def verdict(text: Column, rules: tuple[Rule, ...] = RULES, lang: Column | None = None) -> Column:
    """A struct of a text's counts, ratios, base_failed, failed_rules (names) and kept.

    Stop words and the length of words tell something only in LANGUAGES: where `lang` names
    another language, both ratios are NULL. It is one expression in which the text is measured once, also where Spark moves it
    into a filter.
    """

    listed = F.lit(True) if lang is None else lang.isNull() | F.lower(lang).isin(*LANGUAGES)

    def over(m: Column) -> Column:
        found = {
            "n_words": m["words"]["n_words"],
            "word_chars": m["word_chars"],
            "n_symbols": m["n_symbols"],
            "n_dup_lines": m["lines"]["n_dup_lines"],
            "n_repeat_words": m["words"]["n_repeat_words"],
            "n_stop_words": m["words"]["n_stop_words"],
            "n_lines": m["lines"]["n_lines"],
        }
        found |= {
            "chars_per_word": F.when(listed, F.try_divide(found["word_chars"], found["n_words"])),
            "symbols_per_word": F.try_divide(found["n_symbols"], found["n_words"]),
            "stop_word_ratio": F.when(listed, F.try_divide(found["n_stop_words"], found["n_words"])),
            "dup_line_ratio": F.try_divide(found["n_dup_lines"], found["n_lines"]),
        }
        base = (found["n_words"] < MIN_WORDS) | (found["n_repeat_words"] * 100 > found["n_words"] * MAX_REPEAT_PERCENT)
        failed = F.array_compact(F.array(*(F.when(_fails(found[r.measure], r), F.lit(r.name)) for r in rules)))
        return F.struct(
            *(c.alias(n) for n, c in found.items()),
            base.alias("base_failed"),
            failed.alias("failed_rules"),
            (~base & (F.size(failed) == 0)).alias("kept"),
        )

    return let(_measures(text), over)


def judge(
    documents: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, lang: str | None = "lang"
) -> DataFrame:
    """(row, verdict) per document: the input's columns, and what `verdict` finds.

    `lang` is a column of language codes, if the table has it; a null code says nothing.
    Null and empty texts have no words and fail. Repeated rows are judged each on its own.
    """
    code = F.col(lang) if lang in documents.columns else None
    return documents.select(F.struct("*").alias("row"), verdict(F.col(text), rules, code).alias("verdict"))


def keep_good(documents: DataFrame, text: str = "text", lang: str | None = "lang") -> DataFrame:
    """The documents that fail no rule, with their own columns."""
    return judge(documents, text, lang=lang).filter("verdict.kept").select("row.*")
