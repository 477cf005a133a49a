"""Quality rules: a table of thresholds compiled into one Spark projection, without user functions.

Every rule names a measure of the text and the range in which it must lie. Measures are Spark expressions
over the text alone (length, symbol, stop-word and line ratios), so the whole operator is one narrow
projection: no shuffle, no Python, nothing kept between rows. A filter on a result column should go through ``keep_good``, or
follow a stored result: Spark would move it below the projection and work out the measures again for it.

Defined results: a NULL or empty text has zero words and fails the base rule; repeated rows are judged alike;
every column of the input is carried through, and only the documented result columns are added (an input
column of the same name is replaced). Ratios with a zero denominator are 0.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# White space that separates words, and characters that count as symbols.
WORD_GAP = r"[\x20\x09-\x0D]+"
GAP_CHARACTERS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8

# Frequent function words of the four languages of the corpus.
STOP_WORDS = {
    "en": ["the", "be", "to", "of", "and", "that", "have", "with", "a", "in", "is", "it", "for", "are", "or", "was"],
    "fr": ["le", "la", "les", "de", "et", "un", "une", "des", "que", "est", "en", "du", "dans", "pour", "qui"],
    "de": ["der", "die", "das", "und", "ist", "zu", "ein", "eine", "den", "nicht", "mit", "von", "in", "im", "als"],
    "es": ["el", "la", "los", "de", "y", "un", "una", "que", "en", "del", "las", "por", "para", "no", "se", "es"],
}


@dataclass(frozen=True)
class Rule:
    """``measure`` must lie between ``low`` and ``high``, both included; None leaves that side open."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


RULES: tuple[Rule, ...] = (
    Rule("mean_word_length", "word_chars / n_words", 2.0, 14.0),
    Rule("symbol_share", "n_symbols / word_chars", None, 0.06),
    Rule("symbol_words", "n_symbols / n_words", None, 0.50),
    Rule("stop_word_share", "n_stop_words / n_words", 0.02, None),
    Rule("duplicate_lines", "n_dup_lines / n_lines", None, 0.50),
)


def _prepared(docs: DataFrame, text: str) -> DataFrame:
    stops = sorted({w for words in STOP_WORDS.values() for w in words})
    body = F.coalesce(F.col(text), F.lit(""))
    return (
        docs.withColumn("__text", body)
        .withColumn("__words", F.array_remove(F.split("__text", WORD_GAP, -1), ""))
        .withColumn("n_words", F.size("__words").cast("long"))
        .withColumn(
            "word_chars",
            (F.length("__text") - F.length(F.regexp_replace("__text", rf"[^{_class(GAP_CHARACTERS)}]+", ""))).cast("long"),
        )
        .withColumn("n_symbols", F.length(F.regexp_replace("__text", rf"[^{_class(SYMBOLS)}]+", "")).cast("long"))
        .withColumn("__lines", F.filter(F.split("__text", "\n", -1), lambda line: line.rlike(rf"[^{_class(GAP_CHARACTERS)}]")))
        .withColumn("n_lines", F.size("__lines").cast("long"))
        .withColumn("n_dup_lines", (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"))
        .withColumn(
            "n_stop_words",
            F.size(F.filter("__words", lambda w: (F.length(w) <= 5) & F.lower(w).isin(stops))).cast("long"),
        )
        .withColumn("__windows", _window_hashes(F.col("__words"), F.col("n_words")))
        .withColumn(
            "__pairs",
            # most texts repeat no window: only the others are sorted
            F.when(
                F.size(F.array_distinct("__windows")) < F.size("__windows"),
                F.sort_array(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
            ),
        )
        .withColumn("__starts", _repeated_starts(F.col("__pairs")))
        .withColumn("n_repeat_words", F.coalesce(_covered(F.col("__starts")), F.lit(0)).cast("long"))
    )


def _class(characters: str) -> str:
    return "".join(f"\\x{ord(c):02X}" for c in characters)


def _shifted(array: Column, by: int, n: Column) -> tuple[Column, Column]:
    """The array without its last ``by`` elements, and without its first ones."""
    rest = F.greatest(n - by, F.lit(0)).cast("int")
    return F.slice(array, 1, rest), F.slice(array, 1 + by, rest)


def _window_hashes(words: Column, n: Column) -> Column:
    """64-bit hash of every window of 8 words, from hashes of 1, 2 and 4 words."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    span = 1
    while span < WINDOW:
        left, right = _shifted(hashes, span, n - (span - 1))
        hashes = F.zip_with(left, right, lambda a, b: F.xxhash64(a, b))
        span *= 2
    return hashes


def _repeated_starts(pairs: Column) -> Column:
    """Starts, in order, of the windows whose hash occurs more than once; ``pairs`` are (hash, start), sorted."""
    n = F.size(pairs)
    left, right = _shifted(pairs, 1, n)
    equal = F.zip_with(left, right, lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    return F.sort_array(F.array_distinct(F.flatten(F.filter(equal, lambda x: x.isNotNull()))))


def _covered(starts: Column) -> Column:
    """Number of words in the windows that begin at ``starts``."""
    left, right = _shifted(starts, 1, F.size(starts))
    steps = F.zip_with(left, right, lambda a, b: F.least(b - a, F.lit(WINDOW)))
    return F.lit(WINDOW) + F.aggregate(steps, F.lit(0), lambda total, step: total + step)


def _verdict(rules: Sequence[Rule]) -> Column:
    """Names of the rules that the text breaks."""
    broken = []
    for rule in rules:
        above, _, below = rule.measure.partition(" / ")
        measure = F.when(F.col(below) > 0, F.col(above) / F.col(below)).otherwise(F.lit(0.0)) if below else F.col(above)
        outside = F.lit(False)
        if rule.low is not None:
            outside = outside | (measure < rule.low)
        if rule.high is not None:
            outside = outside | (measure > rule.high)
        broken.append(F.when(outside, F.lit(rule.name)))
    return F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>")


def judge(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """All columns of ``docs`` with the measures, ``base_failed``, ``broken_rules`` and ``kept``."""
    measured = _prepared(docs, text)
    judged = measured.withColumn(
        "base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    ).withColumn("broken_rules", _verdict(rules))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("broken_rules") == 0)).drop(
        "__text", "__words", "__lines", "__windows", "__pairs", "__starts"
    )


def keep_good(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """The documents that pass, with the columns of ``docs``."""
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text).alias("text"))
    # the number keeps Spark from working out the whole verdict once more for each place where a filter could go
    judged = judge(inner, "text", rules).withColumn("__number", F.monotonically_increasing_id())
    return judged.where(F.col("kept") & (F.col("__number") >= 0)).select("row.*")
