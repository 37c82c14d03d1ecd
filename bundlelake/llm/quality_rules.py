"""Quality rules, line first.

Every line is judged by itself on punctuation, navigation and boilerplate; failing lines are
removed, and a document that loses too much of its text is rejected. Only built-in
expressions: one projection, no shuffle, no Python.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bundlelake.llm.common import WORD, let, quoted, words_of

#: Marks that prose rarely has, as the statistics count them.
SYMBOLS = r"[#*$%&|<>]"
#: Whole lines that are menus rather than text.
NAVIGATION = (
    r"(?i)^\W*(home|menu|search|log ?in|log ?out|sign ?in|sign ?up|register|next|previous|prev|back"
    r"|back to top|skip to (main )?content|contact( us)?|about( us)?|help|faq|sitemap|site map"
    r"|share|print|read more|more|subscribe|follow us)\W*$"
)
#: Phrases of notices around a text, in lower case.
BOILERPLATE = (
    "all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie policy",
    "use cookies", "accept cookies", "accept all cookies", "enable javascript", "click here",
    "lorem ipsum", "subscribe to our", "sign up for", "powered by",
)
#: Any mark that the punctuation rules count.
MARKS = r"[#*$%&|<>!?»›·•]"
#: Navigation and boilerplate are sought in lines of up to this many characters; longer ones are text.
SHORT_LINE = 120
#: Failing shares: symbols, stressed marks and bars per word of a line.
MAX_SYMBOLS, MAX_STRESS, MAX_BARS = 0.2, 0.3, 0.3
#: A document is rejected when more than this share of its word characters is removed.
MAX_LOST = 0.4
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5


def _without_space(text: Column) -> Column:
    for mark in (" ", "\t", "\n", "\x0b", "\f", "\r"):
        text = F.replace(text, F.lit(mark), F.lit(""))
    return text


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def line_passes(line: Column) -> Column:
    """The verdict on one line: punctuation, navigation and boilerplate.

    A line without a word passes; it only carries layout.
    """
    def overmarked(n):
        return (
            (_count(line, SYMBOLS) > MAX_SYMBOLS * n)
            | (_count(line, r"[!?]{2,}") > MAX_STRESS * n)
            | (_count(line, r"[|»›·•]") > MAX_BARS * n)
        )

    notice = let(F.lower(line), lambda low: reduce(or_, (low.contains(x) for x in BOILERPLATE)))
    return ~(line.rlike(MARKS) & let(_count(line, WORD), overmarked)) & ~(
        (F.length(line) <= SHORT_LINE) & (line.rlike(NAVIGATION) | notice)
    )


def _repeat_words(words: Column) -> Column:
    """Words in windows of five words that occur twice or more in the text.

    Windows are compared by 64-bit hashes; sorting them with their positions costs
    n log n and happens only for texts that repeat anything.
    """
    def covered(hashes):
        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(pairs):
            def repeated(pair, j):
                same = F.coalesce(F.get(pairs, j - 1)["h"] == pair["h"], F.lit(False)) | F.coalesce(
                    F.get(pairs, j + 1)["h"] == pair["h"], F.lit(False)
                )
                return F.when(same, pair["i"])

            found = F.sort_array(F.filter(F.transform(pairs, repeated), lambda i: i.isNotNull()))
            return let(
                found,
                lambda at: F.aggregate(
                    F.transform(
                        at,
                        lambda i, j: F.least(F.lit(WINDOW), F.coalesce(F.get(at, j + 1) - i, F.lit(WINDOW))),
                    ),
                    F.lit(0).cast("long"),
                    lambda total, n: total + n,
                ),
            )

        return F.when(
            F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")
        ).otherwise(let(ordered, starts))

    windows = F.when(F.size(words) >= WINDOW, F.sequence(F.lit(0), F.size(words) - WINDOW)).otherwise(
        F.array().cast("array<int>")
    )
    return let(
        F.transform(
            windows, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)])
        ),
        covered,
    )


def _facts(text: Column) -> Column:
    def of_lines(lines, words):
        real = F.filter(lines, lambda line: line.rlike(WORD))
        kept = F.filter(lines, line_passes)
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(_without_space(text)).cast("long").alias("word_chars"),
            (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            let(real, lambda r: F.size(r) - F.size(F.array_distinct(r))).cast("long").alias("n_dup_lines"),
            _repeat_words(words).alias("n_repeat_words"),
            F.array_join(kept, "\n").alias("clean_text"),
        )

    return let(
        words_of(text), lambda words: let(F.split(text, "\n"), lambda lines: of_lines(lines, words))
    )


def assess(documents: DataFrame, text: str = "text", max_lost: float = MAX_LOST) -> DataFrame:
    """Add statistics, the cleaned text and the verdict to every document.

    Adds ``quality``: a struct of ``n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, clean_text, base_failed, kept``. One row per input row, repeated rows
    included; a column already named ``quality`` is replaced. A null or empty text has no
    words, so ``base_failed`` is true and its ``clean_text`` is empty. Texts are judged whole.
    """
    facts = _facts(F.coalesce(quoted(text), F.lit("")))

    def verdict(f):
        failed = (f["n_words"] < MIN_WORDS) | (
            100 * f["n_repeat_words"] > MAX_REPEAT_PERCENT * f["n_words"]
        )
        left = F.length(_without_space(f["clean_text"]))
        return F.struct(
            *[f[c].alias(c) for c in (
                "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "clean_text"
            )],
            failed.alias("base_failed"),
            (~failed & (left >= (1 - max_lost) * f["word_chars"])).alias("kept"),
        )

    return documents.withColumn("quality", let(facts, verdict))


def clean(documents: DataFrame, text: str = "text") -> DataFrame:
    """Keep the documents that pass, with failing lines removed from their text.

    Returns the input's columns; ``n_chars``, where present, is counted again. Documents that
    fail, empty and null texts among them, go.
    """
    passed = assess(documents, text).where(F.col("quality.kept"))
    changed = {text: F.col("quality.clean_text")}
    if "n_chars" in documents.columns:
        changed["n_chars"] = F.length(F.col("quality.clean_text")).cast("long")
    return passed.withColumns(changed).select(*[quoted(c) for c in documents.columns])
