"""Document quality by lines first, as DataFrame expressions throughout.

Every line is held against punctuation, navigation and boilerplate rules; lines that fail are
taken out, and a document that loses too many of its words is rejected. Counts over the whole
document (symbols, repeated lines, repeated five-word windows) come beside that. All of it is row
by row: no shuffle, however the rows are spread.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from marlstone.llm.common import SPACE_CLASS, SPACES, WORD, id_and_text

# The rules.
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
SYMBOLS = r"[#*$%&|<>]"
# A line should end like a sentence, closing quotes and brackets aside. One that does not is a
# fragment if it is short or holds no sentence end at all.
CLOSERS = "\"'”’»)]"
SENTENCE_ENDS = [".", "!", "?", ":", ";", "…", "。", "！", "？", "।", "؟"]
SENTENCE_MARK = "[.!?…。！？।؟]"
FRAGMENT_WORDS = 10
# Marks set in runs, as in "now!!" or "word***"; one for every third word is too many.
MARK_RUN = r"[!?#*$%&|<>]{2,}"
WORDS_PER_MARK_RUN = 3
# Bars, bullets and arrows between the items of a menu.
MENU_MARK = "[|»›·•]"
MENU_MARKS = 3
BOILERPLATE = [
    "all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie policy",
    "use cookies", "uses cookies", "enable javascript", "licensed under", "released under the",
    "click here", "lorem ipsum", "sign up for our newsletter", "share this page",
    "share this article", "powered by wordpress",
]
MAX_LOST_PERCENT = 50


def with_value(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value worked out once, however often `body` names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    return with_value(
        F.btrim(text, F.lit(SPACES)),
        lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(
            F.split(t, SPACE_CLASS + "+")
        ),
    )


def n_words_of(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD))


def repeated_words(words: Column) -> Column:
    """How many words lie in a five-word window that the text holds twice or more.

    Windows are compared by their 64-bit hash. Only where some hash comes twice are hashes sorted
    with their places, and the places of equal neighbours merged into stretches.
    """
    starts = F.sequence(F.lit(0), F.size(words) - WINDOW)
    hashes = F.transform(
        starts, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)])
    )
    counted = with_value(
        hashes,
        lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
            with_value(
                F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))),
                _covered,
            )
        ),
    )
    return F.when(F.size(words) < WINDOW, F.lit(0)).otherwise(counted)


def _covered(pairs: Column) -> Column:
    def alike(k: Column) -> Column:
        own = F.get(pairs, k)["h"]
        return F.coalesce(own == F.get(pairs, k - 1)["h"], F.lit(False)) | F.coalesce(
            own == F.get(pairs, k + 1)["h"], F.lit(False)
        )

    places = F.sort_array(
        F.transform(
            F.filter(F.sequence(F.lit(0), F.size(pairs) - 1), alike),
            lambda k: F.get(pairs, k)["i"],
        )
    )
    return F.aggregate(
        places,
        F.struct(F.lit(0).alias("total"), F.lit(0).alias("end")),
        lambda a, p: F.struct(
            (a["total"] + p + WINDOW - F.greatest(a["end"], p)).alias("total"),
            (p + WINDOW).alias("end"),
        ),
        lambda a: a["total"],
    )


def line_fails(line: Column) -> Column:
    """Whether a line with a word breaks a rule."""
    last = F.substring(F.rtrim(line, F.lit(SPACES + CLOSERS)), -1, 1)
    boilerplate = with_value(
        F.lower(line),
        lambda x: reduce(Column.__or__, [F.contains(x, F.lit(p)) for p in BOILERPLATE]),
    )

    def by_count(n: Column) -> Column:
        fragment = ~last.isin(SENTENCE_ENDS) & (
            (n < FRAGMENT_WORDS) | ~line.rlike(SENTENCE_MARK)
        )
        shouting = F.regexp_count(line, F.lit(MARK_RUN)) * WORDS_PER_MARK_RUN > n
        menu = F.regexp_count(line, F.lit(MENU_MARK)) >= MENU_MARKS
        return fragment | shouting | menu | boilerplate

    return with_value(n_words_of(line), by_count)


def quality_rules(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts, the verdicts, and the text without the lines that fail.

    Columns: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept, n_failed_lines, n_lost_words, clean_text. A null or blank text has no words, fails and
    has an empty clean text. Lines without a word break no rule and stay. Ties and repeated rows
    do not arise: each row is judged alone. Other columns of the input are ignored; an empty table
    gives an empty result.
    """
    return _judged(id_and_text(df, id_col, text_col), F.col("text")).drop("text")


def cleaned(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of `df` that are kept, with its columns, the text without the lines that fail.

    Null, empty and blank texts are not kept. Repeated rows are judged alike; an empty table gives an
    empty result.
    """
    rows = df.select(F.struct("*").alias("row"))
    text = F.col("row")[text_col].cast("string")
    kept = _judged(rows, text).where("kept")
    return kept.select(
        *[
            (F.col("clean_text") if c == text_col else F.col("row")[c]).alias(c)
            for c in df.columns
        ]
    )


def _judged(rows: DataFrame, text: Column) -> DataFrame:
    return (
        rows.select("*", *columns(F.coalesce(text, F.lit(""))))
        .withColumn(
            "base_failed",
            (F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
        )
        .withColumn(
            "kept",
            ~F.col("base_failed")
            & (100 * F.col("n_lost_words") <= MAX_LOST_PERCENT * F.col("n_words")),
        )
    )


def columns(text: Column) -> list[Column]:
    counts = with_value(
        words_of(text),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.concat_ws("", w)).cast("long").alias("word_chars"),
            repeated_words(w).cast("long").alias("n_repeat_words"),
        ),
    )
    by_line = with_value(
        F.split(text, "\n"),
        lambda lines: with_value(
            F.filter(lines, lambda x: x.rlike(WORD)),
            lambda full: with_value(
                F.filter(full, line_fails),
                lambda bad: F.struct(
                    (F.size(full) - F.size(F.array_distinct(full))).cast("long").alias("dup"),
                    F.size(bad).cast("long").alias("bad"),
                    F.aggregate(
                        bad, F.lit(0).cast("long"), lambda a, x: a + n_words_of(x)
                    ).alias("lost"),
                    F.when(F.size(bad) == 0, text).otherwise(
                        F.array_join(
                            F.filter(lines, lambda x: ~(x.rlike(WORD) & line_fails(x))), "\n"
                        )
                    ).alias("clean"),
                ),
            ),
        ),
    )
    # A generator keeps the optimiser from copying these structs into each column that reads them.
    return [
        F.inline(
            F.array(
                with_value(
                    counts,
                    lambda c: with_value(
                        by_line,
                        lambda b: F.struct(
                            c["n_words"].alias("n_words"),
                            c["word_chars"].alias("word_chars"),
                            F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
                            b["dup"].alias("n_dup_lines"),
                            c["n_repeat_words"].alias("n_repeat_words"),
                            b["bad"].alias("n_failed_lines"),
                            b["lost"].alias("n_lost_words"),
                            b["clean"].alias("clean_text"),
                        ),
                    ),
                )
            )
        )
    ]
