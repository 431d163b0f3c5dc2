"""Line-first cleaning, in DataFrame functions only.

Every line is held against a punctuation, a navigation and a boilerplate rule; lines that fail one are removed,
and a document is rejected if too much of its text goes with them, or if a base rule fails (too few words, too
many repeated words). All work is within a row: nothing is shuffled, whatever the copies or sources.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
MIN_KEPT_PERCENT = 50      # of the characters in words
WORDS_PER_SYMBOL = 5       # a line with more symbols than one in so many words is not prose
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

# A line of prose ends with a sign that closes a sentence.
CLOSED = r"""[.!?:;,)\]"'…”’»。！？]\s*$"""
# Items side by side, as menus and breadcrumbs have them.
NAVIGATION = r"(?:\s[|»›•·>]\s.*){2,}|^\s*(?:home|menu|next|previous|back to top|skip to content)\b.{0,20}$"
BOILERPLATE = (r"(?i)\b(?:java ?script|cookies?|lorem ipsum|all rights reserved|terms of (?:use|service)|"
               r"privacy policy|licen[sc]ed under|sign (?:in|up)|log ?in|subscribe|newsletter|copyright|click here)\b")


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def line_is_kept(line: Column) -> Column:
    words = F.length(line) - F.length(_without(line, " ")) + 1
    symbols = F.length(line) - F.length(_without(line, SYMBOLS))
    return (line.rlike(CLOSED) & (symbols * WORDS_PER_SYMBOL <= words)
            & ~line.rlike(NAVIGATION) & ~line.rlike(BOILERPLATE))


def _covered(begins: Column, width: int) -> Column:
    """Places covered by windows of ``width`` that begin at the sorted distinct places ``begins``."""
    return F.aggregate(
        F.transform(begins, lambda b, i: F.least(F.lit(width), F.coalesce(F.get(begins, i + 1) - b, F.lit(width)))),
        F.lit(0), lambda acc, n: acc + n)


def quality_rules(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  min_kept_percent: int = MIN_KEPT_PERCENT) -> DataFrame:
    """Per row of ``documents``: id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept, kept_chars (characters of words in kept lines) and cleaned (the kept lines).

    A null or empty text has no words and is not kept. Null ids and repeated rows give one result each, an empty
    table none. A line without words fails no rule and counts nowhere. Other columns are not read.
    """
    words = F.array_remove(F.split(F.translate("text", SPACES[1:], " " * 5), " ", -1), "")
    has_word = lambda line: F.length(_without(line, SPACES)) > 0
    window = lambda i: F.struct(F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)).alias("h"),
                                i.alias("i"))
    read = documents.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    parts = read.select(
        "id", "text", words.alias("words"),
        F.filter(F.split("text", "\n", -1), has_word).alias("lines"),
        F.length(_without(F.col("text"), SPACES)).cast("long").alias("word_chars"),
        (F.length("text") - F.length(_without(F.col("text"), SYMBOLS))).cast("long").alias("n_symbols"))
    with_windows = parts.select(
        "id", "lines", "word_chars", "n_symbols", F.size("words").cast("long").alias("n_words"),
        F.when(F.size("words") >= 3, F.transform(F.sequence(F.lit(0), F.size("words") - 3), window)).alias("windows"))
    # Only a text with equal windows has its windows put in order.
    ordered = with_windows.withColumn("windows", F.when(
        F.size(F.array_distinct("windows.h")) < F.size("windows"), F.sort_array("windows")))
    twice = ordered.withColumn("begins", F.sort_array(F.transform(
        F.filter("windows", lambda x, i: (x["h"] == F.get("windows", i - 1)["h"]) | (x["h"] == F.get("windows", i + 1)["h"])),
        lambda x: x["i"])))
    measured = twice.select(
        "id", "n_words", "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(_covered(F.col("begins"), 3), F.lit(0)).cast("long").alias("n_repeat_words"),
        F.filter("lines", line_is_kept).alias("kept_lines"))
    judged = measured.select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        ((F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))).alias("base_failed"),
        F.length(_without(F.array_join("kept_lines", ""), SPACES)).cast("long").alias("kept_chars"),
        F.array_join("kept_lines", "\n").alias("cleaned"))
    return judged.withColumn(
        "kept", ~F.col("base_failed") & (100 * F.col("kept_chars") >= min_kept_percent * F.col("word_chars")))
