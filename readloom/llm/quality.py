"""Line-first cleaning: judge every line, drop the failures, reject documents that lose too much.

Everything is a column expression over one row; nothing is shuffled and no Python runs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.llm.common import ascii_lower, let, words, wrapped

SYMBOLS = "[#*$%&|<>]"

# Phrases of page furniture, lower case.
BOILERPLATE = [
    "accept cookies",
    "all rights reserved",
    "back to top",
    "click here",
    "cookie policy",
    "enable javascript",
    "log in to",
    "lorem ipsum",
    "powered by",
    "privacy policy",
    "read more",
    "share this",
    "sign up",
    "skip to content",
    "subscribe to",
    "terms of service",
    "terms of use",
]

# A sentence ends in one of these, maybe behind closing quotes or brackets.
LINE_END = r"[.!?:;\x{2026}\x{3002}\x{FF01}\x{FF1F}][\"')\]\x{00BB}\x{201D}\x{2019}]*[ \t-\r]*$"
# The SQL searches only so many last characters of a line for its end mark.
LINE_TAIL = 16
HAS_WORD = r"[^ \t-\r]"
INNER_END = r"[.!?\x{2026}\x{3002}\x{FF01}\x{FF1F}][\"')\]\x{00BB}\x{201D}\x{2019}]*[ \t-\r]"


@dataclass(frozen=True)
class LineRules:
    """Parameters of the line rules and of the document verdict; lengths are in code points."""

    min_words: int = 50
    max_repeat_percent: int = 50
    # A line with this many separators of a menu ("a | b | c") is navigation.
    navigation_marks: int = 3
    # Denser symbols or exclamation marks than one in so many characters are not prose.
    chars_per_symbol: int = 30
    chars_per_shout: int = 15
    # A line without a sentence end passes if it is this long and has one inside.
    long_line: int = 60
    # Page furniture is only looked for in lines up to this length.
    short_line: int = 80
    # The lines kept must hold at least this share of the document's characters.
    min_kept_percent: int = 50


def line_passes(line: Column, doc_symbols: Column, doc_shouts: Column, rules: LineRules) -> Column:
    """True for a line of prose; blank lines pass, they carry no text.

    The counts of the whole document say which rules can fail at all.
    """
    def judge(n: Column) -> Column:
        few_marks = (doc_symbols == 0) | (
            (F.regexp_count(line, F.lit("[|]")) < rules.navigation_marks)
            & (F.regexp_count(line, F.lit(SYMBOLS)) * rules.chars_per_symbol <= n))
        quiet = (doc_shouts == 0) | (
            F.regexp_count(line, F.lit("!")) * rules.chars_per_shout <= F.greatest(n, F.lit(rules.chars_per_shout)))
        punctuated = line.rlike(LINE_END) | ((n >= rules.long_line) & line.rlike(INNER_END))
        furniture = (n <= rules.short_line) & ascii_lower(line).rlike("|".join(BOILERPLATE))
        return ~line.rlike(HAS_WORD) | (few_marks & quiet & punctuated & ~furniture)
    return let(F.length(line), judge)


def spread(starts: Column) -> Column:
    """How many positions the windows of three with these starts cover; null starts count for nothing."""
    held = F.filter(starts, lambda i: i.isNotNull())
    return F.size(F.array_distinct(F.flatten(F.transform(held, lambda i: F.array(i, i + 1, i + 2)))))


def repeated_words(tokens: Column, few: int = 48) -> Column:
    """How many words lie in a window of three that occurs at least twice, the first one included.

    A handful of repeated windows is searched for directly; with more than ``few``, windows are sorted
    with their positions and compared with their neighbours. Both count the same.
    """
    def by_order(order: Column) -> Column:
        def twin(x: Column, j: Column) -> Column:
            same = F.coalesce(F.get(order, j - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(
                F.get(order, j + 1)["h"] == x["h"], F.lit(False))
            return F.when(same, x["i"])
        return spread(F.transform(order, twin))

    def covered(grams: Column) -> Column:
        def search(twice: Column) -> Column:
            placed = F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
            return F.when(
                F.size(twice) <= few,
                spread(F.transform(grams, lambda h, i: F.when(F.array_contains(twice, h), i))),
            ).otherwise(let(placed, by_order))

        def repeats(order: Column) -> Column:
            twice = F.filter(order, lambda h, i: F.coalesce(h == F.get(order, i + 1), F.lit(False)))
            return let(F.array_distinct(twice), search)

        return F.when(F.size(F.array_distinct(grams)) == F.size(grams), F.lit(0)).otherwise(
            let(F.sort_array(grams), repeats))

    grams = F.when(
        F.size(tokens) >= 3,
        F.slice(F.transform(
            tokens, lambda w, i: F.xxhash64(w, F.get(tokens, i + 1), F.get(tokens, i + 2))),
            F.lit(1), F.size(tokens) - 2),
    ).otherwise(F.array().cast("array<bigint>"))
    return let(grams, covered)


def measure(text: Column, rules: LineRules = LineRules()) -> Column:
    """A struct with all counts of a text, its cleaned form and the verdict."""
    def of_text(t: Column) -> Column:
        def of_words(w: Column) -> Column:
            return let(F.struct(
                F.size(w).cast("long").alias("n_words"),
                F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
                repeated_words(w).cast("long").alias("n_repeat_words"),
                F.regexp_count(t, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
                F.regexp_count(t, F.lit("!")).alias("n_shouts"),
                F.split(t, "\n").alias("lines")), of_counts)

        def of_counts(m: Column) -> Column:
            with_words = F.filter(m["lines"], lambda x: x.rlike(HAS_WORD))
            passed = F.filter(
                m["lines"], lambda x: line_passes(x, m["n_symbols"], m["n_shouts"], rules))
            return F.struct(
                m["n_words"].alias("n_words"),
                m["word_chars"].alias("word_chars"),
                m["n_symbols"].alias("n_symbols"),
                let(with_words, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")
                .alias("n_dup_lines"),
                m["n_repeat_words"].alias("n_repeat_words"),
                F.array_join(passed, "\n").alias("clean_text"),
                F.length(t).cast("long").alias("n_chars"))
        return let(words(t), of_words)
    return let(F.coalesce(text, F.lit("")), of_text)


def verdict(text: Column, rules: LineRules = LineRules()) -> Column:
    """The measures of a text with ``n_clean_chars``, ``base_failed`` and ``kept``."""
    def judge(m: Column) -> Column:
        failed = (m["n_words"] < rules.min_words) | (
            100 * m["n_repeat_words"] > rules.max_repeat_percent * m["n_words"])
        n_clean = F.length(m["clean_text"]).cast("long")
        enough = 100 * n_clean >= rules.min_kept_percent * m["n_chars"]
        fields = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "clean_text"]
        return F.struct(
            *[m[f].alias(f) for f in fields], n_clean.alias("n_clean_chars"),
            failed.alias("base_failed"), (~failed & enough).alias("kept"))
    return let(measure(text, rules), judge)


def judged(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """Each document as a struct ``doc`` beside a struct ``quality``: counts, cleaned text and verdict.

    Null text counts as empty. An empty text has no words and fails the base rule. Copies and repeated
    rows are judged alike, each row by itself; an empty table gives an empty table. The verdict: the base
    rule holds and the lines kept hold at least ``min_kept_percent`` of the characters.
    """
    # explode keeps the optimizer from computing the struct again for each use of a field.
    return docs.select(
        wrapped(docs).alias("doc"), F.explode(F.array(verdict(F.col("text"), rules))).alias("quality"))


def clean(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """The documents kept, their text without the lines that failed; same columns as ``docs``.

    ``n_chars``, where it is there, follows the new text.
    """
    replaced = {"text": F.col("quality.clean_text")}
    if "n_chars" in docs.columns:
        replaced["n_chars"] = F.length("quality.clean_text").cast(docs.schema["n_chars"].dataType)
    return judged(docs, rules).where("quality.kept").select(*[
        replaced.get(c, F.col("doc")[c]).alias(c) for c in docs.columns])


def quality_report(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """One row per document: the counts and the verdict."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
             "base_failed", "kept", "n_clean_chars"]
    return judged(docs.select("doc_id", "text"), rules).select(
        "doc.doc_id", *[F.col("quality")[c].alias(c) for c in names])
