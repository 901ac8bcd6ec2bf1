"""Quality rules by line-first cleaning, with built-in functions only.

Lines are judged first: each one against rules of punctuation, navigation and boilerplate. Lines that fail are
removed, and a document is rejected when its removed lines held too large a part of its characters. Statistics of
the whole text (length, repeated words) reject a document before that. Everything is a function of one row, so the
plan is one scan without a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.session import tune

BLANK_RUN = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"
#: Marks that crowd a line of shouting or of broken markup.
MARKS = r"[#*$%&|<>!~^=_{}\\]"
SEPARATORS = "[|>»›•·]"
#: Marks a sentence ends with, closing quotes and brackets included.
SENTENCE_END = ".!?…:;\"'”’»)]。！？：；」』）।؟۔"
#: Phrases of licences, notices and page furniture, in lower case.
BOILERPLATE = [
    "all rights reserved",
    "licensed under",
    "licenced under",
    "released under the",
    "general public license",
    "copyright (c)",
    "copyright ©",
    "terms of use",
    "terms of service",
    "privacy policy",
    "cookie policy",
    "cookie settings",
    "use cookies",
    "uses cookies",
    "accept cookies",
    "use of cookies",
    "enable javascript",
    "javascript is disabled",
    "javascript is required",
    "lorem ipsum",
    "click here",
    "subscribe to our",
    "share this page",
    "share this article",
    "skip to content",
    "skip to main content",
    "back to top",
]

LEAST_WORDS = 50
MOST_REPEATED = 50
MOST_LOST = 30


def judged_lines(text: Column) -> Column:
    """Each line with its characters outside blanks (``chars``) and whether it fails a rule.

    ``punctuation``: no mark of a sentence's end, or more than one crowding mark in ten characters.
    ``navigation``: two separators or more, at least one in 25 characters. ``boilerplate``: holds one of the phrases.
    A line without a word fails nothing.
    """
    read = F.transform(
        F.split(text, "\n", -1),
        lambda line: F.struct(
            line.alias("line"), F.regexp_replace(line, BLANK_RUN, "").alias("body"), F.lower(line).alias("lower")
        ),
    )
    measured = F.transform(
        read,
        lambda m: F.struct(
            m["line"].alias("line"),
            F.length(m["body"]).alias("chars"),
            (F.instr(F.lit(SENTENCE_END), F.right(m["body"], F.lit(1))) > 0).alias("ended"),
            F.regexp_count(m["line"], F.lit(MARKS)).alias("marks"),
            F.regexp_count(m["line"], F.lit(SEPARATORS)).alias("separators"),
            reduce(or_, [F.contains(m["lower"], F.lit(phrase)) for phrase in BOILERPLATE]).alias("boilerplate"),
        ),
    )
    return F.transform(
        measured,
        lambda m: F.struct(
            m["line"].alias("line"),
            m["chars"].alias("chars"),
            ((m["chars"] > 0) & (~m["ended"] | ((m["marks"] > 1) & (m["marks"] * 10 > m["chars"])))).alias("punctuation"),
            ((m["separators"] > 1) & (m["separators"] * 25 >= m["chars"])).alias("navigation"),
            m["boilerplate"].alias("boilerplate"),
        ),
    )


def failed(line: Column) -> Column:
    return line["punctuation"] | line["navigation"] | line["boilerplate"]


def beside(values: Column, value: Column, at: Column, key: Callable[[Column], Column]) -> Column:
    """Whether a neighbour in an array has the same key."""
    return key(value).eqNullSafe(key(F.get(values, at - 1))) | key(value).eqNullSafe(key(F.get(values, at + 1)))


def hashed_windows(words: Column) -> Column:
    """All windows of three words, sorted: 32 bits of hash above the 32 bits of the place."""
    places = F.when(F.size(words) > 2, F.sequence(F.lit(0), F.size(words) - 3)).otherwise(F.array().cast("array<int>"))
    code = lambda k: F.hash(F.get(words, k), F.get(words, k + 1), F.get(words, k + 2))
    return F.sort_array(F.transform(places, lambda k: F.shiftleft(code(k).cast("long"), 32) + k))


def likely_windows(words: Column, hashed: Column) -> Column:
    """``(gram, place)`` of the windows whose hash occurs again, sorted: all repeated ones are among them."""
    again = F.filter(hashed, lambda x, k: beside(hashed, x, k, lambda v: F.shiftright(v, 32)))
    place = lambda x: x.bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")
    gram = lambda k: F.concat_ws(" ", F.get(words, k), F.get(words, k + 1), F.get(words, k + 2))
    return F.sort_array(F.transform(again, lambda x: F.struct(gram(place(x)).alias("gram"), place(x).alias("place"))))


def repeated_words(windows: Column) -> Column:
    """Words inside windows that occur twice or more, from sorted ``(gram, place)``: equal windows are neighbours."""
    repeated = F.transform(
        F.filter(windows, lambda w, k: beside(windows, w, k, lambda v: v["gram"])), lambda w: w["place"]
    )
    start = F.struct(F.lit(0).alias("words"), F.lit(-3).alias("last"))
    return F.aggregate(
        F.sort_array(repeated),
        start,
        lambda seen, place: F.struct(
            (seen["words"] + F.least(F.lit(3), place - seen["last"])).alias("words"), place.alias("last")
        ),
        lambda seen: seen["words"],
    )


def clean_lines(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    least_words: int = LEAST_WORDS,
    most_repeated: int = MOST_REPEATED,
    most_lost: int = MOST_LOST,
) -> DataFrame:
    """One row per input row with its statistics, the text of the lines that stay, and the verdict.

    ``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` count over the whole text;
    ``n_lines, n_punctuation, n_navigation, n_boilerplate`` count lines and the lines failing each rule;
    ``lost_chars`` are the characters outside blanks in removed lines, ``cleaned`` is the rest of the lines in
    order. ``base_failed``: fewer than ``least_words`` words, or more than ``most_repeated`` percent of the words in
    repeated windows. ``kept``: not ``base_failed``, and at most ``most_lost`` percent of the characters lost.

    Null counts as the empty text, which has one line, no word and fails for its length. A very long text is one
    row and is judged whole; its windows are sorted in the memory of one task. Rows are independent: repeated rows,
    equal ids and null ids pass through, an empty table gives no rows, other columns are ignored.
    """
    tune(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    split = rows.select(
        "doc_id", "text", F.array_remove(F.split("text", BLANK_RUN), "").alias("words"), judged_lines(F.col("text")).alias("lines")
    )
    hashed = split.withColumn("hashed", hashed_windows(F.col("words")))
    counted = hashed.withColumn("windows", likely_windows(F.col("words"), F.col("hashed")))
    with_word = F.filter("lines", lambda line: line["chars"] > 0)
    lines_failing = lambda rule: F.size(F.filter("lines", lambda line: line[rule])).cast("long")
    chars = lambda lines: F.aggregate(lines, F.lit(0).cast("long"), lambda total, line: total + line["chars"])
    found = counted.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        chars(F.col("lines")).alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size(with_word) - F.size(F.array_distinct(F.transform(with_word, lambda line: line["line"])))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("windows")).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        *(lines_failing(rule).alias(f"n_{rule}") for rule in ("punctuation", "navigation", "boilerplate")),
        chars(F.filter("lines", failed)).alias("lost_chars"),
        F.array_join(F.transform(F.filter("lines", lambda line: ~failed(line)), lambda line: line["line"]), "\n").alias("cleaned"),
    )
    base_failed = (F.col("n_words") < least_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * most_repeated)
    return found.withColumn("base_failed", base_failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("lost_chars") * 100 <= F.col("word_chars") * most_lost)
    )
