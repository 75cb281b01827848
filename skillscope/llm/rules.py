"""Line-first quality rules, in DataFrame functions only.

Each line is judged first: punctuation (no closing mark at its end), navigation (menu separators or
a short line of link words) and boilerplate (standard notices). Lines that fail are removed, and a
document that loses too large a share of its word characters is rejected. The base counts below are
taken from the untouched text and reject on their own.

Defined results: a null or empty text has no words, loses nothing, and fails the base rule on its
length. Repeated rows give repeated results; a null ``doc_id`` is carried through. Only ``doc_id``
and ``text`` are read, so further columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skillscope.llm.words import SPACE_RUN, SPACES, word_array

SYMBOLS = r"[#*$%&|<>]"  # fixed value: the characters that count as symbols
CLOSING = ".!?:;\"')]}…”’»"
MENU_MARKS = "[|»›•·>]"
# Whole-line link words and notices that pages repeat.
MENU_WORDS = (
    "home", "menu", "login", "log in", "sign in", "sign up", "register", "search", "next", "previous",
    "back", "contact", "about", "about us", "sitemap", "share", "top", "more", "read more",
)
NOTICES = (
    "all rights reserved", "cookie", "privacy policy", "terms of use", "terms of service",
    "enable javascript", "lorem ipsum", "subscribe to our", "click here", "copyright ©",
    "released under", "licensed under",
)
WINDOW = 8


def _combine(hashes: Column, step: int) -> Column:
    """Hash of positions i and i+step for every i; the tail is cut by the caller."""
    return F.zip_with(hashes, F.slice(hashes, step + 1, F.greatest(F.size(hashes), F.lit(1))),
                      lambda a, b: F.xxhash64(a, b))


def line_fails(line: Column, folded: Column, marked: Column, noticed: Column, max_menu_marks: int = 3,
               min_words: int = 3) -> Column:
    """Whether a trimmed line is to be removed.

    ``folded`` is the line in lower case; ``marked`` and ``noticed`` say whether the document holds a
    menu mark or a notice at all, so that most lines need not be searched.
    """
    short = F.size(F.split(line, SPACE_RUN)) < min_words
    unclosed = ~F.contains(F.lit(CLOSING), F.right(line, F.lit(1))) & short
    menu = marked & (F.size(F.split(line, MENU_MARKS)) > max_menu_marks)
    notice = noticed & (F.length(line) < 200) & F.rlike(folded, F.lit("|".join(NOTICES)))
    return (line != "") & (unclosed | menu | folded.isin(*MENU_WORDS) | notice)


def quality_rules(docs: DataFrame, max_loss: float = 0.5, min_words: int = 20,
                  max_repeat_percent: int = 30) -> DataFrame:
    """One row per document: base counts, the cleaned text, and whether it is kept."""
    text = F.col("__text")
    df = docs.select(F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("__text"))
    df = df.withColumn("__folded", F.lower(text))
    noticed = F.lit(False)
    for phrase in NOTICES:
        noticed = noticed | F.contains("__folded", F.lit(phrase))
    df = df.withColumns({
        "__words": word_array(text), "__raw": F.split(text, "\n"), "__noticed": noticed,
        "__low": F.split("__folded", "\n"),
        "__marked": F.rlike(text, F.lit(MENU_MARKS)),
        "n_symbols": (F.size(F.split(text, SYMBOLS)) - 1).cast("long"),
    })
    df = df.withColumns({
        "__lines": F.filter("__raw", lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]"))),
        "__bad": F.zip_with("__raw", "__low", lambda raw, low: line_fails(
            F.btrim(raw, F.lit(SPACES)), F.btrim(low, F.lit(SPACES)), F.col("__marked"), F.col("__noticed"))),
    })
    df = df.withColumns({
        "n_words": F.size("__words").cast("long"),
        "word_chars": F.length(F.array_join("__words", "")).cast("long"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "__1": F.transform("__words", lambda w: F.xxhash64(w)),
        "n_lines_removed": F.size(F.filter("__bad", lambda x: x)).cast("long"),
    })
    removed = F.filter("__raw", lambda x, i: F.get(F.col("__bad"), i))
    kept = F.filter("__raw", lambda x, i: ~F.get(F.col("__bad"), i))
    some = F.col("n_lines_removed") > 0
    df = df.withColumns({
        "cleaned": F.when(some, F.array_join(kept, "\n")).otherwise(text),
        "__lost": F.when(some, F.length(F.array_join(word_array(F.array_join(removed, "\n")), ""))).otherwise(0),
    })
    df = df.withColumn("__2", _combine(F.col("__1"), 1)).withColumn("__4", _combine(F.col("__2"), 2))
    df = df.withColumn("__8", F.when(F.col("n_words") >= WINDOW, F.slice(
        _combine(F.col("__4"), 4), F.lit(1), F.greatest(F.col("n_words") - (WINDOW - 1), F.lit(1)).cast("int"))))
    repeats = F.size(F.array_distinct("__8")) < F.size("__8")
    df = df.withColumn("__sorted", F.when(repeats, F.array_sort(
        F.transform("__8", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    df = df.withColumn("__found", F.when(F.col("__sorted").isNotNull(), F.filter(
        "__sorted", lambda p, k: (p["h"] == F.get(F.col("__sorted"), k - 1)["h"]).eqNullSafe(True)
        | (p["h"] == F.get(F.col("__sorted"), k + 1)["h"]).eqNullSafe(True))))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last"))
    covered = F.aggregate(
        F.array_sort(F.transform("__found", lambda p: p["i"])), start,
        lambda acc, i: F.struct((acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n"), i.alias("last")),
        lambda acc: acc["n"])
    df = df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
    df = df.withColumns({
        "base_failed": (F.col("n_words") < min_words)
        | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words")),
        "lost_share": F.when(F.col("word_chars") > 0, F.col("__lost") / F.col("word_chars")).otherwise(F.lit(0.0)),
    })
    return df.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.col("lost_share") <= max_loss)).alias("kept"),
        "n_lines_removed", "lost_share", "cleaned",
    )
