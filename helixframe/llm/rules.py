"""Quality rules with cross-document line frequency, in SQL functions only.

Base rules look at one text. Words are runs of anything but space, tab, line feed, vertical tab, form feed and carriage
return. A document fails them with fewer than 50 words, or when more than half of its words lie in 3-word windows that
the text holds twice or more.

The method looks across documents: lines are normalised (lower case, single spaces) and hashed, and the distinct
documents that hold a line are counted per host (``source``). Documents with the same text count once, so copies of a
page do not make its content boilerplate. A line held by more than ``max_docs`` documents of its host is removed, and a
document that keeps fewer than ``min_words`` words, or less than ``min_share`` of its words, is depleted and rejected.

A null text has no words, fails, and is returned; a null source is a host of its own; rows that repeat are judged one by
one; ids play no part in the verdict and may be null or repeat. Other columns are ignored. Lines and windows are
compared by 64-bit hashes within a host or a text, and documents by 64-bit hashes of the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from helixframe.llm.boilerplate import normal
from helixframe.llm.common import WORD, bound

WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_DOCS = 20
MIN_SHARE = 0.2


def repeat_words(words: Column) -> Column:
    """Words covered by 3-word windows that occur at least twice."""

    def covered(w: Column) -> Column:
        windows = F.when(
            F.size(w) >= 4,
            F.array_sort(F.transform(F.sequence(F.lit(1), F.size(w) - 2), lambda i: F.struct(
                F.xxhash64(F.get(w, i - 1), F.get(w, i), F.get(w, i + 1)).alias("h"), i.alias("i")))),
        ).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))

        def twice(s: Column) -> Column:
            again = F.filter(s, lambda x, i: (
                F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))))
            return F.array_sort(F.transform(again, lambda x: x["i"]))

        start = F.struct(F.lit(-9).alias("last"), F.lit(0).cast("long").alias("n"))
        return F.aggregate(bound(windows, twice), start, lambda a, p: F.struct(
            p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n")))["n"]

    return bound(words, covered)


def measures(text: Column) -> dict[str, Column]:
    """The base measures of a text; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    with_word = F.filter(F.split(text, "\n"), lambda x: F.translate(x, WHITE, "") != "")
    return {
        "word_chars": F.length(F.translate(text, WHITE, "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": bound(with_word, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
    }


def judge(docs: DataFrame, max_docs: int = MAX_DOCS, min_words: int = MIN_WORDS, min_share: float = MIN_SHARE) -> DataFrame:
    """Measures, ``base_failed`` and ``kept`` for every row, with the words that line removal left (``left_words``)."""
    text = F.coalesce("text", F.lit(""))
    host = F.coalesce(F.concat(F.lit("="), "source"), F.lit("none"))

    def line(x: Column) -> Column:
        n = F.size(F.regexp_extract_all(x, F.lit(f"({WORD})")))
        return F.struct(F.xxhash64(normal(x)).alias("h"), n.alias("n"))

    lines = F.filter(F.transform(F.split(text, "\n"), line), lambda x: x["n"] > 0)
    named = docs.select("doc_id", text.alias("text"), host.alias("host"))
    # Distinct documents per line and host: first one row per line and text, so a line in a third of all documents is
    # counted in many tasks.
    over = (
        named.select("host", F.xxhash64("text").alias("copy"), F.explode(F.array_distinct(F.transform(lines, lambda x: x["h"]))).alias("h"))
        .groupBy("host", "h").agg(F.count_distinct("copy").alias("n_docs")).where(F.col("n_docs") > max_docs).select("host", "h")
    )
    words = F.regexp_extract_all("text", F.lit(f"({WORD})"))
    measured = named.withColumns({
        "row": F.monotonically_increasing_id(), "n_words": F.size(words).cast("long"), **measures(F.col("text")),
        "n_repeat_words": repeat_words(words).cast("long"), "lines": lines,
    }).drop("text")
    base = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    each = measured.select(*base, "row", "host", F.explode_outer("lines").alias("line")).select(
        *base, "row", "host", F.col("line.h").alias("h"), F.col("line.n").alias("n"))
    # Only rows of one document meet here; null lines of empty documents join nothing.
    marked = each.join(over.withColumn("removed", F.lit(True)), ["host", "h"], "left")
    left = marked.groupBy("row").agg(
        *[F.first(c).alias(c) for c in base],
        F.coalesce(F.sum(F.when(F.col("removed").isNull(), F.col("n"))), F.lit(0)).alias("left_words"))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    depleted = (F.col("left_words") < min_words) | (F.col("left_words") < min_share * F.col("n_words"))
    return left.select(*base, failed.alias("base_failed"), (~failed & ~depleted).alias("kept"), "left_words")
