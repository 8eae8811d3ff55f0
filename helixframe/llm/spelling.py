"""Spelling variants by dynamic programming over sorted word lists.

Two words are near if one insertion, deletion or replacement of a code point separates them. Such words of lengths m and
m or m + 1 share their first or their last half(m) = ceil((m - 1) / 2) code points, so Spark deals each word to the lists
of its beginnings and of its reversed endings, for m its own length and one less, and sorts the lists. In a list, each word
scans those behind it. Beside a word lie the rows of its edit matrix with the scanning word, three cells each (the band of one edit); the
next word keeps the rows of the prefix it shares with the one before (LCP), and when all cells of a row exceed one edit,
the whole range that shares this prefix is skipped. A pair that both lists hold counts in the list of beginnings.

A task holds one list at a time: the words, not the occurrences, with one half in common. Found pairs are not written
out: each list gives per word the number of near words and the best of them.

A form has at least twice the occurrences of its word, so chains are short; roots come from pointer jumping, in
logarithmically many rounds.

Null texts have no words; a null doc_id counts as an empty string in the hash. Texts may have any length. Repeated rows
count again. An empty table gives no rows. Other columns of the input are left out.
"""

from __future__ import annotations

import string
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from helixframe.llm.common import save

RUN = r"([A-Za-zÀ-ÿ]+)"
MIN_LENGTH, MIN_COUNT = 5, 3
SLIP = 97  # one run in so many loses a letter
DOMINANCE = 2
LAST = "\U0010ffff"


def slipped_words(docs: DataFrame) -> DataFrame:
    """Runs of letters of all texts, A-Z in lower case; those whose hash is a multiple of SLIP lose a letter."""
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(1))).alias("run"))
    low = F.translate("run", string.ascii_uppercase, string.ascii_lowercase)
    runs = runs.where(F.length("run") >= MIN_LENGTH).select("doc_id", low.alias("run"))
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = runs.withColumn("h", h).select(F.when(F.col("h") % SLIP == 0, cut).otherwise(F.col("run")).alias("word"))
    return words.where(F.length("word") >= MIN_LENGTH)


def vocabulary(words: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """Different words with their number of occurrences."""
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def half(m: int) -> int:
    """Code points that near words of lengths m and m or m + 1 share at one side at least."""
    return m // 2


def near_in_list(words: list[str], m: int, depth: int) -> Iterator[tuple[int, int]]:
    """Pairs of places of near words in a sorted list whose words share their first ``depth`` code points.

    Words are of length m or m + 1; two of length m + 1 are not compared.
    """
    shared = [depth] * len(words)
    for i in range(1, len(words)):
        a, b, k = words[i - 1], words[i], depth
        end = min(len(a), len(b))
        while k < end and a[k] == b[k]:
            k += 1
        shared[i] = k
    # Cells of row d of the matrix: d code points of the scanned word against d - 1, d and d + 1 of the scanning word.
    before, same, after = [1] * (m + 2), [0] * (m + 2), [1] * (m + 2)
    for i, word in enumerate(words):
        size, last = len(word), len(words)
        query = word + "\0\0\0"
        j = i + 1
        if j >= last:
            return
        known = shared[j]  # rows up to here are those of equal prefixes
        for d in range(depth, known + 1):
            before[d], same[d], after[d] = 1, 0, 1
        while j < last:
            other = words[j]
            d, end = min(shared[j], known), len(other)
            x, y, z = before[d], same[d], after[d]
            while d < end:
                c = other[d]
                x = min(x + (c != query[d - 1]), y + 1)
                y = min(y + (c != query[d]), x + 1, z + 1)
                z = min(z + (c != query[d + 1]), y + 1)
                d += 1
                if x > 1 and y > 1 and z > 1:
                    break
                before[d], same[d], after[d] = x, y, z
            else:
                known = d
                if (size == m or end == m) and (y if end == size else x if end > size else z) == 1:
                    yield i, j
                j += 1
                continue
            known = d - 1
            j += 1
            if j < last and shared[j] >= d:  # the range with this prefix is out of reach
                j = bisect_left(words, other[:d] + LAST, j)


def near_counts(words: DataFrame) -> DataFrame:
    """Per word and list: n_near, and the near word of largest n (ties: smallest) as best_n, best."""
    size = F.length("word")
    lists = words.select(
        "word", "n", F.explode(F.when(size > MIN_LENGTH, F.array(size, size - 1)).otherwise(F.array(size))).alias("m")
    ).select("word", "n", "m", F.explode(F.array(F.lit(False), F.lit(True))).alias("backward")).select(
        "n", "m", "backward", F.when(F.col("backward"), F.reverse("word")).otherwise(F.col("word")).alias("key"))
    lists = lists.withColumn("head", F.substring("key", F.lit(1), F.expr("m div 2").cast("int")))
    dealt = lists.repartition("backward", "m", "head").sortWithinPartitions("backward", "m", "head", "key")

    def judged(backward: bool, m: int, keys: list[str], counts: list[int]) -> list[tuple]:
        depth = half(m)
        near, best = [0] * len(keys), [None] * len(keys)
        for i, j in near_in_list(keys, m, depth):
            if backward and keys[i][::-1][:depth] == keys[j][::-1][:depth]:
                continue
            for a, b in ((i, j), (j, i)):
                near[a] += 1
                offer = (-counts[b], keys[b][::-1] if backward else keys[b])
                if best[a] is None or offer < best[a]:
                    best[a] = offer
        return [(k[::-1] if backward else k, x, -b[0], b[1]) for k, x, b in zip(keys, near, best, strict=True) if x]

    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, keys, counts, out = None, [], [], []
        for frame in frames:
            for backward, m, head, key, n in zip(*(frame[c].tolist() for c in ("backward", "m", "head", "key", "n")), strict=True):
                if (backward, m, head) != now:
                    if len(keys) > 1:
                        out += judged(now[0], now[1], keys, counts)
                    now, keys, counts = (backward, m, head), [], []
                keys.append(key)
                counts.append(n)
            if len(out) > 10_000:
                yield pd.DataFrame(out, columns=["word", "n_near", "best_n", "best"])
                out = []
        if len(keys) > 1:
            out += judged(now[0], now[1], keys, counts)
        yield pd.DataFrame(out, columns=["word", "n_near", "best_n", "best"])

    return dealt.mapInPandas(scan, "word string, n_near long, best_n long, best string")


def roots(forms: DataFrame) -> DataFrame:
    """word, root: the last form that is reached from each word with a form."""
    links = save(forms.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "forms")
    while not links.where("moved").isEmpty():
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        jumped = links.join(ahead, "root", "left")
        links = save(jumped.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "forms")
    return links.select("word", "root")


def variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the corpus."""
    words = save(vocabulary(slipped_words(docs)), "words")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    near = near_counts(words).groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
    strong = -F.col("b.n") >= DOMINANCE * F.col("n")
    forms = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(strong, F.col("b.word")).alias("form"), F.when(strong, -F.col("b.n")).alias("form_n"))
    forms = save(forms, "forms")
    return forms.join(roots(forms), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
