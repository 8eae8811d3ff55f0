"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

A source is a stream of words: its documents in the order of a keyed hash, repeated when the target exceeds its size. The
stream up to the target is cut into blocks of equal size. The blocks of all sources are the quotas that a binary tree
splits among the output shards: each node draws, without replacement, how many blocks of each source its left half gets,
so the shards add up to the quotas exactly and each is a random share. Within a source the blocks are permuted by drawn
keys (in each round a block and its mirror image at the round's key change places or not, by a hash of the pair) and
given out in that order, so shards draw disjoint blocks; a document goes with the block in which it starts. Rows of a
shard are shuffled by sorting on a second hash, ``order``.

Documents are taken whole, but for the one per source at which the target is reached: of it the first words are taken.
A null or empty text has size 0 and is never taken. A null source is a source of its own, last in order. Rows that
repeat an id or a text are separate documents; which of two equal rows comes first does not show. An empty table gives
an empty mix. Extra columns are kept by ``mix`` unless they carry the name of a column that it adds.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from helixframe.llm.common import bound, n_words

SEED = 20_240_501
WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST_COPIES = 2.0
SHARDS = 16
BLOCK_WORDS = 1024
# Rounds of the permutation of a source's blocks.
ROUNDS = 48
# Hash buckets get about this many documents each; a bucket is summed and ordered within one task.
BUCKET_DOCS = 128


def targets(sizes: list[tuple], weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST_COPIES) -> list[float]:
    """Target words of sources given in order as (name, size): weights repeat, an excess over ``most`` sizes is reshared."""
    total, goal = share * sum(n for _, n in sizes), [0.0] * len(sizes)
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    free = set(range(len(sizes)))
    while free:
        rest = total - sum(goal[i] for i in range(len(sizes)) if i not in free)
        unit = rest / sum(weight[i] for i in free)
        full = {i for i in free if weight[i] * unit > most * sizes[i][1]}
        for i in full or free:
            goal[i] = most * sizes[i][1] if full else weight[i] * unit
        free = free - full if full else set()
    return goal


def split_tree(quotas: list[int], shards: int, seed: int = SEED) -> np.ndarray:
    """Blocks of each source (column) for each shard (row)."""
    out = np.zeros((shards, len(quotas)), dtype=np.int64)

    def descend(have: np.ndarray, first: int, last: int) -> None:
        if last - first == 1:
            out[first] = have
            return
        middle = (first + last) // 2
        rng = np.random.default_rng([seed, first, last])
        # The left half gets its exact part of all blocks; the sources in it are drawn without replacement.
        n_left = int(have.sum()) * (middle - first) // (last - first)
        left = rng.multivariate_hypergeometric(have, n_left, method="marginals") if have.sum() else have
        descend(left, first, middle)
        descend(have - left, middle, last)

    descend(np.array(quotas, dtype=np.int64), 0, shards)
    return out


def _running(df: DataFrame, by: list[str], order: list[str], value: str) -> Column:
    """Sum of ``value`` in the rows before."""
    window = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(window), F.lit(0))


def plan(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, block_words: int = BLOCK_WORDS) -> DataFrame:
    """All rows of ``docs`` with size, source_size, target, taken and the place in the mix.

    ``place`` lists (copy, shard, words, order) for each copy taken. Only totals per source reach the driver.
    """
    added = ["size", "source_size", "target", "taken", "place"]
    kept = [c for c in docs.columns if c not in added]
    base = docs.select(*kept).withColumns({
        "_src": F.coalesce("source", F.lit("")), "_null": F.col("source").isNull().cast("int"),
        "size": n_words(F.col("text")), "_order": F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text")),
    })
    key = ["_null", "_src"]
    totals = base.groupBy(*key).agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n")).collect()  # one row per source
    # Spark and Python order strings by code point alike.
    totals.sort(key=lambda r: (r["_null"], r["_src"]))
    sizes = [(r["_src"], r["source_size"]) for r in totals]
    goal = targets(sizes)
    words = [round(g) for g in goal]
    block = max(block_words, -(-sum(words) // 500_000_000))  # the draw is exact below a thousand million blocks
    shares = split_tree([-(-w // block) for w in words], shards, seed)
    rows = []
    for i, r in enumerate(totals):
        ends = np.cumsum(shares[:, i])
        blocks = max(1, int(ends[-1]))
        keys = np.random.default_rng([seed, shards, i]).integers(0, 2**62, ROUNDS)
        rows.append((r["_null"], r["_src"], int(r["source_size"]), float(goal[i]), int(words[i]), blocks, [int(x) for x in keys], [int(x) for x in ends]))
    spark = docs.sparkSession
    per_source = spark.createDataFrame(
        rows, "_null int, _src string, source_size long, target double, _words long, _blocks long, _keys array<long>, _ends array<long>")

    bits = max(0, int(np.ceil(np.log2(max(1, sum(r["n"] for r in totals)) / BUCKET_DOCS))))
    bucket = F.shiftrightunsigned("_order", 64 - bits) if bits else F.lit(0).cast("long")
    base = base.withColumn("_bucket", bucket)
    # Offsets in the stream: sums per bucket, then per thousand buckets, so no window holds more than a share of a source.
    by_bucket = base.groupBy(*key, "_bucket").agg(F.sum("size").alias("_sum")).withColumn("_upper", F.shiftright("_bucket", 10))
    by_upper = by_bucket.groupBy(*key, "_upper").agg(F.sum("_sum").alias("_upper_sum"))
    by_upper = by_upper.select(*key, "_upper", _running(by_upper, key, ["_upper"], "_upper_sum").alias("_before_upper"))
    starts = by_bucket.withColumn("_before", _running(by_bucket, [*key, "_upper"], ["_bucket"], "_sum")).join(by_upper, [*key, "_upper"])
    starts = starts.select(*key, "_bucket", (F.col("_before") + F.col("_before_upper")).alias("_before"))
    inside = _running(base, [*key, "_bucket"], ["_order", "doc_id", "size"], "size")
    placed = base.withColumn("_inside", inside).join(starts, [*key, "_bucket"]).join(F.broadcast(per_source), key)  # one row per source
    at = F.col("_before") + F.col("_inside")

    def permuted(number: Column) -> Column:
        """Place of a block among the blocks of its source: one to one, for any number of blocks."""
        mirror = lambda x, key: F.pmod(key - x, F.col("_blocks"))
        return F.aggregate("_keys", number, lambda x, key: F.when(
            F.xxhash64(key, F.greatest(x, mirror(x, key))).bitwiseAND(F.lit(1)) == 1, mirror(x, key)).otherwise(x))

    def copy(n: Column) -> Column:
        start = at + n * F.col("source_size")
        words = F.greatest(F.lit(0), F.least(F.col("size"), F.col("_words") - start)).cast("long")
        shard = bound(permuted(F.floor(start / block).cast("long")), lambda p: F.size(F.filter("_ends", lambda e: e <= p)))
        return F.struct(n.cast("int").alias("copy"), shard.cast("int").alias("shard"), words.alias("words"), F.xxhash64(F.lit(seed + 1), "_order", n).alias("order"))

    copies = F.array(*[copy(F.lit(i)) for i in range(int(np.ceil(MOST_COPIES)))])
    taken = F.filter(copies, lambda c: c["words"] > 0)
    return placed.withColumn("place", taken).withColumn(
        "taken", F.aggregate("place", F.lit(0).cast("long"), lambda a, c: a + c["words"]),
    ).select(*kept, *added)


def mix(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """One row per copy taken, with ``copy``, ``shard``, ``words`` and ``order``; of a document cut at the target, its first words."""
    planned = plan(docs, shards, seed)
    kept = [c for c in docs.columns if c not in ("size", "source_size", "target", "taken", "place", "copy", "shard", "words", "order")]
    rows = planned.select(*kept, "size", F.explode("place").alias("_p"))
    head = F.regexp_extract("text", r"^[\x20\x09-\x0D]*", 0)
    pieces = F.slice(F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+[\x20\x09-\x0D]*)")), F.lit(1), F.col("_p.words").cast("int"))
    cut = F.rtrim(F.concat(head, F.array_join(pieces, "")))
    text = F.when(F.col("_p.words") < F.col("size"), cut).otherwise(F.col("text"))
    return rows.select(*[text.alias(c) if c == "text" else F.col(c) for c in kept], "size", "_p.copy", "_p.shard", "_p.words", "_p.order")


def shuffled(mixed: DataFrame) -> DataFrame:
    """Rows of ``mix`` together by shard, in the order that a hash gives; a shard is spread over many tasks."""
    spread = int(mixed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return mixed.repartition("shard", F.pmod("order", F.lit(spread))).sortWithinPartitions("shard", "order")


def write_shards(mixed: DataFrame, path: str) -> None:
    """Write a folder per shard, its rows shuffled."""
    shuffled(mixed).write.partitionBy("shard").parquet(path)
