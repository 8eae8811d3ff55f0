"""Near-duplicate documents by BagMinHash signatures, banding and exact multiset overlap.

A document is the multiset of its five-word shingles; fewer than five words make one shingle of all words. Two texts
are linked when their weighted Jaccard similarity, sum of minima over sum of maxima, is at least ``threshold``; classes
are the connected components of the links.

Signatures. Weights are discretised into levels, grouped into intervals (0,1], (1,2], (2,4], (4,8], ... Each shingle has
one Poisson process per interval that its weight reaches, with a rate equal to the interval's length; a point carries a
level within its interval, counts if the weight reaches that level, and falls on a random register. A register keeps its
first point. Processes are only followed while they can still lower a register. Two registers agree with probability
equal to the weighted Jaccard similarity, whatever the weights.

Candidates. Texts that agree in one of ``BANDS`` bands share a bucket. Every text is first verified against the most
central text of each of its buckets (the one that meets most others), which joins most of a large group. Buckets whose
texts are still in different classes are then compared in full, block by block, on two sketches: the signature (pairs
within 4.5 standard errors of the threshold stay) and the parity of the hashed shingles in 2,048 bits, whose Hamming
distance never exceeds the size of the multisets' difference. Pairs of different classes that pass both are verified.
No bucket is capped, no group sits in one task, and pairs within a class are not listed. A pair of similarity 0.8 shares
no bucket in 3 of a million cases.

Words are runs of anything but ASCII white space. Null texts and texts without words are alone in their class. Rows with
equal texts are one class and compared once. The class is named by its smallest doc_id (null if none has an id). Rows
may repeat; other columns are ignored by ``classes`` and kept by ``one_of_each``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from helixframe.llm.common import WORD, save
from helixframe.llm.graph import components

THRESHOLD = 0.8
SHINGLE = 5
REGISTERS = 160  # BANDS * BAND_ROWS
BAND_ROWS = 5
BANDS = 32
ESTIMATE = THRESHOLD - 4.5 * (THRESHOLD * (1 - THRESHOLD) / REGISTERS) ** 0.5
BLOCK = 256
PARITY_BITS = 2048
CHUNK_ROWS = 20_000
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
LOW = np.uint64(0xFFFFFFFF)
LOG_RANGE = 32 * np.log(2.0)


def _mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Shingles:
    """Hashed shingles of texts; remembers the hashes of recent words."""

    def __init__(self) -> None:
        self.memo: dict[bytes, int] = {}

    def of(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Distinct shingle hashes, in order, and their weights."""
        words = (text or "").encode().split()
        if len(self.memo) > 500_000:
            self.memo.clear()
        memo = self.memo
        for w in set(words).difference(memo):
            memo[w] = xxhash.xxh64_intdigest(w)
        h = np.fromiter(map(memo.__getitem__, words), dtype=np.uint64, count=len(words))
        if not len(h):
            return h, np.zeros(0, dtype=np.int64)
        size = min(SHINGLE, len(h))
        with np.errstate(over="ignore"):
            out = np.full(len(h) - size + 1, size, dtype=np.uint64)
            for i in range(size):
                out = _mix(out * GOLDEN + h[i : len(h) - size + 1 + i])
        return np.unique(out, return_counts=True)


def signature(shingles: np.ndarray, weights: np.ndarray, m: int = REGISTERS) -> np.ndarray:
    """BagMinHash: one 64-bit mark per register."""
    first, mark = np.full(m, np.inf), np.zeros(m, dtype=np.uint64)
    top = int(weights.max())
    seeds, lows, reach, rates = [], [], [], []
    low, length = 0, 1
    while low < top:  # products wrap around
        own = weights > low
        seeds.append(_mix(shingles[own] + np.multiply(np.array([len(seeds) + 1], dtype=np.uint64), GOLDEN)))
        lows.append(low)
        rates.append(length)
        reach.append(weights[own])
        low, length = low + length, low + length
    held = [(seed, weight, np.zeros(len(seed)), 0) for seed, weight in zip(seeds, reach, strict=True)]
    # Points per process that fill most registers; what is still needed follows in later rounds.
    horizon = m / float(weights.sum()) * (np.log(m) + 1)
    limit = np.inf
    while any(len(seed) for seed, *_ in held):
        after = []
        for (seed, weight, at, drawn), low, rate in zip(held, lows, rates, strict=True):
            if not len(seed):
                after.append((seed, weight, at, drawn))
                continue
            # Processes of one rate take the same steps, so where a point falls does not depend on the rest of the text.
            steps = min(4096, max(1, int(np.ceil(rate * horizon))))
            r = _mix(seed[:, None] + np.arange(drawn + 1, drawn + steps + 1, dtype=np.uint64) * GOLDEN)
            x = np.log((r >> np.uint64(32)).astype(np.float64) + 0.5)
            x -= LOG_RANGE
            x *= -1.0 / rate
            x[:, 0] += at
            np.cumsum(x, axis=1, out=x)
            last = x[:, -1].copy()
            useful = x < limit
            if rate > 1:
                # The level comes from bits that decide nothing else.
                level = low + 1 + ((_mix(r ^ np.uint64(0xA5A5A5A5A5A5A5A5)) >> np.uint64(20)) % np.uint64(rate)).astype(np.int64)
                useful &= level <= weight[:, None]
            mine, marks = x[useful], r[useful]
            # The register comes from the low half of the mark, where the point lies from the high half.
            register = (((marks & LOW) * np.uint64(m)) >> np.uint64(32)).view(np.int64)
            np.minimum.at(first, register, mine)
            won = first[register] == mine
            mark[register[won]] = marks[won]
            after.append((seed, weight, last, drawn + steps))
        limit = first.max()
        held = [(seed[at < limit], weight[at < limit], at[at < limit], drawn) for seed, weight, at, drawn in after]
        horizon = max(horizon / 2, 0.5)
    return mark


def similarity(a: tuple, b: tuple) -> float:
    """Weighted Jaccard similarity of two multisets of hashes."""
    common, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    low = int(np.minimum(a[1][i], b[1][j]).sum())
    total = int(a[1].sum() + b[1].sum()) - low
    return low / total if total else 0.0


def parity(shingles: np.ndarray, weights: np.ndarray) -> bytes:
    """Bits that are one where an odd number of the multiset's elements falls."""
    nth = np.arange(int(weights.sum())) - np.repeat(np.cumsum(weights) - weights, weights)
    element = _mix(np.repeat(shingles, weights) + (nth.astype(np.uint64) + np.uint64(1)) * GOLDEN)
    counts = np.bincount((element % np.uint64(PARITY_BITS)).astype(np.int64), minlength=PARITY_BITS)
    return np.packbits(counts & 1).tobytes()


def text_key(text: Column) -> Column:
    """16 bytes that stand for a text; null for a text without words."""
    return F.when(text.rlike(WORD), F.unhex(F.md5(text)))


SIGNED = "d binary, doc_id long, marks binary, bands binary, parity binary, n int"


def signatures(texts: DataFrame) -> DataFrame:
    """Sketches of (d, doc_id, text): a byte per register, four bytes per band, parity bits, number of shingles."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles()
        names = [c.split()[0] for c in SIGNED.split(", ")]
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                held = [shingles.of(t) for t in part.column("text").to_pylist()]
                marks = np.array([signature(*x) for x in held]).reshape(-1, REGISTERS)
                bands = np.full((len(marks), BANDS), 7, dtype=np.uint64)
                for i in range(BAND_ROWS):
                    bands = _mix(bands * GOLDEN + marks[:, i : BANDS * BAND_ROWS : BAND_ROWS])
                yield pa.RecordBatch.from_arrays([
                    part.column("d"), part.column("doc_id").cast(pa.int64()),
                    pa.array([x.tobytes() for x in (marks & np.uint64(255)).astype(np.uint8)], pa.binary()),
                    pa.array([x.tobytes() for x in (bands >> np.uint64(32)).astype(np.uint32)], pa.binary()),
                    pa.array([parity(*x) for x in held], pa.binary()),
                    pa.array([int(w.sum()) for _, w in held], pa.int32()),
                ], names)

    return texts.mapInArrow(rows, SIGNED)


def verified(pairs: DataFrame, texts: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Pairs (a, b) whose texts (d, text) are similar enough, by exact multiset overlap."""
    both = pairs.join(texts.select(F.col("d").alias("a"), F.col("text").alias("ta")), "a").join(
        texts.select(F.col("d").alias("b"), F.col("text").alias("tb")), "b")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, last, known = Shingles(), None, None
        for batch in batches:
            keep = []
            for ta, tb in zip(batch.column("ta"), batch.column("tb"), strict=True):
                ta, tb = ta.as_py(), tb.as_py()
                if tb != last:  # rows arrive sorted by b
                    last, known = tb, shingles.of(tb)
                keep.append(similarity(shingles.of(ta), known) >= threshold)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "ta", "tb").mapInArrow(rows, "a binary, b binary")


def _central_pairs(members: DataFrame) -> DataFrame:
    """Each text with the most central text of each of its buckets."""
    weight = members.groupBy("d").agg(F.sum("size").alias("met"))
    leaders = members.join(weight, "d").groupBy("key").agg(F.max(F.struct("met", "d")).alias("m")).select("key", F.col("m.d").alias("b"))
    return members.join(leaders, "key").where("d != b").select(F.col("d").alias("a"), "b").distinct()


def _block_pairs(members: DataFrame, texts: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs of different classes that share a bucket and whose signatures may be similar enough."""
    named = members.where("size > 2").join(labels.withColumnRenamed("node", "d"), "d", "left").withColumn("label", F.coalesce("label", "d"))
    mixed = named.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low != high").select("key")
    active = named.join(mixed, "key", "left_semi").join(texts.select("d", "marks", "bands", "parity", "n"), "d")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.hash("d"), F.col("blocks"))
    # A text goes to every pair of blocks that holds its own; a small bucket is one pair of a block with itself.
    dealt = active.withColumn("blocks", blocks).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("key", "band", "d", "label", "marks", "bands", "parity", "n", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    dealt = save(dealt, "blocks")
    chunks = max(1, -(-dealt.count() // CHUNK_ROWS))

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        found = []
        for (_, i, j), g in frame.groupby(["key", "i", "j"], sort=False):
            labels, count = np.unique(g["label"].to_numpy(), return_inverse=True)[1], len(g)
            marks = np.frombuffer(b"".join(g["marks"]), dtype=np.uint8).reshape(count, REGISTERS)
            bits = np.frombuffer(b"".join(g["parity"]), dtype=np.uint64).reshape(count, -1)
            bands = np.frombuffer(b"".join(g["bands"]), dtype=np.uint32).reshape(count, BANDS)
            band, d, own, n = int(g["band"].iloc[0]), g["d"].to_numpy(), g["own"].to_numpy(), g["n"].to_numpy()
            for x in range(count - 1):
                ys = np.arange(x + 1, count)
                ys = ys[labels[ys] != labels[x]]
                if i != j:
                    ys = ys[own[ys] != own[x]]
                ys = ys[(marks[ys] == marks[x]).mean(axis=1) >= ESTIMATE]
                apart = np.bitwise_count(bits[ys] ^ bits[x]).sum(axis=1)
                ys = ys[apart <= (n[ys] + n[x]) * ((1 - THRESHOLD) / (1 + THRESHOLD)) + 1e-9]
                # A pair is listed in its first common bucket only.
                for y in ys[(bands[ys, :band] != bands[x, :band]).all(axis=1)]:
                    found.append((min(d[x], d[y]), max(d[x], d[y])))
        return pd.DataFrame(found, columns=["a", "b"])

    share = F.pmod(F.xxhash64("key", "i", "j"), F.lit(chunks))
    return dealt.withColumn("chunk", share).groupBy("chunk").applyInPandas(compare, "a binary, b binary").distinct()


def labelled(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(d, first_id): for each text with words, the smallest doc_id of its class."""
    keyed = docs.select(text_key(F.col("text")).alias("d"), "doc_id", "text").where(F.col("d").isNotNull())
    signed = signatures(keyed).groupBy("d").agg(
        F.min("doc_id").alias("first_id"), *[F.first(c).alias(c) for c in ("marks", "bands", "parity", "n")])
    sketches = save(signed, "signatures")
    each = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.substring("bands", i * 4 + 1, F.lit(4)))
    rows = sketches.select("d", F.posexplode(each).alias("band", "value")).select("d", "band", F.xxhash64("band", "value").alias("key"))
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = save(rows.join(sizes, "key"), "buckets")
    # Texts that share a bucket, once each; the set grows with the input, so it is never broadcast.
    shared = members.select("d").distinct().hint("merge")
    texts = save(keyed.groupBy("d").agg(F.first("text").alias("text")).join(shared, "d", "left_semi"), "texts")
    links = save(verified(_central_pairs(members), texts, threshold), "links")
    labels = components(links)
    more = save(verified(save(_block_pairs(members, sketches, labels), "pairs"), texts, threshold), "links")
    if more.limit(1).count():
        labels = components(links.unionByName(more))
    named = sketches.select("d", "first_id").join(labels.withColumnRenamed("node", "d"), "d", "left").withColumn("label", F.coalesce("label", "d"))
    least = named.groupBy("label").agg(F.min("first_id").alias("class_id"))
    return named.select("d", "label").join(least, "label")


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, class_id) for every row."""
    found = save(labelled(docs, threshold), "classes")
    rows = docs.select("doc_id", text_key(F.col("text")).alias("d"))
    return rows.join(found.select("d", F.struct("class_id").alias("c")), "d", "left").select(
        "doc_id", F.when(F.col("c").isNull(), F.col("doc_id")).otherwise(F.col("c.class_id")).alias("class_id"))


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of the smallest id of each class, one per class; texts without words all stay."""
    found = save(labelled(docs, threshold), "classes").select(F.col("d").alias("_d"), F.col("label").alias("_label"), "class_id")
    kept = docs.columns
    joined = docs.withColumn("_d", text_key(F.col("text"))).join(found.withColumnRenamed("class_id", "_class"), "_d", "left")
    first = joined.where(F.col("_label").isNotNull() & F.col("doc_id").eqNullSafe(F.col("_class"))).dropDuplicates(["_label"])
    return first.select(*kept).unionByName(joined.where(F.col("_d").isNull()).select(*kept))
