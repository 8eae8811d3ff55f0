"""Byte-level BPE: whole pre-tokens by a minimal perfect hash, the rest by merges from a heap.

Tier one hashes a pre-token into a table with exactly one slot per vocabulary entry and compares the entry found
there, so a pre-token that is itself a vocabulary entry costs one probe. Tier two takes the misses: its bytes form a
linked list, and a heap gives the adjacent pair of lowest rank (leftmost first) until no pair is in the vocabulary.
Both tiers see each distinct pre-token of a batch once; a bounded memo keeps recent results.

Null and empty texts have no ids and decode to no bytes; a very long word takes n log n steps. An empty table gives no rows. Repeated rows are encoded alike. Columns of the input that
carry the name of an output column are replaced.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, types as T

MEMO_ENTRIES, MEMO_LENGTH = 300_000, 64  # a memo lives as long as its task and keeps no longer words
CHUNK_CHARS = 2_000_000
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Minimal perfect hash by displacement: n keys, n slots."""

    def __init__(self, keys: list[bytes]):
        self.n = n = len(keys)
        hashes = self.hashes(keys)
        if len(np.unique(hashes)) != n:
            raise ValueError("keys repeat")
        buckets = (hashes % np.uint64(n)).astype(np.int64)
        order = np.argsort(buckets, kind="stable")
        ids, first, sizes = np.unique(buckets[order], return_index=True, return_counts=True)
        self.displacement = np.zeros(n, dtype=np.int64)
        self.slot_key = np.full(n, -1, dtype=np.int64)
        # Buckets of one size try their next displacement together, the largest first; of two that want a slot one waits.
        for size in range(int(sizes.max(initial=0)), 1, -1):
            at = np.flatnonzero(sizes == size)
            members = order[first[at][:, None] + np.arange(size)]
            tries = np.ones(len(at), dtype=np.int64)
            left = np.arange(len(at))
            while len(left):
                slots = self._slot(hashes[members[left]], tries[left][:, None])
                ordered = np.sort(slots, axis=1)
                fits = (ordered[:, 1:] > ordered[:, :-1]).all(axis=1) & (self.slot_key[slots] < 0).all(axis=1)
                owner = np.full(n, len(left), dtype=np.int64)
                np.minimum.at(owner, slots[fits].ravel(), np.repeat(np.flatnonzero(fits), size))
                wins = fits & (owner[slots] == np.arange(len(left))[:, None]).all(axis=1)
                self.slot_key[slots[wins]] = members[left[wins]]
                self.displacement[ids[at[left[wins]]]] = tries[left[wins]]
                tries[left[~fits]] += 1
                left = left[~wins]
        single = np.flatnonzero(sizes == 1)
        free = np.flatnonzero(self.slot_key < 0)
        self.displacement[ids[single]] = -free - 1
        self.slot_key[free] = order[first[single]]

    @staticmethod
    def hashes(keys: list[bytes]) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh64_intdigest, keys), dtype=np.uint64, count=len(keys))

    def _slot(self, hashes: np.ndarray, displacement) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (_mix(hashes + np.asarray(displacement).astype(np.uint64) * GOLDEN) % np.uint64(self.n)).astype(np.int64)

    def candidates(self, keys: list[bytes]) -> np.ndarray:
        """Index of the only key that may equal each given one."""
        hashes = self.hashes(keys)
        displacement = self.displacement[(hashes % np.uint64(self.n)).astype(np.int64)]
        slots = np.where(displacement < 0, -displacement - 1, self._slot(hashes, np.maximum(displacement, 0)))
        return self.slot_key[slots]


class Encoder:
    """The two tiers over one vocabulary."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.tokens = list(self.ranks)
        self.ids = list(self.ranks.values())
        self.names = dict(zip(self.ids, map(str, self.ids), strict=True))
        self.bytes_of = {rank: token for token, rank in self.ranks.items()}
        self.table = PerfectHash(self.tokens)
        self.find = regex.compile(pattern).findall
        # Two generations: what was used since the last turn survives the next.
        self.memo: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text."""
        if not text:
            return []
        words = self.find(text)
        fresh = set(words).difference(self.memo)
        if fresh:
            if len(self.memo) + len(fresh) > MEMO_ENTRIES:
                self.older, self.memo = self.memo, {}
                fresh = set(words)
            older = self.older
            known = {w: older[w] for w in fresh if w in older}
            known |= self._resolve([w for w in fresh if w not in known])
            self.memo.update((w, ids) for w, ids in known.items() if len(w) <= MEMO_LENGTH)
            long = {w: ids for w, ids in known.items() if len(w) > MEMO_LENGTH}
            if long:
                memo = self.memo
                return list(chain.from_iterable(long[w] if w in long else memo[w] for w in words))
        return list(chain.from_iterable(map(self.memo.__getitem__, words)))

    def _resolve(self, words: list[str]) -> dict[str, tuple[int, ...]]:
        if not words:
            return {}
        keys = [w.encode() for w in words]
        return {
            word: (self.ids[at],) if self.tokens[at] == key else self.merge(key)
            for word, key, at in zip(words, keys, self.table.candidates(keys).tolist(), strict=True)
        }

    def forget(self) -> None:
        """Drop the memos."""
        self.memo, self.older = {}, {}

    def merge(self, word: bytes) -> tuple[int, ...]:
        """Ids of a pre-token that is no vocabulary entry."""
        n, get, push = len(word), self.ranks.get, heapq.heappush
        # A pair is one number: its rank, then the start of its first piece and the end of its second.
        bits = n.bit_length()
        high, mask = 2 * bits, (1 << bits) - 1
        end = list(range(1, n + 2))  # end of the piece that starts here; 0: no piece starts here
        before = list(range(-1, n))
        heap = [rank << high | i << bits | i + 2 for i in range(n - 1) if (rank := get(word[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            pair = heapq.heappop(heap)
            left, stop = pair >> bits & mask, pair & mask
            right = end[left]
            if not right or end[right] != stop:
                continue  # one of the two has grown since
            end[left], end[right] = stop, 0
            if stop < n:
                before[stop] = left
                after = end[stop]
                if (rank := get(word[left:after])) is not None:
                    push(heap, rank << high | left << bits | after)
            first = before[left]
            if first >= 0 and (rank := get(word[first:stop])) is not None:
                push(heap, rank << high | first << bits | stop)
        out, at, ranks = [], 0, self.ranks
        while at < n:
            stop = end[at]
            out.append(ranks[word[at:stop]])
            at = stop
        return tuple(out)

    def decode(self, ids: list[int]) -> bytes:
        """Bytes of a list of ids."""
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    """One encoder per Python worker and vocabulary."""
    return Encoder(path, pattern)


def _replaced(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([f for f in df.schema.fields if f.name != name] + [T.StructField(name, kind)])


def _hashes(coder: Encoder, ids: list[int]) -> tuple[str, str]:
    """SHA-256 of the ids joined by spaces and of the bytes they decode to."""
    return sha256(" ".join(map(coder.names.__getitem__, ids)).encode()).hexdigest(), sha256(coder.decode(ids)).hexdigest()


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", out: str = "ids", hashes: bool = False) -> DataFrame:
    """Add the ids of each text as an array column; with ``hashes`` also ids_sha256 and decoded_sha256 of the round trip."""
    added = [(out, T.ArrayType(T.IntegerType()))] + [(n, T.StringType()) for n in ("ids_sha256", "decoded_sha256") if hashes]
    replaced = [n for n, _ in added]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path, pattern)
        for batch in batches:
            texts, start, ids, offsets, taken, shas = batch.column(text), 0, [], [0], 0, []
            for i in range(batch.num_rows):
                value = texts[i].as_py()
                found = coder.encode(value)
                ids.extend(found)
                offsets.append(len(ids))
                taken += len(value or "")
                if hashes:
                    shas.append(_hashes(coder, found))
                if taken >= CHUNK_CHARS or i + 1 == batch.num_rows:
                    new = [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.array(ids, dtype=np.int32)))]
                    new += [pa.array(x, pa.string()) for x in zip(*shas, strict=True)]
                    part = batch.slice(start, i + 1 - start)
                    names = [n for n in part.schema.names if n not in replaced]
                    yield pa.RecordBatch.from_arrays([part.column(n) for n in names] + new, names + replaced)
                    start, ids, offsets, taken, shas = i + 1, [], [0], 0, []
        coder.forget()

    kept = [f.name for f in df.schema.fields if f.name not in replaced or f.name == text]
    fields = [f for f in df.schema.fields if f.name not in replaced] + [T.StructField(n, kind) for n, kind in added]
    return df.select(kept).mapInArrow(rows, T.StructType(fields))


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add the bytes that each array of ids stands for."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path, pattern)
        for batch in batches:
            names = [n for n in batch.schema.names if n != out]
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                values = [coder.decode(x or []) for x in (v.as_py() for v in part.column(ids))]
                yield pa.RecordBatch.from_arrays([part.column(n) for n in names] + [pa.array(values, pa.binary())], names + [out])

    kept = [f.name for f in df.schema.fields if f.name != out]
    return df.select(kept).mapInArrow(rows, _replaced(df, out, T.BinaryType()))


def digests(df: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, number of ids, and the hashes of the ids and of the bytes they decode to, in one pass over the texts."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path, pattern)
        for batch in batches:
            found: tuple[list, ...] = ([], [], [])
            for text in batch.column("text"):
                ids = coder.encode(text.as_py())
                for column, value in zip(found, (len(ids), *_hashes(coder, ids)), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(x, t) for x, t in zip(found, (pa.int64(), pa.string(), pa.string()), strict=True))],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        coder.forget()

    return df.select("doc_id", "text").mapInArrow(rows, f"doc_id {dict(df.dtypes)['doc_id']}, n_tokens long, ids_sha256 string, decoded_sha256 string")
