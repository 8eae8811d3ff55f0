"""Exact nearest neighbours of a query set by a block matrix join.

Queries are packed into strips and all vectors into blocks; a cell of the grid (strip, group of blocks) is one task.
Each tile multiplies the two int8 matrices. Because a vector x is stored as scale * int8 + r with known |r|, the product
differs from the true inner product by at most |x'||r_y| + |r_x||y'| + |r_x||r_y|, which gives a lower and an upper
bound of every distance. Pairs whose lower bound exceeds the k-th smallest upper bound, or the k-th distance found in an
earlier tile, are left out; the rest are recomputed in double precision and pushed on a heap per query. The heaps of the
cells are merged by rank per query.

Vectors that are null, zero, or hold null or non-finite components, and rows without an id, take no part. Vectors are
compared with vectors of their own length only. Rows that repeat an id are separate candidates, none of which is offered
to a query of that id; of repeated query rows the smallest vector asks. Ties go to the smaller id. Other columns are
ignored. An empty table has no result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

STRIP_ROWS = 4096
BLOCK_ROWS = 1024
BLOCKS_PER_GROUP = 4
PAIRS_AT_ONCE = 32_768
# Products of int8 values stay exact in single precision up to this length.
EXACT_LENGTH = 1024

TILE = "tile long, dim int, n int, ids binary, vectors binary"


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """Rows that take part: (id, v array<double>, dim)."""
    v = F.col(vec_col).cast("array<double>")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return (
        vectors.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull())
        .select(F.col(id_col).cast("long").alias("id"), v.alias("v"))
        .where(F.forall("v", finite) & F.exists("v", lambda x: x != 0))
        .withColumn("dim", F.size("v"))
    )


def _pack(rows: DataFrame, most: int) -> DataFrame:
    """Tiles of up to ``most`` vectors, cut within each partition; originals are kept in double precision."""

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, tiles = TaskContext.get().partitionId(), 0
        open_tiles: dict[int, list[tuple[int, np.ndarray]]] = {}

        def close(dim: int) -> pd.DataFrame:
            nonlocal tiles
            held = open_tiles.pop(dim)
            tiles += 1
            ids, vectors = np.array([i for i, _ in held], dtype="<i8"), np.array([v for _, v in held], dtype="<f8")
            return pd.DataFrame({"tile": [(part << 32) + tiles], "dim": [dim], "n": [len(held)], "ids": [ids.tobytes()], "vectors": [vectors.tobytes()]})

        for frame in frames:
            for i, v, dim in zip(frame["id"], frame["v"], frame["dim"], strict=True):
                open_tiles.setdefault(dim, []).append((i, v))
                if len(open_tiles[dim]) >= most:
                    yield close(dim)
        for dim in list(open_tiles):
            yield close(dim)

    return rows.mapInPandas(pack, TILE)


class Tile:
    """A matrix of vectors with its int8 form."""

    def __init__(self, row):
        self.ids = np.frombuffer(row.ids, dtype="<i8")
        self.exact = np.frombuffer(row.vectors, dtype="<f8").reshape(row.n, row.dim)
        largest = np.abs(self.exact).max(axis=1, keepdims=True)
        # Norms are taken of scaled vectors, so very large and very small ones neither overflow nor vanish.
        self.scale = largest / 127
        unit = self.exact / largest
        self.codes = np.rint(unit * 127).astype(np.int8)
        coded = self.codes.astype(np.float64) / 127
        self.size = largest[:, 0] * np.sqrt((unit**2).sum(axis=1))
        self.coded_size = largest[:, 0] * np.sqrt((coded**2).sum(axis=1))
        self.rest = largest[:, 0] * np.sqrt(((unit - coded) ** 2).sum(axis=1))


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of int8 rows, exact."""
    out = np.zeros((len(a), len(b)))
    for at in range(0, a.shape[1], EXACT_LENGTH):
        out += a[:, at : at + EXACT_LENGTH].astype(np.float32) @ b[:, at : at + EXACT_LENGTH].astype(np.float32).T
    return out


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distance row by row, components added in order."""
    total = np.zeros(len(a))
    for j in range(a.shape[1]):
        total += (a[:, j] - b[:, j]) ** 2
    return np.sqrt(total)


def search_tile(q: Tile, c: Tile, heaps: list[list], k: int) -> None:
    """Push the pairs of a tile that may be among the k nearest on the heaps of its queries."""
    for at in range(0, len(q.ids), 512):
        s = slice(at, at + 512)
        with np.errstate(over="ignore", invalid="ignore"):
            inner = _products(q.codes[s], c.codes) * (q.scale[s] * c.scale[:, 0])
            error = np.outer(q.coded_size[s], c.rest) + np.outer(q.rest[s], c.coded_size + c.rest)
            squares = (q.size[s] ** 2)[:, None] + c.size**2
            slack = error * 2 + squares * 1e-12 + 1e-300
            low, high = squares - 2 * inner - slack, squares - 2 * inner + slack
        own = q.ids[s][:, None] == c.ids
        low[own], high[own] = np.inf, np.inf
        limit = np.partition(high, k - 1, axis=1)[:, k - 1] if high.shape[1] >= k else np.full(len(high), np.inf)
        held = np.array([-h[0][0] if len(h) == k else np.inf for h in heaps[s]])
        with np.errstate(over="ignore"):
            limit = np.minimum(limit, held**2 * (1 + 1e-12))
        near = ~(low > limit[:, None]) & ~own  # bounds that overflow to nan rule nothing out
        rows, columns = np.nonzero(near)
        for start in range(0, len(rows), PAIRS_AT_ONCE):
            r, m = rows[start : start + PAIRS_AT_ONCE], columns[start : start + PAIRS_AT_ONCE]
            with np.errstate(over="ignore"):
                exact = distances(q.exact[s][r], c.exact[m])
            order = np.lexsort((c.ids[m], exact, r))
            r, m, exact = r[order], m[order], exact[order]
            first = np.searchsorted(r, r, side="left")
            keep = np.arange(len(r)) - first < k
            for i, j, d in zip(r[keep].tolist(), c.ids[m[keep]].tolist(), exact[keep].tolist(), strict=True):
                heap = heaps[at + i]
                if len(heap) < k:
                    heapq.heappush(heap, (-d, -j))
                elif (-d, -j) > heap[0]:
                    heapq.heapreplace(heap, (-d, -j))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, <id_col>, score): the k nearest vectors of each query row, by Euclidean distance."""
    candidates = usable(vectors, id_col, vec_col)
    asked = usable(queries, id_col, vec_col).groupBy("id").agg(F.min_by(F.struct("v", "dim"), "v").alias("x")).select("id", "x.*")
    strips = max(1, -(-queries.count() // STRIP_ROWS))
    # A strip is a hash share of the queries with an expected size, so none grows with the data.
    dealt = asked.withColumn("share", F.pmod(F.xxhash64("id"), F.lit(strips)))
    packed = dealt.groupBy("share").applyInPandas(
        lambda f: pd.DataFrame([
            {"strip": int(f["share"].iloc[0]), "dim": int(dim), "n": len(g), "ids": g["id"].to_numpy("<i8").tobytes(),
             "vectors": np.array(g["v"].tolist(), dtype="<f8").tobytes()}
            for dim, g in f.groupby("dim")
        ], columns=["strip", "dim", "n", "ids", "vectors"]),
        "strip long, dim int, n int, ids binary, vectors binary")
    groups = max(1, -(-vectors.count() // (BLOCK_ROWS * BLOCKS_PER_GROUP)))
    left = packed.withColumn("cell", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
    blocks = _pack(candidates, BLOCK_ROWS).withColumn("cell", F.pmod(F.xxhash64("tile"), F.lit(groups)))
    right = blocks.withColumn("strip", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(strips - 1).cast("long"))))

    def cell(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        for row in left.itertuples():
            q = Tile(row)
            heaps: list[list] = [[] for _ in q.ids]
            for other in right[right["dim"] == row.dim].itertuples():
                search_tile(q, Tile(other), heaps, k)
            found += [(int(i), -j, -d) for i, heap in zip(q.ids, heaps, strict=True) for d, j in heap]
        return pd.DataFrame(found, columns=["query_id", id_col, "score"])

    heaps = left.groupBy("strip", "cell").cogroup(right.groupBy("strip", "cell")).applyInPandas(
        cell, f"query_id long, {id_col} long, score double")
    by_rank = Window.partitionBy("query_id").orderBy("score", id_col)
    return heaps.withColumn("rank", F.row_number().over(by_rank)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), id_col, "score")
