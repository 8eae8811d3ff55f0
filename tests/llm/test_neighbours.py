import math

import numpy as np

from helixframe.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>, score string"


def brute(rows, k):
    usable = [(i, np.array(v, dtype="f4").astype("f8")) for i, v, _ in rows if i is not None and v is not None and len(v)
              and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, x in usable:
        if q % 100 == 0:
            near = sorted((float(np.sqrt(((x - y) ** 2).sum())), i) for i, y in usable if i != q and len(y) == len(x))
            out[q] = [(i, round(d, 9)) for d, i in near[:k]]
    return {q: near for q, near in out.items() if near}


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], round(r["score"], 9)))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def nearest(df, k=10):
    return neighbours.nearest(df, df.where("vec_id % 100 = 0"), k)


def test_like_brute_force(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 64)
    monkeypatch.setattr(neighbours, "STRIP_ROWS", 3)
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=16).astype("f4")], "s") for i in range(700)]
    assert found(nearest(spark.createDataFrame(rows, SCHEMA))) == brute(rows, 10)


def test_ties_and_unusable_vectors(spark):
    same = [1.0, 2.0]
    rows = [(0, same, "a"), (100, [3.0, 4.0], "a")] + [(i, same, "a") for i in range(1, 40)]
    rows += [(200, None, "a"), (300, [0.0, 0.0], "a"), (400, [float("nan"), 1.0], "a"), (500, [float("inf"), 1.0], "a"),
             (600, [None, 1.0], "a"), (700, [1.0], "a"), (None, same, "a"), (800, [], "a"), (900, [1e30, -1e30], "a")]
    got = found(nearest(spark.createDataFrame(rows, SCHEMA)))
    assert got == brute(rows, 10)
    assert [i for i, _ in got[0]] == list(range(1, 11)) and 700 not in got


def test_empty(spark):
    assert nearest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_error_bound_holds():
    rng = np.random.default_rng(5)
    rows = rng.normal(size=(200, 24)) * 10.0 ** rng.integers(-3, 4, size=(200, 1))

    class Row:
        n, dim = rows.shape
        ids = np.arange(200, dtype="<i8").tobytes()
        vectors = rows.astype("<f8").tobytes()

    t = neighbours.Tile(Row)
    inner = neighbours._products(t.codes, t.codes) * (t.scale * t.scale[:, 0])
    bound = np.outer(t.coded_size, t.rest) + np.outer(t.rest, t.coded_size + t.rest)
    assert (np.abs(inner - rows @ rows.T) <= bound * (1 + 1e-9) + 1e-12).all()
