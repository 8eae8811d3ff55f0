from collections import defaultdict
import random

import numpy as np
import pytest

from helixframe.llm import mixing


def test_targets():
    goal = mixing.targets([("a", 1000), ("b", 10), ("c", 5000)])
    assert goal[1] == 20 and goal[0] == 2000  # both full
    assert sum(goal) == pytest.approx(1.5 * 6010)
    assert mixing.targets([]) == [] and mixing.targets([("a", 0), ("b", 0)]) == [0, 0]


def test_tree_adds_up():
    shares = mixing.split_tree([1000, 7, 0, 333], 16)
    assert shares.sum(axis=0).tolist() == [1000, 7, 0, 333] and (shares >= 0).all()
    assert shares.sum(axis=1).max() - shares.sum(axis=1).min() <= 4
    assert (shares == mixing.split_tree([1000, 7, 0, 333], 16)).all()


def rows_of(n):
    rng = random.Random(2)
    rows = [(i, " ".join("w" for _ in range(rng.choice([1, 5, 60, 900]))), rng.choice(["big"] * 6 + ["b", "c", None])) for i in range(n)]
    return rows + [(None, None, "big"), (1, "", "c"), (2, " \n", None), rows[0], rows[0]]


def test_plan(docs_of, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_DOCS", 8)
    rows = rows_of(400)
    got = mixing.plan(docs_of(rows)).collect()
    again = mixing.plan(docs_of(rows).repartition(7)).collect()
    pick = lambda r: (str(r["doc_id"]), r["source"] or "", r["size"], r["taken"])
    assert sorted(map(pick, got)) == sorted(map(pick, again)) and len(got) == len(rows)
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    goal = dict(zip(order, mixing.targets([(s, sizes[s]) for s in order]), strict=True))
    taken, shards = defaultdict(int), defaultdict(int)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(goal[r["source"]])
        assert r["taken"] <= 2 * r["size"] and r["taken"] == sum(p["words"] for p in r["place"])
        taken[r["source"]] += r["taken"]
        for p in r["place"]:
            shards[p["shard"]] += p["words"]
    assert all(taken[s] == round(goal[s]) for s in order)
    assert set(shards) <= set(range(mixing.SHARDS))
    total = sum(shards.values())
    assert max(shards.values()) < 3 * total / mixing.SHARDS


def test_mix_cuts_one_document_per_source(docs_of, spark, tmp_path):
    rows = rows_of(200)
    mixed = mixing.mix(docs_of(rows))
    got = mixed.collect()
    planned = {(r["doc_id"], r["source"], r["size"]): r for r in mixing.plan(docs_of(rows)).collect()}
    assert sum(r["words"] for r in got) == sum(len(r["text"].split()) for r in got)
    cut = [r for r in got if r["words"] < planned[next(k for k in planned if k[0] == r["doc_id"] and k[1] == r["source"])]["size"]]
    assert len(cut) <= 4
    mixing.write_shards(mixed, f"file://{tmp_path}/shards")
    assert spark.read.parquet(f"file://{tmp_path}/shards").count() == len(got)


def test_empty(docs_of):
    assert mixing.plan(docs_of([])).count() == 0 and mixing.mix(docs_of([])).count() == 0


def test_draw_is_hypergeometric():
    first = np.array([mixing.split_tree([100, 300], 2, seed=s)[0] for s in range(400)])
    assert (first.sum(axis=1) == 200).all() and abs(first[:, 0].mean() - 50) < 1


def test_shards_get_what_the_tree_draws(docs_of, spark, tmp_path):
    """Documents of one block each: the copies per shard and source are the tree's numbers, each block in one place."""
    rows = [(i, "w w w w", "a" if i < 90 else "b" if i < 97 else None) for i in range(140)]
    planned = mixing.plan(docs_of(rows), shards=6, seed=3, block_words=4).collect()
    order = ["a", "b", None]
    goal = mixing.targets([(s, 4 * sum(x == s for _, _, x in rows)) for s in order])
    want = mixing.split_tree([-(-round(g) // 4) for g in goal], 6, 3)
    got = np.zeros_like(want)
    for r in planned:
        for p in r["place"]:
            got[p["shard"], order.index(r["source"])] += 1
    assert (got == want).all()
    # The blocks of a source do not go to the shards in the order of its stream.
    other = {r["doc_id"]: [p["shard"] for p in r["place"]] for r in mixing.plan(docs_of(rows), shards=6, seed=4, block_words=4).collect()}
    assert other != {r["doc_id"]: [p["shard"] for p in r["place"]] for r in planned}
    mixed = mixing.mix(docs_of(rows))
    mixing.write_shards(mixed, f"file://{tmp_path}/s")
    for path in (tmp_path / "s").glob("shard=*/*.parquet"):
        held = [r["order"] for r in spark.read.parquet(f"file://{path}").collect()]
        assert held == sorted(held)
    assert sorted(r["order"] for r in spark.read.parquet(f"file://{tmp_path}/s").collect()) == sorted(p["order"] for r in mixing.plan(docs_of(rows)).collect() for p in r["place"])


def test_long_texts_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "word " * 300_000, "a", "x", 7), (2, "b", "a", "y", 8)], "doc_id long, text string, source string, place string, order int")
    got = mixing.mix(docs).collect()
    assert sum(r["words"] for r in got) == round(1.5 * 300_001) == sum(len(r["text"].split()) for r in got)
