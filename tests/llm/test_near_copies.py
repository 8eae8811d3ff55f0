from collections import Counter
import random

import numpy as np

from helixframe.llm import neardup
from helixframe.llm.graph import components


def shingles(text):
    words = (text or "").encode().split()
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def brute(rows):
    texts = sorted({t for _, t, _ in rows if shingles(t)})
    bags = [shingles(t) for t in texts]
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            low = sum((bags[i] & bags[j]).values())
            if low / (sum(bags[i].values()) + sum(bags[j].values()) - low) >= 0.8:
                parent[root(i)] = root(j)
    label = {t: root(i) for i, t in enumerate(texts)}
    first = {}
    for i, t, _ in rows:
        if t in label and i is not None:
            first[label[t]] = min(i, first.get(label[t], i))
    return sorted(((i, first.get(label[t]) if t in label else i) for i, t, _ in rows), key=str)


def corpus():
    rng = random.Random(6)
    word = lambda: rng.choice("abcdefgh") + str(rng.randrange(400))
    rows, n = [], 0
    for group in range(12):
        base = [word() for _ in range(rng.choice([6, 30, 120, 300]))]
        for _ in range(rng.choice([1, 3, 14])):
            text = list(base)
            for _ in range(int(len(base) * rng.choice([0, 0.005, 0.02, 0.05]))):
                text[rng.randrange(len(text))] = word()
            rows.append((n := n + 1, " ".join(text), "s"))
    rows += [(n + 1, "same same " * 200, "s"), (n + 2, "same same " * 203, "s"), (n + 3, "same same " * 60, "s"), (n + 4, "two words", "s"), (n + 5, "two words", "s")]
    return rows + [rows[0], (None, rows[1][1], "s"), (None, None, None), (n + 6, "", "s"), (n + 7, " \n", "s"), (n + 8, "one word", "s")]


def test_classes_like_brute_force(docs_of, monkeypatch):
    rows = corpus()
    docs = docs_of(rows)
    want = brute(rows)
    assert sorted(((r["doc_id"], r["class_id"]) for r in neardup.classes(docs).collect()), key=str) == want
    monkeypatch.setattr(neardup, "BLOCK", 3)  # buckets in several blocks
    assert sorted(((r["doc_id"], r["class_id"]) for r in neardup.classes(docs).collect()), key=str) == want
    kept = neardup.one_of_each(docs)
    assert kept.columns == docs.columns
    with_words = [r["doc_id"] for r in kept.collect() if shingles(r["text"])]
    assert sorted(with_words) == sorted({c for i, c in want if c is not None and any(i == j and shingles(t) for j, t, _ in rows)})


def test_empty(docs_of):
    assert neardup.classes(docs_of([])).count() == 0 and neardup.one_of_each(docs_of([])).count() == 0


def test_signature_estimates_weighted_similarity():
    rng = np.random.default_rng(8)
    gaps = []
    for _ in range(150):
        h = np.unique(rng.integers(0, 2**63, rng.integers(2, 200)).astype(np.uint64))
        a = rng.integers(1, 9, len(h))
        b = np.where(rng.random(len(h)) < 0.7, a, rng.integers(1, 20, len(h)))
        true = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        gaps.append((neardup.signature(h, a) == neardup.signature(h, b)).mean() - true)
    assert abs(np.mean(gaps)) < 0.012 and np.std(gaps) < 0.06


def test_parity_never_exceeds_the_difference():
    rng = np.random.default_rng(9)
    h = np.unique(rng.integers(0, 2**63, 300).astype(np.uint64))
    for _ in range(20):
        a, b = rng.integers(1, 4, len(h)), rng.integers(1, 4, len(h))
        x, y = (np.frombuffer(neardup.parity(h, w), dtype=np.uint64) for w in (a, b))
        assert np.bitwise_count(x ^ y).sum() <= np.abs(a - b).sum()


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (5, 5)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}
