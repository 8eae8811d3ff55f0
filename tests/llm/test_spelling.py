import random
import re
import zlib
from collections import Counter

from helixframe.llm import queries, spelling


def neighbours(w, alphabet):
    out = set()
    for i in range(len(w) + 1):
        out |= {w[:i] + c + w[i:] for c in alphabet}
        if i < len(w):
            out |= {w[:i] + c + w[i + 1 :] for c in alphabet} | {w[:i] + w[i + 1 :]}
    return out - {w}


def brute(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(c.lower() if c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{low}".encode())
            if h % 97 == 0:
                k = h % len(low)
                low = low[:k] + low[k + 1 :]
            counts[low] += 1
    n = {w: x for w, x in counts.items() if len(w) >= 5 and x >= 3}
    alphabet = sorted(set("".join(n)))
    near = {w: [x for x in neighbours(w, alphabet) if x in n] for w in n}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def result(df):
    rows = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_equals_brute_force(docs_of):
    draw = random.Random(5)
    stems = ["".join(draw.choice("abÀÿ") for _ in range(draw.randrange(3, 9))) for _ in range(60)]
    rows = []
    for i in range(300):
        words = []
        for _ in range(40):
            w = draw.choice(stems)
            if draw.random() < 0.4:
                k = draw.randrange(len(w) + 1)
                w = draw.choice([w[:k] + draw.choice("abcÉ") + w[k:], w[:k] + w[k + 1 :], w[:k] + "z" + w[k + 1 :]])
            words.append(w.upper() if draw.random() < 0.1 and w.isascii() else w)
        rows.append((None if i == 7 else i, draw.choice([" ", ", ", "\n", "1"]).join(words), "s"))
    rows += [(900, None, "s"), (901, "", "s"), (5, rows[5][1], "s"), (902, "longword " * 60_000 + "longwurd " * 4 + "x" * 100_000, "s")]
    assert result(spelling.variants(docs_of(rows))) == brute([r[:2] for r in rows])


def test_long_chain_and_one_list(docs_of):
    # One list of beginnings holds all; each word's form is the next, doubling.
    words = ["aaaa" + "b" * k for k in range(1, 9)]
    rows = [(k, (w + " ") * (3 * 2**k), "s") for k, w in enumerate(words)]
    got = result(spelling.variants(docs_of(rows)))
    assert got == brute([r[:2] for r in rows])
    assert max(Counter(r[2] for r in got).values()) >= 7


def test_empty(docs_of):
    assert spelling.variants(docs_of([])).count() == 0
    assert spelling.variants(docs_of([(1, "abcde abcde", "s")])).count() == 0


def test_skipped_ranges_lose_nothing():
    draw = random.Random(11)
    for m in (5, 6, 9):
        depth = spelling.half(m)
        words = sorted({"x" * depth + "".join(draw.choice("abc") for _ in range(m - depth + draw.randrange(2))) for _ in range(200)})
        got = set(spelling.near_in_list(words, m, depth))
        want = {(i, j) for i, w in enumerate(words) for j in range(i + 1, len(words))
                if words[j] in neighbours(w, "abcx") and m in (len(w), len(words[j]))}
        assert got == want


def test_query_over_the_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert result(queries.op13_spelling_variants(spark, sf)) == brute(rows)
