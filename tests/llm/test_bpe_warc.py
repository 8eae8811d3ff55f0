import base64
import gzip
import hashlib
import json
import random

import pytest

from helixframe.llm import bpe, warc
from helixframe.llm.queries import vocabulary

TEXTS = [None, "", " ", "plain words", "x" * 5000, "naïve café — 日本語 \U0001f600\n\n\t tail  ", "don't 12345 ###", "\r\n" * 50, " a\x1cb\x85c d"]


@pytest.fixture(scope="module")
def reference():
    tiktoken = pytest.importorskip("tiktoken")
    path, pattern = vocabulary()
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def test_encoder_like_the_library(reference):
    coder = bpe.Encoder(*vocabulary())
    rng = random.Random(1)
    texts = [t for t in TEXTS if t] + ["".join(rng.choice("aeiouth nsr.é漢'0 \n") for _ in range(400)) for _ in range(60)]
    for text in texts:
        ids = coder.encode(text)
        assert ids == reference.encode_ordinary(text)
        assert coder.decode(ids) == text.encode()


def test_perfect_hash_is_minimal():
    keys = [str(i).encode() for i in range(5000)]
    table = bpe.PerfectHash(keys)
    assert sorted(table.slot_key.tolist()) == list(range(5000))
    assert table.candidates(keys).tolist() == list(range(5000))


def test_digests(spark, reference):
    rows = [(i, t, 7) for i, t in enumerate(TEXTS)] + [(None, "no id", 7), (1, "", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int")  # ids clashes with the output
    path, pattern = vocabulary()
    got = bpe.digests(df, path, pattern).collect()
    want = []
    for i, t, _ in rows:
        ids = reference.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_archive_round_trip(spark, tmp_path):
    big, other = "<p>ü</p>" * 400, "y" * 1200
    rows = [(1, "http://b.example.com/x", big, 0), (5, "http://a.example.com/1?q=1#f", big, 0), (3, None, big, 0), (None, "http://a.example.com/2", big, 0),
            (4, "http://a.example.com/1?q=1", other, 0), (6, "u", None, 0), (7, "u", "", 0), (8, "bad\r\nurl", "short", 0), (9, "x", "short", 0), (9, "x", "short", 0)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, key int")
    root = f"file://{tmp_path}/w"
    blocks = warc.write_archive(pages, root, files=3)
    got = {r["page_id"]: r for r in warc.read_archive(blocks, root).collect()}
    assert warc.read_archive(blocks, root).count() == len(rows)
    for i, _, html, _ in rows:
        data = (html or "").encode()
        r = got[i]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(data), hashlib.sha1(data).hexdigest())
        revisit = html == big and i != 5
        assert (r["record_type"], r["refers_to"]) == (("revisit", 5) if revisit else ("response", None))
    whole = b"".join(gzip.decompress(p.read_bytes()) for p in sorted((tmp_path / "w").glob("*.warc.gz")))
    assert whole.count(b"WARC/1.1\r\n") == len(rows)
    urls = spark.createDataFrame([("http://a.example.com/1?q=1",), ("http://b.example.com/x",), ("http://none.example.com/",)], "url string")
    assert sorted(r["page_id"] for r in warc.lookup(spark, root, urls).collect()) == [1, 4, 5]


def test_revisits_where_ids_and_urls_repeat(spark, tmp_path):
    a, b, c = "a" * 1000, "b" * 1000, "c" * 999
    rows = [(1, "http://x.example.com/", t) for t in (a, b, c, a)] + [(2, "http://x.example.com/", a), (3, "http://y.example.com/", b)]
    rows += [(None, None, b), (None, None, "d" * 1000), (9, None, c), (3, "http://y.example.com/", b)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for files in (1, 4):
        root = f"file://{tmp_path}/w{files}"
        got = warc.read_archive(warc.write_archive(pages, root, files=files), root).collect()
        newest = {a: 2, b: 3}
        want = []
        for i, _, html in rows:
            other = html in newest and newest[html] != i
            want.append((i, len(html), hashlib.sha1(html.encode()).hexdigest(), "revisit" if other else "response", newest[html] if other else None))
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
        assert sorted(map(tuple, warc.lookup(spark, root, pages.select("url"), with_payload=False).collect()), key=str) == sorted(want, key=str)


def test_lookup_searches_the_index(spark, tmp_path, monkeypatch):
    """Hot keys over many blocks and files, keys between blocks, and a directory that leads astray."""
    monkeypatch.setattr(warc, "BLOCK_CAPTURES", 4)
    rows = [(i, None if i % 3 == 0 else f"http://h{i % 5}.example.com/{i % 40:02d}", f"page {i} " + "z" * (i * 7)) for i in range(300)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    root = f"file://{tmp_path}/w"
    assert warc.write_archive(pages, root, files=4).count() >= 75
    got = warc.lookup(spark, root, pages.select("url"), with_payload=False).collect()
    assert sorted((r["page_id"], r["payload_digest"]) for r in got) == [(i, hashlib.sha1(h.encode()).hexdigest()) for i, _, h in rows]
    some = spark.createDataFrame([(None,), ("http://h1.example.com/01",), ("http://h1.example.com/01",), ("http://h9.example.com/",), ("http://aa.example.com/0",)], "url string")
    found = warc.lookup(spark, root, some).collect()
    assert sorted((r["page_id"], r["html"]) for r in found) == [(i, h) for i, u, h in rows if u in (None, "http://h1.example.com/01")]
    assert warc.lookup(spark, root, some.limit(0)).count() == 0
    # With first keys that are too late no bisection can come to the records of the block.
    for path in (tmp_path / "w").glob("*.dir"):
        entries = json.loads(path.read_text())
        path.write_text(json.dumps([{**e, "first_key": "zzz"} for e in entries]))
    assert len(warc.lookup(spark, root, pages.select("url"), with_payload=False).collect()) < len(rows)


def test_archive_of_nothing(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    root = f"file://{tmp_path}/w"
    assert warc.read_archive(warc.write_archive(pages, root), root).count() == 0
