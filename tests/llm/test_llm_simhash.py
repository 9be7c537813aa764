"""SimHash near-duplicates and connected components against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash

from metricwin.llm.components import components
from metricwin.llm.simhash import fingerprint, keep_one, links, masked_links, near_duplicates


def plain_fingerprint(text):
    """The contract word by word."""
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64(s.encode(), seed=42).intdigest()
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def reach(nodes, edges):
    """The smallest node each node reaches."""
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def close_pairs(fps, distance):
    return [
        (a, b)
        for i, a in enumerate(fps)
        for b in fps[:i]
        if bin((a ^ b) & (1 << 64) - 1).count("1") <= distance
    ]


def test_fingerprint_is_the_contracts():
    for text in (None, "", " \n", "One", "one TWO", "a b c d a b c d", "É é x y\x0bz Z\x1cq"):
        assert fingerprint(text) == plain_fingerprint(text)
    random.seed(0)
    for _ in range(50):
        text = " ".join(random.choices(["The", "cat", "É", "x" * 99, "."], k=random.randint(1, 60)))
        assert fingerprint(text) == plain_fingerprint(text)


def test_spark_hashes_alike(spark):
    row = spark.sql("select xxhash64('the cat sat') as h").first()
    assert row["h"] % (1 << 64) == xxhash.xxh64(b"the cat sat", seed=42).intdigest()


@pytest.fixture(scope="module")
def clustered():
    """Fingerprints around few centres, with all of a ball's points near one of them."""
    random.seed(5)
    fps = {0, (1 << 64) - 1, 1 << 63}
    for _ in range(6):
        centre = random.getrandbits(64)
        fps |= {centre, centre ^ random.getrandbits(64)}
        for _ in range(60):
            noise = 0
            for _ in range(random.randint(0, 5)):
                noise |= 1 << random.randrange(64)
            fps.add(centre ^ noise)
    return sorted(signed(f) for f in fps)


@pytest.mark.parametrize(("crowd", "distance"), [(128, 2), (4, 2), (128, 3), (128, 1), (1, 1)])
def test_links_reach_what_all_pairs_reach(spark, clustered, crowd, distance):
    frame = spark.createDataFrame([(f,) for f in clustered], "fp long")
    got = [(r["u"], r["v"]) for r in links(frame, distance, crowd).collect()]
    true = close_pairs(clustered, distance)
    assert {tuple(sorted(e)) for e in got} <= {tuple(sorted(e)) for e in true}
    assert reach(clustered, got) == reach(clustered, true)
    if crowd == 128:
        assert {tuple(sorted(e)) for e in got} == {tuple(sorted(e)) for e in true}


def test_masked_keys_alone_reach_everything(spark, clustered):
    frame = spark.createDataFrame([(f,) for f in clustered], "fp long")
    got = [(r["u"], r["v"]) for r in masked_links(frame, 2).collect()]
    assert reach(clustered, got) == reach(clustered, close_pairs(clustered, 2))


def expected(rows):
    fps = [plain_fingerprint(t) for _, t in rows]
    label = {}
    roots = reach(sorted(set(map(signed, fps))), close_pairs(sorted(set(map(signed, fps))), 2))
    for (doc_id, _), fp in zip(rows, fps, strict=True):
        root = roots[signed(fp)]
        ids = [x for x in (label.get(root), doc_id) if x is not None]
        label[root] = min(ids) if ids else None
    return [
        (d, format(fp, "016x"), label[roots[signed(fp)]])
        for (d, _), fp in zip(rows, fps, strict=True)
    ]


def test_awkward_documents(awkward):
    rows = [tuple(r)[:2] for r in awkward.collect()]
    got = [tuple(r) for r in near_duplicates(awkward).collect()]
    assert sorted(got, key=str) == sorted(expected(rows), key=str)


def test_the_table(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = [tuple(r) for r in near_duplicates(docs).collect()]
    assert sorted(got) == sorted(expected(rows))
    assert len({c for _, _, c in got}) < len(got)


def test_keep_one(spark, awkward, no_docs):
    rows = [tuple(r)[:2] for r in awkward.collect()]
    kept = keep_one(awkward)
    assert kept.columns == awkward.columns
    got = [r["doc_id"] for r in kept.collect()]
    want = {c for d, _, c in expected(rows) if c is not None and c == d}
    assert sorted(d for d in got if d is not None) == sorted(want)
    assert got.count(None) == 2
    assert keep_one(no_docs).collect() == []
    assert near_duplicates(no_docs).collect() == []


def test_keep_one_goes_by_row(spark):
    """A third under one id with texts of their own, a third without id that are copies."""
    random.seed(8)
    texts = [" ".join(random.choices("abcdefghijklmnop", k=40)) for _ in range(24)]
    rows = [(-1, t) for t in texts[:8]] + [(100 + i, t) for i, t in enumerate(texts[8:16])]
    rows += [(None, t) for t in texts[12:20]] * 2
    # Under the shared id also copies of a text with a smaller and of one with a larger id.
    rows += [(-1, texts[20]), (-7, texts[20]), (-1, texts[21]), (9, texts[21]), (-1, texts[0])]
    random.shuffle(rows)
    frame = spark.createDataFrame(
        [(d, t, "own", k) for k, (d, t) in enumerate(rows)],
        "doc_id long, text string, row_key string, nth int",
    ).repartition(3, "nth")
    kept = keep_one(frame)
    assert kept.columns == frame.columns
    want = [(-1, t) for t in texts[:8]] + [(100 + i, t) for i, t in enumerate(texts[8:16])]
    want += [(None, t) for t in texts[16:20]] + [(-7, texts[20]), (-1, texts[21])]
    got = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_components_of_awkward_graphs(spark):
    random.seed(2)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(501, 560)]
    rand = [(random.randrange(1000, 1200), random.randrange(1000, 1200)) for _ in range(150)]
    edges = chain + [(b, a) for a, b in star] + rand + [(7, 7), (9, 8), (9, 8), (-5, 8)]
    frame = spark.createDataFrame([*edges, (None, 3)], "u long, v long")
    got = {r["node"]: r["root"] for r in components(frame, "test").collect()}
    linked = [(a, b) for a, b in edges if a != b]
    nodes = {n for e in linked for n in e}
    assert got == reach(nodes, linked)
    empty = spark.createDataFrame([], "u long, v long")
    assert components(empty, "test").collect() == []


def test_counts_of_long_texts():
    words = np.random.default_rng(0).integers(0, 50, 300_000)
    text = " ".join(f"w{w}" for w in words[:20_000])
    assert fingerprint(text) == plain_fingerprint(text)
