"""Cover-tree near-duplicates and multi-index search against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from metricwin.llm import cover_tree, multi_index

SCHEMA = "vec_id long, embedding array<float>, label int, v string, cell string, key string"


def frame(spark, rows):
    full = [
        (i, None if v is None else [None if x is None else float(x) for x in v], 1, "own", "own", "own")
        for i, v in rows
    ]
    return spark.createDataFrame(full, SCHEMA)


def sound(v, dim):
    return (
        v is not None
        and len(v) == dim
        and all(x is not None and math.isfinite(x) for x in v)
        and any(x != 0 for x in v)
    )


def clustered(n=240, dim=8, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    spread = rng.choice([0.01, 0.1, 0.3], size=(n, 1))
    v = centres[rng.integers(0, 12, n)] + spread * rng.normal(size=(n, dim))
    v = v.astype(np.float32).astype(float)
    rows = [(int(i), list(x)) for i, x in zip(rng.permutation(n) * 3, v, strict=True)]
    rows += [(5000 + i, rows[0][1]) for i in range(20)]
    rows += [(6000, [2 * x for x in rows[0][1]]), (6001, [-x for x in rows[0][1]])]
    return rows


def odd_rows(dim=8):
    one = [1.0] + [0.0] * (dim - 1)
    return [
        (7000, None),
        (7001, []),
        (7002, [0.0] * dim),
        (7003, [None] + [1.0] * (dim - 1)),
        (7004, [float("nan")] + [1.0] * (dim - 1)),
        (7005, [float("inf")] + [1.0] * (dim - 1)),
        (7006, [1.0, 2.0]),
        (None, one),
        (None, None),
        (7007, one),
        (7007, one),
        (7007, [-x for x in one]),
    ]


def expected_links(rows, cosine, dim=8):
    ok = [i for i, (n, v) in enumerate(rows) if n is not None and sound(v, dim)]
    v = np.array([rows[i][1] for i in ok])
    norm = np.sqrt((v**2).sum(1))
    linked = (v @ v.T) / norm[:, None] / norm >= cosine
    np.fill_diagonal(linked, False)
    label = np.array([rows[i][0] for i in ok])
    while True:
        new = np.minimum(label, np.where(linked, label[None, :], 1 << 60).min(1))
        if (new == label).all():
            break
        label = new
    out = []
    at = {i: k for k, i in enumerate(ok)}
    for i, (n, _) in enumerate(rows):
        if i in at:
            c = int(label[at[i]])
            out.append((n, int(linked[at[i]].sum()), c, n == c))
        else:
            out.append((n, 0, n, n is not None))
    return sorted(out, key=str)


@pytest.mark.parametrize(("cosine", "block"), [(0.95, 4096), (0.95, 40), (0.6, 64), (0.999, 100)])
def test_near_duplicates(spark, cosine, block):
    rows = clustered() + odd_rows()
    got = cover_tree.near_duplicates(frame(spark, rows), cosine, block=block)
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected_links(rows, cosine)


def test_trees_cover_and_nest():
    u = cover_tree.unit(np.array([v for _, v in clustered(300)]))
    path = cover_tree.build(u)
    assert (path[0] == 0).all() and (path[-1] == np.arange(len(u))).all()
    for depth, radius in enumerate(cover_tree.RADII):
        centres = np.unique(path[depth])
        assert (path[depth][centres] == centres).all()
        assert (path[depth + 1][centres] == centres).all()
        near = np.sqrt(((u - u[path[depth]]) ** 2).sum(1))
        assert near.max() <= radius + 1e-9
        # A node lies within one node of the level above.
        assert (path[depth][path[depth + 1]] == path[depth]).all()


def test_sent_subtrees_are_trees_and_lose_no_near_row():
    u = cover_tree.unit(np.array([v for _, v in clustered(300)]))
    centres = cover_tree._spread(u, 70)
    d = cover_tree.distances(u, centres)
    cell = d.argmin(1)
    far = np.array([d[cell == c, c].max() for c in range(70)])
    path = cover_tree.build(u)
    cells = cover_tree.Cells(centres, far, [1] * 70)
    words = cover_tree.reached(u, path, cells, 0.3)
    bits = np.unpackbits(words.view(np.uint8), axis=1, bitorder="little").astype(bool)[:, :70]
    assert not bits.all()
    for c in range(70):
        near = (cover_tree.distances(u, u[cell == c]) <= 0.3).any(1)
        assert bits[near, c].all()
        # Every centre above a row goes with it.
        assert bits[path[:, bits[:, c]], c].all()


def test_rows_sent_grow_with_clustered_vectors_not_with_their_square(spark):
    """Four times the clusters and vectors: blocks of far cells get nothing."""

    def rows_sent(clusters):
        rng = np.random.default_rng(clusters)
        v = np.repeat(rng.normal(size=(clusters, 16)), 40, axis=0)
        v += 0.01 * rng.normal(size=v.shape)
        rows = [(i, 1, list(map(float, x))) for i, x in enumerate(v)]
        classes = spark.createDataFrame(rows, "class long, weight long, v array<double>")
        classes = classes.withColumn("key", F.sha2(F.col("class").cast("string"), 256))
        planted, cells = cover_tree.plant(classes, 16, 0.95, 40, 1024, 4096)
        assert planted.count() == len(rows)
        return cover_tree.sent(planted, cells).count(), planted.select("block").distinct().count()

    (few, _), (many, blocks) = rows_sent(20), rows_sent(80)
    assert many < 8 * few
    assert many < 80 * 40 * blocks / 8


def test_whole_nodes_are_linked():
    """A tight group is linked from above, without its single pairs."""
    rng = np.random.default_rng(1)
    v = np.concatenate([np.ones((50, 8)), -np.ones((30, 8))]) + 0.01 * rng.normal(size=(80, 8))
    path = cover_tree.build(cover_tree.unit(v))
    w = np.arange(1, 81)
    links = cover_tree.traverse(v, v, path, path, w, w, 0.95, True)
    assert (links.counts[:50] == w[:50].sum() - w[:50]).all()
    assert (links.counts[50:] == w[50:].sum() - w[50:]).all()
    assert sum(len(a) for a, _ in links.edges) < 400
    assert len(set(links.labels().tolist())) == 2


def test_no_vectors(spark):
    none = frame(spark, [])
    assert cover_tree.near_duplicates(none).collect() == []
    assert multi_index.search(none, F.lit(True)).collect() == []
    only_bad = frame(spark, [(1, None), (2, [0.0])])
    assert sorted(map(tuple, cover_tree.near_duplicates(only_bad).collect())) == [
        (1, 0, 1, True),
        (2, 0, 2, True),
    ]
    assert multi_index.search(only_bad, F.lit(True)).collect() == []


def exact_search(rows, wanted, k, dim=8):
    """query -> its nearest distinct ids, as (distance, id)."""
    ok = [(n, np.array(v)) for n, v in rows if n is not None and sound(v, dim)]
    out = {}
    for n, q in ok:
        if not wanted(n):
            continue
        own = out.setdefault(n, {})
        for m, v in ok:
            if m != n:
                d = float(np.sqrt(((v - q) ** 2).sum()))
                own[m] = min(own.get(m, math.inf), d)
    return {n: sorted((d, m) for m, d in own.items())[:k] for n, own in out.items()}


@pytest.mark.parametrize("block", [2048, 30])
def test_whole_walk_is_exact(spark, block):
    rows = clustered() + odd_rows()
    got = multi_index.search(
        frame(spark, rows), F.col("vec_id") % 5 == 0, k=10, centres=4, share=1.1, block=block
    )
    found = {}
    for r in got.orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append(r)
    want = exact_search(rows, lambda n: n % 5 == 0, 10)
    assert found.keys() == want.keys()
    for n, own in found.items():
        assert [r["rank"] for r in own] == list(range(1, len(own) + 1))
        assert [r["vec_id"] for r in own] == [m for _, m in want[n]]
        assert np.allclose([r["score"] for r in own], [d for d, _ in want[n]], rtol=0, atol=1e-12)


def test_fewer_vectors_than_asked(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 1.0])]
    got = multi_index.search(frame(spark, rows), F.lit(True), k=10).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in got) == [
        (1, 1, 3), (1, 2, 2), (2, 1, 3), (2, 2, 1), (3, 1, 1), (3, 2, 2),
    ]
    alone = multi_index.search(frame(spark, rows[:1]), F.lit(True))
    assert alone.collect() == []
    thin = multi_index.search(frame(spark, [(1, [1.0]), (2, [3.0])]), F.lit(True))
    assert sorted((r["query_id"], r["vec_id"], r["score"]) for r in thin.collect()) == [
        (1, 2, 2.0), (2, 1, 2.0),
    ]


@pytest.mark.parametrize("n", [4, 5, 11, 14, 20])
def test_few_vectors_give_all_candidates_asked(spark, n):
    """Distinct vectors, each in a cell of its own or nearly; one id has several of them."""
    rng = np.random.default_rng(n)
    rows = [(i, list(v)) for i, v in enumerate(rng.normal(size=(n, 8)).astype(np.float32))]
    for many in (rows, rows + [(0, [-x for x in v]) for _, v in rows]):
        got = multi_index.search(frame(spark, many), F.lit(True), k=10).groupBy("query_id").count()
        assert {r["query_id"]: r["count"] for r in got.collect()} == {
            i: min(10, n - 1) for i in range(n)
        }


def test_walk_goes_by_summed_distance():
    rng = np.random.default_rng(0)
    a, b = rng.random(7), rng.random(5)
    sizes = rng.integers(0, 4, 35).astype(float)
    order = [c for c in np.argsort((a[:, None] + b).ravel(), kind="stable") if sizes[c]]
    assert multi_index.walk(a, b, sizes, sizes.sum()) == order
    some = multi_index.walk(a, b, sizes, 10)
    assert some == order[: len(some)] and sizes[some].sum() >= 10 > sizes[some[:-1]].sum()


def test_recall_of_the_query(spark):
    from metricwin.llm.queries import QUERIES

    folder = "/root/testdata/sf0.1"
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    ids = np.array([r["vec_id"] for r in vectors])
    v = np.array([r["embedding"] for r in vectors], float)
    got = {}
    for r in QUERIES["op10_multi_index"](spark, folder).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = 0
    for q in np.flatnonzero(ids % 100 == 0):
        d = np.sqrt(((v - v[q]) ** 2).sum(1))
        d[q] = np.inf
        hits += len(got[int(ids[q])] & set(ids[np.lexsort((ids, d))[:10]].tolist()))
    assert hits / (10 * len(got)) >= 0.93


def test_every_length_takes_part(spark):
    """Vectors of several lengths: each among its own kind, by brute force."""
    rng = np.random.default_rng(9)
    base = rng.normal(size=(6, 8)).astype(np.float32).astype(float)
    rows = [(i, list(base[i % 6] + 0.01 * (i // 6))) for i in range(30)]
    rows += [(100 + i, [1.0, 0.0, 0.5 if i < 4 else -9.0]) for i in range(6)]
    rows += [(200, [3.0]), (201, [5.0]), (202, [-1.0])]
    got = cover_tree.near_duplicates(frame(spark, rows), cosine=0.95).collect()
    links = {r["vec_id"]: r["n_links"] for r in got}
    roots = {r["vec_id"]: r["component_id"] for r in got}

    def cosine(a, b):
        return np.dot(a, b) / np.sqrt(np.dot(a, a) * np.dot(b, b))

    for i, v in rows:
        near = [j for j, w in rows if j != i and len(v) == len(w) and cosine(v, w) >= 0.95]
        assert links[i] == len(near), i
    assert [roots[i] for i in (103, 105, 200, 201, 202)] == [100, 104, 200, 200, 202]
    found = multi_index.search(frame(spark, rows), F.col("vec_id") % 100 == 0, k=3, share=1.0)
    by_query = {}
    for r in found.orderBy("query_id", "rank").collect():
        by_query.setdefault(r["query_id"], []).append(r["vec_id"])
    assert by_query[100] == [101, 102, 103] and by_query[200] == [201, 202]
    assert len(by_query[0]) == 3 and max(by_query[0]) < 100


def test_very_large_and_very_small_vectors_link(spark):
    rows = [(i, [s * x for x in (1.0, 2.0, -1.0)]) for i, s in enumerate((1e200, 3e200, 1e-200, 1.0))]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = cover_tree.near_duplicates(table, cosine=0.95).collect()
    assert {(r["n_links"], r["component_id"]) for r in got} == {(3, 0)}
