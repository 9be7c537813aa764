"""Nearest neighbours with an inverted multi-index.

Vectors are cut in two halves, each quantised with its own centroids; a cell is a pair of
centroids. A query walks the pairs in ascending summed squared distance with a heap until the
cells it has met hold a set share of all entries, and those entries are reranked by their exact
distance. Entries and queries of a cell meet in blocks of bounded size on both sides.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metricwin.llm.common import clean_vector, lengths, matrix, table

ENTRY_SCHEMA = "vec_id long, v array<double>, cell int, salt int"
PROBE_SCHEMA = "vec_id long, v array<double>, cell int, salt int"
FOUND_SCHEMA = "query_id long, vec_id long, score double"
SALTS = 1 << 20
#: Probes handed back at a time; each carries its query's vector.
PROBES = 4096


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared Euclidean distances of all rows of ``a`` to all of ``b``."""
    d = (a**2).sum(1)[:, None] - 2 * (a @ b.T) + (b**2).sum(1)
    return np.maximum(d, 0)


def centroids(sample: np.ndarray, k: int, rounds: int = 15) -> np.ndarray:
    """Lloyd's rounds from the first ``k`` distinct rows; an empty cluster keeps its centre."""
    _, first = np.unique(sample, axis=0, return_index=True)
    centres = sample[np.sort(first)[:k]].copy()
    for _ in range(rounds):
        nearest = squared(sample, centres).argmin(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        sizes = np.bincount(nearest, minlength=len(centres))
        full = sizes > 0
        centres[full] = sums[full] / sizes[full, None]
    return centres


def walk(
    first: np.ndarray,
    second: np.ndarray,
    sizes: np.ndarray,
    enough: float,
    ids: dict[int, list[int]] | None = None,
    own: int | None = None,
    least: int = 0,
) -> list[int]:
    """Cells in ascending ``first[i] + second[j]`` until their sizes sum to ``enough`` and their
    ``ids`` are ``least`` different ones besides ``own``, or no cell is left.

    The multi-sequence walk: a pair enters the heap once both its predecessors were taken.
    """
    by_first, by_second = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    a, b = first[by_first], second[by_second]
    taken = np.zeros((len(a), len(b)), bool)
    heap, cells, total = [(float(a[0] + b[0]), 0, 0)], [], 0.0
    met: set[int] = set()
    while heap and (total < enough or len(met) < least):
        _, i, j = heapq.heappop(heap)
        taken[i, j] = True
        cell = int(by_first[i]) * len(b) + int(by_second[j])
        if sizes[cell]:
            cells.append(cell)
            total += float(sizes[cell])
            if len(met) < least:
                met.update(i for i in ids[cell] if i != own)
        if i + 1 < len(a) and (j == 0 or taken[i + 1, j - 1]):
            heapq.heappush(heap, (float(a[i + 1] + b[j]), i + 1, j))
        if j + 1 < len(b) and (i == 0 or taken[i - 1, j + 1]):
            heapq.heappush(heap, (float(a[i] + b[j + 1]), i, j + 1))
    return cells


def salts(task: int, places: np.ndarray) -> np.ndarray:
    """For each place of a task's rows a number below ``SALTS`` that spreads over any few parts.

    All bits are mixed (SplitMix64): rows that come back every so many places, in this task or at
    the same places in others, would else meet in some parts and leave others empty.
    """
    z = (places.astype(np.uint64) + np.uint64(task << 40)) * np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((z ^ (z >> np.uint64(31))) % np.uint64(SALTS)).astype(np.int32)


def nearest_of_block(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, entries: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each query's ``k`` nearest distinct ids among the entries, its own id left out."""
    found_q, found_v, found_s = [], [], []
    repeated = len(np.unique(ids)) < len(ids)
    norms = (entries**2).sum(1)
    for at in range(0, len(queries), 256):
        part = queries[at : at + 256]
        rough = (part**2).sum(1)[:, None] - 2 * (part @ entries.T) + norms
        slack = 1e-9 * (1 + np.abs(rough).max(initial=0))
        for r, (q, qid) in enumerate(zip(part, query_ids[at : at + 256], strict=True)):
            allowed = np.flatnonzero(ids != qid)
            if len(allowed) > k and not repeated:
                kth = np.partition(rough[r, allowed], k - 1)[k - 1]
                allowed = allowed[rough[r, allowed] <= kth + slack]
            score = np.sqrt(((entries[allowed] - q) ** 2).sum(1))
            own = ids[allowed]
            order = np.lexsort((own, score))
            if repeated:
                _, once = np.unique(own[order], return_index=True)
                order = order[np.sort(once)]
            order = order[:k]
            found_q.append(np.full(len(order), qid))
            found_v.append(own[order])
            found_s.append(score[order])
    none = np.zeros(0)
    return (
        np.concatenate([none.astype(np.int64), *found_q]),
        np.concatenate([none.astype(np.int64), *found_v]),
        np.concatenate([none, *found_s]),
    )


def lowest_hashed(sound: DataFrame, n: int) -> list[list[float]]:
    """The vectors of the ``n`` rows whose vec_id hashes lowest, in that order.

    Tasks first agree on the highest hash among them by hashes alone. What comes to the driver is
    read from a table of ``n`` rows: the end of a plan would send it as many from every task.
    """
    hashed = sound.withColumn("place", F.xxhash64("vec_id"))
    highest = hashed.select("place").orderBy("place").limit(n).agg(F.max("place")).scalar()
    lowest = hashed.where(F.col("place") <= F.lit(highest)).orderBy("place", "vec_id").limit(n)
    rows = table(lowest, "multi-sample").collect()
    return [r["v"] for r in sorted(rows, key=lambda r: (r["place"], r["vec_id"]))]


def search(
    vectors: DataFrame,
    is_query,
    k: int = 10,
    centres: int = 16,
    share: float = 0.7,
    sample: int = 16384,
    block: int = 2048,
) -> DataFrame:
    """For each query its ``k`` nearest rows found of ``vec_id, embedding``.

    ``is_query`` is a condition on vec_id. The centroids are fitted on the ``sample`` vectors whose
    vec_id hashes lowest; every row is indexed. A query meets cells until they hold ``share`` of
    all entries, where a cell counts with four mean cells at most, so that one crowded cell does
    not use up the walk, and ``k`` candidates at least if there are so many; all entries of a met
    cell are reranked, crowded or not.

    Returns query_id, rank (from 1), vec_id, score: Euclidean distance in double precision on the
    original vectors, nearest first, ties to the smaller vec_id, the query's own id left out.
    Vectors that are null, zero, hold null or non-finite components, or have no vec_id take no part.
    Vectors of different lengths have no distance: each length (few are expected) has an index of
    its own, gone through in turn. Repeated vec_ids are one candidate at their smallest distance
    and one query. Other columns are ignored; no queries or no other vectors give no rows.
    """
    names = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    names = names.where("vec_id is not null")
    found = [
        _search_length(
            names.where(clean_vector("embedding", dim)), dim, is_query, k, centres, share, sample, block
        )
        for dim in lengths(names, "embedding")
    ]
    if not found:
        return vectors.sparkSession.createDataFrame([], RESULT_SCHEMA)
    if len(found) == 1:
        return found[0]
    # An id with vectors of several lengths is one query: its candidates are ranked together.
    both = reduce(DataFrame.union, found).groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    by_score = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = both.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


RESULT_SCHEMA = "query_id long, rank int, vec_id long, score double"


def _search_length(
    names: DataFrame, dim: int, is_query, k: int, centres: int, share: float, sample: int, block: int
) -> DataFrame:
    """``search`` among sound vectors of one length."""
    spark = names.sparkSession
    sound = names.select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    half = max(1, dim // 2)
    fitted = np.array(lowest_hashed(sound, sample), np.float64)
    first = centroids(fitted[:, :half], centres)
    # One-dimensional vectors have no second half; all are then at its only centre.
    second = centroids(fitted[:, half:], centres) if dim > half else np.zeros((1, 0))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, task = 0, TaskContext.get().partitionId()
        for batch in batches:
            if not batch.num_rows:
                continue
            v = matrix(batch.column("v"), dim)
            a = squared(v[:, :half], first).argmin(1)
            b = squared(v[:, half:], second).argmin(1)
            salt = salts(task, seen + np.arange(len(v)))
            seen += len(v)
            columns = [*batch.columns, pa.array((a * len(second) + b).astype(np.int32))]
            columns.append(pa.array(salt))
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "v", "cell", "salt"])

    entries = table(sound.mapInArrow(assign, ENTRY_SCHEMA), "multi-index")
    sizes = np.zeros(len(first) * len(second))
    for r in entries.groupBy("cell").count().collect():
        sizes[r["cell"]] = r["count"]
    counted = np.minimum(sizes, 4 * sizes.sum() / max(1, (sizes > 0).sum()))
    enough = share * counted.sum()
    # k + 1 ids of a cell tell whether it alone has k besides a query's own.
    lowest = Window.partitionBy("cell").orderBy("vec_id")
    some = entries.select("cell", "vec_id").distinct().withColumn("nth", F.row_number().over(lowest))
    ids: dict[int, list[int]] = {}
    for r in some.where(F.col("nth") <= k + 1).collect():
        ids.setdefault(r["cell"], []).append(r["vec_id"])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            v = matrix(batch.column("v"), dim)
            a, b = squared(v[:, :half], first), squared(v[:, half:], second)
            own = batch.column("vec_id").to_pylist()
            cells = [
                walk(x, y, counted, enough, ids, n, k) for x, y, n in zip(a, b, own, strict=True)
            ]
            row = np.repeat(np.arange(len(v)), [len(c) for c in cells])
            flat = np.array([c for own in cells for c in own], np.int32)
            for at in range(0, len(row), PROBES):
                taken = batch.take(pa.array(row[at : at + PROBES]))
                columns = [taken.column("vec_id"), taken.column("v"), pa.array(flat[at : at + PROBES])]
                columns.append(taken.column("salt"))
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "v", "cell", "salt"])

    queries = entries.where(is_query).select("vec_id", "v", "salt")
    probes = table(queries.mapInArrow(probe, PROBE_SCHEMA), "multi-probes")
    asked = {r["cell"]: r["count"] for r in probes.groupBy("cell").count().collect()}
    # For each cell its blocks of entries and of queries; centres squared rows at most.
    parts = spark.createDataFrame(
        [
            (c, max(1, -(-int(sizes[c]) // block)), max(1, -(-n // block)))
            for c, n in asked.items()
        ],
        "cell int, entry_parts int, query_parts int",
    )

    def blocks(rows: DataFrame, own: str, other: str, queries: bool) -> DataFrame:
        # Spark does not know that the parts are few, and takes probes by their files for fewer.
        sized = rows.join(F.broadcast(parts), "cell")
        return sized.select(
            "cell",
            F.pmod("salt", F.col(own)).alias(own),
            F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other),
            F.lit(queries).alias("is_query"),
            "vec_id",
            "v",
        )

    met = blocks(entries, "entry_parts", "query_parts", False).unionByName(
        blocks(probes, "query_parts", "entry_parts", True)
    )

    def rerank(rows: pa.Table) -> pa.Table:
        asking = rows.column("is_query").combine_chunks().to_numpy(zero_copy_only=False)
        v = matrix(rows.column("v"), dim)
        ids = rows.column("vec_id").to_numpy()
        q, n, s = nearest_of_block(ids[asking], v[asking], ids[~asking], v[~asking], k)
        return pa.table({"query_id": q, "vec_id": n, "score": s})

    found = met.groupBy("cell", "entry_parts", "query_parts").applyInArrow(rerank, FOUND_SCHEMA)
    found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    by_score = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
