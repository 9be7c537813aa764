"""Embedding near-duplicates by dual traversal of cover trees: exact threshold pairs.

Equal vectors are one class. Classes go to the nearest of a few centres, whose cells are cut into
blocks of bounded size, and every block is built into a cover tree: nested levels whose radii halve.
Of a tree only those subtrees are sent to the blocks of another cell that hold a vector which may
have a link there: the cell's covering ball and the plane half way between both centres must come
within the threshold. Two trees are walked together, level by level: a pair of nodes
farther apart than both covering radii and the threshold is dropped with all below it, one that is
nearer by as much is linked whole, and what is left goes on to the children. Single vectors are
compared by their cosine itself.

Only counts and, for each block pair, a spanning set of links leave a task, never all pairs.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metricwin.llm.common import matrix, table
from metricwin.llm.components import components

#: Radii of the levels on the unit sphere; below the last every vector is its own node.
RADII = (2.0, 1.0, 0.5, 0.25, 0.125, 0.0625)
SLACK = 1e-9
#: More than a distance taken from a product in double precision can be off.
BALL_SLACK = 1e-7
#: More than a product of two unit vectors in single precision can be off.
ROUNDING = 1e-5
ROWS = 128
#: A block's vectors, in bytes, unless its rows are given.
BLOCK_BYTES = 4 << 20


def unit(v: np.ndarray) -> np.ndarray:
    return v / np.sqrt((v**2).sum(1))[:, None]


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of unit vectors."""
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


def net(u: np.ndarray, radius: float) -> np.ndarray:
    """For each row the row of its centre: greedy, the first row is one, centres are kept apart."""
    centre = np.full(len(u), -1)
    centres: list[int] = []
    for at in range(0, len(u), 256):
        rows = np.arange(at, min(at + 256, len(u)))
        if centres:
            d = distances(u[rows], u[centres])
            near = d.argmin(1)
            inside = d[np.arange(len(rows)), near] <= radius
            centre[rows[inside]] = np.array(centres)[near[inside]]
        left = rows[centre[rows] < 0]
        if len(left) > 1:
            among = distances(u[left], u[left])
        while len(left):
            if len(left) == 1:
                centre[left] = left
                centres.append(int(left[0]))
                break
            inside = among[0] <= radius
            inside[0] = True
            centre[left[inside]] = left[0]
            centres.append(int(left[0]))
            left, among = left[~inside], among[~inside][:, ~inside]
    return centre


def build(u: np.ndarray) -> np.ndarray:
    """The cover tree of unit vectors: for every level (rows) the centre of each vector.

    The first level is one node around all; each level splits the nodes of the last one, whose
    centres stay centres; at the level after the last radius every vector is its own centre.
    """
    levels = [np.zeros(len(u), np.int64)]
    for radius in RADII[1:]:
        above, here = levels[-1], np.empty(len(u), np.int64)
        order = np.argsort(above, kind="stable")
        for members in np.split(order, np.flatnonzero(np.diff(above[order])) + 1):
            if len(members) == 1:
                here[members] = members
                continue
            own = above[members[0]]
            members = np.concatenate([[own], members[members != own]])
            here[members] = members[net(u[members], radius)]
        levels.append(here)
    levels.append(np.arange(len(u)))
    return np.stack(levels)


@dataclass
class Level:
    """Nodes of one level: centre rows, covering radii, each row's node, each node's parent."""

    centres: np.ndarray
    radii: np.ndarray
    node_of: np.ndarray
    parent: np.ndarray


def levels_of(u: np.ndarray, path: np.ndarray) -> list[Level]:
    out: list[Level] = []
    for depth, centre in enumerate(path):
        centres, node_of = np.unique(centre, return_inverse=True)
        radii = np.zeros(len(centres))
        rest = np.flatnonzero(centre != np.arange(len(u)))
        d = np.sqrt(((u[rest] - u[centre[rest]]) ** 2).sum(1))
        np.maximum.at(radii, node_of[rest], d)
        if depth == len(path) - 1:
            radii[:] = 0
        parent = out[-1].node_of[centres] if out else np.zeros(len(centres), np.int64)
        out.append(Level(centres, radii, node_of, parent))
    return out


class Links:
    """Weighted link counts of the rows of two blocks, and which rows hang together."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights
        self.counts = np.zeros(len(weights), np.int64)
        self.edges: list[tuple[np.ndarray, np.ndarray]] = []

    def labels(self) -> np.ndarray:
        """The smallest row each row reaches over the edges."""
        label = np.arange(len(self.weights))
        if not self.edges:
            return label
        a = np.concatenate([x for x, _ in self.edges])
        b = np.concatenate([y for _, y in self.edges])
        while True:
            low = np.minimum(label[a], label[b])
            new = label.copy()
            np.minimum.at(new, a, low)
            np.minimum.at(new, b, low)
            np.minimum.at(new, label[a], low)
            np.minimum.at(new, label[b], low)
            new = new[new]
            if (new == label).all():
                return label
            label = new


def traverse(
    va: np.ndarray,
    vb: np.ndarray,
    path_a: np.ndarray,
    path_b: np.ndarray,
    wa: np.ndarray,
    wb: np.ndarray,
    cosine: float,
    same: bool,
) -> Links:
    """Walk two trees together; rows of ``a`` come first in the result, then those of ``b``.

    With ``same`` both are one block, given once: every pair is seen from both sides, and a row is
    not linked with itself.
    """
    ua, ub = unit(va), unit(vb)
    la, lb = levels_of(ua, path_a), levels_of(ub, path_b)
    reach = math.sqrt(max(0.0, 2 - 2 * cosine))
    n = len(va)
    links = Links(wa if same else np.concatenate([wa, wb]))
    shift = 0 if same else n
    norm_a, norm_b = np.sqrt((va**2).sum(1)), np.sqrt((vb**2).sum(1))
    # The pairs of nodes that are still open, one level above.
    p, q = np.zeros(1, np.int64), np.zeros(1, np.int64)
    last = len(la) - 1
    for depth, (x, y) in enumerate(zip(la, lb, strict=True)):
        if not len(p):
            break
        going: list[tuple[np.ndarray, np.ndarray]] = []
        for i, j, d in _near(ua[x.centres], ub[y.centres], x, y, p, q, reach):
            if depth == last:
                i, j = x.centres[i], y.centres[j]
                cos = (va[i] * vb[j]).sum(1) / (norm_a[i] * norm_b[j])
                linked = (cos >= cosine) & ~(same & (i == j))
                i, j = i[linked], j[linked]
                np.add.at(links.counts, i, wb[j])
                if not same:
                    np.add.at(links.counts, j + n, wa[i])
                links.edges.append((i, j + shift))
                continue
            whole = d + x.radii[i] + y.radii[j] <= reach - SLACK
            _link_whole(links, x, y, i[whole], j[whole], wa, wb, n, same)
            going.append((i[~whole], j[~whole]))
        if depth < last:
            none = [np.zeros(0, np.int64)]
            p = np.concatenate(none + [i for i, _ in going])
            q = np.concatenate(none + [j for _, j in going])
    return links


def _children(parent: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nodes by parent: their order, where each parent's begin, and how many it has."""
    sizes = np.bincount(parent, minlength=n)
    return np.argsort(parent, kind="stable"), np.cumsum(sizes) - sizes, sizes


def _expand(x: Level, y: Level, p: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of a child of ``p`` and a child of ``q``."""
    order_x, first_x, size_x = _children(x.parent, int(p.max()) + 1)
    order_y, first_y, size_y = _children(y.parent, int(q.max()) + 1)
    each = size_x[p] * size_y[q]
    pair = np.repeat(np.arange(len(p)), each)
    nth = np.arange(len(pair)) - np.repeat(np.cumsum(each) - each, each)
    i = order_x[first_x[p[pair]] + nth // size_y[q[pair]]]
    j = order_y[first_y[q[pair]] + nth % size_y[q[pair]]]
    return i, j


def _near(
    a: np.ndarray, b: np.ndarray, x: Level, y: Level, p: np.ndarray, q: np.ndarray, reach: float
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of the children of open pairs those whose balls come within ``reach``, and their distance.

    Where they are many, products in single precision first drop those that are far by more than
    their rounding; what is left is measured in double precision.
    """
    sizes_x = np.bincount(x.parent, minlength=int(p.max()) + 1)
    sizes_y = np.bincount(y.parent, minlength=int(q.max()) + 1)
    total = int((sizes_x[p] * sizes_y[q]).sum())
    if total < 0.02 * len(a) * len(b):
        found = iter([_expand(x, y, p, q)])
    else:
        found = _near_products(a, b, x, y, p, q, reach, total == len(a) * len(b))
    for i, j in found:
        for at in range(0, len(i), 1 << 17):
            k, m = i[at : at + (1 << 17)], j[at : at + (1 << 17)]
            d = np.sqrt(((a[k] - b[m]) ** 2).sum(1))
            near = d <= x.radii[k] + y.radii[m] + reach + SLACK
            yield k[near], m[near], d[near]


def _near_products(
    a: np.ndarray,
    b: np.ndarray,
    x: Level,
    y: Level,
    p: np.ndarray,
    q: np.ndarray,
    reach: float,
    all_open: bool,
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs that single precision cannot tell to be far, some rows at a time."""
    if not all_open:
        above = np.zeros((int(x.parent.max()) + 1, int(y.parent.max()) + 1), bool)
        above[p, q] = True
    # Nodes of one vector have no radius, so that a row has one bound for all of them.
    order = np.argsort(y.radii > 0, kind="stable")
    single = int((y.radii == 0).sum())
    wide = y.radii[order[single:]]
    a32, b32 = a.astype(np.float32), b[order].astype(np.float32).T.copy()
    for at in range(0, len(a), ROWS):
        dots = a32[at : at + ROWS] @ b32
        bound = x.radii[at : at + ROWS, None] + reach + SLACK
        near = np.empty(dots.shape, bool)
        least = (1 - bound**2 / 2 - ROUNDING).astype(np.float32)
        np.greater_equal(dots[:, :single], least, out=near[:, :single])
        near[:, single:] = dots[:, single:] >= 1 - (bound + wide) ** 2 / 2 - ROUNDING
        if not all_open:
            near &= above[x.parent[at : at + ROWS]][:, y.parent[order]]
        flat = np.flatnonzero(near)
        yield flat // near.shape[1] + at, order[flat % near.shape[1]]


def _link_whole(links, x: Level, y: Level, p, q, wa, wb, n: int, same: bool) -> None:
    """Link every row of each node in ``p`` with every row of its node in ``q``."""
    if not len(p):
        return
    sum_a = np.bincount(x.node_of, wa, len(x.centres)).astype(np.int64)
    sum_b = np.bincount(y.node_of, wb, len(y.centres)).astype(np.int64)
    gain_a = np.bincount(p, sum_b[q], len(x.centres)).astype(np.int64)
    links.counts[:n] += gain_a[x.node_of]
    touched_a = np.isin(x.node_of, p)
    rows = np.flatnonzero(touched_a)
    partner = np.zeros(len(x.centres), np.int64)
    partner[p] = y.centres[q]
    shift = 0 if same else n
    links.edges.append((rows, partner[x.node_of[rows]] + shift))
    links.edges.append((x.centres[p], y.centres[q] + shift))
    if same:
        # A node met itself: its rows counted themselves.
        itself = np.zeros(len(x.centres), bool)
        itself[p[p == q]] = True
        links.counts[:n] -= np.where(itself[x.node_of], wa, 0)
        return
    gain_b = np.bincount(q, sum_a[p], len(y.centres)).astype(np.int64)
    links.counts[n:] += gain_b[y.node_of]
    rows = np.flatnonzero(np.isin(y.node_of, q))
    partner = np.zeros(len(y.centres), np.int64)
    partner[q] = x.centres[p]
    links.edges.append((rows + n, partner[y.node_of[rows]]))


def _usable(values: pa.Array) -> np.ndarray | None:
    """A vector as doubles, None if it is zero, empty or holds null or non-finite components.

    One whose squares would run over or under is scaled by a power of two, which leaves its
    direction as it is.
    """
    if not len(values) or values.null_count:
        return None
    v = values.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0
    if not np.isfinite(v).all():
        return None
    largest = float(np.abs(v).max())
    if not largest:
        return None
    if not 1e-100 < largest < 1e100:
        v = np.ldexp(v, -math.frexp(largest)[1])
    return v


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as doubles with a key of their bytes, null for those that take no part."""
    for batch in batches:
        keys, vectors = [], []
        for i, cell in zip(
            batch.column("vec_id").to_pylist(), batch.column("embedding"), strict=True
        ):
            v = None if i is None or cell.values is None else _usable(cell.values)
            keys.append(None if v is None else hashlib.blake2b(v, digest_size=16).hexdigest())
            vectors.append(v)
        columns = [
            batch.column("vec_id"),
            pa.array(keys, pa.string()),
            pa.array(vectors, pa.list_(pa.float64())),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "key", "v"])


def _spread(u: np.ndarray, k: int) -> np.ndarray:
    """``k`` rows far apart: each next one is the farthest from those before it."""
    chosen = [0]
    nearest = distances(u, u[:1])[:, 0]
    while len(chosen) < min(k, len(u)):
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, distances(u, u[chosen[-1:]])[:, 0])
    return u[chosen]


CLASS_SCHEMA = "class long, weight long, v array<double>, cell int, far double"
BLOCK_SCHEMA = (
    "block long, nth int, class long, weight long, v array<double>, path array<int>,"
    " reached array<long>"
)
LINK_SCHEMA = "class long, links long, label long"


def near_duplicates(
    vectors: DataFrame,
    cosine: float = 0.95,
    block: int | None = None,
    most_cells: int = 1024,
    sample: int = 4096,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vec_id, embedding``.

    n_links: other rows with a cosine of ``cosine`` or more, in double precision; component_id: the
    smallest vec_id reachable over links, itself included; kept: vec_id is component_id. Centres
    are taken from the ``sample`` classes whose key is lowest and only guide which blocks meet;
    the result does not depend on them. A block has about ``block`` rows, by default as many as
    take 4 MB.

    Vectors that are null, empty, zero, hold null or non-finite components, or have no vec_id link
    with nothing: no links, their own component. Vectors of different lengths do not link; each
    length (few are expected) is gone through in turn. Repeated rows are rows of their own, linked
    with each other. Other columns are ignored, labels too; no rows
    give no rows.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    rows = table(
        rows.mapInArrow(_keyed, "vec_id long, key string, v array<double>"), "cover-vectors"
    )
    classes = (
        rows.where("key is not null")
        .groupBy("key")
        .agg(
            F.count("*").alias("weight"), F.min("vec_id").alias("first"), F.first("v").alias("v")
        )
        .withColumn("class", F.monotonically_increasing_id())
    )
    classes = table(classes, "cover-classes")
    dims = classes.select(F.size("v").alias("dim")).distinct().orderBy("dim").collect()
    parts = [
        _links(spark, classes.where(F.size("v") == d["dim"]), d["dim"], cosine, block, most_cells, sample)
        for d in dims
    ]
    linked = reduce(DataFrame.union, parts) if parts else spark.createDataFrame([], LINK_SCHEMA)
    hung = linked.where("label != class").select(F.col("class").alias("u"), F.col("label").alias("v"))
    roots = components(hung, "cover").withColumnRenamed("node", "class")
    counts = linked.groupBy("class").agg(F.sum("links").alias("links"))
    full = (
        classes.select("class", "key", "weight", "first")
        .join(counts, "class", "left")
        .join(roots, "class", "left")
        .withColumn("root", F.coalesce("root", "class"))
    )
    full = table(full, "cover-linked")
    least = full.groupBy("root").agg(F.min("first").alias("component_id"))
    of_key = table(
        full.join(least, "root").select(
            "key",
            (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
            "component_id",
        ),
        "cover-keys",
    )
    sound = rows.where("key is not null").join(of_key, "key")
    out = ("vec_id", "n_links", "component_id")
    alone = rows.where("key is null").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return (
        sound.select(*out)
        .union(alone)
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
    )


@dataclass
class Cells:
    """The centres, and for each cell its covering radius (below 0: empty) and number of blocks."""

    centres: np.ndarray
    far: np.ndarray
    parts: list[int]


def reached(u: np.ndarray, path: np.ndarray, cells: Cells, reach: float) -> np.ndarray:
    """Bits of the cells each row of a tree has to be sent to, 64 in a word.

    A vector within ``reach`` of one in another cell is within that of the cell's ball, and of the
    plane half way between its nearest centre and the cell's. Centres of nodes go along with any
    of their rows, so that what is sent is a tree again.
    """
    k = len(cells.centres)
    between = distances(cells.centres, cells.centres)
    bits = np.zeros((len(u), -(-k // 64) * 64), bool)
    for at in range(0, len(u), 2048):
        square = np.maximum(2 - 2 * (u[at : at + 2048] @ cells.centres.T), 0)
        own = square.argmin(1)
        least = square[np.arange(len(own)), own][:, None]
        bits[at : at + 2048, :k] = (np.sqrt(square) <= cells.far + reach + BALL_SLACK) & (
            square - least <= 2 * between[own] * reach + BALL_SLACK
        )
    words = np.packbits(bits, axis=1, bitorder="little").view(np.int64)
    out = words.copy()
    for centre in path:
        order = np.argsort(centre, kind="stable")
        starts = np.flatnonzero(np.diff(centre[order], prepend=-1))
        out[centre[order][starts]] |= np.bitwise_or.reduceat(words[order], starts)
    return out


def plant(
    classes: DataFrame, dim: int, cosine: float, block: int, most_cells: int, sample: int
) -> tuple[DataFrame, Cells]:
    """Trees of all blocks as rows, written, and the cells the blocks belong to."""
    n = classes.count()
    picked = classes.orderBy("key").limit(sample).select("v").collect()
    centres = _spread(unit(np.array([r["v"] for r in picked])), max(1, min(n // block, most_cells)))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            d = distances(unit(matrix(batch.column("v"), dim)), centres)
            cell = d.argmin(1)
            columns = [
                *batch.columns,
                pa.array(cell.astype(np.int32)),
                pa.array(d[np.arange(len(cell)), cell]),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "cell", "far"])

    placed = classes.select("class", "weight", "v").mapInArrow(assign, CLASS_SCHEMA)
    placed = table(placed, "cover-cells")
    # One row for each centre, of which there are most_cells at most.
    sizes = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("far")).collect()
    cells = Cells(centres, np.full(len(centres), -math.inf), [0] * len(centres))
    for r in sizes:
        cells.far[r["cell"]] = r["far"]
        cells.parts[r["cell"]] = max(1, round(r["n"] / block))
    reach = math.sqrt(max(0.0, 2 - 2 * cosine))

    def grow(rows: pa.Table) -> pa.Table:
        u = unit(matrix(rows.column("v"), dim))
        path = build(u)
        return pa.table(
            {
                "block": rows.column("block"),
                "nth": np.arange(rows.num_rows, dtype=np.int32),
                "class": rows.column("class"),
                "weight": rows.column("weight"),
                "v": rows.column("v"),
                "path": pa.array(list(path.T.astype(np.int32)), pa.list_(pa.int32())),
                "reached": pa.array(
                    list(reached(u, path, cells, reach)), pa.list_(pa.int64())
                ),
            }
        )

    number = _block("cell", F.pmod(F.xxhash64("class"), _parts(cells, F.col("cell"))))
    planted = placed.select(number.alias("block"), "class", "weight", "v")
    return table(planted.groupBy("block").applyInArrow(grow, BLOCK_SCHEMA), "cover-blocks"), cells


def _block(cell: str, part: Column) -> Column:
    """A block's number: the cell's and the part's."""
    return F.col(cell).cast("long") * F.lit(1 << 32) + part


def _parts(cells: Cells, cell: Column) -> Column:
    return F.get(F.array(*map(F.lit, cells.parts)), cell)


def sent(planted: DataFrame, cells: Cells) -> DataFrame:
    """Rows of trees, once for every pair of blocks they go to: ``left, right`` and their own."""
    cell = F.explode(
        F.filter(
            F.sequence(F.lit(0), F.lit(len(cells.parts) - 1)),
            lambda c: F.getbit(F.get("reached", F.shiftright(c, 6)), F.pmod(c, F.lit(64))) == 1,
        )
    )
    rows = planted.select("block", "nth", "class", "weight", "v", "path", cell.alias("cell"))
    part = F.explode(F.sequence(F.lit(0), _parts(cells, F.col("cell")) - 1))
    rows = rows.withColumn("part", part).withColumn("other", _block("cell", F.col("part")))
    return rows.select(
        F.least("block", "other").alias("left"),
        F.greatest("block", "other").alias("right"),
        *("block", "nth", "class", "weight", "v", "path"),
    )


def _links(
    spark: SparkSession,
    classes: DataFrame,
    dim: int,
    cosine: float,
    block: int | None,
    most_cells: int,
    sample: int,
) -> DataFrame:
    """For block pairs: class, weight of the classes linked with it there, and its label there."""
    block = block or max(1, BLOCK_BYTES // (8 * dim))
    planted, cells = plant(classes, dim, cosine, block, most_cells, sample)

    def meet(rows: pa.Table) -> pa.Table:
        own = rows.column("block").to_numpy()
        left, right = rows.column("left")[0].as_py(), rows.column("right")[0].as_py()
        v = matrix(rows.column("v"), dim)
        path = rows.column("path").combine_chunks().flatten().to_numpy().reshape(len(v), -1)
        weight, nth = rows.column("weight").to_numpy(), rows.column("nth").to_numpy()
        ids = rows.column("class").to_numpy()

        def side(which: int) -> tuple[np.ndarray, np.ndarray]:
            """Rows of a tree in order, and their paths by the places of those rows."""
            at = np.flatnonzero(own == which)
            at = at[np.argsort(nth[at])]
            return at, np.searchsorted(nth[at], path[at]).T

        (a, path_a), (b, path_b) = side(left), side(right)
        if not len(a) or not len(b):
            return pa.table({c: pa.array([], pa.int64()) for c in ("class", "links", "label")})
        links = traverse(
            v[a], v[b], path_a, path_b, weight[a], weight[b], cosine, left == right
        )
        names = ids[a] if left == right else np.concatenate([ids[a], ids[b]])
        label = names[links.labels()]
        said = (links.counts > 0) | (label != names)
        return pa.table(
            {"class": names[said], "links": links.counts[said], "label": label[said]}
        )

    met = sent(planted, cells).groupBy("left", "right").applyInArrow(meet, LINK_SCHEMA)
    return table(met, "cover-links")
