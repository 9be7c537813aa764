"""Fixity of WARC replicas by Merkle trees.

A replica's records are hashed where they lie; only digests and lengths move. A leaf is a record
with its offset range, at a place that its id gives it, so that a lost record leaves the others
where they are. Records of one id, and those of none, are told apart by their digest, whose first
digits make two levels of nodes, so that no group of them has to fit one task; equal records are
one leaf with a count. In each archive file a node hashes ``fanout`` nodes below it and spans
their range, above the files nodes group files, and one root is above all. An audit compares
roots and then, level by level, only children of nodes that differ, down to the records.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metricwin.llm.common import table

END = "\r\n"


def warc_record(page_id: Column, url: Column, payload: Column) -> Column:
    """A WARC/1.1 resource record; null parts are empty."""
    none = F.lit("")
    body = F.coalesce(payload, none)
    head = [
        F.lit("WARC/1.1" + END + "WARC-Type: resource" + END + "WARC-Record-ID: <urn:page:"),
        F.coalesce(page_id.cast("string"), none),
        F.lit(">" + END + "WARC-Target-URI: "),
        F.coalesce(url, none),
        F.lit(END + "Content-Type: text/html" + END + "Content-Length: "),
        F.octet_length(body).cast("string"),
        F.lit(END + END),
    ]
    return F.concat(*head, body, F.lit(END + END))


#: The digits of a digest that tell records of one id apart, at the levels above the leaves.
DIGITS = (4, 2, 0)
PLACE = ("kind", "file", "pos", "bucket")


def manifest(pages: DataFrame, per_file: int = 1024) -> DataFrame:
    """Write the leaves of ``page_id, url, html``: place, page_id, begin, end, digest, copies, hash.

    A file holds ``per_file`` consecutive ids in order, each at its ``pos``; records without id are
    of a ``kind`` of their own. Records of one id follow each other by digest, equal ones are one leaf
    with their number in ``copies``. Offsets are bytes from the file's start.
    """
    record = warc_record(F.col("page_id"), F.col("url"), F.col("html"))
    known = F.col("page_id").isNotNull()
    file = F.floor(F.col("page_id") / per_file).cast("long")
    rows = pages.select(
        F.when(known, 0).otherwise(1).alias("kind"),
        F.coalesce(file, F.lit(0)).cast("long").alias("file"),
        F.coalesce(F.col("page_id") - file * per_file, F.lit(0)).cast("long").alias("pos"),
        F.col("page_id").cast("long").alias("page_id"),
        F.sha2(record, 256).alias("digest"),
        F.octet_length(record).cast("long").alias("length"),
    )
    leaves = rows.groupBy(*rows.columns).agg(F.count("*").alias("copies"))
    leaves = leaves.withColumns(
        {"near": F.substring("digest", 1, DIGITS[0]), "bytes": F.col("length") * F.col("copies")}
    )
    leaves = table(leaves, "warc-leaves")
    # Bytes before each group of digests in its file, then within the group.
    near = ("kind", "file", "pos", "near")
    groups = leaves.groupBy(*near).agg(F.sum("bytes").alias("bytes"))
    in_file = Window.partitionBy("kind", "file").orderBy("pos", "near")
    earlier = F.sum("bytes").over(in_file.rowsBetween(Window.unboundedPreceding, -1))
    groups = groups.select(*near, F.coalesce(earlier, F.lit(0)).alias("before"))
    in_group = Window.partitionBy(*near).orderBy("digest", "length")
    upto = F.sum("bytes").over(in_group.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = leaves.withColumn("upto", upto).join(groups, list(near))
    placed = placed.select(
        "kind",
        "file",
        "pos",
        F.concat_ws(":", "digest", "length").alias("bucket"),
        "page_id",
        (F.col("before") + F.col("upto") - F.col("bytes")).alias("begin"),
        (F.col("before") + F.col("upto")).alias("end"),
        "digest",
        "copies",
        F.concat_ws("*", "digest", "copies").alias("hash"),
    )
    return table(placed, "warc-manifest")


@dataclass(frozen=True)
class Tree:
    """``levels`` from the leaves up: place, begin, end, hash. ``ways`` say how each leads on."""

    levels: list[DataFrame]
    ways: list[tuple[Column, ...]]


def ways_up(manifests: list[DataFrame], per_file: int, fanout: int) -> list[tuple[Column, ...]]:
    """For each level the place of a node's parent; the same for all replicas that are compared.

    First by ever fewer digits of the digest, then by place in the file, then by file, then all.
    """
    tops = [m.agg(F.max(F.abs("file")).alias("f")).first()["f"] or 0 for m in manifests]
    kind, file, pos = F.col("kind"), F.col("file"), F.col("pos")
    none, start = F.lit(""), F.lit(0).cast("long")
    ways = [(kind, file, pos, F.substring("bucket", 1, n) if n else none) for n in DIGITS]
    places, files = per_file, max(tops) + 1
    while places > 1:
        ways.append((kind, file, F.floor(pos / fanout).cast("long"), none))
        places = -(-places // fanout)
    while files > 1:
        ways.append((kind, F.floor(file / fanout).cast("long"), start, none))
        files = -(-files // fanout)
    # What is left are the kinds, and files below and from zero.
    return [*ways, (F.lit(0), start, start, none)]


def _above(nodes: DataFrame, way: tuple[Column, ...]) -> DataFrame:
    """The parents of nodes, each the hash of its children's in order."""
    up = [c.alias(f"up_{name}") for c, name in zip(way, PLACE, strict=True)]
    children = F.sort_array(F.collect_list(F.struct(*PLACE, "hash")))
    joined = F.array_join(F.transform(children, lambda c: c["hash"]), "")
    parents = (
        nodes.select(*nodes.columns, *up)
        .groupBy(*[f"up_{name}" for name in PLACE])
        .agg(F.min("begin").alias("begin"), F.max("end").alias("end"), F.sha2(joined, 256).alias("hash"))
    )
    return parents.withColumnsRenamed({f"up_{name}": name for name in PLACE})


def tree(leaves: DataFrame, ways: list[tuple[Column, ...]]) -> Tree:
    """Every level is written, so that an audit reads only what it descends to."""
    levels = [leaves]
    for way in ways:
        levels.append(table(_above(levels[-1], way), "warc-tree"))
    return Tree(levels, ways)


def _differing_leaves(first: Tree, second: Tree) -> DataFrame:
    """Leaves that differ, found by descending mismatching branches only."""
    shown = ("page_id", "begin", "end", "digest", "copies", "hash")
    frontier = None
    for level in range(len(first.levels) - 1, -1, -1):
        sides = []
        for tree_, tag in ((first, "a"), (second, "b")):
            nodes = tree_.levels[level]
            if frontier is not None:
                way = zip(tree_.ways[level], PLACE, strict=True)
                nodes = nodes.select(*nodes.columns, *[c.alias(f"up_{name}") for c, name in way])
                nodes = nodes.join(frontier, [f"up_{name}" for name in PLACE], "left_semi")
            names = shown if not level else ("hash",)
            sides.append(nodes.select(*PLACE, *[F.col(c).alias(f"{c}_{tag}") for c in names]))
        found = sides[0].join(sides[1], list(PLACE), "full_outer")
        found = found.where(~F.col("hash_a").eqNullSafe(F.col("hash_b")))
        if level:
            up = [F.col(name).alias(f"up_{name}") for name in PLACE]
            frontier = table(found.select(*up), "warc-frontier")
    return table(found, "warc-differing")


def audit(first: Tree, second: Tree) -> DataFrame:
    """Records at which two replicas differ; both trees are made with the same ways up.

    Rows: kind, file, page_id, and of each replica offset range, digest and copies; status is
    ``differs`` where an id has one record on each side that the other lacks, else each such record is
    ``missing`` (in the second) or ``extra``, and one that both have ``repeated`` if not as often.
    """
    found = _differing_leaves(first, second)
    sides = [f"{c}_{tag}" for tag in "ab" for c in ("begin", "end", "digest", "copies")]
    out = ("kind", "file", "page_id", *sides)
    found = found.withColumn("page_id", F.coalesce("page_id_a", "page_id_b"))
    of_id = ("kind", "file", "pos")
    # One row per damaged id, whatever its records are.
    per_id = found.groupBy(*of_id).agg(
        (
            (F.count("*") == 2) & (F.count("digest_a") == 1) & (F.count("digest_b") == 1)
        ).alias("paired"),
        F.max("page_id").alias("page_id"),
        *[F.max(c).alias(c) for c in sides],
    )
    per_id = table(per_id, "warc-damaged")
    changed = per_id.where("paired and kind = 0").select(*out, F.lit("differs").alias("status"))
    rest = found.join(per_id.where("not paired or kind = 1").select(*of_id), list(of_id), "left_semi")
    status = F.when(F.col("digest_b").isNull(), "missing").when(F.col("digest_a").isNull(), "extra")
    return changed.union(rest.select(*out, status.otherwise("repeated").alias("status")))


def compare(first: DataFrame, second: DataFrame, per_file: int = 1024, fanout: int = 16) -> DataFrame:
    """Audit two replicas given as tables of ``page_id, url, html``.

    Rows: file (null without an id), page_id, begin, end, digest and copies of each replica, status;
    see ``audit``. A lost, added or repeated record is one row and moves no other. Null payloads and
    urls are empty; repeated rows are copies; records without id are told apart by digest alone;
    ids may be negative; other columns are ignored; two empty replicas agree.
    """
    manifests = [manifest(first, per_file), manifest(second, per_file)]
    ways = ways_up(manifests, per_file, fanout)
    found = audit(*[tree(m, ways) for m in manifests])
    file = F.when(F.col("kind") == 0, F.col("file"))
    return found.withColumn("file", file).drop("kind")
