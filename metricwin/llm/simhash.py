"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint has 64 bits. To find all pairs within ``d`` bits it is cut into only ``d // 2 + 1``
segments: in any such pair some segment differs by at most one bit. The index holds the exact
segments and the variants with one bit deleted (a set bit cleared), so that an equality join finds
every pair whose segments are equal or one bit apart, once; the whole fingerprints verify it.

Only distinct fingerprints are joined, so copies cost nothing. A segment value that more than
``crowd`` fingerprints share would pair them all; these fingerprints, and those that reach them
with a variant, are linked through keys with ``d`` bits masked instead: fingerprints that share
such a key are within ``d`` bits, at most ``2 ** d`` can share one, and every close pair does.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricwin.llm.common import few_or_merged, merged, small_batches, table
from metricwin.llm.components import components

BITS = 64
CHUNK = 1 << 18
#: For each byte its eight bits, lowest first.
BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """The fingerprint of a whole text; 0 if it has no word.

    Words are runs of characters other than ASCII white space, A-Z lower-cased; a shingle is
    ``shingle`` words with single spaces, or the whole sequence if there are fewer. A bit is set if
    it is set in over half of the shingles' XXH64, repeats included.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    begin = np.cumsum(sizes + 1) - sizes - 1
    end = begin + sizes
    n = max(1, len(words) - shingle + 1)
    begin, end = begin[:n], end[min(shingle, len(words)) - 1 :]
    counts = np.zeros((8, 8), np.int64)
    of = xxhash.xxh64_intdigest
    for at in range(0, n, CHUNK):
        spans = zip(begin[at : at + CHUNK].tolist(), end[at : at + CHUNK].tolist(), strict=True)
        hashes = np.array([of(joined[a:b], seed) for a, b in spans], "<u8").view(np.uint8)
        for k in range(8):
            counts[k] += np.bincount(hashes[k::8], minlength=256) @ BYTE_BITS.astype(np.int64)
    set_bits = (2 * counts > n).astype(np.uint8).reshape(-1)
    return int(np.packbits(set_bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, also: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id`` and ``fp``, the fingerprint as a signed 64-bit integer, for every row.

    ``also`` names long columns that are handed on.
    """
    names = ["doc_id", "fp", *also]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            found = np.fromiter(
                (fingerprint(t.as_py(), shingle) for t in texts), np.uint64, len(texts)
            )
            columns = [batch.column("doc_id"), pa.array(found.view(np.int64))]
            columns += [batch.column(c) for c in also]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text", *also)
    return rows.mapInArrow(run, ", ".join(f"{c} long" for c in names))


def _segments(distance: int) -> list[tuple[int, int]]:
    """(lowest bit, bits) of each segment; fewer than one for two differing bits cannot do."""
    n = distance // 2 + 1
    edges = [i * BITS // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _bits(low: int, width: int) -> int:
    """The mask of a segment as a signed 64-bit integer."""
    mask = ((1 << width) - 1) << low
    return mask - (1 << BITS) if mask >= 1 << (BITS - 1) else mask


def _differing(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def links(fps: DataFrame, distance: int = 2, crowd: int = 128) -> DataFrame:
    """Edges ``u < v`` between distinct fingerprints that join all those within ``distance`` bits.

    Every edge is a true one. Outside crowds every close pair is an edge; within them two close
    fingerprints share a masked key, and each is an edge of that key's smallest. ``fps`` is read
    more than once and should be a written table.
    """
    nodes = fps.select("fp").where("fp is not null").distinct()
    parts = _segments(distance)
    exact = [
        F.struct(F.lit(k).alias("seg"), F.col("fp").bitwiseAND(F.lit(_bits(*p))).alias("value"))
        for k, p in enumerate(parts)
    ]
    index = nodes.select("fp", F.inline(F.array(*exact)))
    counts = index.groupBy("seg", "value").agg(F.count("*").alias("members"))
    index = table(index.join(merged(counts), ["seg", "value"]), "simhash-index")
    calm = index.where(F.col("members") <= crowd).select("seg", "value", "fp")
    full = index.where(F.col("members") > crowd)

    def variants(k: int, low: int, width: int) -> Column:
        """The segment with each of its set bits cleared in turn."""
        own = F.col("fp").bitwiseAND(F.lit(_bits(low, width)))
        places = F.array(*[F.lit(_bits(p, 1)) for p in range(low, low + width)])
        here = F.filter(places, lambda bit: own.bitwiseAND(bit) != 0)
        return F.transform(
            here, lambda bit: F.struct(F.lit(k).alias("seg"), own.bitwiseXOR(bit).alias("value"))
        )

    every = F.concat(*[variants(k, *p) for k, p in enumerate(parts)])
    probes = nodes.select(F.col("fp").alias("other"), F.inline(every))
    # A crowded key answers with one row that names no fingerprint.
    keys = full.select("seg", "value", F.lit(None).cast("long").alias("fp")).distinct()
    reached = probes.join(merged(calm.union(keys)), ["seg", "value"]).select("other", "fp")
    close = F.col("fp").isNull() | (_differing(F.col("fp"), F.col("other")) <= distance)
    reached = table(reached.where(close), "simhash-reached")
    others = calm.withColumnRenamed("fp", "other")
    same = calm.join(merged(others), ["seg", "value"]).where("fp < other")
    near = (
        same.select("other", "fp")
        .where(_differing(F.col("fp"), F.col("other")) <= distance)
        .union(reached.where("fp is not null"))
        .select(F.least("fp", "other").alias("u"), F.greatest("fp", "other").alias("v"))
    )
    crowded = full.select("fp").union(reached.where("fp is null").select("other")).distinct()
    return near.union(masked_links(crowded, distance)).distinct()


def masked_links(fps: DataFrame, distance: int) -> DataFrame:
    """Edges ``u < v`` through keys with ``distance`` bits masked; at most 2 ** distance share one."""
    rows = fps.select("fp", F.lit(-1).alias("last"), F.lit(0).cast("long").alias("mask"))
    for _ in range(distance):
        rows = (
            rows.where(F.col("last") < BITS - 1)
            .select("fp", "mask", F.explode(F.expr(f"sequence(last + 1, {BITS - 1})")).alias("last"))
            .select("fp", "last", F.expr("mask | shiftleft(1L, last)").alias("mask"))
        )
    key = F.col("fp").bitwiseAND(F.bitwise_not("mask")).alias("value")
    groups = rows.groupBy("mask", key).agg(F.collect_list("fp").alias("fps"))
    pairs = groups.where(F.size("fps") > 1).select(
        F.array_min("fps").alias("u"), F.explode("fps").alias("v")
    )
    return pairs.where("u < v").distinct()


def near_duplicates(
    docs: DataFrame, distance: int = 2, shingle: int = 3, crowd: int = 128
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``doc_id, text``.

    Rows link if their fingerprints differ in at most ``distance`` bits; component_id is the
    smallest doc_id a row reaches over links, itself included. Equal fingerprints always link.

    Null, empty and wordless texts have fingerprint zero and link like any other. A repeated row is
    kept as often as it occurs. A null doc_id stays null and is never the smallest unless its
    component has no other, whose component_id is then null. Other columns are ignored, whatever
    their names; no documents give no rows.
    """
    fps = table(fingerprints(docs, shingle), "simhash")
    firsts = fps.groupBy("fp").agg(F.min("doc_id").alias("first"))
    linked = components(links(fps, distance, crowd), "simhash").withColumnRenamed("node", "fp")
    linked = table(linked.join(merged(firsts), "fp"), "simhash-linked")
    least = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    named = linked.join(merged(least), "root").select("fp", "component_id")
    of_all = firsts.join(merged(named.withColumn("is_linked", F.lit(True))), "fp", "left").select(
        "fp",
        F.when(F.col("is_linked"), F.col("component_id")).otherwise(F.col("first")).alias("component_id"),
    )
    of_all = table(of_all, "simhash-components")
    return fps.join(merged(of_all), "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one(
    docs: DataFrame, distance: int = 2, shingle: int = 3, crowd: int = 128
) -> DataFrame:
    """One row of ``docs`` for each component: that with the smallest doc_id, null the largest.

    Rows are told apart by a row key, written with them, and not by doc_id: different texts under
    one doc_id all stay, and a copy goes whether or not it has a doc_id. Of a component's rows with
    its smallest doc_id the one with the smallest row key stays. A row with neither doc_id nor text
    is no copy of anything and stays.

    Only the rows to drop are joined with ``docs``, not the rows to keep: they are few, so that
    texts are shuffled only if they are too many to broadcast, by their number and not their files.
    """
    key = "row_key"
    while key in map(str.lower, docs.columns):
        key += "_"
    rows = table(docs.withColumn(key, F.monotonically_increasing_id()), "simhash-rows")
    texts = rows.where("doc_id is not null or text is not null")
    fps = table(fingerprints(texts, shingle, (key,)), "simhash")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", key)
    firsts = fps.groupBy("fp").agg(F.min(order).alias("first"))
    linked = components(links(fps, distance, crowd), "simhash").withColumnRenamed("node", "fp")
    rooted = firsts.join(merged(linked), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    kept = rooted.groupBy("root").agg(F.min("first").alias("first")).select(f"first.{key}")
    dropped = table(fps.select(key).join(merged(kept), key, "left_anti"), "simhash-dropped")
    dropped = few_or_merged(dropped, dropped.count())
    return rows.join(dropped, key, "left_anti").select(docs.columns)
