"""Concatenate and cut: documents end to end, cut every ``length`` tokens.

The first pass tokenises once and writes ids with running offsets of each partition; a prefix sum
over the partitions' totals gives every document its global offset; the second pass cuts at
multiples of the sequence length and emits a boundary record for every piece. Nothing is shuffled
but one total per partition, and no task sees more than its own rows, so neither a hot source nor
a group of copies can fill one.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from metricwin.llm.tokens import ids_of, part_bases, token_table

PIECE_SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)


def _cut(length: int, keep_ids: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            first = (batch.column("base").to_numpy() + batch.column("local_start").to_numpy()).astype(
                np.int64
            )
            sizes = batch.column("n_tokens").to_numpy().astype(np.int64)
            n_pieces = (first + sizes - 1) // length - first // length + 1
            row = np.repeat(np.arange(len(first)), n_pieces)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
            sequence = first[row] // length + nth
            begin = np.maximum(first[row], sequence * length)
            end = np.minimum(first[row] + sizes[row], (sequence + 1) * length)
            start = begin - first[row]
            crcs, pieces, at, blob = np.zeros(len(row), np.int64), [], -1, b""
            ids = batch.column("ids")
            for k, (r, a, n) in enumerate(zip(row, start, end - begin, strict=True)):
                if r != at:
                    at = r
                    blob = ids_of(ids[int(r)].as_buffer(), int(sizes[r])).astype("<u4").tobytes()
                piece = memoryview(blob)[4 * a : 4 * (a + n)]
                crcs[k] = zlib.crc32(piece)
                if keep_ids:
                    pieces.append(bytes(piece))
            columns = [
                batch.column("doc_id").take(pa.array(row)),
                pa.array(start),
                pa.array(end - begin),
                pa.array(crcs),
                pa.array(sizes[row]),
                pa.array(sequence),
                pa.array(begin - sequence * length),
            ]
            names = [field.split()[0] for field in PIECE_SCHEMA.split(", ")]
            if keep_ids:
                columns.append(pa.array(pieces, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def pack(
    docs: DataFrame, tokenizer: str, end_id: int = 1, length: int = 2048, keep_ids: bool = False
) -> DataFrame:
    """Pack ``doc_id, text`` into sequences of ``length`` tokens; one row for each piece.

    Documents follow each other in the order of the input's partitions, each with ``end_id`` after
    its ids, and are cut wherever a sequence is full; only the last sequence is short, so padding
    is less than one sequence for the whole corpus. A piece is (doc_id, start in its document,
    length, crc32 of its ids as little-endian 32-bit integers, tokens of its document,
    sequence_id, offset in the sequence); ``keep_ids`` adds the ids themselves in that form.

    Null and empty texts are documents of the end id alone. A null doc_id stays null, repeated
    rows are packed once each, other columns are ignored, no documents give no pieces.
    """
    tokens = token_table(docs, tokenizer, end_id, ordered=False, label="packing")
    placed = tokens.join(part_bases(tokens), "part")
    schema = PIECE_SCHEMA + (", ids binary" if keep_ids else "")
    return placed.mapInArrow(_cut(length, keep_ids), schema)
