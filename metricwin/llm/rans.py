"""Token ids in files of static range-ANS blocks, written and read in parallel.

One frequency table, counted over the whole corpus, is shared by all blocks. A block holds whole
documents, is encoded by ``lanes`` interleaved states and decodes without any other block.
Every ``steps`` rounds it keeps a checkpoint (the states and the place in the words), from which
decoding can start, and a checksum of the ids up to the next; a last checksum covers the block.

A block's bytes, little-endian: a header (``HEADER``); for each document its id (8 bytes), whether
it is null (1) and its ids (8); for each checkpoint the place in the words (8), the crc32 of its
ids (4) and its states (8 for each lane); the words (3 each); the crc32 of all that (4). Files are
Parquet tables of such blocks, so Spark writes, commits and reads them on any store.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricwin.llm.common import table
from metricwin.llm.tokens import ids_of, part_bases, token_table

#: magic, version, scale bits, lanes, steps, table checksum, documents, ids, checkpoints, words
HEADER = struct.Struct("<4sHHIIIQQQQ")
MAGIC = b"RBLK"
#: States run from 2 ** 27 up to 2 ** 51 and give words of 24 bits: a word is never less than the
#: scale, so one at most is given or taken in a round, and doubles hold and divide states exactly.
LOWEST = 1 << 27
WORD = 24


@dataclass(frozen=True)
class Frequencies:
    """A static table: ``freq`` of every symbol, summing to ``1 << bits``; absent symbols have 0."""

    freq: np.ndarray
    bits: int

    @staticmethod
    def of(counts: dict[int, int], bits: int = 18) -> Frequencies:
        """Scale counts so that every symbol that occurs keeps a frequency of one at least."""
        if not counts:
            return Frequencies(np.zeros(1, np.uint64), bits)
        symbols = np.array(sorted(counts), np.int64)
        seen = np.array([counts[s] for s in symbols.tolist()], np.float64)
        bits = max(bits, int(len(symbols)).bit_length() + 2)
        if bits > WORD:
            raise ValueError("more symbols than the table's scale can hold")
        scaled = np.maximum(1, np.floor(seen * ((1 << bits) / seen.sum()))).astype(np.int64)
        spare = (1 << bits) - int(scaled.sum())
        order = np.argsort(-seen, kind="stable")
        if spare >= 0:
            scaled[order[0]] += spare
        for i in order:
            if spare >= 0:
                break
            take = min(-spare, int(scaled[i]) - 1)
            scaled[i] -= take
            spare += take
        freq = np.zeros(int(symbols[-1]) + 1, np.uint64)
        freq[symbols] = scaled.astype(np.uint64)
        return Frequencies(freq, bits)

    @property
    def first(self) -> np.ndarray:
        return (np.cumsum(self.freq) - self.freq).astype(np.uint64)

    @property
    def check(self) -> int:
        return zlib.crc32(self.freq.astype("<u8").tobytes() + bytes([self.bits]))

    def symbols(self) -> np.ndarray:
        """The symbol of every slot of the scale."""
        return np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq.astype(np.int64))


@dataclass
class Block:
    doc_ids: np.ndarray
    nulls: np.ndarray
    sizes: np.ndarray
    ids: np.ndarray


#: Ids encoded or decoded at a time, shorter blocks padded to the longest among them.
TOGETHER = 1 << 22


def encode(
    blocks: list[Block], table: Frequencies, lanes: int, steps: int, together: int = TOGETHER
) -> list[bytes]:
    """The bytes of each block. Blocks of like length advance together, ``together`` ids at most
    unless a single block has more, so that a long one pads no others."""
    sizes = np.array([len(b.ids) for b in blocks], np.int64)
    out: list[bytes] = [b""] * len(blocks)
    order = np.argsort(-sizes, kind="stable").tolist()
    while order:
        n = max(1, together // max(1, int(sizes[order[0]])))
        own, order = order[:n], order[n:]
        for i, blob in zip(own, _advance([blocks[i] for i in own], table, lanes, steps), strict=True):
            out[i] = blob
    return out


def _advance(blocks: list[Block], table: Frequencies, lanes: int, steps: int) -> list[bytes]:
    """The bytes of each block, all advancing together, one interleaved round at a time."""
    rounds = np.array([-(-len(b.ids) // lanes) for b in blocks])
    order = np.argsort(-rounds, kind="stable")
    longest = int(rounds[order[0]])
    freq, first = table.freq.astype(np.float64), table.first.astype(np.float64)
    # An absent lane has the whole scale as its frequency, which leaves its state as it is.
    scale = float(1 << table.bits)
    freq, first = np.append(freq, scale), np.append(first, 0.0)
    symbols = np.full((longest, len(blocks), lanes), len(freq) - 1, np.int32)
    for k, b in enumerate(order):
        own = blocks[b].ids
        flat = np.full(int(rounds[b]) * lanes, len(freq) - 1, np.int32)
        flat[: len(own)] = own
        symbols[: rounds[b], k] = flat.reshape(-1, lanes)
    going = np.searchsorted(-rounds[order], -np.arange(longest), side="left")
    state = np.full((len(blocks), lanes), float(LOWEST))
    words = np.zeros((longest, len(blocks), lanes), np.uint32)
    gives = np.zeros((longest, len(blocks), lanes), bool)
    marks = np.zeros((-(-longest // steps), len(blocks), lanes), np.uint64)
    room = float(1 << (27 + WORD - table.bits))
    for t in range(longest - 1, -1, -1):
        g = int(going[t])
        s, x = symbols[t, :g], state[:g]
        f = freq[s]
        give = x >= f * room
        high = np.floor(x * 2.0**-WORD)
        words[t, :g] = x - high * 2.0**WORD
        gives[t, :g] = give
        x = np.where(give, high, x)
        q = np.floor(x / f)
        x -= q * f
        q *= scale
        x += q
        x += first[s]
        state[:g] = x
        if t % steps == 0:
            marks[t // steps, :g] = x
    out: list[bytes] = [b""] * len(blocks)
    for k, b in enumerate(order):
        n, block = int(rounds[b]), blocks[b]
        mine = gives[:n, k]
        own = words[:n, k][mine]
        n_marks = -(-n // steps)
        before = np.concatenate([[0], np.cumsum(mine.sum(axis=1))])
        data = block.ids.astype("<u4")
        crcs = [
            zlib.crc32(data[i * steps * lanes : (i + 1) * steps * lanes].tobytes())
            for i in range(n_marks)
        ]
        body = b"".join(
            [
                HEADER.pack(
                    MAGIC, 1, table.bits, lanes, steps, table.check,
                    len(block.doc_ids), len(block.ids), n_marks, len(own),
                ),
                block.doc_ids.astype("<i8").tobytes(),
                block.nulls.astype("u1").tobytes(),
                block.sizes.astype("<i8").tobytes(),
                before[:n:steps].astype("<u8").tobytes(),
                np.array(crcs, "<u4").tobytes(),
                marks[:n_marks, k].astype("<u8").tobytes(),
                np.ascontiguousarray(own.astype("<u4").view("u1").reshape(-1, 4)[:, :3]).tobytes(),
            ]
        )
        out[b] = body + struct.pack("<I", zlib.crc32(body))
    return out


def decode(blobs: list[bytes | memoryview], table: Frequencies) -> list[Block]:
    """The blocks; all stretches between checkpoints of all blocks advance together.

    A block that was changed, or written with another table, raises ValueError.
    """
    blocks: list[Block] = []
    state, place, size, expected, words, base = [], [], [], [], [], 0
    lanes = steps = 0
    for blob in blobs:
        body, (crc,) = blob[:-4], struct.unpack("<I", blob[-4:])
        if zlib.crc32(body) != crc:
            raise ValueError("block checksum differs")
        magic, version, bits, lanes, steps, check, n_docs, n_ids, n_marks, n_words = (
            HEADER.unpack_from(body)
        )
        if magic != MAGIC or version != 1 or check != table.check or bits != table.bits:
            raise ValueError("not a block of this table")
        at = HEADER.size

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(body, kind, count, at)
            at += found.nbytes
            return found

        docs, nulls, sizes = take("<i8", n_docs), take("u1", n_docs), take("<i8", n_docs)
        place.append(take("<u8", n_marks).astype(np.int64) + base)
        expected.append(take("<u4", n_marks))
        state.append(take("<u8", n_marks * lanes).reshape(n_marks, lanes))
        three = np.zeros((n_words, 4), np.uint8)
        three[:, :3] = take("u1", 3 * n_words).reshape(-1, 3)
        words.append(three.view("<u4").reshape(-1))
        base += n_words
        left = n_ids - np.arange(n_marks) * steps * lanes
        size.append(np.minimum(left, steps * lanes))
        blocks.append(Block(docs, nulls.astype(bool), sizes, np.zeros(n_ids, np.uint32)))
    if not blocks:
        return []
    sizes = np.concatenate(size)
    found = _rounds(
        np.concatenate(state), np.concatenate(place), sizes, np.concatenate(words), table, steps
    )
    checks, k = np.concatenate(expected), 0
    for block, own in zip(blocks, size, strict=True):
        done = 0
        for n in own:
            ids = found[k].reshape(-1)[:n]
            if zlib.crc32(ids.astype("<u4").tobytes()) != checks[k]:
                raise ValueError("ids differ from their checksum")
            block.ids[done : done + n] = ids
            done, k = done + int(n), k + 1
    return blocks


def _rounds(
    state: np.ndarray,
    place: np.ndarray,
    sizes: np.ndarray,
    words: np.ndarray,
    table: Frequencies,
    steps: int,
) -> np.ndarray:
    """The symbols of each stretch, by round and lane."""
    lanes = state.shape[1]
    order = np.argsort(-sizes, kind="stable")
    state, place, sizes = state[order].astype(np.int64), place[order].copy(), sizes[order]
    freq, first, symbol = table.freq.astype(np.int64), table.first.astype(np.int64), table.symbols()
    bits, low = table.bits, (1 << table.bits) - 1
    out = np.zeros((len(sizes), steps, lanes), np.uint32)
    words = np.append(words, np.uint32(0))
    last = len(words) - 1
    for t in range(steps):
        g = int((sizes > t * lanes).sum())
        if not g:
            break
        x = state[:g]
        slot = x & low
        s = symbol[slot]
        out[:g, t] = s
        x >>= bits
        x *= freq[s]
        slot -= first[s]
        x += slot
        need = x < LOWEST
        if sizes[g - 1] < (t + 1) * lanes:
            # Lanes past the last id of their stretch are done.
            need &= sizes[:g, None] - t * lanes > np.arange(lanes)
        taken = np.cumsum(need, axis=1)
        at = taken + (place[:g, None] - 1)
        np.copyto(x, (x << WORD) | words[np.minimum(at, last)], where=need)
        place[:g] += taken[:, -1]
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    return out[back]


BLOCK_SCHEMA = "part long, local_start long, n_docs long, n_tokens long, data binary"


def _encoded(table: Frequencies, size: int, lanes: int, steps: int) -> Callable:
    """Cut runs of whole documents of about ``size`` ids and encode some of them at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[int, int, Block]] = []
        docs: list[tuple[int | None, int, np.ndarray]] = []
        part = begin = following = -1
        held = 0

        def close() -> None:
            nonlocal docs
            if docs:
                block = Block(
                    np.array([d or 0 for d, _, _ in docs], np.int64),
                    np.array([d is None for d, _, _ in docs]),
                    np.array([n for _, n, _ in docs], np.int64),
                    np.concatenate([i for _, _, i in docs]).astype(np.uint32),
                )
                waiting.append((part, begin, block))
            docs = []

        def flush() -> pa.RecordBatch:
            nonlocal waiting
            blobs = encode([b for _, _, b in waiting], table, lanes, steps)
            rows = [
                pa.array([p for p, _, _ in waiting], pa.int64()),
                pa.array([s for _, s, _ in waiting], pa.int64()),
                pa.array([len(b.sizes) for _, _, b in waiting], pa.int64()),
                pa.array([len(b.ids) for _, _, b in waiting], pa.int64()),
                pa.array(blobs, pa.binary()),
            ]
            waiting = []
            names = [f.split()[0] for f in BLOCK_SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays(rows, names=names)

        for batch in batches:
            cells = batch.column("ids")
            rows = zip(
                batch.column("part").to_pylist(),
                batch.column("doc_id").to_pylist(),
                batch.column("local_start").to_pylist(),
                batch.column("n_tokens").to_pylist(),
                strict=True,
            )
            for i, (p, doc, start, n) in enumerate(rows):
                if p != part or start != following or held >= size:
                    close()
                    part, begin, held = p, start, 0
                    if sum(len(b.ids) for _, _, b in waiting) >= 64 * size:
                        yield flush()
                docs.append((doc, n, ids_of(cells[i].as_buffer().to_pybytes(), n)))
                held, following = held + n, start + n
        close()
        if waiting:
            yield flush()

    return run


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0, np.int64)
    for batch in batches:
        if not batch.num_rows:
            continue
        cells, sizes = batch.column("ids"), batch.column("n_tokens").to_pylist()
        ids = np.concatenate([ids_of(c.as_buffer(), n) for c, n in zip(cells, sizes, strict=True)])
        found = np.bincount(ids)
        if len(found) > len(total):
            found, total = total, found.astype(np.int64)
        total[: len(found)] += found
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array(seen.astype(np.int64)), pa.array(total[seen])], names=["id", "n"]
    )


DOC_SCHEMA = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _decoded(table: Frequencies, keep_ids: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("n_tokens").to_pylist()
            a = 0
            while a < batch.num_rows:
                b, held = a + 1, sizes[a]
                while b < min(a + 32, batch.num_rows) and held + sizes[b] <= TOGETHER:
                    held += sizes[b]
                    b += 1
                rows, a = batch.slice(a, b - a), b
                blocks = decode([c.as_buffer() for c in rows.column("data")], table)
                starts = (rows.column("base").to_numpy() + rows.column("local_start").to_numpy())
                docs, firsts, sizes, crcs, kept = [], [], [], [], []
                for block, start in zip(blocks, starts.tolist(), strict=True):
                    data = memoryview(block.ids.astype("<u4").tobytes())
                    ends = np.cumsum(block.sizes)
                    for d, null, n, e in zip(
                        block.doc_ids.tolist(),
                        block.nulls.tolist(),
                        block.sizes.tolist(),
                        ends.tolist(),
                        strict=True,
                    ):
                        own = data[4 * (e - n) : 4 * e]
                        docs.append(None if null else d)
                        firsts.append(start + e - n)
                        sizes.append(n)
                        crcs.append(zlib.crc32(own))
                        if keep_ids:
                            kept.append(bytes(own))
                columns = [pa.array(x, pa.int64()) for x in (docs, firsts, sizes, crcs)]
                names = [f.split()[0] for f in DOC_SCHEMA.split(", ")]
                if keep_ids:
                    columns.append(pa.array(kept, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


@dataclass(frozen=True)
class TokenFiles:
    """Written blocks (``start`` is a block's place among all ids) and the table they share."""

    blocks: DataFrame
    bases: DataFrame
    frequencies: Frequencies

    def documents(self, keep_ids: bool = False) -> DataFrame:
        """Read the files back: doc_id, start, n_tokens, ids_crc32, and the ids if asked for."""
        schema = DOC_SCHEMA + (", ids binary" if keep_ids else "")
        placed = self.blocks.join(self.bases, "part")
        return placed.mapInArrow(_decoded(self.frequencies, keep_ids), schema)


def write_tokens(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 1,
    block_tokens: int = 1 << 16,
    lanes: int = 64,
    steps: int = 256,
) -> TokenFiles:
    """Encode ``doc_id, text`` in ascending doc_id order into files of blocks.

    The corpus is tokenised once, in ranges of doc_id. Counts of ids come from all documents; the
    table has a row for each id of the vocabulary that occurs, which bounds what the driver gets.
    Null and empty texts are the end id alone; a null doc_id comes first and stays null; repeated
    doc_ids follow each other by a hash of their text; other columns are ignored; no documents give no blocks. A
    document longer than ``block_tokens`` is a block of its own and never cut.
    """
    tokens = token_table(docs, tokenizer, end_id, ordered=True, label="token-ids", slice_bytes=24 << 20)
    seen = tokens.select("n_tokens", "ids").mapInArrow(_counted, "id long, n long")
    counts = {r["id"]: r["n"] for r in seen.groupBy("id").agg(F.sum("n").alias("n")).collect()}
    shared = Frequencies.of(counts)
    blocks = tokens.mapInArrow(_encoded(shared, block_tokens, lanes, steps), BLOCK_SCHEMA)
    return TokenFiles(table(blocks, "token-blocks"), part_bases(tokens), shared)
