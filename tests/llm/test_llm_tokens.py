"""Tokens, range-ANS files and packing against the library and brute force."""

import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from metricwin.llm.packing import pack
from metricwin.llm.rans import Block, Frequencies, decode, encode, write_tokens
from metricwin.llm.tokens import TextEncoder, token_table

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
BITS = [
    "a", "B", "É", "é.", "the", "The,", " ", " ", "  ", "\n", "\n\n", "\t", "'s", "'LL", "12", "!?",
    "\x01", "ſ", "日本", "😀", "<|endoftext|>", "́", "İ", "J", "̌", "\r\n", ".", ",", "…",
    "Straße", " ", "x" * 250,
]


def whole(path):
    tokenizer = Tokenizer.from_file(path)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_encoder_gives_the_librarys_ids(path):
    random.seed(7)
    texts = ["".join(random.choices(BITS, k=random.randint(0, 40))) for _ in range(1500)]
    texts += ["", " ", "\n", None, "a b", "The cat, the dog.\nThe end."]
    of = whole(path)
    encoder = TextEncoder(path)
    assert encoder.words_apart
    for at in range(0, len(texts), 400):
        own = texts[at : at + 400]
        ids, counts = encoder.encode(pa.array(own))
        ends = np.cumsum(counts)
        assert len(ids) == ends[-1]
        for text, end, n in zip(own, ends, counts, strict=True):
            assert ids[end - n : end].tolist() == of(text), repr(text)


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_special_tokens_strings(path):
    """The library's own ids by default, ordinary text if asked for."""
    texts = ["hello <|endoftext|> world", "<|endoftext|>", "a<|startoftext|>b.", "x <|endoftext|"]
    ids, counts = TextEncoder(path).encode(pa.array(texts))
    assert ids.tolist() == [i for t in texts for i in whole(path)(t)]
    ordinary = Tokenizer.from_file(path)
    ordinary.encode_special_tokens = True
    plain, _ = TextEncoder(path, plain_specials=True).encode(pa.array(texts))
    want = [i for t in texts for i in ordinary.encode(t, add_special_tokens=False).ids]
    assert plain.tolist() == want != ids.tolist()


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_encoder_without_its_shortcuts(path):
    texts = ["The cat, the DOG.\nThe end!! x$$$", "na\u00efve 12 a.b", ""]
    slow = TextEncoder(path)
    slow.words_apart = False
    ids, counts = slow.encode(pa.array(texts))
    assert ids.tolist() == [i for t in texts for i in whole(path)(t)]
    slow.mark_id = None
    assert slow.encode(pa.array(texts))[0].tolist() == ids.tolist()


def test_encoder_takes_no_texts():
    ids, counts = TextEncoder(WORDS).encode(pa.array([], pa.string()))
    assert len(ids) == len(counts) == 0


def random_blocks():
    rng = np.random.default_rng(3)
    sizes = ([5], [1], [0, 3, 0], [33], [4096], [4097, 2], [70_000, 31, 1], [])
    for own in sizes:
        ids = np.minimum(rng.geometric(0.01, sum(own)) - 1, 5000).astype(np.uint32)
        docs = np.arange(len(own), dtype=np.int64)
        yield Block(docs, docs % 2 == 1, np.array(own, np.int64), ids)


@pytest.mark.parametrize(("lanes", "steps"), [(1, 1), (4, 3), (32, 256)])
def test_blocks_come_back_exactly(lanes, steps):
    blocks = [b for b in random_blocks() if len(b.ids)]
    if lanes * steps < 100:
        blocks = [b for b in blocks if len(b.ids) < 5000]
    seen = np.bincount(np.concatenate([b.ids for b in blocks]))
    table = Frequencies.of({int(i): int(seen[i]) for i in np.flatnonzero(seen)}, bits=13)
    assert int(table.freq.sum()) == 1 << table.bits
    assert (table.freq[seen > 0] > 0).all()
    blobs = encode(blocks, table, lanes, steps)
    for got, want in zip(decode(blobs, table), blocks, strict=True):
        for name in ("doc_ids", "nulls", "sizes", "ids"):
            assert (getattr(got, name) == getattr(want, name)).all()
    # Any one block decodes by itself.
    assert (decode(blobs[-1:], table)[0].ids == blocks[-1].ids).all()


def test_one_symbol_and_wrong_bytes():
    table = Frequencies.of({7: 100})
    block = Block(np.array([1]), np.array([False]), np.array([100]), np.full(100, 7, np.uint32))
    blob = encode([block], table, 8, 4)[0]
    assert (decode([blob], table)[0].ids == 7).all()
    with pytest.raises(ValueError):
        decode([blob[:90] + bytes([blob[90] ^ 1]) + blob[91:]], table)
    with pytest.raises(ValueError):
        decode([blob], Frequencies.of({7: 100, 8: 1}))


def test_compressed_below_the_plain_ids():
    rng = np.random.default_rng(1)
    ids = np.minimum(rng.geometric(0.05, 200_000), 400).astype(np.uint32)
    seen = np.bincount(ids)
    table = Frequencies.of({int(i): int(seen[i]) for i in np.flatnonzero(seen)})
    block = Block(np.array([1]), np.array([False]), np.array([len(ids)]), ids)
    share = seen[seen > 0] / len(ids)
    entropy_bytes = -(share * np.log2(share)).sum() * len(ids) / 8
    assert len(encode([block], table, 32, 256)[0]) < 1.06 * entropy_bytes


def expected_files(rows, of):
    """doc_id, start, n_tokens, crc in ascending doc_id order, null first, ties by a hash."""

    def tie(text):
        value = 42 if text is None else xxhash.xxh64(text.encode(), seed=42).intdigest()
        return value - (value >> 63 << 64)

    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, tie(r[1])))
    start, out = 0, []
    for doc_id, text, *_ in order:
        ids = [*of(text), 1]
        out.append((doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    return out


def key(row):
    return tuple((x is not None, x) for x in row)


def test_files_of_awkward_documents(spark, awkward):
    rows = [tuple(r)[:2] for r in awkward.collect()]
    files = write_tokens(awkward.repartition(3), WORDS, block_tokens=64, lanes=4, steps=8)
    got = [tuple(r) for r in files.documents().collect()]
    assert sorted(got, key=key) == sorted(expected_files(rows, whole(WORDS)), key=key)
    kept = files.documents(keep_ids=True).where("doc_id = 12").first()
    assert np.frombuffer(kept["ids"], "<u4").tolist() == [*whole(WORDS)("one"), 1]


def test_files_of_the_table(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    files = write_tokens(docs, WORDS, block_tokens=2000)
    assert files.blocks.count() > 10
    got = [tuple(r) for r in files.documents().orderBy("start").collect()]
    assert got == expected_files(rows, whole(WORDS))


def test_no_documents(spark, no_docs):
    assert write_tokens(no_docs, WORDS).documents().collect() == []
    assert pack(no_docs, BYTES).collect() == []


def check_pieces(pieces, rows, of, length):
    """Every id in one piece, sequences full but the last, offsets without gaps."""
    want = {}
    for doc_id, text in rows:
        want.setdefault(doc_id, []).append([*of(text), 1])
    total = sum(len(x) for own in want.values() for x in own)
    by_place = sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"]))
    assert sum(p["length"] for p in by_place) == total
    place = 0
    for p in by_place:
        assert p["sequence_id"] * length + p["offset"] == place
        assert 0 < p["length"] <= length - p["offset"]
        place += p["length"]
        fits = [
            ids
            for ids in want[p["doc_id"]]
            if len(ids) == p["doc_tokens"]
            and crc(ids[p["start"] : p["start"] + p["length"]]) == p["ids_crc32"]
        ]
        assert fits
    starts = {}
    for p in by_place:
        starts.setdefault(p["doc_id"], []).append((p["start"], p["length"]))
    for doc_id, own in want.items():
        assert sum(n for _, n in starts[doc_id]) == sum(map(len, own))


@pytest.mark.parametrize("length", [7, 2048])
def test_packing_awkward_documents(awkward, length):
    rows = [tuple(r)[:2] for r in awkward.collect()]
    pieces = pack(awkward.repartition(4), BYTES, length=length).collect()
    check_pieces(pieces, rows, whole(BYTES), length)


def test_packing_keeps_ids(spark):
    docs = spark.createDataFrame([(1, "one two three four five six")], "doc_id long, text string")
    pieces = pack(docs, BYTES, length=4, keep_ids=True).orderBy("start").collect()
    ids = np.concatenate([np.frombuffer(p["ids"], "<u4") for p in pieces]).tolist()
    assert ids == [*whole(BYTES)("one two three four five six"), 1]


def test_packing_the_table(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    pieces = pack(docs.repartition(5, F.col("doc_id")), BYTES).collect()
    check_pieces(pieces, [tuple(r) for r in docs.collect()], whole(BYTES), 2048)


def test_many_rows_of_one_id_are_several_partitions(spark):
    rows = [(None if i % 2 else i, f"text number {i % 50}") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tokens = token_table(docs, WORDS, 1, ordered=True, label="hot")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    sizes = [r["count"] for r in tokens.where("doc_id is null").groupBy("part").count().collect()]
    assert sum(sizes) == 3000 and max(sizes) < 2400
    got = [tuple(r) for r in write_tokens(docs, WORDS).documents().orderBy("start").collect()]
    assert got == expected_files(rows, whole(WORDS))


def test_a_long_block_pads_no_others():
    """Memory of one long document among many short ones stays near its own."""
    rng = np.random.default_rng(8)

    def block(n):
        ids = rng.integers(0, 5000, n).astype(np.uint32)
        return Block(np.array([1]), np.array([False]), np.array([n]), ids)

    blocks = [block(1 << 16) for _ in range(63)] + [block(2_000_000)]
    seen = np.bincount(np.concatenate([b.ids for b in blocks]))
    table = Frequencies.of({i: int(n) for i, n in enumerate(seen) if n})
    tracemalloc.start()
    blobs = encode(blocks, table, 64, 256)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 300e6
    back = decode(blobs[-2:], table)
    assert all((x.ids == y.ids).all() for x, y in zip(back, blocks[-2:], strict=True))
