"""Virtual-slot sharding: places, balance, versions and rebalancing."""

import zlib
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from metricwin.llm.sharding import Entry, SlotMap, first_map, place, rebalance, records, shard
from metricwin.storage import fresh_dir


def check(got, rows, shards):
    """Sizes and sums are the texts', and every shard's places run from 0 without gaps."""
    want = []
    for doc_id, text in rows:
        data = (text or "").encode()
        want.append((doc_id, len(data) + 1, zlib.crc32(data)))
    found = [(r["doc_id"], r["size"], r["text_crc32"]) for r in got]
    assert sorted(found, key=str) == sorted(want, key=str)
    for s in range(shards):
        own = sorted(r["place"] for r in got if r["shard"] == s)
        assert own == list(range(len(own)))
    assert {r["shard"] for r in got} <= set(range(shards))


def loads(got, shards):
    total = Counter()
    for r in got:
        total[r["shard"]] += r["size"]
    return [total[s] for s in range(shards)]


def test_the_table_is_balanced(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    rows, slot_map = shard(docs, shards=8)
    got = rows.collect()
    check(got, [tuple(r) for r in docs.collect()], 8)
    sizes = loads(got, 8)
    assert sizes == slot_map.loads()
    largest = max(r["size"] for r in got)
    assert max(sizes) - min(sizes) <= largest


def test_awkward_documents(awkward, no_docs):
    rows, _ = shard(awkward, shards=3, slots=16)
    check(rows.collect(), [tuple(r)[:2] for r in awkward.collect()], 3)
    rows, slot_map = shard(no_docs, shards=3)
    assert rows.collect() == [] and slot_map.entries == ()


def test_hot_key_is_split(spark):
    rows = [(1, "x" * 99)] * 600 + [(i, "y" * 99) for i in range(2, 1200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    placed, slot_map = shard(docs, shards=8, slots=512)
    got = placed.collect()
    check(got, rows, 8)
    sizes = loads(got, 8)
    assert max(sizes) <= 1.02 * min(sizes)
    assert any(e.parts > 1 for e in slot_map.entries)
    assert len({r["shard"] for r in got if r["doc_id"] == 1}) > 4


def test_slots_do_not_move(spark, data):
    """A slot depends on the record alone, whatever the number of shards or partitions."""
    docs = spark.read.parquet(f"{data}/documents.parquet")
    a = {r["doc_id"]: r["slot"] for r in shard(docs, shards=8)[0].collect()}
    b = {r["doc_id"]: r["slot"] for r in shard(docs.repartition(7), shards=3)[0].collect()}
    assert a == b


def test_versions_are_kept(spark, data):
    path = fresh_dir(spark, "maps")
    docs = spark.read.parquet(f"{data}/documents.parquet")
    _, first = shard(docs, shards=4, slots=256, map_path=path)
    second = rebalance(first, 5)
    second.save(spark, path)
    assert SlotMap.load(spark, path, 1, 4) == first
    assert SlotMap.load(spark, path, 2, 5) == second
    with pytest.raises(Exception, match="(?i)exists"):
        second.save(spark, path)


def entries(n):
    return [Entry(i, 0, 1, 1000 + (i * 7919) % 900, 1) for i in range(n)]


def test_growing_moves_slots_to_the_new_shard_only():
    old = first_map(entries(4096), 8)
    new = rebalance(old, 9)
    moved = [(a, b) for a, b in zip(old.entries, new.entries, strict=True) if a.shard != b.shard]
    assert moved and all(b.shard == 8 for _, b in moved)
    assert len(moved) < 1.1 * 4096 / 9
    even = sum(new.loads()) / 9
    assert max(new.loads()) <= 1.021 * even
    assert new.version == old.version + 1


def test_shrinking_moves_only_the_lost_shards_slots():
    old = first_map(entries(1000), 5)
    new = rebalance(old, 4, tolerance=0.05)
    for a, b in zip(old.entries, new.entries, strict=True):
        assert a.shard == b.shard or a.shard == 4
    assert max(new.loads()) <= 1.05 * sum(new.loads()) / 4


def test_rebalancing_what_is_even_moves_nothing():
    old = first_map(entries(2000), 6)
    assert rebalance(old, 6).entries == old.entries


def test_rebalancing_after_growth_of_a_slot():
    old = first_map(entries(2000), 6)
    grown = tuple(replace(e, bytes=e.bytes * 3) if e.shard == 0 else e for e in old.entries)
    new = rebalance(replace(old, entries=grown), 6)
    assert max(new.loads()) <= 1.03 * sum(new.loads()) / 6
    for a, b in zip(grown, new.entries, strict=True):
        assert a.shard == b.shard or a.shard == 0


def test_query_columns(spark, data):
    from metricwin.llm.queries import QUERIES

    got = QUERIES["op1_virtual_slots"](spark, data)
    assert got.columns[:7] == [
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard",
    ]
    kinds = dict(got.dtypes)
    assert [kinds[c] for c in got.columns[:7]] == [
        "bigint", "bigint", "bigint", "string", "int", "bigint", "int",
    ]
    assert got.where(F.col("law") != "bytes").count() == 0


def test_a_saved_map_finds_every_record_again(spark):
    """Loaded and applied to the same records in other partitions, and to some new ones."""
    rows = [(1, "x" * 99)] * 500 + [(1, f"text {i}") for i in range(300)] + [(None, "none")] * 300
    rows += [(i, "y" * 50) for i in range(2, 600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    path = fresh_dir(spark, "maps")
    first, made = shard(docs.repartition(3), shards=5, slots=64, map_path=path)
    assert any(e.parts > 1 for e in made.entries)
    loaded = SlotMap.load(spark, path, 1, 5)

    def where(got):
        return Counter((r["doc_id"], r["text_crc32"], r["shard"]) for r in got)

    before = where(first.collect())
    again = place(records(docs.repartition(7), 64), loaded).collect()
    assert where(again) == before
    check(again, rows, 5)
    new = [(i, "new") for i in range(10_000, 10_400)]
    more = docs.union(spark.createDataFrame(new, docs.schema))
    grown = place(records(more, 64), loaded).collect()
    check(grown, rows + new, 5)
    assert before - where(grown) == Counter()
