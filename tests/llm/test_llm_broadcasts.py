"""Tables that grow with the input are not broadcast, whatever Spark takes their size for."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from metricwin.llm import common, components, multi_index, simhash, spelling


@pytest.fixture
def plans(monkeypatch):
    """The plans of all tables written, each with its label."""
    seen = []

    def noting(df, label):
        seen.append((label, plan_of(df)))
        return common.table(df, label)

    for module in (components, multi_index, simhash, spelling):
        monkeypatch.setattr(module, "table", noting)
    return seen


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def of(plans, *labels):
    found = [plan for label, plan in plans if label in labels]
    assert found
    return found


@pytest.fixture
def docs(spark):
    text = F.concat_ws(" ", *[F.concat(F.lit("word"), F.char(97 + (F.col("id") + i) % 9)) for i in range(6)])
    return spark.range(40).select(F.col("id").alias("doc_id"), text.alias("text"))


def test_simhash_joins_are_merged(docs, plans):
    found = simhash.near_duplicates(docs)
    written = of(plans, "simhash-index", "simhash-reached", "simhash-linked", "simhash-components")
    for plan in [*written, plan_of(found)]:
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
    by_text = found.join(docs, "doc_id").groupBy("text").agg(F.count_distinct("component_id").alias("n"))
    assert [r["n"] for r in by_text.collect()] == [1] * 9


def test_pipeline_keeps_one_without_a_broadcast_of_fingerprints(docs, plans):
    kept = simhash.keep_one(docs)
    for plan in of(plans, "simhash-index", "simhash-reached", "simhash-dropped"):
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(9))


def test_many_rows_are_merged_and_few_left_to_spark(docs, spark, plans, monkeypatch):
    edges = spark.range(1, 60).select(F.col("id").alias("u"), (F.col("id") - 1).alias("v"))
    roots = [r["root"] for r in components.components(edges, "few").collect()]
    monkeypatch.setattr(common, "BROADCAST_ROWS", 4)
    assert [r["root"] for r in components.components(edges, "many").collect()] == roots == [0] * 60
    assert all("Broadcast" not in p for p in of(plans, "many-large", "many-small")[:2])
    kept = simhash.keep_one(docs)
    assert "SortMergeJoin" in plan_of(kept) and kept.count() == 9


def test_spelling_joins_are_merged(spark, plans):
    words = spark.createDataFrame([("house", 9), ("hous", 3), ("houses", 4), ("mouse", 5)], "word string, n long")
    found = spelling.group_variants(words)
    for plan in [*of(plans, "forms", "roots")[:1], plan_of(spelling.near_pairs(words)), plan_of(found)]:
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
    rows = {r["word"]: (r["form"], r["n_near"]) for r in found.collect()}
    assert rows == {"house": (None, 3), "hous": ("house", 1), "houses": ("house", 1), "mouse": (None, 1)}


@pytest.fixture
def vectors(spark):
    v = F.array(*[F.hash("id", F.lit(i)).cast("double") / (1 << 28) for i in range(8)])
    return spark.range(0, 400, 1, 8).select(F.col("id").alias("vec_id"), v.cast("array<float>").alias("embedding"))


def test_only_the_parts_of_cells_are_broadcast(vectors):
    found = multi_index.search(vectors, F.col("vec_id") % 4 == 0, k=3, centres=4)
    plan = plan_of(found)
    # Two joins, entries and probes with the parts of their cells; parts are the side that is sent.
    assert plan.count("BroadcastHashJoin") == plan.count("BuildRight") == 2
    assert found.count() == 300


def test_the_sample_comes_to_the_driver_from_a_table_of_its_own_size(vectors, plans):
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    by_hash = rows.orderBy(F.xxhash64("vec_id"), "vec_id").collect()
    for n in (1, 50, 400, 1000):
        assert multi_index.lowest_hashed(rows, n) == [r["v"] for r in by_hash[:n]]
    copies = rows.union(rows)
    assert multi_index.lowest_hashed(copies, 5) == [by_hash[i // 2]["v"] for i in range(5)]
    assert len(of(plans, "multi-sample")) == 5


def test_probes_are_handed_back_in_small_batches(vectors, monkeypatch):
    query = F.col("vec_id") % 4 == 0
    whole = multi_index.search(vectors, query, k=3, centres=4).orderBy("query_id", "rank").collect()
    monkeypatch.setattr(multi_index, "PROBES", 7)
    assert multi_index.search(vectors, query, k=3, centres=4).orderBy("query_id", "rank").collect() == whole


def test_rows_that_come_back_regularly_fill_all_blocks(spark):
    v = F.array(F.col("id") % 8 + 1, F.col("id") % 8 % 3).cast("array<float>")
    rows = spark.range(0, 512, 1, 1).select(F.col("id").alias("vec_id"), v.alias("embedding"))
    found = multi_index.search(rows, F.col("vec_id") % 8 == 0, k=3, block=4).collect()
    # Each has 63 copies: the nearest are the three smallest ids of them besides its own.
    assert len(found) == 3 * 64 and {r["score"] for r in found} == {0.0}
    assert {r["vec_id"] for r in found} == {0, 8, 16, 24}
    for step in (1, 100, 2000, 1 << 16):
        for parts in (2, 3, 16):
            for task in (0, 5):
                sizes = np.bincount(multi_index.salts(task, np.arange(2000) * step) % parts, minlength=parts)
                assert sizes.min() > 0.6 * 2000 / parts and sizes.max() < 1.4 * 2000 / parts


def test_a_block_without_entries_has_no_neighbours():
    ids, none = np.arange(3), np.zeros((0, 2))
    found = multi_index.nearest_of_block(ids, np.ones((3, 2)), np.zeros(0, np.int64), none, 5)
    assert [len(part) for part in found] == [0, 0, 0]
