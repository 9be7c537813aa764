"""Quality scores against a second computation of their sizes and against held-out labels."""

import zlib

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from metricwin.llm import quality
from metricwin.llm.queries import QUERIES

BIG = "/root/testdata/sf0.1"


def plain_sizes(data, dictionary, strength, stretch):
    """Encoded bytes, with the dictionary given to a coder made anew for each stretch."""
    total = 0
    for a in range(0, len(data), stretch):
        own = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        parameters = zstandard.ZstdCompressionParameters.from_level(
            strength, source_size=stretch, dict_size=len(dictionary),
            write_content_size=False, write_dict_id=False,
        )
        coder = zstandard.ZstdCompressor(dict_data=own, compression_params=parameters)
        total += len(coder.compress(data[a : a + stretch]))
    return total


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0


@pytest.fixture(scope="module")
def scored(spark):
    return QUERIES["op13_compression_quality"](spark, BIG).toPandas()


def test_held_out_accuracy(spark, scored):
    labels = spark.read.parquet(f"{BIG}/labels.parquet").toPandas()
    assert (scored["held_out"] == scored["doc_id"].map(held)).all()
    assert scored["score"].between(0, 1).all()
    assert (scored["predicted"] == (scored["score"] >= 0.3)).all()
    both = scored[scored["held_out"]].merge(labels, on="doc_id")
    rank = both["score"].rank().to_numpy()
    good = both["quality"].to_numpy() == 1
    area = (rank[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())
    assert area > 0.97
    assert both["predicted"][good].mean() > 0.98
    assert 1 - both["predicted"][~good].mean() > 0.8
    # Calibrated: as many good ones as the scores say.
    assert abs(both["score"].mean() - good.mean()) < 0.03


def test_sizes_and_score_are_those_of_the_dictionaries(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = quality.fit(docs, labels)
    assert len(model.good) == len(model.bad) > 1000 and model.slope > 0
    for r in docs.orderBy("doc_id").limit(12).collect():
        data = (r["text"] or "").encode()
        good, bad = (
            plain_sizes(data, d, model.strength, model.stretch) for d in (model.good, model.bad)
        )
        assert model.sizes(r["text"]) == (good, bad, len(data))
        share = (bad - good + 100 * model.usual) / (len(data) + 100)
        want = 1 / (1 + np.exp(-(model.level + model.slope * share)))
        assert model.score(r["text"]) == pytest.approx(want, abs=1e-9)


def test_held_out_labels_are_not_looked_at(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    turned = labels.withColumn(
        "quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality"))
    )
    one, two = quality.fit(docs, labels), quality.fit(docs.repartition(5), turned.repartition(3))
    assert (one.good, one.bad, one.slope, one.level) == (two.good, two.bad, two.slope, two.level)


def test_curve_is_the_logistic_fit():
    rng = np.random.default_rng(1)
    x = rng.standard_normal(20_000) * 0.1
    y = (rng.random(20_000) < 1 / (1 + np.exp(-(1 + 20 * x)))).astype(float)
    slope, level = quality._curve(x, y, np.ones(len(x)))
    assert slope == pytest.approx(20, rel=0.1) and level == pytest.approx(1, abs=0.1)


def test_awkward_rows(spark, awkward, no_docs):
    marks = [(i, i % 2, 0) for i in range(1, 14)] + [(None, 1, 0), (5, 0, 0), (6, None, 1), (7, 9, 0)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    model = quality.fit(awkward, labels, per_label=5)
    got = quality.predict(awkward.withColumn("score", F.lit("own")), model)
    assert got.columns == [*awkward.columns, "score", "predicted"]
    rows = got.collect()
    assert len(rows) == awkward.count()
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if not r["text"]}) == 1
    assert len({r["score"] for r in rows if r["doc_id"] == 5}) == 1
    assert quality.predict(no_docs, model).collect() == []


@pytest.mark.parametrize("value, low, high", [(1, 0.9, 1), (0, 0, 0.1), (None, 0.5, 0.5)])
def test_one_label_or_none(spark, awkward, value, low, high):
    labels = spark.createDataFrame([(i, value) for i in range(1, 14)], "doc_id long, quality int")
    model = quality.fit(awkward, labels)
    scores = {r["score"] for r in quality.predict(awkward, model).collect()}
    assert all(low <= s <= high for s in scores)
    empty = quality.fit(awkward, labels.limit(0))
    assert empty.score("any") == 0.5


def test_very_long_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = quality.fit(docs, labels)
    good = model.good.decode(errors="ignore") * 20
    assert model.score(good) > 0.9 and model.score(model.bad.decode(errors="ignore") * 20) < 0.1
