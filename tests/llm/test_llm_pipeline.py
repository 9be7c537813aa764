"""The corpus pipeline's stages, each against brute force on its own input, and the whole run."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from metricwin.llm import language
from test_llm_secrets import masked, plain_scan
from test_llm_simhash import expected as expected_components
from test_llm_tokens import BYTES, check_pieces, whole

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage gets and gives, written and read again as the checks do."""
    base = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, out[-1], FOLDER).write.parquet(f"{base}/{k}")
        out.append(spark.read.parquet(f"{base}/{k}"))
    return out


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_stages_return_documents(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language id", "near duplicates", "secrets", "packing",
    ]
    for df in stages[:-1]:
        assert df.dtypes == stages[0].dtypes
        assert df.count()


def test_language_drops_only_what_it_rejects(stages):
    before, after = stages[0], stages[1]
    model = language.fit(before)
    kept = [r for r in before.collect() if not model.predict(r["text"])[2]]
    assert rows(after, *before.columns) == sorted((tuple(r) for r in kept), key=str)
    assert 0.98 * before.count() < after.count() <= before.count()


def test_near_duplicates_leave_one_of_each_group(stages):
    before, after = stages[1], stages[2]
    texts = [tuple(r) for r in before.select("doc_id", "text").collect()]
    first = {d for d, _, c in expected_components(texts) if d == c}
    kept = [r for r in before.collect() if r["doc_id"] in first]
    assert rows(after, *before.columns) == sorted((tuple(r) for r in kept), key=str)
    assert after.count() < before.count()


def test_secrets_are_masked_and_nothing_dropped(stages):
    before, after = stages[2], stages[3]
    repository = F.concat_ws("/", "source", "lang")
    texts = [
        tuple(r) for r in before.select("doc_id", "text", "source", repository).collect()
    ]
    spans = {r[0]: r[5] for r in plain_scan(texts)}
    want = [
        (r["doc_id"], masked(r["text"], spans[r["doc_id"]]), r["lang"], r["source"])
        for r in before.collect()
    ]
    assert rows(after, "doc_id", "text", "lang", "source") == sorted(want, key=str)
    changed = after.where(F.col("text").contains("[secret]"))
    assert changed.count() and changed.where("n_chars != length(text)").count() == 0


def test_packing_takes_every_kept_document(stages):
    before, pieces = stages[3], stages[4].collect()
    texts = [tuple(r) for r in before.select("doc_id", "text").collect()]
    check_pieces(pieces, texts, whole(BYTES), 2048)


def test_run_applies_the_stages(spark, stages):
    columns = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")
    run = corpus_pipeline.run(spark, FOLDER)
    # Where a document lies may differ with the partitions; what is packed may not.
    ours = {r[0]: r[4] for r in rows(run, *columns)}
    assert ours == {r[0]: r[4] for r in rows(stages[-1], *columns)}
    assert corpus_pipeline.ORACLE_SQL is None


def test_awkward_documents(spark, awkward, no_docs):
    """Rows that no rule rejects pass every stage; nulls, repeats and empty tables are no trouble."""
    docs = awkward.select(*corpus_pipeline.DOCUMENT)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == list(corpus_pipeline.DOCUMENT)
    ids = [r["doc_id"] for r in docs.collect()]
    assert 6 in ids and ids.count(5) <= 1 and 2 not in ids
    empty = no_docs
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, FOLDER)
        assert empty.collect() == []


def test_registered():
    import __spark_entry__

    names = [n for n in __spark_entry__.queries() if n.startswith("op") or n == "pipeline"]
    assert sorted(int(n[2:].split("_")[0]) for n in names if n != "pipeline") == list(range(1, 14))
    assert "pipeline" in names
