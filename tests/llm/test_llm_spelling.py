"""Spelling variants against whole edit neighbourhoods in plain Python."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from metricwin.llm.queries import QUERIES
from metricwin.llm.spelling import (
    group_variants,
    near_pairs,
    neighbourhood,
    spelling_variants,
    values_of,
    word_counts,
)

TO_LOWER = {ord(a): a.lower() for a in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def counted(rows, typo_every=97):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = run.translate(TO_LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if typo_every and h % typo_every == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            counts[word] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_edit(word, letters):
    made = set()
    for i in range(len(word) + 1):
        if i < len(word):
            made.add(word[:i] + word[i + 1 :])
            made.update(word[:i] + c + word[i + 1 :] for c in letters)
        made.update(word[:i] + c + word[i:] for c in letters)
    made.discard(word)
    return made


def grouped(n):
    letters = sorted({c for w in n for c in w})
    near = {w: [x for x in one_edit(w, letters) if x in n] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    rows = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        rows.add((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return rows


def as_rows(df):
    found = df.select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert len(found) == len({r["word"] for r in found})
    return {tuple(r) for r in found}


def test_query_equals_brute_force(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()
    want = grouped(counted([tuple(r) for r in docs]))
    assert any(r[1] is not None for r in want)
    assert as_rows(QUERIES["op12_reduced_alphabet"](spark, data)) == want


@pytest.mark.parametrize("k", [1, 2, 3])
def test_neighbourhood_is_full_and_made_once(k):
    rng = np.random.default_rng(k)
    for length in (1, 2, 5, 9):
        rows = rng.integers(0, k, (6, length))
        made = [[] for _ in rows]
        for row, values in neighbourhood(rows, k):
            for i, v in zip(row.tolist(), values.tolist(), strict=True):
                made[i].append(v)
        letters = [chr(ord("a") + s) for s in range(k)]
        for row, got in zip(rows, made, strict=True):
            word = "".join(letters[s] for s in row)
            want = one_edit(word, letters) | {word}
            value = {}
            for w in want:
                symbols = np.array([[ord(c) - ord("a") for c in w]], np.int64).reshape(1, len(w))
                value[int(values_of(symbols)[0])] = w
            assert len(got) == len(set(got)) == len(want)
            assert set(got) == set(value)


@pytest.mark.parametrize("symbols", [1, 2, 6, 26])
def test_alphabet_does_not_change_pairs(spark, symbols):
    rng = np.random.default_rng(2)
    words = sorted({"".join(rng.choice(list("abcdéÉ"), rng.integers(5, 8))) for _ in range(400)})
    n = {w: int(rng.integers(3, 40)) for w in words}
    table = spark.createDataFrame(list(n.items()), "word string, n long")
    pairs = [(r["a"], r["b"]) for r in near_pairs(table, symbols).collect()]
    letters = sorted({c for w in words for c in w})
    want = {frozenset((w, x)) for w in words for x in one_edit(w, letters) if x in n}
    assert len(pairs) == len(want)
    assert {frozenset(p) for p in pairs} == want
    assert as_rows(group_variants(table, symbols)) == grouped(n)


def test_hot_word_and_chain(spark):
    """One word near thousands, and forms that lead over several steps."""
    n = {"aaaaaaaa": 1 << 40}
    letters = "bcdefghijklmnopqrstuvwxyz"
    n |= {"aaaaaaaa"[:i] + c + "aaaaaaaa"[i + 1 :]: 3 for i in range(8) for c in letters}
    steps = ["zzzzz", "zzzzy", "zzzxy", "zzwxy", "zvwxy", "uvwxy", "uvwxÿ"]
    n |= {w: 3 * 2**i for i, w in enumerate(steps)}
    table = spark.createDataFrame(list(n.items()), "word string, n long")
    got = as_rows(group_variants(table))
    assert got == grouped(n)
    roots = {r[0]: r[2] for r in got}
    assert roots["zzzzz"] == steps[-1]


def test_awkward_documents(spark, awkward, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    assert as_rows(spelling_variants(awkward, typo_every=97)) == grouped(counted(rows))
    assert as_rows(spelling_variants(awkward)) == grouped(counted(rows, None))
    assert spelling_variants(no_docs).collect() == []
    nothing = awkward.withColumn("text", F.lit(None).cast("string"))
    assert spelling_variants(nothing).collect() == []


def test_cases_signs_and_very_long_words(spark):
    long = "ab" * 20_000
    rows = [(i, f"ÉCOLE école École naïve_naive x×y÷z {long} {long[:-1]}") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    n = {r["word"]: r["n"] for r in word_counts(docs, typo_every=97).collect()}
    assert n == counted(rows)
    got = {r[0]: r for r in as_rows(spelling_variants(docs))}
    assert got["École"][4] == 1 and got["école"][4] == 1
    assert got[long][4] == got[long[:-1]][4] == 1


def test_ratio_must_grow(spark):
    with pytest.raises(ValueError):
        group_variants(spark.createDataFrame([], "word string, n long"), ratio=1)
