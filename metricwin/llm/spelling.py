"""Spelling variants by reduced-alphabet generation.

Letters are dealt to a few symbols. The full one-edit neighbourhood of each distinct reduced word is
small, as there are few symbols to insert or replace by; its members, as 62-bit values, are joined
with the reduced vocabulary, and the words behind a match are verified on their own letters. Words
one edit apart have reduced words that are equal or one edit apart, so nothing is missed.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricwin.llm.common import merged, small_batches, table

#: What a run of letters is.
RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Two moduli below 2^31 and their bases; together they make one value of 62 bits.
HASHES = ((2147483629, 911382323), (2147483587, 972663749))
#: Neighbours made at a time.
BLOCK = 1 << 20


def word_counts(
    docs: DataFrame, shortest: int = 5, least: int = 3, typo_every: int | None = None
) -> DataFrame:
    """``word, n``: the words of all texts that have enough code points and occurrences.

    A word is a maximal run of Latin letters with A-Z lower-cased. With ``typo_every`` words are
    spoilt by rule: where that divides the crc32 h of ``<doc_id>:<word>`` the code point at
    h % length goes. Null texts have no words; a null doc_id is the empty text.
    """
    found = F.regexp_extract_all("text", F.lit(RUN), F.lit(0))
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(found).alias("run"),
    ).where(F.char_length("run") >= shortest)
    run = F.col("run")
    lowered = F.when(F.lower(run) == run, run).otherwise(F.translate(run, UPPER, LOWER))
    words = runs.select("id", lowered.alias("word"))
    if typo_every is not None:
        word = F.col("word")
        h = F.crc32(F.concat(F.col("id"), F.lit(":"), word).cast("binary"))
        at = (h % F.char_length(word)).cast("int")
        cut = F.concat(
            F.substr(word, F.lit(1), at), F.substr(word, at + 2, F.char_length(word).cast("int"))
        )
        words = words.select(F.when(h % typo_every == 0, cut).otherwise(word).alias("word"))
    counted = words.groupBy("word").agg(F.count("*").alias("n"))
    return counted.where((F.char_length("word") >= shortest) & (F.col("n") >= least))


def symbol_map(words: DataFrame, symbols: int) -> dict[str, int]:
    """Letters dealt to symbols by falling frequency, so that symbols are about as frequent.

    One row per letter comes to the driver: an alphabet, whatever the input's size.
    """
    letters = words.select(F.explode(F.split("word", "")).alias("letter"))
    counts = letters.where("letter != ''").groupBy("letter").count().collect()
    load = [(0, s) for s in range(symbols)]
    dealt = {}
    for r in sorted(counts, key=lambda r: (-r["count"], r["letter"])):
        used, symbol = heapq.heappop(load)
        dealt[r["letter"]] = symbol
        heapq.heappush(load, (used + r["count"], symbol))
    return dealt


def _powers(base: int, n: int, modulus: int) -> np.ndarray:
    """base^0 to base^(n - 1), doubling what is there."""
    out = np.ones(1, np.int64)
    while len(out) < n:
        out = np.concatenate([out, out * pow(base, len(out), modulus) % modulus])
    return out[:n]


def _prefixes(symbols: np.ndarray, base: int, modulus: int) -> np.ndarray:
    """Values of all prefixes of each row, the empty one first."""
    terms = (symbols + 1) * _powers(base, symbols.shape[1], modulus) % modulus
    sums = np.cumsum(terms, axis=1) % modulus
    return np.concatenate([np.zeros((len(symbols), 1), np.int64), sums], axis=1)


def values_of(symbols: np.ndarray) -> np.ndarray:
    """The value of each row of symbols: the sum of (symbol + 1) * base^place, for both moduli."""
    (p1, b1), (p2, b2) = HASHES
    return (_prefixes(symbols, b1, p1)[:, -1] << 31) | _prefixes(symbols, b2, p2)[:, -1]


def neighbourhood(symbols: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and values of all sequences over ``k`` symbols at most one edit from each row.

    Each is made once: of a run of equal symbols only the first is deleted, a symbol is inserted
    only where the one before differs, and a replacement differs from what it replaces. Rows have
    one length; a long row is done some places at a time.
    """
    n, length = symbols.shape
    pre = [_prefixes(symbols, b, p) for p, b in HASHES]
    power = [_powers(b, length + 1, p) for p, b in HASHES]
    total = [x[:, -1:] for x in pre]
    yield np.arange(n), (total[0][:, 0] << 31) | total[1][:, 0]
    before = np.concatenate([np.full((n, 1), -1), symbols], axis=1)
    span = max(1, BLOCK // max(1, n))
    for a in range(0, length + 1, span):
        b = min(a + span, length + 1)
        e = min(b, length)
        own, prev = symbols[:, a:e], before[:, a:b]
        shorter, inserted = [], []
        for (p, base), x, w, t in zip(HASHES, pre, power, total, strict=True):
            back = pow(base, -1, p)
            shorter.append((x[:, a:e] + (t - x[:, a + 1 : e + 1]) % p * back) % p)
            inserted.append((x[:, a:b] + (t - x[:, a:b]) % p * base) % p)
        row, place = np.nonzero(own != prev[:, : e - a])
        yield row, (shorter[0][row, place] << 31) | shorter[1][row, place]
        for c in range(k):
            for other, changed in ((own, True), (prev, False)):
                row, place = np.nonzero(other != c)
                made = []
                for (p, _), w, t, grown in zip(HASHES, power, total, inserted, strict=True):
                    if changed:
                        step = (c - own[row, place]) * w[a + place]
                        made.append((t[row, 0] + step) % p)
                    else:
                        made.append((grown[row, place] + (c + 1) * w[a + place]) % p)
                yield row, (made[0] << 31) | made[1]


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Places of words of one length, not too many letters at a time."""
    lengths = np.array([len(w) for w in words], np.int64)
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        step = max(1, (BLOCK >> 4) // max(1, int(length)))
        for a in range(0, len(at), step):
            own = at[a : a + step]
            yield own, [words[i] for i in own]


def reduced_words(words: DataFrame, dealt: dict[str, int]) -> DataFrame:
    """``word, n, reduced, r``: the reduced word, symbols written as letters from a, and its value."""
    shown = str.maketrans({letter: chr(ord("a") + s) for letter, s in dealt.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            reduced = [w.translate(shown) for w in batch.column("word").to_pylist()]
            values = np.zeros(len(reduced), np.int64)
            for at, own in _by_length(reduced):
                values[at] = values_of(_symbols(own))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(reduced, pa.string()), pa.array(values)],
                names=["word", "n", "reduced", "r"],
            )

    return words.select("word", "n").mapInArrow(run, "word string, n long, reduced string, r long")


def _symbols(reduced: list[str]) -> np.ndarray:
    """Reduced words of one length as rows of symbols."""
    raw = np.frombuffer("".join(reduced).encode("utf-32-le"), np.uint32)
    return raw.reshape(len(reduced), -1).astype(np.int64) - ord("a")


def _neighbours(reduced: DataFrame, k: int) -> DataFrame:
    """``r, near``: each distinct reduced word with every sequence about it.

    Of two reduced words about each other the one with the smaller value meets the other, so that
    only neighbours with a larger or its own value go on.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("reduced").to_pylist()
            mine = batch.column("r").to_numpy()
            for at, own in _by_length(words):
                for row, values in neighbourhood(_symbols(own), k):
                    of = mine[at[row]]
                    on = values >= of
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(of[on]), pa.array(values[on])], names=["r", "near"]
                    )

    distinct = reduced.select("r", "reduced").distinct()
    return distinct.mapInArrow(run, "r long, near long")


def near_pairs(words: DataFrame, symbols: int = 6) -> DataFrame:
    """``a, a_n, b, b_n``: each two words (of distinct ``word, n``) one edit apart, once.

    More symbols make more neighbours but fewer false candidates; 6 balance both up to some
    millions of words, larger vocabularies want more.
    """
    dealt = symbol_map(words, symbols)
    reduced = table(reduced_words(words, dealt), "reduced-words")
    seconds = reduced.select(F.col("r").alias("near"), F.col("word").alias("b"), F.col("n").alias("b_n"))
    met = _neighbours(reduced, symbols).join(merged(seconds), "near")
    firsts = reduced.select("r", F.col("word").alias("a"), F.col("n").alias("a_n"))
    near = F.levenshtein("a", "b", 1) == 1
    once = (F.col("m.r") != F.col("m.near")) | (F.col("f.a") < F.col("m.b"))
    both = met.alias("m").join(merged(firsts).alias("f"), (F.col("m.r") == F.col("f.r")) & once & near)
    return both.select("a", "a_n", "b", "b_n")


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for words with a form, following forms to the last.

    Each round joins the words with what their present root leads to, which doubles the way; a
    form has at least ``ratio`` times the occurrences, so there are no circles and few rounds.
    """
    links = table(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = links.join(merged(onward), "root", "left").select(
            "word",
            F.coalesce("further", "root").alias("root"),
            F.col("further").isNotNull().alias("moved"),
        )
        moved = table(moved, "roots")
        links = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return links


def group_variants(words: DataFrame, symbols: int = 6, ratio: int = 2) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for distinct words with their occurrences ``n``.

    Words are near if they differ by exactly one inserted, deleted or replaced code point. A word's
    form is its near word of largest n (ties: smallest in code-point order) if that has at least
    ``ratio`` (over 1) times its occurrences, else null; its root is where forms lead, the word itself
    if it has none. Null words are dropped; no words give no rows; very long words are taken
    whole; other columns are ignored.
    """
    if ratio < 2:
        raise ValueError("ratio must be 2 at least, or forms could lead in a circle")
    words = table(words.where("word is not null").select("word", "n"), "words")
    words = small_batches(words, 10_000)
    pairs = near_pairs(words, symbols)
    sides = [("a", "b"), ("b", "a")]
    mirrored = pairs.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.col(x).alias("word"),
                        F.col(y).alias("other"),
                        F.col(f"{y}_n").alias("other_n"),
                    )
                    for x, y in sides
                ]
            )
        )
    )
    best = F.min(F.struct((-F.col("other_n")).alias("n"), F.col("other").alias("word")))
    about = mirrored.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    grown = -F.col("best.n") >= ratio * F.col("n")
    found = words.join(merged(about), "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(grown, F.col("best.word")).alias("form"),
        F.when(grown, -F.col("best.n")).alias("form_n"),
    )
    found = table(found, "forms")
    roots = _roots(found.where("form is not null"))
    return found.join(merged(roots), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants(docs: DataFrame, typo_every: int | None = None, symbols: int = 6) -> DataFrame:
    """``group_variants`` of the words of all texts; see ``word_counts`` for what those are.

    Repeated rows count as often as they occur; tables without texts give no rows.
    """
    return group_variants(word_counts(docs, typo_every=typo_every), symbols)
