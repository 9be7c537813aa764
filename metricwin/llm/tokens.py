"""Token ids of whole texts, and the table of them that other operators read twice.

Texts repeat their words, so ``TextEncoder`` cuts some megabytes of them at places where the
tokenizer's own pre-tokenizer always cuts, and encodes each distinct cut once with the library.
Texts whose white space makes such cuts unsafe are encoded whole. Both ways give the ids of the
library on the whole text, which the tests compare.

As the library does by itself, the strings of its special tokens in a text give those tokens' ids;
texts that hold one are encoded whole. ``plain_specials`` makes them ordinary text.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricwin.llm.common import small_batches, table

#: Unicode white space, as a class of RE2. Fixed values.
SPACE = (
    r"\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
#: Letters that neither lower case nor composition can end in a mark. Fixed values.
LETTER = r"A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{12f}\x{131}-\x{17f}"
#: A stop or comma that is not one between such a letter and a space, line end or text end, or a
#: mark that composes with the letter before it.
ODD_STOP = rf"(?:^|[^{LETTER}])[.,]|[.,][^ \n]|[\x{{300}}-\x{{36f}}]"
WORD = rf"\A[{LETTER}]+\z"
NO_SPACE_BEFORE = "\x01"
BARE_WORD = rf"\A\x01[{LETTER}]+\z"
#: ASCII signs but the apostrophe, which may begin an ending like 's.
SIGNS = r"[!-&(-/:-@\[-`{-~]+"
SIGNED_WORD = rf"\A[{LETTER}]+{SIGNS}\z"
BEFORE_SIGNS = "\x02"
SLICE_BYTES = 8 << 20


def byte_characters() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies, but for the space."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {
        b: chr(256 + k) for k, b in enumerate(hidden) if b != ord(" ")
    }


class TextEncoder:
    """Encodes texts with a file of the ``tokenizers`` library, without adding special tokens.

    Nothing is kept between calls: a call's texts are cut, its distinct cuts are encoded and its
    ids are put together from theirs. Pass as much text at once as memory allows.
    """

    def __init__(self, path: str, plain_specials: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain_specials
        added = self.tokenizer.get_added_tokens_decoder().values()
        written = [re.escape(t.content) for t in added if not (plain_specials and t.special)]
        # In any case, as the tokenizer may lower texts before it looks for them.
        self.written = "(?i)" + "|".join(written) if written else None
        # Does the white space before a word, or its case, take part in its ids?
        self.spaced = self._whole("a") != self._whole(" a")
        self.lowers = self._whole("A") == self._whole("a")
        # Between cuts that are encoded in one text stands a mark that none of them holds.
        self.mark = "\n" if self.spaced else " \x01 "
        mark = self._whole(self.mark)
        self.mark_id = mark[0] if len(mark) == 1 else None
        # Plain words need no rules before the merges; a tokenizer of the same model without any.
        self.merger = Tokenizer(self.tokenizer.model)
        self.merger.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.characters = byte_characters()
        vocabulary = self.tokenizer.get_vocab()
        self.edge = np.zeros(max(vocabulary.values()) + 1, bool)
        for piece, number in vocabulary.items():
            at_edge = piece.startswith("\u0120") if self.spaced else piece.endswith("</w>")
            self.edge[number] = at_edge
        self.words_apart = True
        self.words_apart = self._words_agree()

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _words_agree(self) -> bool:
        """Whether the merges alone give the whole tokenizer's ids for words of all sorts."""
        words = ["a", "The", "\u00c9t\u00e9", "stra\u00dfe", "qzx" * 9, "I", "\u017f", "na\u00efve"]
        space = " " if self.spaced else ""
        for bare, signs in ((False, ""), (True, ""), (False, "."), (False, ",[$$]-")):
            between = BEFORE_SIGNS if signs else ""
            text = " ".join(w + between + signs for w in words)
            found = self._words(text, len(words), bare, bool(signs))
            if found is None:
                return False
            ids, starts, sizes = found
            for word, a, n in zip(words, starts.tolist(), sizes.tolist(), strict=True):
                if ids[a : a + n].tolist() != self._whole(("" if bare else space) + word + signs):
                    return False
        return True

    def _words(self, text: str, n: int, bare: bool = False, signed: bool = False):
        """Ids of ``n`` plain words, where each begins and how many it has; None if unclear.

        Words have a space before them where that matters, but not ``bare`` ones; ``signed`` ones
        are followed by signs, with ``BEFORE_SIGNS`` between.
        """
        if not n or not self.words_apart:
            return None
        if self.lowers:
            text = text.lower()
        text = text.encode().decode("latin-1").translate(self.characters)
        # The sign of the line end is the mark between bare words, which begin with no sign.
        apart = bare and self.spaced
        if apart:
            text = text.replace(" ", " \u010a ") + " \u010a"
        elif self.spaced:
            text = "\u0120" + text.replace(" ", " \u0120")
        if signed:
            text = text.replace(self.characters[ord(BEFORE_SIGNS)], " ")
        encoded = self.merger.encode_batch_fast([text], add_special_tokens=False)[0]
        ids = np.array(encoded.ids, np.uint32)
        at = np.flatnonzero(ids == self.mark_id if apart else self.edge[ids])
        if signed and not self.spaced:
            # The signs have a last piece of their own.
            if len(at) != 2 * n:
                return None
            at = at[1::2]
        if len(at) != n:
            return None
        if self.spaced and not apart:
            return ids, at, np.diff(np.append(at, len(ids)))
        starts = np.concatenate([[0], at[:-1] + 1])
        return ids, starts, at - starts + (0 if apart else 1)

    def _text_of(self, cut: str) -> str:
        if not self.spaced or cut == "\n":
            return cut
        return cut[1:] if cut.startswith(NO_SPACE_BEFORE) else " " + cut

    def _others(self, cuts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As ``_words``, for cuts of any sort: many in one text with marks, or one by one."""
        texts = [self._text_of(c) for c in cuts]
        alone = [i for i, t in enumerate(texts) if t in ("", "\n") or len(t) > 200]
        apart = set(alone)
        many = [i for i in range(len(texts)) if i not in apart]
        parts, starts, sizes, used = [], np.zeros(len(cuts), np.int64), np.zeros(len(cuts), np.int64), 0
        for at in range(0, len(many), 20_000):
            own = many[at : at + 20_000]
            joined = self.mark.join([texts[i] for i in own]) + self.mark
            ids = np.array(self._whole(joined), np.uint32)
            ends = np.flatnonzero(ids == self.mark_id)
            if len(ends) != len(own):
                alone += own
                continue
            first = np.concatenate([[0], ends[:-1] + 1])
            starts[own], sizes[own] = first + used, ends - first
            parts.append(ids)
            used += len(ids)
        for i in alone:
            ids = np.array(self._whole(texts[i]), np.uint32)
            starts[i], sizes[i] = used, len(ids)
            parts.append(ids)
            used += len(ids)
        return np.concatenate([np.zeros(0, np.uint32), *parts]), starts, sizes

    def _distinct(self, cuts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct cuts in a row, and where each begins and how many it has."""
        sort = np.zeros(len(cuts), np.int8)
        patterns = (WORD, SIGNED_WORD, BARE_WORD if self.spaced else None)
        for kind, pattern in enumerate(patterns, 1):
            if pattern:
                found = pc.match_substring_regex(cuts, pattern).to_numpy(zero_copy_only=False)
                sort[found] = kind
        stores, starts, sizes, used = [], np.zeros(len(cuts), np.int64), np.zeros(len(cuts), np.int64), 0
        for kind in (1, 2, 3, 0):
            at = np.flatnonzero(sort == kind)
            if not len(at):
                continue
            own = cuts.take(pa.array(at))
            found = None
            if kind:
                if kind == 3:
                    own = pc.utf8_slice_codeunits(own, 1)
                if kind == 2:
                    own = pc.replace_substring_regex(own, rf"({SIGNS})\z", BEFORE_SIGNS + r"\1")
                found = self._words(" ".join(own.to_pylist()), len(at), kind == 3, kind == 2)
            if found is None:
                if kind:
                    sort[at] = 0
                    continue
                found = self._others(own.to_pylist())
            ids, first, n = found
            stores.append(ids)
            starts[at], sizes[at] = first + used, n
            used += len(ids)
        return np.concatenate([np.zeros(0, np.uint32), *stores]), starts, sizes

    def _by_cuts(self, texts: pa.Array, plain: bool) -> tuple[np.ndarray, np.ndarray]:
        """``plain`` texts are also cut between a letter and the one stop or comma after it."""
        if plain and self.lowers:
            texts = pc.ascii_lower(texts)
        if plain:
            before = " " + NO_SPACE_BEFORE if self.spaced else " "
            for stop in (".", ","):
                texts = pc.replace_substring(texts, stop, before + stop)
        if self.spaced:
            texts = pc.replace_substring(texts, "\n", " \n " + NO_SPACE_BEFORE)
            empty = pa.scalar("", pa.large_string())
            texts = pc.binary_join_element_wise(
                pa.scalar(NO_SPACE_BEFORE, pa.large_string()), texts, empty
            )
        else:
            texts = pc.replace_substring(texts, "\n", " ")
        lists = pc.split_pattern(texts, " ")
        offsets = lists.offsets.to_numpy()
        offsets = offsets - offsets[0]
        coded = lists.flatten().dictionary_encode()
        del texts, lists
        store, starts, sizes = self._distinct(coded.dictionary)
        which = coded.indices.to_numpy()
        counts = np.add.reduceat(sizes[which], offsets[:-1])
        # Ids are put together some documents at a time, to keep the index arrays small.
        out = np.empty(int(counts.sum()), np.uint32)
        used, a = 0, 0
        while a < len(counts):
            b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + (1 << 19), side="right")) - 1)
            own = which[offsets[a] : offsets[b]]
            n = sizes[own]
            total = int(n.sum())
            at = np.repeat(starts[own] - (np.cumsum(n) - n), n)
            at += np.arange(total)
            out[used : used + total] = store[at]
            used, a = used + total, b
        return out, counts

    def _unsafe(self, texts: pa.Array) -> np.ndarray:
        found = pc.match_substring(texts, NO_SPACE_BEFORE)
        if self.written:
            found = pc.or_(found, pc.match_substring_regex(texts, self.written))
        if self.spaced:
            at_ends = pc.match_substring_regex(texts, r"^[ \n]|[ \n]\z")
            beside = pc.match_substring_regex(texts, rf"[ \n][{SPACE}]|[{SPACE}][ \n]")
            found = pc.or_(found, pc.or_(at_ends, beside))
            found = pc.or_(found, pc.equal(pc.binary_length(texts), 0))
        return found.to_numpy(zero_copy_only=False)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row and how many each has; a null text has none."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        whole = self._unsafe(texts) if self.mark_id is not None else np.ones(len(texts), bool)
        counts = np.zeros(len(texts), np.int64)
        odd_stop = pc.match_substring_regex(texts, ODD_STOP)
        odd_stop = odd_stop.to_numpy(zero_copy_only=False)
        parts: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(texts)
        for plain in (True, False):
            at = np.flatnonzero(~whole & (odd_stop != plain))
            if not len(at):
                continue
            ids, counts[at] = self._by_cuts(texts.take(pa.array(at)), plain)
            for i, found in zip(at, np.split(ids, np.cumsum(counts[at])[:-1]), strict=True):
                parts[i] = found
        for i in np.flatnonzero(whole):
            parts[i] = np.array(self._whole(texts[int(i)].as_py()), np.uint32)
            counts[i] = len(parts[i])
        return np.concatenate([np.zeros(0, np.uint32), *parts]), counts


@lru_cache(maxsize=2)
def encoder(path: str, plain_specials: bool = False) -> TextEncoder:
    """One encoder for each Python worker."""
    return TextEncoder(path, plain_specials)


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``most`` bytes of text each, one row at least."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    first, total = 0, 0
    for i, size in enumerate(sizes):
        if total and total + size > most:
            yield first, i
            first, total = i, 0
        total += int(size)
    if len(sizes):
        yield first, len(sizes)


def gathered(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Batches put together to about ``most`` bytes of ``text``."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        own = pc.sum(pc.binary_length(batch.column("text"))).as_py() or 0
        if held and size + own > most:
            yield pa.concat_batches(held)
            held, size = [], 0
        held.append(batch)
        size += own
    if held:
        yield pa.concat_batches(held)


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Append ``end_id`` to each document."""
    out = np.full(len(ids) + len(counts), end_id, np.uint32)
    ends = np.cumsum(counts + 1) - 1
    inner = np.ones(len(out), bool)
    inner[ends] = False
    out[inner] = ids
    return out, counts + 1


TOKEN_SCHEMA = "part long, doc_id long, local_start long, n_tokens long, ids binary"


def _tokenised(path: str, end_id: int, wide: bool, slice_bytes: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, start = encoder(path), 0
        kind = np.dtype("<u4" if wide else "<u2")
        for batch in gathered(batches, slice_bytes):
            texts = batch.column("text")
            for a, b in slices(texts, slice_bytes):
                ids, counts = with_end(*enc.encode(texts.slice(a, b - a)), end_id)
                starts = start + np.cumsum(counts) - counts
                ends = np.concatenate([[0], np.cumsum(counts)]) * kind.itemsize
                start += int(counts.sum())
                data = pa.py_buffer(ids.astype(kind).tobytes())
                blobs = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(counts), [None, pa.py_buffer(ends.tobytes()), data]
                )
                rows = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("part"),
                        rows.column("doc_id"),
                        pa.array(starts),
                        pa.array(counts),
                        blobs.cast(pa.binary()),
                    ],
                    names=["part", "doc_id", "local_start", "n_tokens", "ids"],
                )
                del ids, data, blobs
                pa.default_memory_pool().release_unused()

    return run


def token_table(
    docs: DataFrame,
    path: str,
    end_id: int,
    ordered: bool,
    label: str,
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """Write the ids of all documents once and return the written table.

    A row is one document: ``part``, the partition that wrote it; ``local_start``, the ids before
    it in that partition; ``n_tokens`` with the end id; ``ids`` as little-endian unsigned integers
    of 2 bytes, or 4 if the vocabulary needs them. With ``ordered`` partitions are ranges of
    ascending doc_id (null first, equal ids by a hash of the text, so that many rows of one id are
    several partitions) and rows are sorted, else both are in the
    order of the input. A task tokenises about ``slice_bytes`` of text at a time: more finds more
    repeated words, and takes about twenty times that memory.
    """
    rows = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if ordered:
        # Rows of one id are told apart by their text; equal rows may come in any order.
        rows = rows.withColumns(
            {"tie": F.xxhash64("text"), "spread": F.monotonically_increasing_id()}
        )
        rows = rows.repartitionByRange("doc_id", "tie", "spread")
        rows = rows.sortWithinPartitions("doc_id", "tie", "spread").drop("tie", "spread")
    rows = rows.withColumn("part", F.spark_partition_id().cast("long"))
    wide = encoder(path).tokenizer.get_vocab_size() > 1 << 16
    return table(rows.mapInArrow(_tokenised(path, end_id, wide, slice_bytes), TOKEN_SCHEMA), label)


def ids_of(blob: bytes | memoryview, n_tokens: int) -> np.ndarray:
    """The ids in a cell of ``token_table``."""
    return np.frombuffer(blob, "<u2" if len(blob) == 2 * n_tokens else "<u4")


def part_bases(tokens: DataFrame) -> DataFrame:
    """For each part the ids in all parts before it; as many rows as there are partitions.

    Written, so that a join knows its size and broadcasts it only while it is small.
    """
    from pyspark.sql import Window

    totals = tokens.groupBy("part").agg(F.sum("n_tokens").alias("part_tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum("part_tokens").over(before), F.lit(0))
    return table(totals.select("part", base.alias("base")), "part-bases")
