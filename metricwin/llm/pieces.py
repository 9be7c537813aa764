"""SentencePiece ids by an Aho-Corasick automaton over the pieces and one Viterbi pass.

The automaton reads a text once. At each position it follows the output links to every piece that
ends there and relaxes the best score of that position; the best path back gives the pieces. No
piece of a usual vocabulary goes from a letter into the next word's mark, so a text may be cut
there, and each distinct cut of some megabytes of text is solved once.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricwin.llm.common import small_batches
from metricwin.llm.tokens import gathered, slices

SPACE = "▁"
SLICE_BYTES = 16 << 20
CUTS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
#: What the library subtracts from the lowest score for a character without a piece. Fixed value.
UNKNOWN_PENALTY = 10.0


class PieceModel:
    """A SentencePiece model file: its pieces, scores, byte pieces and white space rules.

    Ids are those of the best-scoring segmentation (the sum of the pieces' scores in double
    precision; on equal sums the longer last piece), with a byte piece for each byte of a character
    that no piece covers, or the unknown id if the model has no byte pieces. A model's own rules for
    characters and white space are applied to a text first.
    """

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model.serialized_model_proto())
        rules = proto.normalizer_spec
        if proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only models that mark a word's beginning are supported")
        # Such rules are the library's to apply; without them a text only gets its marks.
        ruled = rules.precompiled_charsmap or rules.remove_extra_whitespaces
        self.normalizer = model if ruled or not rules.escape_whitespaces else None
        self.prefix = SPACE if rules.add_dummy_prefix else ""
        self.pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.bytes = np.full(256, -1, np.int64)
        self.byte_of: dict[int, int] = {}
        self.unknown = model.unk_id()
        self.automaton = ahocorasick.Automaton()
        scores = []
        for i, piece in enumerate(self.pieces):
            if model.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.byte_of[i] = int(piece[3:5], 16)
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                scores.append(model.get_score(i))
                self.automaton.add_word(piece, (len(piece), scores[-1], i))
        self.automaton.make_automaton()
        self.lowest = min(scores, default=0.0) - UNKNOWN_PENALTY
        self.single = {p for p in self.pieces if len(p) == 1 and p in self.automaton}
        self.cuttable = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.pieces)

    def _solve(self, text: str) -> tuple[int, ...]:
        """Viterbi over one cut."""
        n = len(text)
        best = [0.0] + [float("-inf")] * n
        back = [(0, -1)] * (n + 1)
        bare: list[int] = []
        if not self.single.issuperset(text):
            bare = [k for k, c in enumerate(text) if c not in self.single]
        waiting, bares = 0, len(bare)
        for end, (size, score, piece) in self.automaton.iter(text):
            # A character without a piece of its own can always be passed, at the lowest score.
            while waiting < bares and bare[waiting] < end:
                self._pass(bare[waiting], best, back)
                waiting += 1
            end += 1
            start = end - size
            score += best[start]
            if score > best[end]:
                best[end] = score
                back[end] = (start, piece)
        for k in bare[waiting:]:
            self._pass(k, best, back)
        ids: list[int] = []
        at = n
        while at:
            start, piece = back[at]
            if piece >= 0:
                ids.append(piece)
            else:
                ids.extend(reversed(self._bytes_of(text[start:at])))
            at = start
        return tuple(reversed(ids))

    def _pass(self, k: int, best: list[float], back: list[tuple[int, int]]) -> None:
        if best[k] + self.lowest > best[k + 1]:
            best[k + 1] = best[k] + self.lowest
            back[k + 1] = (k, -1)

    def _bytes_of(self, char: str) -> list[int]:
        ids = [int(self.bytes[b]) for b in char.encode("utf-8", "surrogatepass")]
        return [self.unknown] if -1 in ids else ids

    def normalised(self, text: str | None) -> str:
        """The text by the model's rules, with its marks; empty for null, empty or nothing left."""
        if not text:
            return ""
        if self.normalizer is not None:
            return self.normalizer.normalize(text)
        return self.prefix + text.replace(" ", SPACE)

    def encode(self, text: str | None) -> np.ndarray:
        """The ids of a whole text; none for null or empty."""
        text = self.normalised(text)
        if not text:
            return np.zeros(0, np.uint32)
        if not self.cuttable:
            return np.array(self._solve(text), np.uint32)
        cuts = CUTS.findall(text)
        known = {cut: self._solve(cut) for cut in dict.fromkeys(cuts)}
        return np.fromiter(chain.from_iterable(map(known.__getitem__, cuts)), np.uint32)

    def encode_many(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text. Where all spaces stand alone between words, texts share cuts."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        odd = pc.match_substring_regex(texts, rf"\A(?: |\z)| \z|  |{SPACE}")
        ruled = self.normalizer is not None or self.prefix != SPACE
        odd = odd.to_numpy(zero_copy_only=False) | (not self.cuttable or ruled)
        out = [np.zeros(0, np.uint32)] * len(texts)
        for i in np.flatnonzero(odd):
            out[i] = self.encode(texts[int(i)].as_py())
        plain = np.flatnonzero(~odd)
        if not len(plain):
            return out
        lists = pc.split_pattern(texts.take(pa.array(plain)), " ")
        offsets = lists.offsets.to_numpy()
        coded = lists.flatten().dictionary_encode()
        solved = [self._solve(SPACE + word) for word in coded.dictionary.to_pylist()]
        which = coded.indices.to_numpy()
        sizes = np.fromiter(map(len, solved), np.int64, len(solved))
        store = np.fromiter(chain.from_iterable(solved), np.uint32, int(sizes.sum()))
        starts = np.cumsum(sizes) - sizes
        del solved, lists
        for k, i in enumerate(plain):
            own = which[offsets[k] - offsets[0] : offsets[k + 1] - offsets[0]]
            n = sizes[own]
            at = np.repeat(starts[own] - (np.cumsum(n) - n), n)
            at += np.arange(len(at))
            out[i] = store[at]
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters."""
        parts: list[str] = []
        held = bytearray()
        numbers = ids.tolist()
        if self.byte_of.keys().isdisjoint(numbers):
            parts = [self.pieces[i] for i in numbers]
        else:
            for i in numbers:
                if i in self.byte_of:
                    held.append(self.byte_of[i])
                    continue
                if held:
                    parts.append(held.decode("utf-8", "replace"))
                    held.clear()
                parts.append(self.pieces[i])
            parts.append(held.decode("utf-8", "replace"))
        text = "".join(parts)
        return text.removeprefix(self.prefix).replace(SPACE, " ")


@lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    """One model for each Python worker."""
    return PieceModel(path)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids`` (little-endian unsigned 32-bit) of every whole text of ``doc_id, text``.

    Null and empty texts have no ids; repeated rows and null doc_ids stay as they are; other
    columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        for batch in gathered(batches, SLICE_BYTES):
            for a, b in slices(batch.column("text"), SLICE_BYTES):
                rows = batch.slice(a, b - a)
                ids = [x.astype("<u4").tobytes() for x in model.encode_many(rows.column("text"))]
                columns = [rows.column("doc_id"), pa.array(ids, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids"])

    rows = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``. A text's own U+2581 comes back as a space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        for batch in batches:
            texts = [model.decode(np.frombuffer(b.as_buffer(), "<u4")) for b in batch.column("ids")]
            columns = [batch.column("doc_id"), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """For every row: doc_id, n_ids, ids_crc32, and whether decoding gives the text back, as the
    model's rules leave it.

    A null text has no ids and comes back as the empty text, which counts as given back.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        for batch in gathered(batches, SLICE_BYTES):
            sizes, crcs, same = [], [], []
            texts = batch.column("text")
            for a, b in slices(texts, SLICE_BYTES):
                own = texts.slice(a, b - a)
                for cell, ids in zip(own, model.encode_many(own), strict=True):
                    text = cell.as_py() or ""
                    sizes.append(len(ids))
                    crcs.append(zlib.crc32(ids.astype("<u4").tobytes()))
                    if model.normalizer is not None:
                        text = model.normalised(text).removeprefix(model.prefix)
                    same.append(model.decode(ids) == text.replace(SPACE, " "))
            columns = [
                batch.column("doc_id"),
                pa.array(sizes, pa.int64()),
                pa.array(crcs, pa.int64()),
                pa.array(same, pa.bool_()),
            ]
            names = ["doc_id", "n_ids", "ids_crc32", "round_trip"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, n_ids long, ids_crc32 long, round_trip boolean")
