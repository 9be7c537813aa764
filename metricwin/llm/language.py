"""Language of a text by compression: the dictionary that makes it smallest names it.

For each language some labelled texts, joined, are a zstandard raw-content dictionary. A text's
words are encoded with each in stretches of ``stretch`` bytes, so that a long text cannot be its own
dictionary, and the smallest total wins. Sizes are whole bytes, so short texts often tie: those are
encoded once more with every part of each dictionary, behind a piece of that part, which costs a few
bytes itself and lets the text's own matches and literals show; the sums tell finer. Where the
winner's lead is narrow even so the prediction is still given but marked as rejected.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from metricwin.llm.common import small_batches

UNDECIDED = "und"
LETTER = regex.compile(r"\p{L}")
#: What is no letter of a word: cases, signs and numbers tell no language.
BETWEEN = re.compile(r"[\W\d_]+")


def words_of(text: str) -> bytes:
    """The text's words in lower case with single spaces, as UTF-8."""
    return BETWEEN.sub(" ", text.lower()).encode("utf-8", "surrogatepass")


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of doc_id as text leaves 2 modulo 4; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_texts(
    docs: DataFrame, per_language: int, most_chars: int, most_languages: int = 64
) -> DataFrame:
    """``lang, text, nth``: a bounded sample of the labelled rows that are not held out.

    Of the ``most_languages`` labels with most rows (ties: first in order) each has the language the ``per_language`` documents whose doc_id hashes lowest, each cut to
    ``most_chars``: nothing but the order of a hash picks them; of rows that repeat a doc_id the
    least text counts. Only rows below a hash that about four times as many have, by the count of
    the language's rows, are brought together, so that a common language fills no task.
    """
    rows = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    rows = rows.where(F.col("text").rlike(r"\p{L}") & ~held_out(F.col("doc_id")))
    most = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most_languages)
    counts = {r["lang"]: r["count"] for r in most.collect()}
    below = F.lit(None).cast("long")
    if counts:
        highest = [
            min((1 << 63) - 1, int(-(2.0**63) + 2.0**64 * 4 * per_language / max(n, 1)))
            for n in counts.values()
        ]
        pairs = zip(counts, highest, strict=True)
        limits = F.create_map(*[F.lit(x) for kv in pairs for x in kv])
        below = F.element_at(limits, F.col("lang"))
    place = F.xxhash64(F.col("doc_id").cast("long"))
    once = (
        rows.select("lang", place.alias("place"), F.substring("text", 1, most_chars).alias("text"))
        .where(F.col("place") <= below)
        .groupBy("lang", "place")
        .agg(F.min("text").alias("text"))
    )
    first = Window.partitionBy("lang").orderBy("place")
    sample = once.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= per_language)
    return sample.select("lang", "text", "nth")


@dataclass
class Model:
    """Languages and their dictionaries; the coders are made once in each Python worker."""

    dictionaries: dict[str, bytes]
    level: int = 6
    stretch: int = 1024
    margin: float = 0.005
    parts: int = 32
    part_level: int = 19
    carrier: int = 96
    _coders: list = field(default_factory=list, repr=False)
    _part_coders: list = field(default_factory=list, repr=False)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_coders": [], "_part_coders": []}

    @staticmethod
    def _coder(data: bytes, level: int, source: int) -> zstandard.ZstdCompressor:
        own = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        parameters = zstandard.ZstdCompressionParameters.from_level(
            level,
            source_size=source,
            dict_size=len(data),
            write_content_size=False,
            write_dict_id=False,
        )
        own.precompute_compress(compression_params=parameters)
        return zstandard.ZstdCompressor(dict_data=own, compression_params=parameters)

    def coders(self) -> list[tuple[str, zstandard.ZstdCompressor]]:
        if not self._coders:
            for lang in sorted(self.dictionaries):
                coder = self._coder(self.dictionaries[lang], self.level, self.stretch)
                self._coders.append((lang, coder))
        return self._coders

    def sizes(self, text: str) -> np.ndarray:
        """Encoded bytes of the whole text by language, in the order of ``coders``."""
        data = words_of(text)
        parts = [data[a : a + self.stretch] for a in range(0, len(data), self.stretch)]
        return np.array([sum(len(c.compress(p)) for p in parts) for _, c in self.coders()])

    def part_coders(self) -> list[list[tuple[zstandard.ZstdCompressor, bytes, int]]]:
        """For each language its dictionary's parts: coder, carrier and the carrier's own size."""
        if not self._part_coders:
            least = min(len(d) for d in self.dictionaries.values())
            n = max(1, min(self.parts, least // (2 * self.carrier)))
            for lang in sorted(self.dictionaries):
                own, size = [], len(self.dictionaries[lang]) // n
                for i in range(n):
                    part = self.dictionaries[lang][i * size : (i + 1) * size]
                    coder = self._coder(part, self.part_level, 512)
                    carrier = part[size // 2 : size // 2 + self.carrier]
                    own.append((coder, carrier, len(coder.compress(carrier))))
                self._part_coders.append(own)
        return self._part_coders

    def fine_sizes(self, text: str) -> np.ndarray:
        """Bytes that the text adds to a carrier, summed over each dictionary's parts."""
        data = b" " + words_of(text).strip() + b" "
        return np.array(
            [
                sum(len(coder.compress(carrier + data)) - alone for coder, carrier, alone in own)
                for own in self.part_coders()
            ]
        )

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, lead over the second as a share of the second's size, and rejected or not.

        A text below ``stretch`` bytes whose lead is narrow is judged by its ``fine_sizes``. Equal
        sizes go to the language that sorts first. Null and letterless texts, and any text
        if nothing was learned, are undecided, scored 0 and rejected.
        """
        if text is None or not self.dictionaries or not LETTER.search(text):
            return UNDECIDED, 0.0, True
        best, lead = self._first(self.sizes(text))
        if lead < self.margin and len(text) < self.stretch:
            best, lead = self._first(self.fine_sizes(text))
        return self.coders()[best][0], lead, lead < self.margin

    @staticmethod
    def _first(sizes: np.ndarray) -> tuple[int, float]:
        best = int(np.argmin(sizes))
        second = np.partition(sizes, 1)[1] if len(sizes) > 1 else sizes[best] * 2
        return best, float(second - sizes[best]) / max(float(second), 1.0)


def fit(
    docs: DataFrame,
    per_language: int = 400,
    most_chars: int = 2000,
    dictionary_bytes: int = 1 << 17,
    level: int = 6,
    stretch: int = 1024,
    margin: float = 0.005,
    most_languages: int = 64,
) -> Model:
    """Dictionaries from ``training_texts``: ``per_language`` texts at most of each of at most
    ``most_languages`` languages come to the driver.

    ``doc_id`` only picks rows; a language with no usable text is not learned.
    """
    rows = training_texts(docs, per_language, most_chars, most_languages).collect()
    texts: dict[str, list[tuple[int, str]]] = {}
    for r in rows:
        texts.setdefault(r["lang"], []).append((r["nth"], r["text"]))
    dictionaries = {}
    for lang, own in texts.items():
        joined = "\n".join(dict.fromkeys(t for _, t in sorted(own)))
        dictionaries[lang] = words_of(joined)[:dictionary_bytes]
    return Model({k: v for k, v in dictionaries.items() if len(v) >= 8}, level, stretch, margin)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred, score, rejected`` added, or set where such columns exist.

    Only ``text`` is looked at. score is from 0 to 1: the winner's lead as a share of the second's
    size. Null and letterless texts are ``und``, score 0, rejected; a text is never cut; repeated
    rows get the same; no documents give no rows.
    """
    names = ("lang_pred", "score", "rejected")
    kept = [c for c in docs.columns if c.lower() not in names]
    docs = small_batches(docs).select(*[f"`{c}`" for c in kept])
    at = [c.lower() for c in kept].index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.predict(t.as_py()) for t in batch.column(at)]
            columns = [
                pa.array([f[0] for f in found], pa.string()),
                pa.array([f[1] for f in found], pa.float64()),
                pa.array([f[2] for f in found], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *columns], names=[*batch.schema.names, *names]
            )

    schema = StructType(list(docs.schema.fields))
    schema = schema.add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    return docs.mapInArrow(run, schema)
