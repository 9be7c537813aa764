"""Quality of a text by compression: does the dictionary of good or of bad texts make it smaller?

Labelled texts, good ones and bad ones, make two zstandard raw-content dictionaries of like size. A
text is encoded with both in stretches of ``stretch`` bytes, so that a long text cannot be its own
dictionary. The difference of the two sizes for each byte of text is what tells (a text that says
little, one word over and over, has little of either); a logistic curve fitted on labelled rows that
are in neither dictionary turns it into a probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from metricwin.llm.common import small_batches, table


def held_out(doc_id: Column) -> Column:
    """Whether 5 divides crc32 of doc_id as text; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


@dataclass
class Model:
    """Two dictionaries and the curve; the coders are made once in each Python worker."""

    good: bytes
    bad: bytes
    slope: float = 0.0
    level: float = 0.0
    #: The difference of a text that says nothing, which short texts are drawn to.
    usual: float = 0.0
    strength: int = 6
    stretch: int = 1024
    prior_bytes: int = 100
    _coders: list = field(default_factory=list, repr=False)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_coders": []}

    def coders(self) -> list[zstandard.ZstdCompressor]:
        if not self._coders:
            for data in (self.good, self.bad):
                own = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                parameters = zstandard.ZstdCompressionParameters.from_level(
                    self.strength,
                    source_size=self.stretch,
                    dict_size=len(data),
                    write_content_size=False,
                    write_dict_id=False,
                )
                own.precompute_compress(compression_params=parameters)
                self._coders.append(
                    zstandard.ZstdCompressor(dict_data=own, compression_params=parameters)
                )
        return self._coders

    def sizes(self, text: str | None) -> tuple[int, int, int]:
        """Bytes of the whole text: encoded with the good and with the bad dictionary, and plain."""
        data = (text or "").encode("utf-8", "surrogatepass")
        parts = [data[a : a + self.stretch] for a in range(0, len(data), self.stretch)]
        good, bad = (sum(len(c.compress(p)) for p in parts) for c in self.coders())
        return good, bad, len(data)

    def difference(self, good: float, bad: float, plain: float) -> float:
        """(bad - good) / plain, after adding ``prior_bytes`` of text with the usual difference."""
        return (bad - good + self.prior_bytes * self.usual) / (plain + self.prior_bytes)

    def score(self, text: str | None) -> float:
        z = self.level + self.slope * self.difference(*self.sizes(text)) if self.good else self.level
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -30.0, 30.0))))


def labelled_ids(labels: DataFrame, label: str) -> DataFrame:
    """``doc_id, label``: ids to learn from, labelled 0 or 1 and not held out.

    Of an id that is labelled both ways neither label counts.
    """
    marks = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
    marks = marks.where(~held_out(F.col("doc_id"))).groupBy("doc_id")
    marks = marks.agg(F.min(label).alias("label"), F.max(label).alias("other"))
    return marks.where("label = other").select("doc_id", F.col("label").cast("int").alias("label"))


def _sample(ids: DataFrame, per_label: int, fold: int) -> DataFrame:
    """Of each label ``per_label`` ids of one of two folds, those that hash lowest.

    Each label's are found as the first rows of an order, not in a group of their own.
    """
    place, spread = F.xxhash64("doc_id"), F.xxhash64("doc_id", F.lit("order"))
    rows = ids.where(F.pmod(place, F.lit(2)) == fold).withColumns({"place": place, "spread": spread})
    found = [rows.where(F.col("label") == v).orderBy("spread", "doc_id").limit(per_label) for v in (0, 1)]
    return found[0].unionAll(found[1])


def _texts(docs: DataFrame, sample: DataFrame, most_chars: int | None) -> DataFrame:
    """``label, spread, doc_id, text`` of the sampled ids; ids without a text are left out.

    The sample, bounded by its parameters, goes to the documents, whose texts stay where they are
    but for the sampled ones. Of rows that repeat an id the least text counts. With
    ``most_chars`` a text is cut to a stretch of it that its id picks.
    """
    text = F.col("text")
    if most_chars is not None:
        begin = F.pmod(F.col("place"), F.greatest(F.char_length(text) - most_chars, F.lit(0)) + 1)
        text = F.substr(text, (begin + 1).cast("int"), F.lit(most_chars))
    rows = docs.where(F.length("text") > 0).select("doc_id", "text")
    rows = rows.join(F.broadcast(sample), "doc_id").select("label", "spread", "doc_id", text.alias("text"))
    return rows.groupBy("label", "spread", "doc_id").agg(F.min("text").alias("text"))


def _curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and level of a logistic curve, by Newton steps with a small ridge on the slope."""
    spread = float(x.std()) or 1.0
    z = np.column_stack([x / spread, np.ones(len(x))])
    ridge, w = np.diag([1e-2, 1e-6]), np.zeros(2)
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (weight * (p - y)) + ridge @ w
        bend = (z * (weight * p * (1 - p))[:, None]).T @ z + ridge
        step = np.linalg.solve(bend, slope)
        step *= min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] / spread), float(w[1])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    per_label: int = 2500,
    most_chars: int = 400,
    calibration_rows: int = 2000,
    strength: int = 6,
    stretch: int = 1024,
) -> Model:
    """Dictionaries and curve from labelled rows that are not held out.

    ``per_label`` pieces of ``most_chars`` characters of each label come to the driver for the
    dictionaries, both cut to the smaller one's length; the curve is fitted on the differences of
    at most ``calibration_rows`` other texts of each label, whole, weighted to the labels' true
    shares. The labels, the texts and the ids that pick rows are all that is looked at.

    With one label only every score is 1 or 0 but for a hundredth; with none it is 0.5.
    """
    ids = table(labelled_ids(labels, label), "labelled-ids")
    counts = {r["label"]: r["count"] for r in ids.groupBy("label").count().collect()}
    if len(counts) < 2:
        known = [float(v) for v in counts]
        return Model(b"", b"", level=4.6 * (2 * known[0] - 1) if known else 0.0)
    sample = table(_texts(docs, _sample(ids, per_label, 0), most_chars), "quality-texts")
    data = {0: b"", 1: b""}
    pieces: dict[int, list[str]] = {0: [], 1: []}
    for r in sample.orderBy("label", "spread", "doc_id").select("label", "text").collect():
        pieces[r["label"]].append(r["text"])
    for value, texts in pieces.items():
        data[value] = "\n".join(dict.fromkeys(texts)).encode("utf-8", "surrogatepass")
    most = min(len(d) for d in data.values())
    if most < 64:
        return Model(b"", b"", level=float(np.log(counts[1] / counts[0])))
    # Equal sizes, or the larger one would win by its size.
    model = Model(data[1][:most], data[0][:most], strength=strength, stretch=stretch)
    others = table(_texts(docs, _sample(ids, calibration_rows, 1), None), "quality-texts")
    others = others.select("label", "text")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([model.sizes(t) for t in batch.column("text").to_pylist()], np.int64)
            sizes = sizes.reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), *[pa.array(sizes[:, j]) for j in range(3)]],
                names=["label", "good", "bad", "plain"],
            )

    schema = "label int, good long, bad long, plain long"
    measured = small_batches(others).mapInArrow(measure, schema).collect()
    y = np.array([r["label"] for r in measured], float)
    if len(set(y.tolist())) < 2:
        return Model(b"", b"", level=float(np.log(counts[1] / counts[0])))
    good, bad, plain = (np.array([r[c] for r in measured], float) for c in ("good", "bad", "plain"))
    share = np.where(y == 1, counts[1] / (y == 1).sum(), counts[0] / (y == 0).sum())
    weight = share / share.sum() * len(y)
    model.usual = float((weight * (bad - good) / plain).sum() / weight.sum())
    model.slope, model.level = _curve(model.difference(good, bad, plain), y, weight)
    return model


def predict(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """``docs`` with ``score, predicted`` added, or set where such columns exist.

    Only ``text`` is looked at, and all of it. score is the probability of label 1. Null and empty
    texts get that of a text that says nothing; repeated rows get the same; no documents, no rows.
    """
    names = ("score", "predicted")
    kept = [c for c in docs.columns if c.lower() not in names]
    docs = small_batches(docs).select(*[f"`{c}`" for c in kept])
    at = [c.lower() for c in kept].index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.array([model.score(t.as_py()) for t in batch.column(at)], np.float64)
            columns = [pa.array(scores), pa.array((scores >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *columns], names=[*batch.schema.names, *names]
            )

    schema = StructType(list(docs.schema.fields)).add("score", "double").add("predicted", "integer")
    return docs.mapInArrow(run, schema)
