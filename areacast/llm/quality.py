"""Quality classifier: naive Bayes support vectors.

A text is the set of its n-grams (binary indicators): one to three neighbouring
lower-cased words, and one to three neighbouring word shapes, hashed into
``DIMENSIONS`` slots. Each indicator is scaled by the log-count ratio of its
slot between the two classes, and a linear hinge-loss model is fitted on the
scaled indicators by dual coordinate descent. Scoring is one Arrow pass over
the documents.

Defined cases: a null or empty text has only the bias indicator, so it gets the
score of the bias. Labels other than 0 and 1 are not used. Repeated label rows
count once per distinct (doc_id, quality). Without both classes among the
training rows the score is the only class seen, or 0.5 with none.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areacast.llm.common import byte_texts, in_bucket, written

DIMENSIONS = 1 << 20
#: The classifier is fitted on at most so many labelled documents, the first
#: by hash of their id.
SAMPLE = 16_000
#: Words kept by a worker with their hashes; beyond, the table is begun anew.
KNOWN_WORDS = 400_000


def _shape(word: str) -> str:
    out = []
    for c in word:
        s = "9" if c.isdigit() else "X" if c.isupper() else "x" if c.isalpha() else c
        if len(out) < 2 or out[-1] != s or out[-2] != s:
            out.append(s)
    return "".join(out)


class _Words(dict):
    """word -> crc32 of the lower-cased word, above crc32 of its shape."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        shape = _shape(word.decode("utf-8", "replace")).encode()
        value = self[word] = zlib.crc32(word.lower()) << 32 | zlib.crc32(shape)
        return value


_WORDS = _Words()


def _slots(values: np.ndarray, kind: int) -> np.ndarray:
    mixed = (values + np.uint64(kind)) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(40)).astype(np.uint32) % np.uint32(DIMENSIONS - 1) + np.uint32(1)


def _chained(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the neighbouring pairs and triples of ``values``."""
    pair = values[1:] * np.uint64(0xC2B2AE3D27D4EB4F) + values[:-1]
    return pair, pair[1:] * np.uint64(0xC2B2AE3D27D4EB4F) + values[:-2]


def indicators(text: bytes | None) -> np.ndarray:
    """The distinct slots of a text's n-grams, in order; slot 0 is the bias."""
    words = text.split() if text else []
    n = len(words)
    if not n:
        return np.zeros(1, np.uint32)
    both = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, n)
    shape = both & np.uint64(0xFFFFFFFF)
    same = np.zeros(n, np.uint64)
    same[1:] = both[1:] == both[:-1]
    shape = shape * np.uint64(2) + same
    word = both >> np.uint64(32)
    kinds = (word, shape, *_chained(shape), *_chained(word))
    found = [np.zeros(1, np.uint32), *(_slots(values, kind) for kind, values in enumerate(kinds, 1))]
    return np.unique(np.concatenate(found))


@dataclass(frozen=True)
class QualityModel:
    """``weights`` holds a margin's share for each slot."""

    weights: np.ndarray

    def score(self, text: bytes | None) -> float:
        margin = float(self.weights[indicators(text)].sum())
        return float(1.0 / (1.0 + np.exp(-np.clip(margin, -500, 500))))


def _indicator_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = [indicators(t).tobytes() for t in byte_texts(b.column(1))]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.binary())], ["label", "slots"])


def hinge_fit(rows: list[np.ndarray], labels: np.ndarray, cost: float = 0.02, epochs: int = 12, smoothing: float = 1.0, seed: int = 7) -> np.ndarray:
    """Weights by slot. Log-count ratios of the indicators, then dual coordinate
    descent on the hinge loss; a class's cost is inverse to its share."""
    y = np.where(labels > 0, 1.0, -1.0)
    counts = {s: np.full(DIMENSIONS, smoothing) for s in (1.0, -1.0)}
    for r, c in zip(rows, y):
        counts[c][r] += 1.0  # a row's slots are distinct
    ratio = np.log(counts[1.0] / counts[1.0].sum()) - np.log(counts[-1.0] / counts[-1.0].sum())
    ratio[0] = 1.0
    norms = np.array([max(float(x @ x), 1e-12) for x in (ratio[r] for r in rows)])
    share = {s: max(float((y == s).mean()), 1e-9) for s in (1.0, -1.0)}
    bound = np.array([cost * 0.5 / share[s] for s in y])
    alpha, w = np.zeros(len(rows)), np.zeros(DIMENSIONS)
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            slots, x = rows[i], ratio[rows[i]]
            gradient = y[i] * float(w[slots] @ x) - 1.0
            new = min(max(alpha[i] - gradient / norms[i], 0.0), bound[i])
            if new != alpha[i]:
                w[slots] += (new - alpha[i]) * y[i] * x
                alpha[i] = new
    return 2.0 * w * ratio


def fit_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> QualityModel:
    """Fits on at most ``sample`` documents that have a label in ``labels``
    (doc_id, quality). The sample's size is the bound of what is broadcast and
    of what reaches the driver."""
    chosen = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
        .select(F.col("doc_id").alias("label_id"), F.col("quality").cast("int").alias("label"))
        .distinct()
        .orderBy(F.xxhash64("label_id"), "label_id", "label")
        .limit(sample)
    )
    found = (
        docs.select("doc_id", "text")
        .join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id"))
        .select("label", "text")
        .mapInArrow(_indicator_rows, "label int, slots binary")
    )
    # The driver's JVM holds a part of the sample at a time.
    rows = list(written(found, "quality-sample").toLocalIterator())
    # An order of the rows that does not depend on how they were read.
    rows.sort(key=lambda r: (r.label, r.slots))
    y = np.array([r.label for r in rows], int)
    if len(set(y.tolist())) < 2:
        bias = np.zeros(DIMENSIONS)
        bias[0] = 0.0 if not len(y) else 20.0 if y[0] else -20.0
        return QualityModel(bias.astype(np.float64))
    return QualityModel(hinge_fit([np.frombuffer(r.slots, np.uint32) for r in rows], y))


def score_quality(docs: DataFrame, model: QualityModel, text: str = "text") -> DataFrame:
    """All columns of ``docs`` but score and predicted, and then these two."""
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    schema = docs.select(*kept).schema.add("score", "double").add("predicted", "integer")
    weights = docs.sparkSession.sparkContext.broadcast(model.weights)  # DIMENSIONS doubles

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = QualityModel(weights.value)
        for b in batches:
            scores = np.array([own.score(t) for t in byte_texts(b.column(b.schema.get_field_index(text)))])
            columns = [*b.columns, pa.array(scores, pa.float64()), pa.array((scores >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "score", "predicted"])

    return docs.select(*kept).mapInArrow(scored, schema)


def quality_scores(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score and predicted of every document; labels of the
    held-out third (remainder 1) are not learnt from."""
    labels = labels.where(~in_bucket("doc_id", 3, 1))
    scores = score_quality(docs.select("doc_id", "text"), fit_quality(docs, labels, sample))
    return scores.select("doc_id", in_bucket("doc_id", 3, 1).alias("held_out"), "score", "predicted")
