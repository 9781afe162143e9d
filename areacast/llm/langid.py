"""Language identification by language-bitmask n-gram filters.

N-grams are letter trigrams of lower-cased words with their borders. A trigram
belongs to a language if it is in at least two of its training documents (one,
if the language has fewer than ten) and in ``LEAST`` of them, and its document
rate there is at least ``RELATIVE`` of its highest rate in any language. The
filter is a bit-sliced Bloom filter: slot s holds a bit for each language, a
trigram sets its languages' bits in ``PROBES`` slots, and the AND of a trigram's
slots returns all languages that contain it at once. A text's popcount for a
language, less what the language's false-positive rate would give, decides.

A slice holds 63 languages, those of most trigrams first, and has as many slots
as keep the false-positive rate of its largest language at ``WRONG`` or below: 29
to 57 for each of its trigrams. As a trigram must be in a share of ``LEAST`` of a
language's documents, there are at most 1 / LEAST times as many as a document
has on average, whatever the corpus; and the slices of many rare languages are
small.

Training counts are partial sums by task, then by trigram; only the filter
reaches the driver.

Defined cases: a null text, or one without a letter, is ``und`` with score 0.
Ties go to the smaller name. A text none of whose trigrams is known gets the
language with most training documents, score 0. Without training rows every
text is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from areacast.llm.common import in_bucket, mix64, written

PROBES, WRONG = 3, 0.001
RELATIVE, LEAST = 0.1, 0.0005
_WORD = 63  # languages to a slice of bits


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def trigrams(text: str | None) -> np.ndarray:
    """The letter trigrams of a text, in order; empty without letters."""
    if not text:
        return np.zeros(0, np.int64)
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    codes = np.where(_letters()[codes], codes, 0)
    codes = np.concatenate([[0], codes, [0]])
    codes = codes[np.append(True, (codes[1:] != 0) | (codes[:-1] != 0))]
    found = codes[:-2] << 42 | codes[1:-1] << 21 | codes[2:] if len(codes) > 2 else np.zeros(0, np.int64)
    return found[codes[1:-1] != 0] if len(found) else found


def slot_count(grams: int) -> int:
    """A power of two at which so many trigrams leave a false-positive rate of
    at most WRONG."""
    share = WRONG ** (1 / PROBES)
    return 1 << max(10, int(np.ceil(np.log2(max(grams, 1) * PROBES / -np.log1p(-share)))))


def slots_of(grams: np.ndarray, slots: int) -> list[np.ndarray]:
    return [(mix64(grams.view(np.uint64) ^ np.uint64(0x51_7C_C1 + k)) & np.uint64(slots - 1)).astype(np.int64) for k in range(PROBES)]


@dataclass(frozen=True)
class LanguageFilter:
    """``bits``: the slots of each slice of 63 languages; ``place``: a language's
    slice * 63 + bit."""

    names: list[str]
    bits: list[np.ndarray]
    place: np.ndarray
    most: int  # the language with most training documents

    def fill(self) -> np.ndarray:
        """Each language's false-positive rate."""
        share = [float((self.bits[p // _WORD] >> np.int64(p % _WORD) & 1).mean()) for p in self.place.tolist()]
        return np.array(share) ** PROBES

    def decide(self, text: str | None, wrong: np.ndarray) -> tuple[str, float]:
        grams = trigrams(text)
        if not len(grams) or not self.names:
            return "und", 0.0
        hits, at = np.zeros(len(self.bits) * _WORD), {}
        for k, bits in enumerate(self.bits):
            places = at.setdefault(len(bits), None) or slots_of(grams, len(bits))
            at[len(bits)] = places
            mask = bits[places[0]]
            for p in places[1:]:
                mask = mask & bits[p]
            used = int(np.bitwise_or.reduce(mask))
            for bit in range(_WORD):
                if used >> bit & 1:
                    hits[k * _WORD + bit] = np.count_nonzero(mask >> np.int64(bit) & 1)
        rate = np.clip((hits[self.place] / len(grams) - wrong) / np.maximum(1 - wrong, 1e-9), 0, 1)
        if not rate.any():
            return self.names[self.most], 0.0
        best = int(rate.argmax())
        return self.names[best], float(rate[best] / rate.sum())


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, gram, documents of the batch with it; gram -1: documents."""
    for b in batches:
        by: dict[str, list[np.ndarray]] = {}
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            by.setdefault(lang, []).append(np.append(np.unique(trigrams(text)), -1))
        for lang, found in by.items():
            grams, counts = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(counts)], ["lang", "gram", "n"])


def fit_languages(train: DataFrame) -> LanguageFilter:
    """From the rows of ``train`` (lang, text) with a language and a text."""
    counts = (
        train.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
        .mapInArrow(_document_counts, "lang string, gram long, n long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    )
    sizes = {r.lang: r.n for r in counts.where("gram = -1").collect()}  # a row for each language
    names = sorted(sizes)
    if not names:
        return LanguageFilter([], [], np.zeros(0, np.int64), 0)
    spark = train.sparkSession
    total = spark.createDataFrame([(k, sizes[k]) for k in names], "lang string, total long")
    rated = counts.where("gram != -1").join(F.broadcast(total), "lang").withColumn("rate", F.col("n") / F.col("total"))
    rated = rated.withColumn("top", F.max("rate").over(Window.partitionBy("gram")))
    own = written(
        rated.where((F.col("rate") >= RELATIVE * F.col("top")) & (F.col("rate") >= LEAST) & (F.col("n") >= F.when(F.col("total") < 10, 1).otherwise(2))).select("lang", "gram"),
        "language-trigrams",
    )
    grams = {r.lang: r.n for r in own.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a row for each language
    order = sorted(names, key=lambda k: (-grams.get(k, 0), k))
    slots = [slot_count(grams.get(order[k], 0)) for k in range(0, len(order), _WORD)]
    placed = spark.createDataFrame([(k, i) for i, k in enumerate(order)], "lang string, place long")

    def to_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            grams, place = b.column(0).to_numpy(), b.column(1).to_numpy()
            for at in np.unique(place // _WORD).tolist():
                here = place // _WORD == at
                for slot in slots_of(grams[here], slots[at]):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(slot), at)), pa.array(slot), pa.array(np.int64(1) << place[here] % _WORD)], ["at", "slot", "bit"])

    marked = own.join(F.broadcast(placed), "lang").select("gram", "place")
    filled = marked.mapInArrow(to_slots, "at long, slot long, bit long").groupBy("at", "slot").agg(F.bit_or("bit").alias("bits")).toArrow()
    bits = [np.zeros(n, np.int64) for n in slots]
    at, slot, value = (filled.column(k).to_numpy() for k in ("at", "slot", "bits"))
    for k, part in enumerate(bits):
        part[slot[at == k]] = value[at == k]
    number = {k: i for i, k in enumerate(order)}
    return LanguageFilter(names, bits, np.array([number[k] for k in names]), max(range(len(names)), key=lambda i: (sizes[names[i]], -i)))


def predict_languages(docs: DataFrame, model: LanguageFilter) -> DataFrame:
    """doc_id, lang_pred and score of each row of ``docs`` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    wrong = model.fill()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [shared.value.decide(t, wrong) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], ["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, lang_pred string, score double")


def language_predictions(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learns from the documents that are
    not held out (remainder 0 of 5)."""
    held = in_bucket("doc_id", 5, 0)
    return predict_languages(docs, fit_languages(docs.where(~held))).select("doc_id", held.alias("held_out"), "lang_pred", "score")
