"""Benchmark decontamination: an FM-index for each training shard.

A shard is some consecutive documents of a task, at most ``SHARD_BYTES`` of
text. Its words are numbered by the benchmark's vocabulary; a run of other
words, which no phrase can hold, becomes one separator. The shard's suffix
array (separators are unique symbols, so only runs of known words are compared)
gives its Burrows-Wheeler transform, held in a wavelet matrix. Test phrases are
searched backwards by ranks, all phrases of a block at a time; the rows found
are located through sampled suffix positions and merged into removal spans.

The phrases of a block of benchmark items are broadcast; a block holds at most
``BLOCK_WORDS`` phrase words, and further blocks are further passes over the
documents whose spans are merged by document.

Words are the maximal runs of digits, letters a-z after ASCII lower-casing, and
non-ASCII characters. A window is ``WINDOW`` consecutive words of an item; an
item of fewer words is one window, an item without words none.

Defined cases: null and empty texts have no words. Rows are judged one by one,
so repeated ids keep their own rows. Items with a null id count as an item
whose id is written as an empty string; repeated item rows count once per
distinct id and window. An empty benchmark leaves every document clean.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructType

from areacast.llm.common import byte_texts, pieces, set_apart, written

WINDOW = 13
SHARD_BYTES = 8 << 20
BLOCK_WORDS = 4_000_000
#: Every so many-th suffix position is kept, besides the first of each run.
SAMPLED = 16

_WORD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_WORD).split() if text else []


def suffix_array(text: np.ndarray, known: int) -> np.ndarray:
    """Sorts the suffixes of ``text``; symbols from ``known`` on occur once
    each. Doubles the compared length, over the suffixes still tied."""
    n = len(text)
    order = np.argsort(text)
    sorted_text = text[order]
    head = np.append(True, sorted_text[1:] != sorted_text[:-1]) if n else np.zeros(0, bool)
    first = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[order] = first
    tied = np.flatnonzero(~(head & np.append(head[1:], True))) if n else np.zeros(0, int)
    length = 1
    while len(tied):
        held = order[tied]
        key = first[tied] * (n + 1) + rank[np.minimum(held + length, n)] + 1
        by = np.argsort(key)
        key = key[by]
        order[tied] = held[by]
        new = np.append(True, key[1:] != key[:-1])
        first[tied] = np.maximum.accumulate(np.where(new, tied, 0))
        rank[order[tied]] = first[tied]
        tied = tied[~(new & np.append(new[1:], True))]
        length *= 2
    return order


class WaveletMatrix:
    """Ranks and symbols of a sequence over 0 .. 2**levels - 1."""

    def __init__(self, text: np.ndarray, symbols: int):
        self.n, self.levels = len(text), max(int(symbols - 1).bit_length(), 1)
        self.words, self.counts, self.zeros = [], [], []
        for level in range(self.levels - 1, -1, -1):
            bits = (text >> level) & 1 == 1
            padded = np.zeros((self.n // 64 + 1) * 64, bool)
            padded[: self.n] = bits
            words = np.packbits(padded, bitorder="little").view(np.uint64)
            self.words.append(words)
            self.counts.append(np.append(0, np.cumsum(np.bitwise_count(words), dtype=np.int64)[:-1]))
            self.zeros.append(self.n - int(bits.sum()))
            text = np.concatenate([text[~bits], text[bits]])

    def _ones(self, level: int, i: np.ndarray) -> np.ndarray:
        """One bits before place i of a level."""
        word = i >> 6
        below = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.counts[level][word] + np.bitwise_count(self.words[level][word] & below)

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often the symbol occurs before place i."""
        start = np.zeros_like(i)
        for level in range(self.levels):
            one = symbol >> (self.levels - 1 - level) & 1 == 1
            si, ii = self._ones(level, start), self._ones(level, i)
            start = np.where(one, self.zeros[level] + si, start - si)
            i = np.where(one, self.zeros[level] + ii, i - ii)
        return i - start

    def symbol_and_rank(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at place i, and how often it occurs before."""
        symbol, start = np.zeros_like(i), np.zeros_like(i)
        for level in range(self.levels):
            one = self.words[level][i >> 6] >> (i & 63).astype(np.uint64) & np.uint64(1) == 1
            si, ii = self._ones(level, start), self._ones(level, i)
            start = np.where(one, self.zeros[level] + si, start - si)
            i = np.where(one, self.zeros[level] + ii, i - ii)
            symbol = symbol * 2 + one
        return symbol, i - start


class FMIndex:
    """Over a sequence of symbols 0 .. known - 1, and separators (-1). One more
    separator ends it, so that each symbol has a suffix after it."""

    def __init__(self, text: np.ndarray, known: int):
        text = np.append(text, -1)
        apart = text < 0
        unique = text.astype(np.int64)
        unique[apart] = known + np.arange(apart.sum())
        order = suffix_array(unique, known)
        before = np.where(order > 0, np.where(apart, known, text)[order - 1], known)
        self.bwt = WaveletMatrix(before.astype(np.int64), known + 1)
        counts = np.bincount(text[~apart], minlength=known)
        self.starts = np.append(0, np.cumsum(counts))
        # Kept positions: each SAMPLED-th, and those with a separator before.
        kept = order % SAMPLED == 0
        kept |= before == known
        self.kept, self.positions = kept, order[kept]
        self.place = np.cumsum(kept) - kept

    def search(self, phrases: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row intervals [low, high) of the phrases phrases[o:p], o and p
        neighbours in ``offsets``; a phrase that is not found has low == high."""
        sizes = np.diff(offsets)
        low, high = np.zeros(len(sizes), np.int64), np.full(len(sizes), self.bwt.n)
        alive, step = np.flatnonzero(sizes > 0), 1
        while len(alive):
            symbol = phrases[offsets[alive + 1] - step]
            low[alive] = self.starts[symbol] + self.bwt.rank(symbol, low[alive])
            high[alive] = self.starts[symbol] + self.bwt.rank(symbol, high[alive])
            step += 1
            alive = alive[(low[alive] < high[alive]) & (sizes[alive] >= step)]
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: walks back to a kept position."""
        found, walked = np.full(len(rows), -1), np.zeros(len(rows), np.int64)
        left, rows = np.arange(len(rows)), rows.copy()
        while len(left):
            here = self.kept[rows[left]]
            done = left[here]
            found[done] = self.positions[self.place[rows[done]]] + walked[done]
            left = left[~here]
            symbol, rank = self.bwt.symbol_and_rank(rows[left])
            rows[left] = self.starts[symbol] + rank
            walked[left] += 1
        return found


class Phrases:
    """The distinct windows of some items, over their own vocabulary."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        number = self.vocabulary.setdefault
        for item, words in items:
            ids = [number(w, len(self.vocabulary)) for w in words]
            for k in range(max(len(ids) - window, 0) + 1 if ids else 0):
                owners.setdefault(tuple(ids[k : k + window]), set()).add(item)
        self.names = sorted({o for s in owners.values() for o in s})
        place = {name: k for k, name in enumerate(self.names)}
        self.words = np.array([w for p in owners for w in p], np.int64)
        self.offsets = np.append(0, np.cumsum([len(p) for p in owners])).astype(np.int64)
        self.owners = [sorted(place[o] for o in s) for s in owners.values()]


def _numbered(texts: list[bytes | None], phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of the texts (-1: not in the vocabulary), words by text."""
    get, found, sizes = phrases.vocabulary.get, [], []
    for text in texts:
        words = words_of(text)
        sizes.append(len(words))
        found.append(np.fromiter(map(get, words, repeat(-1)), np.int64, len(words)))
    return np.concatenate([*found, np.zeros(0, np.int64)]), np.array(sizes, np.int64)


def shard_hits(ids: np.ndarray, sizes: np.ndarray, phrases: Phrases) -> Iterator[tuple[int, np.ndarray, list[str]]]:
    """Text, spans (start, stop in its words, merged) and item names, of the
    texts of a shard that hold a phrase."""
    if not len(phrases.owners) or not len(ids):
        return
    ends = np.cumsum(sizes)
    # One separator before each text, and one for each run of other words.
    text = np.insert(ids, ends - sizes, -1)
    origin = np.insert(np.arange(len(ids)), ends - sizes, -1)
    keep = np.append(True, ~((text[1:] < 0) & (text[:-1] < 0)))
    text, origin = text[keep], origin[keep]
    index = FMIndex(text, len(phrases.vocabulary))
    low, high = index.search(phrases.words, phrases.offsets)
    found = np.flatnonzero(high > low)
    if not len(found):
        return
    many = (high - low)[found]
    rows = np.repeat(low[found] - (np.cumsum(many) - many), many) + np.arange(many.sum())
    phrase = np.repeat(found, many)
    start = origin[index.locate(rows)]
    doc = np.searchsorted(ends, start, "right")
    mark = np.zeros(len(ids) + 1, np.int64)
    np.add.at(mark, start, 1)
    np.add.at(mark, start + np.diff(phrases.offsets)[phrase], -1)
    hit = np.cumsum(mark[:-1]) > 0
    pairs = np.unique(doc * len(phrases.owners) + phrase)
    docs, first = np.unique(pairs // len(phrases.owners), return_index=True)
    for d, of_doc in zip(docs.tolist(), np.split(pairs % len(phrases.owners), first[1:])):
        own = np.concatenate([[0], hit[ends[d] - sizes[d] : ends[d]].astype(np.int8), [0]])
        step = np.diff(own)
        spans = np.stack([np.flatnonzero(step == 1), np.flatnonzero(step == -1)], axis=1)
        yield d, spans, [phrases.names[k] for k in sorted({o for p in of_doc.tolist() for o in phrases.owners[p]})]


def _blocks(benchmark: DataFrame, window: int) -> Iterator[Phrases]:
    """The benchmark's items in blocks of at most BLOCK_WORDS phrase words, or
    one item."""
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text").orderBy("item", "text")
    block, held = [], 0
    for row in rows.toLocalIterator():
        words = words_of(row.text.encode() if row.text is not None else None)
        size = max(len(words) - window + 1, 1) * min(len(words), window)
        if block and held + size > BLOCK_WORDS:
            yield Phrases(block, window)
            block, held = [], 0
        block.append((row.item, words))
        held += size
    yield Phrases(block, window)


_SPAN = StructType().add("start", IntegerType()).add("stop", IntegerType())
_FOUND = "n_words long, spans array<struct<start:int,stop:int>>, items array<string>"


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The columns of ``docs`` with n_words, spans (merged word spans hit by a
    window, in order) and items (names of items with a window there, sorted)."""
    kept = [c for c in docs.columns if c not in ("n_words", "spans", "items")]
    base = docs.select(*kept)
    schema = StructType(list(base.schema.fields))
    for name, kind in (("n_words", LongType()), ("spans", ArrayType(_SPAN)), ("items", ArrayType(StringType()))):
        schema = schema.add(name, kind)
    spark = docs.sparkSession
    blocks = _blocks(benchmark, window)
    result, first = None, next(blocks)
    second = next(blocks, None)
    if second is None:
        return base.mapInArrow(_hits_of(spark.sparkContext.broadcast(first), kept), schema)
    # More phrases than one broadcast may hold: a pass for each block, merged by row.
    numbered = written(base.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    for phrases in _chain(first, second, blocks):
        own = numbered.select("_row", "text").mapInArrow(_hits_of(spark.sparkContext.broadcast(phrases), ["_row", "text"]), "_row long, text string, " + _FOUND).drop("text")
        result = own if result is None else result.union(own)
    merged = result.groupBy("_row").agg(
        F.first("n_words").alias("n_words"),
        F.sort_array(F.flatten(F.collect_list("spans"))).alias("found"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    ).select("_row", "n_words", F.expr(_MERGED).alias("spans"), "items")
    return numbered.join(merged, "_row").select(*kept, "n_words", "spans", "items")


#: Joins spans that touch or overlap, in a sorted list.
_MERGED = """aggregate(found, cast(array() as array<struct<start:int,stop:int>>), (done, s) ->
    if(size(done) > 0 and element_at(done, -1).stop >= s.start,
       concat(slice(done, 1, size(done) - 1), array(named_struct('start', element_at(done, -1).start, 'stop', greatest(element_at(done, -1).stop, s.stop)))),
       concat(done, array(s))))"""


def _chain(first: Phrases, second: Phrases, rest: Iterator[Phrases]) -> Iterator[Phrases]:
    yield first
    yield second
    yield from rest


def _hits_of(phrases, names: list[str]):
    span = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "text", SHARD_BYTES):
            ids, sizes = _numbered(byte_texts(b.column(b.schema.get_field_index("text"))), phrases.value)
            spans: list = [[]] * b.num_rows
            items: list = [[]] * b.num_rows
            for d, found, names_found in shard_hits(ids, sizes, phrases.value):
                spans[d] = [{"start": s, "stop": e} for s, e in found.tolist()]
                items[d] = names_found
            columns = [*b.columns, pa.array(sizes), pa.array(spans, span), pa.array(items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, [*names, "n_words", "spans", "items"])

    return run


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated (hits in
    at least a twentieth of the words) of every document."""
    found = benchmark_hits(docs.select("doc_id", "text"), benchmark)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256")).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without its contaminated documents."""
    docs, own = set_apart(docs, ("n_words", "spans", "items", "_row"))
    found = benchmark_hits(docs, benchmark)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return found.where(~((hit > 0) & (20 * hit >= F.col("n_words")))).select(*own)


def cut_spans(text: bytes | None, spans: list[tuple[int, int]]) -> bytes | None:
    """A text without the words of the spans; what stands between kept words
    stays as it is."""
    if text is None or not spans:
        return text
    blank = text.translate(_WORD)
    view = np.frombuffer(blank, np.uint8) != 32
    edge = np.diff(np.concatenate([[0], view.astype(np.int8), [0]]))
    starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    out, at = [], 0
    for a, b in spans:
        out.append(text[at : starts[a]])
        at = int(stops[b - 1])
    out.append(text[at:])
    return b"".join(out)


def remove_spans(found: DataFrame, text: str = "text") -> DataFrame:
    """Cuts the spans of `benchmark_hits` out of its texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = b.schema.get_field_index(text)
            spans = b.column(b.schema.get_field_index("spans")).to_pylist()
            cut = [cut_spans(t, [(s["start"], s["stop"]) for s in own or []]) for t, own in zip(byte_texts(b.column(at)), spans)]
            columns = list(b.columns)
            columns[at] = pa.array([None if t is None else t.decode("utf-8", "replace") for t in cut], pa.string())
            yield pa.RecordBatch.from_arrays(columns, b.schema.names)

    return found.mapInArrow(run, found.schema)

