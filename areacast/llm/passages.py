"""Substring dedup by difference-cover anchors.

A word of a document goes if a window of ``WINDOW`` words that covers it also
starts in a document with a smaller id. Hashing every window of every document
would shuffle a row for each word. Instead, only ``ANCHOR`` words are hashed,
and only at places of a difference cover modulo ``PERIOD``: for any two places
there is a shift below the period that puts both on the cover. As PERIOD +
ANCHOR - 1 <= WINDOW, two equal windows share an anchor at aligned places. So

1. each chunk of documents sends its distinct anchors to hash buckets;
2. a bucket tells each chunk which of its anchors another document has too;
3. a chunk extends its shared anchors to the windows around them and sends
   these windows' hashes with its least document id for each, and to itself
   the places of these windows;
4. a bucket tells a chunk which of its windows start in a smaller document of
   another chunk;
5. the chunk hashes the windows of those places once more, finds those told, and
   those that a smaller document of its own has, and removes the covered words.

So no window apart from shared anchors is hashed at all: a window that another
document has, of the same chunk or not, has an anchor that it shares.

Chunks are dealt by a hash of id and text and hold about ``CHUNK_BYTES``; a
chunk's texts are shuffled once, to at least as many partitions as there are
chunks, and read from that shuffle by 1, 3 and 5, in the order of id and text.
What chunks and buckets exchange are packed arrays with each value once per
chunk, so a passage that many documents share costs one value per chunk and
bucket work is linear in it: no pairs of occurrences are made.

Words are known by their 64-bit hash, and windows by two 64-bit hashes of the
word hashes. Rows equal in id and text fall into one chunk.

Words are runs of non-blanks (ASCII blanks), unchanged. Defined cases: null and
empty texts have no words, and an empty kept text. Documents of fewer words
than a window, and rows with a null id, keep all words and remove none
elsewhere. Rows with the same id are one document: not smaller than each other.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areacast.llm.common import byte_texts, mix64

WINDOW = 13
ANCHOR = 7
PERIOD = 7
COVER = (0, 1, 3)
CHUNK_BYTES = 8 << 20
#: Texts whose anchors a bucket gathers.
BUCKET_BYTES = 16 << 20


def pack(*columns: np.ndarray) -> bytes:
    """64-bit columns, the first ascending, as compressed byte planes."""
    first = np.diff(columns[0], prepend=columns[0].dtype.type(0))
    planes = [np.ascontiguousarray(c).view(np.uint8).reshape(-1, 8).T.tobytes() for c in (first, *columns[1:])]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unpack(blob: bytes, columns: int) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(columns, 8, -1)
    out = [np.ascontiguousarray(p.T).view(np.uint64).reshape(-1) for p in raw]
    out[0] = np.cumsum(out[0], dtype=np.uint64)
    return out


def _bucket_edges(values: np.ndarray, buckets: int) -> np.ndarray:
    """Where the ascending values' buckets begin; a bucket is a range of hashes."""
    step = (1 << 64) // buckets + 1
    return np.append(np.searchsorted(values, np.array([min(step * k, (1 << 64) - 1) for k in range(buckets)], np.uint64)), len(values))


class Chunk:
    """The words of a chunk's documents, in an order that does not depend on the
    order of ``rows``. ``places``: the windows that count; only their words are
    hashed (all, if not given)."""

    def __init__(self, rows: pa.Table, places: np.ndarray | None = None):
        rows = rows.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        self.ids = rows.column("doc_id")
        ids = self.ids.to_numpy() if not self.ids.null_count else self.ids.fill_null(0).to_numpy()
        self.words = [t.split() if t else [] for t in byte_texts(rows.column("text"))]
        self.sizes = np.array([len(w) for w in self.words], np.int64)
        self.ends = np.cumsum(self.sizes)
        n = int(self.sizes.sum())
        digest = xxhash.xxh64_intdigest
        if places is None:
            self.hashes = np.fromiter((digest(w) for words in self.words for w in words), np.uint64, n)
        else:
            use = np.zeros(n + 1, np.int64)
            np.add.at(use, places, 1)
            np.add.at(use, places + WINDOW, -1)
            at = np.flatnonzero(np.cumsum(use[:-1]) > 0)
            flat = [w for words in self.words for w in words]
            self.hashes = np.zeros(n, np.uint64)
            self.hashes[at] = np.fromiter((digest(flat[k]) for k in at.tolist()), np.uint64, len(at))
        self.doc = np.repeat(np.arange(len(ids)), self.sizes)
        self.id = ids[self.doc]
        self.offset = np.arange(n) - np.repeat(self.ends - self.sizes, self.sizes)
        self.left = np.repeat(self.ends, self.sizes) - np.arange(n)  # words from here on
        usable = self.sizes >= WINDOW
        if self.ids.null_count:
            usable &= self.ids.is_valid().to_numpy()
        self.usable = usable[self.doc]

    def _rolled(self, at: np.ndarray, length: int, seed: int) -> np.ndarray:
        """A hash of the ``length`` words from each of the places on."""
        h = np.full(len(at), seed, np.uint64)
        for k in range(length):
            h = h * np.uint64(0x9E3779B97F4A7C15) + self.hashes[at + k]
            if k % 4 == 3:
                h = mix64(h)
        return mix64(h)

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Places and (even) hashes of the anchors."""
        on = np.isin(np.arange(PERIOD), COVER)[self.offset % PERIOD] & self.usable & (self.left >= ANCHOR)
        at = np.flatnonzero(on)
        return at, self._rolled(at, ANCHOR, 1) & ~np.uint64(1)

    def windows_at(self, anchors: np.ndarray) -> np.ndarray:
        """Places of the windows that hold one of the anchors: from a place on,
        those at it and up to WINDOW - ANCHOR further."""
        near = np.zeros(len(self.hashes) + 1, np.int64)
        np.add.at(near, np.maximum(anchors - (WINDOW - ANCHOR), 0), 1)
        np.add.at(near, anchors + 1, -1)
        return np.flatnonzero((np.cumsum(near[:-1]) > 0) & self.usable & (self.left >= WINDOW))

    def windows(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Both hashes of the windows at these places."""
        return self._rolled(at, WINDOW, 2), self._rolled(at, WINDOW, 3)


def _groups(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by (a, b), and the starts of equal pairs in that order."""
    order = np.argsort(a)
    same = a[order][1:] == a[order][:-1]
    if (same & (b[order][1:] != b[order][:-1])).any():
        order = np.lexsort((b, a))
        same = a[order][1:] == a[order][:-1]
    same &= b[order][1:] == b[order][:-1]
    return order, np.flatnonzero(np.append(True, ~same)) if len(a) else np.zeros(0, int)


def _table(**columns) -> pa.Table:
    kinds = {"bucket": pa.int64(), "chunk": pa.int64()}
    return pa.table({k: pa.array(v, kinds.get(k, pa.binary())) for k, v in columns.items()})


def _by_bucket(chunk: int, buckets: int, first: np.ndarray, *more: np.ndarray) -> pa.Table:
    edges = _bucket_edges(first, buckets)
    full = np.flatnonzero(np.diff(edges))
    blobs = [pack(first[edges[k] : edges[k + 1]], *(m[edges[k] : edges[k + 1]] for m in more)) for k in full]
    return _table(bucket=full, chunk=[chunk] * len(full), blob=blobs)


def _by_chunk(chunks: np.ndarray, first: np.ndarray, *more: np.ndarray) -> pa.Table:
    """A blob for each chunk; ``first`` ascends."""
    order = np.argsort(chunks, kind="stable")
    names, starts = np.unique(chunks[order], return_index=True)
    parts = np.split(order, starts[1:]) if len(names) else []
    return _table(chunk=names, blob=[pack(first[p], *(m[p] for m in more)) for p in parts])


def _gathered(rows: pa.Table, columns: int) -> list[np.ndarray]:
    """The chunk of each value, and the values, of a bucket's blobs."""
    blobs = [unpack(b, columns) for b in rows.column("blob").to_pylist()]
    chunks = np.repeat(rows.column("chunk").to_numpy(), [len(b[0]) for b in blobs])
    return [chunks, *(np.concatenate([b[k] for b in blobs]) for k in range(columns))]


def _send_anchors(buckets: int):
    def run(rows: pa.Table) -> pa.Table:
        chunk = Chunk(rows)
        at, h = chunk.anchors()
        order = np.argsort(h)
        h, ids = h[order], chunk.id[at[order]]
        starts = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.zeros(0, int)
        several = np.minimum.reduceat(ids, starts) != np.maximum.reduceat(ids, starts) if len(h) else np.zeros(0, bool)
        return _by_bucket(rows.column("chunk")[0].as_py(), buckets, h[starts] | several.astype(np.uint64))

    return run


def _shared_anchors(rows: pa.Table) -> pa.Table:
    chunks, h = _gathered(rows, 1)
    order = np.argsort(h)
    chunks, h = chunks[order], h[order]
    key = h & ~np.uint64(1)
    starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    sizes = np.diff(np.append(starts, len(key)))
    shared = np.repeat((sizes > 1) | (np.add.reduceat(h & np.uint64(1), starts) > 0), sizes)
    return _by_chunk(chunks[shared], key[shared])


def _merged(rows: pa.Table, columns: int) -> list[np.ndarray]:
    """What the buckets told a chunk, ascending by the first column."""
    if not rows.num_rows:
        return [np.zeros(0, np.uint64)] * columns
    parts = _gathered(rows, columns)[1:]
    order = np.argsort(parts[0])
    return [p[order] for p in parts]


def _member(values: np.ndarray, ascending: np.ndarray) -> np.ndarray:
    if not len(ascending):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(ascending, values), len(ascending) - 1)
    return ascending[at] == values


def _send_windows(buckets: int):
    def run(rows: pa.Table, told: pa.Table) -> pa.Table:
        if not rows.num_rows or not told.num_rows:
            return _table(bucket=[], chunk=[], blob=[])
        chunk = Chunk(rows)
        at, h = chunk.anchors()
        start = chunk.windows_at(at[_member(h, _merged(told, 1)[0])])
        if not len(start):
            return _table(bucket=[], chunk=[], blob=[])
        w, v = chunk.windows(start)
        order, first = _groups(w, v)
        least = np.minimum.reduceat(chunk.id[start[order]], first)
        number = rows.column("chunk")[0].as_py()
        to_itself = _table(bucket=[buckets + number], chunk=[number], blob=[pack(start.view(np.uint64))])
        return pa.concat_tables([_by_bucket(number, buckets, w[order][first], v[order][first], least.view(np.uint64)), to_itself])

    return run


def _windows_elsewhere(buckets: int):
    def run(rows: pa.Table) -> pa.Table:
        if rows.column("bucket")[0].as_py() >= buckets:  # a chunk's own places
            return pa.table({"chunk": rows.column("chunk"), "own": pa.array([True] * rows.num_rows, pa.bool_()), "blob": rows.column("blob")})
        chunks, w, v, ids = _gathered(rows, 3)
        order, starts = _groups(w, v)
        chunks, w, v, ids = chunks[order], w[order], v[order], ids[order].view(np.int64)
        least = np.repeat(np.minimum.reduceat(ids, starts), np.diff(np.append(starts, len(w))))
        tell = least < ids
        told = _by_chunk(chunks[tell], w[tell], v[tell])
        return pa.table({"chunk": told.column("chunk"), "own": pa.array([False] * told.num_rows, pa.bool_()), "blob": told.column("blob")})

    return run


def _keep(rows: pa.Table, told: pa.Table) -> pa.Table:
    own = told.column("own")
    places = told.filter(own).column("blob").to_pylist()
    start = unpack(places[0], 1)[0].view(np.int64) if places else np.zeros(0, np.int64)
    chunk = Chunk(rows, start)
    gone = np.zeros(len(chunk.hashes) + 1, np.int64)
    if len(start):
        w, v = chunk.windows(start)
        order, first = _groups(w, v)
        ids = chunk.id[start[order]]
        sizes = np.diff(np.append(first, len(order)))
        repeated = ids > np.repeat(np.minimum.reduceat(ids, first), sizes)
        far, far2 = _merged(told.filter(pa.compute.invert(own)), 2)
        hit = np.flatnonzero(_member(w[order], far))
        if len(hit):
            pair = set(zip(far.tolist(), far2.tolist()))
            sure = [p in pair for p in zip(w[order[hit]].tolist(), v[order[hit]].tolist())]
            repeated[hit[sure]] = True
        at = start[order[repeated]]
        np.add.at(gone, at, 1)
        np.add.at(gone, at + WINDOW, -1)
    keep = np.cumsum(gone[:-1]) == 0
    kept, removed = [], []
    for words, end in zip(chunk.words, chunk.ends.tolist()):
        stays = keep[end - len(words) : end]
        removed.append(len(words) - int(stays.sum()))
        kept.append((b" ".join(words) if not removed[-1] else b" ".join([w for w, k in zip(words, stays.tolist()) if k])).decode())
    return pa.table({"doc_id": chunk.ids, "n_words": pa.array(chunk.sizes), "n_removed": pa.array(removed, pa.int64()), "kept": pa.array(kept, pa.string())})


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and kept (the kept words, a space between) of
    every document."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks, buckets = max(1, -(-size // CHUNK_BYTES)), max(1, -(-size // BUCKET_BYTES))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn(
        "chunk", F.pmod(F.xxhash64("doc_id", F.xxhash64("text")), F.lit(chunks))
    )
    # Partitions follow the bytes, so that a task's texts do not grow with them.
    usual = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = lambda n: max(usual, n)
    sent, told = "bucket long, chunk long, blob binary", "chunk long, blob binary"
    mine = texts.repartition(parts(chunks), "chunk").groupBy("chunk")
    shared = mine.applyInArrow(_send_anchors(buckets), sent).repartition(parts(buckets), "bucket").groupBy("bucket").applyInArrow(_shared_anchors, told)
    windows = mine.cogroup(shared.repartition(parts(chunks), "chunk").groupBy("chunk")).applyInArrow(_send_windows(buckets), sent)
    elsewhere = windows.repartition(parts(buckets + chunks), "bucket").groupBy("bucket").applyInArrow(_windows_elsewhere(buckets), "chunk long, own boolean, blob binary")
    return mine.cogroup(elsewhere.repartition(parts(chunks), "chunk").groupBy("chunk")).applyInArrow(_keep, "doc_id long, n_words long, n_removed long, kept string")


def repeat_removal(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every document."""
    return without_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
