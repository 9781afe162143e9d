"""SimHash near-duplicates: BK-trees over fingerprints.

Fingerprints are computed in one Arrow pass; equal ones are joined into one
row. Two fingerprints that differ in at most r of 64 bits agree in at least one
of r + 1 bands of bits, so each distinct fingerprint goes to the shards of its
r + 1 band values, or of so many of their bits that a shard has about
``NODES`` fingerprints. A shard builds the BK-tree of its nodes (children keyed by
their integer Hamming distance to the parent), and each of the shard's
fingerprints follows only the edges whose key lies within r of its own distance
to the node. A shard of more than ``SHARD`` fingerprints is split: its nodes
are dealt over several trees, and its fingerprints search each of them.

A fingerprint of a large share of the rows gets its component by a broadcast of
such fingerprints (at most ``HOT``), so that its rows do not meet in one task.

The trees reach the searching tasks by the shuffle that also brings these the
fingerprints, and never pass through the driver. Shards return a spanning
forest of the links found, at most one row per fingerprint, not all pairs.

Defined cases: a null text is an empty one; a text without words has the
fingerprint zero, which links like any other. Rows with a null id have a
fingerprint, take no part in linking and get a null component. Repeated ids are
one document with several fingerprints; they share one component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areacast.llm.common import byte_texts, written

#: Nodes of one BK-tree at most, but for the unevenness of a hash; and about how
#: many it has while part of the bits of a band can choose the shards.
SHARD, NODES = 16_384, 256
#: Fingerprints of more than this part of the rows are joined apart.
HOT = 1000
#: Fingerprints that a task holds at once, but for those of one shard.
_HELD = 200_000
#: (fingerprint, node) pairs compared at once.
_PAIRS = 1_000_000
#: Shingles whose bits are counted at once.
_ROWS = 65_536


def fingerprint(text: bytes | None, words: int = 3) -> int:
    """The unsigned 64-bit SimHash of the word shingles of a text, ASCII-lower-cased."""
    found = text.lower().split() if text else []
    if not found:
        return 0
    line = b" ".join(found)
    if len(found) <= words:
        return xxhash.xxh64_intdigest(line, 42)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    stops = ends[words - 1 :].tolist()
    starts = [0, *(ends[: len(found) - words] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[a:b], 42) for a, b in zip(starts, stops)), np.uint64, len(stops))
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), _ROWS):
        part = np.ascontiguousarray(hashes[k : k + _ROWS])
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def with_fingerprint(docs: DataFrame, words: int = 3, text: str = "text") -> DataFrame:
    """doc_id and fp, the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t, words) for t in byte_texts(b.column(1))], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, fp long")


class BKForest:
    """BK-trees in arrays. A tree for each distinct key; its root is the first
    of the key's fingerprints. The children of a node follow each other."""

    def __init__(self, keys: np.ndarray, fps: np.ndarray):
        order = np.argsort(keys, kind="stable")
        self.keys, first = np.unique(keys[order], return_index=True)
        self.item = np.empty(len(fps), np.int64)  # a node's place in fps
        self.edge = np.zeros(len(fps), np.int16)  # its distance to its parent
        self.child, self.children = np.zeros(len(fps), np.int64), np.zeros(len(fps), np.int64)
        self.fps = fps
        # Level by level: the first item of a group is a node, the rest go on to
        # its children, grouped by their distance to it.
        items, starts, made = order, first, 0
        parents = np.full(len(starts), -1)
        while len(items):
            sizes = np.diff(np.append(starts, len(items)))
            nodes = np.arange(made, made + len(starts))
            self.item[nodes] = items[starts]
            rooted = parents >= 0
            np.add.at(self.children, parents[rooted], 1)
            begin = np.flatnonzero(np.append(True, parents[1:] != parents[:-1]) & rooted)
            self.child[parents[begin]] = nodes[begin]
            made += len(starts)
            owner = np.repeat(np.arange(len(starts)), sizes)
            rest = np.ones(len(items), bool)
            rest[starts] = False
            items, owner = items[rest], owner[rest]
            if not len(items):
                break
            distance = np.bitwise_count(fps[items] ^ fps[self.item[nodes[owner]]]).astype(np.int64)
            group = owner * 65 + distance
            by = np.argsort(group, kind="stable")
            items, group = items[by], group[by]
            starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
            parents = nodes[group[starts] // 65]
            self.edge[made : made + len(starts)] = group[starts] % 65

    def search(self, keys: np.ndarray, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (place in fps, place in the forest's fps) within the radius."""
        root = np.searchsorted(self.keys, keys)
        root[root == len(self.keys)] = 0
        query = np.flatnonzero(self.keys[root] == keys) if len(self.keys) else np.zeros(0, np.int64)
        node, hits = root[query], []
        while len(query):
            distance = np.bitwise_count(fps[query] ^ self.fps[self.item[node]]).astype(np.int16)
            near = distance <= radius
            hits.append((query[near], self.item[node[near]]))
            many = self.children[node]
            flat = np.repeat(np.arange(len(query)), many)
            step = np.arange(len(flat)) - np.repeat(np.cumsum(many) - many, many)
            below = self.child[node][flat] + step
            along = np.abs(self.edge[below] - distance[flat]) <= radius
            query, node = query[flat[along]], below[along]
        if not hits:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([h[0] for h in hits]), np.concatenate([h[1] for h in hits])


def _least_labels(n: int, a: np.ndarray, b: np.ndarray, label: np.ndarray) -> np.ndarray:
    """The least label reachable over the edges a-b and those that made
    ``label``, by hooking roots and shortcuts. ``label`` holds a place in the
    order of the items. Only roots are hooked, so an item never leaves those
    that earlier edges linked it to."""
    label = label.copy()
    while True:
        while (label[label] != label).any():
            label = label[label]
        one, other = label[a], label[b]
        apart = one != other
        if not apart.any():
            return label
        a, b, one, other = a[apart], b[apart], one[apart], other[apart]
        np.minimum.at(label, np.maximum(one, other), np.minimum(one, other))


def _linked(keys, fps, ids, nodes, queries, radius) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Spanning links (id, least id of its local component) of whole shards."""
    place = np.flatnonzero(nodes)
    forest = BKForest(keys[place], fps[place])
    asked = np.flatnonzero(queries)
    sizes = np.bincount(np.searchsorted(forest.keys, keys[place]), minlength=len(forest.keys)) if len(place) else np.zeros(0, int)
    at = np.minimum(np.searchsorted(forest.keys, keys[asked]), max(len(forest.keys) - 1, 0))
    work = np.cumsum(sizes[at]) if len(forest.keys) else np.zeros(len(asked))
    # A row stands for its id: the same id may be a node here and a query there.
    known, number = np.unique(ids, return_inverse=True)
    label = np.arange(len(known))
    start = 0
    while start < len(asked):
        stop = max(start + 1, int(np.searchsorted(work, (work[start - 1] if start else 0) + _PAIRS, "right")))
        part = asked[start:stop]
        q, p = forest.search(keys[part], fps[part], radius)
        label = _least_labels(len(known), number[part[q]], number[place[p]], label)
        start = stop
    moved = np.flatnonzero(label != np.arange(len(known)))
    if len(moved):
        yield known[moved], known[label[moved]]


def _search_shards(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def go(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
            shard, fp, doc, role = rows
            for a, b in _linked(shard, fp.view(np.uint64), doc, role < 2, role > 0, radius):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            held.append(np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(4)]))
            if sum(x.shape[1] for x in held) < _HELD:
                continue
            rows = np.concatenate(held, axis=1)
            last = np.searchsorted(rows[0], rows[0, -1])
            if last:
                yield from go(rows[:, :last])
                rows = rows[:, last:]
            if rows.shape[1] >= _HELD:  # one shard: its nodes came first and stay
                yield from go(rows)
                rows = rows[:, rows[3] < 2]
                rows[3] = 0
            held = [rows]
        if held:
            yield from go(np.concatenate(held, axis=1))

    return run


def near_links(distinct: DataFrame, radius: int = 3, shard: int = SHARD) -> DataFrame:
    """Links a, b (b the smaller id) that span the classes of ``distinct``
    (id, fp; each fp once) under a distance of at most ``radius`` bits."""
    bands = radius + 1
    width = -(-64 // bands)
    # Bits of a band's value that choose the shard: its lowest ones.
    bits = min(width, max(0, (distinct.count() // NODES).bit_length()))
    keys: list[Column] = [
        F.xxhash64(F.lit(k), F.shiftrightunsigned("fp", k * width).bitwiseAND(F.lit((1 << max(0, min(bits, 64 - k * width))) - 1)) if radius else F.col("fp"))
        for k in range(bands)
    ]
    rows = distinct.select("id", "fp", F.explode(F.array(*keys)).alias("band"))
    crowded = (
        rows.groupBy("band").count().where(F.col("count") > shard)
        .select(F.col("band").alias("hot"), F.ceil(F.col("count") / F.lit(shard)).cast("int").alias("parts"))
    )
    # role 0: a node, 1: a node that also asks, 2: only asks.
    dealt = rows.join(crowded, F.col("band") == F.col("hot"), "left").withColumn("own", F.pmod(F.xxhash64("fp"), F.coalesce("parts", F.lit(1))).cast("int"))
    placed = dealt.select("id", "fp", "band", "own", F.explode(F.when(F.col("parts").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("parts") - 1))).alias("part"))
    asked = placed.select(
        F.xxhash64("band", "part").alias("shard"), "fp", "id",
        F.when(F.col("part") == F.col("own"), 1).otherwise(2).cast("long").alias("role"),
    )
    return (
        asked.repartition("shard").sortWithinPartitions("shard", "role")
        .mapInArrow(_search_shards(radius), "a long, b long")
    )


def least_reachable(links: DataFrame, name: str = "components") -> DataFrame:
    """id and component (least id reachable) of all ids in ``links`` (a, b), by
    alternating large and small stars until nothing moves. Each round is
    written to the shared folder; a star's least id is a partial aggregate."""

    def large(e: DataFrame) -> DataFrame:  # each larger neighbour goes to the least id of the star
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select("b", "a"))
        least = both.groupBy(F.col("u").alias("center")).agg(F.least(F.min("v"), F.min("u")).alias("m"))
        return both.join(least, F.col("u") == F.col("center")).where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()

    def small(e: DataFrame) -> DataFrame:  # smaller neighbours and the id itself go to the least of them
        down = e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v")
        least = down.groupBy(F.col("u").alias("center")).agg(F.min("v").alias("m"))
        hung = down.join(least, F.col("u") == F.col("center")).where("v != m").select(F.col("v").alias("a"), F.col("m").alias("b"))
        return hung.union(least.select(F.col("center").alias("a"), F.col("m").alias("b"))).distinct()

    edges = written(links.where("a != b").distinct(), name)
    seen = None
    while True:
        edges = written(small(large(edges)), name)
        # Stars only: as many rows as distinct ids, and no center below another.
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
        seen = state


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = 3, shard: int = SHARD) -> DataFrame:
    """doc_id, fp, component_id for each row of ``docs`` (doc_id, text)."""
    prints = written(with_fingerprint(docs, words), "fingerprints")
    known = prints.where(F.col("doc_id").isNotNull())
    distinct = known.groupBy("fp").agg(F.min("doc_id").alias("id"))
    hot = written(prints.groupBy("fp").count().where(F.col("count") > F.lit(prints.count() // HOT)).select("fp"), "hot-fingerprints")
    # A fingerprint's rows hang on its least id; so do all fingerprints of an id.
    repeated = known.groupBy("doc_id").agg(F.min("fp").alias("f"), F.max("fp").alias("g")).where("f != g").select("doc_id")
    own = known.join(repeated, "doc_id", "left_semi").join(distinct, "fp").where("doc_id != id").select("doc_id", "id")
    links = near_links(distinct, radius, shard).union(own)
    classes = least_reachable(links)
    joined = written(distinct.join(classes, "id", "left").select("fp", F.coalesce("component", "id").alias("component_id")), "fingerprint-components")
    few = F.broadcast(hot)
    crowd = prints.join(few, "fp", "left_semi").join(F.broadcast(joined.join(few, "fp", "left_semi")), "fp", "left")
    others = prints.join(few, "fp", "left_anti").join(joined, "fp", "left")
    return crowd.unionByName(others).select(
        "doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")
    )


def near_duplicate_components(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every document."""
    found = near_duplicates(docs)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` without the documents that have a smaller id in their class;
    rows with a null id stay. Repeated rows of a kept id stay too."""
    gone = near_duplicates(docs).where("doc_id != component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
