"""Approximate nearest neighbours by multiprobe p-stable hashing.

Equal vectors are one class; a class carries its smallest ``k + 1`` ids, which
are all that can come among anyone's k nearest. Each of ``TABLES`` tables hashes
the unit vector x by floor((a.x + b) / width) for some Gaussian directions a.
A query visits its own bucket in each table and then the perturbed buckets of
highest estimated success: sets of steps to neighbouring cells, in order of the
sum of squared distances to the cells' borders. The candidates of all tables
meet in an exact rerank by the double-precision cosine.

Buckets are dealt to groups by a hash. A bucket of more than ``CROWDED`` classes
is cut into index parts, one that more than ``ASKED`` queries visit into query
shares, and each pair of a part and a share goes to a group. A query's vector is
sent once to a group, with the keys it visits there. A task holds its group's
queries and streams the group's index rows; it returns each query's best.

The numbers of hash functions and of probes are chosen by `tuned` for each table
of vectors: the exact neighbours of at most ``SAMPLE`` queries, found among all
rows, tell for any number of functions up to the logarithm of the classes how
many probes give the recall ``RECALL``, and a sample of rows how many rows
these visit; the least work wins. So clustered vectors are searched in a few
small buckets however many there are, and a few hundred vectors exhaustively.
Recall on the test vectors is in the README.

Defined cases: null, empty and zero vectors, vectors with null or non-finite
components and rows with a null id take no part. Of rows with the same id the
least vector counts. Vectors of different lengths never meet. A query with
fewer candidates gets fewer rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from areacast.llm.common import mix64, written

TABLES, WIDTH = 4, 2.0
#: Recall that the probes must give the sampled queries, and probes of a table at most.
RECALL, PROBES = 0.95, 1024
#: Queries, and rows, that the numbers of functions and probes are chosen by.
SAMPLE, ROWS = 200, 2048
#: Work of a visit to a bucket, in comparisons of a row.
_VISIT = 4
CROWDED = 20_000
#: Queries of a bucket that meet in one group.
ASKED = 20_000
#: Index rows of a group, about.
GROUP = 40_000
_BEST = 1_000_000  # candidates held before they are reduced


@cache
def probe_order(functions: int, probes: int) -> list[tuple[int, ...]]:
    """Sets of single steps, named by their rank among the 2 * functions steps
    by distance to the border, in order of expected success."""
    m = functions
    if not m:
        return []
    expected = [j * (j + 1) / (4 * (m + 1) * (m + 2)) if j <= m else 1 - (2 * m + 1 - j) / (m + 1) + (2 * m + 1 - j) * (2 * m + 2 - j) / (4 * (m + 1) * (m + 2)) for j in range(1, 2 * m + 1)]
    found: list[tuple[int, ...]] = []
    heap = [(expected[0], (0,))]
    while heap and len(found) < probes:
        score, steps = heapq.heappop(heap)
        if not any(2 * m - 1 - s in steps for s in steps):  # not both ways at once
            found.append(steps)
        last = steps[-1] + 1
        if last < 2 * m:
            heapq.heappush(heap, (score - expected[last - 1] + expected[last], (*steps[:-1], last)))
            heapq.heappush(heap, (score + expected[last], (*steps, last)))
    return found


@cache
def _directions(size: int, table: int, functions: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng([17, size, table])
    return random.normal(size=(size, functions)), random.uniform(0, WIDTH, functions)


def _key(cells: np.ndarray, size: int, table: int) -> np.ndarray:
    """A 64-bit bucket key of rows of cells."""
    h = np.full(len(cells), size * 1024 + table, np.uint64)
    for column in cells.T:
        h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + column.astype(np.int64).view(np.uint64))
    return mix64(h).view(np.int64)


def _cells(unit: np.ndarray, table: int, functions: int) -> tuple[np.ndarray, np.ndarray]:
    a, b = _directions(unit.shape[1], table, functions)
    at = (unit @ a + b) / WIDTH
    cell = np.floor(at)
    return cell.astype(np.int64), at - cell


def own_keys(unit: np.ndarray, functions: int) -> np.ndarray:
    """The bucket of each vector in each table."""
    return np.stack([_key(_cells(unit, t, functions)[0], unit.shape[1], t) for t in range(TABLES)], axis=1)


def visited_keys(unit: np.ndarray, functions: int, probes: int) -> np.ndarray:
    """All buckets a query visits, in order by table."""
    order = probe_order(functions, probes)
    found = []
    for table in range(TABLES):
        cell, inside = _cells(unit, table, functions)
        steps = np.zeros((len(unit), len(order) + 1, functions), np.int64)
        if functions:
            border = np.concatenate([inside**2, (1 - inside) ** 2], axis=1)  # down, up
            ranked = np.argsort(border, axis=1, kind="stable")
            rows = np.arange(len(unit))
            for k, chosen in enumerate(order, 1):
                for s in chosen:
                    which = ranked[:, s]
                    steps[rows, k, which % functions] += np.where(which < functions, -1, 1)
        visited = (cell[:, None, :] + steps).reshape(steps.shape[0] * steps.shape[1], functions)
        found.append(_key(visited, unit.shape[1], table).reshape(len(unit), -1))
    return np.concatenate(found, axis=1)


def _matrix(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of equally long vectors, and the vectors, as doubles."""
    sizes = pa.compute.list_value_length(column).to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    starts = np.cumsum(sizes) - sizes
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield rows, flat[starts[rows][:, None] + np.arange(size)]


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _keyed(keys_of):
    """class, key rows of record batches (class, vector)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_numpy()
            for rows, x in _matrix(b.column(1)):
                for k in range(0, len(rows), 512):
                    keys = keys_of(_unit(x[k : k + 512]))
                    yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids[rows[k : k + 512]], keys.shape[1])), pa.array(keys.ravel())], ["class", "key"])

    return run


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in an order of operations that depends on the rows alone."""
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def _best(found: list[tuple[np.ndarray, ...]], k: int) -> tuple[np.ndarray, ...]:
    """Each query's k best distinct classes."""
    query, cls, score = (np.concatenate([f[j] for f in found]) for j in range(3))
    order = np.lexsort((cls, -score, query))
    query, cls, score = query[order], cls[order], score[order]
    new = np.append(True, (query[1:] != query[:-1]) | (cls[1:] != cls[:-1]))
    query, cls, score = query[new], cls[new], score[new]
    first = np.flatnonzero(np.append(True, query[1:] != query[:-1]))
    rank = np.arange(len(query)) - np.repeat(first, np.diff(np.append(first, len(query))))
    return query[rank < k], cls[rank < k], score[rank < k]


class _Group:
    """The queries of one group."""

    def __init__(self):
        self.ids: list[np.ndarray] = []
        self.vectors: list[np.ndarray] = []
        self.keys: list[np.ndarray] = []
        self.ready = False
        self.found: list[tuple[np.ndarray, ...]] = []

    def close(self):
        self.ready = True
        self.id = np.concatenate([*self.ids, np.zeros(0, np.int64)])
        sizes = [len(k) for k in self.keys]
        key = np.concatenate([*self.keys, np.zeros(0, np.int64)])
        order = np.argsort(key, kind="stable")
        self.key, self.query = key[order], np.repeat(np.arange(len(sizes)), sizes)[order]

    def meet(self, cls: np.ndarray, key: np.ndarray, x: np.ndarray, k: int):
        """Compares index rows with the queries that visit their buckets."""
        unit = _unit(x)
        order = np.argsort(key, kind="stable")
        for rows in np.split(order, np.flatnonzero(np.diff(key[order])) + 1):
            a, b = np.searchsorted(self.key, key[rows[0]], "left"), np.searchsorted(self.key, key[rows[0]], "right")
            asked = self.query[a:b]
            asked = asked[[len(self.vectors[q]) == x.shape[1] for q in asked.tolist()]]
            for part in np.array_split(asked, -(-len(asked) * len(rows) // 2_000_000) or 1):
                if not len(part):
                    continue
                q = np.stack([self.vectors[j] for j in part.tolist()])
                about = _unit(q) @ unit[rows].T
                least = np.partition(about, -k, axis=1)[:, -k] if len(rows) > k else np.full(len(part), -2.0)
                i, j = np.nonzero(about >= least[:, None] - 1e-9)
                self.found.append((part[i], cls[rows[j]], cosine(q[i], x[rows[j]])))
        if sum(len(f[0]) for f in self.found) > _BEST:
            self.found = [_best(self.found, k)]


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, group = None, _Group()

        def done() -> Iterator[pa.RecordBatch]:
            if group.found:
                query, cls, score = _best(group.found, k)
                yield pa.RecordBatch.from_arrays([pa.array(group.id[query]), pa.array(cls), pa.array(score)], ["query", "class", "score"])

        # Sorted by group, the queries of a group before its index rows.
        for batch in batches:
            names = batch.column(0).to_numpy()
            role = batch.column(1).to_numpy()
            cut = np.flatnonzero((np.diff(names) != 0) | (np.diff(role) != 0)) + 1
            for start, stop in zip([0, *cut.tolist()], [*cut.tolist(), len(names)]):
                part = batch.slice(start, stop - start)
                if names[start] != name:
                    yield from done()
                    name, group = names[start], _Group()
                ids, keys = part.column(2).to_numpy(), part.column(3)
                if role[start] == 0:
                    group.ids.append(ids)
                    group.keys += [np.array(v, np.int64) for v in keys.to_pylist()]
                    own: list = [None] * len(ids)
                    for rows, x in _matrix(part.column(4)):
                        for r, v in zip(rows.tolist(), x):
                            own[r] = v
                    group.vectors += own
                    continue
                if not group.ready:
                    group.close()
                key = keys.flatten().to_numpy()
                for rows, x in _matrix(part.column(4)):
                    group.meet(ids[rows], key[rows], x, k)
        yield from done()

    return run


def _sampled_neighbours(classes: DataFrame, asked: list[tuple[int, list[float]]], k: int) -> dict[int, list]:
    """The vectors of the k classes nearest to each of the ``asked`` (class,
    vector), by comparing these with all rows."""
    by_size: dict[int, tuple[list, list]] = {}
    for cls, x in asked:
        ids, xs = by_size.setdefault(len(x), ([], []))
        ids.append(cls)
        xs.append(x)
    known = {size: (np.array(ids), _unit(np.array(xs, np.float64))) for size, (ids, xs) in by_size.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[np.ndarray, ...]] = []
        for b in batches:
            cls = b.column(0).to_numpy()
            for rows, x in _matrix(b.column(1)):
                if x.shape[1] not in known:
                    continue
                ids, unit = known[x.shape[1]]
                score = unit @ _unit(x).T
                score[ids[:, None] == cls[rows][None, :]] = -2.0
                best = np.argpartition(-score, k - 1, axis=1)[:, :k] if score.shape[1] > k else np.tile(np.arange(score.shape[1]), (len(ids), 1))
                query = np.repeat(ids, best.shape[1])
                found.append((query, cls[rows][best.ravel()], np.take_along_axis(score, best, 1).ravel()))
            if found:
                found = [_best(found, k)]
        if found:
            query, cls, score = found[0]
            yield pa.RecordBatch.from_arrays([pa.array(query), pa.array(cls), pa.array(score)], ["query", "class", "score"])

    met = classes.select("class", "embedding").mapInArrow(run, "query long, class long, score double").where("score > -2")
    best = met.withColumn("place", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "class"))).where(F.col("place") <= k)
    out: dict[int, list] = {}
    for r in best.join(classes.select("class", "embedding"), "class").select("query", "embedding").collect():
        out.setdefault(r[0], []).append(r[1])
    return out


def _first_visits(visited: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """For each row of ``keys``, by table: the number of the visit, in a query's
    ``visited`` by table, that meets it; ``PROBES + 1`` if none does."""
    first = np.full(keys.shape, PROBES + 1)
    for t in range(TABLES):
        order = np.argsort(visited[t], kind="stable")
        ranked = visited[t][order]
        at = np.minimum(np.searchsorted(ranked, keys[:, t]), len(ranked) - 1)
        first[:, t] = np.where(ranked[at] == keys[:, t], order[at], PROBES + 1)
    return first


def tuned(classes: DataFrame, asking: DataFrame, n: int, k: int) -> tuple[int, int]:
    """Hash functions and probes of least work that reach ``RECALL`` on a sample
    of ``asking``. With no function all rows share a bucket, so some pair does."""
    most = int(max(0, np.log2(max(n, 1) / 64)))
    some = lambda rows, m: [(r[0], r[1]) for r in rows.select("class", "embedding").orderBy(F.xxhash64("class"), "class").limit(m).collect()]
    asked = some(asking, SAMPLE) if most else []
    near = _sampled_neighbours(classes, asked, k) if asked else {}
    if not near:
        return 0, 0
    matrix = lambda xs: _unit(np.array(xs, np.float64))
    rows = [x for _, x in some(classes, ROWS)]
    by_size: dict[int, list] = {}
    for cls, x in asked:
        if cls in near:
            by_size.setdefault(len(x), []).append((x, matrix(near[cls])))
    best = (float(n * TABLES), 0, 0)
    for functions in range(1, most + 1):
        found, work = [], []
        for size, pairs in by_size.items():
            visits = visited_keys(matrix([x for x, _ in pairs]), functions, PROBES).reshape(len(pairs), TABLES, -1)
            found += [_first_visits(v, own_keys(y, functions)).min(axis=1) for v, (_, y) in zip(visits, pairs)]
            if same := [x for x in rows if len(x) == size]:
                keys = own_keys(matrix(same), functions)
                work += [_first_visits(v, keys).ravel() for v in visits]
        first = np.sort(np.concatenate(found))
        probes = int(first[int(np.ceil(RECALL * len(first))) - 1])
        if probes > PROBES:
            continue
        visited = n * sum(np.count_nonzero(v <= probes) for v in work) / (len(found) * len(rows))
        best = min(best, (visited + _VISIT * TABLES * probes, functions, probes))
    return best[1:]


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, shape: tuple[int, int] | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: for each id in ``queries`` (vec_id) the k
    nearest of ``vectors`` (vec_id, embedding) that the index finds. ``shape``:
    hash functions and probes, if they are not to be chosen."""
    x = F.col("embedding")
    fit = vectors.where(
        F.col("vec_id").isNotNull() & F.coalesce(
            F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))) & F.exists(x, lambda v: v != 0), F.lit(False)
        )
    ).groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(F.min("embedding").alias("embedding"))
    ranked = fit.withColumn("place", F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))).where(F.col("place") <= k + 1)
    # A class is named by its least id.
    classes = written(
        ranked.groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).select(F.col("ids")[0].alias("class"), "ids", "embedding"),
        "vector-classes",
    )
    asked = written(
        fit.join(queries.select(F.col("vec_id").cast("long").alias("query_id")).distinct(), F.col("vec_id") == F.col("query_id"), "left_semi")
        .join(classes.select("class", "embedding"), "embedding").select(F.col("vec_id").alias("query_id"), "class"),
        "vector-queries",
    )
    n = classes.count()
    groups = max(8, -(-n * TABLES // GROUP))
    asking = classes.join(asked.select("class").distinct(), "class", "left_semi")
    functions, probes = shape or tuned(classes, asking, n, k)
    own = classes.select("class", "embedding").mapInArrow(_keyed(lambda u: own_keys(u, functions)), "class long, key long")
    visits = written(asking.select("class", "embedding").mapInArrow(_keyed(lambda u: visited_keys(u, functions, probes)), "class long, key long"), "vector-visits")
    crowded = own.groupBy("key").count().where(F.col("count") > CROWDED).select("key", F.ceil(F.col("count") / CROWDED).cast("int").alias("parts"))
    sought = visits.groupBy("key").count().where(F.col("count") > ASKED).select("key", F.ceil(F.col("count") / ASKED).cast("int").alias("shares"))
    # A bucket of several index parts and query shares is met pair by pair.
    parts, shares = F.coalesce("parts", F.lit(1)), F.coalesce("shares", F.lit(1))
    one_of = lambda n: F.pmod(F.xxhash64("class"), n).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    group = F.pmod(F.xxhash64("key", "part", "share"), F.lit(groups)).alias("group")
    kind = vectors.schema["embedding"].dataType
    dealt = lambda rows: rows.join(crowded, "key", "left").join(sought, "key", "left")
    index = (
        dealt(own).select("class", "key", one_of(parts).alias("part"), each(shares).alias("share")).select("class", "key", group)
        .join(classes.select("class", "embedding"), "class")
        .select("group", F.lit(1).alias("role"), "class", F.array("key").alias("keys"), F.col("embedding").cast(kind))
    )
    probing = (
        dealt(visits).select("class", "key", one_of(shares).alias("share"), each(parts).alias("part"))
        .select("class", "key", group).groupBy("group", "class").agg(F.collect_set("key").alias("keys"))
        .join(classes.select("class", "embedding"), "class")
        .select("group", F.lit(0).alias("role"), "class", "keys", F.col("embedding").cast(kind))
    )
    met = index.unionByName(probing).repartition("group").sortWithinPartitions("group", "role").mapInArrow(_search(k + 1), "query long, class long, score double")
    best = met.distinct().withColumn("place", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "class"))).where(F.col("place") <= k + 1)
    rows = (
        best.join(classes.select("class", "ids"), "class").select(F.col("query").alias("class"), "score", F.explode("ids").alias("vec_id"))
        .join(asked, "class").where("vec_id != query_id")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
