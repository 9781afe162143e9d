"""Language-model scoring by a log-bilinear neural model with a factored softmax.

Tokens are ASCII-lower-cased words, and an end after each text. The vocabulary
follows the corpus: of V distinct training words the ``V ** GROWTH`` most frequent
are units of their own, with vectors of their own as context and as prediction.
Units fall into groups by a hash of a word's last two bytes, about as many groups
as a group has units; the other words of a group are one more unit, its tail. The
end is a group of one.

The context is the sum of the vectors of the two units before, each scaled by its
place's weights. The model is P(group | context) P(unit | group, context), each
a softmax of the context's products with the groups', and the group's units',
vectors, plus biases; for a tail times P(word | tail) = (c + 0.5) / (n + 0.5 (v
+ 1)), where c counts the word and n and v are the tail's tokens and distinct
words in the training texts, the rest one unseen word. So the probabilities of
all words, one unseen word for each tail, add up to 1 after any context.

Both softmaxes are trained by noise-contrastive estimation in numpy: noise
groups shared by a batch, and a noise unit drawn for each token from its group.
Training texts are dealt to shards of about ``SHARD_TOKENS`` tokens by a hash of
id and text and read in its order, so that the parameters do not depend on how
the input was partitioned. A pass over all tokens has ``ROUNDS`` rounds; in each,
every shard goes over a part of its texts from the common parameters, and the
shards' parameters and squared gradients are averaged by tokens. Scoring takes
normalised log-probabilities from batched matrix products, group by group.

Word counts stay a table. The most frequent words, at most ``HEAD`` or the units
if those are more, go to the tasks; the other words of a text are joined to
their counts.

Defined cases: a null or empty text is its end alone. Rows are scored one by
one, so repeated ids keep their rows. A null id belongs to the training rows.
Without training rows every word is unseen and the groups are equally likely.
Extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areacast.llm.common import byte_texts, in_bucket, written

HEAD = 1 << 17
#: Hash values of words' ends; the groups are fewer.
TAILS = 4096
WIDTH, NOISE, INNER, BATCH, RATE = 16, 16, 1, 4096, 0.4
PASSES, ROUNDS = 1, 4
#: Of the distinct words' number, for the words with vectors of their own.
GROWTH = 0.56
SHARD_TOKENS = 4_000_000
#: Words that a task counts before it passes the counts on, and rare words whose
#: tail it remembers.
_COUNTED = 400_000
#: Tokens scored at a time, and parameters in a row of a shard's result.
_SCORED, _ROW = 1 << 15, 1 << 14


def words_of(text: bytes | None) -> list[bytes]:
    return text.lower().split() if text else []


def tail_of(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % TAILS


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out(counts: Counter) -> pa.RecordBatch:
        words = list(counts)
        return pa.RecordBatch.from_arrays(
            [pa.array([w.decode() for w in words], pa.string()), pa.array([tail_of(w) for w in words], pa.int32()), pa.array(list(counts.values()), pa.int64())],
            ["word", "tail", "c"],
        )

    counts: Counter = Counter()
    for b in batches:
        for text in byte_texts(b.column(0)):
            counts.update(words_of(text))
            counts[b""] += 1  # the end; no word is empty
            if len(counts) >= _COUNTED:
                yield out(counts)
                counts = Counter()
    yield out(counts)


def word_counts(train: DataFrame) -> DataFrame:
    """word, tail (the hash of its end) and c, over all training texts; the end
    is the empty word."""
    return train.select(F.col("text").cast("string").alias("text")).mapInArrow(_count, "word string, tail int, c long").groupBy("word", "tail").agg(F.sum("c").alias("c"))


@dataclass(frozen=True)
class Vocabulary:
    """The frequent words with their counts and units; tokens and distinct words
    of each unit, its group, and where the groups' units start (those of a group
    stand together, its tail last; the last group is the end)."""

    words: dict[bytes, int]
    units: np.ndarray
    counts: np.ndarray
    tokens: np.ndarray
    types: np.ndarray
    group: np.ndarray
    starts: np.ndarray
    n: int
    v: int

    @property
    def groups(self) -> int:
        return len(self.starts) - 1

    @property
    def end(self) -> int:
        return len(self.group) - 1

    def tail_unit(self, word: bytes) -> int:
        return int(self.starts[tail_of(word) % (self.groups - 1) + 1]) - 1

    def is_tail(self) -> np.ndarray:
        out = np.zeros(len(self.group), bool)
        out[self.starts[1:-1] - 1] = True
        return out

    def shares(self) -> tuple[np.ndarray, np.ndarray]:
        """Smoothed shares of the groups, and of the units in their groups."""
        weight = self.tokens + 1.0
        mass = np.bincount(self.group, weight, self.groups)
        return mass / mass.sum(), weight / mass[self.group]


def unit_counts(distinct: int) -> tuple[int, int]:
    """Words with units of their own, and groups, for so many distinct words."""
    own = int(max(distinct, 0) ** GROWTH)
    groups = 1 << max(4, round(np.log2(max(own, 1)) / 2))
    return own, min(groups, TAILS)


def fit_vocabulary(counts: DataFrame) -> Vocabulary:
    total = counts.agg(F.sum("c"), F.count("*"), F.sum(F.when(F.col("word") == "", F.col("c")))).first()
    own, groups = unit_counts(total[1])
    # A threshold on counts, from a histogram of their logarithms, keeps the
    # frequent words within bounds without a sort.
    size = F.floor(F.log2("c") * 16).cast("int")
    bins = sorted(((r.size, r.n) for r in counts.where("word != ''").groupBy(size.alias("size")).agg(F.count("*").alias("n")).collect()), reverse=True)
    held = np.cumsum([n for _, n in bins])
    least = [s for (s, _), h in zip(bins, held) if h <= max(HEAD, own)]
    top = counts.where("word != ''").where(size >= (least[-1] if least else 1 << 20)).select("word", "tail", "c").collect()
    top.sort(key=lambda r: (-r.c, r.word))
    own = min(own, len(top))
    of_group = np.array([r.tail % groups for r in top], np.int64)
    sizes = np.append(np.bincount(of_group[:own], minlength=groups) + 1, 1)
    starts = np.append(0, np.cumsum(sizes))
    units = starts[of_group + 1] - 1
    by = np.argsort(of_group[:own], kind="stable")
    before = np.cumsum(np.bincount(of_group[:own], minlength=groups)) - np.bincount(of_group[:own], minlength=groups)
    units[by] = starts[of_group[by]] + np.arange(own) - before[of_group[by]]
    tokens, types = np.zeros(starts[-1]), np.zeros(starts[-1])
    tails = counts.where("word != ''").groupBy("tail").agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()  # at most TAILS
    for t in tails:
        tokens[starts[t.tail % groups + 1] - 1] += t.n
        types[starts[t.tail % groups + 1] - 1] += t.v
    many = np.array([r.c for r in top], np.float64)
    tokens[units[:own]], types[units[:own]] = many[:own], 1
    np.subtract.at(tokens, starts[of_group[:own] + 1] - 1, many[:own])
    np.subtract.at(types, starts[of_group[:own] + 1] - 1, 1)
    tokens[-1] = total[2] or 0
    return Vocabulary({r.word.encode(): k for k, r in enumerate(top)}, units, many, tokens, types, np.repeat(np.arange(groups + 1), sizes), starts, total[0] or 0, total[1])


class _Places(dict):
    """word -> its place among the frequent words, or -1 - its tail unit."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__(vocabulary.words)
        self.tails = [int(vocabulary.starts[t % (vocabulary.groups - 1) + 1]) - 1 for t in range(TAILS)]

        self.room = len(self) + _COUNTED

    def __missing__(self, word: bytes) -> int:
        place = -1 - self.tails[tail_of(word)]
        if len(self) < self.room:
            self[word] = place
        return place


_ENCODED = "row long, doc_id long, held_out boolean, h long, n_tokens long, units binary, base double, inside double, known long, words array<string>, times array<int>"


def _encode(vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v: Vocabulary = vocabulary.value
        places = _Places(v)
        whole = np.log10(v.n + 0.5 * (v.v + 1))
        tail = v.is_tail()
        room = np.where(tail, np.log10(v.tokens + 0.5 * (v.types + 1)), 0.0)
        log_count = np.log10(v.counts + 0.5)
        tail_log = np.where(tail[v.units], log_count, 0.0)
        end = np.log10(v.tokens[v.end] + 0.5)
        for b in batches:
            out: list[list] = [[] for _ in range(7)]
            for text in byte_texts(b.column(4)):
                words = words_of(text)
                at = np.fromiter(map(places.__getitem__, words), np.int64, len(words))
                frequent = at >= 0
                place = at[frequent]
                units = np.append(-1 - at, v.end)
                units[:-1][frequent] = v.units[place]
                times = Counter([words[k] for k in np.flatnonzero(~frequent).tolist()])
                n = len(words) + 1
                row = (n, units.astype("<u4").tobytes(), log_count[place].sum() + end - n * whole, tail_log[place].sum() - room[units].sum(), int(frequent.sum()) + int(v.tokens[v.end] > 0), [w.decode() for w in times], list(times.values()))
                for column, value in zip(out, row):
                    column.append(value)
            kinds = (pa.int64(), pa.binary(), pa.float64(), pa.float64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*b.columns[:4], *(pa.array(c, k) for c, k in zip(out, kinds))], ["row", "doc_id", "held_out", "h", "n_tokens", "units", "base", "inside", "known", "words", "times"])

    return run


class Noise:
    """Draws groups by their shares, and units of given groups by theirs (the
    alias method: a seat of the group, or its alias)."""

    def __init__(self, vocabulary: Vocabulary):
        self.group, self.starts = vocabulary.group, vocabulary.starts
        self.group_share, self.share = vocabulary.shares()
        self.sizes = np.diff(self.starts)
        self.keep, self.alias = np.ones(len(self.group)), np.arange(len(self.group))
        for a, b in zip(self.starts[:-1].tolist(), self.starts[1:].tolist()):
            part = self.share[a:b] * (b - a)
            small, large = [k for k in range(b - a) if part[k] < 1], [k for k in range(b - a) if part[k] >= 1]
            while small and large:
                low, high = small.pop(), large.pop()
                self.keep[a + low], self.alias[a + low] = part[low], a + high
                part[high] -= 1 - part[low]
                (small if part[high] < 1 else large).append(high)

    def groups(self, many: int, random: np.random.Generator) -> np.ndarray:
        return random.choice(len(self.group_share), many, p=self.group_share)

    def units(self, group: np.ndarray, many: int, random: np.random.Generator) -> np.ndarray:
        at = random.random((len(group), many)) * self.sizes[group][:, None]
        seat = at.astype(np.int64)
        at -= seat
        seat += self.starts[group][:, None]
        return np.where(at < self.keep[seat], seat, self.alias[seat])


@dataclass
class LogBilinear:
    """``seen`` are the units' vectors as context, ``next`` and ``bias`` as
    prediction, ``group`` and ``group_bias`` those of the groups; ``first`` and
    ``second`` weigh the last and the last but one unit."""

    seen: np.ndarray
    next: np.ndarray
    bias: np.ndarray
    group: np.ndarray
    group_bias: np.ndarray
    first: np.ndarray
    second: np.ndarray

    @staticmethod
    def begin(group_share: np.ndarray, share: np.ndarray, seed: int = 11) -> LogBilinear:
        r, units, groups = np.random.default_rng(seed), len(share), len(group_share)
        start = lambda n, spread: r.normal(0, spread, (n, WIDTH)).astype(np.float32)
        ones = np.ones(WIDTH, np.float32)
        return LogBilinear(start(units, 0.3), start(units, 0.1), np.log(share).astype(np.float32), start(groups, 0.1), np.log(group_share).astype(np.float32), ones, ones / 2)

    def parts(self) -> tuple[np.ndarray, ...]:
        return self.seen, self.next, self.bias, self.group, self.group_bias, self.first, self.second

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts()])

    def like(self, flat: np.ndarray) -> LogBilinear:
        """A model of this one's shapes with other numbers."""
        ends = np.cumsum([p.size for p in self.parts()])
        return LogBilinear(*(x.reshape(p.shape).astype(np.float32) for x, p in zip(np.split(flat, ends[:-1]), self.parts())))

    def context(self, last: np.ndarray, before: np.ndarray) -> np.ndarray:
        return self.seen[last] * self.first + self.seen[before] * self.second

    def log_probabilities(self, last: np.ndarray, before: np.ndarray, target: np.ndarray, group: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Natural log P(target | last, before) of units, normalised."""
        h, g = self.context(last, before), group[target]
        out = _log_softmax(h @ self.group.T + self.group_bias, g)
        order = np.argsort(g.astype(np.uint16), kind="stable")  # groups are at most TAILS + 1
        edges = np.searchsorted(g[order], np.arange(len(starts)))
        for k in np.flatnonzero((np.diff(edges) > 0) & (np.diff(starts) > 1)).tolist():
            rows, a, b = order[edges[k] : edges[k + 1]], starts[k], starts[k + 1]
            out[rows] += _log_softmax(h[rows] @ self.next[a:b].T + self.bias[a:b], target[rows] - a)
        return out


def _log_softmax(scores: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Natural log of the softmax at a place of each row."""
    own = scores[np.arange(len(at)), at]
    with np.errstate(over="ignore", divide="ignore"):
        out = own - np.log(np.exp(scores).sum(axis=1))
    bad = np.flatnonzero(~np.isfinite(out))  # beyond the exponents of floats
    if len(bad):
        top = scores[bad].max(axis=1, keepdims=True)
        out[bad] = own[bad] - top[:, 0] - np.log(np.exp(scores[bad] - top).sum(axis=1))
    return out


def contexts(units: np.ndarray, starts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The last and the last but one unit before each token; before a text
    stand ends."""
    last = np.append(end, units[:-1])
    before = np.append([end, end], units[:-2])[: len(units)]
    last[starts] = end
    before[starts] = end
    second = starts[starts + 1 < len(units)] + 1
    before[second] = end
    return last, before


def _summed(at: np.ndarray, x: np.ndarray, n: int) -> np.ndarray:
    """Rows of ``x`` added up by place."""
    return np.stack([np.bincount(at, x[:, j], n) for j in range(x.shape[1])], axis=1)


def nce_pass(model: LogBilinear, last: np.ndarray, before: np.ndarray, target: np.ndarray, noise: Noise, sums: list[np.ndarray], rate: float, random: np.random.Generator) -> None:
    """One pass of noise-contrastive estimation over tokens, in batches; ``sums``
    hold the squared gradients (Adagrad)."""
    units, groups = len(model.bias), len(model.group_bias)
    bar, inner_bar = np.log(NOISE * noise.group_share).astype(np.float32), np.log(INNER * noise.share).astype(np.float32)
    size = max(BATCH, 2 * units)  # an update touches all units
    for k in range(0, len(target), size):
        u, w, t = last[k : k + size], before[k : k + size], target[k : k + size]
        g = noise.group[t]
        eu, ew = model.seen[u], model.seen[w]
        h = eu * model.first + ew * model.second
        # Groups: noise shared by the batch. The gradients by score:
        drawn = noise.groups(NOISE, random)
        q, z = model.group[g], model.group[drawn]
        true = 1 / (1 + np.exp((h * q).sum(axis=1) + model.group_bias[g] - bar[g]))
        false = -1 / (1 + np.exp(-(h @ z.T + model.group_bias[drawn] - bar[drawn])))
        dh = true[:, None] * q + false @ z
        dgroup = _summed(g, true[:, None] * h, groups)
        np.add.at(dgroup, drawn, false.T @ h)
        dgroup_bias = np.bincount(g, true, groups) + np.bincount(drawn, false.sum(axis=0), groups)
        # Units of the tokens' groups, where there are several.
        some = np.flatnonzero(noise.sizes[g] > 1)
        ht, ts = h[some], t[some]
        q = model.next[ts]
        true = 1 / (1 + np.exp((ht * q).sum(axis=1) + model.bias[ts] - inner_bar[ts]))
        dht = true[:, None] * q
        at, by, bias_by = [ts], [true[:, None] * ht], [true]
        for drawn in noise.units(g[some], INNER, random).T:
            z = model.next[drawn]
            false = -1 / (1 + np.exp(-((ht * z).sum(axis=1) + model.bias[drawn] - inner_bar[drawn])))
            dht += false[:, None] * z
            at.append(drawn)
            by.append(false[:, None] * ht)
            bias_by.append(false)
        dh[some] += dht
        place = np.concatenate(at)
        dnext, dbias = _summed(place, np.concatenate(by), units), np.bincount(place, np.concatenate(bias_by), units)
        dseen = _summed(np.concatenate([u, w]), np.concatenate([dh * model.first, dh * model.second]), units)
        grads = (dseen, dnext, dbias, dgroup, dgroup_bias, (dh * eu).sum(axis=0), (dh * ew).sum(axis=0))
        for p, gradient, s in zip(model.parts(), grads, sums):
            gradient = (gradient / len(t)).astype(np.float32)
            s += gradient * gradient
            p += np.float32(rate) * gradient / np.sqrt(s + np.float32(1e-8))


def _sequence(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    found = [np.frombuffer(x, "<u4") for x in column.to_pylist()]
    sizes = np.array([len(x) for x in found], np.int64)
    return np.concatenate([*found, np.zeros(0, "<u4")]).astype(np.int64), np.cumsum(sizes) - sizes


def _sliced(batches: Iterator[pa.RecordBatch], rows: int = 2000) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for k in range(0, b.num_rows, rows):
            yield b.slice(k, rows)


def _averaged(rows: pa.Table) -> pa.Table:
    """A stretch of the shards' numbers, a row a shard, averaged by tokens."""
    x = rows.column("x").combine_chunks().flatten().to_numpy().reshape(rows.num_rows, -1)
    n = rows.column("n").to_numpy().astype(np.float64)
    order = np.lexsort((n, rows.column("shard").to_numpy()))
    mean = (x[order].astype(np.float64) * (n[order] / n.sum())[:, None]).sum(axis=0)
    return pa.table({"k": rows.column("k")[:1], "shard": pa.array([0]), "n": pa.array([int(n.sum())]), "x": pa.array([mean.astype(np.float32)], pa.list_(pa.float32()))})


def _trained(sent, seed: int):
    """A shard's pass over its texts of a round, and the numbers it sends."""

    def run(rows: pa.Table) -> pa.Table:
        begin, before, drawn = sent.value
        own, squares = begin.like(begin.flat()), begin.like(before).parts()
        random, rows = np.random.default_rng([5, seed]), rows.sort_by("h")
        for k in range(0, rows.num_rows, 2000):
            units, starts = _sequence(rows.column("units").slice(k, 2000))
            nce_pass(own, *contexts(units, starts, len(drawn.group) - 1), units, drawn, squares, RATE, random)
        flat = np.concatenate([own.flat(), *(s.ravel() for s in squares)])
        parts = [flat[k : k + _ROW] for k in range(0, len(flat), _ROW)]
        n = sum(map(len, rows.column("units").to_pylist())) // 4
        same = lambda value: pa.array([value] * len(parts), pa.int64())
        return pa.table({"k": pa.array(range(len(parts)), pa.int32()), "shard": same(rows.column("shard")[0].as_py()), "n": same(n), "x": pa.array(parts, pa.list_(pa.float32()))})

    return run


def shard_count(vocabulary: Vocabulary, shard_tokens: int = SHARD_TOKENS) -> int:
    """Shards of ``shard_tokens``, or of 16 tokens a parameter if that is more, so
    that what shards send stays below a byte a token and round."""
    parameters = len(vocabulary.group) * (2 * WIDTH + 1) + vocabulary.groups * (WIDTH + 1)
    return max(1, -(-vocabulary.n // max(shard_tokens, 16 * parameters)))


def fit_model(encoded: DataFrame, vocabulary: Vocabulary, passes: int = PASSES, shard_tokens: int = SHARD_TOKENS) -> LogBilinear:
    """Trains on all rows of ``encoded`` that are not held out. A round's
    parameters and squared gradients come back averaged, a few numbers a unit."""
    noise = Noise(vocabulary)
    model = LogBilinear.begin(noise.group_share, noise.share)
    spark, size, shards = encoded.sparkSession, len(model.flat()), shard_count(vocabulary, shard_tokens)
    sums = np.full(size, 1e-7, np.float32)
    tokens = encoded.where("not held_out").select("h", "units", F.pmod("h", F.lit(shards)).alias("shard"))
    schema = "k int, shard long, n long, x array<float>"
    for round_ in range(passes * ROUNDS):
        sent = spark.sparkContext.broadcast((model, sums, noise))
        part = tokens.where(F.pmod(F.shiftright("h", 20), F.lit(ROUNDS)) == round_ % ROUNDS).repartition(2 * shards, "shard").groupBy("shard")
        rows = part.applyInArrow(_trained(sent, round_), schema).groupBy("k").applyInArrow(_averaged, schema).select("k", "x").collect()
        if rows:
            flat = np.concatenate([np.array(r.x, np.float32) for r in sorted(rows, key=lambda r: r.k)])
            model, sums = model.like(flat[:size]), flat[size:]
        sent.unpersist()
    return model


def _scores(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, group, starts = sent.value
        for b in _sliced(batches):
            units, firsts = _sequence(b.column(1))
            last, before = contexts(units, firsts, len(group) - 1)
            each = np.concatenate([model.log_probabilities(last[k : k + _SCORED], before[k : k + _SCORED], units[k : k + _SCORED], group, starts) for k in range(0, len(units), _SCORED)])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.add.reduceat(each, firsts) / np.log(10))], ["row", "model"])

    return run


def fit(docs: DataFrame, held_out=None, shard_tokens: int = SHARD_TOKENS) -> tuple[DataFrame, DataFrame, Vocabulary, LogBilinear]:
    """The word counts, the encoded rows, the vocabulary and the model."""
    held = in_bucket("doc_id", 5, 1) if held_out is None else held_out
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).select(
        "row", "doc_id", held.alias("held_out"), F.xxhash64("doc_id", "text").alias("h"), "text"
    )
    counts = written(word_counts(rows.where("not held_out")), "word-counts")
    vocabulary = fit_vocabulary(counts)
    encoded = written(rows.mapInArrow(_encode(docs.sparkSession.sparkContext.broadcast(vocabulary)), _ENCODED), "units")
    return counts, encoded, vocabulary, fit_model(encoded, vocabulary, shard_tokens=shard_tokens)


def language_model_scores(docs: DataFrame, held_out=None, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score
    of every document. ``held_out`` is a condition on doc_id; by default
    remainder 1 of 5."""
    counts, encoded, vocabulary, model = fit(docs, held_out, shard_tokens)
    rare = encoded.select("row", F.explode(F.arrays_zip("words", "times")).alias("w")).select("row", F.col("w.words").alias("word"), F.col("w.times").alias("times"))
    joined = rare.join(counts.select("word", "c"), "word", "left")
    c = F.coalesce("c", F.lit(0))
    parts = joined.groupBy("row").agg(
        F.sum(F.col("times") * F.log10(c + F.lit(0.5))).alias("rare"),
        F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("rare_known"),
    )
    sent = docs.sparkSession.sparkContext.broadcast((model, vocabulary.group, vocabulary.starts))
    scored = encoded.select("row", "units").mapInArrow(_scores(sent), "row long, model double")
    more = F.coalesce("rare", F.lit(0.0))
    return (
        encoded.select("row", "doc_id", "held_out", "n_tokens", "base", "inside", "known")
        .join(scored, "row").join(parts, "row", "left")
        .select(
            "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
            F.lit(vocabulary.n).cast("long").alias("train_tokens"),
            (F.col("base") + more).alias("base_score"), (F.col("model") + F.col("inside") + more).alias("score"),
        )
    )
