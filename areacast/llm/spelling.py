"""Spelling variants, found by bidirectional FM-index search schemes.

Words of the corpus are counted, some runs with a typing error put in by a rule
(see `word_counts`). Two words are near if one inserted, deleted or replaced
code point makes them equal; a word's form is its most frequent near word, if
that is ten times as frequent, and its root the end of that chain.

Let a be the length of the shorter word of a near pair. Its words share their
first a // 2 code points or their last a - a // 2. So

1. a word goes to groups, keyed by its beginning and by its end. The length of
   a key follows the length of the words, in classes (`class_start`), so that
   long words are told apart by long keys; a word at the lower edge of a class
   goes to the class below too;
2. groups are dealt to shards. A group above ``CROWDED`` code points is cut into
   parts, and each pair of an index part and a query part is a shard;
3. a shard lays its words out between delimiters and builds a bidirectional
   FM-index: suffix ranks of the text and of its mirror image, held in step, so
   that a pattern grows to either side. Its search scheme has two searches: the
   first half exactly, delimiter included, then to the right over the other
   half with one error; the second half exactly, then to the left. Extension
   tries the symbols that occur in the interval of ranks. As the words are
   laid out in order, the rank of a delimiter names the word;
4. a pair is counted by the beginnings' search, or by that of the ends if the
   beginnings differ. A shard sends each word's count and best near word, never
   the pairs.

Form chains at least grow tenfold a step, so pointer doubling ends after few
rounds. Each is written to the shared folder.

Defined cases: null texts have no words, a null id is written as nothing in the
rule of typing errors. Rows with the same id and text count each. A word of any
length takes part. An empty table stays empty; extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areacast.llm.common import importable, pieces, written

LEAST_LENGTH, LEAST_COUNT, TIMES, TYPO_EVERY = 7, 2, 10, 31
PIECE_BYTES = 8 << 20
#: Distinct words a task counts before it hands them on.
HELD_WORDS = 200_000
SHARD_CHARS = 400_000
CROWDED = 800_000
#: Queries searched at a time.
BLOCK = 1 << 15

# Latin-1 has the letters A-Z, a-z and U+00C0 to U+00FF, a byte each.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))


def runs(text: str) -> list[bytes]:
    """The maximal runs of letters, A-Z lower-cased, as Latin-1."""
    return text.encode("latin-1", "replace").translate(_LETTERS).split()


def typed(doc_crc: int, run: bytes) -> bytes:
    """The run, without one code point if the checksum of `<doc_id>:<run>` (the
    part before the run is in ``doc_crc``) is a multiple of TYPO_EVERY."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), doc_crc)
    if h % TYPO_EVERY:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame) -> DataFrame:
    """word and n of all words of LEAST_LENGTH code points and LEAST_COUNT
    occurrences."""

    def rows(counts: Counter) -> pa.RecordBatch:
        words = pa.array([w.decode("latin-1") for w in counts], pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(counts.values(), pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for b in pieces(batches, "text", PIECE_BYTES):
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if not text:
                    continue
                doc_crc = zlib.crc32(f"{doc_id}:".encode())
                for w, n in Counter([w for w in runs(text) if len(w) >= LEAST_LENGTH]).items():
                    w = typed(doc_crc, w)
                    if len(w) >= LEAST_LENGTH:
                        held[w] += n
            if len(held) >= HELD_WORDS:
                yield rows(held)
                held = Counter()
        yield rows(held)

    importable(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def class_starts(longest: int = 1 << 31) -> list[int]:
    """The least lengths of the classes."""
    starts = [LEAST_LENGTH]
    while starts[-1] <= longest:
        starts.append(starts[-1] + starts[-1] // 3)
    return starts


def class_start(length: Column) -> Column:
    *starts, last = class_starts()
    chosen = F
    for start, above in zip(starts, [*starts[1:], last]):  # most words are short
        chosen = chosen.when(length < above, F.lit(start))
    return chosen


# ---------------------------------------------------------------- the index


def _suffix_order(text: np.ndarray, last: int) -> np.ndarray:
    """The places of ``text`` (words between delimiters ``last``) ordered by the
    suffix up to the delimiter; equal ones by place."""
    n, width = len(text), 9  # 9 symbols of 7 bits
    ends = np.flatnonzero(text == last)
    left = ends[np.searchsorted(ends, np.arange(n))] - np.arange(n)

    def chunk(at: np.ndarray) -> np.ndarray:
        out = np.zeros(len(at), np.uint64)
        for t in range(width):
            out <<= np.uint64(7)
            inside = left[at] >= t
            out[inside] |= text[at[inside] + t].astype(np.uint64) + np.uint64(1)
        return out

    order = np.arange(n)
    keys = chunk(order)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    group = np.cumsum(np.append(0, keys[1:] != keys[:-1])) if n else order
    depth, seats = width, np.arange(n)
    while len(seats):
        # Those of several equal parts that go on.
        same = group[seats]
        tied = np.bincount(same, minlength=1)[same] > 1
        tied &= left[order[seats]] >= depth
        seats = seats[tied]
        if not len(seats):
            break
        same, at = group[seats], order[seats]
        keys = chunk(at + depth)
        by = np.lexsort((keys, same))
        same, keys = same[by], keys[by]
        order[seats] = at[by]
        new = np.append(True, (same[1:] != same[:-1]) | (keys[1:] != keys[:-1]))
        group[seats] = np.cumsum(new) - 1
        depth += width
    return order


class _Ranks:
    """For a sequence of symbols 0 .. last: how many below a symbol stand before
    a place."""

    def __init__(self, text: np.ndarray, last: int):
        n = len(text)
        wide = n // 64 + 1
        self.bits = np.zeros((last + 2, wide), np.uint64)
        self.before = np.zeros((last + 2, wide), np.int64)
        padded = np.zeros(wide * 64, bool)
        for symbol in range(1, last + 2):
            padded[:n] = text < symbol
            self.bits[symbol] = np.packbits(padded, bitorder="little").view(np.uint64)
            self.before[symbol, 1:] = np.cumsum(np.bitwise_count(self.bits[symbol, :-1]), dtype=np.int64)

    def below(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        word = place >> 6
        mask = (np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[symbol, word] + np.bitwise_count(self.bits[symbol, word] & mask)


class _Side:
    """One direction: symbols before the ranked suffixes of a text."""

    def __init__(self, words: list[bytes], last: int):
        text = np.frombuffer(bytes((last,)) + b"".join([w + bytes((last,)) for w in words]), np.uint8)
        order = _suffix_order(text, last)
        self.symbols = text[order - 1]
        self.ranks = _Ranks(self.symbols, last)
        self.starts = np.append(0, np.cumsum(np.bincount(text, minlength=last + 1)))


class BidirectionalIndex:
    """Over the distinct ``words`` (Latin-1). A state of a pattern is its first
    rank in the text, its first rank in the mirrored text, and its count."""

    LEFT, RIGHT = 0, 1

    def __init__(self, words: list[bytes]):
        letters = sorted(set(b"".join(words)))
        self.last = len(letters)  # the delimiter, above all letters
        table = bytearray([255]) * 256
        for k, letter in enumerate(letters):
            table[letter] = k
        self.table = bytes(table)
        end = bytes((self.last,))
        order = sorted(range(len(words)), key=[w.translate(self.table) + end for w in words].__getitem__)
        self.words = [words[k] for k in order]
        mapped = [w.translate(self.table) for w in self.words]
        # To the left, symbols before suffixes of the text; to the right, of its mirror image.
        self.sides = (_Side(mapped, self.last), _Side(sorted((w[::-1] for w in mapped), key=lambda w: w + end), self.last))
        self.size = len(self.sides[0].symbols)
        self.flat = np.frombuffer(b"".join(mapped), np.uint8)
        self.lengths = np.array([len(w) for w in words], np.int64)[order] if words else np.zeros(0, np.int64)
        self.offsets = np.cumsum(self.lengths) - self.lengths

    def start(self, many: int) -> np.ndarray:
        """States of the empty pattern, as three rows."""
        return np.stack([np.zeros(many, np.int64), np.zeros(many, np.int64), np.full(many, self.size)])

    def extend(self, state: np.ndarray, symbol: np.ndarray, side: int) -> np.ndarray:
        """The states of the patterns with one more symbol on this side."""
        own, symbol = self.sides[side], symbol.astype(np.int64)
        low = state[side]
        high = low + state[2]
        below, below_high = own.ranks.below(symbol, low), own.ranks.below(symbol, high)
        upto, upto_high = own.ranks.below(symbol + 1, low), own.ranks.below(symbol + 1, high)
        out = np.empty_like(state)
        out[side] = own.starts[symbol] + upto - below
        out[1 - side] = state[1 - side] + below_high - below
        out[2] = (upto_high - upto) - (below_high - below)
        return out

    def branches(self, state: np.ndarray, side: int) -> tuple[np.ndarray, np.ndarray]:
        """State numbers and the letters that extend them on this side."""
        few = np.flatnonzero(state[2] <= 8)
        sizes = state[2][few]
        at = np.repeat(few, sizes)
        place = np.arange(len(at)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + state[side][at]
        pairs = np.unique(at * (self.last + 1) + self.sides[side].symbols[place])
        many = np.flatnonzero(state[2] > 8)
        at = np.concatenate([pairs // (self.last + 1), np.repeat(many, self.last)])
        letter = np.concatenate([pairs % (self.last + 1), np.tile(np.arange(self.last), len(many))])
        use = letter < self.last
        return at[use], letter[use]

    def word(self, state: np.ndarray) -> np.ndarray:
        """The word of a state whose pattern is a word with its delimiters."""
        return state[0] - self.sides[0].starts[self.last]

    def search(self, flat: np.ndarray, offsets: np.ndarray, lengths: np.ndarray, half: int, side: int, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Queries and words at one error. ``half`` symbols at the end away from
        ``side`` match exactly, the rest is matched towards ``side``. The symbol
        255 is in no word. ``known``: whether the query is a word of the index."""
        sign = 1 if side == self.RIGHT else -1
        first = offsets if side == self.RIGHT else offsets + lengths - 1  # the outer end of the exact half
        state, query = self.start(len(offsets)), np.arange(len(offsets))
        # The exact half, from its inner to its outer end, then the delimiter.
        for step in range(half, -1, -1):
            symbol = flat[first[query] + sign * (step - 1)] if step else np.full(len(query), self.last)
            state, query = self._grown(state, query, symbol, 1 - side)
        rest = lengths - half

        def symbols(q: np.ndarray, step: int) -> np.ndarray:
            out = np.full(len(q), self.last)
            more = rest[q] > step
            out[more] = flat[first[q[more]] + sign * (half + step)]
            return out

        found, step = [], 0
        wrong, wrong_query = self.start(0), np.zeros(0, np.int64)
        while len(query) or len(wrong_query):
            # A lone word that is the query itself has no other near it.
            more = (state[2] > 1) | ~known[query]
            state, query = state[:, more], query[more]
            now, after = symbols(query, step), symbols(query, step + 1)
            at, letter = self.branches(state, side)
            use = letter != now[at]
            at, letter = at[use], letter[use]
            other, other_at = self._grown(state[:, at], at, letter, side)
            replaced = now[other_at] != self.last
            # Of equal neighbours, the last one is deleted; a letter is inserted after its equals.
            deleted = (now != self.last) & (now != after)
            # The inserted ones are still before this symbol, as are earlier errors.
            wrong, wrong_query = np.concatenate([wrong, other], axis=1), np.concatenate([wrong_query, query[other_at]])
            wrong, wrong_query = self._grown(wrong, wrong_query, symbols(wrong_query, step), side)
            done = rest[wrong_query] == step
            found.append(np.stack([wrong_query[done], self.word(wrong[:, done])]))
            wrong = np.concatenate([wrong[:, ~done], other[:, replaced], state[:, deleted]], axis=1)
            wrong_query = np.concatenate([wrong_query[~done], query[other_at[replaced]], query[deleted]])
            go = now != self.last
            state, query = self._grown(state[:, go], query[go], now[go], side)
            step += 1
        pairs = np.concatenate([*found, np.zeros((2, 0), np.int64)], axis=1)
        both = np.unique(pairs[0] * max(len(self.words), 1) + pairs[1])
        return both // max(len(self.words), 1), both % max(len(self.words), 1)

    def _grown(self, state: np.ndarray, query: np.ndarray, symbol: np.ndarray, side: int) -> tuple[np.ndarray, np.ndarray]:
        """The extended states that occur, and their queries."""
        inside = symbol <= self.last
        if not inside.all():
            state, query, symbol = state[:, inside], query[inside], symbol[inside]
        state = self.extend(state, symbol, side)
        alive = state[2] > 0
        return state[:, alive], query[alive]


def near_in_shard(words: list[bytes], counts: np.ndarray, roles: np.ndarray, ends: np.ndarray, starts: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray, list[bytes]]:
    """Of the rows of a shard (role 1: to be found, 2: to be searched for, 3:
    both; ends: whether by the end; class start): the words with near words, how
    many, the best one's count and the best."""
    own = {w: int(n) for w, n, role in zip(words, counts.tolist(), roles.tolist()) if role & 1}
    index = BidirectionalIndex(list(own))
    n = np.array([own[w] for w in index.words], np.int64)
    plain = np.empty(len(n), np.int64)  # code-point order
    plain[sorted(range(len(n)), key=index.words.__getitem__)] = np.arange(len(n))
    edge = class_starts(int(max(map(len, words), default=0)) + 1)
    out: list = [[], [], [], []]
    asked = {(w, e, s) for w, role, e, s in zip(words, roles.tolist(), ends.tolist(), starts.tolist()) if role & 2}
    for by_end in (False, True):
        for start in sorted({s for _, e, s in asked if e == by_end}):
            of_class = sorted(w for w, e, s in asked if e == by_end and s == start)
            above, half = edge[edge.index(start) + 1], start // 2
            for block in (of_class[k : k + BLOCK] for k in range(0, len(of_class), BLOCK)):
                flat = np.frombuffer(b"".join(block).translate(index.table), np.uint8)
                lengths = np.array([len(w) for w in block], np.int64)
                offsets = np.cumsum(lengths) - lengths
                known = np.array([w in own for w in block])
                side = index.LEFT if by_end else index.RIGHT
                q, w = index.search(flat, offsets, lengths, start - half if by_end else half, side, known)
                short = np.minimum(lengths[q], index.lengths[w])
                use = (short >= start) & (short < above)
                if by_end:  # only pairs that the beginnings do not find
                    use &= (flat[offsets[q][:, None] + np.arange(half)] != index.flat[index.offsets[w][:, None] + np.arange(half)]).any(axis=1)
                q, w = q[use], w[use]
                by = np.lexsort((plain[w], -n[w], q))
                q, w = q[by], w[by]
                first = np.flatnonzero(np.append(True, q[1:] != q[:-1])) if len(q) else np.zeros(0, int)
                out[0] += [block[k] for k in q[first].tolist()]
                out[1].append(np.diff(np.append(first, len(q))))
                out[2].append(n[w[first]])
                out[3] += [index.words[k] for k in w[first].tolist()]
    none = np.zeros(0, np.int64)
    return out[0], np.concatenate([*out[1], none]), np.concatenate([*out[2], none]), out[3]


# ------------------------------------------------------------------ on Spark


def _search(rows: pa.Table) -> pa.Table:
    words = [w.encode("latin-1") for w in rows.column("word").to_pylist()]
    number = lambda name: rows.column(name).to_numpy()
    word, near, best_n, best = near_in_shard(words, number("n"), number("role"), number("by_end"), number("start"))
    text = lambda x: pa.array([w.decode("latin-1") for w in x], pa.string())
    return pa.table({"word": text(word), "n_near": pa.array(near), "best_n": pa.array(best_n), "best": text(best)})


def near_words(words: DataFrame, shard_chars: int = SHARD_CHARS, crowded: int = CROWDED) -> DataFrame:
    """word, n_near, best_n and best (the most frequent near word, ties: the
    smallest) of those of ``words`` (word, n) that have near words."""
    length = F.length("word")
    classes = F.array_distinct(F.filter(F.array(class_start(length), F.when(length > LEAST_LENGTH, class_start(length - 1))), lambda c: c.isNotNull()))
    sides = F.array(F.lit(False), F.lit(True))
    key = F.when(F.col("by_end"), F.expr("right(word, start - start div 2)")).otherwise(F.expr("left(word, start div 2)"))
    placed = words.select("word", "n", F.explode(classes).alias("start")).select("*", F.explode(sides).alias("by_end")).withColumn("key", F.concat_ws(":", F.col("start"), F.col("by_end").cast("string"), key))
    chars = written(placed.groupBy("key").agg(F.sum(F.length("word") + 1).alias("chars")), "spelling-groups")
    whole = chars.agg(F.sum("chars")).first()[0] or 0
    large = chars.where(F.col("chars") > crowded).select("key", F.ceil(F.col("chars") / crowded).cast("int").alias("parts"))
    shards = max(1, -(-whole // shard_chars))
    usual = placed.join(large, "key", "left_anti").select("word", "n", "start", "by_end", F.lit(3).alias("role"), F.pmod(F.xxhash64("key"), F.lit(shards)).alias("shard"))
    # A pair of parts (index, query) is a shard; a word is in its own part.
    part = placed.join(large, "key").withColumn("own", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    tile = lambda i, q: F.xxhash64("key", i, q)
    roles = F.when(F.col("own") == F.col("other"), F.array(F.struct(F.lit(3).alias("role"), tile("own", "own").alias("shard")))).otherwise(
        F.array(F.struct(F.lit(1).alias("role"), tile("own", "other").alias("shard")), F.struct(F.lit(2).alias("role"), tile("other", "own").alias("shard")))
    )
    split = part.select("word", "n", "start", "by_end", F.explode(roles).alias("r")).select("word", "n", "start", "by_end", "r.role", "r.shard")
    # Parts are few rows and much work: a number of them that is not coalesced.
    tiles = large.agg(F.sum(F.col("parts") * F.col("parts"))).first()[0] or 0
    found = usual.unionByName(split).repartition(shards + tiles, "shard").groupBy("shard").applyInArrow(_search, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("minus"), F.col("best").alias("best"))).alias("b")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", (-F.col("b.minus")).alias("best_n"), F.col("b.best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """word and root: the end of the chain of forms (word, form)."""
    state = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        on = state.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        state = written(state.join(on, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "spelling-roots")
        if state.where("moved").isEmpty():
            return state.drop("moved")


def spelling_groups(words: DataFrame, times: int = TIMES) -> DataFrame:
    """word, form, root, n, n_near and form_n of each of ``words`` (word, n)."""
    known = words.join(near_words(words), "word", "left")
    is_form = F.col("best_n") >= F.lit(times) * F.col("n")
    known = written(known.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n")), "spelling-forms")
    ends = roots(known.where("form is not null").select("word", "form"))
    return known.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """`spelling_groups` of the words of ``docs`` (doc_id, text)."""
    return spelling_groups(written(word_counts(docs), "spelling-words"))
