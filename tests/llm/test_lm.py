"""Language-model scores against a plain recomputation, word by word."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from areacast.llm import lm
from areacast.llm.common import importable, table

LONG = " ".join(f"w{i % 977}" for i in range(30_000))
TEXTS = [
    (0, "The cat sat on the mat and the dog sat on the log today because it was warm."), (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "one two"),
    (6, LONG), (7, LONG + " tail"), (10, "Ünï çödé, naïve; ß don't stop..."), (11, "the cat sat on the log"), (11, "the cat sat on the log"), (None, "a cat of no number"),
]
SF = "/root/testdata/sf0.01"


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 1


def tokens(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split() + [b""]


@pytest.fixture(scope="module")
def docs(spark):
    importable(spark)
    return spark.createDataFrame([(i, t, 1, 0.5, b"u") for i, t in TEXTS], "doc_id long, text string, n_tokens int, score double, units binary")


def plain_log10(vocabulary, model, counts, words):
    """log10 of a text's probability, by loops over the definition."""
    units = []
    for w in words:
        place = vocabulary.words.get(w)
        units.append(vocabulary.end if w == b"" else int(vocabulary.units[place]) if place is not None else vocabulary.tail_unit(w))
    total, before = 0.0, [vocabulary.end, vocabulary.end]
    for w, unit in zip(words, units):
        h = model.seen[before[-1]].astype(float) * model.first + model.seen[before[-2]].astype(float) * model.second
        at = int(vocabulary.group[unit])
        by_group = [math.exp(h @ model.group[k] + model.group_bias[k]) for k in range(vocabulary.groups)]
        inside = range(int(vocabulary.starts[at]), int(vocabulary.starts[at + 1]))
        by_unit = {k: math.exp(h @ model.next[k] + model.bias[k]) for k in inside}
        p = by_group[at] / sum(by_group) * by_unit[unit] / sum(by_unit.values())
        if unit == inside[-1] and unit != vocabulary.end:
            p *= (counts.get(w, 0) + 0.5) / (vocabulary.tokens[unit] + 0.5 * (vocabulary.types[unit] + 1))
        total += math.log10(p)
        before.append(unit)
    return total


def test_scores_equal_the_plain_ones(docs):
    rows = [tuple(r) for r in lm.language_model_scores(docs).collect()]
    counts = Counter(w for i, t in TEXTS if not held(i) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    _, _, vocabulary, model = lm.fit(docs)
    want = []
    for i, t in TEXTS:
        words = tokens(t)
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        want.append((i, held(i), len(words), sum(w in counts for w in words), n, base, plain_log10(vocabulary, model, counts, words)))
    order = lambda x: (x[0] is not None, x[0], x[2])
    for got, plain in zip(sorted(rows, key=order), sorted(want, key=order)):
        assert got[:5] == plain[:5]
        assert got[5] == pytest.approx(plain[5], rel=1e-10) and got[6] == pytest.approx(plain[6], rel=1e-4)
    assert len(rows) == len(TEXTS) and lm.language_model_scores(docs.where("false")).count() == 0


def test_all_words_add_up_to_one(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    counts, _, vocabulary, model = lm.fit(docs)
    counts = {r.word.encode(): r.c for r in counts.collect()}
    assert len(vocabulary.group) > 200 and vocabulary.groups >= 17
    r = random.Random(1)
    for _ in range(3):
        last, before = r.randrange(len(vocabulary.group)), r.randrange(len(vocabulary.group))
        every = np.arange(len(vocabulary.group))
        units = np.exp(model.log_probabilities(np.full(len(every), last), np.full(len(every), before), every, vocabulary.group, vocabulary.starts).astype(float))
        room = vocabulary.tokens + 0.5 * (vocabulary.types + 1)
        own = {int(u) for u in vocabulary.units} - {int(k) for k in np.flatnonzero(vocabulary.is_tail())}
        total = units[vocabulary.end] + sum(units[k] for k in own)
        for w, c in counts.items():
            place = vocabulary.words.get(w)
            unit = int(vocabulary.units[place]) if place is not None else vocabulary.tail_unit(w)
            if w != b"" and unit not in own:
                total += units[unit] * (c + 0.5) / room[unit]
        total += sum(units[k] * 0.5 / room[k] for k in np.flatnonzero(vocabulary.is_tail()).tolist())
        assert total == pytest.approx(1, abs=1e-4)


def test_vocabulary_grows_with_the_corpus(spark):
    sizes = []
    for sf in ("sf0.001", "sf0.01", "sf0.1"):
        own, groups = lm.unit_counts(table(spark, f"/root/testdata/{sf}", "documents").select(F.explode(F.split(F.lower("text"), r"\s+"))).distinct().count())
        sizes.append(own)
        assert groups & (groups - 1) == 0 and groups**2 / 4 <= own <= 8 * groups**2
    assert sizes[0] * 1.5 < sizes[1] and sizes[1] * 1.5 < sizes[2]


def test_shuffled_texts_score_lower_and_the_model_beats_the_base(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text")
    mixed = docs.where("doc_id % 5 = 0").select((F.col("doc_id") + 10_000_000).alias("doc_id"), F.array_join(F.shuffle(F.split("text", r"\s+"), F.lit(3)), " ").alias("text"))
    rows = lm.language_model_scores(docs.union(mixed), F.coalesce(F.col("doc_id") % 5 == 0, F.lit(False))).toPandas().query("held_out")
    real, shuffled = rows[rows.doc_id < 10_000_000], rows[rows.doc_id >= 10_000_000]
    per = lambda x: x.score.sum() / x.n_tokens.sum()
    assert per(real) > per(shuffled) + 0.02  # invented prose has little order
    assert per(real) > real.base_score.sum() / real.n_tokens.sum() + 0.1


def test_scores_do_not_hang_on_partitions(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    one, many = (lm.language_model_scores(docs.repartition(k), shard_tokens=2_000).toPandas().sort_values("doc_id") for k in (1, 13))
    assert np.allclose(one.score, many.score, rtol=1e-5)


def test_noise_follows_the_shares(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    _, _, vocabulary, _ = lm.fit(docs)
    noise = lm.Noise(vocabulary)
    k = int(np.argmax(noise.sizes))
    drawn = noise.units(np.full(50_000, k), 4, np.random.default_rng(2))
    a, b = int(vocabulary.starts[k]), int(vocabulary.starts[k + 1])
    share = np.bincount(drawn.ravel() - a, minlength=b - a) / drawn.size
    assert drawn.min() >= a and drawn.max() < b and np.allclose(share, noise.share[a:b], atol=0.01)


def test_learns_an_order():
    """Units 0, 1, 2 of one group follow each other."""
    vocabulary = lm.Vocabulary({}, np.zeros(0, int), np.zeros(0), np.array([4000.0, 4000, 4000, 4000]), np.ones(4), np.array([0, 0, 0, 1]), np.array([0, 3, 4]), 16000, 4)
    noise = lm.Noise(vocabulary)
    model = lm.LogBilinear.begin(noise.group_share, noise.share)
    sums = [np.full_like(p, 1e-7) for p in model.parts()]
    units, starts = np.tile([0, 1, 2, 3], 4000), np.arange(0, 16000, 4)
    last, before = lm.contexts(units, starts, 3)
    for _ in range(10):
        lm.nce_pass(model, last, before, units, noise, sums, 0.3, np.random.default_rng(1))
    p = np.exp(model.log_probabilities(last[:4], before[:4], units[:4], vocabulary.group, vocabulary.starts))
    assert (p > 0.6).all()
