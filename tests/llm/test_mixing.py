"""Mixing against a plain recomputation of rates and draws."""

import struct
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from areacast.llm import mixing
from areacast.llm.common import table

DIR = "/root/testdata/sf0.1"


def rows_of(n, seed=0, rare=True):
    r = np.random.default_rng(seed)
    out = []
    for i in range(n):
        source = ["hot", "mid", "cold", None][r.choice(4, p=[0.5, 0.3, 0.15, 0.05])]
        lang = ["en", "fr", None][r.choice(3, p=[0.7, 0.25, 0.05])]
        text = " ".join(["w"] * int(r.integers(1, 60))) + r.choice(["", " | a", " http", " @"])
        out.append((i, text, source, lang))
    out += [(n, None, "hot", "en"), (n + 1, "", "empty source", "xx"), (None, "a b", "mid", "en"), (None, "a b", "mid", "en"), (3, "other text", "hot", "en")]
    return out + [(n + 2, "one word", "planted source", "planted language")] * rare


def frame(spark, rows):
    return spark.createDataFrame([(*r, 0.5, 7, "k") for r in rows], "doc_id long, text string, source string, lang string, weight double, topic int, Kept string")


def plain_topic(text):
    for name, marks in mixing.TOPICS.items():
        if any(m in (text or "") for m in marks):
            return name
    return "prose"


def plain_level(pairs, wanted):
    """Least f with sum of min(most, f y) = wanted, by halving."""
    low, high = 0.0, 1e12
    for _ in range(200):
        f = (low + high) / 2
        low, high = (f, high) if sum(min(m, f * y) for y, m in pairs) < wanted else (low, f)
    return high


def plain_rates(rows, budget, targets, copies):
    seed = defaultdict(int)
    for _, text, source, lang in rows:
        seed[source, lang, plain_topic(text)] += len((text or "").split())
    whole = sum(seed.values())
    wanted = []
    for d, name in enumerate(mixing.DIMENSIONS):
        totals = defaultdict(int)
        for cell, t in seed.items():
            totals[cell[d]] += t
        asked = targets.get(name)
        share = {k: (asked.get(k, 0.0) if asked else (t / whole) ** mixing.TEMPER) if t else 0.0 for k, t in totals.items()}
        f = plain_level([(share[k], copies * t) for k, t in totals.items()], budget * whole)
        wanted.append({k: min(copies * t, f * share[k]) for k, t in totals.items()})
    factors = [dict.fromkeys(w, 1.0) for w in wanted]
    value = lambda cell, skip=None: seed[cell] * np.prod([f[cell[d]] for d, f in enumerate(factors) if d != skip])
    for _ in range(60):
        for d, goal in enumerate(wanted):
            for k in goal:
                factors[d][k] = plain_level([(value(c, d), copies * seed[c]) for c in seed if c[d] == k], goal[k] * (1 - 1e-14))
    f = plain_level([(value(c), copies * seed[c]) for c in seed], budget * whole * (1 - 1e-14))
    return {c: min(copies, f * value(c) / seed[c]) if seed[c] else budget for c in seed}


def plain_draw(doc_id, text):
    h = 42
    if doc_id is not None:
        h = xxhash.xxh64_intdigest(struct.pack("<q", doc_id), h)
    if text is not None:
        h = xxhash.xxh64_intdigest(text.encode(), h)
    return (xxhash.xxh64_intdigest(struct.pack("<i", 9), h) >> 11) / (1 << 53)


@pytest.mark.parametrize("targets,copies", [({}, 1.0), ({"source": {"hot": 0.5, "mid": 0.3, "cold": 0.2, "absent": 3.0}}, 1.0), ({"lang": {"en": 0.4, "fr": 0.6}}, 3.0)])
def test_rates_and_draws_equal_the_plain_ones(spark, monkeypatch, targets, copies):
    monkeypatch.setattr(mixing, "POOL", 0.0)
    rows = rows_of(300)
    want = plain_rates(rows, 0.8, targets, copies)
    got = mixing.mix(frame(spark, rows), targets, copies=copies)
    assert got.columns == ["doc_id", "text", "source", "lang", "topic", "n_tokens", "weight", "prob", "kept"]
    found = got.collect()
    assert sorted(map(str, ((r.doc_id, r.text, r.source, r.lang) for r in found))) == sorted(map(str, rows))
    for r in found:
        rate = want[r.source, r.lang, r.topic]
        assert r.topic == plain_topic(r.text) and r.n_tokens == len((r.text or "").split())
        assert r.prob == pytest.approx(rate, rel=1e-5, abs=1e-9) and r.weight == pytest.approx(r.prob / 0.8)
        times = int(r.prob) + (plain_draw(r.doc_id, r.text) < r.prob - int(r.prob))
        assert r.kept == times if copies > 1 else r.kept == (times > 0)


def kept_share(found):
    sums = found.agg(F.sum("n_tokens").alias("t"), F.sum(F.when(F.col("kept"), F.col("n_tokens"))).alias("k"), F.sum(F.col("prob") * F.col("n_tokens")).alias("e")).first()
    return sums.k / sums.t, sums.e / sums.t


def test_a_rare_cell_leaves_the_others_alone(spark):
    without, planted = (mixing.mix(frame(spark, rows_of(4000, 1, rare))) for rare in (False, True))
    assert kept_share(without)[1] == pytest.approx(0.8, abs=1e-6) and kept_share(planted)[1] == pytest.approx(0.8, abs=1e-6)
    one, two = ({(r.doc_id, r.text): r.prob for r in x.where("n_tokens > 0").select("doc_id", "text", "prob").collect()} for x in (without, planted))
    assert max(abs(one[k] - two[k]) for k in one) < 0.002


def test_kept_share_at_two_sizes(spark):
    docs = table(spark, DIR, "documents")
    for part in (docs.where("doc_id % 5 = 0"), docs):
        kept, expected = kept_share(mixing.mixture(part))
        assert expected == pytest.approx(mixing.BUDGET, abs=1e-6) and kept == pytest.approx(mixing.BUDGET, abs=0.02)


def test_rare_values_are_pooled(spark):
    rows = [(i, "a b c d", f"s{i}" if i % 2 else "large", "en") for i in range(2000)]
    plan = mixing._plan(mixing._marked(frame(spark, rows), mixing.TOPICS), {"source": {"s1": 0.2, "large": 0.5, "s5": 0.3}}, 0.5, 1.0)
    assert plan.own["source"] == ["large", "s1", "s5"] and plan.names[0] == ["=large", "=s1", "=s5", "~"]
    assert {r.source: r.prob for r in mixing.mix(frame(spark, rows)).collect()}.keys() == {r[2] for r in rows}


def test_margins_that_cannot_be_met_are_reported(spark):
    # b is only in language x, which gets little.
    rows = [(i, "w " * 10, "b" if i < 50 else "a", "x" if i < 50 else "y") for i in range(100)]
    report = {(r.dimension, r.value): r for r in mixing.margins(frame(spark, rows), {"source": {"a": 0.1, "b": 0.9}, "lang": {"x": 0.1, "y": 0.9}}, budget=0.4).collect()}
    assert not report["source", "b"].met and report["topic", "prose"].met
    assert sum(r.expected for (d, _), r in report.items() if d == "source") == pytest.approx(400)
    # A target above what a value has goes to the others.
    one = [(*r[:3], "x") for r in rows]
    more = {(r.dimension, r.value): r for r in mixing.margins(frame(spark, one), {"source": {"a": 0.05, "b": 0.95}}, budget=0.8).collect()}
    assert more["source", "b"].wanted == pytest.approx(500) and more["source", "a"].wanted == pytest.approx(300) and more["source", "a"].met


def test_repeats_and_empty_tables(spark):
    rows = rows_of(50) * 2
    twice = mixing.mix(frame(spark, rows)).collect()
    seen = defaultdict(set)
    for r in twice:
        seen[r.doc_id, r.text].add(r.kept)
    assert len(twice) == len(rows) and all(len(s) == 1 for s in seen.values())
    docs = frame(spark, rows)
    assert mixing.mix(docs.where("false")).count() == 0 and mixing.margins(docs.where("false")).count() == 0
    kept = mixing.sampled(docs)
    assert kept.columns == docs.columns and {r.weight for r in kept.collect()} == {0.5}
    empty_texts = docs.withColumn("text", F.lit(None).cast("string"))
    assert {r.prob for r in mixing.mix(empty_texts).collect()} == {mixing.BUDGET}


def test_a_column_of_topics(spark):
    docs = frame(spark, rows_of(200))
    found = mixing.mix(docs, {"topic": {"1": 0.5, "0": 0.5}}, topics=F.col("doc_id") % 2).groupBy("topic").agg(F.sum(F.col("prob") * F.col("n_tokens")).alias("t")).collect()
    by = {r.topic: r.t for r in found}
    assert by["0"] == pytest.approx(by["1"], rel=1e-3) and not by[None]
