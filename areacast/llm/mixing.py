"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells of source, language and topic; a cell's tokens are
its seed. A budget says which share of all tokens is to be kept, and targets
how it is divided among the values of each dimension. Raking scales the cells
to the targets of each dimension in turn, under the bound that a cell cannot
give more than ``copies`` times its tokens: a value's factor is the water level
at which its cells, the full ones held at their bound, add up to its target. A
last level over all cells makes the kept tokens the budget, whatever targets the
cells could not meet; `margins` reports those.

A cell's rate is its raked tokens over its own. A document is written rate
times: the whole part, and one more with the probability of the rest, by a hash
of its id and text, so that a rerun keeps the same documents. A rare cell with
a large weight fills up and leaves the rates of the others alone.

Targets are shares by value for any of the dimensions. Without them, a
dimension's targets are its own token shares to the power ``TEMPER``, which
flattens them. Where a target is above what its value can give, the rest goes to
the other values in proportion. Values without a target get none of the tokens;
targets of absent values are left out. The shares are scaled to 1.

Sources and languages with a share of tokens below ``POOL`` and without a target
of their own are raked as one value of their dimension. So there are at most
(1 / POOL + 2 + targets) values of a dimension and, with six topics, 1.6 million
cells beside those of the targets, however many sources there are. Cells are
counted as a table; the pooled ones are raked on the driver and broadcast.

Defined cases: a null source or language is a value of its own. A null or empty
text has no tokens; a cell without tokens has the budget as its rate. Rows
equal in id and text are kept or dropped together; rows of one id, or of none,
by their texts. Columns of ``docs`` with the names of results, in any case, are
replaced. An empty table stays empty.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areacast.llm.common import set_apart, written

BUDGET, COPIES, POOL = 0.8, 1.0, 0.002
TEMPER, ROUNDS, CLOSE = 0.9, 200, 1e-10
DIMENSIONS = ("source", "lang", "topic")
#: topic -> marks; the first topic with a mark in the text, else "prose".
TOPICS = {"tables": (" | ",), "licences": ("icense", "opyright"), "contacts": ("@",), "code": ("</", "{", "=="), "links": ("http", "www.")}

Targets = dict[str, dict[str | None, float]]
_RARE, _NULL = "~", "0"  # other values are written with a = before them


def topic(text: Column, topics: dict[str, tuple[str, ...]] = TOPICS) -> Column:
    chosen = F.lit("prose")
    for name, marks in reversed(topics.items()):
        has = F.lit(False)
        for m in marks:
            has = has | F.contains(text, F.lit(m))
        chosen = F.when(has, name).otherwise(chosen)
    return chosen


def tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def levels(y: np.ndarray, most: np.ndarray, at: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """For each group of ``at`` the least factor f at which min(most, f y) adds
    up to what is wanted; where it cannot, one that fills all."""
    k = len(wanted)
    sums = np.bincount(at, y, k)
    f = np.divide(wanted, sums, out=np.zeros(k), where=sums > 0)
    full = np.zeros(len(y), bool)
    while True:  # a cell once full stays full, as factors rise
        now = full | ((y > 0) & (y * f[at] >= most))
        if (now == full).all():
            return f
        full = now
        free = np.bincount(at, np.where(full, 0.0, y), k)
        rest = wanted - np.bincount(at, np.where(full, most, 0.0), k)
        filled = np.zeros(k)
        np.maximum.at(filled, at[full], most[full] / y[full])
        f = np.maximum(f, np.where(free > 0, np.divide(rest, free, out=np.zeros(k), where=free > 0), filled))


def goals(totals: np.ndarray, shares: np.ndarray, budget: float, copies: float) -> np.ndarray:
    """Tokens wanted of each value: the budget by shares, and no value above
    ``copies`` times its tokens; the rest goes to the others."""
    one = np.zeros(len(totals), np.int64)
    most = copies * totals
    return np.minimum(most, levels(shares, most, one, np.array([budget]))[0] * shares) if len(totals) else totals


def rake(seed: np.ndarray, places: list[np.ndarray], targets: list[np.ndarray], copies: float = np.inf, rounds: int = ROUNDS) -> np.ndarray:
    """Scales ``seed`` so that its sums by each of ``places`` are ``targets``, no
    cell above ``copies`` times its seed, and the whole is that of the targets."""
    seed = seed.astype(np.float64)
    most = seed * copies if np.isfinite(copies) else np.full(len(seed), np.finfo(float).max)
    factors = [np.ones(len(t)) for t in targets]
    whole = min(float(targets[0].sum()), copies * float(seed.sum()))
    value = lambda: np.prod([f[at] for f, at in zip(factors, places)], axis=0) * seed
    for _ in range(rounds):
        apart = 0.0
        for d, (at, target) in enumerate(zip(places, targets)):
            sums = np.bincount(at, np.minimum(most, value()), len(target))
            apart = max(apart, float(np.abs(sums - target).max()))
            factors[d] = np.ones(len(target))
            factors[d] = levels(value(), most, at, target)
        if apart <= CLOSE * whole:
            break
    x = value()
    some = np.zeros(len(x), np.int64)
    return np.minimum(most, x * levels(x, most, some, np.array([whole]))[0])


def _shares(names: list[str], totals: np.ndarray, asked: dict | None) -> np.ndarray:
    if asked is None:
        out = np.power(totals / totals.sum(), TEMPER)
    else:
        known = {_NULL if k is None else f"={k}": float(v) for k, v in asked.items()}
        out = np.array([known.get(n, 0.0) for n in names])
    out = np.where(totals > 0, out, 0.0)
    return out / out.sum() if out.sum() > 0 else totals / totals.sum()


def _place(column: Column, own: list[str] | None) -> Column:
    """The value under which a source, language or topic is raked."""
    name = F.concat(F.lit("="), column)
    if own is not None:
        name = F.when(column.isin(own), name).otherwise(F.lit(_RARE))
    return F.when(column.isNull(), F.lit(_NULL)).otherwise(name)


class Plan:
    """The raked cells of a corpus, and where documents find theirs."""

    def __init__(self, marked: DataFrame, targets: Targets | None, budget: float, copies: float):
        self.targets, self.budget, self.copies = targets or {}, budget, copies
        cells = written(marked.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("tokens")), "cells")
        whole = cells.agg(F.sum("tokens")).first()[0] or 0
        self.own: dict[str, list[str] | None] = {"topic": None}
        for d in DIMENSIONS[:2]:
            sums = cells.groupBy(d).agg(F.sum("tokens").alias("t"))
            large = sums.where((F.col("t") >= POOL * whole) & F.col(d).isNotNull()).collect()  # at most 1 / POOL
            self.own[d] = sorted({r[d] for r in large} | {k for k in self.targets.get(d, {}) if k is not None}) if whole else []
        rows = cells.groupBy(*(_place(F.col(d), self.own[d]).alias(d) for d in DIMENSIONS)).agg(F.sum("tokens").alias("tokens")).collect()  # pooled
        rows.sort(key=lambda r: tuple(r[d] for d in DIMENSIONS))  # an order that does not depend on the shuffle
        self.cells = [tuple(r[d] for d in DIMENSIONS) for r in rows]
        self.seed = np.array([r.tokens for r in rows], np.float64)
        self.names, self.places, self.wanted = [], [], []
        for d in range(len(DIMENSIONS)):
            names = sorted({c[d] for c in self.cells})
            number = {n: i for i, n in enumerate(names)}
            at = np.array([number[c[d]] for c in self.cells], np.int64)
            totals = np.bincount(at, self.seed, len(names))
            self.names.append(names)
            self.places.append(at)
            asked = self.targets.get(DIMENSIONS[d])
            self.wanted.append(goals(totals, _shares(names, totals, asked), min(budget, copies) * whole, copies) if whole else totals)
        raked = rake(self.seed, self.places, self.wanted, copies) if whole else self.seed
        self.rates = np.divide(raked, self.seed, out=np.full(len(self.seed), budget), where=self.seed > 0)

    def rates_table(self, spark) -> DataFrame:
        values = [(*c, float(r) / self.budget, float(r)) for c, r in zip(self.cells, self.rates)]
        return F.broadcast(spark.createDataFrame(values, "_source string, _lang string, _topic string, weight double, prob double"))

    def margins(self) -> list[tuple[str, str | None, float, float, float]]:
        """dimension, value, tokens, tokens wanted and tokens to be expected."""
        out = []
        for d, names, at, wanted in zip(DIMENSIONS, self.names, self.places, self.wanted):
            own, kept = np.bincount(at, self.seed, len(names)), np.bincount(at, self.seed * self.rates, len(names))
            text = ["(rare)" if n == _RARE else None if n == _NULL else n[1:] for n in names]
            out += [(d, *row) for row in zip(text, own.tolist(), wanted.tolist(), kept.tolist())]
        return out


def _marked(docs: DataFrame, topics: dict[str, tuple[str, ...]] | Column) -> DataFrame:
    own = [c for c in docs.columns if c.lower() not in ("topic", "n_tokens", "weight", "prob", "kept")]
    said = topics.cast("string") if isinstance(topics, Column) else topic(F.coalesce("text", F.lit("")), topics)
    return docs.select(*own, said.alias("topic"), tokens(F.col("text")).alias("n_tokens"))


def _plan(marked: DataFrame, targets: Targets | None, budget: float, copies: float) -> Plan:
    text = lambda c: F.col(c).cast("string").alias(c)
    return Plan(marked.select(text("source"), text("lang"), "topic", "n_tokens"), targets, budget, copies)


def mix(docs: DataFrame, targets: Targets | None = None, topics: dict[str, tuple[str, ...]] | Column = TOPICS, seed: int = 9, budget: float = BUDGET, copies: float = COPIES) -> DataFrame:
    """The columns of ``docs`` (doc_id, text, source, lang among them) with
    topic, n_tokens, weight (raked share over own share of tokens), prob (the
    rate) and kept (how often the document is written; with one copy, whether).
    ``topics``: marks by topic, or a column of few values."""
    marked = _marked(docs, topics)
    plan = _plan(marked, targets, budget, copies)
    same = [_place(F.col(d).cast("string"), plan.own[d]) == F.col(f"_{d}") for d in DIMENSIONS]
    drawn = F.shiftrightunsigned(F.xxhash64("doc_id", "text", F.lit(seed)), 11) / F.lit(float(1 << 53))
    times = (F.floor("prob") + (drawn < F.col("prob") - F.floor("prob")).cast("int")).cast("int")
    joined = marked.join(plan.rates_table(docs.sparkSession), on=same, how="left")
    return joined.select(*marked.columns, "weight", "prob", (times if copies > 1 else times > 0).alias("kept"))


def margins(docs: DataFrame, targets: Targets | None = None, topics: dict[str, tuple[str, ...]] | Column = TOPICS, budget: float = BUDGET, copies: float = COPIES) -> DataFrame:
    """dimension, value, tokens, wanted and expected (kept tokens) of each raked
    value, and met: whether the two agree to a thousandth."""
    rows = _plan(_marked(docs, topics), targets, budget, copies).margins()
    table = docs.sparkSession.createDataFrame(rows, "dimension string, value string, tokens double, wanted double, expected double")
    return table.withColumn("met", F.abs(F.col("wanted") - F.col("expected")) <= 0.001 * F.col("wanted"))


def mixture(docs: DataFrame) -> DataFrame:
    """doc_id, source, lang, topic, n_tokens, weight, prob and kept of every
    document, with tempered targets."""
    return mix(docs.select("doc_id", "text", "source", "lang")).drop("text")


def sampled(docs: DataFrame, targets: Targets | None = None, budget: float = BUDGET) -> DataFrame:
    """The documents kept, with the columns of ``docs``."""
    docs, own = set_apart(docs, ("topic", "n_tokens", "weight", "prob", "kept", "_source", "_lang", "_topic"))
    return mix(docs, targets, budget=budget).where("kept").select(*own)
