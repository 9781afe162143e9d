"""The registered queries on the sf0.001 tables; against DuckDB where SQL can
say it. The pipeline against its operators, one after the other."""

import os

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from areacast.llm import mixing, quality, simhash
from areacast.llm.common import table
from areacast.llm.queries import ORACLE_SQL, QUERIES

DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_oracle(spark, name):
    got = QUERIES[name](spark, DIR).toPandas()
    db = duckdb.connect()
    for t in ("documents", "benchmark"):
        db.execute(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    want = db.sql(ORACLE_SQL[name]).df()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    order = lambda x: x[columns].sort_values(columns).astype(object).where(x.notna(), None).reset_index(drop=True)
    assert order(got).equals(order(want))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_rows(spark, name):
    n = QUERIES[name](spark, DIR).count()
    documents = table(spark, DIR, "documents").count()
    if name.startswith("op1_"):
        queries = table(spark, DIR, "embeddings").where("vec_id % 50 = 0").count()
        assert 0.95 * 5 * queries <= n <= 5 * queries
    elif name.startswith("op4_"):
        assert n == table(spark, DIR, "conversations").select("conv_id").distinct().count() + 1
    elif name.startswith("op12_"):
        assert n == 4 * table(spark, DIR, "embeddings").count()
    elif name.startswith("op13_"):
        assert n > documents
    else:
        assert n == documents


def test_neighbours_recall(spark):
    rows = QUERIES["op1_multiprobe_neighbours"](spark, "/root/testdata/sf0.1").toPandas()
    vectors = table(spark, "/root/testdata/sf0.1", "embeddings").toPandas().sort_values("vec_id")
    x, ids = np.stack(vectors.embedding).astype(float), vectors.vec_id.to_numpy()
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    hit = total = 0
    for q in np.flatnonzero(ids % 50 == 0):
        s = x @ x[q]
        s[q] = -2
        hit += len(set(ids[np.argsort(-s)[:5]]) & set(rows.vec_id[rows.query_id == ids[q]]))
        total += 5
    assert hit >= 0.9 * total


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    known = table(spark, d, "documents").toPandas().set_index("doc_id")
    lang = QUERIES["op3_language_id"](spark, d).toPandas().query("held_out")
    assert (known.lang[lang.doc_id].to_numpy() == lang.lang_pred.to_numpy()).mean() >= 0.97
    labels = table(spark, d, "labels").toPandas().set_index("doc_id").quality
    scored = QUERIES["op7_quality_classifier"](spark, d).toPandas().query("held_out").set_index("doc_id")
    both = scored.join(labels, how="inner")
    assert (both.predicted == both.quality).mean() >= 0.95
    assert both.predicted[both.quality == 1].mean() >= 0.97
    model = QUERIES["op6_lm_scoring"](spark, d).toPandas().query("held_out")
    assert model.score.sum() > model.base_score.sum()


def test_pipeline_equals_its_operators(spark):
    got = corpus_pipeline.run(spark, DIR).toPandas()
    docs, labels = table(spark, DIR, "documents"), table(spark, DIR, "labels")
    scored = quality.score_quality(docs, quality.fit_quality(docs, labels)).toPandas()
    good = scored[scored.predicted == 1].set_index("doc_id")
    prints = {i: simhash.fingerprint(t.encode()) for i, t in good.text.items()}
    least = {i: i for i in prints}
    for _ in range(10):
        for a in prints:
            for b in prints:
                if (prints[a] ^ prints[b]).bit_count() <= 3:
                    least[a] = least[b] = min(least[a], least[b])
    apart = spark.createDataFrame(good.loc[[i for i in prints if least[i] == i]].reset_index()[list(docs.columns)], docs.schema)
    db = duckdb.connect()
    db.register("documents", apart.toPandas())
    db.execute(f"create view benchmark as select * from '{DIR}/benchmark.parquet'")
    dirty = set(db.sql(ORACLE_SQL["op5_benchmark_decontamination"]).df().query("contaminated").doc_id)
    assert dirty
    clean = apart.where(~apart.doc_id.isin(*dirty))
    assert set(got.doc_id) == {r.doc_id for r in mixing.mix(clean).where("kept").collect()}
    assert got.sort_values("doc_id").start.is_monotonic_increasing
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.where("false"), DIR).columns == docs.columns, name


def test_pipeline_over_nulls_long_texts_and_repeats(spark, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    from areacast.llm import common, tokens

    docs = table(spark, DIR, "documents")
    long = " ".join(r.text for r in docs.where("text is not null").orderBy("doc_id").limit(60).collect())
    first = docs.orderBy("doc_id").first()
    odd = [(900_001, None, None, None), (900_002, "", "en", "src1"), (900_003, long, "en", None), (None, first.text, "en", "src0"), (None, None, None, None), (None, long, None, "src0")]
    more = spark.createDataFrame(odd, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text"))
    whole = docs.unionByName(more.select(*(F.col(f.name).cast(f.dataType) for f in docs.schema))).union(docs.limit(20))
    whole.write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        table(spark, DIR, name).write.parquet(f"{tmp_path}/{name}.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    assert len(got) and got.start.tolist() == np.append(0, np.cumsum(got.n_tokens))[:-1].tolist()
    plain = Tokenizer.from_file(public_tokenizers.path(tokens.TOKENIZER))
    sizes = {}
    for r in whole.collect():
        sizes.setdefault(r.doc_id, set()).add(len(plain.encode(r.text or "", add_special_tokens=False).ids) + 1)
    assert all(n in sizes[None if i != i else int(i)] for i, n in zip(got.doc_id, got.n_tokens))
    # Only what the result reads is left.
    made = [p.removeprefix("file:") for p in common._MADE[spark.sparkContext.applicationId]]
    assert not [p for p in made if "/stage-" in p] and os.path.isdir(made[-1]) and "/token-files" in made[-1]
    common.remove_made(spark)
    assert not os.path.isdir(made[-1])


def test_a_failing_pipeline_leaves_nothing(spark, monkeypatch):
    from areacast.llm import common

    def fails(spark, docs, sf_dir):
        raise ValueError("no tokens")

    common.remove_made(spark)
    monkeypatch.setattr(corpus_pipeline, "STAGES", [*corpus_pipeline.STAGES[2:4], ("token_output", fails)])
    with pytest.raises(ValueError, match="no tokens"):
        corpus_pipeline.run(spark, DIR)
    assert common._MADE[spark.sparkContext.applicationId] == []


def test_stages_return_the_documents_own_columns(spark):
    docs = table(spark, DIR, "documents")
    clash = ("score", "predicted", "n_words", "spans", "items", "topic", "n_tokens", "weight", "prob", "Kept", "_row", "_source")
    docs = docs.select(*docs.columns, *(F.concat(F.lit(f"{c} of "), F.col("doc_id").cast("string")).alias(c) for c in clash))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, DIR)
        assert out.schema.simpleString() == docs.schema.simpleString(), name
        rows = out.collect()
        assert rows and all(r[c] == f"{c} of {r.doc_id}" for r in rows for c in clash), name
