"""Quality: held-out accuracy, the prior, and the defined cases."""

import ast
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from freshet.llm import op4_quality as op


@pytest.fixture(scope="module")
def scored(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    return op.op4_quality(spark, sf).join(labels, "doc_id", "left").collect(), spark.read.parquet(f"{sf}/documents.parquet").count()


def test_held_out_documents_are_ranked_and_cut_right(scored):
    rows, n = scored
    assert len(rows) == n
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r["held_out"] and r["quality"] is not None]
    assert sum(r["predicted"] == r["quality"] for r in held) >= 0.95 * len(held)
    good, bad = ([r["score"] for r in held if r["quality"] == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) >= 0.97


def test_prior_of_a_known_mixture():
    rng = np.random.default_rng(1)
    draw = lambda n, at: rng.standard_normal((n, 4)) + at
    pos, unl = draw(2000, 2), np.concatenate([draw(1400, 2), draw(600, -2)])
    both = np.concatenate([pos, unl])
    mean, scale = both.mean(axis=0), both.std(axis=0)
    halves = [unl[0::2], unl[1::2]]
    above = lambda h, model, cuts: (model.logit(halves[h])[:, None] >= cuts).mean(axis=0)
    assert abs(op.estimate_prior(pos, halves, mean, scale, above) - 0.7) < 0.05
    model = op.train(pos, unl, 0.7, mean, scale)
    assert (model.score(draw(500, 2)) > 0.5).mean() > 0.97 and (model.score(draw(500, -2)) < 0.5).mean() > 0.97


def test_negative_labels_are_not_learned_from(spark):
    """Turning every label 0 into no label at a row outside the sample of
    unlabelled rows changes nothing: only label 1 and null are read."""
    rng = np.random.default_rng(2)
    x = rng.random((60, op.WIDTH)).astype(np.float32)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "doc_id long, x array<float>")
    labels = spark.createDataFrame([(i, 1 if i < 20 else 0) for i in range(40)] + [(3, 1)], "doc_id long, quality int")
    a, b = op.fit(rows, labels), op.fit(rows.where("doc_id < 20 or doc_id >= 40"), labels)
    assert np.array_equal(a.w1, b.w1)


def _risk(par, zp, zu, prior):
    """The part of the risk that a step follows, and the ridge, as written."""
    logit = lambda x: np.tanh(x @ par[0] + par[1]) @ par[2] + par[3]
    loss = lambda g: np.log1p(np.exp(-g)).mean()
    gp, gu = logit(zp), logit(zu)
    ridge = op.RIDGE * ((par[0] ** 2).sum() + (par[2] ** 2).sum()) / 2
    if prior is None:
        return loss(gp) + loss(-gu) + ridge
    rest = loss(-gu) - prior * loss(-gp)
    return (prior * loss(gp) + rest if rest >= 0 else -rest) + ridge


@pytest.mark.parametrize("prior, shift", [(None, 0), (0.4, 0), (0.95, 3)])
def test_gradients_are_those_of_the_risk(prior, shift):
    rng = np.random.default_rng(5)
    zp, zu = rng.standard_normal((30, 4)) + shift, rng.standard_normal((50, 4)) - shift
    par = [rng.standard_normal((4, op.HIDDEN)), rng.standard_normal(op.HIDDEN), rng.standard_normal(op.HIDDEN), np.array([0.3])]
    for p, g in zip(par, op.gradients(par, zp, zu, prior)):
        for at in list(np.ndindex(p.shape))[:40]:
            was, found = p[at], []
            for d in (1e-6, -1e-6):
                p[at] = was + d
                found.append(_risk(par, zp, zu, prior))
            p[at] = was
            assert abs((found[0] - found[1]) / 2e-6 - g[at]) < 1e-6


def test_statistics_and_shares_cover_all_rows(spark):
    """More rows than the sample: means, deviations and shares are those of all."""
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.random((900, op.WIDTH)), rng.random((100, op.WIDTH)) + 5]).astype(np.float32)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "doc_id long, x array<float>").repartition(7)
    mean, scale = op.statistics(rows)
    assert np.allclose(mean, x.astype(float).mean(axis=0)) and np.allclose(scale, x.astype(float).std(axis=0) + 1e-6)
    labels = spark.createDataFrame([(i, 1) for i in range(300)], "doc_id long, quality int")
    model = op.fit(rows, labels, sample=40)
    assert np.allclose(model.mean, mean) and np.allclose(model.scale, scale)
    logit = model.logit(x.astype(float))
    cuts = np.quantile(logit, [0, 0.1, 0.5, 0.9, 1])
    assert np.allclose(op.share_above(rows, model, cuts), [(logit >= c).mean() for c in cuts])


def test_defined_cases(spark, tmp_path):
    texts = [None, "", " \n", "word " * 200_000, "one", "ünï cödé \U0001f600 text."] + [f"some words here {i}." for i in range(40)] * 2
    docs = spark.createDataFrame([(i % 60, t, 1, "c") for i, t in enumerate(texts)], "doc_id long, text string, score int, x string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.createDataFrame([(i, 1) for i in range(6, 30)] + [(7, 0), (None, 1), (9, None)], "doc_id long, quality int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    got = op.op4_quality(spark, str(tmp_path)).collect()
    assert len(got) == len(texts) and all(0 <= r["score"] <= 1 for r in got)
    labels.limit(0).write.mode("overwrite").parquet(f"{tmp_path}/labels.parquet")
    assert {r["score"] for r in op.op4_quality(spark, str(tmp_path)).collect()} == {0.5}
    assert op.score(op.with_features(docs.limit(0)), None).count() == 0
    assert "score" in op.score(op.with_features(docs), None).columns and docs.select(F.count("*")).first()[0] == len(texts)


def test_learning_rows_are_written_once_and_names_are_not_overridden(spark, monkeypatch):
    names = [n.name for n in ast.parse(Path(op.__file__).read_text()).body if isinstance(n, ast.FunctionDef)]
    assert len(names) == len(set(names))
    written = []
    monkeypatch.setattr(op, "materialize", lambda df, name: written.append(name) or df)
    rows = spark.createDataFrame([(0, [0.0] * op.WIDTH)], "doc_id long, x array<double>")
    assert op.fit(rows, spark.createDataFrame([(0, 1)], "doc_id long, quality int")) is None and written == ["quality-known"]
