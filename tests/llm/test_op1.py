"""Language identification: held-out accuracy and the defined cases."""

import numpy as np
from pyspark.sql import functions as F

from freshet.llm import op1_language_id as op


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = op.op1_language_id(spark, sf)
    assert got.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    rows = got.join(docs, "doc_id").collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_bundle_equals_bound_letters_one_by_one():
    binder = op.Binder(64, 1)
    sym = op.symbols("Ab, ça 12 b", binder.letters)
    assert sym.tolist() == [0, *map(ord, "ab"), 0, *map(ord, "ça"), 0, ord("b"), 0]
    place = binder._rows(sym)
    vec = {c: binder.base[p].astype(int) for c, p in zip(sym.tolist(), place)}
    want = sum(np.roll(vec[a], 2) * np.roll(vec[b], 1) * vec[c] for a, b, c in zip(sym, sym[1:], sym[2:]))
    assert binder.bundle(*op.trigrams(sym)).tolist() == want.tolist()


def test_pieces_of_a_long_text_add_up(monkeypatch):
    letters = op.letter_table()
    sym = op.symbols("the quick brown fox " * 300, letters)
    whole = op.trigrams(sym)
    monkeypatch.setattr(op, "_PIECE", 100)
    assert [x.tolist() for x in op.trigrams(sym)] == [x.tolist() for x in whole]


def test_defined_cases(spark):
    rows = [(1, "the cat sat on the mat", "en"), (2, "le chat est sur la table", "fr"), (3, None, "en"), (4, "", "fr"), (5, "12 % 4", "en"),
            (6, "the mat", None), (7, "a", "en"), (6, "the mat", None), (None, "la table", None), (8, "le chat " * 300_000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    learned = op.learn_prototypes(docs)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in op.predict(docs, learned).collect()}
    assert [got[i] for i in (3, 4, 5)] == [("und", 0.0)] * 3
    assert got[6][0] == "en" and got[None][0] == "fr" and got[8][0] == "fr"
    assert op.predict(docs, {}).where("lang_pred != 'und'").count() == 0
    assert op.learn_prototypes(docs.limit(0)) == {}


def test_stage_drops_what_has_no_letters(spark):
    rows = [(1, "the cat sat on the mat", "en", 1), (3, None, "en", 1), (5, "12 % 4", "en", 1), (9, "chat", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred int")
    kept = op.keep_identified(spark, docs, "")
    assert kept.schema == docs.schema
    assert sorted((r["doc_id"], r["lang_pred"]) for r in kept.collect()) == [(1, 1), (9, None)]
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert sorted(r["doc_id"] for r in op.keep_identified(spark, unlabelled, "").collect()) == [1, 9]
