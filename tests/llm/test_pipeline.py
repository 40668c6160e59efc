"""The pipeline, stage by stage, against brute force on the given documents."""

import re

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from freshet.operators.materialize import materialize
from tests.llm.test_op2 import BASE
from tests.llm.test_op7 import groups, slow_fingerprint
from tests.llm.test_op9 import judge

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark):
    """Input and output rows of every stage."""
    docs, found = spark.read.parquet(f"{SF}/documents.parquet"), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out = materialize(stage(spark, docs, SF), name)
        if name != "mix_sources":
            assert out.columns == columns
        found[name] = (docs.collect(), out.collect())
        docs = out
    return found


def ids(rows):
    return sorted(r["doc_id"] for r in rows)


def test_language_stage(steps):
    before, after = steps["language_id"]
    assert ids(after) == ids(r for r in before if r["text"] and re.search(r"[^\W\d_]", r["text"]))


def test_near_dedup_stage(steps):
    before, after = steps["simhash_near_dedup"]
    before = sorted(before, key=lambda r: r["doc_id"])
    first = groups([slow_fingerprint(r["text"]) for r in before], 4)
    assert ids(after) == [before[g]["doc_id"] for i, g in enumerate(first) if i == g]


def test_decontamination_stage(steps, spark):
    before, after = steps["benchmark_decontamination"]
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaked = {r["doc_id"] for r in before if any(t in r["text"] for t in items)}
    gone = set(ids(before)) - set(ids(after))
    assert leaked <= gone and len(gone) <= len(leaked) + 3


def test_secret_stage(steps):
    before, after = steps["secret_scan"]
    assert ids(before) == ids(after)
    old = {r["doc_id"]: r["text"] for r in before}
    for r in after:
        text = old[r["doc_id"]]
        hit = any(ok(m) for _, p, ok in BASE for m in p.finditer(text))
        assert hit == (r["text"] != text)
        assert not any(ok(m) for _, p, ok in BASE for m in p.finditer(r["text"])) and r["n_chars"] == len(r["text"])


def test_mix_stage(steps):
    before, after = steps["mix_sources"]
    sizes = {}
    for r in before:
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(r["text"].encode().split())
    judge(after, sizes)
    assert ids(before) == ids(after)


def test_run_equals_the_stages(spark, steps):
    assert "pipeline" in entry.queries()
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted(map(str, got)) == sorted(map(str, steps["mix_sources"][1]))


def run_stages(spark, docs):
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out = materialize(stage(spark, docs, SF), name)
        if name != "mix_sources":
            assert out.dtypes == docs.dtypes and out.columns == columns
        docs = out
    return docs


def awkward(spark):
    rows = [
        (1, None, "en", "a", None), (None, "the cat sat on the mat and slept", "en", "a", 32), (3, "", None, None, 0), (4, " \t\n ", "fr", "b", 4),
        (5, "le chat est sur la table et il dort", "fr", None, 35), (5, "le chat est sur la table et il dort", "fr", None, 35),
        (6, "the dog sat by the door and barked " * 40_000, "en", "hot", 1), (7, "12 34 %%", "en", "b", 8), (8, "a", None, "b", 1),
        (9, 'the key token = "abcdef0123456789" is here', None, "c", 42), (10, "THE CAT sat on the mat and slept", "en", "a", 32),
    ]
    base = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    clash = ("size", "fp", "score", "spans", "target", "blob", "lang_pred", "component_id", "item_id", "taken", "x", "no")
    return base.selectExpr("*", *[f"'kept' AS {c}" for c in clash])


def test_awkward_rows_pass_every_stage(spark):
    out = run_stages(spark, awkward(spark)).collect()
    got = {r["doc_id"]: (r["source"], r["size"]) for r in out}
    # No letter: 1, 3, 4, 7 go. Of the repeated row 5 and of the copies 10 and null one stays.
    assert sorted(map(str, got)) == sorted(map(str, [5, 6, 8, 9, 10])) and len(out) == 5
    assert got[6] == ("hot", 320_000) and got[5] == (None, 9) and got[9] == ("c", 5)
    judge(out, {s: sum(n for t, n in got.values() if t == s) for s in {t for t, _ in got.values()}})


def test_an_empty_table_passes_every_stage(spark):
    assert run_stages(spark, awkward(spark).limit(0)).count() == 0
