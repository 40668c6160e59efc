"""Secret scans against direct scanning, and the ledger's increments."""

import hashlib
import re

from pyspark.sql import functions as F

from freshet.llm import op2_secrets as op

BASE = (
    ("assign", re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A), lambda m: len(m[2]) >= 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24),
)
KEY = "0123456789abcdef" * 3


def expected(text):
    text = text or ""
    spans = sorted(((m.start(), i, k, m.end()) for i, (k, p, ok) in enumerate(BASE) for m in p.finditer(text) if ok(m)))
    joined = ",".join(f"{k}:{a}:{b}" for a, _, k, b in spans)
    return [sum(s[2] == k for s in spans) for k, *_ in BASE], hashlib.sha256(joined.encode()).hexdigest(), joined


def check(rows, texts):
    assert len(rows) == len(texts)
    for r in rows:
        counts, digest, joined = expected(texts[r["doc_id"]])
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == counts and r["base_sha256"] == digest
        kept = ",".join(s for s in r["spans"].split(",") if s.split(":")[0] in ("assign", "access", "hex"))
        assert kept == joined


def test_given_documents(spark):
    sf = "/root/testdata/sf0.01"
    texts = dict(map(tuple, spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()))
    rows = op.op2_secrets(spark, sf).collect()
    check(rows, texts)
    assert any(r["spans"] for r in rows)


def test_edge_cases(spark, tmp_path):
    texts = {
        1: None, 2: "", 3: f"é𝄞 Token= 'abc' token=abcdef password : \"{KEY}\" x", 4: "AKIA" + "Z" * 15 + " AKIA" + "9" * 16, 5: "api_key=short apikey=longer-one",
        6: "tokentoken==x" + "a" * 23 + "g" + "b" * 24, 7: "paſſword=abcdefgh toKen=abcdefgh", 8: ("word " * 50_000) + f"secret:{KEY}", 9: "-----BEGIN RSA PRIVATE KEY-----",
        10: f"secret:{KEY}", 11: f"secret:{KEY}",
    }
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumn("spans", F.lit(1)).write.parquet(f"{tmp_path}/documents.parquet")
    rows = op.op2_secrets(spark, str(tmp_path)).collect()
    check(rows, texts)
    assert [r["spans"] for r in rows if r["doc_id"] == 9] == ["private_key:0:31"]


def test_runs_of_token_starts_take_time_in_proportion():
    scan = op.scanner(op.RULES)
    assert scan("eyJ" * 300_000, set()) == []
    assert [s[0] for s in scan("x eyJhbGciOiJI.eyJzdWIiOiIx.c2lnbmF0dXJl y", set())] == ["web_token"]


def test_ledger_scans_only_unseen_pairs(spark, tmp_path):
    ledger = f"{tmp_path}/ledger"
    first = spark.createDataFrame([(1, f"token={KEY}"), (2, f"token={KEY}"), (3, "clean")], "doc_id long, text string")
    more = spark.createDataFrame([(4, f"token={KEY}"), (5, "AKIA" + "A" * 16), (6, None), (6, None)], "doc_id long, text string")
    assert op.scan_versions(spark, first, ledger) == 2
    assert op.scan_versions(spark, first, ledger) == 0
    both = first.unionByName(more)
    got = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"]] for r in op.scan_paths(spark, both, ledger).collect()}
    assert got[1] == got[2] == got[4] == [("assign", 0, 54), ("hex", 6, 54)] and got[5] == [("access", 0, 20)] and got[3] == got[6] == []
    assert op.scan_versions(spark, both, ledger) == 0
    # A new rule version rescans every blob with that rule alone.
    newer = tuple(op.Rule("hex", 2, "[0-9a-f]{48,}", 48) if r.kind == "hex" else r for r in op.RULES)
    assert op.scan_versions(spark, both, ledger, newer) == 4
    assert spark.read.parquet(ledger).where("array_contains(rules, 'hex@2') and size(rules) = 1").count() == 4
    got = {r["doc_id"]: [s["kind"] for s in r["spans"]] for r in op.scan_paths(spark, both, ledger, newer).collect()}
    assert got[1] == ["assign", "hex"]


def test_stage_masks_and_keeps_clean_rows(spark):
    text = f"é a token={KEY} b {KEY}"
    rows = [(1, text, len(text), "x"), (2, "clean", 5, "x"), (3, None, None, "x"), (2, "clean", 5, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, blob string")
    got = sorted((r["doc_id"], r["text"], r["n_chars"]) for r in op.mask_secrets(spark, docs, "").collect() if r["doc_id"] != 3)
    assert got == [(1, "é a [SECRET] b [SECRET]", 23), (2, "clean", 5), (2, "clean", 5)]
    assert op.mask_secrets(spark, docs, "").columns == docs.columns
    assert op.mask_secrets(spark, docs.limit(0), "").count() == 0


def _exchanges(df):
    """Output columns of every exchange of a plan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange" in line], plan


def test_the_ledger_is_asked_by_hashes_alone(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text")
    ledger = f"{tmp_path}/ledger"
    names = [op.rule_name(r) for r in op.RULES]
    assert op.scan_versions(spark, docs, ledger) > 0
    held = op._ledger(spark, ledger)
    exchanges, plan = _exchanges(op.unscanned(docs, held, names))
    assert exchanges and not [e for e in exchanges if "text" in e], plan
    # What groups and joins on the way up holds no text either: it is hashed at the scan.
    assert "first(" not in plan


def test_few_and_many_new_blobs_give_the_same(spark, tmp_path, monkeypatch):
    first = spark.createDataFrame([(f"token={KEY}",), ("clean",)], "text string")
    more = spark.createDataFrame([(f"token={KEY}",)] * 3 + [(f"secret={KEY}",)] * 4 + [("other",), (None,), ("",)], "text string")
    found = []
    for few in (100, 0):
        monkeypatch.setattr(op, "FEW_BLOBS", few)
        ledger = f"{tmp_path}/ledger{few}"
        assert op.scan_versions(spark, first, ledger) == 2
        assert op.scan_versions(spark, more, ledger) == 3
        assert op.scan_versions(spark, more, ledger) == 0
        found.append(sorted(map(tuple, spark.read.parquet(ledger).selectExpr("blob", "to_json(rules)", "to_json(spans)").collect())))
    assert found[0] == found[1] and len(found[0]) == 5
