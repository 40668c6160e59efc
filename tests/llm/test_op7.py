"""SimHash groups against brute force over all pairs."""

import numpy as np
import pytest
import xxhash

from freshet.llm import op7_simhash as op
from freshet.llm.components import component_labels


def slow_fingerprint(text, shingle=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(fps, max_bits):
    """Smallest position reachable, by flooding over all pairs."""
    fps = np.asarray(fps, np.uint64)
    seen = np.full(len(fps), -1)
    for i in range(len(fps)):
        if seen[i] < 0:
            seen[i], todo = i, [i]
            while todo:
                near = np.flatnonzero((np.bitwise_count(fps ^ fps[todo.pop()]) <= max_bits) & (seen < 0))
                seen[near] = i
                todo += near.tolist()
    return seen.tolist()


def family(rng, n, base, flips):
    out = []
    for _ in range(n):
        x = int(base)
        for b in rng.integers(0, 64, flips):
            x ^= 1 << int(b)
        out.append(x)
    return out


def test_fingerprint_matches_definition():
    for t in [None, "", " \t\n", "one", "a b c", "A b C d", "É\x1cx y\x0bz w v u t", "w " * 50 + "x y z"]:
        assert op.fingerprint(t) == slow_fingerprint(t)


def test_search_and_forest_match_brute_force():
    rng = np.random.default_rng(5)
    fps = np.unique(np.array(family(rng, 900, 0xF0F0F0F0F0F0F0F0, 6) + family(rng, 300, 12345, 2), np.uint64))
    q, other = op.search(fps[:50], fps, op._levels(fps), 4)
    want = {(i, j) for i in range(50) for j in range(len(fps)) if int(fps[i] ^ fps[j]).bit_count() <= 4}
    assert set(zip(q.tolist(), other.tolist(), strict=True)) == want


@pytest.mark.parametrize("block", [1024, 32])
def test_components_match_brute_force(spark, monkeypatch, block):
    # Small blocks make one top node spread over many blocks and tasks.
    monkeypatch.setattr(op, "BLOCK", block)
    rng = np.random.default_rng(7)
    fps = family(rng, 500, 0xDEADBEEFCAFEF00D, 3) + family(rng, 500, 0x1234567890ABCDEF, 12)
    fps += [int(x) for x in rng.integers(0, 2**63, 500, np.int64)] + [0, 0, 1, 2**63, (1 << 64) - 1] * 3
    rows = [(i, int(np.uint64(f).astype(np.int64))) for i, f in enumerate(fps)]
    df = spark.createDataFrame(rows, "doc_id long, fp long")
    found = df.join(op.components(df), "fp").select("doc_id", "component_id").collect()
    assert dict(map(tuple, found)) == dict(enumerate(groups(fps, 4)))


def test_long_chain_and_star(spark):
    chain = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(2000, 2400)] + [(5, 5)]
    got = dict(map(tuple, component_labels(spark.createDataFrame(chain, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(1, 201)}, **{i: 1000 for i in range(2000, 2400)}}


def test_query_on_given_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").select("doc_id", "text").collect()
    fps = [slow_fingerprint(r["text"]) for r in docs]
    want = {r["doc_id"]: (f"{f:016x}", docs[g]["doc_id"]) for r, f, g in zip(docs, fps, groups(fps, 4), strict=True)}
    got = {r[0]: (r[1], r[2]) for r in op.op7_simhash(spark, sf_dir).collect()}
    assert got == want


def test_stage_keeps_one_row_of_each_group_and_its_columns(spark):
    text = "the quick brown fox jumps over the lazy dog again and again"
    rows = [(3, text, "en", "a"), (2, text.upper(), "en", "b"), (2, text, "en", "c"), (9, None, None, None), (8, "", "x", "y"),
            (None, "a very different text that has no near copy at all here", "en", "z"), (5, "word " * 20000, "en", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, fp string")
    kept = op.keep_one_of_each_group(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == [-1, 2, 5, 8]
    assert op.keep_one_of_each_group(spark, docs.limit(0), "").count() == 0
