"""Decontamination: planted passages, paraphrases and clean look-alikes."""

import random

import numpy as np
import pytest

from freshet.llm import op8_decontamination as op

WORDS = [f"w{i}" for i in range(4000)]
COMMON = ["the", "of", "and", "to", "in", "is", "on", "a"]


def prose(rng, n):
    return [rng.choice(COMMON) if rng.random() < 0.4 else rng.choice(WORDS) for _ in range(n)]


@pytest.fixture(scope="module")
def world(spark):
    rng = random.Random(3)
    items = {i: prose(rng, 20 + 9 * i) for i in range(12)}
    rows, want = [], set()
    for d in range(300):
        text = prose(rng, rng.choice([5, 60, 400]))
        if d % 5 == 0:
            item = items[d // 5 % 12]
            copy = list(item)
            for k in range(0, len(copy), 9):  # a paraphrase: every ninth word is another one
                if d % 2:
                    copy[k] = "other"
            at = rng.randrange(len(text))
            text[at:at] = [w.upper() + "," if d % 3 == 0 else w for w in copy]
            want.add((d, d // 5 % 12))
        rows.append((d, " ".join(text)))
    rows += [(900, None), (901, ""), (902, " \n"), (903, "the of and " * 30_000), (904, " ".join(items[3])), (904, " ".join(items[3])), (None, " ".join(items[4]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()] + [(50, None), (51, ""), (3, "of the")], "item_id long, text string")
    return docs, bench, want | {(904, 3), (None, 4)}


def test_planted_items_are_found_and_nothing_else(spark, world):
    docs, bench, want = world
    clean = bench.where("text != 'of the'")
    assert {(r["doc_id"], r["item_id"]) for r in op.find_leaks(spark, docs, clean).collect()} == want


def test_blocks_of_the_benchmark_give_the_same(spark, world, monkeypatch):
    docs, bench, want = world
    monkeypatch.setattr(op, "BLOCK", 5)
    got = op.find_leaks(spark, docs, bench.where("text != 'of the'"))
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == want


def test_a_block_of_more_passages_than_the_rank(spark):
    """A truncated latent space still proposes every planted item."""
    rng = random.Random(11)
    items = [prose(rng, 40) for _ in range(60)]
    docs = spark.createDataFrame([(i, " ".join(prose(rng, 50) + item + prose(rng, 50))) for i, item in enumerate(items)], "doc_id long, text string")
    (block,) = op._blocks(spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string"))
    index = op.build_index(spark, docs.select("text"), block, rank=45)  # as 384 of 512
    assert {(r["doc_id"], r["item_id"]) for r in op._found(docs, index).collect()} == {(i, i) for i in range(60)}


def test_quotes_across_the_cuts_of_a_long_item(spark):
    rng = random.Random(12)
    item = prose(rng, 260)
    starts = [20, *range(0, len(item) - 88, 6)]  # 20: 44 words on each side of the first cut
    docs = [(i, " ".join(prose(rng, 40) + item[a:a + 88] + prose(rng, 40))) for i, a in enumerate(starts)]
    docs += [(1000 + i, " ".join(prose(rng, 200))) for i in range(20)]
    found = op.find_leaks(spark, spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, " ".join(item))], "item_id long, text string"))
    assert sorted(r["doc_id"] for r in found.collect()) == list(range(len(starts)))


def test_verbatim_items_of_given_documents(spark):
    sf = "/root/testdata/sf0.01"
    texts = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{sf}/benchmark.parquet").collect()
    want = {(d["doc_id"], b["item_id"]) for d in texts for b in items if b["text"] in d["text"]}
    got = {(r["doc_id"], r["item_id"]) for r in op.op8_decontamination(spark, sf).collect()}
    assert want and want <= got and len(got) <= len(want) + 3


def test_empty_tables(spark, world):
    docs, bench, _ = world
    assert op.find_leaks(spark, docs.limit(0), bench).count() == 0
    assert op.find_leaks(spark, docs, bench.limit(0)).count() == 0


def test_longest_common_subsequence():
    rng = np.random.default_rng(1)
    for _ in range(50):
        a, b = rng.integers(0, 6, 12), rng.integers(-1, 6, 30)
        table = np.zeros((13, 31), int)
        for i in range(12):
            for j in range(30):
                table[i + 1, j + 1] = table[i, j] + 1 if a[i] == b[j] else max(table[i, j + 1], table[i + 1, j])
        assert op._lcs(a, b) == table[-1, -1]


def test_basis_spans_the_leading_directions(spark):
    rng = np.random.default_rng(2)
    rows = [rng.integers(0, 40, 25) for _ in range(30)]
    idf = rng.random(40) + 0.5
    dense = np.zeros((30, 40))
    for i, r in enumerate(rows):
        term, w = op._row(r, idf)
        dense[i, term] = w
    basis = op.latent_basis(spark, rows, idf, 30)
    assert np.allclose(dense @ basis @ basis.T, dense, atol=1e-6)
    assert np.allclose(np.linalg.norm(dense @ basis, axis=0), np.linalg.svd(dense, compute_uv=False), atol=1e-6)


def zipf_world(seed, n_items, length=64, size=20_000):
    """Items of Zipf words, and in how many tiles of a corpus each word is."""
    rng = np.random.default_rng(seed)
    p = 1 / np.arange(1, size + 1)
    p /= p.sum()
    tiles = rng.choice(size, (5000, op.WINDOW), p=p)
    df = np.bincount(np.concatenate([np.unique(t) for t in tiles]), minlength=size)
    return rng.choice(size, (n_items, length), p=p), df, lambda n: rng.choice(size, n, p=p)


def as_text(words):
    return " ".join(f"w{w}" for w in words)


def test_a_full_block_finds_items_whose_rarest_words_are_changed(spark):
    items, df, words = zipf_world(5, op.BLOCK)
    block = [op.Passage(i, op.words_of(as_text(w))) for i, w in enumerate(items)]
    known = {f"w{w}".encode(): int(n) for w, n in enumerate(df)}, 5000
    index = op.build_index(spark, None, block, frequencies=known)
    found = {0.0: 0, 0.25: 0, 0.29: 0}
    for i, item in enumerate(items[:120]):
        for share in found:
            copy = item.copy()
            rarest = np.argsort(df[item], kind="stable")[:int(share * len(item))]
            copy[rarest] = words(len(rarest))
            hits = op._hits(as_text([*words(100), *copy, *words(100)]), [index])
            found[share] += any(h[0] == i for h in hits)
    assert found[0.0] == 120 and min(found.values()) >= 0.9 * 120, found


def test_an_items_words_in_another_order_are_no_copy(spark):
    rng = random.Random(6)
    items = {i: prose(rng, 20 + i) for i in range(45)}
    shuffled = [(i, " ".join(w for _ in range(12) for w in rng.sample(item, len(item)))) for i, item in items.items()]
    copies = [(100 + i, " ".join(prose(rng, 30) + item + prose(rng, 30))) for i, item in items.items()]
    # The answer, the last quarter, stands before the question. What follows holds none
    # of the frequent words: of those, half a short answer may come together by chance.
    turned = [(200 + i, " ".join(item[-(len(item) // 4):] + item[:-(len(item) // 4)] + rng.sample(WORDS, 40))) for i, item in items.items()]
    docs = spark.createDataFrame(shuffled + copies + turned, "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in op.find_leaks(spark, docs, bench).collect()} == {(100 + i, i) for i in items}


def test_the_corpus_is_read_once_a_pass_and_once_for_frequencies(spark, world, monkeypatch):
    docs, bench, want = world
    monkeypatch.setattr(op, "BLOCK", 2)
    clean = bench.where("text != 'of the'")
    frequency, passes = [], []
    count, found = op._frequencies, op._found
    monkeypatch.setattr(op, "_frequencies", lambda *a: frequency.append(1) or count(*a))
    monkeypatch.setattr(op, "_found", lambda d, *held: passes.append(len(held)) or found(d, *held))
    got = {(r["doc_id"], r["item_id"]) for r in op.find_leaks(spark, docs, clean).collect()}
    blocks = len(list(op._blocks(clean)))
    assert got == want and blocks > op.BLOCKS_PER_PASS
    assert len(frequency) == 1 and sum(passes) == blocks and len(passes) == -(-blocks // op.BLOCKS_PER_PASS)


def test_share_against_every_split():
    rng = np.random.default_rng(4)
    for _ in range(100):
        want, text = rng.integers(0, 8, rng.integers(1, 14)), rng.integers(-1, 8, rng.integers(0, 30))
        answer = max(1, len(want) // 4)
        cuts = [(op._lcs(want[:-answer], text[:k]), op._lcs(want[-answer:], text[k:])) for k in range(len(text) + 1)]
        expect = max((h + a for h, a in cuts if a >= op.MIN_ANSWER * answer), default=0) / len(want)
        assert op._share(want, text) == expect
