"""The Merkle manifest against a plain recursive one."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from freshet.llm import op13_manifest as op

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, `group` int"


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def _leaf(doc_id, text, lang, source, n_chars):
    return _h(*map(_field, (doc_id, source, lang, n_chars, text)))


def _climb(nodes):
    """(root, for each node its path of (left, right) texts)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(paths):
            start = at[i] // 8 * 8
            p.append(("".join(nodes[start:at[i]]), "".join(nodes[at[i] + 1:start + 8])))
            at[i] //= 8
        nodes = [_h(*nodes[i:i + 8]) for i in range(0, len(nodes), 8)]
    return nodes[0], paths


def _plain(rows):
    by_lang = {}
    for r in rows:
        by_lang.setdefault(r[2], []).append(r)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = []
    for lang in langs:
        own = sorted(((r[0] is not None, r[0] or 0, _leaf(*r[:5]), r) for r in by_lang[lang]), key=lambda x: x[:3])
        trees.append((own, *_climb([x[2] for x in own])))
    root, above = _climb([t[1] for t in trees])
    out = []
    for (own, sub, paths), top in zip(trees, above):
        for (_, _, leaf, r), path in zip(own, paths):
            shown = leaf
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[1] is not None:
                low = "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1])
                shown = _leaf(r[0], low, *r[2:5])
            for left, right in path + top:
                shown = _h(left, shown, right)
            out.append((r[0], leaf, sub, root, _h(*(x for p in path + top for x in p)), shown, shown == root))
    return out


def _run(spark, tmp_path, rows):
    folder = str(tmp_path / "sf")
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    df = op.op13_manifest(spark, folder)
    assert df.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return [tuple(r) for r in df.collect()]


def _row(rng, i, lang):
    text = rng.choice([None, "", "Äb C", "plain", "X" * rng.randrange(50)])
    return (i, text, lang, rng.choice([None, "web", "-"]), rng.choice([None, 0, 7]), "clash", 1)


@pytest.mark.parametrize("block_levels", [1, 2])
def test_like_a_plain_tree(spark, tmp_path, monkeypatch, block_levels):
    monkeypatch.setattr(op, "BLOCK_LEVELS", block_levels)
    monkeypatch.setattr(op, "BLOCK", 8**block_levels)
    rng = random.Random(13)
    sizes = {None: 3, "": 1, "en": 530, "ß": 64, "de": 65, **{f"l{i}": rng.choice([1, 8, 9, 20]) for i in range(15)}}
    rows, at = [], 2**60
    for lang, n in sizes.items():
        for _ in range(n):
            at += rng.choice([1, 5])
            rows.append(_row(rng, at, lang))
    rows += [rows[5], rows[100], rows[100], (None, "Text", "en", None, None, "clash", 1), (None, None, None, None, None, "clash", 1)]
    key = lambda r: tuple(map(str, r))
    got = _run(spark, tmp_path, rows)
    assert sorted(got, key=key) == sorted(_plain([r[:5] for r in rows]), key=key)
    assert not all(r[-1] for r in got)


@pytest.mark.parametrize("n", [0, 1, 2])
def test_small_tables(spark, tmp_path, n):
    rows = [(9 + i, "Aa", "en", "s", 2, "clash", 1) for i in range(n)]
    got = _run(spark, tmp_path, rows)
    assert sorted(got) == sorted(_plain([r[:5] for r in rows])) if n else got == []
    if n == 1:  # a lone leaf is the root; nothing is in its proof
        assert got[0][1] == got[0][2] == got[0][3] and got[0][4] == _h()


def test_leaf_lengths_are_bytes(spark):
    df = spark.createDataFrame([(1, "é", None)], "a long, b string, c string")
    assert df.select(op.leaf_of(F.col("a"), F.col("b"), F.col("c"))).first()[0] == _h("1:1", "2:é", "-")
