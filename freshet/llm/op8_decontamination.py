"""Benchmark decontamination by latent semantic retrieval.

1. Benchmark items are cut into passages of about ``PASSAGE`` words, with one
   more passage across each cut, half on either side, for quotes that straddle
   it. They are the query set: taken in blocks of ``BLOCK`` passages, each block
   against all documents. One pass over the documents serves ``BLOCKS_PER_PASS``
   blocks and its hits are written before the next begins, so what the driver and
   a task hold of the blocks is bounded.
2. Inverse document frequencies of all the benchmark's terms come from one pass
   over every document (tiles of ``WINDOW`` words). No term is left
   out, so a paraphrase that changes the rare words still has candidates.
3. A randomised SVD of the block's TF-IDF passages gives the latent space: the
   rows stay in Spark, tasks add up A'(A Q) for the present basis Q, the driver
   only orthonormalises one (terms x rank) matrix per power iteration. The
   space is spanned by the benchmark's passages and the documents are folded
   in, as usual in latent semantic indexing: a space fitted to the corpus is
   used up by frequent words and shows no direction of an item that is rare.
4. Windows of ``WINDOW`` words at half that stride are folded in; a window and a
   passage whose cosine reaches ``MIN_COSINE`` are candidates. The window's
   length counts all its words, those unknown to the benchmark with the mean
   weight, so one shared rare word is no candidate. Folding is linear, so each
   term's inner products with all passages are computed once (terms x passages).
5. A candidate counts if some stretch of ``SPREAD`` times the passage's length
   around the window holds at least ``MIN_LCS`` of the passage's words as a common
   subsequence, with ``MIN_ANSWER`` of the words of its last quarter (where an item
   states its answer), in order and after the words of the rest. The stretch's
   length is bounded so that a text on the same subject, or one that repeats an
   item's words in any order, does not add up to a subsequence.

Words are compared without case and ASCII marks, so changed punctuation, inserted
and changed words do not hide a passage.

Defined cases: null, empty and blank texts match nothing; a null or empty item
matches nothing; an item that repeats another's text reports under each id;
rows of one doc_id are judged one by one and reported together, with the best
hit of each item; texts are read whole. An empty benchmark or an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import islice, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm.common import table
from freshet.operators.materialize import materialize

PASSAGE = 64
SHORTEST = 8  # a tail of fewer words joins the passage before it
BLOCK = 512
WINDOW = 32
RANK, OVERSAMPLE, ITERATIONS = 384, 10, 2
TERM_GROUPS = 64  # in which the tasks' shares of the basis are added up
BLOCKS_PER_PASS = 8
MIN_COSINE = 0.2
MIN_LCS = 0.7
MIN_ANSWER = 0.5
SPREAD = 1.5
_PLAIN = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words as UTF-8; white space and ASCII marks separate them."""
    return text.lower().encode("utf-8", "surrogatepass").translate(_PLAIN).split() if text else []


@dataclass
class Passage:
    item_id: int | None
    words: list[bytes]


@dataclass
class Index:
    """What a task needs to search for one block."""

    ids: dict[bytes, int]
    idf: np.ndarray
    unknown: float  # squared weight of a word outside the vocabulary
    inner: np.ndarray  # terms x passages, float32: cosine parts without the window's length
    most: np.ndarray  # each term's largest part: bounds a window's cosines from above
    passages: list[np.ndarray]  # term ids
    items: list[int | None]


def passages_of(item_id, text: str | None) -> list[Passage]:
    words = words_of(text)
    cuts = list(range(0, len(words), PASSAGE))
    if len(cuts) > 1 and len(words) - cuts[-1] < SHORTEST:
        cuts.pop()
    across = [(c - PASSAGE // 2, c + PASSAGE // 2) for c in cuts[1:]]
    return [Passage(item_id, words[a:b]) for a, b in sorted([*zip(cuts, [*cuts[1:], len(words)]), *across])]


def _blocks(benchmark: DataFrame) -> Iterator[list[Passage]]:
    rows = benchmark.select("item_id", "text").where("text is not null").orderBy("item_id", "text").toLocalIterator()
    passages = (p for r in rows for p in passages_of(r["item_id"], r["text"]))
    while block := list(islice(passages, BLOCK)):
        yield block


def _words(texts: Iterable, ids: dict[bytes, int]) -> Iterator[np.ndarray]:
    """Term ids of each text's words, -1 for words no benchmark passage has."""
    for t in texts:
        words = words_of(t if isinstance(t, str) else None)
        yield np.fromiter(map(ids.get, words, repeat(-1)), np.int32, len(words))


def _frequencies(texts: DataFrame, terms: Iterable[bytes]) -> tuple[dict[bytes, int], int]:
    """In how many tiles each term is, and the number of tiles: one pass."""
    ids = {t: i for i, t in enumerate(dict.fromkeys(terms))}
    n = len(ids)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found, tiles = np.zeros(n, np.int64), 0
        for pdf in batches:
            for w in _words(pdf["text"], ids):
                at = np.flatnonzero(w >= 0)
                term, many = np.unique(np.unique(at // WINDOW * n + w[at]) % n, return_counts=True)
                found[term] += many
                tiles += -(-len(w) // WINDOW)
        held = np.flatnonzero(found)
        yield pd.DataFrame({"term": np.append(held, -1), "n": np.append(found[held], tiles)})

    counts = texts.mapInPandas(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    by = {r["term"]: r["n"] for r in counts}
    return {t: by.get(i, 0) for t, i in ids.items()}, by.get(-1, 0)


def _weights(count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return (1 + np.log(count)) * idf


def _row(words: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit TF-IDF vector: term ids and weights."""
    term, n = np.unique(words, return_counts=True)
    w = _weights(n, idf[term])
    length = np.sqrt((w * w).sum())
    return (term, w / length) if length else (term[:0], w[:0])


def latent_basis(spark: SparkSession, rows: list[np.ndarray], idf: np.ndarray, rank: int) -> np.ndarray:
    """Right singular vectors (terms x rank) of the unit TF-IDF rows, by
    randomised subspace iteration; the rows' part runs in Spark tasks."""
    n, width = len(idf), min(rank + OVERSAMPLE, len(rows), len(idf))
    data = spark.createDataFrame([(w.tolist(),) for w in rows], "words array<int>").repartition(max(1, len(rows) // 64))

    def add_up(basis: np.ndarray) -> np.ndarray:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total, touched = np.zeros((n, basis.shape[1])), np.zeros(n, bool)
            for pdf in batches:
                for words in pdf["words"]:
                    term, w = _row(np.asarray(words, np.int64), idf)
                    total[term] += np.outer(w, w @ basis[term])
                    touched[term] = True
            at = np.flatnonzero(touched)
            yield pd.DataFrame({"term": at, "v": list(total[at])})

        def combine(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("term", kind="stable")
            term, first = np.unique(pdf["term"].to_numpy(), return_index=True)
            return pd.DataFrame({"term": term, "v": list(np.add.reduceat(np.stack(pdf["v"].tolist()), first, axis=0))})

        out = np.zeros((n, basis.shape[1]))
        schema = "term int, v array<double>"
        parts = data.mapInPandas(run, schema).groupBy(F.col("term") % TERM_GROUPS).applyInPandas(combine, schema)
        for r in parts.toLocalIterator():
            out[r["term"]] = r["v"]
        return out

    basis = np.random.default_rng(8).standard_normal((n, width))
    for _ in range(ITERATIONS):
        basis = np.linalg.qr(add_up(basis))[0]
    image = add_up(basis)  # A'A Q; Q'(A'A)Q gives the singular values in the subspace
    value, turn = np.linalg.eigh((basis.T @ image + image.T @ basis) / 2)
    return basis @ turn[:, np.argsort(-value)[:rank]]


def term_weights(df: np.ndarray, tiles: int) -> np.ndarray:
    return np.log((tiles + 1) / (df + 1)) + 1e-3


def build_index(spark: SparkSession, texts: DataFrame, block: list[Passage], rank: int = RANK,
                frequencies: tuple[dict[bytes, int], int] | None = None) -> Index:
    """``frequencies`` of (at least) the block's terms, if they are known already."""
    ids: dict[bytes, int] = {}
    rows = [np.array([ids.setdefault(w, len(ids)) for w in p.words], np.int64) for p in block]
    by, tiles = frequencies or _frequencies(texts, ids)
    df = np.array([by[t] for t in ids], np.int64)
    weights = term_weights(df, tiles)
    basis = latent_basis(spark, rows, weights, rank)
    inner = np.zeros((len(ids), len(rows)), np.float32)
    for i, r in enumerate(rows):
        term, w = _row(r, weights)
        inner[:, i] = basis @ (w @ basis[term])
    unknown = float(np.mean(weights ** 2))
    return Index(ids, weights, unknown, inner, np.maximum(inner.max(axis=1), 0), rows, [p.item_id for p in block])


def _lcs_prefixes(passage: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Lengths of the longest common subsequence of the passage with the first 0,
    1, ... words of the text, bit-parallel."""
    at: dict[int, int] = {}
    for i, t in enumerate(passage.tolist()):
        at[t] = at.get(t, 0) | 1 << i
    full = row = (1 << len(passage)) - 1
    found = [0]
    for t in text.tolist():
        both = row & at.get(t, 0)
        if both:
            row = ((row + both) | (row - both)) & full
            found.append((full ^ row).bit_count())
        else:
            found.append(found[-1])
    return np.array(found)


def _lcs(passage: np.ndarray, text: np.ndarray) -> int:
    """Length of the longest common subsequence."""
    return int(_lcs_prefixes(passage, text)[-1])


def _share(want: np.ndarray, text: np.ndarray) -> float:
    """Share of ``want`` that is a common subsequence with ``text`` which has enough
    of the answer after the words of the rest; 0 without enough of the answer."""
    answer = max(1, len(want) // 4)
    head = _lcs_prefixes(want[:-answer], text)
    tail = _lcs_prefixes(want[:-answer - 1:-1], text[::-1])[::-1]
    both = (head + tail)[tail >= MIN_ANSWER * answer]
    return both.max() / len(want) if len(both) else 0.0


def _best_stretch(want: np.ndarray, words: np.ndarray, lo: int, hi: int) -> tuple[float, int, int]:
    """Best (share, first word, end word) of the stretches of words lo to hi."""
    size, step = int(len(want) * SPREAD) + 1, max(1, len(want) // 8)
    starts = range(lo, max(lo, hi - size) + step, step)
    stretches = ((a, min(a + size, hi)) for a in starts)
    return max(((_share(want, words[a:b]), a, b) for a, b in stretches), key=lambda s: (s[0], -s[1]))


def _candidates(words: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window, passage, cosine) of one text; window i starts at i half strides."""
    half, n = WINDOW // 2, len(index.idf)
    none = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    at = np.flatnonzero(words >= 0)
    at = at[index.idf[words[at]] > 0]
    if not len(at):
        return none
    windows = max(1, -(-len(words) // half) - 1)
    piece = at // half
    win = np.concatenate([np.minimum(piece, windows - 1), piece - 1])
    term = np.concatenate([words[at], words[at]])
    use = (win >= 0) & np.concatenate([piece < windows, np.ones(len(at), bool)])
    key, count = np.unique(win[use] * n + term[use], return_counts=True)
    win, term = key // n, key % n
    weight = _weights(count, index.idf[term])
    start = np.flatnonzero(np.concatenate(([True], win[1:] != win[:-1])))
    here = win[start]
    strange = np.concatenate(([0], np.cumsum(words < 0)))
    lo, hi = here * half, np.minimum(here * half + WINDOW, len(words))
    length = np.sqrt(np.add.reduceat(weight * weight, start) + index.unknown * (strange[hi] - strange[lo]))
    # Only windows whose bound allows a candidate meet the passages.
    able = np.flatnonzero(np.add.reduceat(weight * index.most[term], start) >= (MIN_COSINE - 1e-4) * length)
    if not len(able):
        return none
    many = np.diff(np.append(start, len(term)))[able]
    found = []
    for a in range(0, len(able), 4096):  # bounded memory for very long texts
        part, n_ = able[a:a + 4096], many[a:a + 4096]
        first = np.cumsum(n_) - n_
        at = np.arange(n_.sum()) + np.repeat(start[part] - first, n_)
        rows = index.inner[term[at]] * weight[at, None].astype(np.float32)
        cos = np.add.reduceat(rows, first, axis=0) / length[part, None]
        w, p = np.nonzero(cos >= MIN_COSINE)
        found.append((here[part[w]], p, cos[w, p].astype(float)))
    return tuple(map(np.concatenate, zip(*found, strict=True)))


def _matches(words: np.ndarray, index: Index) -> list[tuple]:
    """Best verified hit of each item: (item, cosine, lcs share, first word,
    end word)."""
    win, passage, cos = _candidates(words, index)
    order = np.lexsort((win, passage))
    best: dict = {}
    half, i = WINDOW // 2, 0
    while i < len(order):
        p = passage[order[i]]
        want = index.passages[p]
        reach = len(want)
        lo = max(0, win[order[i]] * half - reach)
        hi, top = 0, 0.0
        while i < len(order) and passage[order[i]] == p and (not hi or win[order[i]] * half - reach <= hi):
            hi, top = win[order[i]] * half + WINDOW + reach, max(top, cos[order[i]])
            i += 1
        hi = min(hi, len(words))
        if _lcs(want, words[lo:hi]) < MIN_LCS * len(want):
            continue  # no stretch of it can have more
        share, first, end = _best_stretch(want, words, int(lo), int(hi))
        if share >= MIN_LCS:
            hit = (share, top, first, end)
            item = index.items[p]
            best[item] = max(best.get(item, hit), hit)
    return [(item, top, share, lo, hi) for item, (share, top, lo, hi) in best.items()]


def _hits(text: str | None, indexes: Iterable[Index]) -> Iterator[tuple]:
    """Verified hits of a text, block after block; its words are cut once."""
    words = words_of(text)
    for index in indexes:
        yield from _matches(np.fromiter(map(index.ids.get, words, repeat(-1)), np.int32, len(words)), index)


def _filtered(docs: DataFrame, *indexes: Index) -> DataFrame:
    """The rows of ``docs`` in which no passage of the blocks is found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            clean = [next(_hits(t, indexes), None) is None for t in b.column("text").to_pylist()]
            yield b.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def _found(docs: DataFrame, *indexes: Index) -> DataFrame:
    types = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hits = [(d, *h) for d, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()) for h in _hits(t, indexes)]
            yield pa.RecordBatch.from_arrays([pa.array([h[i] for h in hits], t) for i, t in enumerate(types)], names=_SCHEMA.replace(",", "").split()[::2])

    return docs.select("doc_id", "text").mapInArrow(run, _SCHEMA)


_SCHEMA = "doc_id long, item_id long, cosine double, lcs double, first_word long, end_word long"


def _passes(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> Iterator[list[Index]]:
    """The indexes that each pass over ``docs`` holds. The benchmark is read twice,
    the documents once; the terms of all its passages are on the driver, as every
    table of word counts is, the passages a block at a time."""
    texts = docs.select("text")
    terms = dict.fromkeys(w for block in _blocks(benchmark) for p in block for w in p.words)
    if not terms:
        return
    known = _frequencies(texts, terms)
    indexes = (build_index(spark, texts, block, frequencies=known) for block in _blocks(benchmark))
    while held := list(islice(indexes, BLOCKS_PER_PASS)):
        yield held


def find_leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per doc_id and benchmark item found in a row of it."""
    found = spark.createDataFrame([], _SCHEMA)
    for held in _passes(spark, docs, benchmark):
        found = found.unionByName(materialize(_found(docs, *held), "leaks"))
    # An item of several passages may be found through more than one block.
    keys = ["doc_id", "item_id"]
    best = F.max_by(F.struct("cosine", "lcs", "first_word", "end_word"), F.struct("lcs", "cosine", "first_word")).alias("b")
    return found.groupBy(*keys).agg(best).select(*keys, "b.*")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, item_id, cosine, lcs, first_word, end_word): every document
    that holds a benchmark item, with the words around it."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return find_leaks(spark, docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that hold a benchmark item go."""
    kept, first = docs, True
    for held in _passes(spark, docs, table(spark, sf_dir, "benchmark", "item_id", "text")):
        # What a pass keeps is written, so the driver holds the indexes of one pass only.
        kept, first = _filtered(kept if first else materialize(kept, "clean"), *held), False
    return kept


QUERIES = {"op8_decontamination": op8_decontamination}
