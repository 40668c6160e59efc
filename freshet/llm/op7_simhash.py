"""SimHash near-duplicates through a Gray-order hierarchical index.

Fingerprint: the majority bit of the XXH64 (seed 42) of every 4-word shingle.
Texts with at most ``MAX_BITS`` differing bits link; groups are the connected
components.

The index over the distinct fingerprints:

* Top nodes: the 64 bits are cut into ``SEGMENTS`` segments. Two fingerprints
  with at most d differing bits agree on at least SEGMENTS - d whole segments,
  so for each choice of that many segments a node holds the fingerprints that
  share the masked bit pattern. No link is lost (pigeonhole).
* Below a top node the fingerprints are sorted by Gray rank, in which
  neighbours differ in few bits, and cut into blocks of at most ``BLOCK``. In
  a block, runs of ``FAN`` form nodes, runs of those the next level. A node
  keeps the bits its whole run shares and its parent does not already hold
  (mask and pattern). A search adds up the differing bits from level to level
  and drops a whole group as soon as the sum exceeds the limit; only at the
  leaves whole fingerprints meet.
* A top node with more than one block is joined block against block, and only
  for blocks whose shared bits differ in few enough places.

Sorting is Spark's range partitioning by (top node, Gray rank): a top node that
holds a third of all rows is spread over tasks, and a task holds one block at a
time. A block gives a spanning forest of its links, never all pairs of a group.

Defined cases: null, empty and blank texts have fingerprint zero and link like
any other; fewer than four words are one shingle; copies collapse to one
fingerprint before the search; rows with a null doc_id are fingerprinted and
linked, but the component id is the smallest non-null id (null if there is
none). Repeated rows stay repeated. Very long texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm.common import map_texts, popcount, table
from freshet.llm.components import component_labels
from freshet.operators.materialize import materialize

SHINGLE = 4
MAX_BITS = 4
SEED = 42
SEGMENTS = 6
BLOCK = 1024
FAN = 16
_PIECE = 1 << 20
_QUERIES = 128  # fingerprints that search a block together

_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of the whole text."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = [e + i for i, e in enumerate(accumulate(map(len, words)))]
    starts = [0, *(e + 1 for e in ends[:-1])]
    ends = ends[shingle - 1:] or ends[-1:]
    digest, hist = xxhash.xxh64_digest, np.zeros(2048, np.int64)
    for at in range(0, len(ends), _PIECE):
        raw = b"".join([digest(joined[s:e], SEED) for s, e in zip(starts[at:], ends[at:at + _PIECE])])
        octets = np.frombuffer(raw, np.uint8).reshape(-1, 8) + 256 * np.arange(8)
        hist += np.bincount(octets.ravel(), minlength=2048)
    ones = (hist.reshape(8, 256) @ _BYTE_BITS).ravel()
    return int.from_bytes(np.packbits(2 * ones > len(ends)).tobytes(), "big")


def with_fingerprint(docs: DataFrame, column: str = "fp", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with ``column``, the fingerprint of ``text`` as a signed long."""

    def make(texts: list) -> tuple:
        return (np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64),)

    return map_texts(docs, lambda: make, {column: ("long", pa.int64())})


def masks(max_bits: int = MAX_BITS, segments: int = SEGMENTS) -> list[int]:
    """The masks of the top nodes, unsigned."""
    if not 0 <= max_bits < segments <= 64:
        raise ValueError("0 <= max_bits < segments <= 64 is needed")
    cut = [64 * i // segments for i in range(segments + 1)]
    parts = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(cut, cut[1:])]
    return [sum(c) for c in combinations(parts, segments - max_bits)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _gray_rank(bits: Column) -> Column:
    for shift in (1, 2, 4, 8, 16, 32):
        bits = bits.bitwiseXOR(F.shiftrightunsigned(bits, shift))
    return bits


def _levels(fps: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(mask, pattern) of the nodes of each level, upper levels first; masks
    leave out what the parent holds already."""
    ones, zeros, found = fps, ~fps, []
    while len(ones) > 1:
        cut = np.arange(0, len(ones), FAN)
        ones, zeros = np.bitwise_and.reduceat(ones, cut), np.bitwise_and.reduceat(zeros, cut)
        found.append((ones | zeros, ones))
    found.reverse()
    return [(m & ~(np.repeat(found[i - 1][0], FAN)[:len(m)] if i else np.uint64(0)), p) for i, (m, p) in enumerate(found)]


def search(queries: np.ndarray, fps: np.ndarray, levels, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """All (query, fingerprint) positions at most ``max_bits`` apart."""
    q, node, total = np.arange(len(queries)), np.zeros(len(queries), np.int64), np.zeros(len(queries), np.int64)
    known = np.uint64(0)
    for i, (mask, pattern) in enumerate(levels):
        if i:  # go down to the children of the nodes that are left
            q, node, total = np.repeat(q, FAN), (node[:, None] * FAN + np.arange(FAN)).ravel(), np.repeat(total, FAN)
            inside = node < len(mask)
            q, node, total = q[inside], node[inside], total[inside]
        total = total + popcount((queries[q] ^ pattern[node]) & mask[node])
        near = total <= max_bits
        q, node, total = q[near], node[near], total[near]
    if levels:
        q, node = np.repeat(q, FAN), (node[:, None] * FAN + np.arange(FAN)).ravel()
        inside = node < len(fps)
        q, node = q[inside], node[inside]
    near = popcount(queries[q] ^ fps[node]) <= max_bits
    return q[near], node[near]


def _unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Lower the labels of linked positions until both ends agree."""
    while True:
        open_ = label[a] != label[b]
        if not open_.any():
            return
        a, b = a[open_], b[open_]
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        np.minimum.at(label, high, low)
        while (label[label] != label).any():
            label[:] = label[label]


def _forest(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links inside one block."""
    label, levels = np.arange(len(fps)), _levels(fps)
    for at in range(0, len(fps), _QUERIES):
        q, other = search(fps[at:at + _QUERIES], fps, levels, max_bits)
        _unite(label, q + at, other)
    linked = np.flatnonzero(label != np.arange(len(fps)))
    return fps[linked], fps[label[linked]]


def _bipartite(a: np.ndarray, b: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links between two blocks."""
    label, levels = np.arange(len(a) + len(b)), _levels(b)
    for at in range(0, len(a), _QUERIES):
        q, other = search(a[at:at + _QUERIES], b, levels, max_bits)
        _unite(label, q + at, other + len(a))
    both = np.concatenate([a, b])
    linked = np.flatnonzero(label != np.arange(len(both)))
    return both[linked], both[label[linked]]


_BLOCK_SCHEMA = "a long, b long, top int, pattern long, first long, shared long, bits long, members array<long>"


def _blocks(batches: Iterator[pd.DataFrame], max_bits: int) -> Iterator[pd.DataFrame]:
    """Rows sorted by (top, pattern, rank) to links inside blocks, and the
    blocks of the top nodes that may go on in another block or task."""
    top, pattern, fps, first_run = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.uint64), True
    goes_on = False  # the run at hand has given a full block already

    def links(a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
        n = len(a)
        none = np.full(n, None, object)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64), "top": -1, "pattern": 0, "first": 0, "shared": 0, "bits": 0, "members": none})

    def block(t: int, p: int, f: np.ndarray) -> pd.DataFrame:
        ones, zeros = np.bitwise_and.reduce(f), np.bitwise_and.reduce(~f)
        return pd.DataFrame({"a": [0], "b": [0], "top": [t], "pattern": [p], "first": f[:1].view(np.int64), "shared": [(ones | zeros).view(np.int64)], "bits": [ones.view(np.int64)], "members": [f.view(np.int64)]})

    def settle(last: bool) -> Iterator[pd.DataFrame]:
        nonlocal top, pattern, fps, first_run, goes_on
        if not len(fps):
            return
        edge = np.flatnonzero(np.concatenate(([True], (top[1:] != top[:-1]) | (pattern[1:] != pattern[:-1]), [True])))
        size = np.diff(edge)
        done = len(size) if last else len(size) - 1  # the last run may go on in the next batch
        small = size <= FAN
        small[done:] = False
        # Runs of one leaf: compared with their next FAN - 1 neighbours at once.
        run = np.repeat(np.arange(len(size)), size)
        label = np.arange(len(fps))
        for step in range(1, FAN):
            i = np.flatnonzero(small[run[:-step]] & (run[:-step] == run[step:])) if len(run) > step else np.empty(0, np.int64)
            if not len(i):
                break
            i = i[popcount(fps[i] ^ fps[i + step]) <= max_bits]
            _unite(label, i, i + step)
        linked = np.flatnonzero(label != np.arange(len(fps)))
        if len(linked):
            yield links(fps[linked], fps[label[linked]])
        cut = edge[done]
        for r in np.flatnonzero(~small[:done] | (np.arange(done) == 0) & (first_run or goes_on) | (np.arange(done) == done - 1) & last):
            lo, hi = edge[r], edge[r + 1]
            alone = not (r == 0 and (first_run or goes_on) or last and r == done - 1) and hi - lo <= BLOCK
            for at in range(lo, hi, BLOCK):
                f = fps[at:min(hi, at + BLOCK)]
                if not small[r]:
                    yield links(*_forest(f, max_bits))
                if not alone:
                    yield block(top[lo], pattern[lo], f)
        if done:
            first_run = goes_on = False
        elif not last:  # one open run: give its full blocks
            full = len(fps) // BLOCK * BLOCK
            for at in range(0, full, BLOCK):
                yield links(*_forest(fps[at:at + BLOCK], max_bits))
                yield block(top[0], pattern[0], fps[at:at + BLOCK])
            cut, goes_on = full, goes_on or full > 0
        top, pattern, fps = top[cut:], pattern[cut:], fps[cut:]

    for pdf in batches:
        top = np.concatenate([top, pdf["top"].to_numpy(np.int32)])
        pattern = np.concatenate([pattern, pdf["pattern"].to_numpy(np.int64)])
        fps = np.concatenate([fps, pdf["fp"].to_numpy(np.int64).view(np.uint64)])
        yield from settle(False)
    if len(fps):
        yield from settle(True)


def links(fps: DataFrame, max_bits: int = MAX_BITS, segments: int = SEGMENTS) -> DataFrame:
    """Links (a, b) that connect the distinct fingerprints ``fp`` exactly as
    all pairs at most ``max_bits`` apart would."""
    tops = F.array(*[F.struct(F.lit(i).alias("top"), F.lit(_signed(m)).alias("mask")) for i, m in enumerate(masks(max_bits, segments))])
    keyed = fps.select("fp", F.explode(tops).alias("t")).select("fp", "t.top", F.col("fp").bitwiseAND(F.col("t.mask")).alias("pattern"))
    order = ["top", "pattern", "rank"]
    sorted_ = keyed.withColumn("rank", _gray_rank(F.col("fp"))).repartitionByRange(*order).sortWithinPartitions(*order)
    found = materialize(sorted_.select("top", "pattern", "fp").mapInPandas(lambda it: _blocks(it, max_bits), _BLOCK_SCHEMA), "gray-blocks")
    inside = found.where("top = -1").select("a", "b")

    blocks = found.where("top >= 0").select("top", "pattern", "first", "shared", "bits", "members")
    other = blocks.select("top", "pattern", *[F.col(c).alias(f"{c}2") for c in ("first", "shared", "bits", "members")])
    apart = F.bit_count(F.col("bits").bitwiseXOR(F.col("bits2")).bitwiseAND(F.col("shared")).bitwiseAND(F.col("shared2")))
    pairs = blocks.join(other, ["top", "pattern"]).where((F.col("first") < F.col("first2")) & (apart <= max_bits)).select("members", "members2")

    def across(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for m, m2 in zip(pdf["members"], pdf["members2"]):
                a, b = _bipartite(np.asarray(m, np.int64).view(np.uint64), np.asarray(m2, np.int64).view(np.uint64), max_bits)
                if len(a):
                    yield pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return inside.unionByName(pairs.mapInPandas(across, "a long, b long"))


def components(rows: DataFrame, max_bits: int = MAX_BITS, segments: int = SEGMENTS) -> DataFrame:
    """(fp, root, component_id) per distinct fingerprint of ``rows`` (doc_id,
    fp); root names the group, component_id is its smallest doc_id."""
    distinct = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprints")
    labels = component_labels(links(distinct, max_bits, segments))
    rooted = distinct.join(labels, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("label", "fp").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.select("fp", "root").join(ids, "root").select("fp", "root", "component_id")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    rows = materialize(with_fingerprint(docs).select("doc_id", "fp"), "simhash")
    found = components(rows)
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return rows.join(found, "fp").select("doc_id", hexed.alias("fingerprint"), "component_id")


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of every group the row with the smallest doc_id stays
    (null ids last); of repeated rows one."""
    held = materialize(with_fingerprint(docs.withColumn("__row", F.monotonically_increasing_id()), "__fp"), "simhash-docs")
    rows = held.select("doc_id", F.col("__fp").alias("fp"), F.col("__row").alias("row"))
    roots = components(rows.select("doc_id", "fp")).select("fp", "root")
    first = rows.join(roots, "fp").groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("k"))
    return held.join(first.select(F.col("k.row").alias("__row")), "__row", "left_semi").select(*docs.columns)


QUERIES = {"op7_simhash": op7_simhash}
