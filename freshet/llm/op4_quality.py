"""Quality classification by positive-unlabelled learning.

Only trusted positives (label 1) and unlabelled texts are learned from; a label
0 is never used. With p the share of good texts among the unlabelled, the risk
of a classifier g under the logistic loss is

    p * E_pos[l(g)] + max(0, E_unl[l(-g)] - p * E_pos[l(-g)])

The second part estimates the risk on the unseen negatives without bias; it
cannot be negative, so where the estimate falls below zero the step undoes that
part instead of following it (non-negative risk).

The share p is estimated first: a plain positive-against-unlabelled model of one
half ranks the other half, and p is the smallest ratio (unlabelled share) /
(positive share) over the tops of that ranking that hold at least ``PRIOR_SHARE``
of the positives, averaged over both halves. The unlabelled shares count every
unlabelled row of the half; the features' means and deviations are those of all
learning rows.

Features describe the whole text: shares of character classes and of each ASCII
mark, word lengths, repeated words, pairs and lines. They are computed in one
pass over all documents and written. Corpus statistics (means, deviations, the
shares behind p) cover all rows; only the gradient steps run on a sample, at most
``SAMPLE`` positives and as many unlabelled rows (those with the smallest hash of
doc_id; the bound is a parameter). Scoring reads every row.

Defined cases: null and empty texts have all features zero and get a score like
any other; with fewer than two positives or unlabelled rows every score is 0.5;
repeated rows are scored one by one; a doc_id labelled more than once counts as
positive only if all its labels are 1; very long texts are read whole.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm.common import fold, map_texts, table
from freshet.operators.materialize import materialize

FOLDS, HELD_OUT = 3, 1
SAMPLE = 8_000
STEPS, RATE, RIDGE = 400, 0.05, 1e-2
HIDDEN = 16
PRIOR_SHARE = 0.7
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_CLASSES = 5  # letter, capital, digit, white, other


def _char_table() -> np.ndarray:
    """Class of each byte; bytes of multi-byte characters count as letters."""
    kind = np.zeros(256, np.int64)
    for b in range(128):
        c = chr(b)
        kind[b] = 1 if c.isupper() else 0 if c.isalpha() else 2 if c.isdigit() else 3 if c.isspace() else 4
    return kind


def _share(count: float, of: float) -> float:
    return count / of if of else 0.0


def features(text: str | None, kind: np.ndarray) -> np.ndarray:
    """Description of the whole text; all zero if there is no word."""
    out = np.zeros(WIDTH, np.float32)
    words = text.split() if text else []
    if not words:
        return out
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    hist = np.bincount(raw, minlength=256)
    classes = np.bincount(kind, weights=hist, minlength=_CLASSES)
    visible = len(raw) - classes[3]
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    counts = Counter(words)
    n, top = len(words), max(counts.values())
    pairs = sum(map(str.__eq__, words, words[1:]))
    two = len(set(zip(words, words[1:])))
    lines = [x for x in text.split("\n") if x]
    bare = sum(c for w, c in counts.items() if not any(map(str.isalnum, w)))
    caps = sum(c for w, c in counts.items() if len(w) > 1 and w.isupper())
    marked = sum(c for w, c in counts.items() if len(w) > 1 and not w[-1].isalnum() and w[-1] not in ".,")
    dense = [
        np.log1p(n), np.log1p(len(lines)), _share(len(lines), n), lengths.mean(), lengths.std(), np.log1p(lengths.max()),
        *(classes / max(1, visible)), _share(len(counts), n), _share(len(counts), np.sqrt(n)), _share(top, n), _share(pairs, n),
        _share(two, max(1, n - 1)), _share(len(set(lines)), len(lines)), _share(bare, n), _share(caps, n), _share(marked, n),
    ]
    marks = hist[np.frombuffer(_MARKS.encode(), np.uint8)] / n
    out[:] = np.concatenate([dense, np.sqrt(marks), [_share(caps, n) > 0, _share(marked, n) > 0.02, pairs > 0]])
    return out


WIDTH = 6 + _CLASSES + 9 + len(_MARKS) + 3


def with_features(docs: DataFrame) -> DataFrame:
    """``docs`` without text but with ``x``, the features."""

    def factory():
        kind = _char_table()
        return lambda texts: ([features(t, kind) for t in texts],)

    return map_texts(docs, factory, {"x": ("array<float>", pa.list_(pa.float32()))}, drop=("text",))


@dataclass
class Model:
    """One hidden layer over standardised features."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float

    def logit(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.tanh(z @ self.w1 + self.b1) @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logit(x))


def _sigmoid(g: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(g, -30, 30)))


def _softplus(g: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, g)


def gradients(par: list[np.ndarray], zp: np.ndarray, zu: np.ndarray, prior: float | None) -> list[np.ndarray]:
    """Of the risk by the parameters; of its negative part, turned round, where
    that has gone below zero."""
    hidden = [np.tanh(x @ par[0] + par[1]) for x in (zp, zu)]
    gp, gu = (h @ par[2] + par[3] for h in hidden)
    if prior is None:  # d loss / d logit
        dp, du = -_sigmoid(-gp) / len(gp), _sigmoid(gu) / len(gu)
    elif _softplus(gu).mean() - prior * _softplus(gp).mean() >= 0:
        dp = prior * (-_sigmoid(-gp) - _sigmoid(gp)) / len(gp)
        du = _sigmoid(gu) / len(gu)
    else:  # undo the part that has gone below zero
        dp, du = prior * _sigmoid(gp) / len(gp), -_sigmoid(gu) / len(gu)
    grads = [np.zeros_like(p) for p in par]
    for x, h, d in ((zp, hidden[0], dp), (zu, hidden[1], du)):
        back = d[:, None] * par[2] * (1 - h * h)
        for g, v in zip(grads, (x.T @ back, back.sum(axis=0), h.T @ d, np.array([d.sum()]))):
            g += v
    grads[0] += RIDGE * par[0]
    grads[2] += RIDGE * par[2]
    return grads


def train(pos: np.ndarray, unl: np.ndarray, prior: float | None, mean: np.ndarray, scale: np.ndarray, seed: int = 4) -> Model:
    """Minimise the non-negative risk by Adam; with ``prior`` None, plain
    logistic regression of positives against unlabelled rows."""
    zp, zu = (np.clip((x - mean) / scale, -8, 8) for x in (pos, unl))
    rng, width = np.random.default_rng(seed), pos.shape[1]
    par = [rng.standard_normal((width, HIDDEN)) / np.sqrt(width), np.zeros(HIDDEN), rng.standard_normal(HIDDEN) / np.sqrt(HIDDEN), np.zeros(1)]
    first, second = [np.zeros_like(p) for p in par], [np.zeros_like(p) for p in par]
    for step in range(1, STEPS + 1):
        grads = gradients(par, zp, zu, prior)
        for i, g in enumerate(grads):
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g * g
            par[i] = par[i] - RATE * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return Model(mean, scale, par[0], par[1], par[2], float(par[3][0]))


def estimate_prior(pos: np.ndarray, halves: list[np.ndarray], mean: np.ndarray, scale: np.ndarray,
                   above: Callable[[int, Model, np.ndarray], np.ndarray]) -> float:
    """Share of positives among the unlabelled rows: each half is ranked by a
    model of the other half, so fitting noise does not lower the ratio. ``halves``
    are samples of the unlabelled rows; ``above`` gives, for a half, a model and
    rising cuts of its logit, the share of the half's rows from each cut on."""
    found = []
    for half in (0, 1):
        model = train(pos[half::2], halves[half], None, mean, scale)
        p = np.sort(model.logit(pos[1 - half::2]))
        cut = np.quantile(p, np.linspace(0, 1 - PRIOR_SHARE, 100))
        found.append((above(1 - half, model, cut) / ((len(p) - np.searchsorted(p, cut)) / len(p))).min())
    return float(np.clip(np.mean(found), 0.01, 0.99))


_BUCKETS = 1 << 30


def _sample(rows: DataFrame, n: int) -> np.ndarray:
    """About the ``n`` rows with the smallest hash of doc_id, ``n`` at most. Rows
    beyond the hash that is expected to leave 1.2 n are dropped where they are,
    so that no more than that meets anywhere."""
    total = rows.count()
    bound = int(min(1.0, 1.2 * n / max(1, total)) * _BUCKETS)
    place = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(_BUCKETS))
    picked = rows.where(place < bound).orderBy(place, "doc_id").limit(n).select("x").collect()
    return np.array([r["x"] for r in picked], np.float64).reshape(-1, WIDTH)


def statistics(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of every feature over all ``rows`` (x)."""
    each = [f(F.get("x", F.lit(i)).cast("double")) for f in (F.avg, F.stddev_pop) for i in range(WIDTH)]
    got = np.array(rows.agg(*each).first(), np.float64)
    return got[:WIDTH], got[WIDTH:] + 1e-6


def share_above(rows: DataFrame, model: Model, cuts: np.ndarray) -> np.ndarray:
    """Share of all ``rows`` (x) whose logit is at least each of the rising
    ``cuts``; a task gives out one row of counts for each batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            logit = model.logit(np.asarray(b.column(0).flatten(), np.float64).reshape(-1, WIDTH))
            between = np.bincount(np.searchsorted(cuts, logit, side="right"), minlength=len(cuts) + 1)
            yield pa.RecordBatch.from_arrays([pa.array([between.tolist()], pa.list_(pa.int64()))], names=["n"])

    counts = rows.select("x").mapInArrow(run, "n array<long>")
    n = np.array(counts.agg(*[F.coalesce(F.sum(F.get("n", F.lit(i))), F.lit(0)) for i in range(len(cuts) + 1)]).first(), np.float64)
    return (n.sum() - np.cumsum(n)[:-1]) / n.sum()


def fit(rows: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Model from ``rows`` (doc_id, x) and trusted ``labels`` (doc_id, quality)."""
    marks = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("q"))
    known = materialize(rows.where("doc_id is not null").join(marks, "doc_id", "left").where("q is null or q = 1").select("doc_id", "x", "q"), "quality-known")
    pos, unknown = _sample(known.where("q = 1"), sample), known.where("q is null")
    half = F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2))
    parts = [unknown.where(half == h) for h in (0, 1)]
    halves = [_sample(p, sample // 2) for p in parts]
    if len(pos) < 2 or sum(map(len, halves)) < 2:
        return None
    if not all(map(len, halves)):  # a handful of rows, all in one half
        parts, halves = [unknown] * 2, [np.concatenate(halves)] * 2
    mean, scale = statistics(known)
    prior = estimate_prior(pos, halves, mean, scale, lambda h, model, cuts: share_above(parts[h], model, cuts))
    return train(pos, np.concatenate(halves), prior, mean, scale)


def score(rows: DataFrame, model: Model | None) -> DataFrame:
    """``rows`` with x replaced by ``score``."""
    keep = [f for f in rows.schema.fields if f.name not in ("x", "score")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.asarray(b.column(b.num_columns - 1).flatten(), np.float64).reshape(-1, WIDTH)
            made = model.score(x) if model else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(made)], names=[*(f.name for f in keep), "score"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in keep), "score double"])
    return rows.select(*[F.col(f"`{f.name}`") for f in keep], "x").mapInArrow(run, schema)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = table(spark, sf_dir, "labels", "doc_id", "quality")
    held = fold(F.col("doc_id"), FOLDS) == HELD_OUT
    rows = materialize(with_features(docs).withColumn("held_out", held), "quality-features")
    model = fit(rows.where(~F.col("held_out")), labels.where(~held))
    scored = score(rows.select("doc_id", "held_out", "x"), model)
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


QUERIES = {"op4_quality": op4_quality}
