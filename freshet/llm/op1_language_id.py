"""Language identification with hyperdimensional profiles.

Each letter owns a pseudo-random +1/-1 vector (drawn from its code point and
a seed, so every task draws the same one). A letter trigram is bound into one
vector by multiplying the letters' vectors after rotating them by their place
in the trigram; a text bundles (adds) the vectors of its trigrams, a language
prototype bundles the texts known to be of that language. A text is given the
language whose prototype has the largest cosine with the text's bundle.

Bundling is linear: learning adds up trigram counts per language in a task and
binds each distinct trigram once; what leaves a task is one integer vector per
language, so sums are exact and reruns agree. The prototypes (one vector per
learned language) are the only thing sent to the driver and to the tasks.

Defined cases: a text that is null or holds no letter is ``und`` with score 0;
with nothing learned every text is ``und``; equal cosines go to the first
language by code point; repeated rows are judged one by one; very long texts
are read whole, in pieces that overlap by two symbols.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm.common import fold, map_texts, table

DIMS = 1024
SEED = 20_16
FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"
_BITS = 21  # a code point fits; three fill one signed 64-bit number
_PIECE = 1 << 20  # symbols bundled at once
_GROUP_SYMBOLS = 400_000  # symbols whose trigrams share one bound matrix
_KEEP = 200_000  # distinct trigrams counted in a task before they are bound


def letter_table() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def symbols(text: str, letters: np.ndarray) -> np.ndarray:
    """Lower-cased letters as code points; what lies between words is one 0."""
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    code = np.concatenate(([0], np.where(letters[code], code, 0), [0]))
    keep = np.ones(len(code), bool)
    keep[1:] = (code[1:] != 0) | (code[:-1] != 0)
    return code[keep]


def trigrams(sym: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct trigrams of a symbol row, packed in 63 bits, and their counts."""
    if len(sym) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    found: dict[str, list] = {"code": [], "n": []}
    for at in range(0, len(sym) - 2, _PIECE):
        s = sym[at:at + _PIECE + 2]
        code, n = np.unique((s[:-2] << 2 * _BITS) | (s[1:-1] << _BITS) | s[2:], return_counts=True)
        found["code"].append(code)
        found["n"].append(n)
    if len(found["code"]) == 1:
        return found["code"][0], found["n"][0]
    return _merge(np.concatenate(found["code"]), np.concatenate(found["n"]))


def _merge(code: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    u, inv = np.unique(code, return_inverse=True)
    return u, np.bincount(inv, weights=n, minlength=len(u)).astype(np.int64)


class Binder:
    """Letter vectors, drawn when first met, and the binding of trigrams."""

    def __init__(self, dims: int, seed: int):
        self.dims, self.seed = dims, seed
        self.letters = letter_table()
        self.row: dict[int, int] = {}
        self.base = np.empty((0, dims), np.int8)

    def _rows(self, codes: np.ndarray) -> np.ndarray:
        u, inv = np.unique(codes, return_inverse=True)
        new = [c for c in u.tolist() if c not in self.row]
        if new:
            fresh = [np.random.Generator(np.random.Philox(key=[self.seed, c])).integers(0, 2, self.dims, np.int8) for c in new]
            self.row.update((c, len(self.base) + i) for i, c in enumerate(new))
            self.base = np.concatenate([self.base, np.stack(fresh) * np.int8(2) - np.int8(1)])
        return np.array([self.row[c] for c in u.tolist()], np.int64)[inv]

    def bind(self, code: np.ndarray) -> np.ndarray:
        """One +1/-1 row per packed trigram: first letter rotated by two
        places, second by one, third as it is."""
        mask = (1 << _BITS) - 1
        first, second, third = (self._rows((code >> s) & mask) for s in (2 * _BITS, _BITS, 0))
        out = np.roll(self.base, 2, axis=1)[first]
        out *= np.roll(self.base, 1, axis=1)[second]
        out *= self.base[third]
        return out

    def bundle(self, code: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The counted trigrams added up, exact."""
        out = np.zeros(self.dims, np.int64)
        for at in range(0, len(code), 20_000):
            bound = self.bind(code[at:at + 20_000]).astype(np.float64)
            out += np.rint(n[at:at + 20_000].astype(np.float64) @ bound).astype(np.int64)
        return out


def _learn(batches: Iterator[pd.DataFrame], dims: int, seed: int) -> Iterator[pd.DataFrame]:
    binder, counts, sums = Binder(dims, seed), {}, {}

    def flush(lang: str) -> None:
        code, n = _merge(*map(np.concatenate, zip(*counts.pop(lang), strict=True)))
        sums[lang] = sums.get(lang, 0) + binder.bundle(code, n)

    for pdf in batches:
        for lang, text in zip(pdf["lang"], pdf["text"], strict=True):
            code, n = trigrams(symbols(text, binder.letters))
            if len(code):
                parts = counts.setdefault(lang, [])
                parts.append((code, n))
                if sum(len(c) for c, _ in parts[-64:]) > _KEEP or len(parts) >= 512:
                    counts[lang] = [_merge(*map(np.concatenate, zip(*parts, strict=True)))]
                    if len(counts[lang][0][0]) > _KEEP:
                        flush(lang)
    for lang in list(counts):
        flush(lang)
    for lang, vec in sums.items():
        yield pd.DataFrame({"lang": lang, "place": np.arange(dims, dtype=np.int32), "value": vec})


def learn_prototypes(labelled: DataFrame, dims: int = DIMS, seed: int = SEED) -> dict[str, np.ndarray]:
    """Prototype per language from rows (text, lang); null in either is left
    out. The result holds ``dims`` numbers per distinct language."""
    rows = labelled.select("text", "lang").where("text is not null and lang is not null")
    parts = rows.mapInPandas(lambda it: _learn(it, dims, seed), "lang string, place int, value long")
    sums = parts.groupBy("lang", "place").agg(F.sum("value").alias("value"))
    found: dict[str, np.ndarray] = {}
    for r in sums.toLocalIterator():
        found.setdefault(r["lang"], np.zeros(dims))[r["place"]] = r["value"]
    return {k: found[k] for k in sorted(found) if found[k].any()}


def _judge(texts: list[str | None], binder: Binder, langs: list[str], unit: np.ndarray) -> tuple[list[str], list[float]]:
    names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    group: list[tuple[int, np.ndarray, np.ndarray]] = []
    held = 0

    def settle() -> None:
        u, inv = np.unique(np.concatenate([c for _, c, _ in group]), return_inverse=True)
        dense, at = np.zeros((len(group), len(u)), np.float32), 0
        for i, (_, code, n) in enumerate(group):
            dense[i, inv[at:at + len(code)]] = n
            at += len(code)
        bundles = np.zeros((len(group), binder.dims), np.float32)
        for k in range(0, len(u), 8192):
            bundles += dense[:, k:k + 8192] @ binder.bind(u[k:k + 8192]).astype(np.float32)
        wide = bundles.astype(np.float64)
        norm = np.sqrt((wide * wide).sum(axis=1))
        cos = (wide @ unit.T) / np.where(norm == 0, 1, norm)[:, None]
        best = cos.argmax(axis=1)
        for i, (row, _, _) in enumerate(group):
            names[row], scores[row] = langs[best[i]], float(min(1.0, max(0.0, cos[i, best[i]])))
        group.clear()

    for row, text in enumerate(texts):
        if not text or not langs:
            continue
        sym = symbols(text, binder.letters)
        if len(sym) < 3:  # no letter: at most the border
            continue
        group.append((row, *trigrams(sym)))
        held += len(sym)
        if held > _GROUP_SYMBOLS:
            settle()
            held = 0
    if group:
        settle()
    return names, scores


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], dims: int = DIMS, seed: int = SEED,
            names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with language and score appended under ``names`` (earlier columns
    of these names are replaced); reads the column ``text`` alone."""
    langs = list(prototypes)
    unit = np.stack([v / np.linalg.norm(v) for v in prototypes.values()]) if langs else np.empty((0, dims))

    def factory():
        binder = Binder(dims, seed)
        return lambda texts: _judge(texts, binder, langs, unit)

    return map_texts(docs, factory, dict(zip(names, [("string", pa.string()), ("double", pa.float64())])))


def prototypes_of(docs: DataFrame) -> dict[str, np.ndarray]:
    """Prototypes from the documents outside the held-out fold."""
    return learn_prototypes(docs.where(fold(F.col("doc_id"), FOLDS) != HELD_OUT))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    learned = prototypes_of(docs)
    rows = docs.select("doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "text")
    return predict(rows, learned).select("doc_id", "held_out", "lang_pred", "score")


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents in which no learned language is recognised
    (no text, no letter) go; the others stay unchanged."""
    learned = prototypes_of(docs)
    if not learned:  # nothing to compare with: only the presence of a letter counts
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = predict(docs, learned, names=("__lang", "__score"))
    return found.where(F.col("__lang") != UNKNOWN).select(*docs.columns)


QUERIES = {"op1_language_id": op1_language_id}
