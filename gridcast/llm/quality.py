"""Operator 9: quality by nearest-neighbour voting among labelled latent-semantic vectors.

A text's features are counts of trigrams over character classes (how it is written), of
tokens that repeat their predecessor, and of hashed words (what it says). Weighted by
tf-idf and projected by a truncated singular value decomposition they are its vector.
The labelled vectors are broadcast; each document's cosine with all of them is an exact
matrix product in blocks, and its nearest vote by their cosine.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import labelled_sample
from .hashing import token_hashes

_CLASSES = 16
_REPEATS = 8
_BLOCK = 1 << 20


def _class_table() -> np.ndarray:
    """A class of each byte: letters by case, digits, blanks, line ends and groups of signs."""
    t = np.zeros(256, dtype=np.int64)
    groups = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t", "\n\r", ".", ",", "!?", "|",
              "#$%&*", "\"'`", "()[]{}<>", "-_/\\", ":;=+@~^")
    for i, chars in enumerate(groups, 1):
        t[list(chars.encode())] = i
    t[128:] = len(groups) + 1
    return t


_CLASS = _class_table()


def width(words: int) -> int:
    return _CLASSES ** 3 + _REPEATS + words


def features(texts: list[str | None], words: int) -> np.ndarray:
    """Counts, one row per text: class trigrams, tokens that repeat, hashed words."""
    out = np.zeros((len(texts), width(words)), dtype=np.float32)
    cube = _CLASSES ** 3
    for i, t in enumerate(texts):
        b = np.frombuffer((t or "").encode("utf-8", "replace"), dtype=np.uint8)
        for at in range(0, len(b), _BLOCK):  # two bytes more than a block, so that no trigram is lost
            c = _CLASS[b[at:at + _BLOCK + 2]]
            out[i, :cube] += np.bincount(c[:-2] * 256 + c[1:-1] * 16 + c[2:], minlength=cube) if len(c) > 2 else 0
    bits = np.uint64(64 - (words - 1).bit_length())
    for first, sizes, (h,) in token_hashes(texts):
        doc = np.repeat(np.arange(len(sizes)), sizes)
        flat = np.bincount(doc * words + (h >> bits).astype(np.int64), minlength=len(sizes) * words)
        out[first:first + len(sizes), cube + _REPEATS:] += flat.reshape(-1, words)
        same = np.bincount(doc[1:][(h[1:] == h[:-1]) & (doc[1:] == doc[:-1])], minlength=len(sizes))
        level = np.minimum(np.log2(same + 1).astype(int), _REPEATS)  # 0: none; each level more lights one more
        out[first:first + len(sizes), cube:cube + _REPEATS] += np.arange(_REPEATS) < level[:, None]
    return out


@dataclass(frozen=True)
class Neighbours:
    """The projection and the labelled unit vectors; sizes are set by the parameters of the fit."""

    words: int
    weight: np.ndarray
    project: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    k: int
    prior: float

    def embed(self, texts: list[str | None]) -> np.ndarray:
        return _unit(_weighted(features(texts, self.words), self.weight) @ self.project)

    def scores(self, texts: list[str | None], block: int = 256) -> np.ndarray:
        out = np.full(len(texts), self.prior)
        if not len(self.labels):
            return out
        k = min(self.k, len(self.labels))
        for at in range(0, len(texts), block):
            cosine = self.embed(texts[at:at + block]) @ self.vectors.T
            near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
            vote = np.clip(np.take_along_axis(cosine, near, axis=1), 0, None).astype(np.float64) ** 4
            total = vote.sum(axis=1)
            own = (vote * self.labels[near]).sum(axis=1)
            out[at:at + block] = np.where(total > 0, own / np.maximum(total, 1e-12), self.prior)
        return np.clip(out, 0.0, 1.0)


def _weighted(counts: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Damped counts times idf, each of the feature groups at unit length so that none drowns the others."""
    x = np.log1p(counts) * weight
    cube = _CLASSES ** 3
    for part in (slice(0, cube), slice(cube, cube + _REPEATS), slice(cube + _REPEATS, None)):
        x[:, part] = _unit(x[:, part])
    x[:, cube + _REPEATS:] *= 0.35
    return x


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def _truncated_svd(x: np.ndarray, rank: int) -> np.ndarray:
    """Right singular vectors by subspace iteration; ``x`` is the bounded sample."""
    rank = min(rank, *x.shape)
    q = np.random.default_rng(7).standard_normal((x.shape[1], rank + 8)).astype(np.float32)
    for _ in range(4):
        q, _ = np.linalg.qr(x.T @ (x @ q))
    right = np.linalg.svd(x @ q, full_matrices=False)[2]
    return q @ right[:rank].T


def learn_neighbours(docs: DataFrame, labels: DataFrame, rows_per_label: int = 1500, words: int = 1024, rank: int = 64,
                     k: int = 15) -> Neighbours:
    """Fit on the rows of ``docs`` that ``labels(doc_id, label)`` names, at most about ``rows_per_label`` of each label.

    The sample's feature counts are made in the tasks; the bounded matrix of at most
    2 * rows_per_label rows is weighted and decomposed once. Without labelled rows every
    score is 0.5.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            label, texts = b.column(1), b.column(0).to_pylist()
            for at in range(0, len(texts), 64):
                x = features(texts[at:at + 64], words)
                row, col = np.nonzero(x)
                cut = np.searchsorted(row, np.arange(len(x) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [label.slice(at, len(x)), pa.ListArray.from_arrays(pa.array(cut), pa.array(col.astype(np.int32))),
                     pa.ListArray.from_arrays(pa.array(cut), pa.array(x[row, col]))], ["label", "place", "n"])

    rows = (labelled_sample(docs, labels, rows_per_label)
            .mapInArrow(run, "label int, place array<int>, n array<float>")).toPandas()
    if not len(rows):
        return Neighbours(words, np.zeros(width(words)), np.zeros((width(words), 1)), np.zeros((0, 1)), np.zeros(0), k, 0.5)
    sample = sorted((int(r.label), np.asarray(r.place, np.int32).tobytes(), np.asarray(r.n, np.float32).tobytes())
                    for r in rows.itertuples())  # tasks end in any order
    x = np.zeros((len(sample), width(words)), dtype=np.float32)
    for i, (_, place, n) in enumerate(sample):
        x[i, np.frombuffer(place, np.int32)] = np.frombuffer(n, np.float32)
    weight = np.log((1 + len(x)) / (1 + (x > 0).sum(axis=0))).astype(np.float32) + np.float32(0.1)
    x = _weighted(x, weight)
    project = _truncated_svd(x, rank).astype(np.float32)
    label = np.array([r[0] for r in sample], dtype=np.float64)
    return Neighbours(words, weight, project, _unit(x @ project), label, k, float(label.mean()))


def score_quality(docs: DataFrame, model: Neighbours, threshold: float = 0.7) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on); columns of these names are replaced.

    Only the text is read, whole. A null or empty text has no direction: its score is
    the share of label 1 in the sample. Repeated rows get equal scores.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2 * rows_per_label * rank + width * rank floats at most

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(shared.value.scores(texts.tolist()))

    keep = [c for c in docs.columns if c not in ("score", "predicted")]
    return (docs.select(*keep, score("text").alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))
