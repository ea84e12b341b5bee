"""Operator 7: toxicity by a factorization machine over hashed terms.

A text's terms are its words and their prefixes of three to five bytes, hashed. The
machine scores w0 + sum of w_i + sum over pairs of <v_i, v_j>, so that two terms
together can count for more (or less) than the sum of both.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import FMClassifier
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import labelled_sample, saved
from .hashing import token_hashes

PREFIXES = (3, 4, 5)


@dataclass(frozen=True)
class Machine:
    """``place`` maps a hashed term to its row in ``linear`` and ``factors``, or -1."""

    bits: int
    place: np.ndarray
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def scores(self, texts: list[str | None]) -> np.ndarray:
        raw = np.full(len(texts), self.bias)
        for doc, term in active_terms(texts, self.bits, self.place):
            # sum over pairs <v_i, v_j> = (|sum of v|^2 - sum of |v|^2) / 2
            np.add.at(raw, doc, self.linear[term] - 0.5 * np.square(self.factors[term]).sum(axis=1))
            rows, at = np.unique(doc, return_inverse=True)
            total = np.zeros((len(rows), self.factors.shape[1]))
            np.add.at(total, at, self.factors[term])
            raw[rows] += 0.5 * np.square(total).sum(axis=1)
        return 1.0 / (1.0 + np.exp(-np.clip(raw, -500, 500)))


def _terms(texts: list[str | None], bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(document, hashed term) of all tokens and prefixes, with repeats; block by block."""
    for first, sizes, hashes in token_hashes(texts, PREFIXES):
        doc = np.repeat(np.arange(first, first + len(sizes)), sizes)
        for h in hashes:
            yield doc, (h >> np.uint64(64 - bits)).astype(np.int64)


def active_terms(texts: list[str | None], bits: int, place: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct (document, row of ``place``) of the texts, all terms of one text together."""
    docs, terms, upto = [], [], 0

    def flush():
        pair = np.unique(np.concatenate(docs) * len(place) + np.concatenate(terms))
        return pair // len(place), pair % len(place)

    for n, (doc, term) in enumerate(_terms(texts, bits), 1):
        row = place[term]
        hit = row >= 0
        docs.append(doc[hit])
        terms.append(row[hit].astype(np.int64))
        upto += int(hit.sum())
        if n % (1 + len(PREFIXES)) == 0 and upto:  # a block of texts is complete
            yield flush()
            docs, terms, upto = [], [], 0
    if upto:
        yield flush()


def _term_counts(rows: DataFrame, bits: int) -> DataFrame:
    """``(term, toxic, clean)``: in how many sampled texts of either label a hashed term is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, 1 << bits), dtype=np.int64)
        for b in batches:
            label = b.column(1).to_numpy(zero_copy_only=False)
            for doc, term in _terms(b.column(0).to_pylist(), bits):
                pair = np.unique(doc << bits | term)
                np.add.at(counts, (label[pair >> bits], pair & ((1 << bits) - 1)), 1)
        term = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(counts[1, term]), pa.array(counts[0, term])],
                                         ["term", "toxic", "clean"])

    return (rows.select("text", "label").mapInArrow(run, "term long, toxic long, clean long")
            .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))


def learn_machine(docs: DataFrame, labels: DataFrame, rows_per_label: int = 8000, bits: int = 18, terms: int = 4096,
                  factors: int = 4, rounds: int = 60, step: float = 0.1, penalty: float = 1e-4) -> Machine:
    """Fit on the rows of ``docs`` that ``labels(doc_id, label)`` names, at most about ``rows_per_label`` of each label.

    The sample is drawn by a hash of the id. The ``terms`` hashed terms that tell the
    labels apart best (log likelihood ratio over the sample) are kept, and MLlib fits
    the machine on the sample's sparse vectors. With one label or none, every text gets
    the same score: 1, 0, or 0.5 where there is no label at all.
    """
    rows = saved(labelled_sample(docs, labels, rows_per_label))
    n = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    none = np.full(1 << bits, -1, dtype=np.int32)
    if len(n) < 2:
        bias = 0.0 if not n else (40.0 if 1 in n else -40.0)
        return Machine(bits, none, bias, np.zeros(1), np.zeros((1, factors)))
    toxic, clean, n1, n0 = F.col("toxic"), F.col("clean"), F.lit(float(n[1])), F.lit(float(n[0]))

    def part(seen, total):  # observed * log(observed / expected), 0 for 0
        expected = total * (toxic + clean) / (n1 + n0)
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    def rest(seen, total):
        expected = total * (1 - (toxic + clean) / (n1 + n0))
        return F.when(total - seen > 0, (total - seen) * F.log((total - seen) / expected)).otherwise(0.0)

    ratio = part(toxic, n1) + part(clean, n0) + rest(toxic, n1) + rest(clean, n0)
    best = (_term_counts(rows, bits).where("toxic + clean > 1").withColumn("ratio", ratio)
            .orderBy(F.desc("ratio"), "term").limit(terms).select("term", "ratio").toPandas())
    chosen = np.sort(best["term"].to_numpy(dtype=np.int64)[best["ratio"].to_numpy() > 6.6])  # p of about 0.01
    if not len(chosen):
        return Machine(bits, none, float(np.log(n[1] / n[0])), np.zeros(1), np.zeros((1, factors)))
    place = none.copy()
    place[chosen] = np.arange(len(chosen))
    size = len(chosen)

    def terms_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [[] for _ in range(b.num_rows)]
            for doc, term in active_terms(b.column(0).to_pylist(), bits, place):
                for d, t in zip(doc.tolist(), term.tolist(), strict=True):
                    found[d].append(str(t))
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.string())), b.column(1)], ["terms", "label"])

    vectors = CountVectorizerModel.from_vocabulary([str(i) for i in range(size)], "terms", "features")
    sparse = saved(vectors.transform(rows.select("text", F.col("label").cast("double"))
                                     .mapInArrow(terms_of, "terms array<string>, label double")))
    model = FMClassifier(featuresCol="features", labelCol="label", factorSize=factors, maxIter=rounds, stepSize=step,
                         regParam=penalty, initStd=0.05, seed=7).fit(sparse)
    return Machine(bits, place, float(model.intercept), np.asarray(model.linear.toArray()), np.asarray(model.factors.toArray()))


def score_toxicity(docs: DataFrame, machine: Machine, threshold: float = 0.5) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on); columns of these names are replaced.

    Only the text is read, whole. Null and empty texts get the score of a text without
    any learned term. Repeated rows get equal scores.
    """
    model = docs.sparkSession.sparkContext.broadcast(machine)  # at most 2**bits places and terms * (factors + 1) weights

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.value.scores(texts.tolist()))

    keep = [c for c in docs.columns if c not in ("score", "predicted")]
    return (docs.select(*keep, score("text").alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))
