"""Operator 4: language identification by rank-order profiles of character n-grams.

A profile is the most frequent n-grams (1 to 3 letters, words padded by blanks) in
order of frequency. A document has a profile of its own; its distance to a language is
the sum over its n-grams of how far each is out of place there, and an n-gram that the
language's profile lacks counts as the profile's length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_sample

UNKNOWN = "und"
_POINT = 21  # bits of a code point
_PART = 1 << 20  # code points whose n-grams are held at a time, but for a longer text
_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Which code points are letters; built once per Python worker."""
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000))
    return _LETTER[0]


def ngrams(text: str | None) -> np.ndarray:
    """All 1-, 2- and 3-grams of a text as packed code points; blanks pad the words."""
    points = np.frombuffer(f" {(text or '').lower()} ".encode("utf-32-le", "replace"), dtype=np.uint32)
    a = np.where(_letters()[points], points, 32).astype(np.int64)
    a = a[np.concatenate(([True], (a[1:] != 32) | (a[:-1] != 32)))]  # runs of blanks become one
    two = a[:-1] << _POINT | a[1:]
    three = two[:-1] << _POINT | a[2:]
    return np.concatenate((a[a != 32], two, three[a[1:-1] != 32]))


def ranked(grams: np.ndarray, length: int) -> np.ndarray:
    """The ``length`` most frequent, most frequent first; ties by code points."""
    found, counts = np.unique(grams, return_counts=True)
    return found[np.argsort(-counts, kind="stable")[:length]]


@dataclass(frozen=True)
class Profiles:
    """What is learned: the languages, all their n-grams, and each one's rank in each language."""

    langs: list[str]
    grams: np.ndarray
    ranks: np.ndarray  # [gram, language]; the length where it is missing
    length: int

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, 1 - distance / largest distance); ties go to the smaller name."""
        mine = ranked(ngrams(text), self.length)
        if not len(mine) or not self.langs:
            return UNKNOWN, 0.0
        at = np.minimum(np.searchsorted(self.grams, mine), len(self.grams) - 1)
        known = self.grams[at] == mine
        place = np.arange(len(mine))[known]
        off = np.minimum(np.abs(self.ranks[at[known]] - place[:, None]), self.length).sum(axis=0)
        total = off + self.length * int((~known).sum())
        best = int(np.argmin(total))
        return self.langs[best], 1.0 - float(total[best]) / (self.length * len(mine))


def learn_profiles(docs: DataFrame, length: int = 300, docs_per_lang: int = 4000) -> Profiles:
    """Fit on the rows of ``docs`` whose ``lang`` is not null, at most about ``docs_per_lang`` of each.

    n-grams are counted inside the tasks and summed by Spark; the driver gets ``length``
    rows per language. Without rows there are no languages.
    """
    rows = bounded_sample(docs.where("lang is not null").select("doc_id", "text", "lang"), "lang", docs_per_lang)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = pd.DataFrame({"text": b.column(0).to_pylist(), "lang": b.column(1).to_pylist()})
            texts["part"] = texts["text"].str.len().fillna(0).cumsum() // _PART  # n-grams of so many code points at a time
            for (lang, _), own in texts.groupby(["lang", "part"]):
                grams, n = np.unique(np.concatenate([ngrams(t) for t in own["text"]]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams),
                                                  pa.array(n.astype(np.int64))], ["lang", "gram", "n"])

    counts = (rows.select("text", "lang").mapInArrow(count, "lang string, gram long, n long")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram")) - 1
    top = counts.withColumn("place", place).where(F.col("place") < length).select("lang", "gram", "place").toPandas()
    langs, grams = sorted(set(top["lang"])), np.unique(top["gram"].to_numpy(dtype=np.int64))
    ranks = np.full((len(grams), len(langs)), length, dtype=np.int64)
    ranks[np.searchsorted(grams, top["gram"]), [langs.index(x) for x in top["lang"]]] = top["place"]
    return Profiles(langs, grams, ranks, length)


def identify(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (columns of these names are replaced).

    ``und`` with score 0 for texts that are null or without a letter, and for all texts
    where nothing was learned. Only the text is read; whole texts count.
    """

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([profiles.predict(t) for t in texts], columns=["lang_pred", "score"])

    keep = [c for c in docs.columns if c not in ("lang_pred", "score")]
    return docs.select(*keep, predict("text").alias("__p")).select(*keep, "__p.lang_pred", "__p.score")
