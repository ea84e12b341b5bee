"""Operator 2: token counts by a count-only Viterbi search.

An Aho-Corasick automaton enumerates the vocabulary's pieces that end at each code
point, and dynamic programming carries the best score and its number of pieces; no
token is ever made. The rules are those of the unigram tokenizer: at equal scores the
piece that begins first stays, a code point without a piece of its own may be unknown
at the lowest score less ten, and an unknown one counts as its UTF-8 bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

SPACE = "▁"
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
_UNKNOWN_PENALTY = 10.0
_CACHED_WORDS, _CACHED_LENGTH = 400_000, 40


@dataclass(frozen=True)
class Vocabulary:
    """Pieces and scores of a unigram vocabulary with byte fallback."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    dummy_prefix: bool = True

    @cached_property
    def automaton(self) -> ahocorasick.Automaton:
        a = ahocorasick.Automaton()
        for p, s in zip(self.pieces, self.scores, strict=True):
            a.add_word(p, (len(p), s))
        a.make_automaton()
        return a

    @cached_property
    def unknown(self) -> float:
        return min(self.scores) - _UNKNOWN_PENALTY

    @cached_property
    def parts(self) -> re.Pattern | None:
        """Cuts a text where no piece can lie across, so that words can be counted alone."""
        if any(SPACE in p.lstrip(SPACE) or "\n" in p for p in self.pieces):
            return None
        return re.compile(f"{SPACE}+[^{SPACE}\n]*|\n[^{SPACE}\n]*|[^{SPACE}\n]+")

    def best(self, s: str) -> int:
        """Number of pieces of the best segmentation of ``s`` (spaces are already marks)."""
        n = len(s)
        score, count, single = [0.0] + [float("-inf")] * n, [0] * (n + 1), bytearray(n + 1)
        unknown, at = self.unknown, 0
        for end, (length, gain) in self.automaton.iter(s):  # longest first at each end
            while at < end:
                at += 1
                if not single[at] and score[at - 1] + unknown > score[at]:
                    score[at], count[at] = score[at - 1] + unknown, count[at - 1] + len(s[at - 1].encode("utf-8", "replace"))
            start = end + 1 - length
            if score[start] + gain > score[end + 1]:
                score[end + 1], count[end + 1] = score[start] + gain, count[start] + 1
            if length == 1:
                single[end + 1] = 1
        while at < n:
            at += 1
            if not single[at] and score[at - 1] + unknown > score[at]:
                score[at], count[at] = score[at - 1] + unknown, count[at - 1] + len(s[at - 1].encode("utf-8", "replace"))
        return count[n]


class _Counts(dict):
    """Counts of words seen, in a bounded dictionary."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, word: str) -> int:
        n = self.vocabulary.best(word)
        if len(word) <= _CACHED_LENGTH:
            if len(self) >= _CACHED_WORDS:
                self.clear()
            self[word] = n
        return n

    def text(self, text: str | None) -> int:
        if not text:
            return 0
        marked = (SPACE if self.vocabulary.dummy_prefix else "") + text.replace(" ", SPACE)
        if self.vocabulary.parts is None:
            return self.vocabulary.best(marked)
        return sum(map(self.__getitem__, self.vocabulary.parts.findall(marked)))


def load_vocabulary(path: str = MODEL) -> Vocabulary:
    """Normal pieces and their scores from a SentencePiece model file, read by the driver."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(m.get_piece_size())
           if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i))]
    if not any(m.is_byte(i) for i in range(m.get_piece_size())):
        raise ValueError("the vocabulary has no byte pieces")
    return Vocabulary(tuple(m.id_to_piece(i) for i in ids), tuple(float(m.get_score(i)) for i in ids))


def token_counts(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``(doc_id, n_tokens, n_points)`` for each row of ``docs``: tokens and code points of the whole text.

    Null and empty texts count 0. Repeated rows get equal counts. Other columns are not
    read. The vocabulary is broadcast; its size is that of the tokenizer, whatever the data.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _Counts(shared.value)
        for b in batches:
            texts = b.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([counts.text(t) for t in texts], pa.int64()),
                 pa.array([len(t or "") for t in texts], pa.int64())], ["doc_id", "n_tokens", "n_points"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, n_tokens long, n_points long")
