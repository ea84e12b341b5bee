"""Operator 12: fill-in-the-middle over texts kept as seekable compressed frames.

A text is stored as independent zstandard frames of FRAME_BYTES bytes each, with the
units, code points and bytes before each frame. A cut behind unit u is found by the
cumulative counts: only the frame that holds it is decompressed. The transformed text is
again a row of frames: whole frames of the store are taken over as they are, cut ones are
cut, so prefix, middle and suffix change places without a second copy of the text. Digests
stream one frame after another. The frames of a result, one behind the other, are an
ordinary zstandard stream of the transformed text.

Units are lines (``[^\\n]*\\n|[^\\n]+``): a line end closes a unit, and what follows the last
one is a unit of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

#: The control strings of the transformed text.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
FRAME_BYTES = 64 << 10
_LEVEL = 3
_READER = zstandard.ZstdDecompressor()  # one for all texts: each holds memory of its own
_SLICE = 256  # texts whose results a task holds at a time


@dataclass(frozen=True)
class Rule:
    """How documents are cut: of 100, ``rate`` are transformed and ``spm`` of those get the suffix first."""

    seed: int = 7
    rate: int = 100
    spm: int = 50

    def draws(self, doc_id: int | None) -> tuple[int, int, int, int]:
        digest = hashlib.sha256(f"{self.seed}:{'' if doc_id is None else doc_id}".encode()).digest()
        return tuple(int.from_bytes(digest[i:i + 4], "big") for i in (0, 4, 8, 12))


# --- the store -----------------------------------------------------------------------------

def _points(data: bytes) -> int:
    """Code points that begin in ``data``: all bytes but those that go on with one."""
    return len(data) - int(np.count_nonzero((np.frombuffer(data, np.uint8) & 0xC0) == 0x80))


class Store:
    """One stored text: frames, and at each frame's begin the line ends, code points and bytes before it."""

    def __init__(self, frames: list, lines: list[int], points: list[int], sizes: list[int]):
        self.frames, self.lines, self.points, self.sizes = frames, lines, points, sizes

    @classmethod
    def of_text(cls, text: str | None, packer: zstandard.ZstdCompressor, frame_bytes: int = FRAME_BYTES) -> "Store":
        data = (text or "").encode()
        frames, lines, points, sizes = [], [0], [0], [0]
        for at in range(0, len(data), frame_bytes):
            part = data[at:at + frame_bytes]
            frames.append(packer.compress(part))
            lines.append(lines[-1] + part.count(b"\n"))
            points.append(points[-1] + _points(part))
            sizes.append(sizes[-1] + len(part))
        return cls(frames, lines, points, sizes)

    def frame(self, i: int) -> bytes:
        return _READER.decompress(self.frames[i])

    @property
    def n_units(self) -> int:
        if not self.frames:
            return 0
        return self.lines[-1] + (not self.frame(len(self.frames) - 1).endswith(b"\n"))

    def cut(self, units: int) -> tuple[int, int]:
        """``(bytes, code points)`` before the end of the first ``units`` units: one frame is decompressed."""
        if units == 0:
            return 0, 0
        if units > self.lines[-1]:
            return self.sizes[-1], self.points[-1]
        i = int(np.searchsorted(self.lines, units)) - 1  # the frame in which line end number ``units`` lies
        part, at = self.frame(i), -1
        for _ in range(units - self.lines[i]):
            at = part.index(b"\n", at + 1)
        return self.sizes[i] + at + 1, self.points[i] + _points(part[:at + 1])

    def pieces(self, begin: int, end: int, packer: zstandard.ZstdCompressor) -> Iterator[bytes]:
        """Frames of the bytes from ``begin`` to ``end``: whole ones as stored, cut ones packed anew."""
        i = max(int(np.searchsorted(self.sizes, begin, "right")) - 1, 0)
        while begin < end:
            stop = min(end, self.sizes[i + 1])
            if begin == self.sizes[i] and stop == self.sizes[i + 1]:
                yield self.frames[i]
            else:
                yield packer.compress(self.frame(i)[begin - self.sizes[i]:stop - self.sizes[i]])
            begin, i = stop, i + 1


def stream(frames) -> Iterator[bytes]:
    """What frames hold, one after another."""
    return (_READER.decompress(f) for f in frames)


def find_all(parts: Iterator[bytes], wanted: tuple[bytes, ...]) -> dict[bytes, int]:
    """Offset of the first occurrence of each of ``wanted`` in a stream, those that lie across parts included."""
    found, tail, at = {}, b"", 0
    overlap = max(map(len, wanted)) - 1
    for part in parts:
        seen = tail + part
        for w in wanted:
            if w not in found and (i := seen.find(w)) >= 0:
                found[w] = at - len(tail) + i
        at += len(part)
        tail = seen[-overlap:] if overlap else b""
    return found


def sha256_of(parts: Iterator[bytes]) -> str:
    digest = hashlib.sha256()
    for part in parts:
        digest.update(part)
    return digest.hexdigest()


def between(frames, begin: int, end: int) -> Iterator[bytes]:
    """Bytes ``begin`` to ``end`` of the stream of ``frames``."""
    at = 0
    for part in stream(frames):
        lo, hi = max(begin - at, 0), min(end - at, len(part))
        if lo < hi:
            yield part[lo:hi]
        at += len(part)
        if at >= end:
            return


def restored(frames, form: str) -> Iterator[bytes]:
    """The text before the transformation, from the transformed one and its form alone."""
    if form == "plain":
        yield from stream(frames)
        return
    marks = tuple(m.encode() for m in (PREFIX, SUFFIX, MIDDLE))
    at = find_all(stream(frames), marks)
    end = sum(map(len, stream(frames)))
    order = sorted((at[m], m) for m in marks)
    spans = {m: (o + len(m), order[i + 1][0] if i < 2 else end) for i, (o, m) in enumerate(order)}
    for m in (marks[0], marks[2], marks[1]):
        yield from between(frames, *spans[m])


def transform(store: Store, doc_id: int | None, rule: Rule, packer: zstandard.ZstdCompressor) -> dict:
    """Form, cuts and frames of one transformed text."""
    n = store.n_units
    h1, h2, h3, h4 = rule.draws(doc_id)
    marks = tuple(m.encode() for m in (PREFIX, SUFFIX, MIDDLE))
    if n == 0 or h3 % 100 >= rule.rate or find_all(stream(store.frames), marks):
        return {"n": n, "form": "plain", "prefix_chars": None, "middle_chars": None, "output": list(store.frames)}
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    (a, a_points), (b, b_points) = store.cut(first), store.cut(second)
    p, s, m = map(packer.compress, marks)
    prefix, middle, suffix = (list(store.pieces(*span, packer)) for span in ((0, a), (a, b), (b, store.sizes[-1])))
    spm = h4 % 100 < rule.spm
    output = [s, *suffix, p, *prefix, m, *middle] if spm else [p, *prefix, s, *suffix, m, *middle]
    return {"n": n, "form": "spm" if spm else "psm", "prefix_chars": a_points, "middle_chars": b_points - a_points,
            "output": output}


# --- over DataFrames -----------------------------------------------------------------------

STORE = "frames array<binary>, lines array<long>, points array<long>, sizes array<long>"


def store_texts(docs: DataFrame, frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """``(doc_id, frames, lines, points, sizes)`` for each row of ``docs``: its text as a seekable store.

    A null or empty text has no frames. Other columns are not read.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=_LEVEL)
        types = [pa.list_(pa.binary()), *[pa.list_(pa.int64())] * 3]
        for b in sliced(batches):
            stores = [Store.of_text(t.as_py(), packer, frame_bytes) for t in b.column(1)]
            columns = zip(*((s.frames, s.lines, s.points, s.sizes) for s in stores), strict=True) if stores else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(list(c), t) for c, t in zip(columns, types, strict=True)]],
                ["doc_id", "frames", "lines", "points", "sizes"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, {STORE}")


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in slices, as a task holds the results of one slice."""
    for b in batches:
        for at in range(0, b.num_rows, _SLICE):
            yield b.slice(at, _SLICE)


def fill_in_middle(stores: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """``(doc_id, n, form, prefix_chars, middle_chars, output, output_sha256, restored_sha256)`` for each stored text.

    ``output`` holds the frames of the transformed text; ``restored_sha256`` is the digest of the text as
    :func:`restored` rebuilds it from ``output`` and ``form``. A text that is empty or holds a
    control string stays plain, its cuts null. Rows that repeat an id are cut alike; a null
    id counts as an empty one in the draw. No rows in: no rows out.
    """
    id_type = stores.schema["doc_id"].dataType.simpleString()
    names = ["n", "form", "prefix_chars", "middle_chars", "output"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.binary())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=_LEVEL)
        for b in sliced(batches):
            ids = b.column(0).to_pylist()
            done = [transform(Store(*(c[i].as_py() for c in b.columns[1:])), d, rule, packer) for i, d in enumerate(ids)]
            digests = [[sha256_of(stream(r["output"])) for r in done], [sha256_of(restored(r["output"], r["form"])) for r in done]]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array([r[c] for r in done], t) for c, t in zip(names, types, strict=True)],
                 *[pa.array(d, pa.string()) for d in digests]], ["doc_id", *names, "output_sha256", "restored_sha256"])

    return (stores.select("doc_id", "frames", "lines", "points", "sizes")
            .mapInArrow(run, f"doc_id {id_type}, n long, form string, prefix_chars long, middle_chars long, "
                             "output array<binary>, output_sha256 string, restored_sha256 string"))
