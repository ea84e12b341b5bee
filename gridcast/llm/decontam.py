"""Operator 3: benchmark decontamination by spaced-seed hashing.

A mask lays over a run of tokens and looks only at its ones, so a hash of what it sees
survives substitutions in between. Hashes of all windows of the benchmark are joined
with those of the documents; around each hit both texts are laid side by side on the
hit's diagonal, and the longest stretch with enough equal tokens decides.

Document hashes are not shuffled: a bit table of the benchmark's hashes, of bounded
size whatever the benchmark's, lets a window through only if its two bits are set, and
only what passes is joined. A fuller table lets more through but loses nothing.

Items too short for that are searched by their whole token sequence. Scripts that are
written without blanks have each character as a token.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved, text_key
from .hashing import mix, plain, token_hashes

#: Together they hit every alignment of 13 tokens with 2 substitutions, 15 with 3 and 20 with 4.
MASKS = ("111101", "110111", "111011", "1110101", "101011001", "1001001011")
_MOST_BITS = 28  # 32 MB
_PART = 256
_ODD = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


# Thai, Lao, Myanmar, Tai Le to Khmer; radicals, kana, bopomofo; ideographs with their extensions
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u1950-\u19ff\u1a20-\u1aaf\ua9e0-\ua9ff\uaa60-\uaa7f\uaa80-\uaadf"
                       "\u2e80-\u2fdf\u3005-\u3007\u3021-\u3029\u3040-\u312f\u31a0-\u31bf\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff"
                       "\uf900-\ufaff\uff66-\uff9f\U0001b000-\U0001b16f\U00020000-\U0003ffff]")


def spaced(text: str | None) -> str:
    """``text`` with blanks around each character of a script that is written without them."""
    text = text or ""
    return text if text.isascii() else _UNSPACED.sub(r" \g<0> ", text)


def window_hashes(h: np.ndarray, ends: np.ndarray, masks: tuple[str, ...] = MASKS
                  ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each mask: (first token of each window, its hash). ``ends``: of each token's text."""
    for n, mask in enumerate(masks):
        span = len(mask)
        size = len(h) - span + 1
        if size <= 0:
            continue
        total = np.full(size, n + 1, dtype=np.uint64)
        for i, one in enumerate(mask):
            if one == "1":
                total += h[i:i + size] * _ODD[i]
        at = np.flatnonzero(np.arange(span, size + span) <= ends[:size])
        yield at, mix(total[at])


def _spot(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    return h >> np.uint64(64 - bits), (h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)


def _set(table: np.ndarray, spot: np.ndarray) -> np.ndarray:
    return (table[(spot >> np.uint64(6)).astype(np.int64)] >> (spot & np.uint64(63))) & np.uint64(1) == 1


def _item_hashes(items: DataFrame) -> DataFrame:
    """``(item, at, h)``: every window of every benchmark text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            item = b.column(0).to_numpy(zero_copy_only=False)
            for first, sizes, (h,) in token_hashes([spaced(t) for t in b.column(1).to_pylist()]):
                upto = np.cumsum(sizes)
                doc, start = np.repeat(np.arange(len(sizes)), sizes), np.repeat(upto - sizes, sizes)
                for at, found in window_hashes(h, np.repeat(upto, sizes)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(item[first + doc[at]]), pa.array((at - start[at]).astype(np.int32)),
                         pa.array(found.view(np.int64))], ["item", "at", "h"])

    return items.select("item", "text").mapInArrow(run, "item long, at int, h long")


def _bit_table(hashes: DataFrame, n: int) -> tuple[int, np.ndarray]:
    """Two bits per hash in a table of about 512 bits per hash, but of 2**28 at most; built by Spark."""
    bits = min(max(int(n).bit_length() + 9, 16), _MOST_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spot = np.concatenate(_spot(b.column(0).to_numpy(zero_copy_only=False).view(np.uint64), bits))
            yield pa.RecordBatch.from_arrays(
                [pa.array((spot >> np.uint64(6)).astype(np.int64)),
                 pa.array((np.uint64(1) << (spot & np.uint64(63))).view(np.int64))], ["word", "bit"])

    words = (hashes.select("h").mapInArrow(run, "word long, bit long")
             .groupBy("word").agg(F.bit_or("bit").alias("bit")).toPandas())
    table = np.zeros(1 << (bits - 6), dtype=np.uint64)
    table[words["word"].to_numpy(dtype=np.int64)] = words["bit"].to_numpy(dtype=np.int64).view(np.uint64)
    return bits, table


def _parts(at: np.ndarray, gap: int) -> Iterator[np.ndarray]:
    """Indices of sorted hit positions, cut at gaps and after _PART positions."""
    for run in np.split(np.arange(len(at)), np.flatnonzero(np.diff(at) > gap) + 1):
        yield from np.split(run, np.flatnonzero(np.diff((at[run] - at[run[0]]) // _PART)) + 1)


def _stretches(docs: DataFrame, bits: int, table: np.ndarray, around: int) -> DataFrame:
    """One row for each stretch of a document with windows that the bit table lets through.

    ``h`` has each hash once and ``at`` its places. A stretch spans at most _PART hit
    positions, so a text that repeats itself gives many short rows and not a long one.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(table)
    longest = max(map(len, MASKS))

    def passed(texts: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        for first, sizes, (h,) in token_hashes(texts):
            upto = np.cumsum(sizes)
            ends, at, got = np.repeat(upto, sizes), [], []
            for w, found in window_hashes(h, ends):
                one, two = _spot(found, bits)
                hit = np.flatnonzero(_set(shared.value, one))
                hit = hit[_set(shared.value, two[hit])]
                at.append(w[hit])
                got.append(found[hit])
            if not at or not sum(map(len, at)):
                continue
            at, got = np.concatenate(at), np.concatenate(got)
            order = np.argsort(at, kind="stable")
            at, got = at[order], got[order]
            doc = np.searchsorted(upto, at, side="right")
            for d in np.unique(doc).tolist():
                own = doc == d
                yield first + d, at[own] - int(upto[d] - sizes[d]), got[own]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [spaced(t) for t in b.column(3).to_pylist()]
            place, base, tokens, spots, hashes = [], [], [], [], []
            for i, at, got in passed(texts):
                words = plain(texts[i]).split()
                for part in _parts(at, 2 * around + longest):
                    start = max(0, int(at[part[0]]) - around)
                    kinds, of = np.unique(got[part], return_inverse=True)
                    order = np.argsort(of, kind="stable")
                    place.append(i)
                    base.append(start)
                    tokens.append(words[start:int(at[part[-1]]) + longest + around])
                    spots.append(np.split(at[part][order].astype(np.int32), np.cumsum(np.bincount(of))[:-1]))
                    hashes.append(kinds.view(np.int64))
            if place:
                idx = pa.array(place)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(idx), b.column(1).take(idx), b.column(2).take(idx), pa.array(base, pa.int32()),
                     pa.array(tokens, pa.list_(pa.binary())), pa.array(spots, pa.list_(pa.list_(pa.int32()))),
                     pa.array(hashes, pa.list_(pa.int64()))],
                    ["row", "doc_id", "text_key", "base", "tokens", "at", "h"])

    return (docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", text_key().alias("text_key"), "text")
            .mapInArrow(run, f"row long, doc_id {id_type}, text_key long, base int, tokens array<binary>, "
                             "at array<array<int>>, h array<long>"))


def _whole_hashes(items: DataFrame, lengths: list[int]) -> DataFrame:
    """``h`` of the whole token sequence of every item; ``items`` have as many tokens as one of ``lengths``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, sizes, (h,) in token_hashes([spaced(t) for t in b.column(0).to_pylist()]):
                ends = np.repeat(np.cumsum(sizes), sizes)
                for k in lengths:
                    for at, found in window_hashes(h, ends, ("1" * k,)):
                        whole = found[np.repeat(sizes, sizes)[at] == k]
                        yield pa.RecordBatch.from_arrays([pa.array(whole.view(np.int64))], ["h"])

    return items.select("text").mapInArrow(run, "h long")


def _exact(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The result rows of items that stand in a document token for token; each item's first place."""
    lengths = sorted(r[0] for r in items.select(F.size("words")).distinct().collect())
    whole = _whole_hashes(items, lengths)
    bits, table = _bit_table(whole, whole.count())
    shared = docs.sparkSession.sparkContext.broadcast(table)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def first_places(texts: list[str]) -> Iterator[tuple[int, int, int]]:
        for first, sizes, (h,) in token_hashes(texts):
            upto = np.cumsum(sizes)
            ends = np.repeat(upto, sizes)
            for k in lengths:
                for at, found in window_hashes(h, ends, ("1" * k,)):
                    one, two = _spot(found, bits)
                    hit = np.flatnonzero(_set(shared.value, one))
                    hit = hit[_set(shared.value, two[hit])]
                    at, found = at[hit], found[hit]
                    doc = np.searchsorted(upto, at, side="right")
                    order = np.lexsort((at, found, doc))
                    new = np.ones(len(order), dtype=bool)
                    new[1:] = (np.diff(doc[order]) != 0) | (np.diff(found[order]) != 0)
                    for i in order[new].tolist():
                        yield first + int(doc[i]), int(at[i] - upto[doc[i]] + sizes[doc[i]]), k

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [spaced(t) for t in b.column(2).to_pylist()]
            split, found = {}, sorted(first_places(texts))
            place, start, words = [], [], []
            for i, at, k in found:
                if i not in split:
                    split = {i: plain(texts[i]).split()}
                place.append(i)
                start.append(at)
                words.append(split[i][at:at + k])
            if place:
                idx = pa.array(place)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(idx), b.column(1).take(idx), pa.array(start, pa.int32()),
                     pa.array(words, pa.list_(pa.binary()))], ["doc_id", "text_key", "start", "words"])

    hits = (docs.select("doc_id", text_key().alias("text_key"), "text")
            .mapInArrow(run, f"doc_id {id_type}, text_key long, start int, words array<binary>"))
    size = F.size("words")
    return hits.join(items.select("item_id", "words"), "words").select(
        "doc_id", "text_key", "item_id", "start", size.alias("overlap"), size.alias("matches"), size.alias("item_tokens"))


def longest_stretch(equal: np.ndarray, identity: float) -> tuple[int, int]:
    """(start, length) of the longest run of positions whose share of ones is at least ``identity``."""
    total = np.concatenate(([0], np.cumsum(equal.astype(np.int64) * 1000 - round(identity * 1000))))
    low = np.minimum.accumulate(total)
    high = np.maximum.accumulate(total[::-1])[::-1]
    best, i, j = (0, 0), 0, 0
    while j < len(total):
        if high[j] >= low[i]:
            if j - i > best[1]:
                best = (i, j - i)
            j += 1
        else:
            i += 1
            j = max(i, j)
    return best


#: A longest overlap, or (``equal`` is not null) the tokens that agree from ``start`` on in a piece of a diagonal.
_CHECKED = "row long, item long, length int, same int, start int, item_tokens int, shift int, equal binary"


def _checked(rows: list[tuple], row: pa.Array, item: pa.Array) -> pa.RecordBatch:
    """``rows`` of (place in ``row`` and ``item``, the other columns of _CHECKED)."""
    place, *columns = zip(*rows) if rows else [()] * 7
    idx = pa.array(place, pa.int64())
    types = [pa.int32()] * 5 + [pa.binary()]
    return pa.RecordBatch.from_arrays(
        [row.take(idx), item.take(idx), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))],
        ["row", "item", "length", "same", "start", "item_tokens", "shift", "equal"])


def _verify(identity: float, min_tokens: int, around: int):
    """Of each (stretch, item): the longest overlap on any diagonal that a seed hit.

    Where the stretch may end before the diagonal of an item of more than ``around`` tokens
    does, its piece of the diagonal is passed on to :func:`_merge`.
    """

    def best(base: int, tokens: list[bytes], item: list[bytes], seeds: list[dict]) -> Iterator[tuple]:
        number = {w: i for i, w in enumerate(set(item))}
        x = np.array([number.get(w, -1) for w in tokens])
        y = np.array([number[w] for w in item])
        found = (0, 0, 0)
        for shift in np.unique(np.concatenate([np.subtract.outer(s["doc_at"], s["item_at"]).ravel() for s in seeds])):
            lo, hi = max(base, shift), min(base + len(x), shift + len(y))
            if hi <= lo:
                continue
            equal = x[lo - base:hi - base] == y[lo - shift:hi - shift]
            if len(y) > around and (lo > max(0, shift) or hi < shift + len(y)):
                yield 0, 0, int(lo), len(y), int(shift), equal.tobytes()
                continue
            start, length = longest_stretch(equal, identity)
            found = max(found, (length, int(equal[start:start + length].sum()), -int(lo + start)))
        if found[0] >= min(min_tokens, len(y)):
            yield *found, len(y), None, None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = zip(*(b.column(i).to_pylist() for i in (2, 3, 4, 5)), strict=True)
            yield _checked([(i, *found) for i, r in enumerate(rows) for found in best(*r)], b.column(0), b.column(1))

    return run


def _merge(identity: float, min_tokens: int):
    """Of each (row, item, diagonal): the longest overlap in its pieces, joined where they meet."""

    def joined(pieces: list[dict]) -> Iterator[tuple[int, np.ndarray]]:
        held, first, end = [], 0, -1
        for piece in sorted(pieces, key=lambda p: p["start"]):
            lo, equal = piece["start"], np.frombuffer(piece["equal"], dtype=bool)
            if lo > end:
                if held:
                    yield first, np.concatenate(held)
                held, first, end = [], lo, lo
            held.append(equal[end - lo:])
            end = max(end, lo + len(equal))
        yield first, np.concatenate(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for i, (size, pieces) in enumerate(zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)):
                found = (0, 0, 0)
                for lo, equal in joined(pieces):
                    start, length = longest_stretch(equal, identity)
                    found = max(found, (length, int(equal[start:start + length].sum()), -(lo + start)))
                if found[0] >= min(min_tokens, size):
                    rows.append((i, *found, size, None, None))
            yield _checked(rows, b.column(0), b.column(1))

    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, identity: float = 0.8, min_tokens: int = 13,
                 shortest_item: int = 8, around: int = 64) -> DataFrame:
    """``(doc_id, text_key, item_id, start, overlap, matches, item_tokens)``: one row for each
    row of ``docs`` and benchmark item with an overlap; documents without one have no row.

    An overlap is an ungapped stretch of at least ``min_tokens`` tokens (or the whole of
    a shorter item) of which a share of ``identity`` or more are equal; the longest one
    is given, as far as it lies within ``around`` tokens of the stretches with hits on its
    diagonal, which are joined where they meet. Tokens are lower-cased and without
    ASCII punctuation; characters of scripts without blanks are tokens of their own. Items
    of fewer than ``shortest_item`` tokens count where all their tokens stand in a row,
    without substitutions; the first place is given. Null and empty texts on either side match nothing; a null doc_id is
    carried; repeated rows are each reported. Empty tables give no rows.
    """
    items = benchmark.select(F.monotonically_increasing_id().alias("item"), "item_id", "text")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2),
                 pa.array([plain(spaced(t)).split() for t in b.column(2).to_pylist()], pa.list_(pa.binary()))],
                ["item", "item_id", "text", "words"])

    item_type = benchmark.schema["item_id"].dataType.simpleString()
    items = saved(items.mapInArrow(split, f"item long, item_id {item_type}, text string, words array<binary>")
                  .where(F.size("words") > 0))
    short, items = items.where(F.size("words") < shortest_item), items.where(F.size("words") >= shortest_item)
    test = saved(_item_hashes(items))
    bits, table = _bit_table(test, test.count())
    found = saved(_stretches(docs, bits, table, around))
    hits = found.select("row", "base", F.explode(F.arrays_zip("at", "h")).alias("w")).select(
        "row", "base", F.col("w.at").alias("doc_at"), F.col("w.h").alias("h"))
    places = test.groupBy("item", "h").agg(F.collect_list("at").alias("item_at"))
    seeds = (hits.join(places, "h").groupBy("row", "base", "item")
             .agg(F.collect_list(F.struct("doc_at", "item_at")).alias("seeds")))
    pairs = (seeds.join(found.select("row", "base", "tokens"), ["row", "base"])
             .join(items.select("item", "words"), "item").select("row", "item", "base", "tokens", "words", "seeds"))
    checked = pairs.mapInArrow(_verify(identity, min_tokens, around), _CHECKED)
    if not items.where(F.size("words") > around).isEmpty():  # up to that, a stretch with a hit holds the whole item
        checked = saved(checked)
        pieces = (checked.where("equal is not null").groupBy("row", "item", "shift", "item_tokens")
                  .agg(F.collect_list(F.struct("start", "equal")).alias("pieces"))
                  .select("row", "item", "item_tokens", "pieces"))
        checked = checked.where("equal is null").unionByName(pieces.mapInArrow(_merge(identity, min_tokens), _CHECKED))
    best = checked.groupBy("row", "item").agg(
        F.max(F.struct("length", "same", "start", "item_tokens")).alias("b"))
    names = found.select("row", "doc_id", "text_key").distinct()
    near = best.join(names, "row").join(items.select("item", "item_id"), "item").select(
        "doc_id", "text_key", "item_id", (-F.col("b.start")).alias("start"), F.col("b.length").alias("overlap"),
        F.col("b.same").alias("matches"), F.col("b.item_tokens").alias("item_tokens"))
    return near if short.isEmpty() else near.unionByName(_exact(docs, short))
