"""Hashes of all tokens of many texts at once, with numpy.

A token is a maximal run of letters, digits and non-ASCII bytes after lower-casing
and deleting ASCII punctuation; white space parts tokens. Its hash is a polynomial
over its bytes modulo 2**64, taken from prefix sums over a whole block of texts and
then mixed, so the cost is a few array passes and no loop over tokens.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BLOCK = 1 << 20  # bytes hashed at once; bounds the memory of any input
_BASE = 0x9E3779B97F4A7C15 | 1
_BLANK = bytes(range(9, 14)) + b" "
_DELETE = bytes(c for c in range(128) if not chr(c).isalnum() and c not in _BLANK)
_SPACES = bytes(32 if c in _BLANK else c for c in range(256))
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def plain(text: str | None) -> bytes:
    """The bytes whose blank-separated runs are the tokens."""
    return (text or "").lower().encode("utf-8", "replace").translate(_SPACES, _DELETE)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(BLOCK + 2, 1 << (n + 1).bit_length())
    if size not in _POWERS:
        def table(base: int) -> np.ndarray:
            out = np.full(size, base, dtype=np.uint64)
            out[0] = 1
            return np.multiply.accumulate(out)
        _POWERS.clear()
        _POWERS[size] = table(_BASE), table(pow(_BASE, -1, 1 << 64))
    return _POWERS[size]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xA0761D6478BD642F)
    return h ^ (h >> np.uint64(32))


def hash_block(blob: bytes, prefixes: tuple[int, ...] = ()) -> tuple[np.ndarray, list[np.ndarray]]:
    """(start byte of each token, [its hash, hash of its first k bytes for k in prefixes])."""
    a = np.frombuffer(blob, dtype=np.uint8)
    inside = np.zeros(len(a) + 2, dtype=np.int8)
    inside[1:-1] = a != 32
    edge = np.diff(inside)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    power, inverse = _powers(len(a))
    total = np.zeros(len(a) + 1, dtype=np.uint64)
    np.cumsum((a.astype(np.uint64) + np.uint64(1)) * power[:len(a)], out=total[1:])
    base, back = total[start], inverse[start]
    out = [mix((total[end] - base) * back)]
    for k in prefixes:
        stop = np.minimum(start + k, end)
        out.append(mix((total[stop] - base) * back + np.uint64(k)))
    return start, out


def _pieces(blob: bytes) -> Iterator[bytes]:
    """``blob`` cut at blanks into blocks of about BLOCK bytes (one token is never cut)."""
    at = 0
    while at < len(blob):
        stop = at + BLOCK
        if stop < len(blob):
            cut = blob.rfind(b" ", at, stop)
            stop = cut if cut > at else (blob.find(b" ", stop) if b" " in blob[stop:] else len(blob))
        yield blob[at:stop]
        at = stop


def token_hashes(texts: list[str | None], prefixes: tuple[int, ...] = ()
                 ) -> Iterator[tuple[int, np.ndarray, list[np.ndarray]]]:
    """Yields (index of the first text, tokens per text, [hashes, prefix hashes ...]).

    Texts go together in blocks of about BLOCK bytes; a longer text comes alone,
    hashed piece by piece, so only its token hashes are held whole.
    """
    first, group, held = 0, [], 0

    def flush():
        blob = b" ".join(group)
        start, hashes = hash_block(blob, prefixes)
        ends = np.cumsum(np.fromiter((len(g) + 1 for g in group), dtype=np.int64, count=len(group)))
        upto = np.searchsorted(start, ends)
        return np.diff(upto, prepend=0), hashes

    for i, text in enumerate(texts):
        b = plain(text)
        if group and held + len(b) > BLOCK:
            yield (first, *flush())
            group, held = [], 0
        if len(b) > BLOCK:
            parts = [hash_block(p, prefixes)[1] for p in _pieces(b)]
            hashes = [np.concatenate(x) for x in zip(*parts, strict=True)]
            yield i, np.array([len(hashes[0])]), hashes
            continue
        if not group:
            first = i
        group.append(b)
        held += len(b) + 1
    if group:
        yield (first, *flush())
