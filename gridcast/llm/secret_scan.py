"""Operator 8: secret scans by patterns and by dictionary-primed compression novelty.

Three patterns give the base spans. Beside them, every other long token near (before,
in or after) a sensitive word is a candidate: it is compressed with a zstandard dictionary made of the
text around it and of common identifiers. Words, paths and names share substrings with
that dictionary and cost few bytes; what costs about as much as random strings of its
length and alphabet is reported as kind ``novel``.
"""

from __future__ import annotations

import hashlib
import re
import string
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

KINDS = ("assign", "access", "hex", "novel")
# The base patterns of the contract, each with its least length.
_ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
                     re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")  # a run is maximal, so this drops just the short ones
_LEAST_VALUE, _LEAST_ACCESS = 8, 16

# '=' parts a name from its value; up to six at the end of a token are padding. LEAST counts the padding.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{10,}(?:={1,6}(?![A-Za-z0-9+/_=-]))?")
LEAST = 16
_IN_NAME = frozenset(string.ascii_letters + string.digits + "+/_-")
SENSITIVE = re.compile(r"auth|bearer|cert|cookie|credential|crypt|key|login|passphrase|passwd|password|private|pwd|"
                       r"salt|secret|session|signature|token", re.ASCII | re.IGNORECASE)
#: Identifiers that code around credentials uses; the part of the dictionary that is not the text itself.
IDENTIFIERS = ("access account address admin algorithm application array author authorization backend base64 bearer "
               "boolean bucket buffer cache callback certificate charset client cluster column config connection "
               "console const constructor container content context controller cookie credential database default "
               "define delete description digest directory document domain element encoding endpoint environment "
               "exception export expires false filename folder format function generate handler header hostname "
               "identifier implements import include index instance integer interface internal invalid iterator json "
               "keyword language length library license listener localhost location logger manager message metadata "
               "method module namespace network number object operator optional option output package parameter "
               "parent parse password path payload permission pointer prefix primary private process production "
               "profile property protected protocol provider public query random record reference region register "
               "release remote replace repository request required resource response result return schema script "
               "secret section security select sequence server service session setting signature source standard "
               "static status storage stream string struct subject suffix system table target template thread "
               "timeout timestamp token transaction transfer true undefined unicode update upload username value "
               "variable vector version virtual warning website window workspace wrapper").split()


@cache
def _settings() -> zstandard.ZstdCompressionParameters:
    # no checksum, size or dictionary id in the frame: only the bytes that the candidate adds
    return zstandard.ZstdCompressionParameters(strategy=zstandard.STRATEGY_BTOPT, min_match=3, window_log=17,
                                               hash_log=12, chain_log=12, search_log=4,
                                               write_content_size=False, write_checksum=False, write_dict_id=False)


def _alphabet(data: bytes) -> bytes:
    """The smallest usual alphabet of ``data``: digits or letters or both (of hex: a to f), and its other bytes."""
    used, out, rest = set(data), b"", set(data)
    for letters in (string.ascii_lowercase.encode(), string.ascii_uppercase.encode()):
        if own := used & set(letters):
            out += letters[:6] if own <= set(letters[:6]) else letters
            rest -= own
    digits = string.digits.encode()
    if used & set(digits) or len(out) <= 12:  # never so few symbols that a repeated one passes for random
        out += digits
    return out + bytes(sorted(rest - set(digits)))


def _random_strings(data: bytes, n: int = 4) -> list[bytes]:
    """``n`` fixed random strings of the length and alphabet of ``data``."""
    letters = _alphabet(data)
    table = bytes(letters[i % len(letters)] for i in range(256))
    return [hashlib.shake_256(bytes([i])).digest(len(data)).translate(table) for i in range(n)]


def novelty(candidate: str, around: str) -> float:
    """Compressed bytes of ``candidate`` to those of a random string of its length and alphabet, at most 1.

    Both are compressed with ``around`` and the identifiers as the dictionary, so what
    entropy coding and chance matches save of a limited alphabet counts on both sides.
    The cheapest of a few random strings is taken. One identifier stands before each
    string too and its bytes are taken off, so a short name's matches are not eaten up
    by the headers of a block that a random string, stored as it is, does without. Names
    in capitals or humps are measured in lower case too, and the lower share counts.
    """
    least = 1.0
    known, head = (" ".join(IDENTIFIERS) + "\n").encode(), (IDENTIFIERS[-1] + "\n").encode()
    for fold in (str, str.lower):
        primed = zstandard.ZstdCompressionDict(known + fold(around).encode("utf-8", "replace"),
                                               dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        zstd = zstandard.ZstdCompressor(dict_data=primed, compression_params=_settings())
        data = fold(candidate).encode("utf-8", "replace")
        nothing, own, *others = (len(zstd.compress(head + x)) for x in (b"", data, *_random_strings(data)))
        least = min(least, (own - nothing) / max(1, min(others) - nothing))
    return least


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, place of the kind in KINDS), code points, end exclusive, in order."""
    out = [(m.start(), m.end(), 0) for m in _ASSIGN.finditer(text) if len(m[2]) >= _LEAST_VALUE]
    out += [(m.start(), m.end(), 1) for m in _ACCESS.finditer(text) if m.end() - m.start() >= _LEAST_ACCESS]
    out += [(m.start(), m.end(), 2) for m in _HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], s[2]))


def _name(text: str, s: int) -> str:
    """The name that a value starting at ``s`` is assigned to by '='; else nothing."""
    if text[s - 1:s] != "=":
        return ""
    e = s = s - 1
    while s and text[s - 1] in _IN_NAME:
        s -= 1
    return text[s:e]


def novel_spans(text: str, base: list[tuple[int, int, int]], context: int = 64, around: int = 2048,
                threshold: float = 0.85) -> list[tuple[int, int, int]]:
    """Candidates outside the base spans, near a sensitive word, that don't compress.

    A sensitive word must lie in the candidate, in the name that it is assigned to or
    within ``context`` code points on either side; ``around`` on either side are the
    surrounding code of its dictionary. Every candidate is measured.
    """
    out, at = [], 0
    ends = sorted((s, e) for s, e, _ in base)
    for m in CANDIDATE.finditer(text):
        s, e = m.span()
        while at < len(ends) and ends[at][1] <= s:
            at += 1
        if e - s < LEAST or any(a < e and s < b for a, b in ends[at:at + 3]):
            continue
        if SENSITIVE.search(text, max(0, s - context), e + context) is None and SENSITIVE.search(_name(text, s)) is None:
            continue
        if novelty(m[0], text[max(0, s - around):s] + "\n" + text[e:e + around]) >= threshold:
            out.append((s, e, 3))
    return out


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in spans)


def scan(text: str | None) -> tuple[int, int, int, str, str]:
    """(assign, access, hex spans, sha256 of the base spans, all spans) of one text; null counts as empty."""
    text = text or ""
    base = base_spans(text)
    every = sorted(base + novel_spans(text, base), key=lambda s: (s[0], s[2]))
    kinds = [k for _, _, k in base]
    return (kinds.count(0), kinds.count(1), kinds.count(2), hashlib.sha256(_joined(base).encode()).hexdigest(),
            _joined(every))


def secret_spans(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base_sha256, spans)`` for each row of ``docs``.

    Whole texts are read; null and empty ones have no spans and the hash of the empty
    string. Repeated rows give repeated results. No other column is read.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = list(zip(*(scan(t) for t in b.column(1).to_pylist()), strict=True)) or [()] * 5
            types = [pa.int64()] * 3 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(list(c), t) for c, t in zip(found, types))],
                                             ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
