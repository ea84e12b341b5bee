"""Operator 1: SimHash near-duplicates by a byte-position inverted index.

A fingerprint has eight positional bytes. Two fingerprints at most four bits apart
differ in at most four bytes, so they share at least four (position, byte) entries:
the guaranteed minimum. A posting list for one byte would hold 1/256 of all rows and
its pairs would grow with the square of the corpus, so the index is kept on the
intersections of four lists, which is what the count filter asks for: a pair's tally
reaches four exactly when it meets in one of the C(8,4) = 70 lists. Inside a list the
tally and the bit distance are then checked.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved, text_key
from .components import components

SEED = 42
BITS = 64
_HASHES_AT_ONCE = 1 << 15
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """SimHash of the word shingles; 0 without words (null and blank texts)."""
    words = (text or "").encode("utf-8", "replace").translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    stop = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
    start = (stop - np.fromiter(map(len, words), dtype=np.int64, count=len(words)) - 1)[:len(words) - shingle + 1]
    stop = stop[shingle - 1:] - 1
    digest, total = xxhash.xxh64_intdigest, np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(start), _HASHES_AT_ONCE):
        s, e = start[at:at + _HASHES_AT_ONCE].tolist(), stop[at:at + _HASHES_AT_ONCE].tolist()
        h = np.array([digest(joined[i:j], SEED) for i, j in zip(s, e, strict=True)], dtype="<u8")
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * total > len(start)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """``(doc_id, text_key, fp)`` for every row; ``fp`` is the fingerprint as a signed long."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((fingerprint(t, shingle) for t in b.column(2).to_pylist()), dtype=np.uint64,
                             count=b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp.view(np.int64))],
                                             ["doc_id", "text_key", "fp"])

    return (docs.select("doc_id", text_key().alias("text_key"), "text")
            .mapInArrow(run, f"doc_id {id_type}, text_key long, fp long"))


def _postings(nodes: DataFrame, bytes_shared: int) -> DataFrame:
    """``(key, fp)``: each fingerprint in every list of ``bytes_shared`` positional bytes."""
    masks = [sum(0xFF << (8 * i) for i in c) for c in combinations(range(8), bytes_shared)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keys = F.array(*[F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(m).cast("long"))) for i, m in enumerate(signed)])
    return nodes.select(F.explode(keys).alias("key"), "fp")


def _near(x: np.ndarray, max_bits: int, bytes_shared: int) -> np.ndarray:
    """Count filter, then the check: which XORs share enough bytes and differ in few bits."""
    shared = (np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
    return (shared >= bytes_shared) & (np.bitwise_count(x) <= max_bits)


def _forest(f: np.ndarray, max_bits: int, bytes_shared: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Edges that connect what is linked within ``f``: one for each fingerprint reached.

    A found fingerprint leaves the rest at once, so a dense group costs about one pass
    per member over an ever shorter rest and never yields all its pairs.
    """
    edges, rest = [], f
    while rest.size > 1:
        todo, rest = [rest[0]], rest[1:]
        while todo and rest.size:
            p = todo.pop()
            near = _near(rest ^ p, max_bits, bytes_shared)
            if near.any():
                found = rest[near]
                edges.append((np.full(found.size, p, dtype=np.uint64), found))
                todo.extend(found)
                rest = rest[~near]
    return edges


def _lists_to_edges(max_bits: int, bytes_shared: int, largest: int):
    """Reads rows sorted by list key. Yields edges; members of longer lists pass through."""

    def out(kind: int, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(a), kind, dtype=np.int32)), pa.array(a.view(np.int64)), pa.array(b.view(np.int64))],
            ["kind", "a", "b"])

    def edges_of(key: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        cut = np.flatnonzero(np.diff(key)) + 1
        first, size = np.concatenate(([0], cut)), np.diff(np.concatenate(([0], cut, [len(key)])))
        two = first[size == 2]
        us, vs = [fp[two]], [fp[two + 1]]
        near = _near(us[0] ^ vs[0], max_bits, bytes_shared)
        us, vs = [us[0][near]], [vs[0][near]]
        for i, n in zip(first[size > 2].tolist(), size[size > 2].tolist(), strict=True):
            for u, v in _forest(np.unique(fp[i:i + n]), max_bits, bytes_shared):
                us.append(u)
                vs.append(v)
        u, v = np.concatenate(us), np.concatenate(vs)
        if len(u):
            yield out(0, u, v)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_k, held_f, passing = np.empty(0, np.int64), np.empty(0, np.uint64), None
        for b in batches:
            k = b.column(0).to_numpy(zero_copy_only=False)
            f = b.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            k, f = np.concatenate((held_k, k)), np.concatenate((held_f, f))
            if passing is not None:  # the rest of a long list
                n = int(np.searchsorted(k != passing, True)) if len(k) else 0
                if n:
                    yield out(1, k[:n], f[:n])
                k, f = k[n:], f[n:]
                passing = None if len(k) else passing
            open_from = int(np.flatnonzero(k != k[-1])[-1]) + 1 if len(k) and k[0] != k[-1] else 0
            if open_from:  # all lists but the last have ended
                yield from _split(k[:open_from], f[:open_from])
            held_k, held_f = k[open_from:], f[open_from:]
            if len(held_k) > largest:
                yield out(1, held_k, held_f)
                passing = held_k[0]
                held_k, held_f = held_k[:0], held_f[:0]
        if len(held_k):
            yield from _split(held_k, held_f)

    def _split(k: np.ndarray, f: np.ndarray) -> Iterator[pa.RecordBatch]:
        _, at, size = np.unique(k, return_inverse=True, return_counts=True)
        long = size[at] > largest
        if long.any():
            yield out(1, k[long], f[long])
        if not long.all():
            yield from edges_of(k[~long], f[~long])

    return run


def linked(nodes: DataFrame, max_bits: int = 4, largest: int = 4096) -> DataFrame:
    """``nodes(fp)``, distinct -> ``edges(u, v)`` with the components of all links.

    Not every link is returned (a dense group has as many as its square), but any two
    linked fingerprints are connected by the edges. A list of more than ``largest``
    fingerprints is cut into blocks, and every pair of blocks is one group, so that its
    work spreads over tasks; nothing is dropped.
    """
    bytes_shared = 8 - max_bits
    if not 0 < bytes_shared <= 8:
        raise ValueError("eight bytes bound the distance to 0..7 bits")
    run = _lists_to_edges(max_bits, bytes_shared, largest)
    found = saved(_postings(nodes, bytes_shared).repartition("key").sortWithinPartitions("key")
                  .mapInArrow(run, "kind int, a long, b long"))
    edges = found.where("kind = 0").select(F.col("a").alias("u"), F.col("b").alias("v"))
    over = found.where("kind = 1").select(F.col("a").alias("key"), F.col("b").alias("fp"))
    sizes = over.groupBy("key").agg(F.ceil(F.count("*") / F.lit(largest / 2)).cast("int").alias("blocks"))
    if sizes.isEmpty():
        return edges
    block = F.pmod(F.xxhash64(F.lit(7), "fp"), "blocks").cast("int")
    cells = (over.join(sizes, "key").withColumn("block", block)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select(F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other")).alias("key"), "fp"))
    # a cell holds two blocks of about largest/2 rows; twice that never happens by hashing
    more = (cells.repartition("key").sortWithinPartitions("key")
            .mapInArrow(_lists_to_edges(max_bits, bytes_shared, 1 << 62), "kind int, a long, b long"))
    return edges.union(more.select(F.col("a").alias("u"), F.col("b").alias("v")))


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """``(doc_id, text_key, fp, component_id, winner_key)``, one row for each row of ``docs``.

    Args: ``docs`` with ``doc_id`` and ``text``; other columns are not read.
    ``component_id`` is the smallest doc_id of the rows reachable over links of at most
    ``max_bits`` bits, and (component_id, winner_key) names the row that stands for them.
    Equal fingerprints are joined first, so a group of copies is one node of the graph.

    Null and empty texts have fingerprint 0 and are linked like any other. A row with a
    null doc_id takes part; it names a component only where all its ids are null.
    Repeated rows get equal results. No rows in: no rows out.
    """
    rows = saved(fingerprints(docs, shingle))
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("text_key"))).alias("first")
    nodes = saved(rows.groupBy("fp").agg(first))
    roots = components(linked(nodes.select("fp"), max_bits))
    of_node = nodes.join(roots, nodes["fp"] == roots["u"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    of_root = of_node.groupBy("root").agg(F.min("first").alias("first"))
    label = of_node.select("fp", "root").join(of_root, "root").select(
        "fp", F.col("first.doc_id").alias("component_id"), F.col("first.text_key").alias("winner_key"))
    return rows.join(label, "fp").select("doc_id", "text_key", "fp", "component_id", "winner_key")
