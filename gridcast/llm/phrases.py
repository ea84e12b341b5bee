"""Operator 13: phrase collocations from one count of the longest windows.

At every word of a piece one window of four words begins, padded with nulls behind the
piece's end. Only these windows are counted; the count of every shorter phrase is the sum
over the windows that begin with it, which ``ROLLUP(lang, w1, w2, w3, w4)`` gives for all
lengths at once.

Most windows occur once or twice and belong to no phrase of ``min_count``. So they move
in a compact form: a task counts the windows of a few megabytes of text at a time, sorts
them by their first two words and hands on, for each bucket of such pairs, one compressed
block of lines; words go the same way. A bucket's blocks are merged in one task. There the
count of a pair is known, and of a pair with three words; a window behind a rarer one is
padded from there on, as no phrase of ``min_count`` reaches further. Sums for phrases of
``min_count`` and more stay exact, and the ROLLUP sees few rows. Windows that are padded
behind their first word are not listed at all: the word's whole count is one row, and what
is listed of it is taken off in another (a row with a negative count).

A pair that holds a large share of the windows counted together is dealt over buckets by
its other words; it is frequent already there, so no bucket needs its whole count.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

LONGEST = 4
WORDS = [f"w{i}" for i in range(1, LONGEST + 1)]
#: Bytes of text whose windows are counted together; a pair with more than one in HOT_SHARE of them is dealt out.
CHUNK_BYTES, HOT_SHARE = 8 << 20, 256
#: Buckets for each shuffle partition: a task merges one bucket of one language at a time.
BUCKETS_A_PARTITION = 4
_NO_LANG = "und"
#: A piece ends at these bytes; the break mark is one of them, so no word can hold it.
_ENDS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes(ord("\n") if c in _ENDS else ord(" ") if c == 9 else c for c in range(256))


def _marked(text: str | None) -> bytes:
    """The text in lower case (A-Z), words parted by single blanks or more, pieces by line ends of their own."""
    return (text or "").encode().lower().translate(_TABLE).replace(b"\n", b" \n ")


def _text_block(lines: pa.Array, begins: np.ndarray, packer: zstandard.ZstdCompressor) -> list[bytes]:
    """The lines from each of ``begins`` to the next, as compressed blocks."""
    lists = pa.ListArray.from_arrays(pa.array(np.append(begins, len(lines)), pa.int32()), lines)
    return [packer.compress(text.as_buffer()) for text in pc.binary_join(lists, "\n")]


def count_windows(lang: str, chunk: bytes, min_count: int, buckets: int) -> list[tuple[int, str, bytes]]:
    """``(bucket, kind, block)`` of a marked text.

    Kind ``word``: lines ``word count``. Kinds ``pair`` and ``sure``: lines ``w1 w2``, its count
    and, for each window, ``w3 w4`` (with ``count:`` before it where it is not 1), parted by
    tabs. ``sure`` lines are those of pairs that are dealt out; such a pair leaves a line
    without windows in its own bucket.
    """
    tokens = [t for t in chunk.split(b" ") if t]
    known = sorted(set(tokens) - {b"\n"})
    if not known:
        return []
    place = {w: i for i, w in enumerate(known)}
    place[b"\n"] = -1
    code = np.fromiter(map(place.__getitem__, tokens), np.int64, len(tokens))
    padded = np.concatenate([code, np.full(LONGEST, -1)])
    cols = np.stack([padded[i:i + len(code)] for i in range(LONGEST)])
    for i in range(1, LONGEST):
        cols[i][cols[i - 1] < 0] = -1
    words = pa.array(known, pa.binary()).cast(pa.string())
    seed = zlib.crc32(lang.encode())
    hashes = np.fromiter((zlib.crc32(w, seed) for w in known), np.uint64, len(known))
    packer, out = zstandard.ZstdCompressor(level=3), []

    def hand_on(kind: str, bucket: np.ndarray, lines: pa.Array) -> None:
        order = np.argsort(bucket, kind="stable")
        at = bucket[order]
        begins = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        blocks = _text_block(lines.take(pa.array(order)), begins, packer)
        out.extend((int(at[b]), kind, block) for b, block in zip(begins, blocks, strict=True))

    counts = np.bincount(code[code >= 0], minlength=len(known))
    hand_on("word", (_mixed(hashes) % np.uint64(buckets)).astype(np.int64),
            pc.binary_join_element_wise(words, pa.array(counts).cast(pa.string()), "\t"))
    cols = cols[:, cols[1] >= 0]
    if not cols.shape[1]:
        return out
    base = len(known) + 1
    pair, rest = cols[0] * base + cols[1], (cols[2] + 1) * base + cols[3] + 1
    order = np.lexsort((rest, pair))
    pair, rest, cols = pair[order], rest[order], cols[:, order]
    first = np.flatnonzero(np.concatenate([[True], (pair[1:] != pair[:-1]) | (rest[1:] != rest[:-1])]))
    counts = np.diff(np.append(first, len(pair)))
    pair, rest, cols = pair[first], rest[first], cols[:, first]
    begins = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
    sizes = np.diff(np.append(begins, len(pair)))
    hot = (sizes * HOT_SHARE > len(pair)) & (np.add.reduceat(counts, begins) >= min_count)
    of_pair = np.repeat(np.arange(len(begins)), sizes)
    salt = np.where(hot[of_pair], 1 + (np.arange(len(pair)) - begins[of_pair]) * HOT_SHARE // len(pair), 0)
    rows = np.flatnonzero(np.concatenate([[True], (pair[1:] != pair[:-1]) | (salt[1:] != salt[:-1])]))
    third, fourth = (words.take(pa.array(c, pa.int64(), mask=c < 0)) for c in cols[2:])
    spelled = pc.if_else(pc.is_null(fourth), pc.fill_null(third, ""), pc.binary_join_element_wise(third, fourth, " "))
    several = pa.array(np.where(counts > 1, counts, 0)).cast(pa.string())
    spelled = pc.if_else(pa.array(counts > 1), pc.binary_join_element_wise(several, spelled, ":"), spelled)
    entries = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.append(rows, len(pair)), pa.int32()), spelled), "\t")
    totals = pa.array(np.add.reduceat(counts, rows)).cast(pa.string())
    w1, w2 = cols[0][rows], cols[1][rows]
    heads = pc.binary_join_element_wise(words.take(pa.array(w1)), words.take(pa.array(w2)), " ")
    home = _mixed(hashes[w1] * np.uint64(0x9E3779B97F4A7C15) + hashes[w2])
    bucket = ((home + salt[rows].astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D)) % np.uint64(buckets)).astype(np.int64)
    lines = pc.binary_join_element_wise(heads, totals, entries, "\t")
    dealt = salt[rows] > 0
    if dealt.any():
        hand_on("sure", bucket[dealt], lines.filter(pa.array(dealt)))
        own = np.flatnonzero(dealt & np.concatenate([[True], pair[rows][1:] != pair[rows][:-1]]))
        hand_on("sure", (home[own] % np.uint64(buckets)).astype(np.int64),
                pc.binary_join_element_wise(heads.take(pa.array(own)), "0\t", "\t"))
    if not dealt.all():
        hand_on("pair", bucket[~dealt], lines.filter(pa.array(~dealt)))
    return out


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D) >> np.uint64(16)


def window_blocks(docs: DataFrame, min_count: int, buckets: int, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``(lang, bucket, kind, block)``: all words and windows of ``docs``, as of :func:`count_windows`."""
    def batch_of(lang: str, chunk: bytes) -> pa.RecordBatch:
        found = count_windows(lang, chunk, min_count, buckets)
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(found), pa.string()), pa.array([f[0] for f in found], pa.int32()),
             pa.array([f[1] for f in found], pa.string()), pa.array([f[2] for f in found], pa.binary())],
            ["lang", "bucket", "kind", "block"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}
        for b in batches:
            for lang, text in zip(b.column(0), b.column(1), strict=True):
                lang, marked = lang.as_py(), _marked(text.as_py())
                held.setdefault(lang, []).append(marked)
                sizes[lang] = sizes.get(lang, 0) + len(marked)
                if sum(sizes.values()) >= chunk_bytes:  # the largest goes, however many languages there are
                    largest = max(sizes, key=sizes.get)
                    yield batch_of(largest, b" \n ".join(held.pop(largest)))
                    del sizes[largest]
        for lang, parts in held.items():
            yield batch_of(lang, b" \n ".join(parts))

    return (docs.select(F.coalesce("lang", F.lit(_NO_LANG)).alias("lang"), "text")
            .mapInArrow(run, "lang string, bucket int, kind string, block binary"))


def _lines(blocks: list, fields: int) -> list[pa.Array]:
    """The lines of blocks, parted at their first tabs into ``fields`` columns."""
    reader = zstandard.ZstdDecompressor()
    text = pa.array([reader.decompress(b.as_buffer()) for b in blocks], pa.binary()).cast(pa.string())
    lines = pc.list_flatten(pc.split_pattern(text, "\n"))
    flat = pc.list_flatten(pc.split_pattern(lines, "\t", max_splits=fields - 1))
    return [flat.take(pa.array(np.arange(i, len(flat), fields))) for i in range(fields)]


def merge_blocks(lang: str, kinds: list[str], blocks: list, min_count: int) -> pa.Table:
    """``(lang, w1 .. w4, n)`` of the blocks of one bucket: whole counts of its words, the windows of frequent pairs,
    and those taken off their first word's count."""
    of_kind = {k: [b for kind, b in zip(kinds, blocks, strict=True) if kind == k] for k in ("word", "pair", "sure")}
    parts = []

    def rows(n: pa.Array, *words: pa.Array) -> None:
        none = pa.nulls(len(n), pa.string())
        columns = [w.cast(pa.string()) for w in words] + [none] * (LONGEST - len(words))
        parts.append(pa.table([pa.array([lang] * len(n), pa.string()), *columns, n.cast(pa.int64())], ["lang", *WORDS, "n"]))

    if of_kind["word"]:
        word, n = _lines(of_kind["word"], 2)
        t = pa.table({"w": word, "n": n.cast(pa.int64())}).group_by("w").aggregate([("n", "sum")])
        rows(t["n_sum"].combine_chunks(), t["w"].combine_chunks())
    listed = [_lines(of_kind[k], 3) for k in ("pair", "sure") if of_kind[k]]
    if listed:
        head, total, entries = (pa.concat_arrays(c) for c in zip(*listed, strict=True))
        sure = pc.unique(_lines(of_kind["sure"], 3)[0]) if of_kind["sure"] else head.slice(0, 0)
        t = pa.table({"h": head, "n": total.cast(pa.int64())}).group_by("h").aggregate([("n", "sum")])
        frequent = pa.concat_arrays([t["h"].combine_chunks().filter(pc.greater_equal(t["n_sum"].combine_chunks(), min_count)), sure])
        here = pc.and_(pc.is_in(head, frequent), pc.not_equal(total, "0"))
        head, entries = head.filter(here), pc.split_pattern(entries.filter(here), "\t")
        window = pc.list_flatten(entries)
        head = head.take(pc.list_parent_indices(entries))
        split = pc.split_pattern(window, ":", max_splits=1)
        counted = pc.equal(pc.list_value_length(split), 2)
        n = pc.if_else(counted, pc.list_element(pc.if_else(counted, split, pa.scalar(["1", ""], split.type)), 0), "1").cast(pa.int64())
        window = pc.if_else(counted, pc.list_element(pc.if_else(counted, split, pa.scalar(["1", ""], split.type)), 1), window)
        t = pa.table({"h": head, "w": window, "n": n}).group_by(["h", "w"]).aggregate([("n", "sum")])
        head, window, n = (t[c].combine_chunks() for c in ("h", "w", "n_sum"))
        # behind a rare third word the window is padded
        third = pc.list_element(pc.split_pattern(pc.binary_join_element_wise(window, "", " "), " ", max_splits=1), 0)
        t = pa.table({"h": head, "w": third, "n": n}).group_by(["h", "w"]).aggregate([("n", "sum")])
        keys = pc.binary_join_element_wise(t["h"].combine_chunks(), t["w"].combine_chunks(), " ")
        deep = pc.or_(pc.is_in(pc.binary_join_element_wise(head, third, " "), keys.filter(
            pc.greater_equal(t["n_sum"].combine_chunks(), min_count))), pc.is_in(head, sure))
        window = pc.if_else(deep, window, "")
        both = pc.split_pattern(head, " ")
        two = pc.split_pattern(pc.binary_join_element_wise(window, "", " "), " ")
        found = [pc.list_element(both, 0), pc.list_element(both, 1), pc.list_element(two, 0),
                 pc.list_element(pc.split_pattern(pc.binary_join_element_wise(window, " ", ""), " "), 1)]
        empty = pa.scalar(None, pa.string())
        found[2:] = [pc.if_else(pc.equal(w, ""), empty, w) for w in found[2:]]
        rows(n, *found)
        rows(pc.negate(n), found[0])
    return pa.concat_tables(parts).group_by(["lang", *WORDS]).aggregate([("n", "sum")]).select(
        ["lang", *WORDS, "n_sum"]).rename_columns(["lang", *WORDS, "n"]) if parts else pa.table(
        [pa.array([], pa.string())] * (LONGEST + 1) + [pa.array([], pa.int64())], ["lang", *WORDS, "n"])


def phrase_counts(docs: DataFrame, min_count: int) -> tuple[DataFrame, DataFrame]:
    """``(lang, phrase, m, f)`` of every phrase of at most LONGEST words with ``f >= min_count``, and ``(lang, n)``."""
    buckets = BUCKETS_A_PARTITION * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def merge(key: tuple, blocks: pa.Table) -> pa.Table:
        return merge_blocks(key[0].as_py(), blocks["kind"].to_pylist(), blocks["block"].combine_chunks(), min_count)

    longest = (window_blocks(docs, min_count, buckets).groupBy("lang", "bucket")
               .applyInArrow(merge, ", ".join(["lang string", *[f"{w} string" for w in WORDS], "n long"])))
    sums = longest.rollup("lang", *WORDS).agg(F.sum("n").alias("f"), F.grouping_id().alias("g"))
    rows = sums.withColumn("m", (LONGEST - F.bit_count("g")).cast("int")).where("m >= 0")  # words grouped by, beside lang
    last_word = F.coalesce(*[F.when(F.col("m") == i + 1, F.col(w).isNotNull()) for i, w in enumerate(WORDS)])
    rows = saved(rows.where((F.col("m") == 0) | (last_word & (F.col("f") >= min_count)))
                 .select("lang", F.concat_ws(" ", *WORDS).alias("phrase"), "m", "f"))
    return rows.where("m > 0"), rows.where("m = 0").select("lang", F.col("f").alias("n"))


def _parts(phrase: Column, begin: Column, length: Column) -> Column:
    return F.array_join(F.slice(phrase, begin, length), " ")


def collocations(docs: DataFrame, min_count: int = 30, contained_pct: int = 80, top: int = 2000) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's first ``top`` phrases of 2 to 4 words.

    Words are what blanks and tabs part inside pieces that end at ``. , ; : ! ?`` or a line
    end, A-Z in lower case. A phrase with ``a >= min_count`` occurrences is a candidate;
    behind each of its words it may be cut into parts with ``l`` and ``r`` occurrences, and
    the cut with the lowest ``floor(2000000 a / (l + r))`` is its score (the first of equal
    ones). A candidate that lies in a longer one with ``100 f >= contained_pct a`` goes.
    Order: score and a descending, phrase by bytes. Null lang is ``und``; null and empty
    texts have no words; rows that repeat count each. No words: no rows.
    """
    counts, totals = phrase_counts(docs, min_count)
    words = F.split("phrase", " ")
    candidates = counts.where("m >= 2").select("lang", "phrase", "m", F.col("f").alias("a"), words.alias("ws"))
    cuts = candidates.select("lang", "phrase", "a", "m", "ws", F.explode(F.sequence(F.lit(1), F.col("m") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", _parts(F.col("ws"), F.lit(1), F.col("k")).alias("head"),
        _parts(F.col("ws"), F.col("k") + 1, F.col("m") - F.col("k")).alias("tail"))

    def count_of(part: str, name: str) -> DataFrame:
        return counts.select(F.col("lang").alias(f"{part}_lang"), F.col("phrase").alias(f"{part}_phrase"), F.col("f").alias(name))

    for part, name in (("head", "l"), ("tail", "r")):
        cuts = cuts.join(count_of(part, name), (F.col("lang") == F.col(f"{part}_lang")) & (F.col(part) == F.col(f"{part}_phrase")))
    # 38 digits: no product or sum of counts can overflow
    wide = "CAST(a AS DECIMAL(20, 0)) * 2000000 DIV (CAST(l AS DECIMAL(20, 0)) + CAST(r AS DECIMAL(20, 0)))"
    scored = (cuts.select("lang", "phrase", "a", F.struct(F.expr(wide).alias("score"), "k", "l", "r").alias("c"))
              .groupBy("lang", "phrase", "a").agg(F.min("c").alias("c")))
    places = F.expr("flatten(transform(sequence(2, m - 1), j -> transform(sequence(1, m - j + 1), i -> struct(i, j))))")
    inner = candidates.where("m >= 3").select("lang", "ws", "a", F.explode(places).alias("x")).select(
        F.col("lang").alias("in_lang"), _parts(F.col("ws"), F.col("x.i"), F.col("x.j")).alias("in_phrase"), F.col("a").alias("f"))
    inner = inner.groupBy("in_lang", "in_phrase").agg(F.max("f").alias("f"))
    hidden = F.col("f").cast("decimal(20,0)") * 100 >= F.col("a").cast("decimal(20,0)") * contained_pct
    left = (scored.join(inner, (F.col("lang") == F.col("in_lang")) & (F.col("phrase") == F.col("in_phrase")), "left")
            .where(F.col("f").isNull() | ~hidden)
            .select("lang", "phrase", "a", F.col("c.score").alias("score"), F.col("c.l").alias("l"), F.col("c.r").alias("r")))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    some = F.pmod(F.xxhash64("phrase"), F.lit(64))  # first the best of 64 shares of a language, then of those
    best = (left.withColumn("__share", some)
            .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "__share").orderBy(*order)))
            .where(F.col("rank") <= top)
            .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top))
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
