"""Operator 11: token ids in binary files, each document compressed alone with one shared dictionary.

A text is encoded by the ``tokenizers`` library and closed by an end id. Ids are
serialized as little-endian unsigned integers of 2 bytes where the vocabulary fits them,
else of 4. A zstandard dictionary trained on a bounded sample of serialized documents makes
short documents small although each is a frame of its own. Documents go to shard files in
ascending doc_id order; a shard file is

    magic ``TIDZ1\\n``, SHA-256 of the dictionary, width, number of documents (u32), their ids (u64),
    smallest and largest doc_id (i64; 1 and 0 where all are null),
    for each document: length of its frame (u32) and number of its ids (u64),
    for each document: is its id null (u8) and its id (i64),
    the frames, and one newline byte.

So one document is read by two ranged reads (head and frame), see :func:`read_document`.
Beside the shards lie the dictionary (``dictionary``) and one row per shard
(``manifest``: its place, its doc_id range, its ids and the ids of all shards before).
Spark's own writers write everything, so any store will do and a lost task leaves nothing.
"""

from __future__ import annotations

import hashlib
import json
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import saved, saved_folder

MAGIC = b"TIDZ1\n"
_HEAD = struct.Struct("<6s32sBIQqq")
END_ID = 1
#: The dictionary: its size, the number of documents it is trained on and the bytes of each that are looked at.
DICTIONARY_BYTES, SAMPLE_DOCS, SAMPLE_BYTES = 64 << 10, 2_000, 4 << 10
SHARD_BYTES = 8 << 20
#: ASCII signs that end words: none is a letter, a digit or an apostrophe, so a run of them is one part.
_SIGNS = b".,;:!?*#$%&|\"()[]{}<>/\\^_`~@+-="
_CACHED_WORDS, _CACHED_PARTS, _CACHED_BYTES = 250_000, 200_000, 48

# --- encoding ------------------------------------------------------------------------------

#: Fixed values of the tokenizer family whose words can be encoded one by one: its normalizers and its pattern.
_WORDWISE_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
                         {"type": "Lowercase"}]
_WORDWISE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Characters whose class, lower case and normal form are the same in every version of Unicode in use
#: (Latin letters and punctuation; U+00A0, U+00AD and U+0130 are left to the library).
_PLAIN, _LAST_PLAIN = regex.compile("[\x21-\x7e¡-¬®-įı-ſ]+"), "ſ"


class Encoder:
    """Ids of texts, as the library gives them with ``add_special_tokens=False``, and the end id.

    Where the tokenizer drops blanks and cuts at them (``word_wise``), ids of words seen
    are kept in a bounded table, and a new word of plain characters goes to the library's
    model part by part; every other word goes through the library as it is. Any other
    tokenizer gets whole texts. Both ways give the same ids (tests).
    """

    def __init__(self, definition: str, end_id: int = END_ID):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_str(definition)
        self.model = self.tokenizer.model
        spec = json.loads(definition)
        top = max([self.tokenizer.get_vocab_size(with_added_tokens=True) - 1, end_id,
                   *(t["id"] for t in spec.get("added_tokens", []))])
        self.dtype = np.dtype("<u2" if top < 1 << 16 else "<u4")
        self.end = np.array([end_id], self.dtype).tobytes()
        self.added = [t["content"] for t in spec.get("added_tokens", [])]
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        self.word_wise = (
            (spec.get("normalizer") or {}).get("normalizers") == _WORDWISE_NORMALIZERS and len(steps) == 2
            and steps[0].get("pattern") == {"Regex": _WORDWISE_PATTERN} and steps[0].get("invert") is True
            and steps[0].get("behavior") == "Removed" and steps[1]["type"] == "ByteLevel"
            and not steps[1]["use_regex"] and not steps[1]["add_prefix_space"]
            and not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in spec.get("added_tokens", []))
            and not any(a.rstrip(_SIGNS.decode()).isalpha() for a in self.added))
        self.byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.pattern = regex.compile(_WORDWISE_PATTERN)
        self.shown = _Shown(self.byte_level)
        self.packs = [struct.Struct(f"<{i}{'H' if self.dtype.itemsize == 2 else 'I'}").pack for i in range(32)]
        self.parts = _Kept(self.part, _CACHED_PARTS)
        self.words = _Kept(self.word, _CACHED_WORDS)  # of bytes.split, which parts exactly at the ASCII blanks

    def _pack(self, ids) -> bytes:
        return np.array(ids, self.dtype).tobytes()

    def part(self, part: bytes) -> bytes:
        """Ids of one part, which the library's pre-tokenizer would not cut further, in lower case."""
        shown = part.decode()
        if not part.isascii():
            shown = "".join(map(self.shown.__getitem__, shown))
        ids = [t.id for t in self.model.tokenize(shown)]
        return self.packs[len(ids)](*ids) if len(ids) < len(self.packs) else self._pack(ids)

    def word(self, word: bytes) -> bytes:
        low = word.lower()  # A-Z
        core = low.rstrip(_SIGNS)
        letters = core
        if not core.isalpha():  # a-z
            plain = core.decode().lower()
            if not plain.isalpha() or max(plain) > _LAST_PLAIN:
                return self._mixed_word(word.decode())
            letters = plain.encode()
        ids = self.parts[letters]
        return ids if len(core) == len(low) else ids + self.parts[low[len(core):]]

    def _mixed_word(self, text: str) -> bytes:
        if _PLAIN.fullmatch(text) and not any(a in text for a in self.added):
            return b"".join([self.parts[p.encode()] for p in self.pattern.findall(text.lower())])
        return self._pack(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def text(self, text: bytes) -> bytes:
        """The serialized ids of a text in UTF-8 and the end id."""
        if self.word_wise:
            return b"".join(map(self.words.__getitem__, text.split())) + self.end
        return self._pack(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids) + self.end


class _Shown(dict):
    """How the library's byte level writes a character."""

    def __init__(self, byte_level):
        super().__init__()
        self.byte_level = byte_level

    def __missing__(self, char: str) -> str:
        self[char] = shown = "".join(s for s, _ in self.byte_level.pre_tokenize_str(char))
        return shown


class _Kept(dict):
    """Results of ``make`` for short keys seen lately: a full table is set aside, and what is asked for again comes back from it."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most, self.aside = make, most, {}

    def __missing__(self, key: bytes) -> bytes:
        ids = self.aside.get(key)
        if ids is None:
            ids = self.make(key)
            if len(key) > _CACHED_BYTES:
                return ids
        if len(self) >= self.most:
            self.aside = dict(self)
            self.clear()
        self[key] = ids
        return ids


@lru_cache(1)
def _encoder(definition: str, end_id: int) -> Encoder:
    """One encoder a worker, so that its table of words outlives a task."""
    return Encoder(definition, end_id)


def load_tokenizer(path: str | None = None) -> str:
    """The definition of a tokenizer, read by the driver; by default the public word-end BPE."""
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode(docs: DataFrame, definition: str, end_id: int = END_ID) -> DataFrame:
    """``(doc_id, ids, row)`` for each row of ``docs``: serialized ids, and a number that tells equal rows apart.

    The definition is broadcast; its size is that of the tokenizer, whatever the data.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(definition)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value, end_id)
        for b in batches:
            ids = pa.array((encoder.text(t) for t in b.column(1).cast(pa.binary()).fill_null(b"").to_pylist()), pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), ids], ["doc_id", "ids"])

    return (docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, ids binary")
            .withColumn("row", F.monotonically_increasing_id()))


def train_dictionary(encoded: DataFrame, width: int, size: int = DICTIONARY_BYTES, docs: int = SAMPLE_DOCS,
                     looked_at: int = SAMPLE_BYTES) -> bytes:
    """A zstandard dictionary from at most ``docs`` documents of ``encoded``, chosen by a hash.

    Of a long document a stretch of ``looked_at`` bytes at a hashed place counts; so at
    most ``docs * looked_at`` bytes reach the driver. Where they are too few to train
    on, they are the dictionary themselves; without documents it is empty.
    """
    n = F.octet_length("ids")
    at = F.pmod(F.xxhash64(F.lit(3), "row"), F.greatest(n - F.lit(looked_at), F.lit(0)) + 1)
    start = (F.floor(at / width) * width + 1).cast("int")
    h, share = F.xxhash64(F.lit(5), "row"), 1.5 * docs / max(encoded.count(), 1)
    few = encoded.where(F.pmod(h, F.lit(1 << 30)) < int(min(share, 1.0) * (1 << 30)))  # so that tasks send few rows
    rows = few.select(h.alias("h"), F.substring(F.col("ids"), start, F.lit(looked_at)).alias("s")).orderBy("h", "s").limit(docs).collect()
    samples = [bytes(r["s"]) for r in rows]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[-size:]


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


# --- shards --------------------------------------------------------------------------------

def pack_shard(doc_ids: list, counts: list[int], frames: list[bytes], dictionary: bytes, width: int) -> bytes:
    """The bytes of a shard file, but for the newline that the text writer adds."""
    known = [d for d in doc_ids if d is not None] or [1, 0]
    head = _HEAD.pack(MAGIC, hashlib.sha256(dictionary).digest(), width, len(frames), sum(counts), known[0], known[-1])
    return b"".join([
        head, np.array([len(f) for f in frames], "<u4").tobytes(), np.array(counts, "<u8").tobytes(),
        np.array([d is None for d in doc_ids], "u1").tobytes(), np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
        *frames])


@dataclass(frozen=True)
class ShardIndex:
    """Head of a shard file: its documents, where their frames lie and how many ids they have."""

    dictionary_sha256: bytes
    width: int
    doc_ids: list
    counts: np.ndarray
    begins: np.ndarray  # offsets of the frames in the file, and the end of the last

    @staticmethod
    def size(head: bytes) -> int:
        """Bytes of the whole index, from the first :data:`_HEAD` bytes."""
        return _HEAD.size + 21 * _HEAD.unpack(head[:_HEAD.size])[3]

    @classmethod
    def read(cls, data: bytes) -> "ShardIndex":
        magic, digest, width, n = _HEAD.unpack(data[:_HEAD.size])[:4]
        if magic != MAGIC:
            raise ValueError("not a shard of token ids")
        at = _HEAD.size
        lengths = np.frombuffer(data, "<u4", n, at)
        counts = np.frombuffer(data, "<u8", n, at + 4 * n).astype(np.int64)
        nulls = np.frombuffer(data, "u1", n, at + 12 * n)
        ids = np.frombuffer(data, "<i8", n, at + 13 * n)
        begins = at + 21 * n + np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
        return cls(digest, width, [None if z else int(i) for z, i in zip(nulls, ids, strict=True)], counts, begins)

    def ids(self, frame: bytes, reader: zstandard.ZstdDecompressor) -> np.ndarray:
        return np.frombuffer(reader.decompress(frame), f"<u{self.width}")


def write_token_files(encoded: DataFrame, dictionary: bytes, width: int, folder: str, partitions: int | None = None,
                      shard_bytes: int = SHARD_BYTES, level: int = 3) -> None:
    """Write the documents of ``encoded`` to ``folder`` in ascending doc_id order (nulls last), as shard files.

    Documents are range-partitioned by (doc_id, a hash of the ids, row), so rows that share
    an id, null included, are spread as well. A task streams its sorted documents into
    shards of about ``shard_bytes``; a longer document is a shard of its own.
    """
    spark = encoded.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").isNull(), F.col("doc_id"), F.xxhash64("ids"), F.col("row")]
    in_order = encoded.repartitionByRange(partitions, *order).sortWithinPartitions(*order).select("doc_id", "ids")
    shared = spark.sparkContext.broadcast(dictionary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, known = TaskContext.get().partitionId(), _dictionary(shared.value)
        if known:
            known.precompute_compress(level=level)  # else each document would read the dictionary anew
        packer = zstandard.ZstdCompressor(level=level, dict_data=known, write_content_size=True)
        ids, counts, frames, size, seq = [], [], [], 0, 0

        def shard() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()),
                 pa.array([pack_shard(ids, counts, frames, shared.value, width)], pa.binary())], ["part", "seq", "blob"])

        for b in batches:
            for doc_id, raw in zip(b.column(0), b.column(1), strict=True):
                data = raw.as_py()
                ids.append(doc_id.as_py())
                counts.append(len(data) // width)
                frames.append(packer.compress(data))
                size += len(frames[-1]) + 21
                if size >= shard_bytes:
                    yield shard()
                    ids, counts, frames, size, seq = [], [], [], 0, seq + 1
        if frames:
            yield shard()

    blobs = in_order.mapInArrow(run, "part int, seq int, blob binary")
    # the text writer puts the bytes of a string as they are and ends the row with a newline
    (blobs.select("part", "seq", F.col("blob").cast("string").alias("value"))
     .write.partitionBy("part", "seq").text(f"{folder}/shards"))
    spark.createDataFrame([(bytearray(dictionary),)], "dictionary binary").coalesce(1).write.parquet(f"{folder}/dictionary")
    heads = (_shard_files(spark, folder).select("part", "seq", F.substring("content", 1, _HEAD.size))
             .mapInArrow(_shard_heads, "part int, seq int, first_doc long, last_doc long, n_docs long, n_tokens long"))
    _with_starts(heads).write.parquet(f"{folder}/manifest")


def _shard_files(spark: SparkSession, folder: str) -> DataFrame:
    # places are read from the path, as a folder without shards has no such columns
    return (spark.read.format("binaryFile").load(f"{folder}/shards")
            .select(*[F.regexp_extract("path", r"part=(\d+)/seq=(\d+)/", i).cast("int").alias(c) for i, c in ((1, "part"), (2, "seq"))], "content"))


def _shard_heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        heads = [_HEAD.unpack(h.as_py()) for h in b.column(2)]
        found = [pa.array([h[i] for h in heads], pa.int64()) for i in (5, 6, 3, 4)]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *found],
                                         ["part", "seq", "first_doc", "last_doc", "n_docs", "n_tokens"])


def _with_starts(heads: DataFrame) -> DataFrame:
    """``start`` of each shard: the ids of all shards before, by sums per range and inside a range."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range partition
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    ranges = heads.groupBy("part").agg(F.sum("n_tokens").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0).cast("long")).alias("__first"))
    own = F.coalesce(F.sum("n_tokens").over(inside), F.lit(0).cast("long"))
    return heads.withColumn("__own", own).join(ranges, "part").select(
        *heads.columns, (F.col("__first") + F.col("__own")).alias("start"))


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, from the files alone.

    ``ids_crc32`` is of the ids as little-endian unsigned 32-bit integers. The hash of the
    dictionary is compared in every shard.
    """
    dictionary = read_dictionary(spark, folder)
    shared = spark.sparkContext.broadcast(dictionary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = hashlib.sha256(shared.value).digest()
        reader = zstandard.ZstdDecompressor(dict_data=_dictionary(shared.value))
        for b in batches:
            for part, seq, content in zip(*b.columns, strict=True):
                data = memoryview(content.as_buffer())
                index = ShardIndex.read(data)
                if index.dictionary_sha256 != digest:
                    raise ValueError("the shard was written with another dictionary")
                n = len(index.doc_ids)
                found = [index.ids(data[index.begins[i]:index.begins[i + 1]], reader) for i in range(n)]
                if any(len(f) != c for f, c in zip(found, index.counts, strict=True)):
                    raise ValueError("a frame does not hold the ids that its index names")
                crcs = [zlib.crc32(f.astype("<u4").tobytes()) for f in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.as_py()] * n, pa.int32()), pa.array([seq.as_py()] * n, pa.int32()),
                     pa.array(index.doc_ids, pa.int64()), pa.array(np.cumsum(index.counts) - index.counts, pa.int64()),
                     pa.array(index.counts, pa.int64()), pa.array(crcs, pa.int64())],
                    ["part", "seq", "doc_id", "own", "n_tokens", "ids_crc32"])

    rows = _shard_files(spark, folder).mapInArrow(
        run, "part int, seq int, doc_id long, own long, n_tokens long, ids_crc32 long")
    shards = spark.read.parquet(f"{folder}/manifest").select("part", "seq", "start")
    return rows.join(shards, ["part", "seq"]).select(
        "doc_id", (F.col("start") + F.col("own")).alias("start"), "n_tokens", "ids_crc32")


def read_dictionary(spark: SparkSession, folder: str) -> bytes:
    return bytes(spark.read.parquet(f"{folder}/dictionary").first()["dictionary"])


def read_document(spark: SparkSession, folder: str, doc_id: int) -> list[list[int]]:
    """Ids of the documents with ``doc_id``: the manifest names the shards, and of each file only the
    index and the frames asked for are read, at their offsets."""
    shards = (spark.read.parquet(f"{folder}/manifest").where(F.lit(doc_id).between(F.col("first_doc"), F.col("last_doc")))
              .orderBy("part", "seq").collect())  # one, or the few that rows of one id fill
    reader = zstandard.ZstdDecompressor(dict_data=_dictionary(read_dictionary(spark, folder)))
    jvm, conf, out = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), []
    for s in shards:
        place = jvm.org.apache.hadoop.fs.Path(f"{folder}/shards/part={s['part']}/seq={s['seq']}")
        fs = place.getFileSystem(conf)
        path = next(f.getPath() for f in fs.listStatus(place) if f.getPath().getName().startswith("part-"))

        def read(at: int, n: int, fs=fs, path=path) -> bytes:
            source = fs.open(path)
            try:
                source.seek(at)
                return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(source, n))
            finally:
                source.close()

        index = ShardIndex.read(read(0, ShardIndex.size(read(0, _HEAD.size))))
        for i, d in enumerate(index.doc_ids):
            if d == doc_id:
                begin, end = int(index.begins[i]), int(index.begins[i + 1])
                out.append(index.ids(read(begin, end - begin), reader).tolist())
    return out


def token_files(docs: DataFrame, definition: str, folder: str | None = None, end_id: int = END_ID) -> str:
    """Encode ``docs``, train the dictionary, write the files and return their folder.

    Needs doc_id (an integer) and text; other columns are not read. A null or empty text
    is its end id alone. Null doc_ids come last. Rows that share an id are written each,
    in the order of a hash of their ids. No rows in: a folder without shards. Without
    ``folder``, one in the shared folder that goes when the driver ends.
    """
    spark = docs.sparkSession
    width = Encoder(definition, end_id).dtype.itemsize
    encoded = saved(encode(docs.withColumn("doc_id", F.col("doc_id").cast("long")), definition, end_id))
    folder = folder or saved_folder(spark)
    write_token_files(encoded, train_dictionary(encoded, width), width, folder)
    return folder
