"""Token files, fill-in-the-middle over frames and phrases against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from gridcast.llm import fim, phrases, token_files

from .helpers import awkward, documents, empty

# --- op11 ----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def definition():
    return token_files.load_tokenizer()


@pytest.fixture(scope="module")
def encoder(definition):
    return token_files.Encoder(definition)


@lru_cache(1)
def library(definition):
    from tokenizers import Tokenizer
    return Tokenizer.from_str(definition)


def plain_ids(definition, text):
    return [*library(definition).encode(text or "", add_special_tokens=False).ids, 1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=12), st.sampled_from(
    ["don't", "I'LL", "x'S", "É", "é", "İi", "ŉ", "ſt", "µm²", "½", "a<|endoftext|>b", "<|endoftext|", "\x1c", "\x85", " ", "­",
     " ", "́", "각", "ΑΣ", "ǅ", "١٢", "中文", "\x00", "﻿", "l'été", "...!?", "12345", "K", "Å", "ẞx", "ẞ*", "Ça,", "Ça|", "ŉ!"])), max_size=8),
    st.sampled_from([" ", "  ", "\n", "\t", "\r\n", ""]))
def test_word_by_word_ids_are_the_librarys(encoder, words, gap):
    text = gap.join(words)
    ids = encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert encoder.word_wise
    assert np.frombuffer(encoder.text(text.encode()), encoder.dtype).tolist() == [*ids, 1]


def test_a_tokenizer_of_another_kind_gets_whole_texts():
    import public_tokenizers
    other = token_files.Encoder(token_files.load_tokenizer(public_tokenizers.path("byte_bpe_50k.json")))
    assert not other.word_wise
    text = "  Two  blanks\n and é "
    assert np.frombuffer(other.text(text.encode()), other.dtype).tolist() == [*other.tokenizer.encode(text, add_special_tokens=False).ids, 1]


def test_files_round_trip_in_order(spark, definition):
    rows = [(i * 7919 % 400, f"word{i % 13} " * (i % 50)) for i in range(400)] + [(3, "twice"), (3, "twice"), (None, "no id"), (None, None)]
    encoded = token_files.encode(documents(spark, rows), definition)
    dictionary = token_files.train_dictionary(encoded, 2, size=4096, docs=200)
    folder = token_files.saved_folder(spark)
    token_files.write_token_files(encoded, dictionary, 2, folder, partitions=5, shard_bytes=2048)
    out = [tuple(r) for r in token_files.read_token_files(spark, folder).orderBy("start").collect()]
    assert [r[0] for r in out] == sorted((r[0] for r in rows if r[0] is not None)) + [None, None]
    texts = {}
    for d, t in rows:
        ids = plain_ids(definition, t)
        texts.setdefault(d, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    at = 0
    for doc_id, start, n, crc in out:
        assert start == at
        texts[doc_id].remove((n, crc))
        at += n
    assert spark.read.parquet(f"{folder}/manifest").count() > 5  # small shards, several a task
    assert sorted(token_files.read_document(spark, folder, 3)) == sorted(plain_ids(definition, t) for d, t in rows if d == 3)
    assert token_files.read_document(spark, folder, 10**9) == []


def test_short_documents_gain_from_the_dictionary(spark, definition):
    rows = [(i, f"the licence of item {i} is granted without any warranty to all who ask for it") for i in range(600)]
    encoded = token_files.encode(documents(spark, rows), definition)
    dictionary = token_files.train_dictionary(encoded, 2, size=8192)
    data = bytes(encoded.first()["ids"])
    alone = len(zstandard.ZstdCompressor().compress(data))
    primed = len(zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary)).compress(data))
    assert primed < alone


def test_another_dictionary_is_refused(spark, definition):
    folder = token_files.token_files(documents(spark, [(1, "a b c")]), definition)
    spark.createDataFrame([(bytearray(b"other"),)], "dictionary binary").write.mode("overwrite").parquet(f"{folder}/dictionary")
    with pytest.raises(Exception, match="another dictionary"):
        token_files.read_token_files(spark, folder).collect()


def test_token_files_awkward_and_empty(spark, definition):
    out = token_files.read_token_files(spark, token_files.token_files(awkward(spark), definition)).collect()
    assert len(out) == awkward(spark).count()
    for r in awkward(spark).select("doc_id", "text").collect():
        ids = plain_ids(definition, r["text"])
        assert any(o["doc_id"] == r["doc_id"] and o["n_tokens"] == len(ids)
                   and o["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes()) for o in out)
    assert token_files.read_token_files(spark, token_files.token_files(empty(spark), definition)).collect() == []


# --- op12 ----------------------------------------------------------------------------------


def plain_fim(doc_id, text, seed=7):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i:i + 8], 16) for i in (0, 8, 16, 24)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(t in text for t in ("<P>", "<S>", "<M>")):
        return n, "plain", None, None, text
    if h[3] % 100 < 50:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10**6), st.text(alphabet="ab\n\r <PSM>é中😀", max_size=120), st.sampled_from([1, 2, 3, 7, 64]))
def test_frames_of_any_size_give_the_plain_result(doc_id, text, frame_bytes):
    packer = zstandard.ZstdCompressor()
    store = fim.Store.of_text(text, packer, frame_bytes)
    done = fim.transform(store, doc_id, fim.Rule(), packer)
    output = b"".join(fim.stream(done["output"])).decode()
    assert (done["n"], done["form"], done["prefix_chars"], done["middle_chars"], output) == plain_fim(doc_id, text)
    assert b"".join(fim.restored(done["output"], done["form"])).decode() == text


def test_only_cut_frames_are_packed_anew():
    packer = zstandard.ZstdCompressor()
    store = fim.Store.of_text("".join(f"line {i}\n" for i in range(5000)), packer, 1024)
    done = fim.transform(store, 1, fim.Rule(), packer)
    kept = {id(f) for f in store.frames}
    assert sum(id(f) not in kept for f in done["output"]) <= 3 + 4  # marks and the halves of two cut frames
    whole = zstandard.ZstdDecompressor().stream_reader(b"".join(done["output"]), read_across_frames=True).read()
    assert hashlib.sha256(whole).hexdigest() == fim.sha256_of(fim.stream(done["output"]))


def test_fim_over_awkward_rows(spark):
    out = fim.fill_in_middle(fim.store_texts(awkward(spark), 4096)).drop("output").collect()
    want = Counter()
    for r in awkward(spark).select("doc_id", "text").collect():
        *head, output = plain_fim(r["doc_id"], r["text"])
        want[(r["doc_id"], *head, hashlib.sha256(output.encode()).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest())] += 1
    assert Counter(tuple(o) for o in out) == want
    assert fim.fill_in_middle(fim.store_texts(empty(spark))).collect() == []


def test_rate_and_share_of_forms():
    packer = zstandard.ZstdCompressor()
    forms = Counter(fim.transform(fim.Store.of_text("a\nb\n", packer), i, fim.Rule(rate=40, spm=100), packer)["form"] for i in range(500))
    assert set(forms) == {"plain", "spm"} and 150 < forms["spm"] < 250


# --- op13 ----------------------------------------------------------------------------------


def plain_phrases(rows, min_count, pct=80, top=2000):
    f, n = {}, Counter()
    for lang, text in rows:
        lang, low = lang or "und", (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for i in range(len(words)):
                for m in range(1, min(4, len(words) - i) + 1):
                    key = (lang, tuple(words[i:i + m]))
                    f[key] = f.get(key, 0) + 1
    found = {k: a for k, a in f.items() if len(k[1]) >= 2 and a >= min_count}
    out = {}
    for (lang, ws), a in found.items():
        if any(k[0] == lang and len(k[1]) > len(ws) and 100 * b >= pct * a
               and any(k[1][i:i + len(ws)] == ws for i in range(len(k[1]) - len(ws) + 1)) for k, b in found.items()):
            continue
        score, k = min(((2000000 * a) // (f[lang, ws[:k]] + f[lang, ws[k:]]), k) for k in range(1, len(ws)))
        out.setdefault(lang, []).append((-score, -a, " ".join(ws).encode(), f[lang, ws[:k]], f[lang, ws[k:]]))
    return {(lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for lang, rs in out.items()
            for i, (s, a, p, left, right) in enumerate(sorted(rs)[:top])}


def lang_docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, "x", "y") for i, (lang, t) in enumerate(rows)],
                                 "doc_id long, text string, lang string, n string, score string")


@pytest.mark.parametrize("hot_share", [256, 1, 10**9])
def test_phrases_equal_brute_force(spark, monkeypatch, hot_share):
    r = random.Random(5)
    vocab = ["A", "b", "c", "New", "york", "city", "é", "中文", "\x1c", "x y", "of", "the"]
    rows = [(r.choice(["en", "de", None]), "".join(r.choice(vocab) + r.choice([" ", " ", "  ", "\t", ". ", ",", "\n"]) for _ in range(r.randrange(60))))
            for _ in range(120)]
    rows += [("en", "of the  new York city")] * 40 + [("en", None), ("fr", ""), (None, " \t.,")]
    monkeypatch.setattr(phrases, "HOT_SHARE", hot_share)
    got = {tuple(x) for x in phrases.collocations(lang_docs(spark, rows), 6, top=37).collect()}
    assert got == plain_phrases(rows, 6, top=37)


def test_chunks_of_any_size_count_alike(spark):
    rows = [("en", f"alpha beta gamma delta {i % 3} alpha beta") for i in range(90)]
    want = plain_phrases(rows, 30)
    docs = lang_docs(spark, rows)
    assert {tuple(x) for x in phrases.collocations(docs).collect()} == want
    for chunk in (1, 200, 1 << 20):
        held = phrases.window_blocks(docs, 30, 7, chunk).collect()
        total = Counter()
        for bucket in range(7):
            own = [(x["kind"], pa.scalar(bytes(x["block"]))) for x in held if x["bucket"] == bucket]
            for _, *words, n in zip(*phrases.merge_blocks("en", [k for k, _ in own], [b for _, b in own], 30).to_pydict().values()):
                total[tuple(w for w in words if w)] += n
        assert total["alpha", "beta", "gamma", "delta"] == 90
        assert sum(n for k, n in total.items()) == 90 * 7


def test_pairs_dealt_out_leave_a_line_at_home():
    text = phrases._marked(" . ".join(f"hot pair w{i} v{i}" for i in range(50)))
    found = phrases.count_windows("en", text, 30, 64)
    sure = [(b, line) for b, kind, block in found if kind == "sure"
            for line in zstandard.ZstdDecompressor().decompress(block).decode().split("\n")]
    assert len({b for b, _ in sure}) > 20 and all(line.startswith("hot pair\t") for _, line in sure)
    assert sum(int(line.split("\t")[1]) for _, line in sure) == 50 and [line for _, line in sure if line.split("\t")[1] == "0"] == ["hot pair\t0\t"]
    home = next(b for b, line in sure if line == "hot pair\t0\t")
    few = phrases.count_windows("en", phrases._marked("hot pair w0 x"), 30, 64)
    assert home in {b for b, kind, _ in few if kind == "pair"}


def test_phrases_awkward_and_empty(spark):
    rows = [(r["lang"], r["text"]) for r in awkward(spark).collect()]
    got = {tuple(x) for x in phrases.collocations(awkward(spark), 2).collect()}
    assert got == plain_phrases(rows, 2)
    assert phrases.collocations(empty(spark)).collect() == []


def test_counts_beyond_64_bits_of_product(spark):
    wide = spark.sql("SELECT CAST(CAST(8000000000000000000 AS DECIMAL(20,0)) * 2000000 DIV "
                     "(CAST(8000000000000000000 AS DECIMAL(20,0)) + CAST(9000000000000000000 AS DECIMAL(20,0))) AS LONG) AS s").first()["s"]
    assert wide == 8 * 10**18 * 2000000 // (17 * 10**18)
