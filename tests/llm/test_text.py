import hashlib
import random
import re
import string
from itertools import combinations

import numpy as np
import pytest

from gridcast.llm import decontam, hashing, lang_id, secret_scan, token_count

from .helpers import awkward, documents, empty

BENCH = "item_id long, text string, lang string"


# --- tokens and their hashes ------------------------------------------------------

def test_token_hashes_agree_with_one_token_at_a_time():
    texts = ["One, two  THREE's", None, "", "é中 x-y 12", "..., !", "one", "a" * 50]
    whole, sizes = [], []
    for _, n, (h, p3) in hashing.token_hashes(texts, (3,)):
        whole += list(zip(h.tolist(), p3.tolist()))
        sizes += n.tolist()
    tokens = [hashing.plain(t).split() for t in texts]
    assert sizes == [len(t) for t in tokens]
    assert tokens[0] == [b"one", b"two", b"threes"]
    single = {}
    for t in sorted({t for ts in tokens for t in ts}):
        (_, _, (h, p3)), = hashing.token_hashes([t.decode()], (3,))
        single[t] = (int(h[0]), int(p3[0]))
    assert whole == [single[t] for ts in tokens for t in ts]
    assert len({v[0] for v in single.values()}) == len(single)


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    rng = random.Random(4)
    text = " ".join("".join(rng.choices(string.ascii_letters, k=rng.randint(1, 9))) for _ in range(3000))
    ((_, n, (h,)),) = hashing.token_hashes([text])
    monkeypatch.setattr(hashing, "BLOCK", 100)
    ((_, n2, (h2,)),) = hashing.token_hashes([text])
    assert n.tolist() == n2.tolist() == [3000] and (h == h2).all()


# --- token counts -----------------------------------------------------------------

@pytest.fixture(scope="module")
def vocabulary():
    return token_count.load_vocabulary()


def test_counts_equal_the_unigram_tokenizer(vocabulary):
    from tokenizers import Tokenizer, models, normalizers

    vocab = [("<unk>", 0.0), *zip(vocabulary.pieces, vocabulary.scores, strict=True)]
    floor = min(vocabulary.scores)
    vocab += [(f"<0x{b:02X}>", floor) for b in range(256)]
    t = Tokenizer(models.Unigram(vocab, 0, True))
    t.normalizer = normalizers.Sequence([normalizers.Prepend("▁"), normalizers.Replace(" ", "▁")])
    rng = random.Random(5)
    alphabet = ["the", "ing", " ", " ", "  ", "\n", "é", "中", "😀", "x", "ﬁ", "▁", "Th", "qz", "\t", "0", "1", "%%%", "ß", "​"]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(1, 60))) for _ in range(400)]
    counts = token_count._Counts(vocabulary)
    assert [counts.text(x) for x in texts] == [len(t.encode(x, add_special_tokens=False).ids) for x in texts]


def test_ties_and_unknowns_of_a_small_vocabulary():
    v = token_count.Vocabulary(("a", "b", "ab", "abc", "c", "bc"), (-1.0, -1.0, -2.0, -3.0, -1.0, -2.0), False)
    assert v.best("abc") == 1  # abc = ab + c = a + bc = -3: the piece that begins first
    assert v.best("zé") == 3  # one byte and two
    assert v.best("") == 0


def test_counts_of_awkward_rows(spark, vocabulary):
    got = {(r["doc_id"], r["n_points"]): r["n_tokens"] for r in token_count.token_counts(awkward(spark), vocabulary).collect()}
    assert got[(1, 0)] == got[(2, 0)] == 0 and got[(9, 1_500_000)] > 0 and got[(7, 1)] == 1
    assert token_count.token_counts(empty(spark), vocabulary).count() == 0


# --- decontamination --------------------------------------------------------------

def test_masks_hit_every_alignment_they_promise():
    for size, changed in ((13, 2), (15, 3), (20, 4)):
        places = [[o + i for i, c in enumerate(m) if c == "1"] for m in decontam.MASKS for o in range(size - len(m) + 1)]
        for c in combinations(range(size), changed):
            assert any(not set(p) & set(c) for p in places)


def test_longest_stretch_is_that_of_brute_force():
    rng = np.random.default_rng(6)
    for _ in range(300):
        e = rng.random(rng.integers(1, 40)) < 0.75
        want = max((j - i for i in range(len(e)) for j in range(i + 1, len(e) + 1) if e[i:j].sum() * 5 >= 4 * (j - i)), default=0)
        start, length = decontam.longest_stretch(e, 0.8)
        assert length == want and e[start:start + length].sum() * 5 >= 4 * length


def _words(rng, n):
    return ["".join(rng.choices(string.ascii_lowercase, k=rng.randint(2, 6))) for _ in range(n)]


def test_overlaps_are_those_of_brute_force(spark):
    rng = random.Random(7)
    items = [_words(rng, rng.randint(9, 60)) for _ in range(12)]
    docs = []
    for i in range(80):
        w = _words(rng, rng.randint(0, 120))
        if i % 2:
            item = items[i % 12]
            a = rng.randint(0, max(0, len(item) - 20)) if i % 4 == 1 else 0
            part = [x if rng.random() > 0.12 else "zz" + x for x in item[a:a + rng.randint(8, 60)]]
            at = rng.randint(0, len(w))
            w = w[:at] + part + w[at:]
        docs.append(" ".join(x.upper() + "," if rng.random() < 0.2 else x for x in w))
    bench = spark.createDataFrame([(i, " ".join(t), "x") for i, t in enumerate(items)], BENCH)
    got = {(r["doc_id"], r["item_id"]): r["overlap"]
           for r in decontam.contaminated(documents(spark, list(enumerate(docs))), bench).collect()}
    want = {}
    for d, text in enumerate(docs):
        w = [x.decode() for x in hashing.plain(text).split()]
        for i, item in enumerate(items):
            for shift in range(-len(item), len(w)):
                lo, hi = max(0, shift), min(len(w), shift + len(item))
                if hi - lo >= min(13, len(item)):
                    e = np.array([w[p] == item[p - shift] for p in range(lo, hi)])
                    n = decontam.longest_stretch(e, 0.8)[1]
                    if n >= min(13, len(item)):
                        want[d, i] = max(n, want.get((d, i), 0))
    assert got.keys() == want.keys() and len(got) > 20
    assert got == want


def test_decontamination_on_awkward_rows(spark):
    bench = spark.createDataFrame([(1, "the quick brown fox jumps over a lazy dog while nobody looks at it", "x"),
                                   (2, None, None), (3, "", "x"), (4, "too short", "x"), (None, "long " * 20, "x")], BENCH)
    got = sorted((r["doc_id"] or 0, r["item_id"] or 0) for r in decontam.contaminated(awkward(spark), bench).collect())
    assert got == [(0, 1), (4, 1), (4, 1), (5, 1), (8, 0), (10, 1)]
    assert decontam.contaminated(empty(spark), bench).count() == 0
    assert decontam.contaminated(awkward(spark), bench.limit(0)).count() == 0


def test_short_items_are_found_token_for_token(spark):
    items = ["Paris, France", "42", "what is the capital of france", "one two one", "42", "never seen here", "a b c d e f g"]
    docs = ["he said: What is the capital of France? paris france", "answer 42 or 42", "one two two one", "one two one two one",
            "142", "a b c d e x g", None, "", "42", "a b c d e f g h", "capital of france"]
    bench = spark.createDataFrame([(i, t, "x") for i, t in enumerate([*items, " .", None])], BENCH)
    rows = documents(spark, [*enumerate(docs), (1, docs[1]), (None, "x 42")])
    got = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["item_id"], r["start"], r["overlap"], r["matches"], r["item_tokens"])
                 for r in decontam.contaminated(rows, bench).collect())
    want = []
    for d, text in [*enumerate(docs), (1, docs[1]), (-1, "x 42")]:
        w = hashing.plain(text).split()
        for i, item in enumerate(items):
            t = hashing.plain(item).split()
            places = [p for p in range(len(w) - len(t) + 1) if w[p:p + len(t)] == t]
            if places:
                want.append((d, i, places[0], *[len(t)] * 3))
    assert got == sorted(want) and len(got) > 10


def test_long_items_copied_whole_are_one_overlap(spark):
    rng = random.Random(11)
    items = [_words(rng, n) for n in (900, 400, 70)] + [["long", "again"] * 200]
    noisy = [x if i % 11 else "zz" for i, x in enumerate(items[0])]
    docs = [_words(rng, 700) + items[0] + _words(rng, 30), noisy, items[1][150:], items[0][:500] + _words(rng, 40) + items[0][540:],
            _words(rng, 80) + items[2], ["x"] + ["long", "again"] * 400, items[1][:300] + items[1][310:]]
    bench = spark.createDataFrame([(i, " ".join(t), "x") for i, t in enumerate(items)], BENCH)
    got = {(r["doc_id"], r["item_id"]): (r["overlap"], r["matches"], r["start"])
           for r in decontam.contaminated(documents(spark, [(i, " ".join(w)) for i, w in enumerate(docs)]), bench).collect()}
    want = {}
    for d, w in enumerate(docs):
        for i, item in enumerate(items):
            best = (0, 0, 0)
            for shift in range(-len(item), len(w)):
                lo, hi = max(0, shift), min(len(w), shift + len(item))
                e = np.array([w[p] == item[p - shift] for p in range(lo, hi)], dtype=bool)
                if e.sum() >= 11:
                    start, n = decontam.longest_stretch(e, 0.8)
                    best = max(best, (n, int(e[start:start + n].sum()), -(lo + start)))
            if best[0] >= 13:
                want[d, i] = (best[0], best[1], -best[2])
    assert got == want and got[0, 0] == (900, 900, 700) and got[1, 0][0] >= 899 and got[5, 3][0] == 400


def test_scripts_without_blanks_have_character_tokens(spark):
    chinese = "北京是中华人民共和国的首都和直辖市之一"
    japanese = "これはとてもながいもんだいぶんです"
    thai = "กรุงเทพมหานครเป็นเมืองหลวงของประเทศไทย"
    bench = spark.createDataFrame([(0, chinese, "x"), (1, japanese, "x"), (2, thai, "x"), (3, "東京都", "x")], BENCH)
    docs = ["前文" + chinese + "后文", "x" + japanese[:8] + "ぬ" + japanese[9:] + "。", "ก่อน " + thai, "大東京都民", "東京の都", "한국어 문장"]
    got = {(r["doc_id"], r["item_id"]): (r["start"], r["overlap"])
           for r in decontam.contaminated(documents(spark, list(enumerate(docs))), bench).collect()}
    assert got == {(0, 0): (2, len(chinese)), (1, 1): (1, len(japanese)), (2, 2): (4, len(thai)), (3, 3): (1, 3)}


# --- languages --------------------------------------------------------------------

def test_ngrams_and_ranks_follow_the_definition():
    for text in ("Ab a1b,  é", "", None, "12", "a", "中文 x😀y"):
        words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
        line = " " + " ".join(words) + " " if words else " "
        want = [line[i:i + n] for n in (1, 2, 3) for i in range(len(line) - n + 1)]
        want = sorted(g for g in want if g != " " and not (len(g) == 3 and g[1] == " "))
        packed = []
        for g in want:
            x = 0
            for c in g:
                x = x << 21 | ord(c)
            packed.append(x)
        assert sorted(lang_id.ngrams(text).tolist()) == sorted(packed)
    assert lang_id.ranked(np.array([5, 3, 3, 9, 5, 1]), 3).tolist() == [3, 5, 1]


def test_distances_are_out_of_place_sums():
    p = lang_id.Profiles(["aa", "bb"], np.array([97, 98, 99]), np.array([[0, 2], [1, 3], [3, 0]]), 3)
    mine = lang_id.ranked(lang_id.ngrams("a"), 3)  # a, then two n-grams that no profile has
    assert mine.tolist()[0] == 97
    lang, score = p.predict("a")
    assert lang == "aa" and score == pytest.approx(1 - (0 + 3 * (len(mine) - 1)) / (3 * len(mine)))


def test_languages_of_awkward_rows(spark):
    train = spark.createDataFrame([(i, t, x) for i, (t, x) in enumerate(
        [("the quick brown fox and the dog", "en"), ("der schnelle braune fuchs und der hund", "de"), ("x", None), (None, "en")])],
        "doc_id long, text string, lang string")
    p = lang_id.learn_profiles(train)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in lang_id.identify(awkward(spark), p).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0) and got[4][0] == got[10][0] == "en"
    assert all(0 <= s <= 1 for _, s in got.values())
    assert lang_id.identify(empty(spark), p).count() == 0
    nothing = lang_id.learn_profiles(train.where("lang is null"))
    assert nothing.predict("the dog") == ("und", 0.0)


# --- secrets ----------------------------------------------------------------------

def plain_base(text):
    """Tries every start, so it shares nothing with finditer but the patterns of one place."""
    out = []
    kinds = [(r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
              r"|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 1, 8),
             (r"AKIA[A-Z0-9]+", 0, 16), (r"[0-9a-f]+", 0, 32)]
    for k, (p, group, least) in enumerate(kinds):
        p, at = re.compile(p), 0
        while at <= len(text):
            m = p.match(text, at)
            if m:
                if len(m[group]) >= least:
                    out.append((m.start(), m.end(), k))
                at = m.end()
            else:
                at += 1
    return sorted(out, key=lambda s: (s[0], s[2]))


def test_base_spans_are_those_of_brute_force(spark):
    rng = random.Random(8)
    bits = ["token", "Secret", "api_key", "APIKEY", "passwd", "=", ":", " ", '"', "'", "abc", "AKIA", "ABCDEFGH1234", "AKIAABCDEFGH12345",
            "0123456789abcdef" * 2, "deadbeef", "é", "\n", "K", "ſecret", "%%%", "value_1/x+y="]
    texts = ["".join(rng.choices(bits, k=rng.randint(1, 30))) for _ in range(300)]
    for t in texts:
        assert secret_scan.base_spans(t) == plain_base(t)
    rows = secret_scan.secret_spans(documents(spark, list(enumerate(texts)))).collect()
    for r in rows:
        base = plain_base(texts[r["doc_id"]])
        names = [f"{secret_scan.KINDS[k]}:{s}:{e}" for s, e, k in base]
        assert r["base_sha256"] == hashlib.sha256(",".join(names).encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == i for _, _, k in base) for i in range(3)]
        assert [s for s in r["spans"].split(",") if s and not s.startswith("novel")] == names


def test_novelty_tells_random_strings_from_names():
    rng = random.Random(9)
    around = "def load_configuration(path):\n    return configuration_parameters[path]\n"
    for _ in range(50):
        key = "".join(rng.choices(string.ascii_letters + string.digits, k=rng.randint(20, 44)))
        assert secret_scan.novelty(key, around) >= 0.85
    for name in ("configuration_parameters2", "repository_username_password1", "load_configuration_path3"):
        assert secret_scan.novelty(name, around) < 0.6
    text = around + "bearer Zx81kQpLm2vTn7RwYb40Jd and path load_configuration_path3 for login"
    (s, e, kind), = secret_scan.novel_spans(text, [])
    assert text[s:e] == "Zx81kQpLm2vTn7RwYb40Jd" and secret_scan.KINDS[kind] == "novel"


@pytest.mark.parametrize("alphabet", ["0123456789abcdef", "0123456789ABCDEF", string.ascii_uppercase + "234567",
                                      string.ascii_lowercase + string.digits,
                                      string.ascii_letters + string.digits + "+/"])
def test_random_strings_of_any_length_and_alphabet_are_novel(alphabet):
    rng = random.Random(10)
    around = "def load_configuration(path):\n    return configuration_parameters[path]\n"
    for n in (16, 17, 19, 24, 40, 44, 64, 128, 344, 512, 1000, 2000):
        keys = ["".join(rng.choices(alphabet, k=n)) for _ in range(25)]
        assert [k for k in keys if secret_scan.novelty(k, around) < 0.85] == [], n


def test_repeats_and_names_in_other_cases_are_not_novel():
    around = "def load_configuration(path):\n    return configuration_parameters[path]\n"
    for name in ("-" * 16, "=" * 40, "0" * 20, "ab" * 30, "abcdef" * 50, "0123456789" * 8, "x" * 5000,
                 "CONFIGURATION_PARAMETERS", "LoadConfigurationParameters2", "loadConfiguration" * 20):
        assert secret_scan.novelty(name, around) < 0.6, name


@pytest.mark.parametrize("text, secret", [
    ("AUTH_KEY=Zk81mQpX72LsVt0Rb9Yd", "Zk81mQpX72LsVt0Rb9Yd"),
    ("export AWS_SESSION='Zk81mQpX72LsVt0Rb9Yd'", "Zk81mQpX72LsVt0Rb9Yd"),
    ("PRIVATE_KEY=Zk81mQpX72LsVt0Rb9YdaQ==\n", "Zk81mQpX72LsVt0Rb9YdaQ=="),
    ("http://x.org/a?signature=Zk81mQpX72LsVt0Rb9Yd&b=1", "Zk81mQpX72LsVt0Rb9Yd"),
    ("SESSION_" + "LEVEL_" * 20 + "X=Zk81mQpX72LsVt0Rb9Yd", "Zk81mQpX72LsVt0Rb9Yd"),
    ("Zk81mQpX72LsVt0Rb9Yd is the password", "Zk81mQpX72LsVt0Rb9Yd"),
    ("session-Zk81mQpX72LsVt0Rb9YdWq", "session-Zk81mQpX72LsVt0Rb9YdWq"),
    ("Bearer qXvJkWzTnRbYpLmCdHsG", "qXvJkWzTnRbYpLmCdHsG"),
    ("the Zk81mQpX72LsVt0Rb9Yd is plain", None),
    ("Zk81mQpX72LsVt0Rb9Yd" + " x" * 40 + " password", None),
    ("login: administration_responsibility, DATABASE_CONNECTION_URL=none", None)])
def test_candidates_are_values_with_a_word_on_any_side(text, secret):
    assert [text[s:e] for s, e, _ in secret_scan.novel_spans(text, secret_scan.base_spans(text))] == ([secret] if secret else [])


def test_secrets_on_awkward_rows(spark):
    rows = secret_scan.secret_spans(awkward(spark)).collect()
    assert len(rows) == awkward(spark).count() and all(r["spans"] == "" for r in rows)
    assert secret_scan.secret_spans(empty(spark)).count() == 0
