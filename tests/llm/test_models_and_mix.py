import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridcast.llm import chat, mixing, quality, queries, toxicity

from .helpers import awkward, documents, empty

SF = "/root/testdata/sf0.01"


# --- chat -------------------------------------------------------------------------

def log(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, msg long, seq long, kind string, role string, text string, turns string")


def test_a_log_is_folded_and_rendered(spark):
    rows = [(1, 7, 5, "delta", None, "lo", "x"), (1, 7, 4, "delta", None, "hel", "x"), (1, 7, 3, "message", "assistant", "", "x"),
            (1, 3, 1, "message", "user", "first", "x"), (1, 3, 2, "edit", None, "ask", "x"),
            (1, 9, 8, "message", "assistant", "wrong", "x"), (1, 9, 9, "delta", None, " way", "x"),
            (1, 9, 10, "regenerate", None, None, "x"), (1, 9, 11, "delta", None, "right", "x"),
            (2, 1, 1, "message", None, None, "x"), (None, 1, 1, "message", "user", "no id", "x")]
    got = {r["conv_id"]: r for r in chat.parse(chat.format_chats(log(spark, rows))).collect()}
    assert [tuple(t) for t in got[1]["turns"]] == [("user", "ask"), ("assistant", "hello"), ("assistant", "right")]
    assert got[1]["loss_texts"] == ["hello", "right"]
    assert got[1]["formatted"] == ("<|im_start|>user\nask<|im_end|>\n<|im_start|>assistant\nhello<|im_end|>\n"
                                   "<|im_start|>assistant\nright<|im_end|>\n")
    assert [tuple(t) for t in got[2]["turns"]] == [("", "")] and got[2]["loss_texts"] == []
    assert [tuple(t) for t in got[None]["turns"]] == [("user", "no id")]
    assert chat.format_chats(log(spark, [])).count() == 0


def test_control_strings_come_back(spark):
    rng = random.Random(1)
    bits = ["<", "|", "!", "<|", "<!|", "<!!|", "<|im_end|>", "<|im_start|>", "<|nl|>", "\n", "assistant", "é😀", " ", "\\", "$1"]
    turns = [(c, t, rng.choice(["user", "assistant", "a<|b", "x\ny", None]), "".join(rng.choices(bits, k=rng.randint(0, 12))))
             for c in range(30) for t in range(rng.randint(1, 6))] + [(99, 0, "assistant", None), (99, None, "user", "null turn"),
                                                                      (98, 1, "user", "twice"), (98, 1, "user", "twice")]
    rows = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    read = {r["conv_id"]: r for r in chat.parse(chat.format_chats(chat.log_of_turns(rows, chunk=3))).collect()}
    want = {}
    for c, t, role, text in sorted(turns, key=lambda r: (r[0], -1 if r[1] is None else r[1])):
        want.setdefault(c, []).append((role or "", text or ""))
    assert {c: [tuple(t) for t in r["turns"]] for c, r in read.items()} == want
    for c, r in read.items():
        assert r["loss_texts"] == [t for role, t in want[c] if role == "assistant"]


# --- toxicity ---------------------------------------------------------------------

def accuracy(rows, truth, column):
    held = [(r["predicted"], truth[r["doc_id"]][column]) for r in rows if r["held_out"] and r["doc_id"] in truth]
    return sum(a == b for a, b in held) / len(held)


@pytest.fixture(scope="module")
def truth(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}


def test_machine_scores_are_the_pairwise_sum():
    rng = np.random.default_rng(2)
    texts = ["an idiot here", "idiot idiot moron", "", None, "nothing"]
    place = np.full(1 << 10, -1, dtype=np.int32)
    place[::3] = np.arange(len(place[::3]))
    n = int(place.max()) + 1
    m = toxicity.Machine(10, place, 0.3, rng.normal(size=n), rng.normal(size=(n, 4)))
    active = {i: set() for i in range(len(texts))}
    for doc, term in toxicity._terms(texts, 10):
        for d, t in zip(doc, term, strict=True):
            if place[t] >= 0:
                active[int(d)].add(int(place[t]))
    for i, got in enumerate(m.scores(texts)):
        a = sorted(active[i])
        raw = 0.3 + sum(m.linear[x] for x in a) + sum(m.factors[x] @ m.factors[y] for x in a for y in a if x < y)
        assert got == pytest.approx(1 / (1 + np.exp(-raw)))


def test_toxicity_on_held_out_documents(spark, truth):
    rows = queries.QUERIES["op7_toxicity"](spark, SF).collect()
    assert len(rows) == 1000 and all(0 <= r["score"] <= 1 for r in rows)
    assert accuracy(rows, truth, "toxic") >= 0.95


def test_toxicity_on_awkward_rows(spark):
    docs = awkward(spark)
    some = spark.createDataFrame([(4, 1), (4, 0), (5, 0), (7, 0), (8, None), (None, 1)], "doc_id long, label int")
    for labels, want in ((some, None), (some.limit(0), {0.5}), (some.where("doc_id = 5"), {0.0}), (some.where("doc_id = 4"), {1.0})):
        rows = toxicity.score_toxicity(docs, toxicity.learn_machine(docs, labels, rounds=3)).collect()
        assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
        assert want is None or {round(r["score"], 9) for r in rows} == want
    assert toxicity.score_toxicity(empty(spark), toxicity.learn_machine(empty(spark), some)).count() == 0


# --- quality ----------------------------------------------------------------------

def test_quality_on_held_out_documents(spark, truth):
    rows = queries.QUERIES["op9_quality"](spark, SF).collect()
    assert len(rows) == 1000 and accuracy(rows, truth, "quality") >= 0.97


def test_votes_are_those_of_brute_force(spark, truth):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    m = quality.learn_neighbours(docs, queries.labels(spark, SF, "quality", 4, 2), rows_per_label=60, k=7)
    texts = [r["text"] for r in docs.orderBy("doc_id").limit(40).collect()]
    x = m.embed(texts)
    for v, got in zip(x, m.scores(texts, block=16), strict=True):
        cosine = m.vectors @ v
        near = np.argsort(-cosine)[:7]
        w = np.clip(cosine[near], 0, None).astype(float) ** 4
        assert got == pytest.approx((w * m.labels[near]).sum() / w.sum(), abs=1e-3)


def test_features_do_not_depend_on_blocks(monkeypatch):
    text = "Ab c!! 12 | é\n" * 50
    want = quality.features([text, None, "", "a"], 64)
    monkeypatch.setattr(quality, "_BLOCK", 7)
    assert (quality.features([text, None, "", "a"], 64) == want).all()


def test_quality_on_awkward_rows(spark):
    docs = awkward(spark)
    some = spark.createDataFrame([(4, 1), (5, 0), (7, 0), (None, 1), (8, None)], "doc_id long, label int")
    for labels in (some, some.limit(0), some.where("doc_id = 5")):
        rows = quality.score_quality(docs, quality.learn_neighbours(docs, labels)).collect()
        assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert quality.score_quality(empty(spark), quality.learn_neighbours(empty(spark), some)).count() == 0


# --- mixing -----------------------------------------------------------------------

def test_targets_are_the_fixed_point_of_resharing(spark):
    rng = random.Random(3)
    for n in (1, 2, 5, 40):
        sizes = {f"s{i:02}": rng.choice([0, 1, 10, 1000, 50000]) for i in range(n)} | {None: 7}
        rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r["source"]: r["target"] for r in mixing.targets(rows).collect()}
        order = sorted(s for s in sizes if s) + [None]
        weight = {s: i % 3 + 1 for i, s in enumerate(order)}
        want, capped, left = dict.fromkeys(order, 0.0), set(), float(sum(sizes.values()))
        while left > 1e-9 and len(capped) < len(order):
            free = [s for s in order if s not in capped]
            total = sum(weight[s] for s in free)
            for s in free:
                want[s] += left * weight[s] / total
            left = sum(max(0, want[s] - 3 * sizes[s]) for s in free)
            for s in free:
                if want[s] >= 3 * sizes[s]:
                    want[s] = float(3 * sizes[s])
                    capped.add(s)
        assert got == pytest.approx(want)


@pytest.mark.parametrize("cells", [1, 16, 1024])
def test_the_mix_reaches_its_targets(spark, cells):
    rng = random.Random(4)
    rows = [(i, "w " * rng.randint(0, 30), rng.choice(["hot"] * 6 + ["b", "c", None])) for i in range(400)]
    docs = documents(spark, rows).withColumn("size", mixing.word_count())
    got = mixing.fair_mix(docs, cells=cells).collect()
    assert len(got) == 400 and all(0 <= r["taken"] <= 3 * r["size"] for r in got)
    by = {}
    for r in got:
        by.setdefault(r["source"], []).append(r)
    for g in by.values():
        assert sum(r["taken"] for r in g) == round(g[0]["target"]) and g[0]["source_size"] == sum(r["size"] for r in g)
        assert max(r["taken"] / r["size"] for r in g if r["size"]) - min(r["taken"] / r["size"] for r in g if r["size"]) <= 1
    key = lambda r: (r["doc_id"], r["taken"], r["target"])
    again = mixing.fair_mix(docs.repartition(7), cells=64).collect()
    assert sorted(map(key, got)) == sorted(map(key, again))
    order = mixing.in_mix_order(mixing.fair_mix(docs, cells=cells)).collect()
    finish = [r["virtual_finish"] for r in order]
    assert finish == sorted(finish) and len(order) == sum(r["taken"] > 0 for r in got)


def test_the_closed_form_is_the_cut_of_the_global_sort(spark):
    rng = random.Random(12)
    rows = [(i, "w " * rng.randint(0, 9), rng.choice("abcd")) for i in range(120)]
    docs = documents(spark, rows).withColumn("size", mixing.word_count())
    mixed = mixing.fair_mix(docs).collect()
    copies = sorted(((r["before"] + r["source_size"] * e + r["size"]) / r["target"], r["doc_id"],
                     (r["before"] + r["source_size"] * e) / r["target"], r["size"], r["target"])
                    for r in mixed for e in range(3) if r["size"])
    taken = dict.fromkeys((r["doc_id"] for r in mixed), 0.0)
    for end, doc, begin, size, target in copies:
        taken[doc] += size if end <= 1 else max(0, 1 - begin) * target  # a copy across time 1 up to it
    assert all(abs(r["taken"] - taken[r["doc_id"]]) <= 0.5 + 1e-6 for r in mixed)
    assert abs(sum(r["taken"] for r in mixed) - sum(r["size"] for r in mixed)) <= 2


def test_mixing_awkward_rows(spark):
    docs = awkward(spark).withColumn("size", mixing.word_count())
    got = mixing.fair_mix(docs).collect()
    assert len(got) == docs.count() and all(0 <= r["taken"] <= 3 * r["size"] for r in got)
    assert {r["size"] for r in got if r["text"] is None} == {0}
    assert mixing.fair_mix(empty(spark).withColumn("size", mixing.word_count())).count() == 0
    blank = documents(spark, [(1, "", "a"), (2, None, None)]).withColumn("size", mixing.word_count())
    assert [r["taken"] for r in mixing.fair_mix(blank).collect()] == [0, 0]
    assert mixing.in_mix_order(mixing.fair_mix(blank)).count() == 0


def test_word_counts(spark):
    df = spark.createDataFrame([("a b\x0bc",), ("",), (None,), (" \t",), ("é x y z",)], "text string")
    assert [r[0] for r in df.select(mixing.word_count().cast("int")).collect()] == [3, 0, 0, 0, 2]
    assert df.select(F.count("*")).first()[0] == 5


def test_the_cut_of_the_sorted_queue_equals_a_plain_queue(spark):
    r = random.Random(11)
    docs = documents(spark, [(i, "w " * r.choice([0, 1, 3, 20, 150]), r.choice(["a", "a", "a", "b", "c", None])) for i in range(300)])
    rows = mixing.fair_mix(docs.withColumn("size", mixing.word_count()), cells=16)
    plain, budget = [], 0
    for x in rows.collect():
        for copy in range(3):
            begin = x["before"] + x["source_size"] * copy
            end, mark = begin + x["size"], int(np.floor(x["target"] + 0.5))
            if begin < mark and x["size"]:
                plain.append((end / x["target"] if end < mark else 1.0, min(end, mark) - begin, x["source"]))
            if end > mark and x["size"]:
                plain.append((end / x["target"], end - max(begin, mark), x["source"]))
    marks = {x["source"]: int(np.floor(x["target"] + 0.5)) for x in rows.collect()}
    budget, served = sum(marks.values()), dict.fromkeys(marks, 0)
    for _, words, source in sorted(plain, key=lambda p: p[0]):
        served[source] += min(words, budget)
        budget -= min(words, budget)
    got = {x["source"]: x["served"] for x in mixing.serve(rows, 3).collect()}
    assert got == served == marks


def test_the_log_of_a_service_folds_to_its_turns(spark):
    rows = [(1, 0, "user", "a<|b" * 700), (1, 1, "assistant", "x" * 1500), (1, 2, None, None), (2, 0, "assistant", "")]
    log = chat.log_of_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert {x["kind"] for x in log.select("kind").collect()} == {"message", "edit", "regenerate", "delta"}
    got = {(x["conv_id"], x["role"], x["text"]) for x in chat.fold_messages(log).collect()}
    assert got == {(c, role or "", text or "") for c, _, role, text in rows}


def test_language_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    found = queries.QUERIES["op4_language_id"](spark, sf).where("held_out")
    truth = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").where("lang IS NOT NULL")
    right = found.join(truth, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count("*")).first()
    assert right[1] > 200 and right[0] >= 0.97
    assert found.where("NOT score BETWEEN 0 AND 1").count() == 0
