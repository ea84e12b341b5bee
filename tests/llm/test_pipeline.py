"""Each stage against a plain version on its own input, and on awkward documents."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from gridcast.llm import decontam, hashing, queries, toxicity

from .helpers import awkward, empty
from .test_dedup import plain_fingerprint, plain_roots

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
ORDER = ["toxicity", "exact_dedup", "near_dedup", "decontamination", "mixing"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """{stage: (rows in, rows out)}, each stage's output written and read."""
    folder, out = tmp_path_factory.mktemp("stages"), {}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(folder / name))
        after = spark.read.parquet(str(folder / name))
        out[name] = (docs.collect(), after.collect())
        docs = after
    return out


def ids(rows):
    return sorted(r["doc_id"] for r in rows)


def test_order_and_columns(stages):
    assert list(stages) == ORDER and [n for n, _ in pipeline.STAGES] == ORDER
    for name in ORDER[:-1]:
        assert list(stages[name][1][0].asDict()) == COLUMNS


def test_toxic_rows_go(spark, stages):
    before, after = stages["toxicity"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    machine = toxicity.learn_machine(docs, queries.labels(spark, SF, "toxic", 5, 0))
    scores = machine.scores([r["text"] for r in before])
    clear = [(r["doc_id"], s) for r, s in zip(before, scores, strict=True) if abs(s - 0.5) > 1e-6]
    kept = set(ids(after))
    assert all((i in kept) == (s < 0.5) for i, s in clear) and len(after) < len(before)


def test_copies_go(stages):
    before, after = stages["exact_dedup"]
    groups = {}
    for r in before:
        bare = re.sub(r"[\x20\x09-\x0D]", "", r["text"] or "")
        groups.setdefault(hashlib.sha256(bare.encode()).digest(), []).append((-len(r["text"] or ""), r["doc_id"]))
    assert ids(after) == sorted(min(g)[1] for g in groups.values())


def test_near_copies_go(stages):
    before, after = stages["near_dedup"]
    fp = {r["doc_id"]: plain_fingerprint(r["text"]) for r in before}
    roots = plain_roots(set(fp.values()), lambda a, b: bin(a ^ b).count("1") <= 4)
    least = {}
    for i in sorted(fp):
        least.setdefault(roots[fp[i]], i)
    assert ids(after) == sorted(least.values())


def test_contaminated_rows_go(spark, stages):
    before, after = stages["decontamination"]
    items = [hashing.plain(r["text"]).split() for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert min(map(len, items)) >= 13
    kept = []
    for r in before:
        words = hashing.plain(r["text"]).split()
        count, hit = Counter(words), False
        for item in items:
            if sum((count & Counter(item)).values()) < 11:  # 80 % of 13
                continue
            for shift in range(-len(item), len(words)):
                lo, hi = max(0, shift), min(len(words), shift + len(item))
                equal = np.array([words[p] == item[p - shift] for p in range(lo, hi)], dtype=bool)
                hit = hit or len(equal) >= 13 and decontam.longest_stretch(equal, 0.8)[1] >= 13
        if not hit:
            kept.append(r["doc_id"])
    assert ids(after) == sorted(kept) and len(after) < len(before)


def test_the_mix_is_taken_in_order(stages):
    before, after = stages["mixing"]
    size = {r["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])) for r in before}
    total, taken = Counter(), Counter()
    for r in before:
        total[r["source"]] += size[r["doc_id"]]
    for r in after:
        taken[r["source"]] += r["taken"]
        assert 0 < r["taken"] <= 3 * r["size"] == 3 * size[r["doc_id"]] and r["source_size"] == total[r["source"]]
    assert sum(taken.values()) == pytest.approx(sum(size.values()), abs=len(total))
    assert all(taken[r["source"]] == int(r["target"] + 0.5) for r in after)


def test_run_gives_the_rows_of_the_last_stage(spark, stages):
    rows = pipeline.run(spark, SF).select("doc_id", "taken").collect()
    assert sorted(map(tuple, rows)) == sorted((r["doc_id"], r["taken"]) for r in stages["mixing"][1])


@pytest.mark.parametrize("name,stage", pipeline.STAGES)
def test_stages_survive_awkward_and_no_rows(spark, name, stage):
    docs = awkward(spark).withColumn("doc_id", F.col("doc_id") + 100_000)
    out = stage(spark, docs, SF)
    if name != "mixing":
        assert out.columns == docs.columns
    assert out.count() <= docs.count()
    assert stage(spark, empty(spark), SF).count() == 0
