import random
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from gridcast.llm import exact_dedup, simhash
from gridcast.llm.common import drop_rows, keep_rows
from gridcast.llm.components import components

from .helpers import awkward, documents, empty


def plain_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_roots(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(sorted(nodes), 2):
        if linked(a, b):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {n: find(n) for n in nodes}


def test_fingerprints_follow_the_definition(spark):
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["Ab", "é", "x y", "of", "THE"]) for _ in range(n)) for n in (0, 1, 3, 4, 5, 40, 400)]
    for t in [*texts, "\x0b a\x1cb \x0c c", "İI", None, ""]:
        assert simhash.fingerprint(t) == plain_fingerprint(t)


def test_spark_hash_is_the_same_xxh64(spark):
    got = spark.range(1).select(F.xxhash64(F.lit("some words")).alias("h")).first()["h"]
    assert got % (1 << 64) == xxhash.xxh64_intdigest(b"some words", 42)


@pytest.mark.parametrize("largest", [4096, 8])
def test_links_have_the_components_of_brute_force(spark, largest):
    rng = random.Random(2)
    nodes = {rng.getrandbits(64) for _ in range(60)}
    for centre in list(nodes)[:6]:  # dense groups and chains
        for _ in range(25):
            x = centre
            for b in rng.sample(range(64), rng.randint(1, 6)):
                x ^= 1 << b
            nodes.add(x)
    df = spark.createDataFrame([(n - (1 << 64) if n >> 63 else n,) for n in nodes], "fp long")
    edges = simhash.linked(df, 4, largest=largest)
    for r in edges.collect():
        assert bin((r["u"] ^ r["v"]) % (1 << 64)).count("1") <= 4
    roots = {r["u"] % (1 << 64): r["root"] % (1 << 64) for r in components(edges).collect()}
    want = plain_roots(nodes, lambda a, b: bin(a ^ b).count("1") <= 4)
    same = lambda f: sorted(sorted(m for m in nodes if f(m) == r) for r in {f(n) for n in nodes})
    assert same(lambda n: roots.get(n, n)) == same(want.get)


def test_components_of_chains_hubs_and_nothing(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(200, 260)] + [(300, 300)]
    got = {r["u"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {k: 100 for k in range(200, 260)}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_near_duplicates_on_awkward_rows(spark):
    rows = simhash.near_duplicates(awkward(spark)).collect()
    assert len(rows) == awkward(spark).count()
    docs = [(r["doc_id"], r["text"]) for r in awkward(spark).collect()]
    fps = {plain_fingerprint(t) for _, t in docs}
    roots = plain_roots(fps, lambda a, b: bin(a ^ b).count("1") <= 4)
    least = {}
    for i, t in docs:
        r = roots[plain_fingerprint(t)]
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    want = sorted((i if i is not None else -1, least[roots[plain_fingerprint(t)]]) for i, t in docs)
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["component_id"]) for r in rows) == want
    assert simhash.near_duplicates(empty(spark)).count() == 0


def test_exact_duplicates_on_awkward_rows(spark):
    rows = exact_dedup.exact_duplicates(awkward(spark), runs=5, fan_in=2).collect()
    assert len(rows) == awkward(spark).count()
    groups = {}
    for r in rows:
        groups.setdefault(r["text_sha256"], []).append(r)
    assert all(sum(r["kept"] for r in g) == 1 and {r["group_size"] for r in g} == {len(g)} for g in groups.values())
    of = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert (of[4]["keep_id"], of[4]["group_size"]) == (5, 4)  # doc 5 has one code point more
    assert (of[1]["keep_id"], of[2]["keep_id"], of[3]["group_size"]) == (3, 3, 4)
    assert exact_dedup.exact_duplicates(empty(spark)).count() == 0


@pytest.mark.parametrize("runs,fan_in", [(1, 8), (7, 2), (30, 3)])
def test_merge_levels_agree(spark, runs, fan_in):
    rng = random.Random(3)
    docs = documents(spark, [(i, "w" * rng.randint(0, 12) + " " * rng.randint(0, 2)) for i in range(200)]).repartition(9)
    rows = exact_dedup.exact_duplicates(docs, runs, fan_in).collect()
    want = {}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for i, t in texts.items():
        want.setdefault(t.strip(), []).append((-len(t), i))
    for r in rows:
        g = want[texts[r["doc_id"]].strip()]
        assert (r["keep_id"], r["group_size"], r["kept"]) == (min(g)[1], len(g), r["doc_id"] == min(g)[1])


def test_keep_and_drop_rows(spark):
    docs = awkward(spark)
    near = simhash.near_duplicates(docs)
    names = near.select(F.col("doc_id").alias("win_id"), F.col("text_key").alias("win_key")).distinct()
    kept = keep_rows(docs, names)
    assert kept.columns == docs.columns
    assert kept.count() == names.count() == docs.count() - 1  # one row repeats
    assert drop_rows(docs, names).count() == 0
    assert drop_rows(docs, names.limit(0)).count() == docs.count()


def test_bit_table_of_positions():
    x = np.array([0, 0xFF, 0x0101010101010101, 0x01010101], dtype=np.uint64)
    assert simhash._near(x, 4, 4).tolist() == [True, False, False, True]


def test_a_task_of_the_merge_holds_one_slice_of_one_run(spark):
    rows = exact_dedup._digests(documents(spark, [(i, f"text {i % 40}", "a") for i in range(400)]), 20)
    entries = rows.selectExpr("digest", "check", "n_bytes", "run", "struct(row) AS best", "1L AS n")
    merged = exact_dedup._merged(entries, "run")
    for df, place in ((merged, ["run"]), (exact_dedup._merged(entries.withColumn("slice", F.col("run") % 3), "run", "slice"), ["run", "slice"])):
        plan = re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString())
        assert plan.count("Exchange ") == 1 and f"hashpartitioning({', '.join(place)}, " in plan
    thin = merged.groupBy("run", "digest").count()
    assert thin.where("count > 1").count() == 0 and thin.select("run").distinct().count() == 20
    final = exact_dedup.merge_runs(entries, 20, 3)
    assert final.count() == 40 and final.agg(F.sum("n")).first()[0] == 400
