import random
import re

import corpus_pipeline
import pyarrow as pa

from sieveline.llm import shingles

LOW = {i: i + 32 for i in range(65, 91)}


def runs(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(len(w) - 5, 0) + 1)) if w else frozenset()


def brute(docs):
    own = [runs(t) for _, t in docs]
    parent = list(range(len(docs)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if own[i] == own[j] or 10 * len(own[i] & own[j]) >= 8 * len(own[i] | own[j]):
                parent[find(i)] = find(j)
    return sorted(((str(d), min((e for j, (e, _) in enumerate(docs) if find(j) == find(i) and e is not None), default=None)) for i, (d, _) in enumerate(docs)), key=str)


def sample():
    rng = random.Random(13)
    word = lambda: "".join(rng.choice("abcéÉZ.") for _ in range(rng.randint(2, 9)))
    docs = []
    for i in range(30):
        base = [word() for _ in range(rng.choice([1, 3, 4, 5, 30, 60, 400]))]
        docs.append((100 * i, " ".join(base)))
        for k in range(rng.choice([0, 1, 4, 12])):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 6])):
                copy[rng.randrange(len(copy))] = word()
            docs.append((100 * i + k + 1, "\n ".join(copy)))
    return docs + [(9000, None), (9001, ""), (9002, " \t\n"), (9003, docs[0][1].upper()), (9003, docs[0][1]), (None, docs[1][1]), (None, "alone in here")]


def test_matches_brute_force(spark):
    docs = sample()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = sorted(((str(r.doc_id), r.component_id) for r in shingles.near_duplicates(df).collect()), key=str)
    assert got == brute(docs)


def test_stage_finds_one_changed_word_and_leaves_less_similar_ones(spark):
    words = [f"w{i}" for i in range(200)]
    near, far = list(words), list(words)
    near[100] = "other"
    for i in range(10, 200, 20):
        far[i] = "other"
    docs = [(1, " ".join(words), 0), (2, " ".join(near), 0), (3, " ".join(far), 0)]
    df = spark.createDataFrame(docs, "doc_id long, text string, n_chars long")
    kept = dict(corpus_pipeline.STAGES)["near duplicates"](spark, df, "")
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3]


def test_empty_table_and_slices(spark):
    assert shingles.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    column = pa.array(["x", "a b c d", None, "Tail end of five words"]).slice(1, 3)
    assert [len(x) for x in shingles.sets(column)] == [1, 0, 1]


def test_small_blocks_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(shingles, "BLOCK", 3)
    docs = sample()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert sorted(((str(r.doc_id), r.component_id) for r in shingles.near_duplicates(df).collect()), key=str) == brute(docs)


def test_open_buckets_are_dealt_so_that_all_components_meet(spark):
    rng = random.Random(2)
    buckets = {1: [0] * 300 + [5, 6, 6], 2: [0] * 40 + list(range(1, 60)), 3: list(range(70)), 4: [0] * 9, 5: [3, 4]}  # the roots of each bucket's sets
    rows = [(key, rng.randrange(-(2**63), 2**63), 10, root) for key, roots in buckets.items() for root in roots]
    placed = spark.createDataFrame(rows, "key long, fp long, n long, root long")
    dealt = shingles._dealt_open(placed, 8).collect()
    groups = {}
    for r in dealt:
        groups.setdefault((r.key, r.lo, r.hi), []).append((r.fp, r.root))
    met = {(k[0], *sorted((a, b))) for k, g in groups.items() for a, x in g for b, y in g if x != y}
    want = {(key, *sorted((a, b))) for key in buckets for k, a, _, x in rows for j, b, _, y in rows if k == j == key and x != y}
    assert met == want
    count = lambda key: sum(len(g) for k, g in groups.items() if k[0] == key)
    assert count(1) <= 303 + 3 * (38 + 1) and count(4) == 0  # three sets against 300: not 303 for each of 38 blocks
    assert max(len(g) for g in groups.values()) <= 40
