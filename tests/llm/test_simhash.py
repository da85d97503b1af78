import random

import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from sieveline.llm import simhash

LOW = {i: i + 32 for i in range(65, 91)}


def fingerprint(text):
    import re

    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    sh = [" ".join(w[i : i + 3]) for i in range(max(len(w) - 3, 0) + 1)] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def brute(docs):
    fps = [fingerprint(t) for _, t in docs]
    parent = list(range(len(docs)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                parent[find(i)] = find(j)
    out = []
    for i, (doc, _) in enumerate(docs):
        ids = [d for j, (d, _) in enumerate(docs) if find(j) == find(i) and d is not None]
        out.append((str(doc), f"{fps[i]:016x}", min(ids, default=None)))
    return sorted(out, key=str)


def sample():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abéÉZ.") for _ in range(rng.randint(1, 9)))
    docs = []
    for i in range(40):
        base = [word() for _ in range(rng.choice([1, 2, 3, 40, 400]))]
        docs.append((10 * i, " ".join(base)))
        for k in range(rng.choice([0, 0, 1, 5])):
            copy = list(base)
            copy[rng.randrange(len(copy))] = word()
            docs.append((10 * i + k + 1, "\n ".join(copy)))
    return docs + [(990, None), (991, ""), (992, " \t\n"), (993, docs[0][1]), (993, docs[0][1]), (None, docs[1][1]), (None, "alone in here"), (994, "w" * 200_000 + " b c d")]


def test_matches_brute_force(spark):
    docs = sample()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3).select("*", F.lit(0).alias("fp"), F.lit(0).alias("component_id"))
    got = sorted(((str(r.doc_id), r.fingerprint, r.component_id) for r in simhash.near_duplicates(df).collect()), key=str)
    assert got == brute(docs)
    kept = simhash.representatives(df)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {c for _, _, c in got}


def test_all_pairs_within_two_bits_connect(spark):
    rng = random.Random(8)
    base = [rng.getrandbits(63) for _ in range(20)]
    fps = base + [b ^ (1 << rng.randrange(62)) ^ (1 << rng.randrange(62)) for b in base] + [b ^ (1 << 63) - (1 << 64) for b in base[:5]]
    fps = list(set(fps))
    edges = {frozenset(r) for r in simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long")).collect()}
    near = {frozenset((a, b)) for a in fps for b in fps if a < b and ((a ^ b) % (1 << 64)).bit_count() <= 2}
    assert edges <= near and len(near) >= 20
    reach = {f: {f} for f in fps}
    for e in edges:
        a, b = e
        both = reach[a] | reach[b]
        for f in both:
            reach[f] = both
    assert all(b in reach[a] for a, b in near)


def test_empty_table_and_slices(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    column = pa.array(["x", "a b c d", None, "Tail end"]).slice(1, 3)
    assert [int(x) for x in simhash.fingerprints(column)] == [fingerprint(t) for t in ("a b c d", None, "Tail end")]


def test_representatives_by_balls_and_similarity(spark):
    # one word of many changed: within two bits, but few runs of words are shared if it recurs; and the other way round
    rng = random.Random(5)
    words = [f"w{rng.randrange(10**6)}" for _ in range(3000)]
    long = " ".join(words)
    far = " ".join(w if k % 40 else "x" for k, w in enumerate(words[:400]))
    base = " ".join(words[:400])
    docs = [(1, long), (2, long + " end"), (3, "alone " + " ".join(words[::-1][:50])), (4, None), (5, "")]
    texts = pa.array([t for _, t in docs])
    fp = simhash.fingerprints(texts).tolist()
    assert bin(fp[0] ^ fp[1]).count("1") <= 2
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for similarity in (0.8, 1.0):  # at 1.0 only balls can link 1 and 2
        assert sorted(r.doc_id for r in simhash.representatives(df, size=5, similarity=similarity).collect()) == [1, 3, 4]
    a, b = simhash.fingerprints(pa.array([base, far])).tolist()
    assert bin(a ^ b).count("1") > 2
    df = spark.createDataFrame([(1, base), (2, far)], "doc_id long, text string")
    assert [r.doc_id for r in simhash.representatives(df, size=1, similarity=0.8).collect()] == [1]  # linked by similarity alone
