import random
import re
import zlib
from collections import Counter
from itertools import permutations

from pyspark.sql import functions as F

from sieveline.llm import spelling as S

LOW = {i: i + 32 for i in range(65, 91)}


def brute_counts(docs, every=199, chars=6, least=5):
    n = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            n[run if h % every else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    return {w: c for w, c in n.items() if len(w) >= chars and c >= least}


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(counts, ratio=5):
    out = {}
    for w, n in counts.items():
        near = [x for x in counts if one_apart(w, x)]
        best = min(near, key=lambda x: (-counts[x], x), default=None)
        form = best if best is not None and counts[best] >= ratio * n else None
        out[w] = (n, len(near), form, counts.get(form))
    def root(w):
        return root(out[w][2]) if out[w][2] else w
    return {(w, *v, root(w)) for w, v in out.items()}


def rows(df):
    return {(r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect()}


def corpus():
    rng = random.Random(3)
    stems = ["colour", "behaviour", "naïveté", "straße", "letters", "aaaaaaa"]
    docs = []
    for i in range(60):
        words = []
        for _ in range(60):
            w = rng.choice(stems)
            if rng.random() < 0.4:
                k = rng.randrange(len(w))
                w = rng.choice([w[:k] + w[k + 1 :], w[:k] + rng.choice("aéxÿ") + w[k:], w[:k] + rng.choice("aéxÀ") + w[k + 1 :], w[::-1]])
            words.append(rng.choice([w, w, w.upper(), w.capitalize()]))
        docs.append((i, rng.choice([" ", "\n", "1", "-", "Ā"]).join(words)))
    return [*docs, docs[0], (None, docs[1][1]), (7, None), (8, ""), (9, "é" * 300_000 + " " + "colour " * 3000)]


def test_matches_brute_force(spark):
    docs = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3).select("*", F.lit(1).alias("word"), F.lit(2).alias("n"))
    words = S.word_counts(df, spoil_every=19)
    want = brute_counts(docs, 19)
    assert {r.word: r.n for r in words.collect()} == want
    expected = brute_variants(want)
    assert rows(S.variants(words)) == expected
    assert sum(1 for r in expected if r[3]) > 20
    assert rows(S.variants(words, bucket=1)) == expected


def test_large_buckets_of_anagrams(spark):
    words = {"".join(p): 7 + k for k, p in enumerate(permutations("abcdef"))} | {"".join(p): 400 + k for k, p in enumerate(permutations("abcdx"))}
    words |= {f"{w[:2]}z{w[2:]}": 50 for w in list(words)[:200]}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    dealt = S._dealt(S.anagram_keys(df), 8)
    assert dealt.where("part <> 0").count() > 0
    assert dealt.groupBy("key", "part").count().agg(F.max("count")).first()[0] < 60  # 720 and more share a key
    assert rows(S.variants(df, bucket=8)) == brute_variants(words) == rows(S.variants(df, bucket=10**6))


def test_chains_lead_to_their_root(spark):
    words = {"l" * k: 6**k for k in range(6, 20)} | {"m" * 6: 5}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = rows(S.variants(df))
    assert got == brute_variants(words)
    assert {r[5] for r in got} == {"l" * 19, "m" * 6}


def test_ties_go_to_the_smaller_word_in_code_point_order(spark):
    words = {"lettre": 5, "lettré": 50, "lettrz": 50, "lettrA": 50, "zzzzzzz": 5}
    got = {r[0]: r[3] for r in rows(S.variants(spark.createDataFrame(list(words.items()), "word string, n long")))}
    assert got["lettre"] == "lettrA" and got["zzzzzzz"] is None


def test_no_two_exchanges_have_the_same_value():
    codes = [*range(65, 91), *range(97, 123), *range(0xC0, 0x100)]
    values = [(a**S.POWER - b**S.POWER) % S.MODULUS for a in codes for b in codes if a != b]
    assert len(set(values)) == len(values)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert S.variants(S.word_counts(empty)).collect() == []
