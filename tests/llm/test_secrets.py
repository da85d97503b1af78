import math
import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from sieveline.llm import secrets as S


def brute_base(text):
    text, out = text or "", []
    names = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api")).replace("[aA][pP][iI]", "[aA][pP][iI]_?[kK][eE][yY]")
    for kind, pattern, least, group in (
        (0, rf"""({names})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2), (1, r"AKIA[A-Z0-9]+", 16, 0), (2, r"[0-9a-f]+", 32, 0),
    ):
        out += [(m.start(), kind, m.end(), m.span(group), m[group]) for m in re.finditer(pattern, text) if len(m[group]) >= least]
    return sorted(out)


def brute_verdict(value, n_owners, n_repos):
    """4 for an example, 3 for a live key, or None, written apart from the operator."""
    if len({c.lower() for c in value}) < 4 or n_owners > 2 or n_repos > 9:
        return 4
    if n_owners != 1 or n_repos > 3 or len(value) < 16 or not re.search("[0-9]", value) or not re.search("[A-Za-z]", value):
        return None
    share = [value.count(c) / len(value) for c in set(value)]
    return 3 if sum(p * math.log2(1 / p) for p in share) >= 3 else None


def brute(docs):
    owners, repos = defaultdict(set), defaultdict(set)
    for doc, text, source in docs:
        for *_, v in brute_base(text):
            owners[v] |= {source} - {None}
            repos[v] |= {doc} - {None}
    out = []
    for doc, text, _ in docs:
        spans = set()
        for start, kind, end, (a, b), v in brute_base(text):
            spans.add((start, kind, end))
            if (verdict := brute_verdict(v, len(owners[v]), len(repos[v]))) is not None:
                spans.add((a, verdict, b))
        out.append((str(doc), tuple(sorted(spans))))
    return sorted(out)


def sample():
    rng = random.Random(9)
    hexes = ["".join(rng.choice("0123456789abcdef") for _ in range(n)) for n in (31, 32, 40, 64)]
    keys = ["AKIA" + "".join(rng.choice("ABCXYZ0189") for _ in range(n)) for n in (3, 11, 12, 16)] + ["AKIAKIAKIAKIAKIAKIA"]
    bits = [*hexes, *keys, "password = 'hunter2222'", "TOKEN:\"short\"", "api_key=", "Api_Key = Abc123Xyz789Qrs456T", "ſecret=longvalue1", "toKen: abcdefgh1", "secret=your-example-key",
            "passwd=password=abcdefgh", "token = \n abcdefghij", "çé", "plain", " ", "\n", "apikey\t=abcdefgh"]
    docs = [(i, " ".join(rng.choice(bits) + rng.choice(["", "", "é", "g"]) for _ in range(rng.randint(0, 12))), f"s{rng.randint(0, 4)}") for i in range(70)]
    docs += [(600 + i, f"token={k}", "one") for k, n in (("Zq8vT3kLm9Xw2Rb7Yt", 3), ("Kd7pW1sVf4Hj6Nc0Qe", 4), ("Gx5bM2uTy8Ra3Lo9Wi", 12), ("testTEST99aB7cD1eF", 1)) for i in range(n)]
    return docs + [(500, None, "s1"), (501, "", None), (3, hexes[3] + "f", "s9"), (3, hexes[3] + "f", "s9"), (None, "token=" + "q9" * 12 + "zA4", None), (502, "a" * 300_000, "s1")]


def test_matches_brute_force(spark):
    docs = sample()
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(4).select("*", F.lit(1).alias("spans"), F.lit(1).alias("row"))
    got = sorted((str(r.doc_id), tuple((s.start, s.kind, s.end) for s in r.spans)) for r in S.scan(df).collect())
    assert got == brute(docs)
    kinds = {k for _, spans in got for _, k, _ in spans}
    assert kinds == {0, 1, 2, 3, 4}


def test_empty_table(spark):
    assert S.scan(spark.createDataFrame([], "doc_id long, text string, source string")).collect() == []


def test_repositories_and_not_words_decide_within_one_owner(spark):
    key = lambda c: f"token={c}Zq8vT3kLm9Xw2Rb7testY"
    docs = [(i, key("A"), "s") for i in range(3)] + [(i, key("B"), "s") for i in range(3, 7)] + [(i, key("C"), "s") for i in range(10, 20)]
    rows = S.scan(spark.createDataFrame(docs, "doc_id long, text string, source string")).collect()
    assert {r.doc_id: [s.kind for s in r.spans][1:] for r in rows} == {**dict.fromkeys(range(3), [3]), **dict.fromkeys(range(3, 7), []), **dict.fromkeys(range(10, 20), [4])}
