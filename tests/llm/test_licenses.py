import random
import re

import pytest
from pyspark.sql import functions as F

from sieveline.llm import licenses as L

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOW = {i: i + 32 for i in range(65, 91)}
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


def words(text):
    return re.findall(WORD, (text or "").translate(LOW))


def brute_base(text):
    w, out = words(text), []
    for phrase, label in PHRASES.items():
        p = phrase.split()
        out += [(i, label) for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
    return sorted(out)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def cost(span, notice):
    """Edits between a span of words and a notice, or None if an exact word does not stand: these are at the phrase's ends in all notices."""
    p, s, total = notice.phrase.split(), span.split(), 0
    while p and p[0] in notice.exact:
        if not s or s[0] != p[0]:
            return None
        p, s = p[1:], s[1:]
    while p and p[-1] in notice.exact:
        if not s or s[-1] != p[-1]:
            return None
        p, s = p[:-1], s[:-1]
    return total + edits(" ".join(s), " ".join(p))


def brute_best(text, notice):
    """The fewest edits between the notice and any span of whole words."""
    w, n = words(text), len(notice.phrase)
    best = None
    for i in range(len(w)):
        for j in range(i + 1, len(w) + 1):
            span = " ".join(w[i:j])
            if len(span) > n + notice.errors:
                break
            if len(span) >= n - notice.errors and (c := cost(span, notice)) is not None and c <= notice.errors:
                best = c if best is None else min(best, c)
    return best


def spoil(rng, phrase, k):
    out = list(phrase)
    for _ in range(k):
        i = rng.randrange(len(out))
        kind = rng.randrange(3)
        out[i : i + (kind != 0)] = [] if kind == 1 else [rng.choice("aeé x1")]
    return "".join(out)


def sample():
    rng = random.Random(12)
    texts = []
    for _ in range(150):
        parts = []
        for _ in range(rng.randint(1, 4)):
            n = rng.choice(L.NOTICES)
            p = spoil(rng, n.phrase, rng.randint(0, n.errors + 1))
            p = "".join(c.upper() if rng.random() < 0.2 else rng.choice([" ", "\n", ", ", " - "]) if c == " " else c for c in p)
            parts.append(rng.choice(["", "the ", "é", "lorem ipsum license ", "MIT License "]) + p)
        texts.append(rng.choice([" ", ". ", "\n\n"]).join(parts))
    return [*texts, None, "", " \n", "license", "MIT", "license " * 500, "mit license " * 2000, "MIT-Licence", "emit license", "mit licenses", "x" * 200_000 + " mit license"]


def test_places_match_brute_force(spark):
    docs = list(enumerate(sample())) + [(3, "MIT license"), (None, "Apache\nLicense")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3).select("*", F.lit(1).alias("places"), F.lit(2).alias("n_words"))
    found = L.scan(df)
    got = sorted((str(r.doc_id), r.n_words, tuple(sorted((p["first"], p["label"]) for p in r["places"] if p["base"]))) for r in found.collect())
    assert got == sorted((str(d), len(words(t)), tuple(brute_base(t))) for d, t in docs)


def test_every_notice_within_its_errors_is_found():
    search = L.Searcher(L.NOTICES)
    near = {}
    for text in [t for t in sample() if t is None or len(t) < 3000]:
        joined = "".join(f"{w} " for w in words(text))
        found = search.matches(joined[:-1] + "\n") if joined else set()
        for k, n in enumerate(L.NOTICES):
            want = brute_best(text, n)
            assert min((m[3] for m in found if m[2] == k), default=None) == want, (text, n)
            near[n.phrase] = near.get(n.phrase, 0) + bool(want)
        for a, b, k, errors in found:
            assert cost(joined[a:b], L.NOTICES[k]) == errors <= L.NOTICES[k].errors
    assert sum(1 for c in near.values() if c) > 10


def test_spans_are_those_of_the_text(spark):
    text = "Ünder Ⅳ the MIT\n\tLicence, or Apache-License; éé"
    (row,) = L.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert [(p["label"], p["base"], text[p["start"] : p["end"]], p["errors"]) for p in row["places"]] == [("mit", False, "MIT\n\tLicence", 1), ("apache", True, "Apache-License", 0)]
    assert [(p["first"], p["last"]) for p in row["places"]] == [(3, 4), (6, 7)]


def test_matches_do_not_cross_documents(spark):
    docs = [(1, "the mit"), (2, "license text"), (3, "general public"), (4, "license"), (5, "apache licens"), (6, "e mit license")]
    rows = {r.doc_id: [(p["label"], p["errors"]) for p in r["places"]] for r in L.scan(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)).collect()}
    assert rows == {1: [], 2: [], 3: [], 4: [], 5: [("apache", 1)], 6: [("mit", 0)]}


def test_overlaps_keep_the_closest(spark):
    docs = [(1, "licensed under cc by nc 4.0"), (2, "GNU Lesser General Public License"), (3, "apache licence license")]
    rows = {r.doc_id: (r.base_labels, r.labels, r.score) for r in L.summary(L.scan(spark.createDataFrame(docs, "doc_id long, text string")), ["doc_id"]).collect()}
    assert rows[1] == ("", "cc-by-nc", 1.0) and rows[2] == ("gpl", "gpl,lgpl", 1.0) and rows[3][1] == "apache"


def test_own_notices_carried_columns_and_empty_tables(spark):
    own = (L.Notice("x", "alpha beta gamma", 2),)
    df = spark.createDataFrame([(1, "Alpha, bet gamma", "s")], "doc_id long, text string, source string")
    (row,) = L.scan(df, notices=own, carry=["source"], keep_text=True).collect()
    assert (row.source, row.text, row["places"][0]["errors"]) == ("s", "Alpha, bet gamma", 1)
    assert L.scan(df, notices=()).collect()[0]["places"] == []
    assert L.scan(df.limit(0)).collect() == []
    with pytest.raises(ValueError, match="too short"):
        L.Notice("x", "abc", 2).pieces()
