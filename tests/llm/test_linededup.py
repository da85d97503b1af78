import hashlib
import random
from collections import defaultdict

from pyspark.sql import functions as F

from sieveline.llm.linededup import dedup_lines

LOW = {i: i + 32 for i in range(65, 91)}


def brute(docs):
    key = lambda x: x.strip(" \t\n\v\f\r").translate(LOW)
    held = defaultdict(set)
    for doc, text in docs:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 40 and doc is not None:
                held[key(line)].add(doc)
    out = []
    for doc, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (len(own := held.get(key(x), ())) >= 5 and doc != max(own))]
        out.append((str(doc), "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out)


def test_matches_brute_force(spark):
    rng = random.Random(3)
    lines = ["é" * 39, "é" * 40, "É" * 40, "Common Licence Line, All Rights Reserved By Everyone", "short", "", " " * 50, "x" * 41, " " * 45]
    docs = [(i, "\n".join(rng.choice(lines) + rng.choice(["", " ", "\t", "\r"]) + rng.choice(["", str(i) * 20]) for _ in range(rng.randint(0, 9)))) for i in range(60)]
    docs += [(900, None), (901, ""), (902, "\n\n"), (5, docs[7][1]), (None, docs[9][1]), (None, lines[3]), (903, lines[3] + "\n" + "y" * 300_000 + "\n" + lines[3].upper())]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4).select("*", F.lit(1).alias("keys"), F.lit("a").alias("_n_lines_"), F.lit(2).alias("c0"))
    got = dedup_lines(df)
    assert got.columns == [*df.columns, "_n_lines", "_n_dropped"]
    assert sorted((str(r.doc_id), r.text, r["_n_lines"], r["_n_dropped"]) for r in got.collect()) == brute(docs)


def test_empty_table(spark):
    assert dedup_lines(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_rows_without_an_id_get_their_own_lines_only(spark):
    from sieveline.llm.linededup import MIN_CHARS, MIN_DOCS, dropped_keys

    wide = [f"line {i} that stands in many of the documents of the table" for i in range(40)]
    docs = [(i, "\n".join(wide)) for i in range(6)] + [(None, wide[i % 40] + f"\nown {i // 40}") for i in range(10_000)] + [(3, wide[7])] * 5
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    lost = dropped_keys(df, "doc_id", "text", MIN_CHARS, MIN_DOCS)
    assert lost.where("doc is null").selectExpr("max(size(keys)) as m", "count(*) as n").first()[:] == (1, 10_000)
    got = dedup_lines(df)
    assert sorted((str(r.doc_id), r.text, r["_n_lines"], r["_n_dropped"]) for r in got.collect()) == brute(docs)
