import hashlib
import random
import re

from pyspark.sql import functions as F

from sieveline.llm import decontam
from sieveline.session import Tables

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return (text or "").translate({i: i + 32 for i in range(65, 91)})


def brute(docs, items, size=13):
    wins = {}
    for item, text in items:
        w = WORD.findall(lower(text))
        for k in range(max(len(w) - size, 0) + 1 if w else 0):
            wins.setdefault(tuple(w[k : k + size]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, ids = WORD.findall(lower(text)), set(), set()
        for n in {len(k) for k in wins}:
            for i in range(len(w) - n + 1):
                if own := wins.get(tuple(w[i : i + n])):
                    hit |= set(range(i, i + n))
                    ids |= own
        out.append((doc, len(w), len(hit), tuple(sorted(x for x in ids if x is not None)), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def sample(seed=1):
    rng = random.Random(seed)
    vocab = ["a", "Be", "çé", "ß9", "longer" * 60, "x1", "Ünd", "the"]
    line = lambda n: " ".join(rng.choice(vocab) + rng.choice(["", ",", "!", "\n"]) for _ in range(n))
    items = [(i, line(n)) for i, n in enumerate([30, 13, 14, 5, 1, 20])] + [(90, ""), (91, None), (92, "Zzz")]
    docs = [(i, line(rng.choice([0, 1, 12, 13, 60, 300]))) for i in range(30)]
    docs += [(100, items[0][1]), (101, line(40) + " " + items[1][1].upper() + " " + line(9)), (102, None), (103, ""), (103, ""), (None, items[0][1]), (104, "q " * 4000 + items[0][1])]
    return docs, items


def rows(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in df.collect()), key=str)


def test_matches_brute_force(spark):
    docs, items = sample()
    d, b = spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    assert rows(decontam.scan(d, b)) == want
    assert rows(decontam.scan(d, b, block_bytes=600)) == want  # several blocks
    extra = d.select("doc_id", "text", F.lit("x").alias("n_hit"), F.lit(1).alias("items"), F.lit(2).alias("_t"))
    assert rows(decontam.scan(extra, b)) == want
    left = decontam.clean(extra, b)
    assert left.columns == extra.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(str(w[0]) for w in want if not w[4])


def test_spans_go_and_the_rest_stays(spark):
    item = " ".join(f"w{i}" for i in range(13))
    d = spark.createDataFrame([(1, f"Keep this. {item.upper()}! And that."), (2, "clean")], "doc_id long, text string")
    b = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {r.doc_id: r.text for r in decontam.clean(d, b, remove="spans").collect()}
    assert got == {1: "Keep this. ! And that.", 2: "clean"}


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert decontam.scan(docs, items).collect() == []
    one = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert rows(decontam.scan(one, items)) == [(1, 2, 0, (), False)]


def test_a_window_in_many_items_and_a_long_item(spark):
    line = " ".join(f"w{i}" for i in range(13))
    long = " ".join(f"x{i}" for i in range(300_000))
    items = spark.range(10_000).selectExpr("id as item_id", f"'{line}' as text").union(spark.createDataFrame([(20_000, long), (None, "only here")], "item_id long, text string"))
    docs = spark.createDataFrame([(1, line), (2, "a b " + line.upper() + " c"), (None, line), (3, "x5 " + " ".join(f"x{i}" for i in range(400, 420))), (4, "only here"), (5, "clean")], "doc_id long, text string")
    got = {r.doc_id: (r.n_hit, len(r["items"]), r.contaminated) for r in decontam.scan(docs, items).collect()}
    assert got == {1: (13, 10_000, True), 2: (13, 10_000, True), None: (13, 10_000, True), 3: (20, 1, True), 4: (2, 0, True), 5: (0, 0, False)}
    assert decontam.scan(docs, items, items=False).columns == ["doc_id", "n_words", "n_hit", "spans", "contaminated"]


def test_digests_of_items_that_share_windows(spark):
    """Many documents that hold differing parts of a passage of many items: items are listed once for each class of windows."""
    passage, other = (" ".join(f"{c}{i}" for i in range(60)) for c in "pq")
    items = [(i, passage) for i in range(2000)] + [(2000 + i, f"{passage.split(' ', 20)[-1]} {other}") for i in range(3)] + [(None, other)]
    docs = [(i, " ".join(passage.split()[i % 40 : i % 40 + 14 + i % 7]) + f" and {i}") for i in range(600)] + [(900, other), (901, "none"), (902, None)]
    d, b = spark.createDataFrame(docs, "doc_id long, text string").repartition(4), spark.createDataFrame(items, "item_id long, text string")
    want = {}
    for doc, text in docs:
        w = (text or "").split()
        own = {" ".join(w[k : k + 13]) for k in range(len(w) - 12)}
        want[doc] = {i for i, t in {0: passage, 2000: items[2000][1], 2001: items[2001][1]}.items() if own & {" ".join(t.split()[k : k + 13]) for k in range(len(t.split()) - 12)}}
    full = lambda ids: sorted(str(i) for i in ([*range(2000)] if 0 in ids else []) + ([2000, 2001, 2002] if 2000 in ids else []))
    got = {r.doc_id: (r.n_items, r.items_sha256) for r in decontam.scan(d, b, items="digest").collect()}
    assert got == {doc: (len(full(ids)), hashlib.sha256(",".join(full(ids)).encode()).hexdigest()) for doc, ids in want.items()}
    assert len({g for g in got.values()}) > 3
    with Tables(spark) as own:
        decontam.scan(d, b, items="digest").collect()
        held = [p for p in own.paths if "window-sets" in p]
        assert spark.read.parquet(*held).select("classes").distinct().count() <= 4  # of some 600 sets of windows
        own.clear()
