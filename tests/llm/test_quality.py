import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from sieveline.llm import quality as Q


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = text.split("\n")
    dup = sum(1 for i, x in enumerate(lines) if x.strip(" \t\n\v\f\r") and x in lines[:i])
    grams = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    often, hit = Counter(grams), set()
    for i, g in enumerate(grams):
        if often[g] > 1:
            hit |= set(range(i, i + 8))
    n, rep = len(w), len(hit)
    return n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, rep, n < 20 or 100 * rep > 30 * n


def sample():
    rng = random.Random(2)
    vocab = ["a", "é|é", "Zwei", "#", "l" * 300, "x9", "<b>", "ç"]
    gap = lambda: rng.choice([" ", " ", "\n", "\t ", "\r\n", "\x0b", " "])
    texts = ["".join(rng.choice(vocab[: rng.randint(1, 8)]) + gap() for _ in range(rng.choice([0, 3, 19, 20, 21, 90]))) for _ in range(80)]
    return [*texts, None, "", "\n\n", "a\na\n a\na", "same line\nsame line", "w " * 5000, "y" * 200_000]


def test_counts_match_brute_force(spark):
    docs = list(enumerate(sample())) + [(3, "again"), (None, "no id")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3).select("*", F.lit(7).alias("n_words"), F.lit(1).alias("kept"))
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = Q.train(df, none)
    got = sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) for r in Q.judge(df, model).collect())
    assert got == sorted((str(d), *b, not b[-1]) for d, t in docs for b in [brute(t)])
    assert Q.keep_good(df, none).columns == df.columns


def naive_scores(known, wanted, signs, trees=60, depth=3, rate=0.15, bins=64, penalty=1.0, least=5):
    """Scores of the rows ``wanted`` by trees that are grown recursively, each split tried by itself on ``known`` (x, y)."""
    x, y = known
    cuts = [sorted(set(np.quantile(x[:, f], [k / bins for k in range(1, bins)]).tolist())) for f in range(x.shape[1])]
    margin, out = np.full(len(y), np.log(y.mean() / (1 - y.mean()))), np.full(len(wanted), np.log(y.mean() / (1 - y.mean())))

    def grow(rows, low, high, level):
        bound = lambda v: min(max(v, low), high)
        cost = lambda r, v: g[r].sum() * v + (h[r].sum() + penalty) * v * v / 2
        best_of = lambda r: bound(-g[r].sum() / (h[r].sum() + penalty))
        value = best_of(rows)
        best = None
        if level < depth and len(rows) >= 2 * least:
            for f, sign in enumerate(signs):
                for c in cuts[f]:
                    left, right = rows[x[rows, f] <= c], rows[x[rows, f] > c]
                    if min(len(left), len(right)) < least:
                        continue
                    a, b = best_of(left), best_of(right)
                    if (b - a) * sign < 0:
                        continue
                    loss = cost(left, a) + cost(right, b)
                    if best is None or loss < best[0] - 1e-12:
                        best = (loss, f, c, sign, (a + b) / 2, left, right)
        if best is None or best[0] > cost(rows, value) - 1e-6:
            return rate * value
        _, f, c, sign, middle, left, right = best
        ends = {0: ((low, high), (low, high)), 1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}[sign]
        return f, c, grow(left, *ends[0], level + 1), grow(right, *ends[1], level + 1)

    def value_of(tree, row):
        while isinstance(tree, tuple):
            tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
        return tree

    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        tree = grow(np.arange(len(y)), -np.inf, np.inf, 0)
        margin += [value_of(tree, row) for row in x]
        out += [value_of(tree, row) for row in wanted]
    return 1 / (1 + np.exp(-out))


def naive_kept(docs, labels):
    """{row: kept} of (id, text) rows by the base rules and the naive trees; ids of labelled rows must be unique."""
    x = [Q.features(Q.statistics(pa.array([t], pa.string())))[0] for _, t in docs]
    at = {d: i for i, (d, _) in enumerate(docs) if d is not None}
    used = sorted((d, q) for d, q in labels if d in at and q is not None)
    known = np.array([x[at[d]] for d, _ in used]), np.array([float(q > 0) for _, q in used])
    scores = naive_scores(known, np.array(x), list(Q.FEATURES.values()))
    return [not brute(t)[-1] and bool(s >= Q.THRESHOLD) for (_, t), s in zip(docs, scores, strict=True)]


def test_verdicts_match_naive_trees(spark):
    rows = planted(random.Random(11), 160)
    labels = [(r[0], r[2] if k % 7 else 1 - r[2]) for k, r in enumerate(rows[:90])] + [(None, 0), (3, None), (7777, 1)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.kept for r in Q.judge(docs, Q.train(docs, spark.createDataFrame(labels, "doc_id long, quality int"))).collect()}
    want = naive_kept([r[:2] for r in rows], labels)
    assert [got[r[0]] for r in rows] == want and 0 < sum(want) < len(want)


def test_repeated_ids_bring_no_more_rows_than_the_bound(spark, monkeypatch):
    seen = []
    whole = Q.fit
    monkeypatch.setattr(Q, "fit", lambda x, y, *a: seen.append(len(x)) or whole(x, y, *a))
    docs = spark.range(5000).selectExpr("1L as doc_id", "concat('some text ', id) as text").unionByName(spark.range(2, 50).selectExpr("id as doc_id", "'other text' as text"))
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(1, 1)] * 30, "doc_id long, quality int")
    Q.train(docs, labels, max_rows=20)
    Q.train(docs, labels)
    assert seen[0] <= 20 and seen[1] == 69


def planted(rng, n):
    rows = []
    for i in range(n):
        good = rng.random() < 0.7
        body = [rng.choice(["tree", "river", "stone", "walks", "over", "under", "softly"]) + str(rng.randint(0, 400)) * (rng.random() < 0.2) for _ in range(rng.randint(30, 90))]
        if not good:
            body = [w + rng.choice(["###", "$$$", "%%%", ""]) for w in body]
        rows.append((i, " ".join(body), int(good)))
    return rows


def test_held_out_accuracy_and_same_model_twice(spark):
    rows = planted(random.Random(4), 900)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows[:500]] + [(None, 1), (5, None), (99999, 0)], "doc_id long, quality int")
    model = Q.train(docs, labels)
    again = Q.train(docs.repartition(2), labels)
    assert np.array_equal(model.value, again.value) and np.array_equal(model.threshold, again.threshold)
    kept = {r.doc_id: r.kept for r in Q.judge(docs, model).collect()}
    right = sum(kept[i] == bool(y) for i, _, y in rows[500:] )
    assert right >= 0.95 * 400


def test_monotonic_and_flat_trees():
    rng = np.random.RandomState(0)
    x = rng.rand(2000, 3)
    y = (x[:, 0] + 0.3 * np.sin(9 * x[:, 1]) + 0.2 * rng.randn(2000) < 0.6).astype(float)
    model = Q.fit(x, y, [-1, 0, 1], depth=3)
    for f, sign in ((0, -1), (2, 1)):
        probe = np.repeat(rng.rand(50, 3), 40, axis=0)
        probe[:, f] = np.tile(np.linspace(0, 1, 40), 50)
        step = np.diff(model.scores(probe).reshape(50, 40), axis=1) * sign
        assert (step >= -1e-12).all()

    def walk(t, row):  # node by node
        node = 0
        while model.left[t, node] != node:
            node = model.left[t, node] if row[model.feature[t, node]] <= model.threshold[t, node] else model.right[t, node]
        return model.value[t, node]

    want = [model.start + sum(walk(t, row) for t in range(len(model.feature))) for row in x[:50]]
    assert np.allclose(want, model.margins(x[:50]))
    assert ((model.scores(x) > 0.5) == y).mean() > 0.85


def test_empty_and_one_class(spark):
    assert Q.judge(spark.createDataFrame([], "doc_id long, text string"), Q.fit(np.zeros((0, 14)), np.zeros(0), [0] * 14)).collect() == []
    assert Q.fit(np.zeros((90, 1)), np.ones(90), [0]).scores(np.zeros((2, 1))).min() > 0.99
    assert Q.statistics(pa.array([], pa.string()))["n_words"].tolist() == []
