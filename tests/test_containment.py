import random

import pytest

from sieveline.operators import containment as C


def words(text):
    return {w for w in (text or "").lower().split() if w}


def overlap(a, b):
    a, b = words(a), words(b)
    return len(a & b) / min(len(a), len(b)) if a and b else 0.0


def sample(seed=1):
    rng = random.Random(seed)
    vocab = ["the", "of", "and"] * 20 + [f"w{i}" for i in range(300)]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    truth = [(i, text(rng.choice([1, 3, 12, 60]))) for i in range(40)] + [(3, "the of repeated id"), (50, ""), (51, None), (None, "the of")]
    docs = [(i, text(rng.choice([0, 1, 5, 40, 200]))) for i in range(120)]
    docs += [(200 + i, f"{rng.choice(truth)[1] or ''} {text(rng.choice([0, 3, 30]))}") for i in range(60)]
    return [*docs, (5, "again the"), (None, None), (None, "OF\n\tTHE"), (None, "OF\n\tTHE"), (900, "unknown words only"), (901, "long " + " ".join(f"v{i}" for i in range(50_000)))], truth


def frames(spark, docs, truth):
    return spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(truth, "item_id long, text string").repartition(2)


def test_best_item_of_each_row_for_any_block_and_threshold(spark):
    docs, truth = sample()
    d, t = frames(spark, docs, truth)
    want = []
    for doc, text in docs:
        each = [(overlap(text, b), -i) for i, b in truth if i is not None]
        o, i = max(each)
        want.append((str(doc), -i, round(o, 9)))
    for size, least in ((1 << 20, 0.8), (3000, 0.8), (3000, 0.3), (9000, 1.0), (3000, 0.01)):
        got = [(str(r.doc_id), r.item_id, round(r.overlap, 9)) for r in C.best_containment(d, t, "doc_id", "item_id", block_bytes=size, least=least).collect()]
        assert sorted(got) == sorted(want), (size, least)


@pytest.mark.parametrize("threshold", [0.1, 0.3, 0.5, 0.85, 1.0])
def test_the_index_finds_all_pairs(spark, threshold):
    docs, truth = sample(2)
    d, t = frames(spark, docs, truth)
    got = sorted((str(r.doc_id), str(r.item_id), round(r.overlap, 9)) for r in C.containing(d, t, "doc_id", "item_id", threshold=threshold).collect())
    assert got == sorted((str(i), str(j), round(overlap(a, b), 9)) for i, a in docs for j, b in truth if overlap(a, b) >= threshold)
    with pytest.raises(ValueError, match="threshold"):
        C.containing(d, t, "doc_id", "item_id", threshold=0)


def test_empty_sides(spark):
    docs, truth = sample()
    d, t = frames(spark, docs, truth)
    assert C.best_containment(d.limit(0), t, "doc_id", "item_id").collect() == []
    rows = C.best_containment(d, t.limit(0), "doc_id", "item_id").collect()
    assert len(rows) == len(docs) and all(r.item_id is None and r.overlap == 0 for r in rows)
    assert C.containing(d, t.limit(0), "doc_id", "item_id").collect() == []
