import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sieveline.llm import lm

LOW = {i: i + 32 for i in range(65, 91)}


def brute(docs, order=3, alpha=0.4, least=2):
    words = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW)) for _, t in docs]
    c = Counter(tuple(w[i : i + k]) for w in words for k in range(1, order + 1) for i in range(len(w) - k + 1))
    n, out = sum(map(len, words)), []
    for (doc, _), w in zip(docs, words, strict=True):
        total, single = 0.0, 0
        for i in range(len(w)):
            top = min(i + 1, order)
            for k in range(top, 0, -1):
                g = tuple(w[i - k + 1 : i + 1])
                if k == 1:
                    total, single = total + math.log(alpha ** (top - 1) * c[g] / n), single + 1
                elif c[g] >= least:
                    total += math.log(alpha ** (top - k) * c[g] / c[g[:-1]])
                    break
        out.append((str(doc), len(w), single, round(total, 6), None if not w else round(total / len(w), 6)))
    return sorted(out, key=str)


def sample():
    rng = random.Random(13)
    vocab = [f"w{i}" for i in range(30)] + ["É", "Wx", "l" * 600]
    docs = [(i, " ".join(rng.choice(vocab) for _ in range(rng.choice([0, 1, 2, 3, 50, 200])))) for i in range(60)]
    return docs + [(900, None), (901, " \n\t"), (5, docs[8][1]), (5, docs[8][1]), (None, docs[9][1]), (902, "deep " * 9000)]


@pytest.mark.parametrize(("order", "least"), [(3, 2), (2, 1), (1, 1)])
def test_matches_brute_force(spark, order, least):
    docs = sample()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3).select("*", F.lit(1).alias("n_words"), F.lit(1).alias("part"))
    got = lm.score(df, order=order, min_count=least, group_bytes=1500).select(
        "doc_id", "n_words", "n_backed_off", F.round("log_score", 6), F.round("mean_log_score", 6)
    )
    assert sorted(((str(r[0]), *r[1:]) for r in got.collect()), key=str) == brute(docs, order, least=least)


def test_empty_table(spark):
    assert lm.score(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_equal_rows_make_no_large_group(spark):
    docs = [(7, "the same few words again")] * 5000 + [(None, "x " * 50)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = lm.score(df, group_bytes=2000).select("doc_id", "n_words", "n_backed_off", F.round("log_score", 6), F.round("mean_log_score", 6)).collect()
    assert sorted(((str(r[0]), *r[1:]) for r in got), key=str) == brute(docs)
    sizes = df.select("doc_id", "text").mapInArrow(lm._grouped(2000), "part long, body binary").collect()
    assert len({r.part for r in sizes}) == len(sizes) and max(lm._opened(bytes(r.body)).num_rows for r in sizes) <= 180


def test_ranges_are_those_that_have_keys():
    import numpy as np

    keys = np.array([0, 5, (1 << 62) + 4, (1 << 64) - 1], np.uint64)
    assert lm._ranges(keys, 4) == ([0, 1, 3], [0, 2, 3, 4]) and lm._ranges(keys, 1) == ([0], [0, 4]) and lm._ranges(keys[:0], 9) == ([], [0])


def test_texts_that_come_in_another_order_are_an_error(spark):
    import pyarrow as pa

    docs = [(i, f"words of document {i} and {i * i} more " * 9) for i in range(40)]
    rows = spark.createDataFrame(docs, "doc long, text string").mapInArrow(lm._grouped(500), "part long, body binary").collect()
    a, b = (pa.array([bytes(r.body)], pa.binary()) for r in rows[:2])
    part = pa.array([rows[0].part], pa.int64())
    entries = pa.Table.from_batches(list(lm._list(4, 3)(iter([pa.RecordBatch.from_arrays([part, a], names=["part", "body"])]))))
    answers, run = lm._count(entries), lm._score(4, 3, 0.4, 2, pa.int64())
    assert run(pa.table({"part": part, "body": a}), answers).num_rows > 0
    with pytest.raises(ValueError, match="another order"):
        run(pa.table({"part": part, "body": b}), answers)
