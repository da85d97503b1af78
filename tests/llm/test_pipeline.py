import random

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.test_decontam import brute as contaminated
from tests.llm.test_linededup import brute as lines
from tests.llm.test_quality import brute as failed
from tests.llm.test_quality import naive_kept
from tests.llm.test_shingles import brute as copies

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


#: Documents of 40 words are called bad, but for one in ten; enough labels for a model to be fitted.
LABELS = [(i, int(i % 3 != 1 or i % 10 == 0)) for i in range(58)] + [(None, 0), (59, None), (7777, 1)]


def sample():
    rng = random.Random(21)
    word = lambda: "".join(rng.choice("abcdefgé") for _ in range(rng.randint(2, 8)))
    common = " ".join(word() for _ in range(12))
    items = [(i, " ".join(word() for _ in range(20))) for i in range(5)] + [(5, None)]
    docs = []
    for i in range(60):
        body = [word() + ("#$" if i % 3 == 1 and rng.random() < 0.3 else "") for _ in range(rng.choice([5, 40, 80]) if i % 3 != 1 else 40)]
        text = " ".join(body)
        if i % 4 == 0:
            text += "\n" + common.title()
        if i % 7 == 0:
            text += " " + items[i % 5][1]
        docs.append((i, text))
        if i % 9 == 0:
            docs.append((100 + i, text))
    docs += [(300, None), (301, ""), (None, docs[5][1]), (302, "x " * 4000)]
    return [(d, t, "en", f"s{k % 3}", None if t is None else len(t)) for k, (d, t) in enumerate(docs)], items


@pytest.fixture
def folder(spark, tmp_path):
    docs, items = sample()
    spark.createDataFrame(docs, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(d, q, 0) for d, q in LABELS], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def pairs(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_every_stage_against_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumn("c0", F.lit(1)).withColumn("kept", F.lit("x")).withColumn("component_id", F.lit(2)).withColumn("_keep", F.lit("k")).withColumn("_n_lines", F.lit(3))
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    quality, dedup, near, clean, pack = (f for _, f in corpus_pipeline.STAGES)
    before = pairs(docs)

    a = quality(spark, docs, folder)
    assert a.columns == docs.columns
    labels = [(r.doc_id, r.quality) for r in spark.read.parquet(f"{folder}/labels.parquet").collect()]
    good = naive_kept(before, labels)
    assert sorted(map(str, pairs(a))) == sorted(str(x) for x, k in zip(before, good, strict=True) if k)
    assert sum(good) < sum(not failed(t)[-1] for _, t in before)

    b = dedup(spark, docs, folder)
    assert b.columns == docs.columns and b.where("n_chars <> length(text)").count() == 0
    assert sorted((str(d), t) for d, t in pairs(b)) == [(d, t) for d, t, *_ in lines(before)]

    c = near(spark, docs, folder)
    classes = {root for _, root in copies(before)}
    assert c.columns == docs.columns and sorted(map(str, {d for d, _ in pairs(c)})) == sorted(map(str, classes))

    d = clean(spark, docs, folder)
    dirty = [w[0] for w in contaminated(before, items) if w[4]]
    assert d.columns == docs.columns and dirty
    assert sorted(str(x) for x, _ in pairs(d)) == sorted(str(w[0]) for w in contaminated(before, items) if not w[4])

    model = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    rows = pack(spark, docs, folder).collect()
    for doc, text in before[:20]:
        mine = sorted((r.start, r["ids"]) for r in rows if r.doc_id == doc)
        assert np.frombuffer(b"".join(x for _, x in mine), "<u4").tolist() == model.encode(text or "", add_special_tokens=False).ids + [1]


def test_run_and_empty_tables(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    step = docs
    for _, stage in corpus_pipeline.STAGES:
        step = stage(spark, step, folder)
    want = sorted(map(str, step.select("doc_id", "start", "length", "ids", "doc_tokens").collect()))
    got = sorted(map(str, corpus_pipeline.run(spark, folder).select("doc_id", "start", "length", "ids", "doc_tokens").collect()))
    assert got == want and len({x for x in got}) > 10
    none = tmp_path / "none"
    for name, schema in (("documents", SCHEMA), ("benchmark", "item_id long, text string"), ("labels", "doc_id long, quality int, toxic int")):
        spark.createDataFrame([], schema).write.parquet(f"{none}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(none)).collect() == []


def test_a_run_leaves_other_results_alone(spark, tmp_path):
    from sieveline.llm import linededup, simhash

    docs, items = sample()
    path = str(tmp_path)
    spark.createDataFrame(docs, SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame(LABELS, "doc_id long, quality int").write.parquet(f"{path}/labels.parquet")
    held = spark.read.parquet(f"{path}/documents.parquet")
    lazy = [simhash.near_duplicates(held), linededup.dedup_lines(held)]
    assert corpus_pipeline.run(spark, path).count() > 0
    assert all(r.count() == len(docs) for r in lazy)
