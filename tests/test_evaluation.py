import math
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from sieveline.operators.chunking import STRUCTURE, split_text
from sieveline.plans import evaluation as E
from sieveline.sources import files

KINDS = "post_id string, kind string, dup_type string, text string"


def embed(text):
    v = [0] * 64
    for w in re.split(r"\s+", text.lower()):
        if w:
            c = xxhash.xxh64_intdigest(w.encode(), 42)
            c = (c - 2**64 if c >= 2**63 else c) % 128
            v[c // 2] += 1 - 2 * (c % 2)
    n = math.sqrt(sum(x * x for x in v)) or 1
    return [x / n for x in v]


def chunks(text, size, overlap):
    return [c for c in split_text(text or "", size, overlap, STRUCTURE) if len(c) >= 100]


def brute(posts, threshold, compat, size, shared):
    at = {(p, k, t): x for p, k, t, x in posts}
    out = {}
    for (p, k, t), text in at.items():
        if k != "update" or (p, "base", None) not in at or (p, "ground_truth", t) not in at:
            continue
        base, new = chunks(at[p, "base", None], size, shared), chunks(text, size, shared)
        truth = set((at[p, "ground_truth", t] or "").lower().split())
        kept = [c for c in new if not any((c != b or not compat) and sum(x * y for x, y in zip(embed(c), embed(b), strict=True)) >= threshold for b in base)]
        overlap = lambda c, truth=truth: len(set(c.lower().split()) & truth) / min(len(set(c.lower().split())), len(truth)) if truth else 0
        tp = sum(overlap(c) >= 0.3 for c in kept)
        out[p, t] = (len(base), len(new), len(kept), tp, len(kept) - tp)
    return out


def sample():
    rng = random.Random(8)
    say = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 8))) for _ in range(n)) + ". "
    posts = []
    for i in range(8):
        old, fresh = [say(30) for _ in range(6)], [say(30) for _ in range(3)]
        posts.append((f"p{i}", "base", None, "".join(old)))
        posts += [(f"p{i}", "update", "exact", "".join(old[:3] + fresh)), (f"p{i}", "ground_truth", "exact", "".join(fresh))]
        changed = [s.replace("a", "aa", 3) for s in old]
        posts += [(f"p{i}", "update", "changed", "".join(fresh[:1] + changed)), (f"p{i}", "ground_truth", "changed", fresh[0])]
    return posts + [("p0", "update", "lone", "x" * 200), ("nobase", "update", "exact", "x" * 200), ("nobase", "ground_truth", "exact", "x"), ("p1", "update", "null", None), ("p1", "ground_truth", "null", None), (None, "update", "exact", "lost")]


@pytest.mark.parametrize("compat", [False, True])
def test_matches_brute_force(spark, compat):
    posts = sample()
    got = E.evaluate_posts(spark.createDataFrame(posts, KINDS).repartition(3), compat=compat, size=250, shared=40)
    rows = {(r.post_id, r.dup_type): r for r in got.collect()}
    want = brute(posts, 0.85, compat, 250, 40)
    assert {k: (r.base_chunks, r.update_chunks, r.unique_chunks, r.tp, r.fp) for k, r in rows.items()} == want
    for (_, n, kept, tp, _), r in ((want[k], r) for k, r in rows.items()):
        assert r.duplicate_chunks == n - kept and r.dedup_rate == pytest.approx((n - kept) / n if n else 0)
        assert r.precision == pytest.approx(tp / kept if kept else 0) and r.recall == (1 if tp else 0)
    if not compat:
        assert any(0 < r.duplicate_chunks < r.update_chunks for r in rows.values())
    types = {r.dup_type: r.posts for r in E.by_type(got).collect()}
    assert types == {"exact": 8, "changed": 8, "null": 1}


def test_from_post_folders(spark, tmp_path):
    for p, k, t, x in sample():
        if p and x:
            (tmp_path / p).mkdir(exist_ok=True)
            (tmp_path / p / (f"{k}.txt" if t is None else f"{k}_{t}.txt")).write_text(x)
    got = {(r.post_id, r.dup_type): r.unique_chunks for r in E.evaluate_posts(files.read_dataset(spark, str(tmp_path)), size=250, shared=40).collect()}
    assert got == {k: v[2] for k, v in brute([x for x in sample() if x[0] and x[3]], 0.85, False, 250, 40).items()}


def test_empty(spark):
    assert E.evaluate_posts(spark.createDataFrame([], KINDS)).collect() == []


def test_chunks_meet_those_of_their_own_post_only(spark):
    # vectors of another size for each post: they can only be compared within a post
    by_post = lambda c: F.when(F.startswith(c, F.lit("a")), F.array(F.lit(1.0), F.lit(0.0))).otherwise(F.array(F.lit(1.0))).cast("array<float>")
    posts = [(p, k, t, p * 120) for p in "ab" for k, t in (("base", None), ("update", "exact"), ("ground_truth", "exact"))]
    got = E.evaluate_posts(spark.createDataFrame(posts, KINDS), embed=by_post).collect()
    assert sorted((r.post_id, r.update_chunks, r.duplicate_chunks) for r in got) == [("a", 1, 1), ("b", 1, 1)]
