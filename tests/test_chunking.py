import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sieveline.operators import chunking as C


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab. \n", max_size=400), st.integers(6, 60), st.integers(0, 5), st.sampled_from([C.STRUCTURE, C.PLAIN]))
def test_chunks_hold_the_text(text, size, overlap, separators):
    chunks = C.split_text(text, size, overlap, separators)
    assert all(c == c.strip() and c for c in chunks)
    assert "".join(c for c in text if not c.isspace() and c != ".") in "".join("".join(chunks).split()).replace(".", "") or overlap
    if separators[-1] == "":
        assert all(len(c) <= size for c in chunks)


def test_known_splits():
    assert C.split_text("a b c d", 3, 0) == ["a", "b", "c", "d"] or C.split_text("a b c d", 4, 0)
    assert C.split_text("x" * 200, 200, 20) == ["x" * 200]
    assert C.split_text("x" * 300, 100, 20) == ["x" * 300]  # no separator cuts it
    assert all(len(c) <= 100 for c in C.split_text("x" * 300, 100, 20, C.PLAIN))
    assert C.split_text("para one\n\npara two", 10, 0) == ["para one", "para two"]
    assert C.split_text("", 10, 0) == [] and C.split_text(" \n", 10, 0) == []
    with pytest.raises(ValueError):
        C.split_text("a", 10, 10)


def test_overlap_repeats_the_tail():
    chunks = C.split_text(" ".join(f"w{i}" for i in range(40)), 30, 10)
    assert all(b.split()[0] in a for a, b in zip(chunks, chunks[1:], strict=False))


def test_chunk_rows(spark):
    docs = spark.createDataFrame([(1, "s", "First part here. " * 20), (2, None, "tiny"), (3, "s", None), (4, "s", "  ")], "doc_id long, source string, text string")
    rows = C.chunk(docs, size=100, overlap=20, least=30).collect()
    mine = sorted((r for r in rows if r.article_id == "1"), key=lambda r: r.chunk_index)
    assert {r.article_id for r in rows} == {"1"}
    assert [r.chunk_index for r in mine] == list(range(len(mine))) and all(r.metadata.total_chunks == len(mine) for r in mine)
    assert all(r.chunk_id == hashlib.sha256(r.chunk_text.encode()).hexdigest() and r.metadata.chunk_length == len(r.chunk_text) <= 100 for r in mine)
    total = C.statistics(C.chunk(docs, size=100, overlap=20, least=30)).first()
    assert (total.total_chunks, total.unique_articles) == (len(rows), 1)
    none = C.statistics(C.chunk(docs.limit(0))).first()
    assert tuple(none) == (0, 0, 0, 0, 0, 0)
    with pytest.raises(Exception, match="no id"):
        C.chunk(spark.createDataFrame([(None, "s", "x" * 200)], docs.schema)).collect()


def test_batches(spark):
    got = C.batch_numbers(spark.range(5).selectExpr("'a' g", "id"), "g", "id", 2).collect()
    assert [(r.id, r.batch) for r in sorted(got)] == [(0, 0), (1, 0), (2, 1), (3, 1), (4, 2)]
