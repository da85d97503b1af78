import hashlib
import json
import os
import re
import shutil
import subprocess
import sys

import pytest

from jobs import article_intake as J
from jobs import settings

DATA = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
FIELDS = ("doc_id", "content_id", "original", "reason", "n_chars", "summary", "rate", "batch", "status")


def write(spark, folder, rows):
    """One more file of articles (doc_id, text)."""
    spark.createDataFrame([(d, t, "en", f"s{(d or 0) % 3}") for d, t in rows], J.ARTICLE).coalesce(1).write.mode("append").parquet(folder)


def rows(df):
    return sorted((tuple(r[f] for f in FIELDS) for r in df.collect()), key=str)


def clean(text):
    edge = "[\t-\r \x1c-\x1f\x85\xa0]+"
    return re.sub(f"{edge}$", "", re.sub(f"^{edge}", "", re.sub("\n+", "\n", text or "")))


def brute(batches):
    """(doc_id, content_id, original, reason, batch, status) of every delivered row."""
    first, out = {}, []
    for number, batch in enumerate(batches):
        fresh = {}
        for d, t in batch:
            if d is not None and clean(t) and clean(t) not in first:
                fresh[clean(t)] = min(d, fresh.get(clean(t), d))
        taken = set()
        for d, t in batch:
            reason = "no id" if d is None else None if clean(t) else "no text"
            content = None if reason else hashlib.sha256(clean(t).encode()).hexdigest()
            original = None if reason else first.get(clean(t), fresh.get(clean(t)))
            new = not reason and clean(t) in fresh and d == original and clean(t) not in taken
            if new:
                taken.add(clean(t))
            out.append((d, content, original, reason, number, "rejected" if reason else "new" if new else "copy"))
        first |= fresh
    return sorted(out, key=str)


BATCHES = [
    [(5, "One. Two. Three."), (2, "One. Two. Three.\n"), (9, "x" * 300 + ". Second! Third? Fourth."), (7, None), (8, " \n\t"), (None, "no id"), (4, "alone"), (4, "alone"), (6, "\x0bedge\x1c\xa0")],
    [(1, "One. Two. Three."), (4, "alone"), (4, "alone, edited"), (3, "A\n\n\nB"), (10, "A\nB"), (11, "")],
    [(12, "long " * 100_000), (13, "A\nB"), (14, "new again")],
]


def test_growing_input_is_taken_once(spark, tmp_path):
    source, out, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    seen = 0
    for number, batch in enumerate(BATCHES):
        write(spark, source, batch)
        got = J.run(spark, source, out, log)
        assert sorted(((r.doc_id, r.content_id, r.original, r.reason, r.batch, r.status) for r in got.collect()), key=str) == brute(BATCHES[: number + 1])
        assert got.count() == (seen := seen + len(batch))
    before = rows(got)
    assert rows(J.run(spark, source, out, log)) == before  # nothing new
    new = {r.doc_id: r for r in got.where("status = 'new'").collect()}
    assert new[9].summary == "x" * 300 + ". Second!" and new[2].summary == "One. Two. Three." and abs(new[2].rate - 0.008) < 1e-9
    assert new[12].rate == -0.02 and new[12].n_chars == 499_999 and all(r.summary is None and r.rate is None for r in got.where("status <> 'new'").collect())


def test_a_batch_that_broke_off_comes_out_the_same(spark, tmp_path):
    source, out, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    for number, batch in enumerate(BATCHES[:2]):
        write(spark, source, batch)
        want = rows(J.run(spark, source, out, log))
        for name in (f"{number}", f".{number}.crc"):  # it was written, but not committed
            os.remove(f"{log}/commits/{name}")
        assert rows(J.run(spark, source, out, log)) == want
        os.remove(f"{log}/commits/{number}")
        os.remove(f"{log}/commits/.{number}.crc")
        shutil.rmtree(f"{out}/batch={number}")  # it was not even written
        assert rows(J.run(spark, source, out, log)) == want


def test_one_file_a_batch_or_all_at_once_hold_the_same_rows(spark, tmp_path):
    source = str(tmp_path / "in")
    for batch in BATCHES:
        write(spark, source, batch)
    one = J.run(spark, source, str(tmp_path / "a"), str(tmp_path / "a-log"), J.Config(files_per_batch=1))
    all_ = J.run(spark, source, str(tmp_path / "b"), str(tmp_path / "b-log"))
    assert one.select("batch").distinct().count() == 3 and all_.select("batch").distinct().count() == 1
    for f in (one, all_):
        assert f.count() == sum(map(len, BATCHES)) and f.where("status = 'new'").select("content_id").distinct().count() == f.where("status = 'new'").count()
    assert {r.content_id for r in one.where("status = 'new'").collect()} == {r.content_id for r in all_.where("status = 'new'").collect()}


def test_parts_that_do_not_belong_together_are_an_error(spark, tmp_path):
    source, out, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    write(spark, source, BATCHES[0])
    J.run(spark, source, out, log)
    with pytest.raises(ValueError, match="do not belong together"):
        J.run(spark, source, out, str(tmp_path / "other"))
    with pytest.raises(ValueError, match="do not belong together"):
        J.run(spark, source, str(tmp_path / "other"), log)


def test_empty_input(spark, tmp_path):
    source, out, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    write(spark, source, [])
    for _ in range(2):
        assert J.run(spark, source, out, log).collect() == []
    write(spark, source, BATCHES[0])
    assert J.run(spark, source, out, log).count() == len(BATCHES[0])


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
def test_copies_of_the_table_arrive_twice(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    shutil.copy(f"{DATA}/documents.parquet", source / "a.parquet")
    first = J.run(spark, str(source), str(tmp_path / "out"), str(tmp_path / "log"))
    n, new = first.count(), first.where("status = 'new'").count()
    shutil.copy(f"{DATA}/documents.parquet", source / "b.parquet")
    both = J.run(spark, str(source), str(tmp_path / "out"), str(tmp_path / "log"))
    assert both.count() == 2 * n and both.where("status = 'new'").count() == new and both.where("batch = 1 and status = 'new'").count() == 0


def test_command_line_and_settings(spark, tmp_path):
    source, out, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    write(spark, source, BATCHES[0])
    config = json.load(open(f"{ROOT}/jobs/article_intake.json"))
    assert J.Config(**config) == settings.load(spark, f"{ROOT}/jobs/article_intake.json", J.Config) == J.Config()
    (tmp_path / "wrong.json").write_text('{"sentence": 3}')
    with pytest.raises(ValueError, match="unknown settings"):
        settings.load(spark, str(tmp_path / "wrong.json"), J.Config)
    command = [sys.executable, "-m", "jobs.article_intake", "--articles", source, "--output", out, "--checkpoint", log, "--config", f"{ROOT}/jobs/article_intake.json"]
    done = subprocess.run(command, cwd=ROOT, capture_output=True, text=True, timeout=180)
    assert done.returncode == 0, done.stderr[-3000:]
    assert "read 9 rows in 1 batches" in done.stderr and "'new': 4" in done.stderr
    assert J.read(spark, out).count() == len(BATCHES[0])
