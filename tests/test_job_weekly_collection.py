import json
import os
import subprocess
import sys
from datetime import datetime, timedelta

import pytest

from jobs import settings
from jobs import weekly_collection as J

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
MONDAY = datetime(2024, 1, 1)


def save(spark, folder, edits, articles):
    spark.createDataFrame(edits, J.EDIT).repartition(2).write.mode("overwrite").parquet(f"{folder}/events")
    spark.createDataFrame(articles, J.ARTICLE).repartition(2).write.mode("overwrite").parquet(f"{folder}/articles")
    return f"{folder}/events", f"{folder}/articles"


ARTICLES = [(i, f"\n\nTitle {i}\nFirst. Second. " + "Third. " * 60, ["en", "de", None][i % 3], ["a", "b"][i % 2]) for i in range(30)] + [(40, None, "fr", None), (41, "no source", "fr", None)]


def edits():
    out = []
    for week in range(5):
        for page in range(30):
            for k in range(2):
                day = MONDAY + timedelta(days=7 * week + (page + 3 * k) % 7, hours=k)
                out.append((len(out), day, page, ["view", "click", "error"][(page + k + week) % 3], float((page * 7 + week * 13 + k * 29) % 110)))
    out += [(900, MONDAY, 40, "view", 99.0), (901, MONDAY, 41, "view", 99.0), (902, MONDAY, 77, "view", 99.0), (903, None, 3, "view", 99.0), (904, MONDAY, None, "view", 99.0), (905, MONDAY, 3, "view", None)]
    return [*out, (906, MONDAY + timedelta(days=6, hours=23), 2, "view", 90.0), (907, MONDAY + timedelta(days=6, hours=23), 2, "view", 50.0)]


def brute(edits, articles, c=J.Config()):
    text = {d: (t or "", lang, s) for d, t, lang, s in articles}
    last = {}
    for e, ts, page, kind, value in edits:
        if kind in c.rated_types and None not in (ts, page, value):
            week = (ts - timedelta(days=ts.weekday())).date()
            last[week, page] = max(last.get((week, page), (datetime.min, -1, 0)), (ts, e, min(5.0, value / c.points)))
    rated = {k: v[2] for k, v in last.items()}
    out = {}
    for week in {w for w, _ in rated}:
        for source in ["a", "b", None]:
            before = [r for (w, p), r in rated.items() if source and p in text and text[p][2] == source and 0 < (week - w).days <= 7 * c.affinity_weeks]
            relevance = sum(before) / len(before) if before else -1.0
            found = [(-round(0.8 * r + 0.2 * relevance, 9), p) for (w, p), r in rated.items() if w == week and p in text and text[p][2] == source and r >= c.least_rating]
            best = sorted(x for x in found if -x[0] >= c.least_blend)[: c.pages]
            if best:
                out[week, source or "no source"] = [p for _, p in best]
    return rated, out


def pages(df):
    return {(r.week, r.source): r for r in df.collect()}


def test_matches_brute_force(spark, tmp_path):
    own = edits()
    e, a = save(spark, tmp_path, own, ARTICLES)
    got = pages(J.run(spark, e, a, str(tmp_path / "out")))
    rated, want = brute(own, ARTICLES)
    assert {k for k in got if k[1]} == set(want) and {w for w, s in got if s is None} == {w for w, _ in rated}
    for key, ids in want.items():
        title = lambda p: f"Title {p}" if p < 40 else "" if p == 40 else "no source"
        assert got[key].titles == [title(p) for p in ids] and got[key].n == len(ids), key
        assert got[key].topics == sorted({ARTICLES[p][2] for p in ids if p < 40} - {None} | ({"fr"} if max(ids) >= 40 else set()))
    week, source = next(k for k in want if k[1] == "a")
    assert got[week, source].page.startswith(f"# a, week of {week}\n\n## Title {want[week, source][0]}\n\nTitle {want[week, source][0]}\nFirst. Second.\n")
    for w in {w for w, _ in rated}:
        assert got[w, None].n == sum(x == w for x, _ in rated) and sorted(got[w, None].titles) == sorted(s for x, s in want if x == w)


def test_runs_again_and_for_some_weeks(spark, tmp_path):
    own, out = edits(), str(tmp_path / "out")
    e, a = save(spark, tmp_path, own, ARTICLES)
    whole = pages(J.run(spark, e, a, out))
    assert pages(J.run(spark, e, a, out)) == whole
    assert pages(J.run(spark, e, a, out, "2024-01-15", "2024-01-22")) == whole  # the weeks before count for affinity
    changed = [(i, ts, p, k, 100.0 if ts and ts >= MONDAY + timedelta(days=14) else v) for i, ts, p, k, v in own]
    e, a = save(spark, tmp_path / "new", changed, ARTICLES)
    got = pages(J.run(spark, e, a, out, "2024-01-15", "2024-01-15"))
    day = datetime(2024, 1, 15).date()
    assert {k: v for k, v in got.items() if k[0] != day} == {k: v for k, v in whole.items() if k[0] != day}
    assert {k: v for k, v in got.items() if k[0] == day} == {k: v for k, v in pages(J.run(spark, e, a, str(tmp_path / "other"))).items() if k[0] == day}


def test_a_week_that_lost_its_pages_is_written_empty(spark, tmp_path):
    out, day = str(tmp_path / "out"), datetime(2024, 1, 8).date()
    e, a = save(spark, tmp_path, edits(), ARTICLES)
    assert any(w == day and s for w, s in pages(J.run(spark, e, a, out)))
    e, a = save(spark, tmp_path / "new", [x for x in edits() if not x[1] or x[1].date() < day], ARTICLES)
    got = pages(J.run(spark, e, a, out, "2024-01-08", "2024-01-08"))
    assert [(s, r.n, r.titles) for (w, s), r in got.items() if w == day] == [(None, 0, [])]


def test_bounds_must_be_mondays_and_empty_tables_do(spark, tmp_path):
    e, a = save(spark, tmp_path, [], [])
    assert J.run(spark, e, a, str(tmp_path / "out"), "2024-01-01", "2024-01-08").count() == 2
    with pytest.raises(ValueError, match="Mondays"):
        J.run(spark, e, a, str(tmp_path / "out"), "2024-01-02")


def test_command_line(spark, tmp_path):
    e, a = save(spark, tmp_path, edits(), ARTICLES)
    config = f"{ROOT}/jobs/weekly_collection.json"
    assert J.Config(**json.load(open(config))) == settings.load(spark, config, J.Config) == J.Config()
    command = [sys.executable, "-m", "jobs.weekly_collection", "--edits", e, "--articles", a, "--output", str(tmp_path / "out"), "--config", config]
    done = subprocess.run(command, cwd=ROOT, capture_output=True, text=True, timeout=180)
    assert done.returncode == 0, done.stderr[-3000:]
    assert f"read {len(edits())} edits" in done.stderr and "rows for 5 weeks" in done.stderr
    assert pages(J.read(spark, str(tmp_path / "out"))) == pages(J.run(spark, e, a, str(tmp_path / "again")))
