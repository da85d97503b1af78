import datetime as dt

import pytest
from pyspark.sql import functions as F

from sieveline.plans import jobs, pipelines


def pages(spark, rows):
    full = [(i, "RSS", t, x, None, [], r, dt.datetime(2024, 1, d), k) for k, (i, t, x, r, d) in enumerate(rows)]
    return spark.createDataFrame(full, jobs.PAGE)


def feed(names):
    return "<rss><channel>" + "".join(f"<item><title>{n}</title><link>u</link><description>{n} words</description></item>" for n in names) + "</channel></rss>"


def test_feedback_loop_end_to_end(spark, tmp_path):
    ws = jobs.Workspace(spark, str(tmp_path / "ws"))
    first = pages(spark, [("p", "red fox", "red fox words", 5.0, 5), ("q", "blue sea", "blue sea words", 1.0, 5), ("r", "unrated", "x", None, 5)])
    jobs.sync(ws, first, "2024-01-05")
    assert {(r.change_type, r.n) for r in jobs.distribute(ws, "2024-01-05").collect()} == {("new", 2)}
    later = pages(spark, [("p", "red fox", "red fox words", 4.0, 6), ("q", "blue sea", "blue sea words", 1.0, 4)])
    jobs.sync(ws, later, "2024-01-06")  # q is before the mark
    assert {(r.change_type, r.n) for r in jobs.distribute(ws, "2024-01-06").collect()} == {("updated", 1)}
    assert {(r.item_id, r.user_rating) for r in ws.read("ratings", jobs.RATING).collect()} == {("p", 4.0), ("q", 1.0)}

    feeds = spark.createDataFrame([("l", feed(["red fox", "other thing"]))], "list_name string, text string")
    jobs.pull_feeds(ws, feeds, "r1", "2024-01-06")
    counts = jobs.save(ws, "r1", "2024-01-06", config=pipelines.Config(least=4.0, k=5)).first()
    assert (counts.source, counts.input, counts.deduped) == ("l", 2, 2) and counts.pushed >= 1
    again = jobs.save(ws, "r1", "2024-01-06", config=pipelines.Config(least=4.0, k=5)).first()
    assert again.deduped == 2 - counts.pushed
    for kind in ("twitter", "reddit", "article"):
        jobs.pull_feeds(ws, feeds, f"r-{kind}", "2024-02-01")
        assert jobs.save(ws, f"r-{kind}", "2024-01-06", kind).count() == 1

    assert jobs.recap(ws, "2024-01-05").collect() == []  # a Friday
    assert jobs.recap(ws, "2024-01-06").collect() == []  # p 0.8 * 4 + 0.2 * -1, q less
    more = pages(spark, [("s", "red fox", "red fox words", 5.0, 6), ("t", "red fox", "red fox words", 5.0, 6)])
    jobs.sync(ws, more, "2024-01-07")
    assert {(r.change_type, r.n) for r in jobs.distribute(ws, "2024-01-07").collect()} == {("new", 2)}
    jobs.distribute(ws, "2024-01-13")
    # s has t (5) and p (4) beside it, and itself, which leaves after the cut
    assert {r.item_id: (r.user_rating, r.relevance) for r in jobs.recap(ws, "2024-01-13").collect()} == {"s": (5.0, 4.5), "t": (5.0, 4.5)}
    assert {r.source: (r.titles, r.n) for r in jobs.publish(ws, "2024-01-13").collect()} == {"RSS": (["red fox", "red fox"], 2)}
    assert jobs.clean(ws, "2024-01-08") == ["2024-01-05"]
    assert jobs.clean(ws, "2024-01-08") == []
    assert len(ws._versions("ratings")) == 2


def test_embeddings_are_made_once_and_ratings_expire(spark, tmp_path):
    ws = jobs.Workspace(spark, str(tmp_path / "ws"))
    jobs.sync(ws, pages(spark, [("p", "a", "one", 5.0, 5), ("q", "b", "two", 1.0, 5)]), "2024-01-05")
    jobs.distribute(ws, "2024-01-05")
    gone = lambda text: F.raise_error(F.lit("embedded again")).cast("array<float>")
    assert jobs.distribute(ws, "2024-01-06", embed=gone).collect() == []
    assert ws.vectors.count() == 4 and {str(r.ds) for r in ws.vectors.days_held().collect()} == {"2024-01-05", "2024-01-06"}
    assert {(r.item_id, str(r.ds)) for r in ws.read("visited", jobs.VISITED).collect()} == {(i, d) for i in "pq" for d in ("2024-01-05", "2024-01-06")}
    assert {(r.change_type, r.n) for r in jobs.distribute(ws, "2024-02-04", days=60).collect()} == {("new", 2)}  # the ratings of 5 January are over
    ws.vectors.reset()
    assert ws.vectors.exists() and ws.vectors.count() == 0
    ws.vectors.drop()
    assert not ws.vectors.exists()


def test_journal_todo_and_deepdive(spark, tmp_path):
    ws = jobs.Workspace(spark, str(tmp_path / "ws"))
    at = lambda d: dt.datetime(2024, 1, d)
    notes = spark.createDataFrame([("b", "B", "second. More.", at(2)), ("a", "A", "first.", at(1))], jobs.NOTE)
    page = jobs.journal(ws, notes, "2024-01-03").first()
    body = "A first.\nB second. More."
    lead = "A first. B second."
    assert page.title == "2024-01-03 A first." and page.last_created_time == at(2)
    todo = "1. A first.\n2. B second. More."
    assert page.text == f"2024-01-03 A first.\n\n{body}\n\nCritical Insights\nA first.\n\nTakeaways\n{body}\n\nAction Items\n{todo}\n\nOverall:\n{body}"
    assert (page.todo, page.translation_todo, page.translation) == (todo, todo, page.text) and lead
    none = jobs.journal(ws, notes, "2024-01-04").first()  # both are before the mark
    assert (none.title, none.text, none.todo, none.last_created_time) == ("2024-01-04 n/a", "", "n/a", None)

    rows = [("p", "RSS", "x", "do this\n\nand that", ["t"], 5), ("q", "TODO", "x", "not me", [], 5), ("r", "RSS", "x", "dig here. And there. Deep.", ["action:deepdive"], 5), ("s", "RSS", "x", "", None, 5)]
    own = spark.createDataFrame([(i, s, t, "", w, g, None, at(d), 0) for i, s, t, w, g, d in rows], jobs.PAGE)
    items = lambda df, day: sorted((r.item_id, r.pos, r.item, r.translation) for r in jobs.todo(ws, df, day).collect())
    assert items(own, "2024-01-05") == [("p", 0, "do this", "do this"), ("p", 1, "and that", "and that")]
    assert items(own, "2024-01-06") == []
    assert items(own.withColumn("last_edited_time", F.lit(at(7))), "2024-01-07") == [("p", 0, "do this", "do this"), ("p", 1, "and that", "and that")]
    (dive,) = jobs.deepdive(ws, own, "2024-01-05", 2).collect()
    assert dive.item_id == "r" and len(dive.versions) == 2 and dive.deepdive == dive.versions[1] and dive.deepdive.startswith("dig here. And there. Deep. (version 2)\n\n")
    assert jobs.deepdive(ws, own, "2024-01-06", 2).collect() == []


def test_a_python_provider_sees_the_misses_alone(spark):
    from sieveline.operators import providers, state

    def embed(texts):
        assert set(texts) == {"new"}, texts
        return [[1.0] for _ in texts]

    items = spark.createDataFrame([("a", "old"), ("b", "new"), (None, "new")], "key string, text string")
    cache = spark.createDataFrame([("a", [0.0])], "key string, value array<float>")
    got = state.cache_aside(items, cache, "key", providers.batched(embed, 1)(F.col("text"))).collect()
    assert {(r.key, tuple(r.value), r.cached) for r in got} == {("a", (0.0,), True), ("b", (1.0,), False), (None, (1.0,), False)}


def test_patches_run_once_each_in_order(spark, tmp_path):
    ws, ran = jobs.Workspace(spark, str(tmp_path / "ws")), []
    index = lambda *rows: spark.createDataFrame(rows, "category string, name string, index_id string")

    def first(w):
        ran.append(0)
        jobs.bootstrap(w, index(("notion", "inbox", "b"), ("notion", "inbox", "a"), ("x", "y", "z")))

    def broken(w):
        ran.append(1)
        jobs.bootstrap(w, index(("notion", "journal", "j")))
        if ran.count(1) == 1:
            raise RuntimeError("halfway")

    patches = [(2, "third", lambda w: ran.append(2)), (0, "first", first), (1, "second", broken)]
    with pytest.raises(RuntimeError, match="halfway"):
        jobs.upgrade(ws, patches)
    assert ran == [0, 1] and [r.order_id for r in ws.read("patch", "order_id long, name string").collect()] == [0]
    assert jobs.upgrade(ws, patches) == [1, 2] and ran == [0, 1, 1, 2]
    assert jobs.upgrade(ws, patches) == [] and jobs.upgrade(ws, [*patches, (3, "fourth", first)]) == [3]
    held = sorted(tuple(r) for r in ws.read("index_pages", "category string, name string, index_id string").collect())
    assert held == [("notion", "inbox", "a"), ("notion", "journal", "j"), ("x", "y", "z")]
    with pytest.raises(ValueError, match="share an order"):
        jobs.upgrade(ws, [(1, "a", first), (1, "b", first)])
