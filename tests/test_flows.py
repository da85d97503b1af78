import datetime as dt
import json

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sieveline import schemas
from sieveline.operators import providers, render
from sieveline.plans import pipelines
from sieveline.sinks import notes, writers
from sieveline.sources import feeds, files
from sieveline.streaming import streams


def test_json_and_text_files(spark, tmp_path):
    df = spark.createDataFrame([(1, "x")], "id int, t string")
    writers.write_run(df, str(tmp_path / "d"), "r1")
    writers.write_run(df, str(tmp_path / "d"), "r1")
    assert files.read_run(spark, str(tmp_path / "d"), "r1", df.schema).collect() == df.collect()
    assert files.read_json(spark, str(tmp_path / "none"), df.schema).collect() == []
    for day in ("a", "b"):
        (tmp_path / "n" / day).mkdir(parents=True)
        (tmp_path / "n" / day / "rss.json").write_text('{"id": 1}')
        (tmp_path / "n" / day / "other.json").write_text('{"id": 2}')
    assert [r.id for r in files.read_named(spark, [str(tmp_path / "n/a"), str(tmp_path / "n/b")], "rss.json", "id int").collect()] == [1, 1]
    post = tmp_path / "set" / "post_1"
    post.mkdir(parents=True)
    for name in ("base", "update_exact_30", "ground_truth_exact_30"):
        (post / f"{name}.txt").write_text(f"{name}\ntext")
    rows = {tuple(r) for r in files.read_dataset(spark, str(tmp_path / "set")).collect()}
    assert rows == {("post_1", "base", None, "base\ntext"), ("post_1", "update", "exact_30", "update_exact_30\ntext"), ("post_1", "ground_truth", "exact_30", "ground_truth_exact_30\ntext")}
    days = spark.createDataFrame([(dt.date(2024, 1, d),) for d in (1, 5, 9, 10)], "ds date")
    assert files.trailing_days(days, "ds", "2024-01-09", 5).count() == 2


def test_feed_items(spark):
    rows = [("l", i, f"t{i}", f"u{i}", None, "c", [("a",), ("b",), ("c",), ("d",)], "2024-01-02T00:00:00+00:00" if i else None) for i in range(5)]
    got = sorted(feeds.rss_items(spark.createDataFrame(rows, feeds.RSS_ENTRY), "2024-02-01").collect(), key=lambda r: r.ordinal)
    assert [r.published_key for r in got] == ["2024-02-01", "2024-01-02", "2024-01-02"] and got[0].summary == ""
    import hashlib

    assert got[1].id == hashlib.md5(b"l_t1_2024-01-02").hexdigest()


def test_feed_files(spark):
    rss = "<rss><channel><title>c</title>" + "".join(f"<item><title>t{i}</title><link>u{i}</link><description>d</description><category>x</category><category>y</category><pubDate>Tue, 02 Jan 2024 03:04:05 +0000</pubDate></item>" for i in range(4)) + "</channel></rss>"
    atom = '<feed><entry><title>a</title><link href="h"/><updated>2024-01-03T00:00:00Z</updated><category term="z"/></entry></feed>'
    df = spark.createDataFrame([("l", rss), ("m", atom), ("n", "no xml")], "list_name string, text string")
    got = {(r.list_name, r.pos): r for r in feeds.feed_entries(df).collect()}
    assert set(got) == {("l", i) for i in range(4)} | {("m", 0)}
    assert [t.term for t in got["l", 0].tags] == ["x", "y"] and got["l", 2].link == "u2" and got["l", 0].published.startswith("2024-01-02T03:04:05")
    assert got["m", 0].link == "h" and [t.term for t in got["m", 0].tags] == ["z"]
    assert {r.published_key for r in feeds.rss_items(feeds.feed_entries(df), "2024-02-01").collect()} == {"2024-01-02", "2024-01-03"}


def test_listing(spark):
    post = lambda **k: {"data": {"id": "1", "name": "t3_1", "title": "T", "selftext": "", "url": "/r/x/1", "permalink": "/r/x/1", "subreddit": "x", "author": "a", "created_utc": 1699.0} | k}
    media = {"type": "v", "reddit_video": {"fallback_url": "f", "dash_url": "d"}}
    pics = {"p1": {"status": "valid", "e": "Image", "s": {"u": "uu"}}, "p2": {"status": "failed", "s": {"u": "x"}}, "p3": {"status": "valid", "e": "G", "s": {"gif": "gg"}}}
    answer = json.dumps({"data": {"children": [post(media=media), post(url="https://e.org/a.png", media_metadata=pics), post(media={"type": "odd"})]}})
    a, b, c = feeds.listing_posts(spark.createDataFrame([(answer,)], "answer string")).orderBy("ordinal").collect()
    import hashlib

    assert a.hash_id == hashlib.md5(b"x_T_a_1699.0").hexdigest()
    assert tuple(a.video) == ("reddit", "f", "d") and tuple(b.video) == ("unknown", "", "") and c.video is None
    assert a.url == "https://www.reddit.com/r/x/1" and b.is_image and b.is_external_link and not a.is_external_link
    assert [tuple(g) for g in b.gallery_medias] == [("p1", "Image", "uu"), ("p3", "G", "gg")] and a.gallery_medias == []


def test_tweets_and_their_blocks(spark):
    schema = "tweet_id long, name string, screen_name string, text string, created_at timestamp_ntz, media array<string>, urls array<string>, retweeted_text string, retweeted_media array<string>, reply_to_status_id long"
    at = dt.datetime(2024, 7, 1, 12)
    rows = [(1, "N", "n", "first", at, ["m1", "m2"], ["u"], None, None, None), (2, "M", "m", "own", at, None, ["u1", "u2"], "RT text", None, 1), (3, "M", "m", "lost", at, None, None, None, None, 99)]
    t = feeds.tweets(spark.createDataFrame(rows, schema))
    a, b, c = t.orderBy("tweet_id").collect()
    assert (a.embed, b.embed, c.embed) == ("m2", "u2", "") and b.text == "RT text" and b.retweeted and b.reply_text == "first"
    assert c.reply_deleted and not b.reply_deleted and a.created_at_pdt == dt.datetime(2024, 7, 1, 5)
    blocks = {r.tweet_id: [(x.type, x.text) for x in r.blocks] for r in render.tweet_blocks(t).collect()}
    assert blocks[1][0] == ("paragraph", "N: first") and blocks[2][0] == ("quote", "N: first") and blocks[3][0][0] == "quote"
    assert ("paragraph", "M (Retweeted): RT text") in blocks[2]


def test_lists_and_pages(spark):
    lists = spark.createDataFrame([("a", True, 1, ["x", "y"]), ("b", False, 2, ["x"])], "id string, enabled boolean, created_time int, names array<string>")
    assert [r.list_name for r in feeds.enabled_lists(lists, "names").collect()] == ["x", "y"]
    assert [r.id for r in feeds.latest_databases(lists, n=1).collect()] == ["b"]
    pages = spark.createDataFrame([("p", "S", dt.datetime(2024, 1, 2), "4"), ("q", "S", dt.datetime(2024, 1, 1), None), ("r", "T", dt.datetime(2024, 1, 3), "5")], "id string, source string, last_edited_time timestamp, user_rating string")
    assert [(r.id, r.user_rating) for r in feeds.rated_pages(pages, "S", "2024-01-01").collect()] == [("p", 4.0)]
    assert [r.id for r in feeds.rated_pages(pages, "S", "2024-01-01", False).collect()] == ["q", "p"]


def test_article_video_and_properties(spark):
    a = spark.createDataFrame([("T", "u", "One. Two.\n===\nEins.")], "title string, url string, summary string")
    kinds = [(b.type, b.text) for b in render.article_blocks(a).first().blocks]
    assert kinds == [("paragraph", "One. Two."), ("toggle", "Eins.\n"), ("link", "T")]
    v = spark.createDataFrame([("", "A &amp; B", "u", None, 90.0, None, "s")], "alt_title string, title string, url string, author string, seconds double, views long, summary string")
    r = render.video_blocks(v).select("blocks", render.to_text(F.col("blocks")).alias("t")).first()
    assert r.blocks[0].text == "A & B" and r.blocks[2].text == ", 1.50 minutes, ? views" and r.t.startswith("A & B\n")
    p = spark.createDataFrame([("s", ["l", "l"], ["b", "a", "b"], ["c"], 0.0, 0.0)], "source string, list_names array<string>, topics array<string>, categories array<string>, rating double, relevance double")
    got = render.page_properties(p).first().properties
    assert (got.list_names, got.topics, got.rating, got.relevance) == (["l"], ["a", "b"], -1.0, None)


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int")
    known = spark.createDataFrame([("b",)], "k string")
    writers.append_new(rows, known, "k", str(tmp_path / "t"))
    assert [r.k for r in spark.read.parquet(str(tmp_path / "t")).collect()] == ["a"]
    ok, failed = writers.split_failures(rows.withColumn("error", F.when(F.col("v") == 2, "boom")), "error")
    assert ok.count() == 2 and [(r.reason, r.attempts) for r in writers.dead_letters(failed, "rank", "k", "error", 3, "2024-01-01").collect()] == [("boom", 3)]
    note = spark.createDataFrame([('A "q": b/c', "u", "RSS", ["x", 'y"'], 4.0, "Sum.", dt.datetime(2024, 1, 2), "news")], "title string, url string, source string, tags array<string>, rating double, summary string, created_time timestamp, cat string")
    r = writers.markdown_note(note).first()
    assert r.file_name == "2024-01-02 A  q   b c.md" or r.file_name.startswith("2024-01-02 A ")
    assert r.note.startswith('---\ntitle: "A \\"q\\": b/c"\nsource: RSS\n') and 'tags: ["x", "y\'"]' in r.note and r.note.endswith("\n\nSum.\n")
    writers.write_notes(note, str(tmp_path / "notes"), "cat")
    assert len(list((tmp_path / "notes" / "category=news").glob("*.txt"))) == 1


@pytest.mark.parametrize("folders", [False, True])
def test_notes_are_dealt_to_tasks(spark, tmp_path, folders):
    rows = spark.range(100).coalesce(1).selectExpr("concat('n', id) AS title", "'u' AS url", "'s' AS source", "array('t') AS tags", "4 AS rating", "concat('Sum ', id) AS summary", "timestamp'2024-01-02' AS created_time", "if(id < 80, 'a', 'b') AS cat")
    known = writers.markdown_note(rows.where("title IN ('n0', 'n99')"))
    writers.write_notes(rows, str(tmp_path), "cat", known, **({"folders": True} if folders else {}))
    found = list(tmp_path.rglob("*.txt"))
    want = {(f"category={r.category}", r.note + "\n") for r in writers.markdown_note(rows.withColumn("category", F.col("cat")), ["category"]).collect() if r.file_name not in ("2024-01-02 n0.md", "2024-01-02 n99.md")}
    assert len(found) == 98 and {(f.relative_to(tmp_path).parts[0], f.read_text()) for f in found} == want
    tasks = [f.name[:10] for f in found]
    assert len(set(tasks)) >= 8 and max(map(tasks.count, tasks)) <= 13
    assert not folders or all(len({g.name[:10] for g in f.parent.glob("*.txt")}) == 1 for f in found)


def test_notes_are_files_and_nothing_else(spark, tmp_path):
    cats = ["a/b=c", "", None, "x y%41", "é", "07"]
    rows = spark.createDataFrame([(f"n{i}", c, f"é {i}\n\n") for i, c in enumerate(cats * 5)], "title string, cat string, summary string")
    rows = rows.selectExpr("title", "'u' AS url", "'s' AS source", "array('t') AS tags", "4 AS rating", "summary", "timestamp'2024-01-02' AS created_time", "cat")
    path, kept = str(tmp_path / "notes"), spark.conf.get("spark.sql.hive.filesourcePartitionFileCacheSize")
    for part in (rows.where("title < 'n2'"), rows.where("title >= 'n2'")):  # the second is appended
        writers.write_notes(part, path, "cat", folders=True)
    assert sum(f.is_file() for f in (tmp_path / "notes").rglob("*")) == len(cats) * 5 + 1  # and _SUCCESS: no checksum files, nothing unfinished
    parts = list(files.read_notes(spark, path, len(cats) * 5, listed=7))
    assert len(parts) >= 4 and all(p.count() <= 12 for p in parts)
    got = sorted((r.category, r.value) for p in parts for r in p.select(F.coalesce("category", F.lit("-")).alias("category"), "value").collect())
    want = writers.markdown_note(rows.withColumn("category", F.coalesce(F.nullif("cat", F.lit("")), F.lit("-"))), ["category"])
    assert got == sorted((r.category, r.note + "\n") for r in want.collect())
    assert [p.collect() for p in files.read_notes(spark, str(tmp_path / "none"), 0)] == [[]]
    assert spark.conf.get("spark.sql.hive.filesourcePartitionFileCacheSize") == kept


def test_notes_of_failed_attempts_are_left_out(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(notes.TaskContext, "get", lambda: type("Task", (), {"partitionId": lambda self: 3})())
    rows = pa.RecordBatch.from_pydict({"category": ["a", "b", "a"], "value": ["x", "y", "z"]})
    make = lambda: notes.NoteFiles({"path": str(tmp_path)}).writer(StructType.fromDDL("category string, value string"), False)
    found = lambda: sorted((f.parent.name, f.read_text()) for f in tmp_path.rglob("*.txt"))
    w = make()
    w.write(iter([rows.slice(0, 2)]))  # an attempt that was lost
    w.commit([w.write(iter([rows])), None])
    assert found() == [("category=a", "x\n"), ("category=a", "z\n"), ("category=b", "y\n")]
    w = make()
    w.abort([w.write(iter([rows]))])
    assert len(found()) == 3 and sorted(f.name for f in tmp_path.iterdir()) == ["_SUCCESS", "category=a", "category=b"]
    bad = spark.range(20).selectExpr("if(id = 15, raise_error('bad'), 'n') AS title", "'u' AS url", "'s' AS source", "array('t') AS tags", "4 AS rating", "'x' AS summary", "timestamp'2024-01-02' AS created_time", "'c' AS cat")
    with pytest.raises(Exception, match="bad"):
        writers.write_notes(bad, str(tmp_path / "bad"), "cat")
    assert not list(tmp_path.rglob("bad/**/*.txt"))


def test_providers(spark):
    df = spark.createDataFrame([("Short text",), ("One two. " * 60,), ("",)], "t string")
    e = [r.e for r in df.select(providers.hashed_embedding(F.col("t")).alias("e")).collect()]
    assert all(len(x) == providers.DIM for x in e) and abs(sum(v * v for v in e[0]) - 1) < 1e-6 and not any(e[2])
    s = [r.s for r in df.select(providers.lead_summary(F.col("t")).alias("s")).collect()]
    assert s == ["Short text", "One two. One two.", ""]
    both = providers.first_of(lambda t: F.lit(None).cast("string"), providers.same_language)
    assert df.select(both(F.col("t")).alias("x")).first().x == "Short text"
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise OSError("later")
        return "ok"

    pauses = []
    assert providers.retrying(flaky, sleep=pauses.append)() == "ok" and pauses == [1.0, 2.0]
    with pytest.raises(KeyError):
        providers.get("embed", "none")
    providers.register("embed", "mine", providers.hashed_embedding)
    assert providers.get("embed", "mine") is providers.hashed_embedding
    assert df.select(providers.prompt("translate", F.col("t"), language="French").alias("p")).first().p.endswith("French:\nShort text")


def items(spark):
    rows = [(str(i), "feed", f"l{i % 2}", f"title {i}", "word. " * (10 * i + 1), i) for i in range(8)]
    return spark.createDataFrame(rows, "item_id string, source string, list_name string, title string, text string, ordinal long")


def test_pipelines(spark):
    own = items(spark)
    seen = own.where("item_id = '7'")
    scores = spark.createDataFrame([("1", 5.0), ("2", 3.0), ("3", 9.0)], "item_id string, relevance double")
    limits = spark.createDataFrame([("l1", 8.0)], "list_name string, min_score double")
    r = pipelines.rss(own, seen, scores).collect()
    assert [(x.item_id, x.rate) for x in r] == [("3", -1.0)]
    t = {x.item_id: x.rate for x in pipelines.twitter(own, seen, scores, limits).collect()}
    assert set(t) == {"0", "3", "4", "5", "6"} and all(v > 0 for v in t.values())
    d = pipelines.reddit(own, seen, scores, limits).collect()
    assert {x.item_id for x in d} == set(t) and all(x.summary for x in d)
    a = pipelines.article(own, seen).collect()
    assert len(a) == 7 and all(x.topics[0].name for x in a)


def test_feedback_loop(spark):
    rows = [("p", 5.0, 1, 0, dt.date(2024, 1, 9)), ("p", 4.0, 2, 1, dt.date(2024, 1, 10)), ("q", None, 1, 2, dt.date(2024, 1, 9)), ("r", 3.0, 1, 3, dt.date(2023, 1, 1)), ("s", 2.0, 1, 4, dt.date(2024, 1, 8))]
    snaps = spark.createDataFrame(rows, "item_id string, user_rating double, last_edited_time int, ordinal int, ds date")
    before = spark.createDataFrame([("p", 5.0), ("s", 2.0)], "item_id string, user_rating double")
    assert [(r.item_id, r.user_rating, r.change_type) for r in pipelines.distribute(snaps, "2024-01-10", before).collect()] == [("p", 4.0, "updated")]
    week = spark.createDataFrame([("a", 5.0, None, 0), ("b", 1.0, "note", 1), ("c", 3.0, "", 2), ("d", 5.0, None, 3)], "item_id string, user_rating double, take_aways string, ordinal int")
    relevance = spark.createDataFrame([("a", 3.0), ("d", 5.0)], "item_id string, relevance double")
    assert [r.item_id for r in pipelines.weekly(week, relevance).collect()] == ["d", "a"]
    acts = spark.createDataFrame([("a", "RSS", ["x"], "do", 1), ("b", "TODO", [], "do", 1), ("c", "RSS", ["action:deepdive"], "do", 1), ("d", "RSS", None, "", 1), ("e", "RSS", None, "do", 2)], "item_id string, source string, tags array<string>, take_aways string, last_edited_time int")
    seen = spark.createDataFrame([("a", 1), ("e", 1)], "item_id string, last_edited_time int")
    assert {r.item_id for r in pipelines.todos(acts, seen).collect()} == {"e"}
    assert {r.item_id for r in pipelines.deepdives(acts, seen).collect()} == {"c"}


def test_schema_rules(spark):
    assert schemas.violations(spark.createDataFrame([(1, "x"), (1, "pending")], "content_id long, status string"), "review_status").count() == 2
    m = schemas.index_map(spark.createDataFrame([("c", "n", "1"), ("c", "m", "2")], "category string, name string, index_id string")).first()
    assert m.names == {"m": "2", "n": "1"}


def test_streams(spark, tmp_path):
    src = tmp_path / "src"
    e = spark.createDataFrame([(1, "a", dt.datetime(2024, 1, 1, 3), 1.0), (2, "a", dt.datetime(2024, 1, 2, 3), 2.0), (1, "b", dt.datetime(2024, 1, 1, 9), 4.0)], "id int, k string, ts timestamp, value double")
    e.write.parquet(str(src))
    stream = spark.readStream.schema(e.schema).parquet(str(src))
    out = []
    q = streams.each_batch(streams.unseen(stream, ["k"]), lambda b, n: out.extend(r.k for r in b.collect()), str(tmp_path / "c1"))
    q.awaitTermination()
    assert sorted(out) == ["a", "b"]
    counts = streams.windowed_counts(stream, "ts", ["k"])
    q = counts.writeStream.outputMode("complete").format("memory").queryName("w").trigger(availableNow=True).start()
    q.awaitTermination()
    assert {(str(r.window_start.date()), r.k, r.total) for r in spark.table("w").collect()} == {("2024-01-01", "a", 1.0), ("2024-01-02", "a", 2.0), ("2024-01-01", "b", 4.0)}


def test_latest_version_stream(spark, tmp_path):
    src = tmp_path / "src"
    rows = [(1, 5, "a"), (1, 7, "b"), (2, 1, "c")]
    spark.createDataFrame(rows, "k long, version long, v string").coalesce(1).write.parquet(str(src))
    stream = spark.readStream.schema("k long, version long, v string").parquet(str(src))
    out = []

    def run():
        q = streams.latest(stream, "k", "version").writeStream.outputMode("update").foreachBatch(lambda b, n: out.append({tuple(r) for r in b.collect()}))
        q.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()

    run()
    spark.createDataFrame([(1, 6, "old"), (2, 2, "new"), (3, 1, "x")], "k long, version long, v string").coalesce(1).write.mode("append").parquet(str(src))
    run()
    assert out == [{(1, 7, "b"), (2, 1, "c")}, {(2, 2, "new"), (3, 1, "x")}]
