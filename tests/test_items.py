from datetime import date, datetime

from sieveline.operators import render
from sieveline.plans import actions
from sieveline.sinks import writers
from sieveline.sources import feeds

POST = (
    "id long, url string, text string, summary string, permalink string, subreddit string, author string, ups int, downs int, num_comments int, is_video boolean, is_image boolean, is_gallery boolean, is_external_link boolean, "
    "video struct<video_url:string>, gallery_medias array<struct<url:string>>"
)


def kinds(row):
    return [(b["type"], b["url"] or b["text"]) for b in row["blocks"]]


def test_posts_show_what_they_hold(spark):
    base = lambda i, **k: {"id": i, "url": f"u{i}", "text": None, "summary": None, "permalink": f"p{i}", "subreddit": "s", "author": None, "ups": 3, "downs": 0, "num_comments": 1, "is_video": False, "is_image": False, "is_gallery": False, "is_external_link": False, "video": None, "gallery_medias": []} | k
    rows = [
        base(1, is_video=True, video={"video_url": "https://v.redd.it/x"}, text="said. " * 500), base(2, is_video=True, video={"video_url": "https://other/x"}), base(3, is_image=True, summary="short"),
        base(4, is_gallery=True, gallery_medias=[{"url": "a&amp;b"}, {"url": "c"}]), base(5, is_external_link=True), base(6), base(7, is_video=True), base(8, is_gallery=True, gallery_medias=None),
    ]
    df = spark.createDataFrame([tuple(r[c.split(" ")[0]] for c in POST.replace("struct<video_url:string>", "x").replace("array<struct<url:string>>", "x").split(", ")) for r in rows], POST)
    got = {r["id"]: kinds(r) for r in render.post_blocks(df).collect()}
    assert got[1][0] == ("video", "https://v.redd.it/x") and got[1][1][0] == "quote" and 1000 < len(got[1][1][1]) <= 1800
    assert got[2][0] == ("embed", "https://other/x") and got[3][:2] == [("image", "u3"), ("paragraph", "short")]
    assert got[4][:2] == [("image", "a&b"), ("image", "c")] and got[5][0] == ("embed", "u5")
    assert [k for k, _ in got[6]] == [k for k, _ in got[8]] == ["link", "comment"] and got[7][0][0] == "embed"
    assert got[6][1][1] == "Subreddit: s\nAuthor: \nUps: 3\nDowns: 0\nNumOfComments: 1"


def test_feed_items(spark):
    df = spark.createDataFrame([("t", "u", "", "said", ["a", "b"]), ("t", "u", "sum===more", "c", []), ("t", "u", None, None, None)], "title string, url string, summary string, content string, topics array<string>")
    assert [kinds(r) for r in render.feed_blocks(df).collect()] == [[("paragraph", "said"), ("link", "u"), ("comment", "Topics: a, b")], [("paragraph", "sum"), ("toggle", "more\n"), ("link", "u")], [("link", "u")]]


def test_inbox_notes_and_appended_lines(spark, tmp_path):
    df = spark.createDataFrame([("s/x", ["a:b", "c"], "T|1\n", "take\n it", None, None), ("s", None, None, None, 4.0, "text")], "source string, categories array<string>, title string, take_aways string, rating double, body string")
    a, b = writers.inbox_note(df).collect()
    assert (a.file_name, b.file_name) == ("s x_a b_T 1.md", "s__.md")
    assert "source: s/x\n" in a.note and "category: a:b, c\n" in a.note and "take aways: take it\n" in a.note and "rating: \n" in a.note and a.note.endswith("MOC]]\n\n\n")
    assert "rating: 4.0\n" in b.note and b.note.endswith("\n\ntext\n")
    assert [x.split(":")[0] for x in a.note.split("\n")[1:12]] == list(writers.INBOX_FIELDS)
    path, lines = str(tmp_path / "refs"), lambda *x: spark.createDataFrame([(v,) for v in x], "value string")
    writers.append_lines(lines("a", "b", "a"), path)
    writers.append_lines(lines("b", "c"), path, lines("a", "b"))
    assert sorted(r.value for r in spark.read.text(path).collect()) == ["a", "b", "c"]


def test_weekly_pages_of_the_newest_databases(spark):
    day = lambda d: datetime(2024, 1, d)
    index = spark.createDataFrame([("a", f"a{d}", day(d)) for d in (1, 8, 15)] + [("b", "b1", day(1)), ("x", "x1", day(20))], "source string, id string, created_time timestamp")
    pages = [(1, "a15", "a", 3.0, day(16), 0), (1, "a8", "a", 4.0, day(18), 1), (1, "a8", "a", 5.0, day(18), 2), (2, "a1", "a", 5.0, day(18), 0), (3, "b1", "b", None, day(18), 0), (4, "b1", "b", 2.0, day(12), 0), (5, "b1", "b", 2.0, day(13), 0), (6, "x1", "x", 5.0, day(18), 0), (7, "a15", "b", 5.0, day(18), 0)]
    df = spark.createDataFrame(pages, "page_id long, database_id string, source string, user_rating double, last_edited_time timestamp, ordinal long")
    got = feeds.weekly_pages(df, index, ["a", "b"], "2024-01-20")
    assert got.columns == df.columns and sorted((r.page_id, r.user_rating) for r in got.collect()) == [(1, 4.0), (5, 2.0)]


def test_papers_of_the_last_years(spark):
    rows = [("q", i, f"http://x/abs/1234.{i}v2", f"t{i}", ["A", "B"], date(2024 - 2 * i, 1, 21), "s") for i in range(9)] + [("r", 0, "http://x/1.pdf", "t", [], None, "s")]
    df = spark.createDataFrame(rows, "query string, pos long, id string, title string, authors array<string>, published date, summary string")
    got = feeds.papers(df, "2024-01-20", count=4).orderBy("pos").collect()
    assert [r.arxiv_id for r in got] == ["1234.0", "1234.1", "1234.2", "1234.3"] and got[1].text == "Title: t1\nAuthors: A, B\nPublished: 2022-01-21\nSummary: s"
    assert feeds.papers(df, "2024-01-20").where("query = 'q'").count() == 5 and feeds.papers(df, "2034-01-22").count() == 0


def test_feeds_in_parts_and_pages_of_days(spark):
    feed = lambda *titles: "<rss><channel>" + "".join(f"<item><title>{t}</title></item>" for t in titles) + "</channel></rss>"
    files = spark.createDataFrame([("l", 2, feed("c", "d")), ("l", 1, feed("a", "b")), ("m", 1, "no xml")], "list_name string, part long, text string")
    items = feeds.rss_items(feeds.feed_entries(files, part="part"), "2024-01-20", 3).orderBy("ordinal").collect()
    assert [(r.title, r.ordinal) for r in items] == [("a", 0), ("b", 1), ("c", 2)]
    notes = spark.createDataFrame([("d1", 1, "n", "First. Second."), ("d1", 0, None, "zero"), ("d2", 0, "t", None), (None, 0, "lost", "x")], "day string, ord long, title string, text string")
    got = {r.name: r for r in actions.journal_pages(notes, "day", "ord", "title", "text", "ord").collect()}
    assert set(got) == {"d1", "d2"} and got["d1"].text.startswith("d1 zero\nn First.\n\nzero\nn First. Second.") and got["d1"].last_created_time == 1
    assert got["d2"].title == "d2 t"
