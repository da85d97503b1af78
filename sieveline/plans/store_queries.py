"""Sources, sinks, state and jobs as queries: what is written is read back, with SQL for what must come out."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sieveline import schemas
from sieveline.functions import records as R
from sieveline.functions import text as X
from sieveline.operators import blocks, chunking, dedup, health, providers, render, state
from sieveline.operators import vectors as K
from sieveline.plans import actions, jobs
from sieveline.plans.queries import _CUT, _LEAD, _PAGES, _TRIM, RUN_DAY, _pages, query
from sieveline.session import shared_path
from sieveline.session import table as read
from sieveline.sinks import writers
from sieveline.sources import feeds, files


@query("SELECT doc_id, CAST(quality AS BIGINT) AS quality, CAST(toxic AS BIGINT) AS toxic, 'r2' AS run_id FROM labels WHERE quality = 1")
def run_json_round_trip(spark, sf_dir):
    path, schema = shared_path(spark, "runs"), "doc_id long, quality long, toxic long"
    rows = read(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    writers.write_run(rows, path, "r1")
    writers.write_run(rows, path, "r2")
    writers.write_run(rows.where("quality = 1"), path, "r2")  # a run that is repeated replaces its own
    return files.read_run(spark, path, "r2", schema).withColumn("run_id", F.lit("r2"))


@query("SELECT doc_id, quality FROM labels WHERE toxic = 1")
def missing_json(spark, sf_dir):
    rows = read(spark, sf_dir, "labels").where("toxic = 1").select("doc_id", "quality")
    seen = files.read_json(spark, f"{shared_path(spark, 'nothing')}/seen.json", "doc_id long")  # the first run has no state yet
    return dedup.unseen(rows, seen, ["doc_id"])


@query("SELECT conv_id, CAST(count(*) AS BIGINT) AS n FROM conversations WHERE role = 'user' GROUP BY 1")
def named_files(spark, sf_dir):
    path = shared_path(spark, "named")
    c = read(spark, sf_dir, "conversations")
    c.where("role = 'user'").select("conv_id", "turn").write.json(f"{path}/a/users")
    c.where("role = 'user'").select("conv_id", "turn").limit(0).write.json(f"{path}/b/users")
    c.where("role <> 'user'").select("conv_id", "turn").write.parquet(f"{path}/a/others")
    found = files.read_named(spark, [f"{path}/a", f"{path}/b"], "*.json", "conv_id long, turn long")
    return found.groupBy("conv_id").agg(F.count("*").alias("n"))


@query("SELECT md5(text) AS body, count(*) AS n FROM benchmark WHERE text <> '' GROUP BY 1")
def text_files(spark, sf_dir):
    path = shared_path(spark, "texts")
    read(spark, sf_dir, "benchmark").where("text <> ''").select(F.col("text").alias("value")).write.option("maxRecordsPerFile", 1).option("lineSep", "\x00").text(path)
    return files.read_texts(spark, path).groupBy(F.md5(F.rtrim(F.col("text"), F.lit("\x00"))).alias("body")).agg(F.count("*").alias("n"))


_FEED = "f AS (SELECT source, lang, doc_id, 'd' || doc_id || ' & co' AS title, text, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos FROM documents)"
#: What XML cannot hold, and white space, as blanks.
_PLAIN = r"trim(regexp_replace(coalesce(text, ''), '[\x00-\x20]+', ' ', 'g'))"


def _feeds(spark, sf_dir) -> DataFrame:
    """Feeds in XML, one for each source, with all its documents in order, dated by their ids: a file for each thousand ids."""
    d = read(spark, sf_dir, "documents")
    day = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 28).cast("int")), "dd MMM yyyy")
    plain = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x00-\x20]+", " "))
    escaped = F.replace(F.replace(F.replace(plain, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    item = F.concat(F.lit("<item><title>d"), "doc_id", F.lit(" &amp; co</title><link>http://x.org/"), "doc_id", F.lit("</link><description>"), escaped, F.lit("</description><category>"), "lang", F.lit("</category><category>all</category><pubDate>Mon, "), day, F.lit(" 10:00:00 GMT</pubDate></item>"))
    each = d.groupBy(F.col("source").alias("list_name"), F.expr("doc_id div 1000").alias("part")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", item.alias("x")))), lambda s: s.x), "").alias("items"))
    return each.select("list_name", "part", F.concat(F.lit("<rss><channel>"), "items", F.lit("</channel></rss>")).alias("text"))


@query(f"WITH {_FEED} SELECT source AS list_name, count(*) AS n, max(title) AS last_title, CAST(sum(length({_PLAIN})) AS BIGINT) AS chars, CAST(sum(CAST('0x' || substr(md5({_PLAIN} || pos), 1, 10) AS BIGINT)) AS BIGINT) AS checksum FROM f GROUP BY 1")
def feed_entries(spark, sf_dir):
    e = feeds.feed_entries(_feeds(spark, sf_dir), part="part").withColumn("summary", F.coalesce("summary", F.lit("")))
    before = e.groupBy("list_name", "part").agg(F.count("*").alias("_size"))  # a row for each file
    offset = F.coalesce(F.sum("_size").over(Window.partitionBy("list_name").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    e = e.join(before.select("list_name", "part", offset.alias("_before")), ["list_name", "part"])
    own = F.conv(F.substring(F.md5(F.concat("summary", F.col("pos") + F.col("_before"))), 1, 10), 16, 10).cast("long")
    return e.groupBy("list_name").agg(F.count("*").alias("n"), F.max("title").alias("last_title"), F.sum(F.length("summary")).alias("chars"), F.sum(own).alias("checksum"))


_ITEMS = f"""i AS (SELECT md5(source || '_' || title || '_' || strftime(DATE '2024-01-01' + CAST(doc_id % 28 AS INTEGER), '%Y-%m-%d')) AS id, source AS list_name, title, 'http://x.org/' || doc_id AS url, CAST(pos AS INTEGER) AS ordinal,
lang || ',all' AS topics, {_PLAIN} AS summary FROM f WHERE pos <= 2)"""


@query(f"WITH {_FEED}, {_ITEMS} SELECT * FROM i")
def rss_items(spark, sf_dir):
    items = feeds.rss_items(feeds.feed_entries(_feeds(spark, sf_dir), part="part"), RUN_DAY)
    return items.select("id", "list_name", "title", "url", "ordinal", F.array_join(feeds.tag_topics(F.col("tags")), ",").alias("topics"), "summary")


@query("""SELECT 'p' || page_id AS id, 'name ' || page_id AS title, CASE page_id % 4 WHEN 0 THEN 'unknown' WHEN 1 THEN 'reddit' WHEN 2 THEN 'tube' END AS provider,
CASE page_id % 4 WHEN 0 THEN '' WHEN 1 THEN 'v.mp4' WHEN 2 THEN url END AS video_url, CASE WHEN page_id % 5 = 0 THEN 'http://i/g.gif' ELSE '' END AS pictures, md5('sub' || '_' || 'name ' || page_id || '_' || 'me' || '_' || '1700000000.0') AS hash_id, '2023-11-14 22:13:20' AS utc
FROM pages""")
def listing_posts(spark, sf_dir):
    p = read(spark, sf_dir, "pages")
    media = (
        F.when(F.col("page_id") % 4 == 1, F.lit('{"reddit_video": {"fallback_url": "v.mp4", "dash_url": "a"}}'))
        .when(F.col("page_id") % 4 == 2, F.lit('{"oembed": {"provider_name": "tube"}}')).when(F.col("page_id") % 4 == 3, F.lit('{"type": "odd"}')).otherwise(F.lit("null"))
    )
    shots = F.when(F.col("page_id") % 5 == 0, F.lit('{"a": {"status": "valid", "e": "Gif", "s": {"gif": "http://i/g.gif"}}, "b": {"status": "failed"}}')).otherwise(F.lit("null"))
    text = lambda c: F.to_json(F.struct(c.alias("v"))).substr(F.lit(6), F.length(F.to_json(F.struct(c.alias("v")))) - 6)
    answer = F.concat(
        F.lit('{"data": {"children": [{"data": {"id": "p'), "page_id", F.lit('", "title": "name '), "page_id", F.lit('", "subreddit": "sub", "author": "me", "created_utc": 1700000000.0, "url": '), text(F.col("url")),
        F.lit(', "media": '), media, F.lit(', "media_metadata": '), shots, F.lit("}}]}}"),
    )
    posts = feeds.listing_posts(p.select(answer.alias("answer")))
    return posts.select(
        "id", "title", F.col("video.video_provider").alias("provider"), F.col("video.video_url").alias("video_url"), F.array_join(F.transform("gallery_medias", lambda g: g.url), ",").alias("pictures"), "hash_id",
        F.date_format("datetime_utc", "yyyy-MM-dd HH:mm:ss").alias("utc"),
    )


@query("""WITH t AS (SELECT conv_id * 1000 + turn AS id, role, text, conv_id, turn FROM conversations)
SELECT a.id AS tweet_id, CASE WHEN a.turn % 3 = 0 THEN 'RT ' || a.role ELSE a.text END AS text, CASE WHEN a.turn % 3 = 0 THEN 'rm' WHEN a.turn % 3 = 1 THEN 'm' ELSE 'u2' END AS embed, a.turn % 3 = 0 AS retweeted,
CASE WHEN b.turn % 3 = 0 THEN 'RT ' || b.role ELSE b.text END AS reply_text, a.turn > 0 AND b.id IS NULL AS reply_deleted FROM t a LEFT JOIN t b ON a.turn > 0 AND b.id = a.id - 1 AND b.conv_id = a.conv_id""")
def tweet_records(spark, sf_dir):
    c = read(spark, sf_dir, "conversations")
    own = F.col("conv_id") * 1000 + F.col("turn")
    again = F.col("turn") % 3 == 0
    rows = c.select(
        own.alias("tweet_id"), F.col("role").alias("name"), F.col("role").alias("screen_name"), "text", F.lit("2024-01-01").cast("timestamp_ntz").alias("created_at"),
        F.when(F.col("turn") % 3 != 2, F.array(F.lit("m0"), F.lit("m"))).alias("media"), F.array(F.lit("u1"), F.lit("u2")).alias("urls"), F.when(again, F.concat(F.lit("RT "), "role")).alias("retweeted_text"),
        F.when(again, F.array(F.lit("rm"))).alias("retweeted_media"), F.when(F.col("turn") > 0, own - 1).alias("reply_to_status_id"),
    )
    return feeds.tweets(rows).select("tweet_id", "text", "embed", "retweeted", "reply_text", "reply_deleted")


@query("SELECT doc_id, n FROM (SELECT doc_id, unnest(['a' || source, lang]) AS n FROM documents WHERE doc_id % 2 = 0)")
def enabled_lists(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select("doc_id", F.array(F.concat(F.lit("a"), "source"), F.col("lang")).alias("names"), (F.col("doc_id") % 2 == 0).alias("enabled"), F.col("doc_id").alias("created_time"))
    return feeds.enabled_lists(d, "names").select("doc_id", F.col("list_name").alias("n"))


@query("SELECT doc_id AS id, source FROM documents WHERE source = 'src1' ORDER BY doc_id DESC LIMIT 2")
def latest_databases(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "source", F.col("doc_id").alias("created_time"))
    return feeds.latest_databases(d, "src1").select("id", "source")


@query("SELECT user_id, event_id, CAST(event_id % 6 AS DOUBLE) AS user_rating FROM events WHERE event_type = 'view' AND ts >= TIMESTAMP '2024-01-10' AND event_id % 6 <> 5")
def rated_pages(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    rating = F.when(F.col("event_id") % 6 == 5, F.lit("none")).otherwise((F.col("event_id") % 6).cast("string"))
    pages = e.select("user_id", "event_id", F.col("event_type").alias("source"), rating.alias("user_rating"), F.col("ts").cast("timestamp").alias("last_edited_time"))
    return feeds.rated_pages(pages, "view", "2024-01-10").select("user_id", "event_id", "user_rating")


_BY_TWO = "m AS (SELECT event_type, user_id % 3 AS category, max(ts) AS watermark FROM events WHERE ts <= TIMESTAMP '2024-01-15' AND user_id % 3 > 0 GROUP BY ALL)"


@query(f"WITH {_BY_TWO} SELECT e.event_type, e.user_id % 3 AS category, count(*) AS n FROM events e LEFT JOIN m ON m.event_type = e.event_type AND m.category = e.user_id % 3 WHERE ts >= coalesce(watermark, TIMESTAMP '2024-01-19') GROUP BY ALL")
def watermark_by_source_and_category(spark, sf_dir):
    e = read(spark, sf_dir, "events").select("event_type", (F.col("user_id") % 3).alias("category"), "ts")
    none = spark.createDataFrame([], "event_type string, category long, watermark timestamp_ntz")
    marks = state.advance(none, e.where((F.col("ts") <= F.lit("2024-01-15").cast("timestamp_ntz")) & (F.col("category") > 0)), ["event_type", "category"], "ts")
    return state.since(e, marks, ["event_type", "category"], "ts", start="2024-01-19").groupBy("event_type", "category").agg(F.count("*").alias("n"))


_KINDS = {k: [*parts] for k, parts in state.KEYS.items()}
_KEY = {"source": "source", "list_name": "lang", "item_id": "CAST(doc_id AS VARCHAR)", "provider": "'p'", "model": "'m'", "ds": "'2024-01-20'"}
_TYPED = " UNION ALL ".join(
    f"SELECT '{k}' AS kind, concat_ws('_', '{k}', {', '.join(_KEY[p] for p in parts)}) AS key, arg_max(CAST(n_chars AS VARCHAR), doc_id) AS last_value, arg_min(CAST(n_chars AS VARCHAR), doc_id) AS first_value, {state.LIVES.get(k, 0)} AS days FROM documents GROUP BY ALL"
    for k, parts in _KINDS.items()
)


@query(f"WITH t AS ({_TYPED}) SELECT key, CASE WHEN days > 0 THEN last_value ELSE first_value END AS value, CASE WHEN days > 0 THEN TIMESTAMP '2024-01-20' + to_days(CAST(days AS INTEGER)) END AS expires_at FROM t WHERE days = 0 OR days > 20")
def typed_state(spark, sf_dir):
    """Every kind of state, written in one go and read 20 days on: kinds that live for two weeks are gone by then."""
    d = read(spark, sf_dir, "documents").select("source", F.col("lang").alias("list_name"), F.col("doc_id").alias("item_id"), F.lit("p").alias("provider"), F.lit("m").alias("model"), F.lit(RUN_DAY).alias("ds"), "n_chars")
    each = [state.writes(d, kind, F.col("n_chars"), F.col("item_id")) for kind in state.KEYS]
    writes = each[0]
    for w in each[1:]:
        writes = writes.unionByName(w)
    none = spark.createDataFrame([], "key string, value string, expires_at timestamp_ntz")
    return state.get(state.put(none, writes, RUN_DAY), "2024-02-09")


@query("SELECT doc_id, lang FROM documents")
def append_new_rows(spark, sf_dir):
    path = shared_path(spark, "append")
    d = read(spark, sf_dir, "documents").select("doc_id", "lang")
    d.where("doc_id % 2 = 0").write.parquet(path)
    writers.append_new(d.unionByName(d.where("doc_id % 5 = 0")), spark.read.parquet(path), "doc_id", path)
    return spark.read.parquet(path)


@query("SELECT CAST(doc_id AS VARCHAR) AS item_id, 'embed' AS stage, 'too long' AS reason, CAST(3 AS INTEGER) AS attempts FROM documents WHERE n_chars > 1000")
def dead_letters(spark, sf_dir):
    d = read(spark, sf_dir, "documents").withColumn("error", F.when(F.col("n_chars") > 1000, "too long"))
    _, failed = writers.split_failures(d, "error")
    return writers.dead_letters(failed, "embed", "doc_id", "error", 3, RUN_DAY).drop("failed_at")


@query("SELECT source, count(*) AS total, CAST(count(*) FILTER (n_chars > 1000) AS BIGINT) AS errors FROM documents GROUP BY 1")
def push_totals(spark, sf_dir):
    return writers.push_totals(read(spark, sf_dir, "documents").withColumn("error", F.when(F.col("n_chars") > 1000, "too long")), "source")


@query("""SELECT lang AS category, md5('---' || chr(10) || 'title: "note ' || doc_id || '"' || chr(10) || 'source: ' || source || chr(10) || 'url: http://x' || chr(10) || 'date: 2024-01-20' || chr(10) || 'rating: 4' || chr(10) || 'tags: ["' || lang || '"]' || chr(10) || '---' || chr(10)
|| chr(10) || '# note ' || doc_id || chr(10) || chr(10) || coalesce(text, '') || chr(10)) AS note FROM documents WHERE doc_id % 7 <> 0""")
def markdown_notes(spark, sf_dir):
    path = shared_path(spark, "notes")
    d = read(spark, sf_dir, "documents").select(
        F.concat(F.lit("note "), "doc_id").alias("title"), F.lit("http://x").alias("url"), "source", F.array("lang").alias("tags"), F.lit(4).alias("rating"), F.col("text").alias("summary"),
        F.lit(RUN_DAY).cast("timestamp").alias("created_time"), "lang", "doc_id",
    )
    known = writers.markdown_note(d.where("doc_id % 7 = 0"))
    writers.write_notes(d, path, "lang", known, folders=True)
    out = shared_path(spark, "notes_read")
    for back in files.read_notes(spark, path, d.count()):
        few = back.coalesce(4 * spark.sparkContext.defaultParallelism)  # Spark plans some 30 small files a task
        few.select("category", F.md5(F.substring("value", F.lit(1), F.length("value") - 1)).alias("note")).write.mode("append").parquet(out)  # without the file's last line break
    return spark.read.schema("category string, note string").parquet(out)


@query(r"""SELECT doc_id, source || '_' || lang || '_note ' || doc_id || '.md' AS file_name, '---' || chr(10) || 'created_at: 2024-01-20' || chr(10) || 'rating: 4.5' || chr(10) || 'user_rating: ' || coalesce(CAST(quality AS VARCHAR), '') || chr(10) || 'alias: ' || chr(10) || 'to: ' || chr(10)
|| 'source: ' || source || chr(10) || 'list_name: ' || lang || chr(10) || 'notion url: http://x/' || doc_id || chr(10) || 'topic: ' || lang || ', all' || chr(10) || 'category: ' || lang || chr(10) || 'take aways: ' || regexp_replace(coalesce(text, ''), '[\x09-\x0D\x20]*\n[\x09-\x0D\x20]*', ' ', 'g') || chr(10) || '---' || chr(10) || chr(10)
|| 'Tags:: #notion/toread' || chr(10) || 'Refs:: [[Notion ToRead - MOC]]' || chr(10) || chr(10) || coalesce(text, '') || chr(10) AS note FROM documents LEFT JOIN labels USING (doc_id)""")
def inbox_notes(spark, sf_dir):
    d = read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("user_rating")), "doc_id", "left")
    items = d.select(
        "doc_id", F.lit(RUN_DAY).cast("timestamp").alias("created_time"), F.lit(4.5).alias("rating"), "user_rating", "source", F.col("lang").alias("list_name"), F.concat(F.lit("http://x/"), "doc_id").alias("url"),
        F.concat(F.lit("note: "), "doc_id").alias("title"), F.array("lang", F.lit("all")).alias("topics"), F.array("lang").alias("categories"), F.col("text").alias("take_aways"), F.col("text").alias("body"),
    )
    return writers.inbox_note(items, ["doc_id"])


@query(r"""SELECT CAST(page_id AS VARCHAR) AS page_id, url, regexp_extract(replace(list_extract(string_split(url, '/'), -1), '.pdf', ''), '^[^v]*') AS arxiv_id FROM pages""")
def arxiv_ids(spark, sf_dir):
    return read(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("page_id"), "url", X.arxiv_id(F.col("url")).alias("arxiv_id"))


@query("""WITH p AS (SELECT source AS query, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS n, DATE '2024-01-20' - CAST(doc_id % 9000 AS INTEGER) AS day, lang, text FROM documents WHERE DATE '2024-01-20' - CAST(doc_id % 9000 AS INTEGER) >= DATE '2014-01-20')
SELECT query, 'http://x/abs/' || doc_id || '.12' AS id, doc_id || '.12' AS arxiv_id, concat_ws(chr(10), 'Title: paper ' || doc_id, 'Authors: a, ' || lang, 'Published: ' || day, 'Summary: ' || text) AS text FROM p WHERE n <= 5""")
def papers(spark, sf_dir):
    d = read(spark, sf_dir, "documents")
    day = F.date_sub(F.lit(RUN_DAY).cast("date"), (F.col("doc_id") % 9000).cast("int"))
    found = d.select(F.col("source").alias("query"), F.col("doc_id").alias("pos"), F.concat(F.lit("http://x/abs/"), "doc_id", F.lit(".12v3")).alias("id"), F.concat(F.lit("paper "), "doc_id").alias("title"), F.array(F.lit("a"), F.col("lang")).alias("authors"), day.alias("published"), F.col("text").alias("summary"))
    return feeds.papers(found, RUN_DAY).select("query", F.regexp_replace("id", "v3$", "").alias("id"), "arxiv_id", "text")


_WEEK = """x AS (SELECT event_type AS source, CAST(ts AS DATE) AS day, event_type || '_' || CAST(ts AS DATE) AS id FROM events GROUP BY ALL), b AS (SELECT id, source FROM x WHERE source <> 'error' QUALIFY row_number() OVER (PARTITION BY source ORDER BY day DESC) <= 2)"""


@query(f"""WITH {_WEEK}, e AS (SELECT v.* FROM events v JOIN b ON b.id = v.event_type || '_' || CAST(v.ts AS DATE) WHERE ts >= TIMESTAMP '2024-01-23' AND value >= 10)
SELECT user_id AS page_id, arg_max(event_type, (ts, -event_id)) AS source, arg_max(value, (ts, -event_id)) AS user_rating, max(ts) AS last_edited_time FROM e GROUP BY 1""")
def weekly_pages(spark, sf_dir):
    # a database for each type and day; the two newest of four types count
    e = read(spark, sf_dir, "events")
    database = F.concat_ws("_", "event_type", F.to_date("ts").cast("string"))
    index = e.select(F.col("event_type").alias("source"), database.alias("id"), F.to_date("ts").alias("created_time")).distinct()
    pages = e.select(F.col("user_id").alias("page_id"), database.alias("database_id"), F.col("event_type").alias("source"), F.when(F.col("value") >= 10, F.col("value")).alias("user_rating"), F.col("ts").alias("last_edited_time"), F.col("event_id").alias("ordinal"))
    return feeds.weekly_pages(pages, index, ["view", "click", "signup", "purchase"], "2024-01-30").select("page_id", "source", "user_rating", "last_edited_time")


@query(r"""SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'video v.redd.it/' || page_id WHEN 1 THEN 'image ' || url WHEN 2 THEN 'image http://i/1&2' ELSE 'embed ' || url END || '|quote q' || page_id || '.|paragraph sum ' || page_id || '|link Link|comment Subreddit: sub' AS blocks FROM pages""")
def post_blocks(spark, sf_dir):
    p, k = read(spark, sf_dir, "pages"), F.col("page_id") % 4
    rows = p.select(
        "page_id", "url", F.concat(F.lit("q"), "page_id", F.lit(".")).alias("text"), F.concat(F.lit("sum "), "page_id").alias("summary"), F.lit("http://r").alias("permalink"), F.lit("sub").alias("subreddit"), F.lit("me").alias("author"), F.lit(1).alias("ups"), F.lit(0).alias("downs"), F.lit(2).alias("num_comments"),
        (k == 0).alias("is_video"), (k == 1).alias("is_image"), (k == 2).alias("is_gallery"), (k == 3).alias("is_external_link"), F.struct(F.concat(F.lit("v.redd.it/"), "page_id").alias("video_url")).alias("video"), F.array(F.struct(F.lit("http://i/1&amp;2").alias("url"))).alias("gallery_medias"),
    )
    told = F.transform("blocks", lambda b: F.concat_ws(" ", b.type, F.coalesce(F.nullif(F.split(b.text, "\n")[0], F.lit("")), b.url)))
    return render.post_blocks(rows).select("page_id", F.array_join(told, "|").alias("blocks"))


@query("SELECT 'unique' AS rule, text AS value, count(*) AS n FROM (SELECT CAST(doc_id // 2 AS VARCHAR) AS text FROM documents) GROUP BY 2 HAVING count(*) > 1 UNION ALL SELECT 'status', lang, count(*) FROM documents WHERE lang NOT IN ('pending', 'approved', 'rejected') GROUP BY 2")
def table_violations(spark, sf_dir):
    rows = read(spark, sf_dir, "documents").select(F.expr("doc_id div 2").alias("content_id"), F.col("lang").alias("status"), F.lit(RUN_DAY).cast("timestamp").alias("updated_at"))
    return schemas.violations(rows, "review_status")


@query("SELECT doc_id, lower(split_part(lang, '-', 1)) IN ('en', 'de') AS known FROM documents")
def truth_values(spark, sf_dir):
    word = F.when(F.col("lang").isin("en", "de"), F.lit("TRUE")).otherwise(F.lit("no"))
    return read(spark, sf_dir, "documents").select("doc_id", R.to_bool(word).alias("known"))


@query("""WITH w AS (SELECT CAST(date_trunc('week', ts) AS DATE) AS week, event_type, value FROM events)
SELECT CAST(week AS VARCHAR) AS week, count(*) AS ingested, count(DISTINCT event_type) AS unique_n, CAST(count(*) FILTER (value >= 90) AS BIGINT) AS top_scored FROM w GROUP BY 1""")
def weekly_funnel(spark, sf_dir):
    out = health.weekly_funnel(read(spark, sf_dir, "events"), "ts", F.col("event_type"), F.col("value"), 90.0)
    return out.select(F.col("week").cast("string").alias("week"), "ingested", F.col("unique").alias("unique_n"), "top_scored")


@query("""WITH e AS (SELECT user_id, ts, CASE event_type WHEN 'purchase' THEN 'approved' WHEN 'click' THEN 'rejected' ELSE 'pending' END AS status FROM events WHERE user_id % 2 = 0 OR ts < TIMESTAMP '2024-01-12'),
s AS (SELECT user_id, count(*) FILTER (status = 'approved') / nullif(count(*) FILTER (status <> 'pending'), 0) AS rate, max(ts) AS last_item FROM e GROUP BY 1)
SELECT user_id, round(rate, 6) AS approval_rate, coalesce(rate < 0.2, false) AS low_approval, date_diff('day', CAST(last_item AS DATE), DATE '2024-02-05') >= 14 AS silent FROM s""")
def weak_sources(spark, sf_dir):
    e = read(spark, sf_dir, "events").where("user_id % 2 = 0 or ts < timestamp_ntz'2024-01-12'")
    status = F.when(F.col("event_type") == "purchase", "approved").when(F.col("event_type") == "click", "rejected").otherwise("pending")
    out = health.weak_sources(e.withColumn("status", status), "user_id", "ts", "status", "2024-02-05")
    return out.select("user_id", F.round("approval_rate", 6).alias("approval_rate"), "low_approval", "silent")


@query("SELECT CAST(DATE '2024-01-31' AS VARCHAR) AS ds, CAST(event_id AS VARCHAR) AS item_id FROM events WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)")
def collection_fallback(spark, sf_dir):
    c = K.Collection(spark, shared_path(spark, "collection"))
    c.reset()
    e = read(spark, sf_dir, "events")
    last = e.agg(F.max(F.to_date("ts"))).first()[0]
    own = e.where(F.to_date("ts") == F.lit(last)).select(F.col("event_id").cast("string").alias("item_id"), F.array(F.lit(1.0).cast("float")).alias("embedding"), F.lit("2024-01-31").cast("date").alias("ds"))
    c.insert(own)
    found = c.day("2024-02-01")  # the day has none, the one before has
    return found.select(F.col("ds").cast("string").alias("ds"), "item_id")


@query(f"""WITH {_PAGES}, t AS (SELECT doc_id, source, list_filter(list_transform(string_split(regexp_replace(take_aways, '^\\s+|\\s+$', '', 'g'), chr(10)), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x <> '') AS items
FROM p WHERE take_aways <> '' AND source <> 'TODO' AND NOT deep) SELECT CAST(doc_id AS VARCHAR) AS item_id, count(*) AS n FROM (SELECT doc_id, unnest(items) FROM t) GROUP BY 1""")
def job_todo(spark, sf_dir):
    ws = jobs.Workspace(spark, shared_path(spark, "workspace"))
    made = jobs.todo(ws, _pages(spark, sf_dir), RUN_DAY)
    return made.groupBy("item_id").agg(F.count("*").alias("n"))


@query(f"WITH {_PAGES} SELECT CAST(doc_id AS VARCHAR) AS item_id, CAST(3 AS INTEGER) AS versions, take_aways || ' (version 3)' AS head FROM p WHERE deep AND take_aways <> ''")
def job_deepdive(spark, sf_dir):
    ws = jobs.Workspace(spark, shared_path(spark, "workspace"))
    made = jobs.deepdive(ws, _pages(spark, sf_dir), RUN_DAY)
    behind = F.substring("deepdive", F.length("take_aways") + 1, F.length("deepdive"))  # what stands after the take-aways in the last version
    return made.select("item_id", F.size("versions").alias("versions"), F.concat("take_aways", F.substring_index(behind, "\n\n", 1)).alias("head"))


_SECTION = lambda header, x: f"CASE WHEN contains({x}, '{header}') THEN '' ELSE '{header}' || chr(10) END || {x}"
_NUMBERED = "array_to_string(list_transform(list_filter(list_transform(string_split({0}, chr(10)), lambda y: {1}), lambda y: y <> ''), lambda y, k: k || '. ' || y), chr(10))"
_JOURNAL = f"""e AS (SELECT conv_id, string_agg(coalesce(role, '') || ' ' || coalesce(text, '') || chr(10), '' ORDER BY turn) AS entry, max(turn) AS last_created_time FROM conversations WHERE conv_id IS NOT NULL GROUP BY 1),
r AS (SELECT *, {_TRIM("regexp_replace(entry, '\n+', chr(10), 'g')")} AS r FROM e),
s AS (SELECT *, {_TRIM(_CUT('r', 1))} AS one, {_LEAD('r')} AS lead, {_NUMBERED.format('r', _TRIM('y'))} AS todo FROM r),
j AS (SELECT CAST(conv_id AS VARCHAR) AS name, last_created_time, conv_id || ' ' || left(one, 40) AS title, coalesce(nullif(todo, ''), 'n/a') AS todo,
concat_ws(chr(10) || chr(10), conv_id || ' ' || left(one, 40), r, {_SECTION('Critical Insights', 'one')}, {_SECTION('Takeaways', 'lead')}, {_SECTION('Action Items', 'todo')}, 'Overall:' || chr(10) || lead) AS text FROM s)"""


@query(f"WITH {_JOURNAL} SELECT name, 'Journal' AS source, last_created_time, title, todo, text FROM j")
def journal_pages(spark, sf_dir):
    c = read(spark, sf_dir, "conversations")
    return actions.journal_pages(c, "conv_id", "turn", "role", "text", "turn").select("name", "source", "last_created_time", "title", "todo", "text")


def _notes(spark, sf_dir, conv: str) -> DataFrame:
    """The turns of a conversation as a run's notes."""
    c = read(spark, sf_dir, "conversations").where(conv)
    at = F.timestamp_seconds(F.lit(1_705_708_800) + F.col("turn"))
    return c.select(F.concat_ws("-", "conv_id", "turn").alias("item_id"), F.col("role").alias("title"), "text", at.alias("created_time"))


@query(f"WITH {_JOURNAL} SELECT '2024-01-20' AS name, TIMESTAMP '2024-01-20' + to_seconds(last_created_time) AS last_created_time, replace(title, name || ' ', '2024-01-20 ') AS title, todo, replace(text, title, replace(title, name || ' ', '2024-01-20 ')) AS text FROM j WHERE name = (SELECT CAST(min(conv_id) AS VARCHAR) FROM conversations)")
def job_journal(spark, sf_dir):
    ws = jobs.Workspace(spark, shared_path(spark, "workspace"))
    first = read(spark, sf_dir, "conversations").agg(F.min("conv_id")).first()[0]
    done = jobs.journal(ws, _notes(spark, sf_dir, f"conv_id = {first}"), RUN_DAY)
    return done.select("name", F.col("last_created_time").cast("timestamp_ntz").alias("last_created_time"), "title", "todo", "text")


@query("SELECT '2024-01-21 n/a' AS title, 'n/a' AS todo, '' AS text, (SELECT TIMESTAMP '2024-01-20' + to_seconds(max(turn)) FROM conversations) AS mark")
def job_journal_without_notes(spark, sf_dir):
    ws = jobs.Workspace(spark, shared_path(spark, "workspace"))
    last = read(spark, sf_dir, "conversations").orderBy(F.col("turn").desc(), "conv_id").select("conv_id").first()[0]
    for day in (RUN_DAY, "2024-01-21"):  # the second run's notes were all taken by the first
        done = jobs.journal(ws, _notes(spark, sf_dir, f"conv_id = {last}"), day)
    mark = ws.read("marks", jobs.MARKS).select(F.col("watermark").cast("timestamp_ntz").alias("mark"))
    return done.select("title", "todo", "text").join(mark, F.lit(True), "left")


def _rated(spark, sf_dir) -> DataFrame:
    e = read(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").cast("string").alias("item_id"), F.col("event_type").alias("source"), F.col("event_type").alias("title"), F.col("props").alias("text"), F.lit("").alias("take_aways"),
        F.array().cast("array<string>").alias("tags"), F.round("value").alias("user_rating"), F.col("ts").cast("timestamp").alias("last_edited_time"), F.col("event_id").alias("ordinal"),
    )


@query("""WITH a AS (SELECT user_id, arg_max(round(value), ts) AS r FROM events WHERE ts < TIMESTAMP '2024-01-10' GROUP BY 1),
b AS (SELECT user_id, arg_max(round(value), ts) AS r FROM events GROUP BY 1)
SELECT CASE WHEN a.user_id IS NULL THEN 'new' ELSE 'updated' END AS change_type, count(*) AS n FROM b LEFT JOIN a USING (user_id) WHERE a.user_id IS NULL OR a.r <> b.r GROUP BY 1""")
def job_sync_and_distribute(spark, sf_dir):
    ws = jobs.Workspace(spark, shared_path(spark, "workspace"))
    pages = _rated(spark, sf_dir)
    jobs.sync(ws, pages.where("last_edited_time < timestamp'2024-01-10'"), "2024-01-10")
    jobs.distribute(ws, "2024-01-10")
    jobs.sync(ws, pages, RUN_DAY)
    return jobs.distribute(ws, RUN_DAY)


@query(f"""WITH {_FEED}, {_ITEMS}, t AS MATERIALIZED (SELECT *, CASE WHEN summary = '' THEN chr(10) ELSE summary || chr(10) END AS body FROM i),
l AS (SELECT *, {_LEAD('body')} AS lead FROM t)
SELECT id AS item_id, list_name, title, url, lead AS summary, round(CASE WHEN length(list_name || ' ' || title || ' ' || lead) > 2000 THEN -2 ELSE least(1, (length(list_name || ' ' || title || ' ' || lead) // 2) / 1000) * 100 END, 4) AS rate, -1.0::DOUBLE AS relevance,
CAST(count(*) OVER (PARTITION BY list_name) AS BIGINT) AS pushed FROM l""")
def job_pull_and_save(spark, sf_dir):
    ws = jobs.Workspace(spark, shared_path(spark, "workspace"))
    ws.vectors.create()
    jobs.pull_feeds(ws, _feeds(spark, sf_dir), "r1", RUN_DAY)
    counts = jobs.save(ws, "r1", RUN_DAY, "reddit").where("input = deduped and deduped = pushed").select(F.col("source").alias("list_name"), "pushed")
    out = spark.read.schema(jobs.PUBLISHED).parquet(f"{ws.path}/published/run_id=r1").join(counts, "list_name")
    return out.select("item_id", "list_name", "title", "url", "summary", F.round("rate", 4).alias("rate"), "relevance", "pushed")


@query(r"""SELECT doc_id, [CAST(length(coalesce(text, '')) AS DOUBLE), CAST(length(coalesce(text, '')) - length(replace(coalesce(text, ''), ' ', '')) AS DOUBLE), CAST(length(coalesce(text, '')) - length(replace(coalesce(text, ''), chr(10), '')) AS DOUBLE)] AS vector FROM documents""")
def batched_embeddings(spark, sf_dir):
    embed = providers.batched(lambda texts: [[float(len(t)), float(t.count(" ")), float(t.count("\n"))] for t in texts], 100)
    return read(spark, sf_dir, "documents").select("doc_id", F.transform(embed(F.col("text")), lambda x: x.cast("double")).alias("vector"))


@query("""SELECT conv_id, turn, CASE WHEN role = 'user' THEN 'Q: ' || text ELSE '- ' || text || chr(10) END || chr(10) AS text FROM conversations""")
def rendered_blocks(spark, sf_dir):
    c = read(spark, sf_dir, "conversations")
    own = F.when(F.col("role") == "user", render.block("paragraph", F.concat(F.lit("Q: "), "text"))).otherwise(render.block("bulleted_list_item", F.col("text")))
    return c.select("conv_id", "turn", render.to_text(F.array(own)).alias("text"))


@query("""SELECT doc_id, CAST(len(text) AS BIGINT) AS n_chars, sha256(text) AS chunk_id FROM documents WHERE len(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) BETWEEN 100 AND 800 AND regexp_replace(text, '^\\s+|\\s+$', '', 'g') = text AND NOT contains(text, chr(10) || chr(10))""")
def chunk_short_documents(spark, sf_dir):
    d = read(spark, sf_dir, "documents")
    chunks = chunking.chunk(d)
    whole = d.where((F.length("text").between(100, 800)) & (X.strip(F.col("text")) == F.col("text")) & ~F.col("text").contains("\n\n")).select("doc_id")
    out = chunks.join(whole, F.col("article_id") == F.col("doc_id").cast("string"))
    return out.select("doc_id", F.length("chunk_text").cast("long").alias("n_chars"), "chunk_id")


@query("""SELECT conv_id AS page_id, string_agg(cells, '' ORDER BY turn) || '|' AS text, CAST(count(*) + 1 AS BIGINT) AS n FROM (SELECT conv_id, turn, role || ',' || turn || ',' || text || ',' || chr(10) AS cells FROM conversations) GROUP BY 1""")
def table_blocks(spark, sf_dir):
    # a table a conversation, a row a turn
    c = read(spark, sf_dir, "conversations")
    top = c.select(F.col("conv_id").alias("page_id")).distinct().select("page_id", F.lit("t").alias("block_id"), F.lit(None).cast("string").alias("parent_id"), F.lit(0).cast("long").alias("pos"), F.lit("table").alias("type"), F.lit("").alias("text"), F.lit(None).cast("array<string>").alias("cells"))
    row = c.select(F.col("conv_id").alias("page_id"), F.concat(F.lit("r"), "turn").alias("block_id"), F.lit("t").alias("parent_id"), F.col("turn").alias("pos"), F.lit("table_row").alias("type"), F.lit("").alias("text"), F.array("role", F.col("turn").cast("string"), "text").alias("cells"))
    return blocks.page_text(top.unionByName(row), "|")


@query("SELECT lang AS category, source AS name, CAST(min(doc_id) AS VARCHAR) AS index_id FROM documents GROUP BY ALL UNION ALL SELECT 'label', CAST(label AS VARCHAR), min(CAST(vec_id AS VARCHAR)) FROM embeddings GROUP BY 2")
def job_upgrade(spark, sf_dir):
    """Two patches that fill the index of a workspace; the second run of the upgrade and the repeated entries change nothing."""
    ws = jobs.Workspace(spark, shared_path(spark, "workspace"))
    d, v = read(spark, sf_dir, "documents"), read(spark, sf_dir, "embeddings")
    first = d.groupBy(F.col("lang").alias("category"), F.col("source").alias("name")).agg(F.min("doc_id").cast("string").alias("index_id"))
    labels = v.select(F.lit("label").alias("category"), F.col("label").cast("string").alias("name"), F.col("vec_id").cast("string").alias("index_id"))
    for _ in range(2):
        jobs.upgrade(ws, [(0, "lists", lambda w: jobs.bootstrap(w, first)), (1, "labels", lambda w: jobs.bootstrap(w, labels.unionByName(first.withColumn("index_id", F.lit("again")))))])
    return ws.read("index_pages", schemas.TABLES["index_pages"][0])
