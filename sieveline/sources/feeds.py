"""Flat records from the JSON that feeds, timelines and listings answer with.

Fetching is left to whatever lands the answers as files or streams; these functions are pure
transformations of them. Times are epoch seconds or parsed times in UTC; run dates are parameters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sieveline.functions.records import pacific, surrogate_key
from sieveline.functions.text import arxiv_id
from sieveline.functions.urls import absolute, flags
from sieveline.operators.dedup import latest

RSS_ENTRY = "list_name string, pos int, title string, link string, summary string, content string, tags array<struct<term:string>>, published string"
LISTING = (
    "data struct<children:array<struct<data:struct<id:string,name:string,title:string,selftext:string,url:string,permalink:string,subreddit:string,author:string,"
    "created_utc:double,ups:int,downs:int,num_comments:int,visited:boolean,is_video:boolean,is_gallery:boolean,"
    "media:struct<type:string,reddit_video:struct<fallback_url:string,dash_url:string>,oembed:struct<provider_name:string>>,"
    "media_metadata:map<string,struct<status:string,e:string,s:struct<u:string,gif:string>>>>>>>"
)
SITE = "https://www.reddit.com"


_RSS = "struct<channel:struct<item:array<struct<title:string,link:string,description:string,pubDate:string,category:array<string>>>>>"
_ATOM = "struct<entry:array<struct<title:string,link:struct<_href:string>,summary:string,content:string,updated:string,category:array<struct<_term:string>>>>>"


def feed_entries(files: DataFrame, list_name: str = "list_name", text: str = "text", part: str | None = None) -> DataFrame:
    """Entries of RSS and Atom documents (whole files as text), in their order; what is no XML gives none.

    A long feed may come in several files: ``part`` orders them, and entries have it before their place in the file.
    """
    files = files.select(F.col(list_name).alias("list_name"), F.col(text).alias("text"), (F.col(part) if part else F.lit(0)).cast("long").alias("part"))
    list_name, text = "list_name", "text"
    rss = F.coalesce(F.from_xml(F.col(text), _RSS)["channel"]["item"], F.array().cast("array<struct<title:string,link:string,description:string,pubDate:string,category:array<string>>>"))
    atom = F.coalesce(F.from_xml(F.col(text), _ATOM)["entry"], F.array().cast("array<struct<title:string,link:struct<_href:string>,summary:string,content:string,updated:string,category:array<struct<_term:string>>>>"))
    terms = lambda names: F.transform(F.coalesce(names, F.array().cast("array<string>")), lambda t: F.struct(t.alias("term")))
    bare = lambda t: F.regexp_replace(F.regexp_replace(t, "^[A-Za-z]+, *", ""), "(GMT|UTC|Z)$", "+0000")
    iso = lambda t: F.coalesce(F.date_format(F.try_to_timestamp(bare(t), F.lit("d MMM yyyy HH:mm:ss Z")), "yyyy-MM-dd'T'HH:mm:ssXXX"), t)
    a = files.select("list_name", "part", F.posexplode(rss).alias("pos", "e")).select(
        "list_name", "part", "pos", "e.title", "e.link", F.col("e.description").alias("summary"), F.lit(None).cast("string").alias("content"), terms(F.col("e.category")).alias("tags"), iso(F.col("e.pubDate")).alias("published")
    )
    b = files.select("list_name", "part", F.posexplode(atom).alias("pos", "e")).select(
        "list_name", "part", "pos", "e.title", F.col("e.link._href").alias("link"), "e.summary", "e.content", terms(F.col("e.category._term")).alias("tags"), F.col("e.updated").alias("published")
    )
    return a.unionByName(b)


def rss_items(entries: DataFrame, run_date: str, count: int = 3) -> DataFrame:
    """The first ``count`` entries of each list as items. The id is made of list, title and date, not of the URL."""
    order = ["part", "pos"] if "part" in entries.columns else ["pos"]
    first = entries.withColumn("_n", F.row_number().over(Window.partitionBy("list_name").orderBy(*order))).where(F.col("_n") <= count)
    published = F.try_to_timestamp("published")
    key = F.coalesce(F.date_format(published, "yyyy-MM-dd"), F.lit(run_date))
    return first.select(
        surrogate_key(F.col("list_name"), F.col("title"), key).alias("id"), F.lit("RSS").alias("source"), "list_name", "title", F.col("link").alias("url"),
        published.alias("created_time"), F.coalesce("summary", F.lit("")).alias("summary"), F.coalesce("content", F.lit("")).alias("content"), "tags", "published",
        key.alias("published_key"), (F.col("_n") - 1).alias("ordinal"),
    )


def tag_topics(tags: Column, k: int = 3) -> Column:
    """The first ``k`` tags, unsorted."""
    return F.slice(F.transform(tags, lambda t: t.term), 1, k)


def video(media: Column, post_url: Column) -> Column:
    """(video_provider, video_url, audio_url) of a post's media; null if there is media but none that is known."""
    three = lambda a, b, c: F.struct(a.alias("video_provider"), b.alias("video_url"), c.alias("audio_url"))
    own = media["reddit_video"]
    return (
        F.when(media.isNull(), three(F.lit("unknown"), F.lit(""), F.lit("")))
        .when(own.isNotNull(), three(F.lit("reddit"), own["fallback_url"], own["dash_url"]))
        .when(media["oembed"].isNotNull(), three(media["oembed"]["provider_name"], post_url, F.lit("")))
    )


def gallery(metadata: Column) -> Column:
    """(id, type, url) of each valid picture of a gallery."""
    valid = F.filter(F.map_entries(metadata), lambda e: (e.value["status"] == "valid") & e.value["s"].isNotNull())
    picture = F.transform(valid, lambda e: F.struct(e.key.alias("id"), e.value["e"].alias("type"), F.coalesce(e.value["s"]["u"], e.value["s"]["gif"]).alias("url")))
    return F.coalesce(picture, F.array().cast("array<struct<id:string,type:string,url:string>>"))


def listing_posts(answers: DataFrame, answer: str = "answer") -> DataFrame:
    """Posts of listing answers (JSON strings), one row each, in their order."""
    parsed = answers.select(F.from_json(answer, LISTING).alias("a")).select(F.posexplode("a.data.children").alias("ordinal", "c")).select("ordinal", "c.data.*")
    utc = F.timestamp_seconds("created_utc")
    link = flags(F.col("url"))
    # plain decimals with at least one place, whatever the size: 1700000000.0
    at = F.regexp_replace(F.regexp_replace(F.col("created_utc").cast("decimal(24,6)").cast("string"), "0+$", ""), r"\.$", ".0")
    return parsed.select(
        "id", F.col("name").alias("long_id"), surrogate_key(F.col("subreddit"), F.col("title"), F.col("author"), at).alias("hash_id"),
        F.col("created_utc").alias("timestamp"), utc.alias("created_time"), utc.cast("timestamp_ntz").alias("datetime_utc"),
        pacific(utc.cast("timestamp_ntz")).alias("datetime_pdt"), F.lit("Reddit").alias("source"), "title", F.col("selftext").alias("text"),
        absolute(F.col("url"), SITE).alias("url"), F.concat(F.lit(SITE), "permalink").alias("permalink"), "subreddit", "author", "ups", "downs", "num_comments", "visited",
        F.coalesce("is_video", F.lit(False)).alias("is_video"), link["is_image"].alias("is_image"), (F.coalesce("is_gallery", F.lit(False)) | link["is_gallery"]).alias("is_gallery"),
        (~absolute(F.col("url"), SITE).contains("reddit.com")).alias("is_external_link"), video(F.col("media"), F.col("url")).alias("video"), gallery(F.col("media_metadata")).alias("gallery_medias"), "ordinal",
    )


def tweets(rows: DataFrame) -> DataFrame:
    """Tweets with a retweeted text in place of their own and their reply's text beside them.

    ``rows``: tweet_id, name, screen_name, text, created_at (UTC), media, urls (arrays of URLs),
    retweeted_text, retweeted_media, reply_to_status_id. A reply whose tweet is not there is deleted.
    """
    last = lambda *arrays: F.coalesce(*(F.try_element_at(F.col(a), F.lit(-1)) for a in arrays), F.lit(""))
    own = rows.select(
        "tweet_id", "name", "screen_name", F.coalesce("retweeted_text", "text").alias("text"),
        F.when(F.col("retweeted_text").isNotNull(), last("retweeted_media", "media", "urls")).otherwise(last("media", "urls")).alias("embed"),
        F.concat(F.lit("https://twitter.com/"), "screen_name", F.lit("/status/"), F.col("tweet_id").cast("string")).alias("url"),
        F.col("retweeted_text").isNotNull().alias("retweeted"), F.col("created_at").alias("created_at_utc"), pacific(F.col("created_at")).alias("created_at_pdt"), "reply_to_status_id",
    )
    other = own.select(F.col("tweet_id").alias("_id"), F.col("name").alias("reply_to_name"), F.col("text").alias("reply_text"), F.col("embed").alias("reply_embed"), F.col("url").alias("reply_url"))
    joined = own.join(other, F.col("reply_to_status_id") == F.col("_id"), "left")
    return joined.withColumn("reply_deleted", F.col("reply_to_status_id").isNotNull() & F.col("_id").isNull()).drop("_id")


def enabled_lists(lists: DataFrame, names: str | None = None) -> DataFrame:
    """Enabled rows of a list table, newest first; with ``names``, one row for each name of that array column."""
    out = lists.where("enabled").orderBy(F.col("created_time").desc())
    return out.withColumn("list_name", F.explode(names)) if names else out


def latest_databases(index: DataFrame, source: str | None = None, n: int = 2) -> DataFrame:
    """The newest ``n`` databases of a source."""
    return (index.where(F.col("source") == source) if source else index).orderBy(F.col("created_time").desc(), "id").limit(n)


def rated_pages(pages: DataFrame, source: str, since: str, require_rating: bool = True) -> DataFrame:
    """Pages of a source edited at or after ``since``, oldest edit first; ratings become numbers."""
    own = pages.where((F.col("source") == source) & (F.col("last_edited_time") >= F.lit(since).cast("timestamp")))
    own = own.withColumn("user_rating", F.try_to_number("user_rating", F.lit("9")).cast("double"))
    return (own.where("user_rating is not null") if require_rating else own).orderBy("last_edited_time")


def latest_per_source(index: DataFrame, sources: list[str], n: int = 2) -> DataFrame:
    """The newest ``n`` databases (source, id, created_time) of each of the sources."""
    order = Window.partitionBy("source").orderBy(F.col("created_time").desc(), "id")
    return index.where(F.col("source").isin(*sources)).withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= n).drop("_n")


def weekly_pages(pages: DataFrame, index: DataFrame, sources: list[str], run_day: str, days: int = 7, n: int = 2) -> DataFrame:
    """Rated pages of the week: of the newest ``n`` databases of each source, edited in the ``days`` before the run's end, each page's latest edit.

    Pages (page_id, database_id, source, user_rating, last_edited_time, ordinal) of other databases and sources are left out.
    The index is small; a page is in one source's database, so pages join it by database.
    """
    own = latest_per_source(index, sources, n).select(F.col("id").alias("_database"), F.col("source").alias("_source"))
    since = F.date_sub(F.lit(run_day).cast("date"), days).cast(pages.schema["last_edited_time"].dataType)
    recent = pages.where((F.col("last_edited_time") >= since) & F.col("user_rating").isNotNull())
    joined = recent.join(own, (F.col("database_id") == F.col("_database")) & (F.col("source") == F.col("_source"))).drop("_database", "_source")
    return latest(joined, "page_id", "last_edited_time", "ordinal")


def papers(entries: DataFrame, run_day: str, years: int = 10, count: int = 5, query: str = "query") -> DataFrame:
    """Papers found by a search (query, pos, id, title, authors, published, summary): published in the last ``years``, ``count`` a query in their order.

    ``text`` is what a summary is made of: title, authors, date and abstract.
    """
    since = F.add_months(F.lit(run_day).cast("date"), -12 * years)
    kept = entries.where(F.to_date("published") >= since)
    first = kept.withColumn("_n", F.row_number().over(Window.partitionBy(query).orderBy("pos"))).where(F.col("_n") <= count).drop("_n")
    parts = [F.concat(F.lit(f"{name}: "), value) for name, value in (("Title", F.col("title")), ("Authors", F.array_join("authors", ", ")), ("Published", F.to_date("published").cast("string")), ("Summary", F.col("summary")))]
    return first.withColumn("arxiv_id", arxiv_id(F.col("id"))).withColumn("text", F.concat_ws("\n", *parts))
