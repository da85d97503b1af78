"""Rendering of items to content blocks and to text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.functions.records import falsy
from sieveline.functions.text import block_text, pack_sentences, split_summary, unescape

BLOCK = "struct<type:string,text:string,url:string>"


def block(kind: str, text: Column, url: Column | None = None) -> Column:
    return F.struct(F.lit(kind).alias("type"), text.cast("string").alias("text"), (url if url is not None else F.lit(None)).cast("string").alias("url")).cast(BLOCK)


def blocks(*parts: Column) -> Column:
    """Blocks in order; null ones are left out."""
    return F.array_compact(F.array(*parts))


def tweet_blocks(t: DataFrame) -> DataFrame:
    """Tweets with ``blocks``: the quoted reply (or a notice that it is gone), the body, the embed and the link."""
    reply = (
        F.when(F.col("reply_deleted"), block("quote", F.lit("The tweet that this answers was deleted.")))
        .when(F.col("reply_text").isNotNull(), block("quote", F.concat_ws(": ", "reply_to_name", "reply_text"), F.col("reply_url")))
    )
    body = block("paragraph", F.concat(F.col("name"), F.when(F.col("retweeted"), F.lit(" (Retweeted)")).otherwise(F.lit("")), F.lit(": "), F.col("text")))
    embed = lambda c: F.when(F.coalesce(F.col(c), F.lit("")) != "", block("embed", F.lit(""), F.col(c)))
    return t.withColumn("blocks", blocks(reply, embed("reply_embed"), body, embed("embed"), block("link", F.col("url"), F.col("url"))))


def article_blocks(a: DataFrame) -> DataFrame:
    """Articles with ``blocks``: summary paragraphs and, if there is one, a toggle with the translation."""
    parts = split_summary(F.col("summary"))
    paragraphs = F.transform(pack_sentences(F.coalesce(parts["summary"], F.lit(""))), lambda p: block("paragraph", p))
    toggle = F.when(parts["translation"] != "", block("toggle", parts["translation"]))
    return a.withColumn("blocks", F.concat(paragraphs, blocks(toggle, block("link", F.col("title"), F.col("url")))))


def video_blocks(v: DataFrame) -> DataFrame:
    """Videos with ``blocks``: the video, a line about it and its summary."""
    title = F.coalesce(F.nullif(F.col("alt_title"), F.lit("")), F.col("title"))
    facts = F.format_string("%s, %s minutes, %s views", F.coalesce("author", F.lit("")), F.format_number(F.col("seconds") / 60, 2), F.coalesce(F.col("views").cast("string"), F.lit("?")))
    return v.withColumn("blocks", blocks(block("heading", unescape(title)), block("video", F.lit(""), F.col("url")), block("comment", facts), block("paragraph", F.col("summary"))))


#: Hosts whose videos play in a page (fixed values); others are embedded.
PLAYERS = ("youtube.com", "youtu.be", "v.redd.it")


def post_blocks(p: DataFrame) -> DataFrame:
    """Posts of a listing with ``blocks``: what they show, their text as a quote, the summary, the link and their numbers.

    A video plays if its host is known, pictures of a gallery come one by one, and anything outside is embedded.
    """
    own = F.col("video")["video_url"]
    plays = F.lit(False)
    for host in PLAYERS:
        plays = plays | F.coalesce(own.contains(host), F.lit(False))
    one = lambda b: F.array(b)
    none = F.array().cast(f"array<{BLOCK}>")
    pictures = F.transform("gallery_medias", lambda m: block("image", F.lit(""), F.replace(m.url, F.lit("&amp;"), F.lit("&"))))
    shown = (
        F.when(F.col("is_video"), F.when(plays, one(block("video", F.lit(""), own))).otherwise(one(block("embed", F.lit(""), own))))
        .when(F.col("is_image"), one(block("image", F.lit(""), F.col("url")))).when(F.col("is_gallery"), pictures)
        .when(F.col("is_external_link"), one(block("embed", F.lit(""), F.col("url")))).otherwise(none)
    )
    quote = F.when(F.coalesce(F.col("text"), F.lit("")) != "", block("quote", F.element_at(pack_sentences(F.col("text")), 1)))
    facts = F.format_string("Subreddit: %s\nAuthor: %s\nUps: %s\nDowns: %s\nNumOfComments: %s", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("subreddit", "author", "ups", "downs", "num_comments")))
    parts = split_summary(F.coalesce(F.col("summary"), F.lit("")))
    paragraphs = F.filter(F.transform(pack_sentences(parts["summary"]), lambda x: block("paragraph", x)), lambda b: b.text != "")
    toggle = F.when(parts["translation"] != "", block("toggle", parts["translation"]))
    return p.withColumn("blocks", F.concat(F.coalesce(shown, none), blocks(quote), F.coalesce(paragraphs, none), blocks(toggle, block("link", F.lit("Link"), F.col("permalink")), block("comment", facts))))


def feed_blocks(a: DataFrame) -> DataFrame:
    """Feed items with ``blocks``: the summary (or what the feed says, without one) and the link; a topic line if there are topics."""
    text = F.coalesce(F.nullif(F.col("summary"), F.lit("")), F.col("content"), F.lit(""))
    topics = F.when(F.size("topics") > 0, block("comment", F.concat(F.lit("Topics: "), F.array_join("topics", ", "))))
    rows = article_blocks(a.withColumn("summary", text))
    return rows.withColumn("blocks", F.concat(F.filter("blocks", lambda b: (b.type != "paragraph") | (b.text != "")), blocks(topics)))


def to_text(blocks_: Column, separator: str = "\n") -> Column:
    """Blocks as plain text, the separator after each."""
    own = lambda b: F.coalesce(F.nullif(block_text(b.type, b.text), F.lit("")), b.text, F.lit(""))
    return F.array_join(F.transform(blocks_, lambda b: F.concat(own(b), F.lit(separator))), "")


def page_properties(items: DataFrame) -> DataFrame:
    """The properties that every published page has; a relevance of 0 is none."""
    return items.withColumn(
        "properties",
        F.struct(
            "source", F.array_distinct("list_names").alias("list_names"), F.array_sort(F.array_distinct("topics")).alias("topics"),
            F.array_sort(F.array_distinct("categories")).alias("categories"), falsy(F.col("rating"), -1.0).alias("rating"),
            F.nullif(F.col("relevance"), F.lit(0.0)).alias("relevance"),
        ),
    )


def collection(items: DataFrame, source: str, order: str, title: str, topics: str) -> DataFrame:
    """Rows (source, titles, topics, n): items of each source in order, with all their topics.

    A published page holds all of a source's items, so callers bound them with a top-k first.
    """
    each = items.groupBy(source).agg(
        F.transform(F.array_sort(F.collect_list(F.struct(order, title))), lambda x: x[title]).alias("titles"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(topics)))).alias("topics"), F.count("*").alias("n"),
    )
    return each


def journal(notes: DataFrame, day: str, order: str, title: str, text: str, created: str | None = None) -> DataFrame:
    """Rows (day, entry, n): a day's notes as ``title text`` lines in order, each with a line break after it.

    With ``created``, a column last_created_time: that of the last note.
    """
    line = F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(text, F.lit("")), F.lit("\n"))
    lines = F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), line.alias("l")))), lambda x: x.l)
    last = [F.max_by(created, order).alias("last_created_time")] if created else []
    return notes.groupBy(day).agg(F.array_join(lines, "").alias("entry"), F.count("*").alias("n"), *last)
