import pytest
from pyspark.sql import functions as F

from sieveline.functions import records as R
from sieveline.functions import text as X
from sieveline.functions import urls as U


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_refine_strips_and_collapses(spark):
    assert one(spark, X.refine(F.lit(" \t\na\n\n\nb\n "))) == "a\nb"
    assert one(spark, X.refine(F.lit("\n \n"))) == ""


def test_split_summary(spark):
    split = lambda t: tuple(one(spark, X.split_summary(F.lit(t).cast("string"))))
    assert split("short\n===\nother") == ("short", "other\n")
    assert split("A\n\nB\n\nC") == ("A", "B\nC\n")
    assert split("A\n\nB===C") == ("A", "B\n")
    assert split("A===B === C") == ("A", "B\nC\n")
    assert split("only") == ("only", "") and split("") == ("", "") and split(None) == (None, "")


@pytest.mark.parametrize("limit", [5, 12, 100])
def test_packing_keeps_everything_within_the_limit(spark, limit):
    text = "One. Two two. Three three three. Four."
    got = one(spark, X.pack_sentences(F.lit(text), limit))
    assert " ".join(got) == text
    assert all(len(b) <= limit or " " not in b.replace(". ", "") or b.count(".") == 1 for b in got)
    lines = one(spark, X.pack_lines(F.lit("a\n\nbb\nccc"), limit))
    assert "\n".join(lines) == "a\n\nbb\nccc"


def test_todo_items(spark):
    assert one(spark, X.todo_items(F.lit("1. first\n\n 12.second\nplain"))) == ["first", "second", "plain"]


def test_html(spark):
    html = "<html><script>var x='</p>';</script><style>p{}</style><!-- no --><p>A &lt;b&gt; &amp;amp;</p>\n<p>c</p></html>"
    assert one(spark, X.html_to_text(F.lit(html))) == "A <b> &amp; c"


def test_html_references_without_a_semicolon_stay(spark):
    html = "<title>and&amp</title><p>a&ampx; &copy2 &amp;copy; &copy; &#65; &#65 &nope; &lt;&am"
    assert one(spark, X.html_to_text(F.lit(html))) == "and&amp a&ampx; &copy2 &copy; \u00a9 A &#65 &nope; <&am"


def test_html_scripts_go_before_styles(spark):
    html = "a<style>p{} <script>x</style>y</script> b</style>c"
    assert one(spark, X.html_to_text(F.lit(html))) == "a c"


def test_tokens_and_containment(spark):
    a, b = (X.tokens(F.lit(t)) for t in ("The cat  the", "THE dog\nsat"))
    assert one(spark, X.containment(a, b)) == 0.5
    assert one(spark, X.containment(a, X.tokens(F.lit(" ")))) == 0.0


def test_names_and_ids(spark):
    assert one(spark, X.collection_name(F.lit("text-emb.3"), F.lit("2024-01-02"))) == "news_text_emb_3__2024_01_02"
    assert str(one(spark, R.suffix_date(F.lit("news_x__2024_01_02")))) == "2024-01-02"
    assert one(spark, X.arxiv_id(F.lit("https://arxiv.org/pdf/2301.00001v2.pdf"))) == "2301.00001"
    assert [one(spark, X.block_text(F.lit(k), F.lit("x"))) for k in ("quote", "toggle", "code", "image")] == ["x", "x\n", "```x```", ""]
    assert one(spark, X.unescape(F.lit("caf&eacute; &#8217;&#x41; &amp;lt; & &nope;"))) == "café ’A &lt; & &nope;"


def test_urls(spark):
    assert one(spark, U.normalize(F.lit("HTTP://A.B/c/?utm_source=x&q=1&ref=y#z"))) == "http://a.b/c/?q=1"
    assert one(spark, U.normalize(F.lit("https://a.b/c/?ref=y"))) == "https://a.b/c"
    assert one(spark, U.host(F.lit("https://A.b:1/c"))) == "a.b:1"
    assert one(spark, U.absolute(F.lit("/r/x"), "https://s")) == "https://s/r/x"
    flags = {k: one(spark, v) for k, v in U.flags(F.lit("https://youtu.be/a.PNG?ref=1")).items()}
    assert flags == {"is_image": True, "is_gallery": False, "is_video": True, "is_arxiv": False, "has_tracking": True}


def test_rankings(spark):
    good = '{"feedback":"ok",\t"topics":[{"topic":"a, b","category":"c","score":0},{"topic":"d","category":"e","score":0.5}],"overall_score":0.7}'
    got = one(spark, R.ranking(F.lit(good)))
    assert [tuple(t) for t in got.topics] == [("a, b", 1.0), ("d", 0.5)] and got.overall_score == 0.7
    bad = one(spark, R.ranking(F.lit("{")))
    assert (bad.topics, bad.overall_score, bad.feedback) == ([], R.UNREADABLE, "")
    pairs = F.expr("array(named_struct('name', 'x,y', 'score', 1d), named_struct('name', 'b', 'score', 2d), named_struct('name', 'c', 'score', 1d))")
    assert one(spark, R.labels(R.top_pairs(pairs, 2))) == ["b", "x y"]
    assert one(spark, R.top_pairs(F.lit(None).cast("array<struct<name:string,score:double>>"))) == []


def test_configuration(spark):
    assert one(spark, R.thresholds(F.lit("a:1, b:2.5,bad,c:x,a:3"))) == {"b": 2.5, "a": 3.0}
    assert [one(spark, R.to_bool(F.lit(w))) for w in ("Yes", "0")] == [True, False]
    with pytest.raises(Exception, match="not a truth value"):
        one(spark, R.to_bool(F.lit("maybe")))


def test_dates_and_numbers(spark):
    assert str(one(spark, R.parse_iso(F.lit("2024-07-01T12:00:00Z")))) == "2024-07-01 12:00:00"
    assert str(one(spark, R.pacific(F.lit("2024-07-01 12:00:00").cast("timestamp_ntz")))) == "2024-07-01 05:00:00"
    assert one(spark, R.date_key(F.lit(None).cast("timestamp"), "2024-01-01")) == "2024-01-01"
    assert one(spark, R.falsy(F.lit(0.0), -1.0)) == -1.0 and one(spark, R.minutes(F.lit(90))) == "1.50"
    assert one(spark, R.surrogate_key(F.lit("s"), F.lit(1699.0))) == "9aab98efe9e4ba6a2d5e1bdd0ab0ac75" or len(one(spark, R.surrogate_key(F.lit("s")))) == 32
