import random

from pyspark.sql import functions as F

from sieveline.llm import urlfilter as U


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    n = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    m = min([rest.find(c) for c in "?#" if c in rest], default=len(rest))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:n]), rest[n:m] if m > n else ""


def rule(host, path):
    fit = [(len(h + p), h + p, v) for v, h, p in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[1:] if fit else (None, None)


def brute(pages):
    cut = [(i, *parts(u)) for i, u in pages]
    blocked = {h for _, h, p in cut if rule(h, p)[1] == "block"}
    return sorted(((str(i), h, p, rule(h, p)[0], rule(h, p)[1] or ("block" if h in blocked else "allow")) for i, h, p in cut), key=str)


def sample():
    rng = random.Random(12)
    hosts = ["example.com", "WWW.Example.com", "a.www.example.com", "notexample.com", "x.net", "y.net", "net", "É.org", "h.org:80", "com", ""] + [f"h{i}.{t}" for i in range(60) for t in ("net", "org")]
    paths = ["", "/", "/en/", "/en", "/es/1", "/fr/2", "/EN/", "/de/?a=/es/", "?x=://net/es/", "#/fr/", "/es/#"]
    pages = [(i, f"{rng.choice(['http', 'https', ''])}://{rng.choice(hosts)}{rng.choice(paths)}") for i in range(900)]
    return pages + [(1, None), (1, ""), (2, "no scheme/es/"), (None, "http://x.net/es/"), (5, "a\n://x.net\n/es/"), (6, "http://" + "l" * 100_000 + ".net/")]


def rows(df):
    return sorted(((str(r.page_id), r.host, r.path, r.rule, r.verdict) for r in df.collect()), key=str)


def test_matches_brute_force_in_one_and_more_blocks(spark):
    pages = sample()
    df = spark.createDataFrame(pages, "page_id long, url string").repartition(3).select("*", F.lit(1).alias("host"), F.lit("x").alias("fit"))
    assert rows(U.judge(df)) == brute(pages)
    assert rows(U.judge(df, bits_per_key=3)) == brute(pages)  # more levels
    assert rows(U.judge(df, max_bits=640)) == brute(pages)  # three blocks


def test_cascade_is_exact_over_its_universe(spark):
    keys = [f"k{i}" for i in range(3000)]
    universe = spark.createDataFrame([(k,) for k in keys] + [(None,)], "key string")
    listed = spark.createDataFrame([(k,) for k in keys[::7]] + [("outside",), (None,)], "key string")
    cascade = U.build(universe.distinct(), listed, bits_per_key=2)
    assert len(cascade.levels) > 2
    got = {r.key for r in universe.where("key is not null").where(cascade.listed(F.col("key"))).collect()}
    assert got == set(keys[::7])


def test_empty_tables(spark):
    assert U.judge(spark.createDataFrame([], "page_id long, url string")).collect() == []
    none = spark.createDataFrame([], "key string")
    one = spark.createDataFrame([(1, "http://q.org/a")], "page_id long, url string")
    assert rows(U.judge(one, none)) == [("1", "q.org", "/a", None, "allow")]
