import datetime as dt

from pyspark.sql import functions as F

from sieveline.operators import containment, dedup, evaluate, health, scoring, state


def test_seen_sets(spark):
    items = spark.createDataFrame([("a", "l", 1), ("b", "l", 2), (None, "l", 3)], "id string, list string, v int")
    seen = spark.createDataFrame([("a", "l", 1)], "id string, list string, v int")
    assert {r.id for r in dedup.unseen(items, seen, ["id", "list"]).collect()} == {"b", None}
    assert {r.id for r in dedup.unseen_versions(items, seen.withColumn("v", F.lit(9)), "id", "v").collect()} == {"a", "b", None}
    assert dedup.mark_seen(seen, items, ["id"]).count() == 3


def test_changes(spark):
    now = spark.createDataFrame([(1, 5), (2, 4), (3, None), (4, 1)], "id int, rating int")
    before = spark.createDataFrame([(2, 4), (3, 2), (4, None)], "id int, rating int")
    assert {(r.id, r.change_type) for r in dedup.split_changes(now, before, "id", "rating").collect()} == {(1, "new"), (3, "updated"), (4, "updated")}


def test_latest_and_last(spark):
    rows = [(1, 10, 0, "x"), (1, 10, 1, "y"), (1, 9, 2, "z"), (2, 1, 3, "w")]
    df = spark.createDataFrame(rows, "id int, edited int, ord int, v string")
    assert {(r.id, r.v) for r in dedup.latest(df, "id", "edited", "ord").collect()} == {(1, "x"), (2, "w")}
    assert {(r.id, r.v) for r in dedup.last_loaded(df, "id", "ord").collect()} == {(1, "z"), (2, "w")}
    assert dedup.latest(df, "id", "edited", "ord").columns == df.columns


def test_copies(spark):
    d = spark.createDataFrame([(3, "t", "s2"), (1, "t", "s1"), (2, "u", "s1"), (4, "t", "s1")], "id int, text string, src string")
    assert {r.id for r in dedup.first_rows(d, F.col("text"), "id").collect()} == {1, 2}
    got = dedup.cluster_sources(d, dedup.star_links(d, F.col("text"), "id"), "id", "src")
    assert {(r.cluster_id, r.size, tuple(r.sources)) for r in got.collect()} == {(1, 3, ("s1", "s2")), (2, 1, ("s1",))}


def test_watermarks(spark):
    marks = spark.createDataFrame([("a", 5)], "k string, watermark int")
    items = spark.createDataFrame([("a", 5), ("a", 6), ("a", 1), ("b", 0)], "k string, ts int")
    assert state.since(items, marks, "k", "ts").count() == 3
    assert state.since(items, marks, "k", "ts", strict=True).count() == 2
    assert {tuple(r) for r in state.advance(marks, items.where("ts < 3"), "k", "ts").collect()} == {("a", 5), ("b", 0)}


def test_state_with_expiry(spark):
    schema = "key string, value string, expires_at timestamp_ntz"
    old = spark.createDataFrame([("live", "0", None), ("gone", "0", dt.datetime(2024, 1, 1))], schema)
    writes = spark.createDataFrame([("live", "1", 0, 1), ("gone", "1", 0, 1), ("gone", "2", 0, 2), ("live2", "a", 60, 1), ("live2", "b", 60, 2), ("live2", "c", 0, 3)], "key string, value string, ttl_seconds int, ord long")
    got = {r.key: (r.value, r.expires_at) for r in state.put(old, writes, "2024-01-02").collect()}
    assert got == {"live": ("0", None), "gone": ("1", None), "live2": ("b", dt.datetime(2024, 1, 2, 0, 1))}
    over = {r.key: r.value for r in state.put(old, writes, "2024-01-02", overwrite=True).collect()}
    assert over == {"live": "1", "gone": "2", "live2": "c"}
    assert {r.key for r in state.get(old, "2024-01-01").collect()} == {"live"}


def test_cache_and_patches(spark):
    items = spark.createDataFrame([(1, "x"), (2, "y")], "id int, t string")
    cache = spark.createDataFrame([(1, None)], "id int, value string")
    assert {tuple(r) for r in state.cache_aside(items, cache, "id", F.upper("t")).select("id", "value", "cached").collect()} == {(1, None, True), (2, "Y", False)}
    p = spark.createDataFrame([(2,), (1,), (3,)], "order_id int")
    assert [r.order_id for r in state.pending_patches(p, p.where("order_id = 2")).collect()] == [1, 3]


def test_filters(spark):
    s = spark.createDataFrame([(0, 5.0, "a"), (1, -1.0, "a"), (2, 3.0, "b"), (3, 5.0, "b"), (4, 0.0, "c")], "ord int, s double, l string")
    assert [r.ord for r in scoring.filter_top(s, "s", "ord", 3, 4.0).collect()] == [0, 3, 1]
    limits = spark.createDataFrame([("b", 2.0), ("c", 0.0)], "list_name string, min_score double")
    assert {r.ord for r in scoring.filter_by_list(s, limits, "l", "s", 3.5).collect()} == {0, 1, 2, 3}
    w = s.withColumn("u", F.lit(5.0))
    assert [r.ord for r in scoring.weekly_filter(w, "u", "s", "ord", 2, 4.5).collect()] == [0, 3]
    skip = [r[0] for r in s.orderBy("ord").select(scoring.rank_skip(F.col("s"), F.lit("t"), True, 4.0)).collect()]
    assert skip == [False, False, True, False, False]  # 0 and unknown are not low
    assert {tuple(r) for r in scoring.histogram(s, "l", F.col("s") / 5).collect()} == {("a", "<=0.5", 1), ("a", "<=1.0", 1), ("b", "<=0.6", 1), ("b", "<=1.0", 1), ("c", "<=0.5", 1)}


def test_counts_and_rates(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",)], "src string")
    got = {tuple(r) for r in scoring.stage_counts({"all": a, "some": a.where("src = 'x'")}, "src").collect()}
    assert got == {("x", 2, 2), ("y", 1, 0)}
    rows = spark.createDataFrame([(True, True), (True, False), (False, True), (False, False), (True, True)], "p boolean, t boolean")
    r = scoring.confusion(rows, F.col("p"), F.col("t")).first()
    assert (r.tp, r.fp, r.fn, r.tn) == (2, 1, 1, 1) and round(r.f1, 4) == 0.6667 and r.accuracy == 0.6
    none = scoring.confusion(rows.limit(0), F.col("p"), F.col("t")).first()
    assert (none.precision, none.recall, none.f1, none.accuracy) == (0, 0, 0, 0)


def test_containment_in_blocks(spark):
    d = spark.createDataFrame([(1, "a b c d"), (2, "A"), (3, None), (4, "q r")], "doc_id long, text string")
    t = spark.createDataFrame([(10, "a b"), (11, "c d e f g"), (12, "")], "item_id long, text string")
    want = {(1, 10, 1.0), (2, 10, 1.0), (3, 10, 0.0), (4, 10, 0.0)}
    for size in (1, 200, 1 << 20):
        assert {tuple(r) for r in containment.best_containment(d, t, "doc_id", "item_id", block_bytes=size).collect()} == want
    assert containment.best_containment(d, t.limit(0), "doc_id", "item_id").where("overlap = 0").count() == 4


def test_sweep_and_macro(spark):
    rows = spark.createDataFrame([(0.9, True), (0.5, False), (0.2, True)], "s double, t boolean")
    got = {r.threshold: (r.tp, r.fp, r.fn) for r in evaluate.sweep(rows, "s", "t", [0.1, 0.6]).collect()}
    assert got == {0.1: (2, 1, 0), 0.6: (1, 0, 1)}
    assert evaluate.macro(evaluate.sweep(rows, "s", "t", [0.1, 0.6])).first().recall == 0.75


def test_health(spark):
    rows = [("a", i, i, f) for i, f in enumerate([True, True, False, True, True, True])] + [("b", 0, 0, False), ("c", 0, 0, True)]
    df = spark.createDataFrame(rows, "s string, ts int, o int, f boolean")
    got = {r.s: (r.pulls, r.last_success, r.failing) for r in health.source_health(df, "s", "ts", "o", F.col("f")).collect()}
    assert got == {"a": (6, 2, True), "b": (1, 0, False), "c": (1, None, False)}
    e = spark.createDataFrame([(1, "2024-01-01", "s"), (1, "2024-01-04", "d"), (2, "2024-01-01", "s"), (3, "2024-01-09", "d")], "i int, ts string, k string")
    got = health.review_velocity(e, "i", "ts", F.col("k") == "s", F.col("k") == "d", "2024-01-31")
    assert {tuple(r) for r in got.collect()} == {(1, 3, False), (2, 30, True)}


def test_numbering_across_tasks(spark):
    from sieveline.operators.numbering import numbered

    rows = [("hot", i) for i in range(500)] + [("b", i) for i in range(7)] + [(None, i) for i in range(5)]
    df = spark.createDataFrame(rows, "g string, o int").repartition(6)
    got = {(r.g, r.o): r.place for r in numbered(df, "g", "o").collect()}
    assert got == {(g, o): o for g, o in rows}
    assert numbered(df.limit(0), "g", "o").collect() == []


def test_search(spark):
    from sieveline.operators.search import context, search

    d = spark.createDataFrame([(1, "red fox runs"), (2, "Red sea"), (3, "fox"), (4, None), (None, "red fox")], "doc_id long, text string").repartition(3)
    q = spark.createDataFrame([(7, "red fox"), (8, "nothing here"), (9, "")], "item_id long, text string")
    for cells in (1, 1000):
        hits = search(q, d, 2, cells=cells)
        assert {tuple(r) for r in hits.collect()} == {(7, 1, 1.0, 1), (7, 2, 0.5, 2)}
    assert context(hits, d).first().context == "red fox runs\n\nRed sea"
    assert search(q.limit(0), d).collect() == [] and search(q, d.limit(0)).collect() == []


def test_block_trees(spark):
    from sieveline.operators.blocks import page_text

    rows = [("p", "a", None, 0, "toggle", "A", None), ("p", "b", None, 1, "paragraph", "B", None), ("p", "c", "a", 0, "bulleted_list_item", "C", None), ("p", "t", "a", 1, "table", None, None),
            ("p", "r", "t", 0, "table_row", None, ["x", None, "z"]), ("p", "d", "c", 0, "quote", "under a bullet", None), ("p", "e", "zz", 0, "quote", "lost", None), ("q", "a", None, 0, "code", "x", None), ("q", "b", None, 1, "image", "y", None)]
    deep = [("z", f"n{k}", f"n{k - 1}" if k else None, 0, "toggle", str(k), None) for k in range(9)]
    df = spark.createDataFrame(rows + deep, "page_id string, block_id string, parent_id string, pos int, type string, text string, cells array<string>")
    got = {r.page_id: (r.text, r.n) for r in page_text(df, "|").collect()}
    assert got == {"p": ("A\n- C\nx,,z,\n|B|", 5), "q": ("```x```||", 2), "z": ("".join(f"{k}\n" for k in range(9)) + "|", 9)}
