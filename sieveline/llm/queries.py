"""The twelve operators as queries over whole tables, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.llm import chat, decontam, licenses, linededup, lm, packing, quality, secrets, simhash, spelling, urlfilter, warc
from sieveline.session import table

TOKENIZER = "word_bpe_49k.json"


def op1_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = chat.swapped_answer_pairs(chat.gather(table(spark, sf_dir, "conversations")), F.col("conv_id"))
    out = chat.format_preferences(pairs)
    return out.withColumn("chosen_mask", chat.mask_text(F.col("chosen_mask"))).withColumn("rejected_mask", chat.mask_text(F.col("rejected_mask")))


def op2_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), items="digest")
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op4_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, back = warc.archive(table(spark, sf_dir, "pages"), payloads=False)
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linededup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"), F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))


def op6_simhash_ball(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_secret_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    names = F.array(*map(F.lit, secrets.KINDS))
    base = F.filter("spans", lambda s: s.kind < 3)
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s.kind + 1), s.start, s.end)), ",")
    kinds = F.transform("spans", lambda s: s.kind)
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{secrets.KINDS[k]}") for k in range(3)]
    return found.select("doc_id", *counts, F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))


def op8_stupid_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lm.score(table(spark, sf_dir, "documents"))
    return out.withColumn("log_score", F.round("log_score", 4)).withColumn("mean_log_score", F.round("mean_log_score", 6))


def op9_power_of_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket")


def op10_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.word_counts(table(spark, sf_dir, "documents"), spoil_every=199)
    return spelling.variants(words)


def op12_license_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.summary(licenses.scan(table(spark, sf_dir, "documents")), ["doc_id"])


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    ops = (op1_preference_pairs, op2_quality_trees, op3_decontaminate, op4_warc_bundles, op5_line_dedup, op6_simhash_ball, op7_secret_owners, op8_stupid_backoff, op9_power_of_two, op10_url_cascade, op11_spelling_variants, op12_license_notices)
    return {f.__name__: f for f in (*ops, pipeline)}


_OP1 = """
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS rn,
         coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
a AS (SELECT conv_id, rn, text, row_number() OVER p - 1 AS k, count(*) OVER (PARTITION BY conv_id) AS n FROM t WHERE role = 'assistant' WINDOW p AS (PARTITION BY conv_id ORDER BY rn)),
c AS (SELECT x.conv_id, x.rn AS place, CASE WHEN x.n > 1 THEN y.text ELSE '' END AS stale, x.text AS own FROM a x JOIN a y ON x.conv_id = y.conv_id AND y.k = (x.k + 1) % x.n WHERE x.k = x.conv_id % x.n),
d AS (
  SELECT t.conv_id, rn, role, replace(role, '<|im_', '<| im_') AS r, replace(text, '<|im_', '<| im_') AS good,
         replace(CASE WHEN rn = place THEN stale ELSE text END, '<|im_', '<| im_') AS bad, CASE WHEN own <> stale THEN place END AS place
  FROM t LEFT JOIN c USING (conv_id)),
e AS (SELECT *, '<|im_start|>' || r || chr(10) || good || '<|im_end|>' || chr(10) AS g, '<|im_start|>' || r || chr(10) || bad || '<|im_end|>' || chr(10) AS b, coalesce(rn >= place, false) AS tail FROM d),
f AS (SELECT *, sum(CASE WHEN tail THEN length(g) ELSE 0 END) OVER w AS ge, sum(CASE WHEN tail THEN length(b) ELSE 0 END) OVER w AS be FROM e WINDOW w AS (PARTITION BY conv_id ORDER BY rn))
SELECT conv_id, CAST(count(*) FILTER (NOT tail) AS BIGINT) AS n_prompt_turns,
       coalesce(string_agg(g, '' ORDER BY rn) FILTER (NOT tail), '') AS prompt,
       coalesce(string_agg(g, '' ORDER BY rn) FILTER (tail), '') AS chosen,
       coalesce(string_agg((ge - length(g) + 13 + length(r)) || ':' || (ge - 1), ',' ORDER BY rn) FILTER (tail AND role = 'assistant'), '') AS chosen_mask,
       coalesce(string_agg(b, '' ORDER BY rn) FILTER (tail), '') AS rejected,
       coalesce(string_agg((be - length(b) + 13 + length(r)) || ':' || (be - 1), ',' ORDER BY rn) FILTER (tail AND role = 'assistant'), '') AS rejected_mask
FROM f GROUP BY conv_id
"""

_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP3 = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT item_id, w, least(len(w), 13) AS n, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
m AS (SELECT dw.doc_id, dw.n, dw.i, bw.item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.g = bw.g),
h AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM m) GROUP BY doc_id),
it AS (SELECT doc_id, count(x) AS n_items, string_agg(x, ',' ORDER BY x) AS names FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN it USING (doc_id)
"""

_OP4 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
r AS (SELECT h, max(page_id) AS top FROM p WHERE n >= 1000 GROUP BY h)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(encode(p.h)) AS payload_digest,
       CASE WHEN top IS NOT NULL AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN top IS NOT NULL AND page_id <> top THEN top END AS refers_to
FROM p LEFT JOIN r ON p.h = r.h AND p.n >= 1000
"""

_OP5 = r"""
WITH l AS (
  SELECT doc_id, generate_subscripts(x, 1) AS i, unnest(x) AS line FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents)),
k AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
w AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.*, keeper IS NOT NULL AND doc_id <> keeper AS gone FROM k LEFT JOIN w USING (key))
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

_OP8 = rf"""
WITH x AS (
  SELECT doc_id, generate_subscripts(w, 1) AS i, unnest(w) AS w3
  FROM (SELECT doc_id, regexp_extract_all({_LOW}, '[^\x20\x09-\x0D]+') AS w FROM documents) WHERE len(w) > 0),
g AS (SELECT doc_id, i, w3, lag(w3) OVER p AS w2, lag(w3, 2) OVER p AS w1 FROM x WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
c1 AS (SELECT w3 AS a, count(*) AS n FROM g GROUP BY ALL),
c2 AS (SELECT w2 AS a, w3 AS b, count(*) AS n FROM g WHERE i >= 2 GROUP BY ALL),
c3 AS (SELECT w1 AS a, w2 AS b, w3 AS c, count(*) AS n FROM g WHERE i >= 3 GROUP BY ALL),
s AS (
  SELECT g.doc_id,
    CASE WHEN i >= 3 AND t.n >= 2 THEN ln(t.n) - ln(tp.n)
         WHEN i >= 2 AND u.n >= 2 THEN (CASE WHEN i >= 3 THEN ln(0.4) ELSE 0 END) + ln(u.n) - ln(up.n)
         ELSE (least(i, 3) - 1) * ln(0.4) + ln(v.n) - ln((SELECT count(*) FROM g)) END AS s,
    NOT coalesce(i >= 3 AND t.n >= 2 OR i >= 2 AND u.n >= 2, false) AS single
  FROM g LEFT JOIN c3 t ON t.a = w1 AND t.b = w2 AND t.c = w3 LEFT JOIN c2 tp ON tp.a = w1 AND tp.b = w2
    LEFT JOIN c2 u ON u.a = w2 AND u.b = w3 LEFT JOIN c1 up ON up.a = w2 LEFT JOIN c1 v ON v.a = w3),
d AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (single) AS n_backed_off, sum(s) AS log_score FROM s GROUP BY doc_id)
SELECT documents.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_backed_off, 0) AS n_backed_off, round(coalesce(log_score, 0), 4) AS log_score,
       round(log_score / n_words, 6) AS mean_log_score
FROM documents LEFT JOIN d USING (doc_id)
"""

_OP10 = r"""
WITH u AS (
  SELECT page_id, CASE WHEN contains(coalesce(url, ''), '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM u),
r(verdict, h, s) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
hp AS (SELECT DISTINCT host, path FROM p),
f AS (
  SELECT host, path, max_by(h || s, length(h || s)) AS rule, max_by(verdict, length(h || s)) AS verdict
  FROM hp JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, s) GROUP BY ALL),
b AS (SELECT DISTINCT host FROM f WHERE verdict = 'block')
SELECT page_id, p.host, p.path, f.rule, coalesce(f.verdict, CASE WHEN b.host IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN f ON p.host = f.host AND p.path = f.path LEFT JOIN b ON p.host = b.host
"""


_OP11 = rf"""
WITH RECURSIVE t AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) r(i)),
r AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
d AS (SELECT doc_id, run, count(*) AS n FROM r WHERE length(run) >= 6 GROUP BY ALL),
b AS (
  SELECT *, flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''), lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)] ELSE [192 + (unicode(x) >> 6), 128 + (unicode(x) & 63)] END)) AS bytes FROM d),
h AS (SELECT run, n, xor(list_reduce(list_prepend(4294967295, bytes::BIGINT[]), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS h FROM b, t),
s AS (SELECT n, CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM h),
w AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM s WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
x AS MATERIALIZED (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)),
p AS (
  SELECT a.word, b.word AS other, b.n AS m FROM x a JOIN x b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM x a JOIN w b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM x a JOIN w b ON a.rest = b.word),
f AS (SELECT word, count(*) AS n_near, max(m) AS m, min_by(other, (-m, other)) AS other FROM p GROUP BY word),
g AS MATERIALIZED (SELECT w.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 5 * n THEN other END AS form, CASE WHEN m >= 5 * n THEN m END AS form_n FROM w LEFT JOIN f USING (word)),
o AS (SELECT word, word AS root FROM g WHERE form IS NULL UNION ALL SELECT g.word, o.root FROM o JOIN g ON g.form = o.word)
SELECT word, n, n_near, form, form_n, root FROM g JOIN o USING (word)
"""


def oracle_sql() -> dict[str, str]:
    """SQL for the operators that SQL can express: the tree model, XXH64, the tokenizer, the secret verdicts and bounded-error matching it cannot."""
    return {
        "op1_preference_pairs": _OP1,
        "op3_decontaminate": _OP3,
        "op4_warc_bundles": _OP4,
        "op5_line_dedup": _OP5,
        "op8_stupid_backoff": _OP8,
        "op10_url_cascade": _OP10,
        "op11_spelling_variants": _OP11,
    }
