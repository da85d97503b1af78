"""Spelling variants by anagram hashing.

A word's key is the sum of a power of each of its letters, so anagrams share it, and one edit moves it by a letter's value
(addition, removal) or by the difference of two (exchange). Every word gives its key and its key less the value of each of
its different letters; words meet where these are equal:

* the key of one and the reduced key of another: one letter was added or removed,
* the reduced keys of both: one letter was exchanged.

That is a join on all of the differing values with a row for each different letter instead of one for each exchange. Words
that meet are verified by the order of their letters (one edit apart, no more and no less).

A key that more than ``BUCKET`` words share (anagrams of one another but for a letter) is dealt further by the order of the
letters that are left: of such words only those that agree without one letter meet. So no group is compared as a whole, and
none is capped. Words are counted with map-side combine, so a word that fills a third of the corpus is a row a task.

A word's form is its near word of largest count, if that is ``ratio`` times its own or more; counts rise along forms, so
they lead to a root in at most log_ratio(largest count) steps, and roots are found by doubling in the logarithm of that.

Defined results: a null text has no words, repeated rows count again, a null id reads as an empty one. Ties of counts go to
the word that is smaller in code-point order. An empty table gives no rows. A text's runs are held at once in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.session import materialize

RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_CHARS = 6
LEAST_COUNT = 5
RATIO = 5
#: Words that share a key up to which all of them are compared.
BUCKET = 64
#: The power of a letter's code point that stands for it; sums wrap at MODULUS.
POWER = 5
MODULUS = (1 << 61) - 1


def spoiled(doc: Column, run: Column, every: int) -> Column:
    """The run, or, if ``every`` divides the CRC-32 of ``<doc>:<run>``, the run without the letter that it points to."""
    h = F.crc32(F.concat(F.coalesce(doc.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = F.pmod(h, F.length(run)).cast("int")
    return F.when(F.pmod(h, F.lit(every)) == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT, spoil_every: int = 0) -> DataFrame:
    """Rows (word, n): the runs of letters of all texts, A-Z lower-cased, that are long and frequent enough.

    With ``spoil_every`` a share of the runs loses a letter first: misspellings that are known, to measure by.
    """
    run = F.translate(F.col("run"), UPPER, LOWER)
    each = docs.select(F.col(f"`{doc_id}`").alias("doc"), F.explode(F.regexp_extract_all(F.col(f"`{text}`").cast("string"), F.lit(RUN), F.lit(0))).alias("run"))
    each = each.where(F.length("run") >= least_chars).select("doc", run.alias("run"))  # spoiling only shortens
    word = spoiled(F.col("doc"), F.col("run"), spoil_every) if spoil_every else F.col("run")
    return each.select(word.alias("word")).groupBy("word").agg(F.count("*").alias("n")).where((F.length("word") >= least_chars) & (F.col("n") >= least_count))


def _value(code: Column) -> Column:
    out = code.cast("long")
    for _ in range(POWER - 1):
        out = out * code
    return F.pmod(out, F.lit(MODULUS))


def anagram_keys(words: DataFrame) -> DataFrame:
    """Rows (word, n, full, key, letter): the word's own key (letter null), and that without each of its letters."""
    codes = F.transform(F.filter(F.split("word", ""), lambda c: c != ""), lambda c: F.ascii(c))
    coded = words.select("word", "n", codes.alias("codes"))
    full = F.aggregate("codes", F.lit(0).cast("long"), lambda s, c: F.pmod(s + _value(c), F.lit(MODULUS)))
    coded = coded.select("word", "n", full.alias("full"), F.array_append(F.array_distinct("codes"), F.lit(None).cast("int")).alias("letters"))
    each = coded.select("word", "n", "full", F.explode("letters").alias("letter"))
    return each.select("word", "n", "full", F.pmod(F.col("full") - F.coalesce(_value(F.col("letter")), F.lit(0)), F.lit(MODULUS)).alias("key"), "letter")


def _dealt(keyed: DataFrame, bucket: int) -> DataFrame:
    """With ``part``: 0, or in buckets of more than ``bucket`` words a hash of the letters left in order, once for each place of the letter."""
    large = keyed.groupBy("key").agg(F.count("*").alias("size")).where(F.col("size") > bucket).select(F.col("key").alias("large"))
    places = F.filter(F.sequence(F.lit(1), F.length("word")), lambda p: F.ascii(F.substring(F.col("word"), p, F.lit(1))) == F.col("letter"))
    rest = F.transform(places, lambda p: F.xxhash64(F.concat(F.substring(F.col("word"), F.lit(1), p - 1), F.substring(F.col("word"), p + 1, F.length("word")))))
    parts = F.when(F.col("large").isNull(), F.array(F.lit(0).cast("long"))).when(F.col("letter").isNull(), F.array(F.xxhash64("word"))).otherwise(F.array_distinct(rest))
    joined = keyed.join(large, F.col("key") == F.col("large"), "left")
    return joined.select("word", "n", "full", "key", F.col("letter").isNotNull().alias("reduced"), F.explode(parts).alias("part"))


def near_words(words: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Rows (word, n, other, other_n): each ordered pair of words that are one added, removed or exchanged letter apart."""
    rows = materialize(_dealt(anagram_keys(words), bucket), "anagram-rows", compact=True)
    a = rows.select(*(F.col(c).alias(f"a_{c}") for c in rows.columns))
    b = rows.select(*(F.col(c).alias(f"b_{c}") for c in rows.columns))
    met = (F.col("a_key") == F.col("b_key")) & (F.col("a_part") == F.col("b_part")) & (F.col("a_reduced") | F.col("b_reduced")) & (F.col("a_full") != F.col("b_full"))
    near = a.join(b, met & (F.levenshtein("a_word", "b_word", 1) == 1))
    return near.select(F.col("a_word").alias("word"), F.col("a_n").alias("n"), F.col("b_word").alias("other"), F.col("b_n").alias("other_n")).distinct()


def variants(words: DataFrame, ratio: int = RATIO, bucket: int = BUCKET) -> DataFrame:
    """Rows (word, n, n_near, form, form_n, root) for rows (word, n) of distinct words."""
    own = materialize(words, "spelling-words", compact=True)
    near = near_words(own, bucket)
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("m"), F.col("other").alias("w"))).alias("best"))
    best = best.select(F.col("word").alias("_word"), "n_near", F.col("best.w").alias("w"), (-F.col("best.m")).alias("m"))
    formed = F.col("m") >= ratio * F.col("n")
    out = own.join(best, F.col("word") == F.col("_word"), "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(formed, F.col("w")).alias("form"), F.when(formed, F.col("m")).alias("form_n")
    )
    out = materialize(out, "spelling-forms", compact=True)
    return out.join(_roots(out).withColumnRenamed("word", "_word"), F.col("word") == F.col("_word"), "left").select(*out.columns, F.coalesce("root", "word").alias("root"))


def _roots(forms: DataFrame) -> DataFrame:
    """Rows (word, root) of the words with a form: where forms lead to, twice as far in each round."""
    now = forms.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        on = now.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        step = materialize(now.join(on, F.col("root") == F.col("_at"), "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), "spelling-roots", compact=True)
        now = step.select("word", "root")
        if not step.where("moved").limit(1).count():
            return now
