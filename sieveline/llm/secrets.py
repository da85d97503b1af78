"""Secret scans with corpus-wide ownership frequency.

Three base patterns find candidates in whole texts (leftmost, non-overlapping for each kind):

* assign: a secret-like name, ``=`` or ``:`` and a value of 8 or more characters,
* access: ``AKIA`` keys of 16 or more characters,
* hex: runs of 32 or more lower-case hex digits.

The value of each candidate is hashed (128 bits). Over the whole corpus, hashes are aggregated by
distinct repositories and distinct owners. A value that ``EXAMPLE_OWNERS`` or more owners or
``EXAMPLE_REPOSITORIES`` or more repositories hold, or that has no more than three different
characters, is a widely copied *example*; one that a single owner holds in at most
``LIVE_REPOSITORIES`` repositories and that looks random is *live*. No list of words enters: a key that
happens to hold "test" is judged by who has it. Both verdicts become further spans over the value
itself; the base spans stay. Distinct counts combine on the map side, so a value that a third of all
documents repeat costs a row per task, owner and repository; values travel as hashes, texts do not move.

Defined results: a null text is empty. Rows are judged one by one, whether or not they share an id; a
null owner or repository is not counted, so a value without any owner is not live.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sieveline.llm.batches import slices
from sieveline.session import materialize

KINDS = ("assign", "access", "hex", "live", "example")
#: Distinct owners from which a value is a widely copied example.
EXAMPLE_OWNERS = 3
#: Distinct repositories from which a value is a widely copied example, whoever owns them.
EXAMPLE_REPOSITORIES = 10
#: Distinct repositories up to which one owner's value is live.
LIVE_REPOSITORIES = 3
#: Shannon entropy (bits a character) from which a value looks random.
RANDOM_BITS = 3.0
#: Characters from which a value may be live.
LIVE_CHARS = 16

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_NAMES = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
#: Different characters up to which a value is filling.
_FILLING = 3
_HEX_RUN = 32
_HEX_MAP = bytes(0x68 if c in b"0123456789abcdef" else 0x20 for c in range(256))


def _hex_runs(raw: bytes) -> list[tuple[int, int]]:
    """Byte spans of the runs of 32 or more lower-case hex digits."""
    mapped, out = raw.translate(_HEX_MAP), []
    at = mapped.find(b"h" * _HEX_RUN)
    while at >= 0:
        end = mapped.find(b" ", at)
        end = len(mapped) if end < 0 else end
        out.append((at, end))
        at = mapped.find(b"h" * _HEX_RUN, end)
    return out


def candidates(text: str | None) -> list[tuple[int, int, int, int, int, str]]:
    """(kind, start, end, value start, value end, value) of each base span, in code points, by start and kind."""
    if not text:
        return []
    out = []
    raw = text.encode()
    low = raw.lower()
    if any(n in low for n in _NAMES):
        for m in _ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= 8:
                out.append((0, m.start(), m.end(), m.start(2), m.end(2), m[2]))
    if b"AKIA" in raw:
        out += [(1, m.start(), m.end(), m.start(), m.end(), m[0]) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    ascii_only = len(raw) == len(text)
    for a, b in _hex_runs(raw):
        start = a if ascii_only else len(raw[:a].decode())
        out.append((2, start, start + b - a, start, start + b - a, raw[a:b].decode()))
    return sorted(out)


def looks_random(value: str) -> bool:
    """Long, with digits and letters, and of high entropy."""
    if len(value) < LIVE_CHARS or not (any(c.isdigit() for c in value) and any(c.isalpha() for c in value)):
        return False
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) >= RANDOM_BITS


def is_filling(value: str) -> bool:
    """Hardly any variety, like rows of x."""
    return len(set(value.lower())) <= _FILLING


_SPAN = T.StructType(
    [T.StructField(n, T.IntegerType()) for n in ("kind", "start", "end", "value_start", "value_end")]
    + [T.StructField("high", T.LongType()), T.StructField("low", T.LongType()), T.StructField("random", T.BooleanType()), T.StructField("filling", T.BooleanType())]
)
_ARROW_SPAN = pa.struct(
    [(n, pa.int32()) for n in ("kind", "start", "end", "value_start", "value_end")] + [("high", pa.int64()), ("low", pa.int64()), ("random", pa.bool_()), ("filling", pa.bool_())]
)


def find(docs: DataFrame, doc_id: str, text: str, repository: str, owner: str) -> DataFrame:
    """Rows (doc, repository, owner, spans): the base spans of each document row."""
    kinds = docs.schema
    names = {"doc": doc_id, "repository": repository, "owner": owner}
    inner = T.StructType([*(T.StructField(n, kinds[c].dataType) for n, c in names.items()), T.StructField("spans", T.ArrayType(_SPAN))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in slices(whole, 0):
                spans = []
                for value in part.column(0).to_pylist():
                    own = []
                    for kind, a, b, c, d, word in candidates(value):
                        digest = xxhash.xxh3_128_digest(word.encode())
                        high, low = (int.from_bytes(x, "big", signed=True) for x in (digest[:8], digest[8:]))
                        own.append({"kind": kind, "start": a, "end": b, "value_start": c, "value_end": d, "high": high, "low": low, "random": looks_random(word), "filling": is_filling(word)})
                    spans.append(own)
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in (1, 2, 3)), pa.array(spans, pa.list_(_ARROW_SPAN))], names=inner.names)

    narrow = docs.select(F.col(f"`{text}`").cast("string").alias("_t"), *(F.col(f"`{c}`").alias(n) for n, c in names.items()))
    return narrow.mapInArrow(run, inner)


def ownership(found: DataFrame) -> DataFrame:
    """Rows (high, low, random, filling, n_repositories, n_owners) for each value in the corpus."""
    each = found.select("repository", "owner", F.explode("spans").alias("s")).select("repository", "owner", "s.high", "s.low", "s.random", "s.filling")
    value = ["high", "low", "random", "filling"]
    return each.groupBy(*value).agg(F.count_distinct("owner").alias("n_owners"), F.count_distinct("repository").alias("n_repositories"))


def scan(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", repository: str = "doc_id", owner: str = "source",
    example_owners: int = EXAMPLE_OWNERS, example_repositories: int = EXAMPLE_REPOSITORIES, live_repositories: int = LIVE_REPOSITORIES,
) -> DataFrame:
    """One row per document row: the id and ``spans``, an array of (start, kind, end, n_repositories, n_owners), sorted.

    ``kind`` is the place in KINDS. Base spans carry their value's counts; live and example spans cover the value.
    """
    found = materialize(find(docs, doc_id, text, repository, owner).withColumn("row", F.monotonically_increasing_id()), "secret-candidates")
    counted = materialize(ownership(found.where(F.size("spans") > 0)), "secret-ownership", compact=True)
    copied = (F.col("n_owners") >= example_owners) | (F.col("n_repositories") >= example_repositories)
    live = F.col("random") & (F.col("n_owners") == 1) & (F.col("n_repositories") <= live_repositories)
    verdict = F.when(F.col("filling") | copied, F.lit(KINDS.index("example"))).when(live, F.lit(KINDS.index("live")))
    judged = counted.select(F.col("high").alias("h"), F.col("low").alias("l"), verdict.alias("verdict"), "n_repositories", "n_owners")
    each = found.where(F.size("spans") > 0).select("row", F.explode("spans").alias("s")).select("row", "s.*")
    met = each.join(judged, (F.col("high") == F.col("h")) & (F.col("low") == F.col("l")))
    span = lambda start, kind, end: F.struct(
        F.col(start).alias("start"), kind.cast("int").alias("kind"), F.col(end).alias("end"), F.col("n_repositories"), F.col("n_owners")
    )
    two = F.array(span("start", F.col("kind"), "end"), F.when(F.col("verdict").isNotNull(), span("value_start", F.col("verdict"), "value_end")))
    gathered = met.select("row", two.alias("two")).groupBy("row").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.array_compact("two"))))).alias("all"))
    kind = gathered.schema["all"].dataType
    out = found.select("row", F.col("doc").alias("_doc")).join(gathered.withColumnRenamed("row", "_row"), F.col("row") == F.col("_row"), "left")
    return out.select(F.col("_doc").alias(doc_id), F.coalesce("all", F.array().cast(kind)).alias("spans"))
