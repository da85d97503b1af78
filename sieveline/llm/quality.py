"""Quality rules: gradient-boosted trees over document statistics.

Each text gives counts and ratios (words `[^\\x20\\x09-\\x0D]+`, code points, symbols, repeated
lines and windows, ...), computed for many texts at once with numpy. A small histogram booster,
written here, is fitted on the driver to a bounded sample of labelled documents: at most
``max_rows`` of them, taken by the smallest hash of their ids, so that the same tables give the
same model. Chosen features are monotonic: splits that would raise quality with a growing share
of repetition or symbols are not taken, and bounds are handed down so that no deeper split breaks
this. The fitted trees are flattened into numpy node arrays (feature, threshold, left, right,
value); scoring walks all documents of a slice down all trees level by level.

Defined results: a null text has no words and fails the base rules. Labels that are null, have a
null id or belong to no document are not used; repeated labels count as often as they occur, and
documents that share an id give one row for each of its labels.
With fewer than ``MIN_ROWS`` labels, or one class alone, the model keeps what passes the base
rules.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sieveline.llm import words as W
from sieveline.llm.batches import long, map_text, utf8

#: Bound of the labelled sample the model is fitted on.
MAX_ROWS = 20_000
MIN_ROWS = 40
#: Documents whose modelled chance of being good is under this are rejected.
THRESHOLD = 0.3
#: Words in a window that counts as repeated when it occurs again.
REPEAT = 8

#: Features and their direction: -1 where quality may only fall with the feature, 1 rise, 0 free.
FEATURES = {
    "log_words": 0,
    "mean_word_chars": 0,
    "symbol_ratio": -1,
    "dup_line_ratio": -1,
    "repeat_ratio": -1,
    "distinct_ratio": 0,
    "upper_ratio": -1,
    "digit_ratio": -1,
    "punct_ratio": 0,
    "mean_line_words": 0,
    "one_char_ratio": 0,
    "long_word_ratio": 0,
    "top_word_ratio": -1,
    "bang_ratio": -1,
}

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[0x30:0x3A] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[list(b".,;:!?'\"()-")] = True
_HEAD = np.ones(256, bool)  # bytes that begin a code point
_HEAD[0x80:0xC0] = False


def _groups(keys: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal keys of an owner together, earlier ones first, and where its groups start (and the end)."""
    own = W.mix(keys ^ W.mix(owner.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(own, kind="stable")
    edge = np.ones(len(keys) + 1, bool)
    edge[1:-1] = own[order[1:]] != own[order[:-1]]
    return order, np.flatnonzero(edge) if len(keys) else np.zeros(1, np.int64)


def _repeats(keys: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: does an equal one of the same owner come earlier; is there any other."""
    earlier, any_other = np.ones(len(keys), bool), np.zeros(len(keys), bool)
    order, edge = _groups(keys, owner)
    earlier[order[edge[:-1]]] = False
    any_other[order] = np.repeat(np.diff(edge) > 1, np.diff(edge))
    return earlier, any_other


def statistics(column: pa.Array) -> dict[str, np.ndarray]:
    """The counts of each text, by name."""
    buf, offsets = utf8(column)
    s, e, first = W.words(buf, offsets, W.SPACED)
    n = np.diff(first)
    run = lambda kind: np.concatenate([[0], np.cumsum(kind[buf], dtype=np.int64)])
    count = lambda kind: np.diff(run(kind)[offsets])
    heads = run(_HEAD & W.SPACED)
    chars = heads[e] - heads[s]  # code points of each word
    h = W.hashes(buf, s, e)
    owner = np.repeat(np.arange(len(n)), n)

    grams, at = W.windows(h, first, REPEAT)
    _, twice = _repeats(grams, owner[at])
    repeated = W.cover(at[twice], REPEAT, len(s))

    # lines: from a text's start or after a \n, up to the next \n or the text's end
    breaks = np.flatnonzero(buf == 0x0A)
    begin = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
    line_of = np.searchsorted(breaks, offsets[:-1]) + np.arange(len(n))  # where each text's lines start
    stop = np.empty_like(begin)
    lines = np.diff(np.concatenate([line_of, [len(begin)]]))
    which = np.repeat(np.arange(len(n)), lines)
    last = np.cumsum(lines) - 1
    stop[:] = 0
    inner = np.ones(len(begin), bool)
    inner[last] = False
    stop[inner] = breaks
    stop[last] = offsets[1:]
    filled = np.searchsorted(s, stop) > np.searchsorted(s, begin)
    full = np.flatnonzero(filled)
    again, _ = _repeats(W.hashes(buf, begin[full], stop[full]), which[full])
    per = lambda flags, by: np.bincount(by, weights=flags, minlength=len(n)).astype(np.int64)

    # the most frequent word's occurrences in each text
    top, distinct = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
    if len(h):
        order, edge = _groups(h, owner)
        who = owner[order[edge[:-1]]]
        np.maximum.at(top, who, np.diff(edge))
        distinct = np.bincount(who, minlength=len(n))
    return {
        "n_words": n,
        "word_chars": np.diff(heads[offsets]),
        "n_symbols": count(_SYMBOL),
        "n_dup_lines": per(again, which[full]),
        "n_repeat_words": W.per_text(repeated, first),
        "distinct": distinct,
        "upper": count(_UPPER),
        "digits": count(_DIGIT),
        "punct": count(_PUNCT),
        "bangs": np.diff(np.concatenate([[0], np.cumsum(buf == 0x21, dtype=np.int64)])[offsets]),
        "lines": per(np.ones(len(full)), which[full]),
        "one_char": W.per_text(chars == 1, first),
        "long_words": W.per_text(chars > 20, first),
        "top": top,
    }


def features(c: dict[str, np.ndarray]) -> np.ndarray:
    """One row for each text, one column for each of FEATURES."""
    words, chars = np.maximum(c["n_words"], 1), np.maximum(c["word_chars"], 1)
    lines = np.maximum(c["lines"], 1)
    values = {
        "log_words": np.log1p(c["n_words"]),
        "mean_word_chars": c["word_chars"] / words,
        "symbol_ratio": c["n_symbols"] / words,
        "dup_line_ratio": c["n_dup_lines"] / lines,
        "repeat_ratio": c["n_repeat_words"] / words,
        "distinct_ratio": c["distinct"] / words,
        "upper_ratio": c["upper"] / chars,
        "digit_ratio": c["digits"] / chars,
        "punct_ratio": c["punct"] / words,
        "mean_line_words": c["n_words"] / lines,
        "one_char_ratio": c["one_char"] / words,
        "long_word_ratio": c["long_words"] / words,
        "top_word_ratio": c["top"] / words,
        "bang_ratio": c["bangs"] / words,
    }
    return np.stack([values[f] for f in FEATURES], axis=1).astype(float)


def base_failed(c: dict[str, np.ndarray]) -> np.ndarray:
    """The rules that hold whatever the model says."""
    return (c["n_words"] < 20) | (100 * c["n_repeat_words"] > 30 * c["n_words"])


@dataclass
class Forest:
    """Trees in node arrays of one length for all; a leaf points to itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int
    start: float

    def margins(self, x: np.ndarray) -> np.ndarray:
        if not len(self.feature):
            return np.full(len(x), self.start)
        trees, row = np.arange(len(self.feature)), np.arange(len(x))[:, None]
        at = np.zeros((len(x), len(trees)), np.int64)
        for _ in range(self.depth):
            low = x[row, self.feature[trees, at]] <= self.threshold[trees, at]
            at = np.where(low, self.left[trees, at], self.right[trees, at])
        return self.start + self.value[trees, at].sum(axis=1)

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margins(x)))


def fit(
    x: np.ndarray, y: np.ndarray, signs: list[int], trees: int = 60, depth: int = 3, rate: float = 0.15, bins: int = 64, penalty: float = 1.0, least: int = 5
) -> Forest:
    """Boost ``trees`` trees on the logistic loss, with monotonic features where ``signs`` is -1 or 1."""
    nodes = 2 ** (depth + 1) - 1
    none = Forest(*(np.zeros((0, nodes)) for _ in range(5)), depth, 0.0)
    if len(y) < MIN_ROWS or y.min() == y.max():
        none.start = 30.0  # keeps all
        return none
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], axis=1)
    start = float(np.log(y.mean() / (1 - y.mean())))
    margin = np.full(len(y), start)
    forest = Forest(
        np.zeros((trees, nodes), np.int64), np.full((trees, nodes), np.inf), np.tile(np.arange(nodes), (trees, 1)),
        np.tile(np.arange(nodes), (trees, 1)), np.zeros((trees, nodes)), depth, start,
    )
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, np.maximum(p * (1 - p), 1e-9)
        todo = [(0, np.arange(len(y)), -np.inf, np.inf, 0)]
        while todo:
            node, rows, low, high, level = todo.pop()
            best, own = None, -g[rows].sum() / (h[rows].sum() + penalty)
            forest.value[t, node] = rate * float(np.clip(own, low, high))
            if level == depth or len(rows) < 2 * least:
                continue
            for f, sign in enumerate(signs):
                size = len(cuts[f]) + 1
                sums = [np.cumsum(np.bincount(binned[rows, f], weights=w, minlength=size)) for w in (g[rows], h[rows], np.ones(len(rows)))]
                gl, hl, nl = (s[:-1] for s in sums)
                gr, hr, nr = (s[-1] - s[:-1] for s in sums)
                vl, vr = (np.clip(-a / (b + penalty), low, high) for a, b in ((gl, hl), (gr, hr)))
                loss = gl * vl + (hl + penalty) * vl**2 / 2 + gr * vr + (hr + penalty) * vr**2 / 2
                loss[(nl < least) | (nr < least) | ((vr - vl) * sign < 0)] = np.inf
                if len(loss) and (k := int(np.argmin(loss))) is not None and np.isfinite(loss[k]) and (best is None or loss[k] < best[0] - 1e-12):
                    best = (loss[k], f, k, vl[k], vr[k])
            mine = float(np.clip(own, low, high))
            if best is None or best[0] > g[rows].sum() * mine + (h[rows].sum() + penalty) * mine**2 / 2 - 1e-6:
                continue
            _, f, k, vl, vr = best
            forest.feature[t, node], forest.threshold[t, node] = f, cuts[f][k]
            forest.left[t, node], forest.right[t, node] = 2 * node + 1, 2 * node + 2
            middle, go = (vl + vr) / 2, binned[rows, f] <= k
            bounds = {1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle)), 0: ((low, high), (low, high))}[signs[f]]
            todo += [(2 * node + 1, rows[go], *bounds[0], level + 1), (2 * node + 2, rows[~go], *bounds[1], level + 1)]
        one = Forest(*(a[t : t + 1] for a in (forest.feature, forest.threshold, forest.left, forest.right, forest.value)), depth, 0.0)
        margin += one.margins(x)
    return forest


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", max_rows: int = MAX_ROWS) -> Forest:
    """Fit the model to at most ``max_rows`` labelled documents.

    Of rows that share an id, the one with the smallest hash of its text stands for it, so no more
    than ``max_rows`` rows come to the driver however often an id occurs.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("_own"), F.col(label).cast("double").alias("y"))
    picked = known.orderBy(F.xxhash64("_own"), "_own", "y").limit(max_rows)
    own = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    own = own.join(F.broadcast(picked.select(F.col("_own").alias("_pick"))), F.col("id") == F.col("_pick"), "left_semi")
    own = own.withColumn("h", F.xxhash64("text"))

    def fn(column: pa.Array) -> dict[str, pa.Array]:
        x = features(statistics(column))
        flat = pa.array(x.ravel())
        return {"x": pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), flat)}

    each = map_text(own, "text", fn, [T.StructField("x", T.ArrayType(T.DoubleType()))], ["id", "h"])
    one = each.groupBy("id").agg(F.min(F.struct("h", "x")).alias("m"))
    rows = one.join(F.broadcast(picked), F.col("id") == F.col("_own")).select("id", "y", "m.x").limit(max_rows).toPandas()
    rows["k"] = rows.x.map(tuple)
    rows = rows.sort_values(["id", "y", "k"])
    x = np.array(rows.x.tolist(), float).reshape(len(rows), len(FEATURES))
    return fit(x, (rows.y.to_numpy() > 0).astype(float), list(FEATURES.values()))


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judge(docs: DataFrame, model: Forest, text: str = "text", threshold: float = THRESHOLD, carry: list[str] | None = None, keep_text: bool = False) -> DataFrame:
    """The carried columns with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score and kept."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def fn(column: pa.Array) -> dict[str, pa.Array]:
        c = statistics(column)
        failed, score = base_failed(c), shared.value.scores(features(c))
        out = {k: pa.array(c[k]) for k in COUNTS}
        return out | {"base_failed": pa.array(failed), "score": pa.array(score), "kept": pa.array(~failed & (score >= threshold))}

    fields = [*map(long, COUNTS), T.StructField("base_failed", T.BooleanType()), T.StructField("score", T.DoubleType()), T.StructField("kept", T.BooleanType())]
    return map_text(docs, text, fn, fields, carry or ["doc_id"], keep_text)


def keep_good(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents, with all their columns, that the rules and the model keep."""
    columns = docs.columns
    place = {c: f"c{i}" for i, c in enumerate(columns)}
    tagged = docs.select(*(F.col(f"`{c}`").alias(p) for c, p in place.items()))
    model = train(docs, labels, doc_id, text)
    kept = judge(tagged, model, place[text], carry=list(place.values()), keep_text=True, **options).where("kept")
    return kept.select(*(F.col(p).alias(c) for c, p in place.items()))
