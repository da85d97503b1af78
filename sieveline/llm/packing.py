"""Sequence packing by power-of-two decomposition.

A document is tokenised and closed with an end id. Its ids are cut into pieces of ``max_tokens``
(a power of two) and, for the rest, into pieces of the lengths in the rest's binary form, longest
first. Each piece is a sequence of its own, so no sequence crosses documents, none is padded, and
sequences of equal length form a bucket that a trainer can batch as it is (``bucket``: the
logarithm of the length). Documents never move: tokenising and cutting is one narrow pass.

Chunks between ASCII white space are tokenised once for each worker and remembered, up to
``MEMORY_BYTES`` and none longer than ``LONG``, until the worker turns to another operator. That gives the tokenizer's own ids where its
normalisation and pre-tokenisation treat white space as a boundary that leaves no token; whether they
do is read from the tokenizer's file (`splits_at_blanks`), and other tokenizers are given whole texts.
Chunks are lower-cased first if the tokenizer does so, but only ASCII ones that hold no added token's
text in lower case: composed letters and added tokens come before lower case.

Defined results: a null or empty text is the end id alone. Rows that share an id are packed each
by itself. Sequence ids are unique within one result, and follow from the input's partitions and
their order of rows.
"""

from __future__ import annotations

import json
import os
import string
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sieveline.llm.batches import CACHES, slices, trim

MAX_TOKENS = 2048
END = 1
#: Bytes of chunks, their ids and some 200 for the entry of each that a worker remembers.
MEMORY_BYTES = 128 << 20
_ENTRY = 200
#: Bytes of the longest chunk that is remembered.
LONG = 64
#: New chunks that are given to the tokenizer as one text, and how many such texts at a time.
_GROUP = 256
_TEXTS = 16
#: Slices after which a worker gives free memory back.
_TRIM = 4
_MARK = "|"
#: Stops that end a word: pre-tokenisers that tell letters from signs cut between an ASCII letter or digit and these.
_STOPS = b".,;:!?"
_ALNUM = frozenset(b"abcdefghijklmnopqrstuvwxyz0123456789")

#: Tokenizers and remembered chunks of this worker, by path.
_LOADED: dict[str, Callable[[list[str | None]], list[bytes]]] = {}
CACHES.append(_LOADED.clear)


def _flat(part: dict | None, inner: str) -> list[dict]:
    return [] if part is None else [y for x in part[inner] for y in _flat(x, inner)] if part["type"] == "Sequence" else [part]


def splits_at_blanks(path: str) -> bool:
    """Whether a tokenizer's file says that ASCII white space always ends a token and leaves none.

    The normaliser may only compose, decompose, lower-case or squeeze white space; the first
    pre-tokeniser must cut at white space, or keep only what a pattern finds that finds no white space.
    """
    with open(path, encoding="utf-8") as f:
        made = json.load(f)
    for part in _flat(made.get("normalizer"), "normalizers"):
        squeezes = part["type"] == "Replace" and part["pattern"] == {"Regex": r"\s+"} and part["content"] == " "
        if part["type"] not in ("NFC", "NFD", "NFKC", "NFKD", "Lowercase") and not squeezes:
            return False
    cuts = _flat(made.get("pre_tokenizer"), "pretokenizers")
    if not cuts:
        return False
    if cuts[0]["type"] in ("Whitespace", "WhitespaceSplit", "BertPreTokenizer"):
        return True
    if cuts[0]["type"] != "Split" or cuts[0]["behavior"] != "Removed" or not cuts[0]["invert"] or "Regex" not in cuts[0]["pattern"]:
        return False
    blanks = " \t\n\x0b\x0c\r"
    sides = ["", "a", "Z", "é", "7", "'", "'s", "-", "!", "_", "日"]
    probes = [a + b + c + d for a in sides for b in blanks for c in ("", *blanks) for d in sides]
    return not any(set(m[0]) & set(blanks) for p in probes for m in regex.finditer(cuts[0]["pattern"]["Regex"], p))


def cuts_before_stops(path: str) -> bool:
    """Whether a tokenizer's file says that stops behind a word never share a token with it.

    The first pre-tokeniser must part words and punctuation, or keep only what a pattern finds that never finds both.
    """
    with open(path, encoding="utf-8") as f:
        cuts = _flat(json.load(f).get("pre_tokenizer"), "pretokenizers")
    if not cuts:
        return False
    if cuts[0]["type"] in ("Whitespace", "BertPreTokenizer"):
        return True
    if cuts[0]["type"] != "Split" or "Regex" not in cuts[0]["pattern"] or cuts[0]["behavior"] != "Removed" or not cuts[0]["invert"]:
        return False
    stops = [chr(c) for c in _STOPS]
    tails = [*stops, *(a + b for a in stops for b in stops), *(3 * a for a in stops)]
    words = ["a", "z", "0", "9", "word", "it's", "x9", "don't", "7a"]
    return not any(m.start() < len(w) < m.end() for w in words for t in tails for m in regex.finditer(cuts[0]["pattern"]["Regex"], w + t))


def encoder(path: str, by_chunk: bool | None = None) -> Callable[[list[str | None]], list[bytes]]:
    """A function from texts to their ids, as little-endian unsigned 32-bit integers.

    ``by_chunk`` follows from the tokenizer's file unless given.
    """
    key = f"{path}?{by_chunk}"
    if key not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(path)
        model.no_truncation()
        model.no_padding()
        model.encode_special_tokens = False
        chunked = splits_at_blanks(path) if by_chunk is None else by_chunk
        _LOADED[key] = _chunked(model, cuts_before_stops(path)) if chunked else lambda texts: [_packed(model.encode(t or "", add_special_tokens=False).ids) for t in texts]
    return _LOADED[key]


def _packed(ids) -> bytes:
    return np.asarray(ids, "<u4").tobytes()


def _chunked(model, stops_apart: bool) -> Callable[[list[str | None]], list[bytes]]:
    known: dict[bytes, bytes] = {}
    room = MEMORY_BYTES
    mark = model.encode(_MARK, add_special_tokens=False).ids
    #: Texts of added tokens are found before white space matters, so texts that hold one are encoded whole.
    added = [t.content.encode() for t in model.get_added_tokens_decoder().values()]
    plain = len(mark) == 1
    lowers = plain and all(model.encode(c, add_special_tokens=False).ids == model.encode(c.lower(), add_special_tokens=False).ids for c in string.ascii_uppercase)

    def ids_of(chunks: list[bytes]) -> dict[bytes, bytes]:
        into: dict[bytes, bytes] = {}
        joined = []
        for c in chunks:
            if plain and len(c) <= LONG and _MARK.encode() not in c:
                joined.append(c)
            else:
                into[c] = _packed(model.encode(c.decode(), add_special_tokens=False).ids)
        groups = [joined[i : i + _GROUP] for i in range(0, len(joined), _GROUP)]
        for at in range(0, len(groups), _TEXTS):
            some = groups[at : at + _TEXTS]
            texts = [f" {_MARK} ".join(c.decode() for c in g) for g in some]
            for g, e in zip(some, model.encode_batch_fast(texts, add_special_tokens=False), strict=True):
                ids = np.asarray(e.ids, "<u4")
                cuts = np.concatenate([[-1], np.flatnonzero(ids == mark[0]), [len(ids)]])
                if len(cuts) != len(g) + 1:
                    raise ValueError("the tokenizer does not keep chunks between white space apart; use by_chunk=False")
                raw = ids.tobytes()
                for c, a, b in zip(g, (4 * (cuts[:-1] + 1)).tolist(), (4 * cuts[1:]).tolist(), strict=True):
                    into[c] = raw[a:b]
        return into

    def learn(fresh: dict[bytes, bytes]) -> None:
        """Fill in the ids of new chunks. A word and the stops after it are looked up one by one, if the tokenizer parts them."""
        parts = {c: (w, c[len(w) :]) for c in fresh if lowers and stops_apart and c[-1] in _STOPS and (w := c.rstrip(_STOPS)) and w[-1] in _ALNUM}
        need = dict.fromkeys(c for c in fresh if c not in parts)
        need.update(dict.fromkeys(p for two in parts.values() for p in two if p not in known))
        new = ids_of(list(need))
        for c in fresh:
            if c in parts:
                w, tail = parts[c]
                fresh[c] = (new.get(w) or known[w]) + (new.get(tail) or known[tail])
            else:
                fresh[c] = new[c]

    def keys(raw: bytes) -> list[bytes]:
        """Chunks in lower case, but as they are if they have other than ASCII characters or become an added token."""
        chunks = raw.split()
        if not lowers:
            return chunks
        low = raw.lower()
        if any(a in low for a in added):
            return [c if not c.isascii() or any(a in c.lower() for a in added) else c.lower() for c in chunks]
        if raw.isascii():
            return low.split()
        return [b if b.isascii() else c for b, c in zip(low.split(), chunks, strict=True)]

    def encode(texts: list[str | None]) -> list[bytes]:
        nonlocal room
        out: list[bytes] = [b""] * len(texts)
        chunked: list[tuple[int, list[bytes], list[bytes | None]]] = []
        fresh: dict[bytes, bytes] = {}
        for k, text in enumerate(texts):
            raw = (text or "").encode()
            if any(a in raw for a in added):
                out[k] = _packed(model.encode(text, add_special_tokens=False).ids)
                continue
            chunks = keys(raw)
            got = list(map(known.get, chunks))
            if None in got:
                fresh.update((c, b"") for c, g in zip(chunks, got, strict=True) if g is None)
                chunked.append((k, chunks, got))
            else:
                out[k] = b"".join(got)
        if fresh:
            learn(fresh)
            for k, chunks, got in chunked:
                out[k] = b"".join([fresh[c] if g is None else g for c, g in zip(chunks, got, strict=True)])
            if room > 0:
                short = {c: ids for c, ids in fresh.items() if len(c) <= LONG}
                known.update(short)
                room -= _ENTRY * len(short) + sum(map(len, short)) + sum(map(len, short.values()))
        return out

    return encode


def piece_lengths(total: int, max_tokens: int = MAX_TOKENS) -> list[int]:
    """Lengths of the pieces of a document of ``total`` ids."""
    rest = total % max_tokens
    return [max_tokens] * (total // max_tokens) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(
    docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", max_tokens: int = MAX_TOKENS, end: int = END, by_chunk: bool | None = None
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (binary, little-endian unsigned 32-bit), doc_tokens, sequence_id, offset, bucket.

    ``tokenizer`` is the path of a tokenizers file that every worker can read.
    """
    if max_tokens < 1 or max_tokens & (max_tokens - 1):
        raise ValueError(f"max_tokens is {max_tokens}, not a power of two")
    inner = T.StructType(
        [T.StructField("doc", docs.schema[doc_id].dataType)]
        + [T.StructField(n, T.LongType()) for n in ("start", "length")]
        + [T.StructField("ids", T.BinaryType()), T.StructField("doc_tokens", T.LongType()), T.StructField("bucket", T.IntegerType())]
    )
    tail = _packed([end])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trim()
        encode = encoder(tokenizer, by_chunk)
        for whole in batches:
            for count, part in enumerate(slices(whole, 0), 1):
                row, start, length, ids, total = [], [], [], [], []
                for k, own in enumerate(encode(part.column(0).to_pylist())):
                    own += tail
                    at, n = 0, len(own) // 4
                    for size in piece_lengths(n, max_tokens):
                        row.append(k)
                        start.append(at)
                        length.append(size)
                        ids.append(own[4 * at : 4 * (at + size)])
                        total.append(n)
                        at += size
                sizes = pa.array(length, pa.int64())
                bucket = pa.array([n.bit_length() - 1 for n in length], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column(1).take(pa.array(row, pa.int64())), pa.array(start, pa.int64()), sizes, pa.array(ids, pa.binary()), pa.array(total, pa.int64()), bucket],
                    names=inner.names,
                )
                if count % _TRIM == 0:
                    trim()  # what encoding left between what is remembered

    out = docs.select(F.col(f"`{text}`").cast("string").alias("_t"), F.col(f"`{doc_id}`").alias("doc")).mapInArrow(run, inner)
    return out.select(
        F.col("doc").alias(doc_id), "start", "length", "ids", "doc_tokens",
        F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset"), "bucket",
    )
