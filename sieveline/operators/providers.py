"""Pluggable providers of embeddings, summaries, rankings and translations.

A provider is a function from a column to a column, so built-in ones stay inside the JVM and
remote ones can be Arrow UDFs. The defaults are deterministic and need no network.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from functools import cache, wraps
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sieveline.functions.text import strip

DIM = 64


class Provider(Protocol):
    def __call__(self, text: Column) -> Column: ...


@cache
def _signed_counts(dim: int) -> Callable[[Column], Column]:
    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def count(codes: pd.Series) -> pd.Series:
        out = []
        for own in codes:
            n = np.bincount(np.asarray(own, np.int64), minlength=2 * dim)
            v = (n[0::2] - n[1::2]).astype(np.float64)
            size = np.sqrt((v * v).sum())
            out.append((v / size if size else v).astype(np.float32))
        return pd.Series(out, dtype=object)

    return count


def hashed_embedding(text: Column, dim: int = DIM) -> Column:
    """A unit vector of signed token counts, by hash: ``dim`` floats, all 0 for no tokens or no text."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s+"), lambda w: w != "")
    return _signed_counts(dim)(F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(2 * dim)).cast("int")))


def lead_summary(text: Column, sentences: int = 2, limit: int = 20_000, bypass: int = 200) -> Column:
    """Short texts as they are, longer ones by their first sentences."""
    head = F.array_join(F.slice(F.split(F.substring(text, 1, limit), r"(?<=[.!?])\s+"), 1, sentences), " ")
    return F.when(F.length(text) <= bypass, text).otherwise(strip(head))


def length_ranking(text: Column) -> Column:
    """A JSON answer whose score grows with the text's length, with its first word as topic."""
    score = F.least(F.lit(1.0), F.floor(F.length(text) / 2) / 1000)
    topic = F.lower(F.element_at(F.split(strip(text), r"\s+"), 1))
    return F.to_json(
        F.struct(
            F.lit("by length").alias("feedback"),
            F.array(F.struct(topic.alias("topic"), F.lit("general").alias("category"), score.alias("score"))).alias("topics"), score.alias("overall_score"),
        )
    )


def same_language(text: Column) -> Column:
    """A translation that leaves the text as it is."""
    return text


def batched(call: Callable[[list[str]], list[list[float]]], size: int = 100, attempts: int = 3, delay: float = 1.0) -> Provider:
    """A provider from a call that embeds up to ``size`` texts at a time, tried again after growing pauses."""
    again = retrying(call, attempts, delay)

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def embed(texts: pd.Series) -> pd.Series:
        own = texts.fillna("").tolist()
        return pd.Series([v for at in range(0, len(own), size) for v in again(own[at : at + size])], dtype=object)

    return embed


REGISTRY: dict[str, dict[str, Provider]] = {
    "embed": {"hashed": hashed_embedding},
    "summarize": {"lead": lead_summary},
    "rank": {"length": length_ranking},
    "translate": {"same": same_language},
}


def register(kind: str, name: str, provider: Provider) -> None:
    REGISTRY.setdefault(kind, {})[name] = provider


def get(kind: str, name: str) -> Provider:
    if name not in REGISTRY.get(kind, {}):
        raise KeyError(f"no {kind} provider {name!r}; there are {sorted(REGISTRY.get(kind, {}))}")
    return REGISTRY[kind][name]


def first_of(*providers: Provider) -> Provider:
    """Providers one after another, until one gives a result."""
    return lambda text: F.coalesce(*(p(text) for p in providers))


def retrying(call: Callable, attempts: int = 3, delay: float = 1.0, sleep: Callable[[float], None] = time.sleep) -> Callable:
    """A remote call that is tried again after growing pauses; the last error is raised."""

    @wraps(call)
    def run(*args, **kw):
        for k in range(attempts):
            try:
                return call(*args, **kw)
            except Exception:
                if k + 1 == attempts:
                    raise
                sleep(delay * 2**k)

    return run


#: Prompts by task; {text} is the content.
PROMPTS = {
    "summarize": "Summarise the following in a few plain sentences:\n{text}",
    "rank": 'Rate the following from 0 to 1 and name up to three topics, as JSON with "feedback", "topics" and "overall_score":\n{text}',
    "translate": "Translate the following to {language}:\n{text}",
    "journal": "Rewrite the following notes as one journal entry:\n{text}",
    "todo": "List what is left to do in the following, one numbered line each:\n{text}",
    "collect": "Gather what is known on the following, with references:\n{text}",
    "deepdive": "Write a thorough article on the following, using all of the material:\n{text}",
    "classify": "Name the section, category and tags of the following as JSON:\n{text}",
}


def prompt(task: str, text: Column, **values: str) -> Column:
    """The task's prompt with the content filled in, for a generating provider."""
    head, _, tail = PROMPTS[task].format_map({k: v for k, v in values.items()} | {"text": "\x00"}).partition("\x00")
    return F.concat(F.lit(head), text, F.lit(tail))
