"""Fuzzy search for short license notices.

Texts are lower-cased (A-Z) and cut into words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`, joined by single blanks, so line
breaks and punctuation cost no edits. A notice of ``errors`` allowed edits is split into ``errors`` + 1 pieces: whatever
is within that many edits of it holds at least one piece as it stands (pigeonhole). All pieces of all notices make one
Aho-Corasick automaton; each place it finds a piece gives a window of the notice's length and ``errors`` characters on
either side, and the regex library's bounded-error matching verifies its spans between word boundaries; the closest is
taken. A window that holds the notice itself at its place needs no search.

A place is (label, base, first, last, start, end, errors, similarity): the words from ``first`` to ``last`` (from 0), the
code points from ``start`` to ``end`` (exclusive) of the text as it was, and 1 - errors / the notice's length. ``base``
marks exact places of base notices: all of these are reported, whatever overlaps them. Of other places of a label that
overlap, the one with the fewest errors stays, then the first; a place within one of a longer notice with no more errors goes.

The work is one narrow pass: texts are not shuffled, the notices are parameters, and what a task holds is bounded by a
slice of 1 MB or the longest text. Windows are searched one by one, so a text that repeats a piece costs in line with its
length.

Defined results: a null text is empty and has no places; rows are judged one by one, whether or not they share an id.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sieveline.llm import words as W
from sieveline.llm.batches import long, map_text, utf8


@dataclass(frozen=True)
class Notice:
    """A phrase of lower-case words and the edits it bears; ``exact`` words bear none, ``base`` is for the exact phrase."""

    label: str
    phrase: str
    errors: int
    base: bool = False
    exact: tuple[str, ...] = ()

    def pieces(self) -> list[tuple[str, int]]:
        """``errors`` + 1 pieces of the phrase with their offsets."""
        n, k = len(self.phrase), self.errors + 1
        if n <= 2 * self.errors:
            raise ValueError(f"{self.phrase!r} is too short for {self.errors} errors")
        cuts = [n * i // k for i in range(k + 1)]
        return [(self.phrase[a:b], a) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def parts(self) -> tuple[str, str, str]:
        """The exact words at the phrase's beginning, what lies between, and those at its end, with the blanks beside them."""
        words = self.phrase.split(" ")
        a = next((k for k, w in enumerate(words) if w not in self.exact), len(words))
        b = next((k for k, w in enumerate(reversed(words)) if w not in self.exact), len(words))
        if a + b >= len(words) or set(words[a : len(words) - b]) & set(self.exact):
            raise ValueError(f"exact words of {self.phrase!r} must be at its ends, around others")
        head, tail = "".join(f"{w} " for w in words[:a]), "".join(f" {w}" for w in words[len(words) - b :])
        return head, self.phrase[len(head) : len(self.phrase) - len(tail)], tail


NOTICES = (
    Notice("mit", "mit license", 1, base=True, exact=("mit",)),
    Notice("apache", "apache license", 1, base=True),
    Notice("gpl", "general public license", 2, base=True),
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy", 6),
    Notice("apache", "licensed under the apache license version 2 0", 4),
    Notice("lgpl", "lesser general public license", 2),
    Notice("agpl", "affero general public license", 2),
    Notice("mpl", "mozilla public license", 2),
    Notice("epl", "eclipse public license", 2),
    Notice("bsd", "redistribution and use in source and binary forms with or without modification", 6),
    Notice("isc", "permission to use copy modify and or distribute this software for any purpose", 6),
    Notice("unlicense", "this is free and unencumbered software released into the public domain", 6),
    Notice("cc-by", "licensed under cc by", 1, exact=("cc", "by")),
    Notice("cc-by-nc", "licensed under cc by nc", 1, exact=("cc", "by", "nc")),
    Notice("cc-by-sa", "licensed under cc by sa", 1, exact=("cc", "by", "sa")),
    Notice("cc", "creative commons attribution", 2),
)

_PLACE = [("label", T.StringType(), pa.string()), ("base", T.BooleanType(), pa.bool_())]
_PLACE += [(n, T.LongType(), pa.int64()) for n in ("first", "last", "start", "end", "errors")] + [("similarity", T.DoubleType(), pa.float64())]
_SPARK_PLACES = T.ArrayType(T.StructType([T.StructField(n, s) for n, s, _ in _PLACE]))
_ARROW_PLACES = pa.list_(pa.struct([(n, a) for n, _, a in _PLACE]))


class Searcher:
    """The automaton of all pieces and the patterns of some notices."""

    def __init__(self, notices: tuple[Notice, ...]):
        self.notices = notices
        self.parts = [n.parts() for n in notices]
        self.patterns = [regex.compile(f"(?b)(?:{regex.escape(body, literal_spaces=True)}){{e<={n.errors}}}") for n, (_, body, _) in zip(notices, self.parts, strict=True)]
        seeds: dict[str, list[tuple[int, int]]] = {}
        for k, n in enumerate(notices):
            for piece, at in n.pieces():
                seeds.setdefault(piece, []).append((k, at))
        self.automaton = ahocorasick.Automaton()
        for piece, owners in seeds.items():
            self.automaton.add_word(piece, (len(piece), owners))
        if seeds:
            self.automaton.make_automaton()

    def matches(self, text: str) -> set[tuple[int, int, int, int]]:
        """(start, end, notice, errors) of what lies around pieces, in a string whose words are each followed by a blank or, at a text's end, a line break."""
        out: set[tuple[int, int, int, int]] = set()
        if not self.notices:
            return out
        tried: set[tuple[int, int]] = set()
        last = 0
        for end, (size, owners) in self.automaton.iter(text):
            for k, at in owners:
                guess = (k, end + 1 - size - at)
                if guess in tried:
                    continue
                tried.add(guess)
                found = self._around(text, *guess)
                if found:
                    out.add(found)
            if end - last > 1 << 16:  # pieces of one place lie within a phrase of each other
                last, tried = end, {g for g in tried if g[1] > end - 4096}
        return out

    def _around(self, text: str, k: int, start: int) -> tuple[int, int, int, int] | None:
        notice = self.notices[k]
        n, e = len(notice.phrase), notice.errors
        sides = " \n"
        if text.startswith(notice.phrase, max(start, 0)) and start >= 0 and (start == 0 or text[start - 1] in sides) and text[start + n] in sides:
            return start, start + n, k, 0
        head, _, tail = self.parts[k]
        begins = [i for i in range(max(start - e, 0), min(start + e + 1, len(text))) if (i == 0 or text[i - 1] in sides) and text.startswith(head, i)]
        ends = [j for j in range(max(start + n - e, 1), min(start + n + e + 1, len(text))) if text[j] in sides and text.endswith(tail, 0, j)]
        best = None
        for a in begins:
            for b in ends:
                if abs(b - a - n) > e or text.find("\n", a, b) >= 0:
                    continue
                m = self.patterns[k].fullmatch(text, a + len(head), b - len(tail))
                if m and (best is None or sum(m.fuzzy_counts) < best[3]):
                    best = a, b, k, sum(m.fuzzy_counts)
        return best

    def places(self, own: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
        """Those of a text's matches that are reported, by start."""
        base = lambda m: self.notices[m[2]].base and m[3] == 0
        kept: list[tuple[int, int, int, int]] = []
        for label in {self.notices[m[2]].label for m in own}:
            mine = [m for m in own if self.notices[m[2]].label == label]
            held = sorted(m for m in mine if base(m))
            taken = [(m[0], m[1]) for m in held]
            kept += held
            for m in sorted((m for m in mine if not base(m)), key=lambda m: (m[3], m[0] - m[1], m[0])):
                i = bisect_right(taken, (m[0], m[1]))
                if (i == 0 or taken[i - 1][1] <= m[0]) and (i == len(taken) or taken[i][0] >= m[1]):
                    taken.insert(i, (m[0], m[1]))
                    kept.append(m)
        out, wide = [], None
        for m in sorted(kept, key=lambda m: (m[0], -m[1], m[3])):
            if wide and m[1] <= wide[1] and m[3] >= wide[3] and not base(m):
                continue
            out.append(m)
            if wide is None or m[1] > wide[1]:
                wide = m
        return out

    def __call__(self, column: pa.Array) -> dict[str, pa.Array]:
        buf, offsets = utf8(column)
        s, e, first = W.words(W.LOWER[buf], offsets, W.ALNUM)
        raw, begin = W.single_spaced(W.LOWER[buf], s, e)
        joined = np.frombuffer(raw, np.uint8).copy()
        ends = first[1:][first[1:] > first[:-1]]
        joined[begin[ends] - 1] = 0x0A
        points = np.concatenate([[0], np.cumsum((joined & 0xC0) != 0x80)])
        word_at = points[begin]
        text = joined.tobytes().decode()
        own: list[list] = [[] for _ in range(len(first) - 1)]
        for m in self.matches(text):
            word = int(np.searchsorted(word_at, m[0], "right")) - 1
            own[int(np.searchsorted(first, word, "right")) - 1].append(m)
        original = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
        rows = []
        for row, found in enumerate(own):
            places = []
            for a, b, k, errors in self.places(found) if found else ():
                notice = self.notices[k]
                i, j = int(np.searchsorted(word_at, a, "right")) - 1, int(np.searchsorted(word_at, b, "left")) - 1
                begins = original[offsets[row]]
                places.append({
                    "label": notice.label, "base": notice.base and errors == 0, "first": i - first[row], "last": j - first[row], "start": original[s[i]] - begins, "end": original[e[j]] - begins,
                    "errors": errors, "similarity": 1 - errors / len(notice.phrase),
                })
            rows.append(places)
        return {"n_words": pa.array(np.diff(first)), "places": pa.array(rows, _ARROW_PLACES)}


_SEARCHERS: dict[tuple[Notice, ...], Searcher] = {}


def _searcher(notices: tuple[Notice, ...]) -> Searcher:
    if notices not in _SEARCHERS:
        _SEARCHERS.clear()
        _SEARCHERS[notices] = Searcher(notices)
    return _SEARCHERS[notices]


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", notices: tuple[Notice, ...] = NOTICES, carry: list[str] | None = None, keep_text: bool = False) -> DataFrame:
    """One row per document row: the carried columns (the id if none are named), n_words and places, by their first word.

    A computed column replaces a carried one of the same name.
    """
    notices = tuple(notices)
    fields = [long("n_words"), T.StructField("places", _SPARK_PLACES)]
    return map_text(docs, text, lambda column: _searcher(notices)(column), fields, carry or [doc_id], keep_text=keep_text)


def summary(found: DataFrame, keep: list[str]) -> DataFrame:
    """Rows (*keep, n_words, n_base, first_word, last_word, base_labels, labels, score) of what ``scan`` found: counts, sorted labels, the best similarity."""
    base = F.filter("places", lambda p: p.base)
    starts = F.transform(base, lambda p: p["first"])
    joined = lambda places: F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p.label))), ",")
    return found.select(
        *keep, "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"), joined(F.col("places")).alias("labels"), F.coalesce(F.array_max(F.transform("places", lambda p: p.similarity)), F.lit(0.0)).alias("score"),
    )
