"""Fuzzy search for short license notices: exact seeds, then verified edits.

A text becomes its words in lower case, joined by one blank. A notice may stand in it with
up to ``k`` edits: one per ``CHARS_PER_EDIT`` of its characters, ``MOST_EDITS`` at most,
and none for those listed as ``EXACT``, which differ from each other by little. Cut into
k + 1 pieces, one piece at least is untouched by k edits (pigeonhole), so an Aho-Corasick
pass over all notices' pieces meets every place.
Around each piece met, a window just wide enough for the notice with k edits is handed to
the regex library's bounded-error matching, which gives the match of fewest edits in it and
its span. Windows are as short as their notice, so a text costs what its length and its
pieces cost. The base phrases are notices of no edits: one piece, met exactly.

Rows are searched by themselves in Arrow batches: nothing is shuffled, no key can be hot.

Defined cases: a null text is empty and holds nothing; very long texts are searched whole;
rows that repeat get equal results; of a notice's places that overlap, the first met counts;
an empty table gives no rows; an input column named as the result (``licenses`` unless
another name is given) is replaced by it, all others are kept.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Base phrases and their labels.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
# Usual short notices in words, and their labels.
NOTICES = (
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("licensed under the mit license", "mit"),
    ("released under the mit license", "mit"),
    ("distributed under the mit license", "mit"),
    ("the mit licence", "mit"),
    ("spdx license identifier mit", "mit"),
    ("licensed under the apache license version 2 0", "apache"),
    ("you may not use this file except in compliance with the license", "apache"),
    ("spdx license identifier apache 2 0", "apache"),
    ("licensed under the gnu general public license", "gpl"),
    ("gnu general public license version", "gpl"),
    ("this program is free software you can redistribute it and or modify it under the terms of", "gpl"),
    ("this program is distributed in the hope that it will be useful but without any warranty", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("bsd 3 clause license", "bsd"),
    ("bsd 2 clause license", "bsd"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee", "isc"),
    ("mozilla public license version", "mpl"),
    ("eclipse public license version", "epl"),
    ("boost software license version 1 0", "boost"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("creative commons attribution", "cc-by"),
    ("licensed under cc by 4 0", "cc-by"),
    ("licensed under cc by nc", "cc-by-nc"),
    ("licensed under cc by sa", "cc-by-sa"),
)
CHARS_PER_EDIT, MOST_EDITS = 12, 4  # bounded-error matching takes about three times as long with every edit more
EXACT = ("the mit licence", "spdx license identifier mit", "licensed under cc by 4 0", "licensed under cc by nc", "licensed under cc by sa")

# a-z, digits and everything from U+0080 on stay, A-Z become small, all else parts words
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c >= 128 else 32 for c in range(256))


def edits_allowed(notice: str) -> int:
    return 0 if notice in EXACT else min(len(notice) // CHARS_PER_EDIT, MOST_EDITS)


def normal(text: str | None) -> tuple[list[bytes], str]:
    """Words of a text, and the words joined by blanks with one at either end."""
    words = (text or "").encode().translate(_WORDS).split()
    return words, (b" " + b" ".join(words) + b" ").decode()


def pieces(pattern: str, k: int) -> list[tuple[int, str]]:
    """(place, piece): the pattern cut into k + 1 parts of about equal length."""
    cuts = [round(i * len(pattern) / (k + 1)) for i in range(k + 2)]
    return [(a, pattern[a:b]) for a, b in zip(cuts, cuts[1:])]


@dataclass(frozen=True)
class Hit:
    """A notice in the joined words: characters [start, end) and the edits it took."""

    notice: int
    start: int
    end: int
    edits: int


class Finder:
    """Seeds of all notices in one automaton, and a bounded-error pattern of each."""

    def __init__(self, notices: Sequence[tuple[str, int]]) -> None:
        import ahocorasick
        import regex

        self.patterns = [f" {words} " for words, _ in notices]
        self.allowed = [k for _, k in notices]
        self.checks = [
            regex.compile(f"(?b)(?:{regex.escape(p, literal_spaces=True)}){{e<={k}}}") for p, k in zip(self.patterns, self.allowed)
        ]
        seeds: dict[str, list[tuple[int, int]]] = {}
        for i, (p, k) in enumerate(zip(self.patterns, self.allowed)):
            for place, piece in pieces(p, k):
                seeds.setdefault(piece, []).append((i, place))
        self.automaton = ahocorasick.Automaton()
        for piece, uses in seeds.items():
            self.automaton.add_word(piece, (len(piece), uses))
        self.automaton.make_automaton()

    def hits(self, joined: str) -> list[Hit]:
        """Matches of every notice, by notice and place; a notice's own never overlap but for
        the blank between two."""
        found: list[Hit] = []
        upto = [0] * len(self.patterns)
        tried: list[tuple[int, int]] = [(0, 0)] * len(self.patterns)
        for last, (length, uses) in self.automaton.iter(joined):
            start = last - length + 1
            for i, place in uses:
                k, size = self.allowed[i], len(self.patterns[i])
                if not k:
                    found.append(Hit(i, start, start + size, 0))
                    continue
                if start < upto[i]:
                    continue
                window = max(start - place - k, upto[i], 0), start - place + size + k
                if window == tried[i]:  # pieces of one place have one window
                    continue
                tried[i] = window
                match = self.checks[i].search(joined, *window)
                if match:
                    found.append(Hit(i, match.start(), match.end(), sum(match.fuzzy_counts)))
                    upto[i] = match.end() - 1
        return sorted(found, key=lambda h: (h.notice, h.start))


@lru_cache(maxsize=4)
def finder(notices: tuple[tuple[str, int], ...]) -> Finder:
    """One per worker process and list of notices."""
    return Finder(notices)


def _first_word(joined: str, start: int) -> int:
    """Number of the word that holds or follows the character ``start``."""
    return joined.count(" ", 0, start + (joined[start] == " ")) - 1


def find_notices(
    docs: DataFrame,
    base: Sequence[tuple[str, str]] = BASE,
    notices: Sequence[tuple[str, str]] = NOTICES,
    result: str = "licenses",
) -> DataFrame:
    """``docs`` with ``result``: a struct of

    - n_words, and ``base``: array of (label, word), the base phrases' places in order,
    - ``notices``: array of (label, notice, first_word, last_word, edits, written), where
      first_word and last_word bound the match in the text's words and written is what
      stands there, in order of the place,
    - score: 1 for a base phrase, else the largest share of a notice's characters left
      unedited, 0 without any.
    """
    listed = tuple((words, 0) for words, _ in base) + tuple((words, edits_allowed(words)) for words, _ in notices)
    labels = [label for _, label in (*base, *notices)]
    kept = [c for c in docs.columns if c.lower() != result.lower()]
    base_type = pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64())]))
    notice_type = pa.list_(pa.struct([
        ("label", pa.string()), ("notice", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()),
        ("edits", pa.int32()), ("written", pa.string()),
    ]))
    made = pa.struct([("n_words", pa.int64()), ("base", base_type), ("notices", notice_type), ("score", pa.float64())])
    ddl = (
        "struct<n_words:bigint,base:array<struct<label:string,word:bigint>>,notices:array<struct<label:string,notice:string,"
        "first_word:bigint,last_word:bigint,edits:int,written:string>>,score:double>"
    )
    schema = docs.select(*kept).limit(0).withColumn(result, F.lit(None).cast(ddl)).schema

    def look(text: str | None) -> dict:
        words, joined = normal(text)
        exact, fuzzy, score = [], [], 0.0
        for h in finder(listed).hits(joined) if words else ():
            first = _first_word(joined, h.start)
            if h.notice < len(base):
                exact.append({"label": labels[h.notice], "word": first})
                score = 1.0
            else:
                last = _first_word(joined, h.end - 1) - (joined[h.end - 1] == " ")
                fuzzy.append({
                    "label": labels[h.notice], "notice": listed[h.notice][0], "first_word": first, "last_word": last,
                    "edits": h.edits, "written": joined[h.start : h.end].strip(),
                })
                score = max(score, 1.0 - h.edits / (len(listed[h.notice][0]) + 2))
        exact.sort(key=lambda b: b["word"])
        fuzzy.sort(key=lambda f: (f["first_word"], f["last_word"], f["notice"]))
        return {"n_words": len(words), "base": exact, "notices": fuzzy, "score": score}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [look(value.as_py()) for value in batch.column(kept.index("text"))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, made)], names=[*kept, result])

    return docs.select(*kept).mapInArrow(run, schema)
