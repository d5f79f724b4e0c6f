"""License scans: fuzzy search of short notices.

Texts are reduced to lower-cased words with one space between.  A notice of m characters may
be misspelt by ``errors(m)`` edits; cut into one piece more than that, at least one piece
stands unharmed in any such spelling (pigeonhole).  One automaton finds the pieces of all
notices in one pass; around each hit the regex library's bounded-error matching checks the
edits and gives the span.  Words that tell one licence from another (``TELLING``: "nc", "lesser")
take no edits: a spelling counts only if it holds exactly those of its notice, in order.  Of
overlapping spellings of different licences the nearest wins: fewest edits, then the longest.
Fixed phrases of whole words are looked for besides, exactly.

Null and empty texts have no words, labels or spans, and score 0.  Word numbers start at 0,
spans are code points of the original text, whole words, ends exclusive.  One result per input
row, repeated rows included; an empty table gives none; other columns are never read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import textblocks as tb
from .shipping import map_arrow

# fixed values: phrases and their labels
PHRASES = (
    (b"gnu general public license", "gpl"),
    (b"apache license", "apache"),
    (b"cc by", "cc-by"),
    (b"mit license", "mit"),
)
#: Short notices and their labels; extend at will.
NOTICES = (
    ("this work is licensed under the gnu general public license", "gpl"),
    ("you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("under the terms of the gnu lesser general public license", "lgpl"),
    ("licensed under the apache license version 2 0", "apache"),
    ("you may not use this file except in compliance with the license", "apache"),
    ("under the terms of the gnu affero general public license", "agpl"),
    ("licensed under cc by 4 0", "cc-by"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("licensed under cc by nd 4 0", "cc-by-nd"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under cc by nc sa 4 0", "cc-by-nc-sa"),
    ("licensed under cc by nc nd 4 0", "cc-by-nc-nd"),
    ("creative commons attribution 4 0 international", "cc-by"),
    ("creative commons attribution sharealike", "cc-by-sa"),
    ("creative commons attribution noderivatives", "cc-by-nd"),
    ("creative commons attribution noncommercial", "cc-by-nc"),
    ("creative commons attribution noncommercial sharealike", "cc-by-nc-sa"),
    ("creative commons attribution noncommercial noderivatives", "cc-by-nc-nd"),
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    ("redistribution and use in source and binary forms with or without modification", "bsd"),
    ("is subject to the terms of the mozilla public license", "mpl"),
    ("free and unencumbered software released into the public domain", "unlicense"),
    ("permission to use copy modify and or distribute this software for any purpose", "isc"),
)
#: Words on which the licence hangs.
TELLING = frozenset("by sa nd nc sharealike noderivatives noderivs noncommercial lesser affero".split())
_BETWEEN = re.compile(rb"[^0-9a-z\x80-\xff]+")
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def errors(length: int) -> int:
    return max(1, length // 12)


def split(notice: str) -> list[tuple[int, str]]:
    """(offset, piece): one piece more than edits are allowed."""
    n = errors(len(notice)) + 1
    cuts = [round(i * len(notice) / n) for i in range(n + 1)]
    return [(a, notice[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


@lru_cache(maxsize=1)
def searcher():
    import ahocorasick
    import regex

    seeds: dict[str, list[tuple[int, int]]] = {}
    for i, (notice, _) in enumerate(NOTICES):
        for offset, piece in split(notice):
            seeds.setdefault(piece, []).append((i, offset))
    automaton = ahocorasick.Automaton()
    for piece, uses in seeds.items():
        automaton.add_word(piece, (len(piece), uses))
    automaton.make_automaton()
    patterns = [regex.compile(f"(?e)(?:{regex.escape(n, literal_spaces=True)}){{e<={errors(len(n))}}}") for n, _ in NOTICES]
    return automaton, patterns


def near_ends(notice: str, words: str, lo: int, hi: int) -> Iterator[tuple[int, int]]:
    """Runs (first, last) of places in words[lo:hi] at which a spelling of the notice within its edits ends.

    Edit distances to all beginnings at once in the bits of an integer, one step a character:
    it keeps the regex library, whose cost is steep in the edits, from stretches without a match.
    """
    full, top, most = (1 << len(notice)) - 1, 1 << (len(notice) - 1), errors(len(notice))
    equal: dict[str, int] = {}
    for j, c in enumerate(notice):
        equal[c] = equal.get(c, 0) | 1 << j
    more, less, score, first = full, 0, len(notice), None
    for at in range(lo, hi):
        eq = equal.get(words[at], 0)
        same = (((eq & more) + more) ^ more) | eq
        up, down = (less | ~(same | more)) & full, more & same
        score += bool(up & top) - bool(down & top)
        up, down, cross = up << 1 & full, down << 1 & full, eq | less
        more, less = (down | ~(cross | up)) & full, up & cross
        if score <= most:
            first = at + 1 if first is None else first
        elif first is not None:
            yield first, at
            first = None
    if first is not None:
        yield first, hi


def fuzzy(words: str) -> list[tuple[int, int, int, int]]:
    """(notice, start, end, edits) of verified notices in a reduced text."""
    automaton, patterns = searcher()
    windows: dict[int, list[list[int]]] = {}
    for last, (size, uses) in automaton.iter(words):
        for i, offset in uses:
            length = len(NOTICES[i][0])
            slack = errors(length)
            lo = max(0, last - size + 1 - offset - slack)
            hi = last - size + 1 - offset + length + slack
            of = windows.setdefault(i, [])
            if of and lo <= of[-1][1] and of[-1][0] <= lo:
                of[-1][1] = max(hi, of[-1][1])
            else:
                of.append([lo, hi])
    found = set()
    for i, of in windows.items():
        notice, done = NOTICES[i][0], 0
        reach = len(notice) + errors(len(notice))
        for lo, hi in sorted(of):
            for first, last in near_ends(notice, words, lo, min(hi, len(words))):
                at = max(0, done, first - reach)
                for m in patterns[i].finditer(words[at:last]):
                    if m.end() > m.start():
                        found.add((i, at + m.start(), at + m.end(), sum(m.fuzzy_counts)))
                        done = max(done, at + m.end())
    return sorted(found)


def telling(words: str) -> list[str]:
    return [w for w in words.split(" ") if w in TELLING]


def nearest(notices: list[tuple[str, int, int, int]]) -> list[tuple[str, int, int, int]]:
    """The notices (label, first word, last word, edits) that no nearer one of another licence overlaps."""
    out: list[tuple[str, int, int, int]] = []
    together: list[tuple[str, int, int, int]] = []      # a stretch of notices that overlap in a row
    reach = -1
    for notice in [*sorted(notices, key=lambda n: (n[1], n)), ("", 1 << 62, 1 << 62, 0)]:
        if notice[1] > reach:
            kept: list[tuple[str, int, int, int]] = []
            for label, a, b, e in sorted(together, key=lambda n: (n[3], n[1] - n[2], n)):
                if all(b < c or d < a or label == other for other, c, d, _ in kept):
                    kept.append((label, a, b, e))
            out += sorted(kept, key=lambda n: (n[1], n))
            together = []
        together.append(notice)
        reach = max(reach, notice[2])
    return out


def scan(text: bytes) -> tuple[int, list[tuple[int, str]], list[tuple[str, int, int, int]]]:
    """(words, [(first word, label) of phrases], [(label, first word, last word, edits) of notices])."""
    words = _BETWEEN.sub(b" ", text.lower()).strip(b" ")
    if not words:
        return 0, [], []
    padded = b" " + words + b" "
    blanks = np.flatnonzero(np.frombuffer(padded, np.uint8) == 32)
    number = lambda byte: int(np.searchsorted(blanks, byte + 1, "right")) - 1  # noqa: E731  of the word with this byte of ``words``
    places = []
    for phrase, label in PHRASES:
        at = padded.find(b" " + phrase + b" ")
        while at >= 0:
            places.append((number(at), label))
            at = padded.find(b" " + phrase + b" ", at + 1)
    notices = []
    for i, a, b, e in fuzzy(words.decode("latin-1")):
        first, last = number(a + (words[a:a + 1] == b" ")), number(max(a, b - 1 - (words[b - 1:b] == b" ")))
        spelt = padded[blanks[first] + 1:blanks[last + 1]].decode("latin-1")      # whole words
        if telling(spelt) == telling(NOTICES[i][0]):
            notices.append((NOTICES[i][1], first, last, e))
    return words.count(b" ") + 1, sorted(places), nearest(notices)


def spans(text: bytes, notices: list[tuple[str, int, int, int]]) -> str:
    """label:start:end:edits in code points of the text."""
    at = [m.span() for m in _WORD.finditer(text.lower())]
    points = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
    point = points.__getitem__
    return ",".join(f"{label}:{point(at[a][0])}:{point(at[b][1])}:{e}" for label, a, b, e in sorted(notices, key=lambda n: (n[1], n)))


NAMES = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in tb.blocks(batch):
            out = []
            for a, b in zip(block.bounds[:-1], block.bounds[1:], strict=True):
                text = block.buf[a:b].tobytes()
                n, places, notices = scan(text)
                base = sorted({label for _, label in places})
                both = sorted({*base, *(label for label, *_ in notices)})
                near = max((1 - e / (1 + last - first + 2) for _, first, last, e in notices), default=0.0)
                out.append((n, len(places), places[0][0] if places else None, places[-1][0] if places else None, ",".join(base),
                            ",".join(both), float(min(1.0, max(0.0, 1.0 if base else near))), spans(text, notices) if notices else ""))
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.string()]
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
            yield pa.RecordBatch.from_arrays([block.rows.column("doc_id"), *columns], NAMES)


def license_labels(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans of every document."""
    docs = docs.select("doc_id", "text")
    return map_arrow(docs, _rows, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words long, n_base long, first_word long, "
                                  "last_word long, base_labels string, labels string, score double, spans string")
