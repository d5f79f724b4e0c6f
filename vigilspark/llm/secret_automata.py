"""Secret scans: fixed patterns, and probabilistic automata inferred from labelled credentials.

For each labelled format the samples' common beginning is kept as it is; the rest, as
character kinds, becomes a prefix tree whose states are merged while their outcomes agree
within Hoeffding's bound (state merging after ALERGIA).  The automata, with the lengths that
were seen, give the likelihood of a string under each format.  All candidate tokens outside the
patterns' spans are scored against a model of ordinary long tokens: character kinds by the two
before, learnt from drawn identifiers, codes and paths and from the distinct long tokens (up to
``LONGEST`` characters) of all documents.  Their kinds are counted and their scores binned where the
tokens lie: counts and bins, bounded by the alphabet and the margin's range, reach the driver.  Tokens
that some format explains better by the margin are added.  The margin is ``MARGIN`` nats, or more
where more than one ordinary token in a thousand would pass.  The patterns' spans always stay; of a
candidate that touches one, the parts outside are scored on their own.

Null and empty texts have no spans.  Positions are code points, ends exclusive.  One result per
input row, repeated rows included; an empty table gives none; other columns are never read.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from . import textblocks as tb
from .shipping import map_arrow

KINDS = ("assign", "access", "hex", "token")
MARGIN = 6.0
MIN_LENGTH, LONGEST = 16, 200
BINS = 1000                              # bins of a nat for the margin
_ASSIGN = re.compile(rb"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE)
_ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX = re.compile(rb"(?<![0-9a-f])[0-9a-f]{16,}")
_CANDIDATE = re.compile(rb"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_=-][A-Za-z0-9+/_.=-]{%d,}[A-Za-z0-9+/_=-]" % (MIN_LENGTH - 2))


def base_spans(text: bytes) -> list[tuple[int, int, int]]:
    """(start, kind, end) in bytes, by start, then kind."""
    spans = []
    low = text.lower()
    if any(w in low for w in _ASSIGN_WORDS):
        spans += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 12]
    spans += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= 18]
    spans += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(spans)


# ---- labelled strings

_UPPER, _LOWER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
#: format -> parts: literal text, or (alphabet, length)
FORMATS = {
    "access_id": ["ASIA", (_UPPER + _DIGITS, 16)],
    "personal_token": ["ghp_", (_UPPER + _LOWER + _DIGITS, 36)],
    "chat_token": ["xoxb-", (_DIGITS, 11), "-", (_DIGITS, 12), "-", (_UPPER + _LOWER + _DIGITS, 24)],
    "payment_key": ["sk_live_", (_UPPER + _LOWER + _DIGITS, 24)],
    "map_key": ["AIza", (_UPPER + _LOWER + _DIGITS + "_-", 35)],
    "web_token": ["eyJ", (_UPPER + _LOWER + _DIGITS, 17), ".eyJ", (_UPPER + _LOWER + _DIGITS, 24), ".", (_UPPER + _LOWER + _DIGITS + "_-", 43)],
    "base64_key": [(_UPPER + _LOWER + _DIGITS + "/+", 40)],
    "padded_key": [(_UPPER + _LOWER + _DIGITS + "/+", 43), "="],
    "upper_hex": [("ABCDEF" + _DIGITS, 32)],
}


def labelled(copies: int = 60, seed: int = 5) -> list[tuple[str, str]]:
    """(format, credential): strings drawn by the formats' rules."""
    rng = np.random.default_rng(seed)
    return [(name, "".join(p if isinstance(p, str) else "".join(rng.choice(list(p[0]), p[1])) for p in parts))
            for name, parts in FORMATS.items() for _ in range(copies)]


def ordinary(copies: int = 1400, seed: int = 6) -> list[str]:
    """Long tokens that are no credentials: compounds, slugs, paths, hosts, file names, numbers."""
    rng = np.random.default_rng(seed)
    syllables = "an en er on in at es re th nd st ti ou ha ng ed or it is ar te se de la qui que ment tion heit ung sch eau aux ción".split()
    word = lambda n: "".join(rng.choice(syllables, n)).encode("ascii", "ignore").decode()
    of = lambda letters, *n: "".join(rng.choice(list(letters), rng.choice(n)))
    names = lambda n, sep, case: sep.join(case(word(int(rng.integers(1, 4)))) for _ in range(n))
    several = lambda: int(rng.integers(3, 8))
    hexes = "0123456789abcdef"
    kinds = [lambda: word(9), lambda: word(7).capitalize(), lambda: names(4, "-", str), lambda: names(5, "/", str),
             lambda: f"www.{word(4)}.com/{word(3)}/{rng.integers(1, 9999)}", lambda: names(several(), "_", str), lambda: word(8).upper(),
             lambda: names(several(), "", str.capitalize), lambda: word(2) + names(several(), "", str.capitalize),
             lambda: f"{rng.integers(1990, 2030)}-{rng.integers(10, 13)}-{word(4)}-{word(2)}",
             lambda: names(several(), "_", str.upper), lambda: of(_UPPER + _DIGITS, 16, 18, 20, 24, 28), lambda: of(_UPPER + _DIGITS, 16, 20, 24, 32),
             lambda: f"{of(_UPPER, 2, 3)}-{of(_DIGITS, 6, 8, 12)}-{of(_DIGITS, 4, 6)}", lambda: "-".join(of(hexes, n) for n in (8, 4, 4, 4, 12)),
             lambda: "-".join(of(hexes, n).upper() for n in (8, 4, 4, 4, 12)), lambda: names(4, ".", str) + "." + word(1),
             lambda: names(3, "/", str) + "/" + names(2, "", str.capitalize) + ".java", lambda: names(3, "-", str) + "-" + of(_DIGITS, 2, 4),
             lambda: of(_DIGITS + ".-", 18), lambda: "=" * 20, lambda: "-" * 24, lambda: "..." + word(7)]
    return [kinds[i % len(kinds)]() for i in range(copies)]


# ---- automata

def _kind(c: str) -> str:
    if "0" <= c <= "9":
        return "d"
    if "A" <= c <= "F":
        return "H"
    if "G" <= c <= "Z":
        return "U"
    if "a" <= c <= "f":
        return "h"
    if "g" <= c <= "z":
        return "l"
    return c


_SIZE = {"d": 10, "H": 6, "U": 20, "h": 6, "l": 20}


@dataclass
class State:
    n: int = 0
    ends: int = 0
    to: dict[str, int] = field(default_factory=dict)
    by: dict[str, int] = field(default_factory=dict)     # how often each symbol was taken


class Automaton:
    """A prefix tree of symbol strings, merged into a probabilistic automaton."""

    def __init__(self, strings: list[str], alpha: float = 0.05):
        self.states = [State()]
        for s in strings:
            at = 0
            self.states[0].n += 1
            for c in s:
                here = self.states[at]
                if c not in here.to:
                    here.to[c] = len(self.states)
                    self.states.append(State())
                here.by[c] = here.by.get(c, 0) + 1
                at = here.to[c]
                self.states[at].n += 1
            self.states[at].ends += 1
        self._bound = math.sqrt(0.5 * math.log(2 / alpha))
        self._merge()

    def _differ(self, f1: int, n1: int, f2: int, n2: int) -> bool:
        return abs(f1 / n1 - f2 / n2) > self._bound * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))

    def _compatible(self, a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            x, y = (self.states[i] for i in todo.pop())
            if self._differ(x.ends, x.n, y.ends, y.n):
                return False
            for c in x.by.keys() | y.by.keys():
                if self._differ(x.by.get(c, 0), x.n, y.by.get(c, 0), y.n):
                    return False
                if c in x.to and c in y.to:
                    todo.append((x.to[c], y.to[c]))
        return True

    def _fold(self, a: int, b: int) -> None:
        """Pour the tree below b into a."""
        todo = [(a, b)]
        while todo:
            i, j = todo.pop()
            x, y = self.states[i], self.states[j]
            x.n += y.n
            x.ends += y.ends
            for c, k in y.to.items():
                x.by[c] = x.by.get(c, 0) + y.by[c]
                if c in x.to:
                    todo.append((x.to[c], k))
                else:
                    x.to[c] = k

    def _merge(self) -> None:
        red = [0]
        while True:
            blue = next(((r, c) for r in red for c in sorted(self.states[r].to) if self.states[r].to[c] not in red), None)
            if blue is None:
                return
            parent, symbol = blue
            b = self.states[parent].to[symbol]
            same = next((r for r in red if self._compatible(r, b)), None)
            if same is None:
                red.append(b)
            else:
                self.states[parent].to[symbol] = same
                self._fold(same, b)

    def log_likelihood(self, symbols: str, miss: float = 1e-4) -> float:
        total, at = 0.0, 0
        for c in symbols:
            s = self.states[at]
            total += math.log((s.by.get(c, 0) + miss) / (s.n + 1))
            if c not in s.to:
                return total + math.log(miss) * (1 + len(symbols) / 8)
            at = s.to[c]
        s = self.states[at]
        return total + math.log((s.ends + miss) / (s.n + 1))


class Background:
    """Character kinds by the two before them, smoothed by those by the one before."""

    def __init__(self, strings: list[str]):
        self.counts: dict = defaultdict(int)
        self.totals: dict = defaultdict(int)
        for s in strings:
            self.add(s)

    def add(self, symbols: str) -> None:
        for a, b, c in zip("^^" + symbols, "^" + symbols, symbols + "$", strict=False):
            for context in (a + b, b):
                self.count(context, c, 1)

    def count(self, context: str, symbol: str, n: int) -> None:
        self.counts[context, symbol] += n
        self.totals[context] += n

    def log_likelihood(self, symbols: str) -> float:
        total = 0.0
        for a, b, c in zip("^^" + symbols, "^" + symbols, symbols + "$", strict=False):
            one = (self.counts.get((b, c), 0) + 0.2) / (self.totals.get(b, 0) + 3)
            total += math.log((self.counts.get((a + b, c), 0) + 2 * one) / (self.totals.get(a + b, 0) + 2))
        return total


@dataclass
class Model:
    formats: dict[str, tuple[str, Automaton, dict[int, float]]]     # common beginning, automaton of the rest, log share of each length
    background: Background
    margin: float = MARGIN

    def score(self, token: str) -> tuple[float, str]:
        """(nats by which the best format explains the token better than ordinary tokens do, the format)."""
        kinds = "".join(map(_kind, token))
        plain = self.background.log_likelihood(kinds)
        best = (-math.inf, "")
        for name, (head, automaton, lengths) in self.formats.items():
            if token.startswith(head) and len(token) > len(head):
                literal = sum(math.log(_SIZE.get(k, 1)) for k in kinds[:len(head)])
                length = lengths.get(len(token), math.log(1e-6))
                best = max(best, (automaton.log_likelihood(kinds[len(head):]) + literal + length - plain, name))
        return best

    def headed(self, token: str) -> bool:
        """Whether the token begins as a labelled format does."""
        return any(len(head) > 2 and token.startswith(head) for head, *_ in self.formats.values())


@lru_cache(maxsize=1)
def formats() -> dict:
    samples = defaultdict(list)
    for name, s in labelled():
        samples[name].append(s)
    out = {}
    for name, strings in samples.items():
        head = strings[0]
        for s in strings[1:]:
            while not s.startswith(head):
                head = head[:-1]
        lengths = {n: math.log(sum(len(s) == n for s in strings) / len(strings)) for n in {len(s) for s in strings}}
        out[name] = head, Automaton(["".join(map(_kind, s[len(head):])) for s in strings]), lengths
    return out


def train(tokens: tuple[str, ...] = ()) -> Model:
    """The automata, and the model of ordinary tokens with ``tokens`` (of documents) among them."""
    model = Model(formats(), Background([]))
    plain = [*ordinary(), *(t for t in tokens if not model.headed(t))]
    model.background = Background(["".join(map(_kind, s)) for s in plain])
    # calibrated on tokens that were not learnt from: drawn anew, and every other document token by a model of the rest
    held = Model(model.formats, Background(["".join(map(_kind, s)) for s in [*ordinary(), *plain[::2]]]))
    scores = sorted(held.score(s)[0] for s in [*ordinary(seed=16), *plain[1::2]] if len(s) >= MIN_LENGTH)
    if scores:
        model.margin = min(max(MARGIN, scores[int(0.999 * (len(scores) - 1))]), 4 * MARGIN)
    return model


def document_tokens(docs: DataFrame) -> DataFrame:
    """(token): distinct candidates outside the patterns' spans in all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in tb.blocks(batch):
                found = set()
                for lo, hi in zip(block.bounds[:-1], block.bounds[1:], strict=True):
                    text = block.buf[lo:hi].tobytes()
                    found |= {t.decode() for _, _, t in _candidates(text, base_spans(text)) if len(t) <= LONGEST}
                yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.string())], ["token"])

    return map_arrow(docs.select("text"), run, "token string").distinct()


def long_tokens(docs: DataFrame) -> tuple[str, ...]:
    """The same tokens in a fixed order, to look at or to pass to :func:`train`; :func:`train_on` brings none here."""
    return tuple(r["token"] for r in document_tokens(docs).orderBy(F.xxhash64("token"), "token").collect())


def train_on(docs: DataFrame) -> Model:
    """The automata, and the model of ordinary tokens with those of all documents among them."""
    model = Model(formats(), Background([]))
    tokens = stored(document_tokens(docs), "long-tokens")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        halves = Background([]), Background([])
        for batch in batches:
            for token in batch.column("token").to_pylist():
                if not model.headed(token):
                    halves[zlib.crc32(token.encode()) & 1].add("".join(map(_kind, token)))
        rows = [(half, context, c, n) for half, found in enumerate(halves) for (context, c), n in found.counts.items()]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True) if rows else [[]] * 4, (
            pa.int32(), pa.string(), pa.string(), pa.int64()), strict=True)], ["half", "context", "symbol", "n"])

    met = map_arrow(tokens, counted, "half int, context string, symbol string, n long").groupBy("half", "context", "symbol").agg(F.sum("n").alias("n"))
    drawn = ["".join(map(_kind, s)) for s in ordinary()]
    model.background, held = Background(drawn), Model(model.formats, Background(drawn))
    for half, context, symbol, n in met.collect():
        model.background.count(context, symbol, n)
        if half == 0:
            held.background.count(context, symbol, n)

    # calibrated on tokens that were not learnt from: drawn anew, and one half of the documents' by a model of the other
    low, high = int(MARGIN * BINS), int(4 * MARGIN * BINS)
    place = lambda token: min(max(math.floor(held.score(token)[0] * BINS), low), high)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins: dict[int, int] = defaultdict(int)
        for batch in batches:
            for token in batch.column("token").to_pylist():
                if zlib.crc32(token.encode()) & 1 and not model.headed(token):
                    bins[place(token)] += 1
        yield pa.RecordBatch.from_arrays([pa.array(bins.keys(), pa.int32()), pa.array(bins.values(), pa.int64())], ["bin", "n"])

    bins = defaultdict(int, map(tuple, map_arrow(tokens, scored, "bin int, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect()))
    for s in ordinary(seed=16):
        if len(s) >= MIN_LENGTH:
            bins[place(s)] += 1
    above = int(0.999 * (sum(bins.values()) - 1))
    for at in sorted(bins):
        if above < bins[at]:
            model.margin = at / BINS
            break
        above -= bins[at]
    return model


def _candidates(text: bytes, base: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, bytes]]:
    """(start, end, token) of candidates, cut where a pattern's span touches them."""
    starts = [b[0] for b in base]
    reach = list(accumulate((b[2] for b in base), max, initial=-1))
    for m in _CANDIDATE.finditer(text):
        if reach[bisect_left(starts, m.end())] <= m.start():
            yield m.start(), m.end(), m[0]
            continue
        at = m.start()
        touching = base[max(0, bisect_right(reach, m.start()) - 1):bisect_left(starts, m.end())]
        for a, _, b in [s for s in touching if s[2] > m.start()] + [(m.end(), 0, m.end())]:
            rest = _CANDIDATE.fullmatch(text[at:max(a, at)].strip(b".=-/"))
            if rest:
                begin = text.index(rest[0], at)
                yield begin, begin + len(rest[0]), rest[0]
            at = max(at, b)


def added_spans(text: bytes, base: list[tuple[int, int, int]], model: Model, known: dict[bytes, bool]) -> list[tuple[int, int, int]]:
    spans = []
    for start, end, token in _candidates(text, base):
        good = known.get(token)
        if good is None:
            good = model.score(token.decode())[0] >= model.margin
            if len(known) < 100_000 and len(token) < 100:     # a memory of scores, not of results
                known[token] = good
        if good:
            spans.append((start, 3, end))
    return spans


NAMES = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_added"]


def find(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_added of every document."""
    model = model or train_on(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, bool] = {}
        for batch in batches:
            for block in tb.blocks(batch):
                out = []
                for lo, hi in zip(block.bounds[:-1], block.bounds[1:], strict=True):
                    text = block.buf[lo:hi].tobytes()
                    base = base_spans(text)
                    more = added_spans(text, base, model, known)
                    if base or more:
                        points = np.zeros(len(text) + 1, np.int64)
                        np.cumsum((block.buf[lo:hi] & 0xC0) != 0x80, out=points[1:])
                    told = lambda spans: ",".join(f"{KINDS[k]}:{points[a]}:{points[b]}" for a, k, b in spans)  # noqa: B023, E731
                    out.append((*(sum(k == kind for _, k, _ in base) for kind in range(3)),
                                hashlib.sha256(told(base).encode()).hexdigest(), told(sorted(base + more)), len(more)))
                types = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
                yield pa.RecordBatch.from_arrays([block.rows.column("doc_id"), *(pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True))], NAMES)

    docs = docs.select("doc_id", "text")
    return map_arrow(docs, run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_assign long, n_access long, n_hex long, "
                                "base_sha256 string, spans string, n_added long")
