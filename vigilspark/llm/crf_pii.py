"""Personal data: fixed patterns, and a linear-chain conditional random field that adds spans.

The patterns find e-mail and IP addresses, card numbers (Luhn) and international phone
numbers.  The field labels the words of every sentence of every whole text from the shapes
of the word and its neighbours and the words before it; it is trained on a small labelled
table (``labelled``), cut into sentences like any text, and decoded by Viterbi over all sentences
of a block at once.  A state of its own begins a value right behind another of its kind.  Its
spans are added from the words that no pattern's span touches, where they can be what they are
called (``plausible``: digits of a phone, Luhn sum of a card); none is taken away.

Null and empty texts have no spans.  Sentences end at line ends and after . ! ?, but not between
a short abbreviation and a number ("no. 12"), and have no length limit.  Positions are code
points, ends exclusive.  One result per input row, repeated rows included; an empty table gives
none; ``find`` reads no other columns and ``mask`` keeps them.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textblocks as tb
from .shipping import map_arrow

KINDS = ("email", "ip", "card", "phone", "id")
#: A value's words, and the first word of a value that follows one of its kind at once.
STATES = ("O", *KINDS, *(f"{k}^" for k in KINDS))

# ---- patterns, over UTF-8 bytes: all of their characters are ASCII

_DOMAIN = re.compile(rb"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = tb.byte_set(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(rb"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(rb"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(rb"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(rb"[^0-9]")


def _emails(text: bytes) -> Iterator[tuple[int, int]]:
    """Matches of the pattern from left to right, each @ looked at once."""
    free = 0
    at = text.find(b"@")
    while at >= 0:
        start = at
        while start > free and _LOCAL[text[start - 1]]:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            free = domain.end()
        at = text.find(b"@", max(at + 1, free))


def luhn(digits: bytes) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = (c - 48) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: bytes) -> list[tuple[int, int, int]]:
    """(start, kind, end) in bytes, by start, then kind."""
    spans = [(a, 0, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip(b"0")) <= 3 and int(p[-3:]) <= 255 for p in m.groups()):
            spans.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub(b"", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            spans.append((m.start(), 2, m.end()))
    if b"+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGIT.sub(b"", m[0])) <= 15:
                spans.append((m.start(), 3, m.end()))
    return sorted(spans)


# ---- the labelled table

_FILL = ("the of and to in please we our was with for this that is on at house water since many early paper der die und mit von "
         "haus wasser le la les des et pour maison el los del que con una casa").split()
#: Sentences with {kind} where personal data stands; {x} is anything else with digits.
_TEMPLATES = """
call me at {phone} today
tel. {phone}
phone: {phone}
my phone number is {phone} , thanks
you can reach us on {phone} or by mail
mobile {phone} office {phone}
fax {phone}
Telefon {phone} erreichbar
téléphone : {phone}
llame al teléfono {phone} por favor
write to {email} for details
contact {email} or call {phone}
mail {email}
write to {email} please
her address is {email} since may
the host {ip} did not answer
connect to {ip} port {x}
ip address {ip}
my credit card number is {card}
card {card} expires {x}
visa {card}
Kreditkarte {card}
numéro de carte {card}
tarjeta {card}
paid with card no. {card} yesterday
ssn {id}
her social security number is {id}
{phone} {phone}
my phones are {phone} {phone}
numbers {phone} {phone} {phone}
office {phone} {phone} home
{card} {card}
cards {card} {card} on file
card {card} phone {phone}
IBAN {id}
passport no. {id}
passport {id}
card no. {card}
tel. {phone} or {phone}
in {x} the of and {x}
in {year} {year} and {year} it grew
{year} {year} {year}
the sums {few} {few} {few} grew
rows {few} {few} and {few}
{few} {few} {few} {few}
{one} {one} {one} {one} {one} {one} {one} {few}
steps {one} {one} {one} {one}
scores {x} {few} {x} {few}
no. {few} of {x}
fig. {x} and {x}
vol. {few} no. {few} pp. {few}
isbn {isbn}
invoice no. {invoice} of {x}
order {invoice} shipped
version {x} of the text
on {x} we met
about {x} people came
page {x} and {x}
it cost {x} in all
chapter {x} section {x}
between {x} and {x}
build {x} failed
token = "{hex}" the end
key {hex}
the sum {x} was {x} of {x}
order {long} was sent
number {long}
the {long} of and
released under license version {x}
word {long} word {x}
the of and to in was with
READ THIS NOW!! TODAY ONLY!!
*** $$$ %%% ###
one | two | three | four
""".strip().splitlines()


def labelled(copies: int = 12, seed: int = 7) -> list[tuple[str, list[int]]]:
    """Labelled sentences: (text, state of each word), from the templates with drawn values."""
    rng = np.random.default_rng(seed)
    number = lambda *n: "".join(map(str, rng.integers(0, 10, rng.choice(n))))
    name = lambda: "".join(rng.choice(list("abcdeilmnorstu"), rng.integers(3, 9)))
    pick = lambda *options: options[rng.integers(len(options))]()
    hexes = lambda n: "".join(rng.choice(list("0123456789abcdef"), n))
    fill = lambda: " ".join(rng.choice(_FILL, rng.integers(0, 5)))
    draw = {
        "phone": lambda: pick(lambda: f"({number(3)}) {number(3)}-{number(4)}", lambda: f"{number(3)}-{number(3)}-{number(4)}",
                              lambda: f"0{number(2, 3)} {number(6, 7)}", lambda: f"0{number(3)}/{number(6, 7)}",
                              lambda: f"+{number(2)} {number(3)} {number(3)} {number(4)}", lambda: f"+1 ({number(3)}) {number(3)}-{number(4)}",
                              lambda: f"{number(3)}.{number(3)}.{number(4)}", lambda: f"{number(2)} {number(2)} {number(2)} {number(2)} {number(2)}"),
        "email": lambda: pick(lambda: f"{name()}.{name()}@{name()}.com", lambda: f"{name()}{number(2)}@{name()}.co.uk",
                              lambda: f"<{name()}@{name()}.org>", lambda: f"{name()}(at){name()}.com", lambda: f"{name()}[at]{name()}.org",
                              lambda: f"{name()}@{name()}"),
        "ip": lambda: pick(lambda: f"{number(2, 3)}.{number(1, 2)}.{number(1, 2)}.{number(2)}",
                           lambda: f"{hexes(4)}:{hexes(4)}::{hexes(4)}", lambda: ":".join(hexes(4) for _ in range(8))),
        "card": lambda: pick(lambda: " ".join(number(4) for _ in range(4)), lambda: "-".join(number(4) for _ in range(4)),
                             lambda: number(16), lambda: ".".join(number(4) for _ in range(4)), lambda: "/".join(number(4) for _ in range(4)),
                             lambda: f"{number(4)} {number(6)} {number(5)}"),
        "id": lambda: pick(lambda: f"{number(3)}-{number(2)}-{number(4)}", lambda: f"DE{number(20)}", lambda: f"{name()[:1].upper()}{number(8)}"),
        "x": lambda: pick(lambda: number(1, 2, 3, 4), lambda: f"20{number(2)}-{number(2)}-{number(2)}", lambda: f"{number(1)}.{number(1)}",
                          lambda: f"{number(1)},{number(3)}.{number(2)}", lambda: f"{number(2)}:{number(2)}", lambda: f"19{number(2)}",
                          lambda: f"{number(1)}.{number(1)}.{number(2)}", lambda: f"{number(2)}-{number(2)}", lambda: f"{number(2)}%",
                          lambda: f"{name()}{number(1, 2)}", lambda: f"{number(1)}-{number(1)}"),
        "year": lambda: f"{rng.choice(['19', '20'])}{number(2)}", "few": lambda: number(2, 3, 3, 4), "one": lambda: number(1, 1, 2),
        "isbn": lambda: pick(lambda: f"978-{number(1)}-{number(4)}-{number(4)}-{number(1)}", lambda: f"978{number(10)}", lambda: f"{number(1)}-{number(4)}-{number(4)}-{number(1)}"),
        "invoice": lambda: pick(lambda: f"{number(4)}-{number(4, 6)}", lambda: f"R{number(5)}", lambda: f"{number(3)}/{number(4)}", lambda: f"20{number(2)}/{number(4)}"),
        "hex": lambda: hexes(rng.choice([16, 32, 40])),
        "long": lambda: number(7, 9, 10, 13, 15, 16, 17),
    }
    out = []
    for template in _TEMPLATES:
        for _ in range(copies):
            parts, states = [], []
            for word in f"{fill()} {template} {fill()}".split():
                found = re.search(r"\{(\w+)\}", word)
                value = word.replace(found[0], draw[found[1]]()) if found else word
                kind = STATES.index(found[1]) if found and found[1] in KINDS else 0
                again = kind and states and (states[-1] - kind) % len(KINDS) == 0 and states[-1]
                parts += value.split()
                states += [kind + len(KINDS) if again else kind] + [kind] * (len(value.split()) - 1)
            out.append((" ".join(parts), states))
    return out


# ---- the field

_DIGIT = tb.byte_set(b"0123456789")
_EDGE = tb.byte_set(b".,;:!?\"'<>[]{}|*#$%&=")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_TABLE_BITS = 20


@dataclass
class Sentences:
    """Words of a block, cut into sentences."""

    words: tb.Words
    first: np.ndarray    # sentence s is words first[s]:first[s + 1]


def sentences(block: tb.Block) -> Sentences:
    w = tb.words(block, tb.NOT_SPACE)
    n = len(w.start)
    if not n:
        return Sentences(w, np.zeros(1, np.int64))
    ends = np.isin(block.buf[w.end - 1], list(b".!?"))
    lines = np.zeros(len(block.buf) + 1, np.int32)
    np.cumsum(block.buf == 10, out=lines[1:])
    digits = np.zeros(len(block.buf) + 1, np.int32)
    np.cumsum(_DIGIT[block.buf], out=digits[1:])
    numeric = digits[w.end] > digits[w.start]
    short = (w.end - w.start <= 5) & ~numeric & (block.buf[w.end - 1] == ord("."))
    ends[:-1] &= ~(short[:-1] & numeric[1:])
    cut = np.ones(n, bool)
    cut[1:] = ends[:-1] | (w.doc[1:] != w.doc[:-1]) | (lines[w.start[1:]] != lines[w.end[:-1]])
    return Sentences(w, np.append(np.flatnonzero(cut), n))


def features(block: tb.Block, s: Sentences) -> np.ndarray:
    """64-bit feature hashes, one row per word."""
    w, n = s.words, len(s.words.start)
    shape = tb.shape_bytes(block.buf)
    full = tb.range_hash(tb.prefix_sums(shape), w.start, w.end)
    short = tb.shape_hashes(block, w)
    end = w.end - _EDGE[block.buf[w.end - 1]]
    end = np.maximum(end, w.start + 1)
    word = tb.range_hash(tb.prefix_sums(_LOWER[block.buf]), w.start, end)
    digits = np.zeros(len(block.buf) + 1, np.int32)
    np.cumsum(_DIGIT[block.buf], out=digits[1:])
    digits = (digits[w.end] - digits[w.start]).astype(np.uint64)
    sentence = np.repeat(np.arange(len(s.first) - 1), np.diff(s.first))

    def at(values, shift):
        """The value ``shift`` words on in the sentence, or 1."""
        out = np.ones(n, np.uint64)
        if shift > 0:
            same = sentence[shift:] == sentence[:-shift]
            out[:-shift][same] = values[shift:][same]
        else:
            same = sentence[-shift:] == sentence[:shift]
            out[-shift:][same] = values[:shift][same]
        return out

    columns = [short, full, at(short, -1), at(short, 1), at(word, -1), at(word, -2), tb.mix(np.minimum(digits, 20) + tb.U64(99)),
               tb.pair_hash(at(short, -1), short), tb.pair_hash(short, at(short, 1)), tb.pair_hash(at(word, -1), short)]
    return np.stack([tb.mix(c + tb.U64(k * 0x9E37)) for k, c in enumerate(columns)], axis=1)


@dataclass
class Model:
    keys: np.ndarray       # feature hash of each row of weights; row 0 is for unknown features
    weights: np.ndarray    # rows x states
    moves: np.ndarray      # from state x to state
    starts: np.ndarray

    def rows(self, hashes: np.ndarray) -> np.ndarray:
        if not hasattr(self, "_slots"):
            self._slots = np.zeros(1 << _TABLE_BITS, np.int32)
            self._slots[(self.keys[1:] >> np.uint64(64 - _TABLE_BITS))] = np.arange(1, len(self.keys))
        at = self._slots[hashes >> np.uint64(64 - _TABLE_BITS)]
        return np.where(self.keys[at] == hashes, at, 0)

    def scores(self, hashes: np.ndarray) -> np.ndarray:
        out = np.zeros((len(hashes), len(self.starts)), np.float32)
        for k in range(hashes.shape[1]):
            out += self.weights[self.rows(hashes[:, k])]
        return out


def text_block(texts: list[str]) -> tb.Block:
    raw = [t.encode() for t in texts]
    return tb.Block(None, np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in raw])]))


def train(table: list[tuple[str, list[int]]] | None = None, rounds: int = 90, l2: float = 0.02, rate: float = 0.2) -> Model:
    """Maximum likelihood with an L2 term, by Adam over all sentences at once."""
    table = table or labelled()
    block = text_block([t for t, _ in table])
    s = sentences(block)          # as they are cut when texts are decoded
    w = s.words
    hashes = features(block, s)
    keys = np.concatenate([[np.uint64(0)], np.unique(hashes)])
    # one feature to a slot
    _, first = np.unique(keys[1:] >> np.uint64(64 - _TABLE_BITS), return_index=True)
    keys = np.concatenate([keys[:1], keys[1:][first]])
    S, n = len(STATES), len(s.first) - 1
    model = Model(keys, np.zeros((len(keys), S)), np.zeros((S, S)), np.zeros(S))
    rows = model.rows(hashes)
    length = np.diff(s.first)
    T = int(length.max())
    place = np.full((n, T), -1)
    for i in range(n):
        place[i, :length[i]] = np.arange(s.first[i], s.first[i + 1])
    real = place >= 0
    y = np.concatenate([np.asarray(v) for _, v in table])
    yy = np.where(real, y[place], 0)
    truth = np.eye(S)[y]
    params = [model.weights, model.moves, model.starts]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    soft = lambda x, axis: (top := x.max(axis, keepdims=True)).squeeze(axis) + np.log(np.exp(x - top).sum(axis))
    for step in range(1, rounds + 1):
        emit = model.weights[rows].sum(axis=1)
        e = np.where(real[..., None], emit[place], 0.0)
        alpha, beta = np.zeros((T, n, S)), np.zeros((T, n, S))
        alpha[0] = model.starts + e[:, 0]
        for t in range(1, T):
            new = soft(alpha[t - 1][:, :, None] + model.moves, 1) + e[:, t]
            alpha[t] = np.where(real[:, t, None], new, alpha[t - 1])
        for t in range(T - 2, -1, -1):
            new = soft(model.moves + (e[:, t + 1] + beta[t + 1])[:, None, :], 2)
            beta[t] = np.where(real[:, t + 1, None], new, 0.0)
        z = soft(alpha[-1], 1)
        node = np.exp(alpha + beta - z[None, :, None])
        g_moves = np.zeros((S, S))
        for t in range(1, T):
            on = real[:, t]
            pair = np.exp(alpha[t - 1][on][:, :, None] + model.moves + (e[on, t] + beta[t][on])[:, None, :] - z[on, None, None])
            g_moves += pair.sum(0)
            np.subtract.at(g_moves, (yy[on, t - 1], yy[on, t]), 1.0)
        expected = np.zeros_like(emit)
        expected[place[real]] = node.transpose(1, 0, 2)[real]
        g_emit = expected - truth
        g_w = np.stack([np.bincount(rows.ravel(), np.repeat(g_emit[:, k], rows.shape[1]), len(keys)) for k in range(S)], axis=1)
        g_w[0] = 0
        g_start = (node[0] - np.eye(S)[yy[:, 0]]).sum(0)
        for i, g in enumerate((g_w, g_moves, g_start)):
            g = g + l2 * params[i]
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.99 * v[i] + 0.01 * g * g
            params[i] -= rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.99**step)) + 1e-8)
    return Model(keys, model.weights.astype(np.float32), model.moves.astype(np.float32), model.starts.astype(np.float32))


def viterbi(model: Model, emit: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Best state of every word; sentences advance together, the longest first."""
    length = np.diff(first)
    order = np.argsort(-length, kind="stable")
    begin, length = first[:-1][order], length[order]
    best = np.zeros(len(emit), np.int8)
    if not len(order):
        return best
    back = np.zeros(emit.shape, np.int8)
    alive = np.searchsorted(-length, -np.arange(1, length[0] + 1), "right")   # sentences with at least t words
    score = model.starts + emit[begin]
    final = np.zeros((len(order), emit.shape[1]), np.float32)
    for t in range(1, len(alive)):
        n = alive[t]
        final[n:len(score)] = score[n:]
        step = score[:n, :, None] + model.moves
        back[begin[:n] + t] = step.argmax(1)
        score = step.max(1) + emit[begin[:n] + t]
    final[:len(score)] = score
    state = final.argmax(1).astype(np.int8)
    for t in range(len(alive) - 1, -1, -1):
        n = alive[t]
        at = begin[:n] + t
        best[at] = state[:n]
        state[:n] = back[at, state[:n]]
    return best


def added_spans(block: tb.Block, model: Model, taken: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, kind, end) of the field's spans in block bytes: words of one kind in a row, outer punctuation cut off.

    Words that a stretch of ``taken`` touches belong to no span and part the words around them.
    """
    s = sentences(block)
    w = s.words
    if not len(w.start):
        return (np.zeros(0, np.int64),) * 4
    state = viterbi(model, model.scores(features(block, s)), s.first)
    if taken:
        a, b = np.array(taken, np.int64).T
        touched = np.zeros(len(state) + 1, np.int64)
        np.add.at(touched, np.searchsorted(w.end, a, "right"), 1)
        np.add.at(touched, np.searchsorted(w.start, b, "left"), -1)
        state[np.cumsum(touched)[:-1] > 0] = 0
    follows = state > len(KINDS)
    state = np.where(follows, state - len(KINDS), state)
    opens = np.ones(len(state), bool)
    opens[1:] = (state[1:] != state[:-1]) | follows[1:]
    opens[s.first[:-1]] = True
    run = np.flatnonzero(opens)
    last = np.append(run[1:], len(state)) - 1
    some = state[run] > 0
    run, last = run[some], last[some]
    start, end = w.start[run].copy(), w.end[last].copy()
    for _ in range(4):
        start += (start < end - 1) & _EDGE[block.buf[start]]
        end -= (start < end - 1) & _EDGE[block.buf[end - 1]]
    kind = state[run].astype(np.int64) - 1
    real = plausible(block, start, kind, end)
    return w.doc[run][real], start[real], kind[real], end[real]


def plausible(block: tb.Block, start: np.ndarray, kind: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Spans that can be what they are called, by what is counted in them."""
    def count(members: bytes) -> np.ndarray:
        sums = np.zeros(len(block.buf) + 1, np.int32)
        np.cumsum(tb.byte_set(members)[block.buf], out=sums[1:])
        return sums[end] - sums[start]

    digits = count(b"0123456789")
    good = np.select([kind == KINDS.index(k) for k in ("email", "ip", "card", "phone")],
                     [count(b"@([") > 0, count(b".:") > 1, (digits >= 12) & (digits <= 19), (digits >= 7) & (digits <= 15)], digits >= 6)
    for i in np.flatnonzero(good & (kind == KINDS.index("card"))):
        good[i] = luhn(_NOT_DIGIT.sub(b"", block.buf[start[i]:end[i]].tobytes()))
    return good.astype(bool)


def block_spans(block: tb.Block, model: Model) -> Iterator[tuple[list, list]]:
    """For each row: pattern spans and all spans, as (start, kind, end) in code points."""
    marks = np.zeros(len(block.buf) + 1, np.int32)
    np.cumsum(_DIGIT[block.buf] | (block.buf == 64), out=marks[1:])
    points = np.zeros(len(block.buf) + 1, np.int64)
    np.cumsum((block.buf & 0xC0) != 0x80, out=points[1:])
    bounds = block.bounds.tolist()
    bases = [base_spans(block.buf[lo:hi].tobytes()) if marks[hi] > marks[lo] else [] for lo, hi in zip(bounds, bounds[1:])]
    rows, starts, kinds, ends = added_spans(block, model, [(lo + a, lo + b) for lo, base in zip(bounds, bases) for a, _, b in base])
    cut = np.searchsorted(rows, np.arange(block.n + 1))
    for i, base in enumerate(bases):
        lo = bounds[i]
        more = [(int(starts[j] - lo), int(kinds[j]), int(ends[j] - lo)) for j in range(cut[i], cut[i + 1])]
        in_points = lambda spans: [(int(points[lo + a] - points[lo]), k, int(points[lo + b] - points[lo])) for a, k, b in spans]
        yield in_points(base), in_points(sorted(base + more))


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def find(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added of every document."""
    model = model or train()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in tb.blocks(batch):
                found = list(block_spans(block, model))
                counts = [pa.array([sum(k == kind for _, k, _ in b) for b, _ in found], pa.int64()) for kind in range(4)]
                yield pa.RecordBatch.from_arrays(
                    [block.rows.column("doc_id"), *counts,
                     pa.array([hashlib.sha256(joined(b).encode()).hexdigest() for b, _ in found], pa.string()),
                     pa.array([joined(a) for _, a in found], pa.string()),
                     pa.array([len(a) - len(b) for b, a in found], pa.int64())], NAMES)

    docs = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(docs, run, f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, "
                                "base_sha256 string, spans string, n_added long")


NAMES = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"]


def masked_text(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each stretch of overlapping spans replaced by its first kind, as <EMAIL>."""
    out, at = [], 0
    for a, k, b in spans:
        if a >= at:
            out += [text[at:a], f"<{KINDS[k].upper()}>"]
        at = max(at, b)
    return "".join(out) + text[at:]


def mask(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """``docs`` with personal data masked in ``text``; n_chars, where there is one, follows the text."""
    model = model or train()
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in tb.blocks(batch):
                texts = block.rows.column(place).to_pylist()
                new = [t if t is None or not all_ else masked_text(t, all_)
                       for t, (_, all_) in zip(texts, block_spans(block, model), strict=True)]
                columns = list(block.rows.columns)
                columns[place] = pa.array(new, batch.schema.field(place).type)
                yield pa.RecordBatch.from_arrays(columns, names=block.rows.schema.names)

    out = map_arrow(docs, run, docs.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars"))
                             .otherwise(F.char_length("text")).cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)
