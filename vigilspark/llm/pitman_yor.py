"""Language model: a hierarchical Pitman-Yor process over word pairs.

Every word (and the start of a text) is a context with a restaurant of its own: the tokens that
follow it are its customers, seated at tables that serve one word each.  All context restaurants
share one parent, whose customers are their tables and whose base is uniform over the known words
and one unknown word.  Seatings are sampled by Gibbs: in a sweep all customers of a pair leave and
sit down again, at tables in proportion to their customers less the discount, or at new ones in
proportion to the parent's probability of the word.  Predictive probabilities are averaged over
the kept sweeps; a text's score is their summed log10, its perplexity 10 ** (-score / n_tokens).

How it runs: documents become blocks of 64-bit word hashes; a block's pairs are counted, packed
and dealt out to buckets by their context, once.  A bucket holds whole restaurants, so it seats
them alone.  Only what the parent needs travels: tables a word, up to the parent's parts, and
the parent's share of each word back.  Buckets grow in number with the text, not in size.

* A context with a large share of all tokens is split over all buckets by the word that follows;
  its total of tables is then that of the round before while it is seated, and the exact sum of
  the averaged tables when texts are scored.  Such contexts are looked for in a bounded sample of
  documents (``SAMPLE``); a miss makes a bucket larger and changes no count.
* A pair is counted in its block before it travels.  Tables, not customers, are kept: a pair seen
  a billion times costs a few thousand numbers.
* Every step is a function of its input and a fixed seed, sorted before any draw, so a task that
  is run again after a loss gives the same seating.

Only numbers of tables matter, not who sits where, so a pair's customers sit down together: the
number is drawn from its exact distribution, by a recursion up to ``EXACT`` customers, beyond by
an integral whose cost does not grow with them.  Discounts come from the counts of pairs, and
of tables, seen once and twice.  Two words are the same where their 64-bit hashes are.

A null text is empty: its end alone is scored.  Rows of a repeated doc_id each count and are
scored; a null doc_id is neither learnt from nor held out.  Without a text to learn from every
probability is 1 (score 0).  An empty table gives no rows; other columns are never read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from . import textblocks as tb
from .shipping import map_arrow, ship

END, BEGIN = tb.U64(0x243F6A8885A308D3), tb.U64(0x13198A2E03707344)
SEED = 12
ROUNDS, BURN, KEEP = 2, 1, 2
DISCOUNT, STRENGTH = 0.7, 1.0           # the discount before any count is known
BLOCK_TOKENS = 1_200_000
BUCKET_BYTES = 12 << 20
CHUNK = 2 << 20                          # a longer text is hashed in chunks of this size
SAMPLE = 2000
EXACT, NODES, CELLS = 2048, 64, 1 << 18  # largest count by recursion; points of an integral; weights held at a time
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as compressed bytes; whole numbers in the smallest type that holds them."""
    out = []
    for a in arrays:
        if a.dtype.kind == "i":
            a = a.astype(np.min_scalar_type(int(a.max()) if len(a) else 0))
        raw = a.tobytes()
        out.append((a.dtype.str, len(raw), pa.compress(raw, codec="zstd", asbytes=True) if raw else b""))
    return pickle.dumps(out)


def unpack(data: bytes) -> list[np.ndarray]:
    out = []
    for kind, size, raw in pickle.loads(data):
        a = np.frombuffer(pa.decompress(raw, size, codec="zstd", asbytes=True) if size else b"", kind)
        out.append(a.astype(np.int64) if a.dtype.kind == "u" and a.dtype != np.uint64 else a)
    return out


def _cut(block: tb.Block) -> Iterator[tb.Block]:
    """A block whole, or a single very long text in chunks that end between words."""
    size = len(block.buf)
    if size <= CHUNK:
        yield block
        return
    spaces, at = np.flatnonzero(~tb.NOT_SPACE[block.buf]), 0
    while at < size:
        after = np.searchsorted(spaces, at + CHUNK)
        to = int(spaces[after]) + 1 if after < len(spaces) else size
        yield tb.Block(block.rows, block.buf[at:to], np.array([0, to - at]))
        at = to


def tokens(block: tb.Block) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every token, an end token after each text; row of each)."""
    if block.n > 1 or len(block.buf) <= CHUNK:
        parts = [block]
    else:
        parts = list(_cut(block))
    found = [(tb.words(p, tb.NOT_SPACE), LOWER[p.buf]) for p in parts]
    hashes = [tb.range_hash(tb.prefix_sums(low), w.start, w.end) for w, low in found]
    word, doc = np.concatenate(hashes), np.concatenate([w.doc for w, _ in found])
    counts = np.bincount(doc, minlength=block.n)
    row = np.repeat(np.arange(block.n), counts + 1)
    out = np.full(len(row), END)
    inside = np.ones(len(row), bool)
    inside[np.cumsum(counts + 1) - 1] = False
    out[inside] = word
    return out, row


def before(word: np.ndarray, row: np.ndarray) -> np.ndarray:
    """The context of each token."""
    prev = np.concatenate([[BEGIN], word[:-1]]).astype(np.uint64)
    prev[np.concatenate([[True], row[1:] != row[:-1]])[:len(row)]] = BEGIN
    return prev[:len(word)]


def _bucket(h: np.ndarray, n: int) -> np.ndarray:
    return (tb.mix(h ^ tb.U64(0xA4093822299F31D0)) % tb.U64(n)).astype(np.int64)


def _dealt(word: np.ndarray, row: np.ndarray, learn: np.ndarray, hot: np.ndarray, n: int) -> Iterator[tuple[int, bytes]]:
    """A block's pairs, counted by document, as one packed value a bucket."""
    words, wid = np.unique(word, return_inverse=True)
    contexts = np.append(words, BEGIN)
    ctx = np.concatenate([[len(words)], wid[:-1]])
    ctx[np.concatenate([[True], row[1:] != row[:-1]])] = len(words)
    bucket = _bucket(contexts, n)
    split = np.isin(contexts, hot)[ctx]
    if split.any():
        where = _bucket(tb.pair_hash(contexts[ctx[split]], word[split]), n)
        code, inverse = np.unique(ctx[split] * n + where, return_inverse=True)
        ctx[split] = len(contexts) + inverse
        contexts, bucket = np.concatenate([contexts, contexts[code // n]]), np.concatenate([bucket, code % n])
    order = np.argsort(bucket, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    span = 2 * len(learn)
    key = rank[ctx]
    key *= len(words)
    key += wid
    key *= span
    key += row * 2 + learn[row]
    del ctx, wid
    key.sort()
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    number = np.diff(np.append(first, len(key)))
    key = key[first]
    mark, key = key % span, key // span
    wid, at = key % len(words), key // len(words)
    for b, s in _runs(bucket[order][at]):
        here, runs = np.unique(at[s], return_counts=True)
        known, index = np.unique(wid[s], return_inverse=True)
        yield b, pack(contexts[order[here]], runs, words[known], index, mark[s], number[s])


def _runs(values: np.ndarray) -> Iterator[tuple[int, slice]]:
    """(value, its places) of a sorted array; only values that are there."""
    cuts = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if a < b:
            yield int(values[a]), slice(a, b)


def _spread(hot: np.ndarray, n: int):
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, size = TaskContext.get().partitionId(), 0, 0
        held: list = []

        def flush():
            nonlocal held, number
            word = np.concatenate([h[0] for h in held])
            shift = np.cumsum([0] + [len(h[2]) for h in held])
            row = np.concatenate([h[1] + s for h, s in zip(held, shift, strict=False)])
            held = [(None, None, *h[2:]) for h in held]
            learn = np.concatenate([h[2] for h in held])
            block = part << 32 | number
            meta = pickle.dumps(([i for h in held for i in h[3]], np.concatenate([h[4] for h in held]), np.bincount(row, minlength=len(learn))))
            rows = [(block % n, block, True, meta)] + [(b, block, False, data) for b, data in _dealt(word, row, learn, hot, n)]
            held, number = [], number + 1
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int64(), pa.bool_(), pa.binary()), strict=True)],
                                              ["bucket", "block", "meta", "data"])

        for batch in batches:
            for block in tb.blocks(batch):
                word, row = tokens(block)
                flag = lambda c, b=block: np.array(b.rows.column(c).to_pylist(), bool)
                held.append((word, row, flag("learn").astype(np.int64), block.rows.column("doc_id").to_pylist(), flag("held_out")))
                size += len(word)
                if size >= BLOCK_TOKENS:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    return spread


@dataclass
class Bucket:
    """Pairs of a bucket: contexts, words (by part, then hash), types (context, word) and their rows by document."""

    contexts: np.ndarray
    words: np.ndarray
    ctx: np.ndarray       # of each type
    word: np.ndarray      # of each type
    count: np.ndarray     # learnt customers of each type
    kind: np.ndarray      # type of each row
    mark: np.ndarray      # document * 2 + learnt from, of each row
    number: np.ndarray    # tokens of each row
    blocks: list[tuple[int, int, int]]   # (block, first row, end)


def load(records: list[tuple[int, bytes]], parts: int) -> Bucket:
    """The pairs of a bucket, whatever order their blocks came in; rows hold 32-bit numbers."""
    records = sorted(records)
    cols = [unpack(data) for _, data in records]
    blank = [np.zeros(0, np.uint64), np.zeros(0, np.int64)] * 2 + [np.zeros(0, np.int64)] * 2
    join = lambda i: np.concatenate([c[i] for c in cols] or [blank[i]])
    contexts, ctx_at = np.unique(join(0), return_inverse=True)
    words, word_at = np.unique(join(2), return_inverse=True)
    order = np.argsort(words % tb.U64(parts), kind="stable")
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(order), dtype=np.int32)
    words, word_at = words[order], place[word_at]
    ends = np.cumsum([0] + [len(c[3]) for c in cols])
    shift = np.cumsum([0] + [len(c[2]) for c in cols])
    key = np.repeat(ctx_at, join(1)).astype(np.int64)
    key *= max(1, len(words))
    for i, c in enumerate(cols):
        key[ends[i]:ends[i + 1]] += word_at[c[3] + shift[i]]
    mark, number = join(4).astype(np.int32), join(5).astype(np.int32)
    del cols, order, place, word_at, ctx_at
    by_key = np.argsort(key, kind="stable")
    key = key[by_key]
    opens = np.ones(len(key), bool)
    opens[1:] = key[1:] != key[:-1]
    types = key[opens]
    kind = np.empty(len(key), np.int32)
    kind[by_key] = np.cumsum(opens, dtype=np.int32) - 1
    del key, by_key, opens
    count = np.bincount(kind, number * (mark & 1), len(types)).astype(np.int64)
    return Bucket(contexts, words, types // max(1, len(words)), types % max(1, len(words)), count, kind, mark, number,
                  [(b, int(ends[i]), int(ends[i + 1])) for i, (b, _) in enumerate(records)])


def seat(count: np.ndarray, where: np.ndarray, base: np.ndarray, n: int, discount: float, strength: float, rng: np.random.Generator,
         fixed: np.ndarray | None = None, burn: int = BURN, keep: int = KEEP, reseats: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Tables of each type: (mean over the kept sweeps, last), by Gibbs draws; all customers sit down again ``reseats`` times a sweep.

    ``count`` customers (1 or more) of a type sit in restaurant ``where`` (of ``n``) and eat a dish of probability ``base``
    in the parent.  A restaurant with a number in ``fixed`` takes that as its tables in all.

    A restaurant of T tables has the weight gamma(strength / discount + T) times, for each of its types, the Stirling number
    of its customers and tables and (discount * base) ** tables.  With a gamma variable of that shape drawn beside them
    (its integral is the first factor), types no longer depend on each other: each draws its tables from their exact distribution.
    """
    total, last = np.ones(len(count)), np.ones(len(count), np.int64)
    many = np.flatnonzero(count >= 2)
    many = many[np.argsort(count[many], kind="stable")]
    if not len(many):
        return total, last
    c, g, p = count[many], where[many], np.log(np.maximum(base[many], 1e-300))
    own = np.bincount(where, minlength=n).astype(float)
    held = np.zeros(n, bool) if fixed is None else ~np.isnan(fixed)
    tables = np.where(held, 0.0 if fixed is None else fixed, own)
    mass = (strength + discount * tables[g]) * base[many]
    t = np.clip(1 + mass * np.log1p((c - 1) / (1 + mass)), 1, c).astype(np.int64)
    tables = np.where(held, tables, own + np.bincount(g, t - 1, n))
    rows, kept = _stirling(np.unique(c[c <= EXACT]), discount), np.zeros(len(c))
    for sweep in range(burn + keep):
        for _ in range(reseats):
            room = np.where(held, strength + discount * tables, discount * rng.gamma(strength / discount + tables))
            t = _drawn(c, np.log(room)[g] + p, rng.random(len(c)), rows, discount)
            tables = np.where(held, tables, own + np.bincount(g, t - 1, n))
        if sweep >= burn:
            kept += t
    total[many], last[many] = kept / keep, t
    return total, last


def _stirling(counts: np.ndarray, discount: float) -> dict[int, np.ndarray]:
    """Logarithms of the generalised Stirling numbers of each count and 1, 2, … tables: the weights of all seatings."""
    wanted, rows, row = set(counts.tolist()), {}, np.zeros(1)
    for c in range(1, max(wanted, default=0) + 1):
        if c > 1:
            stay = row + np.log(c - 1 - discount * np.arange(1, c))
            row = np.concatenate([stay[:1], np.logaddexp(stay[1:], row[:-1]), row[-1:]])
        if c in wanted:
            rows[c] = row
    return rows


def _drawn(count: np.ndarray, room: np.ndarray, drawn: np.ndarray, rows: dict[int, np.ndarray], discount: float) -> np.ndarray:
    """Tables of each type, in proportion to Stirling number * exp(``room``) ** tables; counts ascend, ``drawn`` is uniform."""
    out = np.ones(len(count), np.int64)
    for c, s in _runs(count):
        if c > EXACT:
            break
        t, step = np.arange(1, c + 1), max(1, CELLS // c)
        for a in range(s.start, s.stop, step):
            to = min(s.stop, a + step)
            weight = room[a:to, None] * t
            weight += rows[c]
            weight -= weight.max(1, keepdims=True)
            np.cumsum(np.exp(weight, out=weight), 1, out=weight)
            out[a:to] = 1 + (weight[:, :-1] <= drawn[a:to, None] * weight[:, -1:]).sum(1)
    large = np.flatnonzero(count > EXACT)
    for i, tilt, middle in zip(large, *_middle(count[large], room[large], discount), strict=True):
        first, weight = _weights(int(count[i]), room[i], discount, tilt, middle)
        sums = np.cumsum(weight)
        out[i] = first + int((sums[:-1] <= drawn[i] * sums[-1]).sum())
    return out


def _middle(c: np.ndarray, room: np.ndarray, discount: float) -> tuple[np.ndarray, np.ndarray]:
    """The saddle point of each type's weights: (tilt of the table sizes, tables)."""
    low, high = np.log(1e-6 / c), np.full(len(c), np.log(750.0))
    for _ in range(60):
        at = (low + high) / 2
        tilt = np.exp(at)
        few = room - tilt + (discount - 1) * np.log(-np.expm1(-tilt)) > np.log(c)
        low, high = np.where(few, at, low), np.where(few, high, at)
    tilt = np.exp(low)
    return tilt, np.clip(-np.exp(room) / discount * np.expm1(discount * np.log(-np.expm1(-tilt))), 1, c)


def _weights(c: int, room: float, discount: float, tilt: float, middle: float) -> tuple[int, np.ndarray]:
    """Weights of the numbers of tables of a large type, from the first returned on; what is left out is below 1e-16 of all.

    The Stirling number of c and t is c! / (t! discount ** t) times the coefficient of z ** c in (1 - (1 - z) ** discount) ** t:
    Cauchy's integral, on a path through the saddle point that is fine enough to be exact to some 1e-7 of all weights.
    """
    reach = 9 * np.sqrt(middle if tilt < 1 else min(middle, c - middle)) + 20
    first, end, at = max(1, int(middle - reach)), min(c, int(middle + reach)), int(middle)
    k = np.arange(1, 45)
    series = np.cumprod(np.append(1.0, (k - discount) / (k + 1)))[::-1]

    def path(u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(exponent at the middle, what one more table adds, length) at z = exp(-s); a parabola about the cut, or a circle."""
        if tilt < 1:
            s = max(tilt, 2 / c) * (1 + 1j * u) ** 2
            more = np.log(-np.expm1(discount * np.log(-np.expm1(-s))))
            return at * more + c * s, more, 1 + 1j * u
        s = tilt + 1j * u
        more = np.log(discount * np.polyval(series, np.exp(-s)))
        return at * more + (c - at) * s, more - s, np.ones(len(u))

    far = np.append(0, np.geomspace(1e-6, 1, 61) * (8.0 if tilt < 1 else np.pi))
    height = path(far)[0].real
    gone = np.flatnonzero(height - height[0] < -40)
    u = np.linspace(0, far[gone[0] if len(gone) else -1], NODES + 1)
    height, more, length = path(u)
    length = length * np.exp(height - height[0])
    length[[0, -1]] /= 2
    t = np.arange(first, end + 1)
    value = (np.exp(np.outer(t - at, more - more[0].real)) @ length).real
    scale = (t - at) * (room - np.log(discount) + more[0].real) - np.cumsum(np.log(t))
    return first, np.maximum(value, 0) * np.exp(scale - scale.max())


@dataclass
class Known:
    """What all buckets know before a round: discounts, words, and the totals of split contexts."""

    rounds: int = 0
    child: float = DISCOUNT
    parent: float = DISCOUNT
    tokens: int = 0                      # learnt ones, N
    words: int = 0                       # distinct learnt ones, V
    tables: int = 0                      # of all contexts: the parent's customers
    roots: float = 0.0                   # the parent's tables
    split: dict | None = None            # context -> (customers, mean tables)

    def base(self, share: np.ndarray) -> np.ndarray:
        """The parent's probability of words from their customers less discounts."""
        return (share + (STRENGTH + self.parent * self.roots) / (self.words + 1)) / (STRENGTH + self.tables)


def _round(bucket: Bucket, number: int, known: Known, share: np.ndarray | None, hot: np.ndarray, n: int):
    """A round's seating of a bucket: (mean tables, last tables) of its types, customers and tables of its contexts."""
    c, ctx = bucket.count, bucket.ctx
    met = np.bincount(bucket.word, c, len(bucket.words))
    base = (met + 1) / (met.sum() + len(met)) if share is None else known.base(share)
    learnt = np.flatnonzero(c)
    customers = np.bincount(ctx, c, len(bucket.contexts))
    fixed = np.full(len(bucket.contexts), np.nan)
    for i in np.flatnonzero(np.isin(bucket.contexts, hot)):
        whole = (known.split or {}).get(int(bucket.contexts[i]))
        fixed[i] = whole[1] if whole else np.count_nonzero(ctx[learnt] == i) * n
    rng = np.random.default_rng([SEED, known.rounds, number])
    mean, last = np.zeros(len(c)), np.zeros(len(c), np.int64)
    mean[learnt], last[learnt] = seat(c[learnt], ctx[learnt], base[bucket.word[learnt]], len(fixed), known.child, STRENGTH, rng, fixed)
    return mean, last, customers, np.bincount(ctx, mean, len(fixed))


def _by_bucket(records) -> Iterator[tuple[int, list, list]]:
    """(bucket, its pairs, all else) of a partition's records (bucket, (kind, key, data))."""
    groups: dict = {}
    for number, record in records:
        groups.setdefault(number, []).append(record)
    for number in sorted(groups):
        rows = groups.pop(number)
        yield number, [(r[1], r[2]) for r in rows if r[0] == "pairs"], [r for r in rows if r[0] != "pairs"]


def _shares(rest: list, kind: str) -> list[np.ndarray]:
    """The parent's replies to a bucket, put together in the order of its words: [share, learnt count]."""
    told = [unpack(data) for _, data in sorted((k, d) for name, k, d in rest if name == kind)]
    return [np.concatenate([t[i] for t in told]) if told else np.zeros(0) for i in (0, 1)]


def _up(known: Known, hot: np.ndarray, n: int):
    """Seat all buckets; tables and customers a word go to the parent's parts, counts for the discounts beside them."""

    def up(records):
        for number, pairs, rest in _by_bucket(records):
            b = load(pairs, n)
            share = _shares(rest, f"share{known.rounds - 1}")[0] if known.rounds else None
            mean, last, customers, tables = _round(b, number, known, share, hot, n)
            counts = np.bincount(b.word, b.count, len(b.words)).astype(np.int64)
            lot = np.bincount(b.word, last, len(b.words)).astype(np.int64)
            for p, s in _runs((b.words % tb.U64(n)).astype(np.int64)):
                yield p, ("words", number, pack(b.words[s], counts[s], lot[s]))
            split = {int(b.contexts[i]): (float(customers[i]), float(tables[i])) for i in np.flatnonzero(np.isin(b.contexts, hot))}
            yield number % n, ("counts", number, pickle.dumps((int((b.count == 1).sum()), int((b.count == 2).sum()), split)))

    return up


def _words(records) -> Iterator[tuple[int, list, np.ndarray, np.ndarray, np.ndarray, list]]:
    """Each part of the parent: (part, [(bucket, its words' places)], words, learnt counts, tables, counts' records)."""
    groups: dict = {}
    for part, record in records:
        groups.setdefault(part, []).append(record)
    for part in sorted(groups):
        rows = groups.pop(part)
        cols = [(k, unpack(d)) for kind, k, d in sorted(rows) if kind == "words"]
        words, at = np.unique(np.concatenate([c[0] for _, c in cols] or [np.zeros(0, np.uint64)]), return_inverse=True)
        sums = [np.bincount(at, np.concatenate([c[i] for _, c in cols] or [np.zeros(0)]), len(words)).astype(np.int64) for i in (1, 2)]
        ends = np.cumsum([0] + [len(c[0]) for _, c in cols])
        yield part, [(k, at[ends[i]:ends[i + 1]]) for i, (k, _) in enumerate(cols)], words, *sums, [d for kind, _, d in rows if kind == "counts"]


def _tallied(records):
    """One part's numbers: tokens, words, tables; pairs and words seen once and twice; totals of split contexts."""
    out, split = np.zeros(7, np.int64), {}
    for _, _, _, counts, tables, told in _words(records):
        out += [counts.sum(), (counts > 0).sum(), tables.sum(), 0, 0, (tables == 1).sum(), (tables == 2).sum()]
        for data in told:
            once, twice, mine = pickle.loads(data)
            out[3:5] += [once, twice]
            split = _merged(split, mine)
    yield out, split


def _merged(one: dict, two: dict) -> dict:
    return {k: tuple(map(sum, zip(one.get(k, (0, 0)), two.get(k, (0, 0)), strict=True))) for k in one.keys() | two.keys()}


def _discount(once: int, twice: int) -> float:
    return float(np.clip(once / max(1, once + 2 * twice), 0.05, 0.95))


def _roots(part: int, tables: np.ndarray, known: Known) -> np.ndarray:
    """Mean tables of the parent's dishes."""
    met, mean = np.flatnonzero(tables), np.zeros(len(tables))
    rng = np.random.default_rng([SEED + 1, known.rounds, part])
    base = np.full(len(met), 1 / (known.words + 1))
    mean[met] = seat(tables[met], np.zeros(len(met), np.int64), base, 1, known.parent, STRENGTH, rng, np.array([float(known.words)]))[0]
    return mean


def _replies(known: Known):
    """The parent's share of each word, and its learnt count, back to the buckets that asked."""

    def replies(records):
        for part, asked, _, counts, tables, _ in _words(records):
            share = (tables - known.parent * _roots(part, tables, known)).astype(np.float32)
            for number, at in asked:
                yield number, (f"share{known.rounds}", part, pack(share[at], counts[at]))

    return replies


def _scores(seen: Known, known: Known, hot: np.ndarray, n: int):
    """Each bucket's part of every document's sums; the last round's seating is drawn again, the same as before."""

    def scores(records):
        for number, pairs, rest in _by_bucket(records):
            for kind, block, data in rest:
                if kind == "meta":
                    yield block, ("meta", 0, data)
            b = load(pairs, n)
            share = _shares(rest, f"share{seen.rounds - 1}")[0] if seen.rounds else None
            mean, _, customers, tables = _round(b, number, seen, share, hot, n)
            now, counts = _shares(rest, f"share{known.rounds}")
            for i in np.flatnonzero(np.isin(b.contexts, hot)):
                customers[i], tables[i] = known.split[int(b.contexts[i])]
            own = b.count - known.child * mean + (STRENGTH + known.child * tables[b.ctx]) * known.base(now)[b.word]
            score = np.log10(own / (STRENGTH + customers[b.ctx]))[b.kind] * b.number
            plain = np.log10((counts[b.word] + 1) / (known.tokens + known.words + 1))[b.kind] * b.number
            met = (counts[b.word] > 0)[b.kind] * b.number
            for block, low, high in b.blocks:
                doc = b.mark[low:high] // 2
                there = np.unique(doc)
                sums = [np.bincount(doc, x[low:high])[there] for x in (met, plain, score)]
                yield block, ("sums", number, pack(there, sums[0].astype(np.int64), *sums[1:]))

    return scores


def _documents(known: Known):
    def documents(records):
        groups: dict = {}
        for block, record in records:
            groups.setdefault(block, []).append(record)
        for block in sorted(groups):
            rows = sorted(groups.pop(block))
            ids, held, size = pickle.loads(next(d for kind, _, d in rows if kind == "meta"))
            sums = np.zeros((3, len(ids)))
            for kind, _, data in rows:
                if kind == "sums":
                    there, *values = unpack(data)
                    for i, v in enumerate(values):
                        sums[i, there] += v
            for i, doc_id in enumerate(ids):
                n, score = int(size[i]), float(sums[2, i])
                yield doc_id, bool(held[i]), n, int(sums[0, i]), known.tokens, float(sums[1, i]), score, float(10 ** min(-score / n, 300.0))

    return documents


def _common_contexts(docs: DataFrame, rows: int, n: int) -> np.ndarray:
    """Contexts with more than a quarter of a bucket's share of the tokens, by a sample of documents."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in tb.blocks(batch):
                prev, count = np.unique(before(*tokens(block)), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(prev.view(np.int64)), pa.array(count)], ["context", "n"])

    few = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(max(1, rows // SAMPLE))) == 0).select("text")
    met = map_arrow(few, counted, "context long, n long").groupBy("context").agg(F.sum("n").alias("n"))
    least = met.agg(F.sum("n") / (4 * n)).scalar()
    found = met.where(F.col("n") > least).select("context").toArrow()["context"].to_numpy()
    return np.sort(found.astype(np.int64).view(np.uint64))


def _co(*parts: RDD) -> RDD:
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def language_model(docs: DataFrame, learn: Column, held_out: Column) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity of every row of ``docs`` (doc_id, text).

    The model learns from the rows of ``learn``; ``base_score`` is the add-one unigram score from the same rows.
    """
    spark = docs.sparkSession
    ship(spark)
    size, rows = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count("*")).first()
    n = int(size // BUCKET_BYTES) + 1
    hot = _common_contexts(docs, rows, n)
    false = F.lit(False)
    flagged = docs.select("doc_id", F.coalesce(learn, false).alias("learn"), F.coalesce(held_out, false).alias("held_out"), "text")
    packed = map_arrow(flagged, _spread(hot, n), "bucket int, block long, meta boolean, data binary").rdd
    pairs = packed.map(lambda r: (r[0], ("meta" if r[2] else "pairs", r[1], bytes(r[3])))).partitionBy(n)
    known, told = Known(), []
    for _ in range(ROUNDS):
        seen = Known(**vars(known))
        up = _co(pairs, *told).mapPartitions(_up(seen, hot, n)).partitionBy(n)
        tally, split = up.mapPartitions(_tallied).treeReduce(lambda a, b: (a[0] + b[0], _merged(a[1], b[1])))
        words, tables = int(tally[1]), int(tally[2])
        known = Known(seen.rounds, _discount(*tally[3:5]) if not seen.rounds else seen.child, _discount(*tally[5:7]), int(tally[0]), words, tables, 0.0, split)
        known.roots = float(up.mapPartitions(lambda r, k=known: (_roots(p, t, k).sum() for p, _, _, _, t, _ in _words(r))).sum())
        told.append(up.mapPartitions(_replies(known)).partitionBy(n))
        last, known = known, Known(**vars(known) | {"rounds": known.rounds + 1})
    sums = _co(pairs, *told).mapPartitions(_scores(seen, last, hot, n)).partitionBy(n)
    schema = StructType([docs.schema["doc_id"], StructField("held_out", BooleanType()), *[StructField(c, LongType()) for c in ("n_tokens", "n_known", "train_tokens")],
                         *[StructField(c, DoubleType()) for c in ("base_score", "score", "perplexity")]])
    return spark.createDataFrame(sums.mapPartitions(_documents(last)), schema, verifySchema=False)


def report(docs: DataFrame) -> DataFrame:
    """The scores of all documents, learnt from those whose crc32(doc_id as text) mod 7 is not 2."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7
    return language_model(docs, fold != 2, fold == 2)
