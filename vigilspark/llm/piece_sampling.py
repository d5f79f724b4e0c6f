"""SentencePiece encoding by forward filtering and backward sampling, and lossless decoding.

A text is cut where no piece can cross (before a space that follows something else, around
line ends), so that its piece lattice is a chain of small lattices.  Each distinct small
lattice is filtered forward once per block, all of them together: the log-sum of all
segmentations up to every character.  Segmentations are then sampled backward, all chunks of
the block together, with numbers hashed from (seed, row key, chunk, character), so that a
row's sample never depends on its neighbours, partitions or retries.

Pieces come from a public SentencePiece model file whose path is a parameter.  A merge model
stores ranks, not probabilities; a piece of rank r has weight proportional to
(r + 2) ** -alpha.  Characters without a piece of their own fall back to byte pieces, and so
does the piece alphabet's own space mark; decoding the bytes gives back every text exactly.

A null text has null ids, an empty one a single space piece.  A null key counts as 0.
Repeated rows get the same sample.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

from . import textblocks as tb
from .shipping import map_arrow

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
ALPHA = 1.0
SEED = 1
MARK = 0x2581
_LITERAL = 0x110000      # a space mark that stands in the text itself; no piece has it
_CHUNKS = re.compile(r" *[^ \n▁]+| +|\n|▁")
#: Longer chunks are filtered one by one instead of together.
LONG = 200
_SLOT_BITS = 20


@dataclass
class Pieces:
    ids: dict[tuple[int, ...], int]     # code points -> id
    weight: np.ndarray                  # log weight by id
    longest: int
    byte_ids: np.ndarray                # by byte
    raw: np.ndarray                     # bytes of all ids, end to end
    cut: np.ndarray                     # id i is raw[cut[i]:cut[i + 1]]
    keys: np.ndarray                    # hash of each beginning of a piece
    whole: np.ndarray                   # its id, or -1 if it is only a beginning
    slots: np.ndarray


@lru_cache(maxsize=2)
def pieces(path: str = MODEL) -> Pieces:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    ids, byte_ids, raw = {}, np.zeros(256, np.int32), []
    weight = np.zeros(sp.vocab_size())
    base = None
    for i in range(sp.vocab_size()):
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            byte_ids[int(piece[3:-1], 16)] = i
            raw.append(bytes([int(piece[3:-1], 16)]))
        elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
            raw.append(b"")
        else:
            base = i if base is None else base
            weight[i] = -np.log(i - base + 2)
            raw.append(piece.replace("▁", " ").encode())
            if "▁" not in piece.lstrip("▁"):   # others could cross a cut
                ids[tuple(map(ord, piece))] = i
    weight[byte_ids] = -np.log(sp.vocab_size())
    longest = max(map(len, ids))
    begun = sorted({piece[:k] for piece in ids for k in range(1, len(piece) + 1)})
    spelled = np.fromiter((c for x in begun for c in x), np.int64)
    size = np.array([len(x) for x in begun])
    end = np.cumsum(size)
    keys = tb.range_hash(_sums(spelled), end - size, end)
    whole = np.array([ids.get(x, -1) for x in begun], np.int32)
    at = (keys >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)
    order = np.argsort(at, kind="stable")
    nth = np.arange(len(at)) - np.searchsorted(at[order], at[order])     # of those in one slot
    slots = np.full((1 << _SLOT_BITS, int(nth.max()) + 1), -1, np.int32)
    slots[at[order], nth] = order
    return Pieces(ids, weight, longest, byte_ids, np.frombuffer(b"".join(raw), np.uint8),
                  np.concatenate([[0], np.cumsum([len(r) for r in raw])]), keys, whole, slots)


def _sums(points: np.ndarray) -> np.ndarray:
    out = np.zeros(len(points) + 1, np.uint64)
    np.cumsum(tb.mix(points.astype(np.uint64) + tb.U64(77)) * tb.powers(len(points) + 1)[0][:len(points)], out=out[1:])
    return out


def _look_up(p: Pieces, hashes: np.ndarray) -> np.ndarray:
    """Places in ``p.keys``, -1 where no piece begins so."""
    at = (hashes >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)
    out = np.full(len(hashes), -1, np.int32)
    for k in range(p.slots.shape[1]):
        i = p.slots[at, k]
        some = np.flatnonzero(i >= 0)
        hit = some[p.keys[i[some]] == hashes[some]]
        out[hit] = i[hit]
    return out


def _points(chunks: list[str]) -> np.ndarray:
    points = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    points[points == MARK] = _LITERAL
    points[points == 32] = MARK
    return points


@dataclass
class Lattices:
    """Nodes are the ends of characters, first those of all chunks' first characters, the longest chunk first, then of the
    second, and so on.  ``cum[x, l - 1]``: share of the weight of reaching node x that comes by pieces of at most l characters."""

    points: np.ndarray   # character before each node
    level: np.ndarray    # nodes after d + 1 characters begin at level[d]
    rank: np.ndarray     # place of each chunk within a level
    length: np.ndarray
    piece: np.ndarray    # id of the piece of l characters that ends at node x, -1 for none, -2 for bytes
    cum: np.ndarray


def matches(p: Pieces, points: np.ndarray, left: np.ndarray) -> np.ndarray:
    """ids[x, l - 1]: the piece of l characters that ends with character x; ``left``: characters from x to its chunk's end."""
    n = len(points)
    sums = _sums(points)
    columns = []
    x = np.arange(n)                                             # starts at which some piece goes on
    for size in range(1, p.longest + 1):
        x = x[left[x] >= size]
        found = _look_up(p, tb.range_hash(sums, x, x + size))
        x, found = x[found >= 0], found[found >= 0]
        if not len(x):
            break
        columns.append(np.full(n, -1, np.int32))
        columns[-1][x + size - 1] = p.whole[found]
    return np.stack(columns or [np.full(n, -1, np.int32)], axis=1)


def lattices(p: Pieces, chunks: list[str], alpha: float) -> Lattices:
    points = _points(chunks)
    length = np.fromiter(map(len, chunks), np.int64, len(chunks))
    first = np.cumsum(length) - length
    n = len(points)
    depth = np.arange(n) - np.repeat(first, length)              # characters before this one
    longest = np.argsort(-length, kind="stable")
    rank = np.empty(len(chunks), np.int64)
    rank[longest] = np.arange(len(chunks))
    level = np.concatenate([[0], np.cumsum(np.searchsorted(-length[longest], -np.arange(1, length.max(initial=0) + 1), "right"))])
    node = level[depth] + np.repeat(rank, length)
    own = matches(p, points, np.repeat(length, length) - depth)
    piece = np.empty_like(own)
    piece[node] = own
    at_node = np.empty_like(points)
    at_node[node] = points
    most = piece.shape[1]
    piece[piece[:, 0] < 0, 0] = -2
    weight = np.append(p.weight * alpha, [p.weight[p.byte_ids[0]] * alpha * 2, -np.inf]).astype(np.float32)
    total = np.empty(n, np.float32)                              # log-sum of all segmentations up to the node
    cum = np.empty((n, most), np.float32)
    for d in range(len(level) - 1):
        lo, hi = level[d], level[d + 1]
        wide = min(d + 1, most)
        reach = weight[piece[lo:hi, :wide]]                      # -1 and -2 are the last two
        for size in range(1, min(d, most) + 1):                  # a piece of d + 1 characters starts the chunk
            before = level[d - size]
            reach[:, size - 1] += total[before:before + hi - lo]
        top = reach.max(1)
        running = np.cumsum(np.exp(reach - top[:, None]), axis=1)
        total[lo:hi] = top + np.log(running[:, -1])
        cum[lo:hi, :wide] = running / running[:, -1:]
        cum[lo:hi, wide:] = 1.0
    return Lattices(at_node, level, rank, length, piece, cum)


def uniform(key: np.ndarray, chunk: np.ndarray, depth: np.ndarray) -> np.ndarray:
    h = tb.mix(key + chunk.astype(np.uint64) * tb.U64(0x9E3779B97F4A7C15))
    h = tb.mix(h + depth.astype(np.uint64) * tb.U64(0xC2B2AE3D27D4EB4F))
    return (h >> np.uint64(40)).astype(np.float32) * np.float32(2.0**-24)


def sample(lat: Lattices, chunk: np.ndarray, key: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(occurrence, end node, piece) of a sampled segmentation of every occurrence, in text order."""
    who = np.arange(len(chunk))
    left, rank = lat.length[chunk], lat.rank[chunk]              # characters not yet covered
    who, left = who[left > 0], left[left > 0]
    steps = []
    while len(who):
        node = lat.level[left - 1] + rank[who]
        u = uniform(key[who], place[who], left)
        size = np.minimum((lat.cum[node] <= u[:, None]).sum(1), lat.cum.shape[1] - 1)
        # rounding must not pick a piece that isn't there
        while (bad := lat.piece[node, size] == -1).any():
            size[bad] -= 1
        steps.append((who, node, lat.piece[node, size]))
        left = left - size - 1
        who, left = who[left > 0], left[left > 0]
    total = np.zeros(len(chunk), np.int64)
    for who, _, _ in steps:
        total[who] += 1
    at = np.cumsum(total)                                        # pieces come from the chunk's end
    end, piece = np.empty(at[-1] if len(at) else 0, np.int64), np.empty(at[-1] if len(at) else 0, np.int32)
    for k, (who, node, ids) in enumerate(steps):
        end[at[who] - 1 - k] = node
        piece[at[who] - 1 - k] = ids
    return np.repeat(np.arange(len(chunk)), total), end, piece


def sample_long(p: Pieces, chunk: str, alpha: float, key: int, place: int) -> list[int]:
    """The same for one long chunk, without tables over all its characters and sizes."""
    points = _points([chunk]).tolist()
    n = len(points)
    ids, weight = p.ids, p.weight * alpha
    total = np.zeros(n + 1)
    ends: list[list[tuple[int, int]]] = [[]]
    byte = float(p.weight[p.byte_ids[0]] * alpha * 2)
    for j in range(1, n + 1):
        edges = []
        for size in range(1, min(p.longest, j) + 1):
            i = ids.get(tuple(points[j - size:j]))
            if i is not None:
                edges.append((size, i))
        if not edges or edges[0][0] != 1:
            edges.insert(0, (1, -2))
        reach = np.array([total[j - s] + (weight[i] if i >= 0 else byte) for s, i in edges])
        top = reach.max()
        total[j] = top + np.log(np.exp(reach - top).sum())
        ends.append(edges)
    out, j = [], n
    u = uniform(np.full(n, key, np.uint64), np.full(n, place), np.arange(1, n + 1))
    while j:
        edges = ends[j]
        share = np.cumsum([np.exp(total[j - s] + (weight[i] if i >= 0 else byte) - total[j]) for s, i in edges])
        size, i = edges[min(int((share <= u[j - 1] * share[-1]).sum()), len(edges) - 1)]
        out.append(_fallback(p, points[j - 1]) if i < 0 else [i])
        j -= size
    return [i for part in reversed(out) for i in part]


def _fallback(p: Pieces, point: int) -> list[int]:
    char = "▁" if point == _LITERAL else " " if point == MARK else chr(point)
    return p.byte_ids[list(char.encode("utf-8", "surrogatepass"))].tolist()


def encode_texts(p: Pieces, texts: list[str], keys: np.ndarray, alpha: float = ALPHA) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, cuts): ids of text i are ids[cuts[i]:cuts[i + 1]]."""
    cut = [_CHUNKS.findall(" " + text) for text in texts]
    number = np.fromiter(map(len, cut), np.int64, len(cut))
    everything = list(chain.from_iterable(cut))
    code = {c: i for i, c in enumerate(dict.fromkeys(everything))}
    chunk = np.fromiter(map(code.__getitem__, everything), np.int64, len(everything))
    doc = np.repeat(np.arange(len(texts)), number)
    place = np.arange(len(chunk)) - np.repeat(np.cumsum(number) - number, number)
    known = list(code)
    is_long = np.fromiter(map(len, known), np.int64, len(known)) > LONG
    long = []
    if is_long.any():
        at_long = is_long[chunk]
        long = [(int(doc[j]), int(place[j]), everything[j]) for j in np.flatnonzero(at_long)]
        chunk, doc, place = chunk[~at_long], doc[~at_long], place[~at_long]
        known = [c if len(c) <= LONG else "" for c in known]
    lat = lattices(p, known, alpha)
    who, end, piece = sample(lat, chunk, keys[doc], place)
    d, c = doc[who], place[who]
    bare = np.flatnonzero(piece == -2)
    if len(bare) or long:
        times = np.ones(len(piece), np.int64)
        spelled = [_fallback(p, int(lat.points[end[j]])) for j in bare]
        times[bare] = [len(s) for s in spelled]
        at = np.cumsum(times) - times
        ids = np.repeat(piece, times)
        for j, s in zip(bare, spelled, strict=True):
            ids[at[j]:at[j] + len(s)] = s
        d, c = np.repeat(d, times), np.repeat(c, times)
        if long:
            parts = [sample_long(p, s, alpha, int(keys[i]), k) for i, k, s in long]
            n = [len(x) for x in parts]
            ids = np.concatenate([ids, *map(np.array, parts)])
            d = np.concatenate([d, np.repeat([i for i, _, _ in long], n)])
            c = np.concatenate([c, np.repeat([k for _, k, _ in long], n)])
            order = np.lexsort((c, d))
            ids, d = ids[order], d[order]
    else:
        ids = piece
    return ids.astype(np.int32), np.searchsorted(d, np.arange(len(texts) + 1))


def decode_bytes(p: Pieces, ids: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, cuts); the space put before each text is taken off."""
    size = np.diff(p.cut)[ids]
    end = np.cumsum(size)
    raw = p.raw[np.arange(end[-1] if len(end) else 0) + np.repeat(p.cut[ids] - (end - size), size)]
    at = np.concatenate([[0], end])[cuts]
    keep = np.ones(len(raw), bool)
    lead = at[:-1][at[:-1] < at[1:]]
    keep[lead] = raw[lead] != 32
    kept = np.concatenate([[0], np.cumsum(keep)])
    return raw[keep], kept[at]


def row_keys(column: pa.Array, seed: int) -> np.ndarray:
    """64-bit numbers from the row keys: integers as they are, other types by their text."""
    if pa.types.is_integer(column.type):
        values = np.asarray(column.cast(pa.int64()).fill_null(0)).astype(np.int64).view(np.uint64)
    else:
        block = next(tb.blocks(pa.RecordBatch.from_arrays([column.cast(pa.string())], ["text"]), max_bytes=1 << 62))
        values = tb.range_hash(tb.prefix_sums(block.buf), block.bounds[:-1], block.bounds[1:])
    return tb.mix(values + tb.U64(seed) * tb.U64(0x9E3779B97F4A7C15))


def encode(docs: DataFrame, path: str = MODEL, alpha: float = ALPHA, seed: int = SEED, key: str = "doc_id", text: str = "text",
           spell: bool = False) -> DataFrame:
    """``docs`` with ``piece_ids``, ``n_pieces`` and ``lossless`` (decoding gives the text back); such columns there are replaced.

    With ``spell`` the text is decoded from the ids in the same pass.
    """
    docs = docs.drop("piece_ids", "n_pieces", "lossless")
    names = docs.columns
    schema = StructType([*docs.schema.fields, StructField("piece_ids", ArrayType(IntegerType())), StructField("n_pieces", LongType()),
                         StructField("lossless", BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(path)
        for batch in batches:
            for block in tb.blocks(batch, text, max_bytes=1 << 20):
                whole = block.buf.tobytes()
                texts = [whole[a:b].decode("utf-8", "surrogatepass") for a, b in zip(block.bounds[:-1], block.bounds[1:], strict=True)]
                ids, cuts = encode_texts(p, texts, row_keys(block.rows.column(names.index(key)), seed), alpha)
                raw, at = decode_bytes(p, ids, cuts)
                if np.array_equal(at, block.bounds) and np.array_equal(raw, block.buf):
                    same = np.ones(block.n, bool)
                else:
                    same = [raw[at[i]:at[i + 1]].tobytes() == whole[block.bounds[i]:block.bounds[i + 1]] for i in range(block.n)]
                null = np.asarray(block.rows.column(names.index(text)).is_null())
                columns = list(block.rows.columns)
                if spell:
                    spelled = pa.array([None if null[i] else raw[at[i]:at[i + 1]].tobytes().decode("utf-8", "surrogatepass")
                                        for i in range(block.n)], pa.string())
                    columns[names.index(text)] = spelled.cast(block.rows.schema.field(names.index(text)).type)
                number = np.diff(cuts)
                held = np.concatenate([[0], np.cumsum(np.where(null, 0, number))])    # a null row holds no ids
                lists = pa.ListArray.from_arrays(pa.array(held, pa.int32(), mask=np.append(null, False)), pa.array(ids[~np.repeat(null, number)]))
                yield pa.RecordBatch.from_arrays([*columns, lists, pa.array(number, pa.int64(), mask=null),
                                                  pa.array(same, pa.bool_(), mask=null)], [*names, "piece_ids", "n_pieces", "lossless"])

    return map_arrow(docs, run, schema)


def decode(encoded: DataFrame, path: str = MODEL, text: str = "text") -> DataFrame:
    """``encoded`` with ``text`` spelled from ``piece_ids``; null ids give a null text."""
    encoded = encoded.drop(text)
    place = encoded.columns.index("piece_ids")
    schema = StructType([*encoded.schema.fields, StructField(text, StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(path)
        for batch in batches:
            lists = batch.column(place)
            cuts = np.concatenate([[0], np.cumsum(np.asarray(lists.value_lengths().fill_null(0)))]).astype(np.int64)
            raw, at = decode_bytes(p, np.asarray(lists.flatten()), cuts)
            texts = [None if null else raw[at[i]:at[i + 1]].tobytes().decode("utf-8", "surrogatepass")
                     for i, null in enumerate(np.asarray(lists.is_null()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, text])

    return map_arrow(encoded, run, schema)
