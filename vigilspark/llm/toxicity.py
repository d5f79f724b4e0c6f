"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

Features of a whole text: densities of a seed lexicon and of a lexicon learnt from labels
(words and word beginnings much commoner in toxic documents), how often their hits stand near
a second-person word, capitals, punctuation, repeated characters and obfuscated words.  They
are computed in numpy blocks; trees and calibration are Spark ML's.

Learning rows are a bounded sample (``MAX_DOCS``) outside the held-out fold.  The lexicon of
one half of them gives the features of the other half, so that the trees do not learn from
words picked by the same documents; every fifth row is left to the calibration.

Nulls and empty texts have all-zero features and get the score those have.  Without usable
labels of both classes, every score is the share of label 1, or 0 without any.  One result
per input row; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textblocks as tb
from .shipping import map_arrow
from .tables import held_out, learning_rows, stored

MAX_DOCS = 12_000
BEGINNINGS = (4, 5, 6, 7, 8)     # bytes
NEAR = 5                         # words
SEED_LEXICON = ("idiot stupid moron loser scum trash clown pathetic worthless disgusting dumb fool imbecile hate garbage filth "
                "dumm trottel abschaum arschloch wertlos ekelhaft idioten imbécile crétin ordure débile connard minable "
                "estúpido imbécil basura inútil asqueroso patético escoria").split()
SECOND_PERSON = "you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta tes vous votre tú ti tus usted ustedes vosotros".split()
NAMES = ("seed_density", "seed_count", "word_density", "word_count", "start_density", "start_count", "weight_density", "weight_top",
         "near_density", "second_person", "capital_share", "capital_words", "punctuation", "exclamations", "symbols", "digits",
         "obfuscated", "stretched", "word_length", "log_words")

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = tb.byte_set(bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256)))
_UPPER = tb.byte_set(bytes(range(65, 91)))
_DIGIT = tb.byte_set(b"0123456789")
_POINT = tb.byte_set(b".,;:!?'\"()-")
_MARK = tb.byte_set(b"!?")
_SYMBOL = tb.byte_set(b"#*$%&|<>@^~_+=")


@dataclass
class Lexicon:
    hashes: np.ndarray       # sorted
    weights: np.ndarray


def _hashes(words: list[str]) -> np.ndarray:
    raw = [w.lower().encode() for w in words]
    end = np.cumsum([len(r) for r in raw])
    return np.sort(tb.range_hash(tb.prefix_sums(np.frombuffer(b"".join(raw), np.uint8)), end - [len(r) for r in raw], end))


_SEED, _YOU = _hashes(SEED_LEXICON), _hashes(SECOND_PERSON)


def _among(hashes: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Places in ``known`` (sorted), -1 where absent."""
    if not len(known):
        return np.full(len(hashes), -1)
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return np.where(known[at] == hashes, at, -1)


def _terms(block: tb.Block) -> tuple[tb.Words, np.ndarray, list[np.ndarray]]:
    """Words, their hashes, and by length of beginning the hashes of beginnings."""
    w = tb.words(block, tb.ALNUM)
    sums = tb.prefix_sums(_LOWER[block.buf])
    word = tb.range_hash(sums, w.start, w.end)
    starts = [tb.mix(tb.range_hash(sums, w.start, np.minimum(w.start + n, w.end)) + tb.U64(n)) for n in BEGINNINGS]
    return w, word, starts


def block_features(block: tb.Block, lexicon: Lexicon) -> np.ndarray:
    w, word, starts = _terms(block)
    n = np.maximum(np.diff(w.first), 1)
    chars = np.maximum(np.diff(block.bounds), 1)
    seed = _among(word, _SEED) >= 0
    own = _among(word, lexicon.hashes)
    weights = np.append(lexicon.weights, 0.0)
    weight = weights[own]
    begun = np.zeros(len(word), bool)
    for size, s in zip(BEGINNINGS, starts, strict=True):
        at = _among(s, lexicon.hashes)
        long = w.end - w.start >= size
        begun |= (at >= 0) & long
        weight = np.maximum(weight, np.where(long, weights[at], 0.0))
    hit = seed | (own >= 0) | begun
    you = np.flatnonzero(_among(word, _YOU) >= 0)
    near = np.zeros(len(word), bool)
    if len(you):
        after = np.searchsorted(you, np.arange(len(word)))
        for side in (np.minimum(after, len(you) - 1), np.maximum(after - 1, 0)):
            near |= (np.abs(you[side] - np.arange(len(word))) <= NEAR) & (w.doc[you[side]] == w.doc)
    in_bytes = lambda members: tb.per_doc(members[block.buf], block.bounds)
    in_words = lambda values: tb.per_doc(values, w.first)
    upper = np.concatenate([[0], np.cumsum(_UPPER[block.buf])])
    capital = (upper[w.end] - upper[w.start] > 1) & (upper[w.end] - upper[w.start] >= 0.8 * (w.end - w.start))
    # letters, then something else, then letters within one spaced word
    spaced = tb.words(block, tb.NOT_SPACE)
    letter = _LETTER[block.buf]
    odd = np.zeros(len(letter), bool)
    inner = ~letter & (block.buf != 39) & (block.buf != 45)
    odd[1:-1] = inner[1:-1] & letter[:-2] & letter[2:]
    odd = np.concatenate([[0], np.cumsum(odd)])
    same = np.zeros(len(letter), bool)
    same[2:] = letter[2:] & (block.buf[2:] == block.buf[1:-1]) & (block.buf[2:] == block.buf[:-2])
    same = np.concatenate([[0], np.cumsum(same)])
    top = np.zeros(block.n)
    np.maximum.at(top, w.doc, weight)
    n_spaced = np.maximum(np.diff(spaced.first), 1)
    letters = np.maximum(in_bytes(_LETTER), 1)
    return np.stack([
        in_words(seed) / n, in_words(seed), in_words(own >= 0) / n, in_words(own >= 0), in_words(begun) / n, in_words(begun),
        in_words(weight) / n, top, in_words(hit & near) / n, in_words(near) / n, in_bytes(_UPPER) / letters, in_words(capital) / n,
        in_bytes(_POINT) / chars, in_bytes(_MARK) / chars, in_bytes(_SYMBOL) / chars, in_bytes(_DIGIT) / chars,
        tb.per_doc(odd[spaced.end] > odd[spaced.start], spaced.first) / n_spaced,
        in_words(same[w.end] > same[w.start]) / n, in_words(w.end - w.start) / n, np.log1p(np.diff(w.first)),
    ], axis=1)


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """half, term, documents with it, toxic ones among them: one line per term and block."""
    for batch in batches:
        for block in tb.blocks(batch):
            w, word, starts = _terms(block)
            y = block.rows.column("y").to_numpy()
            half = block.rows.column("half").to_numpy()
            for h in (0, 1):
                here = half[w.doc] == h
                doc = np.concatenate([w.doc[here]] + [w.doc[here & (w.end - w.start >= n)] for n in BEGINNINGS])
                term = np.concatenate([word[here]] + [s[here & (w.end - w.start >= n)] for n, s in zip(BEGINNINGS, starts, strict=True)])
                order = np.lexsort((doc, term))
                doc, term = doc[order], term[order]
                new = np.ones(len(term), bool)
                new[1:] = (term[1:] != term[:-1]) | (doc[1:] != doc[:-1])
                doc, term = doc[new], term[new]
                first = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]])) if len(term) else np.zeros(0, int)
                if len(first):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(first), h)), pa.array(term[first].view(np.int64)), pa.array(np.diff(np.append(first, len(term)))),
                         pa.array(np.add.reduceat(y[doc].astype(np.int64), first))], ["half", "term", "docs", "toxic"])


def learn_lexicons(rows: DataFrame) -> list[Lexicon]:
    """From half 0, from half 1, from all rows: terms whose share of toxic documents is far above the usual."""
    sizes = {r["half"]: (r["n"], r["t"]) for r in rows.groupBy("half").agg(F.count("*").alias("n"), F.sum("y").alias("t")).collect()}
    counted = stored(map_arrow(rows.select("y", "half", "text"), _tally, "half long, term long, docs long, toxic long")
                     .groupBy("half", "term").agg(F.sum("docs").alias("docs"), F.sum("toxic").alias("toxic")), "terms")
    out = []
    for halves in ((0,), (1,), (0, 1)):
        n = sum(sizes.get(h, (0, 0))[0] for h in halves)
        t = sum(sizes.get(h, (0, 0))[1] for h in halves)
        share = t / n if n else 0.0
        of = counted.where(F.col("half").isin(*halves)).groupBy("term").agg(F.sum("docs").alias("docs"), F.sum("toxic").alias("toxic"))
        z = (F.col("toxic") - share * F.col("docs")) / F.sqrt(F.col("docs") * share * (1 - share) + 1e-9)
        odds = F.log((F.col("toxic") + 0.5) / (F.col("docs") - F.col("toxic") + 0.5)) - float(np.log((t + 0.5) / (n - t + 0.5)))
        best = (of.select("term", z.alias("z"), odds.alias("odds")).where("z > 4 AND odds > 1.5")
                .collect())      # as many as a bounded sample yields
        terms = np.array([r["term"] for r in best], np.int64).view(np.uint64)
        order = np.argsort(terms)
        out.append(Lexicon(terms[order], np.array([r["odds"] for r in best], float)[order]))
    return out


def features(docs: DataFrame, lexicons: list[Lexicon], *keep: str) -> DataFrame:
    """keep and ``f``; a row with a ``half`` gets the features by the other half's lexicon, others by the whole one."""
    halves = "half" in keep

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in tb.blocks(batch):
                if halves:
                    half = block.rows.column("half").to_numpy()
                    f = np.where(half[:, None] == 0, block_features(block, lexicons[1]), block_features(block, lexicons[0]))
                else:
                    f = block_features(block, lexicons[2])
                lists = pa.ListArray.from_arrays(pa.array(np.arange(block.n + 1) * f.shape[1], pa.int32()), pa.array(f.ravel()))
                yield pa.RecordBatch.from_arrays([*(block.rows.column(k) for k in keep), lists], [*keep, "f"])

    kinds = ", ".join(f"{k} {docs.schema[k].dataType.simpleString()}" for k in keep)
    return map_arrow(docs.select(*keep, "text"), run, f"{kinds}, f array<double>").withColumn("features", array_to_vector("f")).drop("f")


@dataclass
class Model:
    lexicons: list[Lexicon]
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    share: float


def _margin():
    return vector_to_array("rawPrediction")[1].alias("margin")


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", limit: int = MAX_DOCS) -> Model:
    rows = learning_rows(docs, labels, label, limit).withColumns({
        "half": F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2)), "part": F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(5))})
    n, toxic = rows.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    if not 0 < toxic < n:
        return Model([], None, None, toxic / n if n else 0.0)
    lexicons = learn_lexicons(rows)
    known = stored(features(rows.withColumn("label", F.col("y").cast("double")), lexicons, "doc_id", "half", "part", "label"), "features")
    fit, rest = known.where("part > 0"), known.where("part = 0")
    if fit.select("label").distinct().count() < 2 or rest.select("label").distinct().count() < 2:
        fit = rest = known
    trees = GBTClassifier(maxIter=20, maxDepth=3, stepSize=0.3, seed=1).fit(fit.coalesce(1).sortWithinPartitions("doc_id"))
    told = trees.transform(rest).select("label", _margin())
    calibration = IsotonicRegression(featuresCol="margin", labelCol="label").fit(told)
    return Model(lexicons, trees, calibration, toxic / n)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    model = train(docs, labels)
    if model.trees is None:
        scored = docs.select("doc_id", F.lit(model.share).alias("score"))
    else:
        margins = model.trees.transform(features(docs, model.lexicons, "doc_id")).select("doc_id", _margin())
        scored = model.calibration.transform(margins).select("doc_id", F.greatest(F.lit(0.0), F.least(F.lit(1.0), "prediction")).alias("score"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
