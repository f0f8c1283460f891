"""Toxicity by class-conditional Kneser-Ney models.

Each class has a model of words; what it discounts goes to a model that spells words in byte n-grams, of
which the longest are the class's own and the shorter ones count, over both classes, how many different
continuations they have. So rare expressions, also those never seen, are judged by spellings
that both classes share. A document's score compares its log-likelihoods, normalised by length, over
the whole text and over its most telling stretches.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import is_letter, lowered, slices, text_buffer, word_bounds, word_hashes

#: Labelled documents that are learned from, at most, of each class; those of smallest hash.
SAMPLE = 8000
ORDER = 5
DISCOUNT = 0.75
#: Words in the stretches of a text that are compared beside the whole.
STRETCHES = (1, 8)
_EDGE = 0x01


def letters(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case bytes, and starts, ends and row offsets of the runs of letters."""
    raw, offsets = text_buffer(texts)
    raw = lowered(raw)
    return raw, *word_bounds(raw, offsets, is_letter(raw))


def spellings(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """Byte n-grams of words, edges before and one behind, and the n + 1 offsets of the words: the last byte lowest."""
    sizes = ends - starts + 1
    at = np.cumsum(sizes + order - 1) - (sizes + order - 1)
    laid = np.full(int((sizes + order - 1).sum()), _EDGE, np.uint8)
    inner = np.arange(int((sizes - 1).sum())) - np.repeat(np.cumsum(sizes - 1) - (sizes - 1), sizes - 1)
    laid[np.repeat(at + order - 1, sizes - 1) + inner] = raw[np.repeat(starts, sizes - 1) + inner]
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    here = np.arange(offsets[-1]) - np.repeat(offsets[:-1], sizes) + np.repeat(at + order - 1, sizes)
    grams = np.zeros(len(here), np.uint64)
    for k in range(order):
        grams |= laid[here - k].astype(np.uint64) << np.uint64(8 * k)
    return grams, offsets


def _summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    every, at = np.unique(keys, return_inverse=True)
    return every, np.bincount(at, weights=weights, minlength=len(every))


def _at(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, missing: float) -> np.ndarray:
    if not len(keys):
        return np.full(len(wanted), missing)
    place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[place] == wanted, values[place], missing)


class Shorter:
    """Interpolated Kneser-Ney chances from continuation counts that both classes share."""

    def __init__(self, grams: np.ndarray):
        self.levels = []
        for n in range(ORDER - 1, 0, -1):
            # a gram counts as often as different bytes stand before it
            grams = np.unique(grams)
            grams, counts = np.unique(grams & np.uint64((1 << 8 * n) - 1), return_counts=True)
            contexts, total = _summed(grams >> np.uint64(8), counts)
            _, kinds = _summed(grams >> np.uint64(8), np.ones(len(grams)))
            self.levels.append((n, grams, counts.astype(float), contexts, total, kinds))

    def chance(self, grams: np.ndarray) -> np.ndarray:
        p = np.full(len(grams), 1 / 256)
        for n, keys, counts, contexts, total, kinds in reversed(self.levels):
            own = grams & np.uint64((1 << 8 * n) - 1)
            whole = _at(contexts, total, own >> np.uint64(8), 0)
            spare = DISCOUNT * _at(contexts, kinds, own >> np.uint64(8), 0)
            used = np.maximum(_at(keys, counts, own, 0) - DISCOUNT, 0)
            p = np.where(whole > 0, (used + spare * p) / np.maximum(whole, 1), p)
        return p


@dataclass
class Model:
    """Log-likelihood ratios: of words, of longest grams, of contexts where the gram is new, of a new word."""

    words: np.ndarray
    word_ratio: np.ndarray
    grams: np.ndarray
    gram_ratio: np.ndarray
    contexts: np.ndarray
    context_ratio: np.ndarray
    new_word: float
    #: Weights of the features, the first one constant.
    weights: np.ndarray | None = None

    def ratios(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """log P(word | toxic) - log P(word | ordinary) of every word."""
        hashes = word_hashes(raw, starts, ends)
        every, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        out = _at(self.words, self.word_ratio, every, np.nan)
        new = np.flatnonzero(np.isnan(out))
        if len(new):
            grams, offsets = spellings(raw, starts[first[new]], ends[first[new]])
            ratio = _at(self.grams, self.gram_ratio, grams, np.nan)
            other = np.flatnonzero(np.isnan(ratio))
            # both classes back off to the same shorter grams: only their spare mass differs
            ratio[other] = _at(self.contexts, self.context_ratio, grams[other] >> np.uint64(8), 0.0)
            out[new] = self.new_word + np.add.reduceat(ratio, offsets[:-1])
        return out[which]

    def features(self, texts: pa.Array | pa.ChunkedArray) -> np.ndarray:
        """Per text: 1, the mean ratio, and the largest means over stretches of few words."""
        raw, starts, ends, rows = letters(texts)
        n = len(rows) - 1
        ratio = self.ratios(raw, starts, ends) if len(starts) else np.zeros(0)
        sums = np.concatenate([[0.0], np.cumsum(ratio)])
        sizes = np.diff(rows)
        out = [np.ones(n), (sums[rows[1:]] - sums[rows[:-1]]) / np.maximum(sizes, 1)]
        filled = np.flatnonzero(sizes > 0)
        owner_end = np.repeat(rows[1:], sizes)
        at = np.arange(len(ratio))
        for width in STRETCHES:
            stop = np.minimum(at + width, owner_end)
            mean = (sums[stop] - sums[at]) / np.minimum(width, np.repeat(sizes, sizes))
            best = np.zeros(n)
            if len(filled):
                best[filled] = np.maximum.reduceat(mean, rows[:-1][filled])
            out.append(best)
        return np.stack(out, axis=1)

    def score(self, texts: pa.Array | pa.ChunkedArray) -> np.ndarray:
        if self.weights is None:
            return np.zeros(len(texts))
        return 1 / (1 + np.exp(-np.clip(self.features(texts) @ self.weights, -700, 700)))


def build(words: list[bytes], toxic: np.ndarray, ordinary: np.ndarray) -> Model:
    """The two classes' models from the number of documents of each class that have a word."""
    sizes = np.array([len(w) for w in words], np.int64)
    raw = np.frombuffer(b" ".join(words), np.uint8)
    starts = np.cumsum(sizes + 1) - sizes - 1
    ends = starts + sizes
    grams, offsets = spellings(raw, starts, ends)
    shared = Shorter(grams)
    counts = np.stack([toxic, ordinary]).astype(float)
    keys, at = np.unique(grams, return_inverse=True)
    contexts, up = np.unique(keys >> np.uint64(8), return_inverse=True)
    lower = shared.chance(keys)
    chance, spare, new = [], [], []
    for c in counts:
        own = np.bincount(at, weights=np.repeat(c, np.diff(offsets)), minlength=len(keys))
        whole = np.bincount(up, weights=own, minlength=len(contexts))
        kinds = np.bincount(up, weights=own > 0, minlength=len(contexts))
        left = np.where(whole > 0, DISCOUNT * kinds / np.maximum(whole, 1), 1.0)
        spare.append(np.log(left))
        chance.append(np.log(np.maximum(own - DISCOUNT, 0) / np.maximum(whole, 1)[up] + left[up] * lower))
        new.append(math.log(max(DISCOUNT * (c > 0).sum(), 1) / max(c.sum(), 1)))
    spelled = [np.add.reduceat(p[at], offsets[:-1]) for p in chance]
    word = [np.log(np.maximum(c - DISCOUNT, 0) / max(c.sum(), 1) + np.exp(n + s)) for c, n, s in zip(counts, new, spelled, strict=True)]
    hashes = word_hashes(raw, starts, ends)
    order = np.argsort(hashes)
    return Model(hashes[order], (word[0] - word[1])[order], keys, chance[0] - chance[1], contexts, spare[0] - spare[1], new[0] - new[1])


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3, rounds: int = 50) -> np.ndarray:
    """Weights of a logistic regression by Newton's method."""
    scale = np.maximum(np.abs(x).max(axis=0), 1e-9)
    x = x / scale
    w = np.zeros(x.shape[1])
    total = weight.sum()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - y)) / total + ridge * w
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x / total + ridge * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w / scale


def train(docs: DataFrame, labels: DataFrame, learn: Column, doc_id: str = "doc_id", text: str = "text",
          toxic: str = "toxic", sample: int = SAMPLE) -> Model:
    """A model of labelled documents for which `learn`, an expression of `doc_id`, is true.

    At most `sample` documents of each class, those whose ids have the smallest hashes, are learned from, so the
    model has a bounded size. Word counts come from all of them; the weights of the comparison are fitted
    on half of them with counts of the other half. Null labels, ids and texts teach nothing. With no
    labelled documents of one class every score is the share of toxic labels.
    """
    named = labels.select(F.col(doc_id).alias("doc_id"), (F.col(toxic) > 0).cast("int").alias("toxic"))
    named = named.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & learn)
    totals = {r.toxic: r.n for r in named.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    rank = F.xxhash64("doc_id")
    picked = [named.where(F.col("toxic") == c).orderBy(rank, "doc_id").limit(sample) for c in (0, 1)]
    picked = picked[0].unionByName(picked[1])
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).where("text IS NOT NULL")
    # at most 2 * sample rows, so that no text has to move to meet its label
    joined = source.join(F.broadcast(picked), "doc_id").withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)).cast("int"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            raw, starts, ends, rows = letters(batch.column("text"))
            data, out = raw.tobytes(), {}
            for r, (c, fold) in enumerate(zip(batch.column("toxic").to_pylist(), batch.column("fold").to_pylist(), strict=True)):
                for w in {data[a:b] for a, b in zip(starts[rows[r]:rows[r + 1]], ends[rows[r]:rows[r + 1]], strict=True)}:
                    key = w, c, fold
                    out[key] = out.get(key, 0) + 1
            if out:
                w, c, fold = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(w, pa.binary()), pa.array(c, pa.int32()), pa.array(fold, pa.int32()), pa.array(out.values(), pa.int64())],
                    ["word", "toxic", "fold", "n"])

    cell = lambda c, f: F.sum(F.when((F.col("toxic") == c) & (F.col("fold") == f), F.col("n")).otherwise(0)).alias(f"n{c}{f}")
    words = joined.select("text", "toxic", "fold").mapInArrow(counted, "word binary, toxic int, fold int, n bigint").groupBy("word").agg(
        *[cell(c, f) for c in (0, 1) for f in (0, 1)])
    table = words.toArrow()
    names = table.column("word").to_pylist()
    n = {k: table.column(k).to_numpy() for k in ("n00", "n01", "n10", "n11")}
    share = totals.get(1, 0) / max(1, sum(totals.values()))
    empty = Model(*[np.zeros(0, np.uint64), np.zeros(0)] * 3, 0.0)
    if not names or not (n["n00"] + n["n01"]).any() or not (n["n10"] + n["n11"]).any():
        clipped = min(max(share, 1e-6), 1 - 1e-6)
        empty.weights = np.array([math.log(clipped / (1 - clipped))] + [0.0] * (1 + len(STRETCHES)))
        return empty
    whole = build(names, n["n10"] + n["n11"], n["n00"] + n["n01"])
    half = np.flatnonzero(n["n00"] + n["n10"])
    some = build([names[i] for i in half], n["n10"][half], n["n00"][half]) if len(half) and n["n10"].any() and n["n00"].any() else whole

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            x = some.features(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), *[pa.array(c) for c in x.T]], ["toxic", *[f"x{k}" for k in range(x.shape[1])]])

    schema = "toxic int, " + ", ".join(f"x{k} double" for k in range(2 + len(STRETCHES)))
    seen = joined.where("fold = 1").select("text", "toxic").mapInArrow(measured, schema).toArrow()
    y = seen.column("toxic").to_numpy().astype(float)
    x = np.stack([seen.column(c).to_numpy() for c in seen.column_names[1:]], axis=1) if len(y) else np.zeros((0, 2 + len(STRETCHES)))
    # classes count as in all labels, not as in the sample
    weight = np.where(y > 0, totals[1] / max(1, min(sample, totals[1])), totals[0] / max(1, min(sample, totals[0])))
    whole.weights = logistic(x, y, weight) if len(y) and 0 < y.mean() < 1 else np.array([0.0, 0.0] + [1.0] * len(STRETCHES))
    return whole


def scorer(docs: DataFrame, model: Model):
    """A function of a text column that gives its score, from 0 to 1; `docs` only names the session."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))  # bounded by the sample

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = Model(**shared.value)
        for texts in batches:
            # in parts, so that a batch of long texts doesn't multiply in memory
            parts = [own.score(part) for part in slices(texts)]
            yield pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return scored


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", least: float = 0.3) -> DataFrame:
    """`doc_id, score, predicted` of every row: `predicted` is 1 from a score of `least` on.

    A null or empty text has no words and the score of the constant. Repeated rows stay apart, an empty table
    gives no rows, other columns are not kept. Rows stay where they are read.
    """
    found = docs.select(F.col(doc_id).alias("doc_id"), scorer(docs, model)(F.col(text).cast("string")).alias("score"))
    return found.withColumn("predicted", (F.col("score") >= least).cast("int"))
