"""Language identification with a linear-chain conditional random field over words.

A word's features are its first and last bytes, its byte n-grams and the word itself; a state is a
language. Emission weights and transitions are learned together by the gradient of the sequence
likelihood, so that a word of an unclear language leans on its neighbours, also where a text switches. The forward-backward
algorithm gives every word's chances, and a document the language of most of its words.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import is_letter, lowered, mixed, slices, text_buffer, word_bounds, word_hashes

#: Blocks of each language that are learned from, at most: those of smallest hash. Words in a block.
SAMPLE, BLOCK = 3000, 32
#: Feature weights for each language are kept in so many places, found by hash.
PLACES = 1 << 18
AFFIXES, GRAMS = (1, 2, 3, 4), (2, 3)
#: Parts of a language whose blocks are numbered before those of all parts.
PARTS = 64
UNKNOWN = "und"


def words_of(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case bytes, and starts, ends and row offsets of the runs of letters."""
    raw, offsets = text_buffer(texts)
    raw = lowered(raw)
    return raw, *word_bounds(raw, offsets, is_letter(raw))


def word_features(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the features of words, one word after the other, and the n + 1 offsets of the words."""
    n, sizes = len(starts), ends - starts
    owner, keys = [np.arange(n)], [word_hashes(raw, starts, ends)]
    for k in AFFIXES:
        long = np.flatnonzero(sizes >= k)
        for side, at in ((1, starts[long]), (2, ends[long] - k)):
            code = np.full(len(long), k * 4 + side, np.uint64)
            for j in range(k):
                code = code << np.uint64(8) | raw[at + j].astype(np.uint64)
            owner.append(long)
            keys.append(code)
    inner = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    at, word = np.repeat(starts, sizes) + inner, np.repeat(np.arange(n), sizes)
    for k in GRAMS:
        fits = inner + k <= np.repeat(sizes, sizes)
        code = np.full(int(fits.sum()), k * 4 + 3, np.uint64)
        for j in range(k):
            code = code << np.uint64(8) | raw[at[fits] + j].astype(np.uint64)
        owner.append(word[fits])
        keys.append(code)
    owner, keys = np.concatenate(owner), np.concatenate(keys)
    order = np.argsort(owner, kind="stable")
    places = (mixed(keys[order]) % np.uint64(PLACES)).astype(np.int32)
    return places, np.searchsorted(owner[order], np.arange(n + 1))


def blocks_of(rows: np.ndarray, size: int = BLOCK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first word and length of each block of at most `size` words."""
    sizes = np.diff(rows)
    n = -(-sizes // size)
    row = np.repeat(np.arange(len(sizes)), n)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    first = rows[row] + nth * size
    return row, first, np.minimum(size, rows[row + 1] - first)


def forward_backward(scores: np.ndarray, lengths: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Chances of the states of every word, expected transitions, and the log of the partition functions' product.

    `scores` is blocks x words x states, padded behind the `lengths`; `moves` holds transition scores.
    """
    blocks, longest, states = scores.shape
    top = scores.max(axis=2, keepdims=True)
    emit = np.exp(scores - top)
    high = moves.max()
    step = np.exp(moves - high)
    ahead, scale = np.empty_like(emit), np.ones((blocks, longest))
    for t in range(longest):
        a = emit[:, t] if t == 0 else (ahead[:, t - 1] @ step) * emit[:, t]
        scale[:, t] = a.sum(axis=1)
        ahead[:, t] = a / scale[:, t, None]
    behind, expected = np.ones_like(emit), np.zeros_like(moves)
    inside = np.arange(longest)[None, :] < lengths[:, None]
    for t in range(longest - 2, -1, -1):
        onward = inside[:, t + 1]
        later = emit[:, t + 1] * behind[:, t + 1] / scale[:, t + 1, None]
        behind[:, t] = np.where(onward[:, None], later @ step.T, 1.0)
        expected += (ahead[:, t] * onward[:, None]).T @ later * step
    chance = ahead * behind
    chance /= chance.sum(axis=2, keepdims=True)
    total = float(((np.log(scale) + top[:, :, 0]) * inside).sum() + high * np.maximum(lengths - 1, 0).sum())
    return chance, expected, total


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray
    moves: np.ndarray

    def chances(self, texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """States' chances of every word, the words' bounds, and the n + 1 offsets of the rows in words."""
        raw, starts, ends, rows = words_of(texts)
        _, first, which = np.unique(word_hashes(raw, starts, ends), return_index=True, return_inverse=True)
        states = len(self.languages)
        scores = np.zeros((len(first), states), np.float32)
        for at in range(0, len(first), 20_000):
            some = first[at:at + 20_000]
            places, offsets = word_features(raw, starts[some], ends[some])
            scores[at:at + len(some)] = np.add.reduceat(self.weights[places], offsets[:-1], axis=0)
        out = np.empty((len(starts), states), np.float32)
        _, begin, lengths = blocks_of(rows)
        order = np.argsort(-lengths, kind="stable")
        for at in range(0, len(order), 4096):
            b, n = begin[order[at:at + 4096]], lengths[order[at:at + 4096]]
            inside = np.arange(n[0])[None, :] < n[:, None]
            place = np.where(inside, b[:, None] + np.arange(n[0])[None, :], b[:, None])
            found, _, _ = forward_backward(scores[which[place]], n, self.moves)
            out[place[inside]] = found[inside]
        return out, starts, ends, rows


def fit(texts: pa.Array | pa.ChunkedArray, languages: list[str], truth: np.ndarray, rounds: int = 3, batch: int = 64) -> Model:
    """A model of texts, at most a block of words each, whose words all have the language of their text."""
    raw, starts, ends, rows = words_of(texts)
    states = len(languages)
    model = Model(languages, np.zeros((PLACES, states), np.float32), np.zeros((states, states)))
    _, first, which = np.unique(word_hashes(raw, starts, ends), return_index=True, return_inverse=True)
    places, offsets = word_features(raw, starts[first], ends[first])
    row, begin, lengths = blocks_of(rows)
    rng = np.random.default_rng(11)
    past, past_moves = np.full((PLACES, states), 1e-6, np.float32), np.full((states, states), 1e-6)
    for _ in range(rounds):
        for some in np.array_split(rng.permutation(len(begin)), max(1, math.ceil(len(begin) / batch))):
            if not len(some):
                continue
            n = lengths[some]
            inside = np.arange(n.max())[None, :] < n[:, None]
            words, at = np.unique(which[np.where(inside, begin[some, None] + np.arange(n.max())[None, :], begin[some, None])], return_inverse=True)
            at = at.reshape(inside.shape)
            sizes = offsets[words + 1] - offsets[words]
            flat = places[np.repeat(offsets[words], sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)]
            emission = np.add.reduceat(model.weights[flat], np.cumsum(sizes) - sizes, axis=0)
            chance, expected, _ = forward_backward(emission[at].astype(float), n, model.moves)
            state = truth[row[some]]
            slope = chance * inside[:, :, None]
            slope[np.arange(len(some))[:, None], np.arange(inside.shape[1])[None, :], state[:, None]] -= inside
            by_word = np.stack([np.bincount(at.ravel(), weights=slope[:, :, s].ravel(), minlength=len(words)) for s in range(states)], axis=1)
            which_place, back = np.unique(flat, return_inverse=True)
            own = np.repeat(by_word, sizes, axis=0)
            grad = np.stack([np.bincount(back, weights=own[:, s], minlength=len(which_place)) for s in range(states)], axis=1)
            grad += 0.01 * model.weights[which_place]
            past[which_place] += grad * grad
            model.weights[which_place] -= 0.2 * grad / np.sqrt(past[which_place])
            # a ridge keeps changes of language possible, though no text of one language shows any
            seen = np.zeros((states, states))
            np.add.at(seen, (state, state), np.maximum(n - 1, 0))
            grad = (expected - seen) / n.sum() + 0.02 * model.moves
            past_moves += grad * grad
            model.moves -= 0.1 * grad / np.sqrt(past_moves)
    return model


def train(docs: DataFrame, learn: Column, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> Model:
    """A model of the documents with a language for which `learn`, an expression of `doc_id`, is true.

    Their whole texts are cut in blocks of BLOCK words; at most `sample` blocks of each language are learned
    from, those of smallest hash, equal ones once. Null texts and languages teach nothing.
    """
    labelled = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    labelled = labelled.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[str, dict[int, bytes]] = {}
        for batch in (part for whole in batches for part in slices(whole)):
            raw, starts, ends, rows = words_of(batch.column("text"))
            row, first, size = blocks_of(rows)
            if not len(first):
                continue
            data, names = raw.tobytes(), batch.column("lang").to_pylist()
            # a hash of all words of a block; those of one hash are told apart by their text
            key = mixed(np.add.reduceat(word_hashes(raw, starts, ends), first) + size.astype(np.uint64))
            taken = Counter()
            for b in np.argsort(key, kind="stable").tolist():
                name = names[row[b]]
                taken[name] += 1
                if taken[name] <= sample:
                    block, mine = data[starts[first[b]]:ends[first[b] + size[b] - 1]], best.setdefault(name, {})
                    mine[int(key[b])] = min(block, mine.get(int(key[b]), block))
            for name, mine in best.items():
                best[name] = dict(sorted(mine.items())[:sample])
        rows = [(block, name, key) for name, mine in best.items() for key, block in mine.items()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string()),
             pa.array(np.array([r[2] for r in rows], np.uint64).view(np.int64))], ["block", "lang", "key"])

    blocks = labelled.mapInArrow(cut, "block binary, lang string, key bigint").groupBy("lang", "key").agg(F.min("block").alias("block"))
    order = F.expr("shiftrightunsigned(key, 1)")
    # parts of a language first, so that no task sorts what all tasks found of it
    part = F.pmod("key", F.lit(PARTS))
    within, over = Window.partitionBy("lang", part).orderBy(order, "key"), Window.partitionBy("lang").orderBy(order, "key")
    some = blocks.withColumn("nth", F.row_number().over(within)).where(F.col("nth") <= sample)
    table = some.withColumn("nth", F.row_number().over(over)).where(F.col("nth") <= sample).orderBy("lang", order, "key").toArrow()
    languages = sorted(set(table.column("lang").to_pylist()))
    if not languages:
        return Model([], np.zeros((PLACES, 0), np.float32), np.zeros((0, 0)))
    truth = np.array([languages.index(x) for x in table.column("lang").to_pylist()])
    return fit(table.column("block"), languages, truth)


def identifier(docs: DataFrame, model: Model, filtered: bool = False):
    """A function of a text column that gives its language, score and runs of words; `docs` only names the session.

    With `filtered` a filter by what it gives reads that; Spark would else find each text's language once for the filter and once more for what is kept.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.weights, model.moves.astype(np.float32)))  # of fixed size

    @F.arrow_udf("struct<lang:string,score:double,words:array<struct<lang:string,n:int>>>")
    def identified(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        own = Model(*shared.value)
        for texts, lettered in batches:
            pairs = pa.RecordBatch.from_arrays([texts, lettered], ["text", "lettered"])
            parts = [_named(own, part.column("text"), part.column("lettered")) for part in slices(pairs)]
            yield pa.concat_arrays(parts) if parts else _named(own, texts, lettered)

    found = identified.asNondeterministic() if filtered else identified

    def apply(text: Column) -> Column:
        return found(text, F.coalesce(text.rlike(r"\p{L}"), F.lit(False)))

    return apply


def _named(model: Model, texts: pa.Array, lettered: pa.Array) -> pa.Array:
    lettered = lettered.to_numpy(zero_copy_only=False)
    if model.languages:
        chance, _, _, rows = model.chances(texts)
        sums = np.concatenate([np.zeros((1, len(model.languages))), np.cumsum(chance, axis=0, dtype=float)])
        share = (sums[rows[1:]] - sums[rows[:-1]]) / np.maximum(np.diff(rows), 1)[:, None]
        best, state = share.argmax(axis=1), chance.argmax(axis=1)
        new = np.ones(len(state), bool)
        new[1:] = state[1:] != state[:-1]
        new[rows[:-1][np.diff(rows) > 0]] = True
        begin = np.flatnonzero(new)
        sizes = np.diff(np.append(begin, len(state)))
        runs = pa.ListArray.from_arrays(np.searchsorted(begin, rows).astype(np.int32), pa.StructArray.from_arrays(
            [pa.array(model.languages).take(pa.array(state[begin])), pa.array(sizes.astype(np.int32))], ["lang", "n"]))
        lang = [model.languages[b] if ok else UNKNOWN for b, ok in zip(best, lettered, strict=True)]
        score = np.where(lettered, np.clip(share[np.arange(len(best)), best], 0, 1), 0.0)
    else:
        lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
        runs = pa.array([[]] * len(texts), pa.list_(pa.struct([("lang", pa.string()), ("n", pa.int32())])))
    return pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score), runs], ["lang", "score", "words"])


def predict(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id, lang_pred, score, words` of every row: the language of most words and its share of their chances.

    `words` has the runs of words that go to one language, as (lang, n), in order. The language is `und`, with
    score 0, for null texts, texts without a letter and a model that has learned nothing. Repeated rows stay
    apart, an empty table gives no rows, other columns are not kept. Rows stay where they are read.
    """
    found = identifier(docs, model)(F.col(text).cast("string"))
    named = docs.select(F.col(doc_id).alias("doc_id"), found.alias("found"))
    return named.select("doc_id", F.col("found.lang").alias("lang_pred"), "found.score", "found.words")
