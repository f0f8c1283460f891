"""Removal of long word sequences that an earlier document has: prefix-partitioned suffix trees.

Every window of `words` words starts a suffix. Suffixes are split by prefixes of variable length: by their
first word where few enough share it, else by as many more words as it takes for a group to fit in memory.
A group's suffixes, sorted by the hash of their first `words` words, are the leaves of its subtree; a run of
equal ones hangs below one internal node of that depth, a repeat. Of each run the smallest document
stays, and neighbouring windows join to maximal repeats in every other.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, PACK_BYTES, pack_of, run_hashes, slices, text_buffer, text_bytes, word_bounds, word_hashes

#: Suffixes that a group holds, about.
GROUP = 1_000_000
#: Words in a prefix, from level to level.
LEVELS = (1, 2, 3, 5, 8)
NO_ID = np.iinfo(np.int64).max


def _levels(words: int) -> list[int]:
    return [n for n in LEVELS if n < words] + [words]


def _places(hashes: np.ndarray, rows: np.ndarray, at: np.ndarray, n: int, bits: int) -> np.ndarray:
    """The cell, one of 2**bits, of the first n words of the suffixes that start at `at`."""
    runs, starts = run_hashes(hashes, rows, n, salt=1)
    return (runs[np.searchsorted(starts, at)] >> np.uint64(64 - bits)).astype(np.int64)


def _cells(texts: pa.Array, words: int, bits: int) -> np.ndarray:
    """Suffixes of these texts in each prefix cell, for every level."""
    raw, offsets = text_buffer(texts)
    starts, ends, rows = word_bounds(raw, offsets)
    hashes = word_hashes(raw, starts, ends)
    _, at = run_hashes(hashes, rows, words)
    return np.stack([np.bincount(_places(hashes, rows, at, n, bits), minlength=1 << bits) for n in _levels(words)])


def prefix_sizes(docs: DataFrame, words: int, bits: int) -> np.ndarray:
    """Suffixes in each prefix cell, for every level: a table of fixed size."""
    levels = _levels(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(levels), 1 << bits), np.int64)
        for batch in (part for whole in batches for part in slices(whole)):
            counts += _cells(batch.column("text"), words, bits)
        level, cell = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(level.astype(np.int32)), pa.array(cell.astype(np.int32)), pa.array(counts[level, cell])],
                                         ["level", "cell", "n"])

    sizes = np.zeros((len(levels), 1 << bits), np.int64)
    for r in docs.select("text").mapInArrow(run, "level int, cell int, n bigint").groupBy("level", "cell").agg(F.sum("n").alias("n")).collect():
        sizes[r.level, r.cell] = r.n
    return sizes


class Windows:
    """The windows of a pack of documents in order of their ids: each distinct one once, and its prefix group."""

    def __init__(self, ids: pa.ChunkedArray, texts: pa.ChunkedArray, words: int, small: np.ndarray):
        give_back()
        key = ids.to_numpy() if not ids.null_count else ids.fill_null(NO_ID).to_numpy()
        self.order = np.argsort(key, kind="stable")
        self.ids = key[self.order]
        self.missing = texts.is_null().to_numpy()[self.order]
        self.raw, self.offsets = text_buffer(texts.take(pa.array(self.order)))
        self.starts, self.ends, self.rows = word_bounds(self.raw, self.offsets)
        hashes = word_hashes(self.raw, self.starts, self.ends)
        windows, self.at = run_hashes(hashes, self.rows, words)
        self.doc = np.searchsorted(self.rows, self.at, side="right") - 1
        distinct, first, self.which = np.unique(windows, return_index=True, return_inverse=True)
        # in order of first occurrence, that is of the smallest document
        turn = np.argsort(first, kind="stable")
        place = np.empty(len(turn), np.int64)
        place[turn] = np.arange(len(turn))
        self.which, self.first, self.windows = place[self.which], first[turn], distinct[turn]
        levels, bits = _levels(words), small.shape[1].bit_length() - 1
        self.group = np.full(len(turn), -1, np.int64)
        for k, n in enumerate(levels):
            left = np.flatnonzero(self.group < 0)
            if len(left):
                cell = _places(hashes, self.rows, self.at[self.first[left]], n, bits)
                fits = small[k][cell] | (k + 1 == len(levels))
                self.group[left[fits]] = (k << bits) + cell[fits]

    def by_group(self) -> Iterator[tuple[int, np.ndarray]]:
        """Each group and the places of its windows, in order."""
        order = np.argsort(self.group, kind="stable")
        groups, begin = np.unique(self.group[order], return_index=True)
        if len(groups):
            yield from zip(groups.tolist(), np.split(order, begin[1:]), strict=True)


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 13,
                    carry: tuple[str, ...] = (), as_it_was: bool = False, pack_bytes: int = PACK_BYTES) -> DataFrame:
    """`doc_id, text, n_words, n_removed, repeats` of every row: words covered by repeated windows are removed.

    A window is `words` consecutive words; it is repeated where its words also start in a document with a
    smaller id. Windows are judged on the input. `text` is what is left, joined by single spaces; `repeats`
    has the spans of removed words as [first, last + 1]. Null texts have no words. A null id counts as
    greater than all others; rows with the same id don't make each other repeated. An
    empty table gives no rows. With `as_it_was` texts that lose nothing stay as they are, nulls too. Of other columns those in `carry` are kept, as carried_0, carried_1 and so on.

    Every pack of documents sends each of its distinct windows once, so a window of many copies weighs no
    more than there are packs; the answer is one bit for each. A worker holds about twenty times `pack_bytes`; smaller
    packs send a window that many have more often.
    """
    carried = [f"carried_{k}" for k in range(len(carry))]
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"),
                         *[F.col(c).alias(n) for c, n in zip(carry, carried, strict=True)])
    total = text_bytes(source)
    # cells by the number of suffixes, about one for each six bytes
    bits = max(8, math.ceil(math.log2(max(1, total / 6 / GROUP))) + 2)
    small = prefix_sizes(source, words, bits) <= GROUP
    packed = source.withColumn("pack", pack_of(total, "doc_id", "text", size=pack_bytes))

    def offered(table: pa.Table) -> pa.Table:
        w = Windows(table.column("doc_id"), table.column("text"), words, small)
        found = [(g, w.windows[p].tobytes(), *np.unique(w.doc[w.first[p]], return_counts=True)) for g, p in w.by_group()]
        out = pa.table({
            "grp": pa.array([f[0] for f in found], pa.int32()),
            "pack": pa.array([table.column("pack")[0].as_py()] * len(found), pa.int32()),
            "windows": pa.array([f[1] for f in found], pa.binary()),
            "ids": pa.array([np.diff(w.ids[f[2]], prepend=np.int64(0)) for f in found], pa.list_(pa.int64())),
            "counts": pa.array([f[3] for f in found], pa.list_(pa.int32())),
        })
        # an idle worker lives on beside those of the next stage
        del w, found
        give_back()
        return out

    def marked(table: pa.Table) -> list[bytes]:
        suffixes = [np.frombuffer(x.as_py(), np.uint64) for x in table.column("windows")]
        owners = [np.repeat(np.cumsum(np.array(i.as_py(), np.int64)), c.as_py()) for i, c in zip(table.column("ids"), table.column("counts"), strict=True)]
        sizes = np.cumsum([len(s) for s in suffixes])[:-1]
        suffix, owner = np.concatenate(suffixes), np.concatenate(owners)
        order = np.argsort(suffix, kind="stable")
        leaf = suffix[order]
        begin = np.flatnonzero(np.concatenate([[True], leaf[1:] != leaf[:-1]]))
        low = np.minimum.reduceat(owner[order], begin)
        repeated = np.empty(len(suffix), bool)
        repeated[order] = owner[order] > np.repeat(low, np.diff(np.append(begin, len(leaf))))
        return [np.packbits(part).tobytes() for part in np.split(repeated, sizes)]

    def subtree(table: pa.Table) -> pa.Table:
        marks = marked(table)
        give_back()
        return pa.table({"pack": table.column("pack"), "grp": table.column("grp"), "marks": pa.array(marks, pa.binary())})

    def removed(table: pa.Table, answers: pa.Table) -> pa.Table:
        w = Windows(table.column("doc_id"), table.column("text"), words, small)
        marks = dict(zip(answers.column("grp").to_pylist(), answers.column("marks").to_pylist(), strict=True))
        earlier = np.zeros(len(w.windows), bool)
        for g, places in w.by_group():
            earlier[places] = np.unpackbits(np.frombuffer(marks[g], np.uint8))[:len(places)].astype(bool)
        smallest = w.ids[w.doc[w.first]]
        hit = w.at[earlier[w.which] | (w.ids[w.doc] > smallest[w.which])]
        cover = np.zeros(len(w.starts) + 1, np.int32)
        np.add.at(cover, hit, 1)
        np.add.at(cover, hit + words, -1)
        gone = np.cumsum(cover[:-1]) > 0
        texts, cut, spans = [], [], []
        raw = w.raw.tobytes()
        for r in range(len(w.ids)):
            a, b = w.rows[r], w.rows[r + 1]
            own = gone[a:b]
            edges = np.flatnonzero(np.diff(np.concatenate([[False], own, [False]])))
            cut.append(int(own.sum()))
            spans.append(edges.reshape(-1, 2).tolist())
            if not cut[-1] and as_it_was:
                texts.append(None if w.missing[r] else raw[w.offsets[r]:w.offsets[r + 1]])
            elif not cut[-1]:
                texts.append(b" ".join(raw[w.offsets[r]:w.offsets[r + 1]].split()))
            else:
                kept = np.concatenate([[0], edges, [b - a]]).reshape(-1, 2) + a
                texts.append(b" ".join([b" ".join(raw[w.starts[i]:w.ends[j - 1]].split()) for i, j in kept if j > i]))
        order = pa.array(w.order)
        out = pa.table({
            "doc_id": table.column("doc_id").take(order), "text": pa.array(texts, pa.binary()).cast(pa.string()), "n_words": pa.array(np.diff(w.rows)),
            "n_removed": pa.array(cut, pa.int64()), "repeats": pa.array(spans, pa.list_(pa.list_(pa.int32()))),
            **{c: table.column(c).take(order) for c in carried},
        })
        del w, marks, earlier, smallest, hit, cover, gone, texts, spans, raw
        give_back()
        return out

    sent = packed.groupBy("pack").applyInArrow(offered, "grp int, pack int, windows binary, ids array<bigint>, counts array<int>")
    answers = sent.groupBy("grp").applyInArrow(subtree, "pack int, grp int, marks binary")
    return packed.groupBy("pack").cogroup(answers.groupBy("pack")).applyInArrow(
        removed, "doc_id bigint, text string, n_words bigint, n_removed bigint, repeats array<array<int>>" + "".join(
            f", {n} {source.schema[n].dataType.simpleString()}" for n in carried))
