"""Language-model scores by context-tree weighting over bytes.

A text is spelled as its words, A to Z in lower case, with one space between and an end byte. A byte is
eight binary decisions; each has a tree of contexts, the bytes before it, whose nodes hold
Krichevsky-Trofimov estimates. A node's weight against its children follows from how well either codes the
training text, and a prediction mixes the estimates of all depths along its context.

The trees grow with the corpus and are never in one place. Runs of DEPTH + 1 bytes, with how often training
text has them, are dealt by the two bytes before the last, so that a group has whole subtrees; the answer is
the probability of each run. The two levels above need only the counts of three bytes, a table of at
most 256**3 rows: their weights take the nodes at depth two for leaves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lowered, mixed, pack_of, slices, text_buffer, word_bounds, word_hashes

DEPTH = 5
#: Text of the documents that one call handles, about: a pack's runs take eight times as much.
PACK_BYTES = 4 << 20
#: Never part of UTF-8: before a text and behind it.
END = 0xFF
#: Text whose distinct runs, or words, go to one group, about.
GROUP_BYTES = 12 << 20
END_WORD = np.uint64(0x656E64)


class Spelled:
    """The bytes of a batch's texts as they are coded, and their words."""

    def __init__(self, texts: pa.Array | pa.ChunkedArray, depth: int = DEPTH):
        raw, offsets = text_buffer(texts)
        self.raw = lowered(raw)
        self.starts, self.ends, self.rows = word_bounds(self.raw, offsets)
        n = len(offsets) - 1
        first = np.zeros(len(self.starts), bool)
        first[self.rows[:-1][np.diff(self.rows) > 0]] = True
        keep = np.zeros(len(raw) + 1, bool)
        spans = np.zeros(len(raw) + 1, np.int8)
        spans[self.starts] += 1
        spans[self.ends] -= 1
        keep[:-1] = np.cumsum(spans[:-1], dtype=np.int8) > 0
        gaps = self.starts[~first] - 1
        keep[gaps] = True
        sizes = np.add.reduceat(keep.astype(np.int64), offsets[:-1]) * (np.diff(offsets) > 0) if n else np.zeros(0, np.int64)
        text = self.raw.copy()
        text[gaps] = 32
        text = text[keep[:-1]]
        # each text after `depth` end bytes and before one
        laid = np.full(len(text) + n * (depth + 1), END, np.uint8)
        laid[np.arange(len(text)) + np.repeat(depth * np.arange(1, n + 1) + np.arange(n), sizes)] = text
        self.sizes = sizes + 1
        at = np.arange(len(text) + n) + np.repeat(depth * np.arange(1, n + 1), self.sizes)
        self.begins = np.cumsum(self.sizes) - self.sizes
        # the byte itself lowest, then the bytes before it, the closest one highest
        self.runs = laid[at].astype(np.uint64)
        for k in range(1, depth + 1):
            self.runs |= laid[at - k].astype(np.uint64) << np.uint64(8 * (depth - k + 1))

    def words(self) -> np.ndarray:
        return word_hashes(self.raw, self.starts, self.ends)


def _log_gamma(z: np.ndarray) -> np.ndarray:
    z = z.astype(np.float64)
    low = np.zeros_like(z)
    for k in range(8):
        low += np.log(z + k)
    z = z + 8
    series = 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5)
    return (z - 0.5) * np.log(z) - z + 0.5 * math.log(2 * math.pi) + series - low


def _block(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Natural logarithm of the Krichevsky-Trofimov probability of so many zeros and ones."""
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(zeros + ones + 1.0) - math.log(math.pi)


class Trees:
    """Context trees of the eight decisions, from depth `top` to `depth`, of sorted distinct runs and counts."""

    def __init__(self, runs: np.ndarray, counts: np.ndarray, depth: int, top: int):
        self.depth, self.top, self.nodes = depth, top, {}
        below: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for d in range(depth, top - 1, -1):
            if d < depth:
                runs, at = np.unique((runs >> np.uint64(16) << np.uint64(8)) | (runs & np.uint64(255)), return_inverse=True)
                counts = np.bincount(at, weights=counts, minlength=len(runs)).astype(np.int64)
            for j in range(8):
                keys = runs >> np.uint64(8 - j)
                begin = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
                bit = (runs >> np.uint64(7 - j)) & np.uint64(1)
                whole = np.add.reduceat(counts, begin) if len(keys) else counts
                ones = np.add.reduceat(counts * bit.astype(np.int64), begin) if len(keys) else counts
                keys = keys[begin]
                own = _block(whole - ones, ones)
                if d == depth:
                    lead, total = np.full(len(keys), np.inf), own
                else:
                    child, coded = below[j]
                    up = (child >> np.uint64(j + 8) << np.uint64(j)) | (child & np.uint64((1 << j) - 1))
                    children = np.bincount(np.searchsorted(keys, up), weights=coded, minlength=len(keys))
                    lead, total = own - children, np.logaddexp(own, children) - math.log(2)
                below[j] = keys, total
                self.nodes[d, j] = keys, (ones + 0.5) / (whole + 1.0), 1 / (1 + np.exp(-np.clip(lead, -700, 700)))

    def weigh(self, runs: np.ndarray, depth: int, j: int, chance: np.ndarray) -> np.ndarray:
        """Chance of a one at decision j, mixed from the deepest node upwards; NaN where no node was met."""
        context, byte = runs >> np.uint64(8), runs & np.uint64(255)
        for d in range(self.depth, self.top - 1, -1):
            keys, own, weight = self.nodes[d, j]
            if not len(keys):
                continue
            wanted = (context >> np.uint64(8 * (depth - d)) << np.uint64(j)) | (byte >> np.uint64(8 - j))
            at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            met = keys[at] == wanted
            deeper = ~np.isnan(chance)
            mix = np.where(deeper, weight[at] * own[at] + (1 - weight[at]) * np.where(deeper, chance, 0), own[at])
            chance = np.where(met, mix, chance)
        return chance


def log_chances(runs: np.ndarray, depth: int, deep: Trees, high: Trees) -> np.ndarray:
    """Base-10 logarithm of the probability of the last byte of each run after the others."""
    out = np.zeros(len(runs))
    for j in range(8):
        one = high.weigh(runs, depth, j, deep.weigh(runs, depth, j, np.full(len(runs), np.nan)))
        one = np.where(np.isnan(one), 0.5, one)
        bit = (runs >> np.uint64(7 - j)) & np.uint64(1)
        out += np.log10(np.where(bit == 1, one, 1 - one))
    return out


def _index(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places in sorted distinct `keys` of values that are all among them; by a table, then by search."""
    bits = max(8, (4 * len(keys)).bit_length())
    spread = lambda x: (x * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)).astype(np.int64)
    table = np.zeros(1 << bits, np.int32)
    table[spread(keys)] = np.arange(len(keys), dtype=np.int32)
    at = table[spread(wanted)].astype(np.int64)
    other = np.flatnonzero(keys[at] != wanted)
    at[other] = np.searchsorted(keys, wanted[other])
    return at


def _three_bytes(docs: DataFrame) -> tuple[np.ndarray, np.ndarray, int]:
    """Runs of three bytes in training text with their counts, and the bytes of all text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, size = np.zeros(0, np.uint64), np.zeros(0), 0
        for batch in (part for whole in batches for part in slices(whole)):
            size += len(text_buffer(batch.column("text"))[0])
            texts = batch.column("text").filter(batch.column("train"))
            if len(texts):
                found, times = np.unique(Spelled(texts, 2).runs, return_counts=True)
                keys, at = np.unique(np.concatenate([keys, found]), return_inverse=True)
                counts = np.bincount(at, weights=np.concatenate([counts, times]))
        yield pa.RecordBatch.from_arrays([pa.array(np.append(keys.astype(np.int32), np.int32(-1)), pa.int32()),
                                          pa.array(np.append(counts, size).astype(np.int64))], ["run", "n"])

    rows = docs.select("text", "train").mapInArrow(run, "run int, n bigint").groupBy("run").agg(F.sum("n").alias("n")).toArrow()
    keys, counts = rows.column("run").to_numpy(), rows.column("n").to_numpy()
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    size = int(counts[keys < 0].sum())
    return keys[keys >= 0].astype(np.uint64), counts[keys >= 0].astype(np.int64), size


class Pack:
    """Distinct runs and words of a pack of documents, each with its training count, group by group."""

    def __init__(self, table: pa.Table, word_groups: int, run_groups: int):
        train = table.column("train").to_numpy()
        self.spelled = Spelled(table.column("text"))
        learn = np.repeat(train, self.spelled.sizes)
        self.runs, counts = self._counted(self.spelled.runs, learn)
        group = word_groups + (mixed(self.runs >> np.uint64(8 * DEPTH - 8)) % np.uint64(run_groups)).astype(np.int64)
        self.run_order = np.argsort(group, kind="stable")
        self.words = self.spelled.words()
        rows = self.spelled.rows
        learn = np.append(np.repeat(train, np.diff(rows)), np.ones(int(train.sum()) + 1, bool))
        learn[-1] = False  # the end is looked up also where no training text is
        tokens = np.append(self.words, np.full(int(train.sum()) + 1, END_WORD))
        self.vocabulary, known = self._counted(tokens, learn)
        kinds = (self.vocabulary % np.uint64(word_groups)).astype(np.int64)
        self.word_order = np.argsort(kinds, kind="stable")
        self.parts = []
        # every group of words hears of every pack, so that a pack's answers hold the totals of all groups
        at = np.searchsorted(kinds[self.word_order], np.arange(word_groups + 1))
        for g in range(word_groups):
            places = self.word_order[at[g]:at[g + 1]]
            self.parts.append((g, self.vocabulary[places], known[places]))
        names, begin = np.unique(group[self.run_order], return_index=True)
        for g, places in zip(names.tolist(), np.split(self.run_order, begin[1:]), strict=True):
            self.parts.append((g, self.runs[places], counts[places]))

    @staticmethod
    def _counted(values: np.ndarray, learn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        seen, times = np.unique(values[learn], return_counts=True)
        every = np.union1d(seen, values[~learn])
        counts = np.zeros(len(every), np.int64)
        counts[np.searchsorted(every, seen)] = times
        return every, counts


def score(docs: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte` of every row.

    The model and the base learn from rows where `held_out` is false. Scores are base-10 logarithms of
    probabilities. Tokens are the words, A to Z in lower case, and one end for each text; the base gives a
    token log10((c + 1) / (N + V + 1)) for c, N and V its count, all tokens and distinct tokens of training
    text. `score` codes the same words spelled in bytes, and `bits_per_byte` is its code length by byte.
    A null text counts as empty: an end only. Rows with null ids take part; repeated rows count as often
    as they occur; an empty table gives no rows; without training rows all bytes are equally likely.
    """
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"), (~held_out).alias("train"))
    keys, counts, total = _three_bytes(source)
    high = Trees(keys, counts, 2, 0)
    for j in range(8):  # depth two belongs to the groups
        none = np.zeros(0)
        high.nodes[2, j] = np.zeros(0, np.uint64), none, none
    groups = max(64, math.ceil(total / GROUP_BYTES))
    packed = source.withColumn("pack", pack_of(total, "doc_id", "text", size=PACK_BYTES))

    def offered(table: pa.Table) -> pa.Table:
        pack = Pack(table, groups, groups)
        return pa.table({
            "grp": pa.array([g for g, _, _ in pack.parts], pa.int32()),
            "pack": pa.array([table.column("pack")[0].as_py()] * len(pack.parts), pa.int32()),
            "keys": pa.array([np.diff(k, prepend=np.uint64(0)).tobytes() for _, k, _ in pack.parts], pa.binary()),
            "counts": pa.array([c.astype("<u4").tobytes() for _, _, c in pack.parts], pa.binary()),
        })

    def answered(table: pa.Table) -> pa.Table:
        parts = [np.cumsum(np.frombuffer(k.as_py(), np.uint64), dtype=np.uint64) for k in table.column("keys")]
        times = np.concatenate([np.frombuffer(c.as_py(), "<u4") for c in table.column("counts")]).astype(np.int64)
        every, at = np.unique(np.concatenate(parts), return_inverse=True)
        sums = np.bincount(at, weights=times, minlength=len(every)).astype(np.int64)
        cuts = np.cumsum([len(p) for p in parts])[:-1]
        if table.column("grp")[0].as_py() < groups:
            found = [part.astype("<u8").tobytes() for part in np.split(sums[at], cuts)]
            totals = [(int(sums.sum()), int((sums > 0).sum()))] * len(parts)
        else:
            deep = Trees(every[sums > 0], sums[sums > 0], DEPTH, 2)
            chances = log_chances(every, DEPTH, deep, high).astype("<f4")
            found, totals = [part.tobytes() for part in np.split(chances[at], cuts)], [(0, 0)] * len(parts)
        return pa.table({"pack": table.column("pack"), "grp": table.column("grp"), "found": pa.array(found, pa.binary()),
                         "tokens": pa.array([t[0] for t in totals], pa.int64()), "kinds": pa.array([t[1] for t in totals], pa.int64())})

    def scored(table: pa.Table, answers: pa.Table) -> pa.Table:
        pack = Pack(table, groups, groups)
        answers = answers.sort_by("grp")
        grp = answers.column("grp").to_numpy()
        found = answers.column("found").to_pylist()
        chance = np.empty(len(pack.runs), np.float64)
        chance[pack.run_order] = np.frombuffer(b"".join(found[int((grp < groups).sum()):]), "<f4")
        known = np.empty(len(pack.vocabulary), np.int64)
        known[pack.word_order] = np.frombuffer(b"".join(found[:int((grp < groups).sum())]), "<u8")
        tokens, kinds = int(answers.column("tokens").to_numpy().sum()), int(answers.column("kinds").to_numpy().sum())
        own = pack.spelled
        total = np.add.reduceat(chance[_index(pack.runs, own.runs)], own.begins)
        c = known[_index(pack.vocabulary, pack.words)] if len(pack.words) else np.zeros(0, np.int64)
        end = int(known[np.searchsorted(pack.vocabulary, END_WORD)])
        logs, seen = np.concatenate([[0], np.cumsum(np.log10(c + 1.0))]), np.concatenate([[0], np.cumsum(c > 0)])
        n = np.diff(own.rows) + 1
        base = logs[own.rows[1:]] - logs[own.rows[:-1]] + math.log10(end + 1) - n * math.log10(tokens + kinds + 1)
        return pa.table({
            "doc_id": table.column("doc_id"), "held_out": pa.array(~table.column("train").to_numpy()), "n_tokens": pa.array(n),
            "n_known": pa.array(seen[own.rows[1:]] - seen[own.rows[:-1]] + (end > 0)),
            "train_tokens": pa.array(np.full(len(n), tokens, np.int64)), "base_score": pa.array(base), "score": pa.array(total),
            "n_bytes": pa.array(own.sizes), "bits_per_byte": pa.array(-total * math.log2(10) / own.sizes),
        })

    sent = packed.groupBy("pack").applyInArrow(offered, "grp int, pack int, keys binary, counts binary")
    answers = sent.groupBy("grp").applyInArrow(answered, "pack int, grp int, found binary, tokens bigint, kinds bigint")
    key_type = source.schema["doc_id"].dataType.simpleString()
    return packed.groupBy("pack").cogroup(answers.groupBy("pack")).applyInArrow(
        scored, f"doc_id {key_type}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, "
                "score double, n_bytes bigint, bits_per_byte double")
