"""Importance resampling towards a target: hashed n-grams by Arrow kernels, Gumbel scores, the highest drawn.

Texts are lowered, split and flattened by Arrow, words become dictionary indices, and shifted indices make pairs and triples.
Only distinct words, pairs and triples get a checksum, each continuing that of its shorter run. Gains are taken by
bucket and reduced over the segments of each document.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from .common import give_back, slices, text_buffer

#: What parts words: all of ASCII but digits and lower-case letters.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Bytes of a text that are turned into features at once.
PIECE = 4 << 20
#: Ranges of scores that are counted at once to find the lowest that is drawn.
RANGES = 4096


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> np.uint32(1)) ^ np.uint32(0xEDB88320), table >> np.uint32(1))
    return table


def _apply(operator: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return (operator[0][crc & 255] ^ operator[1][(crc >> np.uint32(8)) & 255] ^ operator[2][(crc >> np.uint32(16)) & 255]
            ^ operator[3][crc >> np.uint32(24)])


def _operators() -> list[np.ndarray]:
    """For each k, what 2**k zero bytes do to a CRC-32, by its four bytes."""
    zero, basis = _byte_table(), [np.arange(256, dtype=np.uint32) << np.uint32(8 * j) for j in range(4)]
    out = [np.stack([(b >> np.uint32(8)) ^ zero[b & 255] for b in basis])]
    while len(out) < 32:
        out.append(np.stack([_apply(out[-1], _apply(out[-1], b)) for b in basis]))
    return out


_ZEROS = _operators()


def appended(crc: np.ndarray, tail: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of texts with checksum `crc`, each followed by one of `length` bytes with checksum `tail`."""
    out = crc.copy()
    for k in range(int(length.max(initial=0)).bit_length()):
        on = np.flatnonzero(length >> k & 1)
        out[on] = _apply(_ZEROS[k], out[on])
    return out ^ tail


def _pieces(raw: np.ndarray) -> tuple[list[bytes], list[int]]:
    """A long text from word to word, each piece with the two words after it; and the words of its own, -1 for all."""
    ink = ((raw >= 48) & (raw <= 57)) | (((raw | 32) >= 97) & ((raw | 32) <= 122)) | (raw >= 128)
    starts = np.flatnonzero(ink & ~np.append(False, ink[:-1]))
    ends = np.flatnonzero(ink & ~np.append(ink[1:], False)) + 1
    if not len(starts):
        return [b""], [-1]
    first = np.unique(np.searchsorted(starts, np.arange(0, len(raw), PIECE)))
    first = np.append(first[first < len(starts)], len(starts))
    texts, own = [], []
    for a, b in zip(first[:-1], first[1:], strict=True):
        texts.append(raw[starts[a]:ends[min(b + 2, len(starts)) - 1]].tobytes())
        own.append(int(b - a))
    return texts, own


def features(texts: pa.Array, buckets: int, longest: int = 3) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and row of every run of 1 to `longest` words, and the number of words of each row."""
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    if lengths.max(initial=0) > PIECE:
        raw, offsets = text_buffer(texts)
        parts = [_pieces(raw[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        source = pa.array([t.decode() for found, _ in parts for t in found], pa.large_string())
        row_of = np.repeat(np.arange(len(parts)), [len(found) for found, _ in parts])
        own = np.array([n for _, counts in parts for n in counts])
    else:
        source, row_of, own = pc.fill_null(texts, ""), np.arange(len(texts)), np.full(len(texts), -1)
    split = pc.split_pattern_regex(pc.ascii_lower(source), pattern=BETWEEN)
    row = pc.list_parent_indices(split).to_numpy(zero_copy_only=False)
    words = pc.list_flatten(split)
    full = pc.not_equal(pc.binary_length(words), 0)
    words, row = words.filter(full), row[full.to_numpy(zero_copy_only=False)]
    coded = words.dictionary_encode()
    index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    distinct = [w.encode() for w in coded.dictionary.to_pylist()]
    sizes = np.array([len(w) + 1 for w in distinct], np.int64)
    behind = np.array([zlib.crc32(b" " + w) for w in distinct], np.uint32)
    known = np.array([zlib.crc32(w) for w in distinct], np.uint32)
    began = np.searchsorted(row, np.arange(len(source)))
    counted = (own[row] < 0) | (np.arange(len(row)) - began[row] < own[row])
    n_words = np.bincount(row_of[row[counted]], minlength=len(texts))
    found, rows, runs = [], [], index
    for n in range(1, longest + 1):
        if n > 1:
            # a run and the word behind it; equal ones get one index and one checksum
            last = len(index) - n + 1
            if last <= 0:
                break
            inside = row[:last] == row[n - 1:]
            code = np.where(inside, runs[:last] * len(distinct) + index[n - 1:], -1)
            coded = pa.array(code).dictionary_encode()
            runs, pairs = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary.to_numpy(zero_copy_only=False)
            real = pairs >= 0
            word = pairs % len(distinct)
            known = np.where(real, appended(known[np.where(real, pairs // len(distinct), 0)], behind[word], sizes[word]), 0).astype(np.uint32)
            kept = inside & counted[:last]
        else:
            last, kept = len(index), counted
        place = (known % np.uint32(buckets)).astype(np.int32)
        found.append(place[runs[:last][kept]])
        rows.append(row_of[row[:last][kept]])
    return np.concatenate(found) if found else np.zeros(0, np.int32), np.concatenate(rows) if rows else np.zeros(0, np.int64), n_words


def bucket_counts(table: DataFrame, text: str, buckets: int) -> np.ndarray:
    """Features in each bucket, over all texts: added up in each task, then by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for part in (s for batch in batches for s in slices(batch)):
            counts += np.bincount(features(part.column("text"), buckets)[0], minlength=buckets)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(counts[at])], ["bucket", "n"])

    parts = table.select(F.col(text).cast("string").alias("text")).mapInArrow(run, "bucket int, n bigint")
    out = np.zeros(buckets, np.int64)
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most `buckets` rows
        out[r.bucket] = r.n
    return out


def gains_of(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln) of the ratio of smoothed target and source shares, for each bucket."""
    n, s, t = len(source), int(source.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((b + 1) * (s + n) / ((a + 1) * (t + n)))) for a, b in zip(source.tolist(), target.tolist(), strict=True)],
                    np.int64)


def weighed(docs: DataFrame, gains: np.ndarray, doc_id: str, text: str) -> DataFrame:
    """`doc_id, n_words, n_features, weight` of each document."""
    key = docs.schema[doc_id].dataType
    schema = T.StructType([T.StructField("doc_id", key)] + [T.StructField(n, T.LongType()) for n in ("n_words", "n_features", "weight")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (s for batch in batches for s in slices(batch)):
            bucket, row, n_words = features(part.column("text"), len(gains))
            order = np.argsort(row, kind="stable")
            segments = np.searchsorted(row[order], np.arange(part.num_rows + 1))
            total = np.append(0, np.cumsum(gains[bucket[order]]))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(n_words.astype(np.int64)), pa.array(np.diff(segments)), pa.array(np.diff(total[segments]))],
                schema.names)
        give_back()

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, schema)


def noise(doc_id: str, seed: int):
    """floor(-1000 * ln(-ln u)) for a u in (0, 1) that the seed and the id fix."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(name, 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def lowest_drawn(scores: DataFrame, wanted: int) -> int:
    """A score that at least `wanted` rows reach, and few more: ranges of scores are counted, and the last one again in parts."""
    low, high = scores.agg(F.min("score"), F.max("score")).first()
    above = 0
    while True:
        width = max(1, -(-(high - low + 1) // RANGES))
        counts = scores.where(F.col("score").between(low, high)).groupBy(
            F.floor((F.col("score") - low) / width).alias("at")).count().collect()  # at most RANGES rows
        reached = above
        for r in sorted(counts, key=lambda r: -r["at"]):
            reached += r["count"]
            if reached >= wanted:
                break
        low, high = low + r["at"] * width, min(high, low + (r["at"] + 1) * width - 1)
        if width == 1 or reached <= 2 * wanted:
            return low
        above = reached - r["count"]


def ranked(rows: DataFrame, wanted: int) -> DataFrame:
    """`rows` with `rank`, by falling score and rising id, null beyond `wanted`: ranges of the order, counted, then numbered inside."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    parts = cut_lineage(rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    sizes = {r["_part"]: r["count"] for r in parts.groupBy("_part").count().collect()}
    starts, total = [], 0
    for p in range(max(sizes, default=-1) + 1):
        starts.append(F.lit(total).cast("long"))
        total += sizes.get(p, 0)
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    rank = inside + F.element_at(F.array(*starts), F.col("_part") + 1) if starts else F.lit(None).cast("long")
    return parts.withColumn("rank", rank).withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank"))).drop("_part")


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, buckets: int = 10_000, seed: int = 42,
             doc_id: str = "doc_id", text: str = "text", target_text: str = "text") -> DataFrame:
    """`doc_id, n_words, n_features, weight, score, rank` of every document; rank counts those that are drawn, others have none.

    Words are maximal runs of ASCII letters, digits and characters beyond ASCII; only A to Z are lowered. A null or empty text has
    no features and weight 0. Documents with `least_words` words at least may be drawn, `percent` of them, rounded down;
    equal scores go to the smaller id, null ids last; a null id has the noise of an empty one. Rows that
    repeat count each for itself and have equal scores. An empty target gives gains that only the source decides. An empty
    table gives no rows; columns other than those named are not kept. A text longer than PIECE is handled in pieces.

    Two passes over the texts, nothing of which is shuffled: sums of at most `buckets` rows a task, then four numbers a
    document, of which those near the drawn ones are sorted by ranges.
    """
    gains = gains_of(bucket_counts(docs, text, buckets), bucket_counts(target, target_text, buckets))
    scored = cut_lineage(weighed(docs, gains, doc_id, text).withColumn("score", F.col("weight") + noise("doc_id", seed)))
    may = F.col("n_words") >= least_words
    wanted = scored.where(may).count() * percent // 100
    if not wanted:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    near = may & (F.col("score") >= lowest_drawn(scored.where(may), wanted))
    return ranked(scored.where(near), wanted).unionByName(scored.where(~near).withColumn("rank", F.lit(None).cast("long")))
