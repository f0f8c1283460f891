"""Packing by power-of-two decomposition.

A document of n tokens is cut into whole pieces of the longest length, and its rest into one piece for
each binary digit of what is left. Every length is a power of two and pieces of one length form one
bucket, with a range of sequence ids of its own: no sequence crosses documents, none is padded.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import kept_encoder
from .common import kept, slices

#: Word parts that a worker keeps the ids of; they are dropped together when there are more.
CACHED_PARTS = 600_000
#: Parts that the tokenizer takes at once, joined by spaces.
LINE = 200
#: Texts of these characters only have one normal form; the word pattern finds these parts in them. Marks of special tokens need others.
PLAIN = re.compile("[ \t\n\r\x0b\x0c!-;=-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*")
# letters come first, as they are the most frequent: no two alternatives begin with the same character but those after an apostrophe
PARTS = re.compile("[A-Za-z\u00c0-\u00ff]+|[0-9]|'s|'t|'re|'ve|'m|'ll|'d|[^ \t\n\r\x0b\x0cA-Za-z0-9\u00c0-\u00ff]+")
#: Sequences of one length have ids from its power of two times this on.
BUCKET = 1 << 58


def piece_lengths(n: int, longest: int) -> list[int]:
    """Lengths of the pieces of n tokens, from the longest on."""
    if longest & (longest - 1) or longest < 1:
        raise ValueError("the longest piece must be a power of two")
    whole, rest = divmod(n, longest)
    return [longest] * whole + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


class TextIds:
    """Token ids of whole texts as packed bytes.

    Plain texts are cut into the parts that the tokenizer's pattern finds, and each different part is encoded once. All other
    texts, and all texts of files with other rules, are encoded by `bpe.ChunkEncoder`.
    """

    def __init__(self, path: str):
        self.others = kept_encoder(path)
        self.known: dict[str, bytes] = {}

    def encode(self, texts: pa.Array) -> list[bytes]:
        if len(self.known) > CACHED_PARTS:
            self.known.clear()
        out: list[bytes] = [b""] * len(texts)
        rest, open_texts, missing = [], [], set()
        for i, t in enumerate(texts.to_pylist()):
            if t and self.others.by_words and PLAIN.fullmatch(t) and not self.others.marks.search(t):
                parts = PARTS.findall(t.lower() if self.others.lowers else t)
                ids = list(map(self.known.get, parts))
                holes = [(k, parts[k]) for k, x in enumerate(ids) if x is None]
                if holes:
                    missing.update(part for _, part in holes)
                    open_texts.append((i, ids, holes))
                else:
                    out[i] = b"".join(ids)
            elif t:
                rest.append(i)
        new = list(missing)
        self.known.update(zip(new, self._learnt(new), strict=True))
        for i, ids, holes in open_texts:
            for k, part in holes:
                ids[k] = self.known[part]
            out[i] = b"".join(ids)
        for i, ids in zip(rest, self.others.encode(texts.take(pa.array(rest, pa.int64()))), strict=True):
            out[i] = ids
        return out

    def _learnt(self, parts: list[str]) -> list[bytes]:
        """Ids of parts, each of which is one word to the tokenizer: many in one line, told apart by the word that a token is of."""
        lines = [parts[at:at + LINE] for at in range(0, len(parts), LINE)]
        out: list[bytes] = []
        for at in range(0, len(lines), 100):
            found = self.others.library.encode_batch([" ".join(line) for line in lines[at:at + 100]], add_special_tokens=False)
            for line, e in zip(lines[at:at + 100], found, strict=True):
                ids, word = np.array(e.ids, "<u4").tobytes(), np.array(e.word_ids)
                begin = np.flatnonzero(np.diff(word, prepend=-1, append=-1)) * 4
                if len(begin) == len(line) + 1:
                    cuts = begin.tolist()
                    out += [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                else:
                    out += self.others.ids_of(line)
        return out


def kept_ids(path: str) -> TextIds:
    """The ids of a file's parts, kept by the worker from task to task."""
    return kept(("parts", path), lambda: TextIds(path))


def pack(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", end_id: int = 2,
         longest: int = 4096) -> DataFrame:
    """Pieces of every document: `doc_id, start, length, ids, doc_tokens, bucket, sequence_id, offset`.

    `tokenizer` is the path of a `tokenizers` file that every executor has. `ids` are packed as
    little-endian unsigned 32-bit numbers, as token files hold them. A null text counts as empty: its only
    token is the end id. Rows that repeat, also with equal or null ids, are packed each for itself; an empty
    table gives no rows. Columns other than the two named are not kept. Nothing is shuffled: a
    document is cut where it is read. `bucket` is the power of two of a length: sequences of one length have
    ids of one range, and a table `partitionBy("bucket")` has them in one folder. A text is handled as a whole and has to fit a worker.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], "<u4").tobytes()
        for batch in (part for whole in batches for part in slices(whole)):
            rows, held = [], 0
            for key, ids in zip(batch.column(0).to_pylist(), kept_ids(tokenizer).encode(batch.column(1)), strict=True):
                ids += end
                start, n = 0, len(ids) // 4
                for size in piece_lengths(n, longest):
                    rows.append((key, start, size, ids[4 * start:4 * (start + size)], n))
                    start += size
                held += len(ids)
                if held > 16 << 20:
                    yield made(rows)
                    rows, held = [], 0
            if rows:
                yield made(rows)

    key_type = docs.schema[doc_id].dataType
    schema = f"doc_id {key_type.simpleString()}, start bigint, length bigint, ids binary, doc_tokens bigint"
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64()]

    def made(rows: list[tuple]) -> pa.RecordBatch:
        keys, *rest = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(keys), *(pa.array(c, k) for c, k in zip(rest, kinds, strict=True))],
                                          ["doc_id", "start", "length", "ids", "doc_tokens"])

    pieces = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(cut, schema)
    numbered = pieces.withColumn("bucket", F.log2("length").cast("int")).withColumn(
        "sequence_id", F.col("bucket").cast("long") * BUCKET + F.monotonically_increasing_id())
    return numbered.withColumn("offset", F.lit(0).cast("long"))
