"""SentencePiece encoding that keeps where every piece comes from, and decoding.

The normaliser replaces, at each place, the longest prefix that the model's compiled character map knows
and records the source byte of everything it writes. Pieces are then cut from the normalised text and
projected through that record to spans of bytes of the original text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words a task keeps the pieces of; they are dropped together when there are more.
CACHED_WORDS = 250_000
#: Fixed value: the sign that stands for a space in pieces.
SPACE = "▁".encode()


def _fields(raw: bytes) -> Iterator[tuple[int, int, bytes | int, bytes]]:
    """Number, wire type, value and whole bytes of each field of a protocol-buffer message."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = raw[at]
            value |= (byte & 127) << shift
            at, shift = at + 1, shift + 7
            if byte < 128:
                return value, at

    at = 0
    while at < len(raw):
        begin = at
        tag, at = varint(at)
        kind = tag & 7
        if kind == 0:
            value, at = varint(at)
        else:
            size, at = varint(at) if kind == 2 else ({1: 8, 5: 4}[kind], at)
            value, at = raw[at:at + size], at + size
        yield tag >> 3, kind, value, raw[begin:at]


class CharacterMap:
    """The compiled map: a double-array trie over UTF-8 whose leaves point at replacements."""

    def __init__(self, compiled: bytes):
        size = int.from_bytes(compiled[:4], "little")
        self.units = np.frombuffer(compiled[4:4 + size], "<u4").tolist()
        self.texts = compiled[4 + size:]
        # first bytes that start some entry, to pass over all other text quickly
        self.first = bytes(b for b in range(256) if self.units and self._child(self._base(0, self.units[0]), b) is not None)

    @staticmethod
    def _base(node: int, unit: int) -> int:
        return node ^ ((unit >> 10) << ((unit & 512) >> 6))

    def _child(self, base: int, byte: int) -> int | None:
        node = base ^ byte
        return node if node < len(self.units) and self.units[node] & 0x800000FF == byte else None

    def longest(self, raw: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest entry that `raw` has at `at`."""
        found, base = None, self._base(0, self.units[0])
        for k in range(at, len(raw)):
            node = self._child(base, raw[k])
            if node is None:
                break
            base = self._base(node, self.units[node])
            if self.units[node] >> 8 & 1:
                found = k + 1 - at, self.units[base] & 0x7FFFFFFF
        if found is None:
            return None
        return found[0], self.texts[found[1]:self.texts.index(b"\0", found[1])]


class Normaliser:
    """Normalised text and, for each of its bytes and its end, the source byte."""

    def __init__(self, model: bytes):
        spec = next((v for n, _, v, _ in _fields(model) if n == 3), b"")
        trainer = next((v for n, _, v, _ in _fields(model) if n == 2), b"")
        found = {n: v for n, _, v, _ in _fields(spec)}
        compiled = found.get(2, b"")
        self.map = CharacterMap(compiled) if compiled else None
        self.dummy, self.squeeze, self.escape = (bool(found.get(n, 1)) for n in (3, 4, 5))
        if any(n == 24 and v for n, _, v, _ in _fields(trainer)):
            raise ValueError("models that put white space after words are not supported")
        self.space = SPACE if self.escape else b" "

    def _replaced(self, raw: bytes) -> tuple[bytes, np.ndarray]:
        """Each longest entry of the map replaced, all else kept character by character."""
        data = np.frombuffer(raw, np.uint8)
        source = np.maximum.accumulate(np.where(data & 0xC0 != 0x80, np.arange(len(data)), 0)) if len(raw) else np.zeros(0, int)
        if self.map is None:
            return raw, source
        out, origin, at, kept = [], [], 0, 0
        lead = re.compile(b"[" + re.escape(self.map.first) + b"]") if self.map.first else re.compile(b"(?!)")
        while (hit := lead.search(raw, at)) is not None:
            found = self.map.longest(raw, hit.start()) if data[hit.start()] & 0xC0 != 0x80 else None
            if found is None:
                at = hit.start() + 1
                continue
            size, text = found
            out += [raw[kept:hit.start()], text]
            origin += [source[kept:hit.start()], np.full(len(text), hit.start())]
            at = kept = hit.start() + size
        return b"".join([*out, raw[kept:]]), np.concatenate([*origin, source[kept:]]).astype(np.int64)

    def __call__(self, raw: bytes) -> tuple[bytes, np.ndarray]:
        text, source = self._replaced(raw)
        source = np.append(source, len(raw))
        data = np.frombuffer(text, np.uint8)
        if self.squeeze:
            blank = data == 32
            keep = ~blank
            keep[1:] |= blank[1:] & ~blank[:-1]
            inked = np.flatnonzero(~blank)
            first, last = (inked[0], inked[-1] + 1) if len(inked) else (len(data), len(data))
            keep[:first] = keep[last:] = False
            at = np.flatnonzero(keep)
            end = source[last]
            data, source = data[at], np.append(source[at], end)
        if not len(data):
            return b"", np.array([len(raw)])
        text = data.tobytes()
        if self.escape:
            wide = np.where(data == 32, 3, 1)
            text, source = text.replace(b" ", SPACE), np.append(np.repeat(source[:-1], wide), source[-1])
        if self.dummy:
            text, source = self.space + text, np.append(np.full(len(self.space), source[0]), source)
        return text, source


class Encoder:
    """Ids and source spans of texts, word by word with the words' pieces remembered."""

    def __init__(self, path: str):
        import sentencepiece

        with open(path, "rb") as file:
            model = file.read()
        self.normalise = Normaliser(model)
        # the library gets text that is normalised already: a model whose own normaliser does nothing
        silent = b"\x0a\x08identity\x18\x00\x20\x00\x28\x00"
        bare = b"".join(whole for n, _, _, whole in _fields(model) if n != 3) + b"\x1a" + bytes([len(silent)]) + silent
        self.library = sentencepiece.SentencePieceProcessor()
        self.library.LoadFromSerializedProto(bare)
        size = self.library.get_piece_size()
        names = [self.library.id_to_piece(i) for i in range(size)]
        # a piece with a space inside would join words: then a text is one "word"
        self.apart = self.normalise.escape and not any("▁" in name.lstrip("▁") for name in names)
        self.surface, self.span = [], []
        for i, name in enumerate(names):
            if self.library.is_byte(i):
                surface = bytes([int(name[3:5], 16)])
            elif self.library.is_control(i):
                surface = b""
            else:
                surface = " ⁇ ".encode() if self.library.is_unknown(i) else name.encode()
            self.surface.append(surface)
            self.span.append(-1 if self.library.is_unknown(i) else len(surface))
        self.end, self.known = self.library.eos_id(), {}

    def _words(self, text: bytes) -> list[bytes]:
        if not self.apart:
            return [text] if text else []
        if SPACE + SPACE in text or text.endswith(SPACE):
            return re.findall(b"(?:" + SPACE + b")*(?:(?!" + SPACE + b")(?s:.))+|(?:" + SPACE + b")+", text)
        first, *rest = text.split(SPACE)
        words = [SPACE + w for w in rest]
        return [first, *words] if first else words

    def _learn(self, words: list[bytes]) -> None:
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        new = [*set(words).difference(self.known)]
        for at in range(0, len(new), 20_000):
            some = new[at:at + 20_000]
            for word, ids in zip(some, self.library.encode([w.decode() for w in some], num_threads=1), strict=True):
                spans = [self.span[i] for i in ids]
                if -1 in spans:
                    pieces = self.library.encode(word.decode(), out_type="immutable_proto").pieces
                    spans = [len(p.surface.encode()) for p in pieces]
                self.known[word] = np.array([ids, spans], "<i4").T.tobytes()

    def encode(self, raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids with the end id, and the first and last source byte of each (the end id's are the text's end)."""
        text, source = self.normalise(raw)
        words = self._words(text)
        self._learn(words)
        ids, spans = np.frombuffer(b"".join(map(self.known.__getitem__, words)), "<i4").reshape(-1, 2).T
        bounds = np.cumsum(spans, dtype=np.int64)
        at = source[np.concatenate([[0], bounds])] if len(ids) else np.array([len(raw)])
        return (np.append(ids, np.int32(self.end)), np.append(at[:-1], len(raw)).astype(np.int32),
                np.append(at[1:], len(raw)).astype(np.int32))

    def decode(self, ids: list[int]) -> bytes:
        """Text of ids: spaces for their signs, one leading space less where the model adds one."""
        text = b"".join(map(self.surface.__getitem__, ids)).decode("utf-8", "replace").encode()
        text = text.replace(SPACE, b" ") if self.normalise.escape else text
        cut = self.normalise.dummy or self.normalise.squeeze
        return text[1:] if cut and text[:1] == b" " else text


def encode(docs: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id, ids, begins, ends` of every row: piece ids closed by the end id, and each one's span of source bytes.

    `model` is the path of a SentencePiece model that every executor has. A byte piece has the span of its
    character if it is the last of it, else an empty one. A null text counts as empty and has the end id
    only. Repeated rows stay apart, other columns are not kept, an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model)
        for batch in batches:
            raws = batch.column(1).cast(pa.large_binary())
            done, held, begin = [], 0, 0
            for k, raw in enumerate(raws):
                done.append(encoder.encode(raw.as_py() or b""))
                held += len(done[-1][0])
                if held > 1 << 20 or k + 1 == len(raws):
                    offsets = np.concatenate([[0], np.cumsum([len(d[0]) for d in done])]).astype(np.int32)
                    lists = [pa.ListArray.from_arrays(offsets, np.concatenate([d[c] for d in done])) for c in range(3)]
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, len(done)), *lists],
                                                     ["doc_id", "ids", "begins", "ends"])
                    done, held, begin = [], 0, k + 1

    key_type = docs.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {key_type}, ids array<int>, begins array<int>, ends array<int>"
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, schema)


def decoder(model: str):
    """A function of an id array column that gives its text; null for null."""

    @F.arrow_udf("string")
    def decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = Encoder(model)
        for ids in batches:
            texts = pa.array([None if row is None else encoder.decode(row) for row in _lists(ids)], pa.binary())
            yield pc.cast(texts, pa.string())

    def apply(ids: Column | str) -> Column:
        return decoded(ids)

    return apply


def _lists(ids: pa.Array) -> Iterator[list[int] | None]:
    values = ids.values.to_numpy(zero_copy_only=False)
    at = ids.offsets.to_numpy()
    for k, valid in enumerate(ids.is_valid().to_pylist()):
        yield values[at[k]:at[k + 1]].tolist() if valid else None
