"""BPE encoding and decoding with content-defined chunks.

A rolling hash cuts texts where their content says so, hence a passage that several documents share is cut into the same
chunks in each. A chunk is encoded once and its ids are used again wherever it comes back. A cut may lie inside a word: at
every join the word across it is encoded anew in a window with one whole word of both chunks, and the window is
taken only if these two words get the ids that they have in their chunks. Where they don't, the window grows to the whole
text, so ids always equal those of the library over the whole text.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import give_back, kept, slices, text_buffer

#: A cut every 2**CUT_BITS bytes on average; the rolling hash sees 2**WINDOW_BITS bytes.
CUT_BITS, WINDOW_BITS = 9, 4
#: Bytes of chunks and of ids, and words, that a worker keeps; they are dropped together when there are more.
CACHED_BYTES, CACHED_WORDS = 24 << 20, 400_000
#: Tokens that are joined to texts at once.
LARGEST_JOIN = 1 << 26

_GEAR = np.random.default_rng(11).integers(0, 1 << 32, 256, dtype=np.uint64).astype(np.uint32)
_SPACE = frozenset(b" \t\n\r\x0b\x0c")
#: The word pattern of the public word-level vocabulary, and the same for lower-case ASCII.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Words of these characters only have one normal form, and the pattern finds the same parts in them.
PLAIN = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[A-Za-z\u00c0-\u00ff]+|[0-9]|[^A-Za-z0-9\u00c0-\u00ff]+")


def cut_points(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Starts of all chunks but the first of each row: where the hash of the bytes before is 0, never inside a character."""
    h = _GEAR[raw]
    for k in range(WINDOW_BITS):
        step = 1 << k
        h[step:] = h[step:] + (h[:-step] << np.uint32(step))
    at = np.flatnonzero((h * np.uint32(2_654_435_761)) >> np.uint32(32 - CUT_BITS) == 0) + 1
    at = at[at < len(raw)]
    at = at[(raw[at] & 0xC0) != 0x80]
    # a window that reaches into the row before isn't this text's content
    row = np.searchsorted(offsets, at, "right") - 1
    return at[at - offsets[row] >= 1 << WINDOW_BITS]


class ChunkEncoder:
    """Ids of whole texts by chunks, as packed little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            self.spec = json.load(file)
        del self.spec["model"]  # the rules are enough here
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.by_words = self._drops_space()
        self.words: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.chunks: dict[bytes, tuple] = {}
        self.held = 0
        self.encoded_chunks = self.reused_chunks = 0

    def _drops_space(self) -> bool:
        """Whether the file's rules part texts at white space and drop it, so that words are encoded independently."""
        kinds = lambda part, inner: [part] if part and part["type"] != "Sequence" else (part or {}).get(inner, [])
        normal, before = kinds(self.spec.get("normalizer"), "normalizers"), kinds(self.spec.get("pre_tokenizer"), "pretokenizers")
        local = all(n["type"] in ("NFC", "Lowercase") or n["type"] == "Replace" and n["pattern"] == {"Regex": r"\s+"} and n["content"] == " "
                    for n in normal)
        first = before[0] if before else {}
        parted = (first.get("type") == "Split" and first["behavior"] == "Removed" and first["invert"]
                  and first["pattern"] == {"Regex": WORD_PATTERN}) and before[1:] and before[1].get("add_prefix_space") is False
        plain = all(not set(t["content"].encode()) & _SPACE and not t["single_word"] for t in self.spec.get("added_tokens", []))
        self.lowers = any(n["type"] == "Lowercase" for n in normal)
        self.marks = re.compile("|".join(re.escape(t["content"]) for t in self.spec.get("added_tokens", [])) or "(?!)")
        return bool(local and parted and plain)

    def ids_of(self, texts: list[str]) -> list[bytes]:
        """What the library gives for whole texts."""
        out = []
        for at in range(0, len(texts), 10_000):
            found = self.library.encode_batch(texts[at:at + 10_000], add_special_tokens=False)
            out += [array("I", e.ids).tobytes() for e in found]
        return out

    def learn(self, words: set[bytes]) -> None:
        """Ids of words not met before. Plain words are made of parts that the pattern finds in lower case."""
        if len(self.words) > CACHED_WORDS:
            self.words.clear()
        if len(self.parts) > CACHED_WORDS:
            self.parts.clear()
        cut: dict[bytes, list[str]] = {}
        whole: list[bytes] = []
        for w in words - self.words.keys():
            s = w.decode()
            if PLAIN.fullmatch(s) and not self.marks.search(s):
                cut[w] = PARTS.findall(s.lower() if self.lowers else s)
            else:
                whole.append(w)
        new = list({p for found in cut.values() for p in found} - self.parts.keys())
        self.parts.update(zip(new, self.ids_of(new), strict=True))
        parts = self.parts
        for w, found in cut.items():
            self.words[w] = parts[found[0]] if len(found) == 1 else b"".join([parts[p] for p in found])
        self.words.update(zip(whole, self.ids_of([w.decode() for w in whole]), strict=True))

    def _entry(self, chunk: bytes, words: list[bytes]) -> tuple:
        """Open head, ids of the whole words, open tail, first and last whole word; None for ids where no white space parts it."""
        opens, stays = chunk[0] not in _SPACE, chunk[-1] not in _SPACE
        if opens and stays and len(words) == 1:
            return chunk, None, b"", b"", b""
        inner = words[opens:len(words) - stays]
        ids = b"".join([self.words[w] for w in inner])
        return (words[0] if opens else b"", ids, words[-1] if stays else b"",
                inner[0] if inner else b"", inner[-1] if inner else b"")

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Packed ids of every text; null counts as empty."""
        raw, offsets = text_buffer(texts)
        if not self.by_words:
            return self.ids_of([t or "" for t in texts.to_pylist()])
        if not len(raw):
            return [b""] * len(texts)
        bounds = np.union1d(offsets, cut_points(raw, offsets))
        held = pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(raw))])
        coded = held.dictionary_encode()
        index, distinct = coded.indices.to_pylist(), coded.dictionary.to_pylist()
        if self.held > CACHED_BYTES:
            self.chunks.clear()
            self.held = 0
        new = {c: c.split() for c in distinct if c not in self.chunks}
        self.encoded_chunks += len(new)
        self.reused_chunks += len(index) - len(new)
        self.learn({w for words in new.values() for w in words})
        for c, words in new.items():
            entry = self.chunks[c] = self._entry(c, words)
            self.held += len(c) + len(entry[1] or b"")
        entries = [self.chunks[c] for c in distinct]
        rows = np.searchsorted(bounds, offsets).tolist()
        plans = [self._plan([entries[k] for k in index[a:b]]) for a, b in zip(rows[:-1], rows[1:], strict=True)]
        windows = [*{w for plan in plans for w in plan if type(w) is tuple}]
        self.learn({g for before, _, behind in windows for g in (before, behind) if g})
        joined = dict(zip(windows, self._repair(windows), strict=True))
        out, wrong = [], []
        for row, plan in enumerate(plans):
            ids = [joined[p] if type(p) is tuple else p for p in plan]
            if None in ids:
                wrong.append(row)
                ids = []
            out.append(b"".join(ids))
        for row, ids in zip(wrong, self.ids_of([raw[offsets[r]:offsets[r + 1]].tobytes().decode() for r in wrong]), strict=True):
            out[row] = ids
        return out

    @staticmethod
    def _plan(entries: list[tuple]) -> list:
        """A row's ids in turn: known ones, and windows (whole word before, word across the join, whole word behind)."""
        plan, pending, before = [], b"", b""
        for head, ids, tail, first, last in entries:
            if ids is None:
                pending += head
                continue
            if pending or head:
                plan.append((before, pending + head, first))
                before = pending + head
            if ids:
                plan.append(ids)
                before = last
            pending = tail
        if pending:
            plan.append((before, pending, b""))
        return plan

    def _repair(self, windows: list[tuple[bytes, bytes, bytes]]) -> list[bytes | None]:
        """Ids of the words across joins; None where a neighbour's ids differ from those in its chunk."""
        found = self.ids_of([b" ".join(w for w in window if w).decode() for window in windows])
        out: list[bytes | None] = []
        for (before, _, behind), ids in zip(windows, found, strict=True):
            left, right = self.words[before] if before else b"", self.words[behind] if behind else b""
            fits = len(ids) >= len(left) + len(right) and ids.startswith(left) and ids.endswith(right)
            out.append(ids[len(left):len(ids) - len(right)] if fits else None)
        return out


class Decoder:
    """Texts of packed ids, as the library decodes them with special tokens kept."""

    def __init__(self, encoder: ChunkEncoder):
        self.library = encoder.library
        self.joins = encoder.spec.get("decoder") is None
        size = max(self.library.get_vocab(with_added_tokens=True).values(), default=-1) + 1
        self.tokens = pa.array([self.library.id_to_token(i) or "" for i in range(size)], pa.string())
        self.missing = np.array([self.library.id_to_token(i) is None for i in range(size)])

    def decode(self, packed: list[bytes]) -> pa.Array:
        if not self.joins:
            return pa.array(self.library.decode_batch([np.frombuffer(p, "<u4").tolist() for p in packed], skip_special_tokens=False), pa.large_string())
        ids = np.frombuffer(b"".join(packed), "<u4")
        bounds = np.cumsum([0, *(len(p) // 4 for p in packed)])
        known = ids < len(self.tokens)
        known[known] = ~self.missing[ids[known]]
        if not known.all():  # the library leaves out what it doesn't know
            ids, bounds = ids[known], np.append(0, np.cumsum(known))[bounds]
        if len(ids) > LARGEST_JOIN:  # string offsets of a join are 32 bits wide
            tokens = self.tokens.take(pa.array(ids)).to_pylist()
            return pa.array([" ".join(tokens[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.large_string())
        tokens = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), self.tokens.take(pa.array(ids)))
        return pc.binary_join(tokens, " ").cast(pa.large_string())


def kept_encoder(path: str) -> ChunkEncoder:
    """The encoder of a file, kept by the worker from task to task."""
    return kept(("chunks", path), lambda: ChunkEncoder(path))


def encode(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", decoded: bool = False) -> DataFrame:
    """One row per input row: `doc_id, ids, n_tokens`, and with `decoded` the text that the ids stand for.

    `tokenizer` is the path of a `tokenizers` file that every executor has; special tokens are not added, those in a text are
    recognised, truncation and padding of the file are off. `ids` are packed as little-endian unsigned 32-bit
    numbers. A null or empty text has no ids and decodes to an empty text. Rows that repeat, also with equal or null
    ids, are encoded each for itself; an empty table gives no rows; columns other than the two named are not kept, whatever
    their names. Texts are handled in slices of about two megabytes; a longer one is a slice of its own and has to fit a
    worker. Nothing is shuffled: chunks that come back are looked up in the worker that met them first, in a table of bounded
    size, and a lost executor only costs its own rows. For a file whose rules don't part texts at white space every
    text is encoded whole.
    """
    key = docs.schema[doc_id].dataType
    schema = T.StructType([T.StructField("doc_id", key), T.StructField("ids", T.BinaryType()), T.StructField("n_tokens", T.LongType())]
                          + [T.StructField("decoded", T.StringType())] * decoded)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(kept_encoder(tokenizer)) if decoded else None
        for batch in (s for whole in batches for s in slices(whole)):
            ids = kept_encoder(tokenizer).encode(batch.column("text"))
            columns = [batch.column("doc_id"), pa.array(ids, pa.binary()), pa.array([len(i) // 4 for i in ids], pa.int64())]
            if decoder:
                columns.append(decoder.decode(ids).cast(pa.string()))
            yield pa.RecordBatch.from_arrays(columns, schema.names)
        give_back()

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, schema)


def decode(ids: str | Column, tokenizer: str) -> Column:
    """The text of packed ids, null for null; ids without a token are left out, as the library does."""

    @F.arrow_udf("string")
    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        decoder = Decoder(kept_encoder(tokenizer))
        for part in parts:
            found = decoder.decode([b or b"" for b in part.to_pylist()])
            yield pc.if_else(part.is_valid(), found.cast(pa.string()), pa.scalar(None, pa.string()))

    return run(F.col(ids) if isinstance(ids, str) else ids)
