"""Arrow text buffers as NumPy arrays: words, hashes, packs of documents.

Words are maximal runs of bytes other than space and 0x09 to 0x0D, the same set `bytes.split()` cuts at.
"""

from __future__ import annotations

import ctypes
import math
import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Text that a group of documents handled by one Python call holds on average.
PACK_BYTES = 8 << 20

#: Seconds after which a worker drops what it kept and nobody asked for.
IDLE_SECONDS = 10.0
_kept: dict[tuple, list] = {}
_rng = np.random.default_rng(20_240_601)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_STEP = int(_rng.integers(1, 1 << 62)) * 2 + 1
_WINDOW = _rng.integers(1, 1 << 63, 4096, dtype=np.uint64) | np.uint64(1)
_LONG = 1 << 12
with np.errstate(over="ignore"):
    _POWER = np.cumprod(np.full(_LONG, _STEP & (2**64 - 1), dtype=np.uint64))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets of its rows; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_binary())
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def kept(key: tuple, build: Callable[[], object]):
    """What `build` makes, kept by this worker from task to task while it is asked for now and then."""
    if key not in _kept:
        _kept[key] = [build(), 0.0]
    _kept[key][1] = time.monotonic()
    return _kept[key][0]


def give_back() -> None:
    """Return freed memory to the system: Python workers live on between tasks and stages, beside the executor's heap.

    What was kept for tasks of another kind, and not asked for since, goes too.
    """
    for key in [k for k, (_, used) in _kept.items() if time.monotonic() - used > IDLE_SECONDS]:
        del _kept[key]
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def slices(batch: pa.RecordBatch | pa.Array, size: int = 2 << 20) -> Iterator[pa.RecordBatch | pa.Array]:
    """Parts of a batch, or of its texts, of about `size` bytes of text and a row at least."""
    texts = batch if isinstance(batch, pa.Array) else batch.column("text")
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(lengths) // size
    begin = np.flatnonzero(np.diff(part, prepend=-1))
    for a, b in zip(begin, np.append(begin[1:], len(texts)), strict=True):
        yield batch.slice(int(a), int(b - a))
    give_back()


def lowered(raw: np.ndarray) -> np.ndarray:
    """A to Z in lower case; all other bytes as they are."""
    return np.where((raw >= 65) & (raw <= 90), raw | 32, raw).astype(np.uint8)


def is_space(raw: np.ndarray) -> np.ndarray:
    return (raw == 32) | ((raw >= 9) & (raw <= 13))


def is_letter(raw: np.ndarray) -> np.ndarray:
    """ASCII letters and all bytes of other characters."""
    return (raw >= 128) | (((raw | 32) >= 97) & ((raw | 32) <= 122))


def word_bounds(raw: np.ndarray, offsets: np.ndarray, ink: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the n + 1 offsets of the rows in words; `ink` marks what words are made of."""
    ink = ~is_space(raw) if ink is None else ink
    before = np.zeros(len(raw) + 1, bool)
    before[1:] = ink
    before[offsets] = False
    starts = np.flatnonzero(ink & ~before[:-1])
    after = np.zeros(len(raw) + 1, bool)
    after[:-1] = ink
    after[offsets] = False
    ends = np.flatnonzero(ink & ~after[1:]) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    out = np.empty(len(starts), np.uint64)
    step = 1 << 20
    cuts = np.searchsorted(starts, np.arange(starts[0], ends[-1] + step, step))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if a == b:
            continue
        s, e = starts[a:b], ends[a:b]
        sizes = e - s
        inner = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        value = _BYTE[raw[np.repeat(s, sizes) + inner]]
        value *= _POWER[inner % _LONG]
        if sizes.max() > _LONG:
            value *= mixed((inner // _LONG).astype(np.uint64)) | np.uint64(1)
        out[a:b] = np.add.reduceat(value, np.cumsum(sizes) - sizes) + sizes.astype(np.uint64)
    return mixed(out)


def run_hashes(words: np.ndarray, offsets: np.ndarray, n: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every run of `n` words within a row, and the index of its first word."""
    if len(words) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    keys = _WINDOW[salt * 64:salt * 64 + n]
    out = words[:len(words) - n + 1] * keys[0]
    for k in range(1, n):
        out += words[k:len(words) - n + 1 + k] * keys[k]
    inside = np.zeros(len(words) + 1, bool)
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    inside = rows[:len(words) - n + 1] == rows[n - 1:]
    at = np.flatnonzero(inside)
    return mixed(out[at]), at


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """All bytes of a text column, for sizing groups."""
    return docs.agg(F.sum(F.octet_length(text))).first()[0] or 0


def pack_of(total: int, *columns: str, size: int = PACK_BYTES) -> Column:
    """A pack number for each row, so that a pack holds about `size` bytes of text of any rows."""
    packs = max(1, math.ceil(total / size))
    return F.pmod(F.xxhash64(*columns), F.lit(packs)).cast("int")


def part(column: str, n: int, kept: int) -> Column:
    """True where crc32 of the id as text modulo `n` equals `kept`."""
    return F.coalesce(F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(n)) == kept, F.lit(False))
