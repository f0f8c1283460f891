"""Write 8-bit RGB PNG files with the standard library."""

import struct
import zlib

import numpy as np


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def write_png(path, pixels: np.ndarray) -> None:
    height, width, _ = pixels.shape
    rows = b"".join(b"\0" + pixels[y].tobytes() for y in range(height))
    header = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    path.write_bytes(b"\x89PNG\r\n\x1a\n" + _chunk(b"IHDR", header) + _chunk(b"IDAT", zlib.compress(rows)) + _chunk(b"IEND", b""))
