"""Image files for the tests: minimal 8-bit PNGs, RGB, RGBA or grey."""

import os
import struct
import zlib

import numpy as np

COLOUR = {1: 0, 3: 2, 4: 6}


def png(pixels: np.ndarray) -> bytes:
    """``pixels``: height x width x channels."""
    def chunk(kind: bytes, data: bytes) -> bytes:
        body = kind + data
        return struct.pack(">I", len(data)) + body + struct.pack(">I", zlib.crc32(body) & 0xFFFFFFFF)

    h, w, c = pixels.shape
    raw = b"".join(b"\x00" + row.astype(np.uint8).tobytes() for row in pixels)
    header = struct.pack(">IIBBBBB", w, h, 8, COLOUR[c], 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", header) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def write_pngs(folder: str, images: dict[int, np.ndarray]) -> None:
    """``images``: id -> channels x height x width."""
    os.makedirs(folder)
    for i, a in images.items():
        with open(os.path.join(folder, f"{i:05d}.png"), "wb") as f:
            f.write(png(a.transpose(1, 2, 0)))
