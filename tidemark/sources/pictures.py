"""Image files without an imaging library: headers read, JPEG and PNG written."""

from __future__ import annotations

import struct
import zlib

import numpy as np

#: The standard's example tables of quantisation for luminance and chrominance, row by row.
LUMINANCE = (
    16, 11, 10, 16, 24, 40, 51, 61, 12, 12, 14, 19, 26, 58, 60, 55, 14, 13, 16, 24, 40, 57, 69, 56, 14, 17, 22, 29, 51, 87, 80, 62,
    18, 22, 37, 56, 68, 109, 103, 77, 24, 35, 55, 64, 81, 104, 113, 92, 49, 64, 78, 87, 103, 121, 120, 101, 72, 92, 95, 98, 112, 100, 103, 99,
)
CHROMINANCE = (
    17, 18, 24, 47, 99, 99, 99, 99, 18, 21, 26, 66, 99, 99, 99, 99, 24, 26, 56, 99, 99, 99, 99, 99, 47, 66, 99, 99, 99, 99, 99, 99,
    99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99,
)
#: What a PNG's colour type and a JPEG's number of components are called.
PNG_MODES = {0: "L", 2: "RGB", 3: "P", 4: "LA", 6: "RGBA"}
JPEG_MODES = {1: "L", 3: "RGB", 4: "CMYK"}


def header(data: bytes | None) -> tuple[int, int, str] | None:
    """(width, height, mode) from the beginning of a PNG, JPEG or BMP file; None if it is none or ends too early. No pixel is decoded."""
    if data is None:
        return None
    if data[:8] == b"\x89PNG\r\n\x1a\n" and len(data) >= 26:
        width, height, _, kind = struct.unpack(">IIBB", data[16:26])
        return (width, height, PNG_MODES[kind]) if kind in PNG_MODES else None
    if data[:2] == b"BM" and len(data) >= 30:
        width, height = struct.unpack("<ii", data[18:26])
        mode = {1: "1", 4: "P", 8: "P", 24: "RGB", 32: "RGBA"}.get(struct.unpack("<H", data[28:30])[0])
        return (width, abs(height), mode) if mode else None
    if data[:2] != b"\xff\xd8":
        return None
    at = 2
    while at + 4 <= len(data):
        if data[at] != 0xFF:
            return None
        kind = data[at + 1]
        if kind == 0xFF or 0xD0 <= kind <= 0xD8:
            at += 1 if kind == 0xFF else 2
            continue
        if kind in (0xD9, 0xDA):
            return None
        if 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):
            if at + 10 > len(data):
                return None
            height, width, parts = struct.unpack(">HHB", data[at + 5 : at + 10])
            return (width, height, JPEG_MODES[parts]) if parts in JPEG_MODES else None
        at += 2 + struct.unpack(">H", data[at + 2 : at + 4])[0]
    return None


def png(pixels: bytes, width: int, height: int) -> bytes:
    """A PNG of 8-bit grey, RGB or RGBA pixels: lossless, and made with what every Python has."""
    channels = _channels(pixels, width, height, (1, 3, 4))
    row = width * channels
    raw = b"".join(b"\0" + pixels[k * row : (k + 1) * row] for k in range(height))
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    head = struct.pack(">IIBBBBB", width, height, 8, {1: 0, 3: 2, 4: 6}[channels], 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def ppm(pixels: bytes, width: int, height: int) -> bytes:
    """A binary PPM of RGB pixels."""
    _channels(pixels, width, height, (3,))
    return b"P6\n%d %d\n255\n" % (width, height) + pixels


def _channels(pixels: bytes, width: int, height: int, known: tuple[int, ...]) -> int:
    n = len(pixels) // max(1, width * height)
    if n not in known or len(pixels) != width * height * n:
        raise ValueError(f"{len(pixels)} bytes aren't {width} x {height} pixels of {known} bytes")
    return n


def _zigzag() -> np.ndarray:
    """The order of an 8 x 8 block's coefficients along its diagonals."""
    return np.array(sorted(range(64), key=lambda k: (k // 8 + k % 8, k % 8 if (k // 8 + k % 8) % 2 == 0 else k // 8)))


def _bits(value: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The lowest ``size`` bits of each value, one after the other."""
    each = np.unpackbits(value.astype(">u4").view(np.uint8).reshape(-1, 4), axis=1)
    return each[np.arange(32) >= 32 - size[:, None]]


def jpeg(pixels: bytes, width: int, height: int, quality: int = 95) -> bytes:
    """A baseline JPEG of grey or RGB pixels, colours in full resolution.

    The standard lets a file bring its own code tables. Here every symbol has a code of one length (4 bits for DC, 8 for AC), so no table is needed to make them: files are somewhat larger than
    with codes by frequency, and decode to the same pixels.
    """
    n = _channels(pixels, width, height, (1, 3))
    image = np.frombuffer(pixels, np.uint8).reshape(height, width, n).astype(float)
    if n == 3:
        to_ycc = np.array([[0.299, 0.587, 0.114], [-0.168736, -0.331264, 0.5], [0.5, -0.418688, -0.081312]])
        image = image @ to_ycc.T + np.array([0, 128, 128])
    image = np.pad(image, ((0, -height % 8), (0, -width % 8), (0, 0)), mode="edge") - 128
    scale = 5000 / quality if quality < 50 else 200 - 2 * quality
    tables = [np.clip(np.floor((np.array(t) * scale + 50) / 100), 1, 255).astype(int) for t in (LUMINANCE, CHROMINANCE)]
    k = np.arange(8)
    dct = np.sqrt(np.where(k == 0, 1 / 8, 2 / 8))[:, None] * np.cos(np.pi * (2 * k + 1) * k[:, None] / 16)
    rows, cols = image.shape[0] // 8, image.shape[1] // 8
    blocks = image.reshape(rows, 8, cols, 8, n).transpose(0, 2, 4, 1, 3)
    found = np.einsum("ui,...ij,vj->...uv", dct, blocks, dct, optimize=True).reshape(rows * cols, n, 64)
    order = _zigzag()
    whole = np.stack([np.rint(found[:, c] / tables[min(c, 1)]).astype(int)[:, order] for c in range(n)], 1)
    whole[1:, :, 0] -= whole[:-1, :, 0].copy()
    whole = whole.reshape(-1, 64)

    # codes: DC by its size, AC by (zeros before it, size)
    symbols = [0x00, 0xF0, *[r << 4 | s for r in range(16) for s in range(1, 11)]]
    code = np.zeros(256, int)
    code[symbols] = np.arange(len(symbols))
    width_of = lambda v: np.where(v == 0, 0, np.floor(np.log2(np.maximum(np.abs(v), 1))).astype(int) + 1)
    amount = lambda v, s: np.where(v >= 0, v, v + (1 << s) - 1)
    dc, size = whole[:, 0], width_of(whole[:, 0])
    b, at = np.nonzero(whole[:, 1:])
    at += 1
    first = np.r_[True, b[1:] != b[:-1]] if len(b) else np.zeros(0, bool)
    zeros = at - np.where(first, 0, np.r_[0, at[:-1]] if len(b) else at) - 1
    v = whole[b, at]
    s = width_of(v)
    skips = zeros // 16
    ends = np.nonzero(whole[:, 63] == 0)[0]
    parts = [
        (np.arange(len(whole)), np.zeros(len(whole)), size << size | amount(dc, size), size + 4),
        (np.repeat(b, skips), np.repeat(at - 0.5, skips), np.full(skips.sum(), code[0xF0]), np.full(skips.sum(), 8)),
        (b, at.astype(float), code[zeros % 16 << 4 | s] << s | amount(v, s), s + 8),
        (ends, np.full(len(ends), 64.0), np.full(len(ends), code[0x00]), np.full(len(ends), 8)),
    ]
    block, place, value, bits = (np.concatenate(x) for x in zip(*parts))
    along = np.lexsort((place, block))
    value, bits = value[along], bits[along]
    stream = np.concatenate([_bits(value[k : k + 500_000], bits[k : k + 500_000]) for k in range(0, len(value), 500_000)])
    stream = np.concatenate([stream, np.ones(-len(stream) % 8, np.uint8)])
    scan = np.packbits(stream).tobytes().replace(b"\xff", b"\xff\x00")

    part = lambda kind, data: struct.pack(">BBH", 0xFF, kind, len(data) + 2) + data
    out = b"\xff\xd8" + part(0xE0, b"JFIF\0\1\1\0\0\1\0\1\0\0")
    for k in range(min(n, 2)):
        out += part(0xDB, bytes([k]) + bytes(tables[k][order].tolist()))
    out += part(0xC0, struct.pack(">BHHB", 8, height, width, n) + b"".join(bytes([c + 1, 0x11, min(c, 1)]) for c in range(n)))
    out += part(0xC4, bytes([0x00]) + bytes([0, 0, 0, 12, *[0] * 12]) + bytes(range(12)))
    out += part(0xC4, bytes([0x10]) + bytes([0, 0, 0, 0, 0, 0, 0, len(symbols), *[0] * 8]) + bytes(symbols))
    return out + part(0xDA, bytes([n]) + b"".join(bytes([c + 1, 0x00]) for c in range(n)) + bytes([0, 63, 0])) + scan + b"\xff\xd9"
