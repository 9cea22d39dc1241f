"""Media columns: payloads as progressive JPEG, scans accumulated into coefficients, RGB tensors.

``encode_media`` writes bytes as the quantised coefficients of a three-component 4:2:0 progressive
JPEG, 64 bytes a block: for each component a DC scan and scans of two bands of AC coefficients with
successive approximation (lowest bit left out), and a refinement scan of each. All quantiser steps are
1, so the coefficients and with them the bytes survive unchanged. Each code table has one code, or two
for DC, so that all codes of a scan have one length: no coefficient is zero, and there are no runs. ``decode_media`` is a decoder for
progressive JPEG in general: it accumulates spectral-selection and successive-approximation scans
into coefficient arrays, inverse-transforms them with numpy, upsamples the chroma and gives the RGB
tensor. Runs of codes of equal length are decoded as arrays, all else code by code.

Null and empty texts are payloads of 64 zero bytes. Equal payloads give equal files.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .util import map_batches, utf8

BLOCK = 64
#: The zigzag order of the coefficients of a block.
ZIGZAG = np.array([
    0, 1, 8, 16, 9, 2, 3, 10, 17, 24, 32, 25, 18, 11, 4, 5, 12, 19, 26, 33, 40, 48, 41, 34, 27, 20, 13, 6, 7, 14, 21, 28,
    35, 42, 49, 56, 57, 50, 43, 36, 29, 22, 15, 23, 30, 37, 44, 51, 58, 59, 52, 45, 38, 31, 39, 46, 53, 60, 61, 54, 47, 55, 62, 63,
])


def _basis() -> np.ndarray:
    """64 x 64: coefficients in zigzag order to pixels in raster order."""
    k, x = np.mgrid[0:8, 0:8]
    d = np.cos((2 * x + 1) * k * np.pi / 16) * np.where(k == 0, np.sqrt(1 / 8), 0.5)
    return np.kron(d, d)[ZIGZAG].astype(np.float32)


BASIS = _basis()
#: Spectral selection: the bands of AC coefficients, each in scans of its own.
BANDS = ((1, 5), (6, 63))
#: Code tables: how many codes of each length, then the symbols.
DC_TABLE = bytes([1, 1] + [0] * 14) + bytes([10, 9])
AC_FIRST_TABLE = bytes([1] + [0] * 15) + bytes([0x07])
AC_REFINE_TABLE = bytes([1] + [0] * 15) + bytes([0x00])


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def _scan_head(component: int, table: int, first: int, last: int, high: int, low: int) -> bytes:
    return _segment(0xDA, bytes([1, component, table, first, last, high << 4 | low]))


def _stuffed(x: np.ndarray) -> bytes:
    return x.tobytes().replace(b"\xff", b"\xff\x00")


def _packed(bits: np.ndarray) -> bytes:
    bits = bits.ravel()
    if len(bits) % 8:
        bits = np.concatenate([bits, np.ones(-len(bits) % 8, np.uint8)])
    return _stuffed(np.packbits(bits))


def encode_jpeg(payload: np.ndarray) -> bytes:
    """A progressive JPEG whose coefficients are these bytes (uint8, a multiple of 64 of them).

    A byte b at a place other than a block's first is the coefficient of eight bits whose code is b:
    b itself from 128 on, else b - 255. A block's first byte is 512 + b, negative in odd blocks.
    """
    n = len(payload) // BLOCK
    units = -(-n // 6)
    rows = -(-units // max(64, -(-units // 4095)))
    cols = -(-units // rows)
    blocks = np.zeros((6 * rows * cols, BLOCK), np.uint8)
    blocks[:n] = payload.reshape(n, BLOCK)
    q = rows * cols
    parts = [(1, blocks[: 4 * q]), (2, blocks[4 * q : 5 * q]), (3, blocks[5 * q :])]
    out = [
        b"\xff\xd8",
        _segment(0xFE, struct.pack(">Q", n)),
        _segment(0xDB, b"\0" + b"\1" * 64),
        _segment(0xC2, struct.pack(">BHHB", 8, 16 * rows, 16 * cols, 3) + bytes([1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0])),
        _segment(0xC4, b"\x00" + DC_TABLE + b"\x10" + AC_FIRST_TABLE + b"\x11" + AC_REFINE_TABLE),
    ]
    eleven = np.arange(10, -1, -1)
    for c, b in parts:
        value = 512 + b[:, 0].astype(np.int32)
        value[1::2] *= -1
        half = value >> 1
        diff = np.diff(half, prepend=0)
        code = np.where(diff < 0, diff + 1023, diff)  # one bit 0, then ten
        code[0] = 0b10 << 9 | diff[0]  # two bits, then nine
        out += [_scan_head(c, 0x00, 0, 0, 0, 1), _packed((code[:, None] >> eleven & 1).astype(np.uint8))]
        for first, last in BANDS:
            out += [_scan_head(c, 0x00, first, last, 0, 1), np.ascontiguousarray(b[:, first : last + 1] >> 1).tobytes()]
        out += [_scan_head(c, 0x00, 0, 0, 1, 0), _packed((value & 1).astype(np.uint8))]
        for first, last in BANDS:
            fine = np.zeros((len(b), last - first + 2), np.uint8)  # the code that ends the band, then a bit for each coefficient
            band = b[:, first : last + 1]
            fine[:, 1:] = band & 1 ^ (band < 128)
            out += [_scan_head(c, 0x01, first, last, 1, 0), _packed(fine)]
    return b"".join([*out, b"\xff\xd9"])


@lru_cache(64)
def _lookup(table: bytes) -> np.ndarray:
    """For each 16 bits: code length * 256 + symbol; 0 where there is no such code."""
    out, code, at = np.zeros(65536, np.int32), 0, 16
    for length in range(1, 17):
        for _ in range(table[length - 1]):
            out[code << 16 - length : (code + 1) << 16 - length] = length << 8 | table[at]
            code, at = code + 1, at + 1
        code <<= 1
    return out


class _Bits:
    """Reads the bits of one scan or restart interval."""

    def __init__(self, data: np.ndarray):
        self.data, self.at = np.concatenate([data, np.full(8, 0, np.uint8)]), 0
        self.end = 8 * len(data)

    def window(self, at: np.ndarray) -> np.ndarray:
        """The 24 or more bits from each place, as the upper bits of 32."""
        i, d = at >> 3, self.data
        w = d[i].astype(np.uint64) << np.uint64(32) | d[i + 1].astype(np.uint64) << np.uint64(24) | d[i + 2].astype(np.uint64) << np.uint64(16) | d[i + 3].astype(np.uint64) << np.uint64(8) | d[i + 4].astype(np.uint64)
        return (w >> (np.uint64(8) - (at & 7).astype(np.uint64))).astype(np.int64) & 0xFFFFFFFF

    def take(self, n: int) -> int:
        v = 0
        for _ in range(n):
            v = v << 1 | (int(self.data[self.at >> 3]) >> 7 - (self.at & 7)) & 1 if self.at < self.end else v << 1
            self.at += 1
        return v

    def symbol(self, table: np.ndarray) -> int:
        i = min(self.at >> 3, len(self.data) - 3)
        w = int(self.data[i]) << 16 | int(self.data[i + 1]) << 8 | int(self.data[i + 2])
        got = int(table[w >> 8 - (self.at & 7) & 0xFFFF])
        if not got or self.at >= self.end:
            raise ValueError("damaged scan")
        self.at += got >> 8
        return got & 255


def _extend(v: int, size: int) -> int:
    return v if not size or v >= 1 << size - 1 else v - (1 << size) + 1


def _dc_first(bits: _Bits, coef: np.ndarray, order: np.ndarray, table: np.ndarray, low: int) -> bool:
    """All blocks of one component at once, if all codes with their extra bits have one length."""
    n = len(order)
    got = int(table[int(bits.data[0]) << 8 | int(bits.data[1])])
    stride = (got >> 8) + (got & 255)
    if not got or stride > 24 or n * stride > bits.end:
        return False
    w = bits.window(np.arange(n, dtype=np.int64) * stride)
    got = table[w >> 16]
    size = got & 255
    if ((got >> 8) + size != stride).any():
        return False
    v = w >> 32 - stride & (1 << size) - 1
    v = np.where((size > 0) & (v < 1 << np.maximum(size, 1) - 1), v - (1 << size) + 1, v)
    coef[order, 0] = np.cumsum(v) << low
    return True


def _ac_first(bits: _Bits, coef: np.ndarray, order: np.ndarray, table: np.ndarray, first: int, last: int, low: int) -> bool:
    """All coefficients at once, if each has a code of no run and all have one length."""
    n = len(order) * (last - first + 1)
    got = int(table[int(bits.data[0]) << 8 | int(bits.data[1])])
    size, stride = got & 255, (got >> 8) + (got & 255)
    if not got or not 0 < size < 16 or stride > 16 or n * stride > bits.end:
        return False
    if stride == 8:  # a byte each; the code is its first bits
        w = bits.data[:n].astype(np.int16)
        if (w >> size != int(bits.data[0]) >> size).any():
            return False
    else:
        w = bits.window(np.arange(n, dtype=np.int64) * stride) >> 16
        if (table[w] != got).any():
            return False
        w = (w >> 16 - stride).astype(np.int16)
    v = w & (1 << size) - 1
    v -= (v < 1 << size - 1) * np.int16((1 << size) - 1)
    coef[order, first : last + 1] = v.reshape(len(order), -1) << low
    return True


def _ac_refine(bits: _Bits, coef: np.ndarray, order: np.ndarray, table: np.ndarray, first: int, last: int, low: int) -> bool:
    """All blocks at once, if each has no zero in the band and ends it with one code."""
    n, width = len(order), last - first + 1
    got = int(table[int(bits.data[0]) << 8 | int(bits.data[1])])
    length = got >> 8
    if not got or got & 255 or n * (length + width) > bits.end:
        return False
    band = coef[order, first : last + 1]
    if not band.all():
        return False
    all_bits = np.unpackbits(bits.data[: -(-n * (length + width) // 8)])[: n * (length + width)].reshape(n, -1)
    if (all_bits[:, :length] != all_bits[0, :length]).any():
        return False
    coef[order, first : last + 1] = band + np.where(band < 0, -1, 1).astype(np.int16) * (all_bits[:, length:].astype(np.int16) << low)
    return True


def _slow_band(bits: _Bits, row: np.ndarray, table: np.ndarray, first: int, last: int, high: int, low: int, run: int) -> int:
    """One block of an AC scan; gives how many blocks after it have ended already."""
    k = first
    if not high:
        if run:
            return run - 1
        while k <= last:
            r, s = divmod(bits.symbol(table), 16)
            if s:
                k += r
                row[k] = _extend(bits.take(s), s) << low if bits.at <= bits.end else 0
                k += 1
            elif r == 15:
                k += 16
            else:
                return (1 << r) + bits.take(r) - 1
        return 0

    def correct(k: int) -> None:
        if bits.take(1) and not int(abs(int(row[k]))) >> low & 1:
            row[k] += 1 << low if row[k] > 0 else -(1 << low)

    while k <= last and not run:
        r, s = divmod(bits.symbol(table), 16)
        new = 0
        if s:
            new = 1 << low if bits.take(1) else -(1 << low)
        elif r < 15:
            run = (1 << r) + bits.take(r)
            break
        while k <= last:
            if row[k]:
                correct(k)
            elif r:
                r -= 1
            else:
                row[k] = new
                k += 1
                break
            k += 1
    if run:
        for i in range(k, last + 1):
            if row[i]:
                correct(i)
        return run - 1
    return 0


def decode_coefficients(data: bytes) -> dict:
    """Height, width, components (sampling, quantiser, coefficients by block) and comment of a progressive JPEG."""
    at, tables, steps, restart, frame, note = 2, {}, {}, 0, None, b""
    if data[:2] != b"\xff\xd8":
        raise ValueError("not a JPEG")
    while at < len(data):
        marker = data[at + 1]
        at += 2
        if marker == 0xD9:
            break
        size = data[at] << 8 | data[at + 1]
        body = data[at + 2 : at + size]
        at += size
        if marker == 0xFE:
            note = body
        elif marker == 0xDB:
            while body:
                wide = body[0] >> 4
                steps[body[0] & 15] = np.frombuffer(body[1 : 65 + 64 * wide], ">u2" if wide else np.uint8).astype(np.float32)
                body = body[65 + 64 * wide :]
        elif marker == 0xC4:
            while body:
                n = 17 + sum(body[1:17])
                tables[body[0]] = _lookup(bytes(body[1:n]))
                body = body[n:]
        elif marker == 0xDD:
            restart = body[0] << 8 | body[1]
        elif marker == 0xC2:
            height, width = struct.unpack(">HH", body[1:5])
            parts = {body[i]: {"h": body[i + 1] >> 4, "v": body[i + 1] & 15, "q": body[i + 2]} for i in range(6, 6 + 3 * body[5], 3)}
            hm, vm = max(p["h"] for p in parts.values()), max(p["v"] for p in parts.values())
            ux, uy = -(-width // (8 * hm)), -(-height // (8 * vm))
            for p in parts.values():
                p["cols"], p["rows"] = ux * p["h"], uy * p["v"]
                p["own"] = -(-width * p["h"] // (8 * hm)), -(-height * p["v"] // (8 * vm))
                p["coef"] = np.zeros((p["rows"] * p["cols"], 64), np.int16)
            frame = {"height": height, "width": width, "parts": parts, "hm": hm, "vm": vm, "units": (ux, uy)}
        elif marker == 0xDA:
            if frame is None:
                raise ValueError("a scan before its frame, or not progressive")
            n = body[0]
            chosen = [(frame["parts"][body[1 + 2 * i]], body[2 + 2 * i]) for i in range(n)]
            first, last, approx = body[1 + 2 * n : 4 + 2 * n]
            pieces, begun = [], at
            while True:  # up to a marker that is no restart
                end = data.index(b"\xff", at)
                while data[end + 1] == 0:
                    end = data.index(b"\xff", end + 2)
                pieces.append(data[begun:end])
                if 0xD0 <= data[end + 1] <= 0xD7:
                    begun = at = end + 2
                else:
                    at = end
                    break
            _scan(frame, chosen, pieces, tables, first, last, approx >> 4, approx & 15, restart)
        elif 0xC0 <= marker <= 0xCF and marker != 0xC8 and marker != 0xCC:
            raise ValueError("not progressive")
    if frame is None:
        raise ValueError("no frame")
    for p in frame["parts"].values():
        p["steps"] = steps[p["q"]]
    return frame | {"note": note}


def _scan(frame: dict, chosen: list, pieces: list[bytes], tables: dict, first: int, last: int, high: int, low: int, restart: int) -> None:
    if len(chosen) == 1:
        p = chosen[0][0]
        if p["own"] == (p["cols"], p["rows"]):
            order = np.arange(p["cols"] * p["rows"])
        else:
            order = (np.arange(p["own"][1])[:, None] * p["cols"] + np.arange(p["own"][0])).ravel()
        units = order[:, None]
    else:
        ux, uy = frame["units"]
        y, x = np.divmod(np.arange(ux * uy), ux)
        units = [((y * p["v"] + dy) * p["cols"] + x * p["h"] + dx, i) for i, (p, _) in enumerate(chosen) for dy in range(p["v"]) for dx in range(p["h"])]
    total = len(units) if len(chosen) == 1 else len(units[0][0])
    step = restart or total
    for k, raw in enumerate(pieces):
        raw = raw.replace(b"\xff\x00", b"\xff") if b"\xff" in raw else raw
        bits, span = _Bits(np.frombuffer(raw, np.uint8)), slice(k * step, min((k + 1) * step, total))
        if len(chosen) == 1:
            (p, t), o = chosen[0], units[span, 0]
            coef = p["coef"]
            if not first and not high and _dc_first(bits, coef, o, tables[t >> 4], low):
                continue
            if not first and high:
                coef[o, 0] |= np.unpackbits(bits.data)[: len(o)].astype(np.int16) << low
                continue
            if first and not high and _ac_first(bits, coef, o, tables[16 | t & 15], first, last, low):
                continue
            if first and high and _ac_refine(bits, coef, o, tables[16 | t & 15], first, last, low):
                continue
            ahead = 0
            if first:
                for b in o:
                    ahead = _slow_band(bits, coef[b], tables[16 | t & 15], first, last, high, low, ahead)
                continue
        before = [0] * len(chosen)
        for u in range(span.start, span.stop):
            for b, i in [(units[u, 0], 0)] if len(chosen) == 1 else [(where[u], i) for where, i in units]:
                p, t = chosen[i]
                if high:
                    p["coef"][b, 0] |= bits.take(1) << low
                else:
                    s = bits.symbol(tables[t >> 4])
                    before[i] += _extend(bits.take(s), s)
                    p["coef"][b, 0] = before[i] << low


def to_rgb(frame: dict) -> np.ndarray:
    """height x width x 3 samples: inverse transform, chroma upsampled to full resolution, colour conversion."""
    planes = []
    for p in frame["parts"].values():
        x = (p["coef"] * p["steps"]).astype(np.float32) @ BASIS
        x = np.clip(np.rint(x + 128), 0, 255).astype(np.float32)
        x = x.reshape(p["rows"], p["cols"], 8, 8).swapaxes(1, 2).reshape(8 * p["rows"], 8 * p["cols"])
        for axis, f in ((0, frame["vm"] // p["v"]), (1, frame["hm"] // p["h"])):
            x = np.repeat(x, f, axis) if f > 1 else x
        planes.append(x[: frame["height"], : frame["width"]])
    if len(planes) == 1:
        return np.repeat(planes[0].astype(np.uint8)[..., None], 3, -1)
    y, b, r = planes[0], planes[1] - 128, planes[2] - 128
    out = np.empty((*y.shape, 3), np.uint8)
    for i, c in enumerate((y + 1.402 * r, y - 0.344136 * b - 0.714136 * r, y + 1.772 * b)):
        out[..., i] = np.clip(np.rint(c), 0, 255)
    return out


def payload_of(frame: dict) -> np.ndarray:
    """The bytes that encode_jpeg put into the coefficients."""
    out = []
    for p in frame["parts"].values():
        v = p["coef"]
        b = np.where(v < 0, v + 255, v).astype(np.uint8)
        b[:, 0] = np.abs(v[:, 0]) - 512
        out.append(b)
    return np.concatenate(out)[: struct.unpack(">Q", frame["note"])[0]].ravel()


def encode_media(df: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` plus n_bytes (of the text; null counts as empty) and media, a JPEG that holds the text's bytes."""

    def run(batches: Iterator[list[pa.Array]]) -> Iterator[list[pa.Array]]:
        for (texts,) in batches:
            raw, off = utf8(texts)
            media = []
            for i in range(len(off) - 1):
                n = int(off[i + 1] - off[i])
                payload = np.zeros(max(BLOCK, -(-n // BLOCK) * BLOCK), np.uint8)
                payload[:n] = raw[off[i] : off[i + 1]]
                media.append(encode_jpeg(payload))
            yield [pa.array(np.diff(off)), pa.array(media, pa.binary())]

    return map_batches(df, keep, [text_col], "n_bytes long, media binary", run)


def decode_media(df: DataFrame, keep: list[str], media_col: str = "media", tensors: bool = False) -> DataFrame:
    """``keep`` plus what the files hold.

    payload_bytes, payload_sha256, tail_crc32 (of the last 64 bytes), media_bytes, media_sha256,
    width, height, feature (size, and mean of each channel of the RGB tensor); with ``tensors`` also
    rgb, the tensor's bytes. A null file gives nulls; a damaged one fails.
    """
    made = "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, width int, height int, feature string"

    def run(batches: Iterator[list[pa.Array]]) -> Iterator[list[pa.Array]]:
        for (files,) in batches:
            rows = []
            for f in files:
                f = f.as_py()
                if f is None:
                    rows.append((None,) * 9)
                    continue
                frame = decode_coefficients(f)
                rgb = to_rgb(frame)
                p = payload_of(frame).tobytes()
                means = rgb.reshape(-1, 3).sum(0, dtype=np.int64) / (rgb.size // 3)
                feature = f"{frame['width']}x{frame['height']}:" + ",".join(f"{m:.3f}" for m in means)
                rows.append((len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]), len(f), hashlib.sha256(f).hexdigest(), frame["width"], frame["height"], feature, rgb.tobytes() if tensors else None))
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.binary()]
            yield [pa.array(c, k) for c, k in zip(zip(*rows), kinds)][: 9 if tensors else 8]

    return map_batches(df, keep, [media_col], made + ", rgb binary" * tensors, run)
