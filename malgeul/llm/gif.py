"""GIF media columns: an LZW codec, palettes, disposal and transparency, timed frames and colour histograms."""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from malgeul.llm.common import require

#: Fixed values of the format.
MAX_CODES, MAX_BITS, MAX_SIDE = 4096, 12, 65535
#: Samples in a row of a stored payload, and bytes of frames that are passed on at once, about.
WIDTH, HELD = 64, 4_000_000


# ---- LZW ----


def _widths(bits: int, n: int) -> np.ndarray:
    """Bits of each of the first n codes after a clear code, for samples of ``bits`` bits."""
    entries = (1 << bits) + 1 + np.arange(n)  # highest code in the table as a code is read
    entries[:1] = 1 << bits
    return np.minimum(MAX_BITS, np.frexp(entries.astype(float))[1].clip(bits + 1))


def lzw_encode(samples: bytes, bits: int = 8) -> bytes:
    """The code stream of samples below ``1 << bits``, with a clear code first and whenever the table is full."""
    clear = 1 << bits
    full = MAX_CODES - clear - 2  # entries that a table can get
    runs: list[list[int]] = []
    codes: list[int] = []
    if samples:
        table: dict[int, int] = {}
        found, add, emit = table.get, clear + 2, codes.append
        w = samples[0]
        for b in samples[1:]:
            key = w << 8 | b
            known = found(key)
            if known is not None:
                w = known
                continue
            emit(w)
            w = b
            if add < MAX_CODES:
                table[key] = add
                add += 1
            else:
                runs.append(codes)
                codes, table, add = [], {}, clear + 2
                found, emit = table.get, codes.append
        codes.append(w)
    runs.append(codes)
    parts, widths = [np.array([clear])], [np.array([bits + 1])]
    own = np.concatenate([_widths(bits, full + 1), [MAX_BITS]])
    for i, run in enumerate(runs):
        parts.append(np.array([*run, clear if i < len(runs) - 1 else clear + 1]))
        widths.append(own[: len(run) + 1])
    value, width = np.concatenate(parts), np.concatenate(widths)
    at = np.concatenate([[0], np.cumsum(width)])
    spread = value << (at[:-1] & 7)
    place = at[:-1] >> 3
    size = int(at[-1] + 7) >> 3
    out = np.zeros(size + 3)
    for k in range(3):
        out[:size + 3] += np.bincount(place + k, (spread >> 8 * k) & 255, size + 3)
    return out[:size].astype(np.uint8).tobytes()


def lzw_decode(stream: bytes, bits: int, n: int) -> bytes:
    """The first n samples of a code stream; ValueError where it is damaged or too short."""
    clear, first = 1 << bits, (1 << bits) + 2
    data = np.frombuffer(stream + b"\0\0\0", np.uint8).astype(np.int64)
    limit, step = 8 * len(stream), MAX_CODES - clear
    own = _widths(bits, step)
    before = np.concatenate([[0], np.cumsum(own)])
    out, at = bytearray(), 0
    starts: list[int] = []
    lengths: list[int] = []
    fresh = True
    while len(out) < n:
        width = own if fresh else np.full(step, MAX_BITS)
        where = at + (before[:-1] if fresh else MAX_BITS * np.arange(step))
        use = int(np.searchsorted(where + width, limit, "right"))
        if not use:
            raise ValueError("the code stream is too short")
        where, width = where[:use], width[:use]
        byte = where >> 3
        codes = (data[byte] | data[byte + 1] << 8 | data[byte + 2] << 16) >> (where & 7) & ((1 << width) - 1)
        stops = np.flatnonzero((codes == clear) | (codes == clear + 1))
        end = int(stops[0]) if len(stops) else use
        for code in codes[:end].tolist():
            place = len(out)
            if code < clear:
                out.append(code)
                length = 1
            else:
                entry = code - first
                if entry >= len(starts) or entry >= MAX_CODES - first:
                    raise ValueError("the code stream is damaged")
                # an entry is what its code stood for and the sample after it: a run of the output
                begin, length = starts[entry], lengths[entry] + 1
                part = out[begin : begin + length]
                if len(part) < length:
                    part.append(part[0])
                out += part
            starts.append(place)
            lengths.append(length)
        if not len(stops):
            fresh, at = False, int(where[-1] + width[-1])
        elif codes[end] == clear:
            starts, lengths = [], []
            fresh, at = True, int(where[end] + width[end])
        else:
            break
    if len(out) < n:
        raise ValueError("the code stream is too short")
    return bytes(out[:n])


# ---- container ----


@dataclass
class Frame:
    """A rectangle of palette indices and how to show it."""

    left: int
    top: int
    pixels: np.ndarray  # height x width, uint8
    palette: np.ndarray  # colours x 3, uint8
    transparent: int | None = None
    disposal: int = 0
    delay_cs: int = 0


@dataclass
class Gif:
    width: int
    height: int
    background: int
    palette: np.ndarray | None
    frames: list[Frame]


def _sub_blocks(data: bytes) -> bytes:
    return b"".join(bytes([len(part)]) + part for i in range(0, len(data), 255) if (part := data[i : i + 255])) + b"\0"


def write_gif(gif: Gif) -> bytes:
    """The bytes of a GIF89a; frames without a palette equal to the global one carry their own."""

    def table(palette: np.ndarray) -> tuple[int, bytes]:
        size = max(1, int(len(palette) - 1).bit_length())
        return size, palette.astype(np.uint8).tobytes().ljust(3 << size, b"\0")

    out = [b"GIF89a"]
    if gif.palette is None:
        out.append(struct.pack("<HHBBB", gif.width, gif.height, 0x70, 0, 0))
    else:
        size, raw = table(gif.palette)
        out += [struct.pack("<HHBBB", gif.width, gif.height, 0xF0 | size - 1, gif.background, 0), raw]
    for f in gif.frames:
        out.append(struct.pack("<BBBBHBB", 0x21, 0xF9, 4, f.disposal << 2 | (f.transparent is not None), f.delay_cs, f.transparent or 0, 0))
        height, width = f.pixels.shape
        shared = gif.palette is not None and np.array_equal(f.palette, gif.palette)
        size, raw = table(f.palette)
        out.append(struct.pack("<BHHHHB", 0x2C, f.left, f.top, width, height, 0 if shared else 0x80 | size - 1))
        out += [b"" if shared else raw, bytes([max(2, size)]), _sub_blocks(lzw_encode(f.pixels.tobytes(), max(2, size)))]
    return b"".join([*out, b"\x3b"])


def read_gif(data: bytes) -> Gif:
    """Parse a GIF; ValueError where it is damaged."""
    at = 0

    def take(n: int) -> bytes:
        nonlocal at
        if at + n > len(data):
            raise ValueError("the file is too short")
        at += n
        return data[at - n : at]

    def blocks() -> bytes:
        parts = []
        while size := take(1)[0]:
            parts.append(take(size))
        return b"".join(parts)

    def colours(flags: int) -> np.ndarray:
        return np.frombuffer(take(6 << (flags & 7)), np.uint8).reshape(-1, 3)

    if take(6) not in (b"GIF87a", b"GIF89a"):
        raise ValueError("no GIF")
    width, height, flags, background, _ = struct.unpack("<HHBBB", take(7))
    gif = Gif(width, height, background, colours(flags) if flags & 0x80 else None, [])
    control: tuple[int, int, int | None] = (0, 0, None)
    while (kind := take(1)[0]) != 0x3B:
        if kind == 0x21:
            label, body = take(1)[0], blocks()
            if label == 0xF9 and len(body) >= 4:
                bits, delay, index = struct.unpack("<BHB", body[:4])
                control = (bits >> 2 & 7, delay, index if bits & 1 else None)
        elif kind == 0x2C:
            left, top, w, h, flags = struct.unpack("<HHHHB", take(9))
            palette = colours(flags) if flags & 0x80 else gif.palette
            if palette is None:
                raise ValueError("a frame has no palette")
            bits = take(1)[0]
            if not 2 <= bits <= 8:
                raise ValueError("the code stream is damaged")
            pixels = np.frombuffer(lzw_decode(blocks(), bits, w * h), np.uint8).reshape(h, w)
            if flags & 0x40:
                order = [y for start, step in ((0, 8), (4, 8), (2, 4), (1, 2)) for y in range(start, h, step)]
                pixels = pixels[np.argsort(order)]
            if pixels.size and pixels.max() >= len(palette):
                raise ValueError("a sample has no colour")
            gif.frames.append(Frame(left, top, pixels, palette, control[2], control[0], control[1]))
            control = (0, 0, None)
        else:
            raise ValueError("an unknown block")
    return gif


def compose(gif: Gif) -> Iterator[tuple[int, int, np.ndarray]]:
    """(start and duration in hundredths of a second, height x width x 4 canvas) of every frame as it is shown."""
    height = max([gif.height, *(f.top + f.pixels.shape[0] for f in gif.frames)])
    width = max([gif.width, *(f.left + f.pixels.shape[1] for f in gif.frames)])
    canvas, now = np.zeros((height, width, 4), np.uint8), 0
    for f in gif.frames:
        h, w = f.pixels.shape
        area = (slice(f.top, f.top + h), slice(f.left, f.left + w))
        saved = canvas[area].copy() if f.disposal == 3 else None
        shown = np.dstack([f.palette[f.pixels], np.full((h, w), 255, np.uint8)])
        if f.transparent is not None:
            shown = np.where((f.pixels == f.transparent)[..., None], canvas[area], shown)
        canvas[area] = shown
        yield now, f.delay_cs, canvas.copy()
        now += f.delay_cs
        if f.disposal == 2:
            canvas[area] = 0
        elif f.disposal == 3:
            canvas[area] = saved


def histogram(canvas: np.ndarray, bins: int = 4) -> list[int]:
    """Opaque pixels by red, green and blue, ``bins`` classes each."""
    own = canvas[canvas[..., 3] > 0][:, :3].astype(np.int64) * bins >> 8
    return np.bincount((own[:, 0] * bins + own[:, 1]) * bins + own[:, 2], minlength=bins**3).tolist()


# ---- columns ----

FRAMES = "frame int, start_ms long, duration_ms long, width int, height int, rgba binary, histogram array<long>, error string"


def decode_frames(media: DataFrame, key: str, column: str) -> DataFrame:
    """A row for each frame of each GIF in ``column``: when it shows, its RGBA pixels and histogram.

    A null, empty or damaged value gives one row with ``error`` and no frame, a GIF without frames no
    row; repeated rows are all decoded; other columns are ignored.
    """
    require(media, key, column)

    def frames(raw: bytes) -> Iterator[tuple]:
        try:
            gif = read_gif(raw)  # a damaged value has no frames at all
        except ValueError as e:
            yield (None,) * 7 + (str(e),)
            return
        for i, (a, d, c) in enumerate(compose(gif)):
            yield i, 10 * a, 10 * d, c.shape[1], c.shape[0], c.tobytes(), histogram(c), None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, size = [], 0

            def out() -> pa.RecordBatch:
                columns = zip(*rows, strict=True)
                return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, [batch[key].type, *kinds], strict=True)], names)  # noqa: B023

            for k, v in zip(batch[key].to_pylist(), batch[column], strict=True):
                for row in frames(v.as_py() or b""):
                    rows.append((k, *row))
                    size += len(row[5] or b"")
                    if size >= HELD:
                        yield out()
                        rows, size = [], 0
            if rows:
                yield out()

    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.string()]
    names = [key, *(f.split()[0] for f in FRAMES.split(", "))]
    return media.select(key, column).mapInArrow(run, f"`{key}` {media.schema[key].dataType.simpleString()}, {FRAMES}")


GREYS = np.repeat(np.arange(256, dtype=np.uint8)[:, None], 3, axis=1)


def store(payload: bytes) -> bytes:
    """A payload, a multiple of WIDTH long, as a GIF of grey samples; a new frame begins where a side would be too long."""
    samples = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    parts = [samples[i : i + MAX_SIDE] for i in range(0, len(samples), MAX_SIDE)]
    return write_gif(Gif(WIDTH, min(len(samples), MAX_SIDE), 0, GREYS, [Frame(0, 0, p, GREYS, delay_cs=10) for p in parts]))


def encode_texts(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_bytes`` and ``media``: the UTF-8 of the whole ``text`` (null: empty), filled up with
    zero bytes to a positive multiple of 64 and stored losslessly.  One row per input row, repeated and null ids
    included; a text over 4 MB makes several frames; other columns are ignored; an empty table gives no rows."""
    require(docs, "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), 64):
                part = batch.slice(i, 64)
                raw = [(t.as_py() or "").encode() for t in part["text"]]
                media = [store(r.ljust(max(WIDTH, -(-len(r) // WIDTH) * WIDTH), b"\0")) for r in raw]
                yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(map(len, raw), pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_bytes long, media binary")


def payload_of(gif: Gif) -> tuple[bytes, list[int]]:
    """The grey samples that the composed frames show, and the histogram over all of them."""
    parts, counts = [], np.zeros(64, np.int64)
    for frame, (_, _, canvas) in zip(gif.frames, compose(gif), strict=True):
        own = canvas[frame.top : frame.top + frame.pixels.shape[0], frame.left : frame.left + frame.pixels.shape[1]]
        parts.append(own[..., 0].tobytes())
        counts += histogram(own)
    return b"".join(parts), counts.tolist()


def read_back(media: DataFrame) -> DataFrame:
    """Digests and the feature string of the payload in each row's ``media``.

    A null value gives nulls but for ``feature``, which names the error, as it does for a damaged value, whose stored bytes
    alone have a size and a digest.  Repeated rows are all read; other columns are ignored; an empty table gives no rows."""
    require(media, "doc_id", "n_bytes", "media")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value in batch["media"]:
                stored = value.as_py()
                try:
                    gif = read_gif(stored or b"")
                except ValueError as e:
                    known = (None, None) if stored is None else (len(stored), hashlib.sha256(stored).hexdigest())
                    rows.append((None, None, None, *known, f"error={e}"))
                    continue
                payload, counts = payload_of(gif)
                grey = ",".join(str(counts[i]) for i in (0, 21, 42, 63))
                shown = sum(f.delay_cs for f in gif.frames) * 10
                rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(stored), hashlib.sha256(stored).hexdigest(), f"frames={len(gif.frames)};ms={shown};side={gif.width}x{gif.height};grey={grey}"))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["n_bytes"], *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names)

    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    kind = media.schema["doc_id"].dataType.simpleString()
    return media.select("doc_id", "n_bytes", "media").mapInArrow(run, f"doc_id {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
