"""Media columns: baseline JPEG in numpy.

decode_dc parses markers, Huffman-decodes the scans and keeps the DC coefficient of each luminance block: a thumbnail of one eighth of the
picture's size. All restart segments of all pictures of a batch advance together, one code at a time. Any baseline picture (grey or
several components in one scan or a scan each, sampling factors, with or without restart intervals) is read; luminance is the first component.
Progressive or arithmetic pictures and broken ones raise ValueError.

encode_flat writes bytes as flat 8 x 8 blocks of a grey baseline picture, quantised so that the DC coefficient is the byte
less 128: reading the thumbnail back gives the bytes. Each 576 blocks are a restart segment. Payloads beyond one picture's
height become several pictures, one after another. The stored table is compressed by zstd, which finds passages that pictures of one page share.

Defined results: null text is empty; an empty text is one block row set of padding; very long texts take wider or several pictures; rows of one
doc_id are stored one by one; an empty table gives no rows; of the input only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, materialize, prepare, table

UNIT = 576
MAX_ROWS = 8000
# fixed values: code lengths and categories of the DC table that the JPEG standard suggests for luminance
DC_LENGTHS = (0, 1, 5, 1, 1, 1, 1, 1, 1, 0, 0, 0, 0, 0, 0, 0)
DC_VALUES = (0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11)
# fixed values: zigzag order is not needed, as only the first coefficient is kept


def huffman(lengths, values) -> dict[int, tuple[int, int]]:
    """value -> (code, length) of a canonical table."""
    code, at, out = 0, 0, {}
    for size, count in enumerate(lengths, 1):
        for _ in range(count):
            out[values[at]] = (code, size)
            code, at = code + 1, at + 1
        code <<= 1
    return out


def lookup(lengths, values) -> tuple[np.ndarray, np.ndarray]:
    """Value and code length for each 16-bit window; length 0 where no code fits."""
    symbol, size = np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.int32)
    for value, (code, n) in huffman(lengths, values).items():
        symbol[code << (16 - n) : (code + 1) << (16 - n)] = value
        size[code << (16 - n) : (code + 1) << (16 - n)] = n
    return symbol, size


def _differences() -> tuple[np.ndarray, np.ndarray]:
    """For each DC difference from -255 to 255 the bits of its block (end-of-block code, one bit, included), and their number."""
    table_, bits, sizes = huffman(DC_LENGTHS, DC_VALUES), np.zeros((511, 16), np.uint8), np.zeros(511, np.int64)
    for d in range(-255, 256):
        n = abs(d).bit_length()
        code, size = table_[n]
        word = f"{code:0{size}b}" + (f"{d if d > 0 else d + (1 << n) - 1:0{n}b}" if n else "") + "0"
        bits[d + 255, : len(word)] = [int(x) for x in word]
        sizes[d + 255] = len(word)
    return bits, sizes


_BITS, _SIZES = _differences()
_KEEP = np.arange(16)[None, :] < _SIZES[:, None]


def _segment(marker: int, body: bytes) -> bytes:
    return bytes((0xFF, marker)) + (len(body) + 2).to_bytes(2, "big") + body


def _picture(values: np.ndarray, width: int, each: int = 0) -> bytes:
    """A picture of `width` blocks a row; each: blocks of a restart segment (0: a row)."""
    rows, each = len(values) // width, each or width
    parts = len(values) // each
    d = np.diff(values.reshape(parts, each).astype(np.int64) - 128, axis=1, prepend=0) + 255
    sizes = _SIZES[d].sum(axis=1)
    bits = _BITS[d.reshape(-1)][_KEEP[d.reshape(-1)]]
    padded = -(-sizes // 8) * 8
    out = np.ones(int(padded.sum()), np.uint8)
    starts = np.cumsum(padded) - padded
    out[np.arange(len(bits)) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)] = bits
    packed = np.packbits(out)
    escaped = packed == 0xFF
    part = np.repeat(np.arange(parts), padded // 8)
    # an escape byte after each 0xFF, a restart marker after each segment but the last
    shift = np.cumsum(escaped) - escaped + 2 * part
    scan = np.zeros(len(packed) + int(escaped.sum()) + 2 * (parts - 1), np.uint8)
    scan[np.arange(len(packed)) + shift] = packed
    ends = np.cumsum(padded // 8)[:-1]
    marks = ends + np.cumsum(escaped)[ends - 1] + 2 * np.arange(parts - 1)
    scan[marks], scan[marks + 1] = 0xFF, 0xD0 + np.arange(parts - 1) % 8
    size = (8 * rows).to_bytes(2, "big") + (8 * width).to_bytes(2, "big")
    head = b"\xff\xd8" + _segment(0xDB, b"\0" + bytes([8] * 64)) + _segment(0xC0, b"\x08" + size + b"\x01\x01\x11\0") + _segment(0xC4, b"\0" + bytes(DC_LENGTHS) + bytes(DC_VALUES)) + _segment(0xC4, b"\x10" + bytes((1, *[0] * 15)) + b"\0") + _segment(0xDD, each.to_bytes(2, "big")) + _segment(0xDA, b"\x01\x01\0\0\x3f\0")
    return head + scan.tobytes() + b"\xff\xd9"


def encode_flat(payload: bytes) -> bytes:
    """payload, of a positive multiple of 576 bytes, as one or more grey pictures."""
    values = np.frombuffer(payload, np.uint8)
    width = 24 if len(values) <= 24 * MAX_ROWS else UNIT
    return b"".join(_picture(values[at : at + width * MAX_ROWS], width, UNIT) for at in range(0, len(values), width * MAX_ROWS))


def parse(data: bytes, at: int = 0) -> tuple[dict, int]:
    """Frame, tables and scan of the picture that starts at `at`; where it ends."""
    if data[at : at + 2] != b"\xff\xd8":
        raise ValueError("no start of a picture")
    at, out = at + 2, {"quant": {}, "dc": {}, "ac": {}, "restart": 0}
    while True:
        while data[at] == 0xFF and data[at + 1] == 0xFF:
            at += 1
        if data[at] != 0xFF:
            raise ValueError("no marker where one must stand")
        marker = data[at + 1]
        if marker == 0xD9:
            if "scan" not in out:
                raise ValueError("no scan of the first component")
            return out, at + 2
        n = int.from_bytes(data[at + 2 : at + 4], "big")
        body, at = data[at + 4 : at + 2 + n], at + 2 + n
        if marker == 0xDB:
            k = 0
            while k < len(body):
                wide, name = body[k] >> 4, body[k] & 15
                out["quant"][name] = int.from_bytes(body[k + 1 : k + 2 + wide], "big")  # of the DC coefficient
                k += 1 + 64 * (1 + wide)
        elif marker == 0xC0:
            if "components" in out:
                raise ValueError("two frames in one picture")
            out |= {"height": int.from_bytes(body[1:3], "big"), "width": int.from_bytes(body[3:5], "big"), "components": [(body[k], body[k + 1] >> 4, body[k + 1] & 15, body[k + 2]) for k in range(6, 6 + 3 * body[5], 3)]}
        elif 0xC1 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
            raise ValueError("not a baseline picture")
        elif marker == 0xC4:
            k = 0
            while k < len(body):
                lengths = tuple(body[k + 1 : k + 17])
                m = sum(lengths)
                out["ac" if body[k] >> 4 else "dc"][body[k] & 15] = (lengths, tuple(body[k + 17 : k + 17 + m]))
                k += 17 + m
        elif marker == 0xDD:
            out["restart"] = int.from_bytes(body[:2], "big")
        elif marker == 0xDA:
            scan = [(body[1 + 2 * k], body[2 + 2 * k] >> 4, body[2 + 2 * k] & 15) for k in range(body[0])]
            stop = at
            while True:
                stop = data.find(b"\xff", stop)
                if stop < 0:
                    raise ValueError("the scan does not end")
                if data[stop + 1] == 0 or 0xD0 <= data[stop + 1] <= 0xD7:
                    stop += 2
                    nxt = stop
                    tail = np.frombuffer(data, np.uint8, offset=nxt)
                    hits = np.flatnonzero((tail[:-1] == 0xFF) & (tail[1:] != 0) & ((tail[1:] < 0xD0) | (tail[1:] > 0xD7)))
                    if not len(hits):
                        raise ValueError("the scan does not end")
                    stop = nxt + int(hits[0])
                break
            if "components" not in out:
                raise ValueError("a scan before its frame")
            if "scan" not in out and out["components"][0][0] in [c for c, _, _ in scan]:  # the one that holds luminance, with the tables known by now
                out |= {"scan": [(c, out["dc"].get(d), out["ac"].get(a)) for c, d, a in scan], "each": out["restart"], "data": data[at:stop]}
            at = stop


_tables: dict = {}


def _known(kind) -> tuple[np.ndarray, np.ndarray]:
    if kind not in _tables:
        _tables[kind] = lookup(*kind)
    return _tables[kind]


def decode_dc(pictures: list[bytes]) -> list[list[np.ndarray]]:
    """Luminance thumbnails of the pictures in each of the given streams."""
    frames = []
    for which, data in enumerate(pictures):
        at = 0
        while at < len(data):
            frame, at = parse(data, at)
            frames.append((which, frame))
    out: list[list[np.ndarray]] = [[] for _ in pictures]
    groups: dict = {}
    for k, (_, f) in enumerate(frames):
        sides = (max(x[1] for x in f["components"]), max(x[2] for x in f["components"]))
        used = [(next(x for x in f["components"] if x[0] == c), d, a) for c, d, a in f["scan"]]
        if any(d is None or a is None for _, d, a in used):
            raise ValueError("a scan without its tables")
        luma = [u[0] for u in used].index(f["components"][0])
        groups.setdefault((sides, luma, tuple((x[1:], d, a) for x, d, a in used)), []).append(k)
    made: dict[int, np.ndarray] = {}
    for (sides, luma, layout), members in groups.items():
        made |= _decode_group([frames[k][1] for k in members], members, layout, luma, *sides)
    for k, (which, _) in enumerate(frames):
        out[which].append(made[k])
    return out


def _decode_group(frames: list[dict], names: list[int], layout, first_of: int, hmax: int, vmax: int) -> dict[int, np.ndarray]:
    """Pictures with the same components and tables, all restart segments together. first_of: the scan's place of luminance."""
    single = len(layout) == 1
    blocks = []  # component of each block of a unit, and its place there
    for c, ((h, v, _), _, _) in enumerate(layout):
        blocks += [(c, 0, 0)] if single else [(c, y, x) for y in range(v) for x in range(h)]
    (h0, v0, q0), _, _ = layout[first_of]
    pieces, todo, owner, first = [], [], [], []
    for k, f in enumerate(frames):
        f["size"] = (-(-f["height"] * v0 // vmax), -(-f["width"] * h0 // hmax))  # samples of the component
        f["units"] = (-(-f["size"][0] // 8), -(-f["size"][1] // 8)) if single else (-(-f["height"] // (8 * vmax)), -(-f["width"] // (8 * hmax)))
        n = f["units"][0] * f["units"][1]
        raw = np.frombuffer(f["data"], np.uint8)
        ff = np.flatnonzero(raw[:-1] == 0xFF)
        marks = ff[(raw[ff + 1] >= 0xD0) & (raw[ff + 1] <= 0xD7)]
        drop = np.zeros(len(raw), bool)
        drop[ff[raw[ff + 1] == 0] + 1] = True
        drop[marks], drop[marks + 1] = True, True
        kept = np.cumsum(~drop) - ~drop
        starts = np.r_[0, kept[np.minimum(marks + 2, len(raw) - 1)]]
        pieces.append((raw[~drop], starts))
        each = f["each"] or n
        todo.append(np.minimum(each, n - each * np.arange(len(starts))))
        first.append(each * np.arange(len(starts)))
        owner.append(np.full(len(starts), k))
    base = np.cumsum([0, *[len(p) + 8 for p, _ in pieces]])
    stream = np.full(int(base[-1]) + 8, 255, np.uint8)
    for b, (p, _) in zip(base, pieces, strict=False):
        stream[b : b + len(p)] = p
    wide = stream.astype(np.uint32)
    words = (wide[:-3] << 24) | (wide[1:-2] << 16) | (wide[2:-1] << 8) | wide[3:]
    bit = 8 * np.concatenate([b + s for b, (_, s) in zip(base, pieces, strict=False)]).astype(np.int64)
    todo, owner, first = np.concatenate(todo), np.concatenate(owner), np.concatenate(first)
    room = np.cumsum([0, *[f["units"][0] * f["units"][1] for f in frames]])
    per_luma = sum(c == first_of for c, _, _ in blocks)
    luma = np.zeros((int(room[-1]), per_luma), np.int32)
    previous = np.zeros((len(layout), len(bit)), np.int32)
    peek = lambda b: ((words[b >> 3] >> (16 - (b & 7)).astype(np.uint32)) & np.uint32(0xFFFF)).astype(np.int64)
    active, unit = np.flatnonzero(todo > 0), 0
    while len(active):
        luma_at = 0
        for c, _, _ in blocks:
            _, dc, ac = layout[c]
            symbol, size = _known(dc)
            b = bit[active]
            window = peek(b)
            n, used = symbol[window], size[window]
            if not used.all():
                raise ValueError("a code outside its table")
            b = b + used
            value = (peek(b) >> (16 - n)).astype(np.int32)
            value = np.where((n > 0) & (value < (1 << np.maximum(n - 1, 0))), value - (1 << n) + 1, value)
            previous[c, active] += value
            b = b + n
            if c == first_of:
                luma[room[owner[active]] + first[active] + unit, luma_at] = previous[c, active]
                luma_at += 1
            symbol, size = _known(ac)
            k, open_ = np.ones(len(active), np.int64), np.arange(len(active))
            while len(open_):
                window = peek(b[open_])
                run, used = symbol[window], size[window]
                if not used.all():
                    raise ValueError("a code outside its table")
                b[open_] += used + (run & 15)
                k[open_] = np.where(run == 0, 64, k[open_] + (run >> 4) + 1)
                open_ = open_[k[open_] < 64]
            bit[active] = b
        unit += 1
        active = active[todo[active] > unit]
    out = {}
    for k, f in enumerate(frames):
        rows, cols = f["units"]
        values = luma[room[k] : room[k + 1]].reshape(rows, cols, v0 if not single else 1, h0 if not single else 1).transpose(0, 2, 1, 3)
        values = values.reshape(values.shape[0] * values.shape[1], -1) * f["quant"][q0]
        tall, broad = (-(-x // 8) for x in f["size"])
        out[names[k]] = np.clip((values[:tall, :broad] + 4) // 8 + 128, 0, 255).astype(np.uint8)
    return out


def thumbnail_hash(thumb: np.ndarray) -> str:
    """64 bits as hex: whether each cell of an 8 x 9 grid of means is darker than its right neighbour."""
    rows, cols = (np.linspace(0, n, k + 1).astype(int) for n, k in zip(thumb.shape, (8, 9), strict=True))
    sums = np.zeros((thumb.shape[0] + 1, thumb.shape[1] + 1))
    sums[1:, 1:] = thumb.astype(np.float64).cumsum(0).cumsum(1)
    top, bottom, left, right = rows[:-1], np.maximum(rows[1:], rows[:-1] + 1).clip(max=thumb.shape[0]), cols[:-1], np.maximum(cols[1:], cols[:-1] + 1).clip(max=thumb.shape[1])
    top, left = np.minimum(top, bottom - 1), np.minimum(left, right - 1)
    cells = (sums[bottom][:, right] - sums[top][:, right] - sums[bottom][:, left] + sums[top][:, left]) / ((bottom - top)[:, None] * (right - left)[None, :])
    return np.packbits(cells[:, :-1] < cells[:, 1:]).tobytes().hex()


_STORED = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("media", pa.binary())])
_ROW = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string())])
_NAMES = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def _store(batches):
    for batch in batches:
        ids, texts = batch.column("doc_id"), batch.column("text")
        for at in range(0, len(ids), 250):
            raw = [(texts[i].as_py() or "").encode() for i in range(at, min(at + 250, len(ids)))]
            yield table(_STORED, [ids.slice(at, len(raw)), [len(x) for x in raw], [encode_flat(x + b"\xff" * (-len(x) % UNIT if x else UNIT)) for x in raw]])


def _read(keep: bool):
    schema = _ROW.append(pa.field("media", pa.binary())) if keep else _ROW

    def run(batches):
        for batch in batches:
            for at in range(0, len(batch), 250):
                part = batch.slice(at, 250)
                media = part.column("media").to_pylist()
                cols = [[] for _ in schema]
                for m, thumbs in zip(media, decode_dc(media), strict=True):
                    back = b"".join(t.tobytes() for t in thumbs)
                    feature = f"{8 * thumbs[0].shape[1]}x{8 * sum(t.shape[0] for t in thumbs)}:{thumbnail_hash(np.concatenate(thumbs))}"
                    row = (len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-32:]), len(m), hashlib.sha256(m).hexdigest(), feature, m)
                    for c, v in zip(cols[2:], row, strict=False):
                        c.append(v)
                yield table(schema, [part.column("doc_id"), part.column("n_bytes"), *cols[2:]])

    return lean(run)


def store_media(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, media (the picture of the text's bytes) of each document, as a stored table."""
    prepare(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return materialize(texts.mapInArrow(lean(_store), "doc_id long, n_bytes long, media binary"), compression="zstd")


def media_columns(docs: DataFrame, keep: bool = True) -> DataFrame:
    """One row a document: sizes and digests of its payload as read back from the stored media column, the picture itself if keep, and its feature."""
    return store_media(docs).mapInArrow(_read(keep), _NAMES + (", media binary" if keep else ""))
