"""Best-fit packing of token pieces into sequences by minimum bin slack.

Pieces are counted by length: at most `capacity` counts, whatever the input. On these counts each bin takes the longest piece left
and the fullest feasible combination of the others, found by subset-sum dynamic programming on a bitset (an integer whose bit
s says that sum s can be made); the combination is repeated as long as its counts last and removed. The plan is a list of
patterns, a few for each length, so the driver's work does not grow with the input. Pieces are then numbered within their length,
in salted groups of bounded size, and the pattern that owns the number gives sequence and offset.

Defined results: ids are those that the tokenizer's plain call gives, so a string such as <|endoftext|> inside a text is its one id; null text is
empty, and still has the end token; rows of one doc_id are packed one by one; an empty table packs to
no rows. Only documents longer than the capacity are cut; of these the first piece may be shorter, the others are full.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import lean, materialize, prepare, ragged, slices, table, text_buffer

END = 2
_PIECE = "doc_id long, piece int, start long, length int, ids_crc32 long"
_PIECE_ARROW = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int32()), ("ids_crc32", pa.int64())])
GROUP_ROWS = 20_000
MEMO_CHUNKS, MEMO_BYTES = 700_000, 48 << 20
_loaded: dict = {}


class _Chunks:
    """A tokenizer with a memo of the ids of text chunks, emptied beyond MEMO_CHUNKS chunks or MEMO_BYTES of them; both are kept for one task."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # strings that stand for one id wherever a text holds them; texts are cut around them
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.widths = np.zeros(max(vocabulary.values()) + 1, np.int64)  # a byte-level vocabulary writes each byte as one character
        for token, number in vocabulary.items():
            self.widths[number] = len(token)
        self.clear()

    def clear(self) -> None:
        """Chunk -> number; number -> start and length in ids, which may have spare room. Number 0 is the end of a document."""
        self.number: dict[str, int] = {}
        self.start, self.length, self.ids = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64), np.zeros(1 << 18, "<u4")
        self.n_chunks, self.n_ids, self.n_bytes = 0, 0, 0
        self._append([], np.array([END], "<u4"), np.array([1]))

    def _append(self, chunks: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        n, m = len(lengths), len(ids)
        while self.n_chunks + n > len(self.start):
            self.start, self.length = np.concatenate([self.start, self.start]), np.concatenate([self.length, self.length])
        while self.n_ids + m > len(self.ids):
            self.ids = np.concatenate([self.ids, self.ids])
        self.length[self.n_chunks : self.n_chunks + n] = lengths
        self.start[self.n_chunks : self.n_chunks + n] = self.n_ids + np.cumsum(lengths) - lengths
        self.ids[self.n_ids : self.n_ids + m] = ids
        self.number.update(zip(chunks, range(self.n_chunks, self.n_chunks + n), strict=False))
        self.n_bytes += sum(map(len, chunks)) + 4 * m
        self.n_chunks, self.n_ids = self.n_chunks + n, self.n_ids + m

    def _encode(self, chunks: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]

    def _learn(self, chunks: list[str]) -> None:
        spaced, plain, odd = [], [], []
        for x in chunks:
            if x[-1].isspace() or x in self.added:
                odd.append(x)
            elif not x[0].isspace():
                plain.append(x)
            elif x[0] == " " and not x[1].isspace():
                spaced.append(x)
            else:
                odd.append(x)
        # chunks that begin with one space, or stand between line ends, do not change each other when they stand in one text;
        # token lengths in bytes tell where each one ends
        for group, before in ((spaced, ""), (plain, "\n")):
            for at in range(0, len(group), 20_000):
                part = group[at : at + 20_000]
                ids = np.array(self._encode([before + before.join(part)])[0], "<u4")
                sizes = np.fromiter(map(len, map(str.encode, part)), np.int64, len(part)) + len(before)
                lengths = np.diff(np.searchsorted(np.cumsum(self.widths[ids]), np.cumsum(sizes), side="left") + 1, prepend=0)
                if before:
                    ids = np.delete(ids, np.cumsum(lengths) - lengths)
                    lengths = lengths - 1
                self._append(part, ids, lengths)
        for at in range(0, len(odd), 20_000):
            part = odd[at : at + 20_000]
            got = self._encode(part)
            self._append(part, np.array([y for x in got for y in x], "<u4"), np.array([len(x) for x in got], np.int64))

    def numbers(self, chunks: list[str]) -> np.ndarray:
        if self.n_chunks > MEMO_CHUNKS or self.n_bytes > MEMO_BYTES:
            self.clear()
        missing = [x for x in chunks if x not in self.number]
        if missing:
            self._learn(missing)
        return np.fromiter(map(self.number.__getitem__, chunks), np.int64, len(chunks))


def _added(raw: np.ndarray, offsets: np.ndarray, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the added tokens inside texts, from the left, none overlapping another."""
    found, whole = [], None
    for x in strings:
        x = x.encode()
        if whole is None:
            whole = raw.tobytes()
        at = whole.find(x)
        while at >= 0:
            if np.searchsorted(offsets, at, side="right") == np.searchsorted(offsets, at + len(x), side="left"):
                found.append((at, -len(x)))
            at = whole.find(x, at + 1)
    kept, last = [], 0
    for at, size in sorted(found):
        if at >= last:
            kept.append((at, last := at - size))
    return (np.array([a for a, _ in kept], np.int64), np.array([b for _, b in kept], np.int64))


def _chunk_starts(raw: np.ndarray, offsets: np.ndarray, added: list[str] = ()) -> np.ndarray:
    """Bytes where a chunk begins: each text that is not empty, each added token and what follows it, what follows an ASCII letter and is ASCII but
    no letter, and each single space or line end, with what follows the latter, between two characters that are no white space.

    The tokenizer always cuts there, so chunks can be encoded alone.
    """
    begins, ends = _added(raw, offsets, added)
    padded = np.concatenate([np.full(3, 32, np.uint8), raw, np.full(3, 32, np.uint8)])
    spaces = np.flatnonzero((raw == 32) | (raw == 10))
    near = {k: padded[spaces + 3 + k] for k in (-3, -2, -1, 1, 2, 3)}

    def white(a: np.ndarray, b: np.ndarray, c: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Whether bytes a b c, or b c as a pair, are white space; last alone is the ASCII case."""
        wide = ((a == 0xE1) & (b == 0x9A) & (c == 0x80)) | ((a == 0xE3) & (b == 0x80) & (c == 0x80)) | ((a == 0xE2) & (b == 0x81) & (c == 0x9F))
        wide |= (a == 0xE2) & (b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))
        return wide | (last == 32) | ((last >= 9) & (last <= 13)) | ((last >= 28) & (last <= 31))

    two = (near[-2] == 0xC2) & ((near[-1] == 0x85) | (near[-1] == 0xA0)) | (near[1] == 0xC2) & ((near[2] == 0x85) | (near[2] == 0xA0))
    odd = white(near[-3], near[-2], near[-1], near[-1]) | white(near[1], near[2], near[3], near[1]) | two
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    edge[begins], edge[ends] = True, True
    safe = spaces[~odd & ~edge[spaces] & ~edge[spaces + 1]]
    edge[safe] = True
    edge[safe[raw[safe] == 10] + 1] = True
    letter = (raw | 32) - np.uint8(97) < 26
    edge[1:-1] |= letter[:-1] & ~letter[1:] & (raw[1:] < 128)
    edge[ragged(begins + 1, ends - begins - 1)] = False  # an added token is one chunk
    return np.flatnonzero(edge[:-1])


def _chunks(path: str) -> _Chunks:
    if path not in _loaded:
        _loaded[path] = _Chunks(path)
    return _loaded[path]


def _encode(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, each followed by END, and the len + 1 offsets of each text's ids."""
    memo = _chunks(path)
    raw, offsets = text_buffer(texts)
    starts = _chunk_starts(raw, offsets, memo.added)
    cuts = np.append(starts, len(raw)).astype(np.int64)
    chunks = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(cuts), pa.py_buffer(raw)).dictionary_encode()
    numbers = memo.numbers(chunks.dictionary.to_pylist())[chunks.indices.to_numpy(zero_copy_only=False)] if len(starts) else np.zeros(0, np.int64)
    ends = np.searchsorted(starts, offsets[1:], side="left")
    numbers = np.insert(numbers, ends, 0)
    lengths = memo.length[numbers]
    upto = np.concatenate([[0], np.cumsum(lengths)])
    return memo.ids[ragged(memo.start[numbers], lengths)], upto[np.concatenate([[0], ends + np.arange(1, len(ends) + 1)])]


def _cut(path: str, capacity: int):
    def pieces_of(batch: pa.RecordBatch) -> pa.RecordBatch:
        tokens, at = _encode(batch.column("text"), path)
        sizes = np.diff(at)
        pieces = -(-sizes // capacity)
        doc = np.repeat(np.arange(len(sizes)), pieces)
        piece = ragged(np.zeros(len(sizes), np.int64), pieces)
        head = sizes - (pieces - 1) * capacity  # only the first piece may be shorter
        start = np.where(piece == 0, 0, head[doc] + (piece - 1) * capacity)
        length = np.where(piece == 0, head[doc], capacity)
        view = memoryview(tokens).cast("B")
        low = 4 * (at[doc] + start)
        crcs = [zlib.crc32(view[i:j]) for i, j in zip(low.tolist(), (low + 4 * length).tolist(), strict=True)]
        return table(_PIECE_ARROW, [batch.column("doc_id").take(pa.array(doc)), piece.astype(np.int32), start, length.astype(np.int32), crcs])

    def run(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        for batch in batches:
            for i, j in slices(text_buffer(batch.column("text"))[1], 1 << 20):
                yield pieces_of(batch.slice(i, j - i))
        _loaded.clear()  # other stages use the same workers

    return lean(run)


def fullest(limit: int, counts: dict[int, int]) -> list[int]:
    """Lengths, each at most as often as counts has it, of greatest sum up to limit; of equal sums the one with the longest first."""
    mask = (1 << (limit + 1)) - 1
    reach, steps = 1, []
    for length in sorted((x for x in counts if x <= limit), reverse=True):
        left, size = min(counts[length], limit // length), 1
        while left:
            take = min(size, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            left -= take
            size *= 2
        if reach >> limit & 1:
            break
    total = reach.bit_length() - 1
    out: list[int] = []
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            out += [length] * take
            total -= length * take
    return out


def plan(counts: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """(lengths of a bin, how many such bins), until nothing is left."""
    counts = {k: v for k, v in counts.items() if v > 0}
    out = []
    while counts:
        lead = max(counts)
        counts[lead] -= 1
        rest = fullest(capacity - lead, {k: v for k, v in counts.items() if v})
        counts[lead] += 1
        bin_ = [lead, *rest]
        need: dict[int, int] = {}
        for x in bin_:
            need[x] = need.get(x, 0) + 1
        times = min(counts[k] // n for k, n in need.items())
        for k, n in need.items():
            counts[k] -= n * times
            if not counts[k]:
                del counts[k]
        out.append((bin_, times))
    return out


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 1024) -> DataFrame:
    prepare(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_cut(tokenizer_path, capacity), _PIECE)


def pack(pieces: DataFrame, capacity: int = 1024) -> DataFrame:
    """pieces (length between 1 and capacity, any more columns) with sequence_id and offset."""
    spark = pieces.sparkSession
    keys = [c for c in ("doc_id", "piece", "start", "ids_crc32") if c in pieces.columns]
    counts = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}  # at most capacity rows
    bins = plan(dict(counts), capacity)
    rows, number, used = [], 0, {}
    for lengths, times in bins:
        offset, seen = 0, {}
        for x in lengths:
            seen.setdefault(x, []).append(offset)
            offset += x
        for x, offsets in seen.items():
            per = len(offsets)
            rows.append((x, used.get(x, 0), used.get(x, 0) + per * times, per, number, offsets))
            used[x] = used.get(x, 0) + per * times
        number += times
    by_length: dict[int, list] = {}
    for length, *rest in rows:
        by_length.setdefault(length, []).append(tuple(rest))
    patterns = spark.createDataFrame(sorted(by_length.items()), "length int, patterns array<struct<low: long, high: long, per: int, first: long, offsets: array<int>>>")
    groups = max(1, -(-max(counts.values(), default=1) // GROUP_ROWS))
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64(*keys), F.lit(groups)))
    sizes = salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.withColumn("_before", F.sum("_n").over(Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_n")).drop("_n")
    ranked = salted.withColumn("_rank", F.row_number().over(Window.partitionBy("length", "_salt").orderBy(*keys))).join(before, ["length", "_salt"]).withColumn("_rank", F.col("_rank") - 1 + F.col("_before"))
    placed = ranked.join(F.broadcast(patterns), "length").withColumn("_p", F.filter("patterns", lambda p: (p["low"] <= F.col("_rank")) & (F.col("_rank") < p["high"]))[0]).withColumn("_k", F.col("_rank") - F.col("_p.low"))
    return placed.select(*pieces.columns, (F.col("_p.first") + F.floor(F.col("_k") / F.col("_p.per"))).cast("long").alias("sequence_id"), F.col("_p.offsets")[(F.col("_k") % F.col("_p.per")).cast("int")].cast("long").alias("offset"))


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 1024) -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = materialize(token_pieces(docs, tokenizer_path, capacity))
    out = pack(pieces, capacity)
    return out.withColumn("length", F.col("length").cast("long"))
