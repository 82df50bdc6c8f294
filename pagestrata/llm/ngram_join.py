"""N-gram Jaccard join: documents whose sets of word shingles are similar, as classes with link counts.

Rare-first prefix filtering. A fixed-size sketch of shingle counts over all documents orders each set from rare to frequent
(ties by hash); two sets that reach the threshold share a shingle among the first n - ceil(t n) + 1 of each. Entries
of these prefixes meet by shingle, where length and positional filters apply; candidates then pass a suffix filter
(element counts over 64 hash ranges bound the symmetric difference from below) and are verified once on their full sets.

Shingles are told apart by 128-bit hashes chained from BLAKE2b digests of their words. Sets of one digest (BLAKE2b of their sorted hashes) form one
class before anything else. In a shingle's bucket each entry first meets the entry in which that
shingle stands earliest and its own neighbours only; after links found so have merged documents into components, the remaining
pairs of different components are enumerated, inside the operator: in a bucket, entries outside its largest component meet all others. A group of
thousands of near copies costs as many pairs as it has members, and no link between different components is lost. A bucket of more than
HOT_ENTRIES entries is dealt over blocks by a hash of the document: first blocks work alone, then one entry of each component and bucket is
merged across them, then each pair of blocks is a cell of its own. A candidate is verified on its two texts: their words are compared, not hashes.
All links lie within components, where they are
counted exactly: each pair of a component's classes that the length filter lets pass meets in one cell of at most two blocks
of classes, and a cell's intersections are products of its 0/1 matrix of classes and shingles, numbered by their words. No pair becomes a row.

Defined results: null text, or text without words, has an empty set and is linked with nothing (n_shingles 0, component its own
doc_id); fewer words than the shingle: the whole sequence is one shingle; rows of one doc_id count as one document if
their sets are equal, else each set is linked on its own and both rows get the smallest component; null doc_id: linked with
nothing, component_id null; an empty table gives no rows; of the input only doc_id and text are read.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, Words, blobs, connected_components, discard, lean, materialize, mix, partitions, parts_for, prepare, ragged, slices, table, text_buffer

CELLS = 1 << 20
BLOCK_CLASSES = 1024
BLOCK_SHINGLES = 1 << 21
RANGES = 64
HOT_ENTRIES = 1 << 16
CHUNK_PAIRS = 1 << 21
_SET = "doc_id long, n int, s1 long, s2 long, prefix binary, ranges binary, text string"
_SET_ARROW = pa.schema([("doc_id", pa.int64()), ("n", pa.int32()), ("s1", pa.int64()), ("s2", pa.int64()), ("prefix", pa.binary()), ("ranges", pa.binary()), ("text", pa.string())])
_ENTRY = np.dtype([("h", "<u4"), ("id", "<i8"), ("n", "<i4"), ("pos", "<i4"), ("c", "<i8"), ("cell", "<u4"), ("own", "<u2")])


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text as two hashes each, sorted within it, and the index of its text for each."""
    w = Words(raw, offsets, lower=True)
    begins, stop = w.shingles(k)
    doc = w.doc[begins]
    h, g = w.chained(begins, stop, k)
    order = np.lexsort((h, doc))
    doc, h, g = doc[order], h[order], g[order]
    same = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    if (same & (g[1:] != g[:-1])).any():
        order = np.lexsort((g, h, doc))
        doc, h, g = doc[order], h[order], g[order]
        same = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    new = np.ones(len(h), bool)
    new[1:] = ~same | (g[1:] != g[:-1])
    return h[new], g[new], doc[new]


def exact_sets(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, numbered by their words within this call, sorted within it, and the index of its text for each."""
    raw, offsets = text_buffer(texts)
    w = Words(raw, offsets, lower=True)
    begins, stop = w.shingles(k)
    doc, code = w.doc[begins], w.numbered(begins, stop, k)
    order = np.lexsort((code, doc))
    doc, code = doc[order], code[order]
    new = np.ones(len(doc), bool)
    new[1:] = (code[1:] != code[:-1]) | (doc[1:] != doc[:-1])
    return code[new], doc[new]


def _sketch(k: int):
    schema = pa.schema([("chunk", pa.int32()), ("counts", pa.binary())])

    def run(batches):
        counts = np.zeros(CELLS, np.uint32)
        for batch in batches:
            raw, offsets = text_buffer(batch.column("text"))
            for i, j in slices(offsets):
                h, _, _ = shingle_sets(raw, offsets[i : j + 1], k)
                counts += np.bincount((h >> U64(44)).astype(np.int64), minlength=CELLS).astype(np.uint32)
        yield table(schema, [np.arange(16, dtype=np.int32), [x.tobytes() for x in counts.reshape(16, -1)]])

    return lean(run)


def _total(batches):
    schema = pa.schema([("chunk", pa.int32()), ("counts", pa.binary())])
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            total[chunk] = total.get(chunk, 0) + np.frombuffer(counts, np.uint32).astype(np.uint64)
    yield table(schema, [list(total), [np.minimum(x, 0xFFFFFFFF).astype(np.uint32).tobytes() for x in total.values()]])


def _sets(k: int, percent: int, shared):
    def run(batches):
        level = shared.value
        for batch in batches:
            raw, offsets = text_buffer(batch.column("text"))
            for i, j in slices(offsets):
                h, g, doc = shingle_sets(raw, offsets[i : j + 1], k)
                n_docs = j - i
                first = np.searchsorted(doc, np.arange(n_docs + 1))
                n = np.diff(first)
                whole = memoryview(np.stack([h, g], axis=1).tobytes())
                key = np.frombuffer(b"".join([blake2b(whole[16 * a : 16 * b], digest_size=16).digest() for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]), np.int64).reshape(-1, 2)
                order = np.lexsort((h, level[(h >> U64(44)).astype(np.int64)], doc))
                keep = np.where(n > 0, n - (percent * n + 99) // 100 + 1, 0)
                prefix = h[order][ragged(first[:-1], keep)]
                cell = np.bincount(doc * RANGES + ((h >> U64(20)) & U64(RANGES - 1)).astype(np.int64), minlength=n_docs * RANGES).astype(np.uint32)
                yield table(_SET_ARROW, [batch.column("doc_id").slice(i, j - i), n.astype(np.int32), key[:, 0], key[:, 1], blobs(prefix, np.repeat(np.arange(n_docs), keep), n_docs), [x.tobytes() for x in cell.reshape(n_docs, RANGES)], batch.column("text").slice(i, j - i)])

    return lean(run)


def _crowds(batches):
    """mapInArrow: counts of prefix entries by cell of their hash."""
    schema = pa.schema([("chunk", pa.int32()), ("counts", pa.binary())])
    counts = np.zeros(CELLS, np.uint32)
    for batch in batches:
        h = np.frombuffer(b"".join(batch.column("prefix").to_pylist()), np.uint64)
        counts += np.bincount((h >> U64(44)).astype(np.int64), minlength=CELLS).astype(np.uint32)
    yield table(schema, [np.arange(16, dtype=np.int32), [x.tobytes() for x in counts.reshape(16, -1)]])


def _spread(n_parts: int, blocks, full: bool):
    """mapInArrow: prefix entries by part. blocks: by cell of the hash, over how many blocks its entries are dealt; full: each entry goes to all pairs of its block."""
    schema = pa.schema([("part", pa.int32()), ("entries", pa.binary())])

    def run(batches):
        dealt = blocks.value
        for batch in batches:
            blobs_in = batch.column("prefix").to_pylist()
            h = np.frombuffer(b"".join(blobs_in), np.uint64)
            count = np.array([len(x) // 8 for x in blobs_in], np.int64)
            out = np.zeros(len(h), _ENTRY)
            out["h"] = (h & U64(0xFFFFFFFF)).astype(np.uint32)
            out["pos"] = ragged(np.zeros(len(count), np.int64), count)
            for name, column in (("id", "rep"), ("n", "n"), ("c", "c")):
                out[name] = np.repeat(batch.column(column).to_numpy(zero_copy_only=False), count)
            k = dealt[(h >> U64(44)).astype(np.int64)].astype(np.int64)
            own = (mix(out["id"].astype(np.uint64)) % k.astype(np.uint64)).astype(np.int64)
            out["own"] = own
            if full and (k > 1).any():
                at, other = np.repeat(np.arange(len(h)), k), ragged(np.zeros(len(k), np.int64), k)
                out, h, own = out[at], h[at], own[at]
                out["cell"] = (np.minimum(own, other) << 16) | np.maximum(own, other)
            else:
                out["cell"] = (own << 16) | own
            part = (((h >> U64(32)) + out["cell"].astype(np.uint64) * U64(0x9E3779B1)) % U64(n_parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            used = np.unique(part)
            yield table(schema, [used.astype(np.int32), blobs(out[order], np.searchsorted(used, part[order]), len(used))])

    return lean(run)


def _crowded(blocks):
    """mapInArrow: prefix entries of cells that are dealt over several blocks, a row each."""
    schema = pa.schema([("h", pa.int64()), ("c", pa.int64()), ("pos", pa.int32()), ("rep", pa.int64()), ("n", pa.int32())])

    def run(batches):
        dealt = blocks.value
        for batch in batches:
            blobs_in = batch.column("prefix").to_pylist()
            h = np.frombuffer(b"".join(blobs_in), np.uint64)
            count = np.array([len(x) // 8 for x in blobs_in], np.int64)
            pick = np.flatnonzero(dealt[(h >> U64(44)).astype(np.int64)] > 1)
            of, pos = np.repeat(np.arange(len(count)), count)[pick], ragged(np.zeros(len(count), np.int64), count)[pick]
            rep, n, c = (batch.column(x).to_numpy(zero_copy_only=False)[of] for x in ("rep", "n", "c"))
            yield table(schema, [h[pick].view(np.int64), c, pos.astype(np.int32), rep, n.astype(np.int32)])

    return lean(run)


_PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _passes(e: np.ndarray, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Length and positional filter of pairs of entries, of different components and, in a cell of two blocks, of both."""
    x, y = e[i], e[j]
    need = -(-percent * (x["n"].astype(np.int64) + y["n"]) // (100 + percent))
    room = np.minimum(x["n"] - x["pos"], y["n"] - y["pos"])
    cross = (x["own"] != y["own"]) | (x["cell"] >> 16 == x["cell"] & 0xFFFF)
    return (room >= need) & (x["c"] != y["c"]) & cross & (100 * np.minimum(x["n"], y["n"]).astype(np.int64) >= percent * np.maximum(x["n"], y["n"]).astype(np.int64))


def _pairs_out(found: list[np.ndarray]):
    pairs = np.unique(np.sort(np.concatenate(found, axis=1), axis=0), axis=1)
    for at in range(0, pairs.shape[1], 100_000):
        yield table(_PAIR, [pairs[0, at : at + 100_000], pairs[1, at : at + 100_000]])


def first_pairs(e: np.ndarray, percent: int) -> list[np.ndarray]:
    """Pairs of each entry with its bucket's lead and its neighbours; e sorted by bucket, length, id."""
    new = np.r_[True, (e["h"][1:] != e["h"][:-1]) | (e["cell"][1:] != e["cell"][:-1])]
    group, where = np.cumsum(new) - 1, np.flatnonzero(new)
    everyone, found = np.arange(len(e)), []
    lead = np.lexsort((e["id"], e["n"], e["pos"], group))[where][group]
    for i, j in ((everyone, lead), (everyone[:-1][~new[1:]], everyone[1:][~new[1:]])):
        ok = _passes(e, i, j, percent)
        found.append(np.stack([e["id"][i[ok]], e["id"][j[ok]]]))
    return found


def cross_pairs(e: np.ndarray, percent: int) -> list[np.ndarray]:
    """All pairs of different components; e sorted by bucket, length, id. Entries of a bucket's largest component only wait for the others."""
    new = np.r_[True, (e["h"][1:] != e["h"][:-1]) | (e["cell"][1:] != e["cell"][:-1])]
    group = np.cumsum(new) - 1
    order = np.lexsort((e["c"], group))
    g, c = group[order], e["c"][order]
    runs = np.flatnonzero(np.r_[True, (g[1:] != g[:-1]) | (c[1:] != c[:-1])])
    size = np.diff(np.r_[runs, len(e)])
    best = np.lexsort((size, g[runs]))
    last = np.flatnonzero(np.r_[g[runs][best][1:] != g[runs][best][:-1], True])
    largest = c[runs][best][last]  # of each bucket
    few = np.flatnonzero(e["c"] != largest[group])
    step = np.int64(int(e["n"].max()) + 2)
    key = group * step + e["n"]
    low = np.searchsorted(key, group[few] * step + -(-percent * e["n"][few].astype(np.int64) // 100), side="left")
    high = np.searchsorted(key, group[few] * step + np.minimum(100 * e["n"][few].astype(np.int64) // percent, step - 1), side="right")
    found, at, upto = [np.zeros((2, 0), np.int64)], 0, np.cumsum(high - low)
    while at < len(few):
        stop = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + CHUNK_PAIRS, side="right")))
        i, j = np.repeat(few[at:stop], high[at:stop] - low[at:stop]), ragged(low[at:stop], high[at:stop] - low[at:stop])
        ok = (i < j) | (e["c"][j] == largest[group[j]])
        i, j = i[ok], j[ok]
        ok = _passes(e, i, j, percent)
        found.append(np.stack([e["id"][i[ok]], e["id"][j[ok]]]))
        if len(found) > 64:
            found = [np.unique(np.sort(np.concatenate(found, axis=1), axis=0), axis=1)]
        at = stop
    return found


def _pairs(percent: int, full: bool):
    """mapInArrow over all entries of some parts: candidate pairs (a, b), a < b. full: all pairs of different components; else a few for each entry."""

    def run(batches):
        got = [np.frombuffer(x, _ENTRY) for batch in batches for x in batch.column("entries").to_pylist()]
        if not got:
            return
        e = np.concatenate(got)
        del got
        e = e[np.lexsort((e["id"], e["n"], e["cell"], e["h"]))]
        new = np.ones(len(e), bool)
        new[1:] = (e["h"][1:] != e["h"][:-1]) | (e["cell"][1:] != e["cell"][:-1])
        e = e[~(new & np.r_[new[1:], True])]
        if len(e):
            yield from _pairs_out((cross_pairs if full else first_pairs)(e, percent))

    return lean(run)


def _leads(percent: int):
    """mapInArrow over all rows (h, c, pos, rep, n) of some shingles, one a component: pairs with the lead and neighbours."""

    def run(batches):
        rows = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if rows is None or not rows.num_rows:
            return
        e = np.zeros(rows.num_rows, _ENTRY)
        h = rows.column("h").to_numpy()
        order = np.lexsort((rows.column("rep").to_numpy(), rows.column("n").to_numpy(), h))
        e["h"] = np.unique(h[order], return_inverse=True)[1]
        for name, column in (("id", "rep"), ("n", "n"), ("pos", "pos"), ("c", "c")):
            e[name] = rows.column(column).to_numpy()[order]
        yield from _pairs_out(first_pairs(e, percent))

    return lean(run)


def _verify(percent: int, k: int):
    """mapInArrow: pairs whose texts, cut into words anew, reach the threshold."""

    def run(batches):
        for batch in batches:
            m = len(batch)
            if not m:
                continue
            texts = pa.concat_arrays([batch.column(c).cast(pa.large_string()) for c in ("ta", "tb")])
            code, doc = exact_sets(texts, k)
            size = np.bincount(doc, minlength=2 * m)
            pair = doc % m
            order = np.lexsort((code, pair))
            code, pair = code[order], pair[order]
            same = np.bincount(pair[1:][(code[1:] == code[:-1]) & (pair[1:] == pair[:-1])], minlength=m)
            ok = pa.array((same > 0) & (100 * same >= percent * (size[:m] + size[m:] - same)))
            yield table(_PAIR, [batch.column("a").filter(ok), batch.column("b").filter(ok)])

    return lean(run)


def _suffix(percent: int):
    """mapInArrow: candidates whose element counts by hash range do not rule the threshold out."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for batch in batches:
            na, nb = (batch.column(c).to_numpy().astype(np.int64) for c in ("na", "nb"))
            ra, rb = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, RANGES).astype(np.int64) for c in ("ra", "rb"))
            need = -(-percent * (na + nb) // (100 + percent))
            ok = np.abs(ra - rb).sum(axis=1) <= na + nb - 2 * need
            yield table(schema, [batch.column("a").filter(pa.array(ok)), batch.column("b").filter(pa.array(ok))])

    return lean(run)


def _linked(texts: list[str], k: int, percent: int, first: int | None = None) -> np.ndarray:
    """Links of each text's set with the others; with `first`, only those between the first so many sets and the rest."""
    column, of = exact_sets(pa.array(texts, pa.large_string()), k)
    m, n = len(texts), np.bincount(of, minlength=len(texts)).astype(np.int64)
    _, column, count = np.unique(column, return_inverse=True, return_counts=True)
    column = np.where(count > 1, np.cumsum(count > 1) - 1, -1)[column]  # a shingle of one set is in no intersection
    of, column = of[column >= 0], column[column >= 0]
    order = np.argsort(column, kind="stable")
    of, column = of[order], column[order]
    half = m if first is None else first
    low = 0 if first is None else first
    same = np.zeros((half, m - low), np.int64)
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, 2048):
        i, j = np.searchsorted(column, [at, at + 2048])
        hit = np.zeros((m, min(2048, int(column[-1]) + 1 - at)), np.float32)
        hit[of[i:j], column[i:j] - at] = 1
        same += (hit[:half] @ hit[low:].T).astype(np.int64)
    link = 100 * same >= percent * (n[:half, None] + n[None, low:] - same)
    if first is None:
        np.fill_diagonal(link, False)
        return link.sum(axis=1)
    return np.r_[link.sum(axis=1), link.sum(axis=0)]


_CELL = ("component", "band", "i", "up", "j")
_DEGREE = "n int, s1 long, s2 long, n_links long"
_DEGREE_ARROW = pa.schema([("n", pa.int32()), ("s1", pa.int64()), ("s2", pa.int64()), ("n_links", pa.int64())])


def _degrees(percent: int, shingle: int):
    """mapInArrow over rows sorted by cell, side and class: the links of each class that its cell holds."""

    def counted(cell: tuple, rows: dict) -> pa.RecordBatch:
        _, _, i, up, j = cell
        keys = list(rows)  # rows of one class are given once
        got = _linked([rows[k] for k in keys], shingle, percent, sum(k[0] == 0 for k in keys) if up or i != j else None)
        return table(_DEGREE_ARROW, [[k[1] for k in keys], [k[2] for k in keys], [k[3] for k in keys], got])

    def run(batches):
        cell, rows = None, {}
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in (*_CELL, "side", "n", "s1", "s2", "text")]
            for component, band, i, up, j, *key, text in zip(*cols, strict=True):
                if (component, band, i, up, j) != cell:
                    if len(rows) > 1:
                        yield counted(cell, rows)
                    cell, rows = (component, band, i, up, j), {}
                rows[tuple(key)] = text
        if len(rows) > 1:
            yield counted(cell, rows)

    return lean(run)


def link_counts(members: DataFrame, sets: DataFrame, percent: int, shingle: int) -> DataFrame:
    """n, s1, s2, n_links of the classes in members (n, s1, s2, rep, component): exact, over all pairs of one component.

    A component above the size of a block is dealt by length, in bands so wide that sets which can link are in the same or in
    neighbouring ones, and bands by hash into blocks; each pair of blocks of one or two neighbouring bands is a cell.
    """
    wide = max(float(np.log(100 / percent)) * 1.0001, 1e-6)
    size = (F.count(F.lit(1)).alias("m"), F.sum("n").alias("total"))
    large = members.groupBy("component").agg(*size).where((F.col("m") > BLOCK_CLASSES) | (F.col("total") > BLOCK_SHINGLES)).select("component", F.lit(True).alias("_large"))
    banded = members.join(F.broadcast(large), "component", "left").withColumn("band", F.when(F.col("_large"), F.floor(F.log("n") / wide)).otherwise(F.lit(0)).cast("long"))
    parts = F.greatest(F.ceil(F.col("m") / BLOCK_CLASSES), F.ceil(F.col("total") / BLOCK_SHINGLES)).cast("int")
    blocks = materialize(banded.where("_large").groupBy("component", "band").agg(*size).select("component", "band", parts.alias("parts")))
    near = lambda step, name: F.broadcast(blocks.select("component", (F.col("band") + step).alias("band"), F.col("parts").alias(name)))
    dealt = banded.join(near(0, "_own"), ["component", "band"], "left").join(near(-1, "_up"), ["component", "band"], "left").join(near(1, "_down"), ["component", "band"], "left")
    block = F.pmod(F.xxhash64("s1", "s2"), F.coalesce("_own", F.lit(1))).cast("int")
    each = lambda count, f: F.transform(F.when(F.coalesce(count, F.lit(0)) > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.expr("CAST(array() AS array<int>)")), f)
    cell = lambda band, i, up, j, side: F.struct(band.alias("band"), i.alias("i"), F.lit(up).alias("up"), j.alias("j"), side.alias("side"))
    b = F.col("_b")
    cells = F.concat(each(F.coalesce("_own", F.lit(1)), lambda k: cell(F.col("band"), F.least(b, k), 0, F.greatest(b, k), (b > k).cast("int"))), each(F.col("_up"), lambda k: cell(F.col("band"), b, 1, k, F.lit(0))), each(F.col("_down"), lambda k: cell(F.col("band") - 1, k, 1, b, F.lit(1))))
    known = dealt.withColumn("_b", block).select("component", "n", "s1", "s2", F.col("rep").alias("doc_id"), cells.alias("_cells"))
    full = sets.select("doc_id", "n", "s1", "s2", "text").join(known, ["doc_id", "n", "s1", "s2"])
    rows = full.select("component", "n", "s1", "s2", "text", F.explode("_cells").alias("_c")).select("component", "_c.*", "n", "s1", "s2", "text")
    placed = rows.repartition(partitions(sets.sparkSession), *_CELL).sortWithinPartitions(*_CELL, "side", "s1", "s2")
    return placed.mapInArrow(_degrees(percent, shingle), _DEGREE).groupBy("n", "s1", "s2").agg(F.sum("n_links").alias("n_links"))


def ngram_classes(docs: DataFrame, shingle: int = 5, percent: int = 80, spent: list[DataFrame] | None = None, counts: bool = True) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links (classes of equal sets linked with the document's class) of each row of docs (doc_id, text).

    Documents link when 100 x intersection >= percent x union of their sets of shingles of so many lower-cased words.
    spent: takes the tables that the result reads; a caller who has written the result may discard them. counts: whether to count links,
    else the result has no n_links.
    """
    spark = docs.sparkSession
    prepare(spark)
    n_parts = parts_for(docs)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    chunk, pair = "chunk int, counts binary", "a long, b long"

    def counted(rows: DataFrame) -> np.ndarray:
        """Counts by cell of the hash: a fixed 4 MB, whatever the input."""
        out = np.zeros((16, CELLS // 16), np.uint32)
        for row in rows.repartition(16, "chunk").mapInArrow(_total, chunk).collect():
            out[row[0]] = np.frombuffer(row[1], np.uint32)
        return out.reshape(-1)

    shared = spark.sparkContext.broadcast(counted(docs.select("text").where("text IS NOT NULL").mapInArrow(_sketch(shingle), chunk)))
    sets = materialize(docs.mapInArrow(_sets(shingle, percent, shared), _SET))
    small = sets.select("doc_id", "n", "s1", "s2")
    reps = materialize(sets.where("n > 0 AND doc_id IS NOT NULL").groupBy("s1", "s2", "n").agg(F.min("doc_id").alias("rep"), F.min_by("prefix", "doc_id").alias("prefix"), F.min_by("ranges", "doc_id").alias("ranges")).select("rep", "n", "s1", "s2", "prefix", "ranges"))
    crowds = -(-counted(reps.select("prefix").mapInArrow(_crowds, chunk)).astype(np.int64) // HOT_ENTRIES)
    blocks = spark.sparkContext.broadcast(np.clip(crowds, 1, 0xFFFF).astype(np.uint16))

    def near(found: DataFrame) -> DataFrame:
        side = reps.select("rep", "n", "ranges")
        both = found.distinct().join(side.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("ranges").alias("ra")), "a").join(side.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("ranges").alias("rb")), "b")
        return both.select("a", "b", "na", "nb", "ra", "rb").mapInArrow(_suffix(percent), pair)

    def candidates(labelled: DataFrame, full: bool) -> DataFrame:
        return near(labelled.mapInArrow(_spread(n_parts, blocks, full), "part int, entries binary").repartition(n_parts, "part").mapInArrow(_pairs(percent, full), pair))

    def verified(pairs: DataFrame) -> DataFrame:
        known = reps.select("rep", "s1", "s2")
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
        side = sets.select("doc_id", "s1", "s2", "text").join(wanted, "doc_id", "left_semi").join(known.select(F.col("rep").alias("doc_id"), "s1", "s2"), ["doc_id", "s1", "s2"], "left_semi").dropDuplicates(["doc_id", "s1", "s2"]).select("doc_id", "text")
        both = pairs.join(side.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")), "a").join(side.select(F.col("doc_id").alias("b"), F.col("text").alias("tb")), "b")
        return both.select("a", "b", "ta", "tb").mapInArrow(_verify(percent, shingle), pair)

    def label(merged: DataFrame) -> DataFrame:
        return reps.join(merged.withColumnRenamed("id", "rep"), "rep", "left").select("rep", "n", "prefix", F.coalesce("component", "rep").alias("c"))

    tried = materialize(candidates(reps.select("rep", "n", "prefix", F.col("rep").alias("c")), False))
    links = materialize(verified(tried))
    merged = connected_components(links)
    while (crowds > 1).any():  # merge across the blocks of large buckets until that finds nothing more
        leads = label(merged).mapInArrow(_crowded(blocks), "h long, c long, pos int, rep long, n int").groupBy("h", "c").agg(F.min(F.struct("pos", "rep", "n")).alias("x")).select("h", "c", "x.*")
        also = materialize(near(leads.repartition(n_parts, "h").mapInArrow(_leads(percent), pair)).join(tried, ["a", "b"], "left_anti"))
        new = materialize(verified(also))
        tried, links, before = materialize(tried.union(also)), materialize(links.union(new)), (tried, links, also)
        for x in before:
            discard(x)
        if new.isEmpty():
            discard(new)
            break
        discard(new)
        merged = connected_components(links)
    rest = materialize(candidates(label(merged), True).join(tried, ["a", "b"], "left_anti"))
    more = materialize(verified(rest))
    every = links.union(more)
    final = connected_components(every.union(merged.select(F.col("id").alias("a"), F.col("component").alias("b"))))
    classes = reps.select("rep", "n", "s1", "s2").join(final.withColumnRenamed("id", "rep"), "rep", "left").select("n", "s1", "s2", "rep", F.coalesce("component", "rep").alias("component_id"))
    out = small.join(classes.drop("rep"), ["n", "s1", "s2"], "left").select("doc_id", "n", "s1", "s2", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
    if counts:
        # a class alone in its component has no link; rows of one doc_id with different sets are classes of one component
        linked = final.union(reps.groupBy("rep").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").join(final, F.col("rep") == F.col("id"), "left_anti").select(F.col("rep").alias("id"), F.col("rep").alias("component")))
        members = materialize(reps.select("n", "s1", "s2", "rep").join(linked.withColumnRenamed("id", "rep"), "rep"))
        degree = materialize(link_counts(members, sets, percent, shingle))
        discard(members)
        out = out.join(degree, ["n", "s1", "s2"], "left").withColumn("n_links", F.coalesce(F.when(F.col("doc_id").isNotNull(), F.col("n_links")), F.lit(0)).cast("long"))
        if spent is not None:
            spent.append(degree)
    out = out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id", *["n_links"] * counts)
    discard(tried)
    if spent is not None:
        spent += [sets, reps, links, rest, more]
    return out


def drop_near_copies(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """One row of each class of docs, the one of smallest doc_id; rows without words and rows of null doc_id stay as they are."""
    spent: list[DataFrame] = []
    classes = materialize(ngram_classes(docs, shingle, percent, spent, counts=False).where("doc_id <> component_id").select("doc_id").distinct())
    for x in spent:
        discard(x)
    kept = docs.join(classes, docs["doc_id"] == classes["doc_id"], "left_anti")
    return kept
