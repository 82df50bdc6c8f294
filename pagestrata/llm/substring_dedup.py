"""Substring dedup: words covered by a window of words that also starts in a document of smaller doc_id are removed.

Level-wise doubling. Windows of about half the wanted length (anchors) come first; windows repeated in another document
alone are extended to twice that length, where windows are compared by the 128-bit BLAKE2b digest of their words' digests. Of the anchors only local minima of their hash are
exchanged: every window of the wanted length holds one, and equal windows hold equal ones, so no repeat is lost. What one
batch of documents already knows (a hash seen in a smaller document) is settled there; one entry per hash and batch is
sent on, so a passage that a third of all documents share meets as one entry per batch, not one per document.

Defined results: null text has no words and stays null; a null doc_id takes no part, its text stays; rows of equal doc_id
are never compared with each other; fewer words than the window: nothing is removed; white space between kept words
becomes one space in changed texts only; an empty table gives no rows; input columns named n_words, n_removed or, with digest, kept_sha256
are replaced, all others are kept (names with two leading underscores are the operator's own).
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import U64, Words, blobs, lean, mix, partitions, parts_for, prepare, slices, table, text_buffer, without

_ENTRY = "part int, h binary, g binary, owner binary, n binary, at binary, told boolean"
_ENTRY_ARROW = pa.schema([("part", pa.int32()), ("h", pa.binary()), ("g", pa.binary()), ("owner", pa.binary()), ("n", pa.binary()), ("at", pa.binary()), ("told", pa.bool_())])
_OWNER = np.dtype([("doc", "<i8"), ("key", "<i8")])
_ANSWER = "part int, owner binary, n binary, at binary"
_ANSWER_ARROW = pa.schema([("part", pa.int32()), ("owner", pa.binary()), ("n", pa.binary()), ("at", pa.binary())])
_PLACES = "doc_id long, __key long, __places binary"
_PLACES_ARROW = pa.schema([("doc_id", pa.int64()), ("__key", pa.int64()), ("__places", pa.binary())])


def levels(length: int) -> list[int]:
    """Window lengths, each at most twice the one before it, the wanted one last."""
    out = [length]
    while out[0] > 12:
        out.insert(0, -(-out[0] // 2))
    return out


def _anchors(words: Words, k: int, length: int) -> np.ndarray:
    """Positions of k-word windows whose hash is least among those inside some window of length words of one text."""
    h, valid = words.windows(k)
    span = length - k + 1
    n = len(words.hash) - length + 1
    if n <= 0:
        return np.zeros(0, np.int64), h
    whole = words.doc[:n] == words.doc[length - 1 :]
    least = h[:n].copy()
    for j in range(1, span):
        np.minimum(least, h[j : j + n], out=least)
    chosen = np.zeros(len(h), bool)
    for j in range(span):
        chosen[j : j + n] |= whole & (h[j : j + n] == least)
    return np.flatnonzero(chosen), h


def _owners(doc, key) -> np.ndarray:
    out = np.empty(len(doc), _OWNER)
    out["doc"], out["key"] = doc, key
    return out


def _packed(at: np.ndarray, groups: np.ndarray, n_groups: int) -> list[bytes]:
    """Places of each group as differences, byte planes apart: neighbours differ little, so that all but the first plane compress to nothing."""
    cut = np.searchsorted(groups, np.arange(n_groups + 1)).tolist()
    at = at.astype(np.int32)
    return [np.diff(at[a:b], prepend=np.int32(0)).view(np.uint8).reshape(-1, 4).T.tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)]


def _places(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(blob, np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.int32).reshape(-1), dtype=np.int32)


def _answers(owner: np.ndarray, at: np.ndarray, n_parts: int) -> tuple:
    """Places found, one row for each part of the documents."""
    part = (mix(owner["doc"].astype(np.uint64)) % U64(n_parts)).astype(np.int64)
    order = np.lexsort((at, owner["key"], owner["doc"], part))
    owner, at, part = owner[order], at[order], part[order]
    used = np.unique(part)
    dense, n = np.searchsorted(used, part), len(used)
    first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    return used.astype(np.int32), blobs(owner[first], dense[first], n), blobs(np.diff(np.r_[first, len(owner)]).astype(np.uint32), dense[first], n), _packed(at, dense, n)


def _send(h, g, doc, key, at, n_parts, any_other: bool):
    """Entries by part, and answers that this batch gives itself. any_other: any other document counts, not only a smaller one."""
    order = np.lexsort((doc, g, h))
    h, g, doc, key, at = h[order], g[order], doc[order], key[order], at[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1])
    group = np.cumsum(new) - 1
    lead = doc[np.flatnonzero(new)]
    later = doc != lead[group]
    several = np.zeros(len(lead), bool)
    several[group[later]] = True
    if any_other:
        known = several[group]
        sent = ~known | new
        told = known
    else:
        known = later
        sent = ~known
        told = np.zeros(len(h), bool)
    rows = []
    part = (h >> U64(40)).astype(np.int64) % n_parts
    for flag in (False, True):
        pick = np.flatnonzero(sent & (told == flag))
        pick = pick[np.lexsort((at[pick], key[pick], doc[pick], part[pick]))]
        p = part[pick]
        used = np.unique(p)
        dense, n = np.searchsorted(used, p), len(used)
        hs = (h[pick] & U64(0xFFFFFFFF)).astype(np.uint32) if any_other else h[pick]
        gs = [b""] * n if any_other else blobs(g[pick], dense, n)
        if flag and any_other:
            owners = counts = ats = [b""] * n
        else:
            owner = _owners(doc[pick], key[pick])
            first = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (dense[1:] != dense[:-1])][: len(pick)])
            owners, counts = blobs(owner[first], dense[first], n), blobs(np.diff(np.r_[first, len(pick)]).astype(np.uint32), dense[first], n)
            ats = _packed(at[pick], dense, n)
        rows.append(table(_ENTRY_ARROW, [used.astype(np.int32), blobs(hs, dense, n), gs, owners, counts, ats, np.full(n, flag)]))
    answered = np.flatnonzero(known)
    if len(answered):
        to, owners, counts, ats = _answers(_owners(doc[answered], key[answered]), at[answered], n_parts)
        none = [b""] * len(to)
        rows.append(table(_ENTRY_ARROW, [to, none, none, owners, counts, ats, np.ones(len(to), bool)]))
    return rows


def _level(k: int, length: int, size: int, n_parts: int):
    """mapInArrow: entries of a level. The first one takes anchors of every text; later ones the k-word windows around the places where those of size words were repeated."""
    final, first = k == length, not size

    def run(batches):
        for batch in batches:
            raw, offsets = text_buffer(batch.column("text"))
            ids, keys = batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False), batch.column("__key").to_numpy(zero_copy_only=False)
            found = None if first else batch.column("__places").to_pylist()
            got = []
            for i, j in slices(offsets):
                w = Words(raw, offsets[i : j + 1])
                if first and not final:
                    at, h = _anchors(w, k, length)
                elif first:
                    h, valid = w.windows(k)
                    at = np.flatnonzero(valid)
                else:
                    h, valid = w.windows(k)
                    joined = [x or b"" for x in found[i:j]]
                    doc = np.repeat(np.arange(j - i), [len(x) // 4 for x in joined])
                    p = np.frombuffer(b"".join(joined), np.int32) + w.first[doc]
                    low, n = np.maximum(p - (k - size), w.first[doc]), len(h)
                    mark = np.bincount(np.minimum(low, n), minlength=n + 1) - np.bincount(np.minimum(p + 1, n), minlength=n + 1)
                    at = np.flatnonzero((np.cumsum(mark)[: len(h)] > 0) & valid)
                if not len(at):
                    continue
                d = w.doc[at]
                head, tail = w.digests(at, k) if final else (h[at], np.zeros(len(at), np.uint64))
                got.append((head, tail, ids[i + d], keys[i + d], at - w.first[d]))
            if got:
                yield from _send(*[np.concatenate(x) for x in zip(*got, strict=True)], n_parts, not final)

    return lean(run)


def _meet(final: bool, n_parts: int):
    """mapInArrow over all entries of some parts: which of them another (final: a smaller) document has too."""

    def run(batches):
        hs, gs, owners, ats, told, settled = [], [], [], [], [], []
        for batch in batches:
            for h, g, owner, count, at, flag in zip(*[batch.column(c).to_pylist() for c in ("h", "g", "owner", "n", "at", "told")], strict=True):
                if flag and not h:
                    settled.append((np.repeat(np.frombuffer(owner, _OWNER), np.frombuffer(count, np.uint32)), _places(at)))
                    continue
                hs.append(np.frombuffer(h, np.uint64 if final else np.uint32))
                n = len(hs[-1])
                gs.append(np.frombuffer(g, np.uint64) if final else np.zeros(n, np.uint64))
                if owner:
                    owners.append(np.repeat(np.frombuffer(owner, _OWNER), np.frombuffer(count, np.uint32)))
                    ats.append(_places(at))
                else:
                    owners.append(np.zeros(n, _OWNER))
                    ats.append(np.full(n, -1, np.int32))
                told.append(np.full(n, flag))
        if settled:
            yield table(_ANSWER_ARROW, list(_answers(*[np.concatenate(x) for x in zip(*settled, strict=True)], n_parts)))
        if not hs:
            return
        h, g, owner, at, told = (np.concatenate(x) for x in (hs, gs, owners, ats, told))
        del hs, gs, owners, ats
        order = np.lexsort((owner["doc"], g, h))
        h, g, owner, at, told = h[order], g[order], owner[order], at[order], told[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1])
        group, where = np.cumsum(new) - 1, np.flatnonzero(new)
        if final:
            hit = owner["doc"] != owner["doc"][where][group]
        else:
            repeated = (owner["doc"][where] != owner["doc"][np.r_[where[1:], len(h)] - 1]) | np.logical_or.reduceat(told, where)
            hit = repeated[group] & ~told
        pick = np.flatnonzero(hit)
        if not len(pick):
            return
        yield table(_ANSWER_ARROW, list(_answers(owner[pick], at[pick], n_parts)))

    return lean(run)


@lean
def _gather(batches):
    """mapInArrow over all answers for some documents: one row a document."""
    owners, ats = [], []
    for batch in batches:
        for owner, n, at in zip(*[batch.column(c).to_pylist() for c in ("owner", "n", "at")], strict=True):
            owners.append(np.repeat(np.frombuffer(owner, _OWNER), np.frombuffer(n, np.uint32)))
            ats.append(_places(at))
    if not owners:
        return
    owner, at = np.concatenate(owners), np.concatenate(ats)
    order = np.lexsort((at, owner["key"], owner["doc"]))
    owner, at = owner[order], at[order]
    first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    ends = np.r_[first[1:], len(owner)]
    for i in range(0, len(first), 5000):
        a, b = first[i : i + 5000], ends[i : i + 5000]
        yield table(_PLACES_ARROW, [owner["doc"][a], owner["key"][a], [at[x:y].tobytes() for x, y in zip(a, b, strict=True)]])


def _strip(length: int, digest: bool):
    """mapInArrow: texts without the words under the places found."""

    def run(batches):
        for batch in batches:
            texts, found = batch.column("text"), batch.column("__places").to_pylist()
            n_words, n_removed, kept, sums = [], [], [], []
            for i, places in enumerate(found):
                text = texts[i].as_py()
                words = (text or "").encode().split()
                n, gone, out = len(words), 0, text
                if places:
                    p = np.frombuffer(places, np.int32)
                    mark = np.bincount(p, minlength=n + 1) - np.bincount(np.minimum(p + length, n), minlength=n + 1)
                    keep = np.cumsum(mark)[:n] == 0
                    gone = int(n - keep.sum())
                    words = list(compress(words, keep.tolist()))
                    out = b" ".join(words).decode()
                n_words.append(n)
                n_removed.append(gone)
                if digest:
                    sums.append(hashlib.sha256(b" ".join(words)).hexdigest())
                else:
                    kept.append(out)
            cols = {c: batch.column(c) for c in batch.schema.names if c not in ("__places", "text")}
            if digest:
                cols["kept_sha256"] = pa.array(sums, pa.string())
            else:
                cols["text"] = pa.array(kept, pa.string())
            cols["n_words"], cols["n_removed"] = pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())
            yield pa.RecordBatch.from_pydict(cols)

    return lean(run)


def substring_dedup(docs: DataFrame, length: int = 13, digest: bool = False) -> DataFrame:
    """docs (doc_id, text, any more columns) with repeated passages removed from text, plus n_words and n_removed.

    length: words of the window. digest: give kept_sha256 (kept words joined by one space) instead of the text.
    """
    prepare(docs.sparkSession)
    more = without(docs, "n_words", "n_removed", *["kept_sha256"] * digest)
    keyed = more.withColumns({"doc_id": F.col("doc_id").cast("long"), "text": F.col("text").cast("string")}).withColumn("__key", F.xxhash64("text"))
    texts = keyed.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "text", "__key")
    parts = parts_for(docs)
    steps, found = levels(length), None
    # a hash join cannot spill: only where a partition's places are known to be few
    small = (lambda x: x.hint("shuffle_hash")) if parts <= partitions(docs.sparkSession) else (lambda x: x)
    # every join below takes the same left side, columns and rows, so that its texts are shuffled once
    for n, k in enumerate(steps):
        if found is None:
            entries = texts.mapInArrow(_level(k, length, 0, 4 * parts), _ENTRY)
        else:
            entries = keyed.join(small(found), ["doc_id", "__key"], "left").mapInArrow(_level(k, length, steps[n - 1], 4 * parts), _ENTRY)
        answers = entries.repartition(parts, "part").mapInArrow(_meet(k == length, parts), _ANSWER)
        found = answers.repartition(parts, "part").mapInArrow(_gather, _PLACES)
    joined = keyed.join(small(found), ["doc_id", "__key"], "left").drop("__key")
    kept = [f for f in joined.schema.fields if f.name not in ("__places", "text")]
    out = joined.mapInArrow(_strip(length, digest), T.StructType([*kept, T.StructField("kept_sha256" if digest else "text", T.StringType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())]))
    return out if digest else out.select(*[f"`{c}`" for c in more.columns], "n_words", "n_removed")
