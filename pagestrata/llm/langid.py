"""Language identification by bit-sliced Bloom filters of character n-grams.

Each cell of the filter holds a bit mask of languages. An n-gram's mask is the conjunction of the masks in its cells, so one lookup returns all languages
whose filter contains it. For each language the n-grams of a text that it contains are counted, the count expected from false
positives is taken off, and the language with the largest corrected share wins.

An n-gram enters a language's filter if its rate there is at least `ratio` of its greatest rate in any language and it was seen at least
twice. Filters are learned from a hash sample of about `max_rows` rows a language (the bound is a parameter); every whole text is then scored. Any number of
languages, in order of code point: each cell has a mask of 64 languages for every 64 of them. Defined results: null doc_id is learned from like any other; null text, or text without a letter, gives `und` with score 0; without learned
languages every text gives `und`; ties go to the smaller code.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import U64, materialize, mix, prepare, slices, table, text_buffer, without
from .quality import held_out

SIZES = (2, 3, 4)
CELLS = 1 << 21
HASHES = 2
_RATES = 1 << 22


def ngrams(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the byte n-grams of each lower-cased text within and at the edges of its letter runs, and the index of its text."""
    raw = raw[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    letter = ((raw | 32) >= 97) & ((raw | 32) <= 122) | (raw >= 128)
    low = np.where(letter, np.where(raw < 128, raw | 32, raw), 32).astype(np.uint64)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    hs, docs = [], []
    for n in SIZES:
        m = len(low) - n + 1
        if m <= 0:
            continue
        h = np.full(m, n, np.uint64)
        inner = np.ones(m, bool)
        with np.errstate(over="ignore"):
            for j in range(n):
                h = (h << U64(8)) | low[j : j + m]
                if 0 < j < n - 1:
                    inner &= low[j : j + m] != 32
        ok = inner & (text[:m] == text[n - 1 :]) & ((low[:m] != 32) | (low[n - 1 :] != 32))
        at = np.flatnonzero(ok)
        hs.append(mix(h[at]))
        docs.append(text[at])
    return (np.concatenate(hs), np.concatenate(docs)) if hs else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def cells(h: np.ndarray) -> list[np.ndarray]:
    return [((h >> U64(21 * k)) & U64(CELLS - 1)).astype(np.int64) for k in range(HASHES)]


def _counts():
    schema = pa.schema([("lang", pa.int32()), ("h", pa.int64()), ("n", pa.int64())])

    def run(batches):
        for batch in batches:
            raw, offsets = text_buffer(batch.column("text"))
            lang = batch.column("lang").to_numpy()
            for i, j in slices(offsets):
                h, doc = ngrams(raw, offsets[i : j + 1])
                for k in np.unique(lang[i:j]):
                    u, n = np.unique(h[lang[i:j][doc] == k], return_counts=True)
                    yield table(schema, [np.full(len(u), k, np.int32), u.view(np.int64), n])

    return run


def _fill():
    """mapInArrow: masks of n-grams as cells of the filter."""
    schema = pa.schema([("cell", pa.int32()), ("word", pa.int32()), ("mask", pa.int64())])

    def run(batches):
        for batch in batches:
            h, word, mask = batch.column("h").to_numpy().view(np.uint64), batch.column("word").to_numpy(), batch.column("mask").to_numpy()
            for c in cells(h):
                yield table(schema, [c.astype(np.int32), word, mask])

    return run


def _predict(shared, names: list[str]):
    def run(batches):
        langs, cell, word, mask, rate = shared.value
        width = -(-len(langs) // 64)
        kind = np.uint8 if len(langs) <= 8 else np.uint16 if len(langs) <= 16 else np.uint64
        filters = np.zeros((max(width, 1), CELLS), kind)
        filters[word, cell] = mask.view(np.uint64).astype(kind)
        patterns = ((np.arange(256)[:, None] >> np.arange(len(langs))) & 1).astype(np.float64) if kind == np.uint8 else None
        for batch in batches:
            texts = batch.column("text")
            raw, offsets = text_buffer(texts)
            spoken = pc.match_substring_regex(texts, r"\p{L}").fill_null(False).to_numpy(zero_copy_only=False)
            best, score = [], []
            for i, j in slices(offsets):
                h, doc = ngrams(raw, offsets[i : j + 1])
                at = cells(h)
                n = np.bincount(doc, minlength=j - i)
                hits = np.zeros((j - i, len(langs)))
                for w in range(width):
                    found = filters[w][at[0]]
                    for c in at[1:]:
                        found &= filters[w][c]
                    if patterns is not None:
                        hits = np.bincount(doc * 256 + found, minlength=(j - i) * 256).reshape(j - i, 256) @ patterns
                        continue
                    for k in range(64 * w, min(64 * w + 64, len(langs))):
                        hits[:, k] = np.bincount(doc, (found >> kind(k - 64 * w)) & kind(1), minlength=j - i)
                share = np.clip((hits / np.maximum(n, 1)[:, None] - rate) / np.maximum(1 - rate, 1e-9), 0, 1)
                top = share.argmax(axis=1) if len(langs) else np.zeros(j - i, np.int64)
                for d in range(j - i):
                    if not len(langs) or not spoken[i + d]:
                        best.append("und")
                        score.append(0.0)
                    else:
                        best.append(langs[top[d]])
                        score.append(float(share[d, top[d]]))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(best, pa.string()), pa.array(score, pa.float64())], names=[*names, "lang_pred", "score"])

    return run


def identify_languages(docs: DataFrame, max_rows: int = 1500, ratio: float = 0.34, least: int = 2) -> DataFrame:
    """docs (doc_id, text, lang, any more columns, text left out) with held_out, lang_pred and score."""
    spark = docs.sparkSession
    prepare(spark)
    base = without(docs, "held_out", "lang_pred", "score").withColumn("text", F.col("text").cast("string"))
    known = base.where("lang IS NOT NULL AND text IS NOT NULL").where(~held_out("doc_id"))
    sizes = sorted((r[0], r[1]) for r in known.groupBy("lang").count().collect())  # a row a language
    langs = [x for x, _ in sizes]
    numbers = spark.createDataFrame([(x, i, max(1, min(1_000_000, int(1_000_000 * max_rows / n)))) for i, (x, n) in enumerate(sizes)], "lang string, __number int, __bound int")
    sample = known.select("doc_id", "lang", "text").join(numbers, "lang").where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.col("__bound")).select(F.col("__number").alias("lang"), "text")
    counted = materialize(sample.mapInArrow(_counts(), "lang int, h long, n long").groupBy("lang", "h").agg(F.sum("n").alias("n")))
    totals = counted.groupBy("lang").agg(F.sum("n").alias("total"))
    rated = counted.where(F.col("n") >= least).join(F.broadcast(totals), "lang").withColumn("share", F.col("n") / F.col("total"))  # a row a language
    peak = rated.groupBy("h").agg(F.max("share").alias("peak"), F.collect_list(F.struct("lang", "share")).alias("in"))
    inside = peak.select("h", F.explode(F.filter("in", lambda x: x["share"] >= F.lit(ratio) * F.col("peak"))["lang"]).alias("lang"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("lang") % 64)
    masks = inside.groupBy("h", F.floor(F.col("lang") / 64).cast("int").alias("word")).agg(F.bit_or(bit).alias("mask"))
    filled = masks.mapInArrow(_fill(), "cell int, word int, mask long").groupBy("cell", "word").agg(F.bit_or("mask").alias("mask")).toArrow()  # at most CELLS rows for 64 languages
    cell, word, mask = filled.column("cell").to_numpy().astype(np.int32), filled.column("word").to_numpy().astype(np.int32), filled.column("mask").to_numpy()
    density = np.array([((mask[word == i // 64] >> (i % 64)) & 1).sum() / CELLS for i in range(len(langs))])
    shared = spark.sparkContext.broadcast((langs, cell, word, mask, density**HASHES))
    names = [c for c in base.columns if c != "text"]
    out = base.mapInArrow(_predict(shared, names), T.StructType([*[base.schema[c] for c in names], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))
    return out.withColumn("held_out", held_out("doc_id"))
