"""Quality classifier: naive Bayes support vectors on word n-grams.

Indicators of unigrams and bigrams of words (lower-cased, hashed), of their forms (capitals, letters, signs, last byte) and of a word
said twice running are scaled by the log ratio of their smoothed class counts; a linear
hinge-loss model on them is fitted by dual coordinate descent. Class scores come from a logistic curve on margins of rows that the fit did not see.

The fit takes at most about `max_rows` labelled rows, chosen by a hash of their id in proportion to the labels, in one task; the model is a vector of
`buckets` floats. Scoring covers every whole text. Defined results: null text scores as empty, and an empty text scores as the
intercept; rows without a label, or held out, are never learned from; an id with two labels takes the smaller one; with no labelled rows of both classes every
score is the share of label 1 (1 if there are none).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import U64, Words, blobs, materialize, mix, prepare, slices, table, text_buffer, without

BUCKETS = 1 << 19


def held_out(doc_id):
    """Whether a row is kept from learning: crc32 of its id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def indicators(raw: np.ndarray, offsets: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed n-grams of each text, and the index of its text for each."""
    w = Words(raw, offsets, lower=True)
    h2, valid = w.windows(2)
    at = np.flatnonzero(valid)
    same = at[w.hash[at] == w.hash[at + 1]]
    raw = raw[offsets[0] : offsets[-1]]
    capital, letter = np.zeros(len(raw) + 1, np.int32), np.zeros(len(raw) + 1, np.int32)
    np.cumsum((raw >= 65) & (raw <= 90), out=capital[1:])
    np.cumsum(((raw | 32) >= 97) & ((raw | 32) <= 122) | (raw >= 128), out=letter[1:])
    n_letters, last = letter[w.end] - letter[w.start], w.raw[w.end - 1].astype(np.int64)
    shape = np.minimum(capital[w.end] - capital[w.start], 2) * 4096 + np.minimum(n_letters, 2) * 1024 + np.minimum(w.end - w.start - n_letters, 3) * 256 + np.where((last >= 128) | ((last >= 97) & (last <= 122)), 97, last)
    form = mix(shape.astype(np.uint64) + U64(0xABCDEF))
    cell = lambda doc, h: doc * buckets + (h & U64(buckets - 1)).astype(np.int64)
    key = np.r_[cell(w.doc, w.hash), cell(w.doc[at], mix(h2[at])), cell(w.doc, form), cell(w.doc[at], mix(form[at] * U64(3) + form[at + 1])), cell(w.doc[same], np.full(len(same), 77, np.uint64))]
    key = np.sort(key)
    key = key[np.r_[True, key[1:] != key[:-1]][: len(key)]]
    return key & (buckets - 1), key // buckets


def _featurize(buckets: int):
    schema = pa.schema([("doc_id", pa.int64()), ("label", pa.int32()), ("idx", pa.binary())])

    def run(batches):
        for batch in batches:
            raw, offsets = text_buffer(batch.column("text"))
            for i, j in slices(offsets):
                idx, doc = indicators(raw, offsets[i : j + 1], buckets)
                yield table(schema, [batch.column("doc_id").slice(i, j - i), batch.column("label").slice(i, j - i), blobs(idx.astype(np.int32), doc, j - i)])

    return run


def log_count_ratios(rows: list[np.ndarray], y: np.ndarray, buckets: int, alpha: float = 1.0) -> np.ndarray:
    p, q = np.full(buckets, alpha), np.full(buckets, alpha)
    for idx, label in zip(rows, y, strict=True):
        (p if label > 0 else q)[idx] += 1
    seen = (p + q) > 2 * alpha + 1
    ratio = np.log(p / (p[seen].sum() or 1)) - np.log(q / (q[seen].sum() or 1))
    return np.where(seen, ratio, 0.0)


def dual_coordinate_descent(rows: list[np.ndarray], y: np.ndarray, r: np.ndarray, cost: np.ndarray, epochs: int = 15, seed: int = 7) -> tuple[np.ndarray, float]:
    """Weights and intercept of the L1-loss support vector machine on rows scaled by r and brought to unit length; cost bounds each dual variable."""
    w, b, a = np.zeros(len(r)), 0.0, np.zeros(len(y))
    values = [r[i] / max(np.sqrt((r[i] ** 2).sum()), 1e-9) for i in rows]
    norm = np.array([(v @ v) + 1.0 for v in values])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(y)):
            g = y[i] * (w[rows[i]] @ values[i] + b) - 1
            new = min(max(a[i] - g / norm[i], 0.0), cost[i])
            d = (new - a[i]) * y[i]
            if d:
                w[rows[i]] += d * values[i]
                b += d
                moved = max(moved, abs(d))
                a[i] = new
        if moved < 1e-3:
            break
    return w, b


def margins(rows: list[np.ndarray], r: np.ndarray, w: np.ndarray, b: float) -> np.ndarray:
    return np.array([w[i] @ r[i] / max(np.sqrt((r[i] ** 2).sum()), 1e-9) + b for i in rows])


def calibrate(m: np.ndarray, y: np.ndarray, steps: int = 100) -> tuple[float, float]:
    """Slope and shift of a logistic curve on margins, with smoothed targets."""
    hi, lo = (y > 0).sum(), (y < 0).sum()
    t = np.where(y > 0, (hi + 1) / (hi + 2), 1 / (lo + 2))
    slope, shift = 1.0, 0.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(slope * m + shift, -35, 35)))
        g = np.array([((p - t) * m).sum(), (p - t).sum()])
        v = p * (1 - p) + 1e-9
        hess = np.array([[(v * m * m).sum() + 1e-6, (v * m).sum()], [(v * m).sum(), v.sum() + 1e-6]])
        step = np.linalg.solve(hess, g)
        slope, shift = slope - step[0], shift - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(slope), float(shift)


def fit(rows: list[np.ndarray], labels: np.ndarray, buckets: int) -> tuple[np.ndarray, float, float, float, np.ndarray]:
    """Weight of each bucket, intercept, slope, shift, scale of each bucket."""
    y = np.where(labels > 0, 1.0, -1.0)
    if len(y) == 0 or abs(y.sum()) == len(y):
        share = 1.0 if len(y) == 0 or y[0] > 0 else 0.0
        return np.zeros(buckets), 0.0, 0.0, 35.0 if share else -35.0, np.zeros(buckets)

    def train(pick):
        yy, rr = y[pick], [rows[i] for i in pick]
        r = log_count_ratios(rr, yy, buckets)
        w, b = dual_coordinate_descent(rr, yy, r, np.ones(len(yy)))
        return r, w, b

    fold = np.arange(len(y)) % 3
    out = np.zeros(len(y))
    for k in range(3):
        inside, outside = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
        if abs(y[inside].sum()) == len(inside):
            continue
        r, w, b = train(inside)
        out[outside] = margins([rows[i] for i in outside], r, w, b)
    r, w, b = train(np.arange(len(y)))
    slope, shift = calibrate(out, y)
    return w, b, max(slope, 1e-3), shift, r


def _train(buckets: int):
    schema = pa.schema([("weights", pa.binary()), ("scales", pa.binary()), ("numbers", pa.list_(pa.float64()))])

    def run(batches):
        rows, labels, ids = [], [], []
        for batch in batches:
            rows += [np.frombuffer(x, np.int32) for x in batch.column("idx").to_pylist()]
            labels += batch.column("label").to_pylist()
            ids += batch.column("doc_id").to_pylist()
        order = np.argsort(np.array(ids, np.int64), kind="stable")
        w, b, slope, shift, r = fit([rows[i] for i in order], np.array(labels, np.int64)[order], buckets)
        yield table(schema, [[w.astype(np.float32).tobytes()], [r.astype(np.float32).tobytes()], [[b, slope, shift]]])

    return run


def _score(shared, buckets: int, names: list[str]):
    def run(batches):
        w, r, (b, slope, shift) = shared.value
        product = (w * r).astype(np.float64)
        square = (r * r).astype(np.float64)
        for batch in batches:
            raw, offsets = text_buffer(batch.column("text"))
            got = []
            for i, j in slices(offsets):
                idx, doc = indicators(raw, offsets[i : j + 1], buckets)
                top = np.bincount(doc, product[idx], minlength=j - i)
                size = np.sqrt(np.bincount(doc, square[idx], minlength=j - i))
                got.append(top / np.maximum(size, 1e-9) + b)
            m = np.concatenate(got) if got else np.zeros(0)
            score = 1 / (1 + np.exp(-np.clip(slope * m + shift, -35, 35)))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(score)], names=[*names, "score"])

    return run


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, max_rows: int = 6000, keep_text: bool = False) -> DataFrame:
    """docs (doc_id, text, any more columns; text only if keep_text) with held_out, score between 0 and 1 and predicted."""
    spark = docs.sparkSession
    prepare(spark)
    base = without(docs, "held_out", "score", "predicted").withColumn("text", F.col("text").cast("string"))
    marked = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").cast("int").alias("label")).where(~held_out("doc_id"))
    total = marked.count()
    kept = marked if total <= max_rows else marked.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * max_rows / total))
    learn = base.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(kept), "doc_id")  # at most about max_rows rows
    rows = learn.select("doc_id", "label", "text").mapInArrow(_featurize(BUCKETS), "doc_id long, label int, idx binary")
    model = materialize(rows.repartition(1).mapInArrow(_train(BUCKETS), "weights binary, scales binary, numbers array<double>")).collect()
    if model:
        w, r, numbers = np.frombuffer(model[0][0], np.float32), np.frombuffer(model[0][1], np.float32), model[0][2]
    else:
        w, r, numbers = np.zeros(BUCKETS, np.float32), np.zeros(BUCKETS, np.float32), [0.0, 0.0, 35.0]
    shared = spark.sparkContext.broadcast((w, r, tuple(numbers)))
    names = [c for c in base.columns if keep_text or c != "text"]
    scored = base.mapInArrow(_score(shared, BUCKETS, names), T.StructType([*[base.schema[c] for c in names], T.StructField("score", T.DoubleType())]))
    return scored.withColumn("held_out", held_out("doc_id")).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
