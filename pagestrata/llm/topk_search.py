"""Exact top-k search by inner product with MaxScore.

Vectors are quantised to integers. A term of a query is one dimension; its score bound within a chunk of a shard is the larger of q x max and
q x min over the chunk, so it is never below any contribution. Vectors are dealt over shards and queries over blocks by hashes of their ids; each pair of
a shard and a block is a cell, one task's run of rows: first its queries, then its vectors, chunk by chunk, held dimension by dimension. Terms are split by
their bounds: the essential ones are traversed for every vector, the non-essential
ones, whose bounds together are small against the range of scores, are probed, largest bound first, for
vectors that stay competitive: partial score plus the bounds not yet probed is at least the query's threshold. The
threshold is the k-th best score of the cell's chunks so far, at first that of a part of the chunk, and only grows. Cells' best k are merged, by
descending score and ascending id. Neither queries nor vectors pass through the driver.

Defined results: vectors that are null, or hold null or non-finite components, take no part; the inner product is defined between vectors of one length
only, so a query's candidates are those of its own length; a vector is never its own candidate (rows of one id are one vector for this); equal rows
are one query, and rows of one id with different vectors are a query each, ranked apart; repeated candidates count each; fewer candidates than k: all; null
vec_id: no part; an empty table gives no rows. Sums are exact below 2^53.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import lean, materialize, partitions, prepare, table

_HIT = "query_id long, form long, vec_id long, score long"
_HIT_ARROW = pa.schema([("query_id", pa.int64()), ("form", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
_CELL = ("n", "shard", "block")
SEED_ROWS = 512
CHUNK_ROWS = 65_536


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to smaller ids."""
    if len(scores) > k:
        floor = np.partition(scores, len(scores) - k)[len(scores) - k]
        pick = np.flatnonzero(scores >= floor)
    else:
        pick = np.arange(len(scores))
    return pick[np.lexsort((ids[pick], -scores[pick]))][:k]


def maxscore(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int, known: np.ndarray, fraction: float = 0.12):
    """For each query (place of query, places of vectors, scores) of its k best in this chunk, those below its known threshold left out."""
    if not len(vectors):
        return
    low, high = vectors.min(axis=0), vectors.max(axis=0)
    bound = np.maximum(queries * high, queries * low)
    order = np.argsort(bound, axis=1)
    rising = np.cumsum(np.take_along_axis(bound, order, axis=1), axis=1)
    seed = vectors[:SEED_ROWS] @ queries.T
    seed[ids[:SEED_ROWS, None] == query_ids[None, :]] = -np.inf
    kk = min(k, seed.shape[0])
    threshold = np.partition(seed, seed.shape[0] - kk, axis=0)[seed.shape[0] - kk] if seed.shape[0] > k else np.full(len(queries), -np.inf)
    threshold = np.maximum(threshold, known)
    # the smallest bounds, together at most a fraction of the way from threshold to the greatest possible score
    room = np.where(np.isfinite(threshold), fraction * np.maximum(rising[:, -1] - threshold, 0), -1)
    skipped = (rising <= room[:, None]).sum(axis=1)
    essential = queries.copy()
    for q in range(len(queries)):
        essential[q, order[q, : skipped[q]]] = 0
    partial = essential @ vectors.T
    for q in range(len(queries)):
        left = skipped[q]
        slack = rising[q, left - 1] if left else 0.0
        alive = np.flatnonzero(partial[q] + slack >= threshold[q])
        alive = alive[ids[alive] != query_ids[q]]
        score = partial[q, alive]
        if len(alive) > 4 * k and left:  # raise the threshold by probing the best so far completely
            top = alive[np.argpartition(-score, k)[: 2 * k]]
            whole = vectors[top] @ queries[q]
            threshold[q] = max(threshold[q], np.partition(whole, len(whole) - k)[len(whole) - k])
        for t in range(left - 1, -1, -1):
            keep = score + rising[q, t] >= threshold[q]
            alive, score = alive[keep], score[keep]
            d = order[q, t]
            score = score + vectors[alive, d] * queries[q, d]
        pick = _best(score, ids[alive], k)
        yield q, alive[pick], score[pick]


class _Cell:
    """Queries of a cell and their best hits in its chunks so far."""

    def __init__(self, ids: np.ndarray, forms: np.ndarray, queries: np.ndarray, k: int):
        self.ids, self.forms, self.queries, self.k = ids, forms, queries, k
        self.hits = [(np.zeros(0), np.zeros(0, np.int64)) for _ in ids]
        self.known = np.full(len(ids), -np.inf)

    def search(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        step = max(1, 16_000_000 // max(len(ids), 1))
        for at in range(0, len(self.ids), step):
            part = slice(at, at + step)
            for q, places, scores in maxscore(self.queries[part], self.ids[part], vectors, ids, self.k, self.known[part]):
                score, hit = (np.concatenate(x) for x in zip(self.hits[at + q], (scores, ids[places]), strict=True))
                best = _best(score, hit, self.k)
                self.hits[at + q] = (score[best], hit[best])
                if len(best) == self.k:
                    self.known[at + q] = score[best[-1]]

    def rows(self) -> pa.RecordBatch:
        n = [len(s) for s, _ in self.hits]
        return table(_HIT_ARROW, [np.repeat(self.ids, n), np.repeat(self.forms, n), np.concatenate([h for _, h in self.hits]), np.concatenate([s for s, _ in self.hits]).astype(np.int64)])


def _search(k: int):
    """mapInArrow over rows sorted by cell, queries before vectors."""

    def run(batches):
        name, cell, ids, queries, forms, waiting = None, None, [], [], [], 0

        def flush():
            nonlocal cell, ids, queries, forms, waiting
            if ids:
                got = np.concatenate(ids), np.concatenate(queries)
                if cell is None:
                    cell = _Cell(got[0], np.concatenate(forms), got[1], k)
                else:
                    cell.search(*got)
            ids, queries, forms, waiting = [], [], [], 0

        for batch in batches:
            if not len(batch):
                continue
            keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in (*_CELL, "side")], axis=1)
            cuts = np.r_[0, np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, len(batch)]
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                *new, side = keys[a].tolist()
                if new != name:
                    flush()
                    if cell is not None and len(cell.ids):
                        yield cell.rows()
                    name, cell = new, None
                    if side:  # no query in this cell
                        cell = _Cell(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, max(new[0], 1))), k)
                elif side and cell is None:
                    flush()
                part = batch.slice(a, b - a)
                ids.append(part.column("vec_id").to_numpy())
                forms.append(part.column("form").to_numpy())
                queries.append(part.column("v").flatten().to_numpy().astype(np.float64).reshape(b - a, new[0]) if new[0] else np.zeros((b - a, 1)))
                waiting += b - a
                if side and waiting >= CHUNK_ROWS:
                    flush()
        flush()
        if cell is not None and len(cell.ids):
            yield cell.rows()

    return lean(run)


def exact_top_k(vectors: DataFrame, k: int = 20, every: int = 20, scale: int = 64, block: int = 8192, shard_rows: int = 1 << 20) -> DataFrame:
    """query_id, rank, vec_id, score of the k best candidates for each row whose vec_id is divisible by `every`.

    vectors: vec_id, embedding. block: queries of a cell; shard_rows: vectors of a cell; both follow from the counts of each length alone.
    """
    spark = vectors.sparkSession
    prepare(spark)
    whole = F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    fine = F.col("embedding").isNotNull() & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    clean = vectors.where(F.col("vec_id").isNotNull()).where(F.coalesce(fine, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v"))
    kept = materialize(clean.withColumn("form", F.xxhash64("v")).withColumn("n", F.size("v")))
    queries = kept.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id", "form", "v"])
    # small tables are spread over tasks, large ones cut by the bounds of a cell
    least = lambda n: F.least(F.lit(partitions(spark)), F.ceil(n / 4096))
    sizes = kept.groupBy("n").agg(F.greatest(least(F.count(F.lit(1))), F.ceil(F.count(F.lit(1)) / shard_rows)).cast("int").alias("shards"), F.greatest(F.lit(1), F.ceil(F.count_if(F.col("vec_id") % every == 0) / block)).cast("int").alias("blocks"))
    sized = F.broadcast(sizes)  # a row for each length of vectors
    each = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    own = lambda seed, count: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.col(count)).cast("int")
    asked = queries.join(sized, "n").select("n", each("shards").alias("shard"), own(2, "blocks").alias("block"), F.lit(0).alias("side"), "vec_id", "form", "v")
    told = kept.join(sized, "n").select("n", own(1, "shards").alias("shard"), each("blocks").alias("block"), F.lit(1).alias("side"), "vec_id", "form", "v")
    cells = asked.union(told).repartition(partitions(spark), *_CELL).sortWithinPartitions(*_CELL, "side")
    hits = cells.mapInArrow(_search(k), _HIT)
    rank = F.row_number().over(Window.partitionBy("query_id", "form").orderBy(F.desc("score"), "vec_id"))
    return hits.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
