"""Shared pieces: durable intermediate tables, Arrow text access, vectorised word hashing, connected components.

Words are maximal runs of bytes other than 0x20 and 0x09-0x0D of the UTF-8 text, so a word never spans white space and
multi-byte characters are never cut.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import ship

SLICE_BYTES = 2 << 20
U64 = np.uint64
PART_BYTES = 32 << 20
_NO_WORD = U64(0xA5A5A5A5DEADBEEF)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share; a folder of the session's warehouse only where no checkpoint folder is set (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    return found or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_intermediate"


def materialize(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Write df to the shared folder and read it back: later stages survive a lost executor and lineage ends here. compression: another than the session's."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    trim_driver(spark)
    out = spark.read.schema(df.schema).parquet(path)
    out._table_path = path
    return out


def trim_driver(spark: SparkSession) -> str:
    """What the driver's JVM says on handing freed native memory back; empty where it has no such command.

    Compiling the code of many plans on hundreds of threads leaves hundreds of MB in the allocator's arenas, which only this returns.
    """
    jvm, new_array = spark._jvm, spark.sparkContext._gateway.new_array
    named = jvm.java.lang.Class.forName
    types, given = new_array(jvm.java.lang.Class, 4), new_array(jvm.java.lang.Object, 4)
    for k, name in enumerate(("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")):
        types[k] = named(name)
    given[0], given[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
    try:  # by the interface, as the server's own class is not open to reflection
        return named("javax.management.MBeanServer").getMethod("invoke", types).invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), given)
    except Py4JJavaError:  # another JVM, or one older than this command
        return ""


def discard(df: DataFrame) -> None:
    """Delete the table behind a materialize() result that nothing reads any more."""
    path = getattr(df, "_table_path", None)
    if path:
        spark = df.sparkSession
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def prepare(spark: SparkSession) -> None:
    """Workers get this package; the Arrow batches that reach them are bounded by bytes, as texts may be long."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def lean(run):
    """A mapInArrow function that hands unused memory back when its task ends: workers stay, beside others and the JVM."""

    def wrapped(batches):
        import ctypes

        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)

    return wrapped


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def parts_for(df: DataFrame) -> int:
    """Number of parts for stages that hold a part in memory: it grows with the bytes that the plan of df expects to read."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return max(partitions(df.sparkSession), -(-size // PART_BYTES) if size < 1 << 60 else 1)  # no expectation where a source states none


def without(df: DataFrame, *names: str) -> DataFrame:
    """df without its columns of these names in any case: an operator's own output columns replace clashing ones."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(33)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(33)
    return x


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts together and the len + 1 offsets of each; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about limit bytes; a longer text stands alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


class Words:
    """Words of a run of texts: doc (index of the text), start and end bytes; first[i]..first[i+1] are those of text i.

    word numbers the distinct words of the run: equal numbers are equal words. hash and check are the halves of a 128-bit BLAKE2b digest of each word, the
    same in all runs; nobody knows two words of one digest.
    """

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, lower: bool = False):
        raw, offsets = raw[offsets[0] : offsets[-1]], offsets - offsets[0]
        n = len(raw)
        if lower:
            raw = raw + (((raw >= 65) & (raw <= 90)).astype(np.uint8) << 5)
        self.raw = raw
        inside = (raw != 32) & ((raw < 9) | (raw > 13))
        begins = np.zeros(n + 1, bool)
        begins[offsets] = True
        before = np.empty(n, bool)
        after = np.empty(n, bool)
        if n:
            before[0], after[-1] = False, False
            before[1:], after[:-1] = inside[:-1], inside[1:]
        self.start = np.flatnonzero(inside & (~before | begins[:-1]))
        self.end = np.flatnonzero(inside & (~after | begins[1:])) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.doc = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))
        cuts = np.concatenate([[0], np.cumsum(self.end - self.start)])
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(self.start), [None, pa.py_buffer(cuts), pa.py_buffer(raw[inside])]).dictionary_encode()
        self.word = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.n_distinct = len(words.dictionary)
        made = np.frombuffer(b"".join([blake2b(x, digest_size=16).digest() for x in words.dictionary.to_pylist()]), np.uint64).reshape(-1, 2)
        self.hash, self.check = (np.ascontiguousarray(made[:, k])[self.word] if len(made) else np.zeros(0, np.uint64) for k in (0, 1))

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the k words from each position on, and whether they all are of one text."""
        n = len(self.hash) - k + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, bool)
        with np.errstate(over="ignore"):
            out = self.hash[:n].copy()
            for j in range(1, k):
                out *= U64(0xD6E8FEB86659FD93)
                out += self.hash[j : j + n]
            return mix(out), self.doc[:n] == self.doc[k - 1 :]

    def digests(self, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Halves of the 128-bit digest of the k words from each of the given positions on: equal for equal words only."""
        whole = memoryview(np.stack([self.hash, self.check], axis=1).tobytes())
        got = np.frombuffer(b"".join([blake2b(whole[p : p + 16 * k], digest_size=16).digest() for p in (at * 16).tolist()]), np.uint64).reshape(-1, 2)
        return got[:, 0].copy(), got[:, 1].copy()

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions where a shingle begins, k words of one text or all words of a shorter one, and the end of its text."""
        stop = self.first[1:][self.doc]
        at = np.arange(len(self.doc))
        begins = np.flatnonzero((at + k <= stop) | (at == self.first[:-1][self.doc]))
        return begins, stop[begins]

    def chained(self, begins: np.ndarray, stop: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Two independent 64-bit hashes of each shingle."""
        h, g = np.full(len(begins), k, np.uint64), np.full(len(begins), k + 1, np.uint64)
        with np.errstate(over="ignore"):
            for j in range(k):
                at = begins + j
                there, at = at < stop, np.minimum(at, len(self.hash) - 1)
                h = mix(h * U64(0xD6E8FEB86659FD93) ^ np.where(there, self.hash[at], _NO_WORD))
                g = mix(g * U64(0xA0761D6478BD642F) + np.where(there, self.check[at], _NO_WORD))
        return h, g

    def numbered(self, begins: np.ndarray, stop: np.ndarray, k: int) -> np.ndarray:
        """A number for each shingle, equal for equal words only; words are compared, not hashes."""
        code = np.zeros(len(begins), np.int64)
        for j in range(k):
            at = begins + j
            word = np.where(at < stop, self.word[np.minimum(at, len(self.word) - 1)], self.n_distinct)
            code = np.unique(code * (self.n_distinct + 1) + word, return_inverse=True)[1]
        return code


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All of starts[i] .. starts[i] + lengths[i] - 1, one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) - np.repeat(ends - lengths - starts, lengths)


def table(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t.type) for c, t in zip(columns, schema, strict=True)], schema=schema)


def blobs(values: np.ndarray, groups: np.ndarray, n_groups: int) -> list[bytes]:
    """values cut into one blob of bytes per group, order kept; groups must be sorted."""
    at = np.searchsorted(groups, np.arange(n_groups + 1))
    return [values[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component): component is the smallest id that links reach. edges: columns a, b; null ends are ignored.

    Alternating large-star and small-star rounds; each round is one aggregation and one join, written to the shared folder,
    so a node with very many links only costs a split join. Rounds grow with the logarithm of the longest path.
    """
    now = materialize(edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first()
        state = (state[0], state[1])
        if state == before or not state[0]:
            break
        before = state
        both = now.union(now.select(F.col("v"), F.col("u")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*").where("u <> v").distinct()
        following = materialize(small)
        discard(now)
        now = following
    member = now.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("id"), "component")
    return member.union(now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
