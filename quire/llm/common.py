"""What the training-data operators share: shared-folder tables, batches of bytes, hashes.

Texts are handled as the bytes of an Arrow batch, a few megabytes at a time, so a task's
memory does not depend on the number of documents it reads.  64-bit hashes stand for words and
shingles inside a document pair; a false agreement needs a collision within one pair.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import sys
import tempfile
import time
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

U = np.uint64
BASE = U(0x9E3779B97F4A7C15 | 1)
BASE_INV = U(pow(int(BASE), -1, 1 << 64))
CHUNK = 1 << 19  # bytes of text that numpy works on at once
_powers: dict[str, np.ndarray] = {}

BATCH = 1 << 23  # bytes of an Arrow batch
SWEEP_S = 5  # seconds between sweeps of the driver


@lru_cache(maxsize=1)
def _lean() -> None:
    """Python workers outlive their tasks: batches and arrays that are done with go back to the system at once."""
    if TaskContext.get() is None:
        return
    pa.set_memory_pool(pa.system_memory_pool())
    if sys.platform == "linux":
        with contextlib.suppress(OSError, AttributeError):
            ctypes.CDLL("libc.so.6").mallopt(-3, 1 << 23)  # M_MMAP_THRESHOLD


def _trim() -> None:
    """Gives back what a task's arrays have left in the worker's heap."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        with contextlib.suppress(OSError, AttributeError):
            ctypes.CDLL("libc.so.6").malloc_trim(0)


def mapped(df: DataFrame, run, schema: str | StructType) -> DataFrame:
    """df.mapInArrow, with workers that are small again when a task has ended."""

    def task(batches):
        _lean()
        try:
            yield from run(batches)
        finally:
            _trim()

    return df.mapInArrow(task, schema)


def settle(spark: SparkSession) -> None:
    """Batches that Spark hands to Python are bounded in bytes, as texts may be long."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(str(spark.conf.get(name)).removesuffix("b")) > BATCH:
        spark.conf.set(name, str(BATCH))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or in local mode a temporary one where that is unset (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="quire-shared-")
        spark.sparkContext.setCheckpointDir(found)
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


_scratch: list[list[str]] = []


@contextlib.contextmanager
def scratch():
    """Tables written inside are dropped at the end, but for those that `table` is told to keep."""
    made: list[str] = []
    _scratch.append(made)
    try:
        yield
    finally:
        _scratch.remove(made)
        for path in made:
            with contextlib.suppress(OSError, pa.ArrowException):  # a store that only Spark writes to keeps them until its folder is cleared
                store, at = fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")
                store.delete_dir(at)


def table(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Writes df as a Parquet table in the shared folder and reads it again: cuts lineage, survives lost executors.

    The shuffle files behind it are of no more use, and Spark is told to drop them when it is written, so that scratch
    disks hold one step's shuffles.
    """
    spark = df.sparkSession
    settle(spark)
    path = f"{shared_dir(spark)}/quire-{name}-{uuid.uuid4().hex}"
    if _scratch and not keep:
        _scratch[-1].append(path)
    clean = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(clean)
    spark.conf.set(clean, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(clean, before)
    _swept(spark)
    return spark.read.schema(df.schema).parquet(path)


_last = [0.0]


def _swept(spark: SparkSession) -> None:
    """Every few seconds, lets the driver give back what finished steps have left there: broadcast blocks and generated classes go with its garbage."""
    if time.monotonic() - _last[0] > SWEEP_S:
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        _trim()
        _last[0] = time.monotonic()


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: str) -> DataFrame:
    """Only the columns an operator reads, null texts as empty; rows without an id are left out."""
    settle(docs.sparkSession)
    return docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *more)


ROW = "__quire_row"


def keyed(docs: DataFrame, id_col: str = "doc_id") -> tuple[DataFrame, bool]:
    """The documents with a key of each row in ROW, and whether it is the id.

    Ids serve where each row has one of its own; else rows are numbered and stored, so that rows with one id, or
    without one, stay apart.
    """
    shared = docs.groupBy(id_col).agg(F.count("*").alias("__quire_n")).where((F.col("__quire_n") > 1) | F.col(id_col).isNull())
    if not shared.limit(1).count():
        return docs.withColumn(ROW, F.col(id_col)), True
    return table(docs.withColumn(ROW, F.monotonically_increasing_id()), "rows"), False


def replaced(docs: DataFrame, texts: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all columns, with the texts (doc_id, text) given in place of their own where there is one."""
    new = texts.select(F.col("doc_id").alias("__quire_id"), F.col("text").alias("__quire_text")).dropDuplicates(["__quire_id"])
    joined = docs.join(new, docs[id_col] == new["__quire_id"], "left")
    return joined.select(*(F.coalesce("__quire_text", F.col(k)).alias(k) if k == text_col else F.col(k) for k in docs.columns))


def fold_bucket(column: str, mod: int):
    """crc32 of the id as text, modulo: the split between training and held-out rows."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % mod


def _power(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, U)
    out[0] = 1
    return np.multiply.accumulate(out, out=out)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n; those for a usual chunk are kept."""
    if n > CHUNK + 4096:
        return _power(BASE, n), _power(BASE_INV, n)
    if not _powers:
        _powers.update(p=_power(BASE, CHUNK + 4096), q=_power(BASE_INV, CHUNK + 4096))
    return _powers["p"][:n], _powers["q"][:n]


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit words with good avalanche (splitmix finaliser)."""
    x = x + U((seed * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def strings(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (from 0) of a string or binary column without nulls."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    offsets = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] is not None and len(col) else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]] if len(col) else data[:0], offsets - offsets[0] if len(col) else np.zeros(1, np.int64)


def pieces(offsets: np.ndarray, most: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Row ranges of about `most` bytes; one longer text is a range of its own."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = True, space: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, row, start and end of each word `[^\\x20\\x09-\\x0D]+`; A-Z count as a-z."""
    n = len(data)
    if not n:
        return (np.zeros(0, U), *(np.zeros(0, np.int64) for _ in range(3)))
    low = _LOWER[data] if lower else data
    inside = ~space[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    left = inside.copy()
    left[1:] &= ~inside[:-1] | edge[1:n]
    right = inside.copy()
    right[:-1] &= ~inside[1:] | edge[1:n]
    start, end = np.flatnonzero(left), np.flatnonzero(right) + 1
    p, q = powers(n)
    sums = np.zeros(n + 1, U)
    np.cumsum((low.astype(U) + U(1)) * p, out=sums[1:])
    h = (sums[end] - sums[start]) * q[start]
    h = mix(h ^ (end - start).astype(U) * U(0xD6E8FEB86659FD93))
    return h, np.searchsorted(offsets, start, "right") - 1, start, end


def shingles(data: np.ndarray, offsets: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct `width`-word shingles, sorted by row and hash; shorter texts give their whole sequence as one."""
    h, row, _, _ = words(data, offsets)
    rows = len(offsets) - 1
    first = np.searchsorted(row, np.arange(rows))
    count = np.diff(np.append(first, len(row)))
    place = np.arange(len(row)) - first[row] if len(row) else row
    whole = place + width <= count[row] if len(row) else np.zeros(0, bool)
    s = mix(h, width)
    for j in range(1, width):
        nxt = np.zeros_like(s)
        nxt[: max(len(s) - j, 0)] = h[j:]
        s = mix(s * U(0x9FB21C651E98DF25) + nxt, j)
    out_row, out = [row[whole]], [s[whole]]
    for n in range(1, width):
        short = np.flatnonzero(count == n)
        if len(short):
            s = mix(h[first[short]], 100 + n)
            for j in range(1, n):
                s = mix(s * U(0x9FB21C651E98DF25) + h[first[short] + j], j)
            out_row.append(short)
            out.append(s)
    r, s = np.concatenate(out_row), np.concatenate(out)
    order = np.lexsort((s, r))
    r, s = r[order], s[order]
    keep = np.ones(len(r), bool)
    keep[1:] = (r[1:] != r[:-1]) | (s[1:] != s[:-1])
    return r[keep], s[keep]


def marks(values: DataFrame, column: str) -> np.ndarray:
    """Packed bits at the column's values modulo their number: a filter that passes every value given and, while it is sparse, few others.

    It has eight bits a value, from 32 kB to 32 MB, so it is sparse up to 2**26 values; beyond that it passes more.
    """
    log2 = min(28, max(18, (8 * values.count()).bit_length()))
    at = F.pmod(F.col(column), F.lit(1 << log2)) + 1
    rows = values.groupBy(F.bitmap_bucket_number(at).alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")).collect()
    out = np.zeros((1 << log2) // 8, np.uint8)
    for r in rows:
        out[(r["k"] - 1) * 4096 : r["k"] * 4096] = np.frombuffer(r["bits"], np.uint8)
    return out


def passing(batches, column: str, bits: np.ndarray):
    """The rows whose value may be among those marked: thins what is worked on and shuffled."""
    last = len(bits) * 8 - 1
    for b in batches:
        at = b.column(column).to_numpy(zero_copy_only=False).astype(np.int64) & last
        yield b.filter(pa.array((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 != 0))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of each node with an edge (a, b); component is the smallest node reachable.

    Alternates large-star and small-star steps, so a hub's edges are moved to its smallest neighbour and
    path lengths shrink geometrically; each round is stored and nothing comes to the driver but a count.
    """
    def both(e):
        return e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def large(e):
        e = both(e)
        m = e.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        return e.where("b > a").join(m, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()

    def small(e):
        e = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        m = e.groupBy("a").agg(F.min("b").alias("m"))
        moved = e.join(m, "a")
        return moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(moved.select("a", F.col("m").alias("b"))).where("a <> b").distinct()

    e, seen = table(edges.select("a", "b").where("a <> b").distinct(), "edges"), None
    while True:
        e = table(small(large(e)), "edges")
        state = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1000003)).first())
        if state == seen:
            break
        seen = state
    stars = e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
