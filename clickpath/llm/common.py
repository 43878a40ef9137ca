"""Shared helpers of the corpus operators.

Text reaches Python in Arrow batches and is handled as one byte array with
document offsets, so word splitting and hashing are vectorised over a whole
batch. Every helper works on whole texts; a batch is cut between documents
only, so memory per task is bounded by ``max_bytes`` or the longest document.
"""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import time
import uuid
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from clickpath.session import checkpoint_dir

U64 = np.uint64


# ---------------------------------------------------------------- session

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package (once per application), so that its
    functions can be imported there even when it is not installed."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="clickpath-ship-"), "clickpath-package.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    sc.addPyFile(archive)  # served by the driver to every executor
    _shipped.add(sc.applicationId)


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder name inside the shared ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(spark: SparkSession, df: DataFrame, spread: bool = False) -> DataFrame:
    """``df`` checkpointed in the shared folder: lineage is cut and a lost executor
    costs only its own tasks. Spark removes the files once no plan uses them
    (``spark.cleaner.referenceTracking.cleanCheckpoints``). With ``spread`` the rows are
    dealt evenly first: a later join then shuffles both its sides, so a hot key
    can be split at run time."""
    checkpoint_dir(spark)
    return (df.repartition(tasks_for(spark)) if spread else df).checkpoint(eager=True)


def write_table(spark: SparkSession, df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` as a Parquet table in the shared folder, reread, and its path."""
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def remove_table(spark: SparkSession, path: str) -> None:
    """Delete a table of :func:`write_table` that nothing reads any more."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def release_files(spark: SparkSession) -> None:
    """Have Spark remove the shuffle files, checkpoints and broadcasts that no plan uses any
    more. Spark does so when the driver's JVM collects their handles; left alone, a driver with
    memory to spare keeps its garbage, and the disks of the executors keep every finished step."""
    gc.collect()  # handles that Python still holds in cycles
    given_up = getattr(spark.sparkContext._gateway._gateway_client, "finalizer_deque", None)
    for _ in range(40):  # py4j passes them on in a thread of its own, which sleeps up to a second
        if not given_up:
            break
        time.sleep(0.05)
    spark.sparkContext._jvm.System.gc()


def tasks_for(spark: SparkSession) -> int:
    """Number of shuffle partitions the session asks for."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def keep_rows(docs: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, so extra columns of the input never clash."""
    return docs.select(*[docs[c] for c in columns])


def packed(docs: DataFrame, *columns: str) -> DataFrame:
    """All columns of ``docs`` as one struct ``row`` (so their names never clash with
    an operator's own), beside copies of the named ones."""
    return docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), *[docs[c] for c in columns])


def extended(df: DataFrame, columns, *fields: StructField) -> StructType:
    """Schema of the named columns of ``df`` and further fields."""
    return StructType([StructField(c, df.schema[c].dataType) for c in columns] + list(fields))


def held_out(doc_id="doc_id"):
    """Rows whose crc32 of the id as text leaves remainder 1 modulo 3."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


# ---------------------------------------------------------------- worker memory
# Python workers are kept for later tasks. What a task has freed stays with their
# allocators, so every worker would hold its largest task's memory through all stages.

def release_memory() -> None:
    """Give free memory of this process back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def released(run: Callable) -> Callable:
    """``run`` of a ``mapInArrow``, after which its task's memory is given back."""

    def wrapped(batches):
        yield from run(batches)
        release_memory()

    return wrapped


def released_group(run: Callable) -> Callable:
    """The same for one table of an ``applyInArrow``."""

    def wrapped(table: pa.Table) -> pa.Table:
        out = run(table)
        release_memory()
        return out

    return wrapped


def released_cogroup(run: Callable) -> Callable:
    """The same for two tables of an ``applyInArrow``."""

    def wrapped(left: pa.Table, right: pa.Table) -> pa.Table:
        out = run(left, right)
        release_memory()
        return out

    return wrapped


# ---------------------------------------------------------------- arrow text

def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """Arrow string or binary array → (bytes, offsets); null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):  # zero or several chunks left
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if not pa.types.is_large_string(column.type) and not pa.types.is_large_binary(column.type):
        column = column.cast(pa.large_binary() if pa.types.is_binary(column.type) else pa.large_string())
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_large_binary(column.type) else "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def byte_chunks(offsets: np.ndarray, max_bytes: int) -> Iterator[tuple[int, int]]:
    """Document ranges of at most ``max_bytes`` (or one longer document)."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + max_bytes, "right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi
        lo = hi


def byte_table(separators: bytes) -> np.ndarray:
    """256 flags: True for bytes that belong to words."""
    flags = np.ones(256, bool)
    flags[np.frombuffer(separators, np.uint8)] = False
    return flags


#: word bytes when words are cut at white space: all but 0x20 and 0x09-0x0D
SPACE_WORDS = byte_table(b" \t\n\x0b\x0c\r")


def words(data: np.ndarray, offsets: np.ndarray, flags: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end) byte positions of all words, and per document the index of its
    first word (length documents + 1). Words never cross documents."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    w = flags[data]
    bounds = offsets[:-1][offsets[:-1] < n]
    first = w.copy()
    first[1:] &= ~w[:-1]
    first[bounds] = w[bounds]
    last = w.copy()
    last[:-1] &= ~w[1:]
    ends = bounds[bounds > 0] - 1
    last[ends] = w[ends]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


# ---------------------------------------------------------------- hashing
# Polynomial prefix hashes modulo 2**64 with odd bases: the hash of any segment
# comes from two prefix values. Values are finished with a mixing step.

_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_HASH_BLOCK = 1 << 15
_powers: dict[int, np.ndarray] = {}


def powers(n: int, base: int) -> np.ndarray:
    """base**0..n modulo 2**64 (kept per worker, grown as needed)."""
    have = _powers.get(base)
    if have is None or len(have) < n + 1:
        p = np.full(max(n + 1, _HASH_BLOCK + 1), base, U64)
        p[0] = 1
        _powers[base] = have = np.multiply.accumulate(p)
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser on 64-bit values."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_BYTE_VALUES = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))


class PrefixHash:
    """Hashes of segments of one sequence of 64-bit values (or of bytes)."""

    def __init__(self, values: np.ndarray, seed: int = 0):
        n, self.base = len(values), _BASES[seed]
        forward = powers(_HASH_BLOCK, self.base)
        back = powers(_HASH_BLOCK, pow(self.base, -1, 1 << 64))
        self.prefix = np.zeros(n + 1, U64)
        for a in range(0, n, _HASH_BLOCK):
            own = values[a : a + _HASH_BLOCK]
            m = len(own)
            own = _BYTE_VALUES[own] if own.dtype == np.uint8 else own
            own = np.cumsum(own * back[:m]) * forward[:m]
            self.prefix[a + 1 : a + m + 1] = own + self.prefix[a] * forward[1 : m + 1]

    def segments(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Unmixed hash of every [start, end); equal segments have equal hashes."""
        size = end - start
        return self.prefix[end] - self.prefix[start] * powers(int(size.max()) if len(size) else 0, self.base)[size]


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    h = PrefixHash(data, seed).segments(start, end)
    return mix(h ^ ((end - start).astype(U64) * U64(0xD6E8FEB86659FD93)))


def window_starts(first_word: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Word index of every window of ``n`` words inside one document, and the
    document of each window."""
    counts = np.maximum(np.diff(first_word) - n + 1, 0)
    doc = np.repeat(np.arange(len(counts)), counts)
    skip = np.cumsum(counts) - counts
    return np.arange(int(counts.sum())) - skip[doc] + first_word[:-1][doc], doc


def covered(starts: np.ndarray, length, total: int) -> np.ndarray:
    """Flags of the positions covered by [s, s + length) for any of the distinct starts."""
    delta = np.zeros(total + 1, np.int8)
    delta[starts] += 1
    delta[starts + length] -= 1
    return np.cumsum(delta[:total], dtype=np.int32) > 0


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of True as (start, end)."""
    edge = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
