"""What the operators share: tables, the shared folder, words and shingle hashes of Arrow batches."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.session import work_dir
from basketry.sources import paths

# Text bytes that go through numpy at a time; temporary arrays take about 40 times as much.
CHUNK_BYTES = 1 << 19
ROWS_PER_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
# Bytes of rows that go to a Python worker at a time; a longer row goes alone.
BYTES_PER_BATCH, MOST_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 2 << 20
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers that don't have it; once per application.

    Documents are long rows, so fewer than the default 10,000 of them go to a Python worker at a time, and no more than
    2 MB of longer ones: an executor and its workers hold each batch several times over, outside the heap.
    """
    if int(spark.conf.get(ROWS_PER_BATCH)) > 2500:
        spark.conf.set(ROWS_PER_BATCH, "2500")
    spark.conf.set(BYTES_PER_BATCH, str(MOST_BYTES))
    context = spark.sparkContext
    if any(name.startswith("basketry-") for name in context._python_includes):
        return
    root = Path(__file__).resolve().parent.parent
    target = Path(tempfile.mkdtemp()) / f"basketry-{uuid.uuid4().hex}.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for source in sorted(root.rglob("*.py")):
            archive.write(source, source.relative_to(root.parent))
    context.addPyFile(str(target))


def _release() -> None:
    """Hand freed memory back to the system: Python workers are used again, and what one task freed would stay with them."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


# What this worker process keeps from task to task: how to drop it, by the job it is kept for.
_kept: dict[str, Callable[[], None]] = {}


def keep(job: str, drop: Callable[[], None]) -> None:
    """``drop`` is called when this worker process goes on with another job's ``tidy`` function."""
    _kept[job] = drop


def _drop_others(job: str | None) -> None:
    others = [other for other in _kept if other != job]
    for other in others:
        _kept.pop(other)()
    if others:
        gc.collect()
        _release()


def released(run, *args):
    """What ``run`` returns, with the memory it freed given back."""
    try:
        return run(*args)
    finally:
        _release()


def tidy(run, job: str | None = None):
    """``run``, a function over batches, that gives back its memory when a task ends.

    What workers keep for others than ``job`` goes first: it would stay beside all that follows, as idle workers are used again.
    """
    def wrapped(batches):
        _drop_others(job)
        try:
            yield from run(batches)
        finally:
            gc.collect()
            _release()

    return wrapped


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the cluster's shared folder and read back: cuts lineage, survives lost executors.

    Shuffle files of the write go when it ends, not when the driver happens to collect its garbage.
    """
    spark, path = df.sparkSession, work_dir(df.sparkSession, name)
    before = spark.conf.get(SHUFFLES_GO, "false")
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLES_GO, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables as ``stored`` returned them; nothing may read them, or what was made of them and isn't stored, again."""
    for df in tables:
        paths.delete(df.sparkSession, df._stored_at)


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """Rows dealt evenly over the shuffle partitions by ``columns``."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *columns)


# A membership filter has so many bits per key, but no more than 8 MB of them, in bitmaps of 4 KB.
FILTER_BITS, MOST_FILTER_BITS, _MAP_BITS = 16, 1 << 26, 1 << 15


def sifted(df: DataFrame, keys: list[str | Column], found: DataFrame, found_keys: list[str | Column]) -> DataFrame:
    """``df`` with a column _maybe, false only in rows whose keys are not those of any row of ``found`` (a stored table).

    A join with ``found`` needs the other rows alone, so texts that meet nothing are not shuffled, whatever the sizes.
    Null keys equal null keys. The filter is broadcast, at most 8 MB: about one row in 16 passes in vain, and more
    only beyond four million rows of ``found``.
    """
    bits = _MAP_BITS
    wanted = min(FILTER_BITS * found.count(), MOST_FILTER_BITS)
    while bits < wanted:
        bits *= 2
    spot = lambda columns: F.pmod(F.xxhash64(*columns), F.lit(bits))
    part, bit = (lambda s: (s / _MAP_BITS).cast("int")), (lambda s: s % _MAP_BITS)
    spots = found.select(part(spot(found_keys)).alias("_part"), bit(spot(found_keys)).alias("_bit"))
    maps = stored(spots.groupBy("_part").agg(F.expr("bitmap_construct_agg(_bit)").alias("_bits")), "filter")
    asked = df.withColumns({"_part": part(spot(keys)), "_bit": bit(spot(keys))}).join(F.broadcast(maps), "_part", "left")
    byte = F.conv(F.hex(F.expr("substring(_bits, int(_bit div 8) + 1, 1)")), 16, 10).cast("int")
    hit = byte.bitwiseAND(F.expr("shiftleft(1, int(_bit % 8))")) > 0
    return asked.withColumn("_maybe", F.coalesce(hit, F.lit(False))).drop("_part", "_bit", "_bits")


def text_slices(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` text bytes; a longer text is a range of its own."""
    ends = np.cumsum(np.fromiter((0 if n is None else n for n in pc.binary_length(texts).to_pylist()), np.int64))
    start, base = 0, 0
    while start < len(texts):
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield start, stop
        start, base = stop, int(ends[stop - 1])


def flat_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, a line feed after each, and the offset of each text; null counts as empty."""
    parts = [b"" if t is None else t for t in texts.cast(pa.binary()).to_pylist()]
    offsets = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) + 1 for p in parts], out=offsets[1:])
    return np.frombuffer(b"\n".join(parts) + b"\n", np.uint8), offsets


# Random 64-bit weights for byte values and odd factors; any constants do, but they must stay the same in all tasks.
_BYTE = np.random.Generator(np.random.PCG64(20240601)).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_PLACES = np.random.Generator(np.random.PCG64(20240602)).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_INVERSE = np.uint64(pow(int(_STEP), -1, 2**64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.ones(max(n, 1), np.uint64)
    done = 1
    factor = base
    while done < n:
        take = min(done, n - done)
        out[done:done + take] = out[:take] * factor
        factor = factor * factor
        done += take
    return out[:n]


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of every run of bytes other than white space (0x20, 0x09 to 0x0D), A-Z lower-cased."""
    space = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    edge = np.diff(np.concatenate(([True], space)).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if len(starts) > len(ends):
        ends = np.append(ends, len(data))
    low = np.where((data >= 0x41) & (data <= 0x5A), data | 0x20, data)
    return run_hashes(low, starts, ends), starts


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of every given range of bytes."""
    with np.errstate(over="ignore"):
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * _powers(_STEP, len(data)))))
        spans = (total[ends] - total[starts]) * _powers(_INVERSE, len(data) + 1)[starts]
        return mix(spans + (ends - starts).astype(np.uint64) * _PLACES[0])


def shingle_sets(texts: pa.Array, size: int = 5) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct 64-bit shingle hashes) of each text; a text of fewer words is one shingle, of none has none.

    Different shingles share a hash with a probability of about 1 in 10**19 per compared pair.
    """
    for start, stop in text_slices(texts):
        data, offsets = flat_bytes(texts.slice(start, stop - start))
        words, at = word_hashes(data)
        bounds = np.searchsorted(at, offsets)
        with np.errstate(over="ignore"):
            rolled = np.zeros(max(len(words) - size + 1, 0), np.uint64)
            for i in range(size):
                rolled += words[i:len(words) - size + 1 + i] * _PLACES[i + 1]
            rolled = mix(rolled)
            for row in range(stop - start):
                a, b = int(bounds[row]), int(bounds[row + 1])
                if b - a >= size:
                    yield start + row, np.unique(rolled[a:b - size + 1])
                elif b > a:
                    short = np.sum(words[a:b] * _PLACES[1:b - a + 1], dtype=np.uint64) + np.uint64(b - a) * _PLACES[40]
                    yield start + row, mix(np.array([short]))
                else:
                    yield start + row, np.empty(0, np.uint64)


def signature(hashes: np.ndarray) -> int:
    """63-bit digest of a sorted set of hashes."""
    with np.errstate(over="ignore"):
        return int(mix(np.array([np.sum(mix(hashes ^ _STEP), dtype=np.uint64) + np.uint64(len(hashes)) * _STEP]))[0] >> np.uint64(1))


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns that an operator is about to add; names match as Spark resolves them, in any case."""
    taken = {n.lower() for n in names}
    return df.select(*(F.col(f"`{c}`") for c in df.columns if c.lower() not in taken))
