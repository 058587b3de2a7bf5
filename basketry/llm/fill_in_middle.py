"""Fill-in-the-middle transformation: two random cuts between units turn a text into prefix, middle and suffix.

A unit is a run of ASCII letters or any other single code point. To find the n-th unit of a text without scanning it
from the start, texts are cut into chunks where a rolling hash of the last ``WINDOW`` bytes says so, so that passages that
many texts share make the same chunks. A chunk's summary (units, code points, whether a letter stands at either end) is
worked out once and kept in a cache under the chunk's whole content, which is compared on every use. Summaries
combine: two chunks have the units of both, less one where a letter run goes over the cut between them. The running
counts of a document say in which chunk a cut lies, and that chunk alone is scanned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm.common import flat_bytes, text_slices, tidy, without

# Fixed values of the format.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_PERCENT, SPM_PERCENT = 10, 20

WINDOW = 16
# A chunk ends where these bits of the rolling hash are 0: every 256 bytes on average.
CHUNK_BITS = np.uint32(0xFF << 16)
LONGEST = 4096
CACHE_BYTES = 16 << 20

_GEAR = np.random.Generator(np.random.PCG64(20240604)).integers(0, 2**32, 256, dtype=np.uint32)
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


def rolling(data: np.ndarray) -> np.ndarray:
    """Hash of the ``WINDOW`` bytes up to each place, in which a byte's share moves up by one bit a place."""
    hashes, done = _GEAR[data], 1
    while done < WINDOW:
        hashes[done:] += hashes[:-done] << np.uint32(done)
        done *= 2
    return hashes


def chunk_edges(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Places where chunks start or end, those of the texts among them; never inside a code point.

    No chunk is longer than ``LONGEST`` and three bytes.
    """
    goes_on = (data & 0xC0) == 0x80
    cuts = np.flatnonzero((rolling(data) & CHUNK_BITS) == 0) + 1
    cuts = cuts[cuts < len(data)]
    # The hash must not look into the text before.
    text = np.searchsorted(starts, cuts, side="right") - 1
    cuts = cuts[(cuts - starts[text] >= WINDOW) & (cuts < ends[text]) & ~goes_on[cuts]]
    edges = np.unique(np.concatenate((starts, ends, cuts)))
    wide = np.flatnonzero(np.diff(edges) > LONGEST)
    if len(wide):
        more = np.concatenate([np.arange(edges[i] + LONGEST, edges[i + 1], LONGEST) for i in wide])
        for _ in range(3):
            more = more + goes_on[more]
        edges = np.unique(np.concatenate((edges, more)))
    return edges


def unit_starts(data: np.ndarray) -> np.ndarray:
    """Whether a unit starts at each byte; a letter at the very start does."""
    letters = _LETTER[data]
    first = ~letters & ((data & 0xC0) != 0x80)
    first[0] |= letters[0]
    first[1:] |= letters[1:] & ~letters[:-1]
    return first


class Summaries:
    """Summaries of chunks by content."""

    def __init__(self):
        self.places: dict[bytes, int] = {}
        self.size = 0
        self.units = self.chars = np.empty(0, np.int64)
        self.left = self.right = np.empty(0, bool)

    def of(self, chunks: list[bytes]) -> np.ndarray:
        """The place of each chunk's summary; new chunks get one."""
        if self.size > CACHE_BYTES:
            self.__init__()
        fresh = [c for c in dict.fromkeys(chunks) if c not in self.places]
        if fresh:
            data = np.frombuffer(b"".join(fresh), np.uint8)
            sizes = np.array([len(c) for c in fresh])
            starts = np.cumsum(sizes) - sizes
            first = unit_starts(data)
            letters = _LETTER[data]
            first[starts] |= letters[starts]
            self.units = np.append(self.units, np.add.reduceat(first, starts, dtype=np.int64))
            self.chars = np.append(self.chars, np.add.reduceat((data & 0xC0) != 0x80, starts, dtype=np.int64))
            self.left = np.append(self.left, letters[starts])
            self.right = np.append(self.right, letters[starts + sizes - 1])
            self.places.update(zip(fresh, range(len(self.places), len(self.places) + len(fresh))))
            self.size += len(data)
        return np.fromiter(map(self.places.__getitem__, chunks), np.intp, len(chunks))


def _draws(seed: int, key: object) -> list[int]:
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).digest()
    return [int.from_bytes(digest[i:i + 4], "big") for i in (0, 4, 8, 12)]


def _transform(texts: pa.Array, keys: list, seed: int, cache: Summaries) -> Iterator[tuple]:
    """(units, form, prefix_chars, middle_chars, output) of every text of a slice."""
    data, offsets = flat_bytes(texts)
    starts, ends = offsets[:-1], offsets[1:] - 1
    raw = data.tobytes()
    edges = chunk_edges(data, starts, ends)
    inside = np.searchsorted(starts, edges[:-1], side="right") - 1
    real = edges[:-1] < ends[inside]  # the others are the line feeds between texts
    at, to, owner = edges[:-1][real], edges[1:][real], inside[real]
    place = cache.of([raw[a:b] for a, b in zip(at.tolist(), to.tolist())])
    joined = np.zeros(len(at), bool)
    joined[1:] = cache.right[place[:-1]] & cache.left[place[1:]] & (owner[1:] == owner[:-1])
    units = np.concatenate(([0], np.cumsum(cache.units[place] - joined)))
    chars = np.concatenate(([0], np.cumsum(cache.chars[place])))
    bounds = np.searchsorted(owner, np.arange(len(keys) + 1))

    def cut(row: int, unit: int) -> tuple[int, int]:
        """Byte place and code points of the text before a unit."""
        first, last = bounds[row], bounds[row + 1]
        wanted = units[first] + unit
        if wanted == units[last]:
            return int(ends[row]), int(chars[last] - chars[first])
        chunk = int(np.searchsorted(units[first + 1:last + 1], wanted, side="right")) + first
        part = data[at[chunk]:to[chunk]]
        byte = int(np.flatnonzero(unit_starts(part))[wanted - units[chunk] + joined[chunk]])
        before = int(np.count_nonzero((part[:byte] & 0xC0) != 0x80))
        return int(at[chunk]) + byte, int(chars[chunk] - chars[first]) + before

    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    for row, key in enumerate(keys):
        n = int(units[bounds[row + 1]] - units[bounds[row]])
        a, b = int(starts[row]), int(ends[row])
        h = _draws(seed, key)
        if a == b or h[2] % 100 >= 100 - PLAIN_PERCENT or any(raw.find(m, a, b) >= 0 for m in marks):
            yield n, "plain", None, None, raw[a:b]
            continue
        low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
        (i, before), (j, both) = cut(row, low), cut(row, high)
        prefix, middle, suffix = raw[a:i], raw[i:j], raw[j:b]
        p, s, m = marks
        if h[3] % 100 < SPM_PERCENT:
            yield n, "spm", before, both - before, b"".join((s, suffix, p, prefix, m, middle))
        else:
            yield n, "psm", before, both - before, b"".join((p, prefix, s, suffix, m, middle))


def transform(df: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 1) -> DataFrame:
    """``df`` with n, form, prefix_chars, middle_chars and output instead of ``text``; columns of these names are replaced.

    Cuts and form follow from ``seed`` and the key alone, so rows with equal keys and texts come out alike, and null keys
    count as an empty string. A null text is empty. Empty texts and those that hold a mark stay as they are (form plain,
    without prefix_chars and middle_chars), as does a tenth of all others; of the rest a fifth is spm, the others psm. Texts
    of any length go through whole. An empty table stays empty.
    """
    added = {"n": T.LongType(), "form": T.StringType(), "prefix_chars": T.LongType(), "middle_chars": T.LongType(), "output": T.StringType()}
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    kept = without(df, text, *(c for c in added if c.lower() != key.lower())).schema.fields
    schema = T.StructType([*kept, *(T.StructField(name, kind) for name, kind in added.items())])
    # By place, so that no name can clash.
    placed = df.select(*(F.col(f"`{f.name}`").alias(f"c{i}") for i, f in enumerate(kept)),
                       F.col(key).cast("string").alias("key"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = Summaries()
        for batch in batches:
            keys, texts = batch.column(len(kept)), batch.column(len(kept) + 1)
            for start, stop in text_slices(texts, 1 << 20):
                part = slice(start, stop)
                rows = list(_transform(texts[part], keys[part].to_pylist(), seed, cache))
                columns = [pa.array(c, pa.binary()).cast(t) if t == pa.string() and isinstance(c[0], bytes) else pa.array(c, t)
                           for c, t in zip(zip(*rows), kinds)]
                same = batch.slice(start, stop - start).columns[:len(kept)]
                yield pa.RecordBatch.from_arrays([*same, *columns], names=[f.name for f in schema.fields])

    return placed.mapInArrow(tidy(run), schema)


def restored(output: str | Column = "output", form: str | Column = "form") -> Column:
    """The text that ``output`` was made from."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    first, second, middle = (F.get(parts, F.lit(i)) for i in (1, 2, 3))
    return (F.when(form == "psm", F.concat(first, middle, second)).when(form == "spm", F.concat(second, middle, first))
            .otherwise(output))


def digests(df: DataFrame) -> DataFrame:
    """The columns of ``transform``, with SHA-256 digests of the output and of the text restored from it."""
    return df.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                     F.sha2(restored(), 256).alias("restored_sha256"))
