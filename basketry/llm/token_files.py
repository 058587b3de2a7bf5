"""Token ids as binary files: Simple-8b words in blocks, with tables that lead to every block and document.

Documents are dealt to tasks by ranges of doc_id, so the files, taken by task and number, hold one long row of ids in
ascending doc_id order. A file is::

    magic, blocks, block table, document table, footer

A block holds ``BLOCK`` ids (the last one of a file fewer) as little-endian 64-bit words, then its escapes. The block table has
offset, words, escapes and ids of every block, the document table doc_id, whether there is one, and the number of ids;
the footer says how many rows both have and where they start. Any block can be unpacked alone and at once.

A task that is run again writes other files, and only the list of the run that counted is stored, so files of lost
attempts are never read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm import simple8b, word_bpe
from basketry.llm.common import stored, tidy
from basketry.session import work_dir

MAGIC = b"SIMPLE8B"
BLOCK = 1 << 16
FILE_BYTES, FILE_DOCUMENTS = 64 << 20, 1 << 20
END_ID = 1

LIST = "part int, number int, file string, n_docs long, n_ids long"


class Writer:
    """One file; ids and documents are added in order."""

    def __init__(self, folder: str, block: int = BLOCK):
        system, at = FileSystem.from_uri(folder)
        system.create_dir(at, recursive=True)
        name = f"{uuid.uuid4().hex}.ids"
        self.file, self.out = f"{folder}/{name}", system.open_output_stream(f"{at}/{name}", compression=None)
        self.out.write(MAGIC)
        self.size, self.blocks, self.documents = len(MAGIC), [], []
        self.block, self.waiting, self.n_waiting, self.n_ids = block, [], 0, 0

    def add(self, ids: np.ndarray) -> None:
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        if self.n_waiting >= self.block:
            both = np.concatenate(self.waiting)
            whole = len(both) - len(both) % self.block
            for start in range(0, whole, self.block):
                self._write(both[start:start + self.block])
            self.waiting, self.n_waiting = [both[whole:]], len(both) - whole

    def _write(self, ids: np.ndarray) -> None:
        words, escapes = simple8b.pack(ids)
        self.blocks.append((self.size, len(words), len(escapes), len(ids)))
        for part in (words, escapes):
            self.out.write(part.astype("<u8").tobytes())
        self.size += 8 * len(words) + 16 * len(escapes)
        self.n_ids += len(ids)

    def close(self) -> tuple[str, int, int]:
        """(file, documents, ids)"""
        if self.n_waiting:
            self._write(np.concatenate(self.waiting))
        self.out.write(np.array(self.blocks, "<i8").tobytes())
        self.out.write(np.array(self.documents, "<i8").tobytes())
        self.out.write(np.array([self.size, len(self.blocks), len(self.documents), self.n_ids], "<i8").tobytes() + MAGIC)
        self.out.close()
        return self.file, len(self.documents), self.n_ids


class Reader:
    def __init__(self, file: str):
        system, at = FileSystem.from_uri(file)
        self.handle = system.open_input_file(at)
        size = self.handle.size()
        footer = self.handle.read_at(40, size - 40) if size >= 48 else b""
        if footer[32:] != MAGIC or self.handle.read_at(8, 0) != MAGIC:
            raise ValueError(f"{file} is no complete file of token ids")
        start, n_blocks, n_docs, self.n_ids = np.frombuffer(footer[:32], "<i8").tolist()
        tables = np.frombuffer(self.handle.read_at(32 * n_blocks + 24 * n_docs, start), "<i8")
        self.blocks, self.documents = tables[:4 * n_blocks].reshape(-1, 4), tables[4 * n_blocks:].reshape(-1, 3)

    def block(self, i: int) -> np.ndarray:
        offset, n_words, n_escapes, n_ids = self.blocks[i].tolist()
        data = np.frombuffer(self.handle.read_at(8 * n_words + 16 * n_escapes, offset), "<u8")
        return simple8b.unpack(data[:n_words], n_ids, data[n_words:].reshape(-1, 2))

    def parts(self) -> Iterator[tuple[int, np.ndarray, bool]]:
        """(document number, ids, whether they end it): a document's ids come block by block."""
        row, left = 0, int(self.documents[0, 2]) if len(self.documents) else 0
        for i in range(len(self.blocks)):
            ids = self.block(i)
            at = 0
            while at < len(ids):
                take = min(left, len(ids) - at)
                left -= take
                yield row, ids[at:at + take], left == 0
                at += take
                if left == 0:
                    row += 1
                    left = int(self.documents[row, 2]) if row < len(self.documents) else 0


def write(documents: DataFrame, folder: str | None = None, key: str = "doc_id", text: str = "text",
          end_id: int = END_ID, tokenizer: str | None = None, block: int = BLOCK, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the ids of every whole text, ``end_id`` after each, and return the stored list of files.

    ``folder`` is a URI or path that all executors can write, ``tokenizer`` a file that all can read. A file ends with the
    first megabyte of texts that takes it over ``file_bytes``. A null or empty
    text has the end id alone. Null doc_ids come first; repeated ones are all kept, ordered by a hash of their text,
    then by their place in the input, so that a hot one is split over tasks. An empty table writes no file.
    """
    spark = documents.sparkSession
    folder, path = folder or work_dir(spark, "token-files"), tokenizer or word_bpe.default_path()
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = documents.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).withColumns({
        "_hash": F.xxhash64("text"), "_row": F.monotonically_increasing_id()})
    order = ["doc_id", "_hash", "_row"]
    dealt = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, done, out, encoder = TaskContext.get().partitionId(), [], None, None
        for batch in batches:
            encoder = encoder or word_bpe.Encoder(path)
            ids = batch.column(0).fill_null(0).to_numpy()
            known = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            for start, stop, flat, sizes in encoder.encode(batch.column(1)):
                if out is not None and (out.size > file_bytes or len(out.documents) > FILE_DOCUMENTS):
                    done.append(out.close())
                    out = None
                out = out or Writer(folder, block)
                ends = np.cumsum(sizes)
                out.add(np.insert(flat, ends, end_id))
                out.documents += zip(ids[start:stop].tolist(), known[start:stop].tolist(), (sizes + 1).tolist())
        if out is not None:
            done.append(out.close())
        columns = [[part] * len(done), range(len(done)), *(zip(*done) if done else ([], [], []))]
        kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=[f.split()[0] for f in LIST.split(", ")])

    return stored(dealt.mapInArrow(tidy(run), LIST), "token-file-list")


def _placed(files: DataFrame) -> DataFrame:
    """``files`` with the number of ids in all files before; one row a file goes through one task here."""
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.withColumn("before", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    return placed.select("file", "before").repartition(int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _read(files: DataFrame, schema: str, kind: pa.DataType, start, add, finish) -> DataFrame:
    """One row per document: doc_id, start, n_tokens and what ``start``, ``add`` and ``finish`` make of its ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, at in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                reader, rows, state = Reader(file), [], start()
                size = 0
                for row, ids, ends in reader.parts():
                    state = add(state, ids)
                    if not ends:
                        continue
                    doc_id, known, n = reader.documents[row].tolist()
                    rows.append((doc_id if known else None, at, n, finish(state)))
                    at, state, size = at + n, start(), size + n
                    if len(rows) == 10_000 or size > 1 << 20:
                        yield _rows(rows, kind)
                        rows, size = [], 0
                yield _rows(rows, kind)

    return _placed(files).mapInArrow(tidy(run), schema)


def _rows(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    columns = zip(*rows) if rows else ([],) * 4
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 3 + [kind])],
                                      names=["doc_id", "start", "n_tokens", "value"])


def read(files: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids (``array<long>``) of every document in the files."""
    found = _read(files, "doc_id long, start long, n_tokens long, value array<long>", pa.list_(pa.int64()), list,
                  lambda parts, ids: [*parts, ids], lambda parts: np.concatenate(parts).astype(np.int64))
    return found.withColumnRenamed("value", "ids")


def checksums(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32: the CRC-32 of a document's ids as little-endian unsigned 32-bit numbers."""
    found = _read(files, "doc_id long, start long, n_tokens long, value long", pa.int64(), int,
                  lambda crc, ids: zlib.crc32(ids.astype("<u4").tobytes(), crc), int)
    return found.withColumnRenamed("value", "ids_crc32")
