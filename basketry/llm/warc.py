"""WARC archives: an index of offsets, lengths, URLs and digests first, then byte-range reads of chosen records.

``write`` deals pages to tasks; each task appends gzip members (one per record) to a file of its own in the shared
folder and returns the index rows of what it wrote. A task that is run again writes another file, and only the
index of the run that counted is stored, so files of lost attempts are never read. ``read`` takes any selection of
index rows, sorts it by file and offset, joins neighbouring ranges and reads each joined range once.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import stored
from basketry.session import work_dir

DEDUP_BYTES = 100
SPAN_BYTES = 4 << 20
GAP_BYTES = 64 << 10
FILE_BYTES = 256 << 20

INDEX = ("page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, "
         "file string, offset long, length long")
RECORD = ("page_id long, url string, record_type string, refers_to long, payload_digest string, payload binary, "
          "file string, offset long")


def plan(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html",
         dedup_bytes: int = DEDUP_BYTES) -> DataFrame:
    """Which record each page becomes: page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to.

    Of equal payloads of at least ``dedup_bytes`` bytes the one with the smallest page_id is the response and the
    others revisit it. A null payload is empty. Repeated page_ids are archived row by row; a repeated row of the
    smallest page_id is a response again.
    """
    payload = F.encode(F.coalesce(F.col(html).cast("string"), F.lit("")), "UTF-8")
    records = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
                           payload.alias("payload")).withColumns({
        "payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha2("payload", 256),
    })
    # One row per repeated payload; the join below is the last step before the write, so hot payloads can be split.
    repeated = stored(
        records.where(F.col("payload_bytes") >= dedup_bytes).groupBy("payload_digest")
        .agg(F.min("page_id").alias("response_id"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1").drop("copies"), "warc-repeated")
    revisit = F.col("page_id") > F.col("response_id")
    return records.join(repeated, "payload_digest", "left").select(
        "page_id", "url", "payload", "payload_bytes", "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("response_id")).alias("refers_to"))


def record(row: dict) -> bytes:
    """One WARC/1.1 record; header values are percent-encoded where they hold line breaks."""
    def one_line(value: str) -> str:
        return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")

    body = row["payload"] if row["record_type"] == "response" else b""
    head = [
        "WARC/1.1", f"WARC-Type: {row['record_type']}",
        f"WARC-Record-ID: <urn:page:{'' if row['page_id'] is None else row['page_id']}>",
        f"WARC-Payload-Digest: sha256:{row['payload_digest']}", "Content-Type: text/html; charset=UTF-8",
        f"Content-Length: {len(body)}",
    ]
    if row["url"] is not None:
        head.append(f"WARC-Target-URI: {one_line(row['url'])}")
    if row["refers_to"] is not None:
        head.append(f"WARC-Refers-To: <urn:page:{row['refers_to']}>")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """The fields of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record here")
    fields = dict(line.split(": ", 1) for line in lines[1:])

    def page(name: str) -> int | None:
        number = fields.get(name, "<urn:page:>")[len("<urn:page:"):-1]
        return int(number) if number else None

    target = fields.get("WARC-Target-URI")
    return {
        "page_id": page("WARC-Record-ID"), "refers_to": page("WARC-Refers-To"), "record_type": fields["WARC-Type"],
        "url": target and target.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%"),
        "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha256:"),
        "payload": rest[:int(fields["Content-Length"])],
    }


def write(records: DataFrame, folder: str) -> DataFrame:
    """Write planned records as ``*.warc.gz`` below ``folder`` and return the stored index.

    ``folder`` is a URI or path that all executors can write, on any file system that Arrow reaches.
    """
    names = [f.split()[0] for f in INDEX.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, file, offset = None, "", 0
        try:
            for batch in batches:
                rows = []
                for row in batch.to_pylist():
                    if out is None or offset > FILE_BYTES:
                        if out is not None:
                            out.close()
                        system, at = FileSystem.from_uri(folder)
                        system.create_dir(at, recursive=True)
                        name, offset = f"{uuid.uuid4().hex}.warc.gz", 0
                        file, out = f"{folder}/{name}", system.open_output_stream(f"{at}/{name}", compression=None)
                    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
                    data = pack.compress(record(row)) + pack.flush()
                    out.write(data)
                    rows.append([*(row[n] for n in names[:6]), file, offset, len(data)])
                    offset += len(data)
                yield pa.RecordBatch.from_arrays([
                    pa.array(c, pa.int64() if n in ("page_id", "refers_to", "payload_bytes", "offset", "length") else pa.string())
                    for n, c in zip(names, zip(*rows) if rows else [[]] * len(names))], names=names)
        finally:
            if out is not None:
                out.close()

    return stored(records.mapInArrow(run, INDEX), "warc-index")


def ranges(rows: list[tuple[str, int, int]]) -> list[list[tuple[str, int, int]]]:
    """Sorted (file, offset, length) rows in groups to be read at once: gaps up to GAP_BYTES, spans up to SPAN_BYTES."""
    groups: list[list[tuple[str, int, int]]] = []
    for file, offset, length in rows:
        if groups and groups[-1][-1][0] == file:
            first, last = groups[-1][0], groups[-1][-1]
            if offset - (last[1] + last[2]) <= GAP_BYTES and offset + length - first[1] <= SPAN_BYTES:
                groups[-1].append((file, offset, length))
                continue
        groups.append([(file, offset, length)])
    return groups


def read(index: DataFrame) -> DataFrame:
    """The records that ``index`` rows point at, parsed. A row listed twice gives its record twice."""
    names = [f.split()[0] for f in RECORD.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    types = [kinds[f.split()[1]] for f in RECORD.split(", ")]
    n = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = index.select("file", "offset", "length").repartitionByRange(n, "file", "offset").sortWithinPartitions("file", "offset")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        handle, opened = None, None
        for batch in batches:
            for group in ranges(list(zip(*(c.to_pylist() for c in batch.columns)))):
                file, base, _ = group[0]
                if file != opened:
                    if handle is not None:
                        handle.close()
                    system, at = FileSystem.from_uri(file)
                    handle, opened = system.open_input_file(at), file
                data = handle.read_at(max(o + size for _, o, size in group) - base, base)
                rows = []
                for _, offset, length in group:
                    found = parse(zlib.decompress(data[offset - base:offset - base + length], 31))
                    rows.append([found.get(x, file if x == "file" else offset) for x in names])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
        if handle is not None:
            handle.close()

    return wanted.mapInArrow(run, RECORD)


def resolve(records: DataFrame) -> DataFrame:
    """Digest columns of what was read: a revisit has the length and digest of the response it refers to.

    Of several responses with one page_id that is the one whose digest the revisit names.
    """
    response = F.col("record_type") == "response"
    own = stored(records.select("page_id", "record_type", "refers_to", F.octet_length("payload").cast("long").alias("n"),
                                F.when(response, F.sha2("payload", 256)).otherwise(F.col("payload_digest")).alias("digest")), "warc-read")
    asked = own.select(F.col("refers_to").alias("page_id"), "digest").where("page_id IS NOT NULL").distinct()
    found = stored(own.where(response).join(asked, ["page_id", "digest"], "left_semi").groupBy("page_id", "digest").agg(
        F.first("n").alias("full_n")).withColumnRenamed("page_id", "refers_to"), "warc-responses")
    return own.join(found, ["refers_to", "digest"], "left").select(
        "page_id", F.when(response, F.col("n")).otherwise(F.col("full_n")).alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        "record_type", "refers_to")


def archive(pages: DataFrame, folder: str | None = None, **names: str) -> DataFrame:
    """Write ``pages`` as archives and return the index. Empty tables give an empty index and no file."""
    return write(plan(pages, **names), folder or work_dir(pages.sparkSession, "warc"))
