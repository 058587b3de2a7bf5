"""Byte-level BPE encoding and decoding with DuckDB queries inside each Spark partition.

A text is split by the tokenizer's pattern; each match is a word. A word that is a vocabulary entry is one token.
Of the others, a worker encodes every distinct one once, as long as it remembers it: its spans of two bytes and more
are joined with the vocabulary, and a recursive query contracts, in each word and each round, the leftmost pair of
lowest rank, until no pair is left. A pair is a span of the vocabulary that holds just two tokens, which is how the
public encoder finds pairs, so the state of a word is a bit mask of the places where tokens meet. A span leaves the
query as soon as one of its ends is no such place any more, and with the last pair of its word. Decoding takes the
bytes of a text's ids from the vocabulary by position and concatenates them.

A word has half as many spans as the square of its length, and a round handles one pair. Words over ``LONG`` bytes,
up to pages of one letter, therefore take the same leftmost-lowest-rank steps on a heap.
"""

from __future__ import annotations

import base64
import functools
import heapq
import re
import unicodedata
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm.common import keep, text_slices, tidy, without

RANKS = "byte_bpe_multi_50k.tiktoken"
# At most 30, as a span's key has five bits for each end.
LONG = 24
CACHE = 300_000
JOB = "byte_bpe"
WORDS_PER_QUERY, SPANS_PER_QUERY = 20_000, 1_000_000
IDS_PER_QUERY = 250_000

ENCODE = """
WITH RECURSIVE part AS (
    SELECT word, bytes, first, past, substring(hex, 2 * first + 1, 2 * (past - first)) AS hex FROM words JOIN places ON past <= bytes
), span AS MATERIALIZED (
    SELECT word, bytes, rank * 1024 + first * 32 + past AS key, (1 << first) | (1 << past) AS ends, (1 << past) - (2 << first) AS inside
    FROM part JOIN vocabulary USING (hex)
), step(word, key, ends, inside, mask) AS (
    SELECT word, key, ends, inside, (2 << bytes) - 1 FROM span
    UNION ALL
    (WITH lowest AS (
        SELECT word, min(key) AS best FROM step WHERE bit_count(mask & inside) = 1 GROUP BY word
    ), target AS (
        SELECT word, ~((1 << best % 32) - (2 << best // 32 % 32)) AS rest FROM lowest
    )
    SELECT s.word, key, ends, inside, mask & rest FROM step s JOIN target USING (word)
    WHERE mask & inside <> 0 AND mask & rest & ends = ends)
), ended AS (
    SELECT word, min(mask) AS mask FROM step WHERE mask & inside = 0 GROUP BY word
)
SELECT word, key // 32 % 32 AS first, key % 32 AS past, key // 1024 AS id
FROM span JOIN ended USING (word) WHERE mask & ends = ends AND mask & inside = 0
"""

DECODE = """
SELECT text, coalesce(array_to_string(parts, ''), '') AS hex, list_count(parts) AS n
FROM (SELECT text, list_select(entries, places) AS parts FROM tokens, vocabulary)
"""


class Codes(dict):
    """Numbers words in the order of their first use."""

    def __missing__(self, word: str) -> int:
        self[word] = code = len(self)
        return code


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def _latin(kind: str) -> str:
    return "".join(c for c in map(chr, range(0x250)) if unicodedata.category(c)[0] == kind)


class Words:
    """The matches of the tokenizer's pattern in a text.

    Texts without a character from U+0250 on go through the same pattern with its classes written out, which the
    standard library takes half the time for.
    """

    def __init__(self):
        import regex

        letters, numbers, space = _latin("L"), _latin("N"), " \t\n\v\f\r\x85\xa0"
        self.general = regex.compile(public_tokenizers.PATTERN).findall
        self.latin = re.compile(
            f" ?[{letters}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[{numbers}]+| ?[^{space}{letters}{numbers}]+"
            f"|[{space}]+(?![^{space}])|[{space}]+").findall
        self.beyond = re.compile(r"[^\x00-\u024f]").search

    def __call__(self, text: str) -> list[str]:
        return (self.general if self.beyond(text) else self.latin)(text)


def _bounded(words: list[int], sizes: np.ndarray) -> list[list[int]]:
    """``words`` query by query: no more than so many words, and words of no more than so many spans and one word's."""
    share = np.maximum(sizes * (sizes - 1) // 2, SPANS_PER_QUERY // WORDS_PER_QUERY)
    query = (np.cumsum(share) - share) // SPANS_PER_QUERY
    edges = [0, *(np.flatnonzero(np.diff(query)) + 1).tolist(), len(words)]
    return [words[a:b] for a, b in zip(edges, edges[1:]) if a < b]


class Database:
    """A DuckDB of one Python worker, on one thread and bounded memory."""

    def __init__(self):
        import duckdb

        # What a query freed goes back to the system: its allocator would keep it beside the words.
        self.db = duckdb.connect(config={
            "threads": 1, "memory_limit": "300MB", "allocator_flush_threshold": "4MB", "allocator_bulk_deallocation_flush_threshold": "4MB"})

    def __enter__(self):
        return self

    def __exit__(self, *_) -> None:
        self.db.close()

    def _load(self, name: str, rows: pa.Table) -> None:
        self.db.register("incoming", rows)
        self.db.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM incoming")
        self.db.unregister("incoming")


class Memory:
    """Words met so far and their ids. A worker process keeps it from task to task, so that frequent words are
    merged once, until it goes on with another job."""

    def __init__(self):
        self.codes = Codes()
        self.pool, self.starts, self.sizes = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)
        self.uses = np.empty(0, np.int64)

    def gather(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words one after the other, and the end of each."""
        sizes = self.sizes[codes]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self.pool[np.arange(total) + np.repeat(self.starts[codes] - (ends - sizes), sizes)], ends

    def forget(self) -> None:
        """Keep the words used most since the last time, at most half as many as fit."""
        kept = np.flatnonzero(self.uses > 1)
        if len(kept) > CACHE // 2:
            kept = np.sort(kept[np.argsort(-self.uses[kept], kind="stable")[:CACHE // 2]])
        words = list(self.codes)
        pool, ends = self.gather(kept)
        sizes = self.sizes[kept]
        self.__init__()
        for i in kept.tolist():
            self.codes[words[i]]
        self.pool, self.starts, self.sizes, self.uses = pool, ends - sizes, sizes, np.zeros(len(kept), np.int64)


@functools.lru_cache(maxsize=1)
def _memory(path: str) -> Memory:
    keep(JOB, _memory.cache_clear)
    return Memory()


class Encoder(Database):
    def __init__(self, path: str, memory: Memory | None = None):
        super().__init__()
        self.ranks = read_ranks(path)
        self.split = Words()
        self.memory = memory or Memory()
        self._load("vocabulary", pa.table({"hex": [v.hex() for v in self.ranks], "rank": pa.array(self.ranks.values(), pa.int32())}))
        first, past = np.triu_indices(LONG + 1, 2)
        self._load("places", pa.table({"first": first.astype(np.int32), "past": past.astype(np.int32)}))

    def encode(self, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """Row ranges of the texts, with all their ids one after the other and how many each row has.

        The words of all texts are learnt together, in few queries; ids are gathered from range to range.
        """
        memory = self.memory
        # A task that failed may have left words without ids.
        self._learn(list(islice(memory.codes, len(memory.sizes), None)))
        if len(memory.codes) > CACHE:
            memory.forget()
        found, none = [], np.empty(0, np.int32)
        for start, stop in text_slices(texts):
            # Text by text, so that no more than one text's words are in memory, and near the processor.
            split = [self._codes(t) if t else none for t in texts.slice(start, stop - start).to_pylist()]
            found.append((start, stop, np.array([len(c) for c in split], np.int64), np.concatenate(split)))
            del split
        self._learn(list(islice(memory.codes, len(memory.sizes), None)))
        for start, stop, counts, codes in found:
            memory.uses += np.bincount(codes, minlength=len(memory.uses))
            flat, ends = memory.gather(codes)
            bounds = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(counts)))]
            yield start, stop, flat, np.diff(bounds)

    def _codes(self, text: str) -> np.ndarray:
        words = self.split(text)
        return np.fromiter(map(self.memory.codes.__getitem__, words), np.int32, len(words))

    def _learn(self, fresh: list[str]) -> None:
        """Encode words that no earlier text had."""
        if not fresh:
            return
        memory = self.memory
        data = [word.encode() for word in fresh]
        known = [self.ranks.get(d) for d in data]
        long = {i: self.contract(d) for i, d in enumerate(data) if known[i] is None and len(d) > LONG}
        short = [i for i, k in enumerate(known) if k is None and i not in long]
        sizes = np.ones(len(fresh), np.int64)
        parts = [self._merge([data[i] for i in some]) for some in _bounded(short, np.array([len(data[i]) for i in short], np.int64))]
        sizes[short] = np.concatenate([n for _, n in parts]) if parts else 0
        sizes[list(long)] = [len(ids) for ids in long.values()]
        starts = np.cumsum(sizes) - sizes
        pool = np.zeros(int(sizes.sum()), np.int32)
        whole = [i for i, k in enumerate(known) if k is not None]
        pool[starts[whole]] = [known[i] for i in whole]
        for i, ids in long.items():
            pool[starts[i]:starts[i] + len(ids)] = ids
        if parts:
            n = sizes[short]
            pool[np.arange(n.sum()) + np.repeat(starts[short] - (np.cumsum(n) - n), n)] = np.concatenate([ids for ids, _ in parts])
        memory.starts = np.concatenate((memory.starts, len(memory.pool) + starts))
        memory.pool = np.concatenate((memory.pool, pool))
        memory.uses = np.concatenate((memory.uses, np.zeros(len(fresh), np.int64)))
        memory.sizes = np.concatenate((memory.sizes, sizes))

    def _merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words one after the other, and how many each has."""
        single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        sizes = np.array([len(w) for w in words])
        starts = np.cumsum(sizes) - sizes
        self._load("words", pa.table({
            "word": np.arange(len(words), dtype=np.int32), "hex": [w.hex() for w in words], "bytes": sizes.astype(np.int32)}))
        found = self.db.sql(ENCODE).to_arrow_table()
        word, first, past, ids = (found.column(c).to_numpy() for c in ("word", "first", "past", "id"))
        # Bytes outside all spans found are tokens of their own; a span's token stands at its first byte.
        tokens = single[np.frombuffer(b"".join(words), np.uint8)]
        tokens[starts[word] + first] = ids
        inner = np.zeros(len(tokens) + 1, np.int8)
        inner[starts[word] + first + 1] = 1
        inner[starts[word] + past] -= 1
        kept = np.cumsum(inner[:-1]) == 0
        return tokens[kept], np.add.reduceat(kept, starts, dtype=np.int64)

    def contract(self, data: bytes) -> list[int]:
        """The same contraction of one long word with a heap of (rank, position)."""
        ranks, n = self.ranks, len(data)
        parts: list[bytes | None] = [data[i:i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(ranks[data[i:i + 2]], i, data[i:i + 2]) for i in range(n - 1) if data[i:i + 2] in ranks]
        heapq.heapify(heap)
        while heap:
            _, i, joined = heapq.heappop(heap)
            j = after[i] if parts[i] is not None else n
            if j >= n or parts[i] + parts[j] != joined:
                continue
            parts[i], parts[j] = joined, None
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (both := parts[a] + parts[b]) in ranks:
                    heapq.heappush(heap, (ranks[both], a, both))
        return [ranks[p] for p in parts if p is not None]


class Decoder(Database):
    def __init__(self, path: str):
        super().__init__()
        entries = {r: v.hex() for v, r in read_ranks(path).items()}
        self._load("vocabulary", pa.table({"entries": pa.array([[entries.get(i) for i in range(max(entries) + 1)]], pa.list_(pa.string()))}))

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> list[bytes]:
        """Bytes of each run of ``sizes`` ids; unknown ids raise an error."""
        ends = np.cumsum(sizes)
        parts: list[list[bytes]] = [[] for _ in sizes]
        # A query takes a bounded number of ids, also of one long text; the parts of a text follow each other.
        for start in range(0, len(ids), IDS_PER_QUERY):
            stop, found = min(start + IDS_PER_QUERY, len(ids)), 0
            some = np.arange(np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "left") + 1)
            offsets = np.concatenate(([0], np.minimum(ends[some], stop) - start)).astype(np.int32)
            # Places count from 1; at 0 there is no entry, below it they would count from the end.
            places = np.maximum(np.asarray(ids[start:stop], np.int32), -1) + 1
            self._load("tokens", pa.table({"text": some, "places": pa.ListArray.from_arrays(pa.array(offsets), pa.array(places))}))
            for row, hex_, n in self.db.execute(DECODE).fetchall():
                parts[row].append(bytes.fromhex(hex_))
                found += n
            if found != stop - start:
                raise ValueError("ids outside the vocabulary")
        return [b"".join(p) for p in parts]


Batches = Iterator[pa.RecordBatch]


def _encode(batches: Batches, path: str, text: str, to: str) -> Batches:
    # The database lives as long as its task: workers are used again, and its memory must not stay behind.
    with Encoder(path, _memory(path)) as bpe:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))
            for first, last in text_slices(texts, 8 << 20):
                for start, stop, flat, sizes in bpe.encode(texts.slice(first, last - first)):
                    offsets = np.concatenate((np.zeros(1, np.int64), np.cumsum(sizes))).astype(np.int32)
                    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
                    part = batch.slice(first + start, stop - start)
                    yield pa.RecordBatch.from_arrays([*part.columns, lists], names=[*part.schema.names, to])


def _decode(batches: Batches, path: str, ids: str, to: str) -> Batches:
    with Decoder(path) as bpe:
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids))
            lengths = np.array(pc.list_value_length(lists).fill_null(0).to_pylist(), np.int64)
            data = bpe.decode(lists.flatten().to_numpy(zero_copy_only=False), lengths)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(data, pa.binary())], names=[*batch.schema.names, to])


def encode(df: DataFrame, text: str = "text", to: str = "ids", ranks: str | None = None) -> DataFrame:
    """``df`` with the token ids of ``text`` as ``array<int>``, as the public encoder gives them without special tokens.

    Null and empty texts have no ids (an empty array). Rows are independent: repeated rows repeat, an empty table
    stays empty, long texts are encoded whole. A column named ``to`` is replaced. ``ranks`` is a path that every
    executor can read.
    """
    path = ranks or public_tokenizers.path(RANKS)
    df = without(df, to)
    schema = T.StructType([*df.schema.fields, T.StructField(to, T.ArrayType(T.IntegerType()))])
    return df.mapInArrow(tidy(lambda batches: _encode(batches, path, text, to), JOB), schema)


def decode(df: DataFrame, ids: str = "ids", to: str = "decoded", ranks: str | None = None) -> DataFrame:
    """``df`` with the bytes that the token ids in ``ids`` stand for; null counts as no ids, a null id is an error."""
    path = ranks or public_tokenizers.path(RANKS)
    df = without(df, to)
    schema = T.StructType([*df.schema.fields, T.StructField(to, T.BinaryType())])
    return df.mapInArrow(tidy(lambda batches: _decode(batches, path, ids, to), JOB), schema)


def round_trip(df: DataFrame, text: str = "text", ids: str = "ids", decoded: str = "decoded", ranks: str | None = None) -> DataFrame:
    """``encode`` and ``decode`` in one pass of one worker, with ``text`` left out of the result."""
    path = ranks or public_tokenizers.path(RANKS)
    df = without(df, ids, decoded)
    schema = T.StructType([*(f for f in df.schema.fields if f.name != text), T.StructField(ids, T.ArrayType(T.IntegerType())),
                           T.StructField(decoded, T.BinaryType())])

    def run(batches: Batches) -> Batches:
        encoded = (batch.drop_columns([text]) for batch in _encode(batches, path, text, ids))
        return _decode(encoded, path, ids, decoded)

    return df.mapInArrow(tidy(run, JOB), schema)


def digests(df: DataFrame, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """n_tokens and the hexadecimal SHA-256 of the ids joined by commas and of the decoded bytes."""
    return df.select("doc_id", F.size(ids).cast("long").alias("n_tokens"),
                     F.sha2(F.concat_ws(",", F.col(ids).cast("array<string>")), 256).alias("ids_sha256"),
                     F.sha2(F.col(decoded), 256).alias("decoded_sha256"))
