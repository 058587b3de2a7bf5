"""Runs of words that stand in a text word for word as somewhere before, wherever in a line they start or end.

Windows of ``SEED`` words start where a text's shingle hash is the smallest of ``GAP`` in a row. The choice follows from
the words alone, so two copies of a run choose the same places, and every run of ``MIN_WORDS`` words holds a whole
window. A window is aligned with the one of equal digest before it in its text, so that words said over and over shift by
one period, or else with the digest's first occurrence in all texts (the first one with the last). Windows that overlap
and agree on the shift make a stretch. A stretch is then extended word by word on both sides, as far as both texts
agree, and is a repeated run if it reaches ``MIN_WORDS`` words.

Only minima and maxima are kept per digest, so one in a third of all texts costs a row per task. A run whose windows
all have an earlier copy in some other, shorter run is aligned with that one and not found if the shorter one is too short.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.common import flat_bytes, mix, sifted, stored, text_slices, tidy, word_hashes

MIN_WORDS = 50
SHINGLE, SEED, GAP = 5, 28, 23
# Words on either side of a stretch that a run may still have: none holds a whole window.
EDGE = SEED + GAP

_WEIGHTS = np.random.Generator(np.random.PCG64(20240605)).integers(1, 2**63, 16, dtype=np.uint64) | np.uint64(1)
_NO_ID = 2**63 - 1


def seeds(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and digests of the windows of one text, given as word hashes."""
    if len(words) < MIN_WORDS:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    n = len(words) - SHINGLE + 1
    with np.errstate(over="ignore"):
        shingles = np.zeros(n, np.uint64)
        for i in range(SHINGLE):
            shingles += words[i:i + n] * _WEIGHTS[i]
        shingles = mix(shingles)
        rows = np.lib.stride_tricks.sliding_window_view(shingles, GAP)
        places = np.unique(rows.argmin(axis=1) + np.arange(len(rows)))
        places = places[places + SEED <= len(words)]
        digests = np.zeros(len(places), np.uint64)
        for i, at in enumerate([*range(0, SEED - SHINGLE, SHINGLE), SEED - SHINGLE]):
            digests += shingles[places + at] * _WEIGHTS[SHINGLE + i]
        return places, mix(digests)


def _texts_of_words(texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    for start, stop in text_slices(texts):
        data, offsets = flat_bytes(texts.slice(start, stop - start))
        words, at = word_hashes(data)
        bounds = np.searchsorted(at, offsets)
        for row in range(stop - start):
            yield start + row, words[bounds[row]:bounds[row + 1]]


def _seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, places, digests, earlier = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        for row, words in _texts_of_words(batch.column(2)):
            at, found = seeds(words)
            rows.append(np.full(len(at), row))
            places.append(at)
            digests.append(found)
            order = np.argsort(found, kind="stable")
            before = np.full(len(at), -1)
            before[order[1:]] = np.where(found[order[1:]] == found[order[:-1]], at[order[:-1]], -1)
            earlier.append(before)
        row = pa.array(np.concatenate(rows))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(row), batch.column(1).take(row), pa.array(np.concatenate(places).astype(np.int32)),
             pa.array(np.concatenate(digests).view(np.int64)), pa.array(np.concatenate(earlier).astype(np.int32))],
            names=["id", "t", "pos", "digest", "before"])


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of the words next to asked places, the nearest first: before a place (side 0) or from it on (side 1)."""
    for batch in batches:
        asked = batch.column(3).to_pylist()
        out = []
        for row, words in _texts_of_words(batch.column(2)):
            hashes = words.view(np.int64)
            for a in asked[row]:
                at = a["at"]
                near = hashes[max(0, at - EDGE):at][::-1] if a["side"] == 0 else hashes[at:at + EDGE]
                out.append((row, at, a["side"], near))
        if out:
            rows, places, sides, near = zip(*out)
            row = pa.array(rows)
            offsets = np.concatenate(([0], np.cumsum([len(x) for x in near]))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(row), batch.column(1).take(row), pa.array(places, pa.int32()), pa.array(sides, pa.int32()),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(near)))], names=["id", "t", "at", "side", "near"])


def _agree(a: str, b: str) -> Column:
    """How many elements two arrays have in common from their beginning on."""
    differ = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), False)
    return F.when(differ > 0, differ - 1).otherwise(F.size(a)).cast("int")


def _keyed(documents: DataFrame, key: str, text: str) -> DataFrame:
    return documents.select(F.coalesce(F.col(key).cast("long"), F.lit(_NO_ID)).alias("id"), F.xxhash64(F.col(text).cast("string")).alias("t"),
                            F.col(text).cast("string").alias("text"))


def find(documents: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, text_key, first_word, n_words, class_doc_id, class_first_word, removed: one row per repeated run of a text.

    Words are counted from 0 over the whole text. class_doc_id and class_first_word name the copy a run was aligned with:
    an earlier one, and removed is true, or, for the first copy of all, a later one. Copies are ordered by doc_id
    (null last), text_key (a hash that tells texts of one doc_id apart) and place, so a run may also repeat inside a text
    (one that overlaps its own copy may have a row for the copy alone).
    Equal rows (doc_id and text) count as one text. Null, empty and shorter texts have no row, nor has an empty table; texts of any length are
    read whole. ``min_words`` is at least 50.
    """
    if min_words < MIN_WORDS:
        raise ValueError(f"runs have at least {MIN_WORDS} words")
    docs = _keyed(documents, key, text)
    found = stored(docs.select("id", "t", "text").mapInArrow(tidy(_seeds), "id long, t long, pos int, digest long, before int"), "run-seeds")
    spot = F.struct("id", "t", "pos")
    classes = stored(found.groupBy("digest").agg(F.min(spot).alias("first"), F.max(spot).alias("last")).where("first <> last"), "run-classes")
    own = F.struct("id", "t", F.col("before").alias("pos"))
    partner = F.when(F.col("before") >= 0, own).when(spot == F.col("first"), F.col("last")).otherwise(F.col("first"))
    aligned = found.join(classes, "digest").select("id", "t", "pos", partner.alias("p"), (spot != F.col("first")).alias("removed"))
    aligned = aligned.select("id", "t", "pos", F.col("p.id").alias("pid"), F.col("p.t").alias("pt"), (F.col("pos") - F.col("p.pos")).alias("shift"), "removed")
    along = Window.partitionBy("id", "t", "pid", "pt", "shift", "removed").orderBy("pos")
    apart = (F.col("pos") - F.lag("pos").over(along) > SEED).cast("int")
    stretch = aligned.withColumn("apart", F.coalesce(apart, F.lit(0))).withColumn("n", F.sum("apart").over(along))
    stretches = stored(stretch.groupBy("id", "t", "pid", "pt", "shift", "removed", "n").agg(
        F.min("pos").alias("start"), (F.max("pos") + SEED).alias("stop")).drop("n"), "run-stretches")

    def asked(i: str, t: str, shift) -> DataFrame:
        ends = F.array(F.struct((F.col("start") - shift).alias("at"), F.lit(0).alias("side")), F.struct((F.col("stop") - shift).alias("at"), F.lit(1).alias("side")))
        return stretches.select(F.col(i).alias("id"), F.col(t).alias("t"), F.explode(ends).alias("end"))

    wanted = asked("id", "t", F.lit(0)).union(asked("pid", "pt", F.col("shift"))).distinct()
    lists = stored(wanted.groupBy("id", "t").agg(F.collect_list("end").alias("ends")), "run-edges")
    maybe = sifted(docs, ["id", "t"], lists, ["id", "t"]).where("_maybe")
    edges = stored(maybe.join(lists, ["id", "t"]).select("id", "t", "text", "ends").mapInArrow(
        tidy(_edges), "id long, t long, at int, side int, near array<long>").dropDuplicates(["id", "t", "at", "side"]), "run-contexts")
    near = stretches
    for name, i, t, at, side in (("a0", "id", "t", "start", 0), ("a1", "id", "t", "stop", 1),
                                 ("b0", "pid", "pt", "start - shift", 0), ("b1", "pid", "pt", "stop - shift", 1)):
        part = edges.where(F.col("side") == side).select(F.col("id").alias("_i"), F.col("t").alias("_t"), F.col("at").alias("_at"), F.col("near").alias(name))
        near = near.join(part, (F.col(i) == F.col("_i")) & (F.col(t) == F.col("_t")) & (F.expr(at) == F.col("_at"))).drop("_i", "_t", "_at")
    left, right = _agree("a0", "b0"), _agree("a1", "b1")
    runs = near.withColumns({"first_word": F.col("start") - left, "n_words": F.col("stop") - F.col("start") + left + right}).where(F.col("n_words") >= min_words)
    known = lambda c: F.when(F.col(c) != _NO_ID, F.col(c))
    return runs.select(known("id").alias("doc_id"), F.col("t").alias("text_key"), "first_word", "n_words", known("pid").alias("class_doc_id"),
                       (F.col("first_word") - F.col("shift")).alias("class_first_word"), "removed").distinct()


def _without(text: str, lines: list[int], runs: list) -> str:
    """``text`` without some of its lines and runs of words; what follows a run moves up to its place."""
    data = np.frombuffer(text.encode() + b"\n", np.uint8)
    gone = np.zeros(len(data), bool)
    if lines:
        ends = np.flatnonzero(data == 0x0A) + 1
        starts = np.concatenate(([0], ends[:-1]))
        for i in lines:
            gone[starts[i]:ends[i]] = True
    if runs:
        at = np.append(word_hashes(data)[1], len(data) - 1)
        for r in runs:
            gone[at[r["first_word"]]:at[r["first_word"] + r["n_words"]]] = True
    whole = bool(gone[-1])
    kept = data[~gone].tobytes().decode()
    # The line feed added above, or, if it went with the last line, the one before that.
    return kept[:-1] if kept and (not whole or kept.endswith("\n")) else kept


def _cut(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for texts, lines, runs in batches:
        parts = []
        for start, stop in text_slices(texts):
            rows = zip(*(c.slice(start, stop - start).to_pylist() for c in (texts, lines, runs)))
            parts.append(pa.array([None if t is None else _without(t, a or [], b or []) for t, a, b in rows], pa.string()))
        yield pa.concat_arrays(parts) if parts else pa.array([], pa.string())


def remove(documents: DataFrame, runs: DataFrame | None = None, lines: DataFrame | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``documents`` without the runs, and the lines (paragraphs of ``substring_dedup``), that are marked as removed.

    A column _removed counts them (0 or more). Rows are told by doc_id, null among them, and text; all others stay as they are.
    """
    parts = []
    if runs is not None:
        parts.append(runs.where("removed").select("doc_id", "text_key", F.struct("first_word", "n_words").alias("run"), F.lit(None).cast("int").alias("line")))
    if lines is not None:
        parts.append(lines.where("removed").select("doc_id", "text_key", F.lit(None).cast("struct<first_word:int,n_words:int>").alias("run"),
                                                   F.col("paragraph").alias("line")))
    gone = functools.reduce(DataFrame.unionByName, parts).groupBy("doc_id", "text_key").agg(
        F.collect_set("run").alias("runs"), F.collect_set("line").alias("lines"))
    gone = stored(gone.select(F.struct("*").alias("_gone")), "removed-words")
    names = [f"c{i}" for i in range(len(documents.columns))]
    rest = documents.toDF(*names)
    k, t = names[documents.columns.index(key)], names[documents.columns.index(text)]
    text_key = F.xxhash64(F.col(t).cast("string"))
    rest = sifted(rest, [F.col(k).cast("long"), text_key], gone, ["_gone.doc_id", "_gone.text_key"])
    met = rest.where("_maybe").join(gone, F.col(k).eqNullSafe(F.col("_gone.doc_id")) & (text_key == F.col("_gone.text_key")), "left")

    @F.arrow_udf("string")
    def cut(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        yield from tidy(_cut)(batches)

    # Only texts that lose something go to Python, and once: a filter on the new text is not pushed below what Spark takes as not deterministic.
    asked = F.when(F.col("_gone").isNotNull(), F.col(t).cast("string"))
    changed = F.when(F.col("_gone").isNull(), F.col(t)).otherwise(cut.asNondeterministic()(asked, F.col("_gone.lines"), F.col("_gone.runs")))
    count = sum(F.coalesce(F.greatest(F.size(c), F.lit(0)), F.lit(0)) for c in ("_gone.lines", "_gone.runs"))

    def named(rows: DataFrame, new_text: Column, removed: Column) -> DataFrame:
        return rows.select(*((new_text if n == t else F.col(n)).alias(c) for n, c in zip(names, documents.columns) if c != "_removed"), removed.alias("_removed"))

    return named(met, changed, count).union(named(rest.where("NOT _maybe"), F.col(t).cast("string"), F.lit(0)))
