"""Passages that repeat within or across documents: MinHash bands, exact Jaccard, components.

A passage is a paragraph (a line) of at least ``MIN_WORDS`` words. Equal shingle sets make one class. MinHash values are
cut into bands; the number of bands is tuned so that a pair of similarity ``SIMILARITY`` shares none with a
probability of at most ``MISS``. Classes that share a band are verified exactly by ``set_links`` and their links joined
to components. Of the paragraphs of a component, the one with the smallest (doc_id, paragraph) stays.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import discard, mix, shingle_sets, sifted, signature, stored, tidy
from basketry.llm.set_links import clusters, linked

MIN_WORDS = 50
SIMILARITY = 0.8
ROWS = 3
MISS = 1e-6


def bands_for(similarity: float, rows: int, miss: float) -> int:
    """Fewest bands of ``rows`` values that a pair of ``similarity`` misses with probability ``miss`` at most."""
    return math.ceil(math.log(miss) / math.log(1 - similarity**rows))


BANDS = bands_for(SIMILARITY, ROWS, MISS)
_FACTORS = np.random.Generator(np.random.PCG64(20240603)).integers(1, 2**63, (BANDS * ROWS + ROWS + 1, 1), dtype=np.uint64) | np.uint64(1)


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of a set of shingle hashes."""
    with np.errstate(over="ignore"):
        least = np.concatenate([
            (hashes[None, a:a + 4096] * _FACTORS[:BANDS * ROWS]).min(axis=1, keepdims=True) for a in range(0, len(hashes), 4096)
        ], axis=1).min(axis=1).reshape(BANDS, ROWS)
        joined = (mix(least) * _FACTORS[BANDS * ROWS:BANDS * ROWS + ROWS, 0]).sum(axis=1, dtype=np.uint64)
        return mix(joined + np.arange(BANDS, dtype=np.uint64) * _FACTORS[-1, 0]).view(np.int64)


def paragraphs(text: str | None, min_words: int) -> list[tuple[int, int, bytes]]:
    """(number, words, bytes) of the lines with at least ``min_words`` words."""
    lines = enumerate((text or "").encode().split(b"\n"))
    return [(i, n, line) for i, line in lines if len(line) >= 2 * min_words - 1 and (n := len(line.split())) >= min_words]


def _sets(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[tuple]:
    """(doc_id, paragraph, words, text_key, hashes) of all passages."""
    for batch in batches:
        ids = batch.column(0).to_pylist()
        texts = batch.column(2).to_pylist()
        only = batch.column(3).to_pylist() if batch.num_columns > 3 else None
        for start in range(0, len(ids), 256):
            found = [(ids[i], *p[:2], texts[i], p[2]) for i, text in enumerate(batch.column(1).slice(start, 256).to_pylist(), start)
                     for p in paragraphs(text, min_words) if only is None or p[0] in only[i]]
            lines = pa.array([p[4] for p in found], pa.binary())
            for row, hashes in shingle_sets(lines):
                yield (*found[row][:4], hashes)


def _batches(rows: Iterator[tuple], kinds: dict[str, pa.DataType], size: int = 2000) -> Iterator[pa.RecordBatch]:
    part = []
    for row in rows:
        part.append(row)
        if len(part) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part), kinds.values())], names=list(kinds))
            part = []
    if part:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part), kinds.values())], names=list(kinds))


def repeated(documents: DataFrame, min_words: int = MIN_WORDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Paragraphs that have a copy or near copy: doc_id, text_key, paragraph, n_words, class_doc_id, class_paragraph, n_links, removed.

    ``paragraph`` counts the lines of a text from 0. Near copies share five-word shingles with a Jaccard similarity of at
    least 0.8 (words as in the n-gram join). class_doc_id and class_paragraph name the first paragraph of the
    component, removed is true for all others; n_links counts the different sets that the paragraph's set is linked with. Shorter paragraphs, and null or empty texts, give no
    row. text_key is a hash that tells texts of one doc_id apart. Of repeated rows with one doc_id the later lose their paragraphs only with the whole doc_id, so equal
    (doc_id, paragraph) rows are all kept if they come first. Rows with a null doc_id take no part. An empty table gives no row.
    """
    base = documents.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).where("doc_id IS NOT NULL")
    base = base.withColumn("text_key", F.xxhash64("text"))
    kinds = {"doc_id": pa.int64(), "paragraph": pa.int32(), "n_words": pa.int32(), "text_key": pa.int64(), "sig": pa.int64(), "bands": pa.list_(pa.int64())}

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(((d, p, w, t, signature(h), band_keys(h)) for d, p, w, t, h in _sets(batches, min_words)), kinds)

    described = stored(base.mapInArrow(tidy(describe), "doc_id long, paragraph int, n_words int, text_key long, sig long, bands array<long>"), "passages")
    first = F.min(F.struct("doc_id", "paragraph")).alias("rep")
    classes = stored(described.groupBy("sig").agg(first, F.count(F.lit(1)).alias("copies")), "passage-classes")
    # All copies of a class have its bands; the first stands for it.
    reps = described.join(classes.select("sig", "rep"), "sig").where("doc_id = rep.doc_id AND paragraph = rep.paragraph")
    near = clusters(reps.select(F.col("sig").alias("id"), F.explode("bands").alias("key")))

    wanted = classes.join(near.select(F.col("id").alias("sig")), "sig", "left_semi")
    wanted = wanted.groupBy(F.col("rep.doc_id").alias("doc_id")).agg(F.collect_set("rep.paragraph").alias("only"))
    shapes = {"id": pa.int64(), "n": pa.int64(), "elements": pa.binary()}

    def elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(((signature(h), len(h), np.sort(h.view(np.int64)).tobytes()) for *_, h in _sets(batches, min_words)), shapes)

    wanted = stored(wanted, "wanted")
    maybe = sifted(base, ["doc_id"], wanted, ["doc_id"]).where("_maybe")
    sets = maybe.join(wanted, "doc_id").select("doc_id", "text", "text_key", "only").mapInArrow(
        tidy(elements), "id long, n long, elements binary").dropDuplicates(["id"])
    members = stored(sets.join(near, "id"), "passage-members")
    found = stored(linked(members), "passage-links").withColumnRenamed("id", "sig")
    discard(members, near, wanted)

    labelled = stored(classes.join(found, "sig", "left").select(
        "sig", "rep", "copies", F.coalesce("component", "sig").alias("component"), F.coalesce("n_links", F.lit(0)).alias("n_links")),
        "passage-labels")
    firsts = stored(labelled.groupBy("component").agg(F.min("rep").alias("first"), F.sum("copies").alias("members"))
                    .where("members > 1"), "passage-firsts")
    named = stored(labelled.join(firsts, "component").select("sig", "first", "n_links"), "passage-names")
    return described.select("doc_id", "text_key", "paragraph", "n_words", "sig").join(named, "sig").select(
        "doc_id", "text_key", "paragraph", "n_words", F.col("first.doc_id").alias("class_doc_id"),
        F.col("first.paragraph").alias("class_paragraph"), F.col("n_links").cast("long").alias("n_links"),
        ((F.col("doc_id") != F.col("first.doc_id")) | (F.col("paragraph") != F.col("first.paragraph"))).alias("removed"))
