"""Language identification as inference of a mixture of languages.

Training counts hashed byte 4-grams per language over all labelled documents (one pass, summed per task and then
over tasks; the model has at most languages x ``BUCKETS`` numbers, however large the corpus). A text is cut at
white space into segments of about ``SEGMENT`` bytes, each with a log-likelihood per language. Expectation-
maximisation finds the proportions of the languages over the segments of a document; of the sets made of its one,
two, three ... largest languages the one with the highest penalised likelihood counts. All documents of a chunk
go through the iterations together.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import flat_bytes, text_slices, tidy, without

BUCKETS = 1 << 16
SEGMENT = 48
ROUNDS = 12
# Log-likelihood that another language must gain, per logarithm of the number of segments, to join the set.
PENALTY = 6.0
MAX_LANGUAGES = 256


class Model(NamedTuple):
    languages: list[str]
    log_p: np.ndarray  # BUCKETS x languages


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A bucket per byte position: that byte and the three before it, A-Z lower-cased, other ASCII signs and digits as blanks.

    Before a text, which starts at one of ``offsets``, there are blanks.
    """
    low = np.where((data >= 0x41) & (data <= 0x5A), data | 0x20, data)
    low = np.where((low < 0x61) | ((low > 0x7A) & (low < 0x80)), 0x20, low).astype(np.uint32)
    code = low.copy()
    starts, sizes = offsets[:-1], np.diff(offsets)
    for i, factor in ((1, 0x9E3779B1), (2, 0x85EBCA77), (3, 0xC2B2AE3D)):
        before = np.full(len(low), 0x20, np.uint32)
        before[i:] = low[:-i]
        for j in range(i):
            before[starts[sizes > j] + j] = 0x20
        code += before * np.uint32(factor)
    code *= np.uint32(0x27D4EB2F)
    return (code >> np.uint32(16)).astype(np.int64), low


def train(df: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Smoothed 4-gram probabilities of each language in ``lang``; rows with a null text or language are skipped.

    More than ``MAX_LANGUAGES`` labels are an error, so that the model's size is bounded. Without any row the model
    has no languages.
    """
    rows = df.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text")).dropna()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            labels, texts = np.array(batch.column(0).to_pylist(), object), batch.column(1)
            for label in dict.fromkeys(labels):
                own = texts.filter(pa.array(labels == label))
                total = sums.setdefault(label, np.zeros(BUCKETS, np.int64))
                if len(sums) > MAX_LANGUAGES:
                    raise ValueError("too many languages")
                for start, stop in text_slices(own):
                    data, offsets = flat_bytes(own.slice(start, stop - start))
                    total += np.bincount(grams(data, offsets)[0], minlength=BUCKETS)
        for label, total in sums.items():
            bucket = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([label] * len(bucket)), pa.array(bucket), pa.array(total[bucket])], names=["lang", "bucket", "n"])

    counts = rows.mapInArrow(tidy(count), "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = counts.toPandas()
    languages = sorted(found["lang"].unique())
    table = np.zeros((BUCKETS, len(languages)))
    for i, label in enumerate(languages):
        own = found[found["lang"] == label]
        table[own["bucket"].to_numpy(), i] = own["n"].to_numpy()
    if languages:
        table += 0.05
        table = np.log(table / table.sum(axis=0))
    return Model(languages, table.astype(np.float32))


def mixtures(model: Model, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Proportions of the languages (documents x languages) and whether a text has a letter at all."""
    n = len(texts)
    data, offsets = flat_bytes(texts)
    codes, low = grams(data, offsets)
    blank = low == 0x20
    letters = np.add.reduceat(np.append(~blank, False).astype(np.int64), offsets[:-1]) > 0 if n else np.zeros(0, bool)
    # Segments begin at texts and at the first blank after every SEGMENT bytes of a text.
    cell = (np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets))) // SEGMENT
    cell += np.repeat(np.arange(n) << 40, np.diff(offsets))
    spaces = np.flatnonzero(blank)
    first = np.flatnonzero(np.diff(cell[spaces], prepend=-1) != 0)
    starts = np.union1d(spaces[first], offsets[:-1])
    # Positions without a letter say nothing.
    weight = np.where(blank, np.float32(0), np.float32(1))
    likelihood = np.stack(
        [np.add.reduceat(model.log_p[:, i][codes] * weight, starts, dtype=np.float64) for i in range(len(model.languages))], axis=1)
    document = np.searchsorted(offsets, starts, side="right") - 1
    first_of = np.searchsorted(starts, offsets[:-1])
    segments = np.diff(np.append(first_of, len(starts)))
    scaled = np.exp(np.maximum(likelihood - likelihood.max(axis=1, keepdims=True), -60))

    def fit(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        share = mask / mask.sum(axis=1, keepdims=True)
        for _ in range(ROUNDS):
            joint = scaled * share[document]
            joint /= np.maximum(joint.sum(axis=1, keepdims=True), 1e-300)
            share = np.add.reduceat(joint, first_of) / segments[:, None]
        fitted = np.log(np.maximum((scaled * share[document]).sum(axis=1), 1e-300))
        return share, np.add.reduceat(fitted, first_of)

    full, _ = fit(np.ones((n, len(model.languages))))
    # Ties go to the language that explains the whole text better, then to the first by name.
    total = np.add.reduceat(likelihood, first_of)
    order = np.lexsort((np.broadcast_to(np.arange(full.shape[1]), full.shape), -total, -full.round(9)), axis=1)
    best = np.full(n, -np.inf)
    chosen = np.zeros_like(full)
    # Each document stops at the first set that is no better, whatever the others of its slice do.
    growing = np.ones(n, bool)
    for size in range(1, full.shape[1] + 1):
        mask = np.zeros_like(full)
        np.put_along_axis(mask, order[:, :size], 1.0, axis=1)
        share, fitted = fit(mask)
        penalised = fitted - PENALTY * (size - 1) * (1 + np.log(segments))
        better = growing & (penalised > best + 1e-9)
        best[better], chosen[better] = penalised[better], share[better]
        growing = better
        if not growing.any():
            break
    return chosen, letters


def has_letter(text: str | None) -> bool:
    return bool(text) and any(c.isalpha() for c in text)


def identify(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` with lang_pred (the language with the largest proportion), score (that proportion) and languages.

    languages maps each language of the selected set to its proportion. A text that is null or has no letter, and
    every text if the model has no language, gets ``und``, score 0 and an empty map. Texts are read whole; repeated
    rows get equal results; an empty table stays empty. Columns of those names are replaced.
    """
    df = without(df, "lang_pred", "score", "languages")
    shared = df.sparkSession.sparkContext.broadcast(model)
    added = "lang_pred string, score double, languages map<string,double>"

    @F.pandas_udf(added)
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        yield from tidy(score)(batches)

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for batch in batches:
            texts = pa.array(batch.astype(object).where(batch.notna(), None), pa.large_string())
            out = []
            for start, stop in text_slices(texts):
                part = texts.slice(start, stop - start)
                if not model.languages:
                    out += [("und", 0.0, {})] * len(part)
                    continue
                shares, _ = mixtures(model, part)
                for value, row in zip(part.to_pylist(), shares):
                    if not has_letter(value):
                        out.append(("und", 0.0, {}))
                        continue
                    top = int(np.argmax(row))
                    out.append((model.languages[top], float(min(row[top], 1.0)),
                                {model.languages[i]: float(row[i]) for i in np.flatnonzero(row > 1e-6)}))
            yield pd.DataFrame(out, columns=["lang_pred", "score", "languages"])

    # Not deterministic for Spark alone: else a filter on the result is pushed below and each text is scored a second time.
    return df.withColumn("_found", predict.asNondeterministic()(F.col(text))).select(*[F.col(f"`{c}`") for c in df.columns], "_found.*")
