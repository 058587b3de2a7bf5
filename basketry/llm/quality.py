"""Text quality by an interpolated modified Kneser-Ney model of trusted text.

The model is one of bytes (A-Z lower-cased, white space as blanks, digits alike), of order ``ORDER``; a gram of k bytes
is a whole number, so the context of a gram is a shift and its suffix a mask. Training counts the highest order over all
trusted texts; lower orders count the different bytes before a gram. Per order, grams are joined to the statistics of their
context and to the probabilities of their suffix; both joins are dealt by number and none has more than 256
rows of a key. The result, a table (gram, log_p, back_off) per order, is stored in shards by range of the gram.

Scoring cuts texts into slices, looks the different grams of a slice up shard by shard (longest order first, with
back-off for unseen ones) and sums per document. A shard has at most ``SHARD_ROWS`` rows, and a worker holds one
shard and one slice at a time beyond the rows of ``KEPT`` shards it remembers, so memory is bounded whatever the corpus.

Texts are dealt to two folds by their hash, and each is scored by the model of the other fold's trusted texts, so no text
is judged by a model that has seen it or an exact copy. The limits are quantiles of the trusted texts' scores made that
way. Text of repeated words is no less probable than other text to a model with so short a context; it is told by its
variety, the least share of different grams in a block of ``BLOCK`` places, which has a lower quantile as its limit.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow.fs import FileSelector, FileSystem
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import stored, text_slices, tidy, without
from basketry.session import work_dir

ORDER = 5
SHARD_ROWS = 1_000_000
KEPT = 6
FLUSH = 4 << 20
QUANTILE = 0.99
BLOCK = 256
FOLDS = 2


class Model(NamedTuple):
    folders: list[str]  # one per order, from 1; empty without trusted text


def _codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The ORDER-gram that ends at every byte of every text, with line feeds before a text, and the number of bytes per text."""
    pad = b"\n" * (ORDER - 1)
    data = np.frombuffer(pad + pad.join(texts) if texts else b"", np.uint8)
    low = np.where((data >= 0x41) & (data <= 0x5A), data | 0x20, data)
    low = np.where((low >= 0x30) & (low <= 0x39), 0x30, low)
    # Line feeds of a text are blanks like all white space; only the padding stands for a beginning.
    low = np.where((low == 0x20) | ((low >= 0x09) & (low <= 0x0D)), 0x20, low)
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(sizes + ORDER - 1) - sizes
    inside = np.ones(len(data), bool)
    for k in range(1, ORDER):
        inside[starts - k] = False
    low = np.where(inside, low, 0x0A).astype(np.uint64)
    code = np.zeros(len(low), np.uint64)
    for k in range(ORDER):
        code[k:] |= low[:len(low) - k] << np.uint64(8 * k)
    return code[inside].astype(np.int64), sizes


def _slices(column: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, list[bytes]]]:
    for start, stop in text_slices(column, limit):
        yield start, [t or b"" for t in column.slice(start, stop - start).cast(pa.binary()).to_pylist()]


def _counts(texts: DataFrame) -> DataFrame:
    """(gram, c) of the highest order, added up within each task first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, counts = np.empty(0, np.int64), np.empty(0, np.int64)

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(grams), pa.array(counts)], names=["gram", "c"])

        for rows in batches:
            for _, part in _slices(rows.column(0)):
                new, n = np.unique(_codes(part)[0], return_counts=True)
                every, back = np.unique(np.concatenate((grams, new)), return_inverse=True)
                sums = np.bincount(back, weights=np.concatenate((counts, n)), minlength=len(every)).astype(np.int64)
                grams, counts = every, sums
                if len(grams) > FLUSH:
                    yield batch()
                    grams, counts = np.empty(0, np.int64), np.empty(0, np.int64)
        yield batch()

    return texts.mapInArrow(tidy(run), "gram long, c long").groupBy("gram").agg(F.sum("c").alias("c"))


def discounts(counts: dict[int, int]) -> list[float]:
    """D1, D2 and D3+ from the numbers of grams that occur once to four times."""
    n = [0.0] + [float(counts.get(k, 0)) for k in range(1, 5)]
    if not (n[1] and n[2]):
        return [0.5, 0.5, 0.5]
    y = n[1] / (n[1] + 2 * n[2])
    raw = [k - (k + 1) * y * n[k + 1] / n[k] if n[k] else 0.5 for k in (1, 2, 3)]
    return [min(max(d, 0.01), k - 0.01) for k, d in zip((1, 2, 3), raw)]


def train(trusted: DataFrame, text: str = "text") -> Model:
    """Model of all non-empty texts of ``trusted``; null and empty ones are skipped."""
    spark = trusted.sparkSession
    folder = work_dir(spark, "language-model")

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    texts = trusted.select(F.col(text).cast("string").alias("text")).where("length(text) > 0")
    counts = {ORDER: kept(_counts(texts), "counts")}
    for k in range(ORDER - 1, 0, -1):
        # Continuation counts: how many different bytes stand before a gram.
        counts[k] = kept(counts[k + 1].groupBy(F.col("gram").bitwiseAND((1 << 8 * k) - 1).alias("gram"))
                         .agg(F.count(F.lit(1)).alias("c")), f"counts-{k}")
    if counts[1].isEmpty():
        return Model([])
    folders, below = [], None
    for k in range(1, ORDER + 1):
        seen = {r["c"]: r["n"] for r in counts[k].where("c <= 4").groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect()}
        d = discounts(seen)
        cut = F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2])
        context = F.shiftright("gram", 8)
        rows = counts[k].select("gram", "c", cut.alias("cut"), context.alias("context"))
        totals = kept(rows.groupBy("context").agg(F.sum("c").alias("total"), F.sum("cut").alias("mass")), f"contexts-{k}")
        shares = rows.join(totals, "context").select(
            "gram", "context", ((F.col("c") - F.col("cut")) / F.col("total")).alias("own"), (F.col("mass") / F.col("total")).alias("left"))
        if below is None:
            found = shares.withColumn("p", F.col("own") + F.col("left") / 256)
        else:
            lower = below.select(F.col("gram").alias("suffix"), F.col("p").alias("lower"))
            found = shares.withColumn("suffix", F.col("gram").bitwiseAND((1 << 8 * (k - 1)) - 1)).join(lower, "suffix").withColumn(
                "p", F.col("own") + F.col("left") * F.col("lower"))
        below = kept(found.select("gram", "p"), f"p-{k}")
        backs = totals.select(F.col("context").alias("gram"), F.log(F.col("mass") / F.col("total")).alias("back_off"))
        if k > 1:
            # The weight of a context stands with the gram of the order below.
            folders.append(_shards(previous.join(backs, "gram", "full"), f"{folder}/model-{k - 1}"))
        previous = below.select("gram", F.log("p").alias("log_p"))
    folders.append(_shards(previous.withColumn("back_off", F.lit(None).cast("double")), f"{folder}/model-{ORDER}"))
    return Model(folders)


def _shards(rows: DataFrame, folder: str) -> str:
    """Sorted shards by range of the gram; grams that only begin texts have no probability of their own."""
    rows = rows.select("gram", F.coalesce("log_p", F.lit(float("nan"))).alias("log_p"), F.coalesce("back_off", F.lit(0.0)).alias("back_off"))
    n = rows.count() // SHARD_ROWS + 1
    rows.repartitionByRange(n, "gram").sortWithinPartitions("gram").write.parquet(folder)
    return folder


@functools.lru_cache(maxsize=64)
def _files(folder: str) -> list[str]:
    system, at = FileSystem.from_uri(folder)
    return sorted(f.path for f in system.get_file_info(FileSelector(at)) if f.path.endswith(".parquet"))


_shards_read: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}


def _shard(folder: str, path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A shard's columns. A worker remembers shards of ``KEPT`` times ``SHARD_ROWS`` rows in all, the last ones used."""
    rows = _shards_read.pop(path, None)
    if rows is None:
        system, _ = FileSystem.from_uri(folder)
        found = pq.read_table(path, filesystem=system)
        rows = tuple(found.column(c).to_numpy() for c in ("gram", "log_p", "back_off"))
        kept = len(rows[0]) + sum(len(r[0]) for r in _shards_read.values())
        for oldest in list(_shards_read):
            if kept <= KEPT * SHARD_ROWS:
                break
            kept -= len(_shards_read.pop(oldest)[0])
    _shards_read[path] = rows
    return rows


def _look_up(folder: str, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """log_p (nan if unseen) and back_off (0 if unseen) of sorted grams, shard by shard."""
    log_p, back_off = np.full(len(grams), np.nan), np.zeros(len(grams))
    for path in _files(folder):
        keys, p, b = _shard(folder, path)
        if len(keys):
            lo, hi = np.searchsorted(grams, [keys[0], keys[-1] + 1])
            if lo < hi:
                at = np.minimum(np.searchsorted(keys, grams[lo:hi]), len(keys) - 1)
                hit = keys[at] == grams[lo:hi]
                log_p[lo:hi][hit], back_off[lo:hi][hit] = p[at[hit]], b[at[hit]]
    return log_p, back_off


def log_probabilities(model: Model, grams: np.ndarray) -> np.ndarray:
    """Log-probability of the last byte of each ORDER-gram."""
    out, weight = np.full(len(grams), np.nan), np.zeros(len(grams))
    open_ = np.arange(len(grams))
    for k in range(ORDER, 0, -1):
        if not len(open_):
            return out
        keys, back = np.unique(grams[open_] & ((1 << 8 * k) - 1), return_inverse=True)
        found = _look_up(model.folders[k - 1], keys)[0][back]
        seen = ~np.isnan(found)
        out[open_[seen]] = weight[open_[seen]] + found[seen]
        open_ = open_[~seen]
        if k > 1 and len(open_):
            contexts, back = np.unique((grams[open_] & ((1 << 8 * k) - 1)) >> 8, return_inverse=True)
            weight[open_] += _look_up(model.folders[k - 2], contexts)[1][back]
    # Bytes that trusted text never has: what is left of the unigrams, spread over all byte values.
    out[open_] = weight[open_] - np.log(256.0) - 3.0
    return out


def varieties(grams: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Per text the least share of different grams in its blocks of ``BLOCK`` places; what is left over at its end counts with
    the block before as one longer block. ``grams`` are numbers from 0, one per place; a text without any has 1."""
    blocks = np.maximum(sizes // BLOCK, 1)
    first = np.cumsum(blocks) - blocks
    place = np.arange(len(grams)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    block = np.repeat(first, sizes) + np.minimum(place // BLOCK, np.repeat(blocks - 1, sizes))
    length = np.bincount(block, minlength=int(blocks.sum()))
    # Sorted and compared with their neighbours; np.unique hashes, which takes ten times as long.
    pairs = np.sort(block << 32 | grams)
    new = np.concatenate(([True], pairs[1:] != pairs[:-1])) if len(pairs) else np.empty(0, bool)
    different = np.bincount(pairs[new] >> 32, minlength=len(length))
    shares = np.where(length > 0, different / np.maximum(length, 1), 1.0)
    return np.minimum.reduceat(shares, first) if len(sizes) else np.empty(0)


def scores(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` with perplexity, as ``perplexity`` gives it, and variety (null where the perplexity is)."""
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out, variety = np.full(len(batch), np.nan), np.full(len(batch), np.nan)
            if model.folders:
                texts = pa.array(batch.astype(object).where(batch.notna(), None), pa.large_string()).cast(pa.large_binary())
                for start, part in _slices(texts):
                    codes, sizes = _codes(part)
                    grams, back = np.unique(codes, return_inverse=True)
                    logs = log_probabilities(model, grams)[back]
                    sums = np.diff(np.concatenate(([0.0], np.cumsum(logs)))[np.concatenate(([0], np.cumsum(sizes)))])
                    out[start:start + len(part)] = np.where(sizes > 0, np.exp(-sums / np.maximum(sizes, 1)), np.nan)
                    variety[start:start + len(part)] = np.where(sizes > 0, varieties(back, sizes), np.nan)
            yield pd.DataFrame({name: pd.Series([None if np.isnan(x) else float(x) for x in column], dtype=object)
                                for name, column in (("perplexity", out), ("variety", variety))})

    @F.pandas_udf("perplexity double, variety double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        yield from tidy(judge)(batches)

    rest = without(df, "perplexity", "variety")
    return rest.withColumn("_score", score(F.col(text))).select(*(F.col(f"`{c}`") for c in rest.columns), "_score.*")


def perplexity(df: DataFrame, model: Model, text: str = "text", to: str = "perplexity") -> DataFrame:
    """``df`` with the perplexity per byte of ``text``; null for null and empty texts and without trusted text.

    Whole texts are scored; repeated rows get equal values, an empty table stays empty, a column ``to`` is replaced.
    """
    rest = without(df, to)
    found = scores(rest.select(F.struct(*(F.col(f"`{c}`") for c in rest.columns)).alias("_row"), F.col(text)), model, text)
    return found.select("_row.*", F.col("perplexity").alias(to))


def thresholds(scored: DataFrame, trusted: DataFrame, lang: str = "lang", key: str = "doc_id", quantile: float = QUANTILE) -> DataFrame:
    """lang, limit, least_variety: of the trusted documents of each language, the ``quantile`` of the perplexities and the
    variety that as few fall below as exceed the limit."""
    own = scored.join(trusted.select(F.col(key)).distinct(), key, "left_semi")
    return own.groupBy(F.coalesce(F.col(lang), F.lit("und")).alias("lang")).agg(
        F.percentile_approx("perplexity", quantile, 10_000).alias("limit"),
        F.percentile_approx("variety", 1 - quantile, 10_000).alias("least_variety"))


def classify(df: DataFrame, trusted: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
             quantile: float = QUANTILE) -> DataFrame:
    """``df`` with perplexity, variety, limit and least_variety (of the document's language) and good.

    ``trusted`` holds ids of ``df``. A language without trusted documents takes the widest limits of all; a null language counts as one of its
    own. good is true if the perplexity is at most the limit and the variety at least the least one, false if not or if the text is null or
    empty; without any trusted text nothing is judged and all of them are null. If all trusted texts fall into one fold, their
    one model scores all documents.
    """
    df = without(df, "perplexity", "variety", "limit", "least_variety", "good")
    fold = F.pmod(F.xxhash64(F.col(text)), F.lit(FOLDS))
    # Never broadcast: the ids grow with the labels, and the join should run alike at every size.
    ids = trusted.select(key).distinct().hint("merge")
    models = [train(df.select(key, text).where(fold != k).join(ids, key, "left_semi"), text) for k in range(FOLDS)]
    models = [m if m.folders else next((o for o in models if o.folders), m) for m in models]
    parts = [scores(df.select(key, lang, text).where(fold == k), m, text).drop(text) for k, m in enumerate(models)]
    scored = stored(functools.reduce(DataFrame.unionByName, parts), "perplexities")
    limits = stored(thresholds(scored, trusted, lang, key, quantile), "limits")
    highest, least = limits.agg(F.max("limit"), F.min("least_variety")).first()
    judged = scored.select("*", F.coalesce(F.col(lang), F.lit("und")).alias("_lang")).join(
        limits.withColumnRenamed("lang", "_lang"), "_lang", "left").withColumns({
            "limit": F.coalesce("limit", F.lit(highest).cast("double")),
            "least_variety": F.coalesce("least_variety", F.lit(least).cast("double"))})
    fits = (F.col("perplexity") <= F.col("limit")) & (F.col("variety") >= F.col("least_variety"))
    return judged.drop("_lang").withColumn("good", F.when(F.col("limit").isNotNull(), F.coalesce(fits, F.lit(False))))
