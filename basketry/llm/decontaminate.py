"""Benchmark passages in documents, by SimHash of item-sized windows. DataFrame functions only.

Words are runs of letters and digits in lower case. A window has as many words as an item. With a similarity of at least
0.8 it shares 4/9 of both numbers of shingles at least, so windows are laid at every start of a text from which that many
shingles are an item's, wherever they stand in the item: reordered parts count like others, and no start is left out.
Windows and items get a 64-bit SimHash of their shingles. The fingerprints are cut into ``RADIUS`` + 1 blocks: two within
that Hamming distance agree in one block at least, so a join on size, block number and block value finds all of them.
Candidates within the radius are verified exactly by the weighted Jaccard similarity of their shingles, weights being the
numbers of occurrences.

Windows with a similarity of 0.8 differ in 10 of 64 bits on average, with a standard deviation under 3; a radius of 24
is five deviations away.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import stored

SHINGLE = 5
RADIUS = 24


def words(text: Column) -> Column:
    return F.coalesce(F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != ""), F.array().cast("array<string>"))


def grams(words: Column, size: int) -> Column:
    """64-bit hashes of all runs of ``size`` words, in order."""
    last = F.size(words) - (size - 1)
    runs = F.transform(F.sequence(F.lit(0), last - 1), lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(size))))
    return F.when(last > 0, runs).otherwise(F.array().cast("array<long>"))


def shingles(words: Column) -> Column:
    """Five-word shingles; of a shorter sequence the whole as one."""
    out = grams(words, SHINGLE)
    for size in range(SHINGLE - 1, 0, -1):
        out = F.when(F.size(words) == size, grams(words, size)).otherwise(out)
    return out


def simhash(hashes: Column) -> Column:
    """64 majority bits over the hashes."""
    def bit(b: Column) -> Column:
        votes = F.aggregate(hashes, F.lit(0), lambda sum_, h: sum_ + F.getbit(h, b) * 2 - 1)
        return F.when(votes > 0, F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"), lambda print_, b: print_.bitwiseOR(bit(b)))


def blocks(fingerprint: Column, radius: int = RADIUS) -> Column:
    """radius + 1 structs (number, value) that cut the 64 bits."""
    n = radius + 1
    edges = [64 * i // n for i in range(n + 1)]
    return F.array(*(F.struct(F.lit(i).alias("block"), F.shiftrightunsigned(fingerprint, a).bitwiseAND((1 << (b - a)) - 1).alias("value"))
                     for i, (a, b) in enumerate(zip(edges, edges[1:]))))


def similarity(a: Column, b: Column) -> tuple[Column, Column]:
    """Weighted intersection and union of two arrays taken as multisets."""
    times = lambda array, x: F.size(F.filter(array, lambda y: y == x))
    both = F.aggregate(F.array_intersect(a, b), F.lit(0), lambda sum_, x: sum_ + F.least(times(a, x), times(b, x)))
    return both, F.size(a) + F.size(b) - both


def starts(at: Column, span: Column, need: Column, last: Column) -> Column:
    """Every start from 0 to ``last`` with at least ``need`` of the sorted places ``at`` among the ``span`` places from it on."""
    def run(i: Column) -> Column:
        # The starts for which the i-th place is the first inside; so none comes twice.
        low = F.greatest(F.lit(0), F.get(at, i - 1) + 1, F.get(at, i + need - 1) - span + 1)
        high = F.least(F.get(at, i), last)
        return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))

    runs = F.flatten(F.transform(F.sequence(F.lit(0), F.size(at) - need), run))
    return F.when(F.size(at) >= need, runs).otherwise(F.array().cast("array<int>"))


def leaks(documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
          item: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, item_id, start, n_words, hamming, similarity: every document and item with a window of similarity >= 0.8.

    Of several windows the one most similar, then first, counts; start is its first word (from 0). Items without a word
    (null or empty) match nothing, equal items match alike, and texts without a word have no window. A text shorter than
    the item is one window. Rows with a null id take no part; repeated rows count once; an empty table gives no row.
    """
    items = stored(
        benchmark.select(F.col(item).alias("item_id"), words(F.col(item_text)).alias("w")).where("size(w) > 0 AND item_id IS NOT NULL")
        .select("item_id", F.size("w").alias("n"), shingles(F.col("w")).alias("grams")).distinct()
        .withColumn("fingerprint", simhash(F.col("grams"))), "items")
    seeds = stored(items.select(F.least("n", F.lit(SHINGLE)).alias("size"), "n", F.explode("grams").alias("gram")).distinct(), "seeds")
    # Rows of one id may have different texts, so the digest of the text tells them apart.
    rows = documents.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("digest")).where("doc_id IS NOT NULL")
    texts = rows.select("doc_id", "digest", words(F.col("text")).alias("w"))

    hits = None
    for size in sorted(r["size"] for r in seeds.select("size").distinct().collect()):
        spots = texts.select("doc_id", "digest", F.size("w").alias("length"), F.posexplode(grams(F.col("w"), size)).alias("at", "gram"))
        found = spots.join(seeds.where(F.col("size") == size), "gram")
        hits = found if hits is None else hits.unionByName(found)
    if hits is None:
        hits = texts.select("doc_id", "digest", *(F.lit(0).alias(c) for c in ("length", "at", "gram", "size", "n"))).limit(0)
    span = F.least("n", "length") - F.col("size") + 1
    need = F.ceil((F.col("n") - F.col("size") + 1 + span) * 4 / 9).cast("int")
    places = stored(
        hits.groupBy("doc_id", "digest", "length", "size", "n").agg(F.sort_array(F.collect_set("at")).alias("at")).where(F.size("at") >= need)
        .select("doc_id", "digest", "n", starts(F.col("at"), span, need, F.greatest(F.lit(0), F.col("length") - F.col("n"))).alias("starts"))
        .where("size(starts) > 0"), "places")

    windows = stored(
        rows.join(places, ["doc_id", "digest"]).select("doc_id", words(F.col("text")).alias("w"), "n", "starts")
        .select("doc_id", F.explode(F.transform("starts", lambda s: F.struct(
            s.alias("start"), F.col("n"), shingles(F.slice("w", s + 1, F.col("n"))).alias("grams")))).alias("x"))
        .select("doc_id", "x.*").distinct()
        .select("*", simhash(F.col("grams")).alias("fingerprint"), F.monotonically_increasing_id().alias("window")), "windows")

    index = items.select("item_id", "n", F.col("fingerprint").alias("own"), F.explode(blocks(F.col("fingerprint"))).alias("part")).select(
        "item_id", "n", "own", "part.*")
    near = windows.select("window", "n", "fingerprint", F.explode(blocks(F.col("fingerprint"))).alias("part")).select(
        "window", "n", "fingerprint", "part.*").join(stored(index, "blocks"), ["n", "block", "value"]).select(
        "window", "item_id", F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("own"))).alias("hamming")).where(
        F.col("hamming") <= RADIUS).distinct()
    both, union = similarity(F.col("grams"), F.col("item_grams"))
    verified = windows.join(near, "window").join(items.select("item_id", F.col("grams").alias("item_grams")), "item_id").select(
        "doc_id", "item_id", "start", "n", "hamming", both.alias("both"), union.alias("union")).where("100 * both >= 80 * union")
    best = F.max(F.struct((F.col("both") / F.col("union")).alias("similarity"), (-F.col("start")).alias("before"), "n", "hamming")).alias("best")
    return verified.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", (-F.col("best.before")).alias("start"), F.col("best.n").alias("n_words"),
        F.col("best.hamming").alias("hamming"), F.col("best.similarity").alias("similarity"))
