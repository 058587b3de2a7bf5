"""Repeated runs of words against all windows of 50 words of all texts."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from basketry.llm import byte_bpe, repeated_runs, substring_dedup
from basketry.llm.common import CHUNK_BYTES, MOST_BYTES, ship, sifted, tidy
from tests.llm.test_llm import ODD, edited

rng = random.Random(23)
VOCABULARY = ["".join(rng.choice("abcdefghijklmno") for _ in range(rng.randint(2, 9))) for _ in range(4000)]


def prose(n):
    return [rng.choice(VOCABULARY) for _ in range(n)]


def laid_out(words):
    """Words with line breaks and capitals anywhere."""
    return "".join((w.upper() if rng.random() < 0.1 else w) + rng.choice([" ", " ", " ", "  ", "\n", "\t"]) for w in words)


def words_of(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()


def covered(texts):
    """Words in a window of 50 that stands elsewhere too, and those in one that stands before; by (row, word)."""
    first, again = {}, set()
    windows = [(row, i, tuple(w[i:i + 50])) for row, w in enumerate(map(words_of, texts)) for i in range(len(w) - 49)]
    for row, i, window in windows:
        if first.setdefault(window, (row, i)) != (row, i):
            again.add(window)
    inside = lambda keep: {(row, i + k) for row, i, w in windows if w in again and keep(row, i, w) for k in range(50)}
    return inside(lambda *_: True), inside(lambda row, i, w: first[w] != (row, i))


def frame(spark, texts, ids=None):
    rows = [(i, t, "x", 0) for i, t in zip(range(len(texts)) if ids is None else ids, texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, id string, _gone int")


def corpus():
    passages = [prose(n) for n in (50, 51, 55, 64, 90, 140, 400)]
    short = [prose(n) for n in (30, 40, 49)]
    texts = []
    for _ in range(90):
        parts = []
        for _ in range(rng.randint(0, 3)):
            parts += [prose(rng.randint(0, 80)), rng.choice(passages + short)]
        texts.append(laid_out(sum(parts, []) + prose(rng.randint(0, 60))))
    shared = prose(300)
    texts += [laid_out(prose(20) + shared[a:a + 120] + prose(20)) for a in (0, 60, 100, 180)]
    return texts + ["\n".join(" ".join(passages[3][i:i + 9]) for i in range(0, 64, 9))] * 3 + ODD


def test_runs_equal_all_windows_of_all_texts(spark):
    texts = corpus()
    found = repeated_runs.find(frame(spark, texts)).collect()
    whole, later = covered(texts)
    spread = lambda rows: {(r.doc_id, r.first_word + k) for r in rows for k in range(r.n_words)}
    # A run that overlaps its own copy is found as the copy; its first words may have no row.
    same = next(i for i, t in enumerate(texts) if t and t.startswith("same same"))
    assert {x for x in spread(found) if x[0] != same} == {x for x in whole if x[0] != same}
    assert spread(r for r in found if r.removed) == later
    for r in found:
        a, b = words_of(texts[r.doc_id]), words_of(texts[r.class_doc_id])
        assert a[r.first_word:r.first_word + r.n_words] == b[r.class_first_word:r.class_first_word + r.n_words]
        assert r.removed == ((r.class_doc_id, r.class_first_word) < (r.doc_id, r.first_word))


def test_cutting_leaves_the_first_copy_alone(spark):
    texts = corpus()
    docs = frame(spark, texts)
    _, later = covered(texts)
    cut = repeated_runs.remove(docs, repeated_runs.find(docs))
    assert cut.columns == [*docs.columns, "_removed"]
    for r in cut.collect():
        kept = [w for i, w in enumerate(words_of(texts[r.doc_id])) if (r.doc_id, i) not in later]
        assert words_of(r.text) == kept and (r.text == texts[r.doc_id] or r._removed)
    assert repeated_runs.find(cut).where("removed").isEmpty()


def test_repeated_and_missing_ids(spark):
    passage, own = prose(60), prose(70)
    texts = [laid_out(prose(5) + passage), laid_out(own), laid_out(prose(9) + passage), laid_out(prose(3) + passage + prose(2))]
    docs = frame(spark, texts, [5, 7, 7, None])
    found = repeated_runs.find(docs)
    assert {(r.doc_id, r.class_doc_id, r.removed) for r in found.collect()} == {(5, None, False), (7, 5, True), (None, 5, True)}
    left = {(r.doc_id, len(words_of(r.text))) for r in repeated_runs.remove(docs, found).collect()}
    assert left == {(5, 65), (7, 70), (7, 9), (None, 5)}


def test_lines_of_equal_ids_are_told_apart(spark):
    line, own = " ".join(prose(60)), " ".join(prose(60))
    texts = [line, edited(line, 1) + "\nend", own]
    docs = frame(spark, texts, [1, 5, 5])
    left = {(r.doc_id, r.text) for r in repeated_runs.remove(docs, lines=substring_dedup.repeated(docs)).collect()}
    assert left == {(1, line), (5, "end"), (5, own)}


def test_a_run_inside_one_text_and_lines_cut_together(spark):
    run, line = prose(80), " ".join(prose(60))
    texts = [laid_out(run) + laid_out(prose(3)) + laid_out(run), line, "a\n" + line, line + "\nb", line]
    docs = frame(spark, texts)
    found = repeated_runs.remove(docs, repeated_runs.find(docs), substring_dedup.repeated(docs)).collect()
    left = {r.doc_id: r.text for r in found}
    assert len(words_of(left[0])) == 83
    assert left[1] == line and left[2].strip() == "a" and left[3].strip() == "b" and left[4] == ""


def test_short_and_empty_tables(spark):
    docs = frame(spark, ODD + [" ".join(prose(49))] * 5)
    short = [r for r in repeated_runs.find(docs).collect() if r.doc_id >= len(ODD)]
    assert short == [] and repeated_runs.find(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        repeated_runs.find(docs, min_words=20)


def test_long_runs_of_one_word(spark):
    docs = frame(spark, ["same " * 3000, "x " + "same " * 200])
    left = {r.doc_id: len(words_of(r.text)) for r in repeated_runs.remove(docs, repeated_runs.find(docs)).collect()}
    assert left[1] == 1 and 1 <= left[0] <= 50


def shuffled_rows(node):
    """Rows that the shuffles of an executed plan wrote."""
    kind = node.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return shuffled_rows(node.executedPlan())
    if kind.endswith("QueryStageExec"):
        return shuffled_rows(node.plan())
    own = node.metrics().apply("shuffleRecordsWritten").value() if kind == "ShuffleExchangeExec" else 0
    return own + sum(shuffled_rows(node.children().apply(i)) for i in range(node.children().size()))


def test_texts_that_meet_nothing_are_not_shuffled(spark):
    texts = [laid_out(prose(60)) for _ in range(600)]
    texts += [texts[7] + " more", texts[8] + " more"]
    docs = frame(spark, texts)
    runs = repeated_runs.find(docs)
    before = {name: spark.conf.get(name) for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    try:
        for name in before:
            spark.conf.set(name, "-1")
        cut = repeated_runs.remove(docs, runs)
        assert cut.where("_removed > 0").count() == 2
        assert len(cut.collect()) == len(texts)
        assert shuffled_rows(cut._jdf.queryExecution().executedPlan()) < 100
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_a_sift_lets_all_partners_through_and_few_others(spark):
    docs = spark.range(3000).select(F.when(F.col("id") > 0, F.col("id")).alias("id"), F.lit("text").alias("text"))
    found = docs.where("id IS NULL OR id % 50 = 0")
    wanted = {r.id for r in found.collect()}
    kept = {r.id for r in sifted(docs, ["id"], found, ["id"]).where("_maybe").collect()}
    assert None in kept and wanted <= kept and len(kept) < 600
    assert sifted(docs, ["id"], docs.limit(0), ["id"]).where("_maybe").isEmpty()


def test_a_worker_drops_what_it_kept_for_another_job():
    byte_bpe._memory.cache_clear()
    kept = byte_bpe._memory("ranks")
    assert list(tidy(lambda batches: batches, byte_bpe.JOB)([1])) == [1]
    assert byte_bpe._memory("ranks") is kept
    assert list(tidy(lambda batches: batches)([2])) == [2]
    assert byte_bpe._memory.cache_info().currsize == 0


def test_texts_are_cut_slice_by_slice():
    n = 3 * CHUNK_BYTES // 1000
    texts = pa.array([None if i % 5 == 0 else "a b c\n" + "x" * 1000 for i in range(n)])
    lines = pa.array([[1] if i % 5 == 1 else None for i in range(n)], pa.list_(pa.int32()))
    run = pa.list_(pa.struct({"first_word": pa.int32(), "n_words": pa.int32()}))
    runs = pa.array([[{"first_word": 0, "n_words": 2}] if i % 5 else None for i in range(n)], run)
    parts = list(repeated_runs._cut(iter([(texts, lines, runs), (texts.slice(0, 0), lines.slice(0, 0), runs.slice(0, 0))])))
    assert [len(p) for p in parts] == [n, 0]
    whole = "c\n" + "x" * 1000
    assert parts[0].to_pylist() == [None if i % 5 == 0 else "c" if i % 5 == 1 else whole for i in range(n)]


def test_stages_with_a_filter_send_each_text_to_python_once(spark, tmp_path, capsys):
    """Else two workers a core score or cut the same texts, and stay for all stages that follow."""
    rows = [(i, " ".join(prose(60)) + ("\n" + " ".join(VOCABULARY[:60])), "en", "web", 0) for i in range(6)] + [(9, "12 34", "en", "web", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    left = {"language": 6, "passages": 7}
    for name, stage in corpus_pipeline.STAGES:
        if name in left:
            found = stage(spark, docs, str(tmp_path))
            capsys.readouterr()
            found.explain()
            assert capsys.readouterr().out.count("ArrowEvalPython") == 1, name
            assert found.count() == left[name]


def test_batches_of_long_rows_are_bounded_by_bytes(spark):
    ship(spark)
    long = spark.range(0, 80, 1, 1).select(F.repeat(F.lit("x"), F.when(F.col("id") == 40, 5 * MOST_BYTES).otherwise(100_000)).alias("text"))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"rows": [len(batch)], "size": [batch.nbytes]}, pa.schema([("rows", pa.int64()), ("size", pa.int64())]))

    found = long.mapInArrow(sizes, "rows long, size long").collect()
    assert sum(r["rows"] for r in found) == 80
    assert sorted(r["size"] for r in found)[-2] <= MOST_BYTES + 200_000
    assert max(r["size"] for r in found) <= 6 * MOST_BYTES + 200_000
