"""Rows that once gave wrong results: odd markup, repeated ids, texts that share a slice, clashing columns."""

import hashlib
import time

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from basketry.llm import html_extract, language_id, quality, warc
from tests.llm.test_llm import documents, prose

ARTICLE = "<html><body><div class='menu'>away</div><article><h1>Title</h1><p>one two three four five.</p>%s<p>last words of it.</p></article></body></html>"


@pytest.mark.parametrize("part, kept", [
    ('<section id="discussion"><p>kept</p></section>', True), ('<h2 id="related-work">kept</h2>', True), ('<div id="search-algorithms">kept</div>', True),
    ('<section id="legal"><p>kept</p></section>', True), ('<h3 class="related">kept</h3>', True), ("<p title=it's>kept</p>", True),
    ("<a href=/x?q=it's>kept</a>", True), ('<p data-x="a>b">kept</p>', True), ("<p title = 'q>r'>kept</p>", True),
    ('<div class="related-posts"><a href=x>kept</a></div>', False), ('<div id="comments">kept</div>', False), ('<div class="share">kept</div>', False),
    ('<aside>kept</aside>', False), ('<div class="newsletter signup">kept</div>', False),
])
def test_what_belongs_to_an_article(part, kept):
    text = html_extract.text_of(html_extract.parse(ARTICLE % part), None)
    assert text == "Title one two three four five. " + "kept " * kept + "last words of it."


def test_many_inline_tags_take_time_in_proportion():
    def seconds(n):
        start = time.perf_counter()
        html_extract.parse("<body><article><p>" + "<b>x</b> " * n + "</p></article>")
        return time.perf_counter() - start

    assert seconds(40_000) < 30 * max(seconds(4_000), 0.01)


def test_extraction_keeps_clashing_columns(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c", ARTICLE % "", "p", "h", 7, "m")],
                                  "page_id long, url string, html string, _path string, host string, path int, markup string")
    row = html_extract.extract(pages).first()
    assert row.text == "Title one two three four five. last words of it."
    assert (row._path, row.host, row.path, row.markup) == ("p", "h", 7, "m")


def test_archives_of_repeated_page_ids(spark):
    a, b = "A" * 120, "B" * 150
    pages = spark.createDataFrame([(1, "u", a, "x"), (1, "u", b, "x"), (2, "u", a, "x"), (3, "u", b, "x")], "page_id long, url string, html string, record_type string")
    found = warc.resolve(warc.read(warc.archive(pages)))
    got = sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found.collect())
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got == sorted([(1, 120, digest(a), "response", None), (1, 150, digest(b), "response", None), (2, 120, digest(a), "revisit", 1),
                          (3, 150, digest(b), "revisit", 1)], key=lambda r: r[:3])


@pytest.fixture(scope="module")
def languages():
    r = np.random.default_rng(3)
    return {lang: ["".join(r.choice(list(letters), r.integers(2, 8))) for _ in range(300)]
            for lang, letters in (("aa", "abcdef"), ("bb", "ghijkl"), ("cc", "mnopqr"))}


def speak(languages, r, *parts):
    return " ".join(w for lang, n in parts for w in r.choice(languages[lang], n))


def test_languages_do_not_depend_on_the_slice(spark, languages):
    r = np.random.default_rng(4)
    train = [(i, speak(languages, r, (lang, 200)), lang) for i, lang in enumerate(["aa", "bb", "cc"] * 10)]
    model = language_id.train(spark.createDataFrame(train, "doc_id long, text string, lang string"))
    texts = [speak(languages, r, *((lang, int(r.integers(1, 120))) for lang in r.permutation(["aa", "bb", "cc"])[:r.integers(1, 4)])) for _ in range(200)]
    together, _ = language_id.mixtures(model, pa.array(texts))
    alone = np.concatenate([language_id.mixtures(model, pa.array([t]))[0] for t in texts])
    assert np.allclose(together, alone, atol=1e-9)


def test_language_stage_keeps_mixed_texts_and_all_columns(spark, languages):
    r = np.random.default_rng(5)
    texts = [speak(languages, r, (lang, 200)) for lang in ["aa", "bb", "cc"] * 10]
    texts += [speak(languages, r, ("aa", 80), ("bb", 60), ("cc", 60)), None, "... 123", ""]
    rows = [(i, t, ["aa", "bb", "cc"][i % 3], "s", 1, 0.5, "mine", "own") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double, languages string, _row string")
    kept = corpus_pipeline.identify_language(spark, docs, "")
    assert kept.columns == docs.columns
    got = {r.doc_id: (r.lang, r.score, r.languages, r._row) for r in kept.collect()}
    assert got == {i: (["aa", "bb", "cc"][i % 3] if i < 30 else "aa", 0.5, "mine", "own") for i in range(31)}


def test_variety_counts_different_grams():
    r = np.random.default_rng(6)
    sizes = np.array([0, 1, 300, 1000, 256])
    grams = r.integers(0, 50, sizes.sum())
    found = quality.varieties(grams, sizes)
    at = 0
    for size, value in zip(sizes.tolist(), found):
        mine = grams[at:at + size]
        at += size
        blocks = max(size // quality.BLOCK, 1)
        parts = [mine[i * quality.BLOCK:(i + 1) * quality.BLOCK if i < blocks - 1 else size] for i in range(blocks)]
        assert value == pytest.approx(min([len(set(p.tolist())) / len(p) for p in parts if len(p)], default=1.0))
    assert len(quality.varieties(np.empty(0, np.int64), np.empty(0, np.int64))) == 0


def test_stages_of_rows_without_or_with_equal_ids(spark, tmp_path):
    base, item = prose(80), prose(40)
    rows = [(None, base), (7, base + " end"), (7, prose(90)), (8, base), (8, base), (None, item), (9, prose(30) + " " + item), (None, prose(60)), (None, None), (10, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0, "r", 1) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, row string, component int")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert got == sorted([r for n, r in enumerate(rows) if n not in (0, 3, 4)], key=str)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    clean = corpus_pipeline.drop_benchmark_leaks(spark, docs, str(tmp_path))
    assert clean.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in clean.collect()), key=str) == sorted([r for n, r in enumerate(rows) if n not in (5, 6)], key=str)


def test_language_stage_of_null_texts(spark):
    assert corpus_pipeline.identify_language(spark, documents(spark, [None, None]), "").count() == 0
