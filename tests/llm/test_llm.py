"""Every operator against brute force or the public library, and the cases that rows can bring."""

import base64
import hashlib
import itertools
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from basketry.llm import (byte_bpe, common, decontaminate, html_extract, language_id, ngram_join, quality, repeated_runs, set_links, substring_dedup,
                          token_counts, voronoi_knn, warc)
from basketry.llm.components import components
from basketry.sources import paths

rng = random.Random(7)
VOCABULARY = ["".join(rng.choice("abcdefghijklmno") for _ in range(rng.randint(2, 9))) for _ in range(400)]
ODD = [None, "", "   \n\t ", "one", "one two three four", "a" * 5000, "x　y\x85z", "日本語 テキスト。é ñ 😀", " ".join(["same"] * 400)]


def prose(n, r=rng):
    return " ".join(r.choice(VOCABULARY) for _ in range(n))


def edited(text, changes, r=rng):
    words = text.split(" ")
    for _ in range(changes):
        words[r.randrange(len(words))] = r.choice(VOCABULARY)
    return " ".join(words)


def documents(spark, texts, first=0):
    rows = [(i, t, "en", "s", 0 if t is None else len(t), "clash") for i, t in enumerate(texts, first)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n string")


def shingles(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = lower.encode().split()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def reached(sets):
    """Smallest key that links lead to, and the number of different linked sets."""
    keys = sorted(sets)
    least = {k: k for k in keys}

    def root(k):
        while least[k] != k:
            k = least[k]
        return k

    linked = {k: set() for k in keys}
    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                least[y] = x
                if sets[a] != sets[b]:
                    linked[a].add(frozenset(sets[b]))
                    linked[b].add(frozenset(sets[a]))
    return {k: (root(k), len(linked[k])) for k in keys}


def near_copies():
    base = prose(120)
    texts = [base, base, base.upper()] + [edited(base, rng.randint(1, 4)) for _ in range(40)]
    texts += [" ".join(base.split(" ")[k:]) for k in range(0, 40, 4)] + [prose(rng.randint(1, 80)) for _ in range(30)]
    return texts + ["a b c d e", "a b c d", "a b c d e f", "a b c d e f g h", "a b c d e f g h i"] + ODD + ODD


def test_ngram_join_equals_brute_force(spark):
    texts = near_copies()
    got = {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in ngram_join.component_rows(documents(spark, texts)).collect()}
    sets = {i: shingles(t) for i, t in enumerate(texts)}
    want = reached(sets)
    assert got == {i: (len(sets[i]), *want[i]) for i in sets}


def test_ngram_join_of_nothing_and_of_rows_without_ids(spark):
    assert ngram_join.component_rows(documents(spark, ["x"]).limit(0)).count() == 0
    rows = spark.createDataFrame([(None, prose(9)), (1, "a b"), (1, "a b"), (2, "a b")], "doc_id long, text string")
    got = [(r.doc_id, r.component_id) for r in ngram_join.component_rows(rows).orderBy("doc_id").collect()]
    assert got == [(None, None), (1, 1), (1, 1), (2, 1)]


@pytest.mark.parametrize("across", [False, True])
def test_prefix_tree_finds_all_links(across):
    r = np.random.default_rng(3)
    base = r.integers(0, 2**62, 60)
    sets = [np.unique(np.concatenate((r.choice(base, r.integers(40, 60), replace=False), r.integers(0, 2**62, r.integers(0, 6))))) for _ in range(60)]
    sets += [sets[0], np.empty(0, np.int64), base[:1].copy()]
    sides = np.arange(len(sets)) % 2 if across else None
    want = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if len(sets[i]) and (not across or sides[i] != sides[j])
            and 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))}
    assert set(set_links.links(sets, sides)) == want


def test_large_clusters_are_dealt_to_blocks_that_hold_every_pair(spark, monkeypatch):
    monkeypatch.setattr(set_links, "BLOCK", 8)
    texts = [edited(t, rng.randint(0, 3)) for t in [prose(60)] * 50] + [prose(20) for _ in range(5)]
    got = {r.doc_id: (r.component_id, r.n_links) for r in ngram_join.component_rows(documents(spark, texts)).collect()}
    assert got == reached({i: shingles(t) for i, t in enumerate(texts)})


def test_large_clusters_are_sent_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(set_links, "BLOCK", 8)
    r = random.Random(11)
    texts = [edited(t, r.randint(0, 2), r) for t in [prose(60, r)] * 60] + [prose(20, r) for _ in range(5)]
    sent, write = [], set_links.stored

    def counted(df, name):
        if name == "links":
            frame = df._jdf.queryExecution().optimizedPlan().children().head()
            sent.append(spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, frame).count())
        return write(df, name)

    monkeypatch.setattr(set_links, "stored", counted)
    got = {r.doc_id: (r.component_id, r.n_links) for r in ngram_join.component_rows(documents(spark, texts)).collect()}
    assert got == reached({i: shingles(t) for i, t in enumerate(texts)})
    assert len(sent) > 2 and max(sent) < 2 * len(texts) < sum(sent)


def shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {b.name() for b in map(manager.getAllBlocks().apply, range(manager.getAllBlocks().size())) if b.name().startswith("shuffle_")}


def test_stored_leaves_no_shuffle_files(spark):
    plain = spark.conf.get(common.SHUFFLES_GO, "false")
    before = shuffle_files(spark)
    table = common.stored(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.collect_list("id").alias("ids")), "kept")
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert spark.conf.get(common.SHUFFLES_GO, "false") == plain
    assert sorted(len(r.ids) for r in table.collect()) == [142, 143, 143, 143, 143, 143, 143]


def test_discard_deletes_a_stored_table_only(spark):
    gone, kept = common.stored(spark.range(5), "gone"), common.stored(spark.range(5), "kept")
    common.discard(gone)
    assert not paths.exists(spark, gone._stored_at) and kept.count() == 5


def test_ngram_join_leaves_no_sets_on_disk(spark, monkeypatch):
    made = []
    for module in (ngram_join, set_links):
        def noted(df, name, write=module.stored):
            made.append((name, write(df, name)))
            return made[-1][1]

        monkeypatch.setattr(module, "stored", noted)
    r = random.Random(12)
    texts = [edited(t, 1, r) for t in [prose(120, r)] * 12]
    rows = ngram_join.component_rows(documents(spark, texts))
    left = {name for name, df in made if any(not f.startswith(("_", ".")) for f in paths.names(spark, df.inputFiles()[0].rpartition("/")[0]))}
    assert {name for name, _ in made} >= {"shared", "sets", "members", "links"}
    assert left <= {"described", "named", "links", "large-clusters"}
    assert rows.count() == len(texts)


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (500, 500), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 500: 500}


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_warc_round_trip(spark, tmp_path):
    long, other = "<p>é" + "x" * 120, "y" * 5000
    rows = [(3, "http://a/?q=%0A\n", long), (1, None, long), (2, "http://b", long), (4, "u", None), (5, "u", ""), (6, "u", "short"),
            (7, "u", "short"), (8, "u", other), (9, "u", other)]
    index = warc.archive(pages(spark, rows), str(tmp_path))
    assert [r.page_id for r in warc.read(index.where("page_id = 8")).collect()] == [8]
    records = {r.page_id: r for r in warc.read(index).collect()}
    assert bytes(records[1].payload).decode() == long and records[3].url == "http://a/?q=%0A\n" and bytes(records[2].payload) == b""
    got = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.resolve(warc.read(index)).collect()}
    for page_id, _, html in rows:
        data = (html or "").encode()
        first = min(p for p, _, h in rows if h == html) if len(data) >= 100 else page_id
        kind = ("response", None) if first == page_id else ("revisit", first)
        assert got[page_id] == (len(data), hashlib.sha256(data).hexdigest(), *kind)
    assert warc.archive(pages(spark, rows).limit(0), str(tmp_path)).count() == 0


def test_byte_ranges_are_joined_up_to_the_gap_and_the_span():
    rows = [("a", 0, 10), ("a", 10, 10), ("a", 20 + warc.GAP_BYTES + 1, 5), ("b", 0, 5), ("b", 5, warc.SPAN_BYTES)]
    assert [len(g) for g in warc.ranges(rows)] == [2, 1, 1, 1]


def test_language_of_held_out_texts_and_of_mixtures(spark):
    r = random.Random(1)
    words = {lang: ["".join(r.choice(letters) for _ in range(r.randint(2, 8))) for _ in range(300)] for lang, letters in (("xx", "abcdefgh"), ("yy", "nopqrstu"))}
    def text(lang, n):
        return " ".join(r.choice(words[lang]) for _ in range(n))

    train = spark.createDataFrame([(text(k, 200), k) for k in words for _ in range(30)] + [(None, "xx"), ("q", None)], "text string, lang string")
    model = language_id.train(train)
    assert model.languages == ["xx", "yy"]
    texts = [text("xx", 30), text("yy", 30), text("xx", 60) + " " + text("yy", 20), None, "", "123 !!!"]
    got = [r for r in language_id.identify(documents(spark, texts), model).orderBy("doc_id").collect()]
    assert [r.lang_pred for r in got] == ["xx", "yy", "xx", "und", "und", "und"]
    assert set(got[2].languages) == {"xx", "yy"} and 0.6 < got[2].score < 0.9 and got[0].score == 1.0
    empty = language_id.train(train.limit(0))
    assert {r.lang_pred for r in language_id.identify(documents(spark, texts), empty).collect()} == {"und"}
    assert language_id.identify(documents(spark, texts).limit(0), model).count() == 0


def test_language_accuracy_on_held_out_documents(spark):
    from basketry.llm.queries import op3_language_id

    folder = "/root/testdata/sf0.01"
    known = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    rows = op3_language_id(spark, folder).join(known, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held)


def test_kneser_ney_probabilities_sum_to_one_and_order_texts(spark):
    good = [prose(80) for _ in range(40)]
    model = quality.train(documents(spark, good))
    grams = (quality._codes([good[0][:30].encode()])[0] >> 8 << 8)[-1] + np.arange(256)
    seen = quality.log_probabilities(model, grams)
    assert 0.98 < np.exp(seen).sum() < 1.02
    texts = [prose(60), "".join(rng.choice("ZQ#%&9xyw") for _ in range(300)), None, ""]
    all_ = documents(spark, good + texts)
    trusted = all_.where(f"doc_id < {len(good)}")
    got = {r.doc_id: r for r in quality.classify(all_, trusted).collect()}
    fine, junk, null, empty = (got[len(good) + i] for i in range(4))
    assert fine.perplexity * 3 < junk.perplexity and not junk.good and not null.good and not empty.good and null.perplexity is None
    assert all(got[i].good for i in range(len(good)))
    none = quality.classify(documents(spark, texts), trusted.limit(0)).collect()
    assert len(none) == 4 and all(r.good is None for r in none)


def test_quality_limits_come_from_texts_the_model_has_not_seen_and_repetition_is_seen(spark):
    r = random.Random(41)
    good = [prose(r.randint(40, 120), r) for _ in range(300)]
    odd = "".join(r.choice("ZQ#%&9") for _ in range(400))
    new = [prose(r.randint(40, 120), r) for _ in range(60)]
    same = [" ".join([w] * 90) for w in VOCABULARY[:10]] + [prose(80, r) + " " + " ".join([w] * 90) for w in VOCABULARY[:10]]
    all_ = documents(spark, [*good, odd, odd, *new, *same])
    got = {x.doc_id: x for x in quality.classify(all_, all_.where(f"doc_id <= {len(good)}")).collect()}
    seen = sorted(got[i].perplexity for i in range(len(good)))
    assert min(got[len(good)].perplexity, got[len(good) + 1].perplexity) > 5 * seen[-1] and not got[len(good)].good
    first = len(good) + 2
    assert sum(got[i].good for i in range(first, first + len(new))) >= 0.9 * len(new)
    assert not any(got[i].good for i in range(first + len(new), first + len(new) + len(same)))


def test_html_extraction(spark):
    inside = "<article><h1>T &amp; t</h1><p>one\n two<br>three <b>bo</b>ld<p>" + "four " * 30 + "<ul><li>l1<li>l2</ul></article>"
    want = "T & t one two three bold " + " ".join(["four"] * 30) + " l1 l2"
    around = ("<html><head><title>x</title><style>p{{}}</style></head><body><nav>menu</nav><div class='ad'>buy</div>{}"
              "<div id=comments><p>" + "reader " * 90 + "</div><aside>side</aside><form>f</form><script>var a='<p>';</script><footer>foot</footer>")
    rows = [(i, f"http://h/{i}", around.format(inside)) for i in range(4)]
    rows += [(4, "http://h/4", None), (5, None, ""), (6, "odd url", "plain & text"), (7, "http://h/7", "<div class=post-7><p>only</p></div>")]
    frame = pages(spark, rows).withColumn("text", F.lit("clash"))
    got = {r.page_id: r.text for r in html_extract.extract(frame).collect()}
    assert got == {**{i: want for i in range(4)}, 4: "", 5: "", 6: "plain & text", 7: "only"}
    votes = html_extract.consensus(pages(spark, rows)).collect()
    assert {(r.host, r.path, r.votes) for r in votes} == {("h", "/html/body/article", 4)}
    assert html_extract.extract(pages(spark, rows).limit(0)).count() == 0


def test_substring_dedup_equals_brute_force(spark):
    base = [prose(60) for _ in range(6)]
    texts = ["\n".join([rng.choice(base) if rng.random() < 0.5 else edited(rng.choice(base), rng.randint(1, 3)), "short line", prose(55)]) for _ in range(40)]
    texts += ODD + ["\n".join([base[0], "", base[0]]), "x " * 49 + "x", "x " * 48 + "x"]
    frame = documents(spark, texts)
    found = substring_dedup.repeated(frame)
    got = {(r.doc_id, r.paragraph): (r.class_doc_id * 1000 + r.class_paragraph, r.n_links) for r in found.collect()}
    sets = {d * 1000 + p: shingles(line) for d, t in enumerate(texts) for p, line in enumerate((t or "").split("\n")) if len(line.encode().split()) >= 50}
    want = reached(sets)
    sizes = {}
    for root, _ in want.values():
        sizes[root] = sizes.get(root, 0) + 1
    assert got == {(k // 1000, k % 1000): v for k, v in want.items() if sizes[v[0]] > 1}
    left = {r.doc_id: r.text for r in repeated_runs.remove(frame, lines=found).collect()}
    for d, t in enumerate(texts):
        gone = {p for (doc, p), (first, _) in got.items() if doc == d and first != d * 1000 + p}
        assert left[d] == (t if t is None or not gone else "\n".join(x for p, x in enumerate(t.split("\n")) if p not in gone))
    assert substring_dedup.repeated(frame.limit(0)).count() == 0


def test_search_equals_brute_force(spark):
    r = np.random.default_rng(5)
    centres = r.normal(0, 0.4, (5, 16))
    rows = [(int(i), [float(x) for x in centres[i % 5] + r.normal(0, 0.1, 16)]) for i in range(300)]
    rows += [(300 + i, rows[0][1]) for i in range(30)] + [(400, None), (401, [None] * 16), (402, [float("nan")] * 16), (403, [float("inf")] * 16), (404, [1.0] * 9), (None, rows[0][1])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit(0))
    ints = {i: np.pad(np.floor(64 * np.array(v, np.float32).astype(float)).astype(int), (0, 16 - len(v))) for i, v in rows
            if i is not None and v is not None and None not in v and np.isfinite(v).all()}
    got = {}
    for x in voronoi_knn.search(frame, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(x.query_id, []).append((x["rank"], x.vec_id, x.score))
    want = {q: [(n, i, -s) for n, (s, i) in enumerate(sorted((-int(ints[q] @ ints[i]), i) for i in ints if i != q)[:20], 1)] for q in ints if q % 20 == 0}
    assert {q: sorted(x) for q, x in got.items()} == want
    few = voronoi_knn.search(frame.where("vec_id < 3 OR vec_id >= 400"), F.col("vec_id") == 0).collect()
    assert len(few) == 3
    assert voronoi_knn.search(frame.limit(0), F.col("vec_id") == 0).count() == 0


def test_byte_bpe_equals_the_library(spark):
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(byte_bpe.RANKS), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = ODD + [prose(50), "ab" * 700, "".join(rng.choice("abcdefghij") for _ in range(3000)), "  a  \n\n b 's don't", "<|endoftext|>", "\x00\x1c a"]
    frame = documents(spark, texts).withColumn("ids", F.lit("clash"))
    got = {r.doc_id: r for r in byte_bpe.decode(byte_bpe.encode(frame)).collect()}
    once = {r.doc_id: r for r in byte_bpe.round_trip(frame).collect()}
    for i, t in enumerate(texts):
        assert got[i].ids == library.encode_ordinary(t or "") == once[i].ids and bytes(got[i].decoded).decode() == (t or "") == bytes(once[i].decoded).decode()
    assert byte_bpe.round_trip(frame.limit(0)).count() == 0


def test_byte_bpe_equals_the_library_for_any_order_of_ranks(tmp_path):
    import public_tokenizers
    import tiktoken

    r = random.Random(8)
    for _ in range(20):
        entries = [bytes([b]) for b in range(256)]
        entries += sorted({bytes(r.choice(b"ab") for _ in range(r.randint(2, 6))) for _ in range(60)} | {"é".encode(), "日é".encode()}, key=lambda v: r.random())
        r.shuffle(entries)
        ranks = {v: i for i, v in enumerate(entries)}
        path = tmp_path / "own.tiktoken"
        path.write_text("".join(f"{base64.b64encode(v).decode()} {i}\n" for v, i in ranks.items()))
        library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        words = ["".join(r.choice("ab") for _ in range(n)) for n in range(1, byte_bpe.LONG + 3) for _ in range(8)]
        texts = words + [" ".join(words), "a" * byte_bpe.LONG, "b" * (byte_bpe.LONG + 1), "日é" * 4, "zzz", None, "", "日本 é1 aab"]
        with byte_bpe.Encoder(str(path)) as bpe, byte_bpe.Decoder(str(path)) as back:
            got = []
            for start, stop, flat, sizes in bpe.encode(pa.array(texts)):
                assert [d.decode() for d in back.decode(flat, sizes)] == [t or "" for t in texts[start:stop]]
                got += [part.tolist() for part in np.split(flat, np.cumsum(sizes)[:-1])]
        assert got == [library.encode_ordinary(t or "") for t in texts]


def test_byte_bpe_queries_take_a_row_a_word_and_a_row_a_text(monkeypatch):
    import public_tokenizers

    path, rows, load = public_tokenizers.path(byte_bpe.RANKS), {}, byte_bpe.Database._load
    with byte_bpe.Encoder(path) as bpe, byte_bpe.Decoder(path) as back:
        monkeypatch.setattr(byte_bpe.Database, "_load", lambda self, name, t: (rows.update({name: rows.get(name, 0) + len(t)}), load(self, name, t))[1])
        words = ["".join(rng.choice("bcdfgxyz") for _ in range(12)) for _ in range(300)]
        texts = [" ".join(rng.choice(words) for _ in range(200)) for _ in range(20)]
        for _, _, flat, sizes in bpe.encode(pa.array(texts)):
            assert [d.decode() for d in back.decode(flat, sizes)] == texts
    assert sum(rows.values()) <= 2 * len(words) + len(texts)


def test_byte_bpe_queries_have_bounded_words_and_spans(monkeypatch):
    monkeypatch.setattr(byte_bpe, "WORDS_PER_QUERY", 10)
    monkeypatch.setattr(byte_bpe, "SPANS_PER_QUERY", 400)
    sizes = np.array([2] * 35 + [24] * 7 + [9] * 30 + [2])
    parts = byte_bpe._bounded(list(range(len(sizes))), sizes)
    assert [i for p in parts for i in p] == list(range(len(sizes)))
    assert all(len(p) <= 10 and sum(sizes[i] * (sizes[i] - 1) // 2 for i in p[:-1]) < 400 for p in parts)
    assert byte_bpe._bounded([], sizes[:0]) == []


def test_byte_bpe_decodes_texts_over_several_queries_and_no_unknown_ids(monkeypatch):
    import public_tokenizers

    with byte_bpe.Decoder(public_tokenizers.path(byte_bpe.RANKS)) as back:
        monkeypatch.setattr(byte_bpe, "IDS_PER_QUERY", 2)
        ids = np.array([64, 65, 66, 67, 68], np.int32)
        assert back.decode(ids, np.array([0, 1, 0, 4, 0])) == [b"", b"a", b"", b"bcde", b""]
        assert back.decode(ids, np.array([2, 0, 2, 1])) == [b"ab", b"", b"cd", b"e"]
        assert back.decode(ids[:0], np.array([0, 0])) == [b"", b""]
        for unknown in ([-1], [64, -2], [10**6], [64, 2**31 - 1]):
            with pytest.raises(ValueError):
                back.decode(np.array(unknown, np.int64), np.array([len(unknown)]))


def test_token_counts_equal_the_library(spark):
    import public_tokenizers
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(token_counts.MODEL))
    texts = ODD + [prose(50), "  a\t\tb \r\n c", "▁a ▁ b", "<s> </s> <unk>", "ﬁ ｆ é", "\x00 a"]
    got = {r.doc_id: r for r in token_counts.count_tokens(documents(spark, texts), limit=100).collect()}
    for i, t in enumerate(texts):
        n = len(library.encode(t or ""))
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len((t or "").encode()), n, n > 100)


def test_decontamination_finds_exact_and_edited_items_only(spark):
    items = [prose(30), prose(14), "two words", None, "", prose(30)]
    held = [prose(40) + " " + items[0].upper().replace(" ", ", ") + ". " + prose(30), items[0].rsplit(" ", 1)[0] + " zzz", items[1], "say two words now",
            edited(items[5], 12), prose(200), items[0] + " " + items[0], *ODD]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.leaks(documents(spark, held), bench).collect()}
    assert set(got) == {(0, 0), (1, 0), (2, 1), (3, 2), (6, 0)}
    assert 0.8 <= got[1, 0].similarity < 1 and got[0, 0].similarity == 1.0 and got[0, 0].start == 40 and got[6, 0].start == 0
    assert decontaminate.leaks(documents(spark, held), bench.limit(0)).count() == 0
    assert decontaminate.leaks(documents(spark, held).limit(0), bench).count() == 0


def windows_alike(texts, items):
    """Per text and item the start and similarity of the best window, by brute force over all windows."""
    def split(text):
        return re.findall("[a-z0-9]+", (text or "").lower())

    def bag(words):
        return Counter(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4)))

    best = {}
    for (d, text), (i, item) in itertools.product(enumerate(texts), enumerate(items)):
        words, own = split(text), split(item)
        for start in range(max(0, len(words) - len(own)) + 1) if words and own else ():
            a, b = bag(words[start:start + len(own)]), bag(own)
            both, union = (a & b).total(), (a | b).total()
            if 100 * both >= 80 * union and both / union > best.get((d, i), (0, 0))[1]:
                best[d, i] = (start, both / union)
    return best


def test_decontamination_equals_brute_force_over_all_windows(spark):
    r = random.Random(31)
    items = [prose(60, r), prose(24, r), " ".join(["same"] * 20), "two words", None, prose(9, r), "a b a b a b a b a b a b"]
    a, b = items[0].split()[:20], items[0].split()[20:]
    turned = " ".join(b + a)
    held = [prose(70, r) + f" {turned} " + prose(50, r), turned, prose(30, r) + " " + " ".join(b + a[:-3]), f"{items[0]} {turned}"]
    held += [prose(r.randint(0, 30), r) + " " + edited(items[k], r.randint(0, 2), r) + " " + prose(r.randint(0, 30), r) for k in (0, 1, 5) for _ in range(12)]
    held += [" ".join(items[0].split()[:56]), " ".join(items[1].split()[3:]), " ".join(["same"] * 90), "b a " * 15, "say two words, two words", None, "", "w"]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(x.doc_id, x.item_id): (x.start, x.similarity) for x in decontaminate.leaks(documents(spark, held), bench).collect()}
    assert got == windows_alike(held, items) and {(0, 0), (1, 0), (3, 0)} <= set(got)


def test_hamming_blocks_meet_within_the_radius(spark):
    r = random.Random(2)
    pairs = []
    for _ in range(50):
        a = r.getrandbits(64)
        b = a
        for k in r.sample(range(64), decontaminate.RADIUS):
            b ^= 1 << k
        pairs.append(tuple(x - 2**64 if x >= 2**63 else x for x in (a, b)))
    rows = spark.createDataFrame(pairs, "a long, b long").select(decontaminate.blocks(F.col("a")).alias("a"), decontaminate.blocks(F.col("b")).alias("b"))
    assert rows.where(F.size(F.array_intersect("a", "b")) == 0).count() == 0


def test_pipeline_keeps_one_stage_on_disk(spark, tmp_path, monkeypatch):
    import corpus_pipeline

    made, write = [], corpus_pipeline.stored

    def noted(df, name):
        made.append(write(df, name))
        return made[-1]

    documents(spark, ["a b", "c"]).write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(corpus_pipeline, "stored", noted)
    monkeypatch.setattr(corpus_pipeline, "STAGES", [(name, lambda spark, docs, folder: docs.where("true")) for name in "abcd"])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 2
    left = [df.inputFiles()[0].rpartition("/")[0] for df in made]
    assert [any(n.startswith("part") for n in paths.names(spark, p)) for p in left] == [False, False, True]


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    source = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{source}/documents.parquet")
    passage = prose(60)
    extra = spark.createDataFrame([(10**6, None, None, "s", 0), (10**6 + 1, "12 34", "en", "s", 5), (10**6 + 2, f"{passage}\n{prose(70)}", "en", "s", 0),
                                   (10**6 + 3, f"{passage}\n{prose(70)}", "en", "s", 0)], docs.schema)
    docs, kept = docs.unionByName(extra), {}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        docs = stage(spark, docs, source)
        docs.write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        kept[name] = {r.doc_id: r for r in docs.collect()}
        if name != "tokens":
            assert docs.columns == before.columns
    assert not {10**6, 10**6 + 1} & set(kept["language"])
    sets = {d: shingles(r.text) for d, r in kept["language"].items()}
    assert set(kept["near_duplicates"]) == {k for k, (first, _) in reached(sets).items() if k == first}
    assert passage in kept["passages"][10**6 + 2].text and passage not in kept["passages"][10**6 + 3].text
    assert set(kept["tokens"]) == set(kept["decontamination"])
    for d, r in kept["tokens"].items():
        assert r.decoded_sha256 == hashlib.sha256(kept["decontamination"][d].text.encode()).hexdigest()
