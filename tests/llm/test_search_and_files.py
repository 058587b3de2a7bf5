"""Fill-in-the-middle, ranked search and token files against plain versions of the same definitions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from basketry.llm import fill_in_middle, lexical_search, simple8b, token_files, word_bpe

rng = random.Random(11)
ODD = [None, "", " \n\t", "one", "a" * 20_000, "é" * 9_999, "日本語 テキスト。 😀", "x<P>y", "a <S> b", "<", "don't 'S", "\x00\x1c\x85 z"]
CLASHING = "doc_id long, text string, n string, output int, rank string, start int, score string, _key int"


def table(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "n", 1, "r", 2, "s", 3) for i, t in zip(ids, texts)], CLASHING)


# --- fill in the middle ------------------------------------------------------------


def cut(key, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{key}".encode()).hexdigest()
    h = [int(digest[i:i + 8], 16) for i in (0, 8, 16, 24)]
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < 20:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def mixed(n):
    return "".join(rng.choice(["a", "Bc", "é", " ", "\n", "日", "😀", "<", "P>", ".", "9", "xyz" * 9]) for _ in range(n))


def test_fill_in_middle_equals_units_of_whole_texts(spark):
    shared = mixed(4000)  # its chunks stand in many texts, at different places
    texts = ODD + [mixed(rng.choice([1, 2, 30, 300])) for _ in range(300)] + [mixed(9) + shared[i:] for i in range(60)] + ["ab" * 5000 + "é" + "c" * 9000] * 3
    ids = [*range(len(texts) - 2), 5, None]
    made = fill_in_middle.transform(table(spark, texts, ids)).withColumn("back", fill_in_middle.restored())
    assert {"rank", "start", "score"} <= set(made.columns) and "text" not in made.columns
    got = Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) for r in made.collect())
    want = Counter((i, *cut("" if i is None else i, t), t or "") for i, t in zip(ids, texts))
    assert got == want
    assert {f for _, _, f, *_ in got} == {"plain", "spm", "psm"}
    assert made.limit(0).isEmpty() and fill_in_middle.transform(table(spark, texts).limit(0)).count() == 0


def test_chunks_follow_content_and_stay_short():
    data = np.frombuffer((mixed(3000) + "é" * 6000 + "a" * 9000).encode(), np.uint8)
    moved = np.concatenate((np.frombuffer(b"another beginning", np.uint8), data))
    ends = [np.array([0]), np.array([len(data)])]
    edges = fill_in_middle.chunk_edges(data, *ends)
    later = fill_in_middle.chunk_edges(moved, ends[0], ends[1] + 17)
    assert np.diff(edges).max() <= fill_in_middle.LONGEST + 3
    assert ((data[edges[:-1]] & 0xC0) != 0x80).all()
    first = int(edges[1])
    assert set((edges[edges <= 3000][1:] + 17).tolist()) <= set(later.tolist()) and first >= fill_in_middle.WINDOW


# --- ranked search -----------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def ranking(documents, items, k=10):
    """All scores, one by one."""
    docs = [(i, Counter(terms(t))) for i, t in documents]
    docs = [(i, c, sum(c.values())) for i, c in docs if c]
    n_docs, length = len(docs), sum(n for *_, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for item, wanted in asked.items():
        scored = []
        for i, c, n in docs:
            m = 10 + 90 * n * n_docs // length
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                        for t in wanted if t in c)
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, rank, None if null else i, -score) for rank, (score, null, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


WORDS = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 3))) for _ in range(300)] + ["Straße", "日本", "x9"]


def prose(n):
    return " ".join(rng.choice(WORDS[:rng.choice([20, len(WORDS)])]) for _ in range(n))


def ranked_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_search_equals_all_scores(spark, monkeypatch):
    # Small windows and batches, so that the tree has many nodes and bounds carry over from one to the next.
    monkeypatch.setattr(lexical_search, "WINDOW", 200)
    copies = [prose(30)] * 25  # equal scores
    texts = ODD + [prose(rng.choice([0, 1, 5, 40, 200])) for _ in range(600)] + copies
    ids = [*range(len(texts) - 3), 7, None, None]
    items = [(i, prose(rng.choice([1, 3, 12]))) for i in range(40)] + [
        (40, copies[0]), (41, None), (42, ""), (43, "unknown"), (None, "ab ba"), (3, "again x9"), (3, "again x9")]
    asked = spark.createDataFrame([(i, t, "clash") for i, t in items], "item_id long, text string, score string")
    got = lexical_search.search(table(spark, texts, ids), asked)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert ranked_rows(got) == ranking(list(zip(ids, texts)), items)
    # The same in several blocks of items.
    monkeypatch.setattr(lexical_search, "BLOCK_ITEMS", 8)
    assert ranked_rows(lexical_search.search(table(spark, texts, ids), asked, k=3)) == ranking(list(zip(ids, texts)), items, 3)


def test_search_of_empty_tables(spark):
    docs, items = table(spark, ["some words"]), spark.createDataFrame([(1, "words")], "item_id long, text string")
    assert lexical_search.search(docs.limit(0), items).count() == 0
    assert lexical_search.search(docs, items.limit(0)).count() == 0
    assert lexical_search.search(docs, items).count() == 1


def test_walk_leaves_whole_batches_behind():
    n, size = 20_000, 64
    weights = np.full(size, 1000)
    sets = [np.array([i, i + 1]) for i in range(0, size, 2)]
    search = lexical_search.Search(sets, weights, n, n * 3, 10)
    r = np.random.default_rng(5)
    term = r.integers(0, size, n)
    search.add(np.arange(n), np.zeros(n, bool), np.full(n, 3), np.ones(n, np.int64), term, r.integers(1, 4, n))
    assert all(len(s) == 10 for s in search.scores)
    # Of 640,000 pairs; equal scores, of which there are many here, stay open.
    assert search.opened < n * len(sets) / 20


# --- token files -------------------------------------------------------------------


def test_simple8b_round_trip():
    r = random.Random(5)
    for _ in range(200):
        bits = [r.choice([0, 1, 2, 7, 15, 16, 20, 31, 59, 60, 61, 64]) for _ in range(3)]
        values = np.array([r.getrandbits(r.choice(bits)) for _ in range(r.randint(0, 700))], np.uint64)
        words, escapes = simple8b.pack(values)
        assert (simple8b.unpack(words, len(values), escapes) == values).all()
        assert len(escapes) == sum(v >= 2**60 for v in values.tolist())
    assert len(simple8b.pack(np.zeros(1000, np.uint64))[0]) == 5
    assert len(simple8b.pack(np.full(40, 30_000))[0]) == 10
    with pytest.raises(ValueError):
        simple8b.unpack(simple8b.pack(np.arange(100))[0], 300, np.empty((0, 2), np.uint64))


def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(word_bpe.default_path())


PIECES = ["a", "B", "é", "É", "'s", "'", "'T", "don't", " ", "\n", "\x1c", "\x85", "\xa0", "　", "1", "٣", "²", ",", ".", "—", "×", "÷", "́",
          "̌", "J", "j", "İ", "ΑΣ", "日本", "😀", "<|endoftext|>", "<|EndOfText|>", "<", "|", ">", "\x00", "ß", "Ａ", "ﬁ", "ᄀ", "ᅡ", "_", "''s", "s"]


def test_word_bpe_equals_the_library():
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 30))) for _ in range(5000)] + ODD
    wanted = [e.ids for e in library().encode_batch([t or "" for t in texts], add_special_tokens=False)]
    encoder = word_bpe.Encoder(word_bpe.default_path())
    for _ in range(2):  # the second time all runs are known
        for start, stop, flat, sizes in encoder.encode(pa.array(texts)):
            ends = np.cumsum(sizes)
            assert [flat[e - s:e].tolist() for s, e in zip(sizes, ends)] == wanted[start:stop]


def test_token_files_hold_the_ids_in_order(spark):
    texts = ODD + [prose(rng.choice([0, 1, 5, 40, 900])) for _ in range(200)] + ["same row"] * 300 + ["long text " * 120_000] * 6
    ids = [*rng.sample(range(-500, 5000), len(texts) - 309), *[7] * 301, None, None, *range(9000, 9006)]
    docs = table(spark, texts, ids).repartition(5)
    files = token_files.write(docs, block=500, file_bytes=2000)
    wanted = Counter()
    for i, e in zip(ids, library().encode_batch([t or "" for t in texts], add_special_tokens=False)):
        wanted[i, (*e.ids, 1)] += 1
    found = token_files.read(files).collect()
    assert Counter((r.doc_id, tuple(r.ids)) for r in found) == wanted
    placed = sorted(found, key=lambda r: r.start)
    at = 0
    for r in placed:
        assert r.start == at and r.n_tokens == len(r.ids)
        at += r.n_tokens
    order = [(r.doc_id is not None, r.doc_id or 0) for r in placed]
    assert order == sorted(order)
    assert files.count() > 8 and files.agg(F.sum("n_ids")).first()[0] == at
    sums = {(r.start, r.n_tokens): r.ids_crc32 for r in token_files.checksums(files).collect()}
    assert sums == {(r.start, r.n_tokens): zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in found}


def test_token_files_of_an_empty_table(spark):
    files = token_files.write(table(spark, ["x"]).limit(0))
    assert files.count() == 0 and token_files.read(files).count() == 0 and token_files.checksums(files).count() == 0


def test_cut_off_files_are_refused(spark, tmp_path):
    files = token_files.write(table(spark, ["some words"]), str(tmp_path))
    path = files.first().file
    broken = tmp_path / "broken.ids"
    broken.write_bytes(open(path, "rb").read()[:-8])
    with pytest.raises(ValueError):
        token_files.Reader(str(broken))
