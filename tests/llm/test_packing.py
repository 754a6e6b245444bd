"""Best-fit packing against the tokenizer, the bound on sequences and brute force."""

import itertools
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from episodica.llm import packing, units
from episodica.llm.queries import QUERIES
from episodica.session import Scratch

PATH = public_tokenizers.path("word_bpe_49k.json")
FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, length string, uid string, sequence_id string"


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(PATH)
    found.encode_special_tokens = True
    return found


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def check(rows, docs, tokenizer, size):
    """Every document's ids are there once, in order, and no sequence has a gap or is too long."""
    expected = []
    for doc, text in docs:
        ids = np.array(ids_of(tokenizer, text), "<u4")
        for n, at in enumerate(range(0, len(ids), size)):
            part = ids[at : at + size]
            expected.append((doc, n, at, len(part), zlib.crc32(part.tobytes())))
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=key) == sorted(expected, key=key)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for members in sequences.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= size
    return len(sequences)


def test_words_encode_as_whole_texts_do(tokenizer):
    rng = random.Random(3)
    alphabet = "aé'sS tT\n\t \x1c\x85\xa0 ßİΣ́漢1#<|endoftext|>"
    texts = ["", "  ", "<|endoftext|> a<|startoftext|>b", "x" * 5000, "\x1d \x1c a", "é ́e"]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randrange(80))) for _ in range(3000)]
    encoder = packing.Encoder(PATH)
    texts += ["J\u030c j\u030c J\u030c a=\u0338b A\u030a! ,e\u0301", "Don't 'sun 5's x's!'s", "x\u00a0Y\u2028z", "it,was.NOT 12ab,34"]
    for text, got in zip(texts, encoder.encode_all(t.encode() for t in texts)):
        assert got.tolist() == ids_of(tokenizer, text)[:-1], repr(text)


def test_slices_and_forgetting_change_nothing(tokenizer, monkeypatch):
    rng = random.Random(4)
    text = " ".join("".join(rng.choice("abcdé1") for _ in range(rng.randrange(1, 90))) for _ in range(3000)) + "  \n" + "y" * 3000
    expected = ids_of(tokenizer, text)[:-1]
    monkeypatch.setattr(units, "SLICE", 500)
    monkeypatch.setattr(units, "UNITS", 50)
    monkeypatch.setattr(units, "PIECE", 300)
    monkeypatch.setattr(packing, "PIECE", 300)
    got = list(packing.Encoder(PATH).encode_all(iter([b"", text.encode(), b"a", b"", b"a b"])))
    assert got[1].tolist() == expected and [len(g) for g in got[2:]] == [1, 0, 2] and not len(got[0])
    assert b"".join(packing.slices(text.encode())) == text.encode()


def test_texts_as_long_as_a_run(tokenizer):
    texts = ["a " * (packing.PIECE // 2), "", "é" * (packing.PIECE // 2), "", "b" * (packing.PIECE + 1), "c d" * 200_000, "e", ""]
    for text, got in zip(texts, packing.Encoder(PATH).encode_all(t.encode() for t in texts)):
        assert got.tolist() == ids_of(tokenizer, text)[:-1]


def fewest(sizes, room):
    """The fewest bins, by trying all partitions of few sizes."""
    best = len(sizes)

    def place(i, fills):
        nonlocal best
        if len(fills) >= best:
            return
        if i == len(sizes):
            best = len(fills)
            return
        for at in range(len(fills)):
            if fills[at] + sizes[i] <= room:
                place(i + 1, [*fills[:at], fills[at] + sizes[i], *fills[at + 1 :]])
        place(i + 1, [*fills, sizes[i]])

    place(0, [])
    return best


def test_search_raises_squares_and_comes_near_the_fewest_bins():
    rng, extra = random.Random(5), 0
    for _ in range(200):
        sizes = np.array([rng.randrange(1, 20) for _ in range(rng.randrange(1, 9))])
        start = np.arange(len(sizes))
        found = packing.local_search(sizes, start, 20)
        fill = np.bincount(found, sizes)
        assert fill.max() <= 20 and fill.sum() == sizes.sum()
        assert (fill**2).sum() >= (sizes**2).sum()
        extra += (fill > 0).sum() - fewest(sizes.tolist(), 20)
    assert extra <= 10


def test_search_ends_where_no_exchange_helps():
    rng = random.Random(6)
    for _ in range(40):
        sizes = np.array([rng.randrange(1, 60) for _ in range(25)])
        bins = packing.local_search(sizes, packing.best_fit(sizes, 100), 100)
        fill = np.bincount(bins, sizes)
        members = {b: [int(s) for s in sizes[bins == b]] for b in set(bins.tolist())}
        for a, b in itertools.permutations(members, 2):
            gives = [(x,) for x in members[a]] + list(itertools.combinations(members[a], 2))
            for give, back in itertools.product(gives, [0, *members[b]]):
                more = sum(give) - back
                better = more > 0 and fill[b] + more <= 100 and more * (fill[b] - fill[a] + more) > 0
                assert not (better and 0 < fill[a] < 100 and fill[b] < 100)


def test_empties_bins_that_best_fit_leaves():
    rng = np.random.default_rng(2)
    emptied = 0
    for _ in range(30):
        sizes = rng.integers(200, 900, 300)
        start = packing.best_fit(sizes, 2048)
        emptied += len(set(start.tolist())) - len(set(packing.local_search(sizes, start, 2048).tolist()))
    assert emptied >= 20


def test_odd_rows_and_clashing_columns(spark, tokenizer):
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    docs = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (None, "no id"), (None, None), (5, long), (6, "x" * 30_000), (7, "<|endoftext|>")]
    table = spark.createDataFrame([(*d, "x", "y", "z") for d in docs], DOCS)
    rows = packing.pack(table, Scratch(spark), PATH, packing.Sequences(size=64, group=50)).collect()
    used = check(rows, docs, tokenizer, 64)
    assert used <= math.ceil(sum(r.length for r in rows) / 64) + 1


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], DOCS), Scratch(spark), PATH).collect() == []


def test_text_ids_and_bins_across_groups(spark, tokenizer):
    """Small groups: bins that one group can't fill are filled with those of others."""
    rng = random.Random(8)
    docs = [(f"d{i}", " ".join("a" for _ in range(rng.randrange(1, 900)))) for i in range(600)]
    table = spark.createDataFrame(docs, "doc_id string, text string")
    rows = packing.pack(table, Scratch(spark), PATH, packing.Sequences(group=40)).collect()
    used = check(rows, docs, tokenizer, 2048)
    assert used <= math.ceil(sum(r.length for r in rows) / 2048) + 1


def test_query_packs_all_documents(spark, tokenizer):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    rows = QUERIES["op11_best_fit_packing"](spark, FOLDER).collect()
    assert check(rows, docs, tokenizer, 2048) <= math.ceil(sum(r.length for r in rows) / 2048) + 1
