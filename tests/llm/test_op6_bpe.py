import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from storecast.llm import bpe, queries
from storecast.llm.common import table

SF = "/root/testdata/sf0.01"
PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def lib():
    return Tokenizer.from_file(PATH)


def check(lib, texts):
    own = bpe.tables(bpe.read_spec(PATH))
    for t, ids in zip(texts, own.encode(texts), strict=True):
        assert ids.tolist() == lib.encode(t, add_special_tokens=False).ids, repr(t[:200])
        assert own.decode(ids) == lib.decode(ids.tolist(), skip_special_tokens=False) == t


def test_random_texts_equal_the_library(lib):
    rng = random.Random(2)
    pool = ["a", "aa", "the", " ", "  ", "\n", "\t", "'s", "'ll", "1", "234", "!", "é", "ß", "日本", "\U0001f600", "\x00",
            " ", " ", "\x1c", "՘", "\U0001e6c0", "́", "<|endoftext|>", "<|endo", "x<|endoftext|>y",
            "hello", "World", "‍", "\r\n", "ǅ", "Ⅷ", "²", "_", "-", "﻿", "\U000323b0"]
    check(lib, ["".join(rng.choice(pool) for _ in range(rng.randint(0, 40))) for _ in range(3000)])


def test_random_bytes_and_every_plane(lib):
    rng = random.Random(4)
    check(lib, ["".join(chr(rng.choice([rng.randrange(0x20, 0x250), rng.randrange(0x250, 0xD800), rng.randrange(0xE000, 0x110000)]))
                        for _ in range(60)) for _ in range(400)])


def test_long_words(lib):
    rng = random.Random(6)
    check(lib, ["a" * 5000, "ab" * 30_000, "".join(rng.choice("abcdeilnorst") for _ in range(60_000)), " " * 10_000, "\n" * 9999])


def test_rounds_and_heap_agree():
    own, rng = bpe.tables(bpe.read_spec(PATH)), random.Random(8)
    for _ in range(300):
        sym = own.byte_id[np.array([ord(rng.choice("aeinthsr ")) for _ in range(rng.randint(1, 60))])]
        ids, _ = own.rounds(sym, np.zeros(len(sym), np.int64))
        assert ids.tolist() == own.merge_long(sym.tolist())


def test_cache_is_bounded(lib, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 50)
    own = bpe.Bpe(bpe.read_spec(PATH))
    for i in range(20):
        t = " ".join(f"w{i}x{j}" for j in range(20))
        assert own.encode([t])[0].tolist() == lib.encode(t, add_special_tokens=False).ids
        assert len(own.index) <= 50 + 41


def test_whole_query(spark, lib):
    got = {r.doc_id: r for r in queries.QUERIES["op6_bpe"](spark, SF).collect()}
    docs = table(spark, SF, "documents").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids, r = lib.encode(d.text or "", add_special_tokens=False).ids, got[d.doc_id]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256((d.text or "").encode()).hexdigest())


def test_edges(spark, docs_of, edge_rows):
    docs = docs_of(edge_rows)
    out = bpe.decode(bpe.encode(docs, PATH), PATH)
    assert out.columns == [*docs.columns, "ids", "decoded"]
    assert all(r.decoded == (r.text or "") for r in out.collect()) and out.count() == len(edge_rows)
    assert bpe.round_trip(docs.where(F.lit(False)), PATH).count() == 0
