import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from storecast.llm import queries, tokenfile
from storecast.llm.common import table
from storecast.session import scratch_path

SF = "/root/testdata/sf0.01"
PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def lib():
    return Tokenizer.from_file(PATH)


def expected(lib, rows):
    """Documents in order with start, count and checksum, by the library on whole texts."""
    coded = [(d, lib.encode(t or "", add_special_tokens=False).ids + [1]) for d, t in rows]
    out, start = [], 0
    for d, ids in sorted(coded, key=lambda x: (x[0] is not None, x[0], np.array(x[1], "<u2").tobytes())):
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_pieces_equal_whole_texts():
    rng = random.Random(3)
    pool = ["the", "The", " ", "\n", "\t\t", "\x0b", "é", "É", "'s", "'S", "don't", "1", "23", "!", "?!", " ", "　",
            "Σ", "ΑΣ", "İ", "İİ", "Å", "ŉ", "ẞ", "ǆ", "हिन्दी", "ไทย", "한국", "ª", "ʰ", "J̌", "ǰ", "A.", "b,c", "I", "̇", "<|ENDOFTEXT|>", ".", "a's.", "日本", "<|endoftext|>", "<|startoftext|>x", "\x00", "\x1c", "ﬁ", "-", "\U0001f600"]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 30))) for _ in range(3000)] + [None, "", "x" * 50_000]
    for path, apart in ((PATH, True), (public_tokenizers.path("byte_bpe_50k.json"), False)):
        own = tokenfile.Pieces(open(path, encoding="utf-8").read())
        assert own.apart == apart
        ids, n = own.encode(pa.array(texts))
        whole = Tokenizer.from_file(path)
        assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == \
            [whole.encode(t or "", add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 5000])
def test_shard_access_rank_count_select(n):
    rng = np.random.default_rng(n)
    ids = rng.choice([0, 1, 5, 300, 49407, 65535], n).astype(np.uint32)
    s = tokenfile.Shard(tokenfile.pack(3, 4, [7, None], np.array([n // 2, n - n // 2]), ids, 16))
    assert (s.bucket, s.number, s.doc_ids, s.doc_ends.tolist()) == (3, 4, [7, None], [n // 2, n])
    assert s.ids().tolist() == ids.tolist()
    for i in rng.integers(0, max(n, 1), min(n, 60)).tolist():
        assert s.access(i) == ids[i]
        assert s.rank(int(ids[i]), i) == (ids[:i] == ids[i]).sum()
    for v in (0, 1, 2, 300, 65535, 70_000):
        at = np.flatnonzero(ids == v)
        assert s.count(v) == len(at)
        assert [s.select(v, k) for k in range(0, len(at), 97)] == at[::97].tolist()
        with pytest.raises(IndexError):
            s.select(v, len(at))


def test_whole_query(spark, lib):
    got = queries.QUERIES["op3_token_binary"](spark, SF).collect()
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    assert sorted(tuple(r) for r in got) == expected(lib, rows)


def test_edges_and_small_shards(spark, docs_of, edge_rows, lib):
    docs = docs_of(edge_rows)
    path = scratch_path(spark, "test-tokens")
    report = tokenfile.write(docs, path, PATH, shard_tokens=20, shard_docs=3)
    assert report.count() > 3 and report.agg(F.sum("n_docs")).first()[0] == len(edge_rows)
    got = [tuple(r) for r in tokenfile.documents(spark, path).collect()]
    key = lambda r: (r[1], r[0] is not None)
    assert sorted(got, key=key) == sorted(expected(lib, edge_rows), key=key)
    one = lib.encode("one", add_special_tokens=False).ids[0]
    found = sorted((r.doc_id or 0, r.offset) for r in tokenfile.occurrences(spark, path, one).collect())
    assert found == [(0, 0), (4, 0), (5, 0), (6, 0)]


def test_empty(spark, docs_of):
    path = scratch_path(spark, "test-tokens")
    none = docs_of([(1, "a")]).where(F.lit(False))
    assert tokenfile.write(none, path, PATH).count() == 0
    assert tokenfile.documents(spark, path).count() == 0
