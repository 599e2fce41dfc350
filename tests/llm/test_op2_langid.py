import numpy as np
from pyspark.sql import functions as F

from storecast.llm import langid
from storecast.llm.common import table

SF = "/root/testdata/sf0.01"


def plain_ngrams(text, n):
    """The same n-grams, one character at a time."""
    out, last = [" "], True
    for ch in text:
        if ch.isalpha():
            out.append(ch.lower() if len(ch.lower()) == 1 else ch)
            last = False
        elif not last:
            out.append(" ")
            last = True
    if not last:
        out.append(" ")
    s = "".join(out)
    grams = [s[i:i + n] for i in range(len(s) - n + 1)]
    return [g for g in grams if " " not in g[1:-1] and g != "  "]


def test_ngrams_equal_plain_code():
    texts = ["", "!!", "The cat, sat", "É1é  ü", "x", "  a b  "]
    for n, (h, where) in zip(langid.LENGTHS, langid.ngrams(texts)):
        grams = [g for t in texts for g in plain_ngrams(t, n)]
        assert np.diff(where).tolist() == [len(plain_ngrams(t, n)) for t in texts]
        assert len(set(zip(grams, h.tolist()))) == len(set(grams)) == len(set(h.tolist()))


def test_bit_sliced_lookup_has_no_false_negative():
    rng = np.random.default_rng(1)
    grams = [rng.integers(0, 2**63, 500, dtype=np.int64).view(np.uint64) for _ in range(70)]
    t = np.zeros((2, 1 << 16), np.uint64)
    for i, g in enumerate(grams):
        for p in langid.positions(g, 3, 16):
            np.bitwise_or.at(t[i // 64], p, np.uint64(1) << np.uint64(i % 64))
    f = langid.Filters([f"l{i:02d}" for i in range(70)], t, 3)
    assert f.rows_log2 == 16 and (f.false_positive() < 0.01).all()
    for i, g in enumerate(grams):
        found = ~np.uint64(0)
        for p in langid.positions(g, 3, 16):
            found = found & t[i // 64][p]
        assert ((found >> np.uint64(i % 64)) & np.uint64(1)).all()


def test_held_out_accuracy(spark):
    docs = table(spark, SF, "documents").withColumn("h", langid.held_out())
    filters = langid.learn(docs.where("not h"))
    got = langid.identify(docs.where("h"), filters)
    right, n = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 100 and right > 0.98


def test_edges(spark, docs_of, edge_rows):
    rows = [(100 + i, t, l) for i in range(6) for l, t in
            (("aa", "abba dabba jabba hab"), ("zz", "zuzzu wuzzu kuzzu xuz"), (None, "abba zuzzu"))]
    docs = docs_of([r[:2] + (None,) for r in edge_rows] + rows)
    filters = langid.learn(docs)
    assert filters.languages == ["aa", "zz"]
    got = langid.identify(docs, filters).select("doc_id", "text", "lang_pred", "score").collect()
    assert len(got) == len(edge_rows) + len(rows)
    for r in got:
        if not any(c.isalpha() for c in r.text or ""):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred in ("aa", "zz") and 0 <= r.score <= 1
        if r.text and r.text.startswith("zuz"):
            assert r.lang_pred == "zz" and r.score > 0.9


def test_nothing_learned(spark, docs_of):
    docs = docs_of([(1, "abc", None)])
    assert langid.identify(docs, langid.learn(docs)).select("lang_pred", "score").first() == ("und", 0.0)
    assert langid.identify(docs.where(F.lit(False)), langid.learn(docs)).count() == 0


def test_lang_is_no_input(spark, docs_of):
    rows = [(i, "abba dabba jabba hab", "aa") for i in range(5)] + [(9 + i, "zuzzu wuzzu", "zz") for i in range(5)]
    f = langid.learn(docs_of(rows))
    a = langid.identify(docs_of([(1, "zuzzu", "aa")]), f).first()
    assert a.lang_pred == "zz"
