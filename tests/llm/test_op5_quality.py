import random

from pyspark.sql import functions as F

from llm.oracle import duck_rows, rows
from storecast.llm import quality, queries
from storecast.llm.common import table

SF = "/root/testdata/sf0.01"
COLS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def brute_repeat(text):
    words = (text or "").encode().split()
    seen = {}
    for i in range(len(words) - 4):
        seen.setdefault(tuple(words[i:i + 5]), []).append(i)
    return len({p + k for at in seen.values() if len(at) > 1 for p in at for k in range(5)})


def test_equals_sql(spark):
    docs = table(spark, SF, "documents")
    assert rows(queries.QUERIES["op5_host_quality"](spark, SF)) == duck_rows(quality.SQL, documents=docs)


def test_repeat_words_brute_force(spark, docs_of):
    rng = random.Random(3)
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 40))) for _ in range(150)] + \
            [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 300))) for _ in range(40)]
    got = dict(quality.document_metrics(docs_of(list(enumerate(texts)))).select("doc_id", "n_repeat_words").collect())
    assert got == {i: brute_repeat(t) for i, t in enumerate(texts)}


def test_edges_and_clashing_columns(spark, docs_of, edge_rows):
    docs = docs_of([r + ("en", None) for r in edge_rows] + [(50, "a b c d e f g h i j k\n\n#b\n#b \n#b", "en", "h")])
    got = quality.judge(docs).select(*COLS)
    assert rows(got) == duck_rows(quality.SQL, documents=docs)
    assert quality.judge(docs.where(F.lit(False))).count() == 0


def test_bad_host_is_rejected_and_small_hosts_shrink(spark, docs_of):
    good = "the quick brown fox jumps over a lazy dog near some old mill today"
    rows_ = [(i, good if i % 50 else "bad", "en", f"good{i % 5}") for i in range(500)]
    rows_ += [(1000 + i, "bad" if i % 20 else good, "en", "spam") for i in range(400)]
    rows_ += [(2000, "bad", "en", "tiny"), (2001, good, "en", None)]
    docs = docs_of(rows_)
    got = {r.doc_id: r for r in quality.judge(docs).collect()}
    assert all(got[i].kept for i in range(500) if i % 50)
    assert got[1000].host_rejected and not got[1000].base_failed and not got[1000].kept
    assert got[2000].base_failed and not got[2000].host_rejected  # one failure does not condemn a host
    assert got[2001].kept
    assert rows(quality.judge(docs).select(*COLS)) == duck_rows(quality.SQL, documents=docs)


def test_bad_rate_follows_the_prior(spark, docs_of):
    """Hosts at several rates: which are rejected, and how many rows that changes."""
    good = "the quick brown fox jumps over a lazy dog near some old mill today"
    rates = {f"clean{k}": 0.02 for k in range(30)} | {"some": 0.4, "half": 0.5, "most": 0.8, "all": 1.0}
    rows_ = [(1000 * h + i, "bad" if i < rate * 200 else good, "en", host)
             for h, (host, rate) in enumerate(rates.items()) for i in range(200)]
    docs = docs_of(rows_ + [(10**6, "bad", "en", "once")])
    verdicts = {r.host: r for r in quality.host_verdicts(quality.document_metrics(docs)).collect()}
    assert {h for h, r in verdicts.items() if r.rejected} == {"most", "all"}
    for r in verdicts.values():
        assert r.short_low <= r.short_rate and r.short_bad >= 0.5
    got = quality.judge(docs)
    assert got.where("host_rejected and not base_failed").count() == 40  # the passing fifth of "most"
    assert rows(got.select(*COLS)) == duck_rows(quality.SQL, documents=docs)


def test_prior_of_mixed_hosts_raises_the_bad_rate(spark, docs_of):
    """Where hosts differ widely, only rates surely over ``most_bad`` condemn."""
    good = "the quick brown fox jumps over a lazy dog near some old mill today"
    docs = docs_of([(100 * h + i, "bad" if i < 10 * h else good, "en", f"h{h}") for h in range(11) for i in range(100)])
    got = quality.judge(docs)
    assert {r.host for r in got.where("host_rejected").select("host").distinct().collect()} == {"h9", "h10"}
    assert rows(got.select(*COLS)) == duck_rows(quality.SQL, documents=docs)


def test_one_host_holds_all_rows(spark, docs_of):
    good = "the quick brown fox jumps over a lazy dog near some old mill today"
    docs = docs_of([(i, "bad" if i % 10 else good, "en", "only") for i in range(300)])
    assert rows(quality.judge(docs).select(*COLS)) == duck_rows(quality.SQL, documents=docs)
