import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from llm.oracle import duck_rows, rows
from storecast.llm import suffixes
from storecast.llm.common import table

SF = "/root/testdata/sf0.01"


def brute(docs, m=50):
    where, texts = defaultdict(set), {}
    for d, t in docs:
        texts[d, t] = words = (t or "").encode().split()
        for s in range(len(words) - m + 1):
            where[tuple(words[s:s + m])].add(d)
    out = {}
    for (d, _), words in texts.items():
        spans, others = [], []
        for s in range(len(words) - m + 1):
            rest = where[tuple(words[s:s + m])] - {d}
            if rest and spans and s <= spans[-1][1]:
                spans[-1][1] = s + m
                others[-1] |= rest
            elif rest:
                spans.append([s, s + m])
                others.append(set(rest))
        for (a, z), o in zip(spans, others):
            out.setdefault((d, a, z, z - a), set()).update(o)
    return out


def check(df, docs, m=50):
    """The spans are those of plain code; the other document shares a window."""
    rows, want = df.collect(), brute(docs, m)
    got = {(r.doc_id, r.start_word, r.end_word, r.n_words): r.other_doc_id for r in rows}
    assert len(rows) == len(got) and set(got) == set(want)
    assert all(other in want[k] for k, other in got.items())
    return got


def test_whole_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    assert len(check(suffixes.repeats(table(spark, SF, "documents")), docs)) > 20


@pytest.mark.parametrize("seed,m,span", [(1, 50, 32), (2, 12, 5), (3, 9, 1), (4, 9, 2), (5, 20, 13)])
def test_random_corpora(spark, docs_of, seed, m, span):
    rng = random.Random(seed)
    passages = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(m - 3, 3 * m))) for _ in range(8)]
    docs = []
    for i in range(120):
        parts = [rng.choice(passages) if rng.random() < 0.5 else
                 " ".join(rng.choice("abcdefghij") for _ in range(rng.randint(0, 2 * m))) for _ in range(rng.randint(0, 6))]
        # pieces of passages, so that matches end at every place
        parts += [" ".join(rng.choice(passages).split()[rng.randint(0, m):]) for _ in range(rng.randint(0, 2))]
        docs.append((i, rng.choice((" ", "\n", " \t ")).join(parts)))
    check(suffixes.repeats(docs_of(docs), m, span), docs, m)


@pytest.mark.parametrize("copies", [1, 300])
def test_second_occurrence_in_the_smallest_document(spark, docs_of, copies):
    rng = random.Random(copies)

    def text(tag, n):
        return " ".join(f"{tag}{rng.randint(0, 10 ** 9)}" for _ in range(n))

    docs = []
    for k in range(10):  # several, so that the passage ends at different places of a minimiser's range
        head, passage, tail = text("h", 60), text("p", 50 + 3 * k), text("t", 60)
        docs.append((1000 * k, f"{head} {passage} {tail} {text('o', 20)} {passage} {text('e', 20)}"))
        docs += [(1000 * k + 1 + i, f"{head} {passage} {tail}") for i in range(copies)]
    got = check(suffixes.repeats(docs_of(docs)), docs)
    assert sum(d % 1000 == 0 for d, *_ in got) == 20


def test_runs_over_many_tasks(spark, docs_of):
    common = " ".join(f"c{i}" for i in range(60))
    docs = [(i, f"x{i} y{i} {common} z{i}") for i in range(300)] + [(1000 + i, common) for i in range(100)]
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        assert len(check(suffixes.repeats(docs_of(docs)), docs)) == 400
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_edges(spark, docs_of, edge_rows):
    p = " ".join(f"p{i}" for i in range(55))
    docs = edge_rows + [(20, p), (20, p), (21, "a " + p), (22, p + " " + p), (23, "q " * 49), (24, "q " * 49),
                        (25, "own " * 80), (26, f"s {p}x"), (None, p), (None, "t " + p)]
    got = check(suffixes.repeats(docs_of(docs)), docs)
    small = docs_of([d for d in docs if len(d[1] or "") < 10_000])
    assert rows(suffixes.repeats(small).drop("other_doc_id")) == duck_rows(suffixes.SQL, documents=small)
    assert {d for d, *_ in got} == {20, 21, 22, 26, None}
    assert suffixes.repeats(docs_of(docs).where(F.lit(False))).count() == 0


@pytest.mark.parametrize("chunk", [1, 7, 100])
def test_runs_longer_than_a_chunk(spark, docs_of, chunk):
    rng = random.Random(chunk)
    common = [f"c{i}" for i in range(70)]
    docs = [(i, f"x{i} " + " ".join(common[rng.randint(0, 10):rng.randint(55, 70)]) + f" z{i}") for i in range(150)]
    docs += [(1000 + i, " ".join(common)) for i in range(60)] + [(5000, " ".join(common + ["y"] + common))]
    check(suffixes.repeats(docs_of(docs), chunk=chunk), docs)


def test_chunks_hold_about_one_chunk():
    keys = [0] * 5 + [1] * 40 + list(range(2, 200)) + [200] * 11
    t = suffixes.pa.table({"key": keys})
    got = list(suffixes._chunks(iter(t.to_batches(max_chunksize=4)), ["key"], 16))
    assert [k for c, *_ in got for k in c["key"].to_pylist()] == keys
    assert all(c.num_rows < 2 * 16 + 4 for c, *_ in got)
    assert got[0][1] and got[-1][2]
    for (a, _, after), (b, before, _) in zip(got, got[1:]):
        assert before == after
        assert after or a["key"][-1] != b["key"][0]  # a run that goes on is marked


def test_texts_of_equal_narrow_hash_under_one_id(spark, docs_of):
    p = " ".join(f"p{i}" for i in range(50))
    texts = spark.range(200_000).select(F.concat(F.repeat(F.lit("q "), (F.col("id") % 60).cast("int")), F.lit(p + " t"),
                                                 F.col("id").cast("string")).alias("text")).withColumn("h", F.hash("text"))
    same = texts.groupBy("h").agg(F.collect_list("text").alias("texts")).where("size(texts) > 1").collect()
    assert len(same) > 1
    docs = [(None, t) for r in same for t in r.texts] + [(1, p)]
    check(suffixes.repeats(docs_of(docs)), docs)


def test_null_id_is_no_legal_id(spark, docs_of):
    p, low = " ".join(f"p{i}" for i in range(55)), -(1 << 63)
    docs = [(low, p), (None, "x " + p), (low + 1, "own " * 60), ((1 << 63) - 1, p + " y")]
    got = check(suffixes.repeats(docs_of(docs)), docs)
    assert {d for d, *_ in got} == {low, None, (1 << 63) - 1}
    assert suffixes.stand_in(docs_of([(low + i, "") for i in range(130) if i != 100]), 16) == low + 100
