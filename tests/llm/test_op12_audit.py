import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm.oracle import duck_rows, rows
from storecast.llm import audit, queries
from storecast.llm.common import table

SF = "/root/testdata/sf0.001"


def plain(t):
    words = (t or "").encode().split()
    return (len(words), len(set(words)), len(t or ""), sum("A" <= c <= "Z" for c in t or ""),
            sum(c in "#$%&*|" for c in t or ""))


def scanned(texts, piece):
    got = audit.scan(pa.array(texts, pa.string()), piece)
    return list(zip(*(got[k].tolist() for k in ("n_words", "n_distinct", "n_points", "n_capitals", "n_symbols"))))


@pytest.mark.parametrize("piece", [5, 64, 1 << 20])
def test_scan_equals_plain_python(piece):
    rng = random.Random(piece)
    alphabet = ["a", "B", "é", "日", "𝄞", " ", "\n", "\x0b", "\x1c", "\x85", "\xa0", "#", "|", "\x00", "abcdefgh", "x" * 9, "Q" * 70]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.choice([0, 1, 3, 40, 400]))) for _ in range(200)]
    texts += [None, "", " ", "a", "A A a", "w " * 3000, "x" * 5000, "x" * 5000 + " " + "x" * 4999 + "y " + "x" * 5000]
    rng.shuffle(texts)
    assert scanned(texts, piece) == [plain(t) for t in texts]
    assert audit.scan(pa.array(texts, pa.string()).slice(7, 20))["n_words"].tolist() == [plain(t)[0] for t in texts[7:27]]
    assert scanned([], piece) == [] and scanned([None, None], piece) == [plain("")] * 2


def test_equal_hashes_are_not_equal_words():
    data = np.frombuffer(b"cat dog cat cot" + b"\0" * 8, np.uint8)
    start, size = np.array([0, 4, 8, 12]), np.full(4, 3)
    clash = lambda d, s, n: np.zeros(len(s), np.uint64)         # noqa: E731
    assert audit.distinct(data, np.zeros(4, np.int64), start, size, clash).tolist() == [True, True, False, True]
    assert audit.distinct(data, np.arange(4), start, size, clash).all()


def test_equals_sql(spark):
    got = queries.QUERIES["op12_filter_audit"](spark, SF)
    want = duck_rows(audit.SQL, documents=table(spark, SF, "documents"), labels=table(spark, SF, "labels"))
    assert rows(got) == want and sum(want.values()) == 600 * table(spark, SF, "documents").select("source").distinct().count()


def brute(docs, labels):
    least, marks, out = {}, {}, Counter()
    for d, t, *_ in docs:
        if d is not None:
            least[t or ""] = min(least.get(t or "", d), d)
    for d, q, x in labels:
        good, toxic = marks.get(d, (False, False))
        marks[d] = (good or q == 1, toxic or x == 1)
    for d, t, _, source in docs:
        w, u, n, caps, sym = plain(t)
        fails = {f for f, bad in zip("ABCDE", (w < 50, 100 * u < 65 * w, 100 * caps > 5 * n, sym > 0,
                                               d is not None and d > least[t or ""])) if bad}
        good, toxic = marks.get(d, (False, False)) if d is not None else (False, False)
        for p in audit.permutations("ABCDE"):
            first = next((f for f in p if f in fails), None)
            for k, f in enumerate(p):
                key = (source or "", "".join(p), k + 1)
                out[key, "kept"] += not fails & set(p[:k + 1])
                out[key, "removed"] += f == first
                out[key, "redundant"] += f in fails and f != first
                out[key, "unique_fails"] += fails == {f}
                out[key, "good_lost"] += f == first and good
                out[key, "toxic_lost"] += f == first and toxic
            for q in audit.permutations("ABCDE"):
                if first:
                    out[(source or "", "".join(q), q.index(first) + 1), "shapley"] += 1
    return out


def test_edges_against_brute_force(spark, docs_of, edge_rows):
    docs = [(r + ("en", None))[:4] for r in edge_rows]
    docs += [(20 + i, f"Many {'SHOUTED' if i % 2 else 'words'} {'#' if i % 3 else ''} " + " ".join(
        f"w{j % (60 if i % 5 else 3)}" for j in range(40 + i)), "en", f"s{i % 2}") for i in range(30)]
    docs += [(200 + i, docs[25][1], "en", "copies" if i else "") for i in range(8)] + [(None, docs[25][1], "en", "copies")] * 2
    labels = [(22, 1, 0), (23, 1, 1), (24, 0, 1), (24, 1, None), (None, 1, 1), (205, None, None), (206, 1, 1), (7, 1, 0), (999, 1, 1)]
    df = docs_of(docs)
    marks = spark.createDataFrame([r + ("x", 1) for r in labels], "doc_id long, quality int, toxic int, part string, n int")
    got = {((r.part, r.filter_order, r.step), k): r[k] for r in audit.audit(df, marks).collect()
           for k in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")}
    want = brute(docs, labels)
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in want.items() if v}
    assert len(got) == 7 * 600 * len({d[3] or "" for d in docs})
    assert audit.audit(df.where(F.lit(False)), marks).count() == 0
    assert audit.audit(df, marks.where(F.lit(False))).agg(F.sum("good_lost")).first()[0] == 0
