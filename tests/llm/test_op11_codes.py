import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm.oracle import duck_rows, rows
from storecast.llm import codes, queries
from storecast.llm.common import table

SF = "/root/testdata/sf0.001"
DDL = "vec_id long, embedding array<double>, label string, code string, parts int, error string"


def frame(spark, some):
    return spark.createDataFrame([(i, v, lab, "x", 1, "y") for i, v, lab in some], DDL)


def plain(some, parts, entries, rounds):
    """The contract with Python integers and every distance."""
    def fine(v):
        return v and all(x is not None and math.isfinite(x) and abs(x) < codes.LIMIT / 256 for x in v)
    kept = sorted(((i, [math.floor(256 * x) for x in v], lab) for i, v, lab in some if fine(v)),
                  key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    dims = len(kept[0][1]) // parts
    kept = [r for r in kept if len(r[1]) == dims * parts]
    cut = [[v[p * dims:(p + 1) * dims] for p in range(parts)] for _, v, _ in kept]
    books = [[list(cut[e][p]) for e in range(min(entries, len(kept)))] for p in range(parts)]

    def nearest(p, s):
        return min((sum((a - b) ** 2 for a, b in zip(s, c)), e) for e, c in enumerate(books[p]))
    for _ in range(rounds):
        for p in range(parts):
            of = [nearest(p, c[p])[1] for c in cut]
            books[p] = [[sum(cut[k][p][d] for k in at) // len(at) for d in range(dims)] if (
                at := [k for k, x in enumerate(of) if x == e]) else entry for e, entry in enumerate(books[p])]
    found = [[nearest(p, c[p]) for p in range(parts)] for c in cut]
    errors, totals = [sum(f for f, _ in x) for x in found], {}
    for (_, _, lab), e in zip(kept, errors):
        totals[lab] = totals.get(lab, 0) + e
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted((str(i), "".join(f"{e:02x}" for _, e in x), err, totals[lab]) for (i, _, lab), x, err in zip(kept, found, errors)), sha


def result(df, **how):
    out, books = codes.compress(df, **how)
    return sorted((str(r.vec_id), r.code, r.error, r.label_error) for r in out.collect()), codes.digest(books)


def test_equals_sql(spark):
    got = queries.QUERIES["op11_vector_codes"](spark, SF)
    assert rows(got) == duck_rows(codes.SQL, embeddings=table(spark, SF, "embeddings"))


@pytest.mark.parametrize("dims,parts,entries", [(8, 4, 5), (6, 2, 64), (16, 16, 16), (140, 2, 7)])
def test_brute_force(spark, dims, parts, entries, monkeypatch):
    monkeypatch.setattr(codes, "CHUNK_BYTES", 300 * dims)         # several chunks, the last block of each not full
    rng = np.random.default_rng(dims)
    v = rng.normal(size=(500, dims)).round(1)
    v[100:300] = v[0]                                             # a hot vector, and many ties
    some = [(int(i), x.tolist(), f"l{i % 3}" if i % 5 else None) for i, x in zip(rng.permutation(500), v)]
    assert result(frame(spark, some), parts=parts, entries=entries) == plain(some, parts, entries, 2)


def test_shortlists_keep_every_nearest_entry():
    rng = np.random.default_rng(1)
    for scale in (1, 30, 100_000):
        sub = rng.integers(-scale, scale + 1, (700, 3))
        entries = rng.integers(-scale, scale + 1, (20, 3))
        x = codes.Blocks.build(sub)
        far = ((sub[:, None] - entries[None]) ** 2).sum(2)
        got, dist = x.assign(entries)
        assert (got == far.argmin(1)).all() and (dist == far.min(1)).all()
        n, sums = x.tally(entries)
        assert (n == np.bincount(got, minlength=20)).all()
        assert (sums == np.array([sub[got == e].sum(0) for e in range(20)])).all()
        assert x.shortlists(entries).sum(1).mean() < 20
        y = codes.Blocks.unpack(x.pack(), 3)
        assert (y.assign(entries)[0] == got).all()


def test_hilbert_steps_to_neighbours():
    grid = np.array([(a, b) for a in range(256) for b in range(256)])
    walk = grid[np.argsort(codes.hilbert(grid))]
    assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def test_edges(spark):
    ok = [1.0, -0.5, 0.25, 3.0]
    some = [(3, ok, "a"), (3, ok, "a"), (None, ok, None), (1, [0.1, 0.2, 0.3, 0.4], None), (2, None, "a"), (4, [], "a"),
            (5, [1.0, None, 1.0, 1.0], "b"), (6, [1.0, float("nan"), 1.0, 1.0], "b"), (7, [float("inf")] * 4, "b"),
            (8, [1e300] * 4, "b"), (9, [1.0] * 5, "b"), (10, [-100_000.0, 100_000.0, -0.0, 1e-9], "c")]
    assert result(frame(spark, some), parts=2, entries=3) == plain(some, 2, 3, 2)
    empty, _ = codes.compress(frame(spark, some).where(F.lit(False)), parts=2)
    assert empty.columns == ["vec_id", "label", "code", "error", "label_error"] and empty.count() == 0
    with pytest.raises(ValueError):
        codes.compress(frame(spark, some), parts=3)


def test_decode_names_the_entries(spark):
    v = [(i, [i / 7, -i / 3, 1.0, float(i % 4)], "a") for i in range(40)]
    out, books = codes.compress(frame(spark, v), parts=2, entries=40, rounds=1)
    back = {r.vec_id: r for r in codes.decode(out, books).collect()}
    for i, x, _ in v:
        assert sum((math.floor(256 * a) - 256 * b) ** 2 for a, b in zip(x, back[i].vector)) == back[i].error
