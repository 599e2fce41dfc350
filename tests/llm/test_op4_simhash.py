import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from storecast.llm import simhash


def brute_fp(text):
    words = [w for w in "".join(c.lower() if c.isascii() else c for c in text or "").replace("\x0b", " ")
             .replace("\x0c", " ").replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    sh = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps, max_bits=4):
    seen = {}
    for f in fps:
        if f in seen:
            continue
        seen[f], todo = f, [f]
        while todo:
            x = todo.pop()
            for y in fps:
                if y not in seen and (x ^ y).bit_count() <= max_bits:
                    seen[y] = f
                    todo.append(y)
    groups = defaultdict(set)
    for x, r in seen.items():
        groups[r].add(x)
    return {frozenset(g) for g in groups.values()}


def sets(edges, fps):
    from storecast.llm.common import connected_components
    root = {r.node: r.root for r in connected_components(edges).collect()}
    groups = defaultdict(set)
    for f in fps:
        s = f - (1 << 64) if f >> 63 else f
        groups[root.get(s, s)].add(f)
    return {frozenset(g) for g in groups.values()}


def family(rng, n_centres, n_each, flips):
    out = set()
    for _ in range(n_centres):
        c = rng.getrandbits(64)
        out.add(c)
        for _ in range(n_each):
            x = c
            for b in rng.sample(range(64), rng.randint(0, flips)):
                x ^= 1 << b
            out.add(x)
    return sorted(out)


@pytest.mark.parametrize("max_group", [1 << 18, 40, 6])
def test_links_equal_brute_force(spark, max_group):
    rng = random.Random(max_group)
    fps = family(rng, 12, 40, 7)
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    assert sets(simhash.links(df, 4, max_group), fps) == brute_components(fps)


def test_index_drops_no_pair():
    rng = random.Random(1)
    v = np.array(family(rng, 30, 60, 5), np.uint64)
    v = v[np.argsort(simhash.gray_rank(v))]
    starts = np.array([0, 1, 500])
    label = simhash.link_group(v, starts, 4)
    for a, b in ((0, 1), (1, 500), (500, len(v))):
        got = defaultdict(set)
        for x, l in zip(v[a:b].tolist(), label[a:b].tolist()):
            got[l].add(x)
        assert {frozenset(g) for g in got.values()} == brute_components(v[a:b].tolist())


def test_gray_rank_orders_neighbours():
    v = np.arange(1 << 10, dtype=np.uint64)
    by_rank = v[np.argsort(simhash.gray_rank(v))]
    assert all((int(a) ^ int(b)).bit_count() == 1 for a, b in zip(by_rank, by_rank[1:]))


def test_whole_operator(spark, docs_of, edge_rows):
    base = " ".join(f"w{i % 97}" for i in range(900))
    rows = edge_rows + [(20, base), (21, base + " tail"), (22, base.replace("w50", "W50")), (23, "quite another text here now")]
    got = {(r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs_of(rows)).collect()}
    fp = {}
    for d, t in rows:
        fp.setdefault(d, brute_fp(t))
    comps = brute_components(sorted({brute_fp(t) for _, t in rows}))
    least = {f: min((d for d, t in rows if d is not None and brute_fp(t) in g), default=None) for g in comps for f in g}
    assert got == {(d, f"{brute_fp(t):016x}", least[brute_fp(t)]) for d, t in rows}


def test_empty(spark, docs_of):
    assert simhash.near_duplicates(docs_of([(1, "a")]).where(F.lit(False))).count() == 0
