import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from llm.oracle import duck_rows, rows
from storecast.llm import queries, shards
from storecast.llm.common import table

SF = "/root/testdata/sf0.001"


def check(docs, got, n):
    """Every row once, equal texts together, gapless slots."""
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in docs)
    assert {(r.law, r.grown_shard) for r in got} <= {("bytes", None)}
    by_shard = defaultdict(list)
    for r in got:
        by_shard[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values()) and set(by_shard) <= set(range(n))


def test_equals_sql(spark):
    docs = table(spark, SF, "documents")
    got = queries.QUERIES["op13_minimax_shards"](spark, SF)
    assert rows(got) == duck_rows(shards.SQL, documents=docs)
    check(docs.select("doc_id", "text").collect(), got.collect(), 24)


def smallest(sizes, k):
    """Brute force: try every sum of neighbours as capacity."""
    def fits(c):
        used, at = 1, 0
        for s in sizes:
            used, at = (used, at + s) if at + s <= c else (used + 1, s)
        return used <= k
    sums = sorted({sum(sizes[i:j]) for i in range(len(sizes)) for j in range(i + 1, len(sizes) + 1)})
    return next(c for c in sums if c >= max(sizes) and fits(c))


class Plain(shards.Ends):
    """Ends over a Python list in place of a table."""

    def __init__(self, sizes, width):
        totals, self.inner = [], {}
        for b in range(0, len(sizes), width):
            upto = [sum(sizes[b:i + 1]) for i in range(b, min(b + width, len(sizes)))]
            self.inner[b] = upto
            totals.append((b, upto[-1], upto[0]))
        super().__init__(None, totals)

    def resolve(self, ts):
        for t in ts:
            if len(set(self.bounds(t))) > 1:
                k = shards.bisect_right(self.after, t)
                before = self.after[k - 1] if k else 0
                self.known[t] = before + max(u for u in self.inner[self.blocks[k]] if u <= t - before)


@pytest.mark.parametrize("width", [1, 7, 100])
def test_capacity_is_the_smallest(width):
    rng = random.Random(width)
    for _ in range(60):
        sizes = [rng.choice([8, 9, 20, 500, 3000]) + rng.randint(0, 3) for _ in range(rng.randint(1, 60))]
        k = rng.randint(1, 9)
        capacity, cuts = shards.capacity_cuts(Plain(sizes, width), k)
        assert capacity == max(smallest(sizes, k), -(-sum(sizes) // k))
        ends = [sum(sizes[:i + 1]) for i in range(len(sizes))]
        assert cuts[-1] == ends[-1] and set(cuts) <= set(ends)
        assert all(b - a <= capacity for a, b in zip([0, *cuts], cuts))


def test_blocks_are_looked_into(spark, docs_of, monkeypatch):
    # three large blocks, in the hash's order
    monkeypatch.setattr(shards, "block_of", lambda h: (F.conv(F.hex(F.substring(h, 1, 1)), 16, 10).cast("int") / 100).cast("int"))
    docs = [(i, f"text {i} " * (i % 17)) for i in range(400)]
    df = docs_of(docs)
    got = shards.assign(df, shards=7)
    check(docs, got.collect(), 7)
    sizes = [r[0] for r in shards.measured(df).groupBy("h").agg(F.sum("size").alias("n")).orderBy("h").select("n").collect()]
    most = max(r[0] for r in got.groupBy("shard").agg(F.sum("size")).select("sum(size)").collect())
    # the empty texts, a 17th of the rows, hold less than a share: nothing stands alone
    assert most <= smallest(sizes, 7)


def test_hot_groups_and_edges(spark, docs_of, edge_rows):
    docs = [(r + (None,))[:2] for r in edge_rows]
    docs += [(1000 + i, "copy " * 300) for i in range(300)] + [(None, "copy " * 300)] * 40        # over a third of all bytes
    docs += [(5000 + i, f"{i} some words") for i in range(500)]
    df = docs_of(docs)
    got = shards.assign(df, shards=5).collect()
    check(docs, got, 5)
    texts = defaultdict(set)
    sums = Counter()
    for r in got:
        texts[r.text_crc32].add(r.shard)
        sums[r.shard] += r.size
    assert all(len(s) == 1 for s in texts.values())
    hot = texts[zlib.crc32(("word " * 50_000).encode())] | texts[zlib.crc32(("copy " * 300).encode())]
    assert hot == {0, 1}         # each larger than a share, so alone
    short = docs_of([d for d in docs if len(d[1] or "") < 2000])        # the SQL's CRC takes a step a byte
    assert rows(shards.assign(short, shards=24)) == duck_rows(shards.SQL, documents=short)
    assert shards.assign(df.where(F.lit(False))).count() == 0
    assert {(r.shard, r.slot) for r in shards.assign(df.where("doc_id = 4"), shards=3).collect()} == {(0, 0)}
