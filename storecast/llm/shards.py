"""Contiguous shards of near equal size, in DataFrame functions only.

Documents of equal text are one atomic group.  Groups stand in the order of their text's
SHA-256, and shards are contiguous runs of that order, so where a document goes follows from
its text and a few cut points: no row is ever joined with a table of groups.

* A group larger than an equal share of what is left takes a shard of its own (largest
  first, ties by hash); there are fewer of these than shards.
* For the rest, the smallest capacity with which greedy filling needs no more than the
  remaining shards is searched, and the cuts are where that filling makes them.
  Group sizes are added up within blocks (the hash's first 16 bits, so evenly filled);
  the driver holds one running total a block.  A greedy step ("the last group that ends at
  or before t") is answered from the totals, and where t falls inside a block, by an
  aggregate over that block's rows only.  The totals alone bracket the capacity; then every
  round tries ``WAYS`` capacities inside the bracket at once.
* Slots come from one range sort by (shard, hash, doc_id): a hot group is spread over tasks
  by its doc_ids, and the row's place in its task is shifted by the counts of earlier tasks.

Driver memory: 65,536 totals, the cut points, and one row a partition.

Edge cases: a null text counts as empty (size 8, crc 0) and is equal to an empty one; a null
doc_id stands before the others of its group; repeated rows get slots of their own; ties
between equal rows may fall either way, which no result shows; very long texts are only
hashed and measured; with fewer groups than shards some shards are empty; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storecast.llm.common import materialize

BLOCK_BITS = 16
WAYS = 48           # capacities tried together in a round
ROW_BYTES = 8       # what a document counts besides its text


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32 and the text's hash of every row, and a number that tells
    equal rows apart."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + F.lit(ROW_BYTES)).cast("long").alias("size"),
        F.crc32(F.encode(text, "utf-8")).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("h"),
        F.monotonically_increasing_id().alias("nth"))


def block_of(h: Column) -> Column:
    return F.conv(F.hex(F.substring(h, 1, BLOCK_BITS // 8)), 16, 10).cast("int")


class Ends:
    """Where groups end on the line of all sizes: running totals of blocks on the driver,
    groups inside a block in ``table`` (block, h, upto: the sizes of the block up to this group)."""

    def __init__(self, table: DataFrame, totals: Iterable[tuple[int, int, int]]):
        self.table = table
        rows = sorted(totals)
        self.blocks = [b for b, _, _ in rows]
        self.after = list(accumulate(n for _, n, _ in rows))
        self.firsts = [end - n + first for end, (_, n, first) in zip(self.after, rows, strict=True)]
        self.total = self.after[-1] if rows else 0
        self.known: dict[int, int] = {}

    def bounds(self, t: int) -> tuple[int, int]:
        """The last end at or before ``t`` lies between these; equal where the totals tell it."""
        if t >= self.total:
            return self.total, self.total
        k = bisect_right(self.after, t)                  # the block that t falls into
        before = self.after[k - 1] if k else 0
        if t < self.firsts[k]:
            return before, before
        if t in self.known:
            return self.known[t], self.known[t]
        return self.firsts[k], t

    def resolve(self, ts: Iterable[int]) -> None:
        """Look the ends up that the totals do not tell: one aggregate over the blocks concerned."""
        open_ = sorted({t for t in ts if len(set(self.bounds(t))) > 1})
        if not open_:
            return
        at = [bisect_right(self.after, t) for t in open_]
        before = [self.after[k - 1] if k else 0 for k in at]
        found = self.table.where(F.col("block").isin(sorted({self.blocks[k] for k in at}))).agg(*[
            F.max(F.when((F.col("block") == self.blocks[k]) & (F.col("upto") <= t - b), F.col("upto"))).alias(f"e{i}")
            for i, (t, k, b) in enumerate(zip(open_, at, before, strict=True))]).first()
        self.known.update({t: b + e for t, b, e in zip(open_, before, found, strict=True)})


def bracket(ends: Ends, shards: int) -> tuple[int, int]:
    """Capacities (one that is too small or next to the equal share, one that is enough), from block totals alone."""
    def reaches(capacity: int, side: int) -> bool:
        at = 0
        for _ in range(shards):
            at = ends.bounds(at + capacity)[side]
        return at >= ends.total

    def smallest(side: int, low: int, high: int) -> int:
        while low < high:
            mid = (low + high) // 2
            low, high = (low, mid) if reaches(mid, side) else (mid + 1, high)
        return low

    share = -(-ends.total // shards)
    return smallest(1, share, ends.total) - 1, smallest(0, share, ends.total)


def greedy(ends: Ends, capacities: list[int], shards: int) -> dict[int, list[int]]:
    """For every capacity the ends of the shards that greedy filling makes."""
    cuts: dict[int, list[int]] = {c: [] for c in capacities}
    at = dict.fromkeys(capacities, 0)
    for _ in range(shards):
        ends.resolve(at[c] + c for c in capacities)
        for c in capacities:
            at[c] = ends.bounds(at[c] + c)[0]
            cuts[c].append(at[c])
    return cuts


def capacity_cuts(ends: Ends, shards: int) -> tuple[int, list[int]]:
    """The smallest feasible capacity and the shards' ends."""
    low, high = bracket(ends, shards)       # low is too small, high is enough
    while high - low > 1:
        tried = sorted({low + (high - low) * i // (WAYS + 1) for i in range(1, WAYS + 1)} - {low, high}) or [low + 1]
        fits = [c for c, cuts in greedy(ends, tried, shards).items() if cuts[-1] >= ends.total]
        misses = [c for c in tried if c not in fits]
        low, high = max([low, *misses]), min([high, *fits])
    return high, greedy(ends, [high], shards)[high]


def layout(rows: DataFrame, shards: int) -> tuple[list[bytes], list[tuple[int, bytes]], int]:
    """Hashes of the groups with a shard of their own, the last group of every other shard
    (its number and hash), and the capacity found."""
    groups = materialize(rows.groupBy("h").agg(F.sum("size").alias("bytes")), "shard-groups")
    left = groups.agg(F.sum("bytes")).first()[0] or 0
    alone: list[bytes] = []
    for h, size in groups.orderBy(F.desc("bytes"), "h").limit(shards).collect():
        if len(alone) == shards - 1 or size * (shards - len(alone)) <= left:
            break
        alone.append(bytes(h))
        left -= size
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    upto = F.sum("bytes").over(Window.partitionBy("block").orderBy("h"))
    line = materialize(
        groups.where(~among(F.col("h"), alone)).withColumn("block", block_of(F.col("h")))
        .repartitionByRange(parts, "block").withColumn("upto", upto), "shard-line")
    ends = Ends(line, [tuple(r) for r in line.groupBy("block").agg(F.max("upto"), F.min("upto")).collect()])
    if not ends.total:
        return alone, [], 0
    capacity, cuts = capacity_cuts(ends, shards - len(alone))
    # the group that ends at a cut: the hash that later rows are compared with
    inner = sorted({c for c in cuts if 0 < c < ends.total})
    at = [bisect_right(ends.after, c - 1) for c in inner]
    wanted = F.lit(False)
    for c, k in zip(inner, at, strict=True):
        wanted |= (F.col("block") == ends.blocks[k]) & (F.col("upto") == c - (ends.after[k - 1] if k else 0))
    hashes = sorted(bytes(r[0]) for r in line.where(wanted).select("h").collect())       # fewer than shards
    return alone, [(len(alone) + cuts.index(c), h) for c, h in zip(inner, hashes, strict=True)], capacity


def literal(h: bytes) -> Column:
    return F.unhex(F.lit(h.hex()))


def among(h: Column, some: list[bytes]) -> Column:
    out = F.lit(False)
    for x in some:
        out |= h == literal(x)
    return out


def shard_of(h: Column, alone: list[bytes], cuts: list[tuple[int, bytes]]) -> Column:
    """The shard of a text's hash."""
    out = F.lit(len(alone))
    for n, last in cuts:                        # in order, so the last that holds stands
        out = F.when(h > literal(last), F.lit(n + 1)).otherwise(out)
    for n, x in enumerate(alone):
        out = F.when(h == literal(x), F.lit(n)).otherwise(out)
    return out.cast("int")


def assign(docs: DataFrame, shards: int = 24) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard (null under this law) of every row."""
    rows = materialize(measured(docs), "shard-rows")
    alone, cuts, _ = layout(rows, shards)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["shard", "h", "doc_id", "nth"]
    placed = materialize(
        rows.withColumn("shard", shard_of(F.col("h"), alone, cuts)).repartitionByRange(parts, *order)
        .sortWithinPartitions(*order).select("doc_id", "size", "text_crc32", "shard", F.monotonically_increasing_id().alias("place")),
        "shard-places")
    # a place is the task's number and the row's number in the task
    numbered = placed.withColumn("task", F.shiftright("place", 33))
    runs = numbered.groupBy("shard", "task").agg(F.min("place").alias("start"), F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    # at most a row for each task and shard border
    runs = materialize(runs.select("shard", "task", (F.coalesce(before, F.lit(0)) - F.col("start")).alias("shift")), "shard-runs")
    return numbered.join(runs, ["shard", "task"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("place") + F.col("shift")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


#: The same in DuckDB: the search over the list of group sizes, and a byte-wise CRC.
SQL = r"""
with recursive d as (
  select doc_id, coalesce(text, '') as text, row_number() over () as nth from documents),
t as (select list(x order by i) as crc from (
  select i, list_reduce(list_prepend(i::bigint, range(8)::bigint[]),
                        lambda a, b: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end) as x
  from (select unnest(range(256)) as i))),
r as (
  select doc_id, nth, strlen(text) + 8 as size, sha256(text) as h,
         xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(strlen(text)),
               lambda i: ('0x' || hex(encode(text))[2 * i + 1:2 * i + 2])::bigint)),
             lambda a, b: xor(a >> 8, t.crc[(xor(a, b) & 255) + 1])), 4294967295) as text_crc32
  from d, t),
g as (select h, sum(size)::bigint as bytes from r group by h),
top as (select *, row_number() over (order by bytes desc, h) - 1 as n,
               coalesce(sum(bytes) over (order by bytes desc, h rows between unbounded preceding and 1 preceding), 0) as above
        from g qualify n < 24),
alone as (select h, n from top
          where n < coalesce((select min(n) from top
                              where n = 23 or bytes * (24 - n) <= (select sum(bytes) from g) - above), 24)),
rest as (select h, bytes, sum(bytes) over (order by h)::bigint as upto from g where h not in (select h from alone)),
line as (select list({'b': bytes, 'n': 1::bigint} order by h) as sizes, sum(bytes)::bigint as total, max(bytes) as largest,
                24 - (select count(*) from alone) as k from rest),
search as (
  select greatest(largest, -(-total // k))::bigint as low, total as high from line where total > 0
  union all
  select case when fits then low else (low + high) // 2 + 1 end, case when fits then (low + high) // 2 else high end
  from (select low, high,
               list_reduce(sizes, lambda a, x: case when a.b + x.b <= (low + high) // 2
                 then {'b': a.b + x.b, 'n': a.n} else {'b': x.b, 'n': a.n + 1} end).n <= k as fits
        from search, line where low < high)),
capacity as (select low from search where low = high),
filled as (
  select 0 as n, 0::bigint as past, (select max(upto) from rest where upto <= low) as upto, low from capacity
  union all
  select n + 1, upto, (select max(rest.upto) from rest where rest.upto <= filled.upto + low), low from filled
  where upto < (select total from line)),
put as (
  select rest.h, (24 - (select k from line) + f.n)::int as shard
  from rest join filled f on rest.upto > f.past and rest.upto <= f.upto
  union all select h, n::int from alone)
select doc_id, size::bigint as size, text_crc32, 'bytes' as law, shard,
       row_number() over (partition by shard order by h, doc_id nulls first, nth) - 1 as slot, null::int as grown_shard
from r join put using (h)
"""
