"""SimHash near-duplicate groups through a Gray-order hierarchical index.

Fingerprint: A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``, shingles of
``shingle`` words joined by a space (repeats count, fewer words: the whole
sequence), XXH64 with seed 42; a bit is set if it is set in over half of the
hashes.  A text without words (or null) has fingerprint zero.

Links: all pairs of distinct fingerprints at ``max_bits`` or fewer differing
bits.  Two such fingerprints agree on at least one of ``max_bits + 1`` bit
blocks, so the top nodes of the index are (block, value of the block).  Below a
top node the fingerprints are sorted by Gray rank and packed into a tree whose
nodes hold the bits that all members share (mask and pattern); a query walks
down, adds the differences on the newly masked bits, and drops a whole node
once they exceed ``max_bits`` (or once all its members are in the query's
component already).  A top node over ``max_group`` fingerprints is cut by a
second block of the remaining bits; one still over it is linked through the
points at half the distance, whose groups are bounded.  No link is lost.

Edge cases: repeated rows and equal texts share a fingerprint and a component;
rows with a null doc_id get the component of their fingerprint; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storecast.llm.common import connected_components, fresh, materialize

SEED = 42
FANOUT = 8
U64 = np.uint64


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """The 64-bit fingerprint of one text, as an unsigned number."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    start, end = (end - size)[: len(words) - shingle + 1], end[shingle - 1:]
    ones, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for i in range(0, len(end), 1 << 16):
        s, e = start[i:i + (1 << 16)].tolist(), end[i:i + (1 << 16)].tolist()
        h = np.fromiter([digest(joined[a:b], SEED) for a, b in zip(s, e, strict=True)], U64, len(s))
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * ones > len(end)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(U64)[0])


def _fingerprint_batches(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [fingerprint(t.as_py(), shingle) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("row"),
                                              pa.array(np.array(fps, U64).view(np.int64))], ["doc_id", "row", "fp"])
    return run


def row_hash(docs: DataFrame) -> Column:
    """A hash of all columns of a row that can be hashed."""
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in docs.schema.fields if not f.dataType.typeName() in ("map", "variant")])


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """(doc_id, row, fp): row is a hash of the whole row, fp the fingerprint's 64 bits as a signed long."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_hash(docs).alias("row"),
                       F.col("text").cast("string").alias("text")) \
        .mapInArrow(_fingerprint_batches(shingle), "doc_id long, row long, fp long")


def gray_rank(v: np.ndarray) -> np.ndarray:
    """Position of each 64-bit pattern in the reflected Gray sequence."""
    v = v.copy()
    for s in (1, 2, 4, 8, 16, 32):
        v ^= v >> U64(s)
    return v


def blocks(bits: int, parts: int) -> list[int]:
    """The set bits of ``bits`` dealt into ``parts`` runs, as masks."""
    at = [i for i in range(64) if bits >> i & 1]
    return [sum(1 << i for i in run.tolist()) for run in np.array_split(np.array(at), parts)]


def _top_nodes(masks: list[int], per: int):
    """A row (node, value of its bits, Gray rank, fp) for every fingerprint and
    each of its ``per`` masks: all of them, or those below its hot node."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = b.column("fp").to_numpy(zero_copy_only=False).view(U64)
            if not len(v):
                continue
            rank = (gray_rank(v) ^ U64(1 << 63)).view(np.int64)
            above = b.column("node").to_numpy(zero_copy_only=False) if "node" in b.schema.names else np.zeros(len(v), int)
            for k in range(per):
                node = above * per + k
                m = np.array(masks, U64)[node]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node.astype(np.int32)), pa.array((v & m).view(np.int64)), pa.array(rank),
                     pa.array(v.view(np.int64))], ["node", "value", "rank", "fp"])
    return run


TOP = "node int, value long, rank long, fp long"


class _Index:
    """The tree over the sorted fingerprints of whole top nodes."""

    def __init__(self, v: np.ndarray, starts: np.ndarray):
        ends = np.append(starts[1:], len(v))
        self.v, low, high = v, v, v
        first, last = np.arange(len(v)), np.arange(1, len(v) + 1)
        self.levels = [(np.full(len(v), ~U64(0)), v, first, last, None, None)]  # mask, pattern, members, children
        group = np.repeat(np.arange(len(starts)), ends - starts)
        while len(group) > len(starts):
            gs = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
            n = np.diff(np.append(gs, len(group)))
            pos = np.arange(len(group)) - np.repeat(gs, n)
            cut = np.flatnonzero(pos % FANOUT == 0)
            low, high = np.bitwise_and.reduceat(low, cut), np.bitwise_or.reduceat(high, cut)
            until = np.append(cut[1:], len(group))
            first, last, group = first[cut], last[until - 1], group[cut]
            mask = ~(low ^ high)
            self.levels.append((mask, low & mask, first, last, cut, until))
        self.root = np.repeat(np.arange(len(starts)), ends - starts)

    def pairs(self, q: np.ndarray, label: np.ndarray, spans: list, max_bits: int):
        """Linked pairs (i, j), i < j, for the query positions ``q``."""
        node = self.root[q]
        mask, pattern, *_ = self.levels[-1]
        acc = np.bitwise_count((self.v[q] ^ pattern[node]) & mask[node]).astype(np.int16)
        for level in range(len(self.levels) - 1, 0, -1):
            mask, _, _, _, cut, until = self.levels[level]
            n = until[node] - cut[node]
            child = np.repeat(cut[node], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            q, acc, above = np.repeat(q, n), np.repeat(acc, n), np.repeat(mask[node], n)
            cmask, cpattern, _, clast, _, _ = self.levels[level - 1]
            acc = acc + np.bitwise_count((self.v[q] ^ cpattern[child]) & cmask[child] & ~above)
            lo, hi = spans[level - 1]
            keep = (acc <= max_bits) & (clast[child] > q + 1) & ~((lo[child] == hi[child]) & (lo[child] == label[q]))
            q, acc, node = q[keep], acc[keep], child[keep]
        return q, node

    def spans(self, label: np.ndarray) -> list:
        """Smallest and largest component of every node's members, by level."""
        out = [(label, label)]
        for _, _, _, _, cut, _ in self.levels[1:]:
            lo, hi = out[-1]
            out.append((np.minimum.reduceat(lo, cut), np.maximum.reduceat(hi, cut)))
        return out


def _union(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Component labels after joining the components of i and j."""
    a, b = label[i], label[j]
    both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)])[:, a != b], axis=1)
    if not both.size:
        return label
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while (p := parent.get(x, x)) != x:
            parent[x] = parent.get(p, p)
            x = p
        return x

    for x, y in both.T.tolist():
        x, y = sorted((find(x), find(y)))
        parent[y] = x
    move = np.arange(len(label))
    for x in list(parent):
        move[x] = find(x)
    return move[label]


def link_group(v: np.ndarray, starts: np.ndarray, max_bits: int) -> np.ndarray:
    """For every fingerprint the position of its component's first member,
    components being those of links within a group; ``v`` is sorted by Gray
    rank within each group.  Queries go in steps that bound the memory."""
    index, label = _Index(v, starts), np.arange(len(v))
    if len(index.levels) == 1:
        return label
    step = max(16, min(4096, (1 << 24) // int(np.diff(np.append(starts, len(v))).max())))
    for at in range(0, len(v), step):
        i, j = index.pairs(np.arange(at, min(at + step, len(v))), label, index.spans(label), max_bits)
        label = _union(label, i, j)
    return label


def _link(max_bits: int, buffer: int = 1 << 17):
    """Edges (fp, fp of the component) within the top nodes of a sorted partition."""
    def edges(node: np.ndarray, value: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
        starts = np.flatnonzero(np.r_[True, (node[1:] != node[:-1]) | (value[1:] != value[:-1])])
        label = link_group(v, starts, max_bits)
        moved = label != np.arange(len(v))
        return pa.RecordBatch.from_arrays([pa.array(v[moved].view(np.int64)),
                                           pa.array(v[label[moved]].view(np.int64))], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for b in batches:
            held.append(tuple(b.column(c).to_numpy(zero_copy_only=False) for c in ("node", "value", "fp")))
            if sum(len(x[0]) for x in held) < buffer:
                continue
            node, value, fp = (np.concatenate(x) for x in zip(*held, strict=True))
            other = np.flatnonzero((node != node[-1]) | (value != value[-1]))
            cut = other[-1] + 1 if len(other) else 0  # the last group may go on in the next batch
            if cut:
                yield edges(node[:cut], value[:cut], fp[:cut].view(U64))
            held = [(node[cut:], value[cut:], fp[cut:])]
        if held and sum(len(x[0]) for x in held):
            node, value, fp = (np.concatenate(x) for x in zip(*held, strict=True))
            yield edges(node, value, fp.view(U64))
    return run


def _midpoints(masks: list[int], max_bits: int):
    """(point, fp) for every point within half of ``max_bits`` (rounded up) on
    the bits outside the node's mask: linked fingerprints share a point, and a
    point's group is bounded by the number of such flips."""
    def flips(mask: int) -> np.ndarray:
        free = [1 << i for i in range(64) if not mask >> i & 1]
        return np.array([sum(c) for r in range((max_bits + 1) // 2 + 1) for c in combinations(free, r)], U64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready: dict[int, np.ndarray] = {}
        for b in batches:
            for node, fp in zip(b.column("node").to_pylist(), b.column("fp").to_numpy(zero_copy_only=False),
                                strict=True):
                if node not in ready:
                    ready[node] = flips(masks[node])
                f = ready[node]
                yield pa.RecordBatch.from_arrays(
                    [pa.array((fp.view(U64) ^ f).view(np.int64)), pa.array(np.full(len(f), fp))], ["point", "fp"])
    return run


def links(fps: DataFrame, max_bits: int = 4, max_group: int = 1 << 18) -> DataFrame:
    """Edges (a, b) that connect exactly the components of all pairs of the
    distinct fingerprints ``fp`` at ``max_bits`` or fewer differing bits."""
    masks = blocks((1 << 64) - 1, max_bits + 1)
    below = [m | sub for m in masks for sub in blocks(~m & ((1 << 64) - 1), max_bits + 1)]
    top = fps.select("fp").mapInArrow(_top_nodes(masks, max_bits + 1), TOP)
    hot = materialize(top.groupBy("node", "value").count().where(F.col("count") > max_group)
                      .select("node", "value"), "simhash-hot")

    def linked(rows: DataFrame) -> DataFrame:
        return rows.repartition("node", "value").sortWithinPartitions("node", "value", "rank") \
            .mapInArrow(_link(max_bits), "a long, b long")

    if hot.isEmpty():
        return linked(top)
    edges = linked(top.join(hot, ["node", "value"], "left_anti").select("node", "value", "rank", "fp"))
    second = top.join(hot, ["node", "value"], "left_semi").select("fp", "node").mapInArrow(_top_nodes(below, max_bits + 1), TOP)
    hotter = materialize(second.groupBy("node", "value").count().where(F.col("count") > max_group)
                         .select("node", "value"), "simhash-hotter")
    edges = edges.unionByName(linked(second.join(hotter, ["node", "value"], "left_anti")
                                     .select("node", "value", "rank", "fp")))
    points = second.join(hotter, ["node", "value"], "left_semi").select("node", "fp") \
        .mapInArrow(_midpoints(below, max_bits), "point long, fp long")
    if max_bits % 2:  # two fingerprints of one point could then differ by a bit more
        raise ValueError("top nodes over max_group need an even max_bits")
    least = points.groupBy("point").agg(F.min("fp").alias("b"))
    return edges.unionByName(points.join(least, "point").select(F.col("fp").alias("a"), "b"))


def components(docs: DataFrame, shingle: int = 4, max_bits: int = 4, max_group: int = 1 << 18) -> DataFrame:
    """(doc_id, row, fp, root) for every row of ``docs``; rows of a component share ``root``."""
    own = materialize(fingerprints(docs, shingle), "simhash-fp")
    fps = materialize(own.select("fp").distinct(), "simhash-distinct")
    roots = connected_components(links(fps, max_bits, max_group))
    return own.join(roots, own.fp == roots.node, "left").select("doc_id", "row", "fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4, max_group: int = 1 << 18) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, the smallest
    doc_id that links reach, for every row of ``docs``."""
    own = components(docs.select("doc_id", "text"), shingle, max_bits, max_group)
    least = own.groupBy("root").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("n"))
    # only components of two or more rows, written so that the planner knows their size: broadcast
    # while small, else shuffled, where adaptive execution splits the rows of a hot component
    least = materialize(least.where("n > 1").select("root", "component_id"), "simhash-least")
    return own.join(least, "root", "left") \
        .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, shingle: int = 4, max_bits: int = 4, max_group: int = 1 << 18) -> DataFrame:
    """The rows of ``docs`` of smallest doc_id in each component (nulls last;
    of rows that share it, the smallest row hash; of equal rows, one)."""
    row, number, keep_id, keep_row = fresh(docs, "_row", "_number", "_keep_id", "_keep_row")
    first = components(docs, shingle, max_bits, max_group).groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("k")) \
        .select(F.col("k.doc_id").alias(keep_id), F.col("k.row").alias(keep_row))
    first = materialize(first, "simhash-keep")  # its size is known then: broadcast only while small
    kept = docs.withColumn(row, row_hash(docs)).join(
        first, F.col("doc_id").cast("long").eqNullSafe(F.col(keep_id)) & (F.col(row) == F.col(keep_row)), "left_semi")
    equal = Window.partitionBy("doc_id", row).orderBy(row)
    return kept.withColumn(number, F.row_number().over(equal)).where(F.col(number) == 1).drop(row, number)
