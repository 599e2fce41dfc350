"""Passages that repeat across documents, through a sparse suffix array.

A passage is a window of ``min_words`` words (``[^\\x20\\x09-\\x0D]+``, as they are)
that stands in two or more documents; all such windows are found.

1. Sampling: of the first k-grams of a window the one with the smallest hash is
   its minimiser.  It depends on the window's words alone, so equal windows have
   it at the same place.  Only the suffixes that begin at minimisers are kept,
   each with the range of window starts that it stands for.
2. Sorting: the kept suffixes are sorted by their first words (as far as every
   window of the range goes), then by the whole stretch of the range, and
   compared to their neighbours.  A suffix without a neighbour from another
   document is done with.  A stretch that is whole in another document is a
   match in all its windows.
3. Extension: where only part of a stretch matches, its windows are compared one
   by one, to the left and right of the minimiser; of equal whole stretches
   one takes part, and its windows stand for the smallest and the largest of its
   documents, so a window that a part-equal stretch repeats is seen in both.

Words are compared by 128-bit hashes (64 bits only to propose).  Sorting is by
(hash, document), so a passage that a third of all documents share is dealt over
many tasks.  A task compares ``CHUNK`` rows at a time and holds no more than about two
such chunks; a run that goes on in another task, or is longer than a chunk, is put
together by a table of two rows a task and two a chunk of such a run.

Edge cases: null, empty and shorter texts have no passage; rows of one doc_id
are one document, so what only they share is no repeat; null doc_ids are one
document too, apart from every id; rows of one doc_id are told apart by 64 bits of
hash of their texts; repeated rows are reported once; equal suffixes (ties) are
ordered by document, text and place, and of several other documents the smallest or
the largest is named; a very long text is hashed as a whole, about 100 bytes a word;
empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storecast.llm.common import materialize, slices

U64 = np.uint64
GRAM = 8
CHUNK = 1 << 18
FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd, so invertible modulo 2 ** 64


def words_of(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words of all texts in a row, and where each text's begin."""
    split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat = split.flatten()
    real = pc.not_equal(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    ends = np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy())])
    begin = np.concatenate([[0], np.cumsum(real)])[ends]
    return flat.filter(pa.array(real)).dictionary_encode(), begin


class Hashes:
    """Hashes of any stretch of words in a batch of texts, from prefix sums."""

    def __init__(self, words: pa.DictionaryArray):
        names = words.dictionary.to_pylist()
        at = words.indices.to_numpy(zero_copy_only=False)
        self.sums, self.back = [], []
        for seed, factor in enumerate(FACTORS):
            h = np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in names), U64, len(names))[at]
            power = np.ones(len(at) + 1, U64)
            np.cumprod(np.full(len(at), factor, U64), out=power[1:])
            inverse = np.ones(len(at) + 1, U64)
            np.cumprod(np.full(len(at), pow(factor, -1, 1 << 64), U64), out=inverse[1:])
            self.sums.append(np.concatenate([np.zeros(1, U64), np.cumsum(h * power[:-1])]))
            self.back.append(inverse)

    def of(self, start: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
        h = (self.sums[which][end] - self.sums[which][start]) * self.back[which][start]
        h = (h ^ (h >> U64(32))) * U64(0xD6E8FEB86659FD93) + (end - start).astype(U64)
        return h ^ (h >> U64(29))


def sample(begin: np.ndarray, hashes: Hashes, min_words: int, span: int) -> Iterator[np.ndarray]:
    """Arrays (text, minimiser, first and last window start), places in the batch."""
    n = int(begin[-1])
    if n < min_words:
        return
    at = np.arange(n - GRAM + 1)
    low = (hashes.of(at, at + GRAM) >> U64(32) << U64(32)) | at.astype(U64)
    width = 1
    while width < span:  # smallest of the span from each place, and where it stands
        step = min(width, span - width)
        low = np.minimum(low[:-step], low[step:])
        width += step
    size = np.diff(begin)
    starts = np.repeat(size >= min_words, size)
    starts &= np.arange(n) <= np.repeat(begin[1:] - min_words, size)
    start = np.flatnonzero(starts)
    place = (low[start] & U64(0xFFFFFFFF)).astype(np.int64)
    text = np.searchsorted(begin, start, side="right") - 1
    new = np.r_[True, (place[1:] != place[:-1]) | (text[1:] != text[:-1])] if len(start) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    yield text[first]
    yield place[first]
    yield start[first]
    yield start[np.append(first[1:], len(start))[:len(first)] - 1]


def _samples(min_words: int, span: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text")
            for i, j in slices(texts):
                words, begin = words_of(texts.slice(i, j - i))
                if begin[-1] < min_words:
                    continue
                h = Hashes(words)
                text, place, lo, hi = sample(begin, h, min_words, span)
                row = pa.array(i + text)
                yield pa.RecordBatch.from_arrays([
                    b.column("doc").take(row), b.column("row").take(row), pa.array((lo - begin[text]).astype(np.int32)),
                    pa.array((hi - begin[text]).astype(np.int32)),
                    pa.array(h.of(place, place + min_words - span + 1).view(np.int64)),
                    pa.array(h.of(lo, hi + min_words).view(np.int64)), pa.array(h.of(lo, hi + min_words, 1).view(np.int64))],
                    ["doc", "row", "lo", "hi", "key", "big", "big2"])
    return run


def _windows(min_words: int):
    """The hash of each window that begins in one of the ranges of a text, and how far
    beyond the text's document the largest one is that the range is known from."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text")
            for i, j in slices(texts):
                words, begin = words_of(texts.slice(i, j - i))
                h, ranges = Hashes(words), b.column("ranges").slice(i, j - i)
                n = pc.list_value_length(ranges).to_numpy(zero_copy_only=False)
                lo, hi, far = (x.to_numpy(zero_copy_only=False).astype(np.int64) for x in ranges.flatten().flatten())
                # a difference, for it is mostly 0 and packs well; it may wrap around, and back
                beyond = far - np.repeat(b.column("doc").slice(i, j - i).to_numpy(zero_copy_only=False), n)
                text, size = np.repeat(np.arange(j - i), n), hi - lo + 1
                start = np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(size.sum())
                text = np.repeat(text, size)
                at, row = start + begin[text], pa.array(i + text)
                yield pa.RecordBatch.from_arrays([
                    b.column("doc").take(row), b.column("row").take(row), pa.array(start.astype(np.int32)),
                    pa.array(np.repeat(beyond, size)),
                    pa.array(h.of(at, at + min_words).view(np.int64)), pa.array(h.of(at, at + min_words, 1).view(np.int64))],
                    ["doc", "row", "lo", "beyond", "h", "h2"])
    return run


def _chunks(batches: Iterator[pa.RecordBatch], level: list[str], size: int) -> Iterator[tuple[pa.Table, bool, bool]]:
    """A sorted partition in tables of about ``size`` rows that end with a run of equal
    keys, or within one that is longer; and if the first and the last run may go on
    in rows outside the table."""
    held: list[pa.RecordBatch] = []
    rows, opened = 0, True
    for b in batches:
        if b.num_rows:
            held.append(b)
            rows += b.num_rows
        if rows < size:
            continue
        t = pa.Table.from_batches(held).combine_chunks()
        last = np.zeros(rows - 1, bool)
        for c in level:
            v = t[c].to_numpy()
            last |= v[1:] != v[:-1]
        cut = int(np.flatnonzero(last)[-1]) + 1 if last.any() else 0
        whole = cut > 0
        yield t.slice(0, cut if whole else rows), opened, not whole
        opened = not whole
        held = t.slice(cut).to_batches() if whole else []
        rows = rows - cut if whole else 0
    if rows:
        yield pa.Table.from_batches(held).combine_chunks(), opened, True


def _compare(levels: list[list[str]], names: list[str], size: int):
    """Each row of a sorted partition with, for each level of keys, the smallest and
    largest document of its run of equal keys, and if the run may go on elsewhere.
    A row with ``beyond`` stands for the document that far beyond its own, too; it
    is a match already and passed on only where its run may go on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, before, after in _chunks(batches, levels[0], size):
            doc = t["doc"].to_numpy()
            new = np.zeros(len(doc) - 1, bool)
            beyond = t["beyond"].to_numpy() if "beyond" in t.column_names else np.zeros(len(doc), np.int64)
            far, wanted = doc + beyond, beyond == 0
            cols = [t[c] for c in names[:len(names) - 3 * len(levels)]]
            for level in levels:
                for c in level:
                    v = t[c].to_numpy()
                    new |= v[1:] != v[:-1]
                first = np.flatnonzero(np.r_[True, new])
                length = np.diff(np.append(first, len(doc)))
                edge = np.zeros(len(first), bool)
                edge[0] |= before
                edge[-1] |= after
                wanted |= np.repeat(edge, length)
                cols += [pa.array(np.repeat(x, length)) for x in
                         (np.minimum.reduceat(doc, first), np.maximum.reduceat(far, first), edge)]
            yield from pa.Table.from_arrays(cols, names=names).filter(pa.array(wanted)) \
                .to_batches(max_chunksize=1 << 16)
    return run


def sort_and_compare(rows: DataFrame, levels: list[list[str]], name: str, chunk: int = CHUNK) -> DataFrame:
    """The rows whose key of the first level stands in two or more documents.

    ``levels`` are keys, each level adding columns to those before; for each
    level i the result has ``least_i`` and ``most_i``, the smallest and largest
    document with the same key.
    """
    keys = [c for level in levels for c in level]
    order = [*keys, "doc", "row", "lo"]
    more = [x for i in range(len(levels)) for x in (f"least_{i}", f"most_{i}", f"edge_{i}")]
    kept = [f for f in rows.schema.fields if f.name != "beyond"]
    ddl = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in kept]
                    + [f"{x} {'boolean' if x.startswith('edge') else 'bigint'}" for x in more])
    near = rows.repartitionByRange(*order).sortWithinPartitions(*order) \
        .mapInArrow(_compare(levels, [*[f.name for f in kept], *more], chunk), ddl)
    near = materialize(near.where("least_0 < most_0 or edge_0"), name)
    upto: list[str] = []
    for i, level in enumerate(levels):
        upto = [*upto, *level]
        # two keys a task or chunk of a long run; written, so that the planner knows how small it is
        cross = materialize(near.where(f"edge_{i}").groupBy(*upto).agg(F.min(f"least_{i}").alias("lo_doc"), F.max(
            f"most_{i}").alias("hi_doc")), name + "-edges")
        near = near.join(cross, upto, "left") \
            .withColumn(f"least_{i}", F.coalesce("lo_doc", f"least_{i}")) \
            .withColumn(f"most_{i}", F.coalesce("hi_doc", f"most_{i}")).drop("lo_doc", "hi_doc")
    return near.where("least_0 < most_0").drop(*[f"edge_{i}" for i in range(len(levels))])


def _spans(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for doc, pieces in zip(b.column("doc").to_pylist(), b.column("pieces").to_pylist(), strict=True):
                start = end = other = None
                for p in sorted(pieces, key=lambda p: (p["lo"], p["hi"])):
                    if end is None or p["lo"] > end:
                        if end is not None:
                            out.append((doc, start, end, end - start, other))
                        start, end, other = p["lo"], p["hi"] + min_words, p["other"]
                    end, other = max(end, p["hi"] + min_words), min(other, p["other"])
                out.append((doc, start, end, end - start, other))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in range(5)],
                                             ["doc", "start_word", "end_word", "n_words", "other"])
    return run


def stand_in(docs: DataFrame, block: int = 64) -> int:
    """A number that is no doc_id of ``docs``, for the null ones: the smallest free one."""
    ids, low = docs.select(F.col("doc_id").cast("long").alias("doc")), -(1 << 63)
    while True:  # at most ``block`` rows reach the driver
        taken = {r.doc for r in ids.where(F.col("doc").between(low, low + block - 1)).distinct().collect()}
        if len(taken) < block:
            return next(k for k in range(low, low + block) if k not in taken)
        low += block


def repeats(docs: DataFrame, min_words: int = 50, span: int = 32, chunk: int = CHUNK) -> DataFrame:
    """doc_id, start_word, end_word (exclusive), n_words and other_doc_id for every
    stretch of a document that repeated windows cover; other_doc_id is another
    document that has one of them.  ``span`` k-grams are looked at for a
    minimiser: more of them mean fewer suffixes and shorter sort keys.  ``chunk`` rows are
    compared at a time."""
    if not 1 <= span <= min_words - GRAM + 1:
        raise ValueError("span must be from 1 to min_words - 7")
    none = F.lit(stand_in(docs))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), none).alias("doc"),
                       F.col("text").cast("string").alias("text")).withColumn("row", F.xxhash64("text"))
    kept = materialize(rows.mapInArrow(
        _samples(min_words, span), "doc long, row long, lo int, hi int, key long, big long, big2 long"), "suffixes")
    near = materialize(sort_and_compare(kept, [["key"], ["big", "big2"]], "suffix-runs", chunk), "suffix-candidates")
    whole = F.col("least_1") < F.col("most_1")
    parts = near.where(~whole | (F.col("doc") == F.col("least_1"))).groupBy("doc", "row").agg(
        F.collect_set(F.struct("lo", "hi", F.when(whole, F.col("most_1")).otherwise(F.col("doc")).alias("far")))
        .alias("ranges"))
    single = rows.join(parts, ["doc", "row"]).select("doc", "row", "text", "ranges").mapInArrow(
        _windows(min_words), "doc long, row long, lo int, beyond long, h long, h2 long")
    windows = sort_and_compare(materialize(single, "suffix-windows"), [["h", "h2"]], "suffix-window-runs", chunk)

    def other(i: int):
        return F.when(F.col(f"least_{i}") == F.col("doc"), F.col(f"most_{i}")).otherwise(F.col(f"least_{i}"))

    pieces = near.where(whole).select("doc", "row", "lo", "hi", other(1).alias("other")).unionByName(
        windows.select("doc", "row", "lo", F.col("lo").alias("hi"), other(0).alias("other")))
    found = pieces.groupBy("doc", "row").agg(F.collect_set(F.struct("lo", "hi", "other")).alias("pieces")) \
        .mapInArrow(_spans(min_words), "doc long, start_word long, end_word long, n_words long, other long")
    return found.select(F.nullif("doc", none).alias("doc_id"), "start_word", "end_word", "n_words",
                        F.nullif("other", none).alias("other_doc_id"))


#: The spans in DuckDB SQL over ``documents``: every window as text.
SQL = r"""
with d as (select distinct doc_id, text from documents where text is not null),
w as (
  select row_number() over () as r, doc_id,
         list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') as words from d),
win as (
  select r, doc_id, s, array_to_string(words[s + 1:s + 50], ' ') as win
  from (select r, doc_id, words, unnest(range(0, len(words) - 49)) as s from w where len(words) >= 50)),
rep as (
  select win from win group by win having count(distinct doc_id) + max((doc_id is null)::int) >= 2),
hit as (select r, doc_id, s, lag(s) over (partition by r order by s) as before from win semi join rep using (win)),
span as (
  select r, doc_id, s, sum(case when before is null or s > before + 50 then 1 else 0 end)
                         over (partition by r order by s) as k from hit)
select doc_id, min(s)::bigint as start_word, (max(s) + 50)::bigint as end_word,
       (max(s) + 50 - min(s))::bigint as n_words
from span group by r, doc_id, k
"""
