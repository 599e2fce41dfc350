"""How document filters interact, from one byte pass over every text.

The pass is a table-driven transducer over UTF-8 bytes.  ``CLASS`` maps a byte to one of
six classes, and a text is read in two states, between words and inside one.  The state
after a byte depends on that byte's class alone, so the state before every byte of a batch
is one table lookup on the byte before it, and ``ACTION[state, class]`` says what the byte
does: open a word, close one, count a code point, a capital, a symbol.  The spans of opened
and closed words go into a hash table (``distinct``): all words probe together, round by
round; a word that meets an occupied slot is compared with the occupant byte by byte, so
equal hashes never count as equal words.

Five filters fail a document (case-sensitive words, maximal runs of bytes other than white
space): A under 50 words; B fewer than 65 distinct words in 100; C over 5 capitals A-Z in
100 code points; D holds a symbol of ``#$%&*|``; E equals the text of a smaller doc_id.
Which filters a document fails is a mask of five bits; everything asked about the 120
orders follows from the documents counted by part, mask and labels.  E comes from the
smallest doc_id of every text (by its SHA-256), added up before the shuffle, and a join on
text and doc_id, so a group of copies is no hot key.

Edge cases: a null text is an empty one (and equal to it): no words, fails A only, and E
where it is repeated; a null doc_id is neither smaller nor larger than another, so it does
not fail E; repeated rows with one doc_id do not fail E by each other; a document with
several label rows has a label that any of them gives; a null part is the empty string;
texts over ``PIECE`` bytes are read in pieces cut at white space, so memory is bounded by
the text itself and a piece (or its longest word); an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storecast.llm.common import add_columns, materialize

SPACE, OTHER, CAPITAL, SYMBOL, LEAD, CONTINUATION = range(6)
BETWEEN, INSIDE = 0, 1
OPEN, CLOSE, POINT, CAP, SYM = 1, 2, 4, 8, 16


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class of a byte; state after a byte of a class; what a byte does, by state and class."""
    kind = np.full(256, OTHER, np.uint8)
    kind[[32, *range(9, 14)]] = SPACE
    kind[ord("A"):ord("Z") + 1] = CAPITAL
    kind[list(b"#$%&*|")] = SYMBOL
    kind[0x80:0xC0], kind[0xC0:] = CONTINUATION, LEAD
    after = np.full(6, INSIDE, np.uint8)
    after[SPACE] = BETWEEN
    does = np.zeros((2, 6), np.uint8)
    does[:, [SPACE, OTHER, CAPITAL, SYMBOL, LEAD]] |= POINT
    does[:, CAPITAL] |= CAP
    does[:, SYMBOL] |= SYM
    does[BETWEEN, [OTHER, CAPITAL, SYMBOL, LEAD, CONTINUATION]] |= OPEN
    does[INSIDE, SPACE] |= CLOSE
    return kind, after, does


CLASS, AFTER, ACTION = _tables()
PIECE = 1 << 20         # bytes read at once
LANES = 8               # words of up to this many 8-byte lanes are hashed and compared in bulk
MIX = np.uint64(0x9E3779B97F4A7C15)


def lanes(data: np.ndarray, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The next (up to 8) bytes from ``at`` as numbers; ``n`` bytes are left.  ``data`` has 8 spare bytes."""
    whole = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))[at]
    keep = np.minimum(n, 8).astype(np.uint64) * np.uint64(8)
    return np.where(n >= 8, whole, whole & ((np.uint64(1) << (keep % np.uint64(64))) - np.uint64(1)))


def hashes(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word."""
    h = size.astype(np.uint64) * MIX
    for j in range(LANES):
        more = np.flatnonzero(size > 8 * j) if j else np.arange(len(size))
        if not len(more):
            break
        x = (h[more] ^ lanes(data, start[more] + 8 * j, size[more] - 8 * j)) * MIX
        h[more] = x ^ (x >> np.uint64(29))
    for i in np.flatnonzero(size > 8 * LANES):
        h[i] = xxhash.xxh64_intdigest(data[start[i]:start[i] + size[i]])
    return h


def equal(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the words of ``size`` bytes at ``a`` and ``b`` are the same bytes."""
    same = np.ones(len(a), bool)
    for j in range(LANES):
        more = np.flatnonzero(same & (size > 8 * j) & (size <= 8 * LANES))
        if not len(more):
            break
        left = size[more] - 8 * j
        same[more] = lanes(data, a[more] + 8 * j, left) == lanes(data, b[more] + 8 * j, left)
    for i in np.flatnonzero(size > 8 * LANES):
        same[i] = np.array_equal(data[a[i]:a[i] + size[i]], data[b[i]:b[i] + size[i]])
    return same


def distinct(data: np.ndarray, text: np.ndarray, start: np.ndarray, size: np.ndarray, hashed=hashes) -> np.ndarray:
    """Which words are the first of their kind in their text: a hash table of word spans.

    Free slots are taken by the first word that probes them; a word whose slot is taken by
    other bytes (or another text) goes on to the next slot of its own step."""
    n = len(start)
    bits = max(1, int(2 * n - 1).bit_length())
    h = (hashed(data, start, size) ^ (text.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))) * MIX
    slot = (h >> np.uint64(64 - bits)).astype(np.int64)
    step = ((h & np.uint64((1 << bits) - 1)) | np.uint64(1)).astype(np.int64)
    taken = np.full(1 << bits, -1, np.int64)
    first = np.zeros(n, bool)
    left = np.arange(n)
    while len(left):
        free = left[taken[slot[left]] < 0]
        taken[slot[free[::-1]]] = free[::-1]            # of several, the first stays
        owner = taken[slot[left]]
        first[left[owner == left]] = True
        same = (h[owner] == h[left]) & (text[owner] == text[left]) & (size[owner] == size[left])
        maybe = np.flatnonzero(same & (owner != left))
        same[maybe] = equal(data, start[owner[maybe]], start[left[maybe]], size[left[maybe]])
        left = left[~same]
        slot[left] = (slot[left] + step[left]) & ((1 << bits) - 1)
    return first


def pieces(data: np.ndarray, offsets: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Byte ranges of about ``most`` bytes: whole texts, or a long one cut before a white space byte."""
    begin, end = int(offsets[0]), int(offsets[-1])
    out, at = [], begin
    while at < end:
        cut = min(at + most, end)
        if cut < end:
            borders = offsets[np.searchsorted(offsets, at, "right"):np.searchsorted(offsets, cut, "right")]
            if len(borders):
                cut = int(borders[-1])
            else:
                stop = int(offsets[np.searchsorted(offsets, cut, "right")])
                while cut < stop:               # no text ends here: on to the next white space
                    some = np.flatnonzero(CLASS[data[cut:min(cut + most, stop)]] == SPACE)
                    if len(some):
                        cut += int(some[0])
                        break
                    cut = min(cut + most, stop)
        out.append((at, cut))
        at = cut
    return out


def scan(texts: pa.Array, piece: int = PIECE) -> dict[str, np.ndarray]:
    """Words, distinct words, code points, capitals and symbols of every text; a null one is empty."""
    texts = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(texts.buffers()[2], np.uint8)[:offsets[-1]] if offsets[-1] else np.zeros(0, np.uint8)
    offsets, data = offsets - offsets[0], np.concatenate([raw[offsets[0]:], np.zeros(8, np.uint8)])
    n = len(texts)
    out = {k: np.zeros(n, np.int64) for k in ("n_words", "n_distinct", "n_points", "n_capitals", "n_symbols")}
    kept: list[tuple[np.ndarray, ...]] = []
    for low, high in pieces(data, offsets, piece):
        kind = CLASS[data[low:high]]
        state = np.empty(high - low, np.uint8)
        state[0], state[1:] = BETWEEN, AFTER[kind[:-1]]       # a piece begins at a text or at white space
        first, last = np.searchsorted(offsets, low, "right") - 1, np.searchsorted(offsets, high, "left")
        borders = offsets[first:last + 1].clip(low, high) - low
        heads = borders[:-1][np.diff(borders) > 0]
        state[heads] = BETWEEN
        act = ACTION[state, kind]

        def count(bit):
            return np.diff(np.searchsorted(np.flatnonzero(act & bit), borders))
        out["n_points"][first:last] += count(POINT)
        out["n_capitals"][first:last] += count(CAP)
        out["n_symbols"][first:last] += count(SYM)
        start = np.flatnonzero(act & OPEN)
        tails = borders[1:][np.diff(borders) > 0]
        end = np.sort(np.concatenate([np.flatnonzero(act & CLOSE), tails[AFTER[kind[tails - 1]] == INSIDE]]))
        text = np.searchsorted(borders, start, "right") - 1 + first
        out["n_words"][first:last] += np.bincount(text - first, minlength=last - first)
        new = distinct(data, text, start + low, end - start)
        kept.append((text[new], start[new] + low, (end - start)[new]))
    if kept:
        text, start, size = (np.concatenate(x) for x in zip(*kept, strict=True))
        again = np.isin(text, np.flatnonzero(np.diff(offsets) > piece)) if len(kept) > 1 else np.zeros(len(text), bool)
        new = ~again
        if again.any():             # words of a text in several pieces meet once more
            new[again] = distinct(data, text[again], start[again], size[again])
        out["n_distinct"] = np.bincount(text[new], minlength=n)
    return out


COUNTS = "n_words long, n_distinct long, n_points long, n_capitals long, n_symbols long"


def counts(docs: DataFrame) -> DataFrame:
    """``docs`` without the text, with the transducer's counts of every whole text."""
    return add_columns(docs, COUNTS, lambda x: [pa.array(v) for v in scan(x).values()], max_bytes=PIECE, keep_text=False)


FILTERS = "ABCDE"


def failures(docs: DataFrame, part: str = "source") -> DataFrame:
    """doc_id, part, the text's hash, and the mask of failed filters A to D of every row."""
    text = F.col("text").cast("string")
    rows = counts(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256)).alias("h"), text.alias("text")))
    fails = (F.col("n_words") < 50, 100 * F.col("n_distinct") < 65 * F.col("n_words"),
             100 * F.col("n_capitals") > 5 * F.col("n_points"), F.col("n_symbols") > 0)
    return rows.select("doc_id", "part", "h", *COUNTS.replace(" long", "").split(", "),
                       sum((f.cast("int") * (1 << k) for k, f in enumerate(fails)), F.lit(0)).alias("mask"))


def cells(fails: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents by part and mask (E included): n, good ones, toxic ones."""
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    key = ["h", "doc_id", "part", "mask", "good", "toxic"]
    rows = materialize(fails.select("doc_id", "part", "h", "mask"), "audit-rows")
    known = rows.where("doc_id is not null").join(marks, "doc_id", "left").fillna(0, ["good", "toxic"])
    tally = materialize(known.groupBy(*key).agg(F.count("*").alias("n")), "audit-tally")
    least = tally.groupBy("h").agg(F.min("doc_id").alias("doc_id"))
    unnamed = rows.where("doc_id is null").groupBy("part", "mask").agg(F.count("*").alias("n")) \
        .withColumns({"good": F.lit(0), "toxic": F.lit(0)})
    cell = ["part", "mask", "good", "toxic"]
    once = tally.join(least, ["h", "doc_id"], "left_semi").select(*cell, "n").unionByName(unnamed.select(*cell, "n"))
    every = tally.select(*cell, "n").unionByName(unnamed.select(*cell, "n"))
    both = every.withColumn("first", F.lit(0).cast("long")).unionByName(
        once.select(*cell, F.lit(0).cast("long").alias("n"), F.col("n").alias("first"))) \
        .groupBy(*cell).agg(F.sum("n").alias("n"), F.sum("first").alias("first"))
    split = both.select("part", "good", "toxic", F.explode(F.array(
        F.struct(F.col("mask").alias("mask"), F.col("first").alias("n")),
        F.struct((F.col("mask") + (1 << 4)).alias("mask"), (F.col("n") - F.col("first")).alias("n")))).alias("x"))
    return split.groupBy("part", F.col("x.mask").alias("mask")).agg(
        F.sum("x.n").alias("n"), F.sum(F.col("x.n") * F.col("good")).alias("good"), F.sum(F.col("x.n") * F.col("toxic")).alias("toxic"))


def _bits(letters: Column) -> Column:
    return sum((F.contains(letters, F.lit(x)).cast("int") * (1 << k) for k, x in enumerate(FILTERS)), F.lit(0))


def orders(found: DataFrame) -> DataFrame:
    """A row for every part, order of the filters and step; ``found`` is what ``cells`` gives."""
    every = F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])
    steps = found.withColumn("filter_order", F.explode(every)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(5))))
    rows = steps.withColumn("own", _bits(F.substr("filter_order", F.col("step"), F.lit(1)))) \
        .withColumn("past", _bits(F.substr("filter_order", F.lit(1), F.col("step") - 1)))
    fails = F.col("mask").bitwiseAND(F.col("own")) != 0
    gone = F.col("mask").bitwiseAND(F.col("past")) != 0
    removed = fails & ~gone
    share = F.expr("120 div greatest(1, bit_count(mask))")       # the orders that have this filter first of the failed ones

    def added(value: Column, when: Column) -> Column:
        return F.sum(F.when(when, value).otherwise(F.lit(0))).cast("long")
    return rows.groupBy("part", "filter_order", "step").agg(
        added(F.col("n"), ~fails & ~gone).alias("kept"), added(F.col("n"), removed).alias("removed"),
        added(F.col("n"), fails & gone).alias("redundant"),
        added(F.col("n"), F.col("mask") == F.col("own")).alias("unique_fails"),
        added(F.col("good"), removed).alias("good_lost"), added(F.col("toxic"), removed).alias("toxic_lost"),
        added(F.col("n") * share, fails).alias("shapley")).withColumn("step", F.col("step").cast("int"))


def audit(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """Per part, order and step: documents kept, removed, redundant, and the rest of the contract."""
    return orders(cells(failures(docs, part), labels))


#: The same in DuckDB, word lists instead of a byte pass.
SQL = r"""
with d as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as words
  from documents),
l as (select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels group by doc_id),
m as (
  select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
         [len(words) < 50, 100 * len(list_distinct(words)) < 65 * len(words),
          100 * (len(text) - len(regexp_replace(text, '[A-Z]', '', 'g'))) > 5 * len(text),
          regexp_matches(text, '[#$%&*|]'),
          coalesce(d.doc_id > min(d.doc_id) over (partition by text), false)] as fails
  from d left join l on d.doc_id = l.doc_id),
c as (select part, fails, count(*) as n, sum(good) as good, sum(toxic) as toxic from m group by all),
x as (select unnest(['A', 'B', 'C', 'D', 'E']) as f),
o as (
  select a.f || b.f || c.f || d.f || e.f as filter_order
  from x a, x b, x c, x d, x e
  where len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
s as (
  select filter_order, step::int as step, ord(filter_order[step]) - 64 as own,
         list_transform(range(1, step), lambda i: ord(filter_order[i]) - 64) as past
  from o, (select unnest(range(1, 6)) as step)),
y as (
  select c.*, filter_order, step, fails[own] as failed,
         len(list_filter(past, lambda i: fails[i])) > 0 as gone, len(list_filter(fails, lambda v: v)) as n_failed
  from c, s),
k as (
  select part, filter_order, step,
         coalesce(sum(n) filter (not failed and not gone), 0)::bigint as kept,
         coalesce(sum(n) filter (failed and not gone), 0)::bigint as removed,
         coalesce(sum(n) filter (failed and gone), 0)::bigint as redundant,
         coalesce(sum(n) filter (failed and n_failed = 1), 0)::bigint as unique_fails,
         coalesce(sum(good) filter (failed and not gone), 0)::bigint as good_lost,
         coalesce(sum(toxic) filter (failed and not gone), 0)::bigint as toxic_lost
  from y group by part, filter_order, step)
select *, (sum(removed) over (partition by part, filter_order[step]))::bigint as shapley from k
"""
