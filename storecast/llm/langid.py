"""Language identification with bit-sliced Bloom filters over letter n-grams.

One Bloom filter a language, stored bit-sliced: row r of the table is a bitmask
of the languages whose filter has bit r, so the AND of an n-gram's rows gives
all languages that contain it at once.  A text's popcounts by language are
corrected for each filter's false positive rate (fill ** hashes); the largest
corrected count decides, and the score is its share of the text's n-grams.

Learning takes up to ``sample_docs`` documents of every language (the bound is a
parameter; they are chosen by a hash of doc_id, and read whole).  An n-gram
belongs to a language if two of its documents have it (one, if there is only
one) and its share there is at least ``min_ratio`` of its largest share in any
language; that keeps quotations in other languages out of a filter.

Edge cases: ``und`` and score 0 where the text is null or has no letter, or
nothing was learned; a text with letters but without known n-grams gets the
first language with score 0; ties go to the first language in sorted order.
Rows with a null lang or doc_id are never learned from, and are predicted like any
other; repeated rows give repeated results; other columns pass through, one
named like a result is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storecast.llm.common import add_columns, materialize

U64 = np.uint64
LENGTHS = (2, 3, 4)


@lru_cache(1)
def _letters() -> np.ndarray:
    """Lower-case code point of every letter, 0 for every other character."""
    out = np.zeros(0x110000, np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


def ngrams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram length: the hashes of all texts' n-grams, and where each text's begin.

    Letters are lower-cased and every run of other characters counts as one
    space; an n-gram may begin or end with a space but has none inside.
    """
    joined = "\n" + "\n".join(texts) + "\n"
    code = _letters()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
    begin = np.cumsum([0, *(len(t) + 1 for t in texts)])
    letter = code > 0
    keep = letter.copy()
    keep[1:] |= letter[:-1]       # the space after a word
    keep[begin[:-1]] = True       # and the one before a text
    at = np.concatenate([[0], np.cumsum(keep)])[begin]
    c = code[keep].astype(U64)
    space = c == 0
    for n in LENGTHS:
        if len(c) < n:
            yield np.zeros(0, U64), np.zeros(len(begin), np.int64)
            continue
        size = len(c) - n + 1
        h, ok = np.full(size, n, U64), np.ones(size, bool)
        for k in range(n):
            h = h * U64(0x100000001B3) + c[k:k + size]
            if 0 < k < n - 1:
                ok &= ~space[k:k + size]
        ok &= ~(space[:size] & space[n - 1:n - 1 + size]) if n == 2 else True
        where = np.concatenate([[0], np.cumsum(ok)])[np.minimum(at, size)]
        h = h[ok]
        h ^= h >> U64(31)
        h *= U64(0x9E3779B97F4A7C15)
        yield h ^ (h >> U64(29)), where


def positions(h: np.ndarray, hashes: int, rows_log2: int) -> Iterator[np.ndarray]:
    """The table rows of every n-gram hash, one array a hash function."""
    step, mask = (h >> U64(32)) | U64(1), U64((1 << rows_log2) - 1)
    for k in range(hashes):
        yield ((h + U64(k) * step) & mask).astype(np.int64)


@dataclass
class Filters:
    """languages in sorted order; table[w, r]: the languages 64 w to 64 w + 63 of row r."""
    languages: list[str]
    table: np.ndarray
    hashes: int

    @property
    def rows_log2(self) -> int:
        return int(self.table.shape[1]).bit_length() - 1

    def false_positive(self) -> np.ndarray:
        fill = [((self.table[i // 64] >> U64(i % 64)) & U64(1)).mean() for i in range(len(self.languages))]
        return np.array(fill) ** self.hashes

    def predict(self, texts: list[str | None], rates: np.ndarray) -> tuple[list[str], list[float]]:
        hits = np.zeros((len(self.languages), len(texts)))
        total = np.zeros(len(texts))
        if not self.languages:
            return ["und"] * len(texts), [0.0] * len(texts)
        for h, where in ngrams([t or "" for t in texts]):
            total += np.diff(where)
            at = list(positions(h, self.hashes, self.rows_log2))
            for w, rows in enumerate(self.table):
                found = rows[at[0]]
                for p in at[1:]:
                    found &= rows[p]
                for i in range(64 * w, min(64 * w + 64, len(self.languages))):
                    ones = np.concatenate([[0], np.cumsum((found >> U64(i % 64)) & U64(1), dtype=np.int64)])
                    hits[i] += np.diff(ones[where])
        true = np.clip((hits - total * rates[:, None]) / np.maximum(1 - rates[:, None], 1e-9), 0, None)
        best = true.argmax(0)
        score = np.clip(true[best, np.arange(len(texts))] / np.maximum(total, 1), 0, 1)
        return [self.languages[b] if n else "und" for b, n in zip(best, total, strict=True)], \
            np.where(total > 0, score, 0.0).tolist()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist(), strict=True):
            for h, _ in ngrams([text or ""]):
                gram, n = np.unique(h, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram), pa.string()), pa.array(gram.view(np.int64)),
                                                  pa.array(n)], ["lang", "gram", "n"])


def learn(docs: DataFrame, sample_docs: int = 400, min_ratio: float = 0.2, hashes: int = 2,
          rows_log2: int = 20) -> Filters:
    """Filters from the text and lang of ``docs`` (doc_id only chooses the sample).

    What reaches the driver is the list of languages and the filter table, at
    most ``2 ** rows_log2`` rows whatever the input.
    """
    known = docs.where("lang is not null and text is not null and doc_id is not null") \
        .select(F.col("lang").cast("string").alias("lang"), F.col("doc_id").cast("long").alias("doc_id"),
                F.col("text").cast("string").alias("text"))
    ids = known.select("lang", "doc_id").withColumn("at", F.xxhash64("doc_id"))
    for keys in (["lang", F.pmod("at", F.lit(32))], ["lang"]):  # in two steps: no task gets a whole language
        first = Window.partitionBy(*keys).orderBy("at", "doc_id")
        ids = ids.withColumn("rn", F.row_number().over(first)).where(F.col("rn") <= sample_docs).drop("rn")
    # at most sample_docs ids a language
    sample = materialize(known.join(F.broadcast(ids.select("lang", "doc_id").distinct()), ["lang", "doc_id"], "left_semi")
                         .select("lang", "text").repartition(32, F.xxhash64("text")), "langid-sample")
    sizes = {r.lang: r.n for r in sample.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    words = max(1, -(-len(languages) // 64))
    filters = np.zeros((words, 1 << rows_log2), U64)
    if languages:
        grams = sample.mapInArrow(_count, "lang string, gram long, n long") \
            .groupBy("lang", "gram").agg(F.sum("n").alias("n"), F.count("*").alias("docs"))
        share = F.col("n") / F.sum("n").over(Window.partitionBy("lang"))
        index = F.create_map(*[F.lit(x) for i, lang in enumerate(languages) for x in (lang, i)])[F.col("lang")]
        least = F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(2, sizes[lang]))])[F.col("lang")]
        kept = grams.withColumn("share", share) \
            .withColumn("top", F.max("share").over(Window.partitionBy("gram"))) \
            .where((F.col("share") >= min_ratio * F.col("top")) & (F.col("docs") >= least)) \
            .select("gram", index.alias("i"))

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                h, i = (b.column(c).to_numpy(zero_copy_only=False) for c in ("gram", "i"))
                bit = (U64(1) << (i % 64).astype(U64)).view(np.int64)
                for p in positions(h.view(U64), hashes, rows_log2):
                    yield pa.RecordBatch.from_arrays([pa.array(i // 64, pa.int32()), pa.array(p.astype(np.int32)),
                                                      pa.array(bit)], ["w", "row", "bits"])

        table = kept.mapInArrow(rows, "w int, row int, bits long").groupBy("w", "row") \
            .agg(F.bit_or("bits").alias("bits")).toArrow()
        filters[table["w"].to_numpy(), table["row"].to_numpy()] = table["bits"].to_numpy().view(U64)
    return Filters(languages, filters, hashes)


def identify(docs: DataFrame, filters: Filters, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with the predicted language of every whole text and its score."""
    rates = filters.false_positive()
    shared = docs.sparkSession.sparkContext.broadcast((filters, rates))

    def predict(texts: pa.Array) -> list[pa.Array]:
        model, fp = shared.value
        lang, score = model.predict(texts.to_pylist(), fp)
        return [pa.array(lang, pa.string()), pa.array(score, pa.float64())]

    # small slices: a letter takes some 60 bytes while its n-grams are looked up
    return add_columns(docs, f"{names[0]} string, {names[1]} double", predict, max_bytes=1 << 20)


def held_out() -> Column:
    """Column: crc32 of doc_id as text, mod 5, is 0 (false for a null doc_id)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
