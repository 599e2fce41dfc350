"""Token ids in binary shards, each a wavelet matrix.

Every text is encoded by the tokenizers library, piece by piece, each distinct
piece once: the vocabulary's rules look across neither white space nor the place
between a letter or digit and a punctuation mark, and take no notice of case.
An end id closes every document.  Shards hold whole documents in ascending
doc_id order (nulls first, ties by content) and are cut at about
``shard_tokens`` tokens; a longer document is a shard of its own.

A shard file ``<bucket>-<number>.wvm``: magic, a fixed header, then sections,
each compressed with zstd behind its length: doc ids, their null flags, document
ends, zeros of each level, and for each level, highest bit first, the packed bits
and the ones before every block of ``BLOCK`` bits.  ``Shard`` answers access,
rank, count and select on a loaded file without decoding it.

Files are written by the tasks under a temporary name and renamed, so a task
that is run again only replaces a file by the same bytes; they are read by
Spark's binaryFile source.  Edge cases: a null or empty text has only the end
id; repeated rows are documents of their own; an empty table writes no file and
reads as an empty table; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from storecast.llm.common import materialize, slices
from storecast.session import scratch_path

MAGIC = b"WVMX0001"
HEADER = struct.Struct("<8sIIIQB")  # magic, bucket, number, documents, tokens, levels
BLOCK = 512
CACHE_WORDS = 600_000
MAX_BUCKETS = 200_000
# The rules of a vocabulary whose pieces can be encoded apart.
APART = ("NFC", "Replace", "Lowercase"), r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


# ---- the file format ----

def wavelet(ids: np.ndarray, levels: int) -> tuple[list[np.ndarray], list[int]]:
    """The bits of each level, highest first, and how many of them are 0."""
    cur, planes, zeros = ids.astype(np.uint16 if levels <= 16 else np.uint32), [], []
    for k in range(levels - 1, -1, -1):
        one = (cur & cur.dtype.type(1 << k)) != 0
        planes.append(one)
        low = cur[~one]
        zeros.append(len(low))
        cur = np.concatenate([low, cur[one]])
    return planes, zeros


def unwavelet(planes: list[np.ndarray], zeros: list[int]) -> np.ndarray:
    """The ids of a wavelet matrix, from the lowest level up."""
    n = len(planes[0]) if planes else 0
    kind = np.uint16 if len(planes) <= 16 else np.uint32
    low = np.zeros(n, kind)
    for k, (one, z) in enumerate(zip(reversed(planes), reversed(zeros), strict=True)):
        up = np.empty(n, kind)
        up[~one] = low[:z]
        up[one] = low[z:] | kind(1 << k)
        low = up
    return low.astype("<u4")


def pack(bucket: int, number: int, doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray, levels: int) -> bytes:
    if len(ids) and int(ids.max()) >> levels:
        raise ValueError(f"an id needs more than {levels} bits")
    planes, zeros = wavelet(ids, levels)
    sections = [np.array([d or 0 for d in doc_ids], "<i8"), np.array([d is None for d in doc_ids], np.uint8),
                np.cumsum(lengths).astype("<u8"), np.array(zeros, "<u8")]
    for one in planes:
        bits = np.packbits(one, bitorder="little")
        whole = np.zeros(-(-len(one) // BLOCK) * BLOCK // 64, np.uint64)
        whole.view(np.uint8)[:len(bits)] = bits
        ones = np.bitwise_count(whole).reshape(-1, BLOCK // 64).sum(1, dtype=np.int64)
        sections += [bits, (np.cumsum(ones) - ones).astype("<u4")]
    out = [HEADER.pack(MAGIC, bucket, number, len(doc_ids), len(ids), levels)]
    for s in sections:
        raw = s.tobytes()
        small = pa.compress(raw, codec="zstd", asbytes=True)
        out += [struct.pack("<QQ", len(raw), len(small)), small]
    return b"".join(out)


class Shard:
    """A loaded shard file: random access, rank, count and select on the planes."""

    def __init__(self, data: bytes):
        magic, self.bucket, self.number, self.n_docs, self.n, levels = HEADER.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a wavelet shard")
        at, raw = HEADER.size, []
        while at < len(data):
            size, small = struct.unpack_from("<QQ", data, at)
            at += 16
            raw.append(pa.decompress(data[at:at + small], size, codec="zstd", asbytes=True))
            at += small
        null = np.frombuffer(raw[1], np.uint8)
        self.doc_ids = [None if z else d for d, z in zip(np.frombuffer(raw[0], "<i8").tolist(), null, strict=True)]
        self.doc_ends = np.frombuffer(raw[2], "<u8").astype(np.int64)
        self.zeros = np.frombuffer(raw[3], "<u8").astype(np.int64).tolist()
        self.bits = [np.frombuffer(raw[4 + 2 * k], np.uint8) for k in range(levels)]
        self.before = [np.frombuffer(raw[5 + 2 * k], "<u4") for k in range(levels)]

    def _ones(self, level: int, i: int) -> int:
        """Ones among the first i bits of a level."""
        if i <= 0:
            return 0
        b = (i - 1) // BLOCK
        part = self.bits[level][b * BLOCK // 8:(i + 7) // 8]
        return int(self.before[level][b]) + int(np.unpackbits(part, bitorder="little", count=i - b * BLOCK).sum())

    def _bit(self, level: int, i: int) -> int:
        return int(self.bits[level][i >> 3]) >> (i & 7) & 1

    def _select_bit(self, level: int, bit: int, k: int) -> int:
        """Place of the k-th (from 0) 0 or 1 of a level."""
        lo, hi = 0, self.n
        while lo < hi:
            mid = (lo + hi) // 2
            ones = self._ones(level, mid + 1)
            if (ones if bit else mid + 1 - ones) > k:
                hi = mid
            else:
                lo = mid + 1
        return lo

    def access(self, i: int) -> int:
        """The i-th id."""
        value = 0
        for k, z in enumerate(self.zeros):
            bit, ones = self._bit(k, i), self._ones(k, i)
            value, i = value << 1 | bit, z + ones if bit else i - ones
        return value

    def rank(self, value: int, i: int) -> int:
        """How often ``value`` stands among the first i ids."""
        levels, start = len(self.zeros), 0
        if value >> levels:
            return 0
        for k, z in enumerate(self.zeros):
            a, b = self._ones(k, start), self._ones(k, i)
            start, i = (z + a, z + b) if value >> (levels - 1 - k) & 1 else (start - a, i - b)
        return i - start

    def count(self, value: int) -> int:
        return self.rank(value, self.n)

    def select(self, value: int, k: int) -> int:
        """Place of the k-th (from 0) occurrence of ``value``."""
        levels, at = len(self.zeros), 0
        if not 0 <= k < self.count(value):
            raise IndexError(k)
        for level, z in enumerate(self.zeros):
            ones = self._ones(level, at)
            at = z + ones if value >> (levels - 1 - level) & 1 else at - ones
        at += k
        for level in range(levels - 1, -1, -1):
            bit = value >> (levels - 1 - level) & 1
            at = self._select_bit(level, bit, at - self.zeros[level] if bit else at)
        return at

    def ids(self) -> np.ndarray:
        """All ids, in one pass over each level."""
        planes = [np.unpackbits(b, bitorder="little", count=self.n).astype(bool) for b in self.bits]
        return unwavelet(planes, self.zeros)


# ---- encoding ----

class Pieces:
    """Ids by the library, of pieces with a bounded cache, or of whole texts for
    a vocabulary with other rules."""

    def __init__(self, spec: str):
        rules = json.loads(spec)
        names = tuple(x["type"] for x in (rules["normalizer"] or {}).get("normalizers", ()))
        first = ((rules["pre_tokenizer"] or {}).get("pretokenizers") or [{}])[0]
        self.apart = (names, first.get("pattern", {}).get("Regex")) == APART
        vocab, suffix = rules["model"]["vocab"], rules["model"].get("end_of_word_suffix")
        self.apart &= bool(suffix)
        self.ends = np.zeros(max([*vocab.values(), *(t["id"] for t in rules["added_tokens"])]) + 1, bool)
        self.ends[[i for w, i in vocab.items() if suffix and w.endswith(suffix)]] = True
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks share the cores
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_str(spec)
        self.library.no_truncation()
        self.library.no_padding()
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.ids, self.end = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def call(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The library's ids of all texts in a row, and how many each has."""
        got = [e.ids for i in range(0, len(texts), 50_000)
               for e in self.library.encode_batch_fast(texts[i:i + 50_000], add_special_tokens=False)]
        n = np.fromiter(map(len, got), np.int64, len(got))
        return np.fromiter(chain.from_iterable(got), np.uint32, int(n.sum())), n

    def fresh(self, words: list[str], letters: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words, the first ``letters`` of which have letters only: a
        token that ends a word then ends each of them."""
        ids, _ = self.call([" ".join(words[i:min(i + 256, letters)]) for i in range(0, letters, 256)])
        ends = np.flatnonzero(self.ends[ids])
        if len(ends) != letters:  # a rule that these words do not know of
            return self.call(words)
        rest, n = self.call(words[letters:])
        return np.concatenate([ids, rest]), np.concatenate([np.diff(ends, prepend=-1), n])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and how many each has."""
        if not self.apart:
            return self.call([t or "" for t in texts.to_pylist()])
        if len(self.index) > CACHE_WORDS:
            self.clear()
        apart = pc.replace_substring_regex(pc.fill_null(texts, ""), r"([A-Za-z0-9])([.,!?;:#*$%&])", r"\1 \2")
        split = pc.ascii_split_whitespace(apart)
        words = split.flatten().dictionary_encode()
        # in plain ASCII the case is lost in any case; "<|" may begin a special string, which has one
        plain = pc.and_(pc.string_is_ascii(words.dictionary), pc.invert(pc.match_substring(words.dictionary, "<|")))
        lower = pc.if_else(plain, pc.ascii_lower(words.dictionary), words.dictionary).dictionary_encode()
        names = lower.dictionary.to_pylist()
        at = np.fromiter(map(self.index.get, names, repeat(-1)), np.int64, len(names))
        missing = np.flatnonzero(at < 0)
        if len(missing):
            # words of letters only are one piece each: many of them make one text
            new = [names[i] for i in missing.tolist()]
            letters = np.fromiter((w.isalpha() and w.lower().isalpha() for w in new), bool, len(new))
            order = np.concatenate([np.flatnonzero(letters), np.flatnonzero(~letters)])
            new = [new[i] for i in order.tolist()]
            ids, n = self.fresh(new, int(letters.sum()))
            at[missing[order]] = np.arange(len(self.index), len(self.index) + len(new))
            self.index.update(zip(new, range(len(self.index), len(self.index) + len(new)), strict=True))
            self.ids = np.concatenate([self.ids, ids])
            self.end = np.concatenate([self.end, self.end[-1] + np.cumsum(n)])
        at = at[lower.indices.to_numpy(zero_copy_only=False)[words.indices.to_numpy(zero_copy_only=False)]]
        start, n = self.end[at], self.end[at + 1] - self.end[at]
        total = np.concatenate([[0], np.cumsum(n)])
        ids = self.ids[np.repeat(start - total[:-1], n) + np.arange(total[-1])]
        return ids, np.diff(total[np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy())])])


@lru_cache(2)
def pieces(spec: str) -> Pieces:
    return Pieces(spec)


def _encode(spec, bounds, end_id: int, narrow: bool):
    """(bucket, doc_id, ids): ids as 16-bit numbers where the vocabulary allows it."""
    kind = "<u2" if narrow else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, doc = b.column("text"), b.column("doc_id")
            for i, j in slices(texts, 8 << 20):
                ids, n = pieces(spec.value).encode(texts.slice(i, j - i))
                until = np.cumsum(n)[:-1]
                rows = [np.append(x, end_id).astype(kind).tobytes() for x in np.split(ids, until)]
                own = doc.slice(i, j - i)
                bucket = np.searchsorted(bounds.value, pc.fill_null(own, -(1 << 63)).to_numpy(zero_copy_only=False),
                                         side="right")
                yield pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), own, pa.array(rows, pa.binary())],
                                                 ["bucket", "doc_id", "ids"])
    return run


def store(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder that all machines share."""
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("/") else path.replace("file:", "file://", 1))


def _write(path: str, levels: int, shard_tokens: int, narrow: bool):
    kind = "<u2" if narrow else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, folder = store(path)
        docs: list[int | None] = []
        rows: list[np.ndarray] = []
        bucket, number, held = -1, 0, 0

        def flush() -> pa.RecordBatch:
            data = pack(bucket, number, docs, np.array([len(r) for r in rows]), np.concatenate(rows), levels)
            name = f"{folder}/{bucket:08d}-{number:06d}.wvm"
            part = f"{folder}/_{uuid.uuid4().hex}.part"
            with where.open_output_stream(part) as f:
                f.write(data)
            where.move(part, name)
            return pa.RecordBatch.from_pydict({"name": [name], "n_docs": [len(docs)], "n_tokens": [held]})

        for b in batches:
            for k, doc, raw in zip(*(b.column(c).to_pylist() for c in ("bucket", "doc_id", "ids")), strict=True):
                ids = np.frombuffer(raw, kind)
                if docs and (k != bucket or held + len(ids) > shard_tokens):
                    yield flush()
                    number = number + 1 if k == bucket else 0
                    docs, rows, held = [], [], 0
                bucket = k
                docs.append(doc)
                rows.append(ids)
                held += len(ids)
        if docs:
            yield flush()
    return run


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, shard_tokens: int = 1 << 21,
          shard_docs: int = 4096) -> DataFrame:
    """Write ``docs`` as shard files into the shared folder ``path``; a row (name,
    n_docs, n_tokens) for every file.

    Documents are dealt into buckets of about ``shard_docs`` (at most
    ``MAX_BUCKETS`` buckets) at quantiles of 32 doc_ids a bucket, chosen by hash:
    they only set how even the buckets are.
    """
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as f:
        spec = f.read()
    from tokenizers import Tokenizer
    size = max(Tokenizer.from_str(spec).get_vocab_size(with_added_tokens=True), end_id + 1)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    n = docs.count()
    parts = max(1, min(MAX_BUCKETS, -(-n // shard_docs)))
    bounds = np.zeros(0, np.int64)
    if parts > 1:
        share = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, 32 * parts / n))
        ids = docs.select("doc_id").where(share & F.col("doc_id").isNotNull()).toArrow()["doc_id"].to_numpy()
        if len(ids):
            bounds = np.unique(np.quantile(ids, np.arange(1, parts) / parts, method="nearest"))
    where, folder = store(path)
    where.create_dir(folder, recursive=True)
    shared, cut = spark.sparkContext.broadcast(spec), spark.sparkContext.broadcast(bounds)
    coded = docs.mapInArrow(_encode(shared, cut, end_id, size <= 1 << 16), "bucket int, doc_id long, ids binary")
    dealt = coded.repartitionById(len(bounds) + 1, F.col("bucket")).sortWithinPartitions("bucket", "doc_id", "ids")
    return materialize(dealt.mapInArrow(_write(path, (size - 1).bit_length(), shard_tokens, size <= 1 << 16),
                                        "name string, n_docs long, n_tokens long"), "token-files")


# ---- reading ----

def files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.wvm").load(path).select("content")


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for data in b.column("content"):
            s = Shard(data.as_py())
            ids, ends = s.ids(), s.doc_ends
            starts = np.concatenate([[0], ends[:-1]])
            crc = [zlib.crc32(ids[a:z].tobytes()) for a, z in zip(starts.tolist(), ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([s.bucket] * s.n_docs, pa.int32()), pa.array([s.number] * s.n_docs, pa.int32()),
                 pa.array(s.doc_ids, pa.int64()), pa.array(starts, pa.int64()), pa.array(ends - starts, pa.int64()),
                 pa.array(crc, pa.int64())], ["bucket", "number", "doc_id", "at", "n_tokens", "ids_crc32"])


def documents(spark: SparkSession, path: str) -> DataFrame:
    """From the files: doc_id, start (ids of all documents before it), n_tokens
    and ids_crc32 of every document."""
    own = materialize(files(spark, path).mapInArrow(
        _documents, "bucket int, number int, doc_id long, at long, n_tokens long, ids_crc32 long"), "token-docs")
    sizes = own.groupBy("bucket", "number").agg(F.sum("n_tokens").alias("n")) \
        .withColumn("span", F.floor(F.col("bucket") / 512))
    spans = sizes.groupBy("span").agg(F.sum("n").alias("n"))  # a row for 512 buckets, for the one window over all
    before = F.coalesce(F.sum("n").over(Window.orderBy("span").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = F.coalesce(F.sum("n").over(Window.partitionBy("span").orderBy("bucket", "number")
                                        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    first = sizes.withColumn("inside", inside).join(spans.select("span", before.alias("before")), "span") \
        .select("bucket", "number", (F.col("inside") + F.col("before")).alias("first"))
    return own.join(first, ["bucket", "number"]).select(
        "doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def occurrences(spark: SparkSession, path: str, token: int) -> DataFrame:
    """doc_id and offset in the document of every occurrence of an id, by select
    on the shards that count it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for data in b.column("content"):
                s = Shard(data.as_py())
                at = np.array([s.select(token, k) for k in range(s.count(token))], np.int64)
                doc = np.searchsorted(s.doc_ends, at, side="right")
                start = np.concatenate([[0], s.doc_ends])[doc]
                yield pa.RecordBatch.from_arrays([pa.array([s.doc_ids[d] for d in doc.tolist()], pa.int64()),
                                                  pa.array(at - start, pa.int64())], ["doc_id", "offset"])
    return files(spark, path).mapInArrow(run, "doc_id long, offset long")


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    path = scratch_path(docs.sparkSession, "tokens")
    write(docs, path, tokenizer)
    return documents(docs.sparkSession, path)
