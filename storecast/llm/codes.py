"""Product codes of vectors: 16 codebooks of 64 entries, learned and assigned exactly.

Vectors are cut into equal parts, and every part position has a codebook.  The vectors of a
task are taken in bounded chunks; in a chunk and for every part position, the sub-vectors
are sorted along a Hilbert curve and cut into flat blocks of ``BLOCK``.  A block stores its
points, its box (least and largest component) and its component sums.  Chunks are written
once; every round reads them:

* the least and the largest distance of each entry to the box give the block's shortlist:
  entries whose least distance does not exceed the smallest largest distance.  The nearest
  entry of every point in the box is on it, ties included;
* a block with one entry on its list is counted by its sums, without looking at its points;
* for the others an integer kernel compares the points with the shortlist only.  Blocks are
  taken together by the size of their lists.

A task sends one row a part and entry (count and sums), Spark adds them up, and the driver
holds the codebooks, whose size is fixed.  Sorting within a chunk needs no shuffle; a wider
sort would only shorten the lists, never change the result.  All arithmetic is on 64-bit
integers.

Edge cases: rows whose vector is null, empty, of another length than the first seed's, or
holds a null, non-finite or out-of-range component (over ``LIMIT`` after scaling; squares
would leave 64 bits) are dropped.  Fewer kept rows than entries give shorter codebooks.
A null vec_id comes after all others; rows of the same vec_id are ordered by vector; repeated
rows are coded each.  A length that the parts do not divide is a ValueError.  No kept row
gives no rows.  Labels may be null and are summed together; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storecast.llm.common import materialize

SCALE = 256
LIMIT = 1 << 25
BLOCK = 64                  # points of a block
CHUNK_BYTES = 1 << 20       # components of a chunk, as 16-bit numbers
SALTS = 16


# ------------------------------------------------------------------ in a chunk

def hilbert(points: np.ndarray) -> np.ndarray:
    """Position of every row of ``points`` (integers) along a Hilbert curve through their box.

    Skilling's transform of the coordinates, then their bits interleaved; as many
    coordinates as fit 60 bits take part."""
    x = points[:, :60].astype(np.int64)
    n, dims = x.shape
    bits = max(1, min(8, 60 // dims))
    low = x.min(0)
    span = np.maximum(x.max(0) - low, 1)
    x = ((x - low) * ((1 << bits) - 1) // span).T.copy()
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(dims):
            t = np.where(x[i] & q, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(x[i] & q, p, t)
            if i:
                x[i] ^= t
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    t, q = np.zeros(n, np.int64), 1 << (bits - 1)
    while q > 1:
        t ^= np.where(x[dims - 1] & q, q - 1, 0)
        q >>= 1
    x ^= t
    key = np.zeros(n, np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


class Blocks:
    """The sub-vectors of one part position of a chunk in Hilbert order, in blocks; the last
    block is filled up with its last point, which does not count."""

    def __init__(self, order: np.ndarray, points: np.ndarray, low: np.ndarray, high: np.ndarray, sums: np.ndarray):
        self.order, self.points, self.low, self.high, self.sums = order, points, low, high, sums
        self.sizes = np.full(len(low), points.shape[1], np.int64)
        self.sizes[-1] = len(order) - points.shape[1] * (len(low) - 1)

    @staticmethod
    def build(sub: np.ndarray) -> Blocks:
        order = np.argsort(hilbert(sub), kind="stable")
        blocks = -(-len(sub) // BLOCK)
        filled = np.concatenate([order, np.full(blocks * BLOCK - len(sub), order[-1])])
        points = sub[filled].reshape(blocks, BLOCK, -1)
        sums = points.sum(1)
        sums[-1] -= points[-1, -1] * (blocks * BLOCK - len(sub))
        return Blocks(order, points, points.min(1), points.max(1), sums)

    def pack(self) -> dict[str, bytes]:
        kind = np.int16 if max(-int(self.low.min()), int(self.high.max())) < 1 << 15 else np.int32
        return {"order": self.order.astype(np.int32).tobytes(), "low": self.low.tobytes(), "high": self.high.tobytes(),
                "sums": self.sums.tobytes(), "points": self.points.astype(kind).tobytes()}

    @staticmethod
    def unpack(x: dict[str, bytes], dims: int) -> Blocks:
        low, high, sums = (np.frombuffer(x[k], np.int64).reshape(-1, dims) for k in ("low", "high", "sums"))
        wide = len(x["points"]) // (len(low) * BLOCK * dims)
        points = np.frombuffer(x["points"], {2: np.int16, 4: np.int32}[wide]).reshape(len(low), BLOCK, dims)
        return Blocks(np.frombuffer(x["order"], np.int32), points.astype(np.int64), low, high, sums)

    def shortlists(self, entries: np.ndarray) -> np.ndarray:
        """Which entries can be nearest to a point of the block, (blocks, entries)."""
        least = np.zeros((len(self.low), len(entries)), np.int64)
        most = np.zeros_like(least)
        for d in range(entries.shape[1]):
            below = self.low[:, d, None] - entries[None, :, d]          # positive: the entry lies below the box
            above = entries[None, :, d] - self.high[:, d, None]
            least += np.maximum(np.maximum(below, above), 0) ** 2
            most += np.maximum(np.abs(below), np.abs(above)) ** 2
        return least <= most.min(1)[:, None]

    def nearest(self, entries: np.ndarray, whole: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray | None]]:
        """Groups of blocks: (block numbers, codes, distances).  Without ``whole``, a block of
        one candidate has its code once, (n, 1), and no distance is taken."""
        listed = self.shortlists(entries)
        lengths = listed.sum(1)
        width = np.where(lengths > 1, 1 << np.ceil(np.log2(np.maximum(lengths, 1))).astype(np.int64), 1)
        for w in np.unique(width):
            at = np.flatnonzero(width == w)
            # the listed entries first and in order, so that ties go to the lower index
            some = np.argsort(~listed[at], axis=1, kind="stable")[:, :min(w, len(entries))]
            if w == 1 and not whole:
                yield at, some, None
                continue
            some = np.where(np.arange(some.shape[1]) < lengths[at, None], some, some[:, :1])
            far = np.zeros((len(at), BLOCK, some.shape[1]), np.int64)
            for d in range(entries.shape[1]):
                far += (self.points[at, :, d, None] - entries[some, d][:, None, :]) ** 2
            best = far.argmin(2)
            codes = np.take_along_axis(some, best, 1)
            yield at, codes, np.take_along_axis(far, best[:, :, None], 2)[:, :, 0]

    def tally(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many points are nearest to each entry, and their component sums."""
        n, sums = np.zeros(len(entries), np.int64), np.zeros_like(entries)
        real = np.arange(BLOCK) < self.sizes[:, None]
        for at, codes, far in self.nearest(entries, False):
            if far is None:
                np.add.at(n, codes[:, 0], self.sizes[at])
                np.add.at(sums, codes[:, 0], self.sums[at])
            else:
                np.add.at(n, codes[real[at]], 1)
                np.add.at(sums, codes[real[at]], self.points[at][real[at]])
        return n, sums

    def assign(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Code and distance of every sub-vector, in the chunk's own order."""
        codes, far = (np.zeros((len(self.low), BLOCK), np.int64) for _ in range(2))
        for at, c, f in self.nearest(entries, True):
            codes[at], far[at] = c, f
        out = np.empty((2, len(self.order)), np.int64)
        out[:, self.order] = codes.ravel()[:len(self.order)], far.ravel()[:len(self.order)]
        return out[0], out[1]


def hex_codes(codes: np.ndarray) -> pa.Array:
    """Two hexadecimal digits for every column of ``codes``, one string a row."""
    digits = np.frombuffer(b"0123456789abcdef", np.uint8)
    text = digits[np.stack([codes >> 4, codes & 15], 2)].reshape(len(codes), -1)
    ends = np.arange(len(codes) + 1, dtype=np.int32) * text.shape[1]
    return pa.StringArray.from_buffers(len(codes), pa.py_buffer(ends.tobytes()), pa.py_buffer(text.tobytes()))


# ------------------------------------------------------------------- the table

PART = "struct<order: binary, low: binary, high: binary, sums: binary, points: binary>"


def integers(rows: DataFrame, vector: str, vec_id: str, label: str) -> DataFrame:
    """vec_id, label and the scaled integer vector of the rows that have one."""
    scaled = F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * SCALE))
    fine = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                    & (F.abs(x.cast("double")) < LIMIT / SCALE))
    return rows.where(F.coalesce((F.size(vector) > 0) & fine, F.lit(False))).select(
        F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), scaled.cast("array<int>").alias("v"))


def chunks(rows: DataFrame, dims: int, parts: int) -> DataFrame:
    """Written chunks: the ids and labels of their vectors, and the blocks of every part."""
    most = max(BLOCK, CHUNK_BYTES // (2 * dims) // BLOCK * BLOCK)
    kinds = {c: rows.schema[c].dataType for c in ("vec_id", "label")}
    schema = T.StructType([*(T.StructField(c, T.ArrayType(t)) for c, t in kinds.items()),
                           T.StructField("parts", T._parse_datatype_string(f"array<{PART}>"))])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def chunk(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            t = pa.Table.from_batches(held).combine_chunks()
            flat = t.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
            v = flat.astype(np.int64).reshape(len(t), parts, dims // parts)
            packed = [Blocks.build(v[:, p]).pack() for p in range(parts)]
            lists = [pa.ListArray.from_arrays(pa.array([0, len(t)], pa.int32()), t.column(c).combine_chunks()) for c in kinds]
            return pa.RecordBatch.from_arrays([*lists, pa.array([packed], pa.list_(pa.struct(
                [(k, pa.binary()) for k in packed[0]])))], names=schema.names)

        held, n = [], 0
        for b in batches:
            while len(b):
                take = b.slice(0, most - n)
                held.append(take)
                n, b = n + len(take), b.slice(len(take))
                if n == most:
                    yield chunk(held)
                    held, n = [], 0
        if n:
            yield chunk(held)

    return materialize(rows.where(F.size("v") == dims).mapInArrow(build, schema), "codes-chunks")


def one_by_one(batches: Iterator[pa.RecordBatch], column: str, dims: int) -> Iterator[tuple[pa.RecordBatch, list[Blocks]]]:
    """Each chunk of a batch with its blocks."""
    for b in batches:
        for i in range(len(b)):
            row = b.slice(i, 1)
            yield row, [Blocks.unpack(x, dims) for x in row.column(column)[0].as_py()]


def refine(table: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: every used entry becomes the floored mean of its sub-vectors."""
    parts, entries, dims = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros(books.shape[:2], np.int64), np.zeros_like(books)
        for _, blocks in one_by_one(batches, "parts", dims):
            for p, x in enumerate(blocks):
                more = x.tally(books[p])
                n[p] += more[0]
                sums[p] += more[1]
        p, e = np.nonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(n[p, e]),
                                          *[pa.array(sums[p, e, d]) for d in range(dims)]],
                                         names=["part", "entry", "n", *[f"s{d}" for d in range(dims)]])

    sums = ", ".join(f"s{d} long" for d in range(dims))
    added = table.select("parts").mapInArrow(run, f"part int, entry int, n long, {sums}").groupBy("part", "entry").agg(
        F.sum("n").alias("n"), *[F.sum(f"s{d}").alias(f"s{d}") for d in range(dims)])
    out = books.copy()
    for r in added.collect():           # at most parts * entries rows
        out[r["part"], r["entry"]] = [r[f"s{d}"] // r["n"] for d in range(dims)]
    return out


def encode(table: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id, label, code and error of every vector of the chunks."""
    parts, _, dims = books.shape
    kinds = {c: table.schema[c].dataType.elementType for c in ("vec_id", "label")}
    schema = T.StructType([*(T.StructField(c, t) for c, t in kinds.items()), T.StructField("code", T.StringType()),
                           T.StructField("error", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, blocks in one_by_one(batches, "parts", dims):
            found = [x.assign(books[p]) for p, x in enumerate(blocks)]
            yield pa.RecordBatch.from_arrays(
                [*(row.column(c).flatten() for c in kinds), hex_codes(np.stack([c for c, _ in found], 1)),
                 pa.array(sum(f for _, f in found))], names=schema.names)

    return table.mapInArrow(run, schema)


def decode(codes: DataFrame, books: np.ndarray) -> DataFrame:
    """``codes`` with ``vector``, the entries that the code names, scaled back."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = [np.frombuffer(bytes.fromhex(c), np.uint8) for c in b.column("code").to_pylist()]
            back = [np.concatenate([books[p, e] for p, e in enumerate(x)]) / SCALE for x in at]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(back, pa.list_(pa.float64()))], names=[*b.schema.names, "vector"])

    codes = codes.drop("vector")
    return codes.mapInArrow(run, T.StructType([*codes.schema.fields, T.StructField("vector", T.ArrayType(T.DoubleType()))]))


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def learn(rows: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, vector: str = "embedding",
          vec_id: str = "vec_id", label: str = "label") -> tuple[DataFrame | None, np.ndarray]:
    """The written chunks of all kept rows, and the codebooks (parts, entries, dims)."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hexadecimal digits a part: 1 to 256 entries")
    kept = integers(rows, vector, vec_id, label)
    first = kept.orderBy(F.asc_nulls_last("vec_id"), "v").select("v")
    lead = first.first()
    if lead is None:
        return None, np.zeros((parts, 0, 0), np.int64)
    dims = len(lead[0])
    if dims % parts:
        raise ValueError(f"vectors of length {dims} cannot be cut into {parts} equal parts")
    seeds = first.where(F.size("v") == dims).limit(entries).collect()
    books = np.array([r[0] for r in seeds], np.int64).reshape(len(seeds), parts, -1).transpose(1, 0, 2).copy()
    table = chunks(kept, dims, parts)
    for _ in range(rounds):
        books = refine(table, books)
    return table, books


def compress(rows: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, vector: str = "embedding",
             vec_id: str = "vec_id", label: str = "label") -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error, label_error) of every kept row, and the codebooks."""
    table, books = learn(rows, parts, entries, rounds, vector, vec_id, label)
    if table is None:
        kept = integers(rows, vector, vec_id, label)
        return kept.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"),
                           F.lit(0).cast("long").alias("label_error")).where(F.lit(False)), books
    coded = materialize(encode(table, books), "codes")
    # written, so that the planner knows its size; a label may hold a third of all rows, so the
    # label's row is met under several salts
    sums = materialize(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "codes-labels") \
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).withColumnRenamed("label", "of")
    salted = coded.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int"))
    return salted.join(sums, salted["label"].eqNullSafe(sums["of"]) & (salted["salt"] == sums["salt"])).select(
        "vec_id", "label", "code", "error", "label_error"), books


#: The same in DuckDB, every distance taken.
SQL = r"""
with kept as (
  select row_number() over (order by vec_id nulls last, embedding) as r, vec_id, label,
         list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
  from embeddings
  where len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
sub as (select r, part, v[part * (len(v) // 16) + 1:(part + 1) * (len(v) // 16)] as s
        from kept, (select unnest(range(16)) as part)),
c0 as (select part, r - 1 as entry, s as c from sub where r <= 64),
a1 as materialized (select part, r, s, arg_min(entry, (far, entry)) as entry from (
  select sub.part, r, s, entry, list_sum(list_transform(list_zip(s, c), lambda z: (z[1] - z[2]) ** 2)) as far
  from sub join c0 using (part)) group by part, r, s),
m1 as (select part, entry, list(m order by i) as c from (
  select part, entry, i, floor(sum(s[i])::decimal(38, 0) / count(*))::bigint as m from (
    select part, entry, s, unnest(range(1, len(s) + 1)) as i from a1) group by part, entry, i) group by part, entry),
c1 as materialized (select part, entry, coalesce(m1.c, c0.c) as c from c0 left join m1 using (part, entry)),
a2 as materialized (select part, r, s, arg_min(entry, (far, entry)) as entry from (
  select sub.part, r, s, entry, list_sum(list_transform(list_zip(s, c), lambda z: (z[1] - z[2]) ** 2)) as far
  from sub join c1 using (part)) group by part, r, s),
m2 as (select part, entry, list(m order by i) as c from (
  select part, entry, i, floor(sum(s[i])::decimal(38, 0) / count(*))::bigint as m from (
    select part, entry, s, unnest(range(1, len(s) + 1)) as i from a2) group by part, entry, i) group by part, entry),
c2 as materialized (select part, entry, coalesce(m2.c, c1.c) as c from c1 left join m2 using (part, entry)),
a3 as (select part, r, arg_min(entry, (far, entry)) as entry, min(far) as far from (
  select sub.part, r, entry, list_sum(list_transform(list_zip(s, c), lambda z: (z[1] - z[2]) ** 2)) as far
  from sub join c2 using (part)) group by part, r),
coded as (select r, string_agg(lower(printf('%02x', entry::int)), '' order by part) as code, sum(far)::bigint as error
          from a3 group by r),
books as (select sha256(string_agg(array_to_string(c, ','), ',' order by part, entry)) as codebooks_sha256 from c2)
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256
from kept join coded using (r), books
"""
