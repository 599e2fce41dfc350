"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storecast.session import scratch_path

#: The white space of the contracts: space and the control characters 9 to 13.
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` once into the shared folder and read it back.

    The written table cuts the lineage, survives lost executors, and later
    reads of it prune columns.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(texts: pa.Array, max_bytes: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``max_bytes`` of text; a longer text is a range of its own."""
    if not len(texts):
        return
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    part = ends // max_bytes
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(texts)]
    yield from zip(cuts[:-1], cuts[1:], strict=True)


def add_columns(df: DataFrame, ddl: str, fn, text: str = "text", max_bytes: int = 4 << 20,
                keep_text: bool = True) -> DataFrame:
    """``df`` with the columns of ``ddl``, which ``fn`` makes from an Arrow array of
    texts (as strings, nulls kept).  A column of the same name is replaced; the
    text itself is sent back only with ``keep_text``."""
    new = T._parse_datatype_string(ddl)
    kept = df.drop(*new.names)
    if text not in kept.columns:
        raise ValueError(f"the text column {text} is missing or would be replaced")
    back = [c for c in kept.columns if keep_text or c != text]
    out = T.StructType([*(kept.schema[c] for c in back), *new.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(text).cast(pa.string())
            for i, j in slices(texts, max_bytes):
                more = fn(texts.slice(i, j - i))
                yield pa.RecordBatch.from_arrays([*(b.column(c).slice(i, j - i) for c in back), *more], names=out.names)

    return kept.mapInArrow(run, out)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` does not have yet."""
    have = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in have:
            n += "_"
        have.add(n.lower())
        out.append(n)
    return out


def logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray, steps: int = 30) -> np.ndarray:
    """Weights of a logistic model with a ridge, by Newton steps: rows of
    features x, (soft) labels y, counts n."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (n * np.maximum(q * (1 - q), 1e-9))[:, None]).T @ x + np.eye(len(w))
        w += np.linalg.solve(h, x.T @ (n * (y - q)) - w)
    return w


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Components of the graph with long columns ``a``, ``b``: rows (node, root).

    Alternating large-star and small-star steps: every step replaces edges by
    edges to the smallest neighbour, so the edge count never grows and the
    rounds are logarithmic in the longest path.  ``root`` is the smallest node
    of the component.  Nodes without an edge do not appear.  A hub with very
    many edges is one key of a join that the adaptive planner splits.
    """
    cur = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                      .distinct(), "cc")
    state = None
    for _ in range(max_rounds):
        both = cur.unionByName(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        cur = materialize(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "cc")
        now = cur.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components not settled after {max_rounds} rounds")
    return cur.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        cur.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
