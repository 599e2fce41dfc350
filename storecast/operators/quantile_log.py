"""Exact quantiles kept up to date as periods of rows arrive.

Every appended period is one published version (``sources.versions``) of three tables,
made from its own rows only:

* ``values``: how often each value of each column occurs, range-partitioned and sorted
  by (column, value), so that a range of values is a few row groups;
* ``blocks``: for each column and partition of them the smallest and largest value and
  the number of rows;
* ``sketch``: a KLL sketch of each column.

A quantile of all periods up to a version is exact and reads little of them: the merged
sketches give a bracket, the blocks below it are counted from their table, and of the
values only those inside it, and those below it in the one block of a period that it
cuts, are read.  A bracket that misses its ranks is widened, up to the extremes that a
sketch knows; one that holds over ``inside_limit`` values is cut into sixteen by
``percentile_approx`` until it does not.  The order statistics are then taken by running
sums over the values inside, so a value that a third of all rows have is one row a period.

Driver: scalars, and one block id a period and bracket.  Nulls and NaN are skipped, an
infinity is a value; a column without values has null quantiles; an empty period is a
version without values.  Quantiles interpolate linearly, as ``functions.stats`` does.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from storecast.functions.stats import INSIDE_LIMIT
from storecast.sources.versions import Versions

CUTS = 16


@dataclass
class _Bracket:
    """Quantile ``p`` of a column with ``n`` values: both ends inside, rows below and inside."""
    column: str
    p: float
    n: int
    low: float = 0.0
    high: float = 0.0
    below: int = -1                # -1: not counted yet
    inside: int = 0
    rows: int = 0                  # of the table of values, inside
    cut: list[str] = field(default_factory=list)

    def ranks(self) -> tuple[int, int]:
        at = self.p * (self.n - 1)
        return math.floor(at), math.ceil(at)

    def holds(self) -> Column:
        return (F.col("column") == self.column) & F.col("value").between(F.lit(self.low), F.lit(self.high))

    def under(self) -> Column:
        """Rows below the bracket that the table of blocks cannot count."""
        return (F.col("column") == self.column) & F.col("block").isin(self.cut) & (F.col("value") < F.lit(self.low))

    def found(self) -> bool:
        k, m = self.ranks()
        return 0 <= self.below <= k <= m < self.below + self.inside


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


class QuantileLog:
    def __init__(self, spark: SparkSession, root: str, columns: Sequence[str], k: int = 4096,
                 inside_limit: int = INSIDE_LIMIT):
        self.versions, self.columns = Versions(spark, root), list(columns)
        self.k, self.inside_limit = k, inside_limit

    def append(self, rows: DataFrame) -> int:
        """Add a period of rows; returns its version."""
        data = rows.select(*[F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(c)
                             for c in self.columns])
        named = F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in self.columns]))

        def write(folder: str) -> None:
            data.select(named).where("value is not null").groupBy("column", "value").agg(F.count("*").alias("n")) \
                .repartitionByRange("column", "value").sortWithinPartitions("column", "value") \
                .withColumn("block", F.concat(F.lit(folder.rsplit("/", 1)[1] + "-"), F.spark_partition_id())) \
                .write.parquet(f"{folder}/values")
            self.versions.spark.read.parquet(f"{folder}/values").groupBy("column", "block").agg(
                F.min("value").alias("low"), F.max("value").alias("high"), F.sum("n").alias("n")) \
                .write.parquet(f"{folder}/blocks")
            data.select(named).where("value is not null").groupBy("column").agg(
                F.count("*").alias("n"), F.kll_sketch_agg_double("value", self.k).alias("sketch")) \
                .write.parquet(f"{folder}/sketch")
        return self.versions.publish(write)

    def _read(self, name: str, as_of: int | None) -> DataFrame:
        folders = [f for n, f in self.versions.all().items() if as_of is None or n <= as_of]
        if not folders:
            raise LookupError(f"no version {'' if as_of is None else f'up to {as_of} '}under {self.versions.root}")
        return self.versions.spark.read.parquet(*[f"{f}/{name}" for f in folders])

    def inside(self, brackets: list[_Bracket], as_of: int | None) -> DataFrame:
        """The values in the brackets, or below one in the blocks that it cuts."""
        return self._read("values", as_of).where(_any([x for b in brackets for x in (
            [b.holds(), b.under()] if b.cut else [b.holds()])]))

    def _place(self, brackets: list[_Bracket], slack: float, as_of: int | None) -> None:
        """Ends of the brackets from the merged sketches."""
        probs = sorted({b.p for b in brackets})
        width = slack * 4 / self.k ** 0.9
        ends = [min(1.0, max(0.0, p + side * width)) for p in probs for side in (-1, 1)]
        merged = self._read("sketch", as_of).groupBy("column").agg(F.kll_merge_agg_double("sketch", self.k).alias("s"))
        got = {r.column: r.q for r in merged.select("column", F.kll_sketch_get_quantile_double(
            "s", F.array(*[F.lit(e) for e in ends])).alias("q")).collect()}
        for b in brackets:
            at = 2 * probs.index(b.p)
            b.low, b.high = got[b.column][at:at + 2]

    def _count(self, brackets: list[_Bracket], as_of: int | None) -> None:
        """Rows below and inside, exactly."""
        blocks = self._read("blocks", as_of)
        mine = [F.col("column") == b.column for b in brackets]
        whole = blocks.agg(*[F.sum(F.when(c & (F.col("high") < F.lit(b.low)), F.col("n"))).alias(f"n{i}")
                             for i, (b, c) in enumerate(zip(brackets, mine, strict=True))]).first()
        cuts = [c & (F.col("low") < F.lit(b.low)) & (F.col("high") >= F.lit(b.low))
                for b, c in zip(brackets, mine, strict=True)]
        cut = blocks.where(_any(cuts)).select("block", *[c.alias(f"c{i}") for i, c in enumerate(cuts)]).collect()
        for i, b in enumerate(brackets):
            b.cut = sorted({r.block for r in cut if r[f"c{i}"]})
        got = self.inside(brackets, as_of).agg(*[x for i, b in enumerate(brackets) for x in (
            F.sum(F.when(b.under(), F.col("n")) if b.cut else F.lit(0)).alias(f"u{i}"),
            F.sum(F.when(b.holds(), F.col("n"))).alias(f"i{i}"), F.count_if(b.holds()).alias(f"r{i}"))]).first()
        for i, b in enumerate(brackets):
            b.below = (whole[f"n{i}"] or 0) + (got[f"u{i}"] or 0)
            b.inside, b.rows, b.cut = got[f"i{i}"] or 0, got[f"r{i}"], []

    def _narrow(self, brackets: list[_Bracket], as_of: int | None) -> None:
        """Each bracket cut at up to ``CUTS`` of its values to the part that holds its ranks."""
        data = self.inside(brackets, as_of)
        steps = [j / CUTS for j in range(CUTS + 1)]
        row = data.agg(*[F.percentile_approx(F.when(b.holds(), F.col("value")), F.lit(steps)).alias(f"e{i}")
                         for i, b in enumerate(brackets)]).first()
        edges = [sorted({b.low, b.high, *row[f"e{i}"]}) for i, b in enumerate(brackets)]
        got = data.agg(*[F.sum(F.when(b.holds() & (F.col("value") < F.lit(e)), F.col("n"))).alias(f"c{i}_{j}")
                         for i, b in enumerate(brackets) for j, e in enumerate(edges[i])]).first()
        for i, b in enumerate(brackets):
            k, m = b.ranks()
            under = [b.below + (got[f"c{i}_{j}"] or 0) for j in range(len(edges[i]))]
            at = max(j for j, u in enumerate(under) if u <= k)
            b.high = next((e for e, u in zip(edges[i], under, strict=True) if u > m), b.high)
            b.low, b.below, b.inside = edges[i][at], under[at], b.inside - (under[at] - b.below)
        got = data.agg(*[x for i, b in enumerate(brackets) for x in (
            F.sum(F.when(b.holds(), F.col("n"))).alias(f"i{i}"), F.count_if(b.holds()).alias(f"r{i}"))]).first()
        for i, b in enumerate(brackets):
            shrunk = got[f"r{i}"] < b.rows
            b.inside, b.rows = got[f"i{i}"], got[f"r{i}"] if shrunk else 0  # 0: few values, many periods

    def quantiles(self, probs: Sequence[float], as_of: int | None = None) -> dict[str, list[float | None]]:
        """The quantiles of every column over all periods up to ``as_of``."""
        sizes = {r.column: r.n for r in self._read("sketch", as_of).groupBy("column").agg(F.sum("n").alias("n")).collect()}
        brackets = [_Bracket(c, p, sizes[c]) for c in self.columns for p in probs if sizes.get(c)]
        todo, slack = brackets, 1.0
        while todo:
            self._place(todo, slack, as_of)
            self._count(todo, as_of)
            todo, slack = [b for b in todo if not b.found()], slack * 8
        while large := [b for b in brackets if b.rows > self.inside_limit and b.low < b.high]:
            self._narrow(large, as_of)
        values = self._order_statistics(brackets, as_of) if brackets else {}

        def result(c: str, p: float) -> float | None:
            if not sizes.get(c):
                return None
            low, high = values[c, p]
            return low if low == high else low + (high - low) * (p * (sizes[c] - 1) - math.floor(p * (sizes[c] - 1)))
        return {c: [result(c, p) for p in probs] for c in self.columns}

    def _order_statistics(self, brackets: list[_Bracket], as_of: int | None) -> dict[tuple[str, float], tuple[float, float]]:
        held = self.inside(brackets, as_of).groupBy("column", "value").agg(F.sum("n").alias("n"))
        each = held.withColumn("i", F.explode(F.array_compact(F.array(*[
            F.when(b.holds(), F.lit(i)) for i, b in enumerate(brackets)]))))
        # at most inside_limit rows a bracket
        upto = Window.partitionBy("i").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
        ranks = [F.array(*[F.lit(b.ranks()[side] - b.below) for b in brackets]) for side in (0, 1)]
        found = each.withColumn("upto", F.sum("n").over(upto)).groupBy("i").agg(*[
            F.min(F.when(F.col("upto") > F.get(r, F.col("i")), F.col("value"))).alias(name)
            for r, name in zip(ranks, ("low", "high"), strict=True)]).collect()
        return {(brackets[r.i].column, brackets[r.i].p): (r.low, r.high) for r in found}

    def iqr_bounds(self, column: str, factor: float = 2.0, as_of: int | None = None) -> tuple[float, float] | None:
        """T2 fit: the fence of all periods up to ``as_of``."""
        q1, q3 = self.quantiles([0.25, 0.75], as_of)[column]
        return None if q1 is None else (q1 - factor * (q3 - q1), q3 + factor * (q3 - q1))
