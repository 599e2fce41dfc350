"""Exact quantiles that stay distributed, by one plan at every size.

Spark's exact ``percentile`` merges a value->count map into one buffer, which
does not survive billions of distinct doubles.  Here all quantiles of all
columns are found together:

1. one pass counts the values and, by ``percentile_approx`` (rank error at most
   n / accuracy), gives every wanted quantile a bracket;
2. one pass counts the values below and inside each bracket, exactly;
3. one pass takes the two order statistics that a quantile lies between from
   the values inside, about 4 n / accuracy of them.

A bracket that misses its ranks (with few rows), or still holds over
``INSIDE_LIMIT`` values, is searched again by passes 1 and 2.  Only scalars reach the driver.

Quantiles interpolate linearly between order statistics (pandas
``quantile``, DuckDB ``quantile_cont``, Spark ``percentile``).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACCURACY = 20_000
INSIDE_LIMIT = 4_000_000


@dataclass
class _Search:
    """The quantile ``p`` of a column: its bracket (both ends inside) and counts."""
    col: str
    p: float
    n: int | None = None
    low: float | None = None
    high: float | None = None
    below: int = 0
    inside: int = 0                # 0: no bracket that holds the ranks yet
    slack: float = 2.0
    stuck: bool = False

    def ranks(self) -> tuple[int, int]:
        at = self.p * (self.n - 1)
        return math.floor(at), math.ceil(at)

    def holds(self) -> Column:
        c = F.col(self.col)
        return c.between(F.lit(self.low), F.lit(self.high)) if self.inside else c.isNotNull()

    def ends(self, accuracy: int) -> list[float]:
        """Probabilities, among the values of the bracket, of a narrower one."""
        e = self.slack / accuracy
        if self.n is None:
            return [max(0.0, self.p - e), min(1.0, self.p + e)]
        size = self.inside or self.n
        k, m = (r - self.below for r in self.ranks())
        return [max(0.0, (k - 1) / size - e), min(1.0, (m + 2) / size + e)]

    def take(self, low: float, high: float, below: int, inside: int) -> None:
        k, m = self.ranks()
        if not below <= k <= m < below + inside:
            self.slack *= 4
            return
        # one that does not shrink holds few distinct values: pass 3 can take them
        self.stuck = bool(self.inside) and inside >= self.inside
        self.low, self.high, self.below, self.inside, self.slack = low, high, below, inside, 2.0

    def open(self, limit: int) -> bool:
        return bool(self.n) and (not self.inside or (self.inside > limit and self.low < self.high and not self.stuck))


def column_quantiles(df: DataFrame, cols: list[str], probs: list[float], accuracy: int = ACCURACY,
                     inside_limit: int = INSIDE_LIMIT, also: list[Column] | None = None
                     ) -> dict[str, list[float | None]] | tuple[dict[str, list[float | None]], DataFrame, dict]:
    """Exact quantiles of several columns (nulls skipped).  Aggregates in ``also``
    are computed in the first pass; then the result is the quantiles, the
    aggregate's frame (for its types) and its row."""
    search = [_Search(c, p) for c in cols for p in probs]
    data = df.withColumns({f"_q_{c}": F.col(c).cast("double") for c in cols})
    for s in search:
        s.col = f"_q_{s.col}"
    todo, extra = search, None
    while todo or extra is None:
        aggs = [F.percentile_approx(F.when(s.holds(), F.col(s.col)), F.lit(s.ends(accuracy)), accuracy).alias(f"_e{i}")
                for i, s in enumerate(todo)]
        if extra is None:
            first = data.agg(*aggs, *[F.count(f"_q_{c}").alias(f"_n_{c}") for c in cols], *(also or []))
            row = first.first()
            extra = (first, row.asDict())
            for s in search:
                s.n = row[f"_n{s.col[2:]}"]
        else:
            row = data.agg(*aggs).first()
        found = [(s, row[f"_e{i}"]) for i, s in enumerate(todo) if s.n]
        if found:
            counts = data.agg(*[e for i, (s, (lo, hi)) in enumerate(found) for e in (
                F.count_if(F.col(s.col) < F.lit(lo)).alias(f"_b{i}"),
                F.count_if(F.col(s.col).between(F.lit(lo), F.lit(hi))).alias(f"_i{i}"))]).first()
            for i, (s, (lo, hi)) in enumerate(found):
                s.take(lo, hi, counts[f"_b{i}"], counts[f"_i{i}"])
        todo = [s for s in search if s.open(inside_limit)]
    rest = [s for s in search if s.n and s.low < s.high]
    if rest:
        # percentile at an exact order statistic has no interpolation error
        got = data.agg(*[F.percentile(F.when(s.holds(), F.col(s.col)), F.lit(
            [(r - s.below) / max(s.inside - 1, 1) for r in s.ranks()])).alias(f"_v{i}") for i, s in enumerate(rest)]).first()
    values = {id(s): tuple(got[f"_v{i}"]) for i, s in enumerate(rest)}

    def result(s: _Search) -> float | None:
        if not s.n:
            return None
        lo, hi = values.get(id(s), (s.low, s.low))
        return lo + (hi - lo) * (s.p * (s.n - 1) - s.ranks()[0])

    out = {c: [result(s) for s in search if s.col == f"_q_{c}"] for c in cols}
    return out if also is None else (out, *extra)


def exact_quantiles(df: DataFrame, c: str, probs: list[float], **options) -> list[float | None]:
    """Linear-interpolated quantiles of column ``c`` (nulls skipped)."""
    return column_quantiles(df, [c], probs, **options)[c]
