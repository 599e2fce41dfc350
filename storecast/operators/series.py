"""Skew-safe layout for per-key, row-ordered window features.

A Spark window cannot split one partition key across tasks, so a store that
holds a third of all rows would become one task.  Every feature here looks
back a bounded number of rows (``lookback``), which makes the series
splittable:

1. ``hot_keys``: keys above ``hot_rows`` rows (map-side partial aggregate).
2. A hot key's rows are counted by *unit*: a day, or a part of a day over
   ``chunk_rows`` rows, cut at approximate quantiles of the first tie-break
   column.  Units in order are filled into chunks of about ``chunk_rows`` rows.
3. Each chunk needs the ``lookback`` rows before its first row (its *halo*).
   They lie in the last units of the two chunks before it; from the running
   counts a unit knows how many of its last rows go where, so the halo is cut
   by row number at exactly ``lookback`` rows.
4. Every row carries its home chunk (0 for ordinary keys) plus copies for the
   halos it belongs to.  Windows partition by (key, ``_chunk``); only
   ``_home`` rows are kept afterwards.

Ordinary keys pay one extra pruned scan for their sizes.  The lookup tables (hot
keys, units) grow with the rows of hot keys, so nothing here forces a
broadcast: the planner decides by their size.  Rows that agree in date and first
tie-break column stay in one unit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storecast.session import write_table

CHUNK = "_chunk"
HOME = "_home"
# A window task buffers its whole (key, chunk) group: 5M rows of ~100
# feature columns stay spillable.
DEFAULT_CHUNK_ROWS = 5_000_000
PARTS = 1024          # most parts of a day
UNSET = object()      # "hot keys not computed yet" (None means "there are none")


def _units(hot_rows: DataFrame, key: list[str], day: str, tie: str | None, chunk_rows: int) -> tuple[DataFrame, DataFrame]:
    """Rows of hot keys with ``_day`` and ``_part``, and the units in order: rows
    ``_n``, rows before ``_before``, chunk ``_chunk`` and what the unit owes to the
    halos of later chunks (see ``chunk_series``)."""
    rows = hot_rows.withColumn("_day", F.col(day))
    if tie is None:
        rows = rows.withColumn("_part", F.lit(0))
    else:
        big = (rows.groupBy(*key, "_day").agg(F.count(F.lit(1)).alias("_nd"))
               .filter(4 * F.col("_nd") > chunk_rows))
        cuts = (rows.join(big, key + ["_day"]).groupBy(*key, "_day", "_nd")
                .agg(F.percentile_approx(tie, F.lit([i / PARTS for i in range(1, PARTS)]), 10_000).alias("_q")))
        # of these quantiles as many as parts of a quarter chunk need
        step = F.greatest(F.lit(1), F.floor(F.lit(float(PARTS)) * chunk_rows / (4 * F.col("_nd"))).cast("int"))
        cuts = write_table(cuts.select(*key, "_day", F.array_distinct(F.filter(
            "_q", lambda q, i: (i + 1) % step == 0)).alias("_cuts")), "series-cuts")
        rows = rows.join(cuts, key + ["_day"], "left").withColumn("_part", F.coalesce(F.size(F.filter(
            "_cuts", lambda c: c < F.col(tie))), F.lit(0))).drop("_cuts")
    rows = write_table(rows, "series-hot")      # read for the counts, the homes and the halos
    return rows, rows.groupBy(*key, "_day", "_part").agg(F.count(F.lit(1)).alias("_n"))


def chunk_series(df: DataFrame, key: Sequence[str], order: str | Sequence[str], lookback: int,
                 chunk_rows: int | None = DEFAULT_CHUNK_ROWS,
                 hot_rows: int | None = None, hot=UNSET) -> DataFrame:
    """Add ``_chunk`` (int) and ``_home`` (bool); halo copies have
    ``_home = false``.  ``order`` is the series order: a date column, then the
    tie-break columns.  ``chunk_rows=None`` disables splitting.  ``hot`` may
    carry a hot-key table computed upstream (on the raw input, which is
    cheaper than re-deriving a computed frame just to count its rows)."""
    key, order = list(key), [order] if isinstance(order, str) else list(order)
    plain = {CHUNK: F.lit(0), HOME: F.lit(True)}
    if chunk_rows is None:
        return df.withColumns(plain)
    if hot is UNSET:
        hot = hot_keys(df, key, order[0], chunk_rows, hot_rows)
    if hot is None:                      # the usual case: one chunk per key
        return df.withColumns(plain)
    size = max(chunk_rows, lookback + 1)
    rows, units = _units(df.join(hot.select(*key), key, "left_semi"), key, order[0],
                         order[1] if len(order) > 1 else None, chunk_rows)
    w = Window.partitionBy(*key).orderBy("_day", "_part")
    units = units.withColumn("_before", F.coalesce(
        F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    units = units.withColumn(CHUNK, F.floor(F.col("_before") / size).cast("int"))
    # a chunk holds its halo in the two chunks before it: they have over ``lookback`` rows
    chunks = units.groupBy(*key, CHUNK).agg(F.min("_before").alias("_start"))
    wc = Window.partitionBy(*key).orderBy(CHUNK)
    for k in (1, 2):
        chunks = chunks.withColumns({f"_next{k}": F.lead(CHUNK, k).over(wc), f"_from{k}": F.lead("_start", k).over(wc)})
    end = F.col("_before") + F.col("_n")
    owed = [F.struct(F.col(f"_next{k}").alias("c"),
                     (F.lit(lookback) - (F.col(f"_from{k}") - end)).alias("rows")) for k in (1, 2)]
    units = units.join(chunks, key + [CHUNK]).select(
        *key, "_day", "_part", CHUNK,
        F.filter(F.array(*owed), lambda x: x["c"].isNotNull() & (x["rows"] > 0)).alias("_owed"))
    rows = rows.join(write_table(units, "series-units"), key + ["_day", "_part"])
    last = Window.partitionBy(*key, "_day", "_part").orderBy(*[F.col(c).desc() for c in order])
    owing = rows.filter(F.size("_owed") > 0).withColumn("_rn", F.row_number().over(last))
    halo = owing.select(*df.columns, F.explode(F.filter("_owed", lambda x: F.col("_rn") <= x["rows"])).alias("_o")) \
        .select(*df.columns, F.col("_o.c").alias(CHUNK), F.lit(False).alias(HOME))
    return (df.join(hot.select(*key), key, "left_anti").select(*df.columns).withColumns(plain)
            .unionByName(rows.select(*df.columns, CHUNK).withColumn(HOME, F.lit(True))).unionByName(halo))


def hot_keys(df: DataFrame, key: Sequence[str], date_col: str, chunk_rows: int,
             hot_rows: int | None = None) -> DataFrame | None:
    """Keys with more than ``hot_rows`` rows, or None when there are none; one
    aggregation pass over the key columns, written once."""
    key = list(key)
    hot = write_table(df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
                      .filter(F.col("_n") > (hot_rows or chunk_rows)), "hot-keys")
    return None if hot.isEmpty() else hot


def home_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col(HOME)).drop(CHUNK, HOME)


def positions(df: DataFrame, key: Sequence[str], order: Sequence[str],
              chunk_rows: int | None = DEFAULT_CHUNK_ROWS, hot_rows: int | None = None,
              hot=UNSET) -> DataFrame:
    """Add ``_pos`` (1-based row number in the key's order) and ``_cnt`` (rows
    of the key) without putting a hot key into one task: rows are numbered
    within (key, chunk) and shifted by the rows of the key's earlier chunks,
    taken from a per-(key, chunk) count table."""
    key = list(key)
    if hot is UNSET and chunk_rows is not None:
        hot = hot_keys(df, key, order[0], chunk_rows, hot_rows)
    if chunk_rows is None or hot is None:
        w = Window.partitionBy(*key)
        return df.withColumns({"_pos": F.row_number().over(w.orderBy(*order)),
                               "_cnt": F.count(F.lit(1)).over(w)})
    df = write_table(df, "series")      # a computed frame that the split reads several times
    c = chunk_series(df, key, order, 0, chunk_rows, hot_rows, hot).drop(HOME)
    counts = c.groupBy(*key, CHUNK).agg(F.count(F.lit(1)).alias("_n"))
    wk = Window.partitionBy(*key)
    counts = counts.select(
        *key, CHUNK,
        F.coalesce(F.sum("_n").over(wk.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"),
        F.sum("_n").over(wk).alias("_cnt"))
    rn = F.row_number().over(Window.partitionBy(*key, CHUNK).orderBy(*order))
    return (c.join(counts, key + [CHUNK]).withColumn("_pos", F.col("_off") + rn)
            .drop("_off", CHUNK))
