"""Input validation and store selection.

``validate_sales`` reproduces the reference's checks in order (required
columns, date parse, numeric target, null -> 0, negative -> 0, at least 30
rows, canonical sort) but returns the cleaned DataFrame lazily plus a
one-row report computed in a single aggregation pass, instead of a tuple of
an eager frame and an error string.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType

from storecast.sources.tables import STORE_KEY, TIE_BREAK

# Fixed values of the reference: required columns and the minimum row count.
REQUIRED_COLUMNS = ["date", "billings", "store_code", "partner_code"]
MIN_ROWS = 30
MIN_TRAIN_ROWS = 50
# Fixed values of the reference: its three error texts, which callers may compare.
NO_COLUMNS = "Missing required columns: {}"
BAD_DATE = "Invalid date format in {}"
TOO_FEW = f"Insufficient data: {{}} rows. Minimum {MIN_ROWS} required."


def missing_columns(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> list[str]:
    """P1 (plan time: only the schema is read)."""
    return [c for c in required if c not in df.columns]


def parsed_date(df: DataFrame, c: str) -> Column:
    """The column as a date; unparsable text -> null."""
    t = df.schema[c].dataType
    if isinstance(t, DateType):
        return F.col(c)
    if isinstance(t, (TimestampType, TimestampNTZType)):
        return F.col(c).cast("date")
    return F.coalesce(F.try_to_date(F.trim(F.col(c).cast("string")), "yyyy-MM-dd"),
                      F.to_date(F.try_to_timestamp(F.trim(F.col(c).cast("string")))))


def coerced_number(df: DataFrame, c: str) -> Column:
    """Numeric as is; text -> double, non-numeric text -> null."""
    if isinstance(df.schema[c].dataType, NumericType):
        return F.col(c).cast("double")
    return F.trim(F.col(c).cast("string")).try_cast("double")


def validate_sales(df: DataFrame, date_col: str = "date", target: str = "billings",
                   required: Sequence[str] = REQUIRED_COLUMNS, min_rows: int = MIN_ROWS
                   ) -> tuple[DataFrame, DataFrame]:
    """(cleaned rows in canonical order, one-row report with the first error or null)."""
    spark = df.sparkSession
    missing = missing_columns(df, required)
    if missing:
        report = spark.range(1).select(
            F.lit(None).cast("bigint").alias("rows"), F.lit(None).cast("bigint").alias("bad_dates"),
            F.lit(None).cast("bigint").alias("bad_numbers"), F.lit(None).cast("bigint").alias("null_targets"),
            F.lit(None).cast("bigint").alias("negative_targets"),
            F.lit(NO_COLUMNS.format(missing)).alias("error"))
        return df, report
    d, y = parsed_date(df, date_col), coerced_number(df, target)
    raw_d, raw_y = F.col(date_col), F.col(target)
    report = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(F.when(raw_d.isNotNull() & d.isNull(), 1)).alias("bad_dates"),
        F.count(F.when(raw_y.isNotNull() & y.isNull(), 1)).alias("bad_numbers"),
        F.count(F.when(y.isNull(), 1)).alias("null_targets"),
        F.count(F.when(y < 0, 1)).alias("negative_targets"))
    report = report.withColumn("error", F.when(
        F.col("bad_dates") > 0, F.lit(BAD_DATE.format(date_col))).when(
        F.col("rows") < min_rows,
        F.replace(F.lit(TOO_FEW.replace(str(MIN_ROWS), str(min_rows))), F.lit("{}"), F.col("rows").cast("string"))))
    clean = df.withColumns({
        date_col: d,
        target: F.greatest(F.coalesce(y, F.lit(0.0)), F.lit(0.0)),   # P4 then P5
    })
    # P9; the tie-break columns only where the input has them
    return clean.orderBy(*[c for c in (*STORE_KEY, date_col, *TIE_BREAK) if c in clean.columns]), report


def validate_and_write(df: DataFrame, path: str, date_col: str = "date", target: str = "billings",
                       required: Sequence[str] = REQUIRED_COLUMNS, min_rows: int = MIN_ROWS) -> tuple[DataFrame, DataFrame]:
    """P7 in one pass: the cleaned rows are written to ``path`` (each task's in canonical order),
    and the report is observed by the write itself.  Returns (the written rows, the report);
    without a required column nothing is written and the first is None."""
    if missing_columns(df, required):
        return None, validate_sales(df, date_col, target, required, min_rows)[1]
    seen = Observation("validation")
    raw = {"_d": parsed_date(df, date_col), "_y": coerced_number(df, target)}
    watched = df.withColumns(raw).observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.col(date_col).isNotNull() & F.col("_d").isNull()).alias("bad_dates"),
        F.count_if(F.col(target).isNotNull() & F.col("_y").isNull()).alias("bad_numbers"),
        F.count_if(F.col("_y").isNull()).alias("null_targets"), F.count_if(F.col("_y") < 0).alias("negative_targets"))
    clean = watched.withColumns({date_col: F.col("_d"), target: F.greatest(F.coalesce("_y", F.lit(0.0)), F.lit(0.0))}).drop(*raw)
    order = [c for c in (*STORE_KEY, date_col, *TIE_BREAK) if c in clean.columns]
    clean.sortWithinPartitions(*order).write.mode("overwrite").parquet(path)
    got = seen.get          # five numbers
    error = (BAD_DATE.format(date_col) if got["bad_dates"] else
             TOO_FEW.replace(str(MIN_ROWS), str(min_rows)).replace("{}", str(got["rows"])) if got["rows"] < min_rows else None)
    names = ("rows", "bad_dates", "bad_numbers", "null_targets", "negative_targets")
    report = df.sparkSession.range(1).select(*[F.lit(got[c]).cast("bigint").alias(c) for c in names], F.lit(error).cast("string").alias("error"))
    return df.sparkSession.read.schema(clean.schema).parquet(path), report


def fill_target_zero(df: DataFrame, target: str = "billings") -> DataFrame:
    """P4."""
    return df.withColumn(target, F.coalesce(F.col(target), F.lit(0.0)))


def clip_negative(df: DataFrame, target: str = "billings") -> DataFrame:
    """P5 (after P4; a remaining null stays null)."""
    t = F.col(target)
    return df.withColumn(target, F.when(t.isNotNull(), F.greatest(t, F.lit(0.0))))


def sort_canonical(df: DataFrame) -> DataFrame:
    """Order by partner, store, date (plus the unique tie-break)."""
    return df.orderBy(*STORE_KEY, "date", *TIE_BREAK)


RULES = {
    "date_parses": lambda df: parsed_date(df, "date").isNotNull(),
    "billings_non_negative": lambda df: F.coalesce(coerced_number(df, "billings") >= 0, F.lit(False)),
    "partner_code_not_blank": lambda df: F.coalesce(F.length(F.trim("partner_code")) > 0, F.lit(False)),
    "store_code_not_blank": lambda df: F.coalesce(F.length(F.trim("store_code")) > 0, F.lit(False)),
}


def row_rules(df: DataFrame) -> DataFrame:
    """Per-row rule results, ``failed`` = comma-joined failed rules, and
    codes trimmed."""
    checks = {f"ok_{k}": fn(df) for k, fn in RULES.items()}
    out = df.withColumns(checks)
    failed = F.concat_ws(",", *[F.when(~F.col(f"ok_{k}"), F.lit(k)) for k in RULES])
    return out.withColumn("failed", failed).withColumns(
        {"partner_code": F.trim("partner_code"), "store_code": F.trim("store_code")})


def rule_violations(df: DataFrame) -> DataFrame:
    """Violations per rule, one aggregation pass."""
    checked = row_rules(df)
    wide = checked.agg(*[F.count(F.when(~F.col(f"ok_{k}"), 1)).alias(k) for k in RULES],
                       F.count(F.when(F.col("failed") != "", 1)).alias("any_rule"))
    names = list(RULES) + ["any_rule"]
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("rule"), F.col(n).alias("violations")) for n in names])))


def filter_store(df: DataFrame, partner_code: str, store_code: str) -> DataFrame:
    """P10 (one store; for all stores use groupBy / partitionBy instead)."""
    return df.filter((F.col("partner_code") == partner_code) & (F.col("store_code") == store_code))


def parse_store_list(spark, text: str) -> DataFrame:
    """P11: "P1_S1,P2_S2" -> (partner_code, store_code) pairs, split on the
    first underscore; entries without one are dropped."""
    items = spark.range(1).select(F.explode(F.split(F.lit(text), ",")).alias("item")).select(
        F.trim("item").alias("item"))
    parts = items.filter(F.col("item").contains("_")).select(
        F.split("item", "_", 2).alias("p"))
    return parts.select(F.col("p")[0].alias("partner_code"), F.col("p")[1].alias("store_code")).filter(
        (F.col("partner_code") != "") & (F.col("store_code") != "")).distinct()


def store_list_filter(df: DataFrame, text: str) -> DataFrame:
    """Keep rows of the listed stores.  The list is a user parameter
    (its size is the text's), so it is broadcast into a left-semi join."""
    pairs = parse_store_list(df.sparkSession, text)
    return df.join(F.broadcast(pairs), list(STORE_KEY), "left_semi")


def drop_null_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """P12."""
    return df.na.drop(subset=list(cols))


def select_features(df: DataFrame, declared: Sequence[str]) -> list[str]:
    """The declared features that exist and are numeric."""
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)}
    return [c for c in declared if c in numeric]


def recent_rows(df: DataFrame, n: int, key: Sequence[str] = STORE_KEY) -> DataFrame:
    """Last ``n`` rows per store.  ``row_number() <= n`` lets Spark put
    a partial group limit before the shuffle, so a hot store ships at most
    n rows per input partition."""
    w = Window.partitionBy(*key).orderBy(*[F.col(c).desc() for c in ("date",) + TIE_BREAK])
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def store_sizes(df: DataFrame, min_samples: int = 1) -> DataFrame:
    """Rows per store, stores with at least ``min_samples``."""
    return (df.groupBy(*STORE_KEY).agg(F.count(F.lit(1)).alias("n_rows"))
            .filter(F.col("n_rows") >= min_samples))


def distinct_stores(df: DataFrame) -> DataFrame:
    """J7."""
    return df.select(*STORE_KEY).dropDuplicates()


def limit_stores(stores: DataFrame, max_stores: int | None) -> DataFrame:
    """The first ``max_stores`` stores in (partner, store) order."""
    ordered = stores.orderBy(*STORE_KEY)
    return ordered.limit(max_stores) if max_stores else ordered
