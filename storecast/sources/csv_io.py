"""CSV sources and sinks.

Readers take every column as text (no schema inference pass over the data),
rename by the reference's header maps, and coerce types with ``try_cast`` /
``try_to_date`` so a bad value becomes null instead of failing the job.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the reference: training CSV headers -> canonical names.
SALES_HEADER_MAP = {
    "Partner Code": "partner_code",
    "Partner Name": "partner_name",
    "Store Code": "store_code",
    "Store Name": "store_name",
    "Process Date": "date",
    "Billings": "billings",
    "Miles": "miles",
}
# Fixed values of the reference: dashboard upload aliases (after trim+lower).
DASHBOARD_ALIASES = {
    "transaction date": "fecha",
    "partner name": "partner",
    "country": "pais",
    "city": "ciudad",
    "store name": "tienda",
    "local amount": "ventas_reales",
    "pred": "ventas_predichas",
}
EDA_HEADER_MAP = {"date": "Transaction Date", "partner_name": "Partner Name",
                  "country": "Country", "city": "City", "billings": "Local Amount"}


def write_csv(df: DataFrame, path: str, header_map: dict[str, str] | None = None,
              sep: str = ",", mode: str = "overwrite") -> str:
    out = df
    if header_map:
        out = out.withColumnsRenamed({k: v for k, v in header_map.items() if k in out.columns})
    out.write.mode(mode).option("header", True).option("sep", sep).csv(path)
    return path


def _text_csv(spark: SparkSession, paths, sep: str = ",", multiline: bool = False) -> DataFrame:
    return (spark.read.option("header", True).option("sep", sep).option("multiLine", multiline)
            .option("inferSchema", False).option("mode", "PERMISSIVE").csv(paths))


def load_sales(spark: SparkSession, path: str) -> DataFrame:
    """Read the training CSV, rename known headers, codes as text,
    numbers coerced, ``store_id = partner_code || '_' || store_code``.
    The date stays text until validation (P2)."""
    df = _text_csv(spark, path)
    df = df.withColumnsRenamed({k: v for k, v in SALES_HEADER_MAP.items() if k in df.columns})
    casts = {c: F.col(c).try_cast("double") for c in ("billings", "miles") if c in df.columns}
    df = df.withColumns(casts)
    if "partner_code" in df.columns and "store_code" in df.columns:
        df = df.withColumn("store_id", F.concat_ws("_", "partner_code", "store_code"))
    return df


def list_csv_files(spark: SparkSession, directory: str) -> list[str]:
    """The ``*.csv`` files of ``directory``, its subfolders left out (file-system listing on the
    driver: metadata only)."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(directory)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [s.getPath().toString() for s in fs.listStatus(root) if s.isFile()]
    return sorted(p for p in found if p.endswith(".csv"))


def csv_layouts(spark: SparkSession, directory: str) -> list[tuple[str, list[str]]]:
    """(header line, its files) of every layout among the CSV files; the tasks read the
    headers (the first line of each file's first split), and the driver gets one row a layout."""
    files = list_csv_files(spark, directory)
    if not files:
        return []
    lines = spark.read.text(files).where(F.col("_metadata.file_block_start") == 0).select(
        F.col("_metadata.file_path").alias("path"), "value", F.monotonically_increasing_id().alias("nth"))
    first = lines.groupBy("path").agg(F.min_by("value", "nth").alias("header"))
    found = first.groupBy("header").agg(F.sort_array(F.collect_list("path")).alias("paths")).collect()
    return sorted((r["header"], [unquote(p) for p in r["paths"]]) for r in found)


def load_csv_dir(spark: SparkSession, directory: str) -> DataFrame:
    """Every ``*.csv`` of ``directory``, union by column name (columns missing in a file
    are null).  Files are grouped by header line so each distinct layout is one scan.  A
    header with a line break inside quotes makes its file a layout of its own, read as
    records over several lines (one task a file); empty files add nothing."""
    frames = []
    for header, files in csv_layouts(spark, directory):
        if header.count('"') % 2:
            frames += [_text_csv(spark, f, multiline=True) for f in files]
        else:
            frames.append(_text_csv(spark, files))
    if not frames:
        return spark.createDataFrame([], "value string")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def load_pred_vs_real(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """S3: dashboard upload: headers trimmed and lower-cased, aliases renamed
    unless the target name exists, date and the two numbers coerced (bad ->
    null), rows without a date dropped."""
    return normalize_upload(_text_csv(spark, path, sep))


def normalize_upload(df: DataFrame) -> DataFrame:
    """S3's rules on an all-text frame (batch or streaming)."""
    df = df.toDF(*[c.strip().lower() for c in df.columns])
    for src, dst in DASHBOARD_ALIASES.items():
        if src in df.columns and dst not in df.columns:
            df = df.withColumnRenamed(src, dst)
    if "fecha" in df.columns:
        t = F.trim("fecha")
        df = df.withColumn("fecha", F.coalesce(F.try_to_date(t, "yyyy-MM-dd"),
                                               F.to_date(F.try_to_timestamp(t))))
    df = df.withColumns({c: F.trim(c).try_cast("double")
                         for c in ("ventas_reales", "ventas_predichas") if c in df.columns})
    return df.dropna(subset=["fecha"]) if "fecha" in df.columns else df


def csv_report(df: DataFrame, store_cols: Sequence[str], date_col: str) -> DataFrame:
    """S4 report: rows, distinct stores, first and last date (one pass)."""
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.countDistinct(*store_cols).alias("stores"),
                  F.min(date_col).alias("min_date"), F.max(date_col).alias("max_date"))
