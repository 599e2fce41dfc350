"""Column-expression helpers shared by the operators (all JVM-side)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the reference: the guard that replaces a zero denominator,
# the Spanish weekday names (Monday first), and the model-quality labels with
# their R2 thresholds (strictly greater than).
ZERO_GUARD = 1e-8
WEEKDAY_NAMES_ES = ["Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado", "Domingo"]
QUALITY_THRESHOLDS = [("EXCELENTE", 0.8), ("BUENO", 0.6), ("REGULAR", 0.4)]
QUALITY_FALLBACK = "POBRE"
# Fixed values of the reference's documentation: label, least R2, largest SMAPE.
DOCUMENTED_QUALITY = [("EXCELENTE", 0.9, 5.0), ("BUENO", 0.8, 10.0), ("ACEPTABLE", 0.6, 15.0)]


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def zero_guard(c: str | Column, eps: float = ZERO_GUARD) -> Column:
    """x, with an exact zero replaced by ``eps`` (null stays null)."""
    c = col(c)
    return F.when(c == 0, F.lit(eps)).otherwise(c)


def keep_null(src: str | Column, value: Column) -> Column:
    """``value`` unless ``src`` is null (``greatest`` and friends skip nulls)."""
    return F.when(col(src).isNotNull(), value)


def md5_uniform(*parts: str | Column) -> Column:
    """Deterministic uniform in [0, 1) from the md5 of the '|'-joined parts.

    Same value in DuckDB: ('0x' || substr(md5(s), 1, 8))::UBIGINT / 4294967296.0
    """
    s = F.concat_ws("|", *[col(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(s), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def std_normal(u1: Column, u2: Column) -> Column:
    """Box-Muller standard normal from two uniforms in [0, 1)."""
    return F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - u1)) * F.cos(F.lit(2 * math.pi) * u2)


def quality_label(r2: str | Column) -> Column:
    r2 = col(r2)
    out = None
    for label, threshold in QUALITY_THRESHOLDS:
        out = (F.when(r2 > threshold, F.lit(label)) if out is None
               else out.when(r2 > threshold, F.lit(label)))
    return out.otherwise(F.lit(QUALITY_FALLBACK))


def documented_label(r2: str | Column, smape: str | Column) -> Column:
    """The quality rule of the reference's documentation (D13): R2 and SMAPE."""
    out = F.lit(QUALITY_FALLBACK)
    for label, least, most in reversed(DOCUMENTED_QUALITY):
        out = F.when((col(r2) >= least) & (col(smape) <= most), F.lit(label)).otherwise(out)
    return out


def smape_term(y: str | Column, p: str | Column) -> Column:
    """|y - p| / ((|y| + |p|) / 2), zero denominator -> 1e-8."""
    y, p = col(y), col(p)
    den = (F.abs(y) + F.abs(p)) / 2
    return F.abs(y - p) / zero_guard(den)


def weekday_name(dow: str | Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in WEEKDAY_NAMES_ES]), col(dow) + 1)


def scalar_row(df: DataFrame) -> dict:
    """Collect a one-row aggregate (bounded: exactly one row) to the driver."""
    row = df.first()
    return row.asDict() if row is not None else {}


def fixed(c: str | Column, digits: int) -> Column:
    """Round to ``digits`` decimals as floor(x * 10^d + 0.5) / 10^d: plain
    arithmetic (whole-stage codegen), unlike ``round`` which goes through
    BigDecimal per value; ``fixed_sql`` is the same expression in SQL, so
    both engines produce identical doubles."""
    scale = float(10 ** digits)
    return F.floor(col(c) * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def half_away(c: str | Column, digits: int) -> Column:
    """Round half away from zero on the scaled double, as DuckDB's ``round`` does; Spark's
    goes through the decimal text, which tells 0.5 otherwise apart."""
    scaled = col(c) * F.lit(float(10 ** digits))
    part = F.abs(scaled) % F.lit(1.0)
    return F.signum(scaled) * (F.abs(scaled) - part + (part >= 0.5).cast("double")) / F.lit(float(10 ** digits))


def fixed_sql(expr: str, digits: int) -> str:
    scale = float(10 ** digits)
    return f"(floor(({expr}) * {scale!r}::DOUBLE + 0.5) / {scale!r}::DOUBLE)"
