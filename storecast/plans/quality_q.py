"""Registered validation and store-selection queries (SURVEY §2.2 P1-P14,
§2.3 J1/J7, §2.4 A15/A16)."""

from __future__ import annotations

from pyspark.sql import functions as F

from storecast.operators import validation as V
from storecast.plans.catalog import register
from storecast.plans.features_q import REFERENCE_FEATURES, ROW_KEY, feature_table
from storecast.plans.sources_q import DIRTY_CTE, dirty_text
from storecast.session import scratch_path
from storecast.sources.tables import sales

# Parameters of the registered queries.
STORE_LIST = "P20_1, bad ,P16_2,P18_7,P8_42, P1_8,P4_77_x"
RECENT_N = 60           # rows kept per store as the forecast template history
MAX_STORES = 10         # limited training mode of the reference run


STORE_ID = "concat_ws('_', partner_code, store_code) as store_id"


def _dirty(sql):
    return f"with {DIRTY_CTE}\n{sql}"


def _with_id(df):
    return df.withColumn("store_id", F.concat_ws("_", "partner_code", "store_code"))


# two layouts: the sales view, and the EDA files, which have no codes
_LAYOUTS = {"sales": V.REQUIRED_COLUMNS, "eda": ["date", "billings"]}


@register("required_columns", " union all ".join(
    f"select '{name}' as layout, '{c}' as column_name, {str(c in have).lower()} as present, "
    f"{f'count({c})' if c in have else 'max(cast(null as bigint))'} as non_null from sales"
    for name, have in _LAYOUTS.items() for c in V.REQUIRED_COLUMNS))
def q_required_columns(spark, sf_dir):
    s = sales(spark, sf_dir)
    out = None
    for name, df in (("sales", s), ("eda", s.select("date", "partner_name", "country", "city", "billings"))):
        missing = V.missing_columns(df)
        wide = df.agg(*[F.count(c).alias(c) for c in V.REQUIRED_COLUMNS if c not in missing])
        rows = wide.select(F.inline(F.array(*[
            F.struct(F.lit(name).alias("layout"), F.lit(c).alias("column_name"), F.lit(c not in missing).alias("present"),
                     (F.lit(None).cast("bigint") if c in missing else F.col(c)).alias("non_null"))
            for c in V.REQUIRED_COLUMNS])))
        out = rows if out is None else out.unionByName(rows)
    return out


@register("parse_dates", _dirty(f"select {STORE_ID}, date, miles from dirty"))
def q_parse_dates(spark, sf_dir):
    df = dirty_text(spark, sf_dir)
    return _with_id(df).select("store_id", V.parsed_date(df, "date").alias("date"), V.coerced_number(df, "miles").alias("miles"))


@register("coerce_numeric", _dirty(f"select {STORE_ID}, billings, miles from dirty"))
def q_coerce_numeric(spark, sf_dir):
    df = dirty_text(spark, sf_dir)
    return _with_id(df).select("store_id", V.coerced_number(df, "billings").alias("billings"),
                               V.coerced_number(df, "miles").alias("miles"))


def _numbers(spark, sf_dir):
    df = dirty_text(spark, sf_dir)
    return _with_id(df).select("store_id", V.coerced_number(df, "billings").alias("billings"),
                               V.coerced_number(df, "miles").alias("miles"))


@register("fill_target_zero", _dirty(f"select {STORE_ID}, coalesce(billings, 0) as billings, miles from dirty"))
def q_fill_target_zero(spark, sf_dir):
    return V.fill_target_zero(_numbers(spark, sf_dir))


@register("clip_negative", _dirty(
    f"select {STORE_ID}, greatest(coalesce(billings, 0), 0) as billings, miles from dirty"))
def q_clip_negative(spark, sf_dir):
    return V.clip_negative(V.fill_target_zero(_numbers(spark, sf_dir)))


@register("min_rows_check", f"""
select count(*) as rows, count(*) >= {V.MIN_ROWS} as enough_rows from sales""")
def q_min_rows_check(spark, sf_dir):
    return sales(spark, sf_dir).agg(F.count(F.lit(1)).alias("rows")).withColumn(
        "enough_rows", F.col("rows") >= V.MIN_ROWS)


VALIDATION_SQL = _dirty(f"""
select *, case when bad_dates > 0 then '{V.BAD_DATE.format('date')}'
               when rows < {V.MIN_ROWS} then replace('{V.TOO_FEW}', '{{}}', cast(rows as varchar)) end as error
from (select count(*) as rows, count(*) filter (where date is null) as bad_dates,
             count(*) filter (where bad_number) as bad_numbers, count(*) filter (where billings is null) as null_targets,
             count(*) filter (where billings < 0) as negative_targets from dirty) r""")


@register("validate_sales", VALIDATION_SQL)
def q_validate_sales(spark, sf_dir):
    _, report = V.validate_sales(dirty_text(spark, sf_dir))
    return report


@register("validate_sales_written", VALIDATION_SQL)
def q_validate_sales_written(spark, sf_dir):
    """The report of the pass that writes the cleaned rows."""
    return V.validate_and_write(dirty_text(spark, sf_dir), scratch_path(spark, "validated"))[1]


@register("validated_rows", _dirty(f"""
select {STORE_ID}, date, greatest(coalesce(billings, 0), 0) as billings, miles
from dirty order by partner_code, store_code, date"""))
def q_validated_rows(spark, sf_dir):
    """P7's other result: the cleaned rows in canonical order."""
    df = dirty_text(spark, sf_dir)
    clean, _ = V.validate_sales(df.withColumn("miles", V.coerced_number(df, "miles")))
    return _with_id(clean).select("store_id", "date", "billings", "miles")


_RULES_SQL = {"date_parses": "date is not null", "billings_non_negative": "coalesce(billings >= 0, false)",
              "partner_code_not_blank": "coalesce(length(trim(partner_code)) > 0, false)",
              "store_code_not_blank": "coalesce(length(trim(store_code)) > 0, false)"}
_RULES_SQL["any_rule"] = " and ".join(f"({r})" for r in _RULES_SQL.values())


@register("row_rules", _dirty(" union all ".join(
    f"select '{name}' as rule, count(*) filter (where not ({rule})) as violations from dirty"
    for name, rule in _RULES_SQL.items())))
def q_row_rules(spark, sf_dir):
    return V.rule_violations(dirty_text(spark, sf_dir))


@register("sort_canonical", f"select {', '.join(ROW_KEY)}, billings from sales "
                            "order by partner_code, store_code, date, l_orderkey, l_linenumber, l_partkey")
def q_sort_canonical(spark, sf_dir):
    return V.sort_canonical(sales(spark, sf_dir).select(*ROW_KEY, "billings"))


@register("filter_store", f"""
with top as (select partner_code, store_code from sales group by 1, 2
             order by count(*) desc, partner_code, store_code limit 1)
select {', '.join('s.' + c for c in ROW_KEY)}, s.billings from sales s
join top on s.partner_code = top.partner_code and s.store_code = top.store_code""")
def q_filter_store(spark, sf_dir):
    s = sales(spark, sf_dir)
    top = (V.store_sizes(s).orderBy(F.desc("n_rows"), "partner_code", "store_code").first())
    return V.filter_store(s, top["partner_code"], top["store_code"]).select(*ROW_KEY, "billings")


def _store_list_sql(text):
    pairs = []
    for item in text.split(","):
        item = item.strip()
        if "_" not in item:
            continue
        p, s = item.split("_", 1)
        if p and s:
            pairs.append(f"('{p}', '{s}')")
    return (f"select {', '.join('s.' + c for c in ROW_KEY)}, s.billings from sales s "
            f"where (s.partner_code, s.store_code) in (select * from (values {', '.join(pairs)}) v(p, c))")


@register("store_list_filter", _store_list_sql(STORE_LIST))
def q_store_list_filter(spark, sf_dir):
    return V.store_list_filter(sales(spark, sf_dir), STORE_LIST).select(*ROW_KEY, "billings")


def _feature_sql_for(cols_sql):
    from storecast.operators import features as FE
    from storecast.plans.features_q import MODEL_INPUT_SQL
    body = FE.series_features_sql(f"(select *, {FE.calendar_sql('date')} from {MODEL_INPUT_SQL}) c",
                                  "billings", FE.FAMILIES, digits=None, select_cols=["*"])
    return f"select {cols_sql} from ({body}) f"


_NN = " and ".join(f"{c} is not null" for c in REFERENCE_FEATURES + ["billings"])


@register("drop_null_rows", _feature_sql_for(f"{', '.join(ROW_KEY)}, round(billings, 6) as billings")
          + f" where {_NN}")
def q_drop_null_rows(spark, sf_dir):
    f = V.drop_null_rows(feature_table(spark, sf_dir), REFERENCE_FEATURES + ["billings"])
    return f.select(*ROW_KEY, F.round("billings", 6).alias("billings"))


@register("select_features", _feature_sql_for(", ".join(
    ROW_KEY + [f"round({c}, 6) as {c}" for c in REFERENCE_FEATURES])))
def q_select_features(spark, sf_dir):
    f = feature_table(spark, sf_dir)
    cols = V.select_features(f, REFERENCE_FEATURES)
    return f.select(*ROW_KEY, *[F.round(c, 6).alias(c) for c in cols])


@register("recent_sample", f"""
select {', '.join(ROW_KEY)}, billings from (
  select *, row_number() over (partition by partner_code, store_code
                               order by date desc, l_orderkey desc, l_linenumber desc, l_partkey desc) as rn
  from sales) where rn <= {RECENT_N}""")
def q_recent_sample(spark, sf_dir):
    return V.recent_rows(sales(spark, sf_dir), RECENT_N).select(*ROW_KEY, "billings")


@register("valid_stores", f"""
select partner_code, store_code, count(*) as n_rows from sales group by 1, 2
having count(*) >= {V.MIN_TRAIN_ROWS}""")
def q_valid_stores(spark, sf_dir):
    return V.store_sizes(sales(spark, sf_dir), V.MIN_TRAIN_ROWS)


@register("store_sizes", "select partner_code, store_code, count(*) as n_rows from sales group by 1, 2")
def q_store_sizes(spark, sf_dir):
    return V.store_sizes(sales(spark, sf_dir), 1)


@register("distinct_stores", "select distinct partner_code, store_code from sales")
def q_distinct_stores(spark, sf_dir):
    return V.distinct_stores(sales(spark, sf_dir))


@register("limit_stores", f"""
select partner_code, store_code, count(*) as n_rows from sales group by 1, 2
having count(*) >= {V.MIN_TRAIN_ROWS} order by 1, 2 limit {MAX_STORES}""")
def q_limit_stores(spark, sf_dir):
    return V.limit_stores(V.store_sizes(sales(spark, sf_dir), V.MIN_TRAIN_ROWS), MAX_STORES)
