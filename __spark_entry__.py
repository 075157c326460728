"""Registered queries and the SQL each is checked against.

Queries run over whole tables. Exported types are fixed on both sides: decimals and ratios
are doubles, dates are texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saldo.functions import cells
from saldo.operators import clean as cleaning
from saldo.operators import dates, quality, retention, revenue
from saldo.plans import reports
from saldo.schema import HEADERS
from saldo.sources import csv, scratch, star, warehouse

try:  # the operators for training data are a part that may be absent
    import corpus_pipeline
    from saldo.llm import queries as training
except ImportError:
    training = None

Query = Callable[[SparkSession, str], DataFrame]

# The market segments of the test tables stand for the segments the sales table accepts.
MARKET_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")

_CHECKED = ["row_id", "order_id", "customer_name", "segment", "sales", "quantity", "discount",
            "profit", "year_month"]


def _export(df: DataFrame) -> DataFrame:
    dates = [name for name, kind in df.dtypes if kind == "date"]
    if dates:
        df = df.withColumns({c: F.col(c).cast("string") for c in dates})
    return reports.plain_numbers(df)


def _table_report(report: reports.Report, *columns: str) -> Query:
    return lambda spark, folder: report(star.sales_from_star(spark, folder, columns))


def _clean_report(report: reports.Report, *columns: str) -> Query:
    return lambda spark, folder: report(star.clean_sales_from_star(spark, folder, columns))


def _without_position(df: DataFrame) -> DataFrame:
    return df.drop(*cleaning.POSITION)


# ---- sources and sinks ------------------------------------------------------


def _csv_scan(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch.new_folder(spark, "raw-csv")
    csv.write_csv(star.raw_from_star(spark, folder), path, packed=True)
    return _without_position(csv.read_raw_csv(spark, path))


def _clean_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch.new_folder(spark, "clean-csv")
    csv.write_csv(cleaning.clean(star.raw_from_star(spark, folder)), path, packed=True)
    return csv.read_clean_csv(spark, path)


def _warehouse_load(spark: SparkSession, folder: str) -> DataFrame:
    clean = cleaning.clean(star.raw_from_star(spark, folder))
    return warehouse.load_table(clean, "vendas", segments=MARKET_SEGMENTS)


def _report_batch(spark: SparkSession, folder: str) -> DataFrame:
    columns = ("order_id", "customer_id", "customer_name", "segment", "product", "sales", "discount",
               "profit", "year", "month", "quarter", "year_month")
    sales = scratch.settle(star.sales_from_star(spark, folder, columns), "sales")
    status = reports.run_reports(sales, scratch.new_folder(spark, "reports"))
    return status.select("relatorio", "ok", "linhas", "impressao")


# ---- cleaning ---------------------------------------------------------------


def _dirty_lines(spark: SparkSession, folder: str) -> DataFrame:
    part_key, supplier_key = F.col("l_partkey"), F.col("l_suppkey")
    return star.table(spark, folder, "lineitem").select(
        star.row_key().alias("row_id"),
        F.col("l_linenumber").alias("line"),
        F.when((part_key + supplier_key) % 37 == 0, "n/a")
        .otherwise(star.price().cast("string")).alias("sales"),
        F.when((part_key + supplier_key) % 31 == 0, "1,234.5")
        .otherwise(star.profit().cast("decimal(18,4)").cast("string")).alias("profit"),
        F.when(part_key % 41 != 0, star.line_discount().cast("string")).alias("discount"),
        F.when(part_key % 47 == 0, "").otherwise(F.col("l_quantity").cast("int").cast("string"))
        .alias("quantity"),
        F.when(supplier_key % 29 == 0, "bad").when(supplier_key % 29 == 1, "31/31/2020")
        .otherwise(F.date_format("l_shipdate", "M/d/yyyy")).alias("order_date"),
        part_key.cast("string").alias("customer_id"),
    )


def _coerce_numeric(spark: SparkSession, folder: str) -> DataFrame:
    typed = cleaning.coerce_numbers(_dirty_lines(spark, folder))
    return typed.select("row_id", "sales", "profit", "discount", "quantity")


def _coerce_date(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.coerce_dates(_dirty_lines(spark, folder)).select("row_id", "order_date")


def _dedupe_first(spark: SparkSession, folder: str) -> DataFrame:
    lines = star.table(spark, folder, "lineitem").select(
        star.row_key().alias("row_id"), "l_partkey", "l_suppkey", "l_quantity",
        "l_extendedprice", "l_discount", "l_returnflag",
    )
    return cleaning.dedupe_first(lines)


def _drop_nulls(spark: SparkSession, folder: str) -> DataFrame:
    typed = cleaning.coerce_dates(cleaning.coerce_numbers(_dirty_lines(spark, folder)))
    return cleaning.drop_incomplete(typed).select("row_id", "sales", "order_date", "quantity", "profit")


def _date_parts(spark: SparkSession, folder: str) -> DataFrame:
    orders = star.table(spark, folder, "orders")
    dated = orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("order_date"))
    return cleaning.add_date_parts(dated)


def _date_forms(spark: SparkSession, folder: str) -> DataFrame:
    """What the three dates of a line tell of their forms: month first, day first, year first."""
    ship, commit, receipt = (F.date_add(F.col("l_shipdate").cast("date"), n) for n in (0, 10, 3))
    lines = star.table(spark, folder, "lineitem").select(
        F.when(F.col("l_suppkey") % 29 == 0, "bad").otherwise(F.date_format(ship, "M/d/yyyy")).alias("ship"),
        F.concat(F.date_format(commit, "dd.MM.yyyy"), F.lit(" 08:30")).alias("commit"),
        F.when(F.dayofmonth(receipt) <= 12, F.date_format(receipt, "d-M-yyyy")).otherwise(
            F.date_format(receipt, "yyyy-MM-dd")).alias("receipt"))
    every = None
    for name in lines.columns:
        one = dates.infer(lines, name).report(spark).withColumn("dates", F.lit(name))
        every = one if every is None else every.unionByName(one)
    return every


def _overflow_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Rows whose numbers their columns do not hold, with the texts, after the whole cleaning step."""
    raw = star.raw_from_star(spark, folder)
    part_key = F.col("`Order ID`").cast("bigint") % 7
    large = raw.withColumns({
        "Sales": F.when(part_key == 1, "1e30").when(part_key == 2, "123456789012.5").otherwise(F.col("Sales")),
        "Quantity": F.when(part_key == 3, "9999999999").otherwise(F.col("Quantity")),
        "Date Key": F.when(part_key == 4, F.concat(F.col("`Date Key`"), F.lit("000"))).otherwise(F.col("`Date Key`")),
    })
    typed = quality.to_table_types(cleaning.clean(large, overflow=True))
    rejects = quality.rejected_rows(typed, MARKET_SEGMENTS, ("row_id", cleaning.OVERFLOW))
    texts = [F.concat_ws("=", F.lit(c), cleaning.mark_of(c)) for c in cleaning.MARKED]
    marked = [F.when(cleaning.mark_of(c).isNotNull(), t) for c, t in zip(cleaning.MARKED, texts)]
    return rejects.select("row_id", F.array_join("violations", ",").alias("violations"), F.concat_ws(",", *marked).alias("texts"))


# ---- quality ----------------------------------------------------------------


def _suspects(spark: SparkSession, folder: str) -> DataFrame:
    return quality.to_table_types(star.suspect_sales_from_star(spark, folder))


def _dq_valid(spark: SparkSession, folder: str) -> DataFrame:
    return quality.valid_rows(_suspects(spark, folder), MARKET_SEGMENTS, _CHECKED)


def _dq_rejects(spark: SparkSession, folder: str) -> DataFrame:
    rejects = quality.rejected_rows(_suspects(spark, folder), MARKET_SEGMENTS, _CHECKED)
    return rejects.select(*_CHECKED, F.array_join("violations", ",").alias("violations"))


def _dq_rule_counts(spark: SparkSession, folder: str) -> DataFrame:
    return quality.rule_counts(_suspects(spark, folder), MARKET_SEGMENTS)


# ---- reports ----------------------------------------------------------------


def _mrr_growth(spark: SparkSession, folder: str) -> DataFrame:
    columns = ("year_month", "year", "month", "customer_id", "order_id", "sales", "profit")
    warehouse.create_monthly_view(star.sales_from_star(spark, folder, columns))
    return revenue.mrr_growth(spark.table(warehouse.MONTHLY_VIEW))


def _churn_averages(spark: SparkSession, folder: str) -> DataFrame:
    sales = star.sales_from_star(spark, folder, ("year_month", "customer_id"))
    means = retention.churn_averages(retention.churn_monthly(sales))
    return means.select(*[F.round(c, 6).alias(c) for c in means.columns])


def _activity_sparse(spark: SparkSession, folder: str) -> DataFrame:
    sparse = retention.activity_sparse(star.sales_from_star(spark, folder, _ACTIVITY))
    entry = lambda m: F.concat_ws(":", m["year_month"], m["pedidos"].cast("string"))
    return sparse.select("customer_id", F.size("meses").cast("bigint").alias("n_meses"),
                         F.array_join(F.transform("meses", entry), ",").alias("meses"))


_ACTIVITY = ("year_month", "customer_id")
_MONTH = ("year_month", "customer_id", "order_id", "sales", "profit")

_QUERIES: dict[str, Query] = {
    "csv_scan": _csv_scan,
    "clean_roundtrip": _clean_roundtrip,
    "warehouse_load": _warehouse_load,
    "report_batch": _report_batch,
    "clean_sales": lambda spark, folder: cleaning.clean(star.raw_from_star(spark, folder)),
    "clean_counts": lambda spark, folder: cleaning.clean_counts(star.raw_from_star(spark, folder)),
    "coerce_numeric": _coerce_numeric,
    "coerce_date": _coerce_date,
    "dedupe_first": _dedupe_first,
    "drop_nulls": _drop_nulls,
    "date_parts": _date_parts,
    "date_forms": _date_forms,
    "dq_overflow": _overflow_rejects,
    "dq_valid": _dq_valid,
    "dq_rejects": _dq_rejects,
    "dq_rule_counts": _dq_rule_counts,
    "monthly_revenue_view": _table_report(revenue.monthly_revenue, "year", "month", *_MONTH),
    "mrr_growth": _mrr_growth,
    "sql_segments": _table_report(
        revenue.sql_segments, "segment", "customer_id", "sales", "profit"),
    "sql_top_products": _table_report(
        revenue.sql_top_products, "product", "customer_id", "sales", "profit", "discount"),
    "sql_top_customers": _table_report(
        revenue.sql_top_customers, "customer_name", "segment", "sales", "profit"),
    "sql_quarters": _table_report(
        revenue.sql_quarters, "year", "quarter", "customer_id", "sales", "profit"),
    "sql_discount_bands": _table_report(
        revenue.sql_discount_bands, "discount", "sales", "profit"),
    "load_summary": _table_report(
        revenue.load_summary, "order_date", "customer_id", "product", "sales"),
    "mrr_monthly": _clean_report(revenue.mrr_monthly, *_MONTH),
    "latest_month_kpis": _clean_report(revenue.latest_month_kpis, *_MONTH),
    "segment_kpis": _clean_report(
        revenue.segment_kpis, "segment", "customer_id", "order_id", "sales", "profit"),
    "segment_report": _clean_report(
        lambda sales: revenue.segment_report(revenue.segment_kpis(sales)),
        "segment", "customer_id", "order_id", "sales", "profit"),
    "product_kpis": _clean_report(
        revenue.product_kpis, "product", "customer_id", "sales", "profit"),
    "customer_activity": _table_report(retention.customer_activity, *_ACTIVITY),
    "activity_matrix": _table_report(retention.activity_matrix, *_ACTIVITY),
    "activity_sparse": _activity_sparse,
    "churned_customers": _table_report(retention.churned_customers, *_ACTIVITY),
    "new_customers": _table_report(retention.new_customers, *_ACTIVITY),
    "churn_monthly": _table_report(retention.churn_monthly, *_ACTIVITY),
    "churn_averages": _churn_averages,
    "ltv": _clean_report(retention.ltv_from_sales, "year_month", "customer_id", "sales"),
}


def entry(spark: SparkSession) -> DataFrame:
    """Monthly revenue with growth over the previous month."""
    return queries()["mrr_growth"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    def exported(query: Query) -> Query:
        return lambda spark, folder: _export(query(spark, folder))

    named = {name: exported(query) for name, query in _QUERIES.items()}
    if training:
        named |= training.QUERIES | {"pipeline": corpus_pipeline.run}
    return named


# ---- oracle -----------------------------------------------------------------

_JOINED = """
FROM lineitem
JOIN orders   ON l_orderkey  = o_orderkey
JOIN customer ON o_custkey   = c_custkey
JOIN part     ON l_partkey   = p_partkey
JOIN nation   ON c_nationkey = n_nationkey
JOIN region   ON n_regionkey = r_regionkey
"""

_PRICE = "CAST(l_extendedprice AS DECIMAL(12,2))"
_DISC = "CAST(l_discount AS DECIMAL(5,4))"
_PROFIT = f"({_PRICE} * (1 - 4 * {_DISC}) - CAST(0.7 AS DECIMAL(2,1)) * {_PRICE})"


def _sales_cte(money: str) -> str:
    return f"""WITH vendas AS (
SELECT l_orderkey AS order_id, o_custkey AS customer_id, c_name AS customer_name,
       CAST(o_orderdate AS DATE) AS order_date, c_mktsegment AS segment, p_brand AS product,
       CAST({_PRICE} * (1 - {_DISC}) AS {money}) AS sales,
       CAST(l_quantity AS INT) AS quantity,
       CAST(4 * {_DISC} AS DECIMAL(5,4)) AS discount,
       CAST({_PROFIT} AS {money}) AS profit,
       CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month,
       CAST(quarter(o_orderdate) AS INT) AS quarter,
       strftime(o_orderdate, '%Y-%m') AS year_month
{_JOINED})
"""


_N = _sales_cte("DECIMAL(12,2)")
_F = _sales_cte("DECIMAL(18,4)")


def _int_ratio(num: str, den: str, num_scale: int, den_scale: int, factor: int) -> str:
    """round(num / den * factor, 2) half away from zero, in whole numbers.

    `num` and `den` are decimals with the given scales.
    """
    up = 10 ** max(den_scale - num_scale, 0)
    down = 10 ** max(num_scale - den_scale, 0)
    n = f"CAST(({num}) * {10**num_scale} AS HUGEINT) * {up * factor * 100}"
    d = f"nullif(CAST(({den}) * {10**den_scale} AS HUGEINT) * {down}, 0)"
    half = f"(2 * abs({n}) + abs({d})) // (2 * abs({d}))"
    return f"CAST(sign({n}) * sign({d}) * ({half}) AS DOUBLE) / 100"


def _pct(num: str, den: str) -> str:
    return _int_ratio(num, den, 2, 2, 100)


def _frame_pct(num: str, den: str) -> str:
    return f"round_even((CAST({num} AS DOUBLE) / nullif(CAST({den} AS DOUBLE), 0) * 100) * 100, 0) / 100"


def _frame_ratio(num: str, den: str) -> str:
    return f"round_even((CAST({num} AS DOUBLE) / nullif(CAST({den} AS DOUBLE), 0)) * 100, 0) / 100"


def _mean(x: str) -> str:
    return f"(CAST(sum(CAST({x} AS DECIMAL(18,2))) AS DOUBLE) / nullif(count({x}), 0))"


_ARPU = _int_ratio("sum(sales)", "CAST(count(DISTINCT customer_id) AS DECIMAL(18,0))", 2, 0, 1)

_VIEW = f"""{_N}, visao AS (
SELECT year_month, year, month, sum(sales) AS mrr, count(DISTINCT customer_id) AS clientes_ativos,
       {_ARPU} AS arpu, sum(profit) AS lucro_bruto,
       {_pct("sum(profit)", "sum(sales)")} AS margem_pct, count(DISTINCT order_id) AS pedidos
FROM vendas GROUP BY year_month, year, month)
"""

_F_MONTHS = f"""{_F}, meses AS (
SELECT year_month, sum(sales) AS mrr, count(DISTINCT customer_id) AS clientes_ativos,
       count(DISTINCT order_id) AS pedidos, sum(profit) AS lucro,
       {_frame_ratio("sum(sales)", "count(DISTINCT customer_id)")} AS arpu,
       {_frame_pct("sum(profit)", "sum(sales)")} AS margem_pct
FROM vendas GROUP BY year_month)
"""

# The month of each pair is compared by position among the observed months.
_PAIRS = """, pares AS (SELECT DISTINCT year_month, customer_id FROM vendas),
calendario AS (
SELECT year_month, row_number() OVER (ORDER BY year_month) AS i
FROM (SELECT DISTINCT year_month FROM vendas)),
ativos AS (SELECT i, customer_id FROM pares JOIN calendario USING (year_month)),
sairam AS (
SELECT a.i + 1 AS i, a.customer_id FROM ativos a
ANTI JOIN ativos b ON b.i = a.i + 1 AND b.customer_id = a.customer_id
WHERE a.i < (SELECT max(i) FROM calendario)),
novos AS (
SELECT a.i, a.customer_id FROM ativos a
ANTI JOIN ativos b ON b.i = a.i - 1 AND b.customer_id = a.customer_id
WHERE a.i > 1)
"""

_CHURN = f"""{_PAIRS}, contagem AS (
SELECT c.year_month AS periodo,
       (SELECT count(*) FROM ativos WHERE ativos.i = c.i - 1) AS clientes_ini,
       (SELECT count(*) FROM ativos WHERE ativos.i = c.i) AS clientes_fim,
       (SELECT count(*) FROM novos WHERE novos.i = c.i) AS novos,
       (SELECT count(*) FROM sairam WHERE sairam.i = c.i) AS sairam
FROM calendario c WHERE c.i > 1),
churn AS (
SELECT *,
       CAST(printf('%.2f', CAST(sairam AS DOUBLE) / clientes_ini * 100) AS DOUBLE) AS churn_pct,
       CAST(printf('%.2f', (1 - CAST(sairam AS DOUBLE) / clientes_ini) * 100) AS DOUBLE) AS retencao_pct
FROM contagem)
"""

_BAND = """CASE WHEN discount = 0 THEN '0%  — sem desconto'
WHEN discount <= 0.10 THEN '1% a 10%' WHEN discount <= 0.20 THEN '11% a 20%'
WHEN discount <= 0.30 THEN '21% a 30%' ELSE 'Acima de 30%' END"""

_NBSP = "\u00a0"

_RAW_TEXTS = f"""
CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS row_id,
CAST(l_orderkey AS VARCHAR) AS order_id,
CASE WHEN l_suppkey % 29 = 0 THEN 'bad' ELSE strftime(o_orderdate, '%-m/%-d/%Y') END AS order_date,
strftime(o_orderdate, '%Y%m%d') AS date_key,
'Contact "A", ' || CAST(o_custkey AS VARCHAR) AS contact_name,
n_name AS country,
'São Nº ' || CAST(c_nationkey AS VARCHAR) AS city,
' ' || r_name || chr(9) || ' ' AS region,
r_name || ' / ' || n_name AS subregion,
' ' || c_name || '{_NBSP} ' AS customer_name,
CASE WHEN l_partkey % 43 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS customer_id,
CASE WHEN l_partkey % 7 = 0 THEN {{none}} ELSE p_type END AS industry,
' ' || c_mktsegment AS segment,
p_brand || ' ' AS product,
l_returnflag || l_linestatus AS license,
CASE WHEN (l_partkey + l_suppkey) % 37 = 0 THEN {{na}}
     ELSE CAST(CAST({_PRICE} * (1 - {_DISC}) AS DECIMAL(18,4)) AS VARCHAR) END AS sales,
CASE WHEN l_partkey % 47 <> 0 THEN CAST(CAST(l_quantity AS INT) AS VARCHAR) END AS quantity,
CASE WHEN l_partkey % 41 <> 0 THEN CAST(CAST(4 * {_DISC} AS DECIMAL(5,4)) AS VARCHAR) END AS discount,
CAST(CAST({_PROFIT} AS DECIMAL(18,4)) AS VARCHAR) AS profit
"""

# What the scan gives: the missing-value texts have become NULL.
_SCANNED = _RAW_TEXTS.format(none="NULL", na="NULL")

_COERCED_COLUMNS = [c for c in HEADERS.values()] + ["_row_key"]
_ORDER = ", ".join(f"{c} NULLS FIRST" for c in _COERCED_COLUMNS)


def _coerced_cte(texts: str) -> str:
    return f"""WITH bruto AS (SELECT {texts} {_JOINED}),
convertido AS (
SELECT * REPLACE (
  TRY_CAST(sales AS DECIMAL(18,4)) AS sales, TRY_CAST(profit AS DECIMAL(18,4)) AS profit,
  TRY_CAST(quantity AS DECIMAL(18,4)) AS quantity,
  coalesce(TRY_CAST(discount AS DECIMAL(18,4)), 0) AS discount,
  CAST(try_strptime(order_date, '%m/%d/%Y') AS DATE) AS order_date), row_id AS _row_key
FROM bruto),
primeiro AS (
SELECT * FROM convertido
QUALIFY row_number() OVER (PARTITION BY _row_key ORDER BY {_ORDER}) = 1),
completo AS (
SELECT * FROM primeiro WHERE sales IS NOT NULL AND customer_id IS NOT NULL
AND order_date IS NOT NULL AND quantity IS NOT NULL AND profit IS NOT NULL)
"""


def _clean_select(industry: str, money: str) -> str:
    blank = f"' ' || chr(9) || '{_NBSP}'"
    return f"""
SELECT CAST(row_id AS BIGINT) AS row_id, order_id, CAST(order_date AS VARCHAR) AS order_date,
  CAST(date_key AS INT) AS date_key, contact_name, country, city, trim(region, {blank}) AS region,
  subregion, trim(customer_name, {blank}) AS customer_name, customer_id, {industry} AS industry,
  trim(segment, {blank}) AS segment, trim(product, {blank}) AS product, license,
  CAST(CAST(sales AS {money}) AS DOUBLE) AS sales, CAST(quantity AS INT) AS quantity,
  CAST(CAST(discount AS DECIMAL(5,4)) AS DOUBLE) AS discount,
  CAST(CAST(profit AS {money}) AS DOUBLE) AS profit,
  CAST(year(order_date) AS INT) AS year, CAST(month(order_date) AS INT) AS month,
  CAST(quarter(order_date) AS INT) AS quarter, strftime(order_date, '%Y-%m') AS year_month
FROM completo"""


# Straight from the star there was no scan yet that would turn 'None' into NULL.
_UNSCANNED_CTE = _coerced_cte(_RAW_TEXTS.format(none="'None'", na="'n/a'"))

_DIRTY = f"""WITH linhas AS (
SELECT l_orderkey * 10 + l_linenumber AS row_id,
  CASE WHEN (l_partkey + l_suppkey) % 37 <> 0 THEN {_PRICE} END AS sales,
  CASE WHEN (l_partkey + l_suppkey) % 31 <> 0 THEN CAST({_PROFIT} AS DECIMAL(18,4)) END AS profit,
  CASE WHEN l_partkey % 41 <> 0 THEN {_DISC} ELSE 0 END AS discount,
  CASE WHEN l_partkey % 47 <> 0 THEN CAST(l_quantity AS INT) END AS quantity,
  CASE WHEN l_suppkey % 29 > 1 THEN CAST(l_shipdate AS DATE) END AS order_date
FROM lineitem)
"""

def _shape_sql(name: str, shape: str, sep: str, digits: int, rows: str, days: str, day_place: str, form: str, ambiguous: str) -> str:
    over = f"count(*) FILTER ({rows} AND {days} > 12)"
    first, second = (over, "0") if day_place == "first" else ("0", over) if day_place == "second" else ("0", "0")
    text = f"'{form}'" if form else "CAST(NULL AS VARCHAR)"
    return f"""SELECT '{name}' AS dates, '{shape}' AS shape, '{sep}' AS separator, CAST({digits} AS INT) AS year_digits,
  count(*) FILTER ({rows}) AS rows, CAST({first} AS BIGINT) AS first_over_12, CAST({second} AS BIGINT) AS second_over_12,
  {text} AS format, {ambiguous} AS ambiguous, CAST(0 AS BIGINT) AS contrary FROM lineitem HAVING count(*) FILTER ({rows}) > 0"""


_DATE_FORMS = " UNION ALL ".join([
    _shape_sql("ship", "year last", "/", 4, "l_suppkey % 29 <> 0", "day(l_shipdate)", "second", "M/d/yyyy", "false"),
    _shape_sql("ship", "other", "", 0, "l_suppkey % 29 = 0", "0", "", "", "false"),
    _shape_sql("commit", "year last", ".", 4, "true", "day(l_shipdate + INTERVAL 10 DAY)", "first", "d.M.yyyy", "false"),
    # Days up to twelve tell nothing, so the default order stands and is reported.
    _shape_sql("receipt", "year last", "-", 4, "day(l_shipdate + INTERVAL 3 DAY) <= 12", "0", "", "M-d-yyyy", "true"),
    _shape_sql("receipt", "year first", "-", 4, "day(l_shipdate + INTERVAL 3 DAY) > 12", "day(l_shipdate + INTERVAL 3 DAY)", "second", "yyyy-M-d", "false"),
])

_SUSPECTS = f"""WITH linhas AS (
SELECT l_orderkey * 10 + l_linenumber AS row_id,
  CASE WHEN l_partkey % 101 = 0 THEN lpad(CAST(l_orderkey AS VARCHAR), 51, '0')
       ELSE CAST(l_orderkey AS VARCHAR) END AS order_id,
  CASE WHEN o_custkey % 97 <> 0 THEN c_name END AS customer_name,
  CASE WHEN c_nationkey = 7 THEN 'OTHER' WHEN c_nationkey <> 8 THEN c_mktsegment END AS segment,
  CASE WHEN l_suppkey % 53 = 0 THEN CAST(0 AS DECIMAL(12,2))
       ELSE CAST(CAST({_PRICE} * (1 - {_DISC}) - 2500 AS DECIMAL(18,4)) AS DECIMAL(12,2)) END AS sales,
  CAST(l_quantity AS INT) - 1 AS quantity, 12 * {_DISC} AS discount,
  CAST(CAST({_PROFIT} AS DECIMAL(18,4)) AS DECIMAL(12,2)) AS profit,
  strftime(o_orderdate, '%Y-%m') AS year_month,
  count(*) OVER (PARTITION BY l_orderkey * 10 + l_linenumber) AS copies
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey),
regras AS (
SELECT *, customer_name IS NULL AS r1,
  coalesce(segment NOT IN ({", ".join(f"'{s}'" for s in MARKET_SEGMENTS)}), false) AS r2,
  sales < 0 AS r3, quantity <= 0 AS r4, discount > 1 AS r5, length(order_id) > 50 AS r6,
  copies > 1 AS r7
FROM linhas)
"""

# Rules the suspect rows can break, in the order of the checks.
_BREAKABLE = {
    "customer_name_not_null": "r1",
    "segment_known": "r2",
    "sales_not_negative": "r3",
    "quantity_positive": "r4",
    "discount_0_to_1": "r5",
    "order_id_length": "r6",
    quality.UNIQUE_RULE: "r7",
}

_CHECKED_SQL = """row_id, order_id, customer_name, segment, CAST(sales AS DOUBLE) AS sales,
quantity, CAST(discount AS DOUBLE) AS discount, CAST(profit AS DOUBLE) AS profit, year_month"""


def _rule_counts_sql() -> str:
    unbroken = ["year_not_null", "month_not_null", "quarter_not_null", "month_1_to_12", "quarter_1_to_4"]
    unbroken += [f"{c}_not_null" for c in (
        "row_id", "order_id", "customer_id", "order_date", "product", "sales", "quantity",
        "discount", "profit", "year_month")]
    unbroken += [f"{c}_length" for c in (
        "customer_id", "customer_name", "contact_name", "country", "city", "region", "subregion",
        "industry", "segment", "product", "license", "year_month")]
    parts = [
        f"SELECT '{rule}' AS regra, CAST(count(*) FILTER (WHERE {flag}) AS BIGINT) AS linhas FROM regras"
        for rule, flag in _BREAKABLE.items()
    ]
    parts += [
        f"SELECT '{rule}' AS regra, CAST(count(*) FILTER (WHERE false) AS BIGINT) AS linhas FROM regras"
        for rule in unbroken
    ]
    return _SUSPECTS + " UNION ALL ".join(parts)


# The months of the test tables; a PIVOT cannot stand in a view.
_MATRIX = "SELECT customer_id, " + ", ".join(
    f"""CAST(coalesce(sum(CASE WHEN year_month = '{y}-{m:02d}' THEN 1 END), 0) AS DOUBLE) AS "{y}-{m:02d}\""""
    for y in range(1995, 2002) for m in range(1, 13) if (y, m) <= (2001, 8)) + " FROM vendas GROUP BY customer_id"


# Order ids are the same in all lines of an order, so the first copy of a row id has the same case as the others.
_OVERFLOW = f"""WITH bruto AS (SELECT {_RAW_TEXTS.format(none="'None'", na="'n/a'")}, l_orderkey % 7 AS k {_JOINED}),
grande AS (SELECT * REPLACE (
  CASE WHEN k = 1 THEN '1e30' WHEN k = 2 THEN '123456789012.5' ELSE sales END AS sales,
  CASE WHEN k = 3 THEN '9999999999' ELSE quantity END AS quantity,
  CASE WHEN k = 4 THEN date_key || '000' ELSE date_key END AS date_key) FROM bruto),
convertido AS (SELECT * REPLACE (
  CASE WHEN k = 1 THEN NULL ELSE TRY_CAST(sales AS DECIMAL(18,4)) END AS sales, TRY_CAST(profit AS DECIMAL(18,4)) AS profit,
  TRY_CAST(quantity AS DECIMAL(18,4)) AS quantity, coalesce(TRY_CAST(discount AS DECIMAL(18,4)), 0) AS discount,
  CAST(try_strptime(order_date, '%m/%d/%Y') AS DATE) AS order_date), row_id AS _row_key FROM grande),
primeiro AS (SELECT * FROM convertido QUALIFY row_number() OVER (PARTITION BY _row_key ORDER BY {_ORDER}) = 1),
completo AS (SELECT * FROM primeiro WHERE (sales IS NOT NULL OR k = 1) AND customer_id IS NOT NULL
  AND order_date IS NOT NULL AND quantity IS NOT NULL AND profit IS NOT NULL),
marcado AS (SELECT CAST(row_id AS BIGINT) AS row_id,
  CASE WHEN k IN (1, 2) THEN 'sales_fits' END AS v1, CASE WHEN k = 3 THEN 'quantity_fits' END AS v2,
  CASE WHEN k = 4 THEN 'date_key_fits' END AS v3, CASE WHEN k NOT IN (1, 2) AND sales < 0 THEN 'sales_not_negative' END AS v4,
  CASE WHEN k = 1 THEN 'sales=1e30' WHEN k = 2 THEN 'sales=123456789012.5000000000' WHEN k = 3 THEN 'quantity=9999999999.0000000000'
       WHEN k = 4 THEN 'date_key=' || date_key ELSE '' END AS texts,
  CASE WHEN discount > 1 THEN 'discount_0_to_1' END AS v5 FROM completo)
SELECT row_id, concat_ws(',', v1, v2, v3, v4, v5) AS violations, texts FROM marcado
WHERE concat_ws(',', v1, v2, v3, v4, v5) <> ''"""

_SQL_GROWTH = _int_ratio("mrr - antes", "antes", 2, 2, 100)

# Report file -> its query, its columns in order of their names; those of text are marked.
_REPORT_COLUMNS = {
    "sql_mrr_mensal": ("mrr_growth", "arpu arr clientes_ativos crescimento_mom_pct margem_pct mrr periodo:"),
    "sql_segmentos": ("sql_segments", "arpu clientes lucro_total margem_pct receita_total segmento: share_pct"),
    "sql_top_produtos": ("sql_top_products", "clientes desconto_medio_pct margem_pct produto: rank receita_total"),
    "sql_top_clientes": ("sql_top_customers", "cliente: margem_pct receita_total segmento: share_pct"),
    "sql_trimestral": ("sql_quarters", "ano clientes lucro margem_pct receita trimestre"),
    "sql_descontos": ("sql_discount_bands", "faixa_desconto: margem_pct pedidos receita_total"),
}


def _report_status(name: str, columns: str, sql: str) -> str:
    """SQL of the row of the status that one report gets."""
    values = ", ".join(
        f"coalesce({c[:-1]}, '\\N')" if c.endswith(":") else f"coalesce(CAST(CAST({c} AS DECIMAL(38,4)) AS VARCHAR), '\\N')"
        for c in columns.split())
    return f"""SELECT '{name}' AS relatorio, true AS ok, count(*) AS linhas,
  CAST(coalesce(sum(CAST('0x' || substr(md5(concat_ws(chr(31), {values})), 1, 15) AS BIGINT)), 0) AS VARCHAR) AS impressao
FROM ({sql})"""


def oracle_sql() -> dict[str, str]:
    scanned = ", ".join(f'{column} AS "{header}"' for header, column in HEADERS.items())
    names = ", ".join(f"CASE WHEN {flag} THEN '{rule}' END" for rule, flag in sorted(
        _BREAKABLE.items(), key=lambda item: item[1]))
    broken = " OR ".join(_BREAKABLE.values())
    revenue_f = "CAST(sum(sales) AS DOUBLE) AS receita, CAST(sum(profit) AS DOUBLE) AS lucro"
    total = "sum(sum(sales)) OVER ()"
    customers = "count(DISTINCT customer_id)"
    sql = (training.ORACLE_SQL if training else {}) | {
        "csv_scan": f"WITH bruto AS (SELECT {_SCANNED} {_JOINED}) SELECT {scanned} FROM bruto",
        "clean_roundtrip": _UNSCANNED_CTE + _clean_select("nullif(industry, 'None')", "DECIMAL(18,4)"),
        "warehouse_load": _UNSCANNED_CTE + _clean_select("industry", "DECIMAL(12,2)"),
        "clean_sales": _UNSCANNED_CTE + _clean_select("industry", "DECIMAL(18,4)"),
        "clean_counts": f"""{_UNSCANNED_CTE}
SELECT CAST((SELECT count(*) FROM convertido) AS BIGINT) AS linhas_originais,
  CAST((SELECT count(*) FROM convertido WHERE order_date IS NULL) AS BIGINT) AS datas_invalidas,
  CAST((SELECT count(*) FROM convertido) - (SELECT count(*) FROM completo) AS BIGINT) AS removidas,
  CAST((SELECT count(*) FROM completo) AS BIGINT) AS restantes""",
        "coerce_numeric": f"""{_DIRTY} SELECT row_id, CAST(sales AS DOUBLE) AS sales,
  CAST(profit AS DOUBLE) AS profit, CAST(discount AS DOUBLE) AS discount,
  CAST(quantity AS DOUBLE) AS quantity FROM linhas""",
        "coerce_date": f"{_DIRTY} SELECT row_id, CAST(order_date AS VARCHAR) AS order_date FROM linhas",
        "dedupe_first": """
SELECT l_orderkey * 10 + l_linenumber AS row_id, l_partkey, l_suppkey, l_quantity,
  l_extendedprice, l_discount, l_returnflag
FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey * 10 + l_linenumber
  ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_returnflag) = 1""",
        "drop_nulls": f"""{_DIRTY} SELECT row_id, CAST(sales AS DOUBLE) AS sales,
  CAST(order_date AS VARCHAR) AS order_date, CAST(quantity AS DOUBLE) AS quantity,
  CAST(profit AS DOUBLE) AS profit FROM linhas
WHERE sales IS NOT NULL AND order_date IS NOT NULL AND quantity IS NOT NULL AND profit IS NOT NULL""",
        "date_parts": """
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date,
  CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month,
  CAST(quarter(o_orderdate) AS INT) AS quarter, strftime(o_orderdate, '%Y-%m') AS year_month
FROM orders""",
        "date_forms": _DATE_FORMS,
        "dq_overflow": _OVERFLOW,
        "dq_valid": f"{_SUSPECTS} SELECT {_CHECKED_SQL} FROM regras WHERE NOT ({broken})",
        "dq_rejects": f"""{_SUSPECTS} SELECT {_CHECKED_SQL}, concat_ws(',', {names}) AS violations
FROM regras WHERE {broken}""",
        "dq_rule_counts": _rule_counts_sql(),
        "monthly_revenue_view": f"""{_VIEW}
SELECT year_month, year, month, CAST(mrr AS DOUBLE) AS mrr, CAST(mrr * 12 AS DOUBLE) AS arr,
  clientes_ativos, arpu, CAST(lucro_bruto AS DOUBLE) AS lucro_bruto, margem_pct, pedidos FROM visao""",
        "mrr_growth": f"""{_VIEW}, anterior AS (
SELECT *, lag(mrr) OVER (ORDER BY year_month) AS antes FROM visao)
SELECT year_month AS periodo, CAST(mrr AS DOUBLE) AS mrr, CAST(mrr * 12 AS DOUBLE) AS arr,
  clientes_ativos, arpu, margem_pct, {_SQL_GROWTH} AS crescimento_mom_pct
FROM anterior ORDER BY periodo""",
        "sql_segments": f"""{_N}
SELECT segment AS segmento, {customers} AS clientes, CAST(sum(sales) AS DOUBLE) AS receita_total,
  CAST(sum(profit) AS DOUBLE) AS lucro_total, {_pct("sum(profit)", "sum(sales)")} AS margem_pct,
  {_pct("sum(sales)", total)} AS share_pct, {_ARPU} AS arpu
FROM vendas GROUP BY segment ORDER BY receita_total DESC""",
        "sql_top_products": f"""{_N}
SELECT rank() OVER (ORDER BY sum(sales) DESC) AS rank, product AS produto, {customers} AS clientes,
  CAST(sum(sales) AS DOUBLE) AS receita_total, {_pct("sum(profit)", "sum(sales)")} AS margem_pct,
  {_int_ratio("sum(discount)", "CAST(count(discount) AS DECIMAL(18,0))", 4, 0, 100)} AS desconto_medio_pct
FROM vendas GROUP BY product ORDER BY sum(sales) DESC, product LIMIT 10""",
        "sql_top_customers": f"""{_N}
SELECT customer_name AS cliente, segment AS segmento, CAST(sum(sales) AS DOUBLE) AS receita_total,
  {_pct("sum(profit)", "sum(sales)")} AS margem_pct, {_pct("sum(sales)", total)} AS share_pct
FROM vendas GROUP BY customer_name, segment
ORDER BY sum(sales) DESC, customer_name, segment LIMIT 10""",
        "sql_quarters": f"""{_N}
SELECT year AS ano, quarter AS trimestre, CAST(sum(sales) AS DOUBLE) AS receita,
  CAST(sum(profit) AS DOUBLE) AS lucro, {_pct("sum(profit)", "sum(sales)")} AS margem_pct,
  {customers} AS clientes FROM vendas GROUP BY year, quarter ORDER BY year, quarter""",
        "sql_discount_bands": f"""{_N}
SELECT {_BAND} AS faixa_desconto, count(*) AS pedidos, CAST(sum(sales) AS DOUBLE) AS receita_total,
  {_pct("sum(profit)", "sum(sales)")} AS margem_pct
FROM vendas GROUP BY faixa_desconto ORDER BY min(discount)""",
        "load_summary": f"""{_N}
SELECT CAST(min(order_date) AS VARCHAR) AS inicio, CAST(max(order_date) AS VARCHAR) AS fim,
  count(*) AS transacoes, {customers} AS clientes, count(DISTINCT product) AS produtos,
  CAST(sum(sales) AS DOUBLE) AS receita_total FROM vendas""",
        "mrr_monthly": f"""{_F_MONTHS}, anterior AS (
SELECT *, lag(CAST(mrr AS DOUBLE)) OVER (ORDER BY year_month) AS antes FROM meses)
SELECT year_month, CAST(mrr AS DOUBLE) AS mrr, clientes_ativos, pedidos,
  CAST(lucro AS DOUBLE) AS lucro, CAST(mrr * 12 AS DOUBLE) AS arr, arpu, margem_pct,
  round_even(((CAST(mrr AS DOUBLE) / nullif(antes, 0) - 1) * 100) * 100, 0) / 100 AS crescimento_mom_pct
FROM anterior ORDER BY year_month""",
        "latest_month_kpis": f"""{_F_MONTHS}
SELECT year_month, CAST(mrr AS DOUBLE) AS mrr, CAST(mrr * 12 AS DOUBLE) AS arr, arpu,
  clientes_ativos, margem_pct FROM meses ORDER BY year_month DESC LIMIT 1""",
        "segment_kpis": f"""{_F}
SELECT segment, {revenue_f}, {customers} AS clientes, count(DISTINCT order_id) AS pedidos,
  {_frame_pct("sum(profit)", "sum(sales)")} AS margem_pct,
  {_frame_pct("sum(sales)", total)} AS share_pct, {_frame_ratio("sum(sales)", customers)} AS arpu
FROM vendas GROUP BY segment ORDER BY receita DESC""",
        "segment_report": f"""{_F}
SELECT segment, {revenue_f.split(",")[0]},
  {_frame_pct("sum(profit)", "sum(sales)")} AS margem_pct,
  {_frame_pct("sum(sales)", total)} AS share_pct, {_frame_ratio("sum(sales)", customers)} AS arpu
FROM vendas GROUP BY segment ORDER BY receita DESC""",
        "product_kpis": f"""{_F}
SELECT product, {revenue_f}, {customers} AS clientes,
  {_frame_pct("sum(profit)", "sum(sales)")} AS margem_pct,
  {_frame_pct("sum(sales)", total)} AS share_pct
FROM vendas GROUP BY product ORDER BY receita DESC""",
        "customer_activity": f"""{_N}
SELECT year_month, customer_id, count(*) AS pedidos FROM vendas GROUP BY year_month, customer_id""",
        "activity_matrix": f"{_N} {_MATRIX}",
        "activity_sparse": f"""{_N}
SELECT customer_id, count(*) AS n_meses, string_agg(year_month || ':' || linhas, ',' ORDER BY year_month) AS meses
FROM (SELECT customer_id, year_month, count(*) AS linhas FROM vendas GROUP BY customer_id, year_month)
GROUP BY customer_id""",
        "churned_customers": f"""{_N}{_PAIRS}
SELECT year_month AS periodo, customer_id FROM sairam JOIN calendario USING (i)""",
        "new_customers": f"""{_N}{_PAIRS}
SELECT year_month AS periodo, customer_id FROM novos JOIN calendario USING (i)""",
        "churn_monthly": f"{_N}{_CHURN} SELECT * FROM churn ORDER BY periodo",
        "churn_averages": f"""{_N}{_CHURN}
SELECT round({_mean("churn_pct")}, 6) AS churn_pct_medio,
  round({_mean("retencao_pct")}, 6) AS retencao_pct_media FROM churn""",
        "ltv": f"""{_F_MONTHS}{_CHURN}, medias AS (
SELECT (SELECT {_mean("arpu")} FROM meses) AS arpu, (SELECT {_mean("churn_pct")} FROM churn) / 100 AS taxa)
SELECT CAST(printf('%.2f', arpu) AS DOUBLE) AS arpu_medio,
  CAST(printf('%.2f', taxa * 100) AS DOUBLE) AS churn_pct,
  CAST(printf('%.1f', 1 / taxa) AS DOUBLE) AS meses_vida,
  CAST(printf('%.2f', arpu * (1 / taxa)) AS DOUBLE) AS ltv FROM medias""",
    }
    sql["report_batch"] = " UNION ALL ".join(
        _report_status(name, columns, sql[query]) for name, (query, columns) in _REPORT_COLUMNS.items())
    return sql
