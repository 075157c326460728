"""Revenue aggregates over the sales rows.

Functions named `sql_*` and the monthly view follow the table regime (every row rounded to
cents, decimals, half away from zero, NULL groups kept). `*_kpis` and `mrr_monthly` follow
the frame regime (unrounded rows, doubles, half to even, NULL groups dropped). Either takes
either table: the sums are decimal and exact in both.

Revenue per year is twelve times one month, with all sales taken as recurring.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saldo.functions.cells import discount_band
from saldo.functions.ratios import frame_pct, frame_ratio, frame_round, sql_pct, sql_ratio


def grand_total(groups: DataFrame, value: str) -> Column:
    """Sum of `value` over all groups, as a scalar subquery.

    A window over everything would put all groups into one task. The subquery sums them in
    parallel. It reads the other aggregates too, so that its shuffle is the very one of
    `groups` and Spark runs the pass over the sales rows once for both.
    """
    others = [c for c in groups.columns if c != value]
    reads = [F.max(c).alias(c) for c in others]
    return groups.agg(F.struct(F.sum(value).alias("_total"), *reads).alias("t")).scalar()["_total"]


def _previous(value: str) -> Column:
    # One row per month: at most twelve a year, so one task is enough.
    return F.lag(value).over(Window.orderBy("year_month"))


# ---- table regime ----------------------------------------------------------


def monthly_revenue(sales: DataFrame) -> DataFrame:
    """Monthly view: revenue, yearly revenue, customers, revenue per customer, margin, orders."""
    months = sales.groupBy("year_month", "year", "month").agg(
        F.sum("sales").alias("mrr"),
        F.countDistinct("customer_id").alias("clientes_ativos"),
        F.sum("profit").alias("lucro_bruto"),
        F.countDistinct("order_id").alias("pedidos"),
    )
    mrr, profit = F.col("mrr"), F.col("lucro_bruto")
    return months.select(
        "year_month", "year", "month", "mrr",
        (mrr * 12).alias("arr"),
        "clientes_ativos",
        sql_ratio(mrr, F.col("clientes_ativos")).alias("arpu"),
        "lucro_bruto",
        sql_pct(profit, mrr).alias("margem_pct"),
        "pedidos",
    )


def mrr_growth(view: DataFrame) -> DataFrame:
    """Monthly view with growth over the previous observed month."""
    before = _previous("mrr")
    return view.select(
        F.col("year_month").alias("periodo"),
        F.round("mrr", 2).alias("mrr"),
        F.round("arr", 2).alias("arr"),
        "clientes_ativos",
        F.round("arpu", 2).alias("arpu"),
        F.round("margem_pct", 2).alias("margem_pct"),
        sql_pct(F.col("mrr") - before, before).alias("crescimento_mom_pct"),
    ).orderBy("periodo")


def sql_segments(sales: DataFrame) -> DataFrame:
    groups = sales.groupBy("segment").agg(
        F.countDistinct("customer_id").alias("clientes"),
        F.sum("sales").alias("receita"),
        F.sum("profit").alias("lucro"),
    )
    revenue = F.col("receita")
    return groups.select(
        F.col("segment").alias("segmento"),
        "clientes",
        F.round(revenue, 2).alias("receita_total"),
        F.round("lucro", 2).alias("lucro_total"),
        sql_pct(F.col("lucro"), revenue).alias("margem_pct"),
        sql_pct(revenue, grand_total(groups, "receita")).alias("share_pct"),
        sql_ratio(revenue, F.col("clientes")).alias("arpu"),
    ).orderBy(F.desc_nulls_last("receita_total"), "segmento")


def sql_top_products(sales: DataFrame, n: int = 10) -> DataFrame:
    """The n products of highest revenue, ranked with gaps after ties.

    Whoever outranks one of the first n is among them, so the rank needs only these n rows.
    """
    groups = sales.groupBy("product").agg(
        F.countDistinct("customer_id").alias("clientes"),
        F.sum("sales").alias("receita"),
        F.sum("profit").alias("lucro"),
        F.sum("discount").alias("desconto"),
        F.count("discount").alias("linhas"),
    )
    top = groups.orderBy(F.desc_nulls_last("receita"), "product").limit(n)
    rank = F.rank().over(Window.orderBy(F.desc_nulls_last("receita")))
    return top.select(
        rank.cast("bigint").alias("rank"),
        F.col("product").alias("produto"),
        "clientes",
        F.round("receita", 2).alias("receita_total"),
        sql_pct(F.col("lucro"), F.col("receita")).alias("margem_pct"),
        sql_pct(F.col("desconto"), F.col("linhas")).alias("desconto_medio_pct"),
    ).orderBy("rank", "produto")


def sql_top_customers(sales: DataFrame, n: int = 10) -> DataFrame:
    """The n (customer name, segment) pairs of highest revenue; share is of all pairs."""
    groups = sales.groupBy("customer_name", "segment").agg(
        F.sum("sales").alias("receita"), F.sum("profit").alias("lucro")
    )
    revenue = F.col("receita")
    return (
        groups.orderBy(F.desc_nulls_last("receita"), "customer_name", "segment")
        .limit(n)
        .select(
            F.col("customer_name").alias("cliente"),
            F.col("segment").alias("segmento"),
            F.round(revenue, 2).alias("receita_total"),
            sql_pct(F.col("lucro"), revenue).alias("margem_pct"),
            sql_pct(revenue, grand_total(groups, "receita")).alias("share_pct"),
        )
    )


def sql_quarters(sales: DataFrame) -> DataFrame:
    groups = sales.groupBy("year", "quarter").agg(
        F.sum("sales").alias("receita"),
        F.sum("profit").alias("lucro"),
        F.countDistinct("customer_id").alias("clientes"),
    )
    return groups.select(
        F.col("year").alias("ano"),
        F.col("quarter").alias("trimestre"),
        F.round("receita", 2).alias("receita"),
        F.round("lucro", 2).alias("lucro"),
        sql_pct(F.col("lucro"), F.col("receita")).alias("margem_pct"),
        "clientes",
    ).orderBy("ano", "trimestre")


def sql_discount_bands(sales: DataFrame) -> DataFrame:
    """Rows, revenue and margin per discount band, lowest discount first."""
    groups = sales.groupBy(discount_band(F.col("discount")).alias("faixa_desconto")).agg(
        F.count("*").alias("pedidos"),
        F.sum("sales").alias("receita"),
        F.sum("profit").alias("lucro"),
        F.min("discount").alias("menor"),
    )
    return groups.orderBy("menor").select(
        "faixa_desconto",
        "pedidos",
        F.round("receita", 2).alias("receita_total"),
        sql_pct(F.col("lucro"), F.col("receita")).alias("margem_pct"),
    )


# ---- frame regime ----------------------------------------------------------


def _month_kpis(sales: DataFrame) -> DataFrame:
    months = (
        sales.filter(F.col("year_month").isNotNull())
        .groupBy("year_month")
        .agg(
            F.sum("sales").alias("mrr"),
            F.countDistinct("customer_id").alias("clientes_ativos"),
            F.countDistinct("order_id").alias("pedidos"),
            F.sum("profit").alias("lucro"),
        )
    )
    return months.withColumns({
        "arr": F.col("mrr") * 12,
        "arpu": frame_ratio(F.col("mrr"), F.col("clientes_ativos")),
        "margem_pct": frame_pct(F.col("lucro"), F.col("mrr")),
    })


def mrr_monthly(sales: DataFrame) -> DataFrame:
    """Monthly KPIs; growth over the previous observed month, NULL after a month of zero."""
    now = F.col("mrr").cast("double")
    before = _previous("mrr").cast("double")
    growth = frame_round((F.try_divide(now, before) - 1) * 100)
    return _month_kpis(sales).withColumn("crescimento_mom_pct", growth).orderBy("year_month")


def latest_month_kpis(sales: DataFrame) -> DataFrame:
    """KPIs of the last month; only its rows are aggregated."""
    last = sales.agg(F.max("year_month")).scalar()
    return _month_kpis(sales.filter(F.col("year_month") == last)).select(
        "year_month", "mrr", "arr", "arpu", "clientes_ativos", "margem_pct"
    )


def segment_kpis(sales: DataFrame) -> DataFrame:
    groups = (
        sales.filter(F.col("segment").isNotNull())
        .groupBy("segment")
        .agg(
            F.sum("sales").alias("receita"),
            F.sum("profit").alias("lucro"),
            F.countDistinct("customer_id").alias("clientes"),
            F.countDistinct("order_id").alias("pedidos"),
        )
    )
    revenue = F.col("receita")
    return groups.withColumns({
        "margem_pct": frame_pct(F.col("lucro"), revenue),
        "share_pct": frame_pct(revenue, grand_total(groups, "receita")),
        "arpu": frame_ratio(revenue, F.col("clientes")),
    }).orderBy(F.desc_nulls_last("receita"), "segment")


def segment_report(kpis: DataFrame) -> DataFrame:
    """The columns of the segment KPIs that a reader is shown."""
    return kpis.select("segment", "receita", "margem_pct", "share_pct", "arpu")


def product_kpis(sales: DataFrame) -> DataFrame:
    groups = (
        sales.filter(F.col("product").isNotNull())
        .groupBy("product")
        .agg(
            F.sum("sales").alias("receita"),
            F.sum("profit").alias("lucro"),
            F.countDistinct("customer_id").alias("clientes"),
        )
    )
    revenue = F.col("receita")
    return groups.withColumns({
        "margem_pct": frame_pct(F.col("lucro"), revenue),
        "share_pct": frame_pct(revenue, grand_total(groups, "receita")),
    }).orderBy(F.desc_nulls_last("receita"), "product")


def load_summary(sales: DataFrame) -> DataFrame:
    """One row about a load: period, rows, customers, products, revenue."""
    return sales.agg(
        F.min("order_date").alias("inicio"),
        F.max("order_date").alias("fim"),
        F.count("*").alias("transacoes"),
        F.countDistinct("customer_id").alias("clientes"),
        F.countDistinct("product").alias("produtos"),
        F.sum("sales").alias("receita_total"),
    )
