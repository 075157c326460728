"""Customer activity, churn, retention and lifetime value.

A customer is active in a month with at least one sale; the month before is the previous
observed one. Churn is thus a repurchase proxy and overstates what cancellations would show.

Every function starts from distinct (month, customer) pairs. After that fold a customer has
at most one row per month, so no customer is too large for its window, and a frame with one
row per month has at most twelve rows a year and fits one task.
"""

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from saldo.functions.ratios import exact_round, frame_ratio, mean_of_rounded
from saldo.sources.scratch import settle


def _by_customer() -> WindowSpec:
    return Window.partitionBy("customer_id").orderBy("year_month")


def _by_month() -> WindowSpec:
    return Window.orderBy("year_month")


def _known(sales: DataFrame) -> DataFrame:
    return sales.filter(F.col("year_month").isNotNull() & F.col("customer_id").isNotNull())


def _pairs(sales: DataFrame) -> DataFrame:
    return _known(sales).select("year_month", "customer_id").distinct()


def customer_activity(sales: DataFrame) -> DataFrame:
    """Sales rows per (month, customer)."""
    return _known(sales).groupBy("year_month", "customer_id").agg(F.count("*").alias("pedidos"))


def activity_matrix(sales: DataFrame, months: list[str] | None = None) -> DataFrame:
    """One row per customer, one column per month, 0 where inactive.

    Without `months` the activity is settled first and the months are looked up there.
    """
    activity = customer_activity(sales)
    if months is None:
        activity = settle(activity, "activity")
        found = activity.select("year_month").distinct().orderBy("year_month")
        months = [r.year_month for r in found.collect()]  # at most twelve a year
    pivot = activity.groupBy("customer_id").pivot("year_month", months)
    return pivot.agg(F.avg("pedidos")).na.fill(0.0)


def activity_sparse(sales: DataFrame) -> DataFrame:
    """One row per customer: `meses`, the months with sales in ascending order, each with its rows.

    Nothing is stored for months without sales and nothing is looked up first, so the schema
    does not depend on the data. A customer holds at most twelve entries a year, and its rows
    are folded by month before they meet.
    """
    month = F.struct("year_month", "pedidos")
    return customer_activity(sales).groupBy("customer_id").agg(F.array_sort(F.collect_list(month)).alias("meses"))


def months_between(first: str, last: str) -> list[str]:
    """Months from `first` to `last`, both included, as `2020-01`."""
    number = lambda month: int(month[:4]) * 12 + int(month[5:]) - 1
    return [f"{i // 12:04d}-{i % 12 + 1:02d}" for i in range(number(first), number(last) + 1)]


def widened(sparse: DataFrame, months: list[str]) -> DataFrame:
    """The sparse activity with one column for each of `months`, 0 where inactive, for an export.

    Months that nobody was active in have columns too; those not asked for are left out.
    """
    rows = F.map_from_entries("meses")
    return sparse.select("customer_id", *[
        F.coalesce(rows[month].cast("double"), F.lit(0.0)).alias(month) for month in months])


def _month_states(pairs: DataFrame) -> DataFrame:
    """Per month: active customers, and how many of them return in the next observed month.

    `pairs` has year_month, customer_id, receita. Each pair knows the month of its customer's
    next sale. Nobody in a month returns before the next observed month, so the earliest
    return is either that month or nobody came back in it.
    """
    returns = F.when(F.col("customer_id").isNotNull(), F.lead("year_month").over(_by_customer()))
    flows = (
        pairs.withColumn("volta_em", returns)
        .groupBy("year_month", "volta_em")
        .agg(F.count("customer_id").alias("clientes"), F.sum("receita").alias("receita"))
    )
    return flows.groupBy("year_month").agg(
        F.sum("receita").alias("receita"),
        F.sum("clientes").alias("ativos"),
        F.min("volta_em").alias("primeira_volta"),
        F.min_by("clientes", "volta_em").alias("voltaram"),
    )


def _with_churn(states: DataFrame) -> DataFrame:
    """Adds the churn columns to the months; NULL in the first observed one."""
    # Months without a known customer are not observed: they form a window of their own.
    by_month = Window.partitionBy(F.col("ativos") > 0).orderBy("year_month")
    start = F.lag("ativos").over(by_month)
    returned_at_once = F.lag("primeira_volta").over(by_month) == F.col("year_month")
    stayed = F.when(returned_at_once, F.lag("voltaram").over(by_month)).otherwise(F.lit(0))
    counted = states.withColumns({"clientes_ini": start, "ficaram": stayed}).withColumns({
        "clientes_fim": F.col("ativos"),
        "novos": F.col("ativos") - F.col("ficaram"),
        "sairam": F.col("clientes_ini") - F.col("ficaram"),
    })
    rate = F.try_divide(F.col("sairam"), F.col("clientes_ini"))
    return counted.withColumns({
        "churn_pct": exact_round(rate * 100),
        "retencao_pct": exact_round((1 - rate) * 100),
    })


def churn_monthly(sales: DataFrame) -> DataFrame:
    """Churn per month, from the second observed month on; no rows if there is none."""
    pairs = _pairs(sales).withColumn("receita", F.lit(None).cast("decimal(18,4)"))
    return (
        _with_churn(_month_states(pairs))
        .filter(F.col("clientes_ini").isNotNull())
        .select(
            F.col("year_month").alias("periodo"),
            "clientes_ini", "clientes_fim", "novos", "sairam", "churn_pct", "retencao_pct",
        )
        .orderBy("periodo")
    )


def churn_averages(churn: DataFrame) -> DataFrame:
    """Unweighted means of the monthly percentages."""
    return churn.agg(
        mean_of_rounded(F.col("churn_pct")).alias("churn_pct_medio"),
        mean_of_rounded(F.col("retencao_pct")).alias("retencao_pct_media"),
    )


def _observed_months(pairs: DataFrame) -> DataFrame:
    """Observed months with their neighbours: a calendar, small enough to broadcast.

    The count makes this read the pairs themselves, whose shuffle the caller has anyway.
    """
    return (
        pairs.groupBy("year_month")
        .agg(F.count("*").alias("ativos"))
        .filter(F.col("ativos") > 0)
        .select(
            "year_month",
            F.lag("year_month").over(_by_month()).alias("mes_anterior"),
            F.lead("year_month").over(_by_month()).alias("mes_seguinte"),
        )
    )


def _absent(neighbour: Column, month: str) -> Column:
    return F.col(month).isNotNull() & (neighbour.isNull() | (neighbour != F.col(month)))


def churned_customers(sales: DataFrame) -> DataFrame:
    """(periodo, customer_id): active in the month before `periodo`, not in it."""
    pairs = _pairs(sales)
    following = pairs.withColumn("volta_em", F.lead("year_month").over(_by_customer()))
    return (
        following.join(F.broadcast(_observed_months(pairs)), "year_month")
        .filter(_absent(F.col("volta_em"), "mes_seguinte"))
        .select(F.col("mes_seguinte").alias("periodo"), "customer_id")
    )


def new_customers(sales: DataFrame) -> DataFrame:
    """(periodo, customer_id): active in `periodo`, not in the month before."""
    pairs = _pairs(sales)
    preceding = pairs.withColumn("vinha_de", F.lag("year_month").over(_by_customer()))
    return (
        preceding.join(F.broadcast(_observed_months(pairs)), "year_month")
        .filter(_absent(F.col("vinha_de"), "mes_anterior"))
        .select(F.col("year_month").alias("periodo"), "customer_id")
    )


def _ltv(months: DataFrame) -> DataFrame:
    """One row from the monthly columns arpu and churn_pct; NULLs are months without one."""
    means = months.agg(
        mean_of_rounded(F.col("arpu")).alias("arpu"),
        F.coalesce(mean_of_rounded(F.col("churn_pct")), F.lit(0.0)).alias("churn"),
    )
    rate = F.col("churn") / 100
    life = F.try_divide(F.lit(1.0), rate)
    return means.select(
        exact_round(F.col("arpu")).alias("arpu_medio"),
        exact_round(rate * 100).alias("churn_pct"),
        exact_round(life, 1).alias("meses_vida"),
        exact_round(F.col("arpu") * life).alias("ltv"),
    )


def ltv(monthly: DataFrame, churn: DataFrame) -> DataFrame:
    """Lifetime value from monthly KPIs (arpu) and monthly churn (churn_pct).

    Without churn the rate is 0.0 and life and value are NULL.
    """
    arpu = monthly.select("arpu", F.lit(None).cast("double").alias("churn_pct"))
    rate = churn.select(F.lit(None).cast("double").alias("arpu"), "churn_pct")
    return _ltv(arpu.unionByName(rate))


def ltv_from_sales(sales: DataFrame) -> DataFrame:
    """The same lifetime value in one pass over the sales rows."""
    pairs = (
        sales.filter(F.col("year_month").isNotNull())
        .groupBy("year_month", "customer_id")
        .agg(F.sum("sales").alias("receita"))
    )
    months = _with_churn(_month_states(pairs))
    return _ltv(months.withColumn("arpu", frame_ratio(F.col("receita"), F.col("ativos"))))
