"""Sales rows from a star schema of line items, orders, customers, parts, nations, regions.

The star has no cost and few discounts, so profit is price less discount less 70 % of the
price, and the discount is four times that of the line, which reaches every discount band.
Only the tables that the asked columns need are joined: Spark does not drop an inner join
whose columns nobody reads.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from saldo.functions.cells import month_key
from saldo.schema import STAR_MONEY, TABLE_MONEY

SALES_COLUMNS = (
    "row_id", "order_id", "customer_id", "customer_name", "order_date", "country", "region",
    "segment", "product", "sales", "quantity", "discount", "profit",
    "year", "month", "quarter", "year_month",
)

#: Lines that one task joins to their orders, and the most tasks of that join; beyond, tasks grow and spill.
LINES_PER_TASK = 500_000
MOST_TASKS = 20_000

_FROM_ORDERS = {"customer_id", "order_date", "year", "month", "quarter", "year_month"}
_FROM_CUSTOMER = {"customer_name", "segment"}
_FROM_PART = {"product"}
_FROM_NATION = {"country"}
_FROM_REGION = {"region"}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def price() -> Column:
    return F.col("l_extendedprice").cast(TABLE_MONEY)


def line_discount() -> Column:
    return F.col("l_discount").cast("decimal(5,4)")


def row_key() -> Column:
    """Line key; not unique, which is what deduplication is for."""
    return F.col("l_orderkey") * 10 + F.col("l_linenumber")


def profit() -> Column:
    return price() * (1 - 4 * line_discount()) - F.lit("0.7").cast("decimal(2,1)") * price()


def _columns(money: DecimalType) -> dict[str, Column]:
    date = F.col("o_orderdate")
    return {
        "row_id": row_key(),
        "order_id": F.col("l_orderkey"),
        "customer_id": F.col("o_custkey"),
        "customer_name": F.col("c_name"),
        "order_date": date.cast("date"),
        "country": F.col("n_name"),
        "region": F.col("r_name"),
        "segment": F.col("c_mktsegment"),
        "product": F.col("p_brand"),
        "sales": (price() * (1 - line_discount())).cast(money),
        "quantity": F.col("l_quantity").cast("int"),
        "discount": (4 * line_discount()).cast("decimal(5,4)"),
        "profit": profit().cast(money),
        "year": F.year(date),
        "month": F.month(date),
        "quarter": F.quarter(date),
        "year_month": month_key(date),
    }


def joined(spark: SparkSession, folder: str, *, orders: bool = False, customer: bool = False,
           part: bool = False, nation: bool = False, region: bool = False) -> DataFrame:
    """Line items with the asked tables.

    Orders grow with the lines, so that join always shuffles by order, never broadcasts; the
    lines of an order then share a task, and counting orders folds them there. It comes last.
    Customers join the orders, so that lines travel once for both. Spark chooses how to join the
    others by their size.
    """
    lines = table(spark, folder, "lineitem")
    tasks = _tasks(lines) if orders or customer or nation or region else None
    if part:
        lines = lines.join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
    if tasks is None:
        return lines
    bought = table(spark, folder, "orders")
    if customer or nation or region:
        buyers = table(spark, folder, "customer")
        if nation or region:
            buyers = buyers.join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        if region:
            buyers = buyers.join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        bought = bought.join(buyers, F.col("o_custkey") == F.col("c_custkey"))
    if tasks:
        lines, bought = lines.repartition(tasks, "l_orderkey"), bought.repartition(tasks, "o_orderkey")
    return lines.hint("merge").join(bought, F.col("l_orderkey") == F.col("o_orderkey"))


def _tasks(lines: DataFrame) -> int:
    """Tasks of the join to orders, 0 to leave them to Spark; the count reads footers only.

    Spark merges tasks by what their narrow lines weigh before the join, and the sorts and hash
    tables of the rows behind it grew by that. Where a task for each core would hold more than
    LINES_PER_TASK, their number is thus told, or is Spark's own for a shuffle if that is larger.
    Such tasks are not split: an order is taken to have few lines.
    """
    tasks = -(-lines.count() // LINES_PER_TASK)
    return 0 if tasks <= lines.sparkSession.sparkContext.defaultParallelism else min(tasks, MOST_TASKS)


def sales_from_star(spark: SparkSession, folder: str, columns: Sequence[str] = SALES_COLUMNS,
                    money: DecimalType = TABLE_MONEY) -> DataFrame:
    """Sales rows with `columns`; money in table form (cents) or clean form (4 decimals)."""
    asked = set(columns)
    unknown = asked - set(SALES_COLUMNS)
    if unknown:
        raise ValueError(f"unknown columns: {sorted(unknown)}")
    source = joined(
        spark, folder,
        orders=bool(asked & _FROM_ORDERS),
        customer=bool(asked & _FROM_CUSTOMER),
        part=bool(asked & _FROM_PART),
        nation=bool(asked & _FROM_NATION),
        region=bool(asked & _FROM_REGION),
    )
    expressions = _columns(money)
    return source.select(*[expressions[c].alias(c) for c in columns])


def clean_sales_from_star(spark: SparkSession, folder: str,
                          columns: Sequence[str] = SALES_COLUMNS) -> DataFrame:
    return sales_from_star(spark, folder, columns, STAR_MONEY)


def _text(value: Column) -> Column:
    return value.cast("string")


def raw_from_star(spark: SparkSession, folder: str) -> DataFrame:
    """The star as a raw file would hold it: 19 text columns, some of them dirty.

    Sales 'n/a', a bad date, an empty customer id or quantity, a missing discount, blanks
    around names, and row ids that occur more than once.
    """
    part_key, supplier_key = F.col("l_partkey"), F.col("l_suppkey")
    date = F.col("o_orderdate")
    sales = (price() * (1 - line_discount())).cast(STAR_MONEY)
    columns = {
        "Row ID": _text(row_key()),
        "Order ID": _text(F.col("l_orderkey")),
        "Order Date": F.when(supplier_key % 29 == 0, "bad").otherwise(F.date_format(date, "M/d/yyyy")),
        "Date Key": F.date_format(date, "yyyyMMdd"),
        "Contact Name": F.concat(F.lit('Contact "A", '), _text(F.col("o_custkey"))),
        "Country": F.col("n_name"),
        "City": F.concat(F.lit("São Nº "), _text(F.col("c_nationkey"))),
        "Region": F.concat(F.lit(" "), F.col("r_name"), F.lit("\t ")),
        "Subregion": F.concat(F.col("r_name"), F.lit(" / "), F.col("n_name")),
        "Customer": F.concat(F.lit(" "), F.col("c_name"), F.lit("\u00a0 ")),
        "Customer ID": F.when(part_key % 43 != 0, _text(F.col("o_custkey"))),
        "Industry": F.when(part_key % 7 == 0, "None").otherwise(F.col("p_type")),
        "Segment": F.concat(F.lit(" "), F.col("c_mktsegment")),
        "Product": F.concat(F.col("p_brand"), F.lit(" ")),
        "License": F.concat(F.col("l_returnflag"), F.col("l_linestatus")),
        "Sales": F.when((part_key + supplier_key) % 37 == 0, "n/a").otherwise(_text(sales)),
        "Quantity": F.when(part_key % 47 != 0, _text(F.col("l_quantity").cast("int"))),
        "Discount": F.when(part_key % 41 != 0, _text((4 * line_discount()).cast("decimal(5,4)"))),
        "Profit": _text(profit().cast(STAR_MONEY)),
    }
    source = joined(spark, folder, orders=True, customer=True, part=True, nation=True, region=True)
    return source.select(*[c.alias(name) for name, c in columns.items()])


def suspect_sales_from_star(spark: SparkSession, folder: str) -> DataFrame:
    """Clean-form rows of which some break each kind of quality rule.

    Line keys repeat, order ids grow too long, names are missing, segments are unknown or
    NULL, sales fall below zero or round to it, quantities reach zero, discounts pass one.
    """
    nation_key = F.col("c_nationkey")
    date = F.col("o_orderdate")
    sales = price() * (1 - line_discount()) - 2500
    nothing = F.lit(None).cast("string")
    columns = {
        "row_id": row_key(),
        "order_id": F.when(F.col("l_partkey") % 101 == 0, F.lpad(_text(F.col("l_orderkey")), 51, "0"))
        .otherwise(_text(F.col("l_orderkey"))),
        "order_date": date.cast("date"),
        "date_key": F.date_format(date, "yyyyMMdd").cast("int"),
        "contact_name": nothing,
        "country": nothing,
        "city": nothing,
        "region": nothing,
        "subregion": nothing,
        "customer_name": F.when(F.col("o_custkey") % 97 != 0, F.col("c_name")),
        "customer_id": _text(F.col("o_custkey")),
        "industry": nothing,
        "segment": F.when(nation_key == 7, "OTHER").when(nation_key != 8, F.col("c_mktsegment")),
        "product": F.concat(F.lit("Product "), _text(F.col("l_partkey"))),
        "license": nothing,
        "sales": F.when(F.col("l_suppkey") % 53 == 0, F.lit("-0.0040").cast(STAR_MONEY))
        .otherwise(sales.cast(STAR_MONEY)),
        "quantity": F.col("l_quantity").cast("int") - 1,
        "discount": (12 * line_discount()).cast("decimal(5,4)"),
        "profit": profit().cast(STAR_MONEY),
        "year": F.year(date),
        "month": F.month(date),
        "quarter": F.quarter(date),
        "year_month": month_key(date),
    }
    source = joined(spark, folder, orders=True, customer=True)
    return source.select(*[c.alias(name) for name, c in columns.items()])
