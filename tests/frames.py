"""Hand-made sales rows."""

from decimal import Decimal

from pyspark.sql import Row

from saldo.schema import CLEAN_MONEY

SCHEMA = (
    "order_id string, customer_id string, customer_name string, segment string, product string, "
    "year_month string, year int, month int, quarter int, "
    "sales decimal(28,10), profit decimal(28,10), discount decimal(28,10)"
)


def sale(month="2020-01", customer="c1", order="o1", sales=0, profit=0, discount=0, segment="SMB",
         product="p1", name=None):
    year, number = (int(x) for x in month.split("-"))
    return Row(
        order_id=order, customer_id=customer, customer_name=name or customer, segment=segment,
        product=product, year_month=month, year=year, month=number, quarter=(number + 2) // 3,
        sales=Decimal(str(sales)), profit=Decimal(str(profit)), discount=Decimal(str(discount)),
    )


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def in_cents(df):
    """Table form: money rounded to cents row by row."""
    money = "decimal(12,2)"
    return df.withColumns({c: df[c].cast(money) for c in ("sales", "profit")})


def group(total, profit, customers, orders=None, **kind):
    """Sales rows with the given totals, customer count and order count."""
    rows = max(customers, orders or 0)
    return [
        sale(
            customer=f"c{i % customers}", order=f"o{i % (orders or rows)}",
            sales=total if i == 0 else 0, profit=profit if i == 0 else 0, **kind,
        )
        for i in range(rows)
    ]


def rows(df):
    """Rows with numbers as floats, for comparison with printed results."""
    plain = lambda v: float(v) if isinstance(v, Decimal) else v
    return [tuple(plain(v) for v in row) for row in df.collect()]


assert CLEAN_MONEY.simpleString() in SCHEMA
