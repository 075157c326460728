"""Column names, types and fixed values of the sales data."""

from pyspark.sql import types as T

# Header of the raw CSV -> column name.
HEADERS = {
    "Row ID": "row_id",
    "Order ID": "order_id",
    "Order Date": "order_date",
    "Date Key": "date_key",
    "Contact Name": "contact_name",
    "Country": "country",
    "City": "city",
    "Region": "region",
    "Subregion": "subregion",
    "Customer": "customer_name",
    "Customer ID": "customer_id",
    "Industry": "industry",
    "Segment": "segment",
    "Product": "product",
    "License": "license",
    "Sales": "sales",
    "Quantity": "quantity",
    "Discount": "discount",
    "Profit": "profit",
}

# Texts a CSV reader of the pandas family takes as missing.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Segments the sales table accepts.
SEGMENTS = ("SMB", "Strategic", "Enterprise", "Government")

# Longest text per column of the sales table.
TEXT_LENGTHS = {
    "order_id": 50,
    "customer_id": 50,
    "customer_name": 150,
    "contact_name": 150,
    "country": 100,
    "city": 100,
    "region": 100,
    "subregion": 100,
    "industry": 100,
    "segment": 50,
    "product": 150,
    "license": 100,
    "year_month": 7,
}

# Columns that must be filled after coercion, are stripped, may not be null in the table.
REQUIRED_AFTER_COERCION = ("sales", "customer_id", "order_date", "quantity", "profit")
STRIPPED = ("customer_name", "segment", "product", "region")
NOT_NULL = (
    "row_id", "order_id", "customer_id", "customer_name", "order_date", "product",
    "sales", "quantity", "discount", "profit", "year", "month", "quarter", "year_month",
)

#: As in the texts; the table rounds to cents, once.
CLEAN_MONEY = T.DecimalType(28, 10)
STAR_MONEY = T.DecimalType(18, 4)  # exact for what the star holds
TABLE_MONEY = T.DecimalType(12, 2)
DISCOUNT = T.DecimalType(5, 4)


def _sales_schema(money: T.DecimalType, discount: T.DecimalType) -> T.StructType:
    special = {
        # Wider than the 32-bit key of a small database: 100 TB hold more than 2^31 rows.
        "row_id": T.LongType(),
        "order_date": T.DateType(),
        "date_key": T.IntegerType(),
        "sales": money,
        "quantity": T.IntegerType(),
        "discount": discount,
        "profit": money,
    }
    fields = [T.StructField(c, special.get(c, T.StringType())) for c in HEADERS.values()]
    fields += [T.StructField(c, T.IntegerType()) for c in ("year", "month", "quarter")]
    fields.append(T.StructField("year_month", T.StringType()))
    return T.StructType(fields)


RAW = T.StructType([T.StructField(h, T.StringType()) for h in HEADERS])
CLEAN = _sales_schema(CLEAN_MONEY, CLEAN_MONEY)
TABLE = _sales_schema(TABLE_MONEY, DISCOUNT)
