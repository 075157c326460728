"""A sum over rows that tells whether two tables hold the same rows, in whatever order."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NULL = "\\N"
_BETWEEN = "\x1f"


def row_text(schema: T.StructType, digits: int = 4) -> Column:
    """The values of a row by name of column; numbers with `digits` decimals, so that 1 is 1.0."""
    number = f"decimal(38,{digits})"

    def text(field: T.StructField) -> Column:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.NumericType):
            value = value.try_cast(number)
        return F.coalesce(value.cast("string"), F.lit(_NULL))

    return F.concat_ws(_BETWEEN, *[text(f) for f in sorted(schema.fields, key=lambda f: f.name)])


def fingerprint(df: DataFrame, digits: int = 4) -> Column:
    """Aggregate over `df`: sum of 60 bits of a digest of each row, as text; `0` without rows.

    Sums add up, so parts of a table may be summed in any order and a repeated row counts as
    often as it stands there. Infinite numbers count as NULL.
    """
    bits = F.conv(F.substring(F.md5(row_text(df.schema, digits)), 1, 15), 16, 10).cast("decimal(20,0)")
    return F.coalesce(F.sum(bits).cast("string"), F.lit("0"))
