"""Expressions that clean one value: missing texts, numbers, dates, white space."""

import re
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from saldo.schema import NA_TOKENS

# Python's own notion of white space, which reaches beyond blanks: str.strip removes it.
WHITE_SPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())

DATE_FORMATS = ("M/d/yyyy", "yyyy-MM-dd", "yyyy/MM/dd")

#: Numbers as read: their rounding to what a table holds comes later, once.
NUMBER = "decimal(28,10)"

_TIME_OF_DAY = r"[ T][0-9]{1,2}:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?(Z|[+-][0-9:]+)?$"


def missing_to_null(text: Column) -> Column:
    return F.when(~text.isin(*NA_TOKENS), text)


def to_number(text: Column) -> Column:
    """Number in a text; NULL where there is none, and where it is beyond NUMBER (see `beyond`)."""
    return text.try_cast(NUMBER)


def beyond(text: Column, value: Column) -> Column:
    """The text where it is a number that `value`, its typed form, does not hold; NULL elsewhere."""
    none = F.isnan(F.coalesce(text.try_cast("double"), F.lit(float("nan"))))
    return F.when(value.isNull() & ~none, strip(text))


def to_whole(text: Column) -> Column:
    """Whole number in a text, also in decimal form (`5.0`); NULL otherwise."""
    number = text.try_cast("decimal(38,10)")
    return F.when(number == F.floor(number), number.try_cast("bigint"))


def to_int(whole: Column) -> Column:
    """A whole number as int, NULL beyond it. A failed cast is slow, so only numbers in range are cast."""
    return F.when(whole.between(-2**31, 2**31 - 1), whole.try_cast("int"))


def to_decimal(number: Column, kind: DecimalType) -> Column:
    """A decimal rounded to `kind`, NULL beyond it. Only numbers in range are cast here too."""
    most = Decimal(10) ** (kind.precision - kind.scale) - Decimal(5).scaleb(-kind.scale - 1)
    return F.when(F.abs(number) < F.lit(most), number.try_cast(kind))


def _shape(form: str) -> str:
    """Pattern of the texts that a date format can fit."""
    def digits(letters: re.Match) -> str:
        n = len(letters[0])
        return "[0-9]{1,2}" if n == 1 else f"[0-9]{{{n}}}"
    return "^" + re.sub("[A-Za-z]+", digits, re.sub(r"([^A-Za-z])", r"\\\1", form)) + "$"


def _parse(text: Column, form: str) -> Column:
    # A failed parse is slow, so only texts of the right shape are parsed.
    parsed = F.try_to_date(text, form)
    return F.when(text.rlike(_shape(form)), parsed) if form.isascii() and "MMM" not in form else parsed


def without_time(text: Column) -> Column:
    return F.regexp_replace(text, _TIME_OF_DAY, "")


def day_of(text: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Date in a text without a time of day, by the first format that fits; NULL where none does."""
    return F.coalesce(*[_parse(text, f) for f in formats])


def to_date(text: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Date by the first format that fits, NULL where none does; a time of day is left out."""
    return day_of(without_time(text), formats)


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITE_SPACE))


def month_key(date: Column) -> Column:
    """'yyyy-MM', whose text order is the order of time."""
    return F.date_format(date, "yyyy-MM")


def discount_band(discount: Column) -> Column:
    # Names and upper bounds of the bands.
    return (
        F.when(discount == 0, "0%  — sem desconto")
        .when(discount <= F.lit("0.10").cast("decimal(5,4)"), "1% a 10%")
        .when(discount <= F.lit("0.20").cast("decimal(5,4)"), "11% a 20%")
        .when(discount <= F.lit("0.30").cast("decimal(5,4)"), "21% a 30%")
        .otherwise("Acima de 30%")
    )
