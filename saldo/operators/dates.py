"""The form of the dates in a text column, told from all its values.

One pass counts the shapes of the values: where the year stands, what separates the parts, and
how often the first and the second of day and month are beyond twelve. Counts of two tables
add up. A shape with days on one side only has that order. Without such a day the order is
ambiguous and the default stands; with days on both sides the more frequent order is taken, and
the others are reported as contrary.
"""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saldo.functions.barrier import once
from saldo.functions.cells import DATE_FORMATS, strip, without_time

_YEAR_LAST = r"^[0-9]{1,2}([/.-])[0-9]{1,2}\1([0-9]{4}|[0-9]{2})$"
_YEAR_FIRST = r"^[0-9]{4}([/.-])[0-9]{1,2}\1[0-9]{1,2}$"
_NAMED = r"^[0-9]{1,2}([ -])\p{Alpha}{3}\1[0-9]{4}$"
_COMPACT = "^[0-9]{8}$"
_COUNTS = ("rows", "first_over_12", "second_over_12")
_REPORT = ("shape string, separator string, year_digits int, rows bigint, first_over_12 bigint, second_over_12 bigint, "
           "format string, ambiguous boolean, contrary bigint")


@dataclass(frozen=True)
class Shape:
    """Values of one shape; `format` is None where they are no dates."""

    shape: str
    separator: str
    year_digits: int
    rows: int
    first_over_12: int
    second_over_12: int
    format: str | None = None
    ambiguous: bool = False
    contrary: int = 0


@dataclass(frozen=True)
class DateForms:
    shapes: tuple[Shape, ...]

    @property
    def formats(self) -> tuple[str, ...]:
        """Formats of the values, the most frequent first; the usual ones if no value is a date."""
        return tuple(dict.fromkeys(s.format for s in self.shapes if s.format)) or DATE_FORMATS

    @property
    def ambiguous(self) -> bool:
        return any(s.ambiguous for s in self.shapes)

    @property
    def contrary(self) -> int:
        """Values whose day and month stand the other way round than most of their shape."""
        return sum(s.contrary for s in self.shapes)

    def report(self, spark: SparkSession) -> DataFrame:
        fields = [field.split(" ") for field in _REPORT.split(", ")]
        rows = [F.struct(*[F.lit(vars(s)[name]).cast(kind).alias(name) for name, kind in fields]) for s in self.shapes]
        every = F.array(*rows).cast(f"array<struct<{', '.join(f'{name}: {kind}' for name, kind in fields)}>>")
        return spark.range(1).select(F.inline(every))


def shape_counts(df: DataFrame, column: str = "order_date") -> DataFrame:
    """(shape, separator, year_digits, rows, first_over_12, second_over_12) of the values, NULL left out.

    The shapes are few whatever the values are: all that is no date is one of them.
    """
    day = once(df.select(F.col(f"`{column}`").cast("string").alias("text")).filter("text IS NOT NULL"),
               {"day": strip(without_time(F.col("text")))})
    text = F.col("day")
    shape = (F.when(text.rlike(_YEAR_LAST), "year last").when(text.rlike(_YEAR_FIRST), "year first")
             .when(text.rlike(_NAMED), "month name").when(text.rlike(_COMPACT), "compact").otherwise("other"))
    shaped = once(day, {"shape": shape})
    between = F.regexp_extract(text, "([^0-9])", 1)
    parts = F.split(text, "[^0-9]")

    def over(first: int) -> Column:
        at = F.when(F.col("shape") == "year last", first).when(F.col("shape") == "year first", first + 1)
        return F.get(parts, at).try_cast("int") > 12

    dated = F.col("shape") != "other"
    last = F.length(F.get(parts, F.lit(2)))
    return shaped.select(
        "shape",
        F.when(dated, between).otherwise("").alias("separator"),
        F.when(F.col("shape") == "year last", last).when(dated, 4).otherwise(0).alias("year_digits"),
        over(0).alias("first"), over(1).alias("second"),
    ).groupBy("shape", "separator", "year_digits").agg(
        F.count("*").alias("rows"), F.count_if("first").alias("first_over_12"), F.count_if("second").alias("second_over_12"))


def merge(counts: Sequence[DataFrame]) -> DataFrame:
    """Counts of several tables as those of one."""
    every = counts[0]
    for one in counts[1:]:
        every = every.unionByName(one)
    return every.groupBy("shape", "separator", "year_digits").agg(*[F.sum(c).alias(c) for c in _COUNTS])


def _decide(s: Shape, month_first: bool) -> Shape:
    year, sep = "y" * s.year_digits, s.separator
    known = vars(s) | {"ambiguous": False, "contrary": 0}
    if s.shape == "compact":
        return Shape(**known | {"format": "yyyyMMdd"})
    if s.shape == "month name":
        return Shape(**known | {"format": f"d{sep}MMM{sep}{year}"})
    if s.shape == "other":
        return s
    # A part beyond twelve is a day: the second part of a month-first value, the first of the others.
    first, second = s.first_over_12, s.second_over_12
    usual = month_first or s.shape == "year first"  # year, day, month is nobody's habit
    months_lead = second > first or (second == first and usual)
    order = f"M{sep}d" if months_lead else f"d{sep}M"
    form = f"{order}{sep}{year}" if s.shape == "year last" else f"{year}{sep}{order}"
    return Shape(**known | {"format": form, "ambiguous": first == second and s.shape == "year last", "contrary": min(first, second)})


def choose(counts: DataFrame, month_first: bool = True) -> DateForms:
    """Forms from the counts, a few rows. `month_first` settles what the values leave open."""
    shapes = [_decide(Shape(**r.asDict()), month_first) for r in counts.collect()]
    return DateForms(tuple(sorted(shapes, key=lambda s: (-s.rows, s.shape, s.separator, s.year_digits))))


def infer(df: DataFrame, column: str = "order_date", month_first: bool = True) -> DateForms:
    return choose(shape_counts(df, column), month_first)
