"""Row rules of the sales table, checked on the values the table would hold.

A rule that evaluates to NULL passes, as a SQL check constraint does.
"""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from saldo.functions import cells
from saldo.functions.barrier import once
from saldo.operators.clean import MARKED, OVERFLOW, mark_of, marks
from saldo.schema import NOT_NULL, SEGMENTS, TABLE, TEXT_LENGTHS
from saldo.sources.scratch import settle

UNIQUE_RULE = "row_id_unique"

#: Rules in one generated method.
_TOGETHER = 8


class QualityError(ValueError):
    """Rows break the rules of the sales table."""


def to_table_types(clean: DataFrame) -> DataFrame:
    """Column types of the sales table: money is rounded to cents row by row.

    If the clean rows have OVERFLOW, numbers that the table does not hold are added to it.
    """
    types = {f.name: f.dataType for f in TABLE.fields}
    given = {f.name: f.dataType for f in clean.schema.fields}

    def stored(c: str) -> Column:
        decimals = isinstance(types[c], DecimalType) and isinstance(given.get(c), DecimalType)
        return cells.to_decimal(F.col(c), types[c]) if decimals and given[c] != types[c] else F.col(c).try_cast(types[c])

    typed = [stored(c).alias(c) for c in types]
    if OVERFLOW not in clean.columns:
        return clean.select(*typed)
    too_large = {c: F.coalesce(mark_of(c), F.when(
        F.col(c).isNotNull() & stored(c).isNull(), F.col(c).cast("string"))) for c in MARKED}
    return clean.select(*typed, marks(clean, too_large).alias(OVERFLOW))


def row_rules(segments: Sequence[str] = SEGMENTS, *, overflow: bool = False) -> dict[str, Column]:
    """Rule name -> what must hold in every row.

    With `overflow`, rows name the numbers that their columns do not hold: `<column>_fits` is
    broken by them, not the rule against NULL.
    """
    fits = {c: mark_of(c).isNull() for c in MARKED} if overflow else {}
    rules = {f"{c}_not_null": F.col(c).isNotNull() | ~fits[c] if c in fits else F.col(c).isNotNull() for c in NOT_NULL}
    rules |= {f"{c}_fits": rule for c, rule in fits.items()}
    rules |= {
        "segment_known": F.col("segment").isin(*segments),
        "sales_not_negative": F.col("sales") >= 0,
        "quantity_positive": F.col("quantity") > 0,
        "discount_0_to_1": F.col("discount").between(0, 1),
        "month_1_to_12": F.col("month").between(1, 12),
        "quarter_1_to_4": F.col("quarter").between(1, 4),
    }
    rules |= {f"{c}_length": F.length(c) <= n for c, n in TEXT_LENGTHS.items()}
    return rules


def _broken(rule: Column) -> Column:
    return ~F.coalesce(rule, F.lit(True))


def _repeated_keys(typed: DataFrame) -> DataFrame:
    """row_id values that occur more than once, with their row counts."""
    return (
        typed.filter(F.col("row_id").isNotNull())
        .groupBy("row_id")
        .agg(F.count("*").alias("copies"))
        .filter(F.col("copies") > 1)
    )


def _checked(typed: DataFrame, segments: Sequence[str], columns: Sequence[str] | None) -> tuple[DataFrame, DataFrame]:
    """Rows with `violations` of the row rules, of `columns` and row_id if given; and the repeated ids.

    Both are settled: what is behind the rows is computed once, the rules too, and columns that
    only the rules read go no further. The repeated ids take a job of their own over one column.
    Their size is then known when the join is planned: few of them, as in ordinary data, are
    broadcast and the rows stay where they are; many are joined by shuffle, with hot ids split.
    """
    # Compiled, as array_compact is not, and a few rules at a time, as the methods of many are too long for it.
    rules = [F.when(_broken(rule), name).otherwise("") for name, rule in row_rules(
        segments, overflow=OVERFLOW in typed.columns).items()]
    parts = {f"_broken_{i}": F.array_remove(F.array(*rules[i:i + _TOGETHER]), "") for i in range(0, len(rules), _TOGETHER)}
    kept = dict.fromkeys([*(columns or typed.columns), "row_id"])
    checked = reduce(lambda df, part: once(df, {part: parts[part]}), parts, typed)
    rows = settle(checked.select(*[F.col(f"`{c}`") for c in kept], F.concat(*parts).alias("violations")), "checked-rows")
    return rows, settle(_repeated_keys(rows), "repeated-ids")


def flag(typed: DataFrame, segments: Sequence[str] = SEGMENTS, columns: Sequence[str] | None = None) -> DataFrame:
    """Adds `violations`, the names of the broken rules, to the rows or to `columns` of them.

    Every copy of a repeated id is flagged.
    """
    rows, repeated = _checked(typed, segments, columns)
    names = F.col("violations")
    every = F.when(F.col("copies").isNull(), names).otherwise(F.array_append(names, UNIQUE_RULE))
    return rows.join(repeated, "row_id", "left").select(
        *[F.col(f"`{c}`") for c in columns or typed.columns], every.alias("violations"))


def valid_rows(typed: DataFrame, segments: Sequence[str] = SEGMENTS, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows, or `columns` of them, that break no rule; only those without broken row rules are joined."""
    rows, repeated = _checked(typed, segments, columns)
    fine = rows.filter(F.size("violations") == 0)
    return fine.join(repeated, "row_id", "left_anti").select(*[F.col(f"`{c}`") for c in columns or typed.columns])


def rejected_rows(typed: DataFrame, segments: Sequence[str] = SEGMENTS, columns: Sequence[str] | None = None) -> DataFrame:
    return flag(typed, segments, columns).filter(F.size("violations") > 0)


def split_rows(typed: DataFrame, segments: Sequence[str] = SEGMENTS) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and rejected rows with their violations, from one pass over the source."""
    flagged = settle(flag(typed, segments), "flagged")
    fine = F.size("violations") == 0
    return flagged.filter(fine).drop("violations"), flagged.filter(~fine)


def rule_counts(typed: DataFrame, segments: Sequence[str] = SEGMENTS, *, stored: bool = False) -> DataFrame:
    """(regra, linhas): rows that break each rule, zero included. `stored` rows are not settled again."""
    if not stored:
        typed = settle(typed, "typed-rows")
    rules = row_rules(segments, overflow=OVERFLOW in typed.columns)
    counts = typed.agg(*[F.count_if(_broken(rule)).alias(name) for name, rule in rules.items()])
    per_row = counts.unpivot([], list(rules), "regra", "linhas")
    per_key = _repeated_keys(typed).agg(
        F.lit(UNIQUE_RULE).alias("regra"),
        F.coalesce(F.sum("copies"), F.lit(0)).alias("linhas"),
    )
    return per_row.unionByName(per_key)


def require_fits(typed: DataFrame) -> None:
    """Raises if a number is beyond its column; one pass over the marks, one row back."""
    if OVERFLOW not in typed.columns:
        return
    seen = typed.agg(*[F.count(mark_of(c)).alias(c) for c in MARKED]).first().asDict()
    broken = ", ".join(f"{c}_fits: {n}" for c, n in seen.items() if n)
    if broken:
        raise QualityError(f"numbers are beyond their columns ({broken})")


def require_valid(typed: DataFrame, segments: Sequence[str] = SEGMENTS) -> None:
    """Raises if any row of a stored frame breaks a rule. Reads back one row per broken rule."""
    broken = rule_counts(typed, segments, stored=True).filter(F.col("linhas") > 0).collect()
    if broken:
        detail = ", ".join(f"{r.regra}: {r.linhas}" for r in broken)
        raise QualityError(f"rows break the rules of the sales table ({detail})")
