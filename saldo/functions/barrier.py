"""Columns that are computed once a row."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """`df` with these columns added or replaced, computed once whoever reads them later.

    The optimiser moves a filter below a projection and computes what it reads there once more.
    It does not move one below a generator, here one that makes one row of each.
    """
    added = [c for c in columns if c not in df.columns]
    made = F.inline(F.array(F.struct(*[value.alias(name) for name, value in columns.items()])))
    kept = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    return df.select(*kept, made).select(*[F.col(f"`{c}`") for c in [*df.columns, *added]])
