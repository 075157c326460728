"""Small helpers of the operators in this folder."""

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

import saldo

#: Rows of narrow keys (some 16 bytes each) that a join may broadcast. Beyond, it shuffles.
BROADCAST_ROWS = 2_000_000


def bounded(keys: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """`keys`, to be broadcast if they are counted and few enough, else left to a shuffle.

    Give a settled table: the count reads its footers only.
    """
    return F.broadcast(keys) if keys.count() <= rows else keys


def fresh(df: DataFrame, name: str) -> str:
    """`name`, or the first like it that no column of `df` has in any letter case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """`docs` less the rows whose id is in `ids`; rows without id stay."""
    name = fresh(docs, "_gone")
    gone = bounded(ids.select(F.col(ids.columns[0]).alias(name)))
    return docs.join(gone, F.col(f"`{id_col}`") == F.col(name), "left_anti")


def whole(text: str) -> Column:
    """The text column, null as empty."""
    return F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def importable(df: DataFrame) -> DataFrame:
    """`df`, once Python workers look for this package where the driver has it.

    For local sessions started elsewhere; on a cluster the package is installed on every node.
    """
    root = str(Path(saldo.__file__).parents[1])
    env = df.sparkSession.sparkContext.environment
    known = env.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))
    return df
