"""The sales table: full refresh that either replaces everything or nothing."""

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from saldo.operators import quality
from saldo.operators.clean import OVERFLOW
from saldo.operators.revenue import monthly_revenue
from saldo.schema import SEGMENTS
from saldo.sources import versions
from saldo.sources.scratch import remove

SALES_TABLE = "vendas"
MONTHLY_VIEW = "vw_receita_mensal"


def _root(spark: SparkSession, name: str, folder: str | None) -> str:
    return folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{name}-versions"


def load_table(clean: DataFrame, name: str = SALES_TABLE, folder: str | None = None,
               segments: Sequence[str] = SEGMENTS, former: int = 1, hours: float = 168) -> DataFrame:
    """Writes a new version of the sales table, checks it, then points the table to it.

    The rows are computed once, by the write; the rules read the written columns. A broken
    rule or a failed write leaves the table on its old version and removes the new one. Clean rows
    that name numbers beyond their columns are refused before anything is written. If another
    load has committed meanwhile, this one raises `versions.ConflictError` and leaves nothing.
    Versions lie in `folder`, by default beside the tables of the warehouse, and in nothing
    else but a folder of their own; `former` of them stay for queries that still read them, and
    those in use by `reading`. What ended processes left is removed after `hours`.
    """
    spark = clean.sparkSession
    root = _root(spark, name, folder)
    started, _ = versions.latest(spark, root)
    version = versions.new_version()
    path = f"{root}/{version}"
    typed = quality.to_table_types(clean)
    quality.require_fits(typed)
    try:
        typed.drop(OVERFLOW).write.parquet(path)
        quality.require_valid(spark.read.parquet(path), segments)
        versions.commit(spark, root, started + 1, version)
    except Exception:
        remove(spark, path)
        raise
    # Committed: from here on the version stays, whatever happens to the pointer.
    pointed = None
    while (last := versions.latest(spark, root)[1]) != pointed:
        point_table(spark, name, f"{root}/{last}")
        pointed = last
    versions.retire(spark, root, former, hours)
    return spark.table(name)


def point_table(spark: SparkSession, name: str, version: str) -> None:
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION '{version}'")
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{version}'")
    spark.catalog.refreshTable(name)


@contextmanager
def reading(spark: SparkSession, name: str = SALES_TABLE, folder: str | None = None) -> Iterator[DataFrame]:
    """The table as it was committed last; loads leave that version in place while the block runs."""
    with versions.pinned(spark, _root(spark, name, folder)) as path:
        yield spark.read.parquet(path)


def create_monthly_view(sales: DataFrame, name: str = MONTHLY_VIEW) -> DataFrame:
    view = monthly_revenue(sales)
    view.createOrReplaceTempView(name)
    return view.sparkSession.table(name)
