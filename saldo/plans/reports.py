"""The named reports over the sales table, one by one or as a batch."""

from collections.abc import Callable, Collection, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from saldo.functions.fingerprint import fingerprint
from saldo.operators import revenue
from saldo.sources.csv import read_report, write_csv

Report = Callable[[DataFrame], DataFrame]

# Report file -> report over the sales table.
SQL_REPORTS: dict[str, Report] = {
    "sql_mrr_mensal": lambda sales: revenue.mrr_growth(revenue.monthly_revenue(sales)),
    "sql_segmentos": revenue.sql_segments,
    "sql_top_produtos": revenue.sql_top_products,
    "sql_top_clientes": revenue.sql_top_customers,
    "sql_trimestral": revenue.sql_quarters,
    "sql_descontos": revenue.sql_discount_bands,
}

# Bounded by months, quarters, segments, bands or the ten rows of a top list; products are not.
SMALL_REPORTS = frozenset(SQL_REPORTS) | {"mrr_mensal", "churn_mensal", "por_segmento"}

_STATUS = "relatorio string, ok boolean, linhas bigint, impressao string, erro string"


class ReportError(ValueError):
    """The files of a report do not hold the rows that were written."""


def run_sql(spark: SparkSession, text: str) -> DataFrame:
    return spark.sql(text)


def plain_numbers(df: DataFrame) -> DataFrame:
    """Decimals as doubles, the form in which reports are read elsewhere."""
    decimals = [name for name, kind in df.dtypes if kind.startswith("decimal")]
    return df.withColumns({c: F.col(c).cast("double") for c in decimals}) if decimals else df


def _content(df: DataFrame) -> tuple[Column, Column]:
    return F.count(F.lit(1)).alias("rows"), fingerprint(df).alias("print")


def _run(report: Report, sales: DataFrame, path: str, one_file: bool) -> tuple:
    """Writes one report and reads its files back; gives (ok, row count, fingerprint, error)."""
    seen = Observation()
    try:
        result = plain_numbers(report(sales))
        write_csv(result.observe(seen, *_content(result)), path, one_file=one_file)
        written = seen.get
        stored = read_report(sales.sparkSession, path, result.schema)
        found = stored.agg(*_content(stored)).first()
        if written and (written["rows"], written["print"]) != tuple(found):
            raise ReportError(f"{written['rows']} rows were written, {found['rows']} are read, or other values")
        return True, found["rows"], found["print"], None
    except Exception as error:  # noqa: BLE001 - noted in the status, and the batch goes on
        return False, None, None, ": ".join([type(error).__name__, *str(error).splitlines()[:1]])


def run_reports(sales: DataFrame, folder: str, reports: Mapping[str, Report] = SQL_REPORTS,
                small: Collection[str] = SMALL_REPORTS) -> DataFrame:
    """Writes each report to its own CSV folder; one that fails does not stop the others.

    Reports named in `small` have few rows and become one file, others as many as tasks.

    The reports are submitted together, so that the cluster has work while one of them waits
    for its last tasks. Each is read back: `linhas` and `impressao`, the fingerprint of its rows,
    are those of the files, and a report whose files hold other rows than were written is not ok.
    Returns (relatorio, ok, linhas, impressao, erro), one row per report.
    """
    with ThreadPoolExecutor(max_workers=max(len(reports), 1)) as pool:
        runs = [pool.submit(_run, report, sales, f"{folder}/{name}", name in small) for name, report in reports.items()]
        status = [(name, *run.result()) for name, run in zip(reports, runs)]
    return sales.sparkSession.createDataFrame(status, _STATUS)


def failed(status: DataFrame) -> DataFrame:
    return status.filter(~F.col("ok")).select("relatorio", "erro")
