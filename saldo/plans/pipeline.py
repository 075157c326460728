"""Raw CSV to clean CSV, sales table, monthly view and reports."""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saldo.operators import clean as cleaning
from saldo.operators import quality, retention, revenue
from saldo.operators.dates import DateForms, infer
from saldo.plans.reports import Report, run_reports
from saldo.schema import SEGMENTS
from saldo.sources import csv, scratch, warehouse

# Frame-regime reports over the clean rows.
FRAME_REPORTS: dict[str, Report] = {
    "mrr_mensal": revenue.mrr_monthly,
    "churn_mensal": retention.churn_monthly,
    "por_segmento": revenue.segment_kpis,
    "por_produto": revenue.product_kpis,
}


@dataclass(frozen=True)
class Load:
    """What a load leaves behind."""

    counts: DataFrame
    sales: DataFrame
    view: DataFrame
    summary: DataFrame
    dates: DateForms | None = None


def load(spark: SparkSession, raw_csv: str, clean_csv: str, *, table: str = warehouse.SALES_TABLE,
         segments: Sequence[str] = SEGMENTS, formats: Sequence[str] | None = None) -> Load:
    """Read, clean, write the clean CSV, refresh the table and its view.

    The raw text is parsed once: it is settled in the shared folder, from where the counts
    and the cleaning read the columns they need. The clean rows are settled too, as both
    sinks read them. Without `formats` the form of the dates is told from all of them; `dates`
    of the result says which, and whether the order of day and month was left open. Numbers too
    large for their columns stand in the clean CSV as given, and the table refuses them.
    """
    raw = scratch.settle(csv.read_raw_csv(spark, raw_csv), "raw")
    forms = None
    if formats is None:
        forms = infer(raw, "Order Date")
        formats = forms.formats
    counts = scratch.settle(cleaning.clean_counts(raw, formats), "counts")
    seen = counts.first()
    if seen.linhas_originais and seen.datas_invalidas == seen.linhas_originais:
        raise ValueError(f"no row of {raw_csv} has a date in one of {list(formats)}")
    clean = scratch.settle(cleaning.clean(raw, formats, overflow=True), "clean")
    csv.write_csv(csv.with_texts(clean), clean_csv)
    sales = warehouse.load_table(clean, table, segments=segments)
    return Load(
        counts=counts,
        sales=sales,
        view=warehouse.create_monthly_view(sales),
        summary=revenue.load_summary(clean),
        dates=forms,
    )


def analyse(spark: SparkSession, clean_csv: str, out: str, *, leave_out_overflow: bool = False) -> tuple[DataFrame, DataFrame]:
    """Frame-regime reports over the clean CSV; returns their status and the lifetime value.

    Rows with a number beyond its column have no exact sum: they are an error, unless they are
    to be left out.
    """
    clean = scratch.settle(csv.read_clean_csv(spark, clean_csv, overflow=True), "analysis")
    if leave_out_overflow:
        clean = clean.filter(F.col(cleaning.OVERFLOW).isNull())
    else:
        quality.require_fits(clean)
    clean = clean.drop(cleaning.OVERFLOW)
    return run_reports(clean, out, FRAME_REPORTS), retention.ltv_from_sales(clean)
