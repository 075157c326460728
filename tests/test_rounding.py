"""Rounding by exact value, one rounding of numbers, ids in decimal form, errors of reports."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from saldo.functions.ratios import exact_round
from saldo.operators import clean as cleaning
from saldo.operators import quality
from saldo.plans import reports
from saldo.sources import warehouse
from saldo.sources.scratch import folders_in
from tests.test_clean import raw


@pytest.mark.parametrize("customers", [32, 4_000, 8_000, 20_000])
def test_exact_round_is_the_builtin(spark, customers):
    lost = spark.range(0, customers + 1)
    rate = (F.col("id") / customers).alias("rate")
    rows = lost.select(rate).select("rate", exact_round(F.col("rate") * 100).alias("pct"),
                                    exact_round(F.col("rate") * 100, 1).alias("tenth")).collect()
    assert [(r.pct, r.tenth) for r in rows] == [(round(r.rate * 100, 2), round(r.rate * 100, 1)) for r in rows]


def test_numbers_are_rounded_once(spark):
    clean = cleaning.clean(raw(spark, {"Sales": "1.00496", "Quantity": "2.49996", "Discount": "10"}))
    assert clean.first().discount == Decimal(10)
    row = quality.to_table_types(clean).first()
    assert (row.sales, row.quantity, row.discount) == (Decimal("1.00"), 2, None)


@pytest.mark.parametrize("sales", ["1" + "0" * 14, "1" + "0" * 30])
def test_a_number_too_large_aborts_the_load_and_is_not_removed(spark, sales, tmp_path):
    rows = raw(spark, {"Sales": sales})
    assert cleaning.clean_counts(rows).first().restantes == 1
    with pytest.raises(quality.QualityError, match="sales_not_null"):
        warehouse.load_table(cleaning.clean(rows), "too_large", str(tmp_path))
    assert folders_in(spark, str(tmp_path)) == []


def test_former_versions_go(spark, tmp_path):
    clean = cleaning.clean(raw(spark, {}))
    for _ in range(4):
        assert warehouse.load_table(clean, "versions", str(tmp_path)).count() == 1
    assert len(folders_in(spark, str(tmp_path))) == 2


def test_ids_in_decimal_form(spark):
    clean = cleaning.clean(raw(spark, {"Row ID": "5.0"}, {"Row ID": "5"}, {"Row ID": "5.5"}))
    assert sorted(str(r.row_id) for r in clean.collect()) == ["5", "None"]


def test_an_error_without_text_does_not_stop_the_batch(spark, tmp_path):
    def broken(sales):
        raise RuntimeError

    status = reports.run_reports(spark.range(1), str(tmp_path), {"a": broken, "b": lambda s: s}).collect()
    assert [(r.relatorio, r.ok, r.erro) for r in status] == [("a", False, "RuntimeError"), ("b", True, None)]
