from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from saldo.functions import cells
from saldo.operators import quality
from saldo.schema import CLEAN, TABLE_MONEY

GOOD = {
    "row_id": 1, "order_id": "o", "order_date": date(2020, 11, 9), "date_key": 20201109,
    "contact_name": None, "country": "co", "city": "ci", "region": "re", "subregion": "su",
    "customer_name": "cu", "customer_id": "1001", "industry": "in", "segment": "SMB",
    "product": "pr", "license": None, "sales": Decimal("261.9650"), "quantity": 2,
    "discount": Decimal("0.2"), "profit": Decimal("1.0050"), "year": 2020, "month": 11,
    "quarter": 4, "year_month": "2020-11",
}


def typed(spark, *changes):
    rows = [{**GOOD, "row_id": i + 1, **c} for i, c in enumerate(changes)]
    clean = spark.createDataFrame([tuple(r[c] for c in CLEAN.names) for r in rows], CLEAN)
    return quality.to_table_types(clean)


def test_money_is_rounded_half_away_from_zero(spark):
    row = typed(spark, {"profit": Decimal("-1.0050")}).collect()[0]
    assert (row.sales, row.profit) == (Decimal("261.97"), Decimal("-1.01"))


@pytest.mark.parametrize("change, broken", [
    ({}, []),
    ({"segment": None}, []),
    ({"sales": Decimal("-0.0010")}, []),
    ({"sales": Decimal("0")}, []),
    ({"discount": Decimal("1")}, []),
    ({"order_id": "x" * 50}, []),
    ({"sales": Decimal("-0.0100")}, ["sales_not_negative"]),
    ({"sales": Decimal("99999999999.0000")}, ["sales_not_null"]),
    ({"quantity": 0}, ["quantity_positive"]),
    ({"quantity": None}, ["quantity_not_null"]),
    ({"discount": Decimal("1.01")}, ["discount_0_to_1"]),
    ({"discount": Decimal("-0.01")}, ["discount_0_to_1"]),
    ({"discount": None}, ["discount_not_null"]),
    ({"segment": "Other"}, ["segment_known"]),
    ({"customer_name": None}, ["customer_name_not_null"]),
    ({"product": None}, ["product_not_null"]),
    ({"order_id": "x" * 51}, ["order_id_length"]),
    ({"customer_name": "x" * 151}, ["customer_name_length"]),
    ({"month": 13, "quarter": 5}, ["month_1_to_12", "quarter_1_to_4"]),
    ({"row_id": None}, ["row_id_not_null"]),
])
def test_rules(spark, change, broken):
    df = typed(spark, change)
    assert quality.flag(df).collect()[0].violations == broken
    assert quality.valid_rows(df).count() == int(not broken)
    assert quality.rejected_rows(df).count() == int(bool(broken))
    counts = {r.regra: r.linhas for r in quality.rule_counts(df).collect() if r.linhas}
    assert counts == {name: 1 for name in broken}


def test_every_copy_of_a_repeated_id_is_flagged(spark):
    df = typed(spark, {"row_id": 7}, {"row_id": 7}, {"row_id": 8}, {"row_id": None}, {"row_id": None})
    flagged = {(r.row_id, tuple(r.violations)) for r in quality.flag(df).collect()}
    assert flagged == {(7, ("row_id_unique",)), (8, ()), (None, ("row_id_not_null",))}
    assert {r.regra: r.linhas for r in quality.rule_counts(df).collect() if r.linhas} == {
        "row_id_unique": 2, "row_id_not_null": 2,
    }


def test_strict_check(spark):
    quality.require_valid(typed(spark, {}, {"segment": None}))
    with pytest.raises(quality.QualityError, match="quantity_positive: 2"):
        quality.require_valid(typed(spark, {"quantity": 0}, {"quantity": -1}, {}))


def test_segments_are_a_parameter(spark):
    df = typed(spark, {"segment": "MACHINERY"})
    assert quality.valid_rows(df, ["MACHINERY"]).count() == 1
    assert quality.valid_rows(df).count() == 0


def test_only_asked_columns_go_through_the_check(spark, monkeypatch):
    rows = typed(spark, {}, {"quantity": 0}, {"row_id": 1, "segment": "no"}, {"row_id": 9, "product": None}, {"row_id": 7})
    settled = {}
    monkeypatch.setattr(quality, "settle", lambda df, name: settled.setdefault(name, df))
    rejects = quality.rejected_rows(rows, columns=("row_id", "sales"))
    assert settled["checked-rows"].columns == ["row_id", "sales", "violations"]
    assert sorted((r.row_id, ",".join(r.violations)) for r in rejects.collect()) == [
        (1, "row_id_unique"), (1, "segment_known,row_id_unique"), (2, "quantity_positive"), (9, "product_not_null")]
    settled.clear()
    assert [tuple(r) for r in quality.valid_rows(rows, columns=("sales", "order_id")).collect()] == [(Decimal("261.97"), "o")]
    text = settled["checked-rows"]._jdf.queryExecution().optimizedPlan().toString()
    assert "array_remove" in text and "filter(" not in text


@pytest.mark.parametrize("text", ["9999999999.9949", "9999999999.995", "-9999999999.995", "-9999999999.9949", "0.005", None])
def test_decimals_in_range_are_cast_and_others_null(spark, text):
    df = spark.sql(f"SELECT CAST({'NULL' if text is None else text} AS DECIMAL(28,10)) AS x")
    new, old = df.select(cells.to_decimal(F.col("x"), TABLE_MONEY), F.col("x").try_cast(TABLE_MONEY)).first()
    assert new == old


@pytest.mark.parametrize("n", [2**31 - 1, 2**31, -2**31, -2**31 - 1])
def test_whole_numbers_in_range_are_cast_and_others_null(spark, n):
    assert spark.range(1).select(cells.to_int(F.lit(n).cast("bigint"))).first()[0] == (n if -2**31 <= n < 2**31 else None)
