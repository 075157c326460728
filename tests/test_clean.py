import random
from datetime import date, datetime
from decimal import ROUND_HALF_UP, Decimal, InvalidOperation

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saldo.functions import cells
from saldo.operators import clean as cleaning
from saldo.schema import CLEAN, HEADERS, RAW

FULL = {
    "Row ID": "1", "Order ID": "o", "Order Date": "11/9/2020", "Date Key": "20201109",
    "Contact Name": "n", "Country": "co", "City": "ci", "Region": "re", "Subregion": "su",
    "Customer": "cu", "Customer ID": "1001", "Industry": "in", "Segment": "SMB", "Product": "pr",
    "License": "li", "Sales": "261.96", "Quantity": "2", "Discount": "0.2", "Profit": "41.9136",
}
ORDERED = T.StructType([*RAW.fields, T.StructField("_source_row", T.LongType())])


def raw(spark, *changes):
    """Raw rows in file order, each the full row with some values changed."""
    rows = [{**FULL, **c} for c in changes]
    return spark.createDataFrame(
        [(*(r[h] for h in HEADERS), i) for i, r in enumerate(rows)], ORDERED
    )


def test_clean_row(spark):
    df = cleaning.clean(raw(spark, {"Customer": " \t cu x \x1f", "Region": " re\n"}))
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in CLEAN]
    row = df.collect()[0].asDict()
    assert row["customer_name"] == "cu x" and row["region"] == "re"
    assert row["order_date"] == date(2020, 11, 9) and row["date_key"] == 20201109
    assert (row["year"], row["month"], row["quarter"], row["year_month"]) == (2020, 11, 4, "2020-11")
    assert (row["sales"], row["profit"]) == (Decimal("261.9600"), Decimal("41.9136"))
    assert (row["quantity"], row["discount"]) == (2, Decimal("0.2000"))


@pytest.mark.parametrize("text, number", [
    ("abc", None), ("1,234.5", None), ("", None), (" 12.345 ", "12.345"), ("-3", "-3"),
    ("1e2", "100"), (None, None), ("12.34567", "12.34567"), ("1" * 18, "1" * 18), ("1" * 30, None),
])
def test_to_number(spark, text, number):
    df = spark.createDataFrame([(text,)], "t string")
    expected = Decimal(number) if number else None
    assert df.select(cells.to_number(F.col("t"))).collect()[0][0] == expected


@pytest.mark.parametrize("text, day", [
    ("1/2/2020", date(2020, 1, 2)), ("12/31/2020", date(2020, 12, 31)), ("31/31/2020", None),
    ("2020-03-04", date(2020, 3, 4)), ("2020/03/04", date(2020, 3, 4)),
    ("2020-01-05 00:00:00", date(2020, 1, 5)), ("2020-01-05T07:08:09.5Z", date(2020, 1, 5)), ("bad", None), (None, None), ("2/30/2020", None),
])
def test_to_date(spark, text, day):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(cells.to_date(F.col("t"))).collect()[0][0] == day


def test_date_format_is_a_parameter(spark):
    df = cleaning.clean(raw(spark, {"Order Date": "9.11.2020"}), ["d.M.yyyy"])
    assert df.collect()[0].order_date == date(2020, 11, 9)


def test_missing_discount_is_zero(spark):
    df = cleaning.clean(raw(spark, {"Discount": None}, {"Row ID": "2", "Discount": "x"}))
    assert [r.discount for r in df.collect()] == [0, 0]


@pytest.mark.parametrize("header", ["Sales", "Profit", "Quantity", "Customer ID", "Order Date"])
def test_incomplete_first_copy_takes_the_second_with_it(spark, header):
    df = raw(spark, {header: None}, {}, {"Row ID": "2"})
    assert [r.row_id for r in cleaning.clean(df).collect()] == [2]
    assert cleaning.clean_counts(df).collect()[0][0:4] == (3, int(header == "Order Date"), 2, 1)


def test_complete_first_copy_stays(spark):
    df = raw(spark, {"Sales": "5"}, {"Sales": None}, {"Sales": "7"})
    assert [r.sales for r in cleaning.clean(df).collect()] == [5]
    assert cleaning.clean_counts(df).collect()[0][0:4] == (3, 0, 2, 1)


def test_missing_ids_are_copies_of_each_other_bad_ones_are_not(spark):
    df = raw(spark, {"Row ID": None}, {"Row ID": None}, {"Row ID": "x"}, {"Row ID": "y"},
             {"Row ID": "07"}, {"Row ID": "7"})
    got = [r.row_id for r in cleaning.clean(df).collect()]
    assert sorted(got, key=str) == [7, None, None, None]


def test_other_missing_values_stay(spark):
    row = cleaning.clean(raw(spark, {"Segment": None, "Customer": None, "Region": None})).collect()[0]
    assert (row.segment, row.customer_name, row.region) == (None, None, None)


def test_what_does_not_fit_becomes_null_after_the_completeness_check(spark):
    row = cleaning.clean(raw(spark, {"Discount": "25", "Quantity": "9999999999"})).collect()[0]
    assert (row.discount, row.quantity) == (25, None)


def test_numbers_beyond_their_types_are_named_with_their_text(spark):
    large = {"Sales": "1e30", "Profit": " -" + "7" * 40, "Quantity": "9999999999", "Discount": "Infinity", "Date Key": "20201109000",
             "Row ID": "1" * 25}
    df = raw(spark, large, {"Row ID": "2", "Sales": "NaN"}, {"Row ID": "3", "Date Key": "x"}, {"Row ID": "4", "Discount": "x"})
    found = {r.row_id: r for r in cleaning.clean(df, overflow=True).collect()}
    marks = {c: t for c, t in found[None]._overflow.asDict().items() if t is not None}
    assert marks == {**{c: large[h].strip() for h, c in HEADERS.items() if h in large}, "quantity": "9999999999.0000000000"}
    assert [found[None][c] for c in marks] == [None] * 6
    assert set(found) == {None, 3, 4} and found[3]._overflow is None and found[4]._overflow is None
    assert found[3].date_key is None and found[4].discount == 0
    assert cleaning.clean(df).columns == CLEAN.names
    assert cleaning.clean_counts(df).collect()[0][0:4] == (4, 0, 1, 3)


@pytest.mark.parametrize("text, number", [("2.5", 3), ("0.4", 0), ("0.5", 1), ("2.49", 2)])
def test_quantity_is_rounded_not_cut(spark, text, number):
    assert cleaning.clean(raw(spark, {"Quantity": text})).collect()[0].quantity == number


def test_missing_header(spark):
    with pytest.raises(ValueError, match=r"\['Sales'\]"):
        cleaning.clean(raw(spark, {}).drop("Sales"))


def test_other_columns_pass_through(spark):
    df = cleaning.clean(raw(spark, {}).withColumn("Note", F.lit("x")))
    assert df.columns == [*CLEAN.names, "Note"]


def test_counts_of_nothing(spark):
    assert cleaning.clean_counts(raw(spark)).collect()[0][0:4] == (0, 0, 0, 0)


def test_hot_key_is_folded_before_the_shuffle(spark):
    df = spark.range(0, 30000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("row_id"),
        F.col("id").alias("_source_row"),
    )
    kept = cleaning.dedupe_first(df)
    assert kept.count() == 20001
    assert kept.filter("row_id = 0").collect()[0]._source_row == 0
    plan = kept._jdf.queryExecution().executedPlan().toString()
    shuffle = plan.index("Exchange hashpartitioning")
    assert plan.count("WindowGroupLimit", 0, shuffle) == 1
    assert plan.count("WindowGroupLimit", shuffle) >= 1


def _decimal(text, step="0.0000000001"):
    try:
        return Decimal(text.strip()).quantize(Decimal(step), ROUND_HALF_UP)
    except (AttributeError, InvalidOperation):
        return None


def _day(text):
    for form in ("%m/%d/%Y", "%Y-%m-%d"):
        try:
            return datetime.strptime(text, form).date()
        except (TypeError, ValueError):
            pass
    return None


def _clean_by_hand(rows):
    """(row_id, customer, date, sales, quantity, discount) of the rows that stay."""
    seen, kept = set(), []
    for r in rows:
        if r["Row ID"] in seen:
            continue
        seen.add(r["Row ID"])
        number = {h: _decimal(r[h]) for h in ("Sales", "Profit", "Quantity", "Discount")}
        day = _day(r["Order Date"])
        needed = (number["Sales"], number["Profit"], number["Quantity"], day, r["Customer ID"])
        if None not in needed:
            name = r["Customer"].strip() if r["Customer"] is not None else None
            quantity = int(number["Quantity"].quantize(Decimal(1), ROUND_HALF_UP))
            kept.append((int(r["Row ID"]) if r["Row ID"] else None, name, day, number["Sales"],
                         quantity, number["Discount"] or Decimal(0)))
    return kept


@pytest.mark.parametrize("seed", range(3))
def test_clean_against_a_loop_over_rows(spark, seed):
    rng = random.Random(seed)
    rows = [{
        **FULL,
        "Row ID": rng.choice([None, *map(str, range(120))]),
        "Customer": rng.choice(["a", " b ", "\u2003c\u00a0", "", None]),
        "Customer ID": rng.choice(["1", "2", "3", None]),
        "Order Date": rng.choice(["1/2/2020", "12/31/2020", "2020-02-29", "2/30/2020", "x", None]),
        "Sales": rng.choice(["1.00005", "12", " 7.5 ", "-3", "x", None]),
        "Profit": rng.choice(["1", "-2.5", "1,0", None, "3", "4"]),
        "Quantity": rng.choice(["1", "2.5", "0.4", "x", "9"]),
        "Discount": rng.choice(["0", "0.15", "x", None]),
    } for _ in range(300)]
    expected = _clean_by_hand(rows)
    got = [(r.row_id, r.customer_name, r.order_date, r.sales, r.quantity, r.discount)
           for r in cleaning.clean(raw(spark, *rows)).collect()]
    by_value = lambda found: sorted((tuple(v.normalize() + 0 if isinstance(v, Decimal) else v for v in r) for r in found), key=str)
    assert by_value(got) == by_value(expected)
    counts = cleaning.clean_counts(raw(spark, *rows)).collect()[0]
    bad_dates = sum(_day(r["Order Date"]) is None for r in rows)
    assert tuple(counts) == (300, bad_dates, 300 - len(expected), len(expected))
