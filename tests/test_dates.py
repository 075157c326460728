from datetime import date, timedelta

import pytest

from saldo.operators import dates, quality
from saldo.plans import pipeline
from saldo.schema import HEADERS
from saldo.sources import csv
from tests.test_csv import write


def forms(spark, texts, **how):
    return dates.infer(spark.createDataFrame([(t,) for t in texts], "order_date string"), **how)


DAYS = [date(2020, 1, 1) + timedelta(i) for i in range(0, 366, 5)]


@pytest.mark.parametrize("form, found", [
    ("%m/%d/%Y", "M/d/yyyy"), ("%d/%m/%Y", "d/M/yyyy"), ("%d.%m.%Y", "d.M.yyyy"), ("%Y-%m-%d", "yyyy-M-d"),
    ("%Y/%d/%m", "yyyy/d/M"), ("%d-%m-%y", "d-M-yy"), ("%Y%m%d", "yyyyMMdd"), ("%d %b %Y", "d MMM yyyy"),
    ("%d/%m/%Y 08:15", "d/M/yyyy"),
])
def test_the_form_is_told_from_all_values(spark, form, found):
    texts = [d.strftime(form) for d in DAYS]
    told = forms(spark, texts + [None, "bad", ""])
    assert told.formats == (found,) and not told.ambiguous and told.contrary == 0
    from saldo.functions import cells
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(cells.to_date(df.t, told.formats)).collect()] == DAYS


def test_one_late_day_decides(spark):
    early = ["1/2/2020"] * 500
    assert forms(spark, early + ["13/1/2020"]).formats == ("d/M/yyyy",)
    assert forms(spark, early + ["1/13/2020"]).formats == ("M/d/yyyy",)


def test_open_order_is_reported(spark):
    told = forms(spark, ["1/2/2020", "3/4/2020"])
    assert told.ambiguous and told.formats == ("M/d/yyyy",)
    assert forms(spark, ["1/2/2020"], month_first=False).formats == ("d/M/yyyy",)
    (row,) = told.report(spark).collect()
    assert (row.shape, row.rows, row.format, row.ambiguous) == ("year last", 2, "M/d/yyyy", True)


def test_both_orders_are_reported(spark):
    told = forms(spark, ["13/1/2020", "14/1/2020", "1/15/2020"])
    assert told.formats == ("d/M/yyyy",) and told.contrary == 1 and not told.ambiguous
    assert forms(spark, ["13/1/2020", "1/15/2020"]).ambiguous


def test_counts_add_up(spark):
    frame = lambda texts: spark.createDataFrame([(t,) for t in texts], "order_date string")
    a, b = ["1/2/2020", "x"], ["13/1/2020", "2020-01-13"]
    both = dates.choose(dates.merge([dates.shape_counts(frame(a)), dates.shape_counts(frame(b))]))
    assert both == forms(spark, a + b) and set(both.formats) == {"d/M/yyyy", "yyyy-M-d"}
    assert forms(spark, []).formats == dates.DATE_FORMATS


def test_day_first_files_load_right(spark, tmp_path):
    raw = write(tmp_path / "raw.csv", [{"Row ID": str(i), "Order Date": t} for i, t in enumerate(["5/1/2020", "25/1/2020", "3/2/2020"])])
    loaded = pipeline.load(spark, raw, str(tmp_path / "clean"), table="vendas_dmy")
    assert loaded.dates.formats == ("d/M/yyyy",)
    assert sorted(str(r.order_date) for r in loaded.sales.collect()) == ["2020-01-05", "2020-01-25", "2020-02-03"]


def test_large_numbers_reach_the_clean_csv_and_stop_the_table(spark, tmp_path):
    rows = [{"Row ID": "1", "Sales": "1e30", "Quantity": "9999999999"}, {"Row ID": "2", "Sales": "5"}]
    raw = write(tmp_path / "raw.csv", rows)
    with pytest.raises(quality.QualityError, match="sales_fits: 1, quantity_fits: 1"):
        pipeline.load(spark, raw, str(tmp_path / "clean"), table="vendas_grande")
    back = csv.read_clean_csv(spark, str(tmp_path / "clean"), overflow=True).orderBy("row_id").collect()
    assert [(r.sales, r.quantity) for r in back] == [(None, None), (5, 2)]
    assert (back[0]._overflow.sales, back[0]._overflow.quantity) == ("1e30", "9999999999.0000000000") and back[1]._overflow is None
    with pytest.raises(Exception, match="sales is no number of its type: 1e30"):
        csv.read_clean_csv(spark, str(tmp_path / "clean")).collect()
    with pytest.raises(quality.QualityError, match="sales_fits: 1"):
        pipeline.analyse(spark, str(tmp_path / "clean"), str(tmp_path / "out"))
    status, _ = pipeline.analyse(spark, str(tmp_path / "clean"), str(tmp_path / "out"), leave_out_overflow=True)
    assert [r.ok for r in status.collect()] == [True] * 4


def test_rules_name_what_does_not_fit(spark, tmp_path):
    from saldo.operators import clean as cleaning
    from tests.test_clean import raw
    df = raw(spark, {"Sales": "1e30"}, {"Row ID": "2", "Sales": "12345678901.00"}, {"Row ID": "3"})
    typed = quality.to_table_types(cleaning.clean(df, overflow=True))
    found = {r.row_id: (r.violations, r._overflow.sales) for r in quality.rejected_rows(typed).collect()}
    assert found == {1: (["sales_fits"], "1e30"), 2: (["sales_fits"], "12345678901.0000000000")}
    counts = {r.regra: r.linhas for r in quality.rule_counts(typed).collect()}
    assert counts["sales_fits"] == 2 and counts["sales_not_null"] == 0 and "sales_fits" not in quality.row_rules()
    assert set(HEADERS.values()) >= set(cleaning.MARKED)
