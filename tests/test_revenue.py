from pyspark.sql import functions as F

from saldo.functions.cells import discount_band
from saldo.operators import revenue
from tests.frames import frame, group, in_cents, rows, sale

# Known monthly results, unrounded rows.
# month, revenue, customers, orders, profit, revenue per customer, margin, growth
MONTHS = [
    ("2020-01", 13946.229, 27, 31, 2446.7711, 516.53, 17.54, None),
    ("2020-02", 4810.558, 27, 29, 865.728, 178.17, 18.0, -65.51),
    ("2020-03", 55691.009, 44, 71, 498.7299, 1265.7, 0.9, 1057.68),
    ("2020-04", 28295.345, 44, 66, 3488.8352, 643.08, 12.33, -49.19),
    ("2020-05", 23648.287, 46, 69, 2738.7096, 514.09, 11.58, -16.42),
    ("2020-06", 34595.1276, 53, 66, 4976.5244, 652.74, 14.39, 46.29),
    ("2020-07", 33946.393, 44, 65, -841.4826, 771.51, -2.48, -1.88),
    ("2020-08", 27909.4685, 49, 72, 5318.105, 569.58, 19.05, -17.78),
    ("2020-09", 81777.3508, 77, 130, 8328.0994, 1062.04, 10.18, 193.01),
    ("2020-10", 31453.393, 57, 78, 3448.2573, 551.81, 10.96, -61.54),
    ("2020-11", 78628.7167, 75, 151, 9292.1269, 1048.38, 11.82, 149.98),
    ("2020-12", 69545.6205, 75, 141, 8983.5699, 927.27, 12.92, -11.55),
]

# The same months over rows rounded to cents.
# month, revenue, revenue of twelve months, customers, revenue per customer, growth
MONTHS_IN_CENTS = [
    ("2020-01", 13946.23, 167354.76, 27, 516.53, None),
    ("2020-02", 4810.59, 57727.08, 27, 178.17, -65.51),
    ("2020-03", 55691.04, 668292.48, 44, 1265.71, 1057.68),
    ("2020-04", 28295.35, 339544.2, 44, 643.08, -49.19),
    ("2020-10", 31453.37, 377440.44, 57, 551.81, 11.16),
    ("2020-11", 78628.74, 943544.88, 75, 1048.38, 149.99),
    ("2020-12", 69545.64, 834547.68, 75, 927.28, -11.55),
]

# Revenue, profit, customers, orders, margin, share, revenue per customer.
SEGMENTS = {
    "SMB": (1161401.345, 134119.2092, 96, 2586, 11.55, 50.56, 12097.93),
    "Strategic": (706146.3668, 91979.134, 91, 1514, 13.03, 30.74, 7759.85),
    "Enterprise": (429653.1485, 60298.6785, 76, 909, 14.03, 18.7, 5653.33),
}

# Revenue, profit, customers, margin, share.
PRODUCTS = [
    (410378.265, 12496.2822, 99, 3.05, 17.86),
    (340935.415, 32136.4203, 99, 9.43, 14.84),
    (330007.054, 44515.7306, 99, 13.49, 14.37),
    (223843.608, 21278.8264, 99, 9.51, 9.74),
    (189238.631, 3384.7569, 62, 1.79, 8.24),
    (167380.318, 41936.6357, 97, 25.05, 7.29),
    (149528.03, 55617.8249, 49, 37.2, 6.51),
    (125152.744, 32864.4698, 98, 26.26, 5.45),
    (114879.9963, -3472.556, 89, -3.02, 5.0),
    (107532.161, 18138.0054, 97, 16.87, 4.68),
    (91705.164, 13059.1436, 99, 14.24, 3.99),
    (27118.792, 6527.787, 99, 24.07, 1.18),
    (16476.402, 6964.1767, 88, 42.27, 0.72),
    (3024.28, 949.5182, 86, 31.4, 0.13),
]

# Year, quarter, revenue, profit, margin, customers.
QUARTERS = [
    (2020, 1, 74447.86, 3811.2, 5.12, 71),
    (2020, 2, 86538.77, 11204.16, 12.95, 84),
    (2020, 3, 143633.18, 12804.73, 8.91, 87),
    (2020, 4, 179627.75, 21723.97, 12.09, 95),
]

# Revenue of the first customers, share of a total of 2297201.07.
CUSTOMER_SHARES = [
    (30421.08, 1.32), (29258.49, 1.27), (25826.88, 1.12), (25799.33, 1.12), (25112.09, 1.09),
    (25043.07, 1.09), (24423.59, 1.06), (23884.76, 1.04), (23835.9, 1.04), (23729.82, 1.03),
]


def test_mrr_monthly_known_results(spark):
    data = [r for m, total, customers, orders, profit, *_ in MONTHS
            for r in group(total, profit, customers, orders, month=m)]
    got = rows(revenue.mrr_monthly(frame(spark, data)))
    expected = [(m, total, customers, orders, profit, round(total * 12, 4), arpu, margin, growth)
                for m, total, customers, orders, profit, arpu, margin, growth in MONTHS]
    assert got == expected


def test_mrr_growth_known_results(spark):
    data = [r for m, total, _, customers, *_ in MONTHS_IN_CENTS
            for r in group(total, 0, customers, month=m)]
    view = revenue.monthly_revenue(in_cents(frame(spark, data)))
    got = [(r[0], r[1], r[2], r[3], r[4], r[6]) for r in rows(revenue.mrr_growth(view))]
    # October follows April here, the previous observed month.
    assert got == MONTHS_IN_CENTS


def test_row_rounding_makes_the_two_regimes_differ(spark):
    data = frame(spark, [sale(sales=261.965), sale(sales=261.965)])
    assert rows(revenue.mrr_monthly(data))[0][1] == 523.93
    assert rows(revenue.monthly_revenue(in_cents(data)))[0][3] == 523.94


def test_segment_kpis_known_results(spark):
    data = [r for s, (total, profit, customers, orders, *_) in SEGMENTS.items()
            for r in group(total, profit, customers, orders, segment=s)]
    got = rows(revenue.segment_kpis(frame(spark, data)))
    assert got == [(s, *values) for s, values in SEGMENTS.items()]
    report = revenue.segment_report(revenue.segment_kpis(frame(spark, data)))
    assert report.columns == ["segment", "receita", "margem_pct", "share_pct", "arpu"]


def test_sql_segments_keeps_the_null_group_and_the_frame_report_drops_it(spark):
    data = frame(spark, [sale(sales=30), sale(sales=10, segment=None, customer="c2")])
    sql = rows(revenue.sql_segments(in_cents(data)))
    assert [(r[0], r[2], r[5]) for r in sql] == [("SMB", 30.0, 75.0), (None, 10.0, 25.0)]
    kpis = rows(revenue.segment_kpis(data))
    assert [(r[0], r[6]) for r in kpis] == [("SMB", 100.0)]


def test_product_kpis_known_results(spark):
    data = [r for i, (total, profit, customers, *_) in enumerate(PRODUCTS)
            for r in group(total, profit, customers, product=f"p{i:02d}")]
    got = rows(revenue.product_kpis(frame(spark, data)))
    assert got == [(f"p{i:02d}", *values) for i, values in enumerate(PRODUCTS)]


def test_top_products_rank_leaves_gaps_after_ties(spark):
    data = [sale(product=p, sales=s, profit=1) for p, s in [("b", 50), ("a", 50), ("c", 20), ("d", 10)]]
    got = rows(revenue.sql_top_products(in_cents(frame(spark, data)), n=3))
    assert [(r[0], r[1]) for r in got] == [(1, "a"), (1, "b"), (3, "c")]


def test_top_products_mean_discount_is_unweighted(spark):
    data = [sale(sales=1000, discount=0.1), sale(sales=1, discount=0.2), sale(sales=1, discount=0.25)]
    assert rows(revenue.sql_top_products(in_cents(frame(spark, data))))[0][5] == 18.33


def test_top_customers_known_shares(spark):
    data = [sale(name=f"n{i:02d}", sales=s) for i, (s, _) in enumerate(CUSTOMER_SHARES)]
    rest = round(2297201.07 - sum(s for s, _ in CUSTOMER_SHARES), 2)
    data += [sale(name=f"r{i:03d}", sales=10000) for i in range(int(rest // 10000))]
    data.append(sale(name="rest", sales=round(rest % 10000, 2)))
    got = rows(revenue.sql_top_customers(in_cents(frame(spark, data))))
    assert [(r[2], r[4]) for r in got] == CUSTOMER_SHARES


def test_top_customers_are_name_and_segment_not_id(spark):
    data = [
        sale(name="x", customer="1", sales=5), sale(name="x", customer="2", sales=5),
        sale(name="x", customer="1", sales=7, segment="Enterprise"),
    ]
    got = rows(revenue.sql_top_customers(in_cents(frame(spark, data))))
    assert [r[:3] for r in got] == [("x", "SMB", 10.0), ("x", "Enterprise", 7.0)]


def test_quarters_known_results(spark):
    data = [r for year, quarter, total, profit, _, customers in QUARTERS
            for r in group(total, profit, customers, month=f"{year}-{quarter * 3:02d}")]
    assert rows(revenue.sql_quarters(in_cents(frame(spark, data)))) == QUARTERS


def test_quarter_customers_are_not_the_sum_of_months(spark):
    data = [sale(month=m, sales=1) for m in ("2020-01", "2020-02", "2020-03")]
    assert rows(revenue.sql_quarters(in_cents(frame(spark, data))))[0][5] == 1


def test_discount_bands(spark):
    levels = [0, 0.0001, 0.1, 0.1001, 0.2, 0.3, 0.3001, 1]
    data = frame(spark, [sale(discount=d, sales=10, profit=i) for i, d in enumerate(levels)])
    got = rows(revenue.sql_discount_bands(in_cents(data)))
    assert [r[:3] for r in got] == [
        ("0%  — sem desconto", 1, 10.0), ("1% a 10%", 2, 20.0), ("11% a 20%", 2, 20.0),
        ("21% a 30%", 1, 10.0), ("Acima de 30%", 2, 20.0),
    ]
    assert [r[3] for r in got] == [0.0, 15.0, 35.0, 50.0, 65.0]
    assert data.filter(discount_band(F.col("discount")).isNull()).isEmpty()


def test_month_without_revenue(spark):
    data = [sale(month="2020-01", sales=5, profit=1), sale(month="2020-02"), sale(month="2020-03", sales=5)]
    sales = frame(spark, data)
    monthly = rows(revenue.mrr_monthly(sales))
    assert [r[7] for r in monthly] == [20.0, None, 0.0]
    assert [r[8] for r in monthly] == [None, -100.0, None]
    growth = rows(revenue.mrr_growth(revenue.monthly_revenue(in_cents(sales))))
    assert [r[6] for r in growth] == [None, -100.0, None]


def test_sql_rounds_half_away_from_zero_and_frame_half_to_even(spark):
    data = frame(spark, [sale(sales=32, profit=-1)])
    assert rows(revenue.monthly_revenue(in_cents(data)))[0][8] == -3.13
    assert rows(revenue.mrr_monthly(data))[0][7] == -3.12


def test_latest_month(spark):
    data = [sale(month="2020-01", sales=5), sale(month="2020-03", sales=8, profit=2, customer="c2"),
            sale(month="2020-03", sales=8)]
    assert rows(revenue.latest_month_kpis(frame(spark, data))) == [("2020-03", 16.0, 192.0, 8.0, 2, 12.5)]


def test_empty_sales(spark):
    empty = frame(spark, [])
    for report in (revenue.mrr_monthly, revenue.latest_month_kpis, revenue.segment_kpis,
                   revenue.product_kpis, revenue.sql_segments, revenue.sql_top_products,
                   revenue.sql_top_customers, revenue.sql_quarters, revenue.sql_discount_bands):
        assert rows(report(empty)) == []
    dated = empty.withColumn("order_date", F.lit(None).cast("date"))
    assert rows(revenue.load_summary(dated)) == [(None, None, 0, 0, 0, None)]


def test_totals_agree_between_reports(spark):
    sales = frame(spark, [
        sale(month=f"2020-{1 + i % 12:02d}", customer=f"c{i % 7}", order=f"o{i // 2}", sales=i * 1.37,
             profit=i * 0.11, discount=(i % 9) / 20, segment=["SMB", "Strategic"][i % 2],
             product=f"p{i % 5}")
        for i in range(300)
    ])
    table = in_cents(sales)
    total = float(table.agg(F.sum("sales")).first()[0])
    monthly = rows(revenue.mrr_growth(revenue.monthly_revenue(table)))
    for got in (
        sum(r[1] for r in monthly),
        sum(r[2] for r in rows(revenue.sql_segments(table))),
        sum(r[2] for r in rows(revenue.sql_quarters(table))),
        sum(r[2] for r in rows(revenue.sql_discount_bands(table))),
        sum(r[3] for r in rows(revenue.sql_top_products(table))),
    ):
        assert round(got, 2) == total
    assert all(r[2] == round(r[1] * 12, 2) for r in monthly)
