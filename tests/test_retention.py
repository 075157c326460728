import random

import pytest
from pyspark.sql import functions as F

from saldo.operators import retention, revenue
from tests.frames import frame, rows, sale

# Month, customers at the start, at the end, new, lost, churn, retention.
CHURN = [
    ("2020-02", 27, 27, 18, 18, 66.67, 33.33),
    ("2020-03", 27, 44, 35, 18, 66.67, 33.33),
    ("2020-04", 44, 44, 21, 21, 47.73, 52.27),
    ("2020-05", 44, 46, 25, 23, 52.27, 47.73),
    ("2020-06", 46, 53, 26, 19, 41.3, 58.7),
    ("2020-07", 53, 44, 19, 28, 52.83, 47.17),
    ("2020-08", 44, 49, 25, 20, 45.45, 54.55),
    ("2020-09", 49, 77, 37, 9, 18.37, 81.63),
    ("2020-10", 77, 57, 13, 33, 42.86, 57.14),
    ("2020-11", 57, 75, 32, 14, 24.56, 75.44),
    ("2020-12", 75, 75, 17, 17, 22.67, 77.33),
    ("2021-01", 75, 24, 5, 56, 74.67, 25.33),
    ("2021-02", 24, 30, 24, 18, 75.0, 25.0),
]

# 48 monthly revenues per customer and 47 monthly churn rates, whose lifetime
# value is known.
ARPU = [
    516.53, 178.17, 1265.7, 643.08, 514.09, 652.74, 771.51, 569.58, 1062.04, 551.81, 1048.38,
    927.27, 757.25, 398.38, 656.38, 759.89, 579.46, 495.95, 575.31, 785.07, 861.28, 592.55,
    974.01, 924.93, 515.07, 635.21, 965.78, 726.83, 846.14, 668.31, 662.77, 545.34, 911.35,
    941.05, 955.72, 1215.47, 798.27, 507.09, 829.37, 679.87, 681.36, 720.29, 663.4, 961.19,
    1040.1, 997.36, 1353.33, 1077.08,
]
CHURN_PCT = [
    66.67, 66.67, 47.73, 52.27, 41.3, 52.83, 45.45, 18.37, 42.86, 24.56, 22.67, 74.67, 75.0,
    40.0, 54.24, 44.44, 46.15, 46.0, 48.0, 21.28, 45.33, 26.42, 16.67, 61.73, 55.56, 41.67,
    37.74, 20.37, 44.78, 37.29, 36.21, 16.39, 35.0, 10.0, 19.77, 40.0, 60.71, 25.0, 40.0, 28.81,
    31.34, 19.4, 32.88, 9.38, 19.54, 15.38, 9.64,
]


def active(months):
    return [sale(month=m, customer=c, sales=10) for m, customers in months.items() for c in customers]


def test_churn_known_results(spark):
    current, fresh = [f"c{i}" for i in range(27)], 27
    months = {"2020-01": current}
    for month, _, _, new, lost, *_ in CHURN:
        current = current[lost:] + [f"c{fresh + i}" for i in range(new)]
        fresh += new
        months[month] = current
    got = rows(retention.churn_monthly(frame(spark, active(months))))
    assert got == CHURN


def test_previous_month_is_the_previous_observed_one(spark):
    sales = frame(spark, active({"2020-01": ["a", "b"], "2020-04": ["b", "c"]}))
    assert rows(retention.churn_monthly(sales)) == [("2020-04", 2, 2, 1, 1, 50.0, 50.0)]
    assert rows(retention.churned_customers(sales)) == [("2020-04", "a")]
    assert rows(retention.new_customers(sales)) == [("2020-04", "c")]


def test_nobody_returns_in_the_next_month_but_later(spark):
    sales = frame(spark, active({"2020-01": ["a"], "2020-02": ["b"], "2020-03": ["a", "b"]}))
    assert rows(retention.churn_monthly(sales)) == [
        ("2020-02", 1, 1, 1, 1, 100.0, 0.0), ("2020-03", 1, 2, 1, 0, 0.0, 100.0),
    ]


def test_one_month_gives_no_churn_but_a_schema(spark):
    churn = retention.churn_monthly(frame(spark, active({"2020-01": ["a"]})))
    assert churn.collect() == []
    assert churn.columns == ["periodo", "clientes_ini", "clientes_fim", "novos", "sairam",
                             "churn_pct", "retencao_pct"]


def test_half_percent_steps_round_to_even(spark):
    customers = [f"c{i}" for i in range(32)]
    sales = frame(spark, active({"2020-01": customers, "2020-02": customers[1:]}))
    assert rows(retention.churn_monthly(sales))[0][5:] == (3.12, 96.88)


def brute_force(months):
    names, result = sorted(months), []
    for before, now in zip(names, names[1:]):
        a, b = set(months[before]), set(months[now])
        result.append((now, len(a), len(b), len(b - a), len(a - b)))
    return result


@pytest.mark.parametrize("seed", range(4))
def test_churn_against_sets(spark, seed):
    rng = random.Random(seed)
    names = rng.sample([f"{y}-{m:02d}" for y in (2019, 2020, 2021) for m in range(1, 13)], 14)
    customers = [f"c{i}" for i in range(40)]
    months = {m: rng.sample(customers, rng.randint(1, 25)) for m in names}
    sales = frame(spark, active(months) + [r for r in active(months) if rng.random() < 0.3])
    got = rows(retention.churn_monthly(sales))
    assert [r[:5] for r in got] == brute_force(months)
    order = sorted(months)
    lost = {(b, c) for a, b in zip(order, order[1:]) for c in set(months[a]) - set(months[b])}
    new = {(b, c) for a, b in zip(order, order[1:]) for c in set(months[b]) - set(months[a])}
    assert sorted(rows(retention.churned_customers(sales))) == sorted(lost)
    assert sorted(rows(retention.new_customers(sales))) == sorted(new)
    # The flows add up, and one month's end is the next one's start.
    assert all(r[1] - r[4] + r[3] == r[2] for r in got)
    assert [r[2] for r in got[:-1]] == [r[1] for r in got[1:]]
    one_pass = rows(retention.ltv_from_sales(sales))
    two_frames = rows(retention.ltv(revenue.mrr_monthly(sales), retention.churn_monthly(sales)))
    assert one_pass == two_frames


def test_sales_without_a_customer_count_as_revenue_only(spark):
    data = active({"2020-01": ["a", "b"], "2020-03": ["a"]})
    data += [sale(month=m, customer=None, name="?", sales=30) for m in ("2020-01", "2020-02", "2020-03")]
    sales = frame(spark, data)
    assert rows(retention.churn_monthly(sales)) == [("2020-03", 2, 1, 0, 1, 50.0, 50.0)]
    two_frames = retention.ltv(revenue.mrr_monthly(sales), retention.churn_monthly(sales))
    assert rows(retention.ltv_from_sales(sales)) == rows(two_frames)


def test_activity_and_matrix(spark):
    sales = frame(spark, active({"2020-01": ["a", "a", "b"], "2020-02": ["b"]}))
    activity = sorted(rows(retention.customer_activity(sales)))
    assert activity == [("2020-01", "a", 2), ("2020-01", "b", 1), ("2020-02", "b", 1)]
    matrix = retention.activity_matrix(sales)
    assert matrix.columns == ["customer_id", "2020-01", "2020-02"]
    assert sorted(rows(matrix)) == [("a", 2.0, 0.0), ("b", 1.0, 1.0)]
    asked = retention.activity_matrix(sales, ["2020-01", "2020-05"])
    assert sorted(rows(asked)) == [("a", 2.0, 0.0), ("b", 1.0, 0.0)]
    sparse = retention.activity_sparse(sales)
    assert sorted((r.customer_id, [tuple(m) for m in r.meses]) for r in sparse.collect()) == [
        ("a", [("2020-01", 2)]), ("b", [("2020-01", 1), ("2020-02", 1)])]
    wide = retention.widened(sparse, retention.months_between("2020-01", "2020-02"))
    assert wide.columns == matrix.columns and sorted(rows(wide)) == sorted(rows(matrix))
    assert retention.activity_sparse(sales.limit(0)).collect() == []
    assert retention.months_between("2019-11", "2020-02") == ["2019-11", "2019-12", "2020-01", "2020-02"]


def monthly(spark, arpu):
    return spark.createDataFrame([(x,) for x in arpu], "arpu double")


def churn(spark, pct):
    return spark.createDataFrame([(x, 100 - x) for x in pct], "churn_pct double, retencao_pct double")


def test_ltv_known_result(spark):
    got = rows(retention.ltv(monthly(spark, ARPU), churn(spark, CHURN_PCT)))
    assert got == [(769.98, 37.62, 2.7, 2046.7)]
    means = rows(retention.churn_averages(churn(spark, CHURN_PCT)))
    assert [round(x, 2) for x in means[0]] == [37.62, 62.38]


@pytest.mark.parametrize("pct", [[], [0.0, 0.0]])
def test_ltv_without_churn(spark, pct):
    got = rows(retention.ltv(monthly(spark, [10.0, 20.0]), churn(spark, pct)))
    assert got == [(15.0, 0.0, None, None)]


def test_hot_customer(spark):
    """One customer with most of the rows folds to one row per month."""
    hot = spark.range(20000).select(
        F.concat(F.lit("2020-0"), (F.col("id") % 3 + 1).cast("string")).alias("year_month"),
        F.lit("hot").alias("customer_id"),
    )
    rest = frame(spark, active({"2020-01": ["a"], "2020-02": ["b"], "2020-03": ["a"]}))
    sales = hot.unionByName(rest.select("year_month", "customer_id"))
    assert [r[:5] for r in rows(retention.churn_monthly(sales))] == [
        ("2020-02", 2, 2, 1, 1), ("2020-03", 2, 2, 1, 1),
    ]
