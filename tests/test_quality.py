import pytest
from pyspark.sql import functions as F

from basketry.operators import quality as Q
from basketry.plans import rules as R, silver

RULES = [Q.Rule("a_positive", "a > 0"), Q.Rule("b_set", "b IS NOT NULL"),
         Q.Rule("a_small", "a < 10", Q.WARN)]


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(
        [(1, "x"), (0, "x"), (None, "x"), (20, None), (None, None)], "a int, b string"
    )


def test_unknown_counts_as_violation(rows):
    assert [r.a for r in Q.keep(rows, RULES).collect()] == [1]


def test_split_is_a_partition(rows):
    tagged = Q.tagged(rows, RULES)
    good, bad = Q.accepted(tagged), Q.rejected(tagged)
    assert good.count() + bad.count() == rows.count()
    assert good.columns == rows.columns
    assert all(r[Q.VIOLATIONS] for r in bad.collect())
    assert sorted(len(r[Q.VIOLATIONS]) for r in bad.collect()) == [1, 1, 1, 2]


def test_first_reason_wins(rows):
    reasons = [Q.Reason("no b", "b IS NULL"), Q.Reason("no a", "a IS NULL")]
    got = [r.why for r in rows.select(Q.first_reason(reasons, "fine").alias("why")).collect()]
    assert got == ["fine", "fine", "no a", "no b", "no b"]


def test_report_counts_every_rule(rows):
    got = {r.rule_name: (r.action, r.passed, r.failed) for r in Q.report(rows, RULES, "t").collect()}
    assert got == {"a_positive": ("drop", 2, 3), "b_set": ("drop", 3, 2), "a_small": ("warn", 2, 3)}


def test_report_of_nothing(rows):
    got = Q.report(rows.limit(0), RULES, "t").collect()
    assert [(r.passed, r.failed) for r in got] == [(0, 0)] * 3


def test_fail_rule_stops_even_a_count(spark):
    rows = spark.createDataFrame([("o1", 5.0), (None, 5.0)], "order_id string, sales double")
    rules = [Q.Rule("id", "order_id IS NOT NULL", Q.FAIL)]
    checked = Q.abort_on_violation(rows, rules)
    for run in (checked.count, checked.collect, checked.select("sales").collect):
        with pytest.raises(Exception, match="rule id violated"):
            run()
    clean = Q.abort_on_violation(rows.filter("order_id IS NOT NULL"), rules)
    assert clean.count() == 1


def _customers(spark, values):
    return spark.createDataFrame(
        values, "customer_id string, first_name string, dob date, segment string, "
                "city_type string, outlet_type string, region string"
    )


def test_customer_rules(spark):
    from datetime import date

    rows = _customers(spark, [
        ("1", "A", None, "CONSUMER", "Tier 1", "Large", "East"),
        ("2", "B", date(1899, 12, 31), "CORPORATE", "Tier 9", "Huge", "Up"),
        ("3", None, date(1980, 1, 1), "OTHER", None, None, None),
        ("4", "D", date(2999, 1, 1), "CONSUMER", "Village", "Small", "North"),
    ])
    kept = Q.keep(rows, R.customer_rules()).collect()
    assert [r.customer_id for r in kept] == ["1"]
    failed = {r.rule_name: r.failed for r in Q.report(rows, R.customer_rules(), "c").collect()}
    assert failed == {"customer_id_not_null": 0, "first_name_not_null": 1, "valid_dob": 2,
                      "valid_segment": 1, "valid_city_type": 2, "valid_outlet_type": 2,
                      "valid_region": 2}
    strict = {r.rule_name: r.failed
              for r in Q.report(rows, R.customer_rules(strict=True), "c").collect()}
    assert strict["valid_segment"] == 4


def test_product_and_order_warnings(spark):
    goods = spark.createDataFrame(
        [("1", "n", "Furniture"), ("2", "n", "furniture"),
         ("3", "n", "Sessional Fruits & Vegetables")],
        "product_id string, product_name string, category_of_goods string",
    )
    failed = {r.rule_name: r.failed for r in Q.report(goods, R.PRODUCT_RULES, "p").collect()}
    assert failed["valid_category"] == 1
    orders = spark.createDataFrame(
        [("2020-01-02", "2020-01-01", "Same Day", "Consumer", "East", 10.0, 60.0),
         ("2020-01-01", "2020-01-02", "Drone", "consumer", "east", 10.0, 50.0)],
        "o string, s string, ship_mode string, segment string, region string, sales double, "
        "profit double",
    ).withColumns({"order_date": F.col("o").cast("date"), "ship_date": F.col("s").cast("date")})
    failed = {r.rule_name: r.failed for r in Q.report(orders, R.ORDER_WARN_RULES, "o").collect()}
    assert failed == {"ship_after_order": 1, "valid_ship_mode": 1, "valid_segment": 1,
                      "valid_region": 1, "profit_margin_sane": 1}


def test_silver_quarantine_is_the_complement_of_orders(spark):
    from conftest import SF_SMALL

    from basketry.plans import bronze
    from basketry.sources.testtables import raw_with_audit

    accepted = bronze.accepted(raw_with_audit(spark, SF_SMALL))
    spoiled = accepted.withColumn(
        "customer_id", F.when(F.col("l_suppkey") == 1, F.lit("  ")).otherwise(F.col("customer_id"))
    )
    kept = Q.keep(silver.order_rows(spoiled), R.ORDER_RULES).count()
    bad = silver.quarantine(spoiled)
    assert kept + bad.count() == spoiled.count()
    assert bad.filter("failure_reason = 'customer_id NULL or blank'").count() > 0
    assert bad.filter("failure_reason = 'other'").count() == 0
    subset = silver.quarantine(spoiled, complete=False)
    assert subset.count() > 0
    assert subset.exceptAll(bad.select(*subset.columns)).count() == 0
