"""Physical plans: what is pushed down, broadcast, limited before a shuffle, and never used."""

import re

import pytest
from conftest import SF_SMALL

from basketry.operators import hotkeys, ranking, scd2
from basketry.operators.distinct import distinct_counts
from basketry.plans import bronze, gold, kpi, silver
from basketry.session import staged
from basketry.sources.testtables import FIRST_BY, TIEBREAK_EXTRA, raw_with_audit, table


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def final_plan_of(frame):
    """The plan as adaptive execution left it after a run."""
    executed = frame._jdf.queryExecution()
    executed.executedPlan().executeCollect()
    text = executed.executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def base(spark):
    return staged(bronze.accepted(raw_with_audit(spark, SF_SMALL)), "plan-bronze")


@pytest.fixture(scope="module")
def fact(spark, base):
    orders = silver.orders(base, FIRST_BY, TIEBREAK_EXTRA)
    feeds = gold.customer_feed(base), gold.product_feed(base)
    return gold.fact_sales(
        spark, orders, gold.current_customers(feeds[0]), gold.current_products(feeds[1]))


def test_one_row_per_key_is_limited_before_the_shuffle(base):
    for frame in (silver.customers(base), silver.orders(base, FIRST_BY, TIEBREAK_EXTRA)):
        plan = plan_of(frame)
        partial = plan.index("row_number(), 1, Partial")
        assert plan.index("row_number(), 1, Final") < plan.index("Exchange") < partial
        assert plan.count("Exchange") == 1


def test_no_python_and_no_cross_join(spark, fact):
    events = table(spark, SF_SMALL, "events")
    frames = [fact, kpi.by_region_category(fact), kpi.by_customer_segment(fact),
              kpi.by_outlet_city(fact), kpi.monthly_trend(fact),
              scd2.versions(events, ["user_id"], "ts", ["user_id", "event_type"])]
    for frame in frames:
        plan = plan_of(frame)
        assert not re.search(r"Python|Pandas|CartesianProduct|NestedLoop", plan)


def test_calendar_is_broadcast_and_columns_are_pruned(fact):
    plan = plan_of(kpi.by_region_category(fact, True))
    assert re.search(r"BroadcastHashJoin \[order_date", plan)
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert scans and all("postal_code" not in scan for scan in scans)
    assert re.search(r"PushedFilters: \[IsNotNull", plan)


def test_unique_orders_need_no_shuffle_by_order(spark, fact):
    stored = staged(fact, "plan-fact")
    counted = plan_of(kpi.by_region_category(stored, True))
    distinct = plan_of(kpi.by_region_category(stored))
    assert counted.count("Exchange") == 1 and distinct.count("Exchange") > 1


def test_top_k_is_limited_before_the_shuffle(spark, fact):
    assert "WindowGroupLimit" in plan_of(kpi.top_products(fact, 3, True))


def test_without_hot_keys_the_extra_joins_vanish(spark):
    events = table(spark, SF_SMALL, "events")
    calm = final_plan_of(scd2.versions(events, ["user_id"], "ts", ["user_id", "event_type"]))
    assert calm.count("BroadcastHashJoin") == 0
    hot = scd2.versions(events, ["user_id"], "ts", ["user_id", "event_type"], rows_per_task=20,
                        max_slices=16)
    assert final_plan_of(hot).count("BroadcastHashJoin") >= 3


def test_partition_filter_reaches_the_scan(spark, folder):
    from basketry.sources import tables

    rows = spark.range(100).selectExpr("id", "cast(2015 + id % 5 as string) as order_year")
    tables.refresh(rows, folder, ["order_year"])
    read = tables.snapshot(spark, folder, rows.schema).filter("order_year = '2016'")
    assert dict(read.dtypes)["order_year"] == "string"
    assert re.search(r"PartitionFilters: \[[^]]*order_year", plan_of(read))
    assert read.count() == 20


def test_ranks_of_a_hot_group_are_cut_into_slices(spark):
    frame = spark.range(1000).selectExpr("id", "'g' as g", "cast(id as double) as v")
    points = hotkeys.split_points(frame, ["g"], "v", 100, 32)
    assert len(points.first()[hotkeys.SPLITS]) == 9
    ranked = ranking.rank_in_group(frame, ["g"], "v", "r", 100, 32)
    assert ranked.filter("r <> 1000 - id").count() == 0


def test_a_hot_customer_is_split_by_the_star_join(spark):
    from basketry import contracts as C
    from basketry.operators.calendar import date_spine
    from basketry.operators.star import star_join
    from basketry.streaming.ingest import bronze_schema

    empty = silver.with_order_period(
        silver.order_rows(spark.createDataFrame([], bronze_schema())))
    given = {"order_id": "concat('O', id)", "product_id": "concat('P', id % 500)",
             "customer_id": "if(id % 3 = 0, 'hot', concat('C', id % 5000))",
             "order_date": "date '2020-01-01'", "sales": "10.0D"}
    orders = staged(spark.range(0, 400_000, 1, 8).selectExpr(*[
        f"cast({given.get(f.name, 'null')} as {f.dataType.simpleString()}) as {f.name}"
        for f in empty.schema]), "skewed-orders")
    customers = spark.range(5001).selectExpr(
        "if(id = 5000, 'hot', concat('C', id)) as customer_id",
        *[f"'x' as {n}" for n in ("full_name", "segment", "city_type", "region", "outlet_type",
                                  "state")])
    products = spark.range(500).selectExpr(
        "concat('P', id) as product_id", "'x' as product_name", "'y' as category_of_goods",
        "'z' as sub_category")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        fact = star_join(orders, customers, products, date_spine(spark), 4018)
        totals = fact.groupBy("region", C.SOURCE_FILE).count()
        assert "skew=true" in final_plan_of(totals)
        assert totals.first()["count"] == 400_000
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_distinct_counts_copy_no_rows(spark):
    draw = [(i % 3 or None, f"c{i % 7}", None if i % 5 == 0 else i % 11, 1) for i in range(200)] + [(9, None, None, 1)]
    rows = spark.createDataFrame(draw, "k int, a string, b int, __mark int")
    found = distinct_counts(rows, ["k"], {"as": "a", "bs": "b", "ks": "k"})
    assert not re.search("Expand", plan_of(found))
    want = {k: (len({r[1] for r in draw if r[0] == k} - {None}), len({r[2] for r in draw if r[0] == k} - {None}), int(k is not None))
            for k in {r[0] for r in draw}}
    assert {r.k: (r["as"], r.bs, r.ks) for r in found.collect()} == want
    assert distinct_counts(rows.limit(0), ["k"], {"as": "a"}).count() == 0
