"""The feed derived from the test tables: order of its joins, readings of its rows."""

import glob
import gzip
import os
import re
import time

import pytest
from pyspark.sql import functions as F

from basketry.registry import queries
from basketry.sources import sales_csv, testtables

DAY = "timestamp_ntz'2000-01-31 00:00:00'"
ROWS = {
    "region": "0, 'ASIA'",
    "nation": "0, 'INDIA', 0",
    "customer": "1L, 'Ann', 0, 1.0D, 'BUILDING'", "supplier": "1L, 'S', 0, 1.0D",
    "part": "1L, 'Chair', 'B', 'T', 1, 1.0D",
    "orders": f"1L, 1L, 'O', 1.0D, {DAY}, '2-HIGH'",
    "lineitem": f"1L, 1L, 1L, 1, 2.0D, 10.5D, 0.1D, 0.0D, cast(null as string), 'O', {DAY}",
    "events": f"1L, {DAY}, 1L, 'e', 1.0D, ''",
}


@pytest.fixture
def tables(spark, folder):
    """One row of each table, twice in ``lineitem`` and ``part``; one more order line has no part."""
    for name, row in ROWS.items():
        more = {"lineitem": [row, row.replace("1L, 1L", "1L, null", 1), row.replace("cast(null as string)", "'R'")],
                "part": [row]}.get(name, [])
        values = ", ".join(f"({r})" for r in [row, *more])
        frame = spark.sql(f"select * from values {values}").toDF(*[c.split()[0] for c in testtables.SCHEMAS[name].split(", ")])
        typed = frame.selectExpr(*[f"cast({c.split()[0]} as {c.split()[1]})" for c in testtables.SCHEMAS[name].split(", ")])
        typed.write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_customers_meet_orders_before_order_lines(spark, tables):
    feed = testtables.raw_sales(spark, tables)
    plan = feed._jdf.queryExecution().optimizedPlan().toString()
    joins = re.findall(r"Join Inner, \((\w+?)#\d+L? = (\w+?)#\d+L?\)", plan)
    assert set(joins[0]) == {"l_orderkey", "o_orderkey"}
    assert plan.index("l_partkey#") < plan.index("o_custkey#")
    named = {n: testtables.table(spark, tables, n) for n in ("lineitem", "orders", "customer", "nation", "region", "part")}
    text = testtables.RAW_SQL.replace("{text}", "string").replace("{years}", "interval '20' year")
    written = spark.sql(text, **named)
    assert feed.columns == written.columns and feed.count() == 6
    assert sorted(map(str, feed.collect())) == sorted(map(str, written.collect()))


def test_the_feed_is_not_stored_before_its_files_are(spark, tables, monkeypatch):
    def refused(*_):
        raise AssertionError("the feed is written once, as CSV")

    monkeypatch.setattr(queries, "staged", refused)
    got = queries.src_csv_incremental(spark, tables)
    assert got.count() == 6


def test_folders_are_looked_for_in_files_not_in_rows(spark, tables):
    found = queries.src_file_metadata(spark, tables)
    assert {tuple(r) for r in found.select("folder", "n", "time_is_set").collect()} == {("first", 4, True), ("second", 2, True)}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 2
    rows = testtables.raw_sales(spark, tables)
    assert rows.filter("l_returnflag = 'R'").count() == 2


def _shuffled(spark):
    """Files of the disks that hold what is shuffled; Spark removes them in the background."""
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (files.apply(i).getName() for i in range(files.size())) if name.startswith("shuffle_")}


def test_a_landed_feed_is_compressed_and_leaves_no_shuffles(spark, tables, monkeypatch):
    monkeypatch.setattr(queries, "FILE_ROWS", 1, raising=False)
    session = spark.newSession()
    for key, value in (("autoBroadcastJoinThreshold", "-1"), ("shuffle.partitions", "2"), ("session.timeZone", "UTC")):
        session.conf.set(f"spark.sql.{key}", value)
    before = _shuffled(spark)
    landing = queries._landing(session, tables)
    files = [f for f in glob.glob(f"{landing}/*/part-*") if gzip.open(f).read().count(b"\n") > 1]
    assert {os.path.splitext(f)[1] for f in files} == {".gz"} and len(files) == 6
    for _ in range(100):
        if not (left := _shuffled(spark) - before):
            break
        time.sleep(0.1)
    assert not left
    rows = sales_csv.read_files(spark, files)
    assert [r.product_name for r in rows.collect()] == ["Chair"] * 6


def _tables_of(spark, folder, lines):
    """So many order lines, each of an order and a supplier of its own; one row of the other tables."""
    for name, row in ROWS.items():
        fields = [c.split() for c in testtables.SCHEMAS[name].split(", ")]
        frame = spark.sql(f"select * from values ({row})").toDF(*[c for c, _ in fields])
        own = [c for c in ("l_orderkey", "o_orderkey", "l_suppkey") if c in frame.columns]
        if own:
            frame = frame.drop(*own).crossJoin(spark.range(lines).select(*[F.col("id").alias(c) for c in own]))
        frame.selectExpr(*[f"cast({c} as {kind})" for c, kind in fields]).write.parquet(f"{folder}/{name}.parquet")


def test_slices_of_the_feed_are_the_feed(spark, folder):
    _tables_of(spark, folder, 40)
    slices = testtables.raw_slices(spark, folder, 4)
    found = [sorted(map(str, rows.collect())) for rows in slices]
    assert len(slices) == 4 and all(found) and len(testtables.raw_slices(spark, folder)) == 1
    assert sorted(sum(found, [])) == sorted(map(str, testtables.raw_sales(spark, folder).collect()))
    plan = slices[1]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("pmod(xxhash64(l_orderkey") == plan.count("pmod(xxhash64(o_orderkey") == 1


def test_files_to_rescue_from_hold_the_whole_feed(spark, folder, monkeypatch):
    _tables_of(spark, folder, 40)
    monkeypatch.setattr(queries, "scratch_folder", lambda _, label: f"{folder}/{label}")
    assert len({r.order_id for r in queries.src_rescued_data(spark, folder).collect()}) == 40
    files = glob.glob(f"{folder}/rescue/part-*")
    assert sum(gzip.open(f).read().count(b"\n") - 1 for f in files) == 40


def test_the_first_lot_is_plain_and_small_the_second_is_compressed(spark, folder, monkeypatch):
    _tables_of(spark, folder, 400)
    monkeypatch.setattr(queries, "scratch_folder", lambda _, label: f"{folder}/{label}")
    assert queries.src_csv_incremental(spark, folder).count() == 400
    plain, packed = (
        sum(opened(f, "rb").read().count(b"\n") - 1 for f in glob.glob(f"{folder}/landing/{lot}/part-*"))
        for lot, opened in (("none", open), ("gzip", gzip.open)))
    assert 0 < plain < packed / 4 and plain + packed == 400
